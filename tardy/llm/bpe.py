"""BPE encoding and decoding over a prefix-sharing trie of the distinct words.

Method: the encoding of a string is the encoding of some shorter prefix plus one last token, and
a sequence of tokens is an encoding exactly when every neighbouring pair is one. So one number per
prefix, its last token, describes the encodings of all prefixes. The distinct words of a batch
are inserted into a trie; a depth-first walk gives each node its last token from the states of
its ancestors, so a prefix shared by many words is encoded once. A word's ids are read back along
the chain of last tokens from its end node.

Works for merge tables in which every token is made by one merge, with or without an end-of-word
suffix. Each task works on its own Arrow batches (bounded in rows and bytes); nothing is shuffled.
"""

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from tardy.llm.common import bounded_batches, once_per_worker

NEVER = 1 << 60
CACHE_WORDS = 400_000         # distinct words a worker remembers before it starts afresh
CACHE_PAIRS = 500_000         # likewise for token pairs


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(shifted)) for b in range(256)]


class TrieBpe:
    """Merge table plus the trie walk. Words are strings over the byte alphabet."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.vocab, self.end = vocab, end
        self.rank = {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(merges)}
        self.made_by = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in merges}
        # every prefix of a token: the states of the automaton that finds the tokens ending a path
        self.prefixes = {t[:i] for t in vocab for i in range(len(t) + 1)}
        self.steps: dict[str, dict[str, str]] = {}
        self.ending: dict[str, tuple] = {}
        self.spines: dict[int, tuple] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank at which the part becomes the next one) along one edge of a token's merges."""
        key = 2 * token + side
        if key not in self.spines:
            parts, until = [], NEVER
            while True:
                parts.append((token, until))
                if token not in self.made_by:
                    break
                until, token = self.rank[self.made_by[token]], self.made_by[token][side]
            self.spines[key] = parts[::-1]
        return self.spines[key]

    def meet(self, left: int, right: int, limit: int = NEVER) -> bool:
        """Do two neighbouring tokens stay apart? Merges of rank ``limit`` and above are ignored.

        Both tokens grow from single characters; at each moment the two parts that touch are
        known, and the tokens are no encoding if those parts would merge before either grows.
        Of equal ranks the leftmost merge comes first.
        """
        a, b = self.spine(left, 1), self.spine(right, 0)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            across = self.rank.get((x, y), NEVER)
            if across < x_until and across <= y_until and across < limit:
                return False
            if x_until == NEVER and y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def pair(self, left: int, right: int) -> bool:
        key = (left, right)
        if key not in self.pairs:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.meet(left, right)
        return self.pairs[key]

    def is_whole(self, token: int) -> bool:
        """Does the token's own string encode to the token?"""
        if token not in self.whole:
            parts = self.made_by.get(token)
            self.whole[token] = parts is None or (
                self.is_whole(parts[0]) and self.is_whole(parts[1])
                and self.meet(parts[0], parts[1], self.rank[parts]))
        return self.whole[token]

    def step(self, state: str, ch: str) -> str:
        """The longest suffix of state + ch that begins some token."""
        known = self.steps.setdefault(state, {})
        if ch not in known:
            s = state + ch
            while s not in self.prefixes:
                s = s[1:]
            known[ch] = s
        return known[ch]

    def tokens_ending(self, state: str) -> tuple:
        """Two lists of (token, length), longest first: tokens that end a path in this state, inside
        a word and at the word's end."""
        if state not in self.ending:
            both = []
            for suffix in ("", self.end):
                found = ((self.vocab.get(state[i:] + suffix), len(state) - i) for i in range(len(state)))
                both.append([(t, n) for t, n in found if t is not None and self.is_whole(t)])
            self.ending[state] = tuple(both)
        return self.ending[state]

    def last_token(self, candidates, depth: int, last: list[int]) -> tuple[int, int]:
        """The one candidate that may follow the last token of the prefix before it."""
        pairs = self.pairs
        for token, length in candidates:
            if length == depth:
                return token, length
            key = (last[depth - length], token)
            fits = pairs.get(key)
            if fits is None:
                fits = self.pair(*key)
            if fits:
                return token, length
        raise ValueError("no token ends this prefix")

    def encode_words(self, words) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words by one depth-first walk over their trie.

        Sorted words are the trie's leaves in depth-first order and the common prefix of
        neighbours is the part of the path that stays, so the trie is walked with one stack (the
        prefix states) and never held as nodes. Each distinct prefix is visited once.
        """
        out: dict[str, tuple[int, ...]] = {}
        last, size, states = [-1], [0], [""]        # of the first d characters of the path
        before = ""
        for word in sorted(words):
            n = len(word)
            if not n:
                out[word] = ()
                continue
            keep, most = 0, min(len(states) - 1, n)
            while keep < most and word[keep] == before[keep]:
                keep += 1
            keep = min(keep, n - 1)
            del last[keep + 1:], size[keep + 1:], states[keep + 1:]
            state = states[keep]
            for depth in range(keep + 1, n + 1):
                ch = word[depth - 1]
                state = self.steps.get(state, {}).get(ch) or self.step(state, ch)
                inside, at_end = self.ending.get(state) or self.tokens_ending(state)
                if depth == n and self.end:
                    token, length = self.last_token(at_end, depth, last)
                else:
                    token, length = self.last_token(inside, depth, last)
                    states.append(state)
                    last.append(token)
                    size.append(length)
            ids, depth = [token], n - length
            while depth:
                ids.append(last[depth])
                depth -= size[depth]
            ids.reverse()
            out[word] = tuple(ids)
            before = word
        return out


class WordTokenizer:
    """Encoder and decoder for one tokenizer file of the kind of ``word_bpe_49k.json``.

    Normalisation: canonical composition, white space runs as one space, lower case. Words:
    contractions, letter runs, single digits, runs of other signs. Special tokens in a text are
    found first and become their own ids.
    """

    WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"     # fixed by the vocabulary

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        model = conf["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.bpe = TrieBpe(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.find = regex.compile(self.WORD).findall
        self.hard = regex.compile(r"[^\t\n\r\x20-\x7e\xa0-ɏ]").search
        self.alphabet = byte_alphabet()
        self.path = path
        self.library = None
        self.cache: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens, as normalised strings."""
        if not self.hard(text):
            return self.find(text.lower())        # composed already; white space only separates
        if self.library is None:                  # rare scripts: the file's own normaliser decides
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
            self.unbyte = {c: b for b, c in enumerate(self.alphabet)}
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.unbyte[c] for c in piece).decode("utf-8") for piece, _ in pieces]

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not yet known, together, over one trie."""
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = list(words)
        spelled = {"".join(self.alphabet[b] for b in w.encode("utf-8")): w for w in new}
        for s, ids in self.bpe.encode_words(spelled).items():
            self.cache[spelled[s]] = np.array(ids, dtype="<i4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = []
        for t in texts:
            parts = self.split_special.split(t) if self.split_special else [t]
            split.append([(self.special[p] if i % 2 else self.words(p)) for i, p in enumerate(parts)])
        self.learn({w for parts in split for p in parts if not isinstance(p, int) for w in p})
        get = self.cache.__getitem__
        return [b"".join(p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(get, p)) for p in parts)
                for parts in split]


class Decoder:
    """Names of the tokens of a tokenizer file; a text is its tokens' names joined by one space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.names = {i: t for t, i in conf["model"]["vocab"].items()}
        self.names.update((t["id"], t["content"]) for t in conf["added_tokens"])

    def decode(self, ids) -> str:
        """Unknown ids are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])


def _groups(texts: pa.Array, limit: int = 2 << 20) -> Iterator[list[str]]:
    """Texts of an Arrow array in groups of about ``limit`` characters; null counts as empty."""
    group, held = [], 0
    for t in texts:
        t = t.as_py() or ""
        group.append(t)
        held += len(t)
        if held >= limit:
            yield group
            group, held = [], 0
    if group:
        yield group


def encode_udf(path: str):
    """Column function: text -> array<int> of token ids (null text: no ids)."""
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = once_per_worker(("word tokenizer", path), lambda: WordTokenizer(path))
        for texts in batches:
            rows = [r for group in _groups(texts) for r in tok.encode_batch(group)]
            ends = np.cumsum([0] + [len(r) // 4 for r in rows])
            flat = np.frombuffer(b"".join(rows), dtype="<i4")
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return F.arrow_udf(encode, "array<int>")


def decode_udf(path: str):
    """Column function: array<int> of token ids -> text (null or empty: the empty text)."""
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = once_per_worker(("decoder", path), lambda: Decoder(path))
        for ids in batches:
            yield pa.array([names.decode(row.values.to_numpy(zero_copy_only=False).tolist()) if row.is_valid else ""
                            for row in ids], pa.string())

    return F.arrow_udf(decode, "string")


def round_trip_udf(path: str):
    """Column function: text -> struct of ids and decoded, the text of those ids, by one worker."""
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = once_per_worker(("word tokenizer", path), lambda: WordTokenizer(path))
        names = once_per_worker(("decoder", path), lambda: Decoder(path))
        for texts in batches:
            rows = [r for group in _groups(texts) for r in tok.encode_batch(group)]
            ends = np.cumsum([0] + [len(r) // 4 for r in rows])
            flat = np.frombuffer(b"".join(rows), dtype="<i4")
            decoded = pa.array([names.decode(np.frombuffer(r, dtype="<i4").tolist()) for r in rows], pa.string())
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.StructArray.from_arrays([ids, decoded], names=["ids", "decoded"])

    return F.arrow_udf(both, "struct<ids: array<int>, decoded: string>")


def round_trip(docs, path: str, text_col: str = "text", out_col: str = "coded"):
    """``docs`` with the struct ``out_col`` of each whole text's ids and the text that they decode to."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out_col, round_trip_udf(path)(F.col(text_col).cast("string")))


def encode(docs, path: str, text_col: str = "text", out_col: str = "ids"):
    """``docs`` with the ids of every whole text in ``out_col``. Null texts encode to no ids."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out_col, encode_udf(path)(F.col(text_col).cast("string")))


def decode(encoded, path: str, ids_col: str = "ids", out_col: str = "decoded"):
    """``encoded`` with the text of every id list in ``out_col``."""
    bounded_batches(encoded.sparkSession)
    return encoded.withColumn(out_col, decode_udf(path)(F.col(ids_col)))

