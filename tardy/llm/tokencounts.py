"""Exact token counts of every prefix of a text by dynamic programming.

Method: the encoding of a prefix is the encoding of a shorter prefix and one last token, so its
token count is that prefix's count and one. One pass over a word gives the counts of all its
prefixes; a text's counts are its words' counts on top of the tokens before them. What is stored is
the count at every character, and questions about truncation and budgets are answered from the
stored counts without encoding anything again (``tokens_at``, ``longest_fit``).

A prefix is counted as the text that it is. Three places need care, because the words of a prefix
are not always the first words of the text: white space before a word is one word when the prefix
ends there; the start of a contraction is an apostrophe and letters; the start of a special
token is ordinary text that joins what stands before it.

Words of one worker process are counted once for all its tasks (a bounded cache). Nothing is
shuffled; memory is bounded by the Arrow batch and the longest text.
"""

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.llm.bpe import TrieBpe, byte_alphabet
from tardy.llm.common import bounded_batches, once_per_worker

CACHE_WORDS = 600_000         # distinct words a worker remembers before it starts afresh
CACHE_PAIRS = 1_000_000       # likewise for token pairs
LONG_WORD = 200               # characters; longer words are not remembered


class PrefixCounter:
    """Token counts of all prefixes under a byte-level vocabulary file."""

    WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"   # fixed by the vocabulary
    CONTRACTIONS = ("'re", "'ve", "'ll")       # those whose start of two characters is two words

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in conf["model"]["merges"]]
        self.bpe = TrieBpe(conf["model"]["vocab"], merges)
        self.alphabet = byte_alphabet()
        self.special = [t["content"] for t in conf["added_tokens"]]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.find = regex.compile(self.WORD).findall
        self.blank_runs = regex.compile(r"\p{White_Space}{2,}(?=\P{White_Space})").finditer
        self.hard = regex.compile(r"[^\t\n\r\x20-\x7e\xa0-ɏ]").search
        self.path, self.library = path, None
        self.cache: dict[str, bytes] = {}
        # states as numbers: state and byte -> state, tokens that end there, token pairs -> may they meet
        self.names, self.numbers, self.ending = [""], {"": 0}, [()]
        self.steps: dict[int, int] = {}
        self.pairs: dict[int, bool] = {}

    def words(self, text: str) -> list[str]:
        if not self.hard(text):
            return self.find(text)
        if self.library is None:              # rare scripts: the file's own rules split the text
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def grow(self, state: int, byte: int) -> int:
        """The state after one more byte: the longest suffix so far that begins some token."""
        name = self.bpe.step(self.names[state], self.alphabet[byte])
        if name not in self.numbers:
            self.numbers[name] = len(self.names)
            self.names.append(name)
            self.ending.append(tuple(self.bpe.tokens_ending(name)[0]))
        to = self.steps[state << 8 | byte] = self.numbers[name]
        return to

    def may_follow(self, key: int) -> bool:
        """May the token in the low bits of ``key`` follow the one in its high bits?"""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        fits = self.pairs[key] = self.bpe.meet(key >> 32, key & 0xFFFFFFFF)
        return fits

    def word_counts(self, word: str) -> bytes:
        """Little-endian 32-bit token counts of the word's prefixes of 1, 2, ... characters."""
        raw = word.encode("utf-8")
        steps, ending, pairs = self.steps, self.ending, self.pairs
        last, counts, state = [-1], [0], 0
        for depth, byte in enumerate(raw, 1):
            to = steps.get(state << 8 | byte)
            state = self.grow(state, byte) if to is None else to
            for token, length in ending[state]:       # longest first; one of them ends the encoding
                if length == depth:
                    break
                key = last[depth - length] << 32 | token
                fits = pairs.get(key)
                if self.may_follow(key) if fits is None else fits:
                    break
            else:
                raise ValueError("no token ends this prefix")
            last.append(token)
            counts.append(counts[depth - length] + 1)
        out = np.array(counts[1:], dtype="<i4")
        if len(raw) > len(word):              # keep the counts at the characters' last bytes
            data = np.frombuffer(raw, dtype=np.uint8)
            out = out[np.append(data[1:] & 0xC0 != 0x80, True)]
        if word in self.CONTRACTIONS:
            out[1] = 2
        return out.tobytes()

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Counts of words that the cache lacks; those of very long words are returned only."""
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = list(words)
        long = {}
        for w in new:
            (self.cache if len(w) <= LONG_WORD else long)[w] = self.word_counts(w)
        return long

    def plain(self, text: str) -> np.ndarray:
        """Counts at every prefix of a text without special tokens (the empty one left out)."""
        words = self.words(text)
        if not words:
            return np.zeros(0, dtype=np.int64)
        runs = [m.span() for m in self.blank_runs(text)]
        get = self.cache
        if long := self.learn({*words, *(text[a:b] for a, b in runs)}):
            get = self.cache | long
        counts = np.frombuffer(b"".join(map(get.__getitem__, words)), dtype="<i4").astype(np.int64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        totals = counts[np.cumsum(sizes) - 1]
        counts += np.repeat(np.cumsum(totals) - totals, sizes)
        for a, b in runs:
            counts[b - 1] = (counts[a - 1] if a else 0) + np.frombuffer(get[text[a:b]][-4:], dtype="<i4")[0]
        return counts

    def prefixes(self, text: str) -> np.ndarray:
        """Exact token counts of the prefixes of 1, 2, ... characters of any text."""
        if not self.split_special or not any(s in text for s in self.special):
            return self.plain(text)
        out, before = [], 0
        parts = self.split_special.split(text)
        for part, token in zip(parts[::2], [*parts[1::2], ""], strict=True):
            counts = before + self.plain(part + token[:-1])
            out.append(counts)
            before = int(counts[len(part) - 1]) if part else before
            if token:
                before += 1
                out.append(np.array([before]))
        return np.concatenate(out)


def _fit(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    return int(np.append(np.flatnonzero(counts <= budget), -1).max()) + 1


def counts_udf(path: str, budgets: tuple[int, ...] = (), with_prefixes: bool = False):
    """Column function: text -> struct of n_bytes, n_tokens, fits and, if asked for, prefixes."""
    kind = "struct<n_bytes: bigint, n_tokens: bigint, fits: array<bigint>" + ", prefixes: array<int>" * with_prefixes + ">"

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = once_per_worker(("prefix counter", path), lambda: PrefixCounter(path))
        for texts in batches:
            n_tokens, fits, kept, ends = [], [], [], [0]
            for t in texts:
                counts = counter.prefixes(t.as_py() or "")
                n_tokens.append(int(counts[-1]) if len(counts) else 0)
                fits.append([_fit(counts, b) for b in budgets])
                if with_prefixes:
                    kept.append(counts.astype(np.int32))
                    ends.append(ends[-1] + len(counts))
            cols = [pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()), pa.array(n_tokens, pa.int64()),
                    pa.array(fits, pa.list_(pa.int64()))]
            names = ["n_bytes", "n_tokens", "fits"]
            if with_prefixes:
                flat = np.concatenate(kept) if kept else np.zeros(0, dtype=np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))
                names.append("prefixes")
            yield pa.StructArray.from_arrays(cols, names=names)

    return F.arrow_udf(run, kind)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "tokens",
                 budgets: tuple[int, ...] = (), with_prefixes: bool = False) -> DataFrame:
    """``docs`` with the struct ``out_col``: n_bytes (UTF-8), n_tokens, fits and prefixes.

    ``fits`` has, for each of ``budgets``, the characters of the longest prefix of at most so many
    tokens (counts can fall from one prefix to the next, so the longest is not the first that
    fits). ``prefixes`` (only with ``with_prefixes``) has the token count of the first 1, 2, ...
    characters: store it to answer later questions. A null text counts as empty: no bytes,
    no tokens, no prefixes. Rows stay as they are, repeated ones too; other columns are kept under any
    name but ``out_col``. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out_col, counts_udf(path, budgets, with_prefixes)(F.col(text_col).cast("string")))


def tokens_at(prefixes: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` characters, from stored counts; past the end, of the whole text."""
    n = F.least(n_chars, F.size(prefixes))
    return F.when(n > 0, F.element_at(prefixes, F.greatest(n, F.lit(1)).cast("int"))).otherwise(F.lit(0))


def longest_fit(prefixes: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from stored counts."""
    fits = F.transform(F.reverse(prefixes), lambda c: c <= budget)
    at = F.array_position(fits, True)
    return F.when(at > 0, F.size(prefixes) - at + 1).otherwise(F.lit(0))
