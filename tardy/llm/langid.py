"""Language identification of mixed-language text.

Method: every word (a run of letters) has a script, read from code point ranges, which narrows
its candidate languages to those that use the script; each candidate gets a score from hashed
character n-grams of the word. A Viterbi pass over a text's words with a penalty for switching
the language labels spans; the language with the most letters is the prediction and its share of
letters the score.

The model is learned from labelled texts: counts of character bi-, tri- and 4-grams per language
in ``BUCKETS`` cells each, summed by the tasks and merged by a grouped sum. It holds
languages x 3 x BUCKETS numbers whatever the size of the corpus; that is all the driver sees.
"""

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.llm.common import bounded_batches

BUCKETS = 1 << 14
ORDERS = 3                        # bi-, tri- and 4-grams
SWITCH = 8.0                      # penalty (nats) for changing the language between two words
SCRIPT_SHARE = 0.01               # a language uses a script if so much of its letters are in it
UNKNOWN = "und"
BLOCK_CHARS = 1 << 20

# First code points of script ranges, each up to the next entry.
SCRIPT_RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"),
    (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))


class Alphabet:
    """Per code point: is it part of a word, its lower case, its script. Built once per task."""

    def __init__(self):
        size = 0x30000
        self.letter, self.word = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        self.lower = np.arange(size, dtype=np.uint32)
        self.script = np.zeros(size, dtype=np.uint8)
        for (first, name), (end, _) in zip(SCRIPT_RANGES, (*SCRIPT_RANGES[1:], (size, "")), strict=True):
            self.script[first:end] = SCRIPTS.index(name)
        for c in range(size):
            ch = chr(c)
            kind = unicodedata.category(ch)[0]
            self.letter[c] = kind == "L"
            self.word[c] = kind in "LM"
            if kind == "L" and len(low := ch.lower()) == 1:
                self.lower[c] = ord(low)


class Words:
    """Words of a block of texts as arrays: row, start (in characters of the row), features, script."""

    def __init__(self, alphabet: Alphabet, texts: list[str]):
        joined = " ".join(texts) + " "
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        # ideographs beyond the tables count as one letter of theirs, anything else there as a separator
        beyond = np.where(code < 0x323B0, 0x20000, 0)
        code = np.where(code < len(alphabet.word), code, beyond).astype(np.int64)
        inside = alphabet.word[code]
        self.letters = alphabet.letter[code]
        begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        row_start = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.at = np.flatnonzero(inside)                        # character positions inside words
        self.opens = np.searchsorted(self.at, begins)           # of each word, into ``at``
        self.lengths = np.diff(np.append(self.opens, len(self.at)))
        self.first = np.searchsorted(begins, row_start)         # words of row r: first[r]:first[r+1]
        self.row = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.start = begins - row_start[self.row]
        self.script = alphabet.script[code[begins]]
        self.n_letters = (np.add.reduceat(self.letters[self.at].astype(np.int64), self.opens)
                          if len(begins) else np.zeros(0, np.int64))
        c = np.where(inside, alphabet.lower[code], 0).astype(np.uint64)
        c = np.concatenate([[0], c, [0, 0]]).astype(np.uint64)
        i = self.at + 1
        before, here, after = c[i - 1], c[i], c[i + 1]
        beyond = np.where(after > 0, c[i + 2], 0)               # never look past the word's end
        two = before << np.uint64(21) | here
        self.features = np.stack([_bucket(two, 1), _bucket(two * np.uint64(0x9E3779B97F4A7C15) + after, 2),
                                  _bucket((two * np.uint64(0x9E3779B97F4A7C15) + after)
                                          * np.uint64(0xC2B2AE3D27D4EB4F) + beyond, 3)])


def _bucket(h, order: int):
    h = (h + np.uint64(order)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


class Model:
    """Log-probabilities per order, bucket and language, and the languages of each script."""

    def __init__(self, counts: list[tuple[str, int, int, int]]):
        self.langs = sorted({lang for lang, *_ in counts})
        where = {lang: i for i, lang in enumerate(self.langs)}
        grams = np.zeros((ORDERS, BUCKETS, len(self.langs)))
        scripts = np.zeros((len(SCRIPTS), len(self.langs)))
        for lang, order, bucket, n in counts:
            if order < ORDERS:
                grams[order, bucket, where[lang]] = n
            else:
                scripts[bucket, where[lang]] = n
        self.score = (np.log((grams + 0.1) / (grams.sum(axis=1, keepdims=True) + 0.1 * BUCKETS)) / ORDERS).astype(
            np.float32)
        share = scripts / np.maximum(1, scripts.sum(axis=0))
        # what a script rules out; a script no language uses rules out nothing
        out = share < SCRIPT_SHARE
        self.barred = np.where(out & ~out.all(axis=1, keepdims=True), np.float32(-1e6), np.float32(0))

    def word_scores(self, words: Words):
        """(words, languages) scores. Words without a letter say nothing."""
        per_char = sum(self.score[k][words.features[k]] for k in range(ORDERS))
        out = np.add.reduceat(per_char, words.opens, axis=0) + self.barred[words.script]
        out[words.n_letters == 0] = 0
        return out

    def labels(self, words: Words):
        """Viterbi: the language of every word. All rows of the block advance together.

        Each row's maximum is taken off its values at every step, so they stay as fine as those of one
        word however long the text is.
        """
        emit, first = self.word_scores(words), words.first
        n = np.diff(first)
        order = np.argsort(-n, kind="stable")
        begins, n = first[:-1][order], n[order]
        steps = int(n[0]) if len(n) else 0
        active = np.searchsorted(-n, -np.arange(steps), side="left")    # rows with more than t words
        value = np.zeros((len(n), len(self.langs)), dtype=np.float32)
        switched = np.zeros(emit.shape, dtype=bool)
        source = np.zeros(len(emit), dtype=np.int32)
        for t in range(steps):
            k = active[t]
            v, at = value[:k], begins[:k] + t
            if t:
                top = v.argmax(axis=1)
                v = v - v[np.arange(k), top][:, None]
                switched[at] = v < -np.float32(SWITCH)
                source[at] = top
                v = np.maximum(v, -np.float32(SWITCH))
            value[:k] = v + emit[at]
        state, out = value.argmax(axis=1), np.zeros(len(emit), dtype=np.int32)
        for t in range(steps - 1, -1, -1):
            k = active[t]
            at = begins[:k] + t
            out[at] = state[:k]
            state[:k] = np.where(switched[at, state[:k]], source[at], state[:k])
        return out


def _blocks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t.as_py() or ""
        held.append(t)
        size += len(t)
        if size >= BLOCK_CHARS:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Model from all rows with a language and a text. Nothing else is looked at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        grams = defaultdict(lambda: np.zeros((ORDERS, BUCKETS), dtype=np.int64))
        scripts = defaultdict(lambda: np.zeros(len(SCRIPTS), dtype=np.int64))
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at, texts in _blocks(batch.column(1)):
                words = Words(alphabet, texts)
                char_row = np.repeat(words.row, words.lengths)
                names = np.array(langs[at:at + len(texts)], dtype=object)
                for lang in set(names.tolist()):
                    rows = names == lang
                    mine = rows[char_row]
                    for k in range(ORDERS):
                        grams[lang][k] += np.bincount(words.features[k][mine], minlength=BUCKETS)
                    some = rows[words.row]
                    scripts[lang] += np.bincount(words.script[some], weights=words.n_letters[some],
                                                 minlength=len(SCRIPTS)).astype(np.int64)
        for lang, table in grams.items():
            for order, counts in [*enumerate(table), (ORDERS, scripts[lang])]:
                cells = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(cells), pa.string()), pa.array(np.full(len(cells), order), pa.int64()),
                     pa.array(cells), pa.array(counts[cells])], names=["lang", "order", "bucket", "n"])

    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null")
    cells = rows.mapInArrow(run, "lang string, order long, bucket long, n long")
    cells = cells.groupBy("lang", "order", "bucket").agg(F.sum("n").alias("n"))
    return Model([tuple(r) for r in cells.collect()])


def predict_udf(model: Model):
    """Column function: text -> struct(lang_pred, score, spans)."""
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        alphabet = Alphabet()
        span = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("lang", pa.string())])
        for batch in batches:
            preds, scores, spans = [], [], []
            for _, texts in _blocks(batch):
                for held, more in zip((preds, scores, spans), label(model, alphabet, texts), strict=True):
                    held.extend(more)
            yield pa.StructArray.from_arrays(
                [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                names=["lang_pred", "score", "spans"])

    return F.arrow_udf(predict, "struct<lang_pred: string, score: double, "
                                "spans: array<struct<start: int, length: int, lang: string>>>")


def identify(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with ``out_col``: lang_pred, score, spans (start and length in characters, lang).

    A null text, one without a letter, or an empty model gives ``und`` with score 0 and no spans.
    Whole texts are labelled; nothing is shuffled. ``docs`` keeps its columns; one that is named
    like ``out_col`` is replaced.
    """
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out_col, predict_udf(model)(F.col(text_col).cast("string")))


def label(model: Model, alphabet: Alphabet, texts: list[str]):
    """Predictions, scores and spans of a block of texts."""
    preds, scores, spans = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    words = Words(alphabet, texts)
    if not model.langs or not len(words.start):
        return preds, scores, spans
    langs = model.labels(words)
    weight = np.zeros((len(texts), len(model.langs)))
    np.add.at(weight, (words.row, langs), words.n_letters)
    total = weight.sum(axis=1)
    for r in np.flatnonzero(total > 0):
        best = int(weight[r].argmax())
        preds[r], scores[r] = model.langs[best], float(weight[r, best] / total[r])
    breaks = np.ones(len(langs), dtype=bool)
    breaks[1:] = (np.diff(words.row) > 0) | (np.diff(langs) != 0)
    begin = np.flatnonzero(breaks)
    last = np.append(begin[1:], len(langs)) - 1
    for i, j in zip(begin.tolist(), last.tolist(), strict=True):
        start = int(words.start[i])
        if total[words.row[i]] > 0:
            spans[words.row[i]].append({"start": start, "length": int(words.start[j] + words.lengths[j]) - start,
                                        "lang": model.langs[langs[i]]})
    return preds, scores, spans

