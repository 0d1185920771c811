"""Substring dedup: remove every word covered by a window of words that occurs elsewhere.

Method, count-min prefilter: a first pass over the texts counts windows in a sketch that can only
overestimate; a second pass groups exactly those windows that the sketch calls repeated, so none
is lost.

* A window is represented in the sketch by its least inner 10-word gram. Equal windows have equal
  grams, so a gram's count is never less than the count of any window it stands for; neighbouring
  windows mostly share their gram, and one such run of windows is counted as one row.
* Each task sums its own sketch (map-side partial aggregation) and the shuffle merges the partial
  sketches cell by cell. A gram that is everywhere is one row per task. The sketch is a table of
  cells, looked up by an equi-join: it grows with the corpus and is never broadcast.
* Runs that survive all rows of the sketch are grouped by the hash of all their words. Runs that
  occur twice are repeated as a whole. Where runs with one gram differ, their windows are compared
  one by one by 128-bit hashes of their words.

Windows that repeat inside one run (text that repeats itself closely) count twice in the sketch
and always go to the window-by-window comparison.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.llm.common import bounded_batches, by_shuffle, stored, text_or_empty
from tardy.llm.wordhash import WordHasher, row_blocks

WINDOW, GRAM = 35, 10
REACH = WINDOW - GRAM + 1         # grams inside a window
DEPTH, CELL_BITS = 2, 40          # rows of the sketch and bits of a cell number
RUN = "m long, rh long, doc_id long, th long, start int, n int, multi int"


def _sliding_min(values, width: int):
    """Minimum of every ``width`` consecutive values."""
    low, span = values, 1
    while 2 * span <= width:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    rest = width - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def runs_of(hasher: WordHasher, texts: pa.Array):
    """Runs of windows with one least gram: (row, start, number of windows, gram, hash, multi).

    ``start`` counts words from the row's first; ``multi`` is 1 where a gram repeats so closely
    that the run may hold a window twice.
    """
    words, first = hasher.words(texts)
    if len(words) < WINDOW:
        return [np.zeros(0, dtype=np.int64)] * 6
    sums = hasher.totals(words)
    grams = hasher.span(sums, np.arange(len(words) - GRAM + 1), GRAM)
    least = _sliding_min(grams, REACH)
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    inside = np.flatnonzero(row[:len(least)] == row[WINDOW - 1:])       # windows within one row
    if not len(inside):
        return [np.zeros(0, dtype=np.int64)] * 6
    breaks = np.ones(len(inside), dtype=bool)
    breaks[1:] = (np.diff(inside) > 1) | (least[inside[1:]] != least[inside[:-1]])
    opens = np.flatnonzero(breaks)
    n = np.diff(np.append(opens, len(inside)))
    start = inside[opens]
    close = np.zeros(len(grams) + 1, dtype=np.int64)                    # a gram that comes again at once
    for d in range(1, REACH):
        close[1:len(grams) - d + 1] |= grams[d:] == grams[:-d]
    close = np.cumsum(close)
    multi = (n > REACH) | (close[np.minimum(start + n + REACH - 1, len(grams))] > close[start])
    whole = hasher.span(sums, start, n + WINDOW - 1)
    return [row[start], start - first[row[start]], n, least[start], whole, multi.astype(np.int64)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, th (hash of the text) and text: rows with equal keys are the same document."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def sketch_cells(rows: DataFrame) -> DataFrame:
    """(m, n): distinct grams of each block of text with their counts, the input of the sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(seed=11)
        for batch in batches:
            for _, texts in row_blocks(batch.column(0)):
                _, _, _, gram, _, multi = runs_of(hasher, texts)
                m, at = np.unique(gram.astype(np.uint64), return_inverse=True)
                n = np.bincount(at, weights=1 + multi, minlength=len(m)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(n)], names=["m", "n"])

    return rows.select("text").mapInArrow(run, "m long, n long")


def cell(row: int):
    """The cell of gram ``m`` in a row of the sketch."""
    h = F.col("m") if row == 0 else F.xxhash64("m", F.lit(row))
    return F.shiftrightunsigned(h, 64 - CELL_BITS)


def repeated_cells(counts: DataFrame, row: int) -> DataFrame:
    """Cells of one merged sketch row that hold two windows or more."""
    merged = counts.groupBy(cell(row).alias("cell")).agg(F.sum("n").alias("n"))
    return merged.filter("n > 1").select("cell")


def window_runs(rows: DataFrame) -> DataFrame:
    """All runs with their place: second pass over the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(seed=11)
        for batch in batches:
            for at, texts in row_blocks(batch.column(2)):
                row, start, n, gram, whole, multi = runs_of(hasher, texts)
                take = pa.array(row + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.astype(np.uint64).view(np.int64)), pa.array(whole.astype(np.uint64).view(np.int64)),
                     batch.column(0).take(take), batch.column(1).take(take), pa.array(start.astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(multi.astype(np.int32))],
                    names=["m", "rh", "doc_id", "th", "start", "n", "multi"])

    return rows.mapInArrow(run, RUN)


def estimated_repeats(rows: DataFrame) -> DataFrame:
    """Runs whose gram every row of the sketch counts at least twice."""
    counts = sketch_cells(rows)
    runs = window_runs(rows)
    for row in range(DEPTH):
        # a later row only needs the runs that are left: all copies of a repeated gram are among them
        counts = counts if row == 0 else runs.select("m", (F.col("multi") + 1).cast("long").alias("n"))
        # written before the look-up, so the join is one of two plain tables that can be split
        cells = stored(repeated_cells(counts, row), f"cells-{row}").withColumnRenamed("cell", "hit")
        runs = stored(runs.join(by_shuffle(cells), cell(row) == F.col("hit"), "left_semi"), f"runs-{row}")
    return runs


def windows_of(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Every window of the given runs: w1, w2 (hashes of its words), doc_id, th, pos, whole."""
    per_doc = runs.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n", "whole")).alias("runs"))
    met = rows.join(by_shuffle(per_doc.withColumnRenamed("doc_id", "d").withColumnRenamed("th", "t")),
                    F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
                    ).select("doc_id", "th", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = WordHasher(seed=11), WordHasher(seed=12)
        for batch in batches:
            lists = batch.column(3)
            for at, texts in row_blocks(batch.column(2)):
                w1, w2, take, pos, whole = [], [], [], [], []
                sums, first = [], None
                for hasher in (one, two):
                    words, first = hasher.words(texts)
                    sums.append((hasher, hasher.totals(words)))
                for i in range(len(texts)):
                    for r in lists[at + i].as_py():
                        begin = int(first[i]) + r["start"]
                        places = np.arange(begin, begin + r["n"])
                        w1.append(sums[0][0].span(sums[0][1], places, WINDOW))
                        w2.append(sums[1][0].span(sums[1][1], places, WINDOW))
                        take += [at + i] * r["n"]
                        pos.append(np.arange(r["start"], r["start"] + r["n"], dtype=np.int32))
                        whole += [r["whole"]] * r["n"]
                if take:
                    who = pa.array(take, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(w1).view(np.int64)), pa.array(np.concatenate(w2).view(np.int64)),
                         batch.column(0).take(who), batch.column(1).take(who), pa.array(np.concatenate(pos)),
                         pa.array(whole, pa.bool_())], names=["w1", "w2", "doc_id", "th", "pos", "whole"])

    return met.mapInArrow(run, "w1 long, w2 long, doc_id long, th long, pos int, whole boolean")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """doc_id, th, start, n: runs of n windows from word ``start`` on that occur elsewhere too."""
    runs = estimated_repeats(rows)
    place = F.struct("doc_id", "th", "start", "n")
    same = runs.groupBy("m", "rh").agg(F.count(F.lit(1)).alias("copies"), F.max("multi").alias("multi"),
                                       F.min(place).alias("place"))
    same = stored(same, "distinct-runs")
    whole = runs.join(by_shuffle(same.filter("copies > 1").select("m", "rh")), ["m", "rh"], "left_semi")
    whole = whole.select("doc_id", "th", "start", "n")

    # runs that share their gram with a different run, or may repeat inside: window by window
    mixed = same.groupBy("m").agg(F.count(F.lit(1)).alias("kinds"), F.max("multi").alias("any")).filter(
        "kinds > 1 or any > 0").select("m")
    look = same.join(by_shuffle(mixed), "m", "left_semi").select("place.*", (F.col("copies") > 1).alias("whole"))
    windows = stored(windows_of(rows, look), "windows")
    twice = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    single = windows.filter("not whole").join(by_shuffle(twice), ["w1", "w2"], "left_semi").select(
        "doc_id", "th", F.col("pos").alias("start"), F.lit(1).alias("n"))
    return whole.unionByName(single)


def _kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts and their spans -> struct(n_words, n_removed, kept_text)."""
    for texts, span_lists in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(texts, span_lists, strict=True):
            words = (text.as_py() or "").encode().split()            # exactly space and 0x09-0x0D
            n = len(words)
            spans = spans.as_py()
            if spans:
                cover = np.zeros(n + 1, dtype=np.int64)
                for s in spans:
                    cover[s["start"]] += 1
                    cover[s["start"] + s["n"] + WINDOW - 1] -= 1
                words = [words[k] for k in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
            n_words.append(n)
            n_removed.append(n - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   out_col: str = "repeats") -> DataFrame:
    """``docs`` with ``out_col``: n_words, n_removed, kept_text (kept words, one space between).

    A word goes when a window of 35 words that covers it has the same words as a window that
    starts anywhere else, in this or another document. Null and empty texts have no words; texts
    shorter than a window lose nothing; null and repeated doc_ids are allowed (rows that repeat id
    and text are separate documents and remove each other). ``docs`` keeps its columns; one that
    is named like ``out_col`` is replaced.
    """
    bounded_batches(docs.sparkSession)
    spans = repeated_spans(_keyed(docs, id_col, text_col))
    place = F.collect_set(F.struct("start", "n"))
    per_doc = spans.groupBy("doc_id", "th").agg(place.alias("spans")).select(
        F.struct("doc_id", "th").alias("__place"), F.col("spans").alias("__spans"))
    key = F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("th"))
    met = docs.withColumn("__key", key)
    met = met.join(by_shuffle(per_doc), F.col("__key") == F.col("__place"), "left")
    out = F.arrow_udf(_kept, "struct<n_words: bigint, n_removed: bigint, kept_text: string>")
    met = met.withColumn(out_col, out(text_or_empty(text_col), F.col("__spans")))
    return met.drop("__key", "__place", "__spans")
