"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Method, bulk-synchronous best fit: pieces are range-sorted by length and ranked within their
length over the whole table; open gaps are kept sorted by size. One superstep handles all pieces
of one length, longest first: a successor sweep takes the smallest gaps that are large enough,
pieces that want the same gap are resolved by rank (rank r takes the r-th place), the gaps that
were used are updated and the next superstep begins. Pieces no gap can hold open new sequences.
This is best-fit decreasing, and equal pieces being interchangeable it is exact.

Gaps are held as runs of sequences with equal gaps, so the sweep's state has at most a few runs
per length: it grows with the capacity, never with the table, and so does the plan it returns
(length, first rank, ...), which is all that the tasks need to place their pieces. What grows
with the table (tokenising, sorting, ranking, placing) is done by the executors.
"""

import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tardy.llm.bpe import byte_alphabet
from tardy.llm.common import bounded_batches, stored

LONG_RUN = 500                # characters of a word or blank run that the faster encoder takes
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
ROWS_AT_ONCE = 300


class ByteTokenizer:
    """Ids of a byte-level vocabulary file.

    Two public encoders of the same merges share the work: the faster one takes texts in Latin
    characters with words and white space of ordinary length; texts with special tokens, other
    scripts or very long runs go to the library that the file belongs to.
    """

    WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"   # fixed by the vocabulary

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in conf["model"]["vocab"].items()}
        self.fast = tiktoken.Encoding("file", pat_str=self.WORD, mergeable_ranks=ranks, special_tokens={})
        special = [t["content"] for t in conf["added_tokens"]]
        self.hard = regex.compile("|".join([r"[^\t\n\r\x20-\x7e\xa0-ɏ]", *map(regex.escape, special)])).search
        self.blank_run = re.compile(rf"\s{{{LONG_RUN}}}").search

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if self.hard(text) or self.blank_run(text) or max(map(len, text.split()), default=0) > LONG_RUN:
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids)
        else:
            ids = self.fast.encode_to_numpy(text, disallowed_special=())
        return ids.astype("<i4").tobytes()


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only a document over capacity is cut, into full
    pieces with the shorter remainder first."""
    first = length % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)] if length else []


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    Ids are the text's tokens and the end id; ids_crc32 is the unsigned CRC-32 of a piece's ids as
    little-endian unsigned 32-bit numbers. Null text counts as empty, so each document has at
    least its end id. Memory is bounded by the Arrow batch and the longest document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = ByteTokenizer(path)
        end = np.array([end_id], dtype="<i4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, len(texts), ROWS_AT_ONCE):
                some = [t or "" for t in texts.slice(at, ROWS_AT_ONCE).to_pylist()]
                rows, flat = [], []
                for i, text in enumerate(some):
                    raw = tok.encode(text) + end
                    flat.append(raw)
                    for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                        rows.append((at + i, k, s, n, zlib.crc32(raw[4 * s:4 * (s + n)])))
                doc, piece, start, length, crc = zip(*rows, strict=True)
                cols = [ids.take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    ends = pa.array(np.cumsum([0, *length]), pa.int32())
                    cols.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(flat), dtype="<i4"))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = PIECE_SCHEMA + ", ids array<int>" * with_ids
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


class Gaps:
    """Open sequences as runs (first sequence, how many, gap), kept sorted by gap."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def put(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self.runs:
                self.sizes.insert(bisect_left(self.sizes, gap), gap)
                self.runs[gap] = []
            self.runs[gap].append((first, count))

    def successor(self, length: int) -> tuple[int, int, int] | None:
        """Take out a run of the smallest gap of at least ``length``."""
        at = bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, count = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap]
            self.sizes.pop(at)
        return gap, first, count


def plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Supersteps over the lengths, longest first.

    Rows (length, rank, sequence, per, offset): pieces of ``length`` from ``rank`` on fill the
    sequences from ``sequence`` on, ``per`` in each, the first at ``offset``.
    """
    gaps, rows, opened = Gaps(), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            run = gaps.successor(length)
            if run is None:                        # no gap is large enough: open new sequences
                gap, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            else:
                gap, first, count = run
            per = gap // length
            used = min(count, -(-left // per))
            rows.append((length, rank, first, per, capacity - gap))
            full, rest = divmod(min(left, used * per), per)
            gaps.put(gap - per * length, first, full)
            if rest:
                gaps.put(gap - rest * length, first + full, 1)
            gaps.put(gap, first + used, count - used)
            rank += full * per + rest
            left -= full * per + rest
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "per", "offset"])


def pack(lengths: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Rows need doc_id and piece for a steady order; ties between equal pieces go by them. An empty
    table gives an empty result. Offsets within a sequence are gapless from 0.
    """
    wide = max(2, int(lengths.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["length", "doc_id", "piece"]
    ranged = stored(lengths.repartitionByRange(wide, *order).withColumn("part", F.spark_partition_id()), "ranged")
    # rank within a length = pieces of that length in earlier ranges + rank inside the range
    held = stored(ranged.groupBy("part", "length").count(), "ranged-counts")
    before = held.withColumn("before", F.coalesce(F.sum("count").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # ranges meet only at their borders: at most partitions + capacity rows, whatever the table holds
    before = F.broadcast(before.select("part", "length", "before"))
    inside = F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "piece"))
    ranked = ranged.withColumn("inside", inside - 1).join(before, ["part", "length"])
    ranked = ranked.withColumn("rank", F.col("inside") + F.col("before"))

    # the histogram of lengths has at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    steps = plan(counts, capacity)
    key = steps["length"].to_numpy(np.int64) << 40 | steps["rank"].to_numpy(np.int64)
    by = np.argsort(key)
    key, steps = key[by], steps.iloc[by]
    firsts, pers, offsets = (steps[c].to_numpy(np.int64) for c in ("sequence", "per", "offset"))

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted(key, length << 40 | rank, side="right") - 1
        nth = rank - (key[at] & (1 << 40) - 1)
        return pa.StructArray.from_arrays(
            [pa.array(firsts[at] + nth // pers[at]), pa.array(offsets[at] + nth % pers[at] * length)],
            names=["sequence_id", "offset"])

    placed = ranked.withColumn("placed", place("length", "rank"))
    return placed.select(*lengths.columns, "placed.sequence_id", "placed.offset")


def sequences(pieces_with_ids: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids (its pieces' tokens in order of offset).

    A group holds at most ``capacity`` tokens.
    """
    both = pieces_with_ids.select("doc_id", "piece", "ids").join(
        placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    parts = both.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
