"""Line dedup on content-defined chunks of lines, in DataFrame functions only.

Method: a rolling hash over the hashes of the last ``ROLL`` lines decides where a chunk ends, so
boundaries depend on nearby lines only and survive insertions before them. Chunks of two or more
lines with words that occur more than once in the corpus are compared byte for byte; the first
copy (smallest doc_id, then position) stays and every other copy is removed.

Skew: chunk hashes are counted with map-side partial aggregation (a chunk that is everywhere is
one row per task); the joins that bring chunks to their group's first copy are equi-joins against
one row per hash, which adaptive execution splits.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.llm.common import by_shuffle, stored, text_or_empty

ROLL = 3                          # lines under the rolling hash
SPREAD = 4                        # one line in so many ends a chunk
FACTOR = 31                       # weight of the line before


def line_hash(line: Column) -> Column:
    """28 bits of the line's MD5, as a number that other engines can compute too."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def with_chunks(docs: DataFrame) -> DataFrame:
    """Add ``chunks``: array of (k, n_lines, n_full, chunk) to rows with a ``text``.

    n_full counts lines that are not blank. Every array an inner function looks into is a column
    of its own that is used more than once, so it is computed once per row.
    """
    lines = docs.withColumn("lines", F.split("text", "\n", -1))
    hashed = lines.withColumn("hashes", F.transform("lines", line_hash))

    def ends(i: Column) -> Column:
        rolled = F.lit(0).cast("long")
        for back in range(ROLL):
            rolled = rolled + F.coalesce(F.get("hashes", i - back), F.lit(0)) * F.lit(FACTOR**back)
        return rolled % SPREAD == 0

    starts = F.filter(F.transform("hashes", lambda _, i: F.when((i == 0) | ends(i - 1), i)), lambda i: i.isNotNull())
    cut = hashed.withColumn("starts", F.when(F.size("hashes") > 0, starts))

    def chunk(start: Column, k: Column) -> Column:
        n = F.coalesce(F.get("starts", k + 1), F.size("lines")) - start
        part = F.slice("lines", start + 1, n)
        full = F.size(F.filter(part, lambda line: F.trim(line) != ""))
        return F.struct(k.alias("k"), n.alias("n_lines"), full.alias("n_full"), F.array_join(part, "\n").alias("chunk"))

    chunks = F.when(F.size("lines") > 0, F.transform("starts", chunk))
    return cut.withColumn("chunks", chunks).drop("lines", "hashes", "starts")


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """(doc_id, th, k) of every chunk that is a later copy of another chunk.

    ``rows`` has doc_id, th (hash of the text; rows with equal keys are one document) and chunks.
    """
    # the outer form: a plain one infers a filter that would repeat the whole chunking per element
    every = rows.select("doc_id", "th", F.inline_outer("chunks")).filter("n_full >= 2")
    every = every.select(F.xxhash64("chunk").alias("key"), F.struct("doc_id", "th", "k").alias("place"), "chunk")
    groups = every.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    groups = stored(groups.filter("n > 1"), "chunk-groups")
    copies = stored(every.join(by_shuffle(groups.select("key")), "key", "left_semi"), "chunk-copies")

    # byte check against the group's first copy; a chunk that differs is grouped by its own bytes
    first = groups.select(F.col("key").alias("f_key"), "first")
    lead = copies.join(by_shuffle(first), (F.col("key") == F.col("f_key")) & F.col("place").eqNullSafe(F.col("first")))
    # one row per group is written before it is joined back: a join of two plain tables can be split
    lead = stored(lead.groupBy("key").agg(F.max("chunk").alias("lead_chunk")), "chunk-leads")
    checked = copies.join(by_shuffle(lead), "key").select(
        "key", "place", F.when(F.col("chunk") != F.col("lead_chunk"), F.col("chunk")).alias("other"))
    checked = stored(checked, "chunk-checked")
    exact = checked.groupBy("key", "other").agg(F.min("place").alias("first"))
    exact = stored(exact, "chunk-exact").select(F.col("key").alias("g_key"), F.col("other").alias("g_other"), "first")
    later = checked.join(by_shuffle(exact), (F.col("key") == F.col("g_key")) & F.col("other").eqNullSafe(F.col("g_other")))
    return later.filter(~F.col("place").eqNullSafe(F.col("first"))).select("place.*")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed (lines), kept_text.

    Null text counts as empty (one empty line). Rows that repeat id and text are one document and
    keep or lose the same chunks; a null doc_id sorts first. Chunks with fewer than two lines that
    hold more than spaces are never removed. Only the id and text columns are read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = with_chunks(rows.withColumn("th", F.xxhash64("text"))).drop("text")
    gone = repeated_chunks(rows).groupBy("doc_id", "th").agg(F.collect_set("k").alias("gone"))
    gone = gone.withColumnRenamed("doc_id", "d").withColumnRenamed("th", "t")
    met = rows.join(by_shuffle(gone), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    lost = F.coalesce("gone", F.array().cast("array<int>"))
    marked = met.select("doc_id", "chunks", lost.alias("gone"))
    total = F.aggregate("chunks", F.lit(0).cast("long"), lambda n, c: n + c["n_lines"])
    kept = marked.select("doc_id", total.alias("n_lines"), F.when(F.size("gone") == 0, F.col("chunks")).otherwise(
        F.filter("chunks", lambda c: ~F.array_contains("gone", c["k"]))).alias("kept"))
    left = F.aggregate("kept", F.lit(0).cast("long"), lambda n, c: n + c["n_lines"])
    return kept.select("doc_id", "n_lines", (F.col("n_lines") - left).alias("n_removed"),
                       F.array_join(F.transform("kept", lambda c: c["chunk"]), "\n").alias("kept_text"))
