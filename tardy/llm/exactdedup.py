"""Exact dedup of an incoming batch against an immutable snapshot.

Method: the snapshot's distinct digests are cut into buckets and each bucket gets a static binary
fuse filter. Incoming digests are grouped among themselves first (duplicates inside the batch),
then screened by the filter of their bucket; only positives join the snapshot's exact digest
table, and every group that remains is checked byte for byte before it counts.

Skew: digests are counted with map-side partial aggregation, so a text that fills a third of the
table is one row per task in every shuffle of classes; joins that bring its documents back are
plain equi-joins against one row per class, which adaptive execution splits.
"""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.llm import fusefilter
from tardy.llm.common import by_shuffle, stored, text_or_empty

KEYS_PER_BUCKET = 50_000      # distinct digests per filter: bounds the memory of one group

FILTER_SCHEMA = "bucket long, seed int, n long, cells binary"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) with the SHA-256 of the whole text; a null text counts as empty."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest"))


def classes_of(digest_rows: DataFrame) -> DataFrame:
    """One row per digest: number of documents and the largest doc_id."""
    return digest_rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"))


def _bucketed(classes: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64("digest")
    return classes.withColumn("key", key).withColumn("bucket", F.pmod(F.shiftright(key, 20), F.lit(buckets)))


def build_filters(classes: DataFrame, buckets: int) -> DataFrame:
    """One binary fuse filter per bucket of an immutable snapshot's digest classes."""
    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        seed, n, cells = fusefilter.build(pdf["key"].to_numpy())
        return pd.DataFrame({"bucket": [key[0]], "seed": [seed], "n": [n], "cells": [cells]})

    return _bucketed(classes, buckets).select("bucket", "key").groupBy("bucket").applyInPandas(one, FILTER_SCHEMA)


def screen(classes: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Add ``hit``: may the snapshot hold this digest? Never false for one that it holds.

    Ids pass the workers as text: a null beside 64-bit numbers would turn them all into doubles there.
    """
    def one(key: tuple, rows: pd.DataFrame, filt: pd.DataFrame) -> pd.DataFrame:
        out = rows[["digest", "n", "keep_id"]].copy()
        out["hit"] = False
        if len(filt) and len(rows):
            f = filt.iloc[0]
            out["hit"] = fusefilter.contains(int(f["seed"]), int(f["n"]), f["cells"], rows["key"].to_numpy())
        return out

    id_type = classes.schema["keep_id"].dataType
    sent = _bucketed(classes.withColumn("keep_id", F.col("keep_id").cast("string")), buckets)
    screened = sent.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(
        one, "digest binary, n long, keep_id string, hit boolean")
    return screened.withColumn("keep_id", F.col("keep_id").cast(id_type))


def merged_classes(old: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """Classes of snapshot and batch together; only screened positives meet the snapshot table."""
    screened = stored(screen(new, build_filters(old, buckets), buckets), "screened")
    positive = screened.filter("hit").select("digest", F.col("n").alias("n_new"), F.col("keep_id").alias("keep_new"))
    met = old.join(by_shuffle(positive), "digest", "left").select(
        "digest", (F.col("n") + F.coalesce("n_new", F.lit(0))).alias("n"),
        F.greatest("keep_id", "keep_new").alias("keep_id"))
    false_alarm = screened.filter("hit").join(by_shuffle(old.select("digest")), "digest", "left_anti")
    cols = ["digest", "n", "keep_id"]
    return met.unionByName(screened.filter("not hit").select(cols)).unionByName(false_alarm.select(cols))


def exact_dedup(snapshot: DataFrame, incoming: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document of both inputs: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when their bytes are; of equal texts the one with the largest doc_id stays.
    Null text counts as empty. A null doc_id never beats another id; a group of nothing but null
    ids has a null keep_id and is kept whole. Rows that repeat an id and its text share one fate.
    Only the id and text columns are read, so other columns may have any name. An empty snapshot
    or batch is fine.
    """
    docs = [d.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
            for d in (snapshot, incoming)]
    both = docs[0].unionByName(docs[1])
    rows = stored(digests(docs[0]).withColumn("fresh", F.lit(False))
                  .unionByName(digests(docs[1]).withColumn("fresh", F.lit(True))), "digests")
    old, new = (classes_of(rows.filter(c)) for c in ("not fresh", "fresh"))
    buckets = max(1, -(-rows.count() // KEYS_PER_BUCKET))
    classes = merged_classes(old, new, buckets)
    dup = stored(classes.filter("n > 1"), "dup-classes")

    single = rows.join(by_shuffle(dup.select("digest")), "digest", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")

    # byte check: every document of a group against the group's representative text
    candidates = stored(both.withColumn("digest", F.unhex(F.sha2("text", 256)))
                        .join(by_shuffle(dup.select("digest")), "digest", "left_semi"), "candidates")
    keeper = dup.select(F.col("digest").alias("k_digest"), "keep_id")
    chosen = candidates.join(by_shuffle(keeper), (F.col("digest") == F.col("k_digest"))
                             & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # one row per group is written before it is joined back: a join of two plain tables can be split
    lead = stored(chosen.groupBy("digest").agg(F.max("text").alias("lead_text")), "leads")
    # a text that differs from the lead (two texts, one digest) is grouped by its own bytes
    checked = candidates.join(by_shuffle(lead), "digest").select(
        "doc_id", "digest", F.when(F.col("text") != F.col("lead_text"), F.col("text")).alias("other"))
    checked = stored(checked, "checked")
    groups = checked.groupBy("digest", "other").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
    g = stored(groups, "groups").select(F.col("digest").alias("g_digest"), F.col("other").alias("g_other"), "group_size", "keep_id")
    several = checked.join(by_shuffle(g), (F.col("digest") == F.col("g_digest")) & F.col("other").eqNullSafe(F.col("g_other"))
                           ).select("doc_id", "keep_id", "group_size", "digest")
    return single.unionByName(several).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def split_by_age(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(snapshot, incoming): the older and the newer half of the id range.

    Every row is in exactly one of them; rows without an id count as incoming.
    """
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    middle = ((low or 0) + (high or 0)) // 2
    old = F.coalesce(F.col(id_col) <= F.lit(middle), F.lit(False))
    return docs.filter(old), docs.filter(~old)
