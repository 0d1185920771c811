"""The pipeline stage by stage against plain Python, and the SQL statements at a small size."""

import os

import brute
import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from tardy.llm import queries
from tardy.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.dtypes
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        if name == "language_id":
            kept = {i: t for i, t in kept.items() if any(c.isalpha() for c in t or "")}
        elif name == "exact_dedup":
            last = {}
            for i in sorted(kept):
                last[kept[i]] = i
            kept = {i: kept[i] for i in last.values()}
        elif name == "near_dedup":
            kept = {i: kept[i] for i, low in brute.near_components(kept).items() if i == low}
        elif name == "substring_dedup":
            ids = sorted(kept)
            left = dict(zip(ids, brute.without_repeats([kept[i] for i in ids]), strict=True))
            kept = {i: kept[i] if len(left[i]) == len(brute.words(kept[i])) else " ".join(left[i])
                    for i in ids if left[i]}
        else:
            brute.check_packing(docs.collect(), kept, 1024)
            continue
        assert docs.dtypes == columns
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == kept, name
    assert len(kept) > 100


def test_pipeline_on_nulls_and_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(3).selectExpr(*[f"cast(null as {kind}) as {c}" for c, kind in docs.dtypes])
    for table in (docs.limit(0), docs.filter("doc_id < 20").unionByName(odd)):
        for _, stage in corpus_pipeline.STAGES:
            table = stored(stage(spark, table, SF), "test-odd")
        assert table.count() >= 0


def test_one_copy_of_every_text_reaches_the_end(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 40 and length(text) > 400").cache()
    columns = docs.columns
    twice = docs.filter("doc_id % 4 = 0")                                   # rows that repeat an id and its text
    nameless = docs.filter("doc_id % 4 = 1").withColumn("doc_id", F.lit(None).cast("long"))
    table = docs.filter("doc_id % 4 <> 1")
    for more in (twice, nameless, nameless):
        table = table.unionByName(more.select(columns))
    want = {r["text"] for r in table.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        table = stored(stage(spark, table, SF), f"test-one-{name}")
        if name == "exact_dedup":
            texts = [r["text"] for r in table.collect()]
            assert len(texts) == len(set(texts)) and set(texts) == want
    kept = [r["text"] for r in table.collect()]
    assert len(kept) == len(set(kept)) and len(kept) >= len(want) - 5       # near copies among the few


def test_language_stage_keeps_mixed_text_and_needs_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    some = {r["lang"]: r["text"] for r in docs.filter("length(text) > 1500 and lang is not null").collect()}
    assert len(some) >= 4
    mixed = spark.createDataFrame([(-1, " ".join(t[:600] for t in some.values())), (-2, "12 + 3 = 15!")],
                                  "doc_id long, text string")
    table = docs.unionByName(mixed, allowMissingColumns=True)
    kept = corpus_pipeline.identify_languages(spark, table, SF).filter("doc_id < 0").collect()
    assert [r["doc_id"] for r in kept] == [-1]
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="language_id"):
        corpus_pipeline.identify_languages(spark, unlabelled, SF)
    assert corpus_pipeline.identify_languages(spark, unlabelled.filter("text is null or text = ''"), SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{os.path.join(SF, t)}.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = [sorted(map(repr, f[cols].astype(object).where(f[cols].notna(), None).values.tolist())) for f in (got, want)]
    assert rows[0] == rows[1]
