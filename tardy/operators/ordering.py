"""Exact 1-based positions in a total order without gathering the rows in one task.

Rows are counted first. Up to one slice of them is numbered by one window. More are cut into slices by sampled
splitters of the whole order (a range partitioning, written once under the shared scratch folder, so that counts and
numbers see the same slices); a row's position is the number of rows in the slices before its own plus its
number inside its slice. Only the slice counts, one row per slice, meet in one task; a slice holds about
``slice_rows`` rows whatever their values are, also when all of them share the first key of the order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tardy.session import scratch_path

SLICE_ROWS = 500_000


def with_position(df: DataFrame, order: list[Column | str], name: str = "rank", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``name``: the position by ``order``, which must be total. Counts ``df``, and writes it if it is large."""
    cols = list(df.columns)
    slices = -(-df.count() // slice_rows)
    if slices <= 1:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("int"))
    spark = df.sparkSession
    path = scratch_path(spark, f"ranged-{uuid.uuid4().hex}")
    df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    out = ranged.withColumn("_i", inside).join(F.broadcast(offsets), "_slice")       # a row per slice
    return out.select(*cols, (F.col("_off") + F.col("_i")).cast("int").alias(name))
