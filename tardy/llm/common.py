"""Small helpers shared by the operators: shared scratch tables, bounded Arrow batches."""

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.session import scratch_path

ARROW_BATCH_BYTES = 8 << 20
_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows, unless the session's bound is lower.

    Texts may be megabytes long; 10,000 of them in one batch would not fit a worker.
    """
    held = spark.conf.get(_BYTES_CONF).lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(held[-1], 0)
    if int(held.rstrip("kmg")) << unit > ARROW_BATCH_BYTES:
        spark.conf.set(_BYTES_CONF, str(ARROW_BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read; a lost executor costs its running tasks.
    ``tardy.session.clear_scratch`` removes these tables once results are stored.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """Mark the side of a join that grows with the corpus: never broadcast, at any size."""
    return df.hint("merge")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def once_per_worker(key, make):
    """The object that ``make`` gave for ``key`` in this process, made at most once.

    Python workers are reused by many tasks, while functions pickled by value bring new
    module globals with every task; so what is costly to build lives in a module of its own.
    Only for state that any task may share and that is bounded.
    """
    held = sys.modules.setdefault("tardy_worker_state", types.ModuleType("tardy_worker_state")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]
