"""Tables that are published whole: new folders first, then one pointer (A5, K2).

Layout of a root: ``data/<table>/w=<build>/[departure_date=.../]part-*`` and ``_versions/<n>.json``. A build
writes its tables into folders of its own and reads them back from there; nothing that is published is
touched. ``publish`` then writes the next pointer, a small file that names the folder of every table (of every
date, for tables by date), by a rename: readers see the version before it or all of the new one, whatever
happens to the build. A date that a build did not touch keeps its folder, so an incremental build
writes its own dates only and is atomic all the same. Of two builds that end at once, one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DATE = "departure_date"


class StaleBuildError(RuntimeError):
    """Another build has published since this one began."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions of a root, oldest first."""
    return [int(n[:-5]) for n in _names(spark, f"{root}/_versions") if n.endswith(".json") and n[:-5].isdigit()]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """What a version (default: the newest) holds: table -> schema and folders; None where there is none."""
    held = versions(spark, root)
    if not held or (version is not None and version not in held):
        return None
    path = f"{root}/_versions/{held[-1] if version is None else version:012d}.json"
    return json.loads(spark.read.option("wholetext", True).text(path).first()[0])


def _frame(spark: SparkSession, root: str, name: str, table: dict) -> DataFrame:
    schema = StructType.fromJson(table["schema"])
    columns = schema.fieldNames()
    base = f"{root}/data/{name}"
    if not table["parts"]:
        return spark.createDataFrame([], schema)
    if DATE not in table["by"]:
        return spark.read.schema(schema).parquet(f"{base}/w={table['parts']['']}")
    paths = [f"{base}/w={w}/{DATE}={d}" for d, w in sorted(table["parts"].items())]
    rows = spark.read.schema(schema.add("w", "string")).option("basePath", base).parquet(*paths)
    return rows.select(*columns)


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A published table. A frame keeps reading the version it was made from."""
    held = manifest(spark, root, version)
    if held is None or name not in held:
        raise FileNotFoundError(f"{root} has no published table {name}")
    return _frame(spark, root, name, held[name])


class Build:
    """One build over a root: ``write`` tables, then ``publish`` them together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        held = versions(spark, root)
        self.after = held[-1] if held else 0
        self.tables: dict[str, dict] = (manifest(spark, root) or {}) if held else {}

    def write(self, name: str, df: DataFrame, by_date: bool = False, touched: list[str] | None = None,
              order: tuple[str, ...] = (), max_records: int = 0) -> DataFrame:
        """Write a table into a folder of this build and read it back.

        ``touched`` (dates as text; tables by date) keeps the folders of all other dates; a touched date
        without rows is gone from the new version. ``order`` clusters the rows inside files.
        """
        w = f"b{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/data/{name}/w={w}"
        out = df.hint("rebalance", DATE) if by_date else df
        if cols := [c for c in ((DATE, *order) if by_date else order) if c in df.columns]:
            out = out.sortWithinPartitions(*cols)
        writer = out.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", max_records)
        (writer.partitionBy(DATE) if by_date else writer).parquet(path)
        parts = {"": w}
        if by_date:
            new = {n[len(DATE) + 1:]: w for n in _names(self.spark, path) if n.startswith(f"{DATE}=")}
            old = self.tables.get(name, {}).get("parts", {}) if touched is not None else {}
            parts = {d: x for d, x in old.items() if d not in set(touched or ())} | new
        self.tables[name] = {"schema": json.loads(df.schema.json()), "by": [DATE] if by_date else [], "parts": parts}
        return _frame(self.spark, self.root, name, self.tables[name])

    def publish(self) -> int:
        """Make the tables written so far, and those kept from before, the newest version."""
        number = self.after + 1
        fs, target = _fs(self.spark, f"{self.root}/_versions/{number:012d}.json")
        draft = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_versions/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(self.tables).encode()))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise StaleBuildError(f"{self.root}: version {number} was published by another build")
        self.after = number
        return number


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove versions but the newest ``keep`` and the folders that no kept version names; returns how many
    folders went. Not while a build is at work: what it has written is not named yet."""
    held = versions(spark, root)
    live = {(name, w) for v in held[-keep:] for name, t in manifest(spark, root, v).items() for w in t["parts"].values()}
    for v in held[:-keep]:
        fs, p = _fs(spark, f"{root}/_versions/{v:012d}.json")
        fs.delete(p, False)
    gone = 0
    for name in _names(spark, f"{root}/data"):
        for folder in _names(spark, f"{root}/data/{name}"):
            if (name, folder[2:]) not in live:
                fs, p = _fs(spark, f"{root}/data/{name}/{folder}")
                fs.delete(p, True)
                gone += 1
    return gone
