"""Declarative data-quality tests (H1-H5).

Each test returns its failing rows or values; an empty result is a pass. Nulls are ignored by
``unique``, ``accepted_values`` and ``relationships`` (they are what ``not_null`` is for).

``quality_report`` runs a list of declared tests and returns one row per test with its failure
count. Column-level checks of one model (not_null, accepted_values) share one aggregate pass;
uniqueness is one partially-aggregated groupBy per column; relationships are one anti join.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.schemas import ACCEPTED_CANCELED, ACCEPTED_OCCUPANCY


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """H1: values seen more than once, with their count."""
    return (df.filter(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    """H2: rows where the column is null."""
    return df.filter(F.col(column).isNull())


def dq_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """H3: values outside the accepted list, grouped with their count."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def dq_relationships(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (anti join).

    The parent side is reduced to its distinct keys first (map-side combine), so a dimension with
    repeated keys does not grow the join input; AQE broadcasts it when its runtime size is small.
    """
    keys = parent.select(F.col(field_name).alias("_parent_key")).distinct()
    return (child.filter(F.col(column).isNotNull())
                 .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


@dataclass(frozen=True)
class Test:
    kind: str                      # unique | not_null | accepted_values | relationships
    model: str
    column: str
    values: tuple = ()
    to: str | None = None          # parent model for relationships
    to_field: str | None = None

    @property
    def name(self) -> str:
        """The conventional generic-test name: kind, model, column, then the arguments."""
        base = f"{self.kind}_{self.model}_{self.column}"
        if self.kind == "accepted_values":
            return base + "".join(f"__{_slug(v)}" for v in self.values)
        if self.kind == "relationships":
            return f"{base}__{_slug(self.to_field)}__{_slug(f'ref({self.to!r})')}"
        return base


def _slug(v) -> str:
    return re.sub(r"[^0-9A-Za-z_]+", "_", str(v))


# The 16 declared tests of the star schema.
DECLARED_TESTS: list[Test] = [
    Test("unique", "stg_departures", "departure_key"),
    Test("not_null", "stg_departures", "departure_key"),
    Test("not_null", "stg_departures", "station_id"),
    Test("not_null", "stg_departures", "vehicle_id"),
    Test("accepted_values", "stg_departures", "is_canceled", tuple(ACCEPTED_CANCELED)),
    Test("accepted_values", "stg_departures", "occupancy", tuple(ACCEPTED_OCCUPANCY)),
    Test("unique", "dim_stations", "station_id"),
    Test("not_null", "dim_stations", "station_id"),
    Test("unique", "dim_time", "hour_of_day"),
    Test("not_null", "dim_time", "hour_of_day"),
    Test("unique", "fct_delays", "departure_key"),
    Test("not_null", "fct_delays", "departure_key"),
    Test("not_null", "fct_delays", "station_id"),
    Test("relationships", "fct_delays", "station_id", to="dim_stations", to_field="station_id"),
    Test("not_null", "mart_delay_summary", "total_departures"),
    Test("not_null", "mart_delay_summary", "delay_rate_pct"),
]


@dataclass
class _Acc:
    exprs: list = field(default_factory=list)
    names: list = field(default_factory=list)


def quality_report(models: dict[str, DataFrame], tests: list[Test] = DECLARED_TESTS) -> DataFrame:
    """H5: (test_name, model, column_name, failures) for every test, in one DataFrame."""
    per_model: dict[str, _Acc] = {}
    grouped: list[DataFrame] = []
    for t in tests:
        c = F.col(t.column)
        if t.kind == "not_null":
            acc = per_model.setdefault(t.model, _Acc())
            acc.exprs.append(F.count_if(c.isNull()).alias(f"_{len(acc.names)}"))
            acc.names.append(t)
        elif t.kind == "accepted_values":
            acc = per_model.setdefault(t.model, _Acc())
            bad = F.when(c.isNotNull() & ~c.isin(list(t.values)), c)
            acc.exprs.append(F.count_distinct(bad).alias(f"_{len(acc.names)}"))
            acc.names.append(t)
        elif t.kind == "unique":
            fails = dq_unique(models[t.model], t.column).agg(F.count(F.lit(1)).alias("failures"))
            grouped.append(_label(fails, t))
        elif t.kind == "relationships":
            fails = dq_relationships(models[t.model], t.column, models[t.to], t.to_field) \
                .agg(F.count(F.lit(1)).alias("failures"))
            grouped.append(_label(fails, t))
        else:
            raise ValueError(f"unknown test kind {t.kind}")
    parts = list(grouped)
    for model, acc in per_model.items():
        row = models[model].agg(*acc.exprs)
        # one aggregate row per model -> one output row per test (a generator, not a join)
        cells = F.array(*[F.struct(F.lit(t.name).alias("test_name"), F.lit(t.model).alias("model"),
                                   F.lit(t.column).alias("column_name"),
                                   F.col(f"_{i}").cast("long").alias("failures"))
                          for i, t in enumerate(acc.names)])
        parts.append(row.select(F.explode(cells).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _label(fails: DataFrame, t: Test) -> DataFrame:
    return fails.select(F.lit(t.name).alias("test_name"), F.lit(t.model).alias("model"),
                        F.lit(t.column).alias("column_name"), F.col("failures").cast("long"))


def assert_passed(report: DataFrame) -> None:
    """Raise when any test has failures (collects at most one row per test)."""
    failed = [r for r in report.filter(F.col("failures") > 0).collect()]
    if failed:
        detail = ", ".join(f"{r.test_name}={r.failures}" for r in failed)
        raise AssertionError(f"data tests failed: {detail}")
