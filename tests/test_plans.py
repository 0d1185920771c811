"""Plan guards: hot keys are reduced before their shuffle (the sweep in test_reports checks that
no registered query plans a cartesian product)."""

from tardy.operators import clean as C
from tardy.operators import models as M
from tardy.operators import quality as Q
from tardy.sources import fixtures as X

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_exchange(plan: str) -> bool:
    # in the tree string a child is printed below its parent: a partial aggregate must appear
    # after (below) the first hash exchange
    ex = plan.find("Exchange hashpartitioning")
    return ex >= 0 and "HashAggregate(" in plan[ex:]


def test_hot_keys_are_partially_aggregated_before_shuffling(spark):
    raw = X.raw_departures(spark, SF_SMALL)
    star = M.StarSchema(spark, C.clean_departures(raw))
    assert _partial_before_exchange(_plan(M.mart_delay_summary(star.fct, star.dim_stations, star.dim_time)))
    assert _partial_before_exchange(_plan(Q.dq_unique(star.stg, "station_id")))
    assert _partial_before_exchange(_plan(C.clean_stats(raw)))
    assert _partial_before_exchange(_plan(star.dim_stations))
