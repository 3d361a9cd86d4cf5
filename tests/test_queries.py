"""Every registered query over the events table equals its SQL."""

import duckdb
import pytest

from tidewatch.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF}/events.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, oracle, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = oracle.execute(registry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want)
    for c in columns:
        if got[c].dtype.kind == "f":
            assert ((got[c] - want[c]).abs().fillna(0) < 1e-9).all(), c
        else:
            assert (got[c].astype(str) == want[c].astype(str)).all(), c


def test_sliding_windows_are_registered_with_the_slide_of_the_reference(spark):
    sliding = [n for n in registry.queries() if any(w in n for w in ("hop", "monitor", "lag_previous", "lag_day", "period_over", "two_stream"))]
    assert {n + "_10s" for n in sliding if not n.endswith("_10s")} == {n for n in sliding if n.endswith("_10s")} and len(sliding) == 36
    rows = registry.queries()["multi_hop_10s"](spark, SF).where("BUSINESS_TYPE_CD = 'P3'").collect()
    ends = {r.w_end: r.n_6H for r in rows}
    assert all(e % 10 == 0 for e in ends) and all(e + 10 in ends or n == 1 for e, n in ends.items())
