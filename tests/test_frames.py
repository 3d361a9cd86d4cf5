"""Counts of trailing days in one pass: against the definition for every chunk size, and against the running sums of `trailing`."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import frames, over

DAY = frames.DAY


def _applications(n, seed=3):
    draw = random.Random(seed)
    pick = lambda *of: draw.choice([None, *of])
    # few seconds, so that rows share them; on the edges of the horizons; before 1970; without a time
    when = [None, -1, 0, *[k * DAY + d for k in range(-9, 30) for d in (-1, 0, 1)]]
    return [(f"app{k % 370}", pick("1", "2", "3"), pick("m", "n"), pick("c"), pick("x", "y"), pick("1", "2", "9"), pick("m", "9"), draw.choice(when)) for k in range(n)]


def _plain(rows, days):
    """The eight counts of each row, read off the definition."""
    found = []
    for r in rows:
        out = []
        for d in days:
            near = [x for x in rows if r[7] is not None and x[7] is not None and r[7] - d * DAY <= x[7] <= r[7]]
            same = lambda *at: [x for x in near if all(x[i] == r[i] for i in at)]
            named = lambda me, other: sum(r[me] is not None and x[other] == r[me] for x in near)
            values = lambda i: len({x[i] for x in same(1) if x[i] is not None})
            out += [len(same(1)), named(1, 5), named(2, 6), len(same(1)) - len(same(1, 2)) + len(same(2)), values(5), values(6), len(same(3)), len(same(4))]
        found.append((r[0], r[1], *out))
    return sorted(found, key=str)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "APP_NO string, CERT_NO string, MOBILE_NUM string, COMP_NAME string, STANDARD_ADDR string, SPOUSE_CERT_NO string, SPOUSE_MOBILE_NO string, t long").withColumn("et", F.timestamp_seconds("t"))


@pytest.mark.parametrize("days", [(1, 3, 7), (7,)])
def test_features_equal_the_definition(spark, days):
    rows = _applications(700)
    got = over.velocity_features(_frame(spark, rows), days, drop_null_keys=False)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _plain(rows, days)
    whole = [r for r in rows if None not in r[1:5]]
    got = over.velocity_features(_frame(spark, rows), days)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _plain(whole, days)


@pytest.mark.parametrize("chunk", [1, 2, 7, 100, 10**6])
def test_frames_go_on_from_chunk_to_chunk(chunk):
    draw = random.Random(chunk)
    span, longest, rows = 14 * DAY, 7 * DAY, []
    for key in (("0", "a"), ("0", "b"), ("1", None)):
        for bucket in (None, -1, 0):
            for _ in range(60):
                es = None if bucket is None else bucket * span + draw.choice([-longest, -1, 0, 1, DAY, 2 * DAY, 7 * DAY, 13 * DAY, 13 * DAY + 1])
                own = draw.choice([0, 1, 1])
                rows.append((int(key[0]), key[1], None, bucket, es, own, len(rows) if own and (es is None or es >= bucket * span) else None, draw.choice([None, "p", "q"]), draw.choice([None, "r"])))
    order = lambda r: (r[0], r[1] or "", r[3] is not None, r[3] or 0, r[4] or 0)
    rows.sort(key=order)
    names, types = ("kind", "a", "b", "bucket", "es", "own", "row", "couple", "couple_mobile"), (pa.int8(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))
    run = frames.counting([1, 7], span, ["row"], [f"{h}{n}" for h in "ab" for n in "nmcd"], chunk)
    got = {r.pop("row"): tuple(r.values()) for b in run(iter([batch.slice(k, 9) for k in range(0, len(rows), 9)])) for r in b.to_pylist()}
    want = {}
    for r in rows:
        if r[6] is not None:
            want[r[6]] = ()
            for h in (DAY, 7 * DAY):
                near = [x for x in rows if x[:2] == r[:2] and x[3] == r[3] and r[4] is not None and r[4] - h <= x[4] <= r[4]]
                want[r[6]] += (sum(x[5] for x in near), sum(1 - x[5] for x in near), len({x[7] for x in near} - {None}), len({x[8] for x in near} - {None}))
    assert got == want


def test_what_a_key_leaves_behind_is_bounded_by_its_seconds():
    held = frames.Frames([7], 14 * DAY)
    n = 5_000
    for at in range(0, 20):
        cols = {"kind": [0] * n, "a": ["k"] * n, "b": [None] * n, "bucket": [0] * n, "es": [at] * n, "own": [1] * n, "row": list(range(n)), "couple": [f"v{k % 3}" for k in range(n)], "couple_mobile": [None] * n}
        batch = pa.RecordBatch.from_pydict(cols, pa.schema({"kind": pa.int8(), "a": pa.string(), "b": pa.string(), "bucket": pa.int64(), "es": pa.int64(), "own": pa.int32(), "row": pa.int64(), "couple": pa.string(), "couple_mobile": pa.string()}))
        _, counts = held.count(batch, held.places(batch))
        assert set(counts[0].tolist()) == {n * (at + 1)} and set(counts[2].tolist()) == {3}
    assert len(held.at) == 20 and len(held.values[0][0]) == 3


def test_rows_are_dealt_once_and_tasks_grow_with_them(spark, monkeypatch):
    df = _frame(spark, _applications(400))
    plan = over.velocity_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") <= 4
    few = over.velocity_features(df).rdd.getNumPartitions()
    monkeypatch.setattr(over, "TASK_ROWS", 60)
    assert over.velocity_features(df, drop_null_keys=False).rdd.getNumPartitions() == -(-7 * 3 * 400 // 120) > few
