"""Sliding windows of several sizes on a stream, in one pass: sums, and distinct values, of every size in one row for each window end.

Rows are summed to panes of one slide by Spark. A state for each key then holds the panes of the largest size: where a pane enters the windows
its values are added, where it leaves a size they are taken off, and between these points the sums stand. So the work is that of the panes
and of the result, whatever the ratio of size and slide, and the state is size / slide panes at most, and those that wait.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Context, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.aggregates import exact

#: Decimals are kept as whole numbers of this many places.
PLACES, _EXACT = 15, Context(prec=60)
ROWS = 10_000


class Windows(StatefulProcessor):
    """Panes of a key in, rows of all sizes out, one for each window end that the watermark has passed.

    A value of a set counts while the last pane that held it lies in the window: it is counted where it enters and is not there yet, and taken off
    where its last pane leaves. `last` holds that pane for each value, and forgets it with the largest size.
    """

    def __init__(self, slide: int, sizes: list[int], fractions: list[bool], sets: int, columns: list[str]) -> None:
        self.slide, self.sizes, self.fractions, self.sets, self.columns = slide, sizes, fractions, sets, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "held string")
        self.panes = handle.getMapState("panes", "pane bigint", "held string")
        self.last = handle.getMapState("last", "place int, value string", "pane bigint")

    def _start(self) -> dict:
        found = self.now.get() if self.now.exists() else None
        zeros = [0] * len(self.sizes)
        return json.loads(found[0]) if found else {"until": None, "panes": [], "n": zeros, "s": [list(zeros) for _ in self.fractions], "v": [list(zeros) for _ in range(self.sets)]}

    def _enter(self, now: dict, pane: int, held: dict) -> None:
        for k in range(len(self.sizes)):
            now["n"][k] += held["n"]
            for total, own in zip(now["s"], held["s"], strict=True):
                total[k] += own
        for place, values in enumerate(held["v"]):
            for value in values:
                key = (place, value)
                before = self.last.getValue(key)[0] if self.last.containsKey(key) else None
                for k, size in enumerate(self.sizes):
                    now["v"][place][k] += before is None or before < pane + self.slide - size
                self.last.updateValue(key, (pane,))

    def _leave(self, now: dict, pane: int, held: dict, k: int) -> None:
        now["n"][k] -= held["n"]
        for total, own in zip(now["s"], held["s"], strict=True):
            total[k] -= own
        gone = self.sizes[k] == max(self.sizes)
        for place, values in enumerate(held["v"]):
            for value in values:
                key = (place, value)
                if self.last.containsKey(key) and self.last.getValue(key)[0] == pane:
                    now["v"][place][k] -= 1
                    if gone:
                        self.last.removeKey(key)

    def _row(self, key: tuple, now: dict, end: int) -> tuple:
        sums = [Decimal(v).scaleb(-PLACES, _EXACT) if f else v for f, own in zip(self.fractions, now["s"], strict=True) for v in own]
        return (*key, end, pd.Timestamp(end * 1000 - 1, unit="ms"), *now["n"], *sums, *[v for own in now["v"] for v in own])

    def _advance(self, key: tuple, now: dict, watermark: int) -> Iterator[pd.DataFrame]:
        slide, big = self.slide, self.sizes.index(max(self.sizes))
        closed = watermark // 1000 // slide * slide
        rows: list[tuple] = []
        if now["panes"]:
            until = min(now["panes"]) if now["until"] is None else now["until"]
            # leaves come before entries: a value that leaves where it comes again is counted once
            points = [(p + s + slide, 0, p, k) for p in now["panes"] for k, s in enumerate(self.sizes) if until < p + s + slide <= closed]
            points += [(p + slide, 1, p, 0) for p in now["panes"] if until < p + slide <= closed]
            known: dict[int, dict] = {}
            for at, enters, pane, k in [*sorted(points), (closed + slide, 2, 0, 0)]:
                if now["n"][big]:
                    for end in range(until + slide, at, slide):
                        rows.append(self._row(key, now, end))
                        if len(rows) >= ROWS:
                            yield pd.DataFrame(rows, columns=self.columns)
                            rows = []
                until = max(until, at - slide)
                if enters == 2:
                    break
                if pane not in known:
                    known[pane] = json.loads(self.panes.getValue((pane,))[0])
                if enters:
                    self._enter(now, pane, known[pane])
                else:
                    self._leave(now, pane, known[pane], k)
                    if k == big:
                        self.panes.removeKey((pane,))
                        now["panes"].remove(pane)
                        del known[pane]
            now["until"] = until
        if now["panes"]:
            self.now.update((json.dumps(now),))
            following = now["until"] + slide if now["n"][big] else min(now["panes"]) + slide
            self.handle.registerTimer(max(following, closed + slide) * 1000 - 1)
        else:
            self.now.clear()
        if rows:
            yield pd.DataFrame(rows, columns=self.columns)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = self._start()
        names = ["in_pane", "in_n", *[f"in_s{k}" for k in range(len(self.fractions))], *[f"in_v{k}" for k in range(self.sets)]]
        for part in rows:
            for pane, n, *values in part[names].itertuples(index=False):
                sums, members = values[: len(self.fractions)], values[len(self.fractions) :]
                whole = [int(_EXACT.scaleb(v, PLACES)) if f else int(v) for f, v in zip(self.fractions, sums, strict=True)]
                self.panes.updateValue((int(pane),), (json.dumps({"n": int(n), "s": whole, "v": [list(m) for m in members]}),))
                now["panes"].append(int(pane))
        yield from self._advance(key, now, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._advance(key, self._start(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class SeriesLags(StatefulProcessor):
    """Rows of a key in order of `w_end`, each with what its series were so many rows before (0: nothing yet, or null).

    A series is made of the rows in which its marker is above zero; only rows in which all of them are go out. The last values of a series lie in
    a ring in the state, of which a row touches as many slots as it has lags. Rows of one trigger must be later than those of the one before,
    as closed windows are.
    """

    def __init__(self, series: dict[str, str], lags: list[int], columns: list[str]) -> None:
        self.series, self.lags, self.columns = series, lags, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "series string", "rows bigint")
        self.ring = handle.getMapState("ring", "series string, slot bigint", "value bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        frame = pd.concat(list(rows)).sort_values("w_end")
        size, out, fresh = max(self.lags), frame, None
        for marker, value in self.series.items():
            own = frame[frame[marker] > 0]
            n = self.counts.getValue((marker,))[0] if self.counts.containsKey((marker,)) else 0
            values = own[value].fillna(0).astype("int64").tolist()
            for lag in self.lags:
                # rows before this trigger's come from the ring
                old = [self.ring.getValue((marker, (n + k - lag) % size))[0] if n + k >= lag else 0 for k in range(min(lag, len(values)))]
                out.loc[own.index, f"{value}_{lag}"] = [*old, *values[: max(len(values) - lag, 0)]]
            for k in range(max(len(values) - size, 0), len(values)):
                self.ring.updateValue((marker, (n + k) % size), (values[k],))
            self.counts.updateValue((marker,), (n + len(values),))
            fresh = own.index if fresh is None else fresh.intersection(own.index)
        yield out.loc[fresh, self.columns].sort_values("w_end")

    def close(self) -> None:
        pass


def series_lags(df: DataFrame, keys: list[str], series: dict[str, str], lags: list[int]) -> DataFrame:
    """Windows of a stream (keys, w_end, dt, whole numbers and fractions) with columns <value>_<lag> for each series (marker: value): see `SeriesLags`."""
    more = [f"{v}_{n}" for v in series.values() for n in lags]
    types = dict(df.dtypes) | dict.fromkeys(more, "bigint")
    state = SeriesLags(series, lags, list(types))
    schema = ", ".join(f"`{n}` {t}" for n, t in types.items())
    return df.groupBy(*keys).transformWithStateInPandas(state, schema, "Append", "EventTime", eventTimeColumnName="dt")


def hop(df: DataFrame, keys: list[str], slide: int, sizes: dict[str, int], sums: dict[str, Column], sets: dict[str, Column] | None = None, salt: Column | None = None, salts: int = 1) -> DataFrame:
    """The streaming form of sliding windows of several sizes, for append mode: keys, w_end, dt (its last millisecond, with the watermark), and the
    columns of the batch form. `df` has a watermark on et; the state needs the RocksDB provider.

    A key's panes are worked through in one task. Where a key's distinct values are more than that should hold, `salt` (the column that they
    come from) deals them out so many ways; sums and distinct values of the parts add up. Null keys are a key.
    """
    sets = sets or {}
    own, kinds = exact(df, sums)
    dealt = [*keys, "in_salt"] if salts > 1 else keys
    if salts > 1:
        df = df.withColumn("in_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    fractions = [kinds[n] == "double" for n in sums]
    added = [F.coalesce(F.sum(c), F.lit(0).cast("decimal(38,15)" if f else "long")).alias(f"in_s{k}") for k, (c, f) in enumerate(zip(own.values(), fractions, strict=True))]
    panes = df.groupBy(F.window("et", f"{slide} seconds").alias("w"), *dealt).agg(F.count("*").alias("in_n"), *added, *[F.collect_set(c).alias(f"in_v{k}") for k, c in enumerate(sets.values())])
    panes = panes.select(*dealt, F.unix_seconds("w.start").alias("in_pane"), "in_n", *[f"in_s{k}" for k in range(len(sums))], *[f"in_v{k}" for k in range(len(sets))])
    whole = {f"n_{s}": "bigint" for s in sizes}
    types = whole | {f"{n}_{s}": "decimal(38,15)" if f else "bigint" for n, f in zip(sums, fractions, strict=True) for s in sizes} | {f"{n}_{s}": "bigint" for n in sets for s in sizes}
    kept = dict(panes.dtypes)
    columns = {k: kept[k] for k in dealt} | {"w_end": "bigint", "dt": "timestamp"} | types
    state = Windows(slide, list(sizes.values()), fractions, len(sets), list(columns))
    out = panes.groupBy(*dealt).transformWithStateInPandas(state, ", ".join(f"`{n}` {t}" for n, t in columns.items()), "Append", "EventTime", eventTimeColumnName="dt")
    if salts > 1:
        out = out.groupBy(*keys, "w_end", "dt").agg(*[F.sum(n).alias(n) for n in types])
    back = [F.col(f"{n}_{s}").cast(kinds.get(n, "long")).alias(f"{n}_{s}") for n in ("n", *sums, *sets) for s in sizes]
    return out.select(*keys, "w_end", "dt", *back)
