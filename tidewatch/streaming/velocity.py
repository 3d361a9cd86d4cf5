"""Relationship features of applications on a stream.

An application goes to each of its keys (identity, phone, both, employer, address) and to the contacts that it names. A state for each key holds
running counts of every horizon: an application enters them at its second and leaves where each horizon ends, so nothing is counted twice. What has entered
is kept by hour, and a trigger reads the hours that it adds to or takes from. The answers of an application's keys are gathered to one row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.over import DAY, entries, features, gathered, horizon_names

HOUR = 3600
#: Columns of an application that tell its row from others, and that its keys are made of.
WHO = ["APP_NO", "CERT_NO", "MOBILE_NUM", "COMP_NAME", "STANDARD_ADDR"]


class TrailingCounts(StatefulProcessor):
    """For each row of a key that asks, once the watermark has passed its second: rows, rows naming the key, and distinct values of two columns, by horizon."""

    def __init__(self, days: list[int], columns: list[str]) -> None:
        self.spans, self.columns = [d * DAY for d in days], columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "held string")
        self.waiting = handle.getMapState("waiting", "hour bigint", "held string")
        self.entered = handle.getMapState("entered", "hour bigint", "held string")
        self.last = handle.getMapState("last", "place int, value string", "second bigint")

    def _start(self) -> dict:
        if self.now.exists():
            return json.loads(self.now.get()[0])
        zeros = [0] * len(self.spans)
        # counts: rows, rows naming the key, distinct values of the first and of the second column; cursor: what is older has left
        return {"counts": [list(zeros) for _ in range(4)], "cursor": [-(1 << 50)] * len(self.spans), "waits": [], "held": []}

    def _hour(self, state, hour: int, empty):
        return json.loads(state.getValue((hour,))[0]) if state.containsKey((hour,)) else empty

    def _leave(self, now: dict, second: int) -> None:
        """Take off what no horizon that ends at this second holds any more."""
        longest = max(self.spans)
        for k, span in enumerate(self.spans):
            until = second - span
            for hour in [h for h in now["held"] if now["cursor"][k] // HOUR <= h <= (until - 1) // HOUR]:
                for at, (own, named, *values) in sorted((int(a), v) for a, v in self._hour(self.entered, hour, {}).items()):
                    if now["cursor"][k] <= at < until:
                        now["counts"][0][k] -= own
                        now["counts"][1][k] -= named
                        for place, held in enumerate(values):
                            for value in held:
                                key = (place, value)
                                if self.last.containsKey(key) and self.last.getValue(key)[0] == at:
                                    now["counts"][2 + place][k] -= 1
                                    if span == longest:
                                        self.last.removeKey(key)
                if span == longest and (hour + 1) * HOUR <= until:
                    self.entered.removeKey((hour,))
                    now["held"].remove(hour)
            now["cursor"][k] = max(now["cursor"][k], until)

    def _enter(self, now: dict, second: int, rows: list[list]) -> None:
        own = sum(r[1] for r in rows)
        values = [sorted({r[2 + place] for r in rows if r[2 + place] is not None}) for place in range(2)]
        hour = second // HOUR
        held = self._hour(self.entered, hour, {})
        held[str(second)] = [own, len(rows) - own, *values]
        self.entered.updateValue((hour,), (json.dumps(held),))
        if hour not in now["held"]:
            now["held"].append(hour)
        for k in range(len(self.spans)):
            now["counts"][0][k] += own
            now["counts"][1][k] += len(rows) - own
        for place, some in enumerate(values):
            for value in some:
                key = (place, value)
                before = self.last.getValue(key)[0] if self.last.containsKey(key) else None
                for k, span in enumerate(self.spans):
                    now["counts"][2 + place][k] += before is None or before < second - span
                self.last.updateValue(key, (second,))

    def _emit(self, now: dict, watermark: int) -> Iterator[pd.DataFrame]:
        passed, ready = watermark // 1000, []
        for hour in [h for h in now["waits"] if h <= passed // HOUR]:
            rows = self._hour(self.waiting, hour, [])
            ready += [r for r in rows if r[0] <= passed]
            later = [r for r in rows if r[0] > passed]
            if later:
                self.waiting.updateValue((hour,), (json.dumps(later),))
            else:
                self.waiting.removeKey((hour,))
                now["waits"].remove(hour)
        out = []
        for second, rows in groupby(sorted(ready, key=lambda r: r[0]), key=lambda r: r[0]):
            rows = list(rows)
            self._leave(now, second)
            self._enter(now, second, rows)
            counts = [c for own in now["counts"] for c in own]
            out += [(r[4], r[5], pd.Timestamp(second, unit="s"), *counts) for r in rows if r[1]]
        if not ready and now["held"]:
            self._leave(now, passed)
        if now["waits"] or now["held"]:
            self.now.update((json.dumps(now),))
            if now["waits"]:
                first = min(self._hour(self.waiting, min(now["waits"]), []))[0]
                self.handle.registerTimer(first * 1000 - 1)
            if now["held"]:  # and what no later row takes off goes by itself
                self.handle.registerTimer(max((max(now["held"]) + 1) * HOUR + max(self.spans), passed + 1) * 1000 + 1)
        else:
            self.now.clear()
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, new = self._start(), []
        text = lambda x: None if pd.isna(x) else str(x)
        for part in rows:
            new += [[int(t), int(own), text(a), text(b), key[0], text(who)] for t, own, a, b, who in zip(part["es"], part["own"], part["couple"], part["couple_mobile"], part["who"], strict=True)]
        for hour, own in groupby(sorted(new, key=lambda r: r[0]), key=lambda r: r[0] // HOUR):
            self.waiting.updateValue((hour,), (json.dumps([*self._hour(self.waiting, hour, []), *own]),))
            if hour not in now["waits"]:
                now["waits"].append(hour)
        yield from self._emit(now, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._emit(self._start(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def velocity_features(df: DataFrame, horizons: tuple[int, ...] = (1, 3, 7), drop_null_keys: bool = True) -> DataFrame:
    """The streaming form of the features, for append mode: those of an application as soon as the watermark has passed its second, each row once.

    `df` has a watermark on et; rows without a time are left out. The state needs the RocksDB provider; it holds the applications of the longest horizon
    by hour, and those that wait. Applications of a key that are the same in all of their ids and their second have the same features, and as many rows as they are.
    """
    if drop_null_keys:
        df = df.dropna(subset=["CERT_NO", "MOBILE_NUM", "COMP_NAME", "STANDARD_ADDR"])
    names, (own, contacts) = horizon_names(horizons), entries()
    who = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in WHO]))
    keyed = df.where("et is not null").select("et", who.alias("who"), F.explode(F.concat(own, contacts)).alias("x")).select("et", "x.*", F.unix_seconds("et").alias("es"), "who")
    counts = [f"{d}_{n}" for n in ("n", "named", "couple", "couple_mobile") for d in names]
    state = TrailingCounts(list(names.values()), ["kind", "who", "et", *counts])
    out = ", ".join(["kind string, who string, et timestamp", *[f"{c} bigint" for c in counts]])
    found = keyed.groupBy("kind", "a", "b").transformWithStateInPandas(state, out, "Append", "EventTime", eventTimeColumnName="et")
    # each of the rows that are the same has the counts of all of them
    rows = found.groupBy("et", "who").agg(F.sum(F.when(F.col("kind") == "cert", 1).otherwise(0)).alias("many"), *gathered(names))
    rows = rows.withColumn("one", F.explode(F.sequence(F.lit(1), F.col("many").cast("int")))).withColumn("who", F.from_json("who", ", ".join(f"{c} string" for c in WHO)))
    return features(rows.withColumns({"APP_NO": F.col("who.APP_NO"), "CERT_NO": F.col("who.CERT_NO")}), names)
