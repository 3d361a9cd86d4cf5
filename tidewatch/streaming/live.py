"""The monitors on streams: totals by a tagged union, windows by panes, joins of windows, a keyed store, counts over trailing time."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.joins import join_range
from tidewatch.operators.over import latest_per
from tidewatch.plans.monitor import KEY, SIZES, TOTALS, WINDOWED, period_means, period_measures, period_rates, rates, result_flags, result_measures, window_rates
from tidewatch.sources.credit import make_topics, publish, read_topic, write_topic, write_topics
from tidewatch.streaming import store, windows


def running_product_rates(applies: DataFrame, results: DataFrame) -> DataFrame:
    """Totals of both streams by product, for update mode: two updating aggregates can't be joined, one over both streams can be made."""
    flags = result_flags(1)
    a = applies.select(KEY, F.col("APPLY_TIME").alias("ts"), F.lit(1).alias("APP_C_CT"), F.lit(0).alias("r"), *[F.lit(0).cast("long").alias(n) for n in flags])
    b = results.select(KEY, F.lit(None).cast("long").alias("ts"), F.lit(0).alias("APP_C_CT"), F.lit(1).alias("r"), *[c.alias(n) for n, c in flags.items()])
    both = a.unionByName(b).groupBy(KEY).agg(F.max("ts").alias("ts"), *[F.sum(n).alias(n) for n in ("APP_C_CT", "r", *flags)])
    return rates(both.where("APP_C_CT > 0 and r > 0")).select(KEY, "ts", *TOTALS)


def running_guarded(applies: DataFrame, results: DataFrame, seconds: int) -> DataFrame:
    """Totals of products whose last application and last result are no more than so many seconds apart, for update mode: product, ts, r_ts, counts."""
    a = applies.select(KEY, F.col("APPLY_TIME").alias("ts"), F.lit(None).cast("long").alias("r_ts"), F.lit(1).alias("APP_C_CT"), F.lit(0).cast("long").alias("ACC_C_CT"))
    b = results.select(KEY, F.lit(None).cast("long").alias("ts"), F.col("CREDIT_TIME").alias("r_ts"), F.lit(0).alias("APP_C_CT"), result_flags(1)["ACC_C_CT"].alias("ACC_C_CT"))
    both = a.unionByName(b).groupBy(KEY).agg(F.max("ts").alias("ts"), F.max("r_ts").alias("r_ts"), F.sum("APP_C_CT").alias("APP_C_CT"), F.sum("ACC_C_CT").alias("ACC_C_CT"))
    return both.where(F.abs(F.expr("ts div 1000 - r_ts div 1000")) <= seconds)


def keep_totals(totals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the totals by product (an update-mode stream with `ts` in milliseconds) in a versioned store, one version for each batch."""

    def each(batch: DataFrame, number: int) -> None:
        store.write(batch, path, [KEY], "ts", number)

    return totals.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def totals_beside(own: DataFrame, path: str, topic: str, checkpoint: str, bound: tuple[int, int] | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Write windows (product, w_end, further columns) with the totals of their product to a topic, each row once.

    With `bound`, only where the totals' time lies within [w_end - before, w_end + after] seconds. Every batch reads one version of the totals, the last
    when it is first done, and the same when it is done again. Before there are any totals nothing is met.
    """

    def each(batch: DataFrame, number: int) -> None:
        version = store.pin(batch.sparkSession, path, topic, number)
        totals = store.read(batch.sparkSession, path, [KEY], "ts", version) if version else None
        if totals is None:
            return
        totals = totals.drop("__until", "__written").withColumn("ts", F.expr("ts div 1000"))
        publish(join_range(totals, batch, KEY, *bound) if bound else totals.join(batch, KEY), topic, number)

    make_topics(own.sparkSession, topic)
    return own.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def hop(df: DataFrame, keys: list[str], slide: str, size: str, sums: dict[str, Column]) -> DataFrame:
    """Sliding windows over panes of one slide, for append mode; `df` has a watermark on et. Columns: window, keys, n and the sums."""
    panes = df.groupBy(F.window("et", slide), *keys).agg(F.count("*").alias("n"), *[F.sum(c).alias(m) for m, c in sums.items()])
    over = panes.groupBy(F.window(F.window_time("window"), size, slide), *keys)
    return over.agg(*[F.sum(m).alias(m) for m in ("n", *sums)])


def join_hop(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Windows of two streams that are the same, by key."""
    return left.join(right, ["window", *keys])


def kv_upsert(batch: DataFrame, path: str, key: str, value: str, order: str, days: int, number: int) -> None:
    """Keep the batch's latest value of each key with its expiry, as one folder for each batch (a batch that is done again replaces its own)."""
    own = batch.groupBy(F.col(key).cast("string").alias("key")).agg(F.max_by(F.col(value).cast("string"), order).alias("value"), F.max(order).alias("written"))
    own.withColumn("expires_at", F.col("written") + F.expr(f"interval {days} days")).write.mode("overwrite").parquet(f"{path}/batch={number}")


def kv_lookup(df: DataFrame, held: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Rows with the stored value of their key that was written last and has not expired at `as_of`; null if there is none."""
    latest = held.groupBy("key").agg(F.max_by(F.struct("value", "expires_at"), "written").alias("v"))
    joined = df.join(latest, F.col(key).cast("string") == F.col("key"), "left")
    return joined.withColumn("value", F.when(F.col("v.expires_at") > as_of, F.col("v.value"))).drop("key", "v")


def kv_compact(held: DataFrame, path: str, as_of: Column) -> None:
    """Write what is left of a store to a new one: the last value of each key, unless it has expired. Later batches go to the new folder."""
    latest = held.groupBy("key").agg(F.max_by(F.struct("value", "written", "expires_at"), "written").alias("v")).select("key", "v.*")
    latest.where(F.col("expires_at") > as_of).write.mode("overwrite").parquet(f"{path}/batch=-1")


class TrailingCount(StatefulProcessor):
    """For each row of a key, in order of time: rows, sum of addends and distinct values of its trailing frame. Rows wait until the watermark has passed them."""

    def __init__(self, seconds: int) -> None:
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.past = handle.getListState("past", "es bigint, id string, s bigint, v string")
        self.waiting = handle.getListState("waiting", "es bigint, id string, s bigint, v string")

    def _emit(self, key: tuple, until: int) -> Iterator[pd.DataFrame]:
        waiting = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: r[:2])
        ready = [r for r in waiting if r[0] * 1000 <= until]
        if not ready:
            return
        held = sorted([tuple(r) for r in self.past.get()] + ready, key=lambda r: r[0])
        first = last = total = 0
        values: Counter[str] = Counter()
        rows = []
        for es, row_id, _, _ in ready:
            while last < len(held) and held[last][0] <= es:
                total += held[last][2]
                if held[last][3] is not None:
                    values[held[last][3]] += 1
                last += 1
            while held[first][0] < es - self.seconds:
                total -= held[first][2]
                if (v := held[first][3]) is not None:
                    values[v] -= 1
                    if not values[v]:
                        del values[v]
                first += 1
            rows.append((key[0], row_id, es, last - first, total, len(values)))
        for state, kept in ((self.past, [r for r in held if r[0] > until // 1000 - self.seconds]), (self.waiting, waiting[len(ready) :])):
            state.clear()
            if kept:
                state.put(kept)
        yield pd.DataFrame(rows, columns=["key", "id", "es", "n", "s", "d"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for part in rows:
            own = [(int(t), str(i), int(s), None if pd.isna(v) else str(v)) for t, i, s, v in zip(part["es"], part["id"], part["s"], part["v"], strict=True)]
            self.waiting.appendList(own)
            for t in {r[0] for r in own}:
                self.handle.registerTimer(t * 1000 + 1)
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def trailing_counts(df: DataFrame, key: str, row_id: str, seconds: int, addend: Column | None = None, value: str | None = None) -> DataFrame:
    """The streaming form of trailing counts: key, id, es, n (rows), s (sum of whole `addend`, null: 0), d (distinct `value`, null: none).

    `df` has a watermark on et; state needs the RocksDB provider, and holds the frame of each key and the rows not yet passed.
    """
    added = F.coalesce((F.lit(0) if addend is None else addend).cast("long"), F.lit(0).cast("long")).alias("s")
    counted = (F.lit(None) if value is None else F.col(value)).cast("string").alias("v")
    rows = df.select(F.col(key).alias("key"), F.col(row_id).cast("string").alias("id"), F.unix_seconds("et").alias("es"), added, counted, "et")
    out = "key string, id string, es bigint, n bigint, s bigint, d bigint"
    return rows.groupBy("key").transformWithStateInPandas(TrailingCount(seconds), out, "Append", "EventTime")


#: Stands for a null time in a state.
UNTIMED = -(1 << 40)


class InOrder(StatefulProcessor):
    """Rows of a key (es, seq, whole numbers v0, v1, ...) wait until the watermark has passed them and are then worked through in order of time."""

    def __init__(self, width: int) -> None:
        self.names = ["es", "seq", *[f"v{k}" for k in range(width)]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", ", ".join(f"{n} bigint" for n in self.names))
        self.kept = handle.getListState("kept", ", ".join(f"{n} bigint" for n in self.names[2:]))

    def work(self, kept: list[tuple], rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        """What to keep from here on, and the values to emit for each of the rows."""
        raise NotImplementedError

    def _emit(self, key: tuple, until: int) -> Iterator[pd.DataFrame]:
        waiting = sorted(tuple(r) for r in self.waiting.get())
        ready = [r for r in waiting if r[0] * 1000 <= until]
        if not ready:
            return
        kept, out = self.work([tuple(r) for r in self.kept.get()], [r[2:] for r in ready])
        for state, rows in ((self.kept, kept), (self.waiting, waiting[len(ready) :])):
            state.clear()
            if rows:
                state.put(rows)
        yield pd.DataFrame([(key[0], *r[:2], *v) for r, v in zip(ready, out, strict=True)], columns=["key", *self.names])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for part in rows:
            own = [tuple(int(x) for x in r) for r in part[self.names].itertuples(index=False)]
            self.waiting.appendList(own)
            for t in {r[0] for r in own}:
                self.handle.registerTimer(t * 1000 + 1)
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class RunningSums(InOrder):
    """The sums up to and with each row."""

    def work(self, kept: list[tuple], rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        now, out = kept[0] if kept else (0,) * (len(self.names) - 2), []
        for r in rows:
            now = tuple(a + b for a, b in zip(now, r, strict=True))
            out.append(now)
        return [now], out


class RowLags(InOrder):
    """The first value as it was so many rows earlier, for each of the lags; 0 where no row is there."""

    def __init__(self, lags: tuple[int, ...]) -> None:
        super().__init__(1 + len(lags))
        self.lags = lags

    def work(self, kept: list[tuple], rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        past, out = [r[0] for r in kept], []
        for r in rows:
            out.append((r[0], *[past[-n] if n <= len(past) else 0 for n in self.lags]))
            past.append(r[0])
        return [(v, *[0] * len(self.lags)) for v in past[-max(self.lags) :]], out


def _in_order(df: DataFrame, processor: InOrder, values: list[Column]) -> DataFrame:
    # rows without a time come before all others that have not been worked through yet
    rows = df.select(F.col(KEY).alias("key"), F.coalesce(F.unix_seconds("et"), F.lit(UNTIMED)).alias("es"), F.col("seq").cast("long").alias("seq"), *[v.cast("long").alias(n) for v, n in zip(values, processor.names[2:], strict=True)], "et")
    out = ", ".join(["key string", *[f"{n} bigint" for n in processor.names]])
    done = rows.groupBy("key").transformWithStateInPandas(processor, out, "Append", "EventTime")
    return done.withColumn("es", F.when(F.col("es") != UNTIMED, F.col("es")))


def running_events(applies: DataFrame, results: DataFrame) -> DataFrame:
    """Totals after every event of either stream, once the watermark has passed it: product, ts (epoch seconds), seq, totals and rates.

    Both streams have a watermark on et and a number seq that orders events of one second. State: the totals, and events not yet passed.
    """
    flags = result_flags(1)
    names = ["APP_C_CT", "r", *flags]
    a = applies.select(KEY, "et", "seq", F.lit(1).alias("APP_C_CT"), F.lit(0).alias("r"), *[F.lit(0).cast("long").alias(n) for n in flags])
    b = results.select(KEY, "et", "seq", F.lit(0).alias("APP_C_CT"), F.lit(1).alias("r"), *[c.alias(n) for n, c in flags.items()])
    sums = _in_order(a.unionByName(b), RunningSums(len(names)), [F.col(n) for n in names])
    named = sums.select(F.col("key").alias(KEY), F.col("es").alias("ts"), "seq", *[F.col(f"v{k}").alias(n) for k, n in enumerate(names)])
    return rates(named.where("APP_C_CT > 0 and r > 0")).select(KEY, "ts", "seq", *TOTALS)


def row_lags(df: DataFrame, value: str, lags: tuple[int, ...]) -> DataFrame:
    """A whole number of each row and what it was so many rows of the product earlier (0: none): product, ts, seq, value, lag_<n>."""
    out = _in_order(df, RowLags(lags), [F.coalesce(F.col(value), F.lit(0)), *[F.lit(0)] * len(lags)])
    return out.select(F.col("key").alias(KEY), F.col("es").alias("ts"), "seq", F.col("v0").alias(value), *[F.col(f"v{k + 1}").alias(f"lag_{n}") for k, n in enumerate(lags)])


def staged(df: DataFrame, topic: str, checkpoint: str, delay: str = "5 seconds", trigger: dict | None = None):
    """Write a stream to a topic and read it back with event time and a watermark of its own: the query, and the stream. Time is in `ts`, seconds."""
    query = write_topic(df, topic, checkpoint, trigger=trigger)
    return query, read_topic(df.sparkSession, topic, ", ".join(f"{n} {t}" for n, t in df.dtypes), "ts", "s", delay)


def align_running(running: DataFrame, windows: DataFrame, seconds: int, which: str = "next") -> DataFrame:
    """Totals after each event with the window of their product that closes next behind it, or closed last. Both streams have watermarks.

    `windows` are those of `hop`, or those of all sizes as a topic gives them back (w_end, and et with a watermark), with a slide of `seconds`: an
    equality on the window's end, and a bound on the times so that state can go.
    """
    end = F.floor(F.unix_seconds("et") / seconds) * seconds + (seconds if which == "next" else 0)
    left = running.withColumn("w_end", end.cast("long")).alias("a")
    if "window" in windows.columns:
        windows = windows.withColumn("dt", F.window_time("window")).withColumn("b_end", F.unix_seconds("window.end")).drop("window")
    else:
        windows = windows.withColumnsRenamed({"et": "dt", "w_end": "b_end"})
    right = windows.withColumnRenamed(KEY, "b_key").alias("b")
    within = F.expr(f"dt between et - interval {seconds + 1} seconds and et + interval {seconds + 1} seconds")
    joined = left.join(right, (F.col(KEY) == F.col("b_key")) & (F.col("w_end") == F.col("b_end")) & within)
    return joined.drop("b_key", "b_end", "dt")


def windowed(applies: DataFrame, results: DataFrame, slide: int = 10, sizes: dict[str, int] = SIZES, mode: str = "exact", salts: int = 1) -> DataFrame:
    """Windows of all sizes over both streams, where the smallest holds rows of both: product, w_end, dt and the columns of the batch form.

    One state holds the windows of both, so nothing is joined. `salts` deals the customers of one product out (see `windows.hop`).
    """
    sums, sets = result_measures()
    none = dict(results.select(*[c.alias(n) for n, c in (sums | sets).items()]).dtypes)
    a = applies.select(KEY, "et", "CUST_ID", F.lit(1).alias("APP_C_CT"), F.lit(0).alias("r"), *[F.lit(0 if n in sums else None).cast(t).alias(n) for n, t in none.items()])
    b = results.select(KEY, "et", "CUST_ID", F.lit(0).alias("APP_C_CT"), F.lit(1).alias("r"), *[c.alias(n) for n, c in (sums | sets).items()])
    own = {n: F.col(n) for n in ("APP_C_CT", "r", *sums)}
    both = windows.hop(a.unionByName(b), [KEY], slide, sizes, own, {n: F.col(n) for n in sets}, F.col("CUST_ID"), salts)
    least = min(sizes, key=sizes.__getitem__)
    both = both.where((F.col(f"APP_C_CT_{least}") > 0) & (F.col(f"r_{least}") > 0))
    return window_rates(both, sizes, mode).select(KEY, "w_end", "dt", *[f"{n}_{s}" for n in WINDOWED for s in sizes])


def period_over_period(applies: DataFrame, results: DataFrame, slide: int = 10, size: int = 3600, day: int | None = None) -> DataFrame:
    """The period monitor of 18 columns on streams, for append mode: windows of both streams against those one window and `day` windows before.

    One state holds the windows of both streams, and one the last `day` windows of each product and stream, so nothing is joined.
    """
    day = day or 86_400 // slide
    sums = period_measures()
    kinds = dict(results.select(*[c.alias(n) for n, c in sums.items()]).dtypes)
    a = applies.select(KEY, "et", F.lit(1).alias("a"), F.lit(0).alias("r"), *[F.lit(None).cast(t).alias(n) for n, t in kinds.items()])
    b = results.select(KEY, "et", F.lit(0).alias("a"), F.lit(1).alias("r"), *[c.alias(n) for n, c in sums.items()])
    both = windows.hop(a.unionByName(b), [KEY], slide, {"H": size}, {n: F.col(n) for n in ("a", "r", *sums)})
    counts = [F.col("a_H").alias("apply_num"), F.col("r_H").alias("return_num"), F.col("success_num_H").alias("success_num")]
    both = windows.series_lags(both.select(KEY, "w_end", "dt", *counts, *period_means("H")), [KEY], {"apply_num": "apply_num", "return_num": "success_num"}, [1, day])
    return period_rates(both.withColumnsRenamed({"apply_num_1": "last_num", f"apply_num_{day}": "last_24_num", "success_num_1": "r_last", f"success_num_{day}": "r_last_24"}))


def monitor_job(applies: DataFrame, results: DataFrame, folder: str, part: str, slide: int = 10, which: str = "next", sizes: dict[str, int] = SIZES, names: DataFrame | None = None, trigger: dict | None = None) -> StreamingQuery:
    """One of the three queries that make the product monitor of 62 columns; each has a checkpoint of its own below `folder`.

    `totals` writes the totals after each event to two topics (all of them; the last of each product in the batch), `windows` the windows of all sizes to another,
    and `monitor` reads totals and windows back and writes them joined. They may start in any order, stop anywhere and start again: every
    row is in each topic once. `applies` and `results` are read by the first two only.
    """
    spark, topics = applies.sparkSession, {n: f"{folder}/{n}" for n in ("totals", "latest", "windows", "monitor")}
    make_topics(spark, *topics.values())
    if part == "totals":
        rows = running_events(applies, results)
        sinks = {topics["totals"]: None, topics["latest"]: lambda batch: latest_per(batch, [KEY], ["ts", "seq"])}
    elif part == "windows":
        rows, sinks = windowed(applies, results, slide, sizes).drop("dt"), {topics["windows"]: None}
    else:
        counts = ("CT", "CCT")
        kind = lambda n: f"{n} {'bigint' if n.rsplit('_', 1)[-1] in counts and not n.startswith(('PR', 'AF_PR', 'AVG')) else 'double'}"
        totals = read_topic(spark, topics["totals"], ", ".join([f"{KEY} string, ts bigint, seq bigint", *map(kind, TOTALS)]), "ts", "s")
        wide = [f"{kind(n).split()[0]}_{s} {kind(n).split()[1]}" for n in WINDOWED for s in sizes]
        own = read_topic(spark, topics["windows"], ", ".join([f"{KEY} string, w_end bigint", *wide]), "w_end", "s")
        rows = align_running(totals, own, slide, which)
        if names is None:
            name = F.when(F.col(KEY) == "P0", "product zero").alias("BUSINESS_TYPE_NAME")
        else:
            rows, name = rows.join(names.groupBy(KEY).agg(F.min("BUSINESS_TYPE_NAME").alias("BUSINESS_TYPE_NAME")), KEY, "left"), F.col("BUSINESS_TYPE_NAME")
        rows = rows.select(KEY, name, F.col("ts").alias("DT"), "seq", *TOTALS, *[f"{n}_{s}" for n in WINDOWED for s in sizes])
        sinks = {topics["monitor"]: None}
    return write_topics(rows, sinks, f"{folder}/_checkpoints/{part}", trigger=trigger)
