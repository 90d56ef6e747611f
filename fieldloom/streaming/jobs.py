"""Structured Streaming over an events folder: windows, sessions, count-triggered flushes and a ledger sink."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..shared import shared_folder, written

#: Closes windows and sessions at the end of a replay: a row so far ahead that the watermark passes all others.
CLOSE = "close"


#: Days that a batch of a replay holds.
DAYS = 10
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def staged_days(spark: SparkSession, d: str, late: str | None = None) -> tuple[str, list[int]]:
    """The events below a folder batch=<number> for each ten days, and the numbers in order; rows for which `late` holds make a batch of their own, five days before the end.

    As many tasks write as there are days; the order is that of the numbers, whatever the files' times are. The last batch is a closing row.
    """
    path = shared_folder(spark, "days")
    events = spark.read.parquet(f"{d}/events.parquet")
    ends = events.agg(F.min(F.to_date("ts")).alias("__first"), F.max("ts").alias("__last"))
    after = (F.col("__last") + F.expr("interval 900 days")).cast("timestamp_ntz")
    values = {"event_type": F.lit(CLOSE), "ts": after}
    closing = ends.select(*(values.get(c, F.lit(-1).cast(t) if t in ("bigint", "int") else F.lit(None).cast(t)).alias(c) for c, t in events.dtypes), F.lit(None).cast("date").alias("day"), F.lit(1 << 30).alias("batch"))
    block = lambda day: 2 * F.floor(F.date_diff(day, "__first") / DAYS).cast("int")
    rows = events.join(F.broadcast(ends)).withColumn("day", F.to_date("ts"))  # one row is sent
    number = block("day") if late is None else F.when(F.expr(late), block(F.date_sub(F.to_date("__last"), 5)) + 1).otherwise(block("day"))
    rows = rows.withColumn("batch", number).drop("__first", "__last").unionByName(closing)
    numbers = [r.batch for r in written(rows.select("batch").distinct(), "batches").orderBy("batch").collect()]
    rows.repartition("batch", "day").drop("day").write.partitionBy("batch").parquet(path)
    return path, numbers


def in_batches(spark: SparkSession, d: str, start: Callable[[DataFrame], StreamingQuery], late: str | None = None, progress: list | None = None) -> None:
    """A stream over the events in explicit batches: each is moved to the watched folder once the one before has gone through, and `start` goes on from its checkpoint.

    The stream has a session of its own, so that its settings stay there. `progress` collects what each run says of its batches.
    """
    staged, numbers = staged_days(spark, d, late)
    live, schema = shared_folder(spark, "live"), spark.read.parquet(f"{d}/events.parquet").schema
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(live).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(live))
    for number in numbers:
        if not files.rename(path(f"{staged}/batch={number}"), path(f"{live}/batch={number}")):
            raise RuntimeError(f"batch {number} cannot be moved")
        query = start(own.readStream.schema(schema).parquet(f"{live}/batch=*"))
        query.awaitTermination()
        if progress is not None:
            progress += query.recentProgress


def replayed(spark: SparkSession, d: str, job: Callable[[DataFrame], DataFrame], mode: str, late: str | None = None, progress: list | None = None) -> DataFrame:
    """What a stream has written once all batches there are have gone through it, as a table in the shared folder."""
    run, shape = shared_folder(spark, "stream"), []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{run}/out" if mode == "complete" else f"{run}/out/batch={number}")

    def start(events: DataFrame) -> StreamingQuery:
        out = job(events)
        shape[:] = [out.schema]
        return out.writeStream.outputMode(mode).option("checkpointLocation", f"{run}/state").foreachBatch(keep).trigger(availableNow=True).start()

    in_batches(spark, d, start, late, progress)
    return spark.read.schema(shape[0]).parquet(f"{run}/out").select(*shape[0].fieldNames())


def window_sums(events: DataFrame, size: str, late: str) -> DataFrame:
    """Counts and sums by window; a watermark drops what comes later than `late`. It needs a time zone, which is put on and taken off."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    sums = timed.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return sums.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n", "total")


def once(events: DataFrame, key: str, late: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, gap: str, late: str = "0 seconds") -> DataFrame:
    """Runs of a user's events without a gap; a session leaves the state once the watermark has passed it."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    runs = timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.min("ts").alias("started"), F.count("*").alias("n"))
    return runs.select("user_id", F.col("started").cast("timestamp_ntz").alias("started"), "n")


def in_order(parts: Iterator[pd.DataFrame], *columns: str) -> list[tuple]:
    """The values of a key's rows by (us, event_id), unknown ones last. A key has few rows, so that tables of pandas would cost more than the rows."""
    names = ["us", "event_id", *columns]
    rows = [r for p in parts for r in zip(*(p[c].tolist() for c in names))]
    return sorted(rows, key=lambda r: (r[0] != r[0], r[0], r[1] != r[1], r[1]))


def nearest_merge(events: DataFrame, left: str, right: str) -> DataFrame:
    """(user_id, event_id, other, gap_us): each left event with the right one nearest in time, the later of equals, once a right event follows it.

    Batches come in order of time. The state of a user is the last right event and the left ones since; what no right event follows stays there.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids, times, last = (list(x) for x in state.get) if state.exists else ([], [], [])
        out = []
        for at, ident, kind in in_order(parts, "event_type"):
            if kind == left:
                ids.append(ident)
                times.append(at)
                continue
            for i, t in zip(ids, times):
                back = bool(last) and t - last[1] < at - t
                out.append((key[0], i, last[0] if back else ident, t - last[1] if back else at - t))
            ids, times, last = [], [], [ident, at]
        state.update((ids, times, last))
        if out:
            yield pd.DataFrame(out, columns=["user_id", "event_id", "other", "gap_us"])

    kept = events.where(F.col("event_type").isin(left, right)).select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return kept.groupBy("user_id").applyInPandasWithState(step, "user_id long, event_id long, other long, gap_us long", "ids array<long>, times array<long>, last array<long>", "append", GroupStateTimeout.NoTimeout)


def releases(events: DataFrame, failed: str, most: int) -> DataFrame:
    """(user_id, event_id): the events at which a user has failed over `most` times in a row, once a run; `failed` is a condition on an event."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = state.get[0] if state.exists else 0
        out = []
        for _, ident, bad in in_order(parts, "bad"):
            run = run + 1 if bad else 0
            if run == most + 1:
                out.append((key[0], ident))
        state.update((run,))
        if out:
            yield pd.DataFrame(out, columns=["user_id", "event_id"])

    kept = events.where(F.col("event_type") != CLOSE).select("user_id", "event_id", F.expr(failed).alias("bad"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return kept.groupBy("user_id").applyInPandasWithState(step, "user_id long, event_id long", "run long", "append", GroupStateTimeout.NoTimeout)


def ready_to_join(frames: DataFrame, fixes: DataFrame, by: list[str], time: str, seconds: float) -> DataFrame:
    """`ready` for each group: whether its newest fix is no more than some seconds older than its newest frame; without any fix it is not."""
    newest = lambda df, name: df.groupBy(*by).agg(F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias(name))
    both = newest(frames, "frame_us").join(newest(fixes, "fix_us"), by, "left")
    return both.select(*by, F.coalesce(F.col("fix_us") >= F.col("frame_us") - int(seconds * 1_000_000), F.lit(False)).alias("ready"))


def count_flush(events: DataFrame, size: int) -> DataFrame:
    """(user_id, flush, n): a row for each `size` rows of a key; the count that is left over stays in the state."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, done = state.get if state.exists else (0, 0)
        waiting += sum(map(len, parts))
        full = waiting // size
        state.update((waiting - full * size, done + full))
        yield pd.DataFrame({"user_id": [key[0]] * full, "flush": range(done, done + full), "n": [size] * full})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, flush long, n long", "waiting long, done long", "update", GroupStateTimeout.NoTimeout)


def ledger(spark: SparkSession, d: str, kinds: tuple[str, ...] = ("click", "view")) -> DataFrame:
    """Events fanned out by kind to ledger tables of their own, batch by batch; a batch that is run again replaces its own files only."""
    run = shared_folder(spark, "ledger")

    def fan_out(batch: DataFrame, number: int) -> None:
        for kind in kinds:
            batch.where(F.col("event_type") == kind).select("event_id", "user_id", "event_type").write.mode("overwrite").parquet(f"{run}/out/{kind}/batch={number}")

    in_batches(spark, d, lambda events: events.writeStream.option("checkpointLocation", f"{run}/state").foreachBatch(fan_out).trigger(availableNow=True).start())
    both = [spark.read.option("basePath", f"{run}/out/{kind}").parquet(f"{run}/out/{kind}") for kind in kinds]
    return reduce(DataFrame.unionByName, both).select("event_id", "user_id", "event_type")
