"""Structured Streaming forms: windows, sessions, one copy of each message, inventory."""

from __future__ import annotations

import pickle

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.metrics import _settle
from tidemark.session import scratch


def stream_table(spark: SparkSession, root: str, name: str, *, time: str | None = None, end: str | None = None, files_per_batch: int = 8) -> DataFrame:
    """A driver table as a file stream.

    With ``time`` no batch holds an instant before those of earlier batches, so
    a watermark without delay loses nothing: a table of more files than go into
    one batch is first written again in files by ranges of ``time``. With
    ``end`` (an interval) a last row of nulls comes that long after all others,
    which lets the watermark pass everything that is still open.
    """
    path = f"{root}/{name}.parquet*"
    stored = spark.read.parquet(f"{root}/{name}.parquet")
    files = len(stored.inputFiles()) if time else 0
    if time and (end or files > files_per_batch):
        last = stored.agg((F.max(time) + F.expr(f"INTERVAL {end}")).alias(time)).where(F.col(time).isNotNull()) if end else stored.limit(0)
        return ordered_stream(stored.unionByName(last.select(F.col(time).cast(stored.schema[time].dataType)), allowMissingColumns=True), [time], files=max(files, 1), files_per_batch=files_per_batch)
    return spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ordered_stream(rows: DataFrame, order: list[str], *, files: int, files_per_batch: int) -> DataFrame:
    """Stored rows as a file stream in ``order``, ``files_per_batch`` of its ``files`` a batch."""
    spark = rows.sparkSession
    path = scratch(spark, "in-order")
    rows.repartitionByRange(files, *order).write.option("maxRecordsPerFile", 0).parquet(path)
    date_in_order(spark, path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def date_in_order(spark: SparkSession, path: str) -> None:
    """Date the part files by their numbers, a second apart: a file stream takes the oldest first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dated = lambda: sorted((int(f.getPath().getName().split("-")[1]), f.getModificationTime(), f.getPath()) for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    parts = dated()
    start = max((t for _, t, _ in parts), default=0) - 1000 * len(parts)
    for i, (_, _, part) in enumerate(parts):
        fs.setTimes(part, start + 1000 * i, -1)
    times = [t for _, t, _ in dated()]
    if any(a >= b for a, b in zip(times, times[1:])):
        raise ValueError(f"files in {path} cannot be dated, so they cannot be streamed in time order")


def drain(stream: DataFrame, name: str, *, mode: str = "append", base: str | None = None) -> DataFrame:
    """Run a stream over all that is available and return what it has emitted.

    ``complete`` keeps the last result; ``append`` collects every batch.
    Checkpoint and results lie in ``base`` (default: a scratch folder); a later
    run with the same ``base`` goes on where the last one stopped and reads no
    file twice.
    """
    spark = stream.sparkSession
    base = base or scratch(spark, name)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", f"{base}/out").start()
    else:
        query = writer.foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{base}/out")).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def tumbling_counts(events: DataFrame, time: str, every: str, delay: str, keys: list[str]) -> DataFrame:
    """Half-open clock windows, emitted once the watermark has passed them."""
    return events.withWatermark(time, delay).groupBy(F.window(time, every), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, time: str, gap: str, delay: str, keys: list[str]) -> DataFrame:
    """Sessions that end after ``gap`` without an event."""
    return events.withWatermark(time, delay).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"))


def single_deliveries(messages: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """One copy of each message among those at most ``delay`` apart."""
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def running_inventory(fills: DataFrame, delay: str) -> DataFrame:
    """Average-cost inventory per key, settled as the watermark passes each instant.

    ``fills``: key STRING, ts TIMESTAMP, side, shares, price. Rows wait until no
    earlier one can come; each settled instant emits the state after it.
    """

    def step(key, frames, state: GroupState):
        s, waiting = pickle.loads(state.get[0]) if state.exists else ({"qty": 0.0, "cost": 0.0, "gain": 0.0, "ok": True, "flat": True, "b": 0.0, "v": 0.0, "s": 0.0, "w": 0.0}, [])
        for f in frames:
            waiting += list(zip(f["ts"].astype("datetime64[us]").astype("int64"), f["side"], f["shares"].astype(float), f["price"].astype(float)))
        mark = state.getCurrentWatermarkMs() * 1000
        ready, waiting = sorted(w for w in waiting if w[0] < mark), [w for w in waiting if w[0] >= mark]
        out = []
        for i, (t, side, shares, price) in enumerate(ready):
            a, b = ("b", "v") if side == "BUY" else ("s", "w")
            s[a] += shares
            s[b] += shares * price
            if i + 1 == len(ready) or ready[i + 1][0] != t:
                _settle(s)
                out.append((key[0], t, s["qty"] if s["ok"] else None, s["cost"] if s["ok"] and s["flat"] else None))
        state.update((pickle.dumps((s, waiting)),))
        if waiting:
            state.setTimeoutTimestamp(max(min(w[0] for w in waiting), mark) // 1000 + 1)
        yield pd.DataFrame(out, columns=["key", "time_us", "quantity", "cost"])

    return fills.withWatermark("ts", delay).groupBy("key").applyInPandasWithState(step, "key string, time_us long, quantity double, cost double", "s binary", "append", GroupStateTimeout.EventTimeTimeout)


def late_rows(stream: DataFrame, time: str, delay_us: int) -> DataFrame:
    """All rows of a stream with ``late``: does the row lie more than the delay before the latest instant of earlier batches?

    Late rows go to a side output of their own instead of being dropped. The
    latest instant is kept beside the results, so a restarted run resumes.
    """
    spark = stream.sparkSession
    base = scratch(spark, "late")

    def take(batch: DataFrame, number: int) -> None:
        seen = spark.read.parquet(f"{base}/seen").agg(F.max("t")).first()[0] if number else None
        mark = F.lit(seen).cast("long") - delay_us
        late = F.coalesce(F.unix_micros(time) < mark, F.lit(False))
        batch.withColumn("late", late).write.mode("overwrite").parquet(f"{base}/out/batch={number}")
        batch.agg(F.max(F.unix_micros(time)).alias("t")).write.mode("overwrite").parquet(f"{base}/seen/batch={number}")

    stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stream.schema)}, late boolean, batch int").parquet(f"{base}/out").drop("batch")
