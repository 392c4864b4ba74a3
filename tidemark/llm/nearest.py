"""Records of two tables paired by nearest time, per entity, within a tolerance.

``NearestBuffer`` is the state of a streaming join. It buffers both sides; when
the watermark passes a left row's tolerance horizon, the row is decided and
emitted, and candidates that no open or future left row can reach are evicted.
``nearest_stream`` runs it inside Structured Streaming. ``nearest_time_join``
runs the same stream over stored tables: it writes both sides in the order of
time, so that a batch holds no instant before those of earlier batches and what
a batch has reached is its own watermark, and ends them with a flush row for
every shard.

Scale: a row's key is (entity, time block, salt). Left rows go to their block
and a salt; right rows to every salt of each block they can reach. A hot entity
thus spreads over its blocks. Blocks with more than ``hot`` left rows get as
many salts as they hold that number, counted beforehand, so one instant with a
third of all rows spreads over all cores; other blocks have one, and nothing is
copied for them. Keys are grouped into shards, four for each shuffle partition,
so that a batch makes few calls, each on whole arrays. A batch has at most
250,000 rows a core, and a task holds its shards' share of it; between batches the state is what two tolerances reach, as
lists of numbers. Entities travel as two independent 64-bit hashes, whatever
their length.

Defined cases: a null entity or time matches nothing; at equal distance the
earlier right row wins, at the same instant the smallest id; repeated left rows
each get their match; the boundary of the tolerance counts; empty tables give
an empty result. Names are internal until the end, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.session import materialize
from tidemark.streaming.jobs import drain, ordered_stream

RIGHT, LEFT, FLUSH = 0, 1, 2
HOUR_US = 3_600_000_000
#: Left rows of an entity and time block that one salt takes.
HOT = 20_000
#: Rows of both sides that a core takes in one batch.
ROWS_EACH = 250_000
FIELDS = ["k1", "k2", "t", "kind", "id"]
#: The watermark column is kept after 1970, where the first watermark lies, and inside what pandas can hold.
_FIRST, _LAST = 1_000_000, 9_000_000_000_000_000


class NearestBuffer:
    """Rows (key, key, time, kind, id) that may still match or be matched."""

    def __init__(self, tolerance: int, rows: np.ndarray | None = None) -> None:
        self.tolerance = tolerance
        self.rows = np.empty((5, 0), np.int64) if rows is None else rows

    def push(self, rows: np.ndarray) -> None:
        """Add rows in any order."""
        self.rows = np.concatenate([self.rows, rows], axis=1)

    def advance(self, watermark: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(left ids, right ids) decided once time has passed ``watermark``; None is the end of time.

        Unmatched left rows are dropped when their horizon passes.
        """
        g, h, t, kind, ids = self.rows = self.rows[:, np.lexsort(self.rows[::-1])]
        n, at = len(t), np.arange(len(t))
        if not n:
            return ids, ids
        due = kind == LEFT
        if watermark is not None:
            due &= t + self.tolerance < watermark
        change = np.r_[True, (g[1:] != g[:-1]) | (h[1:] != h[:-1]) | (t[1:] != t[:-1])]
        first = np.maximum.accumulate(np.where(change, at, 0))  # smallest id of the instant
        before = np.maximum.accumulate(np.where(kind == RIGHT, at, -1))
        after = np.minimum.accumulate(np.where(kind == RIGHT, at, n)[::-1])[::-1]
        p, f = first[np.maximum(before, 0)], np.minimum(after, n - 1)
        far = np.iinfo(np.int64).max
        back = np.where((before >= 0) & (g[p] == g) & (h[p] == h), t - t[p], far)
        ahead = np.where((after < n) & (g[f] == g) & (h[f] == h), t[f] - t, far)
        best, gap = np.where(back <= ahead, p, f), np.minimum(back, ahead)
        out = due & (gap <= self.tolerance)
        keep = np.zeros(n, bool) if watermark is None else np.where(kind == LEFT, ~due, t >= watermark - 2 * self.tolerance)
        self.rows = self.rows[:, keep]
        return ids[out], ids[best[out]]


def _step(tolerance: int, in_order: bool):
    def step(key, frames, state: GroupState):
        buffer = NearestBuffer(tolerance, np.array(state.get, np.int64).reshape(5, -1) if state.exists else None)
        mark, last = state.getCurrentWatermarkMs() * 1000, False
        for f in frames:
            rows = f[FIELDS].to_numpy(np.int64).T
            flush = rows[3] == FLUSH
            last |= bool(flush.any())
            buffer.push(rows[:, ~flush])
        if in_order and buffer.rows.shape[1]:
            mark = max(mark, int(buffer.rows[2].max()))
        l, r = buffer.advance(None if last else mark)
        if buffer.rows.shape[1]:
            state.update(tuple(x.tolist() for x in buffer.rows))
            open_left = buffer.rows[2][buffer.rows[3] == LEFT]
            horizon = int(open_left.min() + tolerance if len(open_left) else buffer.rows[2].max() + 2 * tolerance)
            state.setTimeoutTimestamp(min(max(horizon, state.getCurrentWatermarkMs() * 1000), _LAST) // 1000 + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"l": l, "r": r})

    return step


def _joined(rows: DataFrame, tolerance_us: int, delay: str, *, in_order: bool) -> DataFrame:
    """Stream of (shard, k1, k2, t, kind, id, ts) to (l, r)."""
    return rows.withWatermark("ts", delay).groupBy("shard").applyInPandasWithState(
        _step(tolerance_us, in_order), "l long, r long", ", ".join(f"{f} array<bigint>" for f in FIELDS), "append", GroupStateTimeout.EventTimeTimeout
    )


def _block(c: Column, block_us: int) -> Column:
    return F.floor(c / F.lit(block_us)).cast("long")


def _blocks(block_us: int, tolerance_us: int) -> Column:
    """Blocks that a right row reaches."""
    return F.explode(F.sequence(_block(F.col("t") - tolerance_us, block_us), _block(F.col("t") + tolerance_us, block_us)))


def _side(rows: DataFrame, entity: Column, time: Column, id_: str, kind: int) -> DataFrame:
    return rows.where(entity.isNotNull() & time.isNotNull()).select(
        F.xxhash64(entity).alias("e1"), F.xxhash64(F.lit("other"), entity).alias("e2"), time.cast("long").alias("t"), F.lit(kind).alias("kind"), F.col(id_).cast("long").alias("id")
    )


def _keyed(rows: DataFrame, shards: int) -> DataFrame:
    """Rows (e1, e2, b, s, t, kind, id) as the stream takes them."""
    keys = rows.select(F.xxhash64("e1", "b", "s").alias("k1"), F.xxhash64("e2", "b", "s", F.lit("other")).alias("k2"), "t", "kind", "id")
    return keys.select(F.pmod("k1", F.lit(shards)).cast("int").alias("shard"), *FIELDS, F.timestamp_micros(F.greatest(F.least("t", F.lit(_LAST)), F.lit(_FIRST))).alias("ts"))


def _shards(rows: DataFrame) -> int:
    return 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def nearest_time_join(
    left: DataFrame, left_id: str, left_entity: Column, left_time: Column,
    right: DataFrame, right_id: str, right_entity: Column, right_time: Column,
    *, tolerance_us: int, block_us: int = HOUR_US, hot: int = HOT,
) -> DataFrame:
    """Rows (left_id, right_id): each left row with its nearest right row. Both ids are BIGINT."""
    if left_id == right_id:
        raise ValueError("the id columns need different names")
    spark, key = left.sparkSession, ["e1", "e2", "b"]
    a = _side(left, left_entity, left_time, left_id, LEFT).withColumn("b", _block(F.col("t"), block_us))
    c = _side(right, right_entity, right_time, right_id, RIGHT).withColumn("b", _blocks(block_us, tolerance_us))
    heavy = materialize(a.groupBy(*key).agg(F.ceil(F.count("*") / hot).cast("int").alias("salts")).where("salts > 1"), "hot-blocks")
    salts = F.coalesce("salts", F.lit(1))
    a = a.join(heavy, key, "left").withColumn("s", F.pmod(F.xxhash64("id"), salts).cast("int"))
    c = c.join(heavy, key, "left").withColumn("s", F.explode(F.sequence(F.lit(0), salts - 1)))
    shards, cores = _shards(left), spark.sparkContext.defaultParallelism
    rows = _keyed(a.select(*key, "s", "t", "kind", "id").unionByName(c.select(*key, "s", "t", "kind", "id")), shards)
    end = spark.range(shards).select(F.col("id").cast("int").alias("shard"), *[F.lit(FLUSH if f == "kind" else 0).cast("long").alias(f) for f in FIELDS], F.timestamp_micros(F.lit(_LAST)).alias("ts"))
    rows = rows.withColumn("kind", F.col("kind").cast("long")).unionByName(end).withColumn("last", F.col("kind") == FLUSH)
    batches = -(-rows.count() // (ROWS_EACH * cores))
    files = cores * batches
    feed = ordered_stream(rows, ["last", "t", "id"], files=files, files_per_batch=cores).drop("last")
    # rows of one instant may lie in two batches
    out = drain(_joined(feed, tolerance_us, "1 second", in_order=True), "nearest")
    return out.select(F.col("l").alias(left_id), F.col("r").alias(right_id))


def nearest_stream(events: DataFrame, *, tolerance_us: int, delay: str, block_us: int = HOUR_US, salts: int = 1) -> DataFrame:
    """Streaming form over (entity STRING, ts TIMESTAMP, side INT, id BIGINT).

    ``side`` is 0 for candidates, 1 for rows to be matched; ``delay`` is the
    lateness both sides may have. A row that comes later than that is dropped
    by the watermark. Emits (left_id, right_id).
    """
    t = F.unix_micros("ts")
    rows = events.where("entity IS NOT NULL AND ts IS NOT NULL").select(F.xxhash64("entity").alias("e1"), F.xxhash64(F.lit("other"), "entity").alias("e2"), t.alias("t"), F.col("side").cast("long").alias("kind"), F.col("id").cast("long").alias("id"))
    own = F.array(_block(F.col("t"), block_us))
    reach = F.sequence(_block(F.col("t") - tolerance_us, block_us), _block(F.col("t") + tolerance_us, block_us))
    rows = rows.withColumn("b", F.explode(F.when(F.col("kind") == LEFT, own).otherwise(reach)))
    one = F.array(F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    rows = rows.withColumn("s", F.explode(F.when(F.col("kind") == LEFT, one).otherwise(F.sequence(F.lit(0), F.lit(salts - 1)))))
    return _joined(_keyed(rows, _shards(events)), tolerance_us, delay, in_order=False).select(F.col("l").alias("left_id"), F.col("r").alias("right_id"))
