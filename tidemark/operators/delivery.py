"""Messages delivered more than once: Bloom screen per time bucket, exact check.

Deliveries are stored once, narrow (hash, identifier, rank, row id), in one
folder a time bucket, each file a range of hashes. ``possible_repeats`` then
sends each (bucket, hash), already combined within its input batch, to the
shard of the hash. A shard keeps one Bloom filter per time bucket and one over
all of them, each sized from the number of stored rows. What the common filter
lacks is definitely new and goes no further. Only a possible repeat is tried on
the buckets' filters and names those that may hold it. ``repeated_rows`` then
reads the folders of the named buckets only, drops what a bounded bitmap of the
possible repeats excludes before anything is shuffled, and decides exactly, on
the identifier's text.

Scale: storage is written by ranges of (bucket, hash, row), so neither a bucket
nor an identifier with a third of all rows meets in one task; such an
identifier leaves each Arrow batch of the screen as one row per bucket. Filters
take 4 to 8 bytes an identifier of a shard, false positives stay below 0.1 %
at any number, and the number of shards follows the shuffle partitions. What
goes to the driver is one row a time bucket. The exact step aggregates with
map-side combine before it joins.

Defined cases: null identifiers are never repeats; an empty identifier is an
identifier; unknown bucket is bucket -1; of repeats the smallest
(page, line, row id) remains, with nulls after everything else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.screen import screened
from tidemark.session import materialize, scratch

BITS_EACH = 16
PROBES = 6


class BloomFilter:
    """Bloom filter of packed bits, at least ``BITS_EACH`` for each of ``capacity`` identifiers."""

    def __init__(self, capacity: int) -> None:
        self.bits = np.zeros(1 << max(3, (capacity * BITS_EACH - 1).bit_length() - 3), np.uint8)

    @staticmethod
    def probes(ids: np.ndarray) -> np.ndarray:
        """64-bit probe values; a filter uses as many low bits as it has."""
        with np.errstate(over="ignore"):
            mixed = (ids ^ (ids >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            step = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(17)) | np.uint64(1)
            return np.stack([mixed + np.uint64(i) * step for i in range(PROBES)])

    def _at(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = probes & np.uint64(8 * len(self.bits) - 1)
        return (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)

    def has(self, probes: np.ndarray) -> np.ndarray:
        at, mask = self._at(probes)
        return ((self.bits[at] & mask) != 0).all(axis=0)

    def add(self, probes: np.ndarray) -> None:
        at, mask = self._at(probes)
        np.bitwise_or.at(self.bits, at.ravel(), mask.ravel())


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per (bucket, hash) of each batch, with its count."""
    for batch in batches:
        if batch.num_rows:
            own = pa.Table.from_batches([batch]).group_by(["bucket", "h"]).aggregate([([], "count_all")])
            yield from own.rename_columns(["bucket", "h", "n"]).to_batches()


def _screen(rows: dict[int, int], shards: int):
    """Possible repeats of one shard; input sorted by (shard, bucket). ``rows`` counts the stored rows of each bucket."""
    room = lambda n: n // shards + 4 * int((n / shards) ** 0.5) + 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _screened_batches(batches, {b: room(n) for b, n in rows.items()}, room(sum(rows.values())))

    return run


def _screened_batches(batches: Iterator[pa.RecordBatch], rooms: dict[int, int], all_rooms: int) -> Iterator[pa.RecordBatch]:
    shard, filters, any_bucket = None, {}, None

    def run(bucket: int, h: np.ndarray, n: np.ndarray) -> tuple[list, list]:
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.r_[True, h[1:] != h[:-1]]
        ids, counts = h[first], np.add.reduceat(n, np.flatnonzero(first))
        probes = BloomFilter.probes(ids.view(np.uint64))
        maybe = any_bucket.has(probes)  # definitely new otherwise
        repeat = maybe | (counts > 1)
        out_b, out_h = [np.full(int(repeat.sum()), bucket, np.int64)], [ids[repeat]]
        if maybe.any():
            old, asked = ids[maybe], probes[:, maybe]
            for other, known in filters.items():
                if other != bucket and (hit := known.has(asked)).any():
                    out_b.append(np.full(int(hit.sum()), other, np.int64))
                    out_h.append(old[hit])
        any_bucket.add(probes[:, ~maybe])
        if bucket not in filters:
            filters[bucket] = BloomFilter(rooms[bucket])
        filters[bucket].add(probes)
        return out_b, out_h

    for batch in batches:
        if not batch.num_rows:
            continue
        s, b, h, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "bucket", "h", "n"))
        cuts = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (b[1:] != b[:-1])])
        got_b, got_h = [], []
        for lo, hi in zip(cuts, [*cuts[1:], len(s)]):
            if s[lo] != shard:
                shard, filters, any_bucket = s[lo], {}, BloomFilter(all_rooms)
            out_b, out_h = run(int(b[lo]), h[lo:hi], n[lo:hi])
            got_b += out_b
            got_h += out_h
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got_b)), pa.array(np.concatenate(got_h))], ["bucket", "h"])


def store(rows: DataFrame, row_id: str, identifier: Column, order: list[Column], bucket: Column) -> DataFrame:
    """Deliveries with an identifier as stored in the shared folder: id, m, r, h, bucket."""
    rank = F.struct(*[x for i, c in enumerate([*order, F.col(row_id)]) for x in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))])
    kept = rows.select(F.col(row_id).alias("id"), identifier.alias("m"), rank.alias("r"), F.coalesce(bucket.cast("long"), F.lit(-1)).alias("bucket")).where("m IS NOT NULL").withColumn("h", F.xxhash64("m"))
    path = scratch(rows.sparkSession, "deliveries")
    kept.repartitionByRange("bucket", "h", "id").write.partitionBy("bucket").parquet(path)
    return rows.sparkSession.read.schema(kept.schema).parquet(path)


def possible_repeats(stored: DataFrame, counts: dict[int, int], *, shards: int | None = None) -> DataFrame:
    """Distinct (bucket, h) that may hold a repeated identifier; none is missed."""
    shards = shards or 4 * int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = stored.select("bucket", "h").mapInArrow(_combine, "bucket long, h long, n long")
    placed = narrow.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int"))
    sorted_ = placed.repartition("shard").sortWithinPartitions("shard", "bucket")
    return sorted_.mapInArrow(_screen(counts, shards), "bucket long, h long").distinct()


def repeated_rows(rows: DataFrame, row_id: str, identifier: Column, order: list[Column], bucket: Column) -> DataFrame:
    """``row_id`` of every delivery that must go; one copy of each message remains."""
    stored = store(rows, row_id, identifier, order, bucket)
    counts = {r.bucket: r.n for r in stored.groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # one row a time bucket
    hit = materialize(possible_repeats(stored, counts), "possible-repeats")
    named = [r.bucket for r in hit.select("bucket").distinct().collect()]
    key = F.xxhash64("bucket", "h")
    asked = screened(stored.where(F.col("bucket").isin(named)), key, hit, key)
    # an inner join, as a semi-join would be pushed below the bitmap; ``hit`` is distinct
    candidates = materialize(asked.join(hit, ["bucket", "h"]).select("id", "m", "r"), "repeat-candidates")
    first = candidates.groupBy("m").agg(F.min("r").alias("first"), F.count("*").alias("n")).where("n > 1")
    return candidates.join(first, "m").where("r <> first").select(F.col("id").alias(row_id))
