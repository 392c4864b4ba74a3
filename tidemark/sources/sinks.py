"""Sinks: deterministic shards, atomic publishing, read-back verification."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _fs(df: DataFrame, path: str):
    sc = df.sparkSession.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p, sc._jvm.org.apache.hadoop.fs.Path


def publish(df: DataFrame, path: str, fmt: str = "parquet", *, by: list[str] | None = None, **options) -> None:
    """Write to a staging folder, then rename; an existing target is refused."""
    fs, target, make = _fs(df, path)
    if fs.exists(target):
        raise FileExistsError(path)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.write.partitionBy(*(by or [])).format(fmt).options(**options).save(staging)
    if fs.exists(target) or not fs.rename(make(staging), target):
        fs.delete(make(staging), True)
        raise FileExistsError(path)


def write_jsonl_shards(sharded: DataFrame, path: str, order: list[str]) -> None:
    """One gzip JSON-lines folder per ``shard``, rows in ``order``; published atomically."""
    publish(sharded.repartition("shard").sortWithinPartitions("shard", *order), path, "json", by=["shard"], compression="gzip", ignoreNullFields="false")


def fingerprint(df: DataFrame) -> DataFrame:
    """(n, digest) of a table as a multiset: equal tables agree in any row order."""
    h = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(df.columns)])
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("digest"))


def verify(written: DataFrame, read: DataFrame) -> None:
    """Raise unless a table read back is the table that was written."""
    a, b = fingerprint(written).first(), fingerprint(read).first()
    if a != b:
        raise ValueError(f"read back {b.n} rows, wrote {a.n}, or contents differ")
