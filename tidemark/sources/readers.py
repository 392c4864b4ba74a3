"""Readers: JSON lines, CSV, JSON arrays, TSV archives, SQLite, aliases, schedules."""

from __future__ import annotations

import io
import itertools
import sqlite3
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from pyspark.sql.types import StructType

from tidemark.functions.scalars import strict_json


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines, gzip by suffix; blank lines are skipped, anything malformed fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines in which repeated keys, NaN and blank lines are errors."""
    lines = spark.read.text(path)
    good = F.coalesce(strict_json("value"), F.lit(False))
    checked = F.when(good, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a strict JSON object: "), F.substring("value", 1, 80))))
    return lines.select(F.from_json(checked, schema).alias("r")).select("r.*")


def read_rows(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV, JSON lines, JSON array or Parquet, by suffix; ``.gz`` is read through."""
    name = path.removesuffix(".gz").rstrip("/").lower()
    reader = spark.read.schema(schema) if schema else spark.read
    if name.endswith(".csv"):
        return reader.option("header", True).csv(path)
    if name.endswith(".tsv"):
        return reader.option("header", True).option("sep", "\t").csv(path)
    if name.endswith((".jsonl", ".ndjson")):
        return reader.json(path)
    if name.endswith(".json"):
        return reader.option("multiLine", True).json(path)
    if name.endswith(".orc"):
        return reader.orc(path)
    return reader.parquet(path)


def project_aliases(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """One column per name: the first non-null of its spellings, as text; null where none exists."""
    have = {c.lower(): c for c in df.columns}

    def pick(names: list[str]) -> Column:
        found = [F.col(f"`{have[n.lower()]}`").cast("string") for n in names if n.lower() in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    return df.select(*[pick(names).alias(name) for name, names in aliases.items()])


def exactly_one(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that match; none or several make the read fail."""
    n = df.where(condition).agg(F.count("*")).scalar()
    return df.where(condition).withColumn("__n", n).where(F.when(F.col("__n") == 1, True).otherwise(F.raise_error(F.lit("not exactly one match")).cast("boolean"))).drop("__n")


def cdx_rows(lines: DataFrame, cutoff: str) -> DataFrame:
    """Capture index lines (value): good status and type, before the cut-off, one row a digest."""
    p = F.split("value", " ")
    rows = lines.select(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(("key", "stamp", "url", "mime", "status", "digest"))])
    good = rows.where(F.col("stamp").rlike("^[0-9]{14}$") & (F.col("status") == "200") & F.col("mime").isin("text/html", "application/json") & F.col("digest").rlike("^[A-Z2-7]{32}$") & (F.col("stamp") < cutoff))
    return good.groupBy("url", "digest").agg(F.min("stamp").alias("stamp"))


def batch_schedule(spark: SparkSession, start_us: int, end_us: int, minutes: int = 15) -> DataFrame:
    """Stamps of batches from start to before end, on multiples of ``minutes``."""
    step = minutes * 60_000_000
    first = -(-start_us // step) * step
    df = spark.range(max(0, -(-(end_us - first) // step))).select((F.lit(first) + F.col("id") * step).alias("batch_us"))
    return df.withColumn("stamp", F.date_format(F.timestamp_micros("batch_us"), "yyyyMMddHHmmss"))


def _unzip(columns: int, most: int):
    kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.string()]

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for name in z.namelist():
                if z.getinfo(name).file_size > most:
                    raise ValueError(f"{path}: {name} is too large")
                with z.open(name) as lines:
                    for i, raw in enumerate(lines):
                        try:
                            fields = raw.decode("utf-8").rstrip("\r\n").split("\t")
                            yield (path, i, fields, None) if len(fields) == columns else (path, i, None, "columns")
                        except UnicodeDecodeError:
                            yield path, i, None, "encoding"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                lines = rows(path, content)
                while part := list(itertools.islice(lines, 5000)):
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*part), kinds)], ["path", "line", "fields", "error"])

    return run


def zipped_tsv(spark: SparkSession, path: str, columns: int, *, most: int = 1 << 30) -> DataFrame:
    """Lines of zipped TSV files; broken ones are kept with the reason. A member is streamed, 5,000 lines at once."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_unzip(columns, most), "path string, line long, fields array<string>, error string")


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int) -> None:
        super().__init__((lo, hi))


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.path, self.name, self.parts, self.equal = schema, options["path"], options["table"], int(options.get("partitions", 4)), []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and isinstance(f.value, str | int | float):
                self.equal.append((f.attribute[0], f.value))
            else:
                yield f

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._open() as c:
            lo, hi = c.execute(f'SELECT min(rowid), max(rowid) FROM "{self.name}"').fetchone()
        if lo is None:
            return [_Range(0, -1)]
        step = -(-(hi - lo + 1) // self.parts)
        return [_Range(a, min(a + step - 1, hi)) for a in range(lo, hi + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        cols = ", ".join(f'"{c}"' for c in self.schema.names)
        where = "".join(f' AND "{c}" = ?' for c, _ in self.equal)
        with self._open() as c:
            yield from c.execute(f'SELECT {cols} FROM "{self.name}" WHERE rowid BETWEEN ? AND ?{where}', (*partition.value, *[v for _, v in self.equal]))


class SqliteSource(DataSource):
    """``spark.read.format("sqlite").schema(...).options(path=, table=)``; equality filters are pushed down."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(schema, self.options)


def read_sqlite(spark: SparkSession, path: str, table: str, schema: str, *, partitions: int = 4) -> DataFrame:
    """A table of a SQLite file on storage that all executors see, split by row id."""
    if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") != "true":
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").schema(schema).options(path=path, table=table, partitions=partitions).load()
