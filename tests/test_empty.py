"""Every query on empty tables, and on tables of nulls beside the keys."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

KEYS = {"trade_row_id", "record_id", "doc_id", "item_id", "point_id", "source_page_id"}


@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_all_queries(spark, data, tmp_path, kind):
    for p in Path(data).glob("*.parquet"):
        d = spark.read.parquet(str(p))
        if kind == "empty":
            d = d.limit(0)
        else:
            d = d.select(*[F.col(c) if c in KEYS else F.lit(None).cast(d.schema[c].dataType).alias(c) for c in d.columns]).limit(50)
        d.write.parquet(f"{tmp_path}/{p.name}")
    for name, query in entry.queries().items():
        query(spark, str(tmp_path)).collect()
