"""Queries do the whole job: every spelling, every interval, every row."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import labels, shards
from tidemark.plans import context

from .conftest import rows


def _write(df, root, name):
    df.write.mode("overwrite").parquet(f"{root}/{name}.parquet")


def test_every_spelling_of_a_split(spark, tmp_path):
    spelled = [("0xA1", "Training "), ("a1", "dev"), ("b2", " VAL"), ("b2", "valid\t"), ("b2", "Validation"), ("b2", "DEV"), ("c3", "quarantine"), ("c3", "test"), ("d4", "dev"), ("d4", None), ("e5", "trial"), ("e5", "train")]
    _write(spark.createDataFrame([(t, s, "f", "s") for t, s in spelled], "tx string, split string, fixture_id string, source string"), tmp_path, "transactions")
    q = entry.queries()
    assert rows(q["cross_split_keys"](spark, str(tmp_path))) == [("a1", 2)]
    got = {r.what: (r.n_keys, r.n_shared) for r in q["split_disjointness"](spark, str(tmp_path)).collect()}
    assert got == {"tx": (5, 1), "fixture": (1, 1), "source": (1, 1)}


def test_every_interval_covers(spark, tmp_path):
    h = context.HOUR
    # three clicks, starts of every remainder by three, and a view late in the twelve hours of each
    e = [(3 * i + k, f"u{i}", kind, 1_700_000_000_000_000 + i + (9 * h if k else 0)) for i in range(6) for k, kind in enumerate(["click", "view"])] + [(99, "u0", "view", 1_700_000_000_000_000 + 11 * h)]
    df = spark.createDataFrame(e, "event_id long, user_id string, event_type string, us long")
    _write(df.select("event_id", "user_id", "event_type", F.lit(1.0).alias("value"), F.timestamp_micros("us").cast("timestamp_ntz").alias("ts")), tmp_path, "events")
    got = {r.window_id: r.status for r in entry.queries()["occurrence_labels"](spark, str(tmp_path)).collect()}
    assert got == {3 * i + 1: "NO_OBSERVED_TRADE" for i in range(6)} | {99: "CENSORED"}


def test_gaps_of_coverage_censor(spark):
    h = context.HOUR
    w = spark.createDataFrame([(1, "u", 0, 2 * h), (2, "u", h, 3 * h), (3, "u", 4 * h, 6 * h), (4, "v", 0, 2 * h)], "window_id long, user_id string, start long, end long")
    a = spark.createDataFrame([], "user_id string, action_id long, t long, role string")
    c = spark.createDataFrame([("u", 0, h), ("u", h, 2 * h), ("u", 3 * h, 6 * h)], "user_id string, start long, end long")
    got = {r.window_id: r.status for r in labels.occurrence(w, a, c, ["user_id"], horizon_us=2 * h).collect()}
    assert got == {1: "NO_OBSERVED_TRADE", 2: "CENSORED", 3: "NO_OBSERVED_TRADE", 4: "CENSORED"}


@pytest.mark.parametrize(("name", "read"), [("stream_windows", "events"), ("stream_sessions", "events"), ("stream_inventory", "orders")])
def test_streams_of_many_unordered_files(spark, data, tmp_path, name, read):
    _write(spark.read.parquet(f"{data}/{read}.parquet").repartition(24, F.rand(7)), tmp_path, read)
    query = entry.queries()[name]
    assert rows(query(spark, str(tmp_path))) == rows(query(spark, data))


def test_actors_without_an_event_type_have_a_row(spark, tmp_path):
    e = [("a", "1", "0xC", 5, "BUY", "2", "0.5"), (" B", "2", "c", 6, None, "2", "0.5"), ("b", "3", None, 7, "SELL", "2", "0.5"), ("d", "4", "c", 8, "hold", "2", "0.5"), ("", "5", "c", 9, "BUY", "2", "0.5"), (None, "6", "c", 9, "BUY", "2", "0.5")]
    schema = "actor string, execution_id string, condition_id string, time_us long, side string, shares string, price string"
    _write(spark.createDataFrame(e, schema), tmp_path, "executions")
    query, none = entry.queries()["p3_features"], f"0,,0.{'0' * 8},0.{'0' * 20}"
    assert rows(query(spark, str(tmp_path))) == [("a", 1, f"1,5,2.{'0' * 8},1.{'0' * 20}"), ("b", 1, none), ("d", 1, none)]
    _write(spark.createDataFrame(e[1:4], schema), tmp_path, "executions")
    assert rows(query(spark, str(tmp_path))) == [("b", 0, ""), ("d", 0, "")]


@pytest.mark.parametrize("parts", [1, 5])
def test_positions_over_all_rows(spark, parts):
    a, b, c = [(i, i % 7) for i in range(0, 200, 2)], [(i, i % 7 if i % 5 else None) for i in range(0, 210, 2)], [(i, 0) for i in range(50, 90)]
    frame = lambda x: spark.createDataFrame(x, "k long, v long").repartition(parts)
    got = shards.positional_zip(frame(a), frame(b), ["k"], ["k", "v"])
    want = [(i + 1, a[i] if i < len(a) else None, b[i], i < len(a) and a[i] == b[i]) for i in range(len(b))]
    plain = [(r.row, r.first and tuple(r.first), tuple(r.second), r.equal) for r in got.select("row", "first", "second", "equal").orderBy("row").collect()]
    assert plain == want
    merged = shards.ordered_merge([frame(a), frame(c), frame(b)], ["k"]).orderBy("row").collect()
    assert [(r.k, r.source) for r in merged] == sorted([(k, 0) for k, _ in a] + [(k, 1) for k, _ in c] + [(k, 2) for k, _ in b])
    assert [r.row for r in merged] == list(range(1, len(merged) + 1))
