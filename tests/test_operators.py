"""Boundaries, golden values, perturbation and round trips of the core operators."""

import gzip
import io
import json
import random
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import scalars as S
from tidemark.functions.clean import epoch_us, hex_ident, unit_price
from tidemark.operators import context as C
from tidemark.operators import evaluate as E
from tidemark.operators import labels as G
from tidemark.operators import ledgers as L
from tidemark.operators import metrics as M
from tidemark.operators import sequences as Q
from tidemark.operators.asof import asof_prior, fresh, prior_frame, prior_totals, with_halo
from tidemark.operators.shards import byte_shards, row_shards
from tidemark.sources import readers, sinks
from tidemark.streaming import jobs

from .conftest import rows


def _asof(spark, probes, events, **kw):
    p = spark.createDataFrame(probes, "id long, k string, t long")
    e = spark.createDataFrame(events, "k string, t long, v double, n long")
    return asof_prior(p, e, ["k"], "t", ["v", "n"], **kw)


def test_asof_earlier_equal_later(spark):
    got = _asof(spark, [(1, "a", 9), (2, "a", 10), (3, "a", 11), (4, None, 11), (5, "a", None), (6, "z", 11)], [("a", 10, 1.0, 1), ("a", 10, None, 2), ("a", None, 9.0, 9), (None, 1, 9.0, 9)], tie=["n"])
    assert {r.id: (r.prior_t, r.prior_v, r.prior_n) for r in got.collect()} == {1: (None,) * 3, 2: (None,) * 3, 3: (10, None, 2), 4: (None,) * 3, 5: (None,) * 3, 6: (None,) * 3}


@pytest.mark.parametrize("block", [3, 17, 10**6])
def test_asof_against_brute_force(spark, block):
    r = random.Random(block)
    probes = [(i, r.choice("ab"), r.randrange(-50, 100)) for i in range(300)]
    events = [(r.choice("ab"), r.randrange(-50, 100), float(i), i) for i in range(60)]
    want = {i: max(((u, v, n) for e, u, v, n in events if e == k and u < t), default=(None, None, None)) for i, k, t in probes}
    assert {x.id: (x.prior_t, x.prior_v, x.prior_n) for x in _asof(spark, probes, events, block_us=block).collect()} == want
    p, e = spark.createDataFrame(probes, "id long, k string, t long"), spark.createDataFrame(events, "k string, t long, v double, n long")
    sums = prior_totals(p, e, ["k"], "t", {"c": F.lit(1).cast("long"), "s": F.col("v")}, least={"m": F.col("t")}, block_us=block)
    own = {i: [x for x in events if x[0] == k and x[1] < t] for i, k, t in probes}
    assert {x.id: (x.c, x.s, x.m) for x in sums.collect()} == {i: (len(o), sum(x[2] for x in o), min((x[1] for x in o), default=None)) for i, o in own.items()}


def test_asof_does_not_see_the_future(spark):
    probes, events = [(i, "a", 10 * i) for i in range(30)], [("a", 7 * i, float(i), i) for i in range(20)]
    later = [("a", 1000 + i, -1.0, i) for i in range(5)]
    assert rows(_asof(spark, probes, events)) == rows(_asof(spark, probes, events + later))


def test_staleness_boundary(spark):
    got = _asof(spark, [(1, "a", 400), (2, "a", 401), (3, "b", 5)], [("a", 100, 0.5, 1)])
    v, why = fresh("prior_v", "prior_t", "t", 300)
    assert {r.id: (r.v, r.why) for r in got.select("id", v.alias("v"), why.alias("why")).collect()} == {1: (0.5, None), 2: (None, "stale"), 3: (None, "no_earlier_observation")}


def test_frames_ignore_ties(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 6)], "id long, k string, t long")
    assert rows(df.select("id", F.count("*").over(prior_frame(["k"], "t")).alias("n"))) == [(1, 0), (2, 0), (3, 2)]


@pytest.mark.parametrize("block", [1, 10, 64, 10**6])
def test_halo_frames_equal_whole_frames(spark, block):
    r = random.Random(block)
    df = spark.createDataFrame([(i, r.choice("ab"), r.randrange(-100, 200)) for i in range(300)] + [(999, None, 1), (998, "a", None)], "id long, k string, t long")
    n = lambda by: F.count("*").over(W.partitionBy(*by).orderBy("t").rangeBetween(-25, 40)).alias("n")
    got = with_halo(df, ["k"], "t", back_us=25, ahead_us=40, block_us=block).select("id", n(["k", "__b"]), "__own").where("__own").drop("__own")
    assert rows(got) == rows(df.dropna().select("id", n(["k"])))


def _inventory(spark, fills):
    df = spark.createDataFrame(fills, "k string, time_us long, side string, shares double, price double").withColumn("notional", (F.col("shares") * F.col("price")).cast("decimal(34,20)")).withColumn("shares", F.col("shares").cast("decimal(20,8)"))
    return {r.key: (r.quantity, r.cost, r.realised, r.reason) for r in M.average_cost_inventory(df, F.col("k")).collect()}


def test_inventory_golden_values(spark):
    got = _inventory(spark, [
        ("a", 1, "BUY", 10.0, 0.4), ("a", 2, "SELL", 4.0, 0.9), ("b", 1, "BUY", 1.0, 0.5), ("b", 2, "SELL", 2.0, 0.5), ("c", 1, "BUY", 2.0, 0.5), ("c", 1, "SELL", 1.0, 0.5),
        ("d", 1, "BUY", 2.0, 0.5), ("d", 1, "SELL", 1.0, 0.5), ("d", 2, "SELL", 1.0, 0.9), ("d", 3, "BUY", 5.0, 0.2),
    ])
    assert got["a"] == (6.0, pytest.approx(2.4), pytest.approx(2.0), None)
    assert got["b"] == (None, None, None, "oversold") and got["c"] == (1.0, None, None, "mixed_tie") and got["d"] == (5.0, pytest.approx(1.0), 0.0, None)
    assert _inventory(spark, []) == {}


def test_ranking_ties_golden(spark):
    df = spark.createDataFrame([(0, 0.2), (1, 0.2), (0, 0.8), (1, 0.8)], "label int, p double")
    r = E.ranking_metrics(E.score_curve(df)).first()
    assert (r.roc_auc, r.average_precision) == (0.5, 0.5)
    assert E.best_threshold(E.score_curve(df)).first().threshold == 0.2


def test_coverage_and_merge(spark):
    cover = spark.createDataFrame([("a", 0, 5), ("a", 5, 9), ("a", 12, 20), ("a", 3, 3)], "k string, start long, end long")
    merged = G.merge_intervals(cover, ["k"])
    assert rows(merged.select("k", "start", "end")) == [("a", 0, 9), ("a", 12, 20)]
    w = spark.createDataFrame([("a", 0, 9), ("a", 8, 13), ("a", 12, 15), ("b", 1, 2)], "k string, start long, end long")
    assert {(r.k, r.start): r.covered for r in G.covered(w, merged, ["k"]).collect()} == {("a", 0): True, ("a", 8): False, ("a", 12): True, ("b", 1): False}


def test_version_state_and_changes(spark):
    v = spark.createDataFrame([("s", 1, "i", 0, "x"), ("s", 2, "j", 0, "x"), ("s", 3, "i", 2, "y"), ("s", 4, "i", 1, "x"), ("s", 5, "i", 1, "z"), ("s", 5, "i", 1, "q"), ("s", 6, "i", 1, "z")], "scope string, t long, item string, rank int, title string")
    assert rows(C.running_best(v, "scope", "t", "item", "rank").select("t", "n_items", "rank_sum")) == [(1, 1, 0), (2, 2, 0), (3, 2, 2), (4, 2, 2), (5, 2, 2), (6, 2, 2)]
    assert rows(C.change_points(v.where("item = 'i'"), "item", "t", "title").select("t", "title", "conflict")) == [(1, "x", False), (3, "y", False), (4, "x", False), (5, "q", True), (6, "z", False)]


def test_evidence(spark):
    sha = "a" * 64
    df = spark.createDataFrame([([("page", sha, "https://x.org/a", 5)], sha, 5), ([("page", sha, "https://x.org/a", 6)], sha, 5), ([("page", sha, "ftp://x", 1)], sha, 5), ([], sha, 5), ([("blog", sha, "https://x.org", 1)], sha, 5)], "e array<struct<kind string, sha string, url string, captured_us long>>, c string, u long")
    assert [r[0] for r in df.select(C.evidence_valid(F.col("e"), ["page"], F.col("c"), F.col("u"))).collect()] == [True, False, False, False, False]


def test_thresholds_are_exclusive(spark):
    df = spark.createDataFrame([(w, i) for w, n in (("a", 19), ("b", 20), ("c", 21), ("d", 1)) for i in range(n)], "w string, i int")
    assert {r.w for r in L.below_threshold(df, ["w"], 20).select("w").distinct().collect()} == {"a", "d"}


def test_multisets(spark):
    a, b = (spark.createDataFrame(x, "k string") for x in ([("x",), ("x",), (None,)], [("x",), (None,), (None,)]))
    assert rows(L.multiset_excess(a, b, ["k"])) == [("x", 2, 1)]
    assert rows(L.multiset_equal(a, b)) == [(1, 1)] and rows(L.multiset_equal(a, a)) == [(0, 0)]


def test_scalars(spark):
    df = spark.createDataFrame([("2026-06-01T00:00:00Z", "1.50"), ("2026-06-01T02:00:00.5+02:00", "1e2"), ("2026-06-01T00:00:00", "-0"), ("x", ".5"), (None, None)], "t string, d string")
    got = df.select(S.instant_us(F.col("t")), S.decimal_text(F.col("d")), S.iso_utc(S.instant_us(F.col("t")))).collect()
    u = 1_780_272_000_000_000
    assert [tuple(r) for r in got] == [(u, "1.5", "2026-06-01T00:00:00Z"), (u + 500_000, "100", "2026-06-01T00:00:00.500000Z"), (None, "0", None), (None, "0.5", None), (None, None, None)]
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(epoch_us(F.lit(x))) for x in (1_700_000_000, 1_700_000_000_000, 1_700_000_000_000_000)] == [1_700_000_000_000_000] * 3
    assert [one(unit_price(F.lit(x))) for x in (" .5 ", "1", "1.01", "-0.2", "NaN", "n/a", "", "0.")] == [0.5, 1.0, None, None, None, None, None, 0.0]
    assert [one(hex_ident(F.lit(x))) for x in ("0xAB ", "0x00", "", "0x")] == ["ab", None, None, None]
    assert [int(one(S.significant(F.lit(x).cast("long"), 4))) for x in (123456, -123456, 12345, 12355, -12345, 7, 0)] == [123500, -123500, 12340, 12360, -12340, 7, 0]
    assert one(S.sigmoid_difference(F.lit(-1e9), F.lit(0.0))) == 0
    assert one(S.canonical_url(F.lit("HTTPS://X.org/a?b=2&a=1#f"))) == "https://x.org/a?a=1&b=2"
    assert one(S.page_title(F.lit("<title>A &amp; B</title><TITLE> A & B </TITLE>"))) == "A & B" and one(S.page_title(F.lit("<title>a</title><title>b</title>"))) is None
    assert one(S.uint256_hex(F.lit("255"))) == f"{255:064x}" and one(S.uint256_hex(F.lit("x"))) is None
    assert one(S.fold_text(F.lit("  Čafé—Straße "))) == "cafe strasse" and one(S.sha1_base32(F.lit(""))) == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert [one(S.strict_json(F.lit(x))) for x in ('{"a": 1}', '{"a": 1, "a": 2}', '{"a": NaN}', "[1]", "{")] == [True, False, False, False, False]
    assert one(S.single_clause(F.lit("One. It resolves at noon. Two."), "resolves", 400)) == "It resolves at noon."
    assert one(S.hex_word(F.lit("0x" + "ab" * 32 + "cd" * 32), 1)) == "cd" * 32


def test_chunks_and_deltas(spark):
    df = spark.createDataFrame([("a", i, 4) for i in range(5)] + [("b", 0, 99), ("b", 1, 1)], "k string, t long, c long")
    assert rows(Q.budget_chunks(df, "k", ["t"], "c", 10).select("k", "t", "chunk")) == [("a", 0, 0), ("a", 1, 0), ("a", 2, 1), ("a", 3, 1), ("a", 4, 2), ("b", 0, 0), ("b", 1, 1)]
    d = spark.createDataFrame([("a", 0, "x"), ("a", 5, "y"), ("a", 16, "x")], "k string, t long, m string")
    assert rows(Q.delta_context(d, "k", ["t"], "m", 10, "t").select("t", "added", "n_expired", "n_watched")) == [(0, True, 0, 1), (5, True, 0, 2), (16, True, 2, 1)]


def test_shards_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("w"))
    a, b = (rows(row_shards(df.repartition(n), ["id"], 64)) for n in (1, 5))
    assert a == b and a[0] == (0, 0, 1, 1) and max(r[2] for r in a) == 16
    want, before = {}, 0
    for i in range(1000):
        want[before // 100] = want.get(before // 100, 0) + i % 7
        before += i % 7
    assert rows(byte_shards(df.repartition(3), ["id"], F.col("w"), 100).groupBy("shard").agg(F.sum("w"))) == sorted(want.items())


def test_readers_and_sinks(spark, tmp_path):
    p = tmp_path / "a.jsonl.gz"
    p.write_bytes(gzip.compress(b'{"a": 1}\n\n{"a": 2}\n'))
    assert rows(readers.read_jsonl(spark, str(p), "a long")) == [(1,), (2,)]
    (tmp_path / "b.jsonl").write_text('{"a": 1, "a": 2}\n')
    with pytest.raises(Exception, match="strict"):
        readers.read_jsonl_strict(spark, str(tmp_path / "b.jsonl"), "a long").collect()
    (tmp_path / "c.csv").write_text("Wallet,n\nx,1\n")
    r = readers.project_aliases(readers.read_rows(spark, str(tmp_path / "c.csv")), {"wallet": ["proxy", "wallet"], "memo": ["memo"]})
    assert rows(r) == [("x", None)]
    (tmp_path / "d.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    assert readers.read_rows(spark, str(tmp_path / "d.json")).count() == 2
    out = str(tmp_path / "out")
    df = spark.range(10)
    sinks.publish(df, out)
    sinks.verify(df, spark.read.parquet(out))
    with pytest.raises(FileExistsError):
        sinks.publish(df, out)
    with pytest.raises(ValueError):
        sinks.verify(df, spark.range(9))
    assert readers.exactly_one(df, F.col("id") == 3).count() == 1
    with pytest.raises(Exception, match="exactly one"):
        readers.exactly_one(df, F.col("id") > 3).collect()


def test_sqlite_and_zipped_tsv(spark, tmp_path):
    db = str(tmp_path / "t.db")
    with sqlite3.connect(db) as c:
        c.execute("CREATE TABLE trades (condition_id TEXT, n INTEGER)")
        c.executemany("INSERT INTO trades VALUES (?, ?)", [(f"c{i % 3}", i) for i in range(100)])
    t = readers.read_sqlite(spark, db, "trades", "condition_id string, n long")
    assert t.count() == 100 and t.where("condition_id = 'c1'").agg(F.sum("n")).first()[0] == sum(range(1, 100, 3))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("x.tsv", b"a\tb\nc\n\xff\td\n")
    (tmp_path / "z.zip").write_bytes(buffer.getvalue())
    got = readers.zipped_tsv(spark, str(tmp_path / "z.zip"), 2).orderBy("line").collect()
    assert [(r.fields, r.error) for r in got] == [(["a", "b"], None), (None, "columns"), (None, "encoding")]


def test_capture_index_and_schedule(spark):
    lines = spark.createDataFrame([("k 20260101000000 u text/html 200 " + "A" * 32,), ("k 20250101000000 u text/html 200 " + "A" * 32,), ("k 20260101000000 u text/html 404 " + "B" * 32,), ("junk",)], "value string")
    assert rows(readers.cdx_rows(lines, "20270101000000")) == [("u", "A" * 32, "20250101000000")]
    assert [r.stamp for r in readers.batch_schedule(spark, 1, 2_700_000_001).orderBy("batch_us").collect()] == ["19700101001500", "19700101003000", "19700101004500"]


def test_stream_equals_batch(spark, data):
    s = jobs.stream_table(spark, data, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    got = jobs.drain(jobs.tumbling_counts(s, "ts", "1 day", "0 seconds", ["event_type"]), "t", mode="complete").select("window.start", "event_type", "n")
    e = spark.read.parquet(f"{data}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    assert rows(got) == rows(e.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n")).select("window.start", "event_type", "n"))


def test_stream_single_deliveries(spark, tmp_path):
    for k, part in enumerate(([("m1", 10), ("m1", 12), ("m2", 13)], [("m2", 15), ("m3", 16)])):
        spark.createDataFrame(part, "m string, sec long").coalesce(1).write.parquet(f"{tmp_path}/{k}")
    s = spark.readStream.schema("m string, sec long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/*").select("m", F.timestamp_seconds("sec").alias("ts"))
    assert sorted(r.m for r in jobs.drain(jobs.single_deliveries(s, "m", "ts", "1 hour"), "d").collect()) == ["m1", "m2", "m3"]


def test_stream_inventory_equals_fold(spark, tmp_path):
    r = random.Random(1)
    fills = [(r.choice("ab"), r.randrange(1, 40), r.choice(["BUY", "BUY", "BUY", "SELL"]), 1.0, 0.5) for _ in range(60)]
    spark.createDataFrame(sorted(fills, key=lambda x: x[1]), "key string, sec long, side string, shares double, price double").coalesce(1).write.parquet(f"{tmp_path}/0")
    spark.createDataFrame([("z", 9999, "BUY", 1.0, 0.5)], "key string, sec long, side string, shares double, price double").coalesce(1).write.parquet(f"{tmp_path}/1")
    s = spark.readStream.schema("key string, sec long, side string, shares double, price double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/*").select("key", F.timestamp_seconds("sec").alias("ts"), "side", "shares", "price")
    got = jobs.drain(jobs.running_inventory(s, "0 seconds"), "i").groupBy("key").agg(F.max_by("quantity", "time_us").alias("q"))
    want = _inventory(spark, fills)
    assert {x.key: x.q for x in got.collect() if x.key != "z"} == {k: v[0] for k, v in want.items()}
