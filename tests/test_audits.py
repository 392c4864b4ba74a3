"""Audits, sequential choices, strict answers, screens, relevance, scratch tables and streams that close."""

import json
import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions import scalars as S
from tidemark.operators import audits as A
from tidemark.operators import evaluate as E
from tidemark.operators import relevance as R
from tidemark.operators.asof import prior_totals
from tidemark.operators.delivery import possible_repeats
from tidemark.operators.screen import screened
from tidemark.streaming import jobs

from .conftest import rows


def _turns(by_bucket, budget):
    queues, used, out = {b: sorted(c)[::-1] for b, c in sorted(by_bucket.items())}, 0, []
    while any(queues.values()) and used < budget:
        for b, q in queues.items():
            while q:
                rank, cost = q.pop()
                if used + cost <= budget:
                    used += cost
                    out.append((b, rank, cost))
                    break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_balanced_choice_against_the_plain_loop(spark, seed):
    r = random.Random(seed)
    data = {b: [(i, r.choice([1, 2, 3, 7, 30, 500])) for i in range(r.randrange(60))] for b in "abcd"}
    df = spark.createDataFrame([(b, i, c) for b, x in data.items() for i, c in x], "b string, i long, c long")
    got = [(x.bucket, x.rank, x.cost) for x in A.balanced_choice(df, "b", "i", "c", 60).orderBy("place").collect()]
    assert got == _turns(data, 60) and sum(c for _, _, c in got) <= 60
    assert A.balanced_choice(df.limit(0), "b", "i", "c", 60).count() == 0


def test_unreused_choice_against_the_plain_loop(spark):
    r = random.Random(3)
    data = [(f"g{r.randrange(12):02}", f"t{r.randrange(15)}", r.randrange(50)) for _ in range(200)]
    df = spark.createDataFrame(data, "g string, x string, p long").withColumn("o", F.length("g"))
    want, taken = {}, set()
    for g in sorted({d[0] for d in data}):
        for p, x in sorted({(min(p for h, y, p in data if (h, y) == (g, z)), z) for h, z, _ in data if h == g}):
            if x not in taken:
                taken.add(x)
                want[g] = x
                break
    assert {x.group: x["item"] for x in A.unreused_choice(df, "g", ["o", "g"], "x", ["p"]).collect()} == want


def test_answers_are_parsed_strictly(spark):
    one = {"side": "BUY", "outcome": "Yes", "shares": "2", "price": "0.5"}
    texts = {
        json.dumps({"action": "NO_TRADE"}): 0, json.dumps({"action": "TRADE", "trades": [one, one]}): 2, json.dumps({"action": "TRADE", "trades": []}): None, json.dumps({"action": "TRADE", "trades": [one] * 20}): 20, json.dumps({"action": "TRADE", "trades": [one] * 21}): None,
        json.dumps({"action": "TRADE", "trades": [one], "note": 1}): None, json.dumps({"action": "NO_TRADE", "trades": []}): None, json.dumps({"action": "TRADE", "trades": [one | {"price": "1.5"}]}): None, json.dumps({"action": "TRADE", "trades": [one | {"x": 1}]}): None,
        json.dumps({"action": "TRADE", "trades": [one | {"side": "buy"}]}): None, json.dumps({"action": "TRADE", "trades": [one | {"shares": 0}]}): None, json.dumps({"action": "TRADE", "trades": [one | {"shares": 3, "price": 1}]}): 1, "not json": None, "[]": None, "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    assert {x.t: x.n for x in df.select("t", A.parsed_answer(F.col("t")).alias("n")).collect()} == texts | {None: None}


def test_protocol_errors(spark):
    good = [("a", "wait", None, 5, 0), ("a", "act", 5, 5, 2), ("a", "wait", 5, 9, 0), ("a", "act", 9, 9, 1)]
    run = lambda x: {r.code: r.n for r in A.protocol_errors(spark.createDataFrame(x, "k string, kind string, start_us long, end_us long, n long"), "k", ["end_us", F.desc("kind")]).collect() if r.n}
    assert run(good) == {}
    assert run([good[0], ("a", "act", 5, 5, 0)]) == {"act_without_actions": 1}
    assert set(run([("a", "wait", 1, 5, 3), good[1]])) == {"first_wait_has_start", "wait_with_actions"}
    assert "wait_starts_elsewhere" in run([*good[:2], ("a", "wait", 6, 9, 0), good[3]])


def test_stop_after_two_old_pages(spark):
    df = spark.createDataFrame([("s", i, o) for i, o in enumerate([0, 1, 0, 1, 1, 0, 1, 1])] + [("t", 0, 1)], "s string, i long, o int")
    assert rows(A.stop_after_old(df, ["s"], ["i"], F.col("o") == 1).select("s", "i")) == [("s", i) for i in range(5)] + [("t", 0)]


def test_both_ways_counts_repeats(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "x long") for v in ([1, 1, 2], [1, 2, 3]))
    assert tuple(A.both_ways(a, b).first()) == (3, 1, 1)


def test_screen_drops_no_partner(spark):
    a, b = spark.range(0, 3000).withColumn("__slot", F.lit(1)), spark.range(0, 3000, 7)
    for bits in (6, 10, 26):
        got = {r.id for r in screened(a, F.col("id"), b, F.col("id"), bits=bits).collect()}
        assert {r.id for r in b.collect()} <= got and (bits < 26 or len(got) < 600)
    assert screened(a, F.col("id"), b.limit(0), F.col("id")).count() == 0


def test_bloom_screen_names_every_bucket_of_a_repeat(spark):
    data = [(b, h) for b, h in [(1, 10), (2, 10), (3, 11), (1, 12), (1, 12), (-1, 13), (5, 13)] + [(9, 100 + i) for i in range(500)]]
    df = spark.createDataFrame(data, "bucket long, h long")
    got = {tuple(r) for r in possible_repeats(df, {b: sum(x == b for x, _ in data) for b, _ in data}, shards=3).collect()}
    assert {(1, 10), (2, 10), (1, 12), (-1, 13), (5, 13)} <= got and (3, 11) not in got and len(got) < 12


def test_teams_of_several_words_aliases_and_null_columns(spark):
    teams = spark.createDataFrame([("spain",), ("south korea",), ("ivory coast",)], "team string")
    h = spark.createDataFrame([(1, "spain beat korea republic", None), (2, "cote d ivoire in spain", "u"), (3, "south of korea", "u"), (4, "", None)], "id long, words string, url string")
    got = {r.id: r.found for r in R.mentioned_teams(h, "id", "words", teams).collect()}
    assert got == {1: ["south korea", "spain"], 2: ["ivory coast", "spain"], 3: [], 4: []}


def test_pair_patterns(spark):
    f = spark.createDataFrame([("f1", ["ivory coast", "spain"], "ivory coast|spain"), ("f2", ["peru", "spain"], "peru|spain"), ("f3", ["peru", "spain"], "peru|spain")], "fixture string, teams array<string>, pair string")
    p = {r.fixture: (r.pattern, r.ambiguous) for r in R.pair_patterns(f).collect()}
    hit = lambda text: spark.range(1).select(F.lit(text).rlike(p["f1"][0])).first()[0]
    assert [hit(t) for t in ("spain face ivory coast today", "how cote d ivoire can beat spain", "ivory coast vs spain", "ivory coast and spain")] == [True, True, True, False]
    assert not p["f1"][1] and p["f2"][1] and p["f3"][1]


@pytest.mark.parametrize("block", [3, 50, 10**9])
def test_latest_values_and_sums_together(spark, block):
    r = random.Random(block)
    ev = [(r.choice("ab"), r.randrange(100), r.randrange(5), r.choice([None, f"v{i:03}"])) for i in range(120)]
    pr = [(i, r.choice("abc"), r.randrange(110)) for i in range(60)]
    got = prior_totals(spark.createDataFrame(pr, "id long, k string, t long"), spark.createDataFrame(ev, "k string, t long, n long, v string"), ["k"], "t", {"s": F.col("n")}, last={"x": F.col("v")}, block_us=block)
    for x in got.collect():
        own = [(t, v) for k, t, _, v in ev if k == x.k and t < x.t and v is not None]
        assert x.s == sum(n for k, t, n, _ in ev if k == x.k and t < x.t) and x.x == (max(own)[1] if own else None)


def test_late_rows_go_to_a_side_output(spark, tmp_path):
    for i, secs in enumerate([[10, 20], [5, 30, 19], [1, 40]]):
        spark.createDataFrame([(i, s) for s in secs], "b long, s long").coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    files = sorted(Path(f"{tmp_path}/in").glob("part-*"), key=lambda p: p.stat().st_mtime)
    for i, p in enumerate(files):
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    s = spark.readStream.schema("b long, s long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").withColumn("ts", F.timestamp_seconds("s"))
    got = {(r.s, r.late) for r in jobs.late_rows(s, "ts", 4_000_000).collect()}
    assert got == {(10, False), (20, False), (5, True), (30, False), (19, False), (1, True), (40, False)}


def test_scratch_is_deleted_on_request_and_after_the_session(spark, tmp_path):
    a, b = session.materialize(spark.range(3), "a"), session.materialize(spark.range(4), "b")
    where = a.inputFiles()[0].removeprefix("file://")
    session.discard(a)
    assert not Path(where).exists() and b.count() == 4
    code = f"""
import sys; sys.path.insert(0, {str(Path(session.__file__).parents[1])!r})
from pyspark.sql import SparkSession
from tidemark import session
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
session.materialize(s.range(5), "x"); name = session.share_file(s, "f", b"abc")
from pyspark import SparkFiles
assert open(SparkFiles.get(name), "rb").read() == b"abc"
s.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, capture_output=True)
    assert not list(Path(f"{tmp_path}/shared").glob("tidemark-*"))


def test_a_drained_stream_goes_on_where_it_stopped(spark, tmp_path):
    add = lambda *x: spark.createDataFrame([(i,) for i in x], "i long").coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    stream = lambda: spark.readStream.schema("i long").parquet(f"{tmp_path}/in")
    add(1, 2)
    assert rows(jobs.drain(stream(), "s", base=f"{tmp_path}/base")) == [(1,), (2,)]
    add(3)
    assert rows(jobs.drain(stream(), "s", base=f"{tmp_path}/base")) == [(1,), (2,), (3,)]


def test_open_sessions_end_with_the_table(spark, tmp_path):
    import __spark_entry__ as entry

    e = [(1, "u", 0), (2, "u", 3600), (3, "v", 9000), (4, None, 9000)]
    df = spark.createDataFrame(e, "event_id long, user_id string, s long").select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", F.lit("view").alias("event_type"), F.lit(1.0).alias("value"))
    df.write.parquet(f"{tmp_path}/events.parquet")
    got = {(r.user_id, r.n) for r in entry.queries()["stream_sessions"](spark, str(tmp_path)).collect()}
    assert {("u", 2), ("v", 1)} <= got


def test_headlines_of_pages(spark):
    pages = {
        '<title>A b</title><meta property="og:title" content="A b"/>': ("A b", None), "<title>A b</title>": ("A b", None), '<meta property="og:title" content="A &amp; b"/>': ("A & b", None), '<title>A b | Site</title><meta property="og:title" content="A b"/>': ("A b", None),
        '<title>Other</title><meta property="og:title" content="A b"/>': (None, "titles_disagree"), '<meta property="og:title" content="A"/><meta property="og:title" content="B"/>': (None, "several_og_titles"), "<title>Just a moment</title>": (None, "interstitial"), "<p>x": (None, "no_single_title"), "": (None, "no_single_title"),
    }
    df = spark.createDataFrame([(p,) for p in pages], "p string")
    assert {r.p: (r.h.headline, r.h.reason) for r in df.select("p", S.page_headline(F.col("p")).alias("h")).collect()} == pages


def test_a_goal_kick_is_no_goal(spark):
    kinds = ["goal", "goal-kick", "goal---header", "own-goal", "penalty---scored", "penalty---missed", "yellow-card", "corner-kick", None]
    df = spark.createDataFrame([(k,) for k in kinds], "k string")
    hits = lambda c: [r.k for r in df.where(S.kind_matches(F.col("k"), c)).collect()]
    assert hits("goal") == ["goal", "goal---header", "own-goal", "penalty---scored"] and hits("card") == ["yellow-card"] and hits("corner") == ["corner-kick"]


def test_request_addresses(spark):
    m = F.create_map(F.lit("b"), F.lit("x y"), F.lit("a"), F.lit("True"), F.lit("c"), F.lit(None).cast("string"))
    assert spark.range(1).select(S.request_url(F.lit("https://h/p"), m)).first()[0] == "https://h/p?a=true&b=x+y"


def test_poisson_bootstrap_covers_the_mean(spark):
    c = spark.createDataFrame([(i, (i % 7) - 3, 1) for i in range(400)], "g long, total long, n long")
    m = sorted(r.mean for r in E.cluster_bootstrap(c, 400).collect())
    mean, sd = sum((i % 7) - 3 for i in range(400)) / 400, 2.0 / 20
    assert len(m) == 400 and abs(sum(m) / 400 - mean) < sd / 4 and abs((m[389] - m[10]) / (2 * 1.96 * sd) - 1) < 0.25


def test_fitted_line(spark):
    r = random.Random(2)
    data = [(v := r.randrange(50), h := r.randrange(24), 3 * v - 2 * h + 7) for _ in range(80)]
    s = spark.createDataFrame(data, "v long, h long, y long").agg(F.count("*").alias("n"), *[F.sum(F.expr(e)).alias(k) for k, e in {"v": "v", "h": "h", "y": "y", "vv": "v*v", "hh": "h*h", "vh": "v*h", "vy": "v*y", "hy": "h*y"}.items()])
    got = s.select(*E.fitted_line(F.col("n"), {k: F.col(k) for k in ("v", "h", "y", "vv", "hh", "vh", "vy", "hy")})).first()
    assert tuple(got) == pytest.approx((7, 3, -2))
