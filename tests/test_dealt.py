"""Feature table, repeated deliveries and attributes at event time."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions.clean import ident
from tidemark.operators.delivery import BloomFilter, repeated_rows
from tidemark.operators.features import clean_executions, entity_features, typed_totals
from tidemark.operators.versions import version_join

from .conftest import rows

EXEC = "actor string, execution_id string, condition_id string, time_us long, known_us long, side string, shares string, price string, type string"


def _features(spark, data):
    t = typed_totals(clean_executions(spark.createDataFrame(data, EXEC)), "actor", "type", "execution")
    return {r.actor: [(f.n, f.last_us, float(f.shares), float(f.notional)) for f in r.features] for r in entity_features(t, "actor", "type").collect()}


def test_features_repeats_ties_nulls(spark):
    data = [
        ("A ", "1", "0xC1", 5, 5, "buy", "2", "0.5", "x"), ("a", "1", "c1", 5, 5, "BUY", "2", "0.5", "y"),  # one execution, two spellings
        ("a", "2", "c1", 5, 5, "BUY", "-1", "0.5", None),  # counts, adds nothing
        ("a", "3", "c2", None, 5, "SELL", "3", "0.1", None), ("b", "1", "c1", 9, 9, "BUY", "1e400", "NaN", None),
        (None, "9", "c1", 1, 1, "BUY", "1", "0.1", None), ("c", "1", None, 1, 1, "BUY", "1", "0.1", None), ("c", "2", "c1", 1, 1, "HOLD", "1", "0.1", None),
        ("d", None, "c1", 4, 4, "BUY", "1", "1", None), ("d", None, "c1", 4, 4, "BUY", "1", "1", None), ("d", None, "c1", 5, 4, "BUY", "1", "1", None),
    ]
    got = _features(spark, data)
    none = (0, None, 0.0, 0.0)
    assert got == {"a": [(2, 5, 2.0, 1.0), (1, None, 3.0, 0.3)], "b": [(1, 9, 0.0, 0.0), none], "d": [(2, 5, 2.0, 2.0), none]}


def test_features_empty(spark):
    assert _features(spark, []) == {}


def test_bloom_has_no_false_negatives():
    ids = np.random.default_rng(1).integers(0, 2**63, 50_000).astype(np.uint64)
    f = BloomFilter(50_000)
    for part in np.array_split(ids, 7):
        f.add(f.probes(part))
    assert f.has(f.probes(ids)).all()
    other = np.random.default_rng(2).integers(0, 2**63, 50_000).astype(np.uint64)
    assert f.has(f.probes(other)).mean() < 0.001


ROWS = "rid long, m string, page long, line long, day int, h long, bucket long, n long"


def _gone(spark, data):
    df = spark.createDataFrame([(*r, 0, 0, 0) for r in data], ROWS)
    return {r.rid for r in repeated_rows(df, "rid", ident(F.col("m")), [F.col("page"), F.col("line")], F.col("day")).collect()}


def _brute(data):
    first, gone = {}, set()
    for rid, m, page, line, _ in sorted(data, key=lambda r: ((r[2] is None, r[2] or 0), (r[3] is None, r[3] or 0), r[0])):
        if m is None:
            continue
        k = m.strip(" \t\r\n").lower()
        if k in first:
            gone.add(rid)
        first.setdefault(k, rid)
    return gone


def test_repeats_against_brute_force(spark):
    r = random.Random(3)
    hot = [(i, r.choice(["Hot", "hot ", "\tHOT\n"]), r.randrange(50), i, r.randrange(9)) for i in range(400)]
    rest = [(1000 + i, r.choice([None, "", " ", f"id{r.randrange(500)}", f"ID{r.randrange(500)} "]), r.choice([None, r.randrange(50)]), r.choice([None, i]), r.choice([None, r.randrange(9)])) for i in range(1200)]
    assert _gone(spark, hot + rest) == _brute(hot + rest)


def test_repeats_empty_and_all_new(spark):
    assert _gone(spark, []) == set()
    assert _gone(spark, [(i, f"m{i}", i, i, i % 3) for i in range(50)]) == set()


def _in_force(spark, events, changes, **kw):
    e = spark.createDataFrame(events, "rid long, e string, t long, title string, version long")
    c = spark.createDataFrame(changes, "e string, t long, rank int, news string, title string")
    got = version_join(e, "rid", ident(F.col("e")), F.col("t"), c, ident(F.col("e")), F.col("t"), ["news", "title"], [F.coalesce(-F.col("rank"), F.lit(2**31 - 1)), F.col("news")], **kw)
    return {r.rid: r.news for r in got.collect()}


def test_versions_strictly_before_ties_and_nulls(spark):
    events = [(1, "F", 10, "", 0), (2, "f ", 11, "", 0), (3, "f", 20, "", 0), (4, "g", 50, "", 0), (5, None, 50, "", 0), (6, "f", None, "", 0), (7, "f", 21, "", 0), (8, "f", 21, "", 0)]
    changes = [("f", 10, 0, "a", "x"), ("f", 10, 1, "c", None), ("F ", 10, 1, "b", "y"), ("f", 20, None, "d", "z"), ("f", None, 9, "e", ""), (None, 1, 9, "e", ""), ("f", 20, None, "d", "z")]
    assert _in_force(spark, events, changes) == {2: "b", 3: "b", 7: "d", 8: "d"}


def test_versions_against_brute_force(spark):
    r = random.Random(5)
    events = [(i, r.choice("aaaab"), r.randrange(200), "", 0) for i in range(500)]
    changes = [(r.choice("ab"), r.randrange(200), r.randrange(3), f"n{i}", "") for i in range(60)]
    want = {}
    for rid, e, t, *_ in events:
        best = [(c[1], c[2], c[3]) for c in changes if c[0] == e and c[1] < t]
        if best:
            at = max(b[0] for b in best)
            want[rid] = min((-b[1], b[2]) for b in best if b[0] == at)[1]
    for block in (7, 50, 10**9):
        assert _in_force(spark, events, changes, block_us=block) == want
    assert _in_force(spark, events, []) == {} == _in_force(spark, [], changes)


def test_versions_do_not_see_the_future(spark):
    events = [(i, "a", 10 * i, "", 0) for i in range(20)]
    changes = [("a", 15 * i, 0, f"n{i}", "") for i in range(5)]
    assert _in_force(spark, events, changes) == {k: v for k, v in _in_force(spark, events, [*changes, ("a", 10**6, 5, "late", "")]).items()}


def test_entry_and_registry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    names = set(e.queries())
    assert set(e.oracle_sql()) <= names
    assert rows(e.queries()["p4_found"](spark, data)) == rows(e.queries()["p4_found"](spark, data))
