"""The operators of the llm subpackage against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import leakage, mixture, nearest, overlap, spans, splits


# ---- overlap
def _lev(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def _overlaps(a, b):
    s, t = sorted((a, b), key=len)
    return a == b or (abs(len(a) - len(b)) <= 2 and _lev(a, b) <= 2) or (len(s) >= 40 and t.startswith(s))


def _edit(r, t):
    for _ in range(r.randrange(4)):
        i = r.randrange(len(t) + 1)
        t = r.choice([t[:i] + r.choice("0123456789abcdef") + t[i:], t[:i] + t[i + 1 :], t[:i] + "f" + t[i + 1 :]])
    return t


def _records(spark, data):
    df = spark.createDataFrame(data, "record_id long, tx string, split string, source string, cid long, t string")
    return overlap.text_classes(df, "record_id", overlap.tx_text(F.col("tx")), overlap.split_name(F.col("split")))


def test_overlap_against_brute_force(spark):
    r = random.Random(1)
    base = ["".join(r.choices("0123456789abcdef", k=n)) for n in (64, 64, 64, 60, 45, 41, 40, 39, 27, 26, 25, 24, 23, 22, 17, 12, 5, 2, 1)] + ["0" * 60 + "ab1", "0" * 30, "ab" * 32]
    data = []
    for i in range(1000):
        t = _edit(r, r.choice(base))
        if r.random() < 0.2:
            t = t[: r.randrange(38, 66)]
        if r.random() < 0.2:
            t = r.choice(["0x", " 0X", "\t"]) + t.upper() + r.choice(["", " ", "\n"])
        data.append((i, r.choice([t, t, t, None, "", "n/a", "N-A", "0x000"]), r.choice(["train", " Training", "TRAIN", "val", "dev", "test\n", "quarantine", None]), r.choice(["s1", None]), 0, "x"))
    got = [tuple(x) for x in overlap.overlapping_records(_records(spark, data)).collect()]
    kept = [(x.id, x.split, x.t) for x in _records(spark, data).collect()]
    want = {(min(i, j), max(i, j)) for i, s, a in kept if s == "train" for j, u, b in kept if u != "train" and _overlaps(a, b)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    counts = {(c.split, c.source): (c.n_overlapping, c.n_pairs) for c in overlap.overlap_counts(_records(spark, data), "x_source").collect()}
    assert sum(c[1] for c in counts.values()) == len(want)
    held = {i for i, s, _ in kept if s != "train"}
    assert sum(c[0] for c in counts.values()) == len({x for p in want for x in p if x in held})


def test_overlap_empty_and_long(spark):
    assert overlap.overlapping_records(_records(spark, [])).count() == 0
    long = "ab12cd" * 3000
    data = [(1, long, "train", None, 0, ""), (2, long[:-1], "test", None, 0, ""), (3, long[:50], "dev", None, 0, ""), (4, None, "test", None, 0, "")]
    assert rows(overlap.overlapping_records(_records(spark, data))) == [(1, 2), (1, 3)]


def test_overlap_of_repeated_records(spark):
    data = [(i, "ab" * 32, "train" if i % 3 else "test", "s", 0, "") for i in range(30)]
    assert overlap.overlapping_records(_records(spark, data)).count() == 20 * 10


# ---- nearest
def _nearest(spark, left, right, **kw):
    a = spark.createDataFrame(left, "lid long, e string, t long, b long, k1 long, kind int, id long")
    b = spark.createDataFrame(right, "rid long, e string, t long, s string")
    got = nearest.nearest_time_join(a, "lid", F.col("e"), F.col("t"), b, "rid", F.col("e"), F.col("t"), **kw)
    return {x.lid: x.rid for x in got.collect()}


def _nearest_brute(left, right, tol):
    out = {}
    for lid, e, t, *_ in left:
        c = [(abs(u - t), u, rid) for rid, f, u, _ in right if f == e and None not in (e, t, u) and abs(u - t) <= tol]
        if c:
            out[lid] = min(c)[2]
    return out


@pytest.mark.parametrize(("block", "hot"), [(40, 5), (1000, 20_000), (10**9, 50)])
def test_nearest_against_brute_force(spark, block, hot):
    r = random.Random(block)
    left = [(i, r.choice(["a", "a", "a", "b", None]), r.choice([r.randrange(2000), r.randrange(5) * 100, None]), 0, 0, 0, 0) for i in range(600)]
    right = [(i, r.choice(["a", "b", None]), r.choice([r.randrange(2000), r.randrange(5) * 100 + 20, None]), "") for i in range(200)]
    assert _nearest(spark, left, right, tolerance_us=20, block_us=block, hot=hot) == _nearest_brute(left, right, 20)


def test_nearest_boundary_ties_and_empty(spark):
    left = [(1, "a", 100, 0, 0, 0, 0), (2, "a", 100, 0, 0, 0, 0), (3, "b", 100, 0, 0, 0, 0)]
    right = [(9, "a", 90, ""), (7, "a", 110, ""), (8, "a", 90, ""), (5, "b", 111, "")]
    assert _nearest(spark, left, right, tolerance_us=10) == {1: 8, 2: 8}
    assert _nearest(spark, left, [], tolerance_us=10) == {} == _nearest(spark, [], right, tolerance_us=10)


def test_nearest_stream_against_brute_force(spark, tmp_path):
    r = random.Random(4)
    left = [(i, r.choice("ab"), r.randrange(1, 3000), 0, 0, 0, 0) for i in range(200)]
    right = [(i, r.choice("ab"), r.randrange(1, 3000), "") for i in range(80)]
    ev = sorted([(e, t, 1, i) for i, e, t, *_ in left] + [(e, t, 0, i) for i, e, t, _ in right], key=lambda x: x[1])
    for k in range(4):  # four files in the order of time, then one that moves the watermark past all
        spark.createDataFrame(ev[k * 70 : (k + 1) * 70], "entity string, sec long, side int, id long").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    spark.createDataFrame([("z", 9000, 0, 1), ("z", 9001, 0, 1)], "entity string, sec long, side int, id long").coalesce(1).write.parquet(f"{tmp_path}/in/9")
    s = spark.readStream.schema("entity string, sec long, side int, id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    s = s.select("entity", F.timestamp_seconds("sec").alias("ts"), "side", "id")
    q = nearest.nearest_stream(s, tolerance_us=30_000_000, delay="1 hour").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {x.left_id: x.right_id for x in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == _nearest_brute(left, right, 30)


# ---- splits
def _roots(edges):
    p = {}

    def find(x):
        while p.setdefault(x, x) != x:
            x = p[x]
        return x

    for a, b in edges:
        p[find(a)] = find(b)
    return {x: find(x) for x in p}


@pytest.mark.parametrize("kind", ["random", "path", "star"])
def test_components_against_union_find(spark, kind):
    r = random.Random(2)
    edges = {
        "random": [(f"v{r.randrange(90):03}", f"v{r.randrange(90):03}") for _ in range(70)], "path": [(f"v{i:03}", f"v{i + 1:03}") for i in range(60)], "star": [("v000", f"v{i:03}") for i in range(1, 60)],
    }[kind]
    labels = splits.components(spark.createDataFrame(edges + edges[:3], "a string, b string"))
    got, want = {x.v: x.root for x in labels.collect()}, _roots([e for e in edges if e[0] != e[1]])
    group = lambda m: {frozenset(v for v in m if m[v] == k) for k in set(m.values())}
    assert group(got) == group(want)


def test_units_keep_related_rows_together(spark):
    data = [(1, "f1", "x"), (2, "f2", "x"), (3, "f3", "y"), (4, None, "y"), (5, None, "z"), (6, None, "z"), (7, None, None), (8, "f4", None), (9, None, "x"), (10, "f2", "w"), (11, "f3", "w"), (12, None, None)]
    u = {x.rid: x.unit for x in splits.record_units(spark.createDataFrame(data, "rid long, f string, k string"), "rid", "f", "k").collect()}
    assert len(u) == len(data) and u[1] == u[2] == u[9] == u[10] == u[11] == u[3] == u[4] and u[5] == u[6]
    assert len({u[1], u[5], u[7], u[8], u[12]}) == 5


def test_no_edges_and_proportions(spark):
    empty = spark.createDataFrame([], "rid long, f string, k string")
    assert splits.components(splits.shared_key_edges(empty, "f", "k")).count() == 0
    assert splits.record_units(empty, "rid", "f", "k").count() == 0
    units = spark.createDataFrame([(f"u{i}", "s", 1 + i % 7) for i in range(3000)] + [("big", "s", 9000)], "unit string, stratum string, weight long")
    w = {x.split: x.w for x in splits.assign_splits(units).groupBy("split").agg(F.sum("weight").alias("w")).collect()}
    total = sum(w.values())
    assert abs(w["train"] / total - 0.8) < 0.01 and abs(w["test"] / total - 0.1) < 0.01


# ---- leakage
def _words(t):
    import unicodedata

    out, cur = [], ""
    for c in t.replace("­", "").replace("​", ""):
        if unicodedata.category(c)[0] in "LN":
            cur += c
        else:
            out.append(cur)
            cur = ""
    return [w.lower() for w in [*out, cur] if w]


def test_leakage_against_brute_force(spark):
    r = random.Random(6)
    vocab = ["Tor", "ÉCOLE", "müde", "x1", "½", "İz", "go­al", "de​al", "the", "a", "Ⅷ", "ß"]
    seps = [" ", ", ", "\n", "-", "_", " ́", "'"]
    text = lambda n: "".join(r.choice(vocab) + r.choice(seps) for _ in range(n))
    items = [(i, text(r.choice([5, 13, 20, 30]))) for i in range(20)] + [(90, None), (91, ""), (92, items_like := "uno dos " * 10)]
    docs = [(i, text(20) + (lambda t: t[r.randrange(0, 3) :])(r.choice(items)[1] or "").upper() + text(20)) for i in range(60)] + [(900, None), (901, ""), (902, items_like)]
    a = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    b = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    runs = lambda t: {tuple(w[i : i + 13]) for w in [_words(t or "")] for i in range(len(w) - 12)}
    want = sorted((i, d) for i, t in items for d, u in docs if runs(t) & runs(u))
    assert rows(leakage.leaked_items(a, b)) == want and want
    found = leakage.leaked_items(a, b, spans=True).collect()
    assert {(x.item_id, x.doc_id) for x in found} == set(want)
    for x in found:
        w = _words(dict(docs)[x.doc_id][x.start : x.end])
        assert len(w) == x.n_words >= 13 and {tuple(w[i : i + 13]) for i in range(len(w) - 12)} <= runs(dict(items)[x.item_id])


@pytest.mark.parametrize(("least", "stretch", "hits"), [(13, 512, 1 << 20), (13, 7, 3), (4, 5, 2), (1, 3, 1), (2, 4, 5)])
def test_automaton_against_brute_force(monkeypatch, least, stretch, hits):
    import numpy as np

    monkeypatch.setattr(leakage, "STRETCH", stretch)
    monkeypatch.setattr(leakage, "HITS", hits)
    r = random.Random(least * stretch)
    items = [[r.choice("abc") for _ in range(r.randrange(40))] for _ in range(12)]
    doc = [r.choice("abcx") for _ in range(60)] + items[3] + ["x"] + items[5] + items[6]
    vocabulary = list("abc")
    numbers = np.array([vocabulary.index(w) for i in items for w in i])
    parts = leakage.Automaton.build(np.arange(12), np.array([len(i) for i in items]), numbers, vocabulary, least)
    a = leakage.Automaton(parts)
    flat = np.array([-1, *[a.number.get(w, -1) for w in doc], -1])
    item, first, n = leakage._runs(a, flat, least, True)
    want = set()
    for k, words in enumerate(items):
        for i in range(len(words)):
            for j in range(len(doc)):
                if i and j and words[i - 1] == doc[j - 1]:
                    continue
                m = 0
                while i + m < len(words) and j + m < len(doc) and words[i + m] == doc[j + m]:
                    m += 1
                if m >= least:
                    want.add((k, j + 1, m))
    assert set(zip(item.tolist(), first.tolist(), n.tolist())) == want and want
    assert {(i, f) for i, f, _ in zip(*[c.tolist() for c in leakage._runs(a, flat, least, False)])} <= {(k, j + d) for k, j, m in want for d in range(m)}


def test_spans_are_whole(spark):
    words = [f"w{i}" for i in range(60)]
    text = lambda *parts: " ".join(w for a, b in parts for w in words[a:b])
    items = spark.createDataFrame([(1, text((0, 60))), (2, text((10, 40))), (3, text((0, 15), (20, 35), (0, 15)))], "item_id long, text string")
    docs = spark.createDataFrame([(7, "x, " + text((0, 60)) + "."), (8, text((5, 30), (45, 60))), (9, text((0, 15), (0, 15), (3, 50)))], "doc_id long, text string")
    want = rows(leakage.leaked_items(items, docs, spans=True))
    assert (1, 7, 3, len(text((0, 60))) + 3, 60) in want and (1, 8, 0, len(text((5, 30))), 25) in want
    assert {x[:2] for x in want} == {tuple(x) for x in leakage.leaked_items(items, docs).collect()}


def test_leakage_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert leakage.leaked_items(none, docs).count() == 0


# ---- mixture
def test_water_fill_clamps_and_redistributes():
    g = mixture.water_fill({"a": 0.5, "b": 0.3, "c": 0.2, "d": 0.0}, {"a": 100, "b": 1000, "c": 1000, "d": 5}, 1000)
    assert g == {"a": 100, "b": pytest.approx(540), "c": pytest.approx(360), "d": 0}
    assert mixture.water_fill({"a": 0.5, "b": 0.5}, {"a": 10, "b": 20}, 1000) == {"a": 10, "b": 20}
    assert mixture.water_fill({"a": 0.5, "b": 0.25, "x": 0.25}, {"a": 100, "b": 100}) == {"a": pytest.approx(100), "b": pytest.approx(50), "x": 0}
    assert mixture.water_fill({}, {}) == {}


def test_pieces_keep_token_counts():
    r = random.Random(8)
    text = "".join(r.choice(["word ", "don't ", "12 34", "\n\n", "  ", "aé ", "!?"]) for _ in range(60_000))
    e = mixture.encoding(mixture.TOKENIZER)
    assert sum(len(e.encode_ordinary(p)) for p in mixture._pieces(text)) == len(e.encode_ordinary(text)) and "".join(mixture._pieces(text)) == text


def test_mixture_reaches_its_shares(spark):
    r = random.Random(9)
    docs = [(i, " ".join(["goal"] * r.randrange(1, 40)), r.choice(["big", "BIG ", "big", "small_x", "tiny", None])) for i in range(3000)] + [(9000, None, "big"), (9001, "", "tiny")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("tokens", F.lit(1))
    t = spark.createDataFrame([("big", 0.5, 1), ("small-x", 0.3, 2), ("tiny", 0.2, 3), ("ghost", 0.1, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    for total in (None, 200_000.0):
        drawn, report = mixture.mixture(d, t, total=total)
        n = {x.source: x for x in report.collect()}
        assert all(x.most_copies <= x.max_repeats for x in n.values()) and n["ghost"].mixed_tokens == 0
        assert all(abs(x.mixed_tokens - x.planned_tokens) <= 20 for x in n.values())
        assert drawn.groupBy("doc_id").count().where("count > 1").count() == 0
        if total is None:
            assert all(abs(n[s].share_reached - w) < 0.002 for s, w in (("big", 0.5), ("small-x", 0.3), ("tiny", 0.2)))


def test_mixture_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string, source string")
    t = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    drawn, report = mixture.mixture(d, t)
    assert drawn.count() == 0 and report.count() == 1


# ---- spans
def _covered(docs, n):
    seen = {}
    for d, t in docs:
        for i in range(len(t or "") - n + 1):
            seen.setdefault(t[i : i + n], set()).add(d)
    return {d: {i for i in range(len(t or "") - n + 1) if len(seen[t[i : i + n]]) > 1} for d, t in docs}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spans_against_brute_force(spark, seed, monkeypatch):
    r = random.Random(seed)
    monkeypatch.setattr(spans, "CHUNK", r.choice([64, 1 << 15]))
    rand = lambda n, a="abcdé 😀\n": "".join(r.choices(a, k=n))
    notes = [rand(k) for k in (39, 40, 41, 60, 120, 300)] + ["ab" * 40, "x" * 90]
    docs = []
    for d in range(60):
        parts = [rand(r.randrange(30)) for _ in range(3)]
        for _ in range(2):
            note = r.choice(notes)
            a = r.randrange(len(note) // 3 + 1)
            parts.insert(1, note[a : len(note) - r.randrange(len(note) // 3 + 1)])
        docs.append((d, "".join(parts)))
    docs += [(100, docs[0][1]), (101, docs[0][1]), (102, None), (103, ""), (104, "q" * 200), (105, "rs" * 100)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("v", F.lit("clash")).withColumn("doc", F.lit(1))
    want = _covered(docs, 40)
    got = {d: set() for d, _ in docs}
    for x in spans.shared_blocks(df, "doc_id", "text", min_chars=40, q=r.choice([8, 20, 33]), step=r.choice([1, 5, 7]), hashes=seed).collect():
        got[x.doc] |= set(range(x.first, x.last + 1))
    assert got == want and any(want.values())


def test_span_parts(spark):
    a = "".join(random.Random(5).choices("abcdef ", k=900))
    docs = [(1, a), (2, "zz" + a[100:700]), (3, a[:399]), (4, "other"), (5, None), (6, a)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {1: 900, 2: 600, 3: 0, 4: 0, 5: 0, 6: 900}
    assert {x.doc: x.shared_chars for x in spans.shared_part(df, "doc_id", "text").collect()} == want
    assert rows(spans.shared_spans(df.where("doc_id < 3"), "doc_id", "text")) == [(1, 100, 600), (2, 2, 600)]
    assert spans.shared_blocks(df.limit(0), "doc_id", "text").count() == 0


def test_windows_by_tree_and_by_sliding_minimum_agree():
    import numpy as np

    g = np.random.default_rng(0)
    for n, t, top in ((300, 20, 2**60), (300, 20, 3), (50, 50, 9), (400, 1, 5)):
        h = g.integers(0, top, n).astype(np.uint64)
        assert sorted(spans.compact_windows(h, t)) == sorted(spans._sliding(h, t))
