"""Same or near-same records across splits: a weighted cosine join.

A text's vector has one term for every q-gram and number of its occurrence,
weighted by rarity. Two edits touch at most 2q terms, so a text within two
edits of ``a`` has a dot product with it of at least ``|a|^2`` less the 2q
largest squared weights: that maximum-weight bound is each record's own
threshold. Terms are ordered by falling weight; a record is listed under its
terms only until the squared norm of the rest is below its threshold (residual
norm), which keeps both sides' lists complete for all qualifying pairs. Lists
are joined between splits only, partial dot products are bounded by the
residuals, surviving pairs get the exact dot product, and an exact edit check
decides.

Texts too short for a positive threshold are listed under the strings that
deleting up to two characters leaves. A text of which another is a prefix of at
least 40 characters is found by equality of 128-bit digests on its prefixes of
the lengths that occur among texts of the same first 40 characters: a prefix of
a long text has no useful cosine, since the rest of the text outweighs it.

Scale: equal texts are one class, joined once and counted by numbers; a class
with a third of all records is one row of the join. Term rarity is taken over
all texts, from a table of 65,536 hashed counters whose size never changes.
Listed terms are the rarest of a text, so common grams are not joined.

Defined cases: null, empty and placeholder texts overlap with nothing; records
of no known split are left out; repeated record ids are not expected; very long
texts are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import split_name  # noqa: F401 - part of this module's names
from tidemark.session import materialize

#: Long enough that chance grams of hex text seldom meet: 16 ** GRAM is far above the number of texts.
GRAM = 8
EDITS = 2
PREFIX = 40
COUNTERS = 1 << 16
#: Characters handled at once by a worker.
PORTION = 1 << 20
# Spellings of a missing hash.
MISSING = ("", "na", "n/a", "null", "none")


def tx_text(c: Column) -> Column:
    """Comparable form of a transaction hash, or null where it is missing."""
    t = F.regexp_replace(F.regexp_replace(F.lower(c), r"[ \t\r\n:_-]+", ""), "^0x", "")
    return F.when(~t.isin(*MISSING) & ~t.rlike("^0+$"), t)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def term_batch(texts: list[str], q: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit term) of every q-gram with the number of its occurrence, by text."""
    lens = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(points) - q + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(q):
            h = h * np.uint64(0x9E3779B97F4A7C15) + points[j : n + j]
        owner = np.repeat(np.arange(len(texts)), lens)[:n]
        inside = np.arange(n) + q <= np.cumsum(lens)[owner]
        owner, h = owner[inside], _mixed(h[inside])
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])][: len(h)]
        at = np.arange(len(h))
        occurrence = at - np.maximum.accumulate(np.where(new, at, 0))
        return owner, _mixed(h + occurrence.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def _portions(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``PORTION`` characters, or of one text."""
    lo, used = 0, 0
    for i, t in enumerate(texts):
        if used and used + len(t) > PORTION:
            yield lo, i
            lo, used = i, 0
        used += len(t)
    if texts:
        yield lo, len(texts)


def _counter(t: np.ndarray) -> np.ndarray:
    return (t >> np.uint64(48)).astype(np.int64)


def _count_terms(q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            texts = batch.column("t").to_pylist()
            for lo, hi in _portions(texts):
                total += np.bincount(_counter(term_batch(texts[lo:hi], q)[1]), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    return run


def term_weights(texts: DataFrame, q: int = GRAM) -> np.ndarray:
    """Squared weight of each of the 65,536 counters, from all texts."""
    rows = texts.mapInArrow(_count_terms(q), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    counts = np.ones(COUNTERS)
    for r in rows:
        counts[r.slot] += r.n
    return np.log1p(counts.sum() / counts).astype(np.float64) ** 2


def vectors(texts: list[str], weights: np.ndarray, q: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms and squared weights of each text, heaviest first; ties by term."""
    for a, b in _portions(texts):
        owner, t = term_batch(texts[a:b], q)
        w = weights[_counter(t)]
        order = np.lexsort((t, -w, owner))
        t, w = t[order], w[order]
        cuts = np.searchsorted(owner, np.arange(b - a + 1))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield t[lo:hi], w[lo:hi]


def need(w: np.ndarray, q: int, edits: int) -> float:
    """Least dot product with a text within ``edits`` edits; ``w`` falls."""
    return float(w[q * edits :].sum())


def deletions(text: str, edits: int) -> set[str]:
    out = {text}
    for k in range(1, min(edits, len(text)) + 1):
        for gone in combinations(range(len(text)), k):
            out.add("".join(c for i, c in enumerate(text) if i not in gone))
    return out


def _lists(shared, q: int, edits: int):
    """Rows (key, term, w): key is 4 * cid + side; a class's bounds stand under side 0, the rest first, then the threshold."""
    short = q - 1 + q * edits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            cols: list[list[np.ndarray]] = [[] for _ in range(3)]
            sides = (batch.column("n_train").to_numpy() > 0) + 2 * (batch.column("n_eval").to_numpy() > 0)
            texts = batch.column("t").to_pylist()
            for cid, side, text, (t, w) in zip(batch.column("cid").to_pylist(), sides, texts, vectors(texts, weights, q)):
                parts = []
                if len(text) > short:
                    least = need(w, q, edits)
                    rest = np.maximum(least + w[: q * edits].sum() - np.cumsum(w), 0.0)
                    listed = min(int(np.searchsorted(-rest, -least * (1 - 1e-9), side="right")) + 1, len(t))
                    parts.append((side, t[:listed], w[:listed]))
                    parts.append((0, np.array([0, 1], np.uint64), np.array([rest[listed - 1], least])))
                if len(text) <= short + edits:
                    d = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 1 << 40) for x in deletions(text, edits)], np.uint64)
                    parts.append((side, d, np.full(len(d), np.inf)))  # who meets here is not pruned
                for own, t, w in parts:
                    for c, x in zip(cols, (np.full(len(t), 4 * cid + own, np.int64), t.view(np.int64), w)):
                        c.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["key", "term", "w"])

    return run


def _dots(shared, q: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = shared.value
        for pairs in batches:
            dots, sizes = [], []
            for (s, v), (t, w) in zip(vectors(list(pairs["ta"]), weights, q), vectors(list(pairs["tb"]), weights, q)):
                dots.append(float(v[np.isin(s, t)].sum()))
                sizes.append(float(np.sqrt(v.sum() * w.sum())))
            pairs["dot"], pairs["cosine"] = dots, [d / n if n else 0.0 for d, n in zip(dots, sizes)]
            yield pairs

    return run


def text_classes(records: DataFrame, record_id: str, text: Column, split: Column) -> DataFrame:
    """Records (id, split, t) with the id of their class of equal texts, ``cid``."""
    rows = records.select(F.col(record_id).cast("long").alias("id"), split.alias("split"), text.alias("t"), *[F.col(c).alias(f"x_{c}") for c in records.columns if c == "source"])
    return rows.where("id IS NOT NULL AND split IS NOT NULL AND t IS NOT NULL")


def overlapping_classes(classes: DataFrame, *, q: int = GRAM, edits: int = EDITS, prefix: int = PREFIX) -> DataFrame:
    """Pairs (train_cid, eval_cid, cosine) of overlapping texts.

    ``classes``: (cid, t, n_train, n_eval), one row a text.
    """
    spark = classes.sparkSession
    same = classes.where("n_train > 0 AND n_eval > 0").select(F.col("cid").alias("train_cid"), F.col("cid").alias("eval_cid"), F.lit(1.0).alias("cosine"))
    shared = spark.sparkContext.broadcast(term_weights(classes.select("t"), q))  # COUNTERS numbers at any size
    lists = classes.select("cid", "t", "n_train", "n_eval").mapInArrow(_lists(shared, q, edits), "key long, term long, w double")
    lists = materialize(lists, "term-lists")
    side = lambda c, bit, *more: lists.where(f"key & {bit} > 0").select("term", F.shiftright("key", 2).alias(c), *more)
    met = side("a", 1, "w").join(side("b", 2), "term").where("a <> b")
    parts = met.groupBy("a", "b").agg(F.sum("w").alias("part"))
    # a text short enough for deletion variants only has no bounds
    bounds = lists.where("key & 3 = 0").groupBy(F.shiftright("key", 2).alias("c")).agg(F.max(F.when(F.col("term") == 0, F.col("w"))).alias("rest"), F.max(F.when(F.col("term") == 1, F.col("w"))).alias("least"))
    of = lambda c: bounds.select(F.col("c").alias(c), F.col("rest").alias(f"rest_{c}"), F.col("least").alias(f"least_{c}"))
    known = lambda c: F.coalesce(F.greatest(f"{c}_a", f"{c}_b"), F.lit(0.0))
    bounded = parts.join(of("a"), "a", "left").join(of("b"), "b", "left")
    # shared terms that did not meet all lie beyond the list that ends first
    pairs = bounded.select("a", "b", "part", known("rest").alias("rest"), known("least").alias("least")).where("part + rest >= least * (1 - 1e-9)").select("a", "b", "least")
    text = lambda c: classes.select(F.col("cid").alias(c), F.col("t").alias(f"t{c}"))
    dotted = pairs.join(text("a"), "a").join(text("b"), "b").mapInPandas(_dots(shared, q), "a long, b long, least double, ta string, tb string, dot double, cosine double")
    near = dotted.where("dot >= least * (1 - 1e-9)").where(F.levenshtein("ta", "tb", edits) >= 0).select(F.col("a").alias("train_cid"), F.col("b").alias("eval_cid"), "cosine")

    digest = lambda c: (F.xxhash64(c).alias("k1"), F.xxhash64(F.lit("other"), c).alias("k2"))
    long_ = classes.where(F.char_length("t") >= prefix).select("cid", "n_train", "n_eval", "t", F.char_length("t").alias("len"), F.xxhash64(F.substring("t", 1, prefix)).alias("p"))
    heads = long_.groupBy("p").agg(F.collect_set("len").alias("lens"), F.sum("n_train").alias("nt"), F.sum("n_eval").alias("ne")).where("nt > 0 AND ne > 0 AND size(lens) > 1").select("p", "lens")
    family = materialize(long_.join(heads, "p"), "head-families")
    # one narrow row for each length of the family, not one copy of the text
    longer = family.select("cid", "n_train", "n_eval", "t", F.explode(F.filter("lens", lambda x: x < F.col("len"))).alias("len")).select("cid", "n_train", "n_eval", "len", *digest(F.expr("left(t, len)")))
    shorter = family.select(F.col("cid").alias("c2"), F.col("n_train").alias("t2"), F.col("n_eval").alias("e2"), "len", *digest(F.col("t")))
    begun = longer.join(shorter, ["k1", "k2", "len"])
    starts = begun.where("n_train > 0 AND e2 > 0").select(F.col("cid").alias("train_cid"), F.col("c2").alias("eval_cid")).unionByName(
        begun.where("t2 > 0 AND n_eval > 0").select(F.col("c2").alias("train_cid"), F.col("cid").alias("eval_cid"))
    ).withColumn("cosine", F.lit(None).cast("double"))
    return same.unionByName(near).unionByName(starts).groupBy("train_cid", "eval_cid").agg(F.max("cosine").alias("cosine"))


def class_table(rows: DataFrame) -> DataFrame:
    """(cid, t, n_train, n_eval) of the distinct texts of ``text_classes`` rows."""
    train = F.count_if(F.col("split") == "train")
    return rows.groupBy("t").agg(F.min("id").alias("cid"), train.alias("n_train"), (F.count("*") - train).alias("n_eval"))


def overlapping_records(rows: DataFrame) -> DataFrame:
    """All pairs (record_a, record_b) of overlapping train and evaluation records."""
    classes = materialize(class_table(rows), "text-classes")
    pairs = overlapping_classes(classes)
    digest = lambda df, *c: df.select(F.xxhash64("t").alias("k1"), F.xxhash64(F.lit("other"), "t").alias("k2"), *c)
    member = digest(rows, "id", "split").join(digest(classes, "cid"), ["k1", "k2"]).select("cid", "id", "split")
    train = member.where("split = 'train'").select(F.col("cid").alias("train_cid"), F.col("id").alias("i"))
    held = member.where("split <> 'train'").select(F.col("cid").alias("eval_cid"), F.col("id").alias("j"))
    both = pairs.join(train, "train_cid").join(held, "eval_cid")
    return both.select(F.least("i", "j").alias("record_a"), F.greatest("i", "j").alias("record_b"))


def overlap_counts(rows: DataFrame, source: str) -> DataFrame:
    """Per evaluation split and source: records, overlapping records, pairs."""
    classes = materialize(class_table(rows), "text-classes")
    reach = overlapping_classes(classes).join(classes.select(F.col("cid").alias("train_cid"), "n_train"), "train_cid").groupBy(F.col("eval_cid").alias("cid")).agg(F.sum("n_train").alias("pairs"))
    held = rows.where("split <> 'train'").join(classes.select("t", "cid"), "t").join(reach, "cid", "left")
    return held.groupBy("split", F.col(source).alias("source")).agg(
        F.count("*").alias("n_records"), F.count("pairs").alias("n_overlapping"), F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("n_pairs"),
    )
