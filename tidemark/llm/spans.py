"""Long exact spans shared between records.

Tokens are the q-character grams of a text, hashed. Under one hash function a
compact window (a, m, b) says that every run of t grams inside [a, b] that
contains gram m has gram m as its leftmost minimum; the windows of a text are
the nodes of the Cartesian tree over its gram hashes that are t grams wide.
Spans of ``min_chars`` code points are exactly the runs of t = min_chars - q + 1
grams, so under each function a span belongs to one window. Equal spans have
equal minima under every function: the windows of all ``hashes`` functions are
joined by interval, and the parts, each with the signature of its minima, are
what documents are joined by. More functions thin the candidates and lose
nothing. What is joined is verified by content.

1. ``signed_ranges`` reads every text once and emits narrow rows: signature,
   first and last start of the range, place of its anchor (the minimum under
   the first function) and a 96-bit digest of the text that the range covers.
2. Signatures of two documents are kept. A bounded bitmap (``screened``) keeps
   other rows out of the exact semi-join. Ranges with equal digests share all
   their spans.
3. Only where ranges of one signature differ in content is text needed again:
   one representative of each distinct content is cut by where a span starts
   before the anchor into blocks of ``STEP`` starts. All spans of a block
   contain its core, ``min_chars - STEP + 1`` characters; what precedes and
   follows it is the context. Blocks equal in core and context hold only shared
   spans; where one core has several contexts, each is spelled out into its
   spans, at most ``STEP``, and these are compared. No pairs are formed, so a
   notice copied into a third of all documents costs a few rows a document.

The plan is the same at every size. Contexts are compared as text, cores by
128-bit BLAKE2 digests, ranges by 96 bits of XXH3 within one signature.

Defined cases: null texts and texts shorter than ``min_chars`` share nothing;
a span repeated only inside one document does not count; document ids are
unique; long texts are processed whole, in overlapping chunks; periodic texts,
whose tree is a path, get the same windows from a sliding minimum.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.screen import screened
from tidemark.session import materialize

MIN_CHARS = 400
GRAM = 200
STEP = 67
HASHES = 2
CHUNK = 1 << 15
#: Rows of an output batch, which bounds a worker's memory whatever the texts hold.
ROWS = 20_000
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _BASE, np.uint64))
        down = np.cumprod(np.full(n, inverse, np.uint64))
    return up, down


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of every q-gram; equal grams have equal hashes."""
    n = len(points)
    up, down = _powers(CHUNK + 4096)
    if n > len(up):
        up, down = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    with np.errstate(over="ignore"):
        np.cumsum((points + np.uint32(1)) * up[:n], out=sums[1:])
        h = sums[q:] - sums[:-q]
        h *= down[: len(h)]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def rehashed(h: np.ndarray, number: int) -> np.ndarray:
    """The gram hashes under the hash function of that number."""
    if not number:
        return h
    with np.errstate(over="ignore"):
        x = (h + np.uint64(number) * np.uint64(0xA24BAED4963EE407)) * np.uint64(0x9FB21C651E98DF25)
        return x ^ (x >> np.uint64(28))


def compact_windows(h: np.ndarray, t: int) -> list[tuple[int, int, int]]:
    """(first start, last start, minimum) of the spans of each Cartesian-tree node."""
    n, out = len(h), []
    todo, most = [(0, n - 1)], 64 + 16 * n // t
    while todo:
        a, b = todo.pop()
        if b - a + 1 < t:
            continue
        m = a + int(h[a : b + 1].argmin())
        out.append((max(a, m - t + 1), min(m, b - t + 1), m))
        if len(out) > most:
            return _sliding(h, t)
        todo.append((a, m - 1))
        todo.append((m + 1, b))
    return out


def _sliding(h: np.ndarray, t: int) -> list[tuple[int, int, int]]:
    """The same windows by a sliding leftmost minimum, for degenerate trees."""
    best, width = np.arange(len(h)), 1
    while 2 * width <= t:
        left, right = best[:-width], best[width:]
        best = np.where(h[left] <= h[right], left, right)
        width *= 2
    gap = t - width
    if gap:
        left, right = best[:-gap], best[gap:]
        best = np.where(h[left] <= h[right], left, right)
    cut = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    return [(int(lo), int(hi) - 1, int(best[lo])) for lo, hi in zip(cut, [*cut[1:], len(best)])]


def joined_windows(h: np.ndarray, t: int, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Interval join of the windows of all functions: (signature, first start, last start, anchor)."""
    parts = []
    for number in range(hashes):
        own = rehashed(h, number)
        windows = np.array(sorted(compact_windows(own, t)), np.int64)
        parts.append((windows[:, 0], windows[:, 2], own[windows[:, 2]]))
    lo = np.unique(np.concatenate([p[0] for p in parts]))
    hi = np.r_[lo[1:] - 1, len(h) - t]
    sig = np.zeros(len(lo), np.uint64)
    anchor = lo
    with np.errstate(over="ignore"):
        for number, (first, m, v) in enumerate(parts):
            at = np.searchsorted(first, lo, side="right") - 1
            sig = (sig ^ v[at]) * np.uint64(0x9FB21C651E98DF25)
            sig ^= sig >> np.uint64(32)
            if not number:
                anchor = m[at]
    return sig, lo, hi, anchor


def _ranges(min_chars: int, q: int, hashes: int):
    t = min_chars - q + 1
    names = ["sig", "w1", "w2", "doc", "first", "most", "anchor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[] for _ in names]
        used = 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                points = code_points(text.as_py())
                for base in range(0, len(points) - min_chars + 1, CHUNK):
                    part = points[base : base + CHUNK + min_chars - 1]
                    sig, lo, hi, anchor = joined_windows(gram_hashes(part, q), t, hashes)
                    raw = memoryview(part).cast("B")
                    digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[4 * a : 4 * (b + min_chars)]) for a, b in zip(lo.tolist(), hi.tolist())]), np.int64).reshape(-1, 2)
                    own = (sig.view(np.int64), digests[:, 0], digests[:, 1].astype(np.int32), np.full(len(lo), doc, np.int64), (lo + base).astype(np.int32), (hi - lo).astype(np.int32), (anchor - lo).astype(np.int32))
                    for c, x in zip(cols, own):
                        c.append(x)
                    used += len(lo)
                    if used >= ROWS:
                        yield flush()
                        cols, used = [[] for _ in names], 0
        if used:
            yield flush()

    return run


def signed_ranges(texts: DataFrame, *, min_chars: int = MIN_CHARS, q: int = GRAM, hashes: int = HASHES) -> DataFrame:
    """Ranges of starts with one minimum under each function, by one scan of (doc, text).

    ``first`` is the first start, ``most`` how many follow, ``anchor`` how far
    the first function's minimum lies after the first start.
    """
    return texts.mapInArrow(_ranges(min_chars, q, hashes), "sig long, w1 long, w2 int, doc long, first int, most int, anchor int")


def _blocks(min_chars: int, step: int):
    fields = ["doc", "d0", "d1", "core", "context", "before", "after", "at", "least", "most"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[] for _ in fields]

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], fields)

        for batch in batches:
            for doc, text, wanted in zip(*(batch.column(c) for c in ("doc", "text", "wanted"))):
                doc, text = doc.as_py(), text.as_py()
                for w in wanted.as_py():
                    lo, hi, m = w["first"], w["first"] + w["most"], w["first"] + w["anchor"]
                    for k in range((m - hi) // step, (m - lo) // step + 1):
                        s = m - step * k
                        first, last = max(lo, s - step + 1), min(hi, s)
                        core = text[s : s + min_chars - step + 1]
                        before, after = text[first:s], text[s + min_chars - step + 1 : last + min_chars]
                        key = blake2b(core.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                        whole = blake2b(f"{len(before)} {s - last} ".encode() + key + (before + after).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                        for column, x in zip(rows, (doc, w["d0"], w["d1"], key, whole, before, after, s, s - last, s - first)):
                            column.append(x)
                    if len(rows[0]) >= ROWS:
                        yield flush()
                        rows = [[] for _ in fields]
        if rows[0]:
            yield flush()

    return run


def shared_blocks(documents: DataFrame, doc_id: str, text: str, *, min_chars: int = MIN_CHARS, q: int = GRAM, step: int = STEP, hashes: int = HASHES) -> DataFrame:
    """Rows (doc, first, last): all spans starting from first to last are shared.

    Ranges of one document may touch or overlap.
    """
    texts = documents.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where(F.col("doc").isNotNull() & (F.char_length("text") >= min_chars))
    ranges = materialize(signed_ranges(texts, min_chars=min_chars, q=q, hashes=hashes), "span-ranges")
    held = materialize(ranges.groupBy("sig").agg(F.min("doc").alias("d0"), F.max("doc").alias("d1")).where("d0 < d1").select("sig"), "span-signatures")
    # an inner join, as a semi-join would be pushed below the bitmap; ``held`` is distinct
    met = materialize(screened(ranges, F.col("sig"), held, F.col("sig")).join(held, "sig"), "span-candidates")

    content = ["sig", "w1", "w2"]
    contents = met.groupBy(*content).agg(F.min("doc").alias("d0"), F.max("doc").alias("d1"), F.min(F.struct("doc", "first", "most", "anchor")).alias("own"))
    differ = contents.groupBy("sig").agg(F.count("*").alias("n"))
    contents = materialize(contents.join(differ, "sig"), "span-contents")
    equal = met.join(contents.where("d0 < d1"), content, "left_semi").select("doc", "first", (F.col("first") + F.col("most")).alias("last"))

    # ranges of one signature that differ: one of each content, by its text
    wanted = materialize(contents.where("n > 1").groupBy(F.col("own.doc").alias("doc")).agg(F.collect_list(F.struct("own.first", "own.most", "own.anchor", "d0", "d1")).alias("wanted")), "span-rivals")
    chosen = screened(texts, F.col("doc"), wanted, F.col("doc")).join(wanted, "doc")
    blocks = materialize(
        chosen.mapInArrow(_blocks(min_chars, step), "doc long, d0 long, d1 long, core binary, context binary, before string, after string, at int, least int, most int"), "span-blocks"
    )
    context = blocks.groupBy("core", "context").agg(F.min("d0").alias("d0"), F.max("d1").alias("d1"))
    cores = context.groupBy("core").agg(F.count("*").alias("n"), F.min("d0").alias("c0"), F.max("d1").alias("c1")).where("c0 < c1")
    context = materialize(context.join(cores.select("core", "n"), "core"), "span-contexts")
    alike = context.where("d0 < d1").select("core", "context")
    new = blocks.where("d0 = d1")  # the others are among the equal ranges
    whole = new.join(alike, ["core", "context"], "left_semi").select("doc", (F.col("at") - F.col("most")).alias("first"), (F.col("at") - F.col("least")).alias("last"))

    # cores with several contexts: compare their single spans, each context once
    rivals = context.where("n > 1").select("core", "context", "d0", "d1")
    spelled = (
        blocks.drop("d0", "d1").join(rivals, ["core", "context"])
        .groupBy("core", "context").agg(F.first(F.struct("before", "after", "least", "most", "d0", "d1")).alias("b"))
        .select("core", "context", "b.*").withColumn("x", F.explode(F.sequence("least", "most")))
        .withColumn("l", F.expr("right(before, x)")).withColumn("r", F.expr(f"left(after, {step - 1} - x)"))
    )
    key = ["core", "x", "l", "r"]
    agreed = spelled.groupBy(*key).agg(F.min("d0").alias("s0"), F.max("d1").alias("s1")).where("s0 < s1").select(*key)
    # equal contexts are done as a whole
    parts = spelled.where("d0 = d1").join(agreed, key, "left_semi").select("core", "context", "x")
    single = new.join(parts, ["core", "context"]).select("doc", (F.col("at") - F.col("x")).alias("first"), (F.col("at") - F.col("x")).alias("last"))
    return equal.unionByName(whole).unionByName(single)


def shared_spans(documents: DataFrame, doc_id: str, text: str, *, min_chars: int = MIN_CHARS) -> DataFrame:
    """Maximal stretches (doc, start, length) all of whose spans are shared."""
    rows = shared_blocks(documents, doc_id, text, min_chars=min_chars).distinct()
    ahead = F.max("last").over(W.partitionBy("doc").orderBy("first", "last").rowsBetween(W.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("first") > F.coalesce(ahead, F.lit(-2)) + 1, 1).otherwise(0)).over(W.partitionBy("doc").orderBy("first", "last"))
    return rows.withColumn("i", island).groupBy("doc", "i").agg(F.min("first").alias("start"), (F.max("last") - F.min("first") + min_chars).alias("length")).drop("i")


def shared_part(documents: DataFrame, doc_id: str, text: str, *, min_chars: int = MIN_CHARS) -> DataFrame:
    """Characters of each document, and how many are in spans shared elsewhere."""
    spans = shared_spans(documents, doc_id, text, min_chars=min_chars)
    ahead = F.max(F.col("start") + F.col("length")).over(W.partitionBy("doc").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    covered = spans.withColumn("from", F.greatest("start", F.coalesce(ahead, F.lit(0)))).groupBy("doc").agg(F.sum(F.col("start") + F.col("length") - F.col("from")).alias("shared_chars"))
    sizes = documents.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n_chars"))
    return sizes.join(covered, "doc", "left").select("doc", "n_chars", F.coalesce("shared_chars", F.lit(0)).cast("long").alias("shared_chars"))
