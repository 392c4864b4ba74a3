"""Mixing sources to target weights.

``count_tokens`` counts every whole text with a public tokenizer (its file is a
parameter), ``water_fill`` finds how many tokens each source gives, and
``draw_mixture`` samples the whole and fractional repetitions.

``water_fill`` clamps a source that would need more than its capacity (tokens
times allowed repetitions), redistributes the excess in proportion to the
shares of the others, and repeats until nothing exceeds. Without a stated total
it takes the largest one at which every source that has tokens holds its share.

The fractional part of a source takes documents in seeded hash order until its
tokens are reached, within half a document. The running sum is two-level, over
4,096 hash buckets and then inside the one bucket where the bound falls, so a
source with a third of all tokens is never sorted in one task.

Defined cases: sources compare in lower case, without outer white space, with
``_`` as ``-``; documents of a null or untargeted source and without tokens are
not used; a target without documents gets nothing and its share goes to the
others; a null or non-positive share or cap counts as 0; every document counts
on its own, also a repeated one.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.clean import ident
from tidemark.session import materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenizing pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longest piece given to the tokenizer at once, cut at a blank before a letter.
PIECE = 1 << 17

_LOADED: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    if path not in _LOADED:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def source_key(c: Column) -> Column:
    return F.regexp_replace(ident(c), "_", "-")


def _pieces(text: str) -> Iterator[str]:
    """Parts whose token counts add up: no pre-token crosses blank-letter after a letter."""
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut < len(text) - 1 and not (text[cut] == " " and text[cut - 1].isalpha() and text[cut + 1].isalpha()):
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            n = [sum(len(encode(p)) for p in _pieces(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n, pa.int64())], ["doc_id", "source", "tokens"])

    return run


def count_tokens(documents: DataFrame, *, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens) of every document with text; ``source`` is canonical."""
    rows = documents.select(F.col("doc_id").cast("long"), source_key(F.col("source")).alias("source"), "text").where("text IS NOT NULL")
    return rows.mapInArrow(_count(tokenizer), "doc_id long, source string, tokens long")


def count_chars(documents: DataFrame) -> DataFrame:
    """The same with code points in place of tokens, where no tokenizer is at hand."""
    return documents.select(F.col("doc_id").cast("long"), source_key(F.col("source")).alias("source"), F.char_length("text").cast("long").alias("tokens")).where("text IS NOT NULL")


def water_fill(shares: dict[str, float], capacity: dict[str, float], total: float | None = None) -> dict[str, float]:
    """Tokens of each source: its share of ``total``, at most its capacity."""
    open_ = {s for s in shares if shares[s] > 0 and capacity.get(s, 0) > 0}
    given = dict.fromkeys(shares, 0.0)
    if not open_:
        return given
    whole = sum(shares[s] for s in open_)
    if total is None:
        total = min(capacity[s] * whole / shares[s] for s in open_)
    left = float(total)
    while open_ and left > 0:
        whole = sum(shares[s] for s in open_)
        over = {s for s in open_ if left * shares[s] / whole > capacity[s]}
        for s in over or open_:
            given[s] = float(capacity[s]) if over else left * shares[s] / whole
        if not over:
            break
        left -= sum(given[s] for s in over)
        open_ -= over
    return given


def plan_mixture(counts: DataFrame, targets: DataFrame, *, total: float | None = None, max_sources: int = 100_000) -> list[tuple]:
    """(source, target_share, max_repeats, tokens, planned tokens) of each target source.

    The targets are a configuration table; more than ``max_sources`` is an error.
    """
    asked = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").where("source IS NOT NULL")
    asked = asked.groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("repeats"))
    have = counts.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("tokens"))
    rows = asked.join(have, "source", "left").orderBy("source").limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError("too many target sources")
    share = {r.source: r.share if r.share and r.share > 0 and math.isfinite(r.share) else 0.0 for r in rows}
    repeats = {r.source: max(r.repeats or 0, 0) for r in rows}
    tokens = {r.source: r.tokens or 0 for r in rows}
    given = water_fill(share, {s: tokens[s] * repeats[s] for s in tokens}, total)
    return [(s, share[s], repeats[s], tokens[s], given[s]) for s in share]


def draw_mixture(counts: DataFrame, plan: list[tuple], *, seed: int = 11) -> DataFrame:
    """(doc_id, source, tokens, n_copies) of every document used."""
    spark = counts.sparkSession
    drawn = []
    for source, _, cap, tokens, given in plan:
        if tokens and given > 0:
            whole = min(int(given // tokens + 1e-12), cap)
            drawn.append((source, whole, given - whole * tokens if whole < cap else 0.0))
    choice = F.broadcast(spark.createDataFrame(drawn, "source string, whole int, rest double"))  # one row a target source
    rows = counts.where("tokens > 0").join(choice, "source").withColumn("__h", F.sha2(F.concat_ws("|", F.lit(seed), "doc_id"), 256)).withColumn("__b", F.conv(F.substring("__h", 1, 3), 16, 10).cast("int"))
    sums = rows.groupBy("source", "__b").agg(F.sum("tokens").alias("__w"))
    base = F.coalesce(F.sum("__w").over(W.partitionBy("source").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("__base", base)
    # only the bucket in which the bound falls is ordered
    placed = rows.join(sums, ["source", "__b"])
    cut = (F.col("__base") < F.col("rest")) & (F.col("__base") + F.col("__w") > F.col("rest"))
    inside = F.sum("tokens").over(W.partitionBy("source", "__b").orderBy("__h", "doc_id").rowsBetween(W.unboundedPreceding, 0))
    some = placed.where(cut).withColumn("extra", (F.col("__base") + inside - F.col("tokens") / 2 <= F.col("rest")).cast("int"))
    rest = placed.where(~cut).withColumn("extra", (F.col("__base") + F.col("__w") <= F.col("rest")).cast("int"))
    out = some.unionByName(rest).select("doc_id", "source", "tokens", (F.col("whole") + F.col("extra")).cast("long").alias("n_copies"))
    return out.where("n_copies > 0")


def mixture(documents: DataFrame, targets: DataFrame, *, total: float | None = None, tokenizer: str = TOKENIZER, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """The mixture, and the report of shares reached."""
    return mix(materialize(count_tokens(documents, tokenizer=tokenizer), "token-counts"), targets, total=total, seed=seed)


def mix(counts: DataFrame, targets: DataFrame, *, total: float | None = None, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """The same from stored sizes (doc_id, source, tokens), whatever they count."""
    plan = plan_mixture(counts, targets, total=total)
    drawn = draw_mixture(counts, plan, seed=seed)
    got = drawn.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n_copies")).alias("mixed"), F.count("*").alias("docs"), F.max("n_copies").alias("most"))
    named = counts.sparkSession.createDataFrame(plan, "source string, target_share double, max_repeats int, tokens long, planned double")
    whole = F.sum(F.coalesce("mixed", F.lit(0))).over(W.partitionBy())  # one row a target source
    report = named.join(F.broadcast(got), "source", "left").select(
        "source", "target_share", "max_repeats", F.col("tokens").alias("source_tokens"), F.round("planned", 3).alias("planned_tokens"), F.coalesce("mixed", F.lit(0)).cast("long").alias("mixed_tokens"),
        F.coalesce("docs", F.lit(0)).alias("n_documents"), F.coalesce("most", F.lit(0)).alias("most_copies"), F.round(F.coalesce("mixed", F.lit(0)) / whole, 9).alias("share_reached"),
    )
    return drawn, report
