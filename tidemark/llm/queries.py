"""Queries p1, p2, p5, p7, p8 and p9 over the whole driver tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clean import epoch_us, hex_ident, ident, outer_trim, unit_price
from tidemark.llm import leakage, mixture, nearest, overlap, spans, splits
from tidemark.operators import shards
from tidemark.session import materialize, scratch, table
from tidemark.sources import readers, sinks


def _transactions(spark: SparkSession, root: str) -> DataFrame:
    return overlap.text_classes(table(spark, root, "transactions"), "record_id", overlap.tx_text(F.col("tx")), overlap.split_name(F.col("split")))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Overlapping train and evaluation records, as TESTDATA.md defines them."""
    return overlap.overlapping_records(_transactions(spark, root))


def p1_counts(spark: SparkSession, root: str) -> DataFrame:
    """Overlaps per evaluation split and source."""
    return overlap.overlap_counts(_transactions(spark, root), "x_source")


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Nearest usable price point of each trade, as TESTDATA.md defines it."""
    points = table(spark, root, "price_history").where(unit_price(F.col("p")).isNotNull())
    return nearest.nearest_time_join(
        table(spark, root, "trades"), "trade_row_id", outer_trim(F.col("token_id")), F.col("query_us"),
        points, "point_id", outer_trim(F.col("token_id")), epoch_us(F.col("t")), tolerance_us=300_000_000,
    )


def p2_prices(spark: SparkSession, root: str) -> DataFrame:
    """The trade's price beside the point's, with the signed gap in microseconds."""
    trades = table(spark, root, "trades").select("trade_row_id", "price", "query_us")
    points = table(spark, root, "price_history").select("point_id", "p", epoch_us(F.col("t")).alias("point_us"))
    return p2_found(spark, root).join(trades, "trade_row_id").join(points, "point_id").select(
        "trade_row_id", "point_id", "price", "p", (F.col("point_us") - F.col("query_us")).alias("gap_us")
    )


def _trade_keys(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "trades").select("trade_row_id", ident(F.col("fixture_id")).alias("fixture"), hex_ident(F.col("transaction_hash")).alias("tx"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Fixtures that must share a split, as TESTDATA.md defines them."""
    labels = splits.components(splits.shared_key_edges(_trade_keys(spark, root), "fixture", "tx"))
    return splits.linked_pairs(labels).select(F.col("a").alias("fixture_a"), F.col("b").alias("fixture_b"))


def p5_classes(spark: SparkSession, root: str) -> DataFrame:
    """Every fixture that shares transactions with another, the smallest fixture of its class and the class's size."""
    labels = splits.components(splits.shared_key_edges(_trade_keys(spark, root), "fixture", "tx"))
    return splits.membership(labels).select(F.col("v").alias("fixture"), F.col("root").alias("class"), F.col("size").alias("n_fixtures"))


def _stage(c: F.Column) -> F.Column:
    s = F.regexp_replace(ident(c), "[^a-z0-9]+", " ")
    return (
        F.when(s.contains("group"), "1 group").when(s.rlike("round of 32|r32"), "2 round of 32").when(s.rlike("round of 16|r16"), "3 round of 16")
        .when(s.rlike("quarter|^qf$"), "4 quarter").when(s.rlike("semi|^sf$"), "5 semi").when(s.rlike("third|3rd"), "6 third place").when(s.contains("final"), "7 final")
    )


def _split_rows(spark: SparkSession, root: str) -> DataFrame:
    """trade_row_id, fixture, unit, stage of the unit, split."""
    rows = splits.record_units(_trade_keys(spark, root), "trade_row_id", "fixture", "tx")
    basis = table(spark, root, "tournament_sft_v1").select(ident(F.col("fixture_id")).alias("fixture"), "policy_version", _stage(F.col("fixture_partition_basis")).alias("stage"))
    latest = basis.where("fixture IS NOT NULL AND stage IS NOT NULL").groupBy("fixture").agg(F.max_by("stage", F.struct("policy_version", "stage")).alias("stage"))
    named = rows.join(latest, "fixture", "left")
    # a component over several stages counts as the latest of them
    units = named.groupBy("unit").agg(F.count("*").alias("weight"), F.coalesce(F.max("stage"), F.lit("unknown")).alias("stratum"))
    chosen = splits.assign_splits(units).select("unit", "stratum", "split")
    return named.drop("stage").join(chosen, "unit")


def p5_rows(spark: SparkSession, root: str) -> DataFrame:
    """The split of every trade."""
    return _split_rows(spark, root).select("trade_row_id", "unit", "stratum", "split")


def p5_report(spark: SparkSession, root: str) -> DataFrame:
    """Trades, fixtures and units of each stage and split."""
    return _split_rows(spark, root).groupBy("stratum", "split").agg(
        F.count("*").alias("n_rows"), F.countDistinct("fixture").alias("n_fixtures"), F.countDistinct("unit").alias("n_units")
    )


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """Items that leaked into documents, as TESTDATA.md defines them."""
    return leakage.leaked_items(table(spark, root, "eval_items"), table(spark, root, "documents"))


def p7_spans(spark: SparkSession, root: str) -> DataFrame:
    """Every leaked run with its place in the original text."""
    return leakage.leaked_items(table(spark, root, "eval_items"), table(spark, root, "documents"), spans=True)


def p8_mixture(spark: SparkSession, root: str) -> DataFrame:
    """Documents of the mixture with their number of copies."""
    return mixture.mixture(table(spark, root, "documents"), table(spark, root, "mix_targets"))[0]


def p8_report(spark: SparkSession, root: str) -> DataFrame:
    """Target, planned and reached share of every source."""
    return mixture.mixture(table(spark, root, "documents"), table(spark, root, "mix_targets"))[1]


def _capped(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    sizes = materialize(mixture.count_chars(table(spark, root, "documents")), "sizes")
    whole = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    return mixture.mix(sizes, table(spark, root, "mix_targets"), total=float(whole))


def p8_capped(spark: SparkSession, root: str) -> DataFrame:
    """A mixture as large as all documents together, by characters: sources short of their share are clamped and the rest redistributed."""
    return _capped(spark, root)[0]


def p8_capped_report(spark: SparkSession, root: str) -> DataFrame:
    """Target, planned and reached share of every source of ``p8_capped``."""
    return _capped(spark, root)[1].select("source", "target_share", "max_repeats", F.col("source_tokens").alias("source_chars"), F.col("planned_tokens").alias("planned_chars"), F.col("mixed_tokens").alias("mixed_chars"), "n_documents", "most_copies", "share_reached")


def shard_tokens(spark: SparkSession, root: str) -> DataFrame:
    """Tokens of an export of 2,000 documents a shard, counted before it was written and again from what was read back."""
    d = table(spark, root, "documents").where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "source", "text")
    ranked = shards.row_shards(d, ["doc_id"], 2000)
    path = scratch(spark, "documents")
    sinks.write_jsonl_shards(ranked, path, ["line"])
    back = readers.read_jsonl(spark, path, "doc_id long, source string, text string, line long, shard long")
    per = lambda rows, name: mixture.count_tokens(rows).join(rows.select("doc_id", "shard"), "doc_id").groupBy("shard").agg(F.count("*").alias(f"n_{name}"), F.sum("tokens").alias(f"tokens_{name}"))
    j = per(ranked, "stored").join(per(back, "recounted"), "shard", "full")
    return j.withColumn("equal", F.col("tokens_stored").eqNullSafe(F.col("tokens_recounted")) & F.col("n_stored").eqNullSafe(F.col("n_recounted")))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents with a long span of another, as TESTDATA.md defines them."""
    return spans.shared_blocks(table(spark, root, "documents"), "doc_id", "text").select(F.col("doc").alias("doc_id")).distinct()


def p9_spans(spark: SparkSession, root: str) -> DataFrame:
    """Maximal shared stretches of every document."""
    return spans.shared_spans(table(spark, root, "documents"), "doc_id", "text").select(F.col("doc").alias("doc_id"), F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length"))


def p9_shared_part(spark: SparkSession, root: str) -> DataFrame:
    """Part of each document's text that is shared elsewhere."""
    rows = spans.shared_part(table(spark, root, "documents"), "doc_id", "text")
    return rows.select(F.col("doc").alias("doc_id"), "n_chars", "shared_chars", F.round(F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(F.lit(0.0)), 6).alias("part"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_counts, p2_found, p2_prices, p5_found, p5_classes, p5_rows, p5_report, p7_found, p7_spans, p8_mixture, p8_report, p8_capped, p8_capped_report, shard_tokens, p9_found, p9_spans, p9_shared_part)
}

_WS = "' ' || chr(9) || chr(10) || chr(13)"
_TX = """
WITH n AS (SELECT record_id, source, lower(trim(split, ' ' || chr(9) || chr(10) || chr(13))) AS s, regexp_replace(regexp_replace(lower(tx), '[ \\t\\r\\n:_-]+', '', 'g'), '^0x', '') AS t FROM transactions),
r AS (SELECT record_id, source, t, CASE WHEN s IN ('train', 'training') THEN 'train' WHEN s IN ('validation', 'valid', 'val', 'dev') THEN 'validation' WHEN s = 'test' THEN 'test' END AS split
      FROM n WHERE t NOT IN ('', 'na', 'n/a', 'null', 'none') AND NOT regexp_full_match(t, '0+')),
p AS (SELECT a.record_id AS i, b.record_id AS j FROM r a JOIN r b ON a.split = 'train' AND b.split IN ('validation', 'test')
      AND (a.t = b.t OR (abs(length(a.t) - length(b.t)) <= 2 AND levenshtein(a.t, b.t) <= 2)
           OR (least(length(a.t), length(b.t)) >= 40 AND (starts_with(a.t, b.t) OR starts_with(b.t, a.t)))))
"""
_POINTS = f"""
WITH h AS (SELECT point_id, p, trim(token_id, {_WS}) AS k, CASE WHEN t >= 100000000000000 THEN t WHEN t >= 100000000000 THEN t * 1000 ELSE t * 1000000 END AS u
           FROM price_history WHERE regexp_full_match(trim(p, {_WS}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AND try_cast(trim(p, {_WS}) AS double) BETWEEN 0 AND 1),
f AS (SELECT x.trade_row_id, h.point_id, x.price, h.p, h.u - x.query_us AS gap_us FROM trades x JOIN h ON trim(x.token_id, {_WS}) = h.k AND h.u BETWEEN x.query_us - 300000000 AND x.query_us + 300000000
      QUALIFY row_number() OVER (PARTITION BY x.trade_row_id ORDER BY abs(h.u - x.query_us), h.u, h.point_id) = 1)
"""
_WORDS = """
WITH RECURSIVE raw AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM eval_items),
w AS (SELECT side, id, regexp_extract_all(replace(replace(text, chr(173), ''), chr(8203), ''), '[\\p{L}\\p{N}]+') AS ws FROM raw WHERE text IS NOT NULL),
g AS (SELECT DISTINCT side, id, lower(array_to_string(list_slice(ws, i, i + 12), ' ')) AS g FROM (SELECT side, id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13))
"""
_PLACES = """
WITH RECURSIVE raw AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM eval_items),
w AS (SELECT side, id, regexp_extract_all(text, '[\\p{L}\\p{N}](?:[\\x{AD}\\x{200B}]*[\\p{L}\\p{N}])*') AS ws, string_split_regex(text, '[\\p{L}\\p{N}](?:[\\x{AD}\\x{200B}]*[\\p{L}\\p{N}])*') AS gs FROM raw WHERE text IS NOT NULL),
u AS (SELECT side, id, ws, gs, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) >= 13),
o AS (SELECT side, id, i, lower(replace(replace(ws[i], chr(173), ''), chr(8203), '')) AS word, length(ws[i]) AS n, sum(length(gs[i]) + CASE WHEN i > 1 THEN length(ws[i - 1]) ELSE 0 END) OVER (PARTITION BY side, id ORDER BY i)::bigint AS begun FROM u),
g AS (SELECT side, id, i, begun, last_value(begun + n) OVER r AS stop, string_agg(word, ' ') OVER r AS g, count(*) OVER r AS n FROM o WINDOW r AS (PARTITION BY side, id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
m AS (SELECT i.id AS item_id, d.id AS doc_id, d.i, d.i - i.i AS shift, d.begun, d.stop FROM g i JOIN g d USING (g) WHERE i.side = 'i' AND d.side = 'd' AND i.n = 13 AND d.n = 13),
n AS (SELECT *, i - row_number() OVER (PARTITION BY item_id, doc_id, shift ORDER BY i) AS run FROM m)
"""
_SPANS = """
WITH s AS (SELECT doc_id, i, md5(substr(text, i + 1, 400)) AS h FROM (SELECT doc_id, text, unnest(range(0, length(text) - 399)) AS i FROM documents WHERE length(text) >= 400)),
k AS (SELECT h FROM s GROUP BY h HAVING min(doc_id) < max(doc_id)),
f AS (SELECT doc_id, i FROM s SEMI JOIN k USING (h))
"""

_KEY = f"replace(lower(trim(source, {_WS})), '_', '-')"
_MIX = f"""
WITH d AS (SELECT doc_id, {_KEY} AS source, length(text)::bigint AS tokens FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
a AS (SELECT {_KEY} AS source, sum(CASE WHEN target_share > 0 THEN target_share ELSE 0 END) AS share, greatest(coalesce(max(max_repeats), 0), 0) AS repeats FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
h AS (SELECT source, sum(tokens)::bigint AS tokens FROM d WHERE tokens > 0 GROUP BY source),
b AS (SELECT source, share, repeats, coalesce(tokens, 0) AS tokens, (coalesce(tokens, 0) * repeats)::double AS cap FROM a LEFT JOIN h USING (source)),
o AS (SELECT source, cap / share AS r, row_number() OVER (ORDER BY cap / share, source) AS i, ((SELECT sum(tokens) FROM d) - coalesce(sum(cap) OVER (ORDER BY cap / share, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(share) OVER (ORDER BY cap / share, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM b WHERE share > 0 AND cap > 0),
p AS (SELECT b.*, CASE WHEN share > 0 AND cap > 0 THEN least(cap, coalesce((SELECT arg_min(level, i) FROM o WHERE level <= r), 1e300) * share) ELSE 0.0 END AS planned FROM b),
c AS (SELECT source, least(floor(planned / tokens + 1e-12), repeats) AS whole, CASE WHEN floor(planned / tokens + 1e-12) < repeats THEN planned - floor(planned / tokens + 1e-12) * tokens ELSE 0 END AS rest FROM p WHERE tokens > 0 AND planned > 0),
drawn AS (SELECT doc_id, source, tokens, (whole + CASE WHEN sum(tokens) OVER (PARTITION BY source ORDER BY sha256('11|' || doc_id), doc_id) - tokens / 2 <= rest THEN 1 ELSE 0 END)::bigint AS n_copies FROM d JOIN c USING (source) WHERE tokens > 0)
"""
_COMPONENTS = f"""
WITH RECURSIVE t AS (SELECT trade_row_id, lower(trim(fixture_id, {_WS})) AS f, CASE WHEN NOT regexp_full_match(regexp_replace(lower(trim(transaction_hash, {_WS})), '^0x', ''), '0*') THEN regexp_replace(lower(trim(transaction_hash, {_WS})), '^0x', '') END AS h FROM trades),
k AS (SELECT DISTINCT f, h FROM t WHERE f IS NOT NULL AND h IS NOT NULL),
e AS (SELECT DISTINCT a.f AS a, b.f AS b FROM k a JOIN k b USING (h) WHERE a.f <> b.f),
c AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
l AS (SELECT a AS v, least(a, min(b)) AS root FROM c GROUP BY a)
"""
_UNITS = f""", kf AS (SELECT h, min(f) AS f FROM k GROUP BY h),
u AS (SELECT t.trade_row_id, t.f, coalesce('v:' || coalesce(l.root, t.f, kf.f), 'k:' || t.h, 'r:' || t.trade_row_id) AS unit FROM t LEFT JOIN kf ON t.f IS NULL AND t.h = kf.h LEFT JOIN l ON l.v = coalesce(t.f, kf.f)),
s AS (SELECT lower(trim(fixture_id, {_WS})) AS f, policy_version AS pv, regexp_replace(lower(trim(fixture_partition_basis, {_WS})), '[^a-z0-9]+', ' ', 'g') AS b FROM tournament_sft_v1 WHERE fixture_id IS NOT NULL),
g AS (SELECT f, pv, CASE WHEN contains(b, 'group') THEN '1 group' WHEN regexp_matches(b, 'round of 32|r32') THEN '2 round of 32' WHEN regexp_matches(b, 'round of 16|r16') THEN '3 round of 16' WHEN regexp_matches(b, 'quarter|^qf$') THEN '4 quarter'
  WHEN regexp_matches(b, 'semi|^sf$') THEN '5 semi' WHEN regexp_matches(b, 'third|3rd') THEN '6 third place' WHEN contains(b, 'final') THEN '7 final' END AS stage FROM s),
gl AS (SELECT f, stage FROM g WHERE stage IS NOT NULL QUALIFY row_number() OVER (PARTITION BY f ORDER BY pv DESC NULLS LAST, stage DESC) = 1),
named AS (SELECT u.*, gl.stage FROM u LEFT JOIN gl USING (f)),
w AS (SELECT unit, count(*) AS weight, coalesce(max(stage), 'unknown') AS stratum, sha256('7|' || unit) AS h FROM named GROUP BY unit),
o AS (SELECT *, sum(weight) OVER (PARTITION BY stratum ORDER BY length(bin(weight)) DESC, h[1:2], h, unit) AS upto, sum(weight) OVER (PARTITION BY stratum) AS whole FROM w),
cut AS (SELECT unit, stratum, CASE WHEN (upto - weight / 2) / whole < 0.8 THEN 'train' WHEN (upto - weight / 2) / whole < 0.9 THEN 'validation' ELSE 'test' END AS split FROM o)
"""

ORACLE = {
    "p1_found": _TX + "SELECT least(i, j) AS record_a, greatest(i, j) AS record_b FROM p",
    "p1_counts": _TX + """SELECT split, source, count(*) AS n_records, count(c) AS n_overlapping, coalesce(sum(c), 0)::bigint AS n_pairs
FROM r LEFT JOIN (SELECT j AS record_id, count(*) AS c FROM p GROUP BY j) USING (record_id) WHERE split IN ('validation', 'test') GROUP BY split, source""",
    "p2_found": _POINTS + "SELECT trade_row_id, point_id FROM f",
    "p2_prices": _POINTS + "SELECT trade_row_id, point_id, price, p, gap_us FROM f",
    "p5_found": f"""
WITH RECURSIVE k AS (SELECT DISTINCT lower(trim(fixture_id, {_WS})) AS f, regexp_replace(lower(trim(transaction_hash, {_WS})), '^0x', '') AS h FROM trades WHERE fixture_id IS NOT NULL),
e AS (SELECT DISTINCT a.f AS a, b.f AS b FROM k a JOIN k b USING (h) WHERE NOT regexp_full_match(a.h, '0*') AND a.f <> b.f),
c AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a)
SELECT a AS fixture_a, b AS fixture_b FROM c WHERE a < b""",
    "p5_classes": _COMPONENTS + "SELECT v AS fixture, root AS class, count(*) OVER (PARTITION BY root) AS n_fixtures FROM l WHERE v IN (SELECT a FROM e)",
    "p5_rows": _COMPONENTS + _UNITS + "SELECT trade_row_id, unit, stratum, split FROM named JOIN cut USING (unit)",
    "p5_report": _COMPONENTS + _UNITS + "SELECT stratum, split, count(*) AS n_rows, count(DISTINCT f) AS n_fixtures, count(DISTINCT unit) AS n_units FROM named JOIN cut USING (unit) GROUP BY 1, 2",
    "p7_found": _WORDS + "SELECT DISTINCT i.id AS item_id, d.id AS doc_id FROM g i JOIN g d USING (g) WHERE i.side = 'i' AND d.side = 'd'",
    "p7_spans": _PLACES + """SELECT DISTINCT item_id, doc_id, min(begun)::bigint AS start, max(stop)::bigint AS "end", count(*) + 12 AS n_words FROM n GROUP BY item_id, doc_id, shift, run""",
    "p8_capped": _MIX + "SELECT doc_id, source, tokens, n_copies FROM drawn WHERE n_copies > 0",
    "p8_capped_report": _MIX + """, m AS (SELECT source, sum(tokens * n_copies)::bigint AS mixed, count(*) AS docs, max(n_copies) AS most FROM drawn WHERE n_copies > 0 GROUP BY source)
SELECT source, share AS target_share, repeats AS max_repeats, tokens AS source_chars, round(planned, 3) AS planned_chars, coalesce(mixed, 0) AS mixed_chars, coalesce(docs, 0) AS n_documents, coalesce(most, 0) AS most_copies,
round(coalesce(mixed, 0) / sum(mixed) OVER (), 9) AS share_reached FROM p LEFT JOIN m USING (source)""",
    "p9_found": _SPANS + "SELECT DISTINCT doc_id FROM f",
    "p9_spans": _SPANS + """, n AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM f)
SELECT doc_id, min(i) AS start, max(i) - min(i) + 400 AS length FROM n GROUP BY doc_id, g""",
    "p9_shared_part": _SPANS + """, n AS (SELECT doc_id, least(400, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 400)) AS c FROM f), t AS (SELECT doc_id, sum(c)::bigint AS c FROM n GROUP BY doc_id)
SELECT doc_id, coalesce(length(text), 0)::bigint AS n_chars, coalesce(c, 0)::bigint AS shared_chars, round(CASE WHEN length(text) > 0 THEN coalesce(c, 0) / length(text) ELSE 0 END, 6) AS part FROM documents LEFT JOIN t USING (doc_id)""",
}
