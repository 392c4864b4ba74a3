"""Queries p3, p4 and p6 over the whole driver tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clean import ident
from tidemark.operators.delivery import repeated_rows
from tidemark.operators.features import clean_executions, entity_features, listed_actors, type_list, typed_totals
from tidemark.operators.versions import version_join
from tidemark.session import table


def _typed(spark: SparkSession, root: str) -> DataFrame:
    return typed_totals(clean_executions(table(spark, root, "executions")), "actor", "type", "execution")


def p3_features(spark: SparkSession, root: str) -> DataFrame:
    """One row per actor; ``features`` lists n,last_us,shares,notional per type, in the order of ``p3_types``."""
    rows = entity_features(_typed(spark, root), "actor", "type", listed_actors(table(spark, root, "executions")))
    text = F.transform("features", lambda f: F.concat_ws(",", f["n"].cast("string"), F.coalesce(f["last_us"].cast("string"), F.lit("")), f["shares"].cast("string"), f["notional"].cast("string")))
    return rows.select("actor", F.col("n_types").cast("long").alias("n_types"), F.array_join(text, ";").alias("features"))


def p3_types(spark: SparkSession, root: str) -> DataFrame:
    """Event types in the order of the feature arrays, with their totals."""
    totals = _typed(spark, root)
    place = type_list(totals, "type").select(F.posexplode("types").alias("position", "type"))
    whole = totals.groupBy("type").agg(F.count("*").alias("n_actors"), F.sum("n").alias("n_executions"))
    return place.join(whole, "type").select(F.col("position").cast("long").alias("position"), "type", "n_actors", "n_executions")


def _deliveries(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "source_pages").select("source_page_id", F.datediff(F.col("captured_at").cast("date"), F.lit("1970-01-01").cast("date")).alias("captured_day"), "path")
    rows = table(spark, root, "trades").select("trade_row_id", "observation_id", "source_page_id", "source_line")
    return rows.join(pages, "source_page_id", "left")


def _gone(rows: DataFrame) -> DataFrame:
    return repeated_rows(rows, "trade_row_id", ident(F.col("observation_id")), [F.col("source_page_id"), F.col("source_line")], F.col("captured_day"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """Trades that must go, as TESTDATA.md defines them; buckets are capture days."""
    return _gone(_deliveries(spark, root))


def p4_pages(spark: SparkSession, root: str) -> DataFrame:
    """Rows, repeats and remaining rows of every source page."""
    rows = _deliveries(spark, root)
    gone = _gone(rows).withColumn("gone", F.lit(1))
    return rows.join(gone, "trade_row_id", "left").groupBy("source_page_id").agg(
        F.count("*").alias("n_rows"), F.count("gone").alias("n_repeats"), (F.count("*") - F.count("gone")).alias("n_kept"),
    )


def _news_at_trades(spark: SparkSession, root: str) -> DataFrame:
    links = table(spark, root, "fixture_news").select("fixture_id", "news_id", "eligible_us")
    news = table(spark, root, "news").select("news_id", "version_rank", "verified_availability_us", "title")
    changes = links.where("eligible_us IS NOT NULL").join(news.where("verified_availability_us IS NOT NULL"), "news_id")
    holds: Column = F.greatest("eligible_us", "verified_availability_us")
    return version_join(
        table(spark, root, "trades"), "trade_row_id", ident(F.col("fixture_id")), F.col("query_us"),
        changes, ident(F.col("fixture_id")), holds, ["news_id", "title"],
        [F.coalesce(-F.col("version_rank"), F.lit(2**31 - 1)), F.col("news_id")],
    )


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """News in force at each trade, as TESTDATA.md defines it."""
    return _news_at_trades(spark, root).select("trade_row_id", "news_id")


def p6_attributes(spark: SparkSession, root: str) -> DataFrame:
    """The same with the news' attributes, the instant it holds from and its number."""
    return _news_at_trades(spark, root).select("trade_row_id", "news_id", "title", "holds_from_us", "version")


QUERIES = {f.__name__: f for f in (p3_features, p3_types, p4_found, p4_pages, p6_found, p6_attributes)}

_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _sql_ident(c: str) -> str:
    return f"lower(trim({c}, {_WS}))"


_EXEC = f"""
WITH raw AS (
  SELECT {_sql_ident('actor')} AS actor, coalesce('i' || trim(execution_id, {_WS}), 'r' || to_json(struct_pack(a := actor, c := condition_id, t := time_us, s := side, sh := shares, p := price))::varchar) AS execution,
         time_us, regexp_replace({_sql_ident('condition_id')}, '^0x', '') AS condition,
         CASE WHEN upper(trim(side, {_WS})) IN ('BUY', 'SELL') THEN upper(trim(side, {_WS})) END AS side,
         try_cast(trim(shares, {_WS}) AS decimal(20, 8)) AS shares, try_cast(trim(price, {_WS}) AS decimal(13, 12)) AS price
  FROM executions WHERE {_sql_ident('actor')} <> ''),
one AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY actor, execution ORDER BY time_us NULLS FIRST, condition NULLS FIRST, side NULLS FIRST, shares NULLS FIRST, price NULLS FIRST) = 1),
good AS (SELECT actor, condition || '/' || side AS type, time_us, CASE WHEN shares > 0 AND price BETWEEN 0 AND 1 THEN shares END AS shares,
           CASE WHEN shares > 0 AND price BETWEEN 0 AND 1 THEN shares * price END AS notional
         FROM one WHERE condition <> '' AND side IS NOT NULL),
tot AS (SELECT actor, type, count(*) AS n, max(time_us) AS last_us, coalesce(sum(shares), 0)::decimal(38, 8) AS shares, coalesce(sum(notional), 0)::decimal(38, 20) AS notional
        FROM good GROUP BY ALL)
"""
_NEWS = f"""
WITH c AS (SELECT {_sql_ident('l.fixture_id')} AS f, l.news_id, n.title, coalesce(-n.version_rank, 2147483647) AS r, greatest(l.eligible_us, n.verified_availability_us) AS t
           FROM fixture_news l JOIN news n USING (news_id) WHERE l.eligible_us IS NOT NULL AND n.verified_availability_us IS NOT NULL AND l.fixture_id IS NOT NULL),
w AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY f, t ORDER BY r, news_id) = 1),
v AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY t) AS version FROM w)
"""
_FORCE = f"FROM trades x ASOF JOIN v ON {_sql_ident('x.fixture_id')} = v.f AND x.query_us > v.t"
_GONE = f"""SELECT trade_row_id FROM trades WHERE observation_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {_sql_ident('observation_id')} ORDER BY source_page_id, source_line, trade_row_id) > 1"""

ORACLE = {
    "p3_features": _EXEC + """, types AS (SELECT DISTINCT type FROM tot), actors AS (SELECT DISTINCT actor FROM tot)
SELECT actor, count(*) AS n_types, string_agg(coalesce(n, 0)::varchar || ',' || coalesce(last_us::varchar, '') || ',' || coalesce(shares, 0)::decimal(38, 8)::varchar || ',' || coalesce(notional, 0)::decimal(38, 20)::varchar, ';' ORDER BY type) AS features
FROM actors CROSS JOIN types LEFT JOIN tot USING (actor, type) GROUP BY actor""",
    "p3_types": _EXEC + "SELECT row_number() OVER (ORDER BY type) - 1 AS position, type, count(*) AS n_actors, sum(n)::bigint AS n_executions FROM tot GROUP BY type",
    "p4_found": _GONE,
    "p4_pages": f"""WITH gone AS ({_GONE})
SELECT source_page_id, count(*) AS n_rows, count(g.trade_row_id) AS n_repeats, count(*) - count(g.trade_row_id) AS n_kept FROM trades x LEFT JOIN gone g USING (trade_row_id) GROUP BY 1""",
    "p6_found": _NEWS + "SELECT trade_row_id, news_id " + _FORCE,
    "p6_attributes": _NEWS + "SELECT trade_row_id, news_id, title, t AS holds_from_us, version " + _FORCE,
}
