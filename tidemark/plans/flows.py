"""Sources, sinks and streams on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clean import ident
from tidemark.operators.shards import byte_shards, row_shards
from tidemark.operators.asof import prior_totals
from tidemark.plans.dealt import _FORCE, _NEWS
from tidemark.session import scratch, table
from tidemark.sources import readers, sinks
from tidemark.streaming import jobs


def sharded_export(spark: SparkSession, root: str) -> DataFrame:
    """Orders in gzip JSON-lines shards of 4,000 rows, published, read back and verified (SK1, SK3, SK4, SC1)."""
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    s = row_shards(o, ["o_orderkey"], 4000)
    path = scratch(spark, "orders")
    sinks.write_jsonl_shards(s, path, ["line"])
    back = readers.read_jsonl(spark, path, "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string, line long, shard long")
    sinks.verify(s, back.select(*s.columns))
    return back.groupBy("shard").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.max("line").alias("last_line"))


def byte_sized_shards(spark: SparkSession, root: str) -> DataFrame:
    """News shards by bytes of their record (SK2)."""
    n = table(spark, root, "news").select("news_id", F.octet_length(F.concat_ws("|", "news_id", "item_id", "title", "record_json")).alias("bytes"))
    return byte_shards(n, ["news_id"], F.col("bytes"), 16_384).groupBy("shard").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("news_id").alias("first_id"))


def csv_aliases(spark: SparkSession, root: str) -> DataFrame:
    """A CSV with other column names, read through the alias projection (SC3, SK9)."""
    path = scratch(spark, "trades") + ".csv"
    t = table(spark, root, "trades").where("observation_id IS NOT NULL").select(F.col("trade_row_id").alias("rowId"), F.col("wallet").alias("proxyWallet"), F.col("price").alias("Price"), F.col("shares").alias("size"))
    sinks.publish(t, path, "csv", header="true", emptyValue="", nullValue="\\N")
    r = readers.project_aliases(readers.read_rows(spark, path).na.replace("\\N", None), {"id": ["trade_row_id", "rowId"], "wallet": ["wallet", "proxyWallet"], "price": ["price"], "shares": ["shares", "size"], "memo": ["memo"]})
    return r.agg(F.count("*").alias("n"), F.countDistinct(ident(F.col("wallet"))).alias("n_wallets"), F.count("memo").alias("n_memo"), F.sum(F.col("id").cast("long")).alias("id_sum"))


def capture_index(spark: SparkSession, root: str) -> DataFrame:
    """Index lines built from pages, filtered and reduced to one row a digest (SC16)."""
    p = table(spark, root, "source_pages").where("uncompressed_sha256 IS NOT NULL AND path IS NOT NULL")
    digest = F.upper(F.translate(F.substring("uncompressed_sha256", 1, 32), "0189", "GHIJ"))
    lines = p.select(F.concat_ws(" ", F.lit("k"), F.coalesce(F.date_format("captured_at", "yyyyMMddHHmmss"), F.lit("-")), F.replace(F.lower("path"), F.lit(" "), F.lit("")), F.lit("text/html"), F.when(F.col("row_count") > 0, "200").otherwise("404"), digest).alias("value"))
    return readers.cdx_rows(lines, "20260701000000")


def context_index(spark: SparkSession, root: str) -> DataFrame:
    """The context index: every trade with its mapping, news in force and links before it, written partitioned and read back (SK5, J1, J9).

    One pass over the trades: link counts and the latest news come from the
    same blocks, so no trade is shuffled twice or joined back.
    """
    t = table(spark, root, "trades").select("trade_row_id", ident(F.col("fixture_id")).alias("fixture"), ident(F.col("condition_id")).alias("condition"), F.col("query_us").alias("t"), "token_mapping_status")
    links = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", F.col("eligible_us").alias("t"))
    news = table(spark, root, "news").select("news_id", "version_rank", F.col("verified_availability_us").alias("known"))
    held = links.where("t IS NOT NULL").join(news.where("known IS NOT NULL"), "news_id").select("fixture", F.greatest("t", "known").alias("t"), F.struct(F.coalesce(-F.col("version_rank"), F.lit(2**31 - 1)), "news_id").alias("x"))
    changes = held.groupBy("fixture", "t").agg(F.min("x").alias("x")).select("fixture", "t", F.lit(0).cast("long").alias("n"), "x.news_id")
    events = changes.unionByName(links.select("fixture", "t", F.lit(1).cast("long").alias("n"), F.lit(None).cast("string").alias("news_id")))
    got = prior_totals(t, events, ["fixture"], "t", {"n_links": F.col("n")}, last={"news_id": F.col("news_id")})
    rest = t.where("fixture IS NULL OR t IS NULL")
    rows = got.unionByName(rest, allowMissingColumns=True).withColumn("month", F.coalesce(F.date_format(F.timestamp_micros("t"), "yyyy-MM"), F.lit("none")))
    path = scratch(spark, "context-index")
    sinks.publish(rows, path, by=["month"])
    return readers.read_rows(spark, path, "trade_row_id long, n_links long, news_id string, month string").select("trade_row_id", "news_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("month").cast("string").alias("month"))


def schedule(spark: SparkSession, root: str) -> DataFrame:
    """Quarter-hour batches between the first and last publication (SC18)."""
    lo, hi = table(spark, root, "news").agg(F.min("published_us"), F.max("published_us")).first()
    return readers.batch_schedule(spark, lo or 0, hi or 0)


def stream_windows(spark: SparkSession, root: str) -> DataFrame:
    """Daily windows per event type as a stream (§2.14, G1)."""
    e = jobs.stream_table(spark, root, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    out = jobs.drain(jobs.tumbling_counts(e, "ts", "1 day", "0 seconds", ["event_type"]), "windows", mode="complete")
    return out.select(F.unix_micros("window.start").alias("start_us"), "event_type", "n", F.round("total", 4).alias("total"))


def stream_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Sessions of users with a gap of six hours as a stream; the end of the table closes the last (§2.14)."""
    e = jobs.stream_table(spark, root, "events", time="ts", end="7 HOURS").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    out = jobs.drain(jobs.sessions(e, "ts", "6 hours", "0 seconds", ["user_id"]), "sessions")
    return out.select("user_id", F.unix_micros("session_window.start").alias("start_us"), F.unix_micros("session_window.end").alias("end_us"), "n")


def stream_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Stateful average-cost inventory of orders as a stream (A9, §2.14)."""
    o = jobs.stream_table(spark, root, "orders", time="o_orderdate", end="1 DAY").select(F.col("o_custkey").cast("string").alias("key"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.when(F.col("o_orderstatus") == "F", "SELL").otherwise("BUY").alias("side"), F.lit(1.0).alias("shares"), (F.col("o_totalprice") / 1000).alias("price"))
    out = jobs.drain(jobs.running_inventory(o, "0 seconds"), "inventory")
    return out.groupBy("key").agg(F.count("*").alias("n_instants"), F.max("time_us").alias("last_us"), F.count("quantity").alias("n_known"))


QUERIES = {f.__name__: f for f in (sharded_export, byte_sized_shards, csv_aliases, capture_index, context_index, schedule, stream_windows, stream_sessions, stream_inventory)}

_WS = "' ' || chr(9) || chr(10) || chr(13)"

ORACLE = {
    "sharded_export": """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) SELECT i // 4000 + 1 AS shard, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, max(i % 4000) + 1 AS last_line FROM r GROUP BY 1""",
    "byte_sized_shards": """WITH n AS (SELECT news_id, strlen(concat_ws('|', news_id, item_id, title, record_json)) AS b FROM news), r AS (SELECT *, coalesce(sum(b) OVER (ORDER BY news_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS p FROM n)
SELECT p // 16384 AS shard, count(*) AS n, sum(b)::bigint AS bytes, min(news_id) AS first_id FROM r GROUP BY 1""",
    "csv_aliases": f"SELECT count(*) AS n, count(DISTINCT lower(trim(wallet, {_WS}))) AS n_wallets, 0::bigint AS n_memo, sum(trade_row_id)::bigint AS id_sum FROM trades WHERE observation_id IS NOT NULL",
    "capture_index": """WITH p AS (SELECT replace(lower(path), ' ', '') AS url, upper(translate(substr(uncompressed_sha256, 1, 32), '0189', 'GHIJ')) AS digest, strftime(captured_at, '%Y%m%d%H%M%S') AS stamp, row_count FROM source_pages)
SELECT url, digest, min(stamp) AS stamp FROM p WHERE row_count > 0 AND stamp < '20260701000000' AND url IS NOT NULL AND regexp_full_match(digest, '[A-Z2-7]{32}') GROUP BY 1, 2""",
    "context_index": _NEWS + f""", g AS (SELECT trade_row_id, news_id {_FORCE}), l AS (SELECT x.trade_row_id, count(*) AS n FROM trades x JOIN fixture_news f ON lower(trim(x.fixture_id, {_WS})) = lower(trim(f.fixture_id, {_WS})) AND f.eligible_us < x.query_us GROUP BY 1)
SELECT x.trade_row_id, g.news_id, coalesce(l.n, 0) AS n_links, coalesce(strftime(make_timestamp(x.query_us), '%Y-%m'), 'none') AS month FROM trades x LEFT JOIN g USING (trade_row_id) LEFT JOIN l USING (trade_row_id)""",
    "schedule": """WITH b AS (SELECT (min(published_us) + 899999999) // 900000000 * 900000000 AS a, max(published_us) AS z FROM news), s AS (SELECT unnest(range(a, z, 900000000)) AS batch_us FROM b) SELECT batch_us, strftime(make_timestamp(batch_us), '%Y%m%d%H%M%S') AS stamp FROM s""",
    "stream_windows": "SELECT epoch_us(ts) // 86400000000 * 86400000000 AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "stream_inventory": """WITH g AS (SELECT o_custkey::varchar AS key, epoch_us(o_orderdate) AS t, sum(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END) AS d FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, sum(d) OVER (PARTITION BY key ORDER BY t) AS q FROM g), k AS (SELECT *, min(q) OVER (PARTITION BY key ORDER BY t) AS low FROM c) SELECT key, count(*) AS n_instants, max(t) AS last_us, count(*) FILTER (WHERE low >= 0) AS n_known FROM k GROUP BY 1""",
    "stream_sessions": """WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events WHERE ts IS NOT NULL), g AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY user_id ORDER BY t) >= 21600000000, true)::int AS new FROM e), i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t) AS s FROM g)
SELECT user_id, min(t) AS start_us, max(t) + 21600000000 AS end_us, count(*) AS n FROM i GROUP BY user_id, s""",
}
