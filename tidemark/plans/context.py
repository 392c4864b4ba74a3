"""Versioned context, grids, labels and top-k on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.clean import ident
from tidemark.operators import context as C
from tidemark.operators import labels as G
from tidemark.operators import ledgers as L
from tidemark.operators.asof import asof_prior, micros, prior_rank, with_halo
from tidemark.session import table

HOUR = 3_600_000_000


def _news(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "news").select("news_id", "item_id", "version_rank", "published_us", F.col("verified_availability_us").alias("known_us"), "title", "source_url", "record_json")


def _events(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select("event_id", "user_id", "event_type", "value", micros("ts").alias("t"))


def available_versions(spark: SparkSession, root: str) -> DataFrame:
    """Latest verified version of every item known before a cut-off."""
    cut = F.lit(1_782_000_000_000_000)
    verified = F.get_json_object("record_json", "$.historical_availability_verified") == "true"
    gate = C.available_before(verified, F.col("published_us"), F.col("known_us"), cut)
    return C.latest_versions(_news(spark, root), "item_id", "version_rank", gate).select("item_id", "news_id", "version_rank", "known_us")


def version_conflicts(spark: SparkSession, root: str) -> DataFrame:
    """Titles in conflict at one (fixture, instant) of the links."""
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", "eligible_us").dropna()
    return C.version_conflicts(f, "fixture", "eligible_us", ["news_id"])


def running_version_state(spark: SparkSession, root: str) -> DataFrame:
    """Items and best versions known after every instant, per host of the source."""
    n = _news(spark, root).select(F.regexp_extract("source_url", "^https?://([^/]+)", 1).alias("host"), "known_us", "item_id", "version_rank").dropna()
    return C.running_best(n, "host", "known_us", "item_id", "version_rank")


def news_state_chain(spark: SparkSession, root: str) -> DataFrame:
    """Hash chain of the news known per host."""
    n = _news(spark, root).select(F.regexp_extract("source_url", "^https?://([^/]+)", 1).alias("host"), "known_us", "news_id").dropna()
    return C.hash_chain(n, "host", ["known_us", "news_id"], F.concat_ws("@", "news_id", F.col("known_us").cast("string")))


def news_state_before_trade(spark: SparkSession, root: str) -> DataFrame:
    """How many links of the fixture hold strictly before each trade."""
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), F.col("eligible_us").alias("t"))
    x = table(spark, root, "trades").select("trade_row_id", ident(F.col("fixture_id")).alias("fixture"), F.col("query_us").alias("t"))
    return prior_rank(x, f, ["fixture"], "t", "n_links").select("trade_row_id", "n_links")


def fixture_coverage(spark: SparkSession, root: str) -> DataFrame:
    """Trades of each fixture with any link known before, and their share."""
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), F.col("eligible_us").alias("t"))
    x = table(spark, root, "trades").select("trade_row_id", ident(F.col("fixture_id")).alias("fixture"), F.col("query_us").alias("t"))
    n = prior_rank(x, f, ["fixture"], "t", "n_links")
    return n.groupBy("fixture").agg(F.count("*").alias("n"), F.count_if(F.col("n_links") > 0).alias("n_covered"), F.round(F.count_if(F.col("n_links") > 0) / F.count("*"), 9).alias("share"), F.min("n_links").alias("least"), F.max("n_links").alias("most"))


def title_change_points(spark: SparkSession, root: str) -> DataFrame:
    """Changes of an item's headline over time, conflicts quarantined."""
    n = _news(spark, root).select("item_id", "published_us", C.headline_key(F.col("title")).alias("title")).dropna()
    return C.change_points(n, "item_id", "published_us", "title")


def version_ranks(spark: SparkSession, root: str) -> DataFrame:
    """Ranks from 0 in the order of publication, capture and id."""
    n = _news(spark, root)
    r = F.row_number().over(W.partitionBy("item_id").orderBy(F.asc_nulls_last("published_us"), F.asc_nulls_last("known_us"), "news_id")) - 1
    return n.select("news_id", "item_id", r.cast("long").alias("rank"))


def newest_headlines(spark: SparkSession, root: str) -> DataFrame:
    """Newest five headlines of each fixture, each headline once (TK1, SF6, G14)."""
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", "eligible_us").dropna().distinct()
    j = f.join(_news(spark, root).select("news_id", "item_id", "title").dropna(subset=["title"]), "news_id")
    order = [F.desc("eligible_us"), F.col("item_id"), F.col("news_id")]
    d = C.distinct_headlines(j, "fixture", "title", order)
    return C.newest_per_scope(d, "fixture", order, 5).select("fixture", "news_id", "eligible_us", F.col("place").cast("long").alias("place"))


def version_veto(spark: SparkSession, root: str) -> DataFrame:
    """Links whose item has no higher version eligible by the same time."""
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", "eligible_us").dropna().distinct()
    j = f.join(_news(spark, root).select("news_id", "item_id", "version_rank"), "news_id")
    best = F.max("version_rank").over(W.partitionBy("fixture", "item_id").orderBy("eligible_us").rangeBetween(W.unboundedPreceding, 0))
    return j.withColumn("best", best).where("version_rank = best").select("fixture", "news_id", "eligible_us")


def scheduled_windows(spark: SparkSession, root: str) -> DataFrame:
    """Six-hour windows over each user's days with label and counts."""
    e = _events(spark, root).select("user_id", "t")
    span = e.groupBy("user_id").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    q = span.select("user_id", G.fixed_grid(F.floor(F.col("a") / (6 * HOUR)) * 6 * HOUR + 6 * HOUR, F.col("b") + 1, 6 * HOUR).alias("t"))
    line = with_halo(q.withColumn("k", F.lit(0)).unionByName(e.withColumn("k", F.lit(1))), ["user_id"], "t", back_us=24 * HOUR, ahead_us=6 * HOUR, block_us=7 * 24 * HOUR)
    n = lambda lo, hi: F.coalesce(F.sum("k").over(W.partitionBy("user_id", "__b").orderBy("t").rangeBetween(lo, hi)), F.lit(0))
    out = line.withColumns({"n_prior_24h": n(-24 * HOUR, -1), "n_next": n(0, 6 * HOUR - 1)}).where("k = 0 AND __own")
    return out.select("user_id", F.col("t").alias("query_us"), "n_prior_24h", (F.col("n_next") > 0).cast("int").alias("label"))


def monitored_windows(spark: SparkSession, root: str) -> DataFrame:
    """Hourly queries within 24 h after an order event, merged."""
    e = _events(spark, root).where("event_type = 'purchase'")
    return G.active_grid(e, ["user_id"], "t", HOUR, 24 * HOUR)


def gap_alternation(spark: SparkSession, root: str) -> DataFrame:
    """One gap and one action row per distinct instant."""
    o = table(spark, root, "orders").select("o_custkey", micros("o_orderdate").alias("t"), "o_totalprice")
    g = o.groupBy("o_custkey", "t").agg(F.count("*").alias("n"))
    g = g.withColumn("since", F.lag("t").over(W.partitionBy("o_custkey").orderBy("t")))
    row = lambda kind, a, b, n: F.struct(F.lit(kind).alias("kind"), a.alias("start_us"), b.alias("end_us"), n.alias("n"))
    zero = F.lit(0).cast("long")
    return g.select("o_custkey", F.explode(F.array(row("wait", F.col("since"), F.col("t"), zero), row("act", F.col("t"), F.col("t"), F.col("n")))).alias("x")).select("o_custkey", "x.*")


def _coverage(spark: SparkSession, root: str) -> DataFrame:
    """Observation intervals per user: four hours from each event."""
    e = _events(spark, root)
    return e.select("user_id", F.col("t").alias("start"), (F.col("t") + 4 * HOUR).alias("end"))


def merged_coverage(spark: SparkSession, root: str) -> DataFrame:
    return G.merge_intervals(_coverage(spark, root), ["user_id"])


def occurrence_labels(spark: SparkSession, root: str) -> DataFrame:
    """TRADE, NO_OBSERVED_TRADE or CENSORED for two hours after each view.

    A user is covered for twelve hours from each click. Clicks and purchases
    are a taker's actions, sign-ups a maker's, errors of unknown role.
    """
    e = _events(spark, root)
    cover = e.where("event_type = 'click'").select("user_id", F.col("t").alias("start"), (F.col("t") + 12 * HOUR).alias("end"))
    role = F.when(F.col("event_type").isin("click", "purchase"), "taker").when(F.col("event_type") == "signup", "maker").otherwise("unknown")
    windows = e.where("event_type = 'view'").select(F.col("event_id").alias("window_id"), "user_id", F.col("t").alias("start"), (F.col("t") + 2 * HOUR).alias("end"))
    actions = e.where("event_type <> 'view'").select("user_id", F.col("event_id").alias("action_id"), "t", role.alias("role"))
    return G.occurrence(windows, actions, cover, ["user_id"], horizon_us=2 * HOUR)


def historical_universe(spark: SparkSession, root: str) -> DataFrame:
    """The actors active in [t - 7 d, t) and known before t, for weekly t."""
    x = table(spark, root, "executions").where("known_us >= time_us").select(ident(F.col("actor")).alias("actor"), "time_us", "known_us").dropna()
    week = 7 * 24 * HOUR
    q = x.withColumn("query_us", (F.floor(F.col("time_us") / week) + 1) * week).where("known_us < query_us")
    return q.groupBy("query_us", "actor").agg(F.count("*").alias("n"))


def kickoff_splits(spark: SparkSession, root: str) -> DataFrame:
    """Chronological 70/15/15 split of fixtures, simultaneous ones together."""
    k = table(spark, root, "tournament_sft_v1").where("policy_version = 1").select("fixture_id", micros("kickoff_at").alias("kickoff_us")).dropna()
    return G.kickoff_split(k, "kickoff_us", [("train", 0.7), ("validation", 0.15), ("test", 0.15)]).select("fixture_id", "kickoff_us", "split")


def split_by_map_and_time(spark: SparkSession, root: str) -> DataFrame:
    """A trade's split needs the fixture map and the time range to agree."""
    m = table(spark, root, "tournament_sft_v1").where("policy_version = 1").select(ident(F.col("fixture_id")).alias("fixture"), "split", *[micros(F.to_timestamp(c)).alias(c[0]) for c in ("train_before_utc", "validation_before_utc")]).dropna(subset=["fixture"])
    x = table(spark, root, "trades").select("trade_row_id", ident(F.col("fixture_id")).alias("fixture"), "query_us").join(m, "fixture", "left")
    by_time = F.when(F.col("query_us") < F.col("t"), "train").when(F.col("query_us") < F.col("v"), "validation").when(F.col("query_us").isNotNull() & F.col("v").isNotNull(), "test")
    errors = F.array_compact(F.array(F.when(F.col("fixture").isNull(), F.lit("no_fixture")), F.when(F.col("query_us").isNull(), F.lit("no_time")), F.when(F.col("fixture").isNotNull() & F.col("split").isNull(), F.lit("no_split")), F.when(F.col("split") != by_time, F.lit("time_disagrees"))))
    return x.select(F.coalesce("split", F.lit("none")).alias("split"), F.array_join(errors, "+").alias("errors")).groupBy("split", "errors").agg(F.count("*").alias("n"))


def split_chronology(spark: SparkSession, root: str) -> DataFrame:
    """First and last order time per priority split, and whether splits follow each other."""
    s = _sequences(spark, root)
    return G.chronology(s, "split", "first_us", ["train", "validation", "test"])


def _sequences(spark: SparkSession, root: str) -> DataFrame:
    """One sequence per customer and year, split by year."""
    o = table(spark, root, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), micros("o_orderdate").alias("t"))
    late = F.pmod("o_custkey", F.lit(4)) == 0
    s = F.when(F.col("y") + late.cast("int") < 1998, "train").when(F.col("y") < 2000, "validation").otherwise("test")
    return o.groupBy("o_custkey", s.alias("split")).agg(F.min("t").alias("first_us"), F.max("t").alias("last_us"), F.count("*").alias("n"))


def purged_sequences(spark: SparkSession, root: str) -> DataFrame:
    """Whole sequences that start before an earlier split ends are purged."""
    return G.purge_overlap(_sequences(spark, root), "split", "first_us", "last_us", ["train", "validation", "test"])


def boundary_purge(spark: SparkSession, root: str) -> DataFrame:
    """Windows that cross a cut-off are left out."""
    q = monitored_windows(spark, root)
    cut = 1_705_320_000_000_000
    part = F.when(F.col("query_us") + 6 * HOUR <= cut, "train").when(F.col("query_us") >= cut, "test")
    return q.groupBy(F.coalesce(part, F.lit("purged")).alias("part")).agg(F.count("*").alias("n"))


def bottom_k_by_hash(spark: SparkSession, root: str) -> DataFrame:
    """The 100 orders with the smallest seeded hash: TakeOrderedAndProject (TK2)."""
    return table(spark, root, "orders").select("o_orderkey", F.sha2(F.concat(F.lit("seed|"), F.col("o_orderkey")), 256).alias("h")).orderBy("h", "o_orderkey").limit(100)


def negative_sampling(spark: SparkSession, root: str) -> DataFrame:
    """Non-purchases kept where a 64-bit hash falls below 5 % of its range (F19, SF17)."""
    u = F.conv(F.substring(F.sha2(F.concat(F.lit("n|"), F.col("event_id")), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return table(spark, root, "events").where(F.coalesce(F.col("event_type") == "purchase", F.lit(False)) | (u < F.lit("922337203685477580").cast("decimal(20,0)"))).select("event_id", "event_type")


def budget_selection(spark: SparkSession, root: str) -> DataFrame:
    """Per nation, customers in hash order until their orders reach 100 (TK3)."""
    n = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("cost"))
    c = table(spark, root, "customer").select("c_custkey", "c_nationkey").join(n, "c_custkey")
    h = c.withColumn("h", F.sha2(F.col("c_custkey").cast("string"), 256))
    return L.running_budget(h, [F.col("h"), F.col("c_custkey")], "cost", 100, by=["c_nationkey"]).select("c_custkey", "c_nationkey", "cost", "spent")


def round_robin(spark: SparkSession, root: str) -> DataFrame:
    """Turns over the nations: the k-th customer of each by hash, five turns (TK5)."""
    c = table(spark, root, "customer").select("c_custkey", "c_nationkey", F.sha2(F.concat(F.lit("rr"), F.col("c_custkey")), 256).alias("h"))
    return c.withColumn("turn", F.row_number().over(W.partitionBy("c_nationkey").orderBy("h", "c_custkey")).cast("long")).where("turn <= 5").drop("h")


def stratified_rows(spark: SparkSession, root: str) -> DataFrame:
    """First, last and first at or after the middle of each user's events (TK6, SK6)."""
    e = _events(spark, root)
    mid = e.groupBy("user_id").agg(((F.min("t") + F.max("t")) / 2).alias("mid"))
    at = lambda f, c=None: f("event_id", F.struct("t", "event_id") if c is None else F.when(c, F.struct("t", "event_id")))
    return e.join(mid, "user_id").groupBy("user_id").agg(at(F.min_by).alias("first_id"), at(F.max_by).alias("last_id"), at(F.min_by, F.col("t") >= F.col("mid")).alias("middle_id"))


def best_row(spark: SparkSession, root: str) -> DataFrame:
    """Best line per order by a tuple of features, and the newest order per customer (TK8)."""
    l = table(spark, root, "lineitem")
    return l.groupBy("l_orderkey").agg(F.max(F.struct("l_quantity", "l_extendedprice", "l_partkey", "l_linenumber")).alias("s")).select("l_orderkey", "s.l_quantity", "s.l_extendedprice", "s.l_partkey")


def truncated_listing(spark: SparkSession, root: str) -> DataFrame:
    """Ten newest orders with the flag that more exist (TK9)."""
    o = table(spark, root, "orders").select("o_orderkey", micros("o_orderdate").alias("t"))
    return o.orderBy(F.desc("t"), "o_orderkey").limit(10).withColumn("truncated", o.agg(F.count("*") > 10).scalar())


def position_slices(spark: SparkSession, root: str) -> DataFrame:
    """Fixtures by kick-off position in three slices, the last from each stage map (TK11)."""
    k = table(spark, root, "tournament_sft_v1").where("policy_version = 1").select("fixture_id", micros("kickoff_at").alias("t")).dropna()
    # fixtures are a calendar-sized set: one ordered pass
    p = k.withColumn("place", F.row_number().over(W.orderBy("t", "fixture_id")).cast("long"))
    return p.withColumn("slice", F.when(F.col("place").between(1, 12), "train").when(F.col("place").between(17, 20), "validation").when(F.col("place").between(25, 28), "test")).where("slice IS NOT NULL").select("fixture_id", "place", "slice")


def inner_state_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Contract context strictly before the query: last earlier page of the condition."""
    p = table(spark, root, "source_pages").select("source_page_id", micros("captured_at").alias("c"))
    t = table(spark, root, "trades").select("trade_row_id", ident(F.col("condition_id")).alias("condition"), "source_page_id", F.col("query_us").alias("t"))
    seen = t.join(p, "source_page_id").select("condition", F.col("c").alias("t"), "source_page_id").distinct()
    return asof_prior(t.select("trade_row_id", "condition", "t"), seen, ["condition"], "t", ["source_page_id"]).select("trade_row_id", F.col("prior_source_page_id").alias("page"), F.col("prior_t").alias("captured_us"))


QUERIES = {
    f.__name__: f
    for f in (
        available_versions, version_conflicts, running_version_state, news_state_chain, news_state_before_trade, fixture_coverage, title_change_points, version_ranks, newest_headlines, version_veto, scheduled_windows,
        monitored_windows, gap_alternation, merged_coverage, occurrence_labels, historical_universe, kickoff_splits, split_by_map_and_time, split_chronology, purged_sequences, boundary_purge, bottom_k_by_hash,
        negative_sampling, budget_selection, round_robin, stratified_rows, best_row, truncated_listing, position_slices, inner_state_lookup,
    )
}

_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _id(c: str) -> str:
    return f"lower(trim({c}, {_WS}))"


_E = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t FROM events)"
_LINK = f"f AS (SELECT DISTINCT {_id('fixture_id')} AS fixture, news_id, eligible_us FROM fixture_news WHERE fixture_id IS NOT NULL AND news_id IS NOT NULL AND eligible_us IS NOT NULL)"
_KEY = "trim(regexp_replace(lower(title), '\\s+', ' ', 'g'))"
_COUNT = f"""WITH f AS (SELECT {_id('fixture_id')} AS fixture, eligible_us AS t FROM fixture_news), x AS (SELECT trade_row_id, {_id('fixture_id')} AS fixture, query_us AS t FROM trades WHERE fixture_id IS NOT NULL AND query_us IS NOT NULL),
n AS (SELECT x.trade_row_id, x.fixture, count(f.fixture) AS n_links FROM x LEFT JOIN f ON x.fixture = f.fixture AND f.t < x.t GROUP BY 1, 2)"""
_GRID = f"""WITH {_E}, p AS (SELECT DISTINCT user_id, t FROM e WHERE event_type = 'purchase'), g AS (SELECT DISTINCT user_id, unnest(range((t // 3600000000 + 1) * 3600000000, t + 86400000001, 3600000000)) AS query_us FROM p)"""
_COVER = """i AS (SELECT user_id, t AS s, t + 14400000000 AS x FROM e {}), j AS (SELECT *, CASE WHEN s > max(x) OVER (PARTITION BY user_id ORDER BY s, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS b FROM i),
k AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY s, x ROWS UNBOUNDED PRECEDING) AS g FROM j), c AS (SELECT user_id, min(s) AS start, max(x) AS "end" FROM k GROUP BY user_id, g)"""
_SEQ = """WITH o AS (SELECT o_custkey, epoch_us(o_orderdate) AS t, year(o_orderdate) AS y FROM orders),
q AS (SELECT o_custkey, CASE WHEN y + (o_custkey % 4 = 0)::int < 1998 THEN 'train' WHEN y < 2000 THEN 'validation' ELSE 'test' END AS split, min(t) AS first_us, max(t) AS last_us, count(*) AS n FROM o GROUP BY 1, 2)"""

ORACLE = {
    "available_versions": """SELECT item_id, news_id, version_rank, verified_availability_us AS known_us FROM news WHERE json_extract_string(record_json, '$.historical_availability_verified') = 'true' AND verified_availability_us IS NOT NULL AND coalesce(published_us, verified_availability_us) <= verified_availability_us
AND verified_availability_us < 1782000000000000 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY version_rank DESC) = 1""",
    "version_conflicts": f"SELECT {_id('fixture_id')} AS fixture, eligible_us, count(DISTINCT news_id) AS n_contents FROM fixture_news WHERE fixture_id IS NOT NULL AND eligible_us IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT news_id) > 1",
    "running_version_state": """WITH n AS (SELECT regexp_extract(source_url, '^https?://([^/]+)', 1) AS host, verified_availability_us AS known_us, item_id, version_rank AS r FROM news WHERE verified_availability_us IS NOT NULL AND source_url IS NOT NULL AND item_id IS NOT NULL AND version_rank IS NOT NULL),
i AS (SELECT DISTINCT host, known_us FROM n), b AS (SELECT i.host, i.known_us, n.item_id, max(r) AS r FROM i JOIN n ON i.host = n.host AND n.known_us <= i.known_us GROUP BY ALL) SELECT host, known_us, count(*) AS n_items, sum(r)::bigint AS rank_sum FROM b GROUP BY 1, 2""",
    "news_state_chain": """WITH RECURSIVE n AS (SELECT regexp_extract(source_url, '^https?://([^/]+)', 1) AS scope, news_id || '@' || verified_availability_us AS p, row_number() OVER (PARTITION BY regexp_extract(source_url, '^https?://([^/]+)', 1) ORDER BY verified_availability_us, news_id) AS k FROM news WHERE verified_availability_us IS NOT NULL AND source_url IS NOT NULL),
c AS (SELECT scope, k, sha256('|' || p) AS state FROM n WHERE k = 1 UNION ALL SELECT n.scope, n.k, sha256(c.state || '|' || n.p) FROM c JOIN n ON n.scope = c.scope AND n.k = c.k + 1) SELECT * FROM c""",
    "news_state_before_trade": _COUNT + " SELECT trade_row_id, n_links FROM n",
    "fixture_coverage": _COUNT + " SELECT fixture, count(*) AS n, count(*) FILTER (WHERE n_links > 0) AS n_covered, round(count(*) FILTER (WHERE n_links > 0) / count(*), 9) AS share, min(n_links) AS least, max(n_links) AS most FROM n GROUP BY 1",
    "title_change_points": f"""WITH g AS (SELECT item_id, published_us, count(DISTINCT {_KEY}) > 1 AS conflict, min({_KEY}) AS title FROM news WHERE item_id IS NOT NULL AND published_us IS NOT NULL AND title IS NOT NULL GROUP BY 1, 2),
w AS (SELECT *, lag(title) OVER o AS p, lag(conflict) OVER o AS q FROM g WINDOW o AS (PARTITION BY item_id ORDER BY published_us)) SELECT item_id, published_us, title, conflict FROM w WHERE conflict OR p IS NULL OR q OR p <> title""",
    "version_ranks": "SELECT news_id, item_id, row_number() OVER (PARTITION BY item_id ORDER BY published_us NULLS LAST, verified_availability_us NULLS LAST, news_id) - 1 AS rank FROM news",
    "newest_headlines": f"""WITH {_LINK}, j AS (SELECT f.*, n.item_id, {_KEY} AS key FROM f JOIN news n USING (news_id) WHERE title IS NOT NULL), d AS (SELECT * FROM j WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY fixture, key ORDER BY eligible_us DESC, item_id, news_id) = 1),
p AS (SELECT fixture, news_id, eligible_us, row_number() OVER (PARTITION BY fixture ORDER BY eligible_us DESC, item_id, news_id) AS place FROM d) SELECT * FROM p WHERE place <= 5""",
    "version_veto": f"""WITH {_LINK}, j AS (SELECT f.*, item_id, version_rank AS r FROM f JOIN news USING (news_id)) SELECT fixture, news_id, eligible_us FROM j a WHERE NOT EXISTS (SELECT 1 FROM j b WHERE b.fixture = a.fixture AND b.item_id = a.item_id AND b.eligible_us <= a.eligible_us AND b.r > a.r)""",
    "scheduled_windows": f"""WITH {_E}, s AS (SELECT user_id, min(t) // 21600000000 * 21600000000 + 21600000000 AS a, max(t) AS b FROM e GROUP BY 1), q AS (SELECT user_id, unnest(range(a, b + 1, 21600000000)) AS query_us FROM s)
SELECT q.user_id, query_us, count(*) FILTER (WHERE e.t < query_us AND e.t >= query_us - 86400000000) AS n_prior_24h, (count(*) FILTER (WHERE e.t >= query_us AND e.t < query_us + 21600000000) > 0)::int AS label FROM q JOIN e ON q.user_id = e.user_id GROUP BY 1, 2""",
    "monitored_windows": _GRID + " SELECT user_id, query_us FROM g",
    "gap_alternation": """WITH g AS (SELECT o_custkey, epoch_us(o_orderdate) AS t, count(*) AS n FROM orders GROUP BY 1, 2), w AS (SELECT *, lag(t) OVER (PARTITION BY o_custkey ORDER BY t) AS p FROM g)
SELECT o_custkey, 'wait' AS kind, p AS start_us, t AS end_us, 0::bigint AS n FROM w UNION ALL SELECT o_custkey, 'act', t, t, n FROM w""",
    "merged_coverage": f"WITH {_E}, " + _COVER.format("") + " SELECT * FROM c",
    "occurrence_labels": f"WITH {_E}, " + _COVER.replace("14400000000", "43200000000").format("WHERE event_type = 'click'") + """, v AS (SELECT event_id, user_id, t, EXISTS (SELECT 1 FROM c WHERE c.user_id = e.user_id AND c.start <= e.t AND c."end" >= e.t + 7200000000) AS covered FROM e WHERE event_type = 'view' AND user_id IS NOT NULL),
o AS (SELECT *, CASE WHEN event_type IN ('click', 'purchase') THEN 'taker' WHEN event_type = 'signup' THEN 'maker' ELSE 'unknown' END AS role FROM e WHERE event_type <> 'view'),
jj AS (SELECT v.event_id AS window_id, v.covered, o.event_id AS action_id, o.t, o.role FROM v LEFT JOIN o ON o.user_id = v.user_id AND o.t >= v.t AND o.t < v.t + 7200000000),
kk AS (SELECT window_id, any_value(covered) AS covered, count(*) FILTER (WHERE role = 'unknown') AS u, count(DISTINCT action_id) FILTER (WHERE role = 'taker') AS n, min(t) FILTER (WHERE role = 'taker') AS t0 FROM jj GROUP BY 1),
f AS (SELECT kk.*, (SELECT string_agg(DISTINCT action_id::varchar, ',' ORDER BY action_id::varchar) FROM jj WHERE jj.window_id = kk.window_id AND role = 'taker' AND jj.t = kk.t0) AS ids FROM kk)
SELECT window_id, CASE WHEN NOT covered OR u > 0 THEN 'CENSORED' WHEN n > 0 THEN 'TRADE' ELSE 'NO_OBSERVED_TRADE' END AS status, CASE WHEN NOT covered THEN 'incomplete_target_source_coverage' WHEN u > 0 THEN 'unclassified_execution_role' END AS censor_reason,
 CASE WHEN covered AND u = 0 THEN n END AS action_count, CASE WHEN covered AND u = 0 THEN ids END AS first_action_ids, CASE WHEN covered AND u = 0 THEN coalesce(contains(ids, ','), false) END AS ordering_ambiguous, CASE WHEN covered AND u = 0 THEN t0 END AS first_us FROM f""",
    "historical_universe": f"""SELECT (time_us // 604800000000 + 1) * 604800000000 AS query_us, {_id('actor')} AS actor, count(*) AS n FROM executions WHERE actor IS NOT NULL AND known_us >= time_us AND known_us < (time_us // 604800000000 + 1) * 604800000000 GROUP BY 1, 2""",
    "kickoff_splits": """WITH k AS (SELECT fixture_id, epoch_us(kickoff_at) AS kickoff_us FROM tournament_sft_v1 WHERE policy_version = 1 AND fixture_id IS NOT NULL AND kickoff_at IS NOT NULL), r AS (SELECT *, rank() OVER (ORDER BY kickoff_us) - 1 AS b, count(*) OVER () AS n FROM k)
SELECT fixture_id, kickoff_us, CASE WHEN b < n * 0.7 THEN 'train' WHEN b < n * 0.85 THEN 'validation' ELSE 'test' END AS split FROM r""",
    "split_by_map_and_time": f"""WITH m AS (SELECT {_id('fixture_id')} AS fixture, split, epoch_us(train_before_utc::timestamptz) AS a, epoch_us(validation_before_utc::timestamptz) AS b FROM tournament_sft_v1 WHERE policy_version = 1 AND fixture_id IS NOT NULL),
x AS (SELECT {_id('fixture_id')} AS fixture, query_us FROM trades), j AS (SELECT x.fixture, query_us, split, CASE WHEN query_us < a THEN 'train' WHEN query_us < b THEN 'validation' WHEN query_us IS NOT NULL AND b IS NOT NULL THEN 'test' END AS bt FROM x LEFT JOIN m USING (fixture))
SELECT coalesce(split, 'none') AS split, concat_ws('+', CASE WHEN fixture IS NULL THEN 'no_fixture' END, CASE WHEN query_us IS NULL THEN 'no_time' END, CASE WHEN fixture IS NOT NULL AND split IS NULL THEN 'no_split' END, CASE WHEN split <> bt THEN 'time_disagrees' END) AS errors, count(*) AS n FROM j GROUP BY 1, 2""",
    "split_chronology": _SEQ + ", g AS (SELECT split, min(first_us) AS first_us, max(first_us) AS last_us, count(*) AS n, list_position(['train', 'validation', 'test'], split) AS p FROM q GROUP BY 1) SELECT split, first_us, last_us, n, coalesce(lag(last_us) OVER (ORDER BY p) < first_us, true) AS in_order FROM g",
    "purged_sequences": _SEQ + """, x AS (SELECT max(last_us) FILTER (WHERE split = 'train') AS a, max(last_us) FILTER (WHERE split IN ('train', 'validation')) AS b FROM q)
SELECT o_custkey, split, first_us, last_us, n FROM q, x WHERE split = 'train' OR (split = 'validation' AND first_us > a) OR (split = 'test' AND first_us > b)""",
    "boundary_purge": _GRID + " SELECT CASE WHEN query_us + 21600000000 <= 1705320000000000 THEN 'train' WHEN query_us >= 1705320000000000 THEN 'test' ELSE 'purged' END AS part, count(*) AS n FROM g GROUP BY 1",
    "bottom_k_by_hash": "SELECT o_orderkey, sha256('seed|' || o_orderkey) AS h FROM orders ORDER BY h, o_orderkey LIMIT 100",
    "negative_sampling": "SELECT event_id, event_type FROM events WHERE coalesce(event_type = 'purchase', false) OR ('0x' || substr(sha256('n|' || event_id), 1, 16))::ubigint < 922337203685477580",
    "budget_selection": """WITH c AS (SELECT c_custkey, c_nationkey, count(*) AS cost FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2), r AS (SELECT *, coalesce(sum(cost) OVER (PARTITION BY c_nationkey ORDER BY sha256(c_custkey::varchar), c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS spent FROM c) SELECT * FROM r WHERE spent < 100""",
    "round_robin": "SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY sha256('rr' || c_custkey), c_custkey) AS turn FROM customer QUALIFY turn <= 5",
    "stratified_rows": f"WITH {_E}, m AS (SELECT *, (min(t) OVER (PARTITION BY user_id) + max(t) OVER (PARTITION BY user_id)) / 2 AS mid FROM e) SELECT user_id, arg_min(event_id, (t, event_id)) AS first_id, arg_max(event_id, (t, event_id)) AS last_id, arg_min(event_id, (t, event_id)) FILTER (WHERE t >= mid) AS middle_id FROM m GROUP BY 1",
    "best_row": "SELECT l_orderkey, l_quantity, l_extendedprice, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_extendedprice DESC, l_partkey DESC, l_linenumber DESC) = 1",
    "truncated_listing": "SELECT o_orderkey, epoch_us(o_orderdate) AS t, (SELECT count(*) FROM orders) > 10 AS truncated FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10",
    "position_slices": """WITH p AS (SELECT fixture_id, row_number() OVER (ORDER BY kickoff_at, fixture_id) AS place FROM tournament_sft_v1 WHERE policy_version = 1 AND kickoff_at IS NOT NULL AND fixture_id IS NOT NULL)
SELECT fixture_id, place, CASE WHEN place <= 12 THEN 'train' WHEN place <= 20 THEN 'validation' ELSE 'test' END AS slice FROM p WHERE place BETWEEN 1 AND 12 OR place BETWEEN 17 AND 20 OR place BETWEEN 25 AND 28""",
    "inner_state_lookup": f"""WITH t AS (SELECT trade_row_id, {_id('condition_id')} AS condition, source_page_id, query_us AS t FROM trades), s AS (SELECT condition, epoch_us(captured_at) AS c, max(source_page_id) AS page FROM t JOIN source_pages p USING (source_page_id) WHERE captured_at IS NOT NULL AND condition IS NOT NULL GROUP BY 1, 2)
SELECT trade_row_id, page, c AS captured_us FROM t ASOF LEFT JOIN s ON t.condition = s.condition AND t.t > s.c""",
}
