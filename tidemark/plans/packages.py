"""Normalised rows, request addresses, samples, evidence packages and state pointers on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.clean import amount, hex_ident, ident, outer_trim
from tidemark.functions.scalars import EVENT_TERMS, decimal_text, kind_matches, request_url, strict_json
from tidemark.operators import context as C
from tidemark.operators import relevance as R
from tidemark.operators import shards
from tidemark.operators.asof import asof_prior, micros, prior_rank, prior_totals
from tidemark.plans import textual as T
from tidemark.session import materialize, scratch, table
from tidemark.sources import readers, sinks

HOUR = 3_600_000_000


def normalised_trades(spark: SparkSession, root: str) -> DataFrame:
    """Usable trades with every field in canonical form and a digest of the whole row (SF16, SF4, SF14)."""
    t = table(spark, root, "trades")
    cols = {
        "wallet": ident(F.col("wallet")), "condition": hex_ident(F.col("condition_id")), "token": outer_trim("token_id"), "side": F.upper(outer_trim("side")), "shares": decimal_text(F.col("shares")), "price": decimal_text(F.col("price")),
        "fixture": ident(F.col("fixture_id")), "tx": hex_ident(F.col("transaction_hash")), "t": F.col("query_us"),
    }
    n = t.select("trade_row_id", *[c.alias(k) for k, c in cols.items()], amount(F.col("shares"), 38, 18).alias("s"), amount(F.col("price"), 38, 18).alias("p"))
    good = n.where("wallet RLIKE '^0x[0-9a-f]{40}$' AND condition IS NOT NULL AND token IS NOT NULL AND side IN ('BUY', 'SELL') AND s > 0 AND p BETWEEN 0 AND 1 AND t IS NOT NULL")
    return good.select("trade_row_id", *cols, F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])).alias("digest"))


def request_urls(spark: SparkSession, root: str) -> DataFrame:
    """Addresses of news requests: parameters sorted and encoded, truth values in lower case, absent ones left out (SC7)."""
    n = table(spark, root, "news")
    ok = F.get_json_object("record_json", "$.historical_availability_verified")
    params = F.create_map(F.lit("title"), F.col("title"), F.lit("item"), F.col("item_id"), F.lit("Verified"), F.initcap(ok), F.lit("before"), F.col("published_us").cast("string"))
    return n.select("news_id", request_url(F.lit("https://news.invalid/api"), params).alias("url"))


def conflicting_executions(spark: SparkSession, root: str) -> DataFrame:
    """Executions delivered more than once, and whether their contents agree (SC9)."""
    x = table(spark, root, "executions").select(ident(F.col("actor")).alias("actor"), outer_trim("execution_id").alias("execution"), F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in (hex_ident(F.col("condition_id")), F.col("time_us").cast("string"), F.upper(outer_trim("side")), decimal_text(F.col("shares")), decimal_text(F.col("price")))])).alias("d"))
    g = x.where("actor IS NOT NULL AND execution IS NOT NULL").groupBy("actor", "execution").agg(F.count("*").alias("n"), F.countDistinct("d").alias("n_contents"))
    return g.where("n > 1").withColumn("conflict", F.col("n_contents") > 1)


def corpus_samples(spark: SparkSession, root: str) -> DataFrame:
    """Five fixtures evenly spaced by first trade, and of each its first, last and first row at or after the middle (SK6, TK6)."""
    t = table(spark, root, "trades").select("trade_row_id", ident(F.col("fixture_id")).alias("fixture"), F.col("query_us").alias("t")).dropna()
    f = t.groupBy("fixture").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    # one row a fixture from here on
    p = f.withColumn("i", F.row_number().over(W.orderBy("lo", "fixture")) - 1).withColumn("n", F.count("*").over(W.partitionBy()))
    k = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")
    chosen = p.select("fixture", "lo", "hi", "i", "n", k).where("i = floor(k * (n - 1) / 4)").select("fixture", "lo", "hi").distinct()
    j = t.join(chosen, "fixture")
    at = lambda g, c=None: g("trade_row_id", F.struct("t", "trade_row_id") if c is None else F.when(c, F.struct("t", "trade_row_id")))
    return j.groupBy("fixture").agg(at(F.min_by).alias("first_id"), at(F.max_by).alias("last_id"), at(F.min_by, F.col("t") * 2 >= F.col("lo") + F.col("hi")).alias("middle_id"), F.count("*").alias("n"))


def ledger_evidence(spark: SparkSession, root: str) -> DataFrame:
    """The pair ledger exported, read back and rolled up again, beside the roll-up of the log itself (SK7)."""
    t = table(spark, root, "trades").select(ident(F.col("wallet")).alias("wallet"), hex_ident(F.col("condition_id")).alias("condition")).dropna()
    path = scratch(spark, "ledger")
    sinks.publish(t.groupBy("wallet", "condition").agg(F.count("*").alias("n")), path)
    back = spark.read.parquet(path).groupBy("wallet").agg(F.sum("n").alias("exported"), F.count("*").alias("n_pairs"))
    return t.groupBy("wallet").agg(F.count("*").alias("n")).join(back, "wallet", "full").select("wallet", "n", "exported", "n_pairs", F.col("n").eqNullSafe(F.col("exported")).alias("equal"))


def evidence_package(spark: SparkSession, root: str) -> DataFrame:
    """News evidence in shards of 16 KiB, rows without a time or title apart, written and counted from what was read back (SK11)."""
    n = table(spark, root, "news").select("news_id", "title", "verified_availability_us", F.octet_length(F.concat_ws("|", "news_id", "title", "source_url", "record_json")).alias("bytes"))
    good = n.where("title IS NOT NULL AND verified_availability_us IS NOT NULL")
    path = scratch(spark, "evidence")
    rows = shards.byte_shards(good, ["news_id"], F.col("bytes"), 16_384).unionByName(n.join(good.select("news_id"), "news_id", "left_anti").withColumn("shard", F.lit(-1).cast("long")))
    sinks.publish(rows, path, by=["shard"])
    back = readers.read_rows(spark, path, "news_id string, bytes long, shard long")
    return back.groupBy("shard").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("news_id").alias("first_id"), F.max("news_id").alias("last_id"))


def state_before_trade(spark: SparkSession, root: str) -> DataFrame:
    """Number and running hash of the news state of the fixture strictly before each trade."""
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", "eligible_us").dropna().distinct()
    chain = C.hash_chain(f, "fixture", ["eligible_us", "news_id"], F.concat_ws("@", "news_id", "eligible_us"))
    place = f.withColumn("k", F.row_number().over(W.partitionBy("fixture").orderBy("eligible_us", "news_id")).cast("long"))
    states = place.join(chain.withColumnRenamed("scope", "fixture"), ["fixture", "k"]).select("fixture", F.col("eligible_us").alias("t"), "k", "state")
    t = table(spark, root, "trades").select("trade_row_id", ident(F.col("fixture_id")).alias("fixture"), F.col("query_us").alias("t")).dropna()
    return asof_prior(t, states, ["fixture"], "t", ["k", "state"], block_us=168 * HOUR).select("trade_row_id", F.col("prior_k").alias("n_links"), F.col("prior_state").alias("state"))


def article_links(spark: SparkSession, root: str) -> DataFrame:
    """Articles linked to the fixtures of the teams they name if published from 90 days before to six hours after kick-off, with the ladder."""
    n = table(spark, root, "news").select("news_id", "published_us")
    h = R.mentioned_teams(T._headlines(spark, root).select("news_id", "words"), "news_id", "words", T._teams(spark, root)).where("size(found) > 0")
    k = table(spark, root, "tournament_sft_v1").where("policy_version = 1").select(ident(F.col("fixture_id")).alias("fixture"), micros("kickoff_at").alias("kickoff")).dropna()
    pairs = T._fixture_pairs(spark, root).select("fixture", "pair", F.explode("teams").alias("team"))
    j = h.select("news_id", "words", "found", F.explode("found").alias("team")).join(pairs, "team").join(k, "fixture").join(n, "news_id")
    inside = j.where(F.col("published_us").between(F.col("kickoff") - 2160 * HOUR, F.col("kickoff") + 6 * HOUR - 1))
    return inside.select("news_id", "fixture", R.ladder(F.col("found"), F.col("pair"), F.col("words")).alias("relationship"), (F.col("kickoff") - F.col("published_us")).alias("lead_us")).distinct()


def known_behaviour(spark: SparkSession, root: str) -> DataFrame:
    """Count, notional, buy share and rate over all markets of executions that happened and were known strictly before each."""
    from tidemark.operators import prior as P
    from tidemark.operators.features import clean_executions

    raw = table(spark, root, "executions")
    known = raw.where("known_us IS NOT NULL").select(ident(F.col("actor")).alias("actor"), F.coalesce(F.concat(F.lit("i"), outer_trim("execution_id"))).alias("execution"), F.greatest("time_us", "known_us").alias("ready")).dropna().groupBy("actor", "execution").agg(F.min("ready").alias("ready"))
    x = clean_executions(raw).where("shares IS NOT NULL AND time_us IS NOT NULL").join(known, ["actor", "execution"])
    x = x.select("actor", "execution", "time_us", "ready", F.split("type", "/")[1].alias("side"), F.round(F.col("notional") * 1_000_000).cast("long").alias("notional"))
    fills = x.select("actor", F.col("ready").alias("time_us"), "side", "notional", F.col("time_us").alias("since_us"))
    got = P.behaviour_before(x.select("actor", "execution", "time_us"), fills, since="since_us")
    return got.select("actor", F.expr("substring(execution, 2)").alias("execution"), "n_prior", "average_notional", "buy_share", "per_day")


def strict_lines(spark: SparkSession, root: str) -> DataFrame:
    """Link records written as lines, those that are strict JSON read back with decimals and a schema, the others counted (SC2)."""
    f = table(spark, root, "fixture_news").where("link_json IS NOT NULL").select("link_json")
    good = f.where(F.coalesce(strict_json("link_json"), F.lit(False)))
    path = scratch(spark, "lines")
    good.write.text(path)
    back = readers.read_jsonl_strict(spark, path, "relationship string, historical_link_verified boolean")
    n_bad = f.where(~F.coalesce(strict_json("link_json"), F.lit(False))).agg(F.count("*")).scalar()
    return back.groupBy("relationship", "historical_link_verified").agg(F.count("*").alias("n")).withColumn("n_refused", n_bad)


def news_since_last_query(spark: SparkSession, root: str) -> DataFrame:
    """Links of the fixture that became usable between a wallet's previous trade in it and this one."""
    t = table(spark, root, "trades").select("trade_row_id", ident(F.col("wallet")).alias("wallet"), ident(F.col("fixture_id")).alias("fixture"), F.col("query_us").alias("t")).dropna()
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), F.col("eligible_us").alias("t"))
    own = prior_totals(t, t.select("wallet", "fixture", "t"), ["wallet", "fixture"], "t", {}, last={"before": F.col("t")}, block_us=168 * HOUR)
    now = prior_rank(own, f, ["fixture"], "t", "n_now")
    then = prior_rank(own.where("before IS NOT NULL").select("trade_row_id", "fixture", F.col("before").alias("t")), f, ["fixture"], "t", "n_then").select("trade_row_id", "n_then")
    return now.join(then, "trade_row_id", "left").select("trade_row_id", (F.col("n_now") - F.coalesce("n_then", F.lit(0))).alias("n_new"), F.col("n_then").isNull().alias("first_query"))


def feature_subset(spark: SparkSession, root: str) -> DataFrame:
    """Asked features of the activity rows in their canonical order, constant and forbidden ones left out, labels untouched (SK12, F20, F21, F22)."""
    canonical, forbidden, asked = ("n_1d", "n_7d", "buys_7d", "since_us", "hour", "label"), ("label",), ("since_us", "hour", "n_7d", "label", "n_1d")
    rows = materialize(T.causal_features(spark, root), "features")
    names = [c for c in canonical if c in asked and c not in forbidden]
    one = rows.agg(*[(F.countDistinct(c) > 1).alias(c) for c in names]).first()  # one row of flags
    names = [c for c in names if one[c]]
    text = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{c}":'), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in names]), F.lit("}"))
    return rows.select("event_id", text.alias("features"), "label")


def commentary_events(spark: SparkSession, root: str) -> DataFrame:
    """Minutes of commentary exploded into events, each once, inside the playing time, by category of their kind (SC13, F18)."""
    d = table(spark, root, "documents").where("doc_kind = 'commentary' AND text IS NOT NULL").select("doc_id", F.explode(F.split("text", r"\r\n|\n|\r")).alias("line"))
    minute = F.regexp_extract("line", r"^([0-9]{1,3})' ", 1).try_cast("int")
    kind = F.regexp_replace(F.lower(F.regexp_replace("line", "^[0-9]{1,3}' ", "")), "[^a-z0-9]+", "-")
    e = d.select("doc_id", minute.alias("minute"), kind.alias("kind")).where("minute BETWEEN 0 AND 120").distinct()
    return e.agg(F.count("*").alias("n"), *[F.count_if(kind_matches(F.col("kind"), c)).alias(c) for c in ("goal", *EVENT_TERMS)]).unpivot([], ["n", "goal", *EVENT_TERMS], "category", "events")


QUERIES = {f.__name__: f for f in (strict_lines, news_since_last_query, feature_subset, commentary_events, normalised_trades, request_urls, conflicting_executions, corpus_samples, ledger_evidence, evidence_package, state_before_trade, article_links, known_behaviour)}

_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _id(c: str) -> str:
    return f"lower(trim({c}, {_WS}))"


def _hex(c: str) -> str:
    bare = f"regexp_replace({_id(c)}, '^0x', '')"
    return f"CASE WHEN NOT regexp_full_match({bare}, '0*') THEN {bare} END"


def _dec(c: str) -> str:
    return T._TEXT(f"try_cast(trim({c}, {_WS}) AS decimal(38, 18))::varchar")


_E = f"""raw AS (SELECT {_id('actor')} AS actor, 'i' || trim(execution_id, {_WS}) AS execution, time_us, known_us, regexp_replace({_id('condition_id')}, '^0x', '') AS condition, CASE WHEN upper(trim(side, {_WS})) IN ('BUY', 'SELL') THEN upper(trim(side, {_WS})) END AS side,
 try_cast(trim(shares, {_WS}) AS decimal(20, 8)) AS shares, try_cast(trim(price, {_WS}) AS decimal(13, 12)) AS price FROM executions WHERE {_id('actor')} <> '' AND execution_id IS NOT NULL),
one AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY actor, execution ORDER BY time_us NULLS FIRST, condition NULLS FIRST, side NULLS FIRST, shares NULLS FIRST, price NULLS FIRST) = 1),
kn AS (SELECT actor, execution, min(greatest(time_us, known_us)) AS ready FROM raw WHERE known_us IS NOT NULL AND time_us IS NOT NULL GROUP BY 1, 2),
x AS (SELECT one.actor, one.execution, one.time_us, ready, one.side, round(shares * price * 1000000)::bigint AS v FROM one JOIN kn USING (actor, execution) WHERE condition <> '' AND one.side IS NOT NULL AND shares > 0 AND price BETWEEN 0 AND 1 AND one.time_us IS NOT NULL)"""

ORACLE = {
    "strict_lines": """SELECT json_extract_string(link_json, '$.relationship') AS relationship, json_extract_string(link_json, '$.historical_link_verified')::boolean AS historical_link_verified, count(*) AS n, (SELECT count(*) FILTER (WHERE NOT json_valid(link_json)) FROM fixture_news) AS n_refused FROM fixture_news WHERE json_valid(link_json) GROUP BY 1, 2""",
    "news_since_last_query": f"""WITH t AS (SELECT trade_row_id, {_id('wallet')} AS wallet, {_id('fixture_id')} AS fixture, query_us AS t FROM trades WHERE wallet IS NOT NULL AND fixture_id IS NOT NULL AND query_us IS NOT NULL), f AS (SELECT {_id('fixture_id')} AS fixture, eligible_us AS e FROM fixture_news WHERE eligible_us IS NOT NULL),
b AS (SELECT *, max(t) OVER (PARTITION BY wallet, fixture ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM t) SELECT trade_row_id, count(f.e) FILTER (WHERE p IS NULL OR f.e >= p) AS n_new, p IS NULL AS first_query FROM b LEFT JOIN f ON f.fixture = b.fixture AND f.e < b.t GROUP BY trade_row_id, p""",
    "feature_subset": T.ORACLE["causal_features"].replace("SELECT event_id, n_1d, n_7d", "SELECT * FROM (SELECT event_id, n_1d, n_7d", 1).replace("f.t > i.t", "f.t > i.t)", 1).replace("SELECT * FROM (", """SELECT event_id, '{"n_1d":' || n_1d || ',"n_7d":' || n_7d || ',"since_us":' || coalesce(since_us::varchar, 'null') || ',"hour":' || hour || '}' AS features, label FROM (""", 1),
    "commentary_events": """WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\n|\\r')) AS line FROM documents WHERE doc_kind = 'commentary' AND text IS NOT NULL), e AS (SELECT DISTINCT doc_id, try_cast(regexp_extract(line, '^([0-9]{1,3})'' ', 1) AS int) AS minute, regexp_replace(lower(regexp_replace(line, '^[0-9]{1,3}'' ', '')), '[^a-z0-9]+', '-', 'g') AS kind FROM l),
k AS (SELECT * FROM e WHERE minute BETWEEN 0 AND 120), m AS (SELECT count(*) AS n, count(*) FILTER (WHERE kind = 'goal' OR starts_with(kind, 'goal---') OR starts_with(kind, 'own-goal') OR kind = 'penalty---scored') AS goal, """ + ", ".join(f"count(*) FILTER (WHERE regexp_matches(kind, '{'|'.join(terms)}')) AS {c}" for c, terms in EVENT_TERMS.items()) + """ FROM k)
UNPIVOT m ON COLUMNS(*) INTO NAME category VALUE events""",
    "normalised_trades": f"""WITH n AS (SELECT trade_row_id, {_id('wallet')} AS wallet, {_hex('condition_id')} AS condition, trim(token_id, {_WS}) AS token, upper(trim(side, {_WS})) AS side, {_dec('shares')} AS shares, {_dec('price')} AS price, {_id('fixture_id')} AS fixture, {_hex('transaction_hash')} AS tx, query_us AS t,
 try_cast(trim(shares, {_WS}) AS decimal(38, 18)) AS s, try_cast(trim(price, {_WS}) AS decimal(38, 18)) AS p FROM trades)
SELECT trade_row_id, wallet, condition, token, side, shares, price, fixture, tx, t, md5(concat_ws('|', {', '.join(f"coalesce({c}::varchar, '~')" for c in ('wallet', 'condition', 'token', 'side', 'shares', 'price', 'fixture', 'tx', 't'))})) AS digest
FROM n WHERE regexp_full_match(wallet, '0x[0-9a-f]{{40}}') AND condition IS NOT NULL AND token IS NOT NULL AND side IN ('BUY', 'SELL') AND s > 0 AND p BETWEEN 0 AND 1 AND t IS NOT NULL""",
    "request_urls": """SELECT news_id, 'https://news.invalid/api' || coalesce('?' || nullif(concat_ws('&', 'Verified=' || json_extract_string(record_json, '$.historical_availability_verified'), 'before=' || published_us, 'item=' || replace(url_encode(item_id), '%20', '+'), 'title=' || replace(replace(url_encode(title), '%20', '+'), '~', '%7E')), ''), '') AS url FROM news""",
    "conflicting_executions": f"""WITH x AS (SELECT {_id('actor')} AS actor, trim(execution_id, {_WS}) AS execution, concat_ws('|', coalesce({_hex('condition_id')}, '~'), coalesce(time_us::varchar, '~'), coalesce(upper(trim(side, {_WS})), '~'), coalesce({_dec('shares')}, '~'), coalesce({_dec('price')}, '~')) AS d FROM executions WHERE actor IS NOT NULL AND execution_id IS NOT NULL)
SELECT actor, execution, count(*) AS n, count(DISTINCT d) AS n_contents, count(DISTINCT d) > 1 AS conflict FROM x GROUP BY 1, 2 HAVING count(*) > 1""",
    "corpus_samples": f"""WITH t AS (SELECT trade_row_id, {_id('fixture_id')} AS fixture, query_us AS t FROM trades WHERE fixture_id IS NOT NULL AND query_us IS NOT NULL), f AS (SELECT fixture, min(t) AS lo, max(t) AS hi FROM t GROUP BY 1), p AS (SELECT *, row_number() OVER (ORDER BY lo, fixture) - 1 AS i, count(*) OVER () AS n FROM f),
c AS (SELECT DISTINCT fixture, lo, hi FROM p, (SELECT unnest(range(5)) AS k) WHERE i = floor(k * (n - 1) / 4))
SELECT fixture, arg_min(trade_row_id, (t, trade_row_id)) AS first_id, arg_max(trade_row_id, (t, trade_row_id)) AS last_id, arg_min(trade_row_id, (t, trade_row_id)) FILTER (WHERE t * 2 >= lo + hi) AS middle_id, count(*) AS n FROM t JOIN c USING (fixture) GROUP BY 1""",
    "ledger_evidence": f"SELECT {_id('wallet')} AS wallet, count(*) AS n, count(*) AS exported, count(DISTINCT {_hex('condition_id')}) AS n_pairs, true AS equal FROM trades WHERE wallet IS NOT NULL AND {_hex('condition_id')} IS NOT NULL GROUP BY 1",
    "evidence_package": """WITH n AS (SELECT news_id, title IS NOT NULL AND verified_availability_us IS NOT NULL AS good, strlen(concat_ws('|', news_id, title, source_url, record_json)) AS b FROM news), g AS (SELECT *, coalesce(sum(b) OVER (ORDER BY news_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS p FROM n WHERE good),
r AS (SELECT p // 16384 AS shard, news_id, b FROM g UNION ALL SELECT -1, news_id, b FROM n WHERE NOT good) SELECT shard, count(*) AS n, sum(b)::bigint AS bytes, min(news_id) AS first_id, max(news_id) AS last_id FROM r GROUP BY 1""",
    "state_before_trade": f"""WITH RECURSIVE l AS (SELECT DISTINCT {_id('fixture_id')} AS fixture, news_id, eligible_us FROM fixture_news WHERE fixture_id IS NOT NULL AND news_id IS NOT NULL AND eligible_us IS NOT NULL), n AS (SELECT *, row_number() OVER (PARTITION BY fixture ORDER BY eligible_us, news_id) AS k FROM l),
c AS (SELECT fixture, k, eligible_us, sha256('|' || news_id || '@' || eligible_us) AS state FROM n WHERE k = 1 UNION ALL SELECT n.fixture, n.k, n.eligible_us, sha256(c.state || '|' || n.news_id || '@' || n.eligible_us) FROM c JOIN n ON n.fixture = c.fixture AND n.k = c.k + 1),
s AS (SELECT fixture, eligible_us, max(k) AS k, arg_max(state, k) AS state FROM c GROUP BY 1, 2) SELECT x.trade_row_id, s.k AS n_links, s.state FROM (SELECT trade_row_id, {_id('fixture_id')} AS fixture, query_us AS t FROM trades WHERE fixture_id IS NOT NULL AND query_us IS NOT NULL) x ASOF LEFT JOIN s ON x.fixture = s.fixture AND x.t > s.eligible_us""",
    "article_links": f"""WITH {T._H}, {T._P}, {T._M}, kk AS (SELECT {_id('fixture_id')} AS fixture, epoch_us(kickoff_at) AS kickoff FROM tournament_sft_v1 WHERE policy_version = 1 AND fixture_id IS NOT NULL AND kickoff_at IS NOT NULL)
SELECT DISTINCT m.news_id, p.fixture, CASE WHEN array_to_string(found, '|') = pair AND regexp_matches(words, '\\b(v|vs|against|face|meet)\\b') THEN 'direct' WHEN array_to_string(found, '|') = pair THEN 'pair' WHEN len(found) = 1 THEN 'team' ELSE 'background' END AS relationship, kickoff - published_us AS lead_us
FROM m JOIN p ON list_has_any(m.found, p.teams) JOIN kk ON kk.fixture = p.fixture JOIN news ON news.news_id = m.news_id WHERE published_us >= kickoff - 7776000000000 AND published_us < kickoff + 21600000000""",
    "known_behaviour": f"""WITH {_E} SELECT a.actor, substr(a.execution, 2) AS execution, count(b.v) AS n_prior, sum(b.v)::bigint / nullif(count(b.v), 0) AS average_notional, sum(CASE WHEN b.side = 'BUY' THEN b.v ELSE 0 END)::bigint / nullif(sum(b.v)::bigint, 0) AS buy_share, count(b.v) * 86400000000 / nullif(a.time_us - min(b.time_us), 0) AS per_day
FROM x a LEFT JOIN x b ON a.actor = b.actor AND b.ready < a.time_us GROUP BY a.actor, a.execution, a.time_us""",
}
