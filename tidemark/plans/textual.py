"""Scalar functions, headline relevance, chat records and features on the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import scalars as S
from tidemark.functions.clean import amount, hex_ident, ident, outer_trim
from tidemark.operators import relevance as R
from tidemark.operators import sequences as Q
from tidemark.operators.asof import DAY_US, asof_prior, micros, next_frame, prior_frame, with_halo
from tidemark.operators.context import headline_key
from tidemark.operators.ledgers import cents
from tidemark.session import table


def instant_parse(spark: SparkSession, root: str) -> DataFrame:
    """Zoned instants against the row's time; naive text is refused (SF1)."""
    t = table(spark, root, "trades").select("block_timestamp", "query_us", S.instant_us(F.col("block_timestamp")).alias("u"))
    status = F.when(F.col("block_timestamp").isNull(), "missing").when(F.col("u").isNull(), "refused").when(F.col("query_us").isNull(), "no_time").when(F.col("u") == F.col("query_us"), "agrees").otherwise("disagrees")
    return t.groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.max(F.abs(F.col("u") - F.col("query_us"))).alias("largest_gap_us"))


def epoch_scale(spark: SparkSession, root: str) -> DataFrame:
    """Points per unit of their epoch number (SF2)."""
    t = F.col("t")
    unit = F.when(t >= 100_000_000_000_000, "us").when(t >= 100_000_000_000, "ms").when(t.isNotNull(), "s")
    return table(spark, root, "price_history").groupBy(unit.alias("unit")).agg(F.count("*").alias("n"))


def iso_texts(spark: SparkSession, root: str) -> DataFrame:
    """ISO texts of publication times (SF3)."""
    return table(spark, root, "news").select("news_id", S.iso_utc(F.col("published_us")).alias("published"), S.iso_utc(F.floor(F.col("published_us") / 1_000_000) * 1_000_000).alias("second"))


def decimal_texts(spark: SparkSession, root: str) -> DataFrame:
    """Canonical decimal texts of shares and prices (SF4)."""
    return table(spark, root, "trades").select("trade_row_id", S.decimal_text(F.col("shares")).alias("shares"), S.decimal_text(F.col("price")).alias("price"))


def significant_digits(spark: SparkSession, root: str) -> DataFrame:
    """Four significant digits of balances in cents, also negative ones (SF5)."""
    return table(spark, root, "customer").select("c_custkey", S.significant(cents("c_acctbal"), 4).cast("long").alias("cents"))


def folded_headlines(spark: SparkSession, root: str) -> DataFrame:
    """Folded headlines and their keys (SF6, SF7)."""
    return table(spark, root, "news").select("news_id", headline_key(F.col("title")).alias("key"), S.fold_text("title").alias("folded"))


def url_parts(spark: SparkSession, root: str) -> DataFrame:
    """Canonical address, host and ids of every news source (SF11, SC7)."""
    u = F.col("source_url")
    return table(spark, root, "news").select("news_id", S.canonical_url(u).alias("url"), F.regexp_extract(u, "^https?://([^/?#]+)", 1).alias("host"), F.regexp_extract(u, "/(\\d+)/(\\d+)$", 1).alias("article"), F.regexp_extract(u, "/(\\d+)/(\\d+)$", 2).alias("version"))


def plain_documents(spark: SparkSession, root: str) -> DataFrame:
    """Texts without mark-up and entities (SF9)."""
    d = table(spark, root, "documents")
    p = S.plain_text(F.col("text"))
    return d.select("doc_id", F.sha2(p, 256).alias("digest"), F.char_length(p).cast("long").alias("n_chars"))


def resolution_clause(spark: SparkSession, root: str) -> DataFrame:
    """The only sentence of a contract text that names the final whistle, if short (SF12)."""
    d = table(spark, root, "documents").where("doc_kind IN ('rules', 'market_note')")
    return d.select("doc_id", S.single_clause(F.col("text"), "final whistle|Schlusspfiff|coup de sifflet final|pitido final", 400).alias("clause")).where("clause IS NOT NULL")


def hash_words(spark: SparkSession, root: str) -> DataFrame:
    """Hex words of transaction hashes: low address, first bytes as a number (SF13)."""
    h = table(spark, root, "trades").select(hex_ident(F.col("transaction_hash")).alias("h")).distinct()
    w = S.hex_word(F.col("h"), 0)
    return h.where(w.isNotNull()).select("h", F.concat(F.lit("0x"), F.substring(w, 25, 40)).alias("address"), F.conv(F.substring(w, 1, 8), 16, 10).cast("long").alias("head"))


def token_hex(spark: SparkSession, root: str) -> DataFrame:
    """256-bit token numbers as hex: an Arrow UDF, no number type is wide enough (SF13)."""
    t = table(spark, root, "trades").select(outer_trim(F.col("token_id")).alias("token")).dropna().distinct()
    return t.select("token", S.uint256_hex("token").alias("hex"))


def strict_records(spark: SparkSession, root: str) -> DataFrame:
    """Link records that are strict JSON objects with known keys (SF14)."""
    f = table(spark, root, "fixture_news").select("link_json", S.strict_json("link_json").alias("strict"), F.array_join(F.array_sort(F.json_object_keys("link_json")), ",").alias("keys"), F.get_json_object("link_json", "$.relationship").alias("relationship"))
    return f.groupBy("strict", "keys", "relationship").agg(F.count("*").alias("n"))


def news_records(spark: SparkSession, root: str) -> DataFrame:
    """Normalised articles with a content hash (SF15, SF17, §1.5)."""
    n = table(spark, root, "news")
    body = F.concat_ws("|", F.col("item_id"), headline_key(F.col("title")), F.col("source_url"))
    return n.select("news_id", F.concat(F.lit("n"), F.substring(F.sha2(body, 256), 1, 16)).alias("content_id"), S.hash64(body).cast("string").alias("h64"), F.md5(body).alias("digest"))


def trade_quality(spark: SparkSession, root: str) -> DataFrame:
    """Trades by the list of their quality errors; no row is dropped (SF16, F7)."""
    t = table(spark, root, "trades")
    side, sh, p = F.upper(outer_trim("side")), amount(F.col("shares"), 38, 12), amount(F.col("price"), 38, 12)
    bad = lambda c, code: F.when(~F.coalesce(c, F.lit(False)), F.lit(code))
    errors = F.array_compact(F.array(bad(F.col("query_us").isNotNull(), "time"), bad(side.isin("BUY", "SELL"), "side"), bad(sh > 0, "shares"), bad((p >= 0) & (p <= 1), "price"), bad(ident(F.col("wallet")).rlike("^0x[0-9a-f]{40}$"), "wallet"), bad(F.col("token_id").isNotNull(), "token")))
    return t.select(F.array_join(errors, ",").alias("errors")).groupBy("errors").agg(F.count("*").alias("n"))


def answer_scores(spark: SparkSession, root: str) -> DataFrame:
    """Normalised probability of two log-likelihoods, and the repeat rate (SF18, SF19)."""
    e = table(spark, root, "events").select("user_id", "value", micros("ts").alias("t"))
    g = e.groupBy("user_id").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b"), F.avg("value").alias("v"))
    return g.select("user_id", F.round(S.sigmoid_difference(F.col("v"), F.lit(50.0)), 9).alias("p"), F.round(S.repeat_rate(F.col("n"), F.lit(300.0), (F.col("b") - F.col("a")) / 1e6), 9).alias("rate"))


def actor_aliases(spark: SparkSession, root: str) -> DataFrame:
    """Pseudonyms of actors, and short aliases of their markets by sorted id (SF21, SF23)."""
    x = table(spark, root, "executions").select(ident(F.col("actor")).alias("actor"), ident(F.col("condition_id")).alias("market")).dropna().distinct()
    m = F.concat(F.lit("m"), F.lpad(F.row_number().over(W.partitionBy("actor").orderBy("market")), 3, "0"))
    return x.select(S.pseudonym(F.col("actor")).alias("actor"), "market", m.alias("alias"))


def feature_families(spark: SparkSession, root: str) -> DataFrame:
    """Feature names by family, forbidden ones removed, as a projection of a map (SF24)."""
    l = table(spark, root, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey"]
    m = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("double"))])
    kept = F.map_filter(m, lambda k, v: ~k.isin("l_orderkey", "l_linenumber"))
    e = l.select(F.explode(kept).alias("name", "v"))
    return e.groupBy("name").agg(F.count("v").alias("n"), (F.max("v") + 0.0).alias("most")).withColumn("family", S.feature_family(F.col("name")))


def _words(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def _headlines(spark: SparkSession, root: str) -> DataFrame:
    n = table(spark, root, "news").where("title IS NOT NULL")
    words = _words(F.col("title"))
    return n.select("news_id", words.alias("words"), "source_url", F.col("verified_availability_us").alias("known_us"))


def _fixture_pairs(spark: SparkSession, root: str) -> DataFrame:
    t = table(spark, root, "trades").select(ident(F.col("fixture_id")).alias("fixture_key"), R.canonical_team(_words(F.col("selection"))).alias("team_key")).where("team_key <> 'draw'").distinct()
    return R.teams_of(t, "fixture_key", "team_key", F.col("team_key"))


def _teams(spark: SparkSession, root: str) -> DataFrame:
    return _fixture_pairs(spark, root).select(F.explode("teams").alias("team")).distinct()


def candidate_headlines(spark: SparkSession, root: str) -> DataFrame:
    """Headlines by teams named and whether they are candidates."""
    h = R.mentioned_teams(_headlines(spark, root).select("news_id", "words", "source_url"), "news_id", "words", _teams(spark, root))
    c = R.is_candidate(F.col("found"), F.col("words"), F.col("source_url"), r"\b(fixture|appointed)\b", "northgoal")
    return h.select("news_id", F.array_join("found", "|").alias("teams"), c.alias("candidate"))


def scope_reasons(spark: SparkSession, root: str) -> DataFrame:
    """Headlines by scope with the reason for refusal, and since when they count globally."""
    path = _words(F.regexp_extract("source_url", "^https?://[^/?#]+([^?#]*)", 1))
    reason = R.scope_reason(F.col("words"), path, F.col("known_us"), "(?:cup|final|squad|officials|fixture)", "2026")
    h = _headlines(spark, root).withColumn("reason", reason)
    return h.groupBy("reason").agg(F.count("*").alias("n"), F.min(F.when(F.col("reason") == "captured_scope", F.col("known_us"))).alias("first_us"))


def pair_links(spark: SparkSession, root: str) -> DataFrame:
    """Headlines that set the two teams of a fixture against each other, by the compiled pattern of the pair; others blocked with the reason.

    Pairs are joined by the teams a headline names, so each pattern is tried
    only on headlines that name both.
    """
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower("title"), "[\u2010-\u2015\u2212]", "-"), "[^a-z0-9-]+", " "))
    t = table(spark, root, "news").where("title IS NOT NULL").select("news_id", plain.alias("dashed"))
    h = R.mentioned_teams(_headlines(spark, root).select("news_id", "words", "known_us"), "news_id", "words", _teams(spark, root)).where("size(found) >= 2").join(t, "news_id")
    pairs = R.pair_patterns(_fixture_pairs(spark, root))
    two = h.withColumn("a", F.explode("found")).withColumn("b", F.explode("found")).where("a < b").withColumn("pair", F.concat_ws("|", "a", "b"))
    j = two.join(pairs, "pair")
    hit = F.expr("rlike(words, pattern)") | F.expr("rlike(dashed, dash)")
    state = F.when(F.col("ambiguous"), "ambiguous_pair").when(~hit, "no_pair_pattern").when(F.col("known_us").isNull(), "unverified_time").otherwise("direct")
    return j.withColumn("dash", R.dash_pattern(F.col("pattern"))).select("news_id", "fixture", state.alias("state"))


def headline_links(spark: SparkSession, root: str) -> DataFrame:
    """Headlines linked to fixtures of the teams they name, with the ladder."""
    h = R.mentioned_teams(_headlines(spark, root).select("news_id", "words"), "news_id", "words", _teams(spark, root)).where("size(found) > 0")
    by_team = _fixture_pairs(spark, root).select("fixture", "pair", F.explode("teams").alias("team"))
    j = h.select("news_id", "words", "found", F.explode("found").alias("team")).join(by_team, "team")
    return j.select("news_id", "fixture", R.ladder(F.col("found"), F.col("pair"), F.col("words")).alias("relationship")).distinct()


def link_times(spark: SparkSession, root: str) -> DataFrame:
    """When each link is usable: verified news and link, the later of both."""
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", "eligible_us", "link_json")
    n = table(spark, root, "news").select("news_id", "record_json", "verified_availability_us")
    ok = lambda c, k: F.get_json_object(c, f"$.{k}") == "true"
    news_time = F.when(ok("record_json", "historical_availability_verified"), F.col("verified_availability_us"))
    link = F.when(ok("link_json", "historical_link_verified") & news_time.isNotNull() & F.col("eligible_us").isNotNull(), F.greatest(F.col("eligible_us"), news_time))
    direct = F.get_json_object("link_json", "$.relationship") == "direct"
    j = f.join(n, "news_id")
    return j.groupBy("fixture").agg(F.count("*").alias("n_links"), F.count(link).alias("n_usable"), F.count(F.when(direct, link)).alias("n_direct"), F.min(link).alias("first_us"))


def paired_headlines(spark: SparkSession, root: str) -> DataFrame:
    """Headlines of a pair within ten days of its first trade: none, one, many or reused."""
    first = table(spark, root, "trades").where("query_us IS NOT NULL").groupBy(ident(F.col("fixture_id")).alias("fixture")).agg(F.min("query_us").alias("t"))
    left = _fixture_pairs(spark, root).join(first, "fixture").select("fixture", "pair", "t")
    h = R.mentioned_teams(_headlines(spark, root).select("news_id", "words", "known_us"), "news_id", "words", _teams(spark, root))
    right = h.where("size(found) = 2 AND known_us IS NOT NULL").select("news_id", F.array_join("found", "|").alias("pair"), F.col("known_us").alias("k"))
    return R.classify_pairs(left, right, "pair", "t", "k", 10 * 86_400_000_000, "fixture", "news_id")


def registry_audit(spark: SparkSession, root: str) -> DataFrame:
    """Duplicates, orphans and unmapped rows of the registry."""
    t = table(spark, root, "trades").select(ident(F.col("fixture_id")).alias("fixture"), ident(F.col("condition_id")).alias("condition"))
    k = table(spark, root, "tournament_sft_v1").select(ident(F.col("fixture_id")).alias("fixture"), "policy_version")
    count = lambda name, df: df.agg(F.lit(name).alias("finding"), F.count("*").alias("n"))
    out = count("fixtures_repeated", k.groupBy("fixture").agg(F.count("*").alias("c")).where("c > 1"))
    out = out.unionByName(count("fixtures_without_trades", k.select("fixture").distinct().join(t, "fixture", "left_anti")))
    out = out.unionByName(count("trades_without_fixture", t.where("fixture IS NULL")))
    return out.unionByName(count("conditions_of_two_fixtures", t.dropna().groupBy("condition").agg(F.countDistinct("fixture").alias("c")).where("c > 1")))


def event_kinds(spark: SparkSession, root: str) -> DataFrame:
    """Category of an event name by prefix, with the trap that one name contains another."""
    e = table(spark, root, "orders").select("o_orderpriority", micros("o_orderdate").alias("t"))
    p = F.lower("o_orderpriority")
    kind = F.when(p.rlike("^1-"), "top").when(p.contains("low") & ~p.contains("not"), "low").when(p.contains("not"), "unspecified").otherwise("middle")
    return e.where(F.col("t").between(0, 4_102_444_800_000_000)).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def chat_turns(spark: SparkSession, root: str) -> DataFrame:
    """Roles and alternation of chat records (V12, SK8)."""
    c = Q.chat_turns(table(spark, root, "documents").where("doc_kind = 'chat' AND text IS NOT NULL"), "doc_id", "text")
    before = F.lag("role").over(W.partitionBy("doc_id").orderBy("turn"))
    c = c.withColumn("same", before == F.col("role"))
    return c.groupBy("doc_id").agg(F.count("*").alias("n_turns"), F.count_if(F.col("role") == "user").alias("n_user"), F.count_if(F.col("role") == "assistant").alias("n_assistant"), F.count_if("same").alias("n_repeated_roles"))


def chunked_sequences(spark: SparkSession, root: str) -> DataFrame:
    """Orders of a customer in chunks of at most 500,000."""
    o = table(spark, root, "orders").select("o_custkey", "o_orderkey", micros("o_orderdate").alias("t"), F.floor("o_totalprice").cast("long").alias("cost"))
    return Q.budget_chunks(o, "o_custkey", ["t", "o_orderkey"], "cost", 500_000).select("o_custkey", "o_orderkey", "chunk")


def watch_deltas(spark: SparkSession, root: str) -> DataFrame:
    """Markets added to and expired from each user's watch set."""
    e = table(spark, root, "events").select("event_id", "user_id", "event_type", micros("ts").alias("t"))
    return Q.delta_context(e, "user_id", ["t", "event_id"], "event_type", 3 * 86_400_000_000, "t").select("event_id", "added", "n_expired", "n_watched")


def causal_features(spark: SparkSession, root: str) -> DataFrame:
    """Activity row of every event from strictly earlier ones, labelled by another purchase in [t, t + 1 day)."""
    day = DAY_US
    e = table(spark, root, "events").select("event_id", "user_id", "event_type", micros("ts").alias("t"), F.round(F.col("value") * 1_000_000).cast("long").alias("v"))
    by, own = ["user_id", "__b"], F.col("event_type") == "purchase"
    line = with_halo(e, ["user_id"], "t", back_us=7 * day, ahead_us=day, block_us=7 * day)
    back = lambda us: prior_frame(by, "t", us)
    bought = F.count_if(own)
    flat = line.select(
        "event_id", "user_id", "t", "__own", F.count("*").over(back(day)).alias("n_1d"), F.count("*").over(back(7 * day)).alias("n_7d"), bought.over(back(7 * day)).alias("buys_7d"), (F.sum("v").over(back(7 * day)) / (F.count("v").over(back(7 * day)) * 1_000_000)).alias("mean_7d"),
        F.pmod(F.floor(F.col("t") / 3_600_000_000), F.lit(24)).cast("long").alias("hour"), (bought.over(next_frame(by, "t", day)) - F.coalesce(own.cast("int"), F.lit(0)) > 0).alias("label"),
    ).where("__own").drop("__own")
    got = asof_prior(flat, e, ["user_id"], "t", ["event_type", "event_id"], tie=["event_id"], block_us=7 * day)
    return got.select("event_id", "n_1d", "n_7d", "buys_7d", "mean_7d", (F.col("t") - F.col("prior_t")).alias("since_us"), F.col("prior_event_type").alias("last_type"), "hour", "label")


QUERIES = {
    f.__name__: f
    for f in (
        instant_parse, epoch_scale, iso_texts, decimal_texts, significant_digits, folded_headlines, url_parts, plain_documents, resolution_clause, hash_words, token_hex, strict_records, news_records, trade_quality, answer_scores,
        actor_aliases, feature_families, candidate_headlines, scope_reasons, pair_links, headline_links, link_times, paired_headlines, registry_audit, event_kinds, chat_turns, chunked_sequences, watch_deltas, causal_features,
    )
}

_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _id(c: str) -> str:
    return f"lower(trim({c}, {_WS}))"


_E = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t FROM events)"
_TEXT = lambda c: f"regexp_replace(CASE WHEN {c} LIKE '%.%' THEN regexp_replace({c}, '\\.?0+$', '') ELSE {c} END, '^-0$', '0')"
_H = "h AS (SELECT news_id, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS words, source_url, verified_availability_us AS known_us FROM news WHERE title IS NOT NULL)"
_SEL = "trim(regexp_replace(lower(selection), '[^a-z0-9]+', ' ', 'g'))"
_ALIAS = "al(name, team) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in R.ALIASES.items()) + ")"
_P = f"""{_ALIAS}, k AS (SELECT DISTINCT {_id('fixture_id')} AS fixture, coalesce((SELECT al.team FROM al WHERE al.name = {_SEL}), {_SEL}) AS team FROM trades WHERE {_SEL} NOT IN ('draw', '') AND fixture_id IS NOT NULL),
p AS (SELECT fixture, list_sort(list(team)) AS teams, array_to_string(list_sort(list(team)), '|') AS pair FROM k GROUP BY 1 HAVING count(*) = 2), tm AS (SELECT DISTINCT unnest(teams) AS team FROM p)"""
_M = "m AS (SELECT h.news_id, h.words, h.source_url, h.known_us, list_sort(coalesce(list(tm.team) FILTER (WHERE tm.team IS NOT NULL), []::varchar[])) AS found FROM h LEFT JOIN tm ON (contains(' ' || h.words || ' ', ' ' || tm.team || ' ') OR EXISTS (SELECT 1 FROM al WHERE al.team = tm.team AND contains(' ' || h.words || ' ', ' ' || al.name || ' '))) GROUP BY ALL)"
_PLAIN = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[ \\t\\r\\n]+', ' ', 'g'))"
_BODY = "concat_ws('|', item_id, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')), source_url)"

ORACLE = {
    "instant_parse": f"""WITH t AS (SELECT block_timestamp AS b, query_us, CASE WHEN regexp_matches(trim(block_timestamp, {_WS}), '{S.ZONED}') THEN epoch_us(try_cast(trim(block_timestamp, {_WS}) AS timestamptz)) END AS u FROM trades)
SELECT CASE WHEN b IS NULL THEN 'missing' WHEN u IS NULL THEN 'refused' WHEN query_us IS NULL THEN 'no_time' WHEN u = query_us THEN 'agrees' ELSE 'disagrees' END AS status, count(*) AS n, max(abs(u - query_us)) AS largest_gap_us FROM t GROUP BY 1""",
    "epoch_scale": "SELECT CASE WHEN t >= 100000000000000 THEN 'us' WHEN t >= 100000000000 THEN 'ms' WHEN t IS NOT NULL THEN 's' END AS unit, count(*) AS n FROM price_history GROUP BY 1",
    "iso_texts": """WITH n AS (SELECT news_id, published_us AS u, make_timestamp(published_us) AS t FROM news) SELECT news_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN u % 1000000 <> 0 THEN strftime(t, '.%f') ELSE '' END || 'Z' AS published, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS second FROM n""",
    "decimal_texts": f"WITH t AS (SELECT trade_row_id, try_cast(trim(shares, {_WS}) AS decimal(38, 18))::varchar AS s, try_cast(trim(price, {_WS}) AS decimal(38, 18))::varchar AS p FROM trades) SELECT trade_row_id, {_TEXT('s')} AS shares, {_TEXT('p')} AS price FROM t",
    "significant_digits": """WITH v AS (SELECT c_custkey, round(c_acctbal * 100)::bigint AS v FROM customer), p AS (SELECT *, (10 ** greatest(length(abs(v)::varchar) - 4, 0))::bigint AS p FROM v)
SELECT c_custkey, sign(v)::bigint * (abs(v) // p + CASE WHEN 2 * (abs(v) % p) > p OR (2 * (abs(v) % p) = p AND (abs(v) // p) % 2 = 1) THEN 1 ELSE 0 END) * p AS cents FROM p""",
    "folded_headlines": "SELECT news_id, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS key, trim(regexp_replace(lower(strip_accents(title)), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS folded FROM news",
    "url_parts": "SELECT news_id, source_url AS url, regexp_extract(source_url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(source_url, '/(\\d+)/(\\d+)$', 1) AS article, regexp_extract(source_url, '/(\\d+)/(\\d+)$', 2) AS version FROM news",
    "plain_documents": f"SELECT doc_id, sha256({_PLAIN}) AS digest, length({_PLAIN})::bigint AS n_chars FROM documents",
    "hash_words": f"""WITH h AS (SELECT DISTINCT regexp_replace({_id('transaction_hash')}, '^0x', '') AS h FROM trades) SELECT h, '0x' || substr(h, 25, 40) AS address, ('0x' || substr(h, 1, 8))::bigint AS head FROM h WHERE regexp_matches(h, '^[0-9a-f]{{64}}') AND NOT regexp_full_match(h, '0*')""",
    "token_hex": f"""WITH RECURSIVE t AS (SELECT DISTINCT trim(token_id, {_WS}) AS token FROM trades WHERE token_id IS NOT NULL), g AS (SELECT token, ltrim(token, '0') AS d FROM t WHERE regexp_full_match(token, '[0-9]{{1,78}}')),
s(token, d, i, q, r, hex) AS (SELECT token, d, 1, '', 0, '' FROM g UNION ALL SELECT token, CASE WHEN i > length(d) THEN ltrim(q, '0') ELSE d END, CASE WHEN i > length(d) THEN 1 ELSE i + 1 END,
  CASE WHEN i > length(d) THEN '' ELSE q || ((r * 10 + substr(d, i, 1)::int) // 16)::varchar END, CASE WHEN i > length(d) THEN 0 ELSE (r * 10 + substr(d, i, 1)::int) % 16 END, CASE WHEN i > length(d) THEN substr('0123456789abcdef', r + 1, 1) || hex ELSE hex END FROM s WHERE d <> ''),
h AS (SELECT token, hex FROM s WHERE d = '') SELECT token, CASE WHEN length(ltrim(hex, '0')) <= 64 THEN lpad(ltrim(hex, '0'), 64, '0') END AS hex FROM t LEFT JOIN h USING (token)""",
    "resolution_clause": """WITH d AS (SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(1), 'g'), chr(1)) AS s FROM documents WHERE doc_kind IN ('rules', 'market_note')),
h AS (SELECT doc_id, list_filter(s, lambda x: regexp_matches(x, 'final whistle|Schlusspfiff|coup de sifflet final|pitido final')) AS h FROM d) SELECT doc_id, h[1] AS clause FROM h WHERE len(h) = 1 AND length(h[1]) <= 400""",
    "chat_turns": """WITH p AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '\\n((?:system|user|assistant): )', chr(1) || '\\1', 'g'), chr(1)), lambda x: regexp_matches(x, '^(system|user|assistant): ')) AS p FROM documents WHERE doc_kind = 'chat' AND text IS NOT NULL),
u AS (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM p), r AS (SELECT doc_id, i, string_split(p[i], ': ')[1] AS role FROM u), b AS (SELECT *, lag(role) OVER (PARTITION BY doc_id ORDER BY i) AS q FROM r)
SELECT doc_id, count(*) AS n_turns, count(*) FILTER (WHERE role = 'user') AS n_user, count(*) FILTER (WHERE role = 'assistant') AS n_assistant, count(*) FILTER (WHERE q = role) AS n_repeated_roles FROM b GROUP BY 1""",
    "strict_records": """SELECT CASE WHEN link_json IS NOT NULL THEN true END AS strict, array_to_string(list_sort(json_keys(link_json)), ',') AS keys, json_extract_string(link_json, '$.relationship') AS relationship, count(*) AS n FROM fixture_news GROUP BY ALL""",
    "news_records": f"SELECT news_id, 'n' || substr(sha256({_BODY}), 1, 16) AS content_id, ('0x' || substr(sha256({_BODY}), 1, 16))::ubigint::varchar AS h64, md5({_BODY}) AS digest FROM news",
    "trade_quality": f"""WITH t AS (SELECT *, try_cast(trim(shares, {_WS}) AS decimal(38, 12)) AS sh, try_cast(trim(price, {_WS}) AS decimal(38, 12)) AS p FROM trades)
SELECT concat_ws(',', CASE WHEN query_us IS NULL THEN 'time' END, CASE WHEN NOT coalesce(upper(trim(side, {_WS})) IN ('BUY', 'SELL'), false) THEN 'side' END, CASE WHEN NOT coalesce(sh > 0, false) THEN 'shares' END, CASE WHEN NOT coalesce(p BETWEEN 0 AND 1, false) THEN 'price' END,
 CASE WHEN NOT coalesce(regexp_full_match({_id('wallet')}, '0x[0-9a-f]{{40}}'), false) THEN 'wallet' END, CASE WHEN token_id IS NULL THEN 'token' END) AS errors, count(*) AS n FROM t GROUP BY 1""",
    "answer_scores": f"WITH {_E}, g AS (SELECT user_id, count(*) AS n, min(t) AS a, max(t) AS b, avg(value) AS v FROM e GROUP BY 1) SELECT user_id, round(1 / (1 + exp(50 - v)), 9) AS p, round(CASE WHEN n > 1 AND b > a THEN 1 - exp(-(n - 1) * 300 / ((b - a) / 1e6)) ELSE 0 END, 9) AS rate FROM g",
    "actor_aliases": f"""WITH x AS (SELECT DISTINCT {_id('actor')} AS a, {_id('condition_id')} AS market FROM executions WHERE actor IS NOT NULL AND condition_id IS NOT NULL) SELECT 'actor_' || substr(sha256(a), 1, 24) AS actor, market, 'm' || lpad((row_number() OVER (PARTITION BY a ORDER BY market))::varchar, 3, '0') AS alias FROM x""",
    "feature_families": " UNION ALL ".join(f"SELECT '{n}' AS name, count({n}) AS n, max({n}) + 0.0 AS most, '{f}' AS family FROM lineitem" for n, f in (("l_quantity", "activity"), ("l_extendedprice", "price"), ("l_discount", "price"), ("l_tax", "cost"))),
    "candidate_headlines": f"WITH {_H}, {_P}, {_M} SELECT news_id, array_to_string(found, '|') AS teams, regexp_matches(words, '\\b(fixture|appointed)\\b') OR len(found) >= 2 OR (len(found) = 1 AND source_url LIKE '%northgoal%') AS candidate FROM m",
    "scope_reasons": f"""WITH {_H}, c AS (SELECT *, concat_ws(' ', words, trim(regexp_replace(lower(regexp_extract(source_url, '^https?://[^/?#]+([^?#]*)', 1)), '[^a-z0-9]+', ' ', 'g'))) AS b FROM h),
r AS (SELECT known_us, CASE WHEN regexp_matches(b, '{R.OTHER_SCOPE}') THEN 'other_competition' WHEN len(list_filter(regexp_extract_all(b, '\\b((?:19|20)[0-9]{{2}})\\b', 1), lambda y: y <> '2026')) > 0 THEN 'other_edition' WHEN NOT regexp_matches(b, '\\b(?:cup|final|squad|officials|fixture)\\b') THEN 'no_scope'
 WHEN NOT coalesce(strftime(make_timestamp(known_us), '%Y') = '2026', false) THEN 'capture_outside_edition' ELSE 'captured_scope' END AS reason FROM c) SELECT reason, count(*) AS n, min(known_us) FILTER (WHERE reason = 'captured_scope') AS first_us FROM r GROUP BY 1""",
    "pair_links": f"""WITH {_H}, {_P}, {_M}, an AS (SELECT team, string_agg(name, '|' ORDER BY name) AS names FROM al GROUP BY 1), pp AS (SELECT p.*, count(*) OVER (PARTITION BY pair) > 1 AS ambiguous, '(?:' || teams[1] || coalesce('|' || (SELECT names FROM an WHERE an.team = teams[1]), '') || ')' AS a, '(?:' || teams[2] || coalesce('|' || (SELECT names FROM an WHERE an.team = teams[2]), '') || ')' AS b FROM p),
x AS (SELECT m.*, trim(regexp_replace(regexp_replace(lower(title), '[\u2010-\u2015\u2212]', '-', 'g'), '[^a-z0-9-]+', ' ', 'g')) AS dashed FROM m JOIN news USING (news_id)),
j AS (SELECT x.news_id, x.words, x.dashed, x.known_us, pp.* FROM x JOIN pp ON list_contains(x.found, pp.teams[1]) AND list_contains(x.found, pp.teams[2])),
v AS (SELECT *, '\\b(?:' || a || ' (?:{R.AGAINST}) ' || b || '|' || b || ' (?:{R.AGAINST}) ' || a || '|how ' || a || ' can beat ' || b || '|how ' || b || ' can beat ' || a || ')\\b' AS p1, '\\b(?:' || a || ' ?- ?' || b || '|' || b || ' ?- ?' || a || '|how ' || a || ' can beat ' || b || '|how ' || b || ' can beat ' || a || ')\\b' AS p2 FROM j)
SELECT news_id, fixture, CASE WHEN ambiguous THEN 'ambiguous_pair' WHEN NOT (regexp_matches(words, p1) OR regexp_matches(dashed, p2)) THEN 'no_pair_pattern' WHEN known_us IS NULL THEN 'unverified_time' ELSE 'direct' END AS state FROM v""",
    "headline_links": f"""WITH {_H}, {_P}, {_M} SELECT DISTINCT news_id, fixture, CASE WHEN array_to_string(found, '|') = pair AND regexp_matches(words, '\\b(v|vs|against|face|meet)\\b') THEN 'direct' WHEN array_to_string(found, '|') = pair THEN 'pair' WHEN len(found) = 1 THEN 'team' ELSE 'background' END AS relationship
FROM m JOIN p ON list_has_any(m.found, p.teams)""",
    "link_times": f"""WITH j AS (SELECT {_id('f.fixture_id')} AS fixture, json_extract_string(link_json, '$.relationship') = 'direct' AS direct, CASE WHEN json_extract_string(record_json, '$.historical_availability_verified') = 'true' AND json_extract_string(link_json, '$.historical_link_verified') = 'true' AND eligible_us IS NOT NULL AND verified_availability_us IS NOT NULL
 THEN greatest(eligible_us, verified_availability_us) END AS t FROM fixture_news f JOIN news n USING (news_id)) SELECT fixture, count(*) AS n_links, count(t) AS n_usable, count(t) FILTER (WHERE direct) AS n_direct, min(t) AS first_us FROM j GROUP BY 1""",
    "paired_headlines": f"""WITH {_H}, {_P}, {_M}, t AS (SELECT {_id('fixture_id')} AS fixture, min(query_us) AS t FROM trades WHERE query_us IS NOT NULL GROUP BY 1), l AS (SELECT fixture, pair, t FROM p JOIN t USING (fixture)),
x AS (SELECT fixture, news_id, count(*) OVER (PARTITION BY news_id) AS u FROM l JOIN m ON len(found) = 2 AND array_to_string(found, '|') = pair AND abs(t - known_us) <= 864000000000), g AS (SELECT fixture, count(*) AS n, max(u) AS u FROM x GROUP BY 1)
SELECT fixture, CASE WHEN n IS NULL THEN 'unmatched' WHEN u > 1 THEN 'reused' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS kind FROM l LEFT JOIN g USING (fixture)""",
    "registry_audit": f"""WITH t AS (SELECT {_id('fixture_id')} AS f, {_id('condition_id')} AS c FROM trades), k AS (SELECT {_id('fixture_id')} AS f FROM tournament_sft_v1)
SELECT 'fixtures_repeated' AS finding, count(*) AS n FROM (SELECT f FROM k GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'fixtures_without_trades', count(*) FROM (SELECT DISTINCT f FROM k) x WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.f = x.f)
UNION ALL SELECT 'trades_without_fixture', count(*) FROM t WHERE f IS NULL UNION ALL SELECT 'conditions_of_two_fixtures', count(*) FROM (SELECT c FROM t WHERE c IS NOT NULL AND f IS NOT NULL GROUP BY 1 HAVING count(DISTINCT f) > 1)""",
    "event_kinds": "SELECT CASE WHEN lower(o_orderpriority) LIKE '1-%' THEN 'top' WHEN lower(o_orderpriority) LIKE '%low%' AND lower(o_orderpriority) NOT LIKE '%not%' THEN 'low' WHEN lower(o_orderpriority) LIKE '%not%' THEN 'unspecified' ELSE 'middle' END AS kind, count(*) AS n FROM orders WHERE epoch_us(o_orderdate) BETWEEN 0 AND 4102444800000000 GROUP BY 1",
    "chunked_sequences": """WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, floor(o_totalprice)::bigint AS c, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders),
f AS (SELECT o_custkey, o_orderkey, i, c AS used, 0::bigint AS chunk FROM o WHERE i = 1 UNION ALL SELECT o.o_custkey, o.o_orderkey, o.i, CASE WHEN used + c > 500000 THEN c ELSE used + c END, chunk + (used + c > 500000)::int FROM f JOIN o ON o.o_custkey = f.o_custkey AND o.i = f.i + 1) SELECT o_custkey, o_orderkey, chunk FROM f""",
    "watch_deltas": f"""WITH {_E}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i, lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS tp FROM e),
l AS (SELECT a.event_id, a.t, a.tp, a.event_type AS own, b.event_type AS k, max(b.t) AS u FROM r a LEFT JOIN r b ON a.user_id = b.user_id AND b.i < a.i GROUP BY ALL)
SELECT event_id, NOT coalesce(bool_or(k = own AND u >= t - 259200000000), false) AS added, count(*) FILTER (WHERE u < t - 259200000000 AND u >= tp - 259200000000) AS n_expired, count(*) FILTER (WHERE u >= t - 259200000000 AND k <> own) + 1 AS n_watched FROM l GROUP BY event_id""",
    "causal_features": f"""WITH {_E}, i AS (SELECT user_id, t, arg_max(event_type, event_id) AS k FROM e GROUP BY 1, 2), f AS (SELECT event_id, user_id, t, count(*) OVER d AS n_1d, count(*) OVER w AS n_7d, count(*) FILTER (WHERE event_type = 'purchase') OVER w AS buys_7d, sum(round(value * 1000000)::bigint) OVER w / (nullif(count(value) OVER w, 0) * 1000000) AS mean_7d,
 (t // 3600000000) % 24 AS hour, count(*) FILTER (WHERE event_type = 'purchase') OVER a - coalesce((event_type = 'purchase')::int, 0) > 0 AS label FROM e WHERE user_id IS NOT NULL AND t IS NOT NULL
 WINDOW d AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING), w AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN 604800000000 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN CURRENT ROW AND 86399999999 FOLLOWING))
SELECT event_id, n_1d, n_7d, buys_7d, mean_7d, f.t - i.t AS since_us, i.k AS last_type, hour, label FROM f ASOF LEFT JOIN i ON f.user_id = i.user_id AND f.t > i.t""",
}
