"""Activity filters, ledgers, set operations and audits on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.clean import amount, hex_ident, ident, outer_trim, split_name
from tidemark.operators import ledgers as L
from tidemark.operators.asof import micros
from tidemark.session import table


def _trades(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "trades").select(
        "trade_row_id", "observation_id", "source_page_id", "source_line", ident(F.col("wallet")).alias("wallet"), ident(F.col("condition_id")).alias("condition"), "token_id", "token_outcome", "token_mapping_status",
        ident(F.col("fixture_id")).alias("fixture"), hex_ident(F.col("transaction_hash")).alias("tx"), F.col("query_us").alias("t"),
    )


def pair_activity_filter(spark: SparkSession, root: str) -> DataFrame:
    """Pairs (customer, priority) with fewer than 5 orders, all their orders kept."""
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return L.below_threshold(o, ["o_custkey", "o_orderpriority"], 5)


def wallet_activity_filter(spark: SparkSession, root: str) -> DataFrame:
    """Trades of wallets with fewer than 20 trades over all markets."""
    t = _trades(spark, root).select("trade_row_id", "wallet", "condition").where("wallet IS NOT NULL AND condition IS NOT NULL")
    return L.below_threshold(t, ["wallet"], 20, per=["condition"])


def pair_cap_filter(spark: SparkSession, root: str) -> DataFrame:
    """At most 3 trades a pair: with and without dropping the whole wallet."""
    t = _trades(spark, root).select("trade_row_id", "wallet", "condition").where("wallet IS NOT NULL AND condition IS NOT NULL")
    loose = L.at_most_per_pair(t, "wallet", "condition", 3, drop_actor=False).select("trade_row_id", F.lit("pair").alias("rule"))
    return loose.unionByName(L.at_most_per_pair(t, "wallet", "condition", 3, drop_actor=True).select("trade_row_id", F.lit("wallet").alias("rule")))


def exclusion_filter(spark: SparkSession, root: str) -> DataFrame:
    """Executions without those of actors seen before a cut-off and of trade wallets."""
    x = table(spark, root, "executions").select(ident(F.col("actor")).alias("actor"), "execution_id", "time_us").dropna(subset=["actor", "time_us"])
    cut = 1_780_000_000_000_000
    early = x.where(F.col("time_us") < cut).select("actor").distinct()
    wallets = _trades(spark, root).select(F.col("wallet").alias("actor")).dropna().distinct()
    return x.where(F.col("time_us") >= cut).join(early, "actor", "left_anti").join(wallets, "actor", "left_anti").distinct()


def cross_split_keys(spark: SparkSession, root: str) -> DataFrame:
    """Transactions that stand in more than one split (F9, SO7, A4)."""
    r = table(spark, root, "transactions").select(hex_ident(F.col("tx")).alias("tx"), split_name(F.col("split")).alias("s")).dropna()
    return L.crossing_keys(r, "tx", F.col("s"))


def index_report(spark: SparkSession, root: str) -> DataFrame:
    """Counts, distinct counts and conditional counts of the log in one pass (A1)."""
    return _trades(spark, root).agg(
        F.count("*").alias("n_rows"), F.count("t").alias("n_dated"), F.countDistinct("wallet").alias("n_wallets"), F.countDistinct("condition").alias("n_conditions"), F.countDistinct("fixture").alias("n_fixtures"),
        F.count_if(F.col("token_mapping_status").like("exact%")).alias("n_exact"), F.min("t").alias("first_us"), F.max("t").alias("last_us"),
    )


def mapping_histogram(spark: SparkSession, root: str) -> DataFrame:
    return _trades(spark, root).groupBy("token_mapping_status").agg(F.count("*").alias("n_rows"), F.countDistinct("token_id").alias("n_tokens"))


def duplicate_key_groups(spark: SparkSession, root: str) -> DataFrame:
    """Repeated (order, line) keys of a multiset table (A2)."""
    return L.duplicate_keys(table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])


def ledger_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Pair ledger rolled up by wallet, with the number of pairs (A3, SK7)."""
    led = L.count_ledger(_trades(spark, root).where("wallet IS NOT NULL AND condition IS NOT NULL"), ["wallet", "condition"])
    return led.groupBy("wallet").agg(F.sum("n").alias("n"), F.count("*").alias("n_conditions"), F.max("n").alias("largest"))


def conditional_distinct(spark: SparkSession, root: str) -> DataFrame:
    """Distinct counts under conditions, in one aggregation (A4)."""
    l = table(spark, root, "lineitem")
    when = lambda c: F.countDistinct(F.when(c, F.col("l_orderkey")))
    return l.groupBy("l_returnflag").agg(
        when(F.col("l_quantity") < 10).alias("small"), when(F.col("l_quantity") >= 40).alias("large"), F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey", "l_suppkey").alias("part_suppliers"),
    )


def page_count_audit(spark: SparkSession, root: str) -> DataFrame:
    """Declared against actual rows per page, both directions."""
    declared = table(spark, root, "source_pages").select("source_page_id", F.col("row_count").alias("n"))
    actual = L.count_ledger(_trades(spark, root), ["source_page_id"])
    return L.ledger_difference(declared, actual, ["source_page_id"])


def column_mismatches(spark: SparkSession, root: str) -> DataFrame:
    """Null-safe mismatch counts per column of first against last delivery."""
    t = table(spark, root, "trades").select(ident(F.col("observation_id")).alias("m"), "trade_row_id", "wallet", "side", "shares", "price", "query_us", "fixture_id").dropna(subset=["m"])
    cols = ["wallet", "side", "shares", "price", "query_us", "fixture_id"]
    pick = lambda f: t.groupBy("m").agg(f(F.struct("trade_row_id", *cols)).alias("s")).select("m", *[F.col(f"s.{c}").alias(c) for c in cols])
    return L.null_safe_mismatches(pick(F.min), pick(F.max), "m", cols)


def multiset_containment(spark: SparkSession, root: str) -> DataFrame:
    """Lines that the returned part has more often than the accepted part (J16, SO5)."""
    l = table(spark, root, "lineitem")
    cols = ["l_partkey", "l_suppkey"]
    return L.multiset_excess(l.where("l_returnflag = 'R'"), l.where("l_returnflag = 'A'"), cols)


def multiset_equality(spark: SparkSession, root: str) -> DataFrame:
    """How far two multisets of (order, part) are from equal (SO5, V2)."""
    l = table(spark, root, "lineitem").select("l_partkey", "l_linestatus", "l_quantity")
    return L.multiset_equal(l.where("l_quantity < 25").drop("l_quantity"), l.where("l_quantity >= 25").drop("l_quantity"))


def split_symmetric_difference(spark: SparkSession, root: str) -> DataFrame:
    """Customers of urgent but not low orders and the reverse (SO1, SO4)."""
    o = table(spark, root, "orders")
    pick = lambda p: o.where(F.col("o_orderpriority").startswith(p)).select("o_custkey")
    return L.symmetric_difference(pick("1"), pick("5"))


def replaced_log(spark: SparkSession, root: str) -> DataFrame:
    """Customers with a late order are replaced by their fresh rows under new ids (SO2, V10 in part)."""
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    fresh = o.where("o_orderdate >= '1998-01-01'").drop("o_orderdate")
    return L.replace_groups(o.drop("o_orderdate"), fresh, ["o_custkey"], "o_orderkey")


def split_disjointness(spark: SparkSession, root: str) -> DataFrame:
    """Fixtures, transactions and sources shared by two splits (SO3, G8, V8)."""
    r = table(spark, root, "transactions").select(split_name(F.col("split")).alias("s"), hex_ident(F.col("tx")).alias("tx"), ident(F.col("fixture_id")).alias("fixture"), "source").where("s IS NOT NULL")
    parts = [r.select(F.lit(c).alias("what"), F.col(c).alias("k"), "s").dropna().groupBy("what", "k").agg(F.count_distinct("s").alias("n")) for c in ("tx", "fixture", "source")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("what").agg(F.count("*").alias("n_keys"), F.count_if(F.col("n") > 1).alias("n_shared"))


def catalogue_union(spark: SparkSession, root: str) -> DataFrame:
    """News ids of catalogue and links united, with how often each side has them (SO6, J13)."""
    n = table(spark, root, "news").select("news_id", F.lit(1).alias("c"), F.lit(0).alias("l"))
    u = n.unionByName(table(spark, root, "fixture_news").select("news_id", F.lit(0).alias("c"), F.lit(1).alias("l")))
    return u.where("news_id IS NOT NULL").groupBy("news_id").agg(F.sum("c").alias("n_catalogue"), F.sum("l").alias("n_links"))


def orphan_links(spark: SparkSession, root: str) -> DataFrame:
    """Links to unknown news, and links of unknown fixtures."""
    f = table(spark, root, "fixture_news").select("news_id", ident(F.col("fixture_id")).alias("fixture"))
    known = table(spark, root, "tournament_sft_v1").select(ident(F.col("fixture_id")).alias("fixture"))
    a = f.join(table(spark, root, "news").select("news_id"), "news_id", "left_anti").select(F.lit("news").alias("missing"), F.col("news_id").alias("id"))
    b = f.join(known, "fixture", "left_anti").select(F.lit("fixture").alias("missing"), F.col("fixture").alias("id"))
    return a.unionByName(b).groupBy("missing", "id").agg(F.count("*").alias("n"))


def token_registry_join(spark: SparkSession, root: str) -> DataFrame:
    """Condition -> token -> outcome with a three-valued mapping status (J9, SC21)."""
    t = _trades(spark, root).select("trade_row_id", "condition", F.trim("token_id").alias("token"), "token_outcome", "token_mapping_status")
    good = t.where("token_mapping_status LIKE 'exact%' AND condition IS NOT NULL AND token IS NOT NULL")
    reg = good.groupBy("condition", "token").agg(F.min("token_outcome").alias("outcome"))
    conds = reg.select("condition", F.lit(True).alias("known")).distinct()
    j = t.join(conds, "condition", "left").join(reg, ["condition", "token"], "left")
    status = F.when(F.col("known").isNull(), "unknown_condition").when(F.col("outcome").isNull(), "unknown_token").otherwise("exact")
    return j.groupBy(status.alias("status")).agg(F.count("*").alias("n_rows"), F.count_if(F.col("token_outcome").eqNullSafe(F.col("outcome"))).alias("n_same_outcome"))


def exact_join_coverage(spark: SparkSession, root: str) -> DataFrame:
    """Lines must hit their order exactly: hits, misses and late ships."""
    l = table(spark, root, "lineitem").select("l_orderkey", "l_shipdate")
    o = table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    hit = l.join(o, "l_orderkey").agg(F.count("*").alias("n_hits"), F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("n_before_order"))
    miss = l.join(o, "l_orderkey", "left_anti").agg(F.count("*").alias("n_misses"))
    return hit.withColumn("n_misses", miss.scalar())


def positional_compare(spark: SparkSession, root: str) -> DataFrame:
    """Two orderings of each nation's suppliers zipped by position, null-safe; ``shards.positional_zip`` takes one order over all."""
    s = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    a = s.withColumn("i", F.row_number().over(W.partitionBy("s_nationkey").orderBy("s_suppkey")))
    b = s.select(F.col("s_suppkey").alias("other"), "s_nationkey", F.row_number().over(W.partitionBy("s_nationkey").orderBy(F.desc("s_suppkey"))).alias("i"))
    return a.join(b, ["s_nationkey", "i"]).groupBy("s_nationkey").agg(F.count("*").alias("n"), F.count_if(F.col("s_suppkey").eqNullSafe(F.col("other"))).alias("n_equal"))


def reconcile_tolerance(spark: SparkSession, root: str) -> DataFrame:
    """Each trade by how many others of its transaction and token lie within a price tolerance.

    One range frame over whole units of price; no pair is formed.
    """
    t = table(spark, root, "trades").select("trade_row_id", hex_ident(F.col("transaction_hash")).alias("tx"), outer_trim("token_id").alias("token"), (amount(F.col("price"), 18, 8) * 100_000_000).cast("long").alias("u")).where("tx IS NOT NULL AND token IS NOT NULL AND u IS NOT NULL")
    n = F.count("*").over(W.partitionBy("tx", "token").orderBy("u").rangeBetween(-1_000_000, 1_000_000)) - 1
    return t.withColumn("n", n).groupBy(F.when(F.col("n") == 0, "none").when(F.col("n") == 1, "unique").otherwise("ambiguous").alias("status")).agg(F.count("*").alias("n_rows"))


def band_join_orders(spark: SparkSession, root: str) -> DataFrame:
    """Pair equal and times within three days: none, one or many."""
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", micros("o_orderdate").alias("t"))
    day = 86_400_000_000
    a, b = o.where("o_orderpriority LIKE '1%'"), o.where("o_orderpriority LIKE '5%'").select(F.col("o_orderkey").alias("k2"), "o_custkey", F.col("t").alias("t2"))
    # three days are one block, so a partner lies in the same block or a neighbour
    block = lambda c: F.floor(F.col(c) / (3 * day)).cast("long")
    b = b.withColumn("block", F.explode(F.sequence(block("t2") - 1, block("t2") + 1)))
    met = a.withColumn("block", block("t")).join(b, ["o_custkey", "block"]).where(F.abs(F.col("t") - F.col("t2")) <= 3 * day)
    n = met.groupBy("o_orderkey").agg(F.count("*").alias("n"))
    used = met.groupBy("k2").agg(F.count("*").alias("u")).where("u > 1").select("k2")
    twice = met.join(used, "k2", "left_semi").select("o_orderkey", F.lit(True).alias("reused")).distinct()
    j = a.join(n, "o_orderkey", "left").join(twice, "o_orderkey", "left")
    kind = F.when(F.col("n").isNull(), "unmatched").when(F.col("reused"), "reused").when(F.col("n") == 1, "matched").otherwise("ambiguous")
    return j.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def earliest_evidence(spark: SparkSession, root: str) -> DataFrame:
    """Earliest evidence per fixture by (time, id)."""
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", "eligible_us").dropna()
    return f.groupBy("fixture").agg(F.min(F.struct("eligible_us", "news_id")).alias("s")).select("fixture", "s.eligible_us", "s.news_id")


def completion_gates(spark: SparkSession, root: str) -> DataFrame:
    """Named pass/fail checks over several tables (A20 in part, V8)."""
    t, p, n, f = (table(spark, root, x) for x in ("trades", "source_pages", "news", "fixture_news"))
    none = lambda df: df.agg(F.count("*") == 0)
    return L.gates({
        "rows_unique": none(L.duplicate_keys(t, ["trade_row_id"])),
        "lines_unique": none(L.duplicate_keys(t.where("source_page_id IS NOT NULL AND source_line IS NOT NULL"), ["source_page_id", "source_line"])),
        "pages_known": none(t.where("source_page_id IS NOT NULL").join(p, "source_page_id", "left_anti")),
        "page_counts_match": none(L.ledger_difference(p.select("source_page_id", F.col("row_count").alias("n")), L.count_ledger(t, ["source_page_id"]), ["source_page_id"])),
        "versions_unique": none(L.duplicate_keys(n, ["item_id", "version_rank"])),
        "links_known": none(f.join(n, "news_id", "left_anti")),
        "prices_valid": none(t.where("price IS NOT NULL").where(F.coalesce(~F.trim("price").try_cast("double").between(0, 1), F.lit(True)))),
    })


QUERIES = {
    f.__name__: f
    for f in (
        pair_activity_filter, wallet_activity_filter, pair_cap_filter, exclusion_filter, cross_split_keys, index_report, mapping_histogram, duplicate_key_groups, ledger_rollup, conditional_distinct,
        page_count_audit, column_mismatches, multiset_containment, multiset_equality, split_symmetric_difference, replaced_log, split_disjointness, catalogue_union, orphan_links, token_registry_join,
        exact_join_coverage, positional_compare, reconcile_tolerance, band_join_orders, earliest_evidence, completion_gates,
    )
}

_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _id(c: str) -> str:
    return f"lower(trim({c}, {_WS}))"


def _hex(c: str) -> str:
    bare = f"regexp_replace({_id(c)}, '^0x', '')"
    return f"CASE WHEN NOT regexp_full_match({bare}, '0*') THEN {bare} END"


_SPLIT = f"CASE WHEN {_id('split')} IN ('train', 'training') THEN 'train' WHEN {_id('split')} IN ('validation', 'valid', 'val', 'dev') THEN 'validation' WHEN {_id('split')} = 'test' THEN 'test' END"
_T = f"""t AS (SELECT trade_row_id, source_page_id, source_line, {_id('wallet')} AS wallet, {_id('condition_id')} AS condition, token_id, token_outcome, token_mapping_status, {_id('fixture_id')} AS fixture, {_hex('transaction_hash')} AS tx, query_us AS t FROM trades)"""
_TW = f"WITH {_T}, w AS (SELECT * FROM t WHERE wallet IS NOT NULL AND condition IS NOT NULL)"

ORACLE = {
    "pair_activity_filter": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderpriority) < 5",
    "wallet_activity_filter": _TW + " SELECT trade_row_id, wallet, condition FROM w QUALIFY count(*) OVER (PARTITION BY wallet) < 20",
    "pair_cap_filter": _TW + """, c AS (SELECT *, count(*) OVER (PARTITION BY wallet, condition) AS n FROM w), d AS (SELECT *, max(n) OVER (PARTITION BY wallet) AS m FROM c)
SELECT trade_row_id, 'pair' AS rule FROM d WHERE n <= 3 UNION ALL SELECT trade_row_id, 'wallet' FROM d WHERE m <= 3""",
    "exclusion_filter": f"""WITH x AS (SELECT DISTINCT {_id('actor')} AS actor, execution_id, time_us FROM executions WHERE actor IS NOT NULL AND time_us IS NOT NULL)
SELECT * FROM x WHERE time_us >= 1780000000000000 AND actor NOT IN (SELECT actor FROM x WHERE time_us < 1780000000000000) AND actor NOT IN (SELECT {_id('wallet')} FROM trades WHERE wallet IS NOT NULL)""",
    "cross_split_keys": f"WITH r AS (SELECT {_hex('tx')} AS tx, {_SPLIT} AS s FROM transactions) SELECT tx, count(DISTINCT s) AS n_groups FROM r WHERE tx IS NOT NULL AND s IS NOT NULL GROUP BY tx HAVING count(DISTINCT s) > 1",
    "index_report": f"WITH {_T} SELECT count(*) AS n_rows, count(t) AS n_dated, count(DISTINCT wallet) AS n_wallets, count(DISTINCT condition) AS n_conditions, count(DISTINCT fixture) AS n_fixtures, count(*) FILTER (WHERE token_mapping_status LIKE 'exact%') AS n_exact, min(t) AS first_us, max(t) AS last_us FROM t",
    "mapping_histogram": "SELECT token_mapping_status, count(*) AS n_rows, count(DISTINCT token_id) AS n_tokens FROM trades GROUP BY 1",
    "duplicate_key_groups": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "ledger_rollup": _TW + ", l AS (SELECT wallet, condition, count(*) AS n FROM w GROUP BY 1, 2) SELECT wallet, sum(n)::bigint AS n, count(*) AS n_conditions, max(n) AS largest FROM l GROUP BY 1",
    "conditional_distinct": """SELECT l_returnflag, count(DISTINCT CASE WHEN l_quantity < 10 THEN l_orderkey END) AS small, count(DISTINCT CASE WHEN l_quantity >= 40 THEN l_orderkey END) AS large, count(DISTINCT l_orderkey) AS orders,
 count(DISTINCT (l_partkey, l_suppkey)) AS part_suppliers FROM lineitem GROUP BY 1""",
    "page_count_audit": """SELECT * FROM (SELECT coalesce(p.source_page_id, a.source_page_id) AS source_page_id, p.row_count AS n_declared, a.n AS n_actual,
 CASE WHEN a.n IS NULL THEN 'missing' WHEN p.row_count IS NULL THEN 'extra' WHEN a.n <> p.row_count THEN 'mismatch' END AS status
 FROM source_pages p FULL JOIN (SELECT source_page_id, count(*) AS n FROM trades GROUP BY 1) a ON p.source_page_id = a.source_page_id) WHERE status IS NOT NULL""",
    "column_mismatches": f"""WITH t AS (SELECT {_id('observation_id')} AS m, * FROM trades WHERE observation_id IS NOT NULL), a AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY m ORDER BY trade_row_id) = 1),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY m ORDER BY trade_row_id DESC) = 1)
{' UNION ALL '.join(f'SELECT ' + chr(39) + c + chr(39) + f' AS "column", count(*) FILTER (WHERE a.{c} IS DISTINCT FROM b.{c}) AS n_mismatch FROM a JOIN b USING (m)' for c in ("wallet", "side", "shares", "price", "query_us", "fixture_id"))}""",
    "multiset_containment": "SELECT l_partkey, l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS n_part, count(*) FILTER (WHERE l_returnflag = 'A') AS n_whole FROM lineitem GROUP BY 1, 2 HAVING n_part > n_whole",
    "multiset_equality": """WITH g AS (SELECT l_partkey, l_linestatus, count(*) FILTER (WHERE l_quantity < 25) - count(*) FILTER (WHERE l_quantity >= 25) AS d FROM lineitem GROUP BY 1, 2)
SELECT sum(greatest(d, 0))::bigint AS only_first, sum(greatest(-d, 0))::bigint AS only_second FROM g""",
    "split_symmetric_difference": """WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority LIKE '1%'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority LIKE '5%')
SELECT o_custkey, 'first' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT o_custkey, 'second' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "replaced_log": """WITH f AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1998-01-01')
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM f) UNION ALL SELECT o_orderkey + (SELECT max(o_orderkey) FROM orders), o_custkey, o_totalprice FROM f""",
    "split_disjointness": f"""WITH r AS (SELECT {_SPLIT} AS s, {_hex('tx')} AS tx, {_id('fixture_id')} AS fixture, source FROM transactions),
g AS (SELECT what, k, count(DISTINCT s) AS n FROM (SELECT 'tx' AS what, tx AS k, s FROM r UNION ALL SELECT 'fixture', fixture, s FROM r UNION ALL SELECT 'source', source, s FROM r) WHERE k IS NOT NULL AND s IS NOT NULL GROUP BY 1, 2)
SELECT what, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_shared FROM g GROUP BY 1""",
    "catalogue_union": "SELECT news_id, sum(c)::bigint AS n_catalogue, sum(l)::bigint AS n_links FROM (SELECT news_id, 1 AS c, 0 AS l FROM news UNION ALL SELECT news_id, 0, 1 FROM fixture_news) WHERE news_id IS NOT NULL GROUP BY 1",
    "orphan_links": f"""SELECT 'news' AS missing, news_id AS id, count(*) AS n FROM fixture_news f WHERE NOT EXISTS (SELECT 1 FROM news n WHERE n.news_id = f.news_id) GROUP BY ALL
UNION ALL SELECT 'fixture', {_id('fixture_id')}, count(*) FROM fixture_news f WHERE NOT EXISTS (SELECT 1 FROM tournament_sft_v1 k WHERE {_id('k.fixture_id')} = {_id('f.fixture_id')}) GROUP BY ALL""",
    "token_registry_join": f"""WITH {_T}, g AS (SELECT condition, trim(token_id) AS token, min(token_outcome) AS outcome FROM t WHERE token_mapping_status LIKE 'exact%' AND condition IS NOT NULL AND token_id IS NOT NULL GROUP BY 1, 2)
SELECT CASE WHEN c.condition IS NULL THEN 'unknown_condition' WHEN outcome IS NULL THEN 'unknown_token' ELSE 'exact' END AS status, count(*) AS n_rows, count(*) FILTER (WHERE token_outcome IS NOT DISTINCT FROM outcome) AS n_same_outcome
FROM t LEFT JOIN (SELECT DISTINCT condition FROM g) c ON t.condition = c.condition LEFT JOIN g ON t.condition = g.condition AND trim(t.token_id) = g.token GROUP BY 1""",
    "exact_join_coverage": """SELECT count(o_orderkey) AS n_hits, count(*) FILTER (WHERE l_shipdate < o_orderdate) AS n_before_order, count(*) FILTER (WHERE o_orderkey IS NULL) AS n_misses FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "positional_compare": """WITH a AS (SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS i, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS j FROM supplier)
SELECT a.s_nationkey, count(*) AS n, count(*) FILTER (WHERE a.s_suppkey = b.s_suppkey) AS n_equal FROM a JOIN a b ON a.s_nationkey = b.s_nationkey AND a.i = b.j GROUP BY 1""",
    "reconcile_tolerance": f"""WITH t AS (SELECT trade_row_id, {_hex('transaction_hash')} AS tx, trim(token_id, {_WS}) AS token, (try_cast(trim(price, {_WS}) AS decimal(18, 8)) * 100000000)::bigint AS u FROM trades), v AS (SELECT * FROM t WHERE tx IS NOT NULL AND token IS NOT NULL AND u IS NOT NULL),
n AS (SELECT a.trade_row_id, count(b.trade_row_id) AS n FROM v a LEFT JOIN v b ON a.tx = b.tx AND a.token = b.token AND a.trade_row_id <> b.trade_row_id AND abs(a.u - b.u) <= 1000000 GROUP BY 1)
SELECT CASE n WHEN 0 THEN 'none' WHEN 1 THEN 'unique' ELSE 'ambiguous' END AS status, count(*) AS n_rows FROM n GROUP BY 1""",
    "band_join_orders": """WITH a AS (SELECT o_orderkey, o_custkey, o_orderdate AS t FROM orders WHERE o_orderpriority LIKE '1%'), b AS (SELECT o_orderkey AS k2, o_custkey, o_orderdate AS t2 FROM orders WHERE o_orderpriority LIKE '5%'),
m AS (SELECT a.o_orderkey, k2, count(*) OVER (PARTITION BY k2) AS u FROM a JOIN b USING (o_custkey) WHERE abs(epoch_us(t) - epoch_us(t2)) <= 259200000000), g AS (SELECT o_orderkey, count(*) AS n, max(u) AS u FROM m GROUP BY 1)
SELECT CASE WHEN n IS NULL THEN 'unmatched' WHEN u > 1 THEN 'reused' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS kind, count(*) AS n FROM a LEFT JOIN g USING (o_orderkey) GROUP BY 1""",
    "earliest_evidence": f"""SELECT {_id('fixture_id')} AS fixture, eligible_us, news_id FROM fixture_news WHERE fixture_id IS NOT NULL AND news_id IS NOT NULL AND eligible_us IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_id('fixture_id')} ORDER BY eligible_us, news_id) = 1""",
    "completion_gates": """SELECT 'rows_unique' AS gate, count(*) = count(DISTINCT trade_row_id) AS passed FROM trades
UNION ALL SELECT 'lines_unique', count(*) = count(DISTINCT (source_page_id, source_line)) FROM trades WHERE source_page_id IS NOT NULL AND source_line IS NOT NULL
UNION ALL SELECT 'pages_known', count(*) = 0 FROM trades WHERE source_page_id NOT IN (SELECT source_page_id FROM source_pages)
UNION ALL SELECT 'page_counts_match', count(*) = 0 FROM (SELECT source_page_id, count(*) AS n FROM trades GROUP BY 1) a FULL JOIN source_pages p ON p.source_page_id = a.source_page_id WHERE n IS DISTINCT FROM row_count
UNION ALL SELECT 'versions_unique', count(*) = count(DISTINCT (item_id, version_rank)) FROM news
UNION ALL SELECT 'links_known', count(*) = 0 FROM fixture_news f WHERE NOT EXISTS (SELECT 1 FROM news n WHERE n.news_id = f.news_id)
UNION ALL SELECT 'prices_valid', count(*) = 0 FROM trades WHERE price IS NOT NULL AND NOT coalesce(try_cast(trim(price) AS double) BETWEEN 0 AND 1, false)""",
}
