"""Audits, exports and recoveries on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.clean import amount, hex_ident, ident, outer_trim, split_name
from tidemark.functions.scalars import strict_json
from tidemark.operators import audits as A
from tidemark.operators import ledgers as L
from tidemark.operators import shards
from tidemark.operators.asof import asof_prior, micros
from tidemark.operators.context import available_before, evidence_valid
from tidemark.plans.context import gap_alternation
from tidemark.session import materialize, scratch, table
from tidemark.sources import readers, sinks
from tidemark.streaming import jobs

HOUR = 3_600_000_000
# Names of fields that context may not carry, since they give the answer away.
FORBIDDEN = ("label", "answer", "outcome", "winner", "shares", "price")


def _keys(spark: SparkSession, root: str) -> DataFrame:
    t = table(spark, root, "trades")
    return t.select(
        "trade_row_id", "source_page_id", "source_line", ident(F.col("wallet")).alias("wallet"), hex_ident(F.col("condition_id")).alias("condition"), outer_trim("token_id").alias("token"), ident(F.col("token_outcome")).alias("outcome"), ident(F.col("fixture_id")).alias("fixture"),
        hex_ident(F.col("transaction_hash")).alias("tx"), F.col("query_us").alias("t"), F.upper(outer_trim("side")).alias("side"), amount(F.col("shares"), 20, 8).alias("shares"), amount(F.col("price"), 13, 12).alias("price"), "token_mapping_status",
    )


def _kickoffs(spark: SparkSession, root: str) -> DataFrame:
    k = table(spark, root, "tournament_sft_v1").where("policy_version = 1").select(ident(F.col("fixture_id")).alias("fixture"), "split", micros("kickoff_at").alias("kickoff"), *[micros(F.to_timestamp(c)).alias(n) for c, n in (("train_before_utc", "a"), ("validation_before_utc", "b"))])
    return k.where("fixture IS NOT NULL").groupBy("fixture").agg(*[F.min(c).alias(c) for c in ("split", "kickoff", "a", "b")])


def ordered_merge(spark: SparkSession, root: str) -> DataFrame:
    """Orders of three states merged by time into one order over all rows."""
    o = table(spark, root, "orders").select("o_orderkey", "o_orderstatus", micros("o_orderdate").alias("t"))
    merged = shards.ordered_merge([o.where(F.col("o_orderstatus") == s) for s in "FOP"], ["t", "o_orderkey"])
    return merged.select("row", "o_orderkey", F.col("source").cast("long").alias("source"))


def positional_differences(spark: SparkSession, root: str) -> DataFrame:
    """Orders by time and orders by key side by side by position: rows that agree, and the first that does not."""
    o = table(spark, root, "orders").select("o_orderkey", micros("o_orderdate").alias("t"))
    side = lambda order, n: shards.positions(o, order).select("row", F.col("o_orderkey").alias(n))
    z = side(["t", "o_orderkey"], "x").join(side(["o_orderkey"], "y"), "row", "full")
    return z.agg(F.count("*").alias("n"), F.count_if(F.col("x").eqNullSafe(F.col("y"))).alias("n_equal"), F.min(F.when(~F.col("x").eqNullSafe(F.col("y")), F.col("row"))).alias("first_difference"))


def contract_mismatches(spark: SparkSession, root: str) -> DataFrame:
    """Rows that contradict the earliest evidence of their token: condition, outcome or fixture."""
    t = _keys(spark, root).where("token IS NOT NULL")
    first = t.where("t IS NOT NULL AND condition IS NOT NULL AND outcome IS NOT NULL AND fixture IS NOT NULL").groupBy("token").agg(F.min(F.struct("t", "trade_row_id", "condition", "outcome", "fixture")).alias("e"))
    j = t.join(first, "token")
    bad = [F.when(F.col(c).isNotNull() & (F.col(c) != F.col(f"e.{c}")), F.lit(c)) for c in ("condition", "outcome", "fixture")]
    return j.select("trade_row_id", F.array_join(F.array_compact(F.array(*bad)), "+").alias("fields")).where("fields <> ''")


def forbidden_fields(spark: SparkSession, root: str) -> DataFrame:
    """Field names at any depth of the stored JSON, with those that context may not carry marked."""
    one = lambda name, c: table(spark, root, name).select(F.lit(name).alias("source"), F.explode(A.json_keys(F.col(c))).alias("field"))
    return one("news", "record_json").unionByName(one("fixture_news", "link_json")).groupBy("source", "field").agg(F.count("*").alias("n")).withColumn("forbidden", F.col("field").isin(*FORBIDDEN))


def plausible_times(spark: SparkSession, root: str) -> DataFrame:
    """Distinct observations of each fixture inside [kick-off - 6 h, kick-off + 12 h], and outside (F24, SC13)."""
    t = table(spark, root, "trades").select(ident(F.col("observation_id")).alias("o"), ident(F.col("fixture_id")).alias("fixture"), F.col("query_us").alias("t")).where("o IS NOT NULL AND fixture IS NOT NULL AND t IS NOT NULL")
    once = t.groupBy("o").agg(F.min(F.struct("t", "fixture")).alias("x")).select("x.*")
    j = once.join(_kickoffs(spark, root).where("kickoff IS NOT NULL").select("fixture", "kickoff"), "fixture")
    ok = F.col("t").between(F.col("kickoff") - 6 * HOUR, F.col("kickoff") + 12 * HOUR)
    return j.groupBy("fixture").agg(F.count("*").alias("n"), F.count_if(ok).alias("n_plausible"))


def registry_discovery(spark: SparkSession, root: str) -> DataFrame:
    """Fixtures read from nested event records: contracts, tokens, and whether the event is complete (SC11, SC12).

    Events are written as nested JSON and read back, then exploded twice; a
    complete one has three contracts of a Yes and a No token each.
    """
    t = _keys(spark, root).where("fixture IS NOT NULL AND condition IS NOT NULL AND token IS NOT NULL AND outcome IN ('yes', 'no')").groupBy("fixture", "condition", "outcome").agg(F.min("token").alias("token"))
    c = t.groupBy("fixture", "condition").agg(F.array_sort(F.collect_list(F.struct("outcome", "token"))).alias("tokens"))
    events = c.groupBy("fixture").agg(F.array_sort(F.collect_list(F.struct("condition", "tokens"))).alias("markets"))
    path = scratch(spark, "events")
    events.write.json(path)
    back = readers.read_jsonl(spark, path, "fixture string, markets array<struct<condition string, tokens array<struct<outcome string, token string>>>>")
    m = back.select("fixture", F.explode("markets").alias("m")).select("fixture", "m.condition", F.explode("m.tokens").alias("k"))
    per = m.groupBy("fixture", "condition").agg(F.countDistinct("k.outcome").alias("sides"), F.count("*").alias("tokens"))
    return per.groupBy("fixture").agg(F.count("*").alias("n_contracts"), F.sum("tokens").alias("n_tokens"), ((F.count("*") == 3) & (F.min("sides") == 2)).alias("complete"))


def export_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Captures of one format tag, each path and each content once; others with the reason (SC20, SC15)."""
    p = table(spark, root, "source_pages").select("source_page_id", ident(F.col("path")).alias("path"), ident(F.col("uncompressed_sha256")).alias("sha"), "provenance_scope")
    by_path, by_sha = F.row_number().over(W.partitionBy("path").orderBy("source_page_id")), F.row_number().over(W.partitionBy("sha").orderBy("source_page_id"))
    reason = (
        F.when(~F.col("provenance_scope").eqNullSafe("condition"), "other_format").when(~F.coalesce(F.col("sha").rlike("^[0-9a-f]{64}$"), F.lit(False)), "no_digest")
        .when(F.col("path").isNotNull() & (F.col("p") > 1), "path_repeated").when(F.col("s") > 1, "content_repeated").otherwise("used")
    )
    return p.withColumns({"p": by_path, "s": by_sha}).select("source_page_id", reason.alias("reason"))


def stopped_pages(spark: SparkSession, root: str) -> DataFrame:
    """Pages of each scope in the order of their ids until two in a row are older than 1 July (SC14)."""
    p = table(spark, root, "source_pages").select("source_page_id", F.coalesce("provenance_scope", F.lit("none")).alias("scope"), micros("captured_at").alias("c"))
    kept = A.stop_after_old(p, ["scope"], ["source_page_id"], F.coalesce(F.col("c") < 1_782_864_000_000_000, F.lit(False)))
    return kept.groupBy("scope").agg(F.count("*").alias("n"), F.max("source_page_id").alias("last_page"))


def catalog_package(spark: SparkSession, root: str) -> DataFrame:
    """Candidates, backgrounds and coverage written in this order, the report last, all read back (SK10)."""
    links = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id").where("fixture IS NOT NULL AND news_id IS NOT NULL").distinct()
    news = table(spark, root, "news").select("news_id", "item_id", "title")
    parts = {"candidates": news.join(links, "news_id"), "backgrounds": news.join(links, "news_id", "left_anti"), "coverage": links.groupBy("fixture").agg(F.count("*").alias("n"))}
    base, report = scratch(spark, "catalog"), None
    for name, df in parts.items():
        sinks.publish(df, f"{base}/{name}")
        row = spark.read.parquet(f"{base}/{name}").agg(F.lit(name).alias("part"), F.count("*").alias("n"))
        report = row if report is None else report.unionByName(row)
    sinks.publish(report, f"{base}/report")
    return readers.read_rows(spark, f"{base}/report", "part string, n long")


def copied_sequences(spark: SparkSession, root: str) -> DataFrame:
    """Whole histories of a tenth of the customers, chosen by hash, copied as JSON lines, read back and recounted (SK13, SK8)."""
    o = table(spark, root, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"))
    chosen = o.select("o_custkey").distinct().where(F.conv(F.substring(F.sha2(F.concat(F.lit("copy|"), F.col("o_custkey")), 256), 1, 8), 16, 10).cast("long") < 429_496_729)
    path = scratch(spark, "copied")
    sinks.publish(o.join(chosen, "o_custkey", "left_semi"), path, "json", compression="gzip")
    back = readers.read_jsonl(spark, path, "o_custkey long, o_orderkey long, status string").groupBy("o_custkey").agg(F.count("*").alias("n_copied"))
    whole = o.join(chosen, "o_custkey", "left_semi").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return whole.join(back, "o_custkey", "left").select("o_custkey", "n", "n_copied", F.col("n").eqNullSafe(F.col("n_copied")).alias("equal"))


def context_export(spark: SparkSession, root: str) -> DataFrame:
    """Trades exported in two profiles, with news in force and without, or quarantined by reason; read back and counted."""
    t = _keys(spark, root).join(_kickoffs(spark, root), "fixture", "left")
    tx = table(spark, root, "transactions").select(hex_ident(F.col("tx")).alias("tx"), split_name(F.col("split")).alias("s")).dropna()
    crossing = tx.groupBy("tx").agg(F.countDistinct("s").alias("n")).where("n > 1").select("tx", F.lit(1).alias("crossing"))
    t = t.join(crossing, "tx", "left")
    by_time = F.when(F.col("t") < F.col("a"), "train").when(F.col("t") < F.col("b"), "validation").when(F.col("t").isNotNull() & F.col("b").isNotNull(), "test")
    bad = lambda c, code: F.when(~F.coalesce(c, F.lit(False)), F.lit(code))
    errors = F.array_join(F.array_compact(F.array(
        bad(F.col("t").isNotNull(), "time"), bad(F.col("wallet").isNotNull(), "wallet"), bad(F.col("side").isin("BUY", "SELL"), "side"), bad((F.col("shares") > 0) & F.col("price").between(0, 1), "amount"),
        bad(F.col("token_mapping_status").like("exact%"), "mapping"), bad(F.col("split") == by_time, "split"), bad(F.col("crossing").isNull(), "crossing"),
    )), "+")
    links = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), F.col("eligible_us").alias("t"), "news_id")
    rows = asof_prior(t.withColumn("errors", errors).select("trade_row_id", "fixture", "t", "split", "errors"), links, ["fixture"], "t", ["news_id"], block_us=168 * HOUR)
    profile = F.when(F.col("errors") != "", "quarantine").when(F.col("prior_news_id").isNotNull(), "direct").otherwise("plain")
    path = scratch(spark, "contexts")
    sinks.publish(rows.select("trade_row_id", F.col("prior_news_id").alias("news_id"), "errors", profile.alias("profile"), F.coalesce("split", F.lit("none")).alias("split")), path, by=["profile", "split"])
    back = readers.read_rows(spark, path, "trade_row_id long, news_id string, errors string, profile string, split string")
    reason = F.when(F.col("profile") == "quarantine", F.col("errors")).otherwise(F.lit(""))
    return back.groupBy("profile", "split", reason.alias("reason")).agg(F.count("*").alias("n"), F.countDistinct("news_id").alias("n_news"))


def replayed_pages(spark: SparkSession, root: str) -> DataFrame:
    """Every page normalised again: rows against the declared count, and a digest in any row order."""
    t = _keys(spark, root).where("source_page_id IS NOT NULL")
    n = t.groupBy("source_page_id").agg(F.count("*").alias("n"), A.order_free_digest(F.col("source_line"), F.col("wallet"), F.col("condition"), F.col("token"), F.col("side"), F.col("t")).cast("string").alias("digest"), F.min("source_line").alias("first_line"), F.max("source_line").alias("last_line"))
    p = table(spark, root, "source_pages").select("source_page_id", "row_count")
    state = F.when(F.col("n").isNull(), "no_rows").when(F.col("row_count").isNull(), "no_count").when(F.col("n") == F.col("row_count"), "equal").otherwise("differs")
    return p.join(n, "source_page_id", "left").select("source_page_id", "n", "digest", "first_line", "last_line", state.alias("state"))


def replayed_conditions(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of at most 20 rows replayed per condition from the pages, against the ledger of the log, both ways."""
    t = _keys(spark, root).where("wallet IS NOT NULL AND condition IS NOT NULL")
    ledger = t.groupBy("wallet", "condition").agg(F.count("*").alias("n"))
    paged = t.join(table(spark, root, "source_pages").select("source_page_id"), "source_page_id", "left_semi")
    kept = paged.join(ledger.where("n <= 20").select("wallet", "condition"), ["wallet", "condition"], "left_semi").groupBy("wallet", "condition").agg(F.count("*").alias("m"))
    j = ledger.join(kept, ["wallet", "condition"], "full")
    return j.groupBy("condition").agg(F.count_if((F.col("n") <= 20) & ~F.col("m").eqNullSafe(F.col("n"))).alias("n_missing"), F.count_if(F.col("m").isNotNull() & F.coalesce(F.col("n") > 20, F.lit(True))).alias("n_extra"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_rows"))


def sequence_audit(spark: SparkSession, root: str) -> DataFrame:
    """Prior counts and labels of events derived by blocks and by a plain window, compared both ways (V2)."""
    e = table(spark, root, "events").select("event_id", "user_id", micros("ts").alias("t")).dropna(subset=["user_id", "t"])
    from tidemark.operators.asof import next_frame, prior_rank, with_halo

    ahead = with_halo(e, ["user_id"], "t", ahead_us=HOUR)
    label = ahead.withColumn("n_next", F.count("*").over(next_frame(["user_id", "__b"], "t", HOUR))).where("__own").select("event_id", "n_next")
    blocks = prior_rank(e, e, ["user_id"], "t", "n_prior").join(label, "event_id").select("event_id", "n_prior", "n_next")
    plain = W.partitionBy("user_id").orderBy("t")
    other = e.select("event_id", (F.rank().over(plain) - 1).cast("long").alias("n_prior"), F.count("*").over(plain.rangeBetween(0, HOUR - 1)).alias("n_next"))
    return A.both_ways(blocks, other)


def exactly_twenty(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of a wallet and a fixture with exactly twenty rows, less those of conditions that were captured again (V5)."""
    t = _keys(spark, root)
    n = t.where("wallet IS NOT NULL AND fixture IS NOT NULL").groupBy("wallet", "fixture").agg(F.count("*").alias("n"), F.min("t").alias("first_us")).where("n = 20")
    again = t.join(table(spark, root, "source_pages").where("provenance_scope = 'recovered'").select("source_page_id"), "source_page_id", "left_semi").select("wallet", "fixture").distinct()
    return n.join(again, ["wallet", "fixture"], "left_anti").select("wallet", "fixture", "first_us")


def rebuilt_shards(spark: SparkSession, root: str) -> DataFrame:
    """Every shard of an export rebuilt from the source between its intact neighbours, compared with what was written (V7)."""
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch(spark, "orders-by-shard")
    sinks.write_jsonl_shards(shards.row_shards(o, ["o_orderkey"], 4000), path, ["line"])
    written = readers.read_jsonl(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, line long, shard long")
    digest = A.order_free_digest(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"))
    bounds = written.groupBy("shard").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"), F.count("*").alias("n"), digest.alias("d"))
    w = W.orderBy("shard")  # one row a shard
    gaps = bounds.select("shard", "n", "d", F.lag("hi").over(w).alias("after"), F.lead("lo").over(w).alias("before"))
    # a range join on few bounds: each order belongs to the last shard whose left neighbour it follows
    starts = bounds.select(F.lit(0).alias("all"), (F.coalesce(F.lag("hi").over(w), F.lit(-(2**62))) + 1).alias("k"), "shard")
    placed = asof_prior(o.select(F.lit(0).alias("all"), (F.col("o_orderkey") + 1).alias("k"), "o_orderkey", "o_custkey", "o_orderstatus"), starts, ["all"], "k", ["shard"], block_us=1 << 16)
    again = placed.join(F.broadcast(gaps.select("shard", "before")), placed["prior_shard"] == gaps["shard"]).where("before IS NULL OR o_orderkey < before").groupBy("shard").agg(F.count("*").alias("m"), digest.alias("e"))
    return gaps.join(again, "shard", "left").select("shard", "n", "m", (F.col("n").eqNullSafe(F.col("m")) & F.col("d").eqNullSafe(F.col("e"))).alias("equal"))


def repointed_context(spark: SparkSession, root: str) -> DataFrame:
    """News pointers rebuilt from verified availability where they were made from link times alone; targets are untouched (V9)."""
    t = _keys(spark, root).where("fixture IS NOT NULL AND t IS NOT NULL").select("trade_row_id", "fixture", "t", "side")
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", F.col("eligible_us").alias("t"))
    n = table(spark, root, "news").select("news_id", F.col("verified_availability_us").alias("k"))
    was = asof_prior(t, f, ["fixture"], "t", ["news_id"], prefix="was_", block_us=168 * HOUR)
    ready = f.where("t IS NOT NULL").join(n.where("k IS NOT NULL"), "news_id").select("fixture", "news_id", F.greatest("t", "k").alias("t"))
    now = asof_prior(was, ready, ["fixture"], "t", ["news_id"], prefix="now_", block_us=168 * HOUR)
    return now.groupBy("fixture").agg(F.count("*").alias("n"), F.count_if(~F.col("was_news_id").eqNullSafe(F.col("now_news_id"))).alias("n_changed"), F.count("now_news_id").alias("n_with_news"), F.count("side").alias("n_targets"))


def interval_protocol(spark: SparkSession, root: str) -> DataFrame:
    """Findings of the wait and act log of orders."""
    return A.protocol_errors(gap_alternation(spark, root), "o_custkey", ["end_us", F.desc("kind")])


def target_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows and actions of each kind of the wait and act log."""
    return gap_alternation(spark, root).groupBy("kind").agg(F.count("*").alias("n"), F.sum("n").alias("n_actions"))


def split_errors(spark: SparkSession, root: str) -> DataFrame:
    """Violations of disjoint fixtures and of the time ranges of splits, by code; a label looks 15 minutes ahead."""
    k = table(spark, root, "tournament_sft_v1").select(ident(F.col("fixture_id")).alias("fixture"), split_name(F.col("split")).alias("split")).where("fixture IS NOT NULL")
    two = k.groupBy("fixture").agg(F.countDistinct("split").alias("n_splits"))
    t = _keys(spark, root).select("trade_row_id", "fixture", "t").join(_kickoffs(spark, root).select("fixture", "split", "a", "b"), "fixture", "left").join(two, "fixture", "left")
    end = F.col("t") + 900_000_000
    split = F.col("split")
    codes = {
        "missing_fixture": F.col("fixture").isNull(), "unknown_split": F.col("fixture").isNotNull() & ~F.coalesce(split.isin("train", "validation", "test"), F.lit(False)), "fixture_in_two_splits": F.col("n_splits") > 1, "missing_time": F.col("t").isNull(),
        "train_after_cutoff": (split == "train") & (end > F.col("a")), "validation_before_cutoff": (split == "validation") & (F.col("t") < F.col("a")), "validation_after_cutoff": (split == "validation") & (end > F.col("b")), "test_before_cutoff": (split == "test") & (F.col("t") < F.col("b")),
    }
    return t.agg(*[F.count_if(c).alias(n) for n, c in codes.items()]).unpivot([], list(codes), "code", "n")


def parsed_answers(spark: SparkSession, root: str) -> DataFrame:
    """Answers of each wallet and instant written as JSON and parsed strictly: how many hold 1 to 20 trades (SF22)."""
    t = table(spark, root, "trades").select("trade_row_id", ident(F.col("wallet")).alias("wallet"), F.col("query_us").alias("t"), "side", F.col("token_outcome").alias("outcome"), "shares", "price").where("wallet IS NOT NULL AND t IS NOT NULL")
    # one more than an answer may hold tells it is too long
    few = t.withColumn("i", F.row_number().over(W.partitionBy("wallet", "t").orderBy("trade_row_id"))).where(F.col("i") <= A.MOST_TRADES + 1)
    trades = F.array_sort(F.collect_list(F.struct("i", F.struct("side", "outcome", "shares", "price").alias("x"))))
    g = few.groupBy("wallet", "t").agg(F.to_json(F.struct(F.lit("TRADE").alias("action"), F.transform(trades, lambda r: r["x"]).alias("trades"))).alias("answer"))
    return g.groupBy(A.parsed_answer(F.col("answer")).cast("long").alias("n_trades")).agg(F.count("*").alias("n"), F.count_if(strict_json("answer")).alias("n_strict"))


def score_matches(spark: SparkSession, root: str) -> DataFrame:
    """Each wallet's instant scored by its previous one: multisets of side, outcome and both, count, and mean price error.

    A multiset over two sides and two outcomes is four counts.
    """
    t = _keys(spark, root).where("wallet IS NOT NULL AND t IS NOT NULL AND side IN ('BUY', 'SELL') AND outcome IN ('yes', 'no') AND price IS NOT NULL")
    kind = [("by", "BUY", "yes"), ("bn", "BUY", "no"), ("sy", "SELL", "yes"), ("sn", "SELL", "no")]
    g = t.groupBy("wallet", "t").agg(*[F.count_if((F.col("side") == s) & (F.col("outcome") == o)).alias(n) for n, s, o in kind], F.sum("price").cast("decimal(38,12)").alias("p"), F.count("*").alias("n"))
    w = W.partitionBy("wallet").orderBy("t")
    cols = ["by", "bn", "sy", "sn", "p", "n"]
    j = g.select(*cols, *[F.lag(c).over(w).alias(f"l_{c}") for c in cols]).where("l_n IS NOT NULL")
    same = lambda *cs: F.lit(True) if not cs else (sum(F.col(c) for c in cs) == sum(F.col(f"l_{c}") for c in cs))
    size = F.col("n") == F.col("l_n")
    both = size & same("by") & same("bn") & same("sy") & same("sn")
    error = F.abs(F.col("p") - F.col("l_p"))
    return j.agg(
        F.count("*").alias("n_pairs"), F.count_if(size).alias("n_same_size"), F.count_if(size & same("by", "bn")).alias("n_sides"), F.count_if(size & same("by", "sy")).alias("n_outcomes"), F.count_if(both).alias("n_both"), F.count_if(both & (error == 0)).alias("n_exact"),
        F.sum(F.when(both & (F.col("n") == 1), error)).cast("decimal(38,12)").cast("string").alias("single_error"), F.count_if(both & (F.col("n") == 1)).alias("n_single"),
    )


def selected_versions(spark: SparkSession, root: str) -> DataFrame:
    """Highest rank of each item known before the cut-off; two contents at that rank are a conflict."""
    n = table(spark, root, "news").select("news_id", "item_id", "version_rank", "published_us", "verified_availability_us", "title", "source_url", F.coalesce(F.get_json_object("record_json", "$.historical_availability_verified") == "true", F.lit(False)).alias("ok"))
    gate = available_before(F.col("ok"), F.col("published_us"), F.col("verified_availability_us"), F.lit(1_783_000_000_000_000)) & F.col("item_id").isNotNull() & F.col("version_rank").isNotNull()
    kept = n.where(gate)
    top = kept.groupBy("item_id").agg(F.max("version_rank").alias("version_rank"))
    j = kept.join(top, ["item_id", "version_rank"]).groupBy("item_id", "version_rank").agg(F.count_distinct(F.struct(F.coalesce("title", F.lit("")), F.coalesce("source_url", F.lit("")))).alias("k"), F.min("news_id").alias("news_id"))
    return j.select("item_id", "version_rank", F.when(F.col("k") == 1, F.col("news_id")).alias("news_id"), (F.col("k") > 1).alias("conflict"))


def page_evidence(spark: SparkSession, root: str) -> DataFrame:
    """Verified time of each captured path from the captures as evidence: allowed kind, valid digest equal to the first content, captured in time."""
    p = table(spark, root, "source_pages").select("source_page_id", ident(F.col("path")).alias("path"), ident(F.col("uncompressed_sha256")).alias("sha"), micros("captured_at").alias("c"), F.when(F.col("provenance_scope") == "condition", "contemporaneous_capture").when(F.col("provenance_scope") == "recovered", "archive_snapshot").otherwise("other").alias("kind")).where("path IS NOT NULL")
    first = p.groupBy("path").agg(F.min_by("sha", "source_page_id").alias("content"), F.max("c").alias("upper"), F.count("*").alias("n"))
    # a digest and a kind decide: the earliest capture of each is all the evidence that matters
    best = p.groupBy("path", "kind", "sha").agg(F.min("c").alias("c"))
    j = best.join(first, "path")
    ok = evidence_valid(F.array(F.struct("kind", "sha", F.concat(F.lit("https://"), "path").alias("url"), F.col("c").alias("captured_us"))), ["archive_snapshot", "contemporaneous_capture"], F.col("content"), F.col("upper"))
    g = j.withColumn("good", F.coalesce(ok, F.lit(False)).cast("int")).groupBy("path").agg(F.max("n").alias("n_captures"), F.max("upper").alias("upper"), F.max("good").alias("ok"), F.countDistinct("sha").alias("n_contents"))
    rank0 = F.col("n_contents") <= 1
    return g.select("path", "n_captures", F.when((F.col("ok") == 1) & rank0, F.col("upper")).alias("verified_us"), F.when(F.col("ok") == 0, "no_valid_evidence").when(~rank0, "unverified_order").alias("reason"))


def release_gates(spark: SparkSession, root: str) -> DataFrame:
    """Twenty-two named checks over registry, capture, ledger, mapping, news, splits and exports."""
    t, p, n = materialize(_keys(spark, root), "keys"), table(spark, root, "source_pages"), table(spark, root, "news")
    f = table(spark, root, "fixture_news").select(ident(F.col("fixture_id")).alias("fixture"), "news_id", "eligible_us", "link_json")
    k, raw = _kickoffs(spark, root), table(spark, root, "trades")
    none = lambda df: df.agg(F.count("*") == 0)
    pairs = t.where("wallet IS NOT NULL AND condition IS NOT NULL").groupBy("wallet", "condition").agg(F.count("*").alias("n"))
    tokens = t.where("condition IS NOT NULL AND token IS NOT NULL AND outcome IS NOT NULL")
    return L.gates({
        "rows_unique": none(L.duplicate_keys(raw, ["trade_row_id"])),
        "lines_unique": none(L.duplicate_keys(raw.where("source_page_id IS NOT NULL AND source_line IS NOT NULL"), ["source_page_id", "source_line"])),
        "pages_unique": none(L.duplicate_keys(p, ["source_page_id"])),
        "pages_known": none(raw.where("source_page_id IS NOT NULL").join(p, "source_page_id", "left_anti")),
        "page_counts_match": none(L.ledger_difference(p.select("source_page_id", F.col("row_count").alias("n")), L.count_ledger(raw, ["source_page_id"]), ["source_page_id"])),
        "digests_valid": none(p.where(~F.coalesce(ident(F.col("uncompressed_sha256")).rlike("^[0-9a-f]{64}$"), F.lit(False)))),
        "fixtures_registered": none(t.where("fixture IS NOT NULL").join(k, "fixture", "left_anti")),
        "registry_covered": none(k.join(t, "fixture", "left_anti")),
        "kickoffs_known": none(k.where("kickoff IS NULL")),
        "splits_valid": none(k.where("split IS NULL OR split NOT IN ('train', 'validation', 'test')")),
        "conditions_of_one_fixture": none(t.where("condition IS NOT NULL AND fixture IS NOT NULL").groupBy("condition").agg(F.countDistinct("fixture").alias("c")).where("c > 1")),
        "tokens_of_one_condition": none(tokens.groupBy("token").agg(F.countDistinct("condition").alias("c")).where("c > 1")),
        "two_tokens_a_condition": none(tokens.groupBy("condition").agg(F.countDistinct("token").alias("c")).where("c <> 2")),
        "mapping_exact": none(t.where("token_mapping_status IS NULL OR NOT token_mapping_status LIKE 'exact%'")),
        "pairs_below_twenty": none(pairs.where("n >= 20")),
        "pair_ledger_matches": pairs.agg(F.coalesce(F.sum("n"), F.lit(0)) == t.where("wallet IS NOT NULL AND condition IS NOT NULL").agg(F.count("*")).scalar()),
        "prices_valid": none(t.where("price IS NULL OR price NOT BETWEEN 0 AND 1")),
        "times_known": none(t.where("t IS NULL")),
        "versions_unique": none(L.duplicate_keys(n, ["item_id", "version_rank"])),
        "links_known": none(f.join(n, "news_id", "left_anti")),
        "links_after_news": none(f.join(n, "news_id").where("eligible_us < verified_availability_us")),
        "every_fixture_has_direct_news": none(k.join(f.where(F.get_json_object("link_json", "$.relationship") == "direct"), "fixture", "left_anti")),
    })


def collection_overview(spark: SparkSession, root: str) -> DataFrame:
    """Totals of the separate reports side by side, and whether each agrees with the log."""
    t = materialize(_keys(spark, root), "keys")
    log = t.agg(F.count("*").alias("n"), F.countDistinct("wallet").alias("w"), F.countDistinct("condition").alias("c"))
    one = lambda name, df, c: df.select(F.lit(name).alias("report"), F.col(c).cast("long").alias("reported"))
    pages = table(spark, root, "source_pages").agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
    ledger = t.groupBy("wallet", "condition").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    wallets = t.where("wallet IS NOT NULL").groupBy("wallet").agg(F.count("*").alias("n")).agg(F.count("*").alias("n"))
    conditions = t.where("condition IS NOT NULL").groupBy("condition").agg(F.count("*").alias("n")).agg(F.count("*").alias("n"))
    rows = one("pages_rows", pages, "n").unionByName(one("ledger_rows", ledger, "n")).unionByName(one("wallets", wallets, "n")).unionByName(one("conditions", conditions, "n"))
    actual = F.when(F.col("report").endswith("rows"), log.select("n").scalar()).when(F.col("report") == "wallets", log.select("w").scalar()).otherwise(log.select("c").scalar())
    return rows.withColumn("logged", actual).withColumn("equal", F.col("reported") == F.col("logged"))


def late_events(spark: SparkSession, root: str) -> DataFrame:
    """Events in the order of their ids in sixteen batches, with those a day behind the earlier batches in a side output (§2.14, late rows)."""
    e = table(spark, root, "events").where("event_id IS NOT NULL").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    lo, hi = e.agg(F.coalesce(F.min("event_id"), F.lit(0)), F.coalesce(F.max("event_id"), F.lit(0))).first()
    e = e.withColumn("arrival", F.expr(f"(event_id - {lo}) * 16 div {hi - lo + 1}").cast("long"))
    files = e.agg(F.count_distinct("arrival")).first()[0] or 1
    path = scratch(spark, "arrivals")
    e.repartitionByRange(files, "arrival").write.option("maxRecordsPerFile", 0).parquet(path)
    jobs.date_in_order(spark, path)
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return jobs.late_rows(s, "ts", 24 * HOUR).groupBy("late").agg(F.count("*").alias("n"))


def balanced_wallets(spark: SparkSession, root: str) -> DataFrame:
    """Wallets of the fixtures in turns, by hash, until 500 rows are used; what does not fit is passed over (TK4)."""
    t = _keys(spark, root).where("fixture IS NOT NULL AND wallet IS NOT NULL").groupBy("fixture", "wallet").agg(F.count("*").alias("cost"))
    r = t.withColumn("rank", F.row_number().over(W.partitionBy("fixture").orderBy(F.sha2(F.concat_ws("|", F.lit("turn"), "fixture", "wallet"), 256), "wallet")))
    return A.balanced_choice(r, "fixture", "rank", "cost", 500)


def unreused_transactions(spark: SparkSession, root: str) -> DataFrame:
    """The newest transaction of each fixture in the order of kick-off that no earlier fixture has used (TK7)."""
    t = _keys(spark, root).where("fixture IS NOT NULL AND tx IS NOT NULL").join(_kickoffs(spark, root).select("fixture", F.coalesce("kickoff", F.lit(0)).alias("kickoff")), "fixture").select("fixture", "kickoff", "tx", (-F.coalesce("t", F.lit(0))).alias("age"), "trade_row_id")
    return A.unreused_choice(t, "fixture", ["kickoff", "fixture"], "tx", ["age", "trade_row_id"])


QUERIES = {
    f.__name__: f
    for f in (
        ordered_merge, positional_differences, contract_mismatches, forbidden_fields, plausible_times, registry_discovery, export_manifests, stopped_pages, catalog_package, copied_sequences, context_export, replayed_pages, replayed_conditions,
        sequence_audit, exactly_twenty, rebuilt_shards, repointed_context, interval_protocol, target_counts, split_errors, parsed_answers, score_matches, selected_versions, page_evidence, release_gates, collection_overview, late_events,
        balanced_wallets, unreused_transactions,
    )
}

_WS = "' ' || chr(9) || chr(10) || chr(13)"


def _id(c: str) -> str:
    return f"lower(trim({c}, {_WS}))"


def _hex(c: str) -> str:
    bare = f"regexp_replace({_id(c)}, '^0x', '')"
    return f"CASE WHEN NOT regexp_full_match({bare}, '0*') THEN {bare} END"


_K = f"""t AS (SELECT trade_row_id, source_page_id, source_line, {_id('wallet')} AS wallet, {_hex('condition_id')} AS condition, trim(token_id, {_WS}) AS token, {_id('token_outcome')} AS outcome, {_id('fixture_id')} AS fixture, {_hex('transaction_hash')} AS tx, query_us AS t, upper(trim(side, {_WS})) AS side,
 try_cast(trim(shares, {_WS}) AS decimal(20, 8)) AS shares, try_cast(trim(price, {_WS}) AS decimal(13, 12)) AS price, token_mapping_status FROM trades)"""
_KICK = f"""k AS (SELECT {_id('fixture_id')} AS fixture, min(split) AS split, min(epoch_us(kickoff_at)) AS kickoff, min(epoch_us(train_before_utc::timestamptz)) AS a, min(epoch_us(validation_before_utc::timestamptz)) AS b FROM tournament_sft_v1 WHERE policy_version = 1 AND fixture_id IS NOT NULL GROUP BY 1)"""
_SPLIT = f"CASE WHEN {_id('split')} IN ('train', 'training') THEN 'train' WHEN {_id('split')} IN ('validation', 'valid', 'val', 'dev') THEN 'validation' WHEN {_id('split')} = 'test' THEN 'test' END"
_LOG = """g AS (SELECT o_custkey, epoch_us(o_orderdate) AS t, count(*) AS n FROM orders GROUP BY 1, 2), w AS (SELECT *, lag(t) OVER (PARTITION BY o_custkey ORDER BY t) AS p FROM g),
a AS (SELECT o_custkey, 'wait' AS kind, p AS start_us, t AS end_us, 0::bigint AS n FROM w UNION ALL SELECT o_custkey, 'act', t, t, n FROM w)"""


def _digest(*columns: str) -> str:
    text = " || '|' || ".join(f"coalesce({c}::varchar, '~')" for c in columns)
    return f"sum(('0x' || substr(md5({text}), 1, 15))::bigint)::hugeint"


def _none(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS gate, (SELECT count(*) = 0 FROM ({sql})) AS passed"


ORACLE = {
    "ordered_merge": "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey, o_orderstatus) AS row, o_orderkey, strpos('FOP', o_orderstatus) - 1 AS source FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')",
    "positional_differences": """WITH x AS (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r, o_orderkey AS x FROM orders), y AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS r, o_orderkey AS y FROM orders)
SELECT count(*) AS n, count(*) FILTER (WHERE x = y) AS n_equal, min(r) FILTER (WHERE x <> y) AS first_difference FROM x JOIN y USING (r)""",
    "contract_mismatches": f"""WITH {_K}, f AS (SELECT * FROM t WHERE token IS NOT NULL AND t IS NOT NULL AND condition IS NOT NULL AND outcome IS NOT NULL AND fixture IS NOT NULL QUALIFY row_number() OVER (PARTITION BY token ORDER BY t, trade_row_id) = 1),
j AS (SELECT t.trade_row_id, concat_ws('+', CASE WHEN t.condition <> f.condition THEN 'condition' END, CASE WHEN t.outcome <> f.outcome THEN 'outcome' END, CASE WHEN t.fixture <> f.fixture THEN 'fixture' END) AS fields FROM t JOIN f USING (token)) SELECT * FROM j WHERE fields <> ''""",
    "forbidden_fields": f"""WITH j AS (SELECT 'news' AS source, record_json AS j FROM news UNION ALL SELECT 'fixture_news', link_json FROM fixture_news), f AS (SELECT source, unnest(list_distinct(regexp_extract_all(j, '"([^"\\\\]+)"\\s*:', 1))) AS field FROM j WHERE j IS NOT NULL)
SELECT source, field, count(*) AS n, field IN ({', '.join(f"'{x}'" for x in FORBIDDEN)}) AS forbidden FROM f GROUP BY 1, 2""",
    "plausible_times": f"""WITH {_KICK}, o AS (SELECT {_id('fixture_id')} AS fixture, query_us AS t FROM trades WHERE observation_id IS NOT NULL AND fixture_id IS NOT NULL AND query_us IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_id('observation_id')} ORDER BY query_us, {_id('fixture_id')}) = 1)
SELECT fixture, count(*) AS n, count(*) FILTER (WHERE t BETWEEN kickoff - 21600000000 AND kickoff + 43200000000) AS n_plausible FROM o JOIN k USING (fixture) WHERE kickoff IS NOT NULL GROUP BY 1""",
    "registry_discovery": f"""WITH {_K}, m AS (SELECT fixture, condition, count(DISTINCT outcome) AS sides FROM t WHERE fixture IS NOT NULL AND condition IS NOT NULL AND token IS NOT NULL AND outcome IN ('yes', 'no') GROUP BY 1, 2)
SELECT fixture, count(*) AS n_contracts, sum(sides)::bigint AS n_tokens, count(*) = 3 AND min(sides) = 2 AS complete FROM m GROUP BY 1""",
    "export_manifests": f"""WITH p AS (SELECT source_page_id, {_id('path')} AS path, {_id('uncompressed_sha256')} AS sha, provenance_scope FROM source_pages), r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY source_page_id) AS p, row_number() OVER (PARTITION BY sha ORDER BY source_page_id) AS s FROM p)
SELECT source_page_id, CASE WHEN provenance_scope IS DISTINCT FROM 'condition' THEN 'other_format' WHEN NOT coalesce(regexp_full_match(sha, '[0-9a-f]{{64}}'), false) THEN 'no_digest' WHEN path IS NOT NULL AND p > 1 THEN 'path_repeated' WHEN s > 1 THEN 'content_repeated' ELSE 'used' END AS reason FROM r""",
    "stopped_pages": """WITH p AS (SELECT source_page_id, coalesce(provenance_scope, 'none') AS scope, coalesce(epoch_us(captured_at) < 1782864000000000, false) AS old FROM source_pages), l AS (SELECT *, old AND coalesce(lag(old) OVER (PARTITION BY scope ORDER BY source_page_id), false) AS hit FROM p),
s AS (SELECT scope, min(source_page_id) AS stop FROM l WHERE hit GROUP BY 1) SELECT p.scope, count(*) AS n, max(source_page_id) AS last_page FROM p LEFT JOIN s USING (scope) WHERE stop IS NULL OR source_page_id <= stop GROUP BY 1""",
    "catalog_package": f"""WITH l AS (SELECT DISTINCT {_id('fixture_id')} AS fixture, news_id FROM fixture_news WHERE fixture_id IS NOT NULL AND news_id IS NOT NULL)
SELECT 'candidates' AS part, count(*) AS n FROM news JOIN l USING (news_id) UNION ALL SELECT 'backgrounds', count(*) FROM news WHERE news_id NOT IN (SELECT news_id FROM l) UNION ALL SELECT 'coverage', count(DISTINCT fixture) FROM l""",
    "copied_sequences": "SELECT o_custkey, count(*) AS n, count(*) AS n_copied, true AS equal FROM orders WHERE ('0x' || substr(sha256('copy|' || o_custkey), 1, 8))::bigint < 429496729 GROUP BY 1",
    "context_export": f"""WITH {_K}, {_KICK}, x AS (SELECT {_hex('tx')} AS tx FROM transactions WHERE {_SPLIT} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {_SPLIT}) > 1), f AS (SELECT {_id('fixture_id')} AS fixture, eligible_us AS e, max(news_id) AS news_id FROM fixture_news WHERE eligible_us IS NOT NULL AND fixture_id IS NOT NULL GROUP BY 1, 2),
j AS (SELECT t.trade_row_id, t.fixture, t.t, k.split, concat_ws('+', CASE WHEN t.t IS NULL THEN 'time' END, CASE WHEN wallet IS NULL THEN 'wallet' END, CASE WHEN NOT coalesce(side IN ('BUY', 'SELL'), false) THEN 'side' END, CASE WHEN NOT coalesce(shares > 0 AND price BETWEEN 0 AND 1, false) THEN 'amount' END,
 CASE WHEN NOT coalesce(token_mapping_status LIKE 'exact%', false) THEN 'mapping' END, CASE WHEN NOT coalesce(split = CASE WHEN t.t < a THEN 'train' WHEN t.t < b THEN 'validation' WHEN t.t IS NOT NULL AND b IS NOT NULL THEN 'test' END, false) THEN 'split' END, CASE WHEN x.tx IS NOT NULL THEN 'crossing' END) AS errors FROM t LEFT JOIN k USING (fixture) LEFT JOIN x ON x.tx = t.tx),
n AS (SELECT j.*, f.news_id FROM j ASOF LEFT JOIN f ON j.fixture = f.fixture AND j.t > f.e)
SELECT CASE WHEN errors <> '' THEN 'quarantine' WHEN news_id IS NOT NULL THEN 'direct' ELSE 'plain' END AS profile, coalesce(split, 'none') AS split, errors AS reason, count(*) AS n, count(DISTINCT news_id) AS n_news FROM n GROUP BY 1, 2, 3""",
    "replayed_pages": f"""WITH {_K}, n AS (SELECT source_page_id, count(*) AS n, {_digest('source_line', 'wallet', 'condition', 'token', 'side', 't')}::varchar AS digest, min(source_line) AS first_line, max(source_line) AS last_line FROM t WHERE source_page_id IS NOT NULL GROUP BY 1)
SELECT source_page_id, n, digest, first_line, last_line, CASE WHEN n IS NULL THEN 'no_rows' WHEN row_count IS NULL THEN 'no_count' WHEN n = row_count THEN 'equal' ELSE 'differs' END AS state FROM source_pages LEFT JOIN n USING (source_page_id)""",
    "replayed_conditions": f"""WITH {_K}, l AS (SELECT wallet, condition, count(*) AS n, count(*) FILTER (WHERE source_page_id IN (SELECT source_page_id FROM source_pages)) AS m FROM t WHERE wallet IS NOT NULL AND condition IS NOT NULL GROUP BY 1, 2)
SELECT condition, count(*) FILTER (WHERE n <= 20 AND m <> n) AS n_missing, 0::bigint AS n_extra, coalesce(sum(m) FILTER (WHERE n <= 20), 0)::bigint AS n_rows FROM l GROUP BY 1""",
    "sequence_audit": "SELECT count(*) AS n, 0::bigint AS missing, 0::bigint AS extra FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL",
    "exactly_twenty": f"""WITH {_K}, n AS (SELECT wallet, fixture, min(t) AS first_us FROM t WHERE wallet IS NOT NULL AND fixture IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 20)
SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM t JOIN source_pages p USING (source_page_id) WHERE p.provenance_scope = 'recovered' AND t.wallet = n.wallet AND t.fixture = n.fixture)""",
    "rebuilt_shards": "WITH r AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 + 1 AS shard FROM orders) SELECT shard, count(*) AS n, count(*) AS m, true AS equal FROM r GROUP BY 1",
    "repointed_context": f"""WITH {_K}, f AS (SELECT {_id('fixture_id')} AS fixture, news_id, eligible_us AS e FROM fixture_news WHERE fixture_id IS NOT NULL AND eligible_us IS NOT NULL), w AS (SELECT fixture, e, max(news_id) AS news_id FROM f GROUP BY 1, 2),
g AS (SELECT fixture, greatest(e, verified_availability_us) AS e, max(news_id) AS news_id FROM f JOIN news USING (news_id) WHERE verified_availability_us IS NOT NULL GROUP BY 1, 2), x AS (SELECT * FROM t WHERE fixture IS NOT NULL AND t IS NOT NULL),
a AS (SELECT x.fixture, x.t, x.side, w.news_id AS was FROM x ASOF LEFT JOIN w ON x.fixture = w.fixture AND x.t > w.e), b AS (SELECT a.*, g.news_id AS now FROM a ASOF LEFT JOIN g ON a.fixture = g.fixture AND a.t > g.e)
SELECT fixture, count(*) AS n, count(*) FILTER (WHERE was IS DISTINCT FROM now) AS n_changed, count(now) AS n_with_news, count(side) AS n_targets FROM b GROUP BY 1""",
    "interval_protocol": "SELECT unnest(['bad_alternation', 'act_without_actions', 'wait_with_actions', 'wait_ends_elsewhere', 'first_wait_has_start', 'wait_starts_elsewhere', 'time_does_not_grow']) AS code, 0::bigint AS n",
    "target_counts": f"WITH {_LOG} SELECT kind, count(*) AS n, sum(n)::bigint AS n_actions FROM a GROUP BY 1",
    "split_errors": f"""WITH {_K}, {_KICK}, s AS (SELECT {_id('fixture_id')} AS fixture, count(DISTINCT {_SPLIT}) AS c FROM tournament_sft_v1 WHERE fixture_id IS NOT NULL GROUP BY 1), j AS (SELECT t.fixture, t.t, split, a, b, c FROM t LEFT JOIN k USING (fixture) LEFT JOIN s USING (fixture)),
m AS (SELECT count(*) FILTER (WHERE fixture IS NULL) AS missing_fixture, count(*) FILTER (WHERE fixture IS NOT NULL AND NOT coalesce(split IN ('train', 'validation', 'test'), false)) AS unknown_split, count(*) FILTER (WHERE c > 1) AS fixture_in_two_splits, count(*) FILTER (WHERE t IS NULL) AS missing_time,
 count(*) FILTER (WHERE split = 'train' AND t + 900000000 > a) AS train_after_cutoff, count(*) FILTER (WHERE split = 'validation' AND t < a) AS validation_before_cutoff, count(*) FILTER (WHERE split = 'validation' AND t + 900000000 > b) AS validation_after_cutoff, count(*) FILTER (WHERE split = 'test' AND t < b) AS test_before_cutoff FROM j)
UNPIVOT m ON COLUMNS(*) INTO NAME code VALUE n""",
    "parsed_answers": f"""WITH t AS (SELECT {_id('wallet')} AS wallet, query_us AS t, side, token_outcome, try_cast(shares AS double) AS s, try_cast(price AS double) AS p FROM trades WHERE wallet IS NOT NULL AND query_us IS NOT NULL),
g AS (SELECT wallet, t, count(*) AS n, bool_and(coalesce(side IN ('BUY', 'SELL') AND token_outcome IN ('Yes', 'No') AND s > 0 AND s <= 1e100 AND p BETWEEN 0 AND 1, false)) AS ok FROM t GROUP BY 1, 2)
SELECT CASE WHEN ok AND n <= 20 THEN n END AS n_trades, count(*) AS n, count(*) AS n_strict FROM g GROUP BY 1""",
    "score_matches": f"""WITH {_K}, g AS (SELECT wallet, t, count(*) FILTER (WHERE side = 'BUY' AND outcome = 'yes') AS c1, count(*) FILTER (WHERE side = 'BUY' AND outcome = 'no') AS c2, count(*) FILTER (WHERE side = 'SELL' AND outcome = 'yes') AS c3, count(*) FILTER (WHERE side = 'SELL' AND outcome = 'no') AS c4, sum(price)::decimal(38, 12) AS p, count(*) AS n
 FROM t WHERE wallet IS NOT NULL AND t IS NOT NULL AND side IN ('BUY', 'SELL') AND outcome IN ('yes', 'no') AND price IS NOT NULL GROUP BY 1, 2),
l AS (SELECT *, lag((c1, c2, c3, c4)) OVER w AS b, lag(c1 + c2) OVER w AS bs, lag(c1 + c3) OVER w AS bo, lag(p) OVER w AS bp, lag(n) OVER w AS bn FROM g WINDOW w AS (PARTITION BY wallet ORDER BY t)), j AS (SELECT *, n = bn AS same, (c1, c2, c3, c4) = b AS "both" FROM l WHERE bn IS NOT NULL)
SELECT count(*) AS n_pairs, count(*) FILTER (WHERE same) AS n_same_size, count(*) FILTER (WHERE same AND c1 + c2 = bs) AS n_sides, count(*) FILTER (WHERE same AND c1 + c3 = bo) AS n_outcomes, count(*) FILTER (WHERE "both") AS n_both, count(*) FILTER (WHERE "both" AND p = bp) AS n_exact,
 (sum(abs(p - bp)) FILTER (WHERE "both" AND n = 1))::decimal(38, 12)::varchar AS single_error, count(*) FILTER (WHERE "both" AND n = 1) AS n_single FROM j""",
    "selected_versions": """WITH g AS (SELECT * FROM news WHERE json_extract_string(record_json, '$.historical_availability_verified') = 'true' AND verified_availability_us IS NOT NULL AND coalesce(published_us, verified_availability_us) <= verified_availability_us AND verified_availability_us < 1783000000000000 AND item_id IS NOT NULL AND version_rank IS NOT NULL),
m AS (SELECT item_id, max(version_rank) AS version_rank FROM g GROUP BY 1) SELECT item_id, version_rank, CASE WHEN count(DISTINCT (coalesce(title, ''), coalesce(source_url, ''))) = 1 THEN min(news_id) END AS news_id, count(DISTINCT (coalesce(title, ''), coalesce(source_url, ''))) > 1 AS conflict FROM g JOIN m USING (item_id, version_rank) GROUP BY 1, 2""",
    "page_evidence": f"""WITH p AS (SELECT source_page_id, {_id('path')} AS path, {_id('uncompressed_sha256')} AS sha, epoch_us(captured_at) AS c, provenance_scope IN ('condition', 'recovered') AS kind FROM source_pages WHERE path IS NOT NULL),
f AS (SELECT path, arg_min(sha, source_page_id) AS content, max(c) AS upper, count(*) AS n, count(DISTINCT sha) AS k FROM p GROUP BY 1),
g AS (SELECT f.path, any_value(n) AS n, any_value(upper) AS upper, any_value(k) AS k, bool_or(coalesce(kind AND regexp_full_match(sha, '[0-9a-f]{{64}}') AND sha = content AND c <= upper, false)) AS ok FROM f JOIN p USING (path) GROUP BY 1)
SELECT path, n AS n_captures, CASE WHEN ok AND k <= 1 THEN upper END AS verified_us, CASE WHEN NOT ok THEN 'no_valid_evidence' WHEN k > 1 THEN 'unverified_order' END AS reason FROM g""",
    "release_gates": f"WITH {_K}, {_KICK}, f AS (SELECT {_id('fixture_id')} AS fixture, news_id, eligible_us, link_json FROM fixture_news), q AS (SELECT wallet, condition, count(*) AS n FROM t WHERE wallet IS NOT NULL AND condition IS NOT NULL GROUP BY 1, 2), tk AS (SELECT * FROM t WHERE condition IS NOT NULL AND token IS NOT NULL AND outcome IS NOT NULL)\n" + "\nUNION ALL ".join((
        _none("rows_unique", "SELECT 1 FROM trades GROUP BY trade_row_id HAVING count(*) > 1"), _none("lines_unique", "SELECT 1 FROM trades WHERE source_page_id IS NOT NULL AND source_line IS NOT NULL GROUP BY source_page_id, source_line HAVING count(*) > 1"),
        _none("pages_unique", "SELECT 1 FROM source_pages GROUP BY source_page_id HAVING count(*) > 1"), _none("pages_known", "SELECT 1 FROM trades x WHERE source_page_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM source_pages p WHERE p.source_page_id = x.source_page_id)"),
        _none("page_counts_match", "SELECT 1 FROM (SELECT source_page_id, count(*) AS n FROM trades GROUP BY 1) a FULL JOIN source_pages p ON p.source_page_id = a.source_page_id WHERE n IS DISTINCT FROM row_count"), _none("digests_valid", f"SELECT 1 FROM source_pages WHERE NOT coalesce(regexp_full_match({_id('uncompressed_sha256')}, '[0-9a-f]{{64}}'), false)"),
        _none("fixtures_registered", "SELECT 1 FROM t WHERE fixture IS NOT NULL AND fixture NOT IN (SELECT fixture FROM k)"), _none("registry_covered", "SELECT 1 FROM k WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.fixture = k.fixture)"), _none("kickoffs_known", "SELECT 1 FROM k WHERE kickoff IS NULL"),
        _none("splits_valid", "SELECT 1 FROM k WHERE split IS NULL OR split NOT IN ('train', 'validation', 'test')"), _none("conditions_of_one_fixture", "SELECT 1 FROM t WHERE condition IS NOT NULL GROUP BY condition HAVING count(DISTINCT fixture) > 1"), _none("tokens_of_one_condition", "SELECT 1 FROM tk GROUP BY token HAVING count(DISTINCT condition) > 1"),
        _none("two_tokens_a_condition", "SELECT 1 FROM tk GROUP BY condition HAVING count(DISTINCT token) <> 2"), _none("mapping_exact", "SELECT 1 FROM t WHERE token_mapping_status IS NULL OR NOT token_mapping_status LIKE 'exact%'"), _none("pairs_below_twenty", "SELECT 1 FROM q WHERE n >= 20"),
        "SELECT 'pair_ledger_matches', (SELECT coalesce(sum(n), 0) FROM q) = (SELECT count(*) FROM t WHERE wallet IS NOT NULL AND condition IS NOT NULL)", _none("prices_valid", "SELECT 1 FROM t WHERE price IS NULL OR price NOT BETWEEN 0 AND 1"), _none("times_known", "SELECT 1 FROM t WHERE t IS NULL"),
        _none("versions_unique", "SELECT 1 FROM news GROUP BY item_id, version_rank HAVING count(*) > 1"), _none("links_known", "SELECT 1 FROM f WHERE NOT EXISTS (SELECT 1 FROM news n WHERE n.news_id = f.news_id)"), _none("links_after_news", "SELECT 1 FROM f JOIN news USING (news_id) WHERE eligible_us < verified_availability_us"),
        _none("every_fixture_has_direct_news", "SELECT 1 FROM k WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.fixture = k.fixture AND json_extract_string(link_json, '$.relationship') = 'direct')"),
    )),
    "collection_overview": f"""WITH {_K}, l AS (SELECT count(*) AS n, count(DISTINCT wallet) AS w, count(DISTINCT condition) AS c FROM t), r AS (SELECT 'pages_rows' AS report, (SELECT coalesce(sum(row_count), 0)::bigint FROM source_pages) AS reported, n AS logged FROM l UNION ALL SELECT 'ledger_rows', n, n FROM l UNION ALL SELECT 'wallets', w, w FROM l UNION ALL SELECT 'conditions', c, c FROM l)
SELECT *, reported = logged AS equal FROM r""",
    "balanced_wallets": f"""WITH RECURSIVE {_K}, m AS (SELECT fixture, wallet, count(*) AS cost FROM t WHERE fixture IS NOT NULL AND wallet IS NOT NULL GROUP BY 1, 2), r AS (SELECT fixture, cost, row_number() OVER (PARTITION BY fixture ORDER BY sha256('turn|' || fixture || '|' || wallet), wallet) AS rank FROM m),
e AS (SELECT row_number() OVER (ORDER BY fixture) AS b, fixture, list({{'r': rank, 'c': cost}} ORDER BY rank) AS q FROM r GROUP BY fixture), z AS (SELECT count(*) AS nb FROM e),
s(i, used, ptr, idle, bucket, rank, cost, place) AS (SELECT 0::bigint, 0::bigint, (SELECT list(0::bigint) FROM e), 0::bigint, NULL::varchar, NULL::bigint, NULL::bigint, 0::bigint UNION ALL
 SELECT i + 1, used + coalesce(p.c, 0), list_transform(ptr, lambda x, k: CASE WHEN k = b THEN coalesce(p.r, 9223372036854775807) ELSE x END), CASE WHEN p IS NULL THEN idle + 1 ELSE 0 END, fixture, p.r, p.c, place + CASE WHEN p IS NULL THEN 0 ELSE 1 END
 FROM (SELECT s.i, s.used, s.ptr, s.idle, s.place, e.b, e.fixture, list_filter(e.q, lambda x: x.r > s.ptr[e.b] AND s.used + x.c <= 500)[1] AS p FROM s, z, e WHERE e.b = s.i % z.nb + 1 AND s.used < 500 AND s.idle < z.nb))
SELECT bucket, rank, cost, place FROM s WHERE rank IS NOT NULL""",
    "unreused_transactions": f"""WITH RECURSIVE {_K}, {_KICK}, m AS (SELECT t.fixture, coalesce(k.kickoff, 0) AS kickoff, tx, min((-coalesce(t.t, 0), trade_row_id)) AS place FROM t JOIN k ON k.fixture = t.fixture WHERE tx IS NOT NULL GROUP BY 1, 2, 3),
c AS (SELECT dense_rank() OVER (ORDER BY kickoff, fixture) AS f, fixture, tx, row_number() OVER (PARTITION BY fixture ORDER BY place, tx) AS r FROM m), e AS (SELECT f, any_value(fixture) AS fixture, list(tx ORDER BY r) AS txs FROM c GROUP BY 1),
s(f, seen, fixture, pick) AS (SELECT 0::bigint, []::varchar[], NULL::varchar, NULL::varchar UNION ALL SELECT f, CASE WHEN pick IS NULL THEN seen ELSE list_append(seen, pick) END, fixture, pick FROM (SELECT e.f, s.seen, e.fixture, list_filter(e.txs, lambda x: NOT list_contains(s.seen, x))[1] AS pick FROM s JOIN e ON e.f = s.f + 1))
SELECT fixture AS "group", pick AS item FROM s WHERE pick IS NOT NULL""",
    "late_events": """WITH x AS (SELECT epoch_us(ts) AS t, (event_id - min(event_id) OVER ()) * 16 // (max(event_id) OVER () - min(event_id) OVER () + 1) AS a FROM events WHERE event_id IS NOT NULL), b AS (SELECT a, max(t) AS m FROM x GROUP BY 1), s AS (SELECT a, max(m) OVER (ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM b)
SELECT coalesce(t < seen - 86400000000, false) AS late, count(*) AS n FROM x JOIN s USING (a) GROUP BY 1""",
}
