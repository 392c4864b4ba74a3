"""Fixtures and headlines: pair patterns, links with a confidence ladder, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def pair_key(a: Column, b: Column) -> Column:
    """One key for a pair in either order."""
    return F.array_join(F.array_sort(F.array(a, b)), "|")


def teams_of(fixtures: DataFrame, fixture: str, name: str, key: Column) -> DataFrame:
    """Fixtures with exactly two distinct team keys: (fixture, pair, home)."""
    t = fixtures.select(F.col(fixture).alias("fixture"), key.alias("team"), name).where("fixture IS NOT NULL AND team <> ''").groupBy("fixture").agg(F.array_sort(F.collect_set("team")).alias("teams"))
    return t.where("size(teams) = 2").select("fixture", "teams", F.array_join("teams", "|").alias("pair"))


# Other names of teams, as words in lower case.
ALIASES = {
    "cabo verde": "cape verde", "cape verde islands": "cape verde", "congo dr": "dr congo", "cote d ivoire": "ivory coast", "ir iran": "iran",
    "korea republic": "south korea", "bosnia and herzegovina": "bosnia herzegovina", "czech republic": "czechia", "turkey": "turkiye",
}


def canonical_team(words: Column) -> Column:
    """The usual name of a team; ``words`` is its name in lower case between single blanks."""
    names = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.coalesce(F.element_at(names, words), words)


def word_runs(words: Column, most: int) -> Column:
    """All runs of one to ``most`` consecutive words."""
    w = F.split(words, " ")

    def runs(n: int) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))

    return F.array_distinct(F.concat(*[runs(n) for n in range(1, most + 1)]))


def mentioned_teams(headlines: DataFrame, key: str, text: str, teams: DataFrame, *, most: int = 4) -> DataFrame:
    """``headlines`` with ``found``, the sorted distinct teams that the text names in whole words.

    Runs of up to ``most`` words are exploded and joined to the team list, also
    under their other names; nothing is tested pairwise. ``key`` is unique and
    the only column joined back on, so others may be null.
    """
    found = headlines.select(key, F.explode(F.array_distinct(F.transform(word_runs(F.col(text), most), canonical_team))).alias("team")).join(teams, "team").groupBy(key).agg(F.array_sort(F.collect_set("team")).alias("found"))
    return headlines.join(found, key, "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))


def is_candidate(found: Column, text: Column, url: Column, keyword: str, hint: str) -> Column:
    """Keyword, or two teams, or one team with a hint in the address."""
    return text.rlike(keyword) | (F.size(found) >= 2) | ((F.size(found) == 1) & url.rlike(hint))


def ladder(found: Column, pair: Column, text: Column) -> Column:
    """Relationship of a headline to a fixture, strongest first."""
    both = F.array_join(found, "|") == pair
    return F.when(both & text.rlike(r"\b(v|vs|against|face|meet)\b"), "direct").when(both, "pair").when(F.size(found) == 1, "team").otherwise("background")


def classify_pairs(left: DataFrame, right: DataFrame, pair: str, lt: str, rt: str, within_us: int, lid: str, rid: str) -> DataFrame:
    """Left rows by how many right rows have their pair and lie within the band.

    A right row used by several left rows invalidates them all.
    """
    met = left.join(right, pair).where(F.abs(F.col(lt) - F.col(rt)) <= within_us).withColumn("__u", F.count("*").over(W.partitionBy(rid)))
    n = met.groupBy(lid).agg(F.count("*").alias("n"), F.max("__u").alias("u"))
    kind = F.when(F.col("n").isNull(), "unmatched").when(F.col("u") > 1, "reused").when(F.col("n") == 1, "matched").otherwise("ambiguous")
    return left.join(n, lid, "left").select(lid, kind.alias("kind"))


# Words of other competitions, age groups and sports, and how a headline sets two teams against each other.
OTHER_SCOPE = r"\b(club|women|womens|women s|girls|youth|under ?[0-9]{1,2}|u ?[0-9]{1,2}|rugby|cricket|hockey|basketball|futsal|beach|ski|skiing|esport|esports)\b"
AGAINST = "v|vs|versus|against|meet|meets|face|faces|play|plays|take on|takes on"


def scope_reason(words: Column, path: Column, known_us: Column, name: str, year: str) -> Column:
    """May a headline of a known capture count for the edition ``year`` of the competition ``name``, and if not, why?

    ``words`` and ``path`` (of the address) are lower case between single blanks.
    """
    both = F.concat_ws(" ", words, path)
    years = F.exists(F.regexp_extract_all(both, F.lit(r"\b((?:19|20)[0-9]{2})\b"), F.lit(1)), lambda y: y != year)
    return (
        F.when(both.rlike(OTHER_SCOPE), "other_competition").when(years, "other_edition").when(~both.rlike(rf"\b{name}\b"), "no_scope")
        .when(~F.coalesce(F.date_format(F.timestamp_micros(known_us), "yyyy") == year, F.lit(False)), "capture_outside_edition").otherwise("captured_scope")
    )


def pair_patterns(fixtures: DataFrame) -> DataFrame:
    """Fixtures (fixture, teams of two names) with the pattern of their pair, and whether another fixture has the same pair.

    A pair is set against each other by a verb, or as "how a can beat b". Names are words of letters and digits, so
    they need no escaping; their other names count too.
    """
    others = F.create_map(*[F.lit(x) for name in sorted(set(ALIASES.values())) for x in (name, "|".join([name, *sorted(k for k, v in ALIASES.items() if v == name)]))])
    name = lambda i: F.concat(F.lit("(?:"), F.coalesce(F.element_at(others, F.col("teams")[i]), F.col("teams")[i]), F.lit(")"))
    a, b, verb = name(0), name(1), F.lit(f" (?:{AGAINST}) ")
    pattern = F.concat(F.lit(r"\b(?:"), a, verb, b, F.lit("|"), b, verb, a, F.lit("|how "), a, F.lit(" can beat "), b, F.lit("|how "), b, F.lit(" can beat "), a, F.lit(r")\b"))
    return fixtures.withColumn("pattern", pattern).withColumn("ambiguous", F.count("*").over(W.partitionBy("pair")) > 1)


def dash_pattern(pattern: Column) -> Column:
    """The pattern of the same pair written with a dash, for texts that keep theirs."""
    return F.replace(pattern, F.lit(f" (?:{AGAINST}) "), F.lit(" ?- ?"))
