"""Scalar functions. JVM expressions, or Arrow-batched UDFs where SQL has none."""

from __future__ import annotations

import base64
import hashlib
import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import outer_trim

ZONED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$"


# Parts of event kinds by category.
EVENT_TERMS = {
    "card": ("card",), "shot": ("shot",), "substitution": ("substitution",), "foul": ("foul",), "corner": ("corner",), "delay": ("delay",), "phase": ("kickoff", "half", "end-regular", "full-time"),
}


def instant_us(c: Column) -> Column:
    """Microseconds of a zoned ISO instant; naive or unreadable text is null."""
    bare = outer_trim(c)
    return F.when(bare.rlike(ZONED), F.unix_micros(F.try_to_timestamp(bare)))


def iso_utc(us: Column) -> Column:
    """``...Z`` text; the fraction is left out when it is zero."""
    t = F.timestamp_micros(us)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(whole, F.when(F.pmod(us, F.lit(1_000_000)) != 0, F.date_format(t, ".SSSSSS")).otherwise(F.lit("")), F.lit("Z"))


def decimal_text(c: Column, precision: int = 38, scale: int = 18) -> Column:
    """Canonical decimal text: no exponent, no trailing zeros; null if unreadable."""
    s = outer_trim(c).try_cast(f"decimal({precision},{scale})").cast("string")
    s = F.when(s.contains("."), F.regexp_replace(s, r"\.?0+$", "")).otherwise(s)
    return F.when(s == "-0", "0").otherwise(s)


def significant(units: Column, digits: int) -> Column:
    """A whole number rounded to significant digits, half to even, by integer arithmetic; the sign is kept."""
    size = F.abs(units.cast("decimal(38,0)"))
    drop = F.greatest(F.length(size.cast("string")) - digits, F.lit(0))
    unit = F.rpad(F.lit("1"), drop + 1, F.lit("0")).cast("decimal(38,0)")
    rest = size % unit
    whole = (size - rest) / unit
    up = (2 * rest > unit) | ((2 * rest == unit) & (whole.cast("decimal(38,0)") % 2 == 1))
    out = size - rest + F.when(up, unit).otherwise(F.lit(0))
    return (out * F.when(units < 0, -1).otherwise(1)).cast("decimal(38,0)")


def sigmoid_difference(a: Column, b: Column) -> Column:
    """exp(a) / (exp(a) + exp(b)) without overflow."""
    d = a - b
    e = F.exp(-F.abs(d))
    return F.when(d >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def repeat_rate(n: Column, horizon: Column, exposure: Column) -> Column:
    """Chance of another event within the horizon after n events in the exposure."""
    return F.when((n > 1) & (exposure > 0), -F.expm1(-(n - 1) * horizon / exposure)).otherwise(F.lit(0.0))


def pseudonym(c: Column) -> Column:
    return F.concat(F.lit("actor_"), F.substring(F.sha2(F.lower(c), 256), 1, 24))


def hash64(c: Column) -> Column:
    """First 64 bits of SHA-256 as DECIMAL(20, 0)."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def feature_family(name: Column) -> Column:
    """First matching family of a feature name; the order of the tests matters."""
    rules = (("price", "price"), ("discount", "price"), ("quantity", "activity"), ("count", "activity"), ("tax", "cost"))
    out = F.when(F.lit(False), F.lit(""))
    for part, family in rules:
        out = out.when(name.contains(part), family)
    return out.otherwise("other")


@F.pandas_udf(T.StringType())
def fold_text(s: pd.Series) -> pd.Series:
    """NFKD, marks dropped, case folded, everything else than letters and digits one blank."""

    def one(x):
        if x is None:
            return None
        x = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).casefold()
        return " ".join("".join(c if c.isalnum() else " " for c in x).split())

    return s.map(one)


@F.pandas_udf(T.StringType())
def sha1_base32(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else base64.b32encode(hashlib.sha1(x.encode()).digest()).decode())


@F.pandas_udf(T.StringType())
def uint256_hex(s: pd.Series) -> pd.Series:
    """Decimal text of up to 256 bits as 64 hex digits; anything else is null."""

    def one(x):
        x = (x or "").strip(" \t\r\n")
        return f"{int(x):064x}" if x.isascii() and x.isdigit() and len(x) < 79 and int(x) < 1 << 256 else None

    return s.map(one)


@F.pandas_udf(T.BooleanType())
def strict_json(s: pd.Series) -> pd.Series:
    """Is the text one JSON object without repeated keys, NaN or Infinity? Null stays null."""

    def unique(pairs):
        if len({k for k, _ in pairs}) < len(pairs):
            raise ValueError
        return dict(pairs)

    def reject(_):
        raise ValueError

    def one(x):
        if x is None:
            return None
        try:
            return isinstance(json.loads(x, object_pairs_hook=unique, parse_constant=reject), dict)
        except (ValueError, RecursionError):
            return False

    return s.map(one)


def canonical_url(c: Column) -> Column:
    """Lower-case scheme and host, no fragment, query pairs sorted."""
    base = F.regexp_extract(c, r"^([^?#]*)", 1)
    query = F.regexp_extract(c, r"\?([^#]*)", 1)
    head = F.lower(F.regexp_extract(base, r"^([A-Za-z]+://[^/]*)", 1))
    rest = F.regexp_replace(base, r"^[A-Za-z]+://[^/]*", "")
    pairs = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda x: x != "")), "&")
    return F.concat(head, rest, F.when(pairs != "", F.concat(F.lit("?"), pairs)).otherwise(F.lit("")))


def request_url(base: Column, params: Column) -> Column:
    """``base`` with a map of parameters: null ones left out, truth values in lower case, names and values encoded, sorted."""
    kept = F.filter(F.map_entries(params), lambda e: e["value"].isNotNull())
    value = lambda e: F.when(e["value"].isin("True", "False"), F.lower(e["value"])).otherwise(e["value"])
    pairs = F.array_join(F.array_sort(F.transform(kept, lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(value(e))))), "&")
    return F.concat(base, F.when(pairs != "", F.concat(F.lit("?"), pairs)).otherwise(F.lit("")))


def plain_text(c: Column) -> Column:
    """Mark-up removed, common entities resolved, white space collapsed."""
    t = F.regexp_replace(c, r"<[^>]*>", " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(t, r"[ \t\r\n]+", " "))


def page_title(html: Column) -> Column:
    """The single distinct non-empty title; null if there is none, several, or a damaged one."""
    found = F.array_distinct(F.filter(F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<title[^>]*>(.*?)</title>"), F.lit(1)), plain_text), lambda x: x != ""))
    return F.when((F.size(found) == 1) & ~F.contains(F.try_element_at(found, F.lit(1)), F.lit("�")), F.try_element_at(found, F.lit(1)))


def page_headline(html: Column, interstitial: str = "(?i)just a moment|access denied|are you a robot") -> Column:
    """STRUCT(headline, reason): the og:title if there is one, else the title; two that disagree, or a page in between, give a reason.

    A title that begins with the og:title and goes on after a separator (the
    name of the site) agrees with it.
    """
    tags = F.regexp_extract_all(html, F.lit(r"(?is)(<meta[^>]*property=[\"']og:title[\"'][^>]*>)"), F.lit(1))
    og = F.array_distinct(F.filter(F.transform(tags, lambda t: plain_text(F.regexp_extract(t, r"(?is)content=[\"']([^\"']*)[\"']", 1))), lambda x: x != ""))
    title = page_title(html)
    first = F.try_element_at(og, F.lit(1))
    agrees = title.isNull() | (title == first) | (F.startswith(title, first) & F.substr(title, F.length(first) + 1).rlike("^ ?[|\u2013\u2014-] "))
    reason = (
        F.when(F.coalesce(F.coalesce(first, title).rlike(interstitial), F.lit(False)), "interstitial").when(F.size(og) > 1, "several_og_titles").when((F.size(og) == 1) & ~agrees, "titles_disagree")
        .when((F.size(og) == 0) & title.isNull(), "no_single_title")
    )
    return F.struct(F.when(reason.isNull(), F.coalesce(first, title)).alias("headline"), reason.alias("reason"))


def kind_matches(kind: Column, category: str) -> Column:
    """Is an event kind (a slug such as own-goal) of the category? A goal kick is no goal."""
    k = F.lower(F.coalesce(kind, F.lit("")))
    if category == "goal":
        return (k == "goal") | k.startswith("goal---") | k.startswith("own-goal") | (k == "penalty---scored")
    return k.rlike("|".join(EVENT_TERMS[category]))


def single_clause(text: Column, pattern: str, longest: int) -> Column:
    """The only sentence that matches, if it is at most ``longest`` characters."""
    hits = F.filter(F.split(text, r"(?<=[.!?])[ \t\r\n]+"), lambda s: s.rlike(pattern))
    return F.when((F.size(hits) == 1) & (F.char_length(F.try_element_at(hits, F.lit(1))) <= longest), F.try_element_at(hits, F.lit(1)))


def hex_word(c: Column, i: int) -> Column:
    """The i-th 32-byte word (from 0) of a hex payload, or null if it is not whole."""
    bare = F.regexp_replace(F.lower(c), "^0x", "")
    w = F.substring(bare, 64 * i + 1, 64)
    return F.when(w.rlike("^[0-9a-f]{64}$"), w)
