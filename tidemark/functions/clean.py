"""Canonical forms of dirty identifiers and amounts. All are JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks, tabs and line ends.
WHITE = " \t\r\n"


def outer_trim(c: Column) -> Column:
    """Strip blanks, tabs and line ends on both sides; null stays null."""
    return F.btrim(c, F.lit(WHITE))


def ident(c: Column) -> Column:
    """Lower case without outer white space."""
    return F.lower(outer_trim(c))


def hex_ident(c: Column) -> Column:
    """``ident`` without a leading ``0x``; empty and all-zero become null."""
    bare = F.regexp_replace(ident(c), "^0x", "")
    return F.when(~bare.rlike("^0*$"), bare)


def split_name(c: Column) -> Column:
    """train, validation or test; null for anything else."""
    s = ident(c)
    return F.when(s.isin("train", "training"), "train").when(s.isin("validation", "valid", "val", "dev"), "validation").when(s == "test", "test")


def amount(c: Column, precision: int, scale: int) -> Column:
    """Decimal amount of a text, or null where it is no number."""
    return outer_trim(c).try_cast(f"decimal({precision},{scale})")


def unit_price(c: Column) -> Column:
    """A price between 0 and 1 as DOUBLE, else null (``.5`` is one, ``NaN`` is not)."""
    bare = outer_trim(c)
    value = F.when(bare.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), bare.try_cast("double"))
    return F.when((value >= 0) & (value <= 1), value)


def epoch_us(c: Column) -> Column:
    """Epoch number in s (< 1e11), ms (< 1e14) or us, as microseconds."""
    n = c.cast("long")
    return F.when(n >= 100_000_000_000_000, n).when(n >= 100_000_000_000, n * 1000).otherwise(n * 1_000_000)
