"""Security codes: six digits, vendor prefixes and suffixes, canonical ids, and the small vocabularies around them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIX_DIGITS = r"^[0-9]{6}$"
CANONICAL = r"^(SH|SZ|BJ)\.[0-9]{6}$"


def six_digits(c: Column) -> Column:
    """The trimmed code; an error if it isn't six digits."""
    code = F.trim(c.cast("string"))
    return F.when(code.rlike(SIX_DIGITS), code).otherwise(F.raise_error(F.concat(F.lit("not a six-digit code: "), F.coalesce(code, F.lit("null")))))


def source_code(c: Column) -> Column:
    """A vendor's code as six digits: exchange prefix off, ``.0`` off, zeros before; anything else unchanged."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    bare = F.regexp_replace(text, r"(?i)^(sh|sz|bj)[._ -]?(?=[0-9]+$)", "")
    return F.when(bare.rlike("^[0-9]{1,6}$"), F.lpad(bare, 6, "0")).when(bare.rlike("^[0-9]+$"), bare).otherwise(text)


def exchange_of(code: Column) -> Column:
    head = F.substring(code, 1, 1)
    return F.when(head == "6", "SH").when(head.isin("0", "2", "3"), "SZ").when(head.isin("4", "8", "9"), "BJ")


def exchange_alias(c: Column) -> Column:
    name = F.upper(F.trim(c))
    return F.when(name.isin("SH", "SSE"), "SH").when(name.isin("SZ", "SZSE"), "SZ").when(name.isin("BJ", "BSE"), "BJ")


def board(exchange: Column, code: Column) -> Column:
    two, three = F.substring(code, 1, 2), F.substring(code, 1, 3)
    return (
        F.when((exchange == "SH") & (three == "688"), "star").when((exchange == "SH") & (two == "60"), "main")
        .when((exchange == "SZ") & (two == "00"), "main").when((exchange == "SZ") & (two == "30"), "chinext")
        .when(exchange == "BJ", "bse").otherwise("unknown")
    )


def canonical_id(exchange: Column, code: Column) -> Column:
    """``SH.600000``; null if either part is."""
    return F.concat(exchange, F.lit("."), code)


def canonical_from_dotted(c: Column) -> Column:
    """``sh.600000`` as ``SH.600000``; null for anything else."""
    name = F.upper(F.trim(c))
    return F.when(name.rlike(CANONICAL), name)


def canonical_from_prefixed(c: Column) -> Column:
    """``sh600000`` as ``SH.600000``; null for anything else."""
    name = F.upper(F.trim(c))
    return F.when(name.rlike("^(SH|SZ|BJ)[0-9]{6}$"), F.concat(F.substring(name, 1, 2), F.lit("."), F.substring(name, 3, 6)))


def dotted(exchange: Column, code: Column) -> Column:
    """``sh.600000``; the exchange BJ has none."""
    return F.when(exchange != "BJ", F.concat(F.lower(exchange), F.lit("."), code))


def prefixed(exchange: Column, code: Column) -> Column:
    return F.concat(F.lower(exchange), code)


def suffix_symbol(code: Column) -> Column:
    return F.concat(code, F.when(F.substring(code, 1, 1).isin("5", "6", "9"), ".SH").otherwise(".SZ"))


def prefix_symbol(code: Column) -> Column:
    head = F.substring(code, 1, 1)
    beijing = head.isin("4", "8") | (F.substring(code, 1, 3) == "920")
    return F.concat(F.when(beijing, "bj").when(head.isin("5", "6", "9"), "sh").otherwise("sz"), code)


def listing_status(c: Column) -> Column:
    name = F.lower(F.trim(c.cast("string")))
    return F.when(name.isin("1", "active", "listed", "normal"), "active").when(name.isin("0", "delisted", "terminated", "inactive"), "delisted").otherwise("unknown")


def adjustment(c: Column) -> Column:
    """unadjusted, qfq or hfq from their aliases; an error for any other."""
    name = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return (
        F.when(name.isin("", "none", "不复权", "unadjusted"), "unadjusted").when(name.isin("qfq", "hfq"), name)
        .otherwise(F.raise_error(F.concat(F.lit("unknown adjustment: "), name)))
    )


def picked_name(spot: Column, delisted: Column, basic: Column, active: Column) -> Column:
    """The quote's name for a listed security, else the delisting list's, else the basic table's; empty is missing."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(F.when(active, some(spot)), some(delisted), some(basic), some(spot))
