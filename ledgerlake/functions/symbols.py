"""Rules over instrument symbols (``code.EXCHANGE``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code prefixes by exchange.
SHARE_PREFIXES = {"SH": ("60", "68"), "SZ": ("00", "30"), "BJ": ("43", "83", "87", "92")}
ETF_PREFIXES = {"SH": ("51", "56", "58"), "SZ": ("15", "16")}
CDR_PREFIX, RESERVED = "689", tuple(str(k) for k in range(81, 90))
SUBSCRIPTIONS = ("认购款", "申购款")


def code(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit("."), F.lit(1))


def exchange(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit("."), F.lit(2))


def _starts(c: Column, prefixes) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out |= c.startswith(p)
    return out


def infer_exchange(c: Column) -> Column:
    """Exchange of a bare code, filled with zeros to six digits."""
    c = F.lpad(c, 6, "0")
    return F.when(_starts(c, ("60", "68")), "SH").when(_starts(c, ("92", "43", "83", "87")), "BJ").otherwise("SZ")


def six_digits(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[0-9]{6}$"), F.lit(False))


def is_etf(c: Column, ex: Column) -> Column:
    """A fund: six digits that begin as its exchange's funds do."""
    out = F.lit(False)
    for e, prefixes in ETF_PREFIXES.items():
        out |= (F.upper(ex) == e) & _starts(c, prefixes)
    return six_digits(c) & F.coalesce(out, F.lit(False))


def is_cdr(c: Column, ex: Column) -> Column:
    """A depositary receipt: six digits of one prefix, in Shanghai only."""
    return six_digits(c) & F.coalesce((F.upper(ex) == "SH") & c.startswith(CDR_PREFIX), F.lit(False))


def in_class(symbol: Column, mainland_only: bool = False) -> Column:
    """Whether a symbol is a share: a listed prefix on its exchange, neither reserved, receipt nor fund."""
    c, ex = code(symbol), exchange(symbol)
    out = F.lit(False)
    for e, prefixes in SHARE_PREFIXES.items():
        if not (mainland_only and e == "BJ"):
            out |= (ex == e) & _starts(c, prefixes)
    return six_digits(c) & out & ~(ex.isin("SH", "SZ") & _starts(c, RESERVED)) & ~is_cdr(c, ex) & ~is_etf(c, ex)


def placeholder_name(name: Column) -> Column:
    """A stub of a share subscription, by its name's end once blanks and NUL padding are off. Null and empty names are none."""
    bare = F.regexp_replace(name, r"[\s\x00]+$", "")
    return F.coalesce(reduce(lambda a, b: a | b, [bare.endswith(x) for x in SUBSCRIPTIONS]), F.lit(False))


def lots_to_shares(lots: Column) -> Column:
    return lots.cast("bigint") * 100


def limit_threshold(symbol: Column, risk_warning: Column) -> Column:
    """Daily price limit as a ratio, less half a per cent."""
    return F.when(risk_warning, 0.045).when(exchange(symbol) == "BJ", 0.295).when(_starts(symbol, ("30", "688")), 0.195).otherwise(0.095)
