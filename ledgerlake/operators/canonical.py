"""Canonical rows: one row per key out of overlapping batches, validation, provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..registry import Dataset


def source_rank(dataset: Dataset, source: Column) -> Column:
    return F.when(source == dataset.primary, 2).when(source == dataset.backup, 1).otherwise(0)


def evidence_rank(source: Column, fetched_at: Column, trade_date: Column) -> Column:
    """Trading status: 0 authority, 1 a row derived from a gap, 2 a snapshot of the current state.

    A snapshot is an authority only for the session in which it was taken, once that has closed at 15:00: one that was
    fetched earlier, or on a later day and stamped onto this one, is not.
    """
    local = F.from_utc_timestamp(fetched_at, "Asia/Shanghai")
    final = (F.to_date(local) == trade_date) & (F.date_format(local, "HH:mm") >= "15:00")
    return F.when(source == "gap", 1).when((source == "snapshot") & ~F.coalesce(final, F.lit(False)), 2).otherwise(0)


def dedupe(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """One row per key: newest fetch (null last), then source rank, source, version; all other columns settle full ties.

    Datasets whose rows differ in evidence (trading status) rank that before freshness, wherever rows are merged or read.
    """
    known = {"source", "data_version", "fetched_at", *dataset.key}
    order = [
        *([evidence_rank(F.col("source"), F.col("fetched_at"), F.col("trade_date"))] if dataset.evidence else []),
        F.col("fetched_at").desc_nulls_last(),
        source_rank(dataset, F.col("source")).desc(),
        F.col("source").desc_nulls_last(),
        F.col("data_version").desc_nulls_last(),
        *[F.col(c).desc_nulls_last() for c in rows.columns if c not in known],
    ]
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*dataset.key).orderBy(*order))).where("_n = 1").drop("_n")


def traded(bars: DataFrame) -> DataFrame:
    """Rows with volume, or with unknown volume. On canonical rows only: earlier it would revive replaced rows."""
    return bars.where("volume > 0 OR volume IS NULL")


def traded_symbols(bars: DataFrame, dataset: Dataset) -> DataFrame:
    return traded(dedupe(bars, dataset)).select("symbol").distinct()


def validate(rows: DataFrame, dataset: Dataset, allow_missing: bool = False) -> DataFrame:
    """Project to the contract, casting without raising (a bad scalar becomes null). Raises on missing columns."""
    missing = [c for c in dataset.schema if c not in rows.columns]
    if missing and not (allow_missing and not set(missing) & set(dataset.required)):
        raise ValueError(f"{dataset.name} lacks {', '.join(missing)}")
    return rows.select(*[(F.col(c).try_cast(t) if c in rows.columns else F.lit(None).cast(t)).alias(c) for c, t in dataset.schema.items()])


def invalid(rows: DataFrame, dataset: Dataset) -> Column:
    """Whether a row lacks a required value (null, or blank text)."""
    kinds = dict(rows.dtypes)
    tests = [F.col(c).isNull() | ((F.trim(c) == "") if kinds[c] == "string" else F.lit(False)) for c in dataset.required if c in kinds]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


class ContractError(ValueError):
    """Rows that a research read must not return."""


def rules(rows: DataFrame, dataset: Dataset, bar_rules: bool = True) -> dict[str, Column]:
    """Conditions by name that break the contract: a required value missing, a number not finite, or (unless they are checked elsewhere) a bar rule broken."""
    numbers = [c for c, t in dataset.schema.items() if t == "double" and c in rows.columns]
    odd = reduce(lambda a, b: a | b, [F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False)) for c in numbers], F.lit(False))
    out = {"required_missing": invalid(rows, dataset), "not_finite": odd}
    if bar_rules and {"open", "high", "low", "close", "volume", "amount"} <= set(rows.columns):
        out |= bar_faults()
    return out


def faults(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """``check, n``: rows that break the contract."""
    found = rules(rows, dataset)
    return rows.agg(*[F.count_if(v).alias(k) for k, v in found.items()]).unpivot([], list(found), "check", "n").where("n > 0")


def _error(dataset: Dataset, found: dict[str, int]) -> ContractError:
    return ContractError(f"{dataset.name}: " + ", ".join(f"{k} {n}" for k, n in sorted(found.items())))


def check(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """rows, if they keep the contract of their dataset; else an error that names what they break, and how often. A pass of its own."""
    found = {r["check"]: r["n"] for r in faults(rows, dataset).collect()}  # one row a rule
    if found:
        raise _error(dataset, found)
    return rows


def guarded(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """rows, each held against the contract as it is delivered: the first that breaks it fails the query, with its key and what it breaks.

    The condition counts as non-deterministic, so that it is not moved before filters and joins that take rows out first.
    """
    found = rules(rows, dataset)
    names = F.concat_ws(", ", *[F.when(v, F.lit(k)) for k, v in found.items()])
    where = F.concat_ws(" ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in dataset.key if k in rows.columns])
    bad = reduce(lambda a, b: a | b, found.values()) & (F.rand() >= 0)
    return rows.where(F.when(bad, F.raise_error(F.concat(F.lit(f"{dataset.name}: "), names, F.lit(" at "), where)).cast("boolean")).otherwise(F.lit(True)))


def observed(rows: DataFrame, dataset: Dataset, observation: Observation) -> DataFrame:
    """rows as they are, their breaks of the contract counted in the pass that delivers them: confirm() tells them afterwards."""
    return rows.observe(observation, *[F.count_if(v).alias(k) for k, v in rules(rows, dataset).items()])


def confirm(observation: Observation, dataset: Dataset) -> None:
    """Raise if rows that were delivered under an observation broke the contract: the checks and counts that check() would name."""
    found = {k: n for k, n in observation.get.items() if n}
    if found:
        raise _error(dataset, found)


def bar_faults() -> dict[str, Column]:
    """Broken bar rules by name; the order of prices counts on traded rows only."""
    live = F.coalesce(F.col("volume") > 0, F.lit(True))
    price = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) <= 0, F.lit(False)) for c in ("open", "high", "low", "close")])
    rules = {
        "price_not_positive": price,
        "volume_negative": F.col("volume") < 0,
        "amount_negative": F.col("amount") < 0,
        "high_below_open": live & (F.col("high") < F.col("open")),
        "high_below_close": live & (F.col("high") < F.col("close")),
        "low_above_open": live & (F.col("low") > F.col("open")),
        "low_above_close": live & (F.col("low") > F.col("close")),
        "low_above_high": live & (F.col("low") > F.col("high")),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}


def bar_invariants(bars: DataFrame) -> DataFrame:
    """``check, n`` per rule, in one pass."""
    rules = bar_faults()
    return bars.agg(*[F.count_if(v).alias(k) for k, v in rules.items()]).unpivot([], list(rules), "check", "n")


def not_finite(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``column, n``: values that are NaN or infinite."""
    tests = [F.count_if(F.isnan(c) | (F.abs(c) == float("inf"))).alias(c) for c in columns]
    return rows.agg(*tests).unpivot([], columns, "column", "n")


def sanitize(rows: DataFrame, holidays: DataFrame | None = None, date_col: str = "trade_date") -> DataFrame:
    """Bars without weekend and holiday rows."""
    out = rows.where(F.weekday(date_col) < 5)
    return out if holidays is None else out.join(F.broadcast(holidays.select(date_col)), date_col, "left_anti")  # some days a year


def close_calendar(calendar: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """A calendar in which weekends and holidays are never trading days."""
    shut = F.weekday("trade_date") >= 5
    if holidays is not None:
        calendar = calendar.join(F.broadcast(holidays.select("trade_date", F.lit(True).alias("_h"))), "trade_date", "left")
        shut |= F.coalesce("_h", F.lit(False))
    return calendar.withColumn("is_trading", F.when(shut, False).otherwise(F.col("is_trading"))).drop("_h")


def with_provenance(rows: DataFrame, source: str, version: str, now: Column | None = None) -> DataFrame:
    return rows.withColumns({"source": F.lit(source), "data_version": F.lit(version), "fetched_at": now if now is not None else F.current_timestamp()})


def risk_warned() -> Column:
    return F.coalesce("risk_warning", F.lit(False)) | F.coalesce(F.lower("status").isin("st", "*st"), F.lit(False))


def not_trading() -> Column:
    """Whether a row says that the name did not trade; an unknown is_trading is no evidence that it did."""
    return F.coalesce(F.col("status").isin("suspended", "delisted"), F.lit(False)) | ~F.coalesce("is_trading", F.lit(False))


def split_legacy_status(rows: DataFrame) -> DataFrame:
    """A status of st or *st becomes normal with a risk warning; applying it again changes nothing."""
    legacy = F.coalesce(F.lower("status").isin("st", "*st"), F.lit(False))
    return rows.withColumns({"risk_warning": F.when(legacy, True).otherwise(F.col("risk_warning")), "status": F.when(legacy, "normal").otherwise(F.col("status"))})


def encoded(columns: list[Column | str]) -> Column:
    """Values as one text that no other values give: each with its length in bytes before it, nulls as a dash."""
    text = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def summed(code: Column) -> Column:
    """Order-free digest of a group of rows: two sums of 60-bit pieces of their SHA-256, as text."""
    piece = lambda at: F.conv(F.substring(F.sha2(code, 256), at, 15), 16, 10).cast("decimal(38,0)")
    total = lambda at: F.coalesce(F.sum(piece(at)), F.lit(0)).cast("string")
    return F.concat_ws("-", total(1), total(16))


def scope_hash(symbols: DataFrame, column: str = "symbol") -> DataFrame:
    """One row ``hash, n`` for the distinct symbols, whatever their order."""
    return symbols.select(column).distinct().agg(summed(encoded([column])).alias("hash"), F.count("*").alias("n"))


def digest(rows: DataFrame, by: list[str], leave: tuple[str, ...] = ("fetched_at",)) -> DataFrame:
    """Content of each group of rows without their fetch times: ``n`` and an order-free ``hash``."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), summed(encoded([c for c in rows.columns if c not in leave])).alias("hash"))
