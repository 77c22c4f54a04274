"""The main read: window, symbols, canonical rows, universe, adjustment or point in time, in their fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..registry import Dataset
from ..sources import lake
from . import canonical, evidence, research


def read_validated(rows: DataFrame, dataset: Dataset, start=None, end=None, symbols=None, master=None, status=None, strict_universe: bool = False, observation: Observation | None = None, unpriced: bool = False) -> DataFrame:
    """Scan, then the universe (and no rows without a positive price), then validation, then one row per key.

    Rows outside the universe are gone before validation, so they cannot fail it. A row that breaks the contract fails the query that
    delivers it; there is no pass before it. observation: rows are delivered all the same and what they break is counted as
    they pass, for canonical.confirm() to raise on. strict_universe: a day and symbol of the
    window without a status row is an error, as is a read without a master. unpriced: rows of the universe without a positive price
    stay, and the contract has its say on them.
    """
    out = lake.scan(rows, dataset, start, end, symbols)
    if status is not None:
        if strict_universe and (master is None or not research.missing_status(out, status).isEmpty()):
            raise ValueError("the universe of some rows is not known")
        out = research.universe(out, master, status)
        out = out if unpriced else out.where("open > 0 AND high > 0 AND low > 0 AND close > 0")
    typed = canonical.validate(out, dataset, allow_missing=True)
    held = canonical.guarded(typed, dataset) if observation is None else canonical.observed(typed, dataset, observation)
    return canonical.dedupe(held, dataset)


def ordered(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """Rows in the order of their kind: ticks by sequence and intraday bars by time within a symbol, facts by announcement, others by day."""
    kinds = (("tick_seq", ("symbol", "trade_date", "tick_seq")), ("bar_time", ("symbol", "bar_time")), ("report_period", ("announce_date", "symbol", "report_period", "item_code")))
    by = next((order for mark, order in kinds if mark in rows.columns), (dataset.date_col, "symbol"))
    by = [c for c in by if c in rows.columns]
    return rows.orderBy(*by) if by else rows


ADJUSTABLE = ("daily_bars", "minute_bars", "minute_bars_5m", "trade_ticks")


def load(rows: DataFrame, dataset: Dataset, start=None, end=None, symbols=None, adjust=None, factors=None, master=None, status=None, as_of=None, items=None, all_vintages=False, pit_mode="best_effort", strict_adj=False, strict_universe=False, delistings: dict[str, DataFrame] | None = None, observation: Observation | None = None, unpriced: bool = False) -> DataFrame:
    """Rows of a dataset as a research read, in the order of their kind. Arguments that do not go together raise.

    Facts need as_of; start and end are then quarters of their report periods. Ticks and intraday bars take their day's factor.
    delistings (``catalog`` and, if there are such, ``recent`` and ``pending``): a read that fails unless every delisting of its
    window is accounted for; needs the master. strict_adj: a row without an exact factor fails the query that delivers it.
    """
    if adjust and as_of:
        raise ValueError("adjust is for prices, as_of for facts")
    if adjust and dataset.name not in ADJUSTABLE:
        raise ValueError(f"{dataset.name} holds no prices per share")
    if status is not None and dataset.name != "daily_bars":
        raise ValueError(f"a universe is for daily bars, not for {dataset.name}")
    if pit_mode not in ("strict", "best_effort", "observed"):
        raise ValueError(f"unknown pit_mode {pit_mode}")
    if dataset.pit:
        if not as_of:
            raise ValueError(f"{dataset.name} needs as_of")
        seen = research.pit_classify(research.pit_normalize(lake.scan(rows, dataset, start, end, symbols)), as_of, pit_mode)
        seen = seen.where(F.col("item_code").isin(items)) if items else seen
        key = [k for k in dataset.key if k != "announce_date"]
        return ordered(seen if all_vintages else research.pit_collapse(seen, key, ["item_value"]), dataset)
    if as_of or items or all_vintages:
        raise ValueError(f"{dataset.name} has no vintages")
    if delistings is not None:
        if dataset.name != "daily_bars" or master is None:
            raise ValueError("evidence of delistings is for daily bars, with a master")
        evidence.require_delistings(lake.scan(rows, dataset, start, end), start, end, bars=canonical.dedupe(lake.scan(rows, dataset, start, end), dataset), master=master, **delistings)
    out = read_validated(rows, dataset, start, end, symbols, master, status, strict_universe, observation, unpriced)
    if adjust is None:
        return ordered(out, dataset)
    known = lake.scan(factors, dataset, start, end)
    out = {"hfq": research.adjust_hfq, "qfq": research.adjust_qfq}[adjust](out, known, (*research.PRICES, "price"))
    if strict_adj:
        text = F.concat(F.lit("no exact factor of "), "symbol", F.lit(" on "), F.col("trade_date").cast("string"))
        out = out.where(F.when(~F.col("adj_is_exact") & (F.rand() >= 0), F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))
    return ordered(out, dataset)


def query_dataset(rows: DataFrame, dataset: Dataset, start=None, end=None, symbols=None, limit: int = 200, offset: int = 0) -> DataFrame:
    """One page of a dataset that has no read of its own; prices and facts are refused, whose reads adjust and date them."""
    if dataset.pit or dataset.name in ADJUSTABLE:
        raise ValueError(f"{dataset.name} has a read of its own")
    return research.paged(canonical.dedupe(lake.scan(rows, dataset, start, end, symbols), dataset), list(dataset.key), limit, offset)


_PRICES = ("open", "high", "low", "close")
#: Bars with their prices adjusted both ways: by the day's factor, and by it over the latest one not later than the last bar of the symbol.
_ADJUSTED = f"""
    WITH b AS ({{bars}}), h AS (SELECT symbol, trade_date, factor FROM adj_factors WHERE adjust_type = 'hfq'),
    last AS (SELECT symbol, max(trade_date) AS d FROM b GROUP BY symbol),
    a AS (SELECT h.symbol, max_by(h.factor, h.trade_date) AS anchor FROM h JOIN last ON last.symbol = h.symbol AND h.trade_date <= last.d GROUP BY h.symbol)
    SELECT b.*, h.factor IS NOT NULL AS adj_is_exact, {", ".join(f"b.{p} * coalesce(h.factor, 1D) AS hfq_{p}" for p in _PRICES)},
        {", ".join(f"b.{p} * coalesce(try_divide(h.factor, a.anchor), 1D) AS qfq_{p}" for p in _PRICES)}, b.close * coalesce(try_divide(h.factor, a.anchor), 1D) AS adj_close
    FROM b LEFT JOIN h ON h.symbol = b.symbol AND h.trade_date = b.trade_date LEFT JOIN a ON a.symbol = b.symbol"""


def views(spark: SparkSession, frames: dict[str, DataFrame], registry: dict[str, Dataset]) -> None:
    """One canonical temp view per registered dataset: of its rows where frames has some, else empty with its types.

    Beside them the view ``daily_bars_adj``, whose forward-adjusted prices are anchored at each symbol's last bar, and the table
    function ``daily_bars_qfq(start, end)``, whose anchors are those of its window; null bounds are open.
    """
    for name, dataset in registry.items():
        canonical.dedupe(frames.get(name, lake.empty(spark, dataset)), dataset).createOrReplaceTempView(name)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW daily_bars_adj AS {_ADJUSTED.format(bars='SELECT * FROM daily_bars')}")
    window = "SELECT * FROM daily_bars WHERE (start_date IS NULL OR trade_date >= start_date) AND (end_date IS NULL OR trade_date <= end_date)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION daily_bars_qfq(start_date DATE, end_date DATE) RETURNS TABLE RETURN {_ADJUSTED.format(bars=window)}")


def run_sql(spark: SparkSession, text: str, limit: int) -> DataFrame:
    """One query over the views: wrapped as a subquery, so that nothing but a query parses; one page of it."""
    return spark.sql(f"SELECT * FROM (\n{text.rstrip().rstrip(';')}\n) LIMIT {int(limit)}")
