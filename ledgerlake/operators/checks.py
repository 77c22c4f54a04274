"""The quality checks of a lake by name, each with the datasets that it needs, all with findings of one schema.

``findings(frames, day)`` runs every check whose datasets are there. A check tells how many rows, days or names it found and the first of
them; it says nothing where all is well. Thresholds are the operators' own defaults unless ``Limits`` says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import derive, quality


@dataclass(frozen=True)
class Limits:
    """What the checks ask of a market: hours, direction codes, bands."""

    minute_spans: list = field(default_factory=lambda: [("09:31:00", "11:30:00"), ("13:01:00", "15:00:00")])
    tick_spans: list = field(default_factory=lambda: [("09:15:00", "11:30:00"), ("13:00:00", "15:01:00")])
    minutes: int = 240
    buy: str = "buy"
    sell: str = "sell"
    minute_bands: dict = field(default_factory=lambda: {"volume": (0.95, 1.05), "amount": (0.95, 1.05)})
    tick_bands: dict = field(default_factory=lambda: {"volume": (0.95, 1.05), "amount": (0.95, 1.05)})
    volume_band: tuple = (0.5, 2.0)
    adj: tuple = (0.35, 0.15, 0.11)
    jump: float = 20
    silent_days: int = 180
    least_span: int = 730
    first_announce: str = "2001-01-01"


def _told(rows: DataFrame, severity: str | Column, name: str, details: Column | None = None, n: Column | None = None) -> DataFrame:
    """One finding for some rows, or one of each severity where that is a column of them."""
    by = [] if isinstance(severity, str) else [severity.alias("severity")]
    agg = rows.groupBy(*by).agg((F.count("*") if n is None else F.coalesce(F.sum(n), F.lit(0))).cast("long").alias("n"), F.min((F.lit(None) if details is None else details).cast("string")).alias("details")).where("n > 0")
    return agg.select((F.lit(severity) if isinstance(severity, str) else F.col("severity")).alias("severity"), F.lit(name).alias("check"), "n", "details")


def _each(kind: Column, rows: DataFrame, severity: Column, details: Column | None = None, n: Column | None = None) -> DataFrame:
    """One finding for each kind and severity of some rows."""
    made = rows.select(severity.alias("severity"), kind.alias("check"), (F.lit(1) if n is None else n).alias("_n"), (F.lit(None) if details is None else details).cast("string").alias("_d"))
    return made.where("severity <> 'none'").groupBy("severity", "check").agg(F.sum("_n").cast("long").alias("n"), F.min("_d").alias("details")).where("n > 0")


def _calendar(f, day, limits):
    rows = quality.calendar_reconcile(f["daily_bars"], f["trading_calendar"])
    return _each(F.col("check"), rows, F.when(F.col("check") == "not_a_session", "warning").otherwise("error"), F.col("trade_date"))


def _adjustment(f, day, limits):
    jump, calm, apart = limits.adj
    rows = quality.adj_reconcile(f["adjusted_bars"], f["trading_calendar"], f["corporate_actions"], jump, calm, apart, f.get("restructurings"), f.get("instruments"))
    return _each(F.regexp_replace("check", ":more$", ""), rows, F.col("severity"), F.col("symbol"), F.col("n"))


def _directions(f, day, limits):
    n = quality.directions(f["trade_ticks"], limits.buy, limits.sell)
    return _told(n, "error", "tick_direction_unknown", n=F.col("n_unknown")).unionByName(_told(n.where("outside"), "warning", "tick_direction_share"))


def _announced(f, day, limits):
    n = quality.announce_check(f["financial_statement_items"], limits.first_announce)
    return _told(n, "error", "announce_date_missing", n=F.col("n_null")).unionByName(_told(n, "warning", "announce_date_early", n=F.col("n_early")))


def _sums(rows: str, name: str, bands: str):
    def run(f, day, limits):
        told = quality.reconcile(f[rows], f["daily_bars"], getattr(limits, bands))
        return _each(F.concat(F.lit(f"{name}:"), "measure"), told, F.col("severity"))

    return run


#: check -> (dataset that it speaks of, frames that it needs, function of frames, day and limits)
CHECKS: dict[str, tuple[str, tuple[str, ...], Callable]] = {
    "calendar": ("daily_bars", ("daily_bars", "trading_calendar"), _calendar),
    "calendar_horizon": ("trading_calendar", ("trading_calendar",), lambda f, day, _: _told(quality.calendar_horizon(f["trading_calendar"], day).where("n = 0"), "error", "calendar_ends")),
    "series_gaps": ("index_bars", ("index_bars", "trading_calendar"), lambda f, day, _: _told(quality.coverage_by_series(f["index_bars"], f["trading_calendar"], f.get("known_gaps")).where("n_missing > 0"), "error", "series_gaps", F.col("symbol"))),
    "orphans": ("valuation_metrics", ("valuation_metrics", "daily_bars"), lambda f, day, _: _told(quality.orphans(f["valuation_metrics"], f["daily_bars"]), "warning", "orphans", F.col("symbol"))),
    "adjustment": ("adj_factors", ("adjusted_bars", "trading_calendar", "corporate_actions"), _adjustment),
    "factor_coverage": ("adj_factors", ("daily_bars", "adj_factors"), lambda f, day, _: _told(quality.adj_coverage(f["daily_bars"], f["adj_factors"]), "warning", "factors_missing", F.col("exchange"), F.col("n_missing"))),
    "factor_jumps": ("adj_factors", ("adj_factors",), lambda f, day, limits: _told(derive.factor_continuity(f["adj_factors"], limits.jump), "warning", "factor_jumps", F.col("symbol"))),
    "survivorship": ("instruments", ("daily_bars", "instruments"), lambda f, day, limits: _told(quality.survivorship_check(f["daily_bars"], f["instruments"], limits.silent_days, limits.least_span), F.col("severity"), "survivorship", F.col("symbol"))),
    "labels": ("trading_status", ("instruments", "trading_status"), lambda f, day, _: _each(F.concat(F.lit("labels:"), "side"), quality.st_label_check(f["instruments"], f["trading_status"], day), F.lit("warning"), F.col("symbol"))),
    "authority_labels": ("trading_status", ("instruments", "trading_status"), lambda f, day, _: _each(F.lit("authority_labels"), quality.authority_labels(f["trading_status"], f["instruments"], day), F.col("severity"), n=F.greatest(F.lit(1), F.col("n_status_only") + F.col("n_name_only")))),
    "volume_unit": ("daily_bars", ("bars_by_source",), lambda f, day, limits: _told(quality.volume_unit(f["bars_by_source"], *limits.volume_band).where("outside"), "error", "volume_unit", F.col("source"))),
    "close_crosscheck": ("daily_bars", ("daily_bars", "other_bars"), lambda f, day, _: _each(F.lit("close_crosscheck"), quality.close_crosscheck(f["daily_bars"], f["other_bars"], day), F.col("severity"), n=F.col("n_off"))),
    "exchange_compare": ("daily_bars", ("official_bars", "daily_bars"), lambda f, day, _: _told(quality.exchange_compare(f["official_bars"], f["daily_bars"]).where("severity <> 'none'"), F.col("severity"), "exchange_compare", F.col("trade_date"))),
    "minute_session": ("minute_bars", ("minute_bars",), lambda f, day, limits: _told(quality.off_session(f["minute_bars"], "bar_time", limits.minute_spans), "warning", "minute_off_session", F.col("symbol"), F.col("n"))),
    "minute_dates": ("minute_bars", ("minute_bars",), lambda f, day, _: _told(quality.date_mismatch(f["minute_bars"], "bar_time"), "error", "minute_date_mismatch", F.col("trade_date"), F.col("n"))),
    "minute_coverage": ("minute_bars", ("minute_bars",), lambda f, day, limits: _told(quality.session_coverage(f["minute_bars"], limits.minutes).where("alert"), "warning", "minute_session_coverage", n=F.col("n_short"))),
    "minute_sums": ("minute_bars", ("minute_bars", "daily_bars"), _sums("minute_bars", "minute_reconcile", "minute_bands")),
    "tick_sequence": ("trade_ticks", ("trade_ticks",), lambda f, day, _: _told(quality.seq_gaps(f["trade_ticks"]), "error", "tick_seq_gaps", F.col("symbol"))),
    "tick_session": ("trade_ticks", ("trade_ticks",), lambda f, day, limits: _told(quality.off_session(f["trade_ticks"], "trade_time", limits.tick_spans), "warning", "tick_off_session", F.col("symbol"), F.col("n"))),
    "tick_dates": ("trade_ticks", ("trade_ticks",), lambda f, day, _: _told(quality.date_mismatch(f["trade_ticks"], "trade_time"), "error", "tick_date_mismatch", F.col("trade_date"), F.col("n"))),
    "tick_truncation": ("trade_ticks", ("trade_ticks",), lambda f, day, _: _told(quality.truncation(f["trade_ticks"]).where("alert"), "warning", "tick_truncation", n=F.col("n_late"))),
    "tick_direction": ("trade_ticks", ("trade_ticks",), _directions),
    "tick_sums": ("trade_ticks", ("trade_ticks", "daily_bars"), _sums("trade_ticks", "tick_reconcile", "tick_bands")),
    "breadth": ("market_breadth", ("market_breadth",), lambda f, day, _: _told(quality.breadth_days(f["market_breadth"]).where("NOT complete"), "error", "breadth_incomplete", F.col("trade_date"))),
    "index_groups": ("industry_index", ("industry_index",), lambda f, day, _: _told(quality.index_check(f["industry_index"]), "error", "index_groups", F.col("trade_date"))),
    "index_coverage": ("industry_index", ("industry_members", "industry_index"), lambda f, day, _: _told(quality.group_coverage(f["industry_members"], f["industry_index"]), "warning", "index_coverage", F.col("industry_code"))),
    "announced": ("financial_statement_items", ("financial_statement_items",), _announced),
    "macro_age": ("macro_indicators", ("macro_indicators", "macro_limits"), lambda f, day, _: _told(quality.stale(quality.latest_by(f["macro_indicators"], "indicator_id", "obs_date"), "indicator_id", f["macro_limits"], day), "warning", "macro_stale", F.col("indicator_id"))),
}


def findings(frames: dict[str, DataFrame], day: str, only: list[str] | None = None, limits: Limits | None = None) -> DataFrame:
    """``dataset, severity, check, n, details`` of every check (or of ``only`` some) whose frames are there. Bars are canonical."""
    out = [
        run(frames, day, limits or Limits()).select(F.lit(dataset).alias("dataset"), "severity", "check", "n", "details")
        for name, (dataset, needs, run) in CHECKS.items()
        if (only is None or name in only) and all(n in frames for n in needs)
    ]
    if not out:
        raise ValueError("no check has the datasets that it needs")
    return quality.audit_union(out)
