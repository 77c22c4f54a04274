"""Shaping snapshots, gates on completeness, and choosing what to fill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_intervals(intervals: DataFrame, dates: DataFrame, key: str = "symbol") -> DataFrame:
    """Open intervals as snapshots: per date and key the row with the latest start at or before it."""
    j = intervals.join(dates, F.col("start_date") <= F.col("as_of"))  # sent to all tasks only if small: the planner looks at its size
    w = Window.partitionBy("as_of", key).orderBy(F.col("start_date").desc(), *[F.col(c).desc_nulls_last() for c in intervals.columns if c not in (key, "start_date")])
    return j.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def members_in_range(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """Members with start <= date < end (an open end lasts), once each."""
    on = (F.col("start_date") <= F.col("as_of")) & F.coalesce(F.col("as_of") < F.col("end_date"), F.lit(True))
    return intervals.join(dates, on).select("index_code", "symbol", "as_of").distinct()


def statement_unpivot(wide: DataFrame, ids: list[str], items: list[str]) -> DataFrame:
    return wide.unpivot(ids, items, "item_code", "item_value").where("item_value IS NOT NULL")


def announce_dates(reports: DataFrame) -> DataFrame:
    """Earliest disclosure date of each symbol and period."""
    return reports.where("announce_date IS NOT NULL").groupBy("symbol", "report_period").agg(F.min("announce_date").alias("announce_date"))


def borrow_date(rows: DataFrame, twin: DataFrame) -> DataFrame:
    """Null announce dates from the twin filing of symbol and record date (its earliest); rows still undated go."""
    t = twin.where("announce_date IS NOT NULL").groupBy("symbol", "record_date").agg(F.min("announce_date").alias("_d"))
    return rows.join(t, ["symbol", "record_date"], "left").withColumn("announce_date", F.coalesce("announce_date", "_d")).drop("_d").where("announce_date IS NOT NULL")


def invert_factors(rows: DataFrame) -> DataFrame:
    """A series stored as 1 / f, the last row of a date. A value that is not positive and finite is an error, raised as the rows are read."""
    f = F.col("factor")
    bad = F.coalesce(~((f > 0) & (f < float("inf"))), F.lit(True))
    text = F.concat(F.lit("no factor of "), F.coalesce("symbol", F.lit("?")), F.lit(" on "), F.coalesce(F.col("trade_date").cast("string"), F.lit("?")), F.lit(": "), F.coalesce(f.cast("string"), F.lit("null")))
    return rows.withColumn("factor", F.when(bad, F.raise_error(text).cast("double")).otherwise(F.try_divide(F.lit(1.0), f)))


def gate_membership(rows: DataFrame, group: list[str], least: int, distinct: list[str] = ()) -> DataFrame:
    """Groups with their member and value counts, and whether each reaches ``least`` members."""
    g = rows.groupBy(*group).agg(F.count_distinct("symbol").alias("n_members"), *[F.count_distinct(c).alias(f"n_{c}") for c in distinct])
    return g.withColumn("passed", F.col("n_members") >= least)


def drop_thin(rows: DataFrame, group: list[str], least: int) -> DataFrame:
    thin = gate_membership(rows, group, least).where("NOT passed")
    return rows.join(thin, group, "left_anti")


def gate_legs(rows: DataFrame, date_col: str, channel: str, expected: list[str], floor: int, leg_floor: int) -> DataFrame:
    """Per date: all rows over a floor, and every expected channel there and over its own."""
    g = rows.groupBy(date_col).agg(F.count("*").alias("n"), *[F.count_if(F.col(channel) == c).alias(f"n_{c}") for c in expected])
    ok = F.col("n") >= floor
    for c in expected:
        ok &= F.col(f"n_{c}") >= leg_floor
    return g.withColumn("passed", ok)


def gate_floor(rows: DataFrame, period: str, key: list[str], least: int) -> DataFrame:
    """Distinct keys per period over a floor."""
    return rows.groupBy(period).agg(F.count_distinct(*key).alias("n")).withColumn("passed", F.col("n") >= least)


def missing_keys(rows: DataFrame, symbols: DataFrame, days: DataFrame) -> DataFrame:
    """Expected symbol and session pairs that are absent. symbols are a short list of indexes, days a window."""
    want = symbols.select("symbol").distinct().join(F.broadcast(days.select("trade_date").distinct()))
    return want.join(rows, ["symbol", "trade_date"], "left_anti")


def families(rows: DataFrame, period: str, family: str, expected: list[str], periods: DataFrame | None = None) -> DataFrame:
    """Periods and how many of the expected statement families they lack. periods: those that must be there; one without any row lacks all."""
    g = rows.groupBy(period).agg(F.collect_set(family).alias("_f"))  # at most the known families
    if periods is not None:
        g = periods.select(period).distinct().join(g, period, "left")
    have = F.coalesce("_f", F.array().cast("array<string>"))
    return g.select(period, F.size(F.array_except(F.array(*map(F.lit, expected)), have)).alias("n_missing")).where("n_missing > 0")


def complete_memberships(rows: DataFrame, date_col: str, group: str, required: list[str], least: int) -> DataFrame:
    """Snapshot dates on which every required group has at least ``least`` distinct members."""
    g = rows.where(F.col(group).isin(required)).groupBy(date_col, group).agg(F.count_distinct("symbol").alias("n"))
    days = g.groupBy(date_col).agg(F.count("*").alias("_g"), F.min("n").alias("least_members"))
    return days.where((F.col("_g") == len(set(required))) & (F.col("least_members") >= least)).select(date_col, "least_members")


def complete_dates(rows: DataFrame, date_col: str, least: int) -> DataFrame:
    return rows.groupBy(date_col).agg(F.count_distinct("symbol").alias("n")).where(F.col("n") >= least)


def backfill_needed(rows: DataFrame, master: DataFrame, fields: list[str], end: str, least: float) -> DataFrame:
    """Symbols whose fields are filled for too few rows, or whose last date is short of the end of their life."""
    g = rows.groupBy("symbol").agg(F.max("trade_date").alias("last"), F.least(*[F.count(f) for f in fields]).alias("filled"), F.count("*").alias("n"))
    j = master.select("symbol", "delist_date").join(g, "symbol", "left")
    want = F.least(F.lit(end).cast("date"), F.coalesce("delist_date", F.lit(end).cast("date")))
    return j.where(F.col("last").isNull() | (F.col("filled") < least * F.col("n")) | (F.col("last") < want)).select("symbol")


def top_or_latest(rows: DataFrame, day: str, rank_col: str, n: int) -> DataFrame:
    """The first n of a day's ranking, or of the latest earlier day that has one."""
    at = rows.where(F.col("trade_date") <= F.lit(day).cast("date")).agg(F.max("trade_date").alias("trade_date"))
    return rows.join(F.broadcast(at), "trade_date").orderBy(rank_col, "symbol").limit(n).select("symbol")


def candidates(lists: list[DataFrame], n: int) -> DataFrame:
    """The first n distinct symbols of several ranked lists (symbol, pos), in order of the lists."""
    both = None
    for k, part in enumerate(lists):
        part = part.select("symbol", F.lit(k).alias("priority"), F.col("pos").cast("long").alias("pos"))
        both = part if both is None else both.unionByName(part)
    first = both.groupBy("symbol").agg(F.min(F.struct("priority", "pos")).alias("k"))
    return first.orderBy("k", "symbol").limit(n).select("symbol")


def prior_factor(factors: DataFrame, before: str, days: int = 35) -> DataFrame:
    d = F.lit(before).cast("date")
    return factors.where((F.col("trade_date") < d) & (F.col("trade_date") >= F.date_sub(d, days))).groupBy("symbol").agg(F.max_by("factor", "trade_date").alias("factor"))


def new_listings(master: DataFrame, day: str) -> DataFrame:
    return master.where(F.col("list_date") == F.lit(day).cast("date")).select("symbol").distinct()


def latest_boards(members: DataFrame, code: str = "industry_code") -> DataFrame:
    """Codes of the latest snapshot."""
    last = members.agg(F.max("as_of_date").alias("as_of_date"))
    return members.join(F.broadcast(last), "as_of_date").select(code).distinct()  # one row


def complete_snapshots(members: DataFrame, least: int) -> DataFrame:
    """Snapshot dates with at least ``least`` members."""
    return members.groupBy("as_of_date").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("as_of_date")


def recovered(master: DataFrame, spans: DataFrame) -> DataFrame:
    """The master with names appended that only the bars know; null dates from their spans."""
    j = master.select("symbol", "list_date", "delist_date").withColumn("_m", F.lit(True)).join(spans, "symbol", "full_outer")
    return j.select("symbol", F.coalesce("list_date", "first_date").alias("list_date"), F.when(F.col("_m"), F.col("delist_date")).otherwise(F.col("last_date")).alias("delist_date"), F.col("_m").isNull().alias("recovered"))


def retired_orphans(bars: DataFrame, master: DataFrame, day: str, silent: int = 180, alive: int = 5) -> DataFrame:
    """Symbols without a delisting date that have not traded for long and have no run of placeholder rows since."""
    g = bars.groupBy("symbol").agg(F.max(F.when(F.col("volume") > 0, F.col("trade_date"))).alias("last"))
    after = bars.join(g, "symbol").where("trade_date > last").groupBy("symbol").agg(F.count("*").alias("n_after"))
    j = g.join(after, "symbol", "left").join(master.where("delist_date IS NOT NULL"), "symbol", "left_anti")
    return j.where((F.datediff(F.lit(day).cast("date"), F.col("last")) > silent) & (F.coalesce("n_after", F.lit(0)) < alive)).select("symbol", "last")
