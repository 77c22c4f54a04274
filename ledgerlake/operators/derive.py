"""Derived datasets, for all dates at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import symbols as S
from . import asof

def by_date():
    return Window.partitionBy("symbol").orderBy("trade_date")


def align_factors(bars: DataFrame, events: DataFrame) -> DataFrame:
    """One factor per bar date: the latest step at or before it, 1 before the first."""
    days = bars.select("symbol", "trade_date").distinct()
    return asof.backward(days, events, ["symbol"], "trade_date", "factor").withColumn("factor", F.coalesce("factor", F.lit(1.0)))


def missing_factor_keys(bars: DataFrame, factors: DataFrame, day: str) -> DataFrame:
    return bars.where(F.col("trade_date") == F.lit(day).cast("date")).select("symbol", "trade_date").distinct().join(factors, ["symbol", "trade_date"], "left_anti")


def bars_to_derive(bars: DataFrame, factors: DataFrame, watermark: str, refreshed: DataFrame) -> DataFrame:
    """Keys to compute: dates after the watermark, keys without factor on it, and all of refreshed symbols."""
    keys, mark = bars.select("symbol", "trade_date"), F.lit(watermark).cast("date")
    return keys.where(F.col("trade_date") > mark).unionByName(missing_factor_keys(bars, factors, watermark)).unionByName(keys.join(refreshed.select("symbol"), "symbol", "left_semi")).distinct()


def uncovered_symbols(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Symbols whose factors start after their bars, or reach the end on fewer days."""
    span = lambda df, p: df.groupBy("symbol").agg(F.min("trade_date").alias(f"{p}_first"), F.max("trade_date").alias(f"{p}_last"), F.count_distinct("trade_date").alias(f"{p}_days"))
    both = span(bars, "bar").join(span(factors, "factor"), "symbol", "left")
    return both.where("factor_first IS NULL OR factor_first > bar_first OR (factor_last >= bar_last AND factor_days < bar_days)").select("symbol")


def action_terms(actions: DataFrame) -> DataFrame:
    """Per symbol and ex-date: sums of cash, bonus, transfer and allotment ratios, and of allotment cash."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return actions.groupBy("symbol", "ex_date").agg(
        F.sum(zero("cash_dividend")).alias("cash"), F.sum(zero("bonus_ratio")).alias("bonus"), F.sum(zero("transfer_ratio")).alias("transfer"),
        F.sum(zero("allotment_ratio")).alias("allotment"), F.sum(zero(F.col("allotment_ratio") * F.col("allotment_price"))).alias("allotment_cash"),
    )


def factor_crosscheck(bars: DataFrame, factors: DataFrame, actions: DataFrame, tolerance_bps: float = 50) -> DataFrame:
    """Stored factor steps on ex-dates against the step that the action's terms imply; beyond tolerance, the worst per symbol.

    Returns symbol, n_days, worst_bps, worst_date.
    """
    steps = bars.select("symbol", "trade_date", "close").join(factors.select("symbol", "trade_date", "factor"), ["symbol", "trade_date"])
    steps = steps.select("symbol", "trade_date", F.lag("close").over(by_date()).alias("p"), F.try_divide("factor", F.lag("factor").over(by_date())).alias("step"))
    t = action_terms(actions).withColumnRenamed("ex_date", "trade_date")
    reference = F.try_divide(F.col("p") - F.col("cash") + F.col("allotment_cash"), F.lit(1) + F.col("bonus") + F.col("transfer") + F.col("allotment"))
    expected = F.try_divide(F.col("p"), reference)
    gap = steps.join(t, ["symbol", "trade_date"]).where(reference > 0).withColumn("bps", F.abs(F.try_divide(F.col("step"), expected) - 1) * 10000)
    return gap.where(F.col("bps") > tolerance_bps).groupBy("symbol").agg(F.count("*").alias("n_days"), F.max("bps").alias("worst_bps"), F.max_by("trade_date", F.struct("bps", "trade_date")).alias("worst_date"))


def degenerate_action(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Ex-dates whose implied reference price is not positive: the first per symbol, and how many."""
    prior = bars.select("symbol", F.col("trade_date").alias("ex_date"), F.lag("close").over(by_date()).alias("p"))
    bad = prior.join(action_terms(actions), ["symbol", "ex_date"]).where("p - cash + allotment_cash <= 0")
    return bad.groupBy("symbol").agg(F.count("*").alias("n_days"), F.min("ex_date").alias("first_date"))


def factor_continuity(factors: DataFrame, most: float = 20) -> DataFrame:
    """Factor series that jump by more than ``most`` either way: the worst step per symbol."""
    r = F.try_divide("factor", F.lag("factor").over(by_date()))
    rows = factors.withColumn("jump", F.greatest(r, F.try_divide(F.lit(1.0), r))).where(F.col("jump") > most)
    return rows.groupBy("symbol").agg(F.max("jump").alias("worst"), F.max_by("trade_date", F.struct("jump", "trade_date")).alias("worst_date"))


def successors(calendar: DataFrame) -> DataFrame:
    """Each session with the session before it. A calendar is some hundred rows a year."""
    return calendar.where("is_trading").select("trade_date", F.lag("trade_date").over(Window.partitionBy(F.lit(1)).orderBy("trade_date")).alias("prior_date"))


def market_breadth(bars: DataFrame, calendar: DataFrame, status: DataFrame) -> DataFrame:
    """Seven metrics a day in long form: advancing, declining, flat, at the upper and lower limit, their ratio, and all.

    bars are canonical. A name counts if it traded that day and in the session before, with a positive close then. Days with
    bars but no such name give zero rows; days without a session before give none.
    """
    now = bars.where("volume > 0").select("symbol", "trade_date", "close")
    days = now.select("trade_date").distinct().join(F.broadcast(successors(calendar)), "trade_date").where("prior_date IS NOT NULL")
    warn = status.select("symbol", "trade_date", F.coalesce("risk_warning", F.lit(False)).alias("warned"))
    before = now.select("symbol", F.col("trade_date").alias("prior_date"), F.col("close").alias("prior")).where("prior > 0")
    both = now.join(F.broadcast(days), "trade_date").join(before, ["symbol", "prior_date"]).join(warn, ["symbol", "trade_date"], "left")
    ret = F.col("close") / F.col("prior") - 1
    limit = S.limit_threshold(F.col("symbol"), F.coalesce("warned", F.lit(False)))
    up, down = F.count_if(ret > 0), F.count_if(ret < 0)
    agg = both.groupBy("trade_date").agg(up.alias("advance"), down.alias("decline"), F.count_if(ret == 0).alias("flat"), F.count_if(ret >= limit).alias("limit_up"), F.count_if(ret <= -limit).alias("limit_down"), F.count("*").alias("total"))
    names = ["advance", "decline", "flat", "limit_up", "limit_down", "total"]
    wide = days.select("trade_date").join(agg, "trade_date", "left").select("trade_date", *[F.coalesce(n, F.lit(0)).cast("double").alias(n) for n in names])
    wide = wide.withColumn("advance_ratio", F.coalesce(F.try_divide("advance", "total"), F.lit(0.0)))
    return wide.unpivot(["trade_date"], [*names, "advance_ratio"], "metric_id", "value")


def hfq_returns(adjusted: DataFrame, calendar: DataFrame) -> DataFrame:
    """Returns of exact, traded rows between adjacent sessions; amounts under 1 count as unknown."""
    rows = adjusted.where("adj_is_exact AND volume > 0").withColumns({"_p": F.lag("adj_close").over(by_date()), "_d": F.lag("trade_date").over(by_date())})
    out = rows.join(F.broadcast(successors(calendar)), "trade_date").where(F.col("_d") == F.col("prior_date"))
    return out.select("symbol", "trade_date", (F.try_divide("adj_close", "_p") - 1).alias("ret"), F.when(F.col("amount") >= 1, F.col("amount")).alias("amount")).where("ret IS NOT NULL")


def members_as_of(members: DataFrame, days: DataFrame) -> DataFrame:
    """Membership of each day: the latest snapshot at or before it."""
    at = asof.latest_dates(days, members, "trade_date", "as_of_date")
    return members.join(F.broadcast(at), "as_of_date").select("trade_date", "symbol", "industry_code", "as_of_date")


def industry_index(returns: DataFrame, members: DataFrame, levels=(2, 4, 6)) -> DataFrame:
    """Per day, code prefix and weighting: mean and amount-weighted return, and member counts.

    Starts from membership, so groups without a priced member stay, with a null return.
    """
    names = F.array(*[F.struct(F.lit(str(n)).alias("level"), F.substring("industry_code", 1, n).alias("code")) for n in levels])
    days = returns.select("trade_date").distinct()
    rows = members_as_of(members, days).join(returns, ["trade_date", "symbol"], "left").select("trade_date", "symbol", "ret", "amount", F.explode(names).alias("g"))
    known = F.col("ret").isNotNull() & F.col("amount").isNotNull()
    weighted = F.try_divide(F.sum(F.when(known, F.col("ret") * F.col("amount"))), F.sum(F.when(known, F.col("amount"))))
    agg = rows.groupBy("trade_date", F.col("g.code").alias("industry_code"), F.col("g.level").alias("level")).agg(
        F.avg("ret").alias("equal"), weighted.alias("by_amount"), F.count("*").alias("n_members"), F.count("ret").alias("n_priced"), F.coalesce(F.sum(F.when(F.col("ret").isNotNull(), F.col("amount"))), F.lit(0.0)).alias("amount"))
    out = agg.withColumn("n_excluded", F.col("n_members") - F.col("n_priced"))
    return out.unpivot(["trade_date", "industry_code", "level", "n_members", "n_priced", "n_excluded", "amount"], ["equal", "by_amount"], "weighting", "ret")


def lives(bars: DataFrame, master: DataFrame) -> DataFrame:
    """First and last day of each traded symbol: the later of listing and first bar to the earlier of delisting and last bar."""
    span = bars.where("volume > 0").groupBy("symbol").agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("z"))
    return span.join(master.select("symbol", "list_date", "delist_date"), "symbol", "left").select("symbol", F.greatest("a", "list_date").alias("first"), F.least("z", "delist_date").alias("last"))


def suspension_history(bars: DataFrame, master: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sessions within a symbol's life without a traded bar. The calendar is small and broadcast."""
    s = F.broadcast(calendar.where("is_trading").select("trade_date"))
    want = lives(bars, master).join(s, F.col("trade_date").between(F.col("first"), F.col("last"))).select("symbol", "trade_date")
    return want.join(bars.where("volume > 0"), ["symbol", "trade_date"], "left_anti")


def missing_session_keys(bars: DataFrame, master: DataFrame, calendar: DataFrame, status: DataFrame) -> DataFrame:
    """suspension_history less the days that are known not to have traded."""
    from .canonical import not_trading

    return suspension_history(bars, master, calendar).join(status.where(not_trading()), ["symbol", "trade_date"], "left_anti")


def delisted_status_rows(master: DataFrame, calendar: DataFrame) -> DataFrame:
    gone = master.where("delist_date IS NOT NULL").select("symbol", "delist_date")
    days = F.broadcast(calendar.select("trade_date"))
    return gone.join(days, F.col("trade_date") >= F.col("delist_date")).select("symbol", "trade_date", F.lit("delisted").alias("status"), F.lit(False).alias("is_trading"))


def ending_pattern(bars: DataFrame, window: int = 60, least: int = 30, halt: int = 10, drop: float = -0.25, decline: float = -0.4, low: float = 2.0) -> DataFrame:
    """How a series ends, by its last bars: longest calendar gap, worst return, return over the window, last close.

    insufficient: fewer than ``least`` bars in all. consolidation: a halt of more than ``halt`` days and a day worse than ``drop``.
    abrupt_decline: the window lost more than ``decline`` and closed below ``low``. abrupt_stable: all others.
    """
    back = Window.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    rows = bars.withColumn("_k", F.row_number().over(back)).where(F.col("_k") <= window)
    rows = rows.withColumns({"_gap": F.datediff("trade_date", F.lag("trade_date").over(by_date())), "_ret": F.try_divide("close", F.lag("close").over(by_date())) - 1})
    agg = rows.groupBy("symbol").agg(F.count("*").alias("n_bars"), F.max("_gap").alias("longest_gap"), F.min("_ret").alias("worst_return"), (F.try_divide(F.max_by("close", "trade_date"), F.min_by("close", "trade_date")) - 1).alias("window_return"), F.max_by("close", "trade_date").alias("last_close"))
    halted = (F.col("longest_gap") > halt) & (F.col("worst_return") < drop)
    fell = (F.col("window_return") < decline) & (F.col("last_close") < low)
    kind = F.when(F.col("n_bars") < least, "insufficient").when(halted, "consolidation").when(fell, "abrupt_decline").otherwise("abrupt_stable")
    return agg.withColumn("pattern", kind)


def keyword_sentiment(text: Column, lexicon: dict[str, float]) -> Column:
    """(positive - negative) / (positive + negative) of the weights of words that occur; 0 if none does."""
    hit = lambda sign: reduce(lambda a, b: a + b, [F.when(F.contains(text, F.lit(w)), F.lit(abs(v))).otherwise(0.0) for w, v in lexicon.items() if v * sign > 0], F.lit(0.0))
    return F.coalesce(F.try_divide(hit(1) - hit(-1), hit(1) + hit(-1)), F.lit(0.0))


def headline_sentiment(rows: DataFrame, lexicon: dict[str, float], pattern: str = r"^\d+\.[A-Z]{2}$") -> DataFrame:
    """Mean score and count per symbol and day, one row per related symbol (separated by commas or semicolons)."""
    one = rows.select("trade_date", keyword_sentiment(F.col("title"), lexicon).alias("score"), F.explode(F.split("related_symbols", "[,;]")).alias("symbol"))
    one = one.withColumn("symbol", F.upper(F.trim("symbol"))).where(F.col("symbol").rlike(pattern))
    return one.groupBy("symbol", "trade_date").agg(F.avg("score").alias("score"), F.count("*").alias("n"))


def trading_calendar(start: str, end: str, spark, seed: DataFrame, closed: DataFrame, bars: DataFrame) -> DataFrame:
    """One row per calendar day: the seed wins, then the closed list, then a bar; within the bars' era no bar means closed.

    Beyond all of these a weekend is closed, and a weekday before the bars' era is open; one after it is not known: the read fails.
    """
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("trade_date"))
    seen = bars.select("trade_date").distinct().withColumn("_bar", F.lit(True))
    era = bars.agg(F.min("trade_date").alias("_a"), F.max("trade_date").alias("_z"))
    rows = days.join(F.broadcast(seed.select("trade_date", F.col("is_trading").alias("_seed"))), "trade_date", "left").join(F.broadcast(closed.select("trade_date", F.lit(True).alias("_shut"))), "trade_date", "left")
    rows = rows.join(seen, "trade_date", "left").join(F.broadcast(era))  # one row
    open_ = F.when(F.col("_seed").isNotNull(), F.col("_seed")).when(F.col("_shut"), False).when(F.col("_bar"), True).when(F.col("trade_date").between(F.col("_a"), F.col("_z")), False).when(F.weekday("trade_date") >= 5, False).when(F.col("trade_date") < F.col("_a"), True)
    open_ = open_.otherwise(F.raise_error(F.concat(F.lit("no evidence whether a session is held on "), F.col("trade_date").cast("string"))).cast("boolean"))
    return rows.select("trade_date", open_.alias("is_trading"))


def sessions(calendar: DataFrame, start: str, end: str) -> DataFrame:
    """The trading days of a window."""
    return calendar.where(F.col("is_trading") & F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("trade_date")


def event_symbols(actions: DataFrame, master: DataFrame, day: str) -> DataFrame:
    """Names with an ex-date on a day or listed on it: those whose factors may move."""
    d = F.lit(day).cast("date")
    return actions.where(F.col("ex_date") == d).select("symbol").unionByName(master.where(F.col("list_date") == d).select("symbol")).distinct()


def gapfill(primary: DataFrame, backup: DataFrame, key: list[str]) -> DataFrame:
    """Primary rows, and backup rows for keys that it lacks."""
    return primary.unionByName(backup.join(primary, key, "left_anti").select(*primary.columns))


def amount_supplement(bars: DataFrame, other: DataFrame) -> DataFrame:
    """Null amounts from a second source, where all prices and the volume agree."""
    cols = ["open", "high", "low", "close", "volume"]
    o = other.select("symbol", "trade_date", F.struct(*cols).alias("_o"), F.col("amount").alias("_amount"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_o.{c}") for c in cols])
    fill = F.when(F.col("amount").isNull() & F.coalesce(same, F.lit(False)), F.col("_amount")).otherwise(F.col("amount"))
    return bars.join(o, ["symbol", "trade_date"], "left").withColumn("amount", fill).select(*bars.columns)


def amount_mismatches(bars: DataFrame, other: DataFrame) -> DataFrame:
    """Keys whose amount is missing and stays so, as the second source, which has one, differs in a price or in the volume."""
    cols = ["open", "high", "low", "close", "volume"]
    o = other.where("amount IS NOT NULL").select("symbol", "trade_date", *[F.col(c).alias(f"_{c}") for c in cols])
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in cols])
    return bars.where("amount IS NULL").join(o, ["symbol", "trade_date"]).where(~F.coalesce(same, F.lit(False))).select("symbol", "trade_date")


def incremental_window(calendar: DataFrame, day: str, sessions: int = 0, mark: str | None = None) -> DataFrame:
    """First and last day to read again: from the n-th last session up to a day, or from the day after a mark."""
    if mark:
        return calendar.limit(1).select(F.date_add(F.lit(mark).cast("date"), 1).alias("start"), F.lit(day).cast("date").alias("end")).where("start <= end")
    back = calendar.where(F.col("is_trading") & (F.col("trade_date") <= F.lit(day).cast("date"))).orderBy(F.col("trade_date").desc()).limit(sessions)
    return back.agg(F.min("trade_date").alias("start"), F.lit(day).cast("date").alias("end"))


def resampled() -> list[Column]:
    """What a longer bar says of its bars: first open, highest high, lowest low, last close, sums of volume and amount, their number."""
    return [F.min_by("open", "bar_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bar_time").alias("close"), F.sum("volume").alias("volume"), F.sum("amount").alias("amount"), F.count("*").alias("n")]


def resample(bars: DataFrame, minutes: int) -> DataFrame:
    """Bars of more minutes; a bar is named by its closing minute, so it belongs to the window of the minute before."""
    w = F.window(F.col("bar_time") - F.expr("INTERVAL 1 MINUTE"), f"{minutes} minutes")
    agg = bars.groupBy("symbol", "trade_date", w.alias("w")).agg(*resampled())
    return agg.withColumn("bar_time", F.col("w.end")).drop("w")


def ticks_to_bars(ticks: DataFrame, minutes: int) -> DataFrame:
    w = F.window("trade_time", f"{minutes} minutes")
    agg = ticks.groupBy("symbol", w.alias("w")).agg(F.min_by("price", "tick_seq").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "tick_seq").alias("close"), F.sum("volume").alias("volume"))
    return agg.withColumn("bar_time", F.col("w.end")).drop("w")


def touched_days(changed: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days whose derived rows change with some days' bars: themselves, and the session after each, whose returns start from them."""
    days = changed.select("trade_date").distinct()
    after = successors(calendar).join(days.withColumnRenamed("trade_date", "prior_date"), "prior_date", "left_semi").select("trade_date")
    return days.unionByName(after).distinct()


def _needed(rows: DataFrame, days: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows of some days and of the session before each: all that their returns need."""
    before = successors(calendar).join(days, "trade_date", "left_semi").where("prior_date IS NOT NULL").select(F.col("prior_date").alias("trade_date"))
    return rows.join(days.unionByName(before).distinct(), "trade_date", "left_semi")


def breadth_of(days: DataFrame, bars: DataFrame, calendar: DataFrame, status: DataFrame) -> DataFrame:
    """market_breadth() of some days alone; bars and status of other days are not computed with."""
    return market_breadth(_needed(bars, days, calendar), calendar, status.join(days, "trade_date", "left_semi")).join(days, "trade_date", "left_semi")


def index_of(days: DataFrame, adjusted: DataFrame, calendar: DataFrame, members: DataFrame) -> DataFrame:
    """industry_index() of some days alone."""
    returns = hfq_returns(_needed(adjusted, days, calendar), calendar)
    return industry_index(returns.join(days, "trade_date", "left_semi"), members)


def factors_of(keys: DataFrame, events: DataFrame) -> DataFrame:
    """align_factors() of some keys (symbol, trade_date) alone; events of other symbols are not computed with."""
    return align_factors(keys, events.join(keys, "symbol", "left_semi"))
