"""Data-quality operators: each returns rows of findings or per-group figures. Thresholds are arguments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods
from . import canonical, derive, stats

FINDING = ("dataset", "severity", "check", "n", "details")


def finding(rows: DataFrame, dataset: str, severity: str, check: str, details: Column | None = None) -> DataFrame:
    """One finding with the count of ``rows``, or none if there is no row."""
    return rows.agg(F.count("*").alias("n"), F.max(details if details is not None else F.lit(None).cast("string")).alias("details")).where("n > 0").select(F.lit(dataset).alias("dataset"), F.lit(severity).alias("severity"), F.lit(check).alias("check"), "n", "details")


def audit_union(findings: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), findings)


def lake_health(findings: DataFrame, marks: DataFrame | None = None, day: str | None = None) -> DataFrame:
    """Findings by severity, the datasets that are stale on a day and those that are empty, and whether there is no error.

    marks: dataset, watermark, tolerance_days, n_rows, retired. A registry's datasets are some dozens.
    """
    by = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("n"))), F.lit(0)).alias(f"n_{s}")
    told = findings.agg(by("error"), by("warning"), by("info"), (F.count_if(F.col("severity") == "error") == 0).alias("healthy"))
    if marks is None:
        return told
    empty = F.coalesce(F.col("n_rows"), F.lit(0)) == 0
    late = ~empty & stats.stale_by(F.lit(day).cast("date"), F.col("watermark"), F.col("tolerance_days"), F.coalesce("retired", F.lit(False)))
    names = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("dataset"))))
    return told.join(F.broadcast(marks.agg(names(late).alias("stale"), names(empty).alias("empty"))))  # one row


def pk_duplicates(rows: DataFrame, key: list[str], partition: str | None = None) -> DataFrame:
    """Rows beyond the first of each key: in all, or per partition value."""
    by = [partition] if partition else []
    extra = rows.groupBy(*by, *[k for k in key if k not in by]).count().where("count > 1")
    return extra.groupBy(*by).agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_duplicates"), F.count("*").alias("n_keys"))


def scalar_stats(rows: DataFrame, required: list[str], mock: str = "mock") -> DataFrame:
    """Rows, mock rows and nulls of required columns in one pass."""
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col("source") == mock).alias("n_mock"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required])


def required_nulls(rows: DataFrame, required: list[str]) -> DataFrame:
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).unpivot([], required, "column", "n")


def row_mutation(rows: DataFrame, date_col: str, period: str, least: int = 50, share: float = 0.5, today: str | None = None) -> DataFrame:
    """Periods with under ``share`` of the rows or symbols of the period before, where that had at least ``least`` rows.

    The rows of the period that ``today`` lies in are held against the share of it that has passed; symbols are not.
    """
    agg = stats.period_counts(rows, date_col, period)
    w = Window.partitionBy(F.lit(1)).orderBy("period")  # one row a period
    agg = agg.withColumns({"prior_rows": F.lag("n_rows").over(w), "prior_symbols": F.lag("n_symbols").over(w)})
    passed = F.lit(1.0)
    if today:
        d, a, z = F.lit(today).cast("date"), periods.start(F.col("period")), periods.end(F.col("period"))
        passed = F.when((d >= a) & (d < z), F.try_divide(F.datediff(d, a) + 1, F.datediff(z, a) + 1)).otherwise(1.0)
    agg = agg.withColumn("elapsed", passed)
    short = (F.col("n_rows") < share * F.col("prior_rows") * F.col("elapsed")) | (F.col("n_symbols") < share * F.col("prior_symbols"))
    return agg.where((F.col("prior_rows") >= least) & short)


def fragmentation(rows: DataFrame, date_col: str, period: str) -> DataFrame:
    one = rows.groupBy(periods.first_day(F.col(date_col), period).alias("period")).count()
    return one.agg(F.sum("count").alias("n_rows"), F.count("*").alias("n_partitions"), F.try_divide(F.sum("count"), F.count("*")).alias("rows_per_partition"))


def calendar_reconcile(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """Bar dates that are no session, and sessions within the traded span without a traded bar."""
    days, sessions = bars.select("trade_date").distinct(), calendar.where("is_trading").select("trade_date")
    live = canonical.traded(bars)
    span = live.agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("z"))
    odd = days.join(sessions, "trade_date", "left_anti").select("trade_date", F.lit("not_a_session").alias("check"))
    gone = sessions.join(F.broadcast(span), F.col("trade_date").between(F.col("a"), F.col("z"))).select("trade_date").join(live, "trade_date", "left_anti")
    return odd.unionByName(gone.select("trade_date", F.lit("session_without_bar").alias("check")))


def coverage_by_series(bars: DataFrame, calendar: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Sessions missing within each series' own span: ``symbol, n_missing, n_known, first_missing``.

    known (symbol, trade_date): gaps that are accounted for are counted apart, and are not the first one missing.
    """
    span = bars.groupBy("symbol").agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("z"))
    want = span.join(F.broadcast(calendar.where("is_trading").select("trade_date")), F.col("trade_date").between(F.col("a"), F.col("z"))).select("symbol", "trade_date")
    gaps = want.join(bars, ["symbol", "trade_date"], "left_anti")
    gaps = gaps.withColumn("_k", F.lit(None).cast("boolean")) if known is None else gaps.join(known.select("symbol", "trade_date", F.lit(True).alias("_k")), ["symbol", "trade_date"], "left")
    return gaps.groupBy("symbol").agg(F.count_if(F.col("_k").isNull()).alias("n_missing"), F.count("_k").alias("n_known"), F.min(F.when(F.col("_k").isNull(), F.col("trade_date"))).alias("first_missing"))


def coverage_ratio(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Per day, share of the whole's symbols that the part has."""
    return whole.select("trade_date", "symbol").distinct().join(part.select("trade_date", "symbol").distinct().withColumn("_in", F.lit(True)), ["trade_date", "symbol"], "left").groupBy("trade_date").agg(F.count("*").alias("n"), (F.count("_in") / F.count("*")).alias("ratio"))


def last_dense(part: DataFrame, whole: DataFrame, least: float = 0.7) -> DataFrame:
    return coverage_ratio(part, whole).where(F.col("ratio") >= least).agg(F.max("trade_date").alias("trade_date"))


def orphans(rows: DataFrame, bars: DataFrame) -> DataFrame:
    """Symbols without any bar."""
    return rows.select("symbol").distinct().join(bars, "symbol", "left_anti")


def adjusted_returns(adjusted: DataFrame) -> DataFrame:
    """Adjusted and raw return of consecutive bars, and how far they differ."""
    lag = lambda c: F.try_divide(F.col(c), F.lag(c).over(derive.by_date())) - 1
    out = adjusted.select("symbol", "trade_date", F.lag("trade_date").over(derive.by_date()).alias("prior_date"), lag("close").alias("raw"), lag("adj_close").alias("adj"))
    return out.where("raw IS NOT NULL").withColumn("divergence", F.abs(F.col("adj") - F.col("raw")))


def adj_reconcile(adjusted: DataFrame, calendar: DataFrame, actions: DataFrame, jump: float = 0.35, calm: float = 0.15, apart: float = 0.11, restructured: DataFrame | None = None, master: DataFrame | None = None, most: int = 50) -> DataFrame:
    """``severity, check, symbol, trade_date, n``: adjusted moves that the raw ones contradict.

    adjusted_jump (error): a large adjusted move that differs as much from the raw one, between adjacent sessions. unexplained (warning):
    a calm adjusted move that differs without an ex-date after the bar before. restructured (symbol, change_date): share restructurings
    explain a move as an ex-date does, and are listed as info. master: names that it delists are set apart as info too. Of each check
    the ``most`` largest divergences are listed, and one row without a symbol counts the rest.
    """
    r = adjusted_returns(adjusted)
    s = F.broadcast(derive.successors(calendar).withColumnRenamed("prior_date", "session_before"))
    error = r.join(s, "trade_date").where((F.col("prior_date") == F.col("session_before")) & (F.abs("adj") > jump) & (F.col("divergence") > jump))
    calm_ = r.where((F.abs("adj") <= calm) & (F.col("divergence") > apart)).alias("r")

    def explained(by: DataFrame, day: str, how: str) -> DataFrame:
        x = by.select("symbol", F.col(day).alias("_day")).distinct().alias("x")
        return calm_.join(x, (F.col("r.symbol") == F.col("x.symbol")) & (F.col("x._day") > F.col("r.prior_date")) & (F.col("x._day") <= F.col("r.trade_date")), how)

    calm_ = explained(actions, "ex_date", "left_anti").alias("r")
    kinds = [error.withColumns({"severity": F.lit("error"), "check": F.lit("adjusted_jump")})]
    if restructured is not None:
        kinds.append(explained(restructured, "change_date", "left_semi").withColumns({"severity": F.lit("info"), "check": F.lit("restructured")}))
        calm_ = explained(restructured, "change_date", "left_anti").alias("r")
    kinds.append(calm_.withColumns({"severity": F.lit("warning"), "check": F.lit("unexplained")}))
    found = audit_union([k.select("severity", "check", "symbol", "trade_date", "divergence") for k in kinds])
    if master is not None:
        gone = master.where("delist_date IS NOT NULL").select("symbol", F.lit(True).alias("_gone"))
        found = found.join(gone, "symbol", "left").withColumns({"severity": F.when(F.col("_gone"), "info").otherwise(F.col("severity")), "check": F.when(F.col("_gone"), F.concat("check", F.lit(":delisted"))).otherwise(F.col("check"))}).drop("_gone")
    rank = F.row_number().over(Window.partitionBy("severity", "check").orderBy(F.col("divergence").desc(), "symbol", "trade_date"))
    ranked = found.withColumn("_n", rank)
    shown = ranked.where(F.col("_n") <= most).select("severity", "check", "symbol", "trade_date", F.lit(1).cast("long").alias("n"))
    rest = found.groupBy("severity", "check").agg((F.count("*") - most).alias("n")).where("n > 0")
    return shown.unionByName(rest.select("severity", F.concat("check", F.lit(":more")).alias("check"), F.lit(None).cast("string").alias("symbol"), F.lit(None).cast("date").alias("trade_date"), "n"))


def adj_coverage(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Per exchange, share of symbols whose factor days cover all bar days."""
    from ..functions import symbols as S

    has = bars.select("symbol", "trade_date").join(factors.select("symbol", "trade_date", F.lit(True).alias("_f")), ["symbol", "trade_date"], "left")
    one = has.groupBy("symbol").agg(F.count_if(F.col("_f").isNull()).alias("missing"))
    return one.groupBy(S.exchange(F.col("symbol")).alias("exchange")).agg(F.count("*").alias("n"), F.count_if(F.col("missing") == 0).alias("n_covered"), F.sum("missing").alias("n_missing"))


def bar_spans(bars: DataFrame, positive_only: bool = True) -> DataFrame:
    rows = bars.where("volume > 0") if positive_only else bars
    return rows.groupBy("symbol").agg(F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))


def survivorship_check(bars: DataFrame, master: DataFrame, silent: int = 180, least_span: int = 730) -> DataFrame:
    """``symbol, last_date, severity``: names of stocks that fell silent without a delisting date are warnings.

    Silent: no bar for more than ``silent`` days before the last bar of all. Where all bars span at least ``least_span``
    days and no name is silent, the lake holds survivors only: one error without a symbol. A shorter span says nothing.
    """
    stocks = master.where("asset_type = 'stock'").select("symbol", "delist_date")
    spans = bar_spans(bars).join(stocks, "symbol")
    whole = spans.agg(F.min("first_date").alias("_a"), F.max("last_date").alias("_z")).where(F.datediff("_z", "_a") >= least_span)
    quiet = spans.join(F.broadcast(whole)).where(F.datediff("_z", "last_date") > silent)  # one row
    none = whole.join(quiet.agg(F.count("*").alias("_n"))).where("_n = 0").select(F.lit(None).cast("string").alias("symbol"), F.col("_z").alias("last_date"), F.lit("error").alias("severity"))
    return quiet.where("delist_date IS NULL").select("symbol", "last_date", F.lit("warning").alias("severity")).unionByName(none)


def liquid_symbols(bars: DataFrame, day: str, k: int) -> DataFrame:
    return bars.where(F.col("trade_date") == F.lit(day).cast("date")).orderBy(F.col("amount").desc_nulls_last(), "symbol").limit(k).select("symbol", "amount")


def close_crosscheck(bars: DataFrame, reference: DataFrame, day: str, k: int = 12, gap: float = 0.001) -> DataFrame:
    """Closes of the most liquid names against a second source: names beyond ``gap``, and whether that is systematic."""
    c = liquid_symbols(bars, day, k).select("symbol").join(bars.where(F.col("trade_date") == F.lit(day).cast("date")).select("symbol", "close"), "symbol")
    r = reference.where(F.col("trade_date") == F.lit(day).cast("date")).select("symbol", F.col("close").alias("_r"))
    j = c.join(r, "symbol").where("_r > 0").withColumn("off", F.abs(F.try_divide("close", "_r") - 1) > gap)
    return j.agg(F.count("*").alias("n_compared"), F.count_if("off").alias("n_off")).withColumn("severity", F.when(F.col("n_compared") == 0, "none").when(F.col("n_off") * 2 >= F.col("n_compared"), "error").when(F.col("n_off") > 0, "warning").otherwise("none"))


def st_label_check(master: DataFrame, status: DataFrame, day: str) -> DataFrame:
    """Names that say ST against rows that say so, on one day, among active names: the symmetric difference."""
    d = F.lit(day).cast("date")
    named = active_on(master, day).where(F.upper("name").rlike(r"^\*?ST")).select("symbol")
    rows = status.where((F.col("trade_date") == d) & canonical.risk_warned()).select("symbol").join(active_on(master, day), "symbol", "left_semi").distinct()
    return named.join(rows, "symbol", "left_anti").select("symbol", F.lit("name_only").alias("side")).unionByName(rows.join(named, "symbol", "left_anti").select("symbol", F.lit("status_only").alias("side")))


def active_on(master: DataFrame, day: str) -> DataFrame:
    d = F.lit(day).cast("date")
    return master.where(F.coalesce(F.col("list_date") <= d, F.lit(True)) & F.coalesce(F.col("delist_date") >= d, F.lit(True)))


#: Rank error of medians: one in so many rows. Their sketches merge, so no task holds a source's values.
MEDIAN_ACCURACY = 20_000


def median(value: Column) -> Column:
    return F.percentile_approx(value, 0.5, MEDIAN_ACCURACY)


def volume_unit(bars: DataFrame, low: float = 0.5, high: float = 2.0, least: int = 20) -> DataFrame:
    """Per source, the median of amount / (close * volume) over rows where all three are above 0, and whether it lies
    outside the band; sources with fewer than ``least`` such rows are not judged.
    """
    rows = bars.where("volume > 0 AND amount > 0 AND close > 0")
    r = rows.groupBy("source").agg(median(F.col("amount") / F.col("close") / F.col("volume")).alias("ratio"), F.count("*").alias("n")).where(F.col("n") >= least)
    return r.withColumn("outside", ~F.col("ratio").between(low, high))


def amount_completeness(bars: DataFrame) -> DataFrame:
    return bars.groupBy("source").agg(F.count("*").alias("n"), (F.count_if(F.col("amount").isNull()) / F.count("*")).alias("null_share"))


def clock(ts: str) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def off_session(rows: DataFrame, ts: str, spans: list[tuple[str, str]]) -> DataFrame:
    """Rows per symbol and day outside all spans of the clock (ends included)."""
    inside = reduce(lambda a, b: a | b, [clock(ts).between(a, b) for a, b in spans])
    return rows.where(~inside).groupBy("symbol", "trade_date").agg(F.count("*").alias("n"))


def date_mismatch(rows: DataFrame, ts: str) -> DataFrame:
    return rows.where(F.to_date(ts) != F.col("trade_date")).groupBy("trade_date").agg(F.count("*").alias("n"))


def session_coverage(rows: DataFrame, expected: int, least: float = 0.9, alert: float = 0.2) -> DataFrame:
    """Symbol-days, those with fewer than ``least`` of a session's bars, and whether these are at least the share ``alert``."""
    per = rows.groupBy("symbol", "trade_date").count()
    n = per.agg(F.count("*").alias("n_days"), F.count_if(F.col("count") < expected * least).alias("n_short"))
    return n.withColumn("alert", (F.col("n_short") > 0) & (F.col("n_short") >= alert * F.col("n_days")))


def reconcile(part: DataFrame, daily: DataFrame, bands: dict[str, tuple[float, float]], least: int = 20) -> DataFrame:
    """Intraday sums over the daily figure: median ratio per measure, its band, and a severity (info below ``least`` days)."""
    agg = part.groupBy("symbol", "trade_date").agg(*[F.sum(m).alias(f"_{m}") for m in bands])
    j = agg.join(daily.select("symbol", "trade_date", *bands), ["symbol", "trade_date"])
    med = j.agg(F.count("*").alias("n"), *[median(F.try_divide(f"_{m}", m)).alias(m) for m in bands]).unpivot(["n"], list(bands), "measure", "ratio")
    ok = reduce(lambda a, b: a | b, [(F.col("measure") == m) & F.col("ratio").between(lo, hi) for m, (lo, hi) in bands.items()])
    return med.withColumn("severity", F.when(ok, "none").when(F.col("n") < least, "info").otherwise("warning"))


def seq_gaps(ticks: DataFrame) -> DataFrame:
    """Symbol-days whose sequence is not 0 .. n - 1."""
    g = ticks.groupBy("symbol", "trade_date").agg(F.min("tick_seq").alias("a"), F.max("tick_seq").alias("z"), F.count("*").alias("n"), F.count_distinct("tick_seq").alias("d"))
    return g.where("a <> 0 OR z <> n - 1 OR d <> n").select("symbol", "trade_date", "n")


def truncation(ticks: DataFrame, opening: str = "09:25:00", alert: float = 0.1) -> DataFrame:
    """Symbol-days whose first tick comes after the opening auction, and whether they are at least the share ``alert``."""
    g = ticks.groupBy("symbol", "trade_date").agg(F.min(clock("trade_time")).alias("first"))
    n = g.agg(F.count("*").alias("n_days"), F.count_if(F.col("first") > opening).alias("n_late"))
    return n.withColumn("alert", (F.col("n_late") > 0) & (F.col("n_late") >= alert * F.col("n_days")))


def directions(ticks: DataFrame, buy: str, sell: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Unknown direction codes, the share of buys, and whether that lies outside the band of a market."""
    known = F.coalesce(F.col("direction").isin(buy, sell), F.lit(False))
    n = ticks.agg(F.count_if(~known).alias("n_unknown"), F.try_divide(F.count_if(F.col("direction") == buy), F.count_if(known)).alias("buy_share"))
    return n.withColumn("outside", ~F.col("buy_share").between(low, high))


def calendar_horizon(calendar: DataFrame, day: str) -> DataFrame:
    """How many sessions the calendar knows after a day, and the last of them."""
    return calendar.where(F.col("is_trading") & (F.col("trade_date") > F.lit(day).cast("date"))).agg(F.count("*").alias("n"), F.max("trade_date").alias("last"))


def authority_labels(status: DataFrame, master: DataFrame, day: str, most: int = 3) -> DataFrame:
    """Labels of a day against the names of the master: how many are compared, how many disagree each way, and how bad that is.

    An error if more than ``most`` disagree, a warning if any does; none are compared: info.
    """
    rows = status.where(F.col("trade_date") == F.lit(day).cast("date")).join(master.select("symbol", "name"), "symbol")
    named = F.coalesce(F.upper("name").rlike(r"^\*?ST"), F.lit(False))
    n = rows.agg(F.count("*").alias("n"), F.count_if(canonical.risk_warned() & ~named).alias("n_status_only"), F.count_if(~canonical.risk_warned() & named).alias("n_name_only"))
    off = F.col("n_status_only") + F.col("n_name_only")
    return n.withColumn("severity", F.when(F.col("n") == 0, "info").when(off > most, "error").when(off > 0, "warning").otherwise("none"))


def authority_macro(published: DataFrame, curated: DataFrame, key: str, order: list[str], value: str, apart: float = 0.05) -> DataFrame:
    """The latest published value of each series against the latest curated one: whether they are ``apart``."""
    latest = lambda rows, name: rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(name))
    return latest(published, "published").join(latest(curated, "curated"), key).select(key, (F.abs(F.col("published") - F.col("curated")) > apart).alias("off"))


def complete_derived_days(index: DataFrame, levels: int = 3, weightings: int = 2) -> DataFrame:
    """Days of a derived index that have all levels and weightings."""
    days = index.groupBy("trade_date").agg(F.count_distinct("level").alias("n_levels"), F.count_distinct("weighting").alias("n_weightings"))
    return days.where((F.col("n_levels") == levels) & (F.col("n_weightings") == weightings)).select("trade_date")


def latest_by(rows: DataFrame, key: str, date_col: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max(date_col).alias("latest"))


def stale(latest: DataFrame, key: str, limits: DataFrame, day: str) -> DataFrame:
    """Series that lag beyond their own limit in days."""
    j = latest.join(limits, key)
    return j.withColumn("lag", F.datediff(F.lit(day).cast("date"), F.col("latest"))).where("lag > max_lag").select(key, "latest", "lag")


def revisions(incoming: DataFrame, stored: DataFrame, key: list[str], value: str, material: float = 0.05) -> DataFrame:
    j = incoming.select(*key, F.col(value).alias("new")).join(stored.select(*key, F.col(value).alias("old")), key).where("new <> old")
    return j.withColumn("material", F.coalesce(F.abs(F.try_divide(F.col("new"), F.col("old")) - 1) > material, F.lit(True)))


def announce_check(facts: DataFrame, first: str = "2001-01-01") -> DataFrame:
    return facts.agg(F.count_if(F.col("announce_date").isNull()).alias("n_null"), F.count_if(F.col("announce_date") < F.lit(first).cast("date")).alias("n_early"))


BREADTH = ("advance", "decline", "flat", "limit_up", "limit_down", "total", "advance_ratio")


def breadth_days(breadth: DataFrame) -> DataFrame:
    """Per day: metrics found, duplicates, unknown ids, and whether the counts and the ratio agree."""
    v = lambda m: F.max(F.when(F.col("metric_id") == m, F.col("value")))
    g = breadth.groupBy("trade_date").agg(F.count("*").alias("n"), F.count_distinct("metric_id").alias("n_ids"), F.count_if(~F.col("metric_id").isin(*BREADTH)).alias("n_unknown"), *[v(m).alias(m) for m in BREADTH])
    sound = (F.col("n") == 7) & (F.col("n_ids") == 7) & (F.col("n_unknown") == 0) & (F.col("advance") + F.col("decline") + F.col("flat") == F.col("total")) & (F.col("limit_up") <= F.col("advance")) & (F.col("limit_down") <= F.col("decline"))
    sound &= F.abs(F.coalesce(F.try_divide("advance", "total"), F.lit(0.0)) - F.col("advance_ratio")) < 1e-9
    return g.select("trade_date", "n", F.coalesce(sound, F.lit(False)).alias("complete"))


def index_check(index: DataFrame) -> DataFrame:
    """Groups that lack a weighting, repeat one, or whose member counts do not add up."""
    g = index.groupBy("trade_date", "industry_code", "level").agg(F.count("*").alias("n"), F.count_distinct("weighting").alias("n_weightings"), F.count_if(F.col("n_members") != F.col("n_priced") + F.col("n_excluded")).alias("n_bad"))
    return g.where("n <> 2 OR n_weightings <> 2 OR n_bad > 0")


def group_coverage(members: DataFrame, index: DataFrame, length: int = 6) -> DataFrame:
    """Membership groups of a day without an index row."""
    want = derive.members_as_of(members, index.select("trade_date").distinct()).select("trade_date", F.substring("industry_code", 1, length).alias("industry_code")).distinct()
    return want.join(index, ["trade_date", "industry_code"], "left_anti")


def contiguous_watermark(covered: DataFrame, calendar: DataFrame) -> DataFrame:
    """The last session before the first hole (the last session if there is none)."""
    s = calendar.where("is_trading").select("trade_date").join(covered.select("trade_date").distinct().withColumn("_in", F.lit(True)), "trade_date", "left")
    hole = s.where("_in IS NULL").agg(F.min("trade_date").alias("hole"))
    return s.join(F.broadcast(hole)).where("hole IS NULL OR trade_date < hole").agg(F.max("trade_date").alias("watermark"))


def missing_sessions(bars: DataFrame, calendar: DataFrame, start: str, end: str) -> DataFrame:
    s = calendar.where(F.col("is_trading") & F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("trade_date")
    return s.join(bars.where("volume > 0"), "trade_date", "left_anti")


def exchange_compare(official: DataFrame, curated: DataFrame, bps: float = 10, turnover_bps: float = 100, share: float = 0.15) -> DataFrame:
    """Official rows against curated ones per day: missing keys, closes beyond ``bps``, turnovers beyond ``turnover_bps``, and severities.

    A missing key or a close that drifts is an error; turnovers are a warning if more than ``share`` of those compared drift.
    """
    c = curated.select("symbol", "trade_date", F.col("close").alias("_c"), F.col("amount").alias("_a"), F.lit(True).alias("_there"))
    j = official.where("close > 0").join(c, ["symbol", "trade_date"], "left")
    drift = lambda mine, theirs: F.abs(F.try_divide(mine, theirs) - 1) * 10000
    both = (F.col("amount") > 0) & (F.col("_a") > 0)
    n = j.groupBy("trade_date").agg(F.count("*").alias("n"), F.count_if(F.col("_there").isNull()).alias("n_missing"), F.count_if(drift(F.col("_c"), F.col("close")) > bps).alias("n_drift"), F.count_if(both).alias("n_turnover"), F.count_if(both & (drift(F.col("_a"), F.col("amount")) > turnover_bps)).alias("n_turnover_drift"))
    severity = F.when((F.col("n_missing") > 0) | (F.col("n_drift") > 0), "error").when(F.col("n_turnover_drift") > share * F.col("n_turnover"), "warning").otherwise("none")
    return n.withColumn("severity", severity)


def worst_drift(a: DataFrame, b: DataFrame, key: list[str], fields: list[str], bps: float) -> DataFrame:
    """Greatest relative drift over fields where both sides are positive, beyond ``bps``."""
    j = a.select(*key, *fields).join(b.select(*key, *[F.col(f).alias(f"_{f}") for f in fields]), key)
    d = [F.when((F.col(f) > 0) & (F.col(f"_{f}") > 0), F.abs(F.try_divide(F.col(f), F.col(f"_{f}")) - 1) * 10000) for f in fields]
    return j.withColumn("drift_bps", F.greatest(*d)).where(F.col("drift_bps") > bps).select(*key, "drift_bps")


def diff_coverage(primary: DataFrame, backup: DataFrame, key: list[str]) -> DataFrame:
    """How the keys of two sources overlap."""
    j = primary.select(*key).distinct().withColumn("_p", F.lit(1)).join(backup.select(*key).distinct().withColumn("_b", F.lit(1)), key, "full_outer")
    n = j.agg(F.count_if(F.col("_p").isNotNull() & F.col("_b").isNotNull()).alias("n_both"), F.count_if(F.col("_b").isNull()).alias("n_primary_only"), F.count_if(F.col("_p").isNull()).alias("n_backup_only"))
    both, p, b = F.col("n_both"), F.col("n_primary_only"), F.col("n_backup_only")
    state = F.when(both + p + b == 0, "none").when(both + p == 0, "primary_missing").when(both + b == 0, "backup_missing").when(both == 0, "disjoint").when(p + b > 0, "gaps").otherwise("complete")
    return n.withColumn("state", state)


def diff_fields(primary: DataFrame, backup: DataFrame, key: list[str], fields: list[str], tolerance_bps: float, positive: tuple[str, ...] = ()) -> DataFrame:
    """Per key and field: values where one side is null, or that drift beyond tolerance (from 0: by infinity).

    positive: fields in which 0 is no value, so nothing agrees with a reference of 0, another 0 neither.
    """
    p = primary.select(*key, *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(key, fields, "field", "p")
    b = backup.select(*key, *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(key, fields, "field", "b")
    j = p.join(b, [*key, "field"])
    drift = F.when(F.col("b") == 0, F.when((F.col("p") == 0) & ~F.col("field").isin(*positive), 0.0).otherwise(float("inf"))).otherwise(F.abs(F.try_divide(F.col("p") - F.col("b"), F.col("b"))) * 10000)
    kind = F.when(F.col("p").isNull() != F.col("b").isNull(), "null_mismatch").when(drift > tolerance_bps, "drift")
    return j.withColumn("kind", kind).where("kind IS NOT NULL").select(*key, "field", "kind")


def diff_sample(rows: DataFrame, stratum: Column, key: Column, limit: int) -> DataFrame:
    """A repeatable sample: the ``limit`` keys of smallest hash of each stratum (sampling is its purpose)."""
    rows = rows.withColumns({"_s": stratum, "_h": F.md5(key)})
    w = Window.partitionBy("_s").orderBy("_h", key)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit).drop("_s", "_h", "_n")


def diff_gate(findings: DataFrame, n_keys: int, most: float) -> DataFrame:
    n = findings.where("kind = 'drift'").select("symbol", "trade_date").distinct().agg(F.count("*").alias("n_drifting"))
    return n.withColumn("blocked", F.col("n_drifting") > most * n_keys)


def delisting_match(catalog: DataFrame, spans: DataFrame, master: DataFrame) -> DataFrame:
    """Each catalogued delisting by what is wrong with it; verified if nothing is."""
    j = catalog.select("symbol", F.col("delist_date").alias("gone")).join(spans, "symbol", "left").join(master.select("symbol", "delist_date", F.lit(True).alias("_m")), "symbol", "left")
    kind = F.when(F.col("_m").isNull(), "master_missing").when(F.col("delist_date").isNull() | (F.col("delist_date") != F.col("gone")), "master_wrong").when(F.col("first_date").isNull(), "bars_missing").when(F.col("last_date") > F.col("gone"), "bars_after_end").when(F.datediff("gone", "last_date") > 7, "terminal_gap").otherwise("verified")
    return j.select("symbol", kind.alias("kind"))


def schema_report(rows: DataFrame, dataset) -> DataFrame:
    """The contract's columns and types, and how many values of each cast to it."""
    kinds = dataset.schema
    have = [c for c in kinds if c in rows.columns]
    agg = rows.agg(*[F.count(F.col(c).try_cast(kinds[c])).alias(c) for c in have]).unpivot([], have, "column", "n_valid")
    names = F.create_map(*[F.lit(x) for c in have for x in (c, kinds[c])])
    return agg.select("column", F.element_at(names, F.col("column")).alias("type"), "n_valid")
