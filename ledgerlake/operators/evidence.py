"""Evidence that a window of history is whole: delistings, label receipts, and one record of what stands against using it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import canonical, quality

#: Kinds of delisting_coverage() that leave a name unresolved; the others are explained.
BLOCKING = ("pending_probe", "missing_bars", "unknown_overlap", "terminal_mismatch", "missing_instrument", "invalid_delist_date", "recent_quarantined", "formal_unresolved")


def delisting_coverage(catalog: DataFrame, bars: DataFrame, master: DataFrame, start: str, end: str, recent: DataFrame | None = None, pending: DataFrame | None = None, nonprinting_days: int = 3) -> DataFrame:
    """``symbol, kind``: what the evidence says of each name that may have been delisted within a window; a name can have two kinds.

    catalog: symbol and last_date, the last session that a name traded. Of names that ended in the window or later: missing_bars (it
    ended within and has none), unknown_overlap (it ended later and no bar shows that it was listed), terminal_mismatch (its last traded
    bar is another day), terminal_nonprinting (a last quote without a print: up to some days before, and the master delists it on
    the day after), missing_instrument, invalid_delist_date (none, or before its last session). recent (symbol, last_date): names
    found gone lately, recent_quarantined while bars or master lack them. Names that the master alone delists in the window:
    formal_no_overlap (catalogued as ended before), formal_unresolved (no bar in the window) or a date before the last bar. pending:
    names not looked up yet. verified: nothing of these.
    """
    a, z = F.lit(start).cast("date"), F.lit(end).cast("date")
    spans = quality.bar_spans(canonical.traded(bars.where(F.col("trade_date").between(a, z))), positive_only=False)
    names = master.select("symbol", "delist_date", F.lit(True).alias("_m"))
    j = catalog.where(F.col("last_date") >= a).select("symbol", F.col("last_date").alias("gone")).join(spans, "symbol", "left").join(names, "symbol", "left")
    within, seen, formal = F.col("gone") <= z, F.col("last_date").isNotNull(), F.col("delist_date")
    quote = (formal == F.date_add("gone", 1)) & F.datediff("gone", "last_date").between(1, nonprinting_days)
    by_bars = F.when(~seen, F.when(within, "missing_bars").otherwise("unknown_overlap")).when(within & (F.col("last_date") != F.col("gone")), F.when(F.coalesce(quote, F.lit(False)), "terminal_nonprinting").otherwise("terminal_mismatch"))
    by_master = F.when(seen | within, F.when(F.col("_m").isNull(), "missing_instrument").when(formal.isNull() | (formal < F.col("gone")), "invalid_delist_date"))
    kinds = F.array_compact(F.array(by_bars, by_master))
    out = j.select("symbol", F.explode(F.when(F.size(kinds) == 0, F.array(F.lit("verified"))).otherwise(kinds)).alias("kind"))
    listed = catalog.select("symbol", F.col("last_date").alias("_ended"))
    formally = master.where(F.col("delist_date").between(a, z)).select("symbol", "delist_date").join(listed, "symbol", "left").where(F.col("_ended").isNull() | (F.col("_ended") < a)).join(spans, "symbol", "left")
    kind = F.when(F.col("_ended").isNotNull(), "formal_no_overlap").when(~seen, "formal_unresolved").when(F.col("delist_date") < F.col("last_date"), "invalid_delist_date").otherwise("verified")
    out = out.unionByName(formally.select("symbol", kind.alias("kind")))
    if recent is not None:
        lately = recent.where(F.col("last_date").between(a, z)).select("symbol").distinct().join(master.where(F.col("delist_date").between(a, z)), "symbol", "left_anti")
        held = lately.join(spans.select("symbol", F.lit(True).alias("_b")), "symbol", "left").join(names, "symbol", "left").where("_b IS NULL OR _m IS NULL")
        out = out.unionByName(held.select("symbol", F.lit("recent_quarantined").alias("kind")))
    if pending is not None:
        out = out.unionByName(pending.select("symbol", F.lit("pending_probe").alias("kind")))
    return out


def delisting_verdict(kinds: DataFrame) -> DataFrame:
    """One row: whether the window is ``verified``, and how many findings are ``unresolved``."""
    bad = F.count_if(F.col("kind").isin(*BLOCKING))
    return kinds.agg((bad == 0).alias("verified"), bad.alias("unresolved"))


def require_delistings(rows: DataFrame, start: str | None, end: str | None, catalog: DataFrame, bars: DataFrame, master: DataFrame, recent: DataFrame | None = None, pending: DataFrame | None = None) -> None:
    """Raise unless every delisting in the window of some rows is accounted for. A window that is not given is that of the rows."""
    if start is None or end is None:
        span = rows.agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("z")).first()
        if span["a"] is None:
            return
        start, end = start or str(span["a"]), end or str(span["z"])
    found = delisting_verdict(delisting_coverage(catalog, bars, master, start, end, recent, pending)).first()
    if not found["verified"]:
        raise ValueError(f"historical delistings of {start} to {end} are not accounted for: {found['unresolved']} unresolved")


def st_scope(bars: DataFrame, start: str, end: str, source_of: Column) -> DataFrame:
    """``symbol, source``: share codes that traded in a window and the source that must answer for each (null: none can)."""
    from ..functions import symbols as S

    days = F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return canonical.traded(bars.where(days)).where(S.in_class(F.col("symbol"), False)).select("symbol").distinct().withColumn("source", source_of)


def st_row_counts(status: DataFrame, dataset, scope: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """``source, symbol, n``: canonical label rows of each symbol of a scope in a window, those of its source; 0 where there is none."""
    rows = canonical.dedupe(status, dataset)
    rows = rows if start is None else rows.where(F.col("trade_date") >= F.lit(start).cast("date"))
    rows = rows if end is None else rows.where(F.col("trade_date") <= F.lit(end).cast("date"))
    n = rows.groupBy("source", "symbol").agg(F.count("*").alias("n"))
    return scope.select("source", "symbol").distinct().join(n, ["source", "symbol"], "left").select("source", "symbol", F.coalesce("n", F.lit(0)).alias("n"))


def best_receipts(receipts: DataFrame, scope: DataFrame, counts: DataFrame, start: str, end: str, version: str | None = None) -> DataFrame:
    """``source, receipt, start, end, n_scope, covering, intact``: of each source that the scope needs its best receipt that still holds.

    receipts: receipt, source, version, start, end, symbol, n_rows (a row per symbol). One covers if it is of the version and holds all of the
    source's symbols and the whole window; it is intact if its row counts are those of now. Best: earliest start, then latest end.
    A needed source without one has nulls; covering tells whether any covered, so that drift can be told from absence.
    """
    need = scope.where("source IS NOT NULL").groupBy("source").agg(F.count_distinct("symbol").alias("n_scope"))
    rows = receipts if version is None else receipts.where(F.col("version") == version)
    hit = rows.join(scope.select("source", "symbol").distinct(), ["source", "symbol"], "left_semi").join(counts.select("source", "symbol", F.col("n").alias("now")), ["source", "symbol"], "left")
    g = hit.groupBy("source", "receipt", "start", "end").agg(F.count_distinct("symbol").alias("n_hit"), F.bool_and(F.col("n_rows") == F.coalesce("now", F.lit(0))).alias("intact"))
    ok = g.join(need, "source").where((F.col("n_hit") == F.col("n_scope")) & (F.col("start") <= F.lit(start).cast("date")) & (F.col("end") >= F.lit(end).cast("date")))
    w = Window.partitionBy("source").orderBy(F.col("intact").desc(), "start", F.col("end").desc(), "receipt")  # receipts of a source are some dozens
    best = ok.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("source", "receipt", "start", "end", "intact")
    j = need.join(best, "source", "left")
    held = lambda c: F.when(F.col("intact"), F.col(c)).alias(c)
    return j.select("source", held("receipt"), held("start"), held("end"), "n_scope", F.col("intact").isNotNull().alias("covering"), F.coalesce("intact", F.lit(False)).alias("intact"))


def st_verdict(best: DataFrame, scope: DataFrame) -> DataFrame:
    """One row ``verified, n_symbols, n_unsupported, n_sources, n_missing, reason``: verified if every needed source has a receipt that
    holds and no symbol is left without a source."""
    s = scope.agg(F.count_distinct("symbol").alias("n_symbols"), F.count_distinct(F.when(F.col("source").isNull(), F.col("symbol"))).alias("n_unsupported"))
    b = best.agg(F.count("*").alias("n_sources"), F.count_if(~F.col("intact")).alias("n_missing"), F.count_if(F.col("covering") & ~F.col("intact")).alias("_drift"))
    reason = F.when(F.col("n_symbols") == 0, "no_current_universe").when(F.col("n_unsupported") > 0, "unsupported_symbols").when(F.col("_drift") > 0, "receipt_data_drift").when((F.col("n_missing") > 0) | (F.col("n_sources") == 0), "no_matching_receipt")
    return s.join(F.broadcast(b)).withColumn("reason", reason).select(F.col("reason").isNull().alias("verified"), "n_symbols", "n_unsupported", "n_sources", "n_missing", "reason")  # one row each


def compose_receipts(receipts: DataFrame, status: DataFrame, first_traded: DataFrame) -> DataFrame:
    """Chains of overlapping receipts of one source as joint receipts: ``source, start, end, n_links, symbols, n_added``.

    receipts: receipt, source, start, end, symbols (array), n_rows. Only receipts whose row total is still that of status count. Of these,
    in order of their starts, each goes on with the chain before it if it begins no later than the chain's end so far and ends after it, holds all
    symbols of the receipt before, and every symbol that it adds first traded on or after its start, so that no time before
    is left unproven. status: canonical rows; first_traded: symbol, first_date. Chains of one receipt are left out.
    """
    held = receipts.select("receipt", "source", "start", "end", "n_rows", F.explode("symbols").alias("symbol"))
    days = status.select("source", "symbol", "trade_date")
    now = held.join(days, ["source", "symbol"], "left").groupBy("source", "receipt").agg(F.count_if(F.col("trade_date").between(F.col("start"), F.col("end"))).alias("now"))
    sound = receipts.join(now, ["source", "receipt"], "left").where(F.col("n_rows") == F.coalesce("now", F.lit(0))).drop("now")
    order = Window.partitionBy("source").orderBy("start", F.col("end").desc(), "receipt")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    longer = sound.withColumn("_reach", F.max("end").over(before)).where("_reach IS NULL OR end > _reach")  # one within another proves nothing more
    longer = longer.withColumns({"_reach": F.max("end").over(before), "_prior": F.lag("symbols").over(order), "_from": F.lag("start").over(order)})
    added = longer.withColumn("_new", F.array_except("symbols", F.coalesce("_prior", F.array().cast("array<string>"))))
    late = added.select("source", "receipt", "start", F.explode("_new").alias("symbol")).join(first_traded.select("symbol", "first_date"), "symbol", "left")
    late = late.groupBy("source", "receipt").agg(F.bool_and(F.coalesce(F.col("first_date") >= F.col("start"), F.lit(False))).alias("_late"))
    j = added.join(late, ["source", "receipt"], "left")
    links = (F.col("start") <= F.col("_reach")) & (F.col("start") > F.col("_from")) & (F.size(F.array_except("_prior", "symbols")) == 0) & F.coalesce("_late", F.lit(True))
    marked = j.withColumn("_chain", F.sum(F.when(F.coalesce(links, F.lit(False)), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    chains = marked.groupBy("source", "_chain").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_links"), F.max_by("symbols", "start").alias("symbols"), F.min_by("symbols", "start").alias("_first"))
    return chains.where("n_links > 1").select("source", "start", "end", "n_links", "symbols", F.size(F.array_except("symbols", "_first")).alias("n_added"))


def historical_validity(bars: DataFrame, calendar: DataFrame, status: DataFrame, start: str, end: str, evidence: DataFrame | None = None, delistings: DataFrame | None = None) -> DataFrame:
    """``blocker, n``: what stands against research on a window; no row if it is ready.

    Bars that do not reach it, sessions without any traded bar, labels without evidence (evidence: st_verdict(); without it, any label in
    the window), and delistings that are not accounted for (delistings: delisting_coverage() of the window).
    """
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    row = lambda rows, name: rows.where("n > 0").select(F.lit(name).alias("blocker"), F.col("n").cast("long").alias("n"))
    span = bars.agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("z"))
    out = [row(span.select(F.coalesce(((F.col("a") > s) | (F.col("z") < e)).cast("int"), F.lit(1)).alias("n")), "window_not_covered")]
    out.append(row(quality.missing_sessions(bars, calendar, start, end).agg(F.count("*").alias("n")), "sessions_without_bars"))
    if evidence is None:
        out.append(row(status.where(F.col("trade_date").between(s, e)).agg((F.count("risk_warning") == 0).cast("int").alias("n")), "no_label_evidence"))
    else:
        out.append(row(evidence.where("NOT verified").select(F.greatest("n_missing", "n_unsupported", F.lit(1)).alias("n")), "no_label_evidence"))
    if delistings is not None:
        out.append(row(delisting_verdict(delistings).select(F.col("unresolved").alias("n")), "delistings_unverified"))
    return quality.audit_union(out)
