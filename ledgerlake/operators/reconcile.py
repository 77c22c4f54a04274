"""Matching boards by name, evidence receipts, gaps and their repair, ownership of missing days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import symbols as S
from . import canonical, quality


def norm_name(name: Column, generic: str = "[0-9ⅠⅡⅢ\\s]+|brand|concept|sector") -> Column:
    """A board's name without numerals, blanks and generic words."""
    return F.regexp_replace(F.lower(name), generic, "")


def sector_code_map(boards: DataFrame, other: DataFrame, width: int = 6) -> DataFrame:
    """Boards matched by kind and padded code, then by name: identity, name_mismatch, or predicted if the code is unknown."""
    o = other.select("kind", F.lpad("code", width, "0").alias("code"), F.col("name").alias("other_name"))
    j = boards.withColumn("code", F.lpad("code", width, "0")).join(o, ["kind", "code"], "left")
    state = F.when(F.col("other_name").isNull(), "predicted").when(norm_name(F.col("name")) == norm_name(F.col("other_name")), "identity").otherwise("name_mismatch")
    return j.select("kind", "code", "name", "other_name", state.alias("state"))


def sector_routing(boards: DataFrame, indexes: DataFrame, exclusive: str) -> DataFrame:
    """Each board's index by normalised name: excluded, exact if one has the same, contains if one holds the other, else ambiguous
    or none; with the ``confidence`` of the match (1, 0.7, else 0).

    indexes are some hundred rows; the substring comparison is a broadcast join.
    """
    b = boards.select("board", norm_name(F.col("name")).alias("n"), F.lower("name").rlike(exclusive).alias("excluded")).distinct()
    i = F.broadcast(indexes.select("index", norm_name(F.col("name")).alias("m")).distinct())
    exact = b.join(i, F.col("n") == F.col("m")).groupBy("board").agg(F.count_distinct("index").alias("n_exact"), F.min("index").alias("exact"))
    held = b.join(i, (F.length("n") >= 2) & (F.contains("n", "m") | F.contains("m", "n"))).groupBy("board").agg(F.count_distinct("index").alias("n_held"), F.min("index").alias("held"))
    j = b.join(exact, "board", "left").join(held, "board", "left")
    tier = F.when(F.col("excluded"), "exclusive").when(F.col("n_exact") == 1, "exact").when(F.col("n_exact") > 1, "ambiguous").when(F.col("n_held") == 1, "contains").when(F.col("n_held") > 1, "ambiguous").otherwise("none")
    out = j.withColumn("tier", tier)
    return out.select("board", "tier", F.when(F.col("tier") == "exact", F.col("exact")).when(F.col("tier") == "contains", F.col("held")).alias("index"), F.when(F.col("tier") == "exact", 1.0).when(F.col("tier") == "contains", 0.7).otherwise(0.0).alias("confidence"))


def elapsed_fraction(start: Column, end: Column, day: Column) -> Column:
    """Share of a period that is past on a day, from 0 to 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(F.datediff(day, start) + 1, F.datediff(end, start) + 1)))


def verify_gaps(covered: DataFrame, calendar: DataFrame, anchor: str, tolerance: int, first: str, expected: DataFrame | None = None) -> DataFrame:
    """Gaps (dataset, kind, start, end): empty, stale at the end, shallow at the start, and each run of sessions missing within.

    covered: dataset and day. expected: the datasets that should be there; one without any row is ``empty`` from first to anchor.
    """
    a, f = F.lit(anchor).cast("date"), F.lit(first).cast("date")
    order = Window.partitionBy(F.lit(1)).orderBy("trade_date")  # a calendar is some hundred rows a year
    sessions = calendar.where("is_trading").select("trade_date").distinct().withColumn("_k", F.row_number().over(order))
    have = covered.select("dataset", "trade_date").distinct()
    span = have.groupBy("dataset").agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    gap = lambda rows, kind, start, end: rows.select("dataset", F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"))
    stale = gap(span.where(F.datediff(a, F.col("hi")) > tolerance), "stale", F.date_add("hi", 1), a)
    shallow = gap(span.where(F.col("lo") > f), "shallow", f, F.date_sub("lo", 1))
    want = span.join(F.broadcast(sessions), F.col("trade_date").between(F.col("lo"), F.col("hi"))).select("dataset", "trade_date", "_k")
    run = F.col("_k") - F.row_number().over(Window.partitionBy("dataset").orderBy("_k"))  # the same within a run of missing sessions
    hole = want.join(have, ["dataset", "trade_date"], "left_anti").withColumn("_run", run)
    hole = hole.groupBy("dataset", "_run").agg(F.min("trade_date").alias("start"), F.max("trade_date").alias("end"))
    out = stale.unionByName(shallow).unionByName(gap(hole, "interior", F.col("start"), F.col("end")))
    if expected is None:
        return out
    return out.unionByName(gap(expected.select("dataset").distinct().join(span, "dataset", "left_anti"), "empty", f, a))


def repairable(gaps: DataFrame, by_date: list[str]) -> DataFrame:
    """Gaps with an honest way to fill them: any of a dataset with history by date, a stale end or an empty one of the others."""
    return gaps.where(F.col("dataset").isin(by_date) | F.col("kind").isin("stale", "empty"))


def daily_ownership(symbols: DataFrame, spans: DataFrame, master: DataFrame, status: DataFrame, calendar: DataFrame, start: str, end: str) -> DataFrame:
    """Who answers for a symbol's missing days in a window, by the first rule that holds."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    n = calendar.where(F.col("is_trading") & F.col("trade_date").between(s, e)).agg(F.count("*").alias("n_sessions"))
    shut = status.where(F.col("trade_date").between(s, e)).groupBy("symbol").agg(F.count_if(canonical.not_trading()).alias("n_shut"), F.count_if(~canonical.not_trading()).alias("n_open"))
    j = symbols.select("symbol").distinct().join(master.select("symbol", "asset_type", "list_date", "delist_date", F.lit(True).alias("_m")), "symbol", "left").join(shut, "symbol", "left").join(F.broadcast(n))
    owner = (
        F.when(F.col("_m").isNull(), "unknown").when(F.coalesce(F.col("list_date") > e, F.lit(False)) | F.coalesce(F.col("delist_date") < s, F.lit(False)), "expected_no_data")
        .when(F.coalesce(F.col("delist_date").between(s, e), F.lit(False)), "delegated").when(F.col("n_shut") >= F.col("n_sessions"), "expected_no_data")
        .when(F.col("n_open") > 0, "generic").when(F.col("n_shut") > 0, "unknown").when(F.col("asset_type").isNull(), "unknown").otherwise("generic")
    )
    return j.select("symbol", owner.alias("owner"))


def master_enrich(master: DataFrame, history: DataFrame) -> DataFrame:
    """List dates from a history source where unknown, and its delisted names that the master lacks; ``ambiguous``: the history has
    several list dates of the name, and none is taken.
    """
    known = history.groupBy("symbol").agg(F.min("list_date").alias("_l"), (F.count_distinct("list_date") > 1).alias("ambiguous"), F.max("delist_date").alias("_d"))
    taken = F.when(~F.col("ambiguous"), F.col("_l"))
    filled = master.join(known, "symbol", "left").select("symbol", F.coalesce("list_date", taken).alias("list_date"), "delist_date", (F.coalesce("ambiguous", F.lit(False)) & F.col("list_date").isNull()).alias("ambiguous"))
    return filled.unionByName(known.where("_d IS NOT NULL").join(master, "symbol", "left_anti").select("symbol", taken.alias("list_date"), F.col("_d").alias("delist_date"), "ambiguous"))


def delisting_reconcile(catalog: DataFrame, spans: DataFrame, master: DataFrame) -> DataFrame:
    """What can safely be corrected in the master (a missing or wrong date that the bars do not contradict), and what cannot."""
    kinds = quality.delisting_match(catalog, spans, master)
    j = kinds.join(catalog.select("symbol", F.col("delist_date").alias("gone")), "symbol").join(spans.select("symbol", "last_date"), "symbol", "left")
    safe = (F.col("kind") == "master_wrong") & F.coalesce(F.col("last_date") <= F.col("gone"), F.lit(True))
    return j.where("kind <> 'verified'").select("symbol", "kind", F.when(safe, "correct").otherwise("unresolved").alias("action"))


def structural(events: DataFrame, pattern: str) -> DataFrame:
    """Events whose reason speaks of restructuring."""
    return events.where(F.col("change_reason").rlike(pattern))


def purge_orphans(rows: DataFrame, bars: DataFrame, dataset) -> DataFrame:
    """rows without those of symbols that never had a traded bar; all of them where there are no bars to judge by."""
    if bars.isEmpty():
        return rows
    return rows.join(canonical.traded_symbols(bars, dataset), "symbol", "left_semi")


def purge_placeholders(master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The master without subscription stubs, and one row ``n`` of how many those are."""
    stub = S.placeholder_name(F.col("name"))
    return master.where(~stub), master.agg(F.count_if(stub).alias("n"))


def watermark_max(marks: DataFrame, candidates: DataFrame) -> DataFrame:
    """``dataset, watermark``: the later of the stored mark and the candidate of each dataset; a mark never falls here."""
    both = marks.select("dataset", "watermark").unionByName(candidates.select("dataset", "watermark"))
    return both.groupBy("dataset").agg(F.max("watermark").alias("watermark"))


def watermark_reconcile(marks: DataFrame, days: DataFrame, gate: float = 0.7, gated: tuple[str, ...] = ("valuation_metrics",), keep: bool = False) -> DataFrame:
    """``dataset, watermark``: marks ahead of the data are lowered to the last complete day; none is ever raised.

    days: dataset, trade_date, ratio (how complete a day is, 0 to 1; of datasets that are not gated any day counts). A gated
    dataset without a day that reaches the gate has its mark cleared, as has any dataset without a day. keep: where there are
    days but none reaches the gate, the mark stays as it is.
    """
    counts = ~F.col("dataset").isin(*gated) | (F.col("ratio") >= gate)
    last = days.groupBy("dataset").agg(F.max(F.when(counts, F.col("trade_date"))).alias("_last"), F.lit(True).alias("_days"))
    mark = F.when(F.col("_last").isNotNull() | (F.lit(keep) & F.col("_days")), F.least("watermark", "_last"))
    return marks.join(last, "dataset", "left").select("dataset", mark.alias("watermark"))


def volume_unit_migration(bars: DataFrame, lots: list[str], old: str = "v1", new: str = "v2", denormal: float = 1e-300) -> DataFrame:
    """Bars whose volumes are all in shares: old rows of sources that count in lots times 100, and every old row marked new.

    Amounts below ``denormal`` are zeros that were decoded badly and become 0. A second run changes nothing.
    """
    touched = F.coalesce(F.col("data_version") == old, F.lit(False))
    volume = F.when(touched & F.col("source").isin(lots), S.lots_to_shares(F.col("volume"))).otherwise(F.col("volume"))
    amount = F.when(F.abs("amount") < denormal, 0.0).otherwise(F.col("amount"))
    return bars.withColumns({"volume": volume, "amount": amount, "data_version": F.when(touched, new).otherwise(F.col("data_version"))})
