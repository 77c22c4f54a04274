"""Registered datasets: keys, date axis, partition period, preferred sources and column types."""

from __future__ import annotations

from dataclasses import dataclass

PROVENANCE = {"source": "string", "data_version": "string", "fetched_at": "timestamp"}


@dataclass(frozen=True)
class Dataset:
    name: str
    key: tuple[str, ...]
    columns: dict[str, str]
    date_col: str | None = None
    period: str | None = None  # day, month, quarter or year
    primary: str | None = None
    backup: str | None = None
    layer: str = "curated"
    history_mode: str = "by_date"
    tolerance_days: int = 3
    pit: bool = False
    positive: tuple[str, ...] = ()
    label_col: str | None = None  # the query axis where it is a quarter's label and no date
    evidence: bool = False  # rows differ in evidence, which ranks before freshness
    needed: tuple[str, ...] = ()  # further columns that every row must fill

    @property
    def schema(self) -> dict[str, str]:
        return self.columns | PROVENANCE

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that may hold neither null nor blank: key, provenance, and prices with volume."""
        return tuple(dict.fromkeys([*self.key, *PROVENANCE, *self.positive, *self.needed]))


TEXT = set("symbol name exchange title category url reason summary channel country indicator unit rating frequency status direction level weighting".split())
TEXT_ENDS = ("_id", "_code", "_name", "_type", "_symbol", "_symbols", "_hash", "_period", "_channel", "_source", "_reason", "_scope", "_system", "_pattern", "publish_time", "event_time")
WHOLE = set("volume rank rank_change hist_rank headline_count analyst_count forecast_year bars halt_gap_days n_members n_priced n_excluded".split())
OTHER = {"bar_time": "timestamp_ntz", "trade_time": "timestamp_ntz", "tick_seq": "int", "holder_rank": "int", "importance": "tinyint", "risk_warning": "boolean"}


def kind_of(column: str) -> str:
    """The type of a column by its name: dates, flags, text and whole numbers are named as such, all else is a double."""
    if column in OTHER:
        return OTHER[column]
    if column.endswith("_date"):
        return "date"
    if column.startswith("is_"):
        return "boolean"
    if column in TEXT or column.endswith(TEXT_ENDS):
        return "string"
    return "bigint" if column in WHOLE else "double"


def _dataset(name: str, key: str, columns: str, date_col: str | None = None, period: str | None = None, **more) -> Dataset:
    """A dataset of key columns and further columns, given by name."""
    keys = tuple(key.split())
    return Dataset(name, keys, {c: kind_of(c) for c in [*keys, *columns.split()]} | more.pop("types", {}), date_col, period, **more)


_BAR = "open high low close volume amount"
_PRICED = ("open", "high", "low", "close", "volume")
_TIP = {"history_mode": "snapshot_only"}
_TIP_FILLED = {"history_mode": "snapshot_with_backfill"}

#: Names, keys, columns and periods of the datasets, as files hold them.
DATASETS = {
    d.name: d
    for d in (
        # reference data
        _dataset("instruments", "symbol", "name exchange asset_type list_date delist_date prev_symbol", **_TIP_FILLED),
        _dataset("trading_calendar", "trade_date", "is_trading", "trade_date", "year", needed=("is_trading",)),
        _dataset("trading_status", "symbol trade_date", "is_trading status risk_warning", "trade_date", "month", evidence=True, needed=("is_trading", "status"), **_TIP_FILLED),
        # bars and ticks
        _dataset("daily_bars", "symbol trade_date", _BAR, "trade_date", "month", primary="vendor_a", backup="vendor_b", positive=_PRICED),
        _dataset("index_bars", "symbol trade_date frequency", _BAR, "trade_date", "year", positive=_PRICED),
        _dataset("minute_bars", "symbol trade_date bar_time frequency", _BAR, "trade_date", "day", positive=_PRICED),
        _dataset("minute_bars_5m", "symbol trade_date bar_time frequency", _BAR, "trade_date", "day", positive=_PRICED),
        _dataset("trade_ticks", "symbol trade_date tick_seq", "trade_time price volume direction", "trade_date", "day", positive=("price", "volume"), needed=("trade_time", "direction")),
        _dataset("commodity_bars", "symbol trade_date", f"name exchange {_BAR} open_interest", "trade_date", "year", tolerance_days=2, positive=_PRICED),
        _dataset("sector_bars", "sector_code trade_date", f"sector_name board_type {_BAR} change_pct", "trade_date", "month", positive=_PRICED, **_TIP_FILLED),
        # corporate events and facts
        _dataset("corporate_actions", "symbol ex_date action_type", "cash_dividend bonus_ratio transfer_ratio allotment_ratio allotment_price", "ex_date", "year"),
        _dataset("announcement_index", "announcement_id", "symbol title announce_date category url", "announce_date", "day", pit=True),
        _dataset("earnings_disclosure_schedule", "symbol report_period", "scheduled_date first_scheduled_date actual_date", None, "quarter", label_col="report_period"),
        _dataset("financial_statement_items", "symbol report_period statement_type item_code announce_date", "item_value", "announce_date", "quarter", pit=True, label_col="report_period"),
        _dataset("share_structure", "symbol change_date announce_date", "total_shares float_shares restricted_shares free_float_shares change_reason", "change_date", "year", pit=True),
        _dataset("shareholder_counts", "symbol count_date announce_date", "holder_count holder_count_change_pct avg_float_shares avg_holding_value", "count_date", "year", pit=True),
        _dataset("top_holders", "symbol record_date holder_scope holder_rank holder_name announce_date", "holding_shares holding_pct is_institution holder_type", "record_date", "year", pit=True),
        _dataset("valuation_metrics", "symbol trade_date", "pe_ttm pb ps_ttm total_mv float_mv", "trade_date", "day", **_TIP_FILLED),
        _dataset("analyst_consensus", "symbol forecast_date", "forecast_year eps_forecast pe_forecast target_price rating analyst_count", "forecast_date", "day", **_TIP),
        # flows and holdings
        _dataset("fund_flow", "symbol trade_date", "main_net_inflow super_large_net_inflow large_net_inflow medium_net_inflow small_net_inflow", "trade_date", "day", **_TIP),
        _dataset("margin_trading", "symbol trade_date", "margin_balance margin_buy short_balance short_sell_volume", "trade_date", "day", tolerance_days=2),
        _dataset("northbound_holdings", "symbol trade_date channel", "holding_shares holding_mv holding_ratio", "trade_date", "day", tolerance_days=100),
        _dataset("northbound_flows", "trade_date channel", "net_buy buy_amount sell_amount", "trade_date", "year", tolerance_days=2),
        _dataset("dragon_tiger", "symbol trade_date reason", "buy_amount sell_amount net_amount", "trade_date", "month"),
        _dataset("block_trades", "symbol trade_date price volume", "amount premium_ratio", "trade_date", "month", types={"volume": "double"}),
        _dataset("institutional_holdings", "symbol holder_type report_period", "holding_shares holding_ratio holding_mv", None, "quarter", label_col="report_period"),
        # memberships
        _dataset("sector_members", "symbol sector_code as_of_date", "sector_name", "as_of_date", "day", **_TIP),
        _dataset("index_constituents", "index_symbol symbol as_of_date", "weight", "as_of_date", "month", **_TIP_FILLED),
        _dataset("industry_members", "symbol classification_system as_of_date", "industry_code industry_name", "as_of_date", "month", **_TIP_FILLED),
        # macro, sentiment, news
        _dataset("macro_indicators", "indicator_id obs_date", "value frequency", "obs_date", "year"),
        _dataset("sentiment_scores", "symbol trade_date score_channel", "sentiment_score headline_count", "trade_date", "month"),
        _dataset("hot_rank", "symbol trade_date", "rank rank_change hist_rank", "trade_date", "month", **_TIP),
        _dataset("sector_fund_flow", "sector_code trade_date", "sector_name board_type main_net_inflow change_pct turnover_pct", "trade_date", "month", **_TIP),
        _dataset("news_headlines", "news_id", "publish_date publish_time title summary related_symbols channel", "publish_date", "month", **_TIP),
        _dataset("flash_news_wire", "wire_id wire_source", "item_hash publish_date publish_time title summary related_symbols importance channel", "publish_date", "month", **_TIP),
        _dataset("economic_calendar", "event_id", "event_date event_time country indicator importance forecast previous actual unit", "event_date", "year", **_TIP),
        _dataset("share_unlock_schedule", "symbol unlock_date", "unlock_shares unlock_ratio unlock_type", "unlock_date", "year", **_TIP_FILLED),
        _dataset("regulatory_events", "event_id", "symbol event_date event_type title", "event_date", "year"),
        # derived
        _dataset("adj_factors", "symbol trade_date adjust_type", "factor", "trade_date", "year", layer="derived"),
        _dataset("market_breadth", "trade_date metric_id", "value", "trade_date", "year", layer="derived"),
        _dataset("industry_index", "trade_date industry_code level weighting", "ret n_members n_priced n_excluded amount", "trade_date", "year", layer="derived"),
        _dataset("delisting_events", "symbol", "first_trade_date last_trade_date ending_pattern final_close halt_gap_days worst_final_return final_window_return bars", "last_trade_date", None, layer="derived"),
    )
}
