"""Binary-option quotes: market rows to quotes, change states per symbol, summaries, discovery; text items: new and edited."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .segments import PIECE, cut, first_rows, last_values

_C = F.col


def market_candidates(items: DataFrame, now: Column, item: str = "item") -> DataFrame:
    """Market objects (JSON text) as typed rows, with seconds to close and `empty_best_ask` in findings."""
    prices, numbers = ("yes_bid", "yes_ask", "no_bid", "no_ask"), ("yes_ask_size", "no_ask_size", "volume", "volume_24h", "open_interest", "liquidity")
    names = ["ticker", "event_ticker", "series_ticker", "status", "close_time", *prices, *(f"{k}_dollars" for k in prices), *numbers, "fractional_trading_enabled"]
    read = items.select("*", F.json_tuple(item, *names).alias(*(f"__{k}" for k in names)))  # an object is parsed once
    get = lambda k: _C(f"__{k}")
    price = lambda k: S.cents_price(get(k), get(f"{k}_dollars"))
    number = lambda k: S.finite(get(k).try_cast("double"))
    out = read.select(*(c for c in items.columns if c != item), get("ticker").alias("ticker"), get("event_ticker").alias("event_ticker"), get("series_ticker").alias("series_ticker"), F.lower(get("status")).alias("status"), get("close_time").alias("close_time"), *(price(k).alias(k) for k in prices), *(number(k).alias(k) for k in numbers), S.truthy(get("fractional_trading_enabled")).alias("fractional_trading_enabled"))
    none = ~(F.coalesce(_C("yes_ask") > 0, F.lit(False)) | F.coalesce(_C("no_ask") > 0, F.lit(False)))
    return out.withColumns({"seconds_to_close": (F.unix_micros(S.iso_timestamp(_C("close_time"))) - F.unix_micros(now)) / 1e6, "findings": F.array_compact(F.array(F.when(none, F.lit("empty_best_ask"))))})


def open_markets(markets: DataFrame) -> DataFrame:
    """Open markets with an ask. `market_order` is their order, nearest close first, for whoever shows them."""
    has = F.coalesce(_C("yes_ask") > 0, F.lit(False)) | F.coalesce(_C("no_ask") > 0, F.lit(False))
    return markets.where(_C("status").isin("active", "open") & has)


def market_order() -> list[Column]:
    return [F.asc_nulls_last("seconds_to_close"), F.asc("ticker")]


def series_candidates(items: DataFrame, assets: list[str], item: str = "item") -> DataFrame:
    """Series objects with frequency in seconds and the target assets that ticker, title or tags name."""
    get = lambda k: F.get_json_object(item, f"$.{k}")
    text = F.upper(F.concat_ws(" ", get("ticker"), get("title"), get("tags")))
    return items.select(get("ticker").alias("ticker"), get("title").alias("title"), F.lower(get("frequency")).alias("frequency"), S.frequency_seconds(get("frequency")).alias("frequency_seconds"), F.filter(F.array(*map(F.lit, assets)), lambda a: F.contains(text, a)).alias("assets"))


def quote_rows(markets: DataFrame, sampled_at: str = "sampled_at") -> DataFrame:
    """A row per market side with a positive ask, with its quote id and payout ratio."""
    side = lambda s, p: F.struct(F.lit(s).alias("side"), _C(f"{p}_bid").alias("bid"), _C(f"{p}_ask").alias("ask"), _C(f"{p}_ask_size").alias("ask_size"))
    keep = [c for c in markets.columns if not c.startswith(("yes_", "no_"))]
    out = markets.select(*keep, F.explode(F.array(side("YES", "yes"), side("NO", "no"))).alias("x")).where("x.ask > 0").select(*keep, "x.*")
    symbol = F.upper(F.concat("ticker", F.lit(":"), "side"))
    out = out.withColumns({"source": F.lit("kalshi"), "venue": F.lit("kalshi"), "event_type": F.lit("quote"), "symbol": symbol, "product": symbol, "event_time": _C(sampled_at), "payout_ratio": (1 - _C("ask")) / _C("ask")})
    return out.withColumns({"quote_id": S.quote_id(_C("symbol"), _C("bid"), _C("ask"), _C("ask_size"), _C("close_time")), "instrument": F.struct(F.concat(F.lit("binary_option:kalshi:"), "symbol").alias("instrument_id"), _C("symbol").alias("canonical_symbol"))})


def quote_states(quotes: DataFrame, order: list[str], symbol: str = "symbol", at: str = "sampled_at", stale_seconds: float = 60) -> DataFrame:
    """Adds first_observed, changed, repeated, age since the state began, and stale. A symbol's quotes are scanned in pieces."""
    keys = [symbol]
    rows = last_values(cut(quotes, keys, order), keys, order, {"__prior": F.struct("quote_id")})
    prior = _C("__prior.quote_id")
    rows = rows.withColumns({"quote_first_observed": prior.isNull(), "quote_changed": prior.isNotNull() & (prior != _C("quote_id")), "quote_repeated": F.coalesce(prior == _C("quote_id"), F.lit(False))})
    out = last_values(rows, keys, order, {"__since": F.when(~_C("quote_repeated"), _C(at))}, current=True)
    out = out.withColumn("quote_age_ms", S.skew_ms(_C(at), _C("__since"))).drop("__prior", "__since", PIECE)
    return out.withColumn("quote_stale", _C("quote_age_ms") > stale_seconds * 1000)


def quote_summary(quotes: DataFrame, order: list[str]) -> DataFrame:
    """One row: quotes, symbols, first sights, updates, repeats, stale ones; rows without symbol or id count as quotes only."""
    has = ~S.blank(_C("symbol")) & ~S.blank(_C("quote_id"))
    keyed = quotes.where(has).select("symbol", "quote_id", *order)
    met = last_values(cut(keyed, ["symbol"], order), ["symbol"], order, {"prior": _C("quote_id")})
    own = met.agg(F.countDistinct("symbol").alias("side_symbol_count"), F.count_if(_C("prior") != _C("quote_id")).alias("quote_update_count"), F.count_if(_C("prior").isNull()).alias("first_observed_quote_count"))
    every = quotes.agg(F.count("*").alias("quote_count"), F.count_if("quote_repeated").alias("repeated_quote_count"), F.count_if("quote_stale").alias("stale_quote_count"))
    names = ("quote_count", "side_symbol_count", "quote_update_count", "first_observed_quote_count", "repeated_quote_count", "stale_quote_count")
    return every.unionByName(own, allowMissingColumns=True).agg(*(F.max(n).alias(n) for n in names))  # a row each


def quote_counters(quotes: DataFrame, keys: list[str]) -> DataFrame:
    """Per collection: quotes, changes, repeats, stale ones, symbols."""
    return quotes.groupBy(*keys).agg(F.count("*").alias("quotes"), F.count_if("quote_changed").alias("updates"), F.count_if("quote_repeated").alias("repeats"), F.count_if("quote_stale").alias("stale"), F.countDistinct("symbol").alias("symbols"))


def discovery(series: DataFrame, markets: DataFrame, frequencies: list[str]) -> DataFrame:
    """Selected series (a target asset, a wanted frequency) with open markets and findings."""
    own = series.where((F.size("assets") > 0) & _C("frequency").isin(*frequencies))
    counts = markets.where(_C("status").isin("active", "open")).groupBy(_C("series_ticker").alias("ticker")).agg(F.count("*").alias("open_markets"), F.count_if(F.size("findings") > 0).alias("empty_best_asks"))
    out = own.join(counts, "ticker", "left").fillna(0, ["open_markets", "empty_best_asks"])
    return out.withColumn("findings", F.array_compact(F.array(F.when(_C("open_markets") == 0, F.lit("no_open_markets")), F.when(_C("empty_best_asks") > 0, F.lit("empty_best_ask")))))


def shortest_frequency(series: DataFrame, keys: list[str]) -> DataFrame:
    """The most frequent label of each key."""
    return series.groupBy(*keys).agg(F.min_by("frequency", F.struct("frequency_seconds", "frequency")).alias("frequency"))


def api_errors(responses: DataFrame) -> DataFrame:
    """Failed calls as `api_error` events, rate limits marked."""
    failed = ~F.coalesce(_C("success"), F.lit(False))
    return responses.where(failed).withColumns({"event_type": F.lit("api_error"), "rate_limited": F.coalesce(_C("http_status") == 429, F.lit(False))})


def item_payloads(items: DataFrame) -> DataFrame:
    """Items (kind: rss, posts or comments) with the hash of the fields that carry their meaning."""
    fields = {"rss": ("title", "link", "summary"), "posts": ("title", "selftext"), "comments": ("body",)}
    hashes = F.when(F.lit(False), "")
    for kind, names in fields.items():
        hashes = hashes.when(_C("kind") == kind, S.content_hash(*(_C(n) for n in names)))
    return items.withColumn("content_hash", F.when(_C("source_id").isNotNull(), hashes))


def new_or_edit(polls: DataFrame, keys: list[str], order: list[str], hash_: str = "content_hash") -> DataFrame:
    """Polled items that are new or edited since the poll before; unchanged ones go, those without an id pass as new.

    Items without an id are scanned with no others; an item's polls are scanned in pieces.
    """
    id_ = _C(keys[-1])
    met = last_values(cut(polls.where(id_.isNotNull()), keys, order), keys, order, {"__prior": F.struct(hash_)})
    last = _C(f"__prior.{hash_}")
    kept = met.withColumn("row_type", F.when(last.isNull(), "new").when(last != _C(hash_), "edit")).where("row_type is not null").drop("__prior", PIECE)
    none = polls.where(id_.isNull()).withColumns({"row_type": F.lit("new"), hash_: F.lit(None).cast(polls.schema[hash_].dataType)})
    return kept.unionByName(none)


def read_once(items: DataFrame, keys: tuple[str, ...] = ("source", "source_id", "content_hash"), at: str = "ingestion_ts", tie: list[str] | None = None) -> DataFrame:
    """The latest row of each envelope key: at-least-once writes read as exactly once."""
    w = Window.partitionBy(*keys).orderBy(F.desc(at), *(tie or []))
    return items.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def seen_state(items: DataFrame, feed: str, key: str, order: str, cap: int = 5000, hash_: str = "content_hash", start: DataFrame | None = None) -> DataFrame:
    """The last hash of each key, the most recent `cap` keys of a feed (the state's stated bound), found in parts of a feed first.

    start: the state (feed, key, hash, order) from before; what the items say since goes before it. Its rows count as older than all items.
    """
    own = items.where(_C(key).isNotNull()).select(feed, key, hash_, order, F.lit(1).alias("__later"))
    if start is not None:
        own = own.unionByName(start.select(feed, key, hash_, order, F.lit(0).alias("__later")))
    at = F.struct("__later", order)
    last = own.groupBy(feed, key).agg(F.max_by(hash_, at).alias(hash_), F.max(at).alias("__at")).select(feed, key, hash_, _C(f"__at.{order}").alias(order), _C("__at.__later").alias("__later"))
    return first_rows(last, [feed], [F.desc("__later"), F.desc(order), key], cap, name="recency").drop("__later")


def proven_state(state: DataFrame, clean: DataFrame, feed: str, key: str, hash_: str = "content_hash") -> DataFrame:
    """The part of a state whose rows stand in clean: an item that was seen but not written is new again."""
    return state.join(clean.select(feed, key, hash_).distinct(), [feed, key, hash_], "left_semi")
