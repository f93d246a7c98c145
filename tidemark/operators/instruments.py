"""Assets and instruments: alias resolution on distinct symbols, by equi-joins with small dimensions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import venue_name
from ..schemas import ASSET

# Assets, their aliases (alias, type, venue), the instruments with explicit entries, quotes in order of trial.
ASSETS = [
    ("crypto:BTC", "BTC", "Bitcoin", [("BTC", "symbol", None), ("XBT", "symbol", "kraken"), ("BITCOIN", "name", None)]),
    ("crypto:ETH", "ETH", "Ethereum", [("ETH", "symbol", None), ("ETHER", "name", None), ("ETHEREUM", "name", None)]),
    ("crypto:SOL", "SOL", "Solana", [("SOL", "symbol", None), ("SOLANA", "name", None)]),
    ("crypto:XRP", "XRP", "XRP", [("XRP", "symbol", None), ("RIPPLE", "name", None)]),
    ("crypto:DOGE", "DOGE", "Dogecoin", [("DOGE", "symbol", None), ("DOGECOIN", "name", None)]),
    ("crypto:BNB", "BNB", "BNB", [("BNB", "symbol", None), ("BINANCE COIN", "name", None)]),
    ("crypto:ADA", "ADA", "Cardano", [("ADA", "symbol", None), ("CARDANO", "name", None)]),
    ("stablecoin:USDT", "USDT", "Tether USD", [("USDT", "symbol", None), ("TETHER", "name", None)]),
    ("stablecoin:USDC", "USDC", "USD Coin", [("USDC", "symbol", None), ("USD COIN", "name", None)]),
    ("fiat:USD", "USD", "US Dollar", [("USD", "symbol", None), ("US DOLLAR", "name", None)]),
]
PERPS = [("binance-futures", "BTCUSDT", "BTC", "USDT", "USDT"), ("binance-futures", "ETHUSDT", "ETH", "USDT", "USDT"), ("deribit", "BTC-PERPETUAL", "BTC", "USD", "BTC"), ("deribit", "ETH-PERPETUAL", "ETH", "USD", "ETH")]
QUOTES = ("USDT", "USDC", "USD", "BTC", "ETH")
_PAIR = f"struct<base_asset:{ASSET},quote_asset:{ASSET}>"


def _local(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A fixed table of text columns as a local relation: its size is known, so a join with it needs no exchange of the other side."""
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.string()) for n, c in zip(names, columns, strict=True)}))


def asset_aliases(spark: SparkSession, asset_id: str | None = None) -> DataFrame:
    rows = [(a, s, alias, name, kind, venue, "active") for a, s, name, aliases in ASSETS for alias, kind, venue in aliases if asset_id in (None, a)]
    return _local(spark, rows, "asset_id", "canonical_symbol", "alias", "name", "alias_type", "venue", "status")


def instrument_aliases(spark: SparkSession, venue: str | None = None, instrument_type: str | None = None) -> DataFrame:
    ids = {s: a for a, s, _, _ in ASSETS}
    rows = [(f"perp:{v}:{s}", v, s, f"{b}/{q}-PERP", "perp", ids[b], ids[q], ids[k], "active") for v, s, b, q, k in PERPS if venue in (None, v) and instrument_type in (None, "perp")]
    return _local(spark, rows, "instrument_id", "venue", "venue_symbol", "canonical_symbol", "instrument_type", "base_asset_id", "quote_asset_id", "settlement_asset_id", "status")


def dimension_summary(aliases: DataFrame, instruments: DataFrame) -> DataFrame:
    """asset_count, asset_alias_count, instrument_alias_count, venues (sorted)."""
    assets = aliases.select("asset_id", F.lit(None).cast("string").alias("venue"))
    both = assets.unionByName(instruments.select(F.lit(None).cast("string").alias("asset_id"), "venue"))
    return both.agg(F.countDistinct("asset_id").alias("asset_count"), F.count("asset_id").alias("asset_alias_count"), F.count("venue").alias("instrument_alias_count"), F.array_sort(F.collect_set("venue")).alias("venues"))


def resolve_assets(df: DataFrame, aliases: DataFrame, symbol: str, out: str) -> DataFrame:
    """Adds `out`: struct(symbol, asset_id, canonical_symbol, name), or null; aliases are not bound to venues."""
    asset = F.struct(F.col("canonical_symbol").alias("symbol"), "asset_id", "canonical_symbol", "name")
    small = aliases.groupBy(F.upper(F.trim("alias")).alias("__alias")).agg(F.first(asset).alias(out))
    return df.withColumn("__alias", F.upper(F.trim(F.col(symbol)))).join(small, "__alias", "left").drop("__alias")


def _spot(distinct: DataFrame, aliases: DataFrame) -> DataFrame:
    """(value, venue) -> with spot struct(base, quote) of the first quote in order that fits, rows without one left out."""
    ranked = distinct.select("value", "venue", F.posexplode(F.array(*map(F.lit, QUOTES))).alias("rank", "q")).where(F.col("value").endswith(F.col("q")) & (F.length("value") > F.length("q")))
    ranked = ranked.withColumn("b", F.expr("left(value, length(value) - length(q))"))
    both = resolve_assets(resolve_assets(ranked, aliases, "b", "base_asset"), aliases, "q", "quote_asset").where("base_asset is not null and quote_asset is not null")
    return both.groupBy("value", "venue").agg(F.min_by(F.struct("base_asset", "quote_asset"), "rank").alias("spot"))


def _ref(id_: Column, venue: Column, symbol: Column, canonical: Column, kind: str, base: Column, quote: Column) -> Column:
    return F.struct(id_.alias("instrument_id"), venue.alias("venue"), symbol.alias("venue_symbol"), canonical.alias("canonical_symbol"), F.lit(kind).alias("instrument_type"), base.alias("base_asset"), quote.alias("quote_asset"))


def resolve(symbols: DataFrame, kind: str | None = None, aliases: DataFrame | None = None, instruments: DataFrame | None = None) -> DataFrame:
    """(symbol, venue) -> each distinct pair with `instrument`. kind: spot, perp, or None (explicit entry, then spot, then perp)."""
    spark = symbols.sparkSession
    aliases = asset_aliases(spark) if aliases is None else aliases
    instruments = instrument_aliases(spark) if instruments is None else instruments
    pairs = symbols.select("symbol", "venue").distinct()
    pairs = pairs.withColumns({"v": venue_name(F.col("venue")), "s": F.upper(F.trim("symbol"))})
    pairs = pairs.withColumns({"spot_value": F.translate("s", "/", ""), "perp_value": F.translate(F.regexp_replace(F.regexp_replace("s", "_PERP$", ""), "PERP$", ""), "-_/", "")})
    values = pairs.select(F.explode(F.array("spot_value", "perp_value")).alias("value"), F.col("v").alias("venue")).where("value <> ''").distinct()
    spot = _spot(values, aliases)
    own = spot.select(F.col("value").alias("spot_value"), F.col("venue").alias("v"), F.col("spot").alias("as_spot"))
    like = spot.select(F.col("value").alias("perp_value"), F.col("venue").alias("v"), F.col("spot").alias("as_perp"))
    ids = aliases.where("upper(alias) = canonical_symbol")
    asset = F.struct(F.col("canonical_symbol").alias("symbol"), "asset_id", "canonical_symbol", "name")
    named = ids.groupBy("asset_id").agg(F.first(asset).alias("asset"))
    explicit = instruments.join(named.select(F.col("asset_id").alias("base_asset_id"), F.col("asset").alias("base")), "base_asset_id").join(named.select(F.col("asset_id").alias("quote_asset_id"), F.col("asset").alias("quote")), "quote_asset_id", "left")
    explicit = explicit.where((F.lit(kind).isNull()) | (F.col("instrument_type") == F.lit(kind))).groupBy(F.col("venue").alias("v"), F.upper("venue_symbol").alias("s")).agg(F.first(F.struct("instrument_id", "venue", "venue_symbol", "canonical_symbol", "instrument_type", F.col("base").alias("base_asset"), F.col("quote").alias("quote_asset"))).alias("explicit"))
    rows = pairs.join(own, ["spot_value", "v"], "left").join(like, ["perp_value", "v"], "left").join(explicit, ["v", "s"], "left")
    rows = resolve_assets(resolve_assets(rows.withColumns({"b": F.substring_index("s", "-", 1), "q": F.lit("USD")}), aliases, "b", "deribit_base"), aliases, "q", "deribit_quote")
    found = _found(F.col("v"), F.col("s"), F.col("spot_value"), F.col("as_spot"), F.col("as_perp"), F.col("explicit"), F.col("deribit_base"), F.col("deribit_quote"), kind)
    return rows.select("symbol", "venue", found.alias("instrument"))


def _found(v: Column, s: Column, spot_value: Column, as_spot: Column, as_perp: Column, explicit: Column, deribit_base: Column, deribit_quote: Column, kind: str | None) -> Column:
    """The instrument of an upper-cased symbol, from its candidates; null for an empty symbol."""
    slash = lambda b, q, tail="": F.concat(b["symbol"], F.lit("/"), q["symbol"], F.lit(tail))
    sb, sq, pb, pq = as_spot["base_asset"], as_spot["quote_asset"], as_perp["base_asset"], as_perp["quote_asset"]
    spot_ref = F.when(as_spot.isNotNull(), _ref(F.concat(F.lit("spot:"), v, F.lit(":"), spot_value), v, spot_value, slash(sb, sq), "spot", sb, sq))
    perp_id = F.concat(F.lit("perp:"), v, F.lit(":"), s)
    deribit = (v == "deribit") & s.endswith("-PERPETUAL")
    perp_ref = F.when(deribit & deribit_base.isNotNull(), _ref(perp_id, v, s, slash(deribit_base, deribit_quote, "-PERP"), "perp", deribit_base, deribit_quote)).when(~deribit & as_perp.isNotNull(), _ref(perp_id, v, s, slash(pb, pq, "-PERP"), "perp", pb, pq))
    return F.when(s != "", {"spot": spot_ref, "perp": F.coalesce(explicit, perp_ref), None: F.coalesce(explicit, spot_ref, perp_ref)}[kind])


def _asset(asset_id: str, symbol: str, name: str) -> Column:
    return F.struct(F.lit(symbol).alias("symbol"), F.lit(asset_id).alias("asset_id"), F.lit(symbol).alias("canonical_symbol"), F.lit(name).alias("name"))


def with_instrument(df: DataFrame, kind: str | None = None, symbol: str = "symbol", venue: str = "source") -> DataFrame:
    """Adds `instrument` by the fixed dimension alone: its few dozen rows are constants, so rows are neither joined nor read twice."""
    assets = {s: _asset(a, s, name) for a, s, name, _ in ASSETS}
    known = F.create_map(*(x for _, s, _, aliases in ASSETS for alias, _, _ in aliases for x in (F.lit(alias), assets[s])))
    listed = F.create_map(*(x for v, s, b, q, _ in PERPS for x in (F.lit(f"{v} {s}"), _ref(F.lit(f"perp:{v}:{s}"), F.lit(v), F.lit(s), F.lit(f"{b}/{q}-PERP"), "perp", assets[b], assets[q]))))
    pair = lambda value: F.coalesce(*(F.when(value.endswith(q) & (F.length(value) > len(q)) & known[F.rtrim(F.left(value, F.length(value) - len(q)))].isNotNull(), F.struct(known[F.rtrim(F.left(value, F.length(value) - len(q)))].alias("base_asset"), assets[q].alias("quote_asset"))) for q in QUOTES))
    rows = df.withColumns({"__v": venue_name(F.col(venue)), "__s": F.upper(F.trim(F.col(symbol)))})
    spot_value, perp_value = F.translate("__s", "/", ""), F.translate(F.regexp_replace(F.regexp_replace("__s", "_PERP$", ""), "PERP$", ""), "-_/", "")
    rows = rows.withColumns({"__spot": pair(spot_value) if kind != "perp" else F.lit(None).cast(_PAIR), "__perp": pair(perp_value) if kind != "spot" else F.lit(None).cast(_PAIR)})
    found = _found(F.col("__v"), F.col("__s"), spot_value, F.col("__spot"), F.col("__perp"), listed[F.concat("__v", F.lit(" "), "__s")], known[F.trim(F.substring_index("__s", "-", 1))], assets["USD"], kind)
    return rows.withColumn("instrument", found).drop("__v", "__s", "__spot", "__perp")


def legacy_asset_id(c: Column) -> Column:
    """Old ids `asset:btc` become `crypto:BTC` and so on; others pass."""
    pairs = [x for a, s, _, _ in ASSETS for x in (F.lit(f"asset:{s.lower()}"), F.lit(a))]
    return F.coalesce(F.create_map(*pairs)[c], c)
