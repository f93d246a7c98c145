"""Scalar expressions: tolerant parsing, sides, symbols, hashes, partition values. All are plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_errors() -> Column:
    return F.array().cast("array<string>")


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def bad(c: Column, value: Column, name: str) -> Column:
    """[invalid_<name>] where a value is there but was not understood."""
    return F.when(~blank(c) & value.isNull(), F.array(F.lit(f"invalid_{name}"))).otherwise(no_errors())


class Fields:
    """Reads optional fields of text columns; unreadable ones are null and leave their name in `errors()`."""

    def __init__(self) -> None:
        self.found: list[Column] = []

    def _read(self, c: Column, value: Column, name: str) -> Column:
        self.found.append(bad(c, value, name))
        return value

    def integer(self, c: Column, name: str) -> Column:
        return self._read(c, c.try_cast("bigint"), name)

    def number(self, c: Column, name: str) -> Column:
        return self._read(c, c.try_cast("double"), name)

    def boolean(self, text: Column, typed: Column, name: str) -> Column:
        """typed: the same field read as a JSON boolean, so that text like "true" is not one."""
        return self._read(text, typed, name)

    def epoch_ms(self, c: Column) -> Column:
        return self._read(c, F.timestamp_millis(c.try_cast("bigint")), "event_time")

    def iso(self, c: Column) -> Column:
        return self._read(c, iso_timestamp(c), "event_time")

    def mapped(self, c: Column, value: Column, name: str) -> Column:
        return self._read(c, value, name)

    def levels(self, raw: Column, parsed: Column, name: str, price: str | int = 0, size: str | int = 1) -> Column:
        """Levels of arrays or objects; a bad level is dropped and named, a size of 0 stays. raw: the field's text."""
        at = lambda x, k: F.get(x, k) if isinstance(k, int) else x[k]
        read = F.transform(parsed, lambda x: F.struct(at(x, price).try_cast("double").alias("price"), at(x, size).try_cast("double").alias("size")))
        good = F.coalesce(F.filter(read, lambda x: x["price"].isNotNull() & x["size"].isNotNull()), F.array().cast("array<struct<price:double,size:double>>"))
        lost = F.when(~blank(raw) & parsed.isNull(), 1).otherwise(F.coalesce(F.size(read), F.lit(0)) - F.size(good))
        self.found.append(F.array_repeat(F.lit(f"invalid_{name}"), lost))
        return good

    def errors(self, *more: Column) -> Column:
        return F.concat(*self.found, *more) if self.found or more else no_errors()


def iso_timestamp(c: Column) -> Column:
    """ISO-8601; without an offset it is UTC (the session's zone)."""
    return F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}"), F.trim(c).try_cast("timestamp"))


def source_timestamp(c: Column) -> Column:
    """RFC-822, then ISO-8601."""
    day = F.regexp_replace(F.trim(c), r"^\w{3},\s*", "")
    return F.coalesce(F.try_to_timestamp(day, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(day, F.lit("d MMM yyyy HH:mm:ss xx")), iso_timestamp(c))


def finite_positive(c: Column) -> Column:
    """Not null, NaN, infinite, zero or negative (NaN sorts above infinity)."""
    return F.coalesce((c > 0) & ~F.isnan(c) & (c < F.lit(float("inf"))), F.lit(False))


def skew_ms(received: Column, claimed: Column) -> Column:
    """Signed delay in milliseconds."""
    return (F.unix_micros(received) - F.unix_micros(claimed)) / 1000


def side_of_maker_flag(buyer_is_maker: Column) -> Column:
    return F.when(buyer_is_maker, "sell").when(~buyer_is_maker, "buy")


def flipped_side(maker: Column) -> Column:
    """Aggressor's side from the resting order's."""
    return F.when(maker == "buy", "sell").when(maker == "sell", "buy")


def taker_side(c: Column, buy: str, sell: str) -> Column:
    return F.when(c == buy, "buy").when(c == sell, "sell")


def plain_symbol(c: Column) -> Column:
    return F.translate(c, "-_/", "")


def swap_symbol(c: Column) -> Column:
    return plain_symbol(F.regexp_replace(F.upper(c), "-SWAP$", ""))


def venue_name(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("binance_futures", "binancefutures"), "binance-futures").otherwise(low)


def content_hash(*fields: Column) -> Column:
    """SHA-256 of a compact JSON array of the fields, null as empty text."""
    out = F.to_json(F.array(*(F.coalesce(f.cast("string"), F.lit("")) for f in fields)))
    # Control escapes in small letters, as other JSON writers have them. Pairs of backslashes stand aside as a raw control, which JSON never holds.
    low = F.replace(out, F.lit("\\\\"), F.lit("\x01"))
    for code in (0x0B, 0x0E, 0x0F, *range(0x1A, 0x20)):
        low = F.replace(low, F.lit(f"\\u{code:04X}"), F.lit(f"\\u{code:04x}"))
    out = F.when(F.contains(out, F.lit("\\u00")), F.replace(low, F.lit("\x01"), F.lit("\\\\"))).otherwise(out)
    return F.sha2(out, 256)


def fixed10(c: Column) -> Column:
    return F.coalesce(F.format_string("%.10f", c.cast("double")), F.lit(""))


def quote_id(symbol: Column, bid: Column, ask: Column, size: Column, close: Column) -> Column:
    parts = [F.coalesce(symbol, F.lit("")), *(F.when(c.isNull(), "").otherwise(fixed10(c)) for c in (bid, ask, size)), F.coalesce(close.cast("string"), F.lit(""))]
    return F.sha2(F.concat_ws("|", *parts), 256)


def cents_price(token: Column, dollars: Column) -> Column:
    """A price from its JSON token: `_dollars` wins; integers are cents; other numbers above 1 are cents, else dollars."""
    number = token.try_cast("double")
    own = F.when(token.rlike(r"^-?\d+$"), number / 100).when(number > 1, number / 100).otherwise(number)
    return F.coalesce(finite(dollars.try_cast("double")), finite(own))


def finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def truthy(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin("true", "1", "yes"), True).when(low.isin("false", "0", "no"), False)


# Label -> seconds.
FREQUENCIES = {"fifteen_min": 900, "hourly": 3600, "daily": 86400, "weekly": 604800, "monthly": 2592000, "annual": 31536000}


def frequency_seconds(c: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in FREQUENCIES.items() for x in pair))[F.lower(c)]


_LANE = r"^([^_]+)(_perp)?_(depth|trades|funding|text|quotes)(?:_(.+))?$"


def lane_parts(lane: Column) -> Column:
    """struct(venue, dataset, instrument) of `<venue>[_perp]_<dataset>[_<instrument>]`, or null."""
    part = lambda i: F.regexp_extract(lane, _LANE, i)
    return F.when(lane.rlike(_LANE), F.struct(F.concat(part(1), F.when(part(2) != "", "_perp").otherwise("")).alias("venue"), part(3).alias("dataset"), F.when(part(4) != "", part(4)).alias("instrument")))


def run_day(run: Column) -> Column:
    """The day of a run named yyyyMMdd_HHmmss, or null."""
    return F.to_date(F.try_to_timestamp(F.substring(run, 1, 8), F.lit("yyyyMMdd")))


def run_started(run: Column) -> Column:
    return F.try_to_timestamp(run, F.lit("yyyyMMdd_HHmmss"))


def path_value(path: Column, key: str) -> Column:
    """The value of a `key=value` folder of a path, or null."""
    found = F.regexp_extract(path, rf"(?:^|/){key}=([^/]*)", 1)
    return F.when(found != "", found)


def partition_value(c: Column) -> Column:
    """Path-safe: `/` becomes `-`, other characters that are no letter, digit, `-`, `_` or `.` become `_`; empty is `unknown`."""
    safe = F.regexp_replace(F.translate(F.trim(c), "/", "-"), r"[^\p{L}\p{N}\-_.]", "_")
    return F.when(blank(safe), "unknown").otherwise(safe)


def day_end(c: Column) -> Column:
    return F.date_trunc("day", c) + F.expr("interval 1 day")
