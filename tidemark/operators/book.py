"""Order books: final state by last write, per-event best prices and checksums by a fold over each anchored sub-book."""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .gates import up_to
from .segments import PIECE, cut, last_values

_C = F.col


def sub_books(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds `book`: snapshots so far in the run; each starts a book of its own (0: before any)."""
    snap = F.when(_C("event_type") == "snapshot", 1).otherwise(0)
    return updates.withColumn("book", F.sum(snap).over(up_to(keys, order)))


def final_levels(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, side, price, size) of each run's last book: the last write of a price stands, size 0 removes it.

    In a snapshot only positive sizes count; in a difference any size but 0 does. updates: with `book`.
    """
    last = updates.groupBy(*keys).agg(F.max("book").alias("book"))
    own = updates.join(last, [*keys, "book"], "left_semi")
    sides = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(c).alias("levels")) for s, c in (("bid", "bids"), ("ask", "asks")))))
    flat = own.select(*keys, *order, "event_type", sides.alias("x")).select(*keys, *order, "event_type", "x.side", F.posexplode("x.levels").alias("pos", "level"))
    flat = flat.where((_C("event_type") != "snapshot") | _C("event_type").isNull() | (_C("level.size") > 0))
    return flat.groupBy(*keys, "side", _C("level.price").alias("price")).agg(F.max_by("level.size", F.struct(*order, "pos")).alias("size")).where("size <> 0")


def top_levels(levels: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """Per run: best prices, spread, level counts, and the best n levels a side as arrays of (price, size)."""
    bid, ask = _C("side") == "bid", _C("side") == "ask"
    pairs = F.struct("price", "size")
    out = levels.groupBy(*keys).agg(F.max(F.when(bid, _C("price"))).alias("best_bid"), F.min(F.when(ask, _C("price"))).alias("best_ask"), F.count_if(bid).alias("bid_levels"), F.count_if(ask).alias("ask_levels"), F.slice(F.sort_array(F.collect_list(F.when(bid, pairs)), asc=False), 1, n).alias("top_bids"), F.slice(F.sort_array(F.collect_list(F.when(ask, pairs))), 1, n).alias("top_asks"))
    return out.withColumn("spread", _C("best_ask") - _C("best_bid"))


def _flat(lists: pa.Array) -> tuple[list[int], list[float], list[float]]:
    """Ends of each event's levels, and all prices and sizes in a row."""
    levels = lists.flatten()
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    plain = lambda x: x.to_pylist() if x.null_count else x.to_numpy(zero_copy_only=False).tolist()
    return [0, *ends.tolist()], plain(levels.field("price")), plain(levels.field("size"))


def _starts(names: list[pa.Array], last: list | None) -> tuple[list[bool], list]:
    """Does a row's name differ from that of the row before (last: of the batch before), and the last row's name."""
    n = len(names[0])
    if any(pa.types.is_nested(x.type) for x in names):
        of = list(zip(*(x.to_pylist() for x in names), strict=True))
        starts = [list(of[0]) != last, *(a != b for a, b in zip(of, of[1:], strict=False))]
        return starts, list(of[-1])
    other = np.zeros(n - 1, bool)
    for x in names:
        a, b = x.slice(0, n - 1), x.slice(1)
        other |= pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)
    return [[x[0].as_py() for x in names] != last, *other.tolist()], [x[n - 1].as_py() for x in names]


def with_starts(updates: DataFrame, keys: list[str], order: list[str], pieces: int | None = None) -> DataFrame:
    """The updates in pieces (see `segments`), and before each piece that goes on with a sub-book an event `start` with the book's levels then.

    Last writes compose: the last write of each price in each piece (aggregated before the shuffle) stands until a later piece's.
    So every piece has its starting book and can be folded by itself. updates: with `book`.
    """
    names = [*keys, "book"]
    rows = cut(updates.select(*names, *order, "event_type", "bids", "asks"), names, order, pieces)
    sides = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(c).alias("levels")) for s, c in (("bid", "bids"), ("ask", "asks")))))
    flat = rows.select(PIECE, *names, *order, "event_type", sides.alias("x")).select(PIECE, *names, *order, "event_type", "x.side", F.posexplode("x.levels").alias("pos", "level"))
    flat = flat.where((_C("event_type") != "snapshot") | _C("event_type").isNull() | (_C("level.size") > 0))
    span = rows.groupBy(*names).agg(F.min(PIECE).alias("first"), F.max(PIECE).alias("last")).where("first < last")  # sub-books of several pieces
    writes = flat.groupBy(PIECE, *names, "side", _C("level.price").alias("price")).agg(F.max_by("level.size", F.struct(*order, "pos")).alias("size"))
    writes = writes.join(span, names)
    later = F.lead(PIECE).over(Window.partitionBy(*names, "side", "price").orderBy(PIECE))
    until = writes.withColumn("until", F.coalesce(later, "last")).where((_C("size") != 0) & (_C(PIECE) < _C("until")))
    held = until.select(*names, "side", "price", "size", F.explode(F.sequence(_C(PIECE) + 1, "until")).alias(PIECE))
    levels = lambda s: F.collect_list(F.when(_C("side") == s, F.struct("price", "size")))
    books = held.groupBy(PIECE, *names).agg(levels("bid").alias("bids"), levels("ask").alias("asks"))
    return rows.unionByName(books.withColumn("event_type", F.lit("start")), allowMissingColumns=True)


def _standing(updates: DataFrame, keys: list[str], order: list[str], names: list[str] = ()) -> tuple[dict, DataFrame]:
    """The types of keys, book and order, and the updates with each sub-book, or piece of one, sorted in a partition."""
    kind = {c: updates.schema[c].dataType for c in [*keys, "book", *order]}
    first = F.when(_C("event_type") == "start", 0).otherwise(1)  # before its piece's events
    return kind, updates.select(*kind, "event_type", "bids", "asks", *names).repartition(*names, *keys, "book").sortWithinPartitions(*names, *keys, "book", first, *order)


def _folded(updates: DataFrame, keys: list[str], order: list[str], made: str, fold: Callable[[Iterator], Iterator[tuple]]) -> DataFrame:
    """(keys, book, order and `made`) of every event: `fold` is given (whether the sub-book is new, a snapshot, bids, asks) in order.

    Sub-books, or their pieces with a starting book each, stand sorted in a partition and stream past, so none is held whole
    and each costs no call of its own.
    """
    names = [PIECE] if PIECE in updates.columns else []
    kind, rows = _standing(updates, keys, order, names)
    levels = pa.list_(pa.struct([("price", pa.float64()), ("size", pa.float64())]))
    types = [levels if "array" in x else pa.float64() for x in made.split(", ")]
    shape = StructType([StructField(c, t) for c, t in kind.items()] + list(StructType.fromDDL(made)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feed: deque = deque()
        results = fold(feed.popleft() for _ in iter(int, 1))  # one fold that goes on from batch to batch
        last = None
        for batch in batches:
            of = list(zip(*(batch.column(c).to_pylist() for c in (*names, *keys, "book")), strict=True))
            sides = [_flat(batch.column(c)) for c in ("bids", "asks")]
            events = batch.column("event_type").to_pylist()
            held = []
            for n, (name, event) in enumerate(zip(of, events, strict=True)):
                own = [list(zip(prices[ends[n] : ends[n + 1]], sizes[ends[n] : ends[n + 1]], strict=True)) for ends, prices, sizes in sides]
                feed.append((name != last, event == "snapshot", own))
                last = name
                held.append(next(results))
            columns = list(zip(*held, strict=True)) or [()] * len(types)
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kind), *(pa.array(list(c), t) for c, t in zip(columns, types, strict=True))], names=shape.names)
            yield out.filter(pa.array([e != "start" for e in events], pa.bool_()))

    return rows.mapInArrow(run, shape)


def _apply(book: dict[float, float], snapshot: bool, levels: list[tuple[float, float]]) -> None:
    if snapshot:
        book.clear()
        book.update((p, s) for p, s in levels if s > 0)
        return
    for p, s in levels:
        if s == 0:
            book.pop(p, None)
        else:
            book[p] = s


def fold(updates: DataFrame, keys: list[str], order: str | list[str], depth: int | None = None, top: int = 10) -> DataFrame:
    """(keys, book, order, best_bid, best_ask, top_bids, top_asks) after every event of each sub-book.

    Long sub-books are cut into pieces that start from their book then (`with_starts`). A depth bounds the book after each event: a
    level that falls out does not come back, which no last write tells, so with a depth a sub-book is folded in one go,
    streaming. updates: with `book`. `best_prices` is cheaper where best prices are enough.
    """
    order = [order] if isinstance(order, str) else order

    def run(events: Iterator[tuple]) -> Iterator[tuple]:
        books: tuple[dict, dict] = ({}, {})
        for new, snapshot, sides in events:
            tops = []
            for side, (book, levels) in enumerate(zip(books, sides, strict=True)):
                if new:
                    book.clear()
                _apply(book, snapshot, levels)
                if depth is not None and len(book) > depth:
                    for price in (heapq.nsmallest if side == 0 else heapq.nlargest)(len(book) - depth, book):
                        del book[price]
                best = heapq.nlargest(top, book) if side == 0 else heapq.nsmallest(top, book)
                tops.append([(p, book[p]) for p in best])
            yield *(x[0][0] if x else None for x in tops), *tops

    level = "array<struct<price:double,size:double>>"
    made = f"best_bid double, best_ask double, top_bids {level}, top_asks {level}"
    return _folded(updates if depth is not None else with_starts(updates, keys, order), keys, order, made, run)


def best_prices(updates: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """(keys, book, order, best_bid, best_ask) after every event of each sub-book: a heap a side, whose dead prices go when they surface.

    Long sub-books are cut into pieces that start from their book then (`with_starts`).
    """
    order = [order] if isinstance(order, str) else order

    def run(events: Iterator[tuple]) -> Iterator[tuple]:
        books, heaps = ({}, {}), ([], [])
        for new, snapshot, sides in events:
            best = []
            for sign, book, heap, levels in zip((-1, 1), books, heaps, sides, strict=True):
                if new:
                    book.clear()
                if new or snapshot:
                    heap.clear()
                for p, _ in levels:
                    if snapshot or p not in book:
                        heapq.heappush(heap, sign * p)
                _apply(book, snapshot, levels)
                while heap and sign * heap[0] not in book:
                    heapq.heappop(heap)
                best.append(sign * heap[0] if heap else None)
            yield tuple(best)

    return _folded(with_starts(updates, keys, order), keys, order, "best_bid double, best_ask double", run)


def checksums(updates: DataFrame, keys: list[str], order: str | list[str], price_decimals: int, size_decimals: int, depth: int | None = 10, top: int = 10) -> DataFrame:
    """(keys, book, order, event_type, crc) after every event of each sub-book: what `book_crc` tells of `fold`, made while the books stream past.

    A level is put into digits once, when it is written, and only sides that an event touches are joined again. A depth bounds the
    book after each event, so a sub-book is one task's, streaming. updates: with `book`.
    """
    order = [order] if isinstance(order, str) else order
    kind, rows = _standing(updates, keys, order)

    def digits(value: float, decimals: int) -> str:
        return f"{value:.{decimals}f}".replace(".", "").lstrip("0") or "0"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, made, text = ([], []), ([], []), ["", ""]  # a side's signed prices from the best, their levels' digits, its text
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, last = _starts([batch.column(c) for c in (*keys, "book")], last)
            snapshots = pc.fill_null(pc.equal(batch.column("event_type"), "snapshot"), False).to_numpy(zero_copy_only=False).tolist()
            sides = [(i, sign, best[i], made[i], *_flat(batch.column(c))) for i, (c, sign) in enumerate((("bids", -1), ("asks", 1)))]
            sums = []
            for n, (new, snapshot) in enumerate(zip(starts, snapshots, strict=True)):
                for i, sign, places, levels, ends, prices, sizes in sides:
                    start, end = ends[n], ends[n + 1]
                    if new or snapshot:
                        places.clear()
                        levels.clear()
                    elif start == end:
                        continue
                    for at in range(start, end):
                        price, size = sign * prices[at], sizes[at]
                        place = bisect_left(places, price)
                        known = place < len(places) and places[place] == price
                        if size == 0 or (snapshot and not size > 0):
                            if known and not snapshot:
                                del places[place], levels[place]
                        elif known:
                            levels[place] = digits(sign * places[place], price_decimals) + digits(size, size_decimals)
                        else:
                            places.insert(place, price)
                            levels.insert(place, digits(prices[at], price_decimals) + digits(size, size_decimals))
                    if depth is not None:
                        del places[depth:], levels[depth:]
                    text[i] = "".join(levels[:top])
                sums.append(zlib.crc32((text[1] + text[0]).encode()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*kind, "event_type")), pa.array(sums, pa.int64())], names=[*kind, "event_type", "crc"])

    return rows.mapInArrow(run, StructType([StructField(c, t) for c, t in kind.items()] + list(StructType.fromDDL("event_type string, crc bigint"))))


def crossed_counts(states: DataFrame, keys: list[str]) -> DataFrame:
    """Events after which the best bid was not below the best ask."""
    return states.groupBy(*keys).agg(F.count_if(F.coalesce(_C("best_bid") >= _C("best_ask"), F.lit(False))).alias("crossed_book_count"))


def snapshot_states(updates: DataFrame) -> DataFrame:
    """Best prices of streams of full books: no state, so no fold."""
    price = lambda c: F.transform(F.filter(c, lambda x: x["size"] > 0), lambda x: x["price"])
    return updates.withColumns({"best_bid": F.array_max(price("bids")), "best_ask": F.array_min(price("asks"))})


def _digits(value: Column, decimals: int) -> Column:
    plain = F.ltrim(F.replace(F.format_string(f"%.{decimals}f", value), F.lit("."), F.lit("")), F.lit("0"))
    return F.when(plain == "", "0").otherwise(plain)


def book_crc(bids: Column, asks: Column, price_decimals: int, size_decimals: int, top: int = 10) -> Column:
    """CRC32 of the best asks, then bids: prices and sizes in fixed decimals without point and leading zeros."""
    text = lambda side: F.array_join(F.transform(F.slice(side, 1, top), lambda x: F.concat(_digits(x["price"], price_decimals), _digits(x["size"], size_decimals))), "")
    return F.crc32(F.concat(text(asks), text(bids)).cast("binary"))


def checksum_counts(states: DataFrame, keys: list[str], expected: str, price_decimals: int, size_decimals: int) -> DataFrame:
    """Per run: checked, mismatching and missing checksums. states: `checksums` or `fold` output with the expected value joined."""
    own = _C("crc") if "crc" in states.columns else book_crc(_C("top_bids"), _C("top_asks"), price_decimals, size_decimals)
    return states.groupBy(*keys).agg(F.count(expected).alias("checksum_checked_count"), F.count_if(_C(expected) != own).alias("checksum_mismatch_count"), F.count_if(_C(expected).isNull()).alias("checksum_missing_count"))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], on: str, values: list[str]) -> DataFrame:
    """Each left row with the values of the last right row of its key at or before it: a union and a segmented scan, no range join.

    A key with a large share of all rows is cut by time into pieces, so no task holds it.
    """
    extra = [c for c in left.columns if c not in (*keys, on)]
    both = left.withColumns({"__r": F.lit(1), "__v": F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType)}).unionByName(right.select(*keys, on, F.lit(0).alias("__r"), F.struct(*values).alias("__v")), allowMissingColumns=True)
    order = [on, "__r"]
    found = last_values(cut(both, keys, order), keys, order, {"__found": _C("__v")}, current=True)
    return found.where("__r = 1").select(*keys, on, *extra, *(_C("__found")[v].alias(v) for v in values))


def bridges(buffered: DataFrame, anchors: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Do buffered windows bridge a snapshot? Of windows beyond the anchor, the first must reach back to it; none: null.

    A run's windows up to its anchor are left out of `kept`.
    """
    own = buffered.join(anchors.select(*keys, "snapshot_last_update_id"), keys).where(_C("final_update_id") > _C("snapshot_last_update_id"))
    first = own.groupBy(*keys).agg(F.min_by("first_update_id", F.struct(*order)).alias("first"), F.count("*").alias("kept"))
    return anchors.join(first, keys, "left").select(*keys, F.coalesce("kept", F.lit(0)).alias("kept"), (_C("first") <= _C("snapshot_last_update_id") + 1).alias("bridges"))
