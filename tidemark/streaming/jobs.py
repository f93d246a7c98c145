"""Structured Streaming: the same gates over streams of frames, run windows, stateful cursor, dedup, book and timers, idempotent sinks."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions.scalars import finite_positive, skew_ms
from ..operators import gates
from ..schemas import FRAME

_C = F.col

# Stateful processors are classes of functions, so that they travel by value: the process that readies them on the driver
# need not find this package.

def frame_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Frames of JSON-lines files as they arrive, with their file and block; a stream promises no order of lines, so frames
    whose order matters carry a column for it (see `stateful_cursor`)."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).schema("value string").text(path)
    own = lines.select(F.from_json("value", FRAME).alias("f"), _C("_metadata.file_path").alias("file"), _C("_metadata.file_block_start").alias("block"))
    return own.where("f is not null").select("f.*", "file", "block")


def with_run(events: DataFrame, length: str = "30 minutes", at: str = "received_at", late: str = "1 hour") -> DataFrame:
    """The tumbling run of each event (start as yyyyMMdd_HHmmss) and the watermark that bounds state."""
    out = events.withWatermark(at, late) if events.isStreaming else events
    return out.withColumn("run_id", F.date_format(F.window(at, length)["start"], "yyyyMMdd_HHmmss"))


def _cursor(keys: list[str], order: list[str], columns: list[str]) -> StatefulProcessor:
    class Cursor(StatefulProcessor):
        """Highest sequence per stream and run; rows of a batch are put in their own order first."""

        def __init__(self, keys: list[str], order: list[str], columns: list[str]):
            self.keys, self.order, self.columns = keys, order, columns

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.cursor = handle.getValueState("cursor", "sequence bigint")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
            cursor = self.cursor.get()[0] if self.cursor.exists() else None
            reasons = []
            for seq, again in zip(batch["sequence"], batch["subscribe_replay"], strict=True):
                again = bool(again) if again is not None and again == again else False
                seq = None if seq is None or seq != seq else int(seq)
                if again and (seq is None or cursor is None or seq <= cursor):
                    reasons.append("subscribe_replay")
                    continue
                if not again and seq is not None and cursor is not None and seq < cursor:
                    reasons.append("non_monotonic_sequence")
                    continue
                reasons.append(None)
                if seq is not None and (cursor is None or seq > cursor):
                    cursor = seq
            if cursor is not None:
                self.cursor.update((cursor,))
            yield batch.assign(sequence_reason=pd.Series(reasons, index=batch.index, dtype=object))[[*self.columns, "sequence_reason"]]

        def close(self) -> None:
            pass

    return Cursor(keys, order, columns)


def _kept(events: DataFrame, columns: list[str], more: str) -> StructType:
    return StructType([StructField(c, events.schema[c].dataType) for c in columns] + [StructField(more, StringType())])


def stateful_cursor(events: DataFrame, keys: list[str], order: list[str], columns: list[str], at: str | None = None) -> DataFrame:
    """The gate's sequence rule over a stream: the cursor lives across micro-batches. columns: what to keep, `sequence` and `subscribe_replay` among them.

    at: the column that carries the stream's watermark, where another stateful operator follows.
    """
    kept = list(dict.fromkeys([*columns, "sequence", "subscribe_replay", *([at] if at else [])]))
    time = {"timeMode": "EventTime", "eventTimeColumnName": at} if at else {"timeMode": "None"}
    return events.groupBy(*keys).transformWithStateInPandas(statefulProcessor=_cursor(keys, order, kept), outputStructType=_kept(events, kept, "sequence_reason"), outputMode="Append", **time)


def event_gate_stream(events: DataFrame, keys: list[str], order: list[str], at: str = "received_at") -> DataFrame:
    """The whole event gate over a stream: every row rule, and the sequence rule with its cursor in state. events: with a watermark on `at`."""
    own = events.withColumn("subscribe_replay", F.coalesce("metadata.subscribe_replay", F.lit(False)))
    return gates.event_rules(stateful_cursor(own, keys, order, events.columns, at))


def _run_counters(keys: list[str], order: list[str]) -> StatefulProcessor:
    class Runs(StatefulProcessor):
        """A run's counters, a row of state; a timer at its end, by event time, emits them."""

        def __init__(self, keys: list[str], order: list[str]):
            self.keys, self.order = keys, order

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            names = ("n", "first", "last", "back", "same", "gaps", "missing", "none", "prices", "sizes", "skewed")
            self.state = handle.getValueState("run", ", ".join(f"{x} bigint" for x in names) + ", most double")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
            if self.state.exists():
                n, first, last, back, same, gaps, missing, none, prices, sizes, skewed, most = self.state.get()
            else:
                n = back = same = gaps = missing = none = prices = sizes = skewed = 0
                first = last = most = None
                self.handle.registerTimer(int(batch["end_ms"].iloc[0]))
            for id_, price, size, far, skew in zip(batch["id"], batch["bad_price"], batch["bad_size"], batch["far"], batch["skew"], strict=True):
                n, prices, sizes, skewed = n + 1, prices + int(price), sizes + int(size), skewed + int(far)
                if skew is not None and skew == skew:
                    most = float(skew) if most is None else max(most, float(skew))
                if id_ is None or id_ != id_ or id_ == "":
                    none += 1
                    continue
                id_ = int(id_)
                step = None if last is None else id_ - last
                first, last = id_ if first is None else first, id_
                if step is not None:
                    back, same, gaps, missing = back + (step < 0), same + (step == 0), gaps + (step > 1), missing + max(0, step - 1)
            self.state.update((n, first, last, back, same, gaps, missing, none, prices, sizes, skewed, most))
            return iter(())

        def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
            if self.state.exists():
                n, first, last, back, same, gaps, missing, none, prices, sizes, skewed, most = self.state.get()
                self.state.clear()
                names = (*self.keys, "event_count", "first_trade_id", "last_trade_id", "non_monotonic_count", "duplicate_trade_id_count", "trade_id_gap_count", "trade_id_gap_total_missing", "missing_trade_id_count", "invalid_price_count", "invalid_size_count", "excessive_clock_skew_count", "max_clock_skew_ms")
                yield pd.DataFrame([(*key, n, first, last, back, same, gaps, missing, none, prices, sizes, skewed, most)], columns=list(names), dtype=object)

        def close(self) -> None:
            pass

    return Runs(keys, order)


def run_verdicts(events: DataFrame, keys: list[str], order: list[str], ends_at: Column, max_skew_ms: float = 60_000) -> DataFrame:
    """Trade verdicts of runs, each emitted once when the watermark passes its end: the rules of `verdicts.trades`.

    keys: the run; ends_at: its end, from the run's columns. Batches bring a run's events in order, rows of a batch are put in order.
    """
    from ..operators import verdicts

    own = verdicts.with_trade_id(events)
    own = own.select(*keys, *(c for c in order if c not in keys), _C("id").cast("string").alias("id"), (~finite_positive(_C("price"))).alias("bad_price"), (~finite_positive(_C("size"))).alias("bad_size"), F.coalesce(_C("skew") > max_skew_ms, F.lit(False)).alias("far"), _C("skew").cast("double").alias("skew"), F.unix_millis(ends_at).alias("end_ms"))
    counts = ("event_count", "first_trade_id", "last_trade_id", "non_monotonic_count", "duplicate_trade_id_count", "trade_id_gap_count", "trade_id_gap_total_missing", "missing_trade_id_count", "invalid_price_count", "invalid_size_count", "excessive_clock_skew_count")
    shape = StructType([StructField(k, events.schema[k].dataType) for k in keys] + [StructField(c, LongType()) for c in counts] + [StructField("max_clock_skew_ms", DoubleType())])
    out = own.groupBy(*keys).transformWithStateInPandas(statefulProcessor=_run_counters(keys, order), outputStructType=shape, outputMode="Append", timeMode="EventTime")
    return verdicts.judged_trades(out)


def _seen(order: list[str], columns: list[str], ttl_ms: int | None) -> StatefulProcessor:
    class Seen(StatefulProcessor):
        """The last hash of an item; unchanged polls emit nothing. State expires after a time without polls."""

        def __init__(self, order: list[str], columns: list[str], ttl_ms: int | None):
            self.order, self.columns, self.ttl = order, columns, ttl_ms

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("hash", "hash string", self.ttl)

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
            last = self.last.get()[0] if self.last.exists() else None
            kinds = []
            for value in batch["content_hash"]:
                kinds.append("new" if last is None else "edit" if value != last else None)
                last = value
            if last is not None:
                self.last.update((last,))
            out = batch.assign(row_type=pd.Series(kinds, index=batch.index, dtype=object))
            yield out[out["row_type"].notna()][[*self.columns, "row_type"]]

        def close(self) -> None:
            pass

    return Seen(order, columns, ttl_ms)


def stateful_new_or_edit(items: DataFrame, keys: list[str], order: list[str], columns: list[str], ttl_ms: int | None = 30 * 86_400_000) -> DataFrame:
    """New and edited items of a stream of polls, by key; state is bounded by its time to live."""
    kept = list(dict.fromkeys([*columns, "content_hash"]))
    return items.groupBy(*keys).transformWithStateInPandas(statefulProcessor=_seen(order, kept, ttl_ms), outputStructType=_kept(items, kept, "row_type"), outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")


def _capped(id_: str, order: list[str], columns: list[str], cap: int) -> StatefulProcessor:
    class Capped(StatefulProcessor):
        """The last hashes of a feed's items, the least recently seen one going beyond a cap."""

        def __init__(self, id_: str, order: list[str], columns: list[str], cap: int):
            self.id, self.order, self.columns, self.cap = id_, order, columns, cap

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.items = handle.getMapState("items", "id string", "hash string, seen bigint")
            self.clock = handle.getValueState("clock", "seen bigint")

        def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: object) -> None:
            for item, value, recency in zip(initialState["id"], initialState["content_hash"], initialState["recency"], strict=True):
                if recency <= self.cap:
                    self.items.updateValue((item,), (value, -int(recency)))

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
            known = {k[0]: tuple(v) for k, v in self.items.iterator()}
            before = dict(known)
            held = dict(sorted(known.items(), key=lambda x: x[1][1]))  # least recently seen first
            clock = self.clock.get()[0] if self.clock.exists() else 0
            kinds = []
            for item, value in zip(batch[self.id], batch["content_hash"], strict=True):
                if item is None or item != item:
                    kinds.append("new")
                    continue
                last = held.pop(item, None)
                kinds.append("new" if last is None else "edit" if last[0] != value else None)
                clock += 1
                held[item] = (value, clock)
                if len(held) > self.cap:
                    del held[next(iter(held))]
            for item in before.keys() - held.keys():
                self.items.removeKey((item,))
            for item, value in held.items():
                if before.get(item) != value:
                    self.items.updateValue((item,), value)
            self.clock.update((clock,))
            out = batch.assign(row_type=pd.Series(kinds, index=batch.index, dtype=object))
            yield out[out["row_type"].notna()][[*self.columns, "row_type"]]

        def close(self) -> None:
            pass

    return Capped(id_, order, columns, cap)


def capped_new_or_edit(items: DataFrame, feed: str, id_: str, order: list[str], columns: list[str], cap: int = 5000, start: DataFrame | None = None) -> DataFrame:
    """New and edited items of a stream of polls by feed; a feed's state is its `cap` most recently seen items.

    start: the state to begin with (feed, id, content_hash, recency from 1), as `quotes.seen_state` and `proven_state` make it; it is
    read by the first batch of a new checkpoint alone. Items without an id pass as new. A feed is one task's, its state bounded by the cap.
    """
    kept = list(dict.fromkeys([*columns, id_, "content_hash"]))
    own = None
    if start is not None:
        own = start.select(_C(feed), _C(id_).cast("string").alias("id"), _C("content_hash"), _C("recency").cast("bigint").alias("recency")).groupBy(feed)
    return items.groupBy(feed).transformWithStateInPandas(statefulProcessor=_capped(id_, order, kept, cap), outputStructType=_kept(items, kept, "row_type"), outputMode="Append", timeMode="None", initialState=own)


def once_per_batch(write: Callable[[DataFrame, int], None], done: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that does nothing for a batch whose id its folder of markers already has.

    The marker follows the write, so a crash between them writes a batch again: `write` must replace what it wrote for an
    id (as `split` with a batch number does), and then each batch stands once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{done}/batch={batch_id}"
        try:
            if spark.read.text(path).limit(1).count():
                return
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
        write(batch, batch_id)
        spark.createDataFrame([(str(batch_id),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    return run


def gate_stream(events: DataFrame, gate: Callable[[DataFrame], DataFrame], clean: str, quarantine: str, checkpoint: str, done: str):
    """Gate a stream by a row-wise gate and split it, available-now. A batch's rows stand in a folder of its number, so a
    batch that is delivered again replaces itself."""
    from ..sources.sinks import split

    work = once_per_batch(lambda batch, n: split(gate(batch), clean, quarantine, n), done)
    return events.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def delay_gate(events: DataFrame, received: str = "received_at", claimed: str = "exchange_time") -> DataFrame:
    """The row-wise rules of the event gate that need no state: late and early claims, sides, prices, sizes, parse errors.

    Late rows are rejected with a reason, never dropped, so no watermark decides about them.
    """
    delay = skew_ms(_C(received), _C(claimed))
    rules = [((delay > gates.MAX_DELAY_MS) | (delay < -gates.MAX_FUTURE_MS), "stale_or_clock_skew")]
    return gates.verdict(events, *rules)


def _silence(at: str, timeout_ms: int) -> StatefulProcessor:
    class Silence(StatefulProcessor):
        """The time of a key's last frame; a timer ends a run that stays silent, and a new frame restarts it."""

        def __init__(self, at: str, timeout_ms: int):
            self.at, self.timeout = at, timeout_ms

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "ms bigint")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            times = sorted(int(x.value // 1_000_000) for part in rows for x in part[self.at])
            last = self.last.get()[0] if self.last.exists() else None
            ended = [(a, b) for a, b in zip([last, *times] if last is not None else times, times if last is not None else times[1:]) if b - a > self.timeout]
            latest = max([*times, *([last] if last is not None else [])])
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(latest + self.timeout)
            self.last.update((latest,))
            if ended:
                yield pd.DataFrame({"key": pd.Series([str(key[0])] * len(ended), dtype=object), "silent_since": pd.to_datetime([a for a, _ in ended], unit="ms", utc=True), "by_timer": False})

        def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
            last = self.last.get()[0]
            self.last.clear()
            yield pd.DataFrame({"key": pd.Series([str(key[0])], dtype=object), "silent_since": pd.to_datetime([last], unit="ms", utc=True), "by_timer": True})

        def close(self) -> None:
            pass

    return Silence(at, timeout_ms)


def silence_timer(events: DataFrame, key: str, at: str = "received_at", seconds: float = 300) -> DataFrame:
    """(key, silent_since, by_timer): each time a key fell silent, told when its next frame comes or, by event time, when the timer ends.

    events: with a watermark on `at`, which moves the timers.
    """
    return events.select(key, at).groupBy(key).transformWithStateInPandas(statefulProcessor=_silence(at, int(seconds * 1000)), outputStructType="key string, silent_since timestamp, by_timer boolean", outputMode="Append", timeMode="EventTime")


def _packed(rows: DataFrame, key: str, order: str) -> DataFrame:
    """A key's updates of an Arrow batch as one row of arrays: its key, orders, snapshots, and a side's number of levels an update, prices, sizes."""
    flat = [_C(f"{side}s.{c}").cast("array<double>").alias(f"{side}_{c}") for side in ("bid", "ask") for c in ("price", "size")]
    own = rows.select(key, _C(order).cast("bigint").alias("ord"), F.coalesce(_C("event_type") == "snapshot", F.lit(False)).alias("snapshot"), *flat)
    sides = ", ".join(f"{s}_n array<bigint>, {s}_price array<double>, {s}_size array<double>" for s in ("bid", "ask"))
    shape = StructType([StructField(key, rows.schema[key].dataType), *StructType.fromDDL(f"ord array<bigint>, snapshot array<boolean>, {sides}")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            place = np.argsort(code, kind="stable")
            starts = np.flatnonzero(np.diff(code[place], prepend=-1))
            batch = batch.take(pa.array(place))
            ends = np.append(starts, len(place))
            listed = lambda values, ends: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            columns = [batch.column(0).take(pa.array(starts)), listed(batch.column(1), ends), listed(batch.column(2), ends)]
            for c in (3, 5):
                n = batch.column(c).value_lengths().fill_null(0).cast(pa.int64())
                of = np.append(0, np.cumsum(n.to_numpy()))[ends]
                columns += [listed(n, ends), *(listed(batch.column(c + i).flatten(), of) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=shape.names)

    return own.mapInArrow(run, shape)


def _book() -> StatefulProcessor:
    class Book(StatefulProcessor):
        """A book's levels as state: a list of what each batch changed, put anew as one entry when most of it is dead; so a batch
        costs a book one read and one write of state, of changed levels only. Best prices after every event.

        An entry has a side's prices, then their sizes (0: gone).
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.changes = handle.getListState("changes", "bids array<double>, asks array<double>")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows))
            column = lambda c: np.concatenate(batch[c].to_list())
            at, snapshots = column("ord"), column("snapshot")
            place = np.argsort(at, kind="stable")
            snapshots = snapshots[place]
            books: list[dict] = [{}, {}]
            kept = 0  # levels that the state holds, dead ones too
            for entry in self.changes.get():
                for book, own in zip(books, entry, strict=True):
                    book.update(zip(own[: len(own) // 2], own[len(own) // 2 :], strict=True))
                    kept += len(own) // 2
            books = [{p: s for p, s in book.items() if s != 0} for book in books]
            changed, bests = [], []
            for side, sign, book in zip(("bid", "ask"), (-1, 1), books, strict=True):
                count = column(f"{side}_n").astype(int)
                start, count = (np.cumsum(count) - count)[place], count[place]
                touched = np.flatnonzero(snapshots | (count > 0))  # between these a side stays as it is
                prices, sizes = column(f"{side}_price").tolist(), column(f"{side}_size").tolist()
                heap = [sign * p for p in book]  # best first; dead prices go when they surface
                heapq.heapify(heap)
                old: dict = {}  # what changed levels were, null for none
                best = [sign * heap[0] if heap else None]
                for snapshot, first, end in zip(snapshots[touched].tolist(), start[touched].tolist(), (start + count)[touched].tolist(), strict=True):
                    if snapshot:
                        for price, size in book.items():
                            old.setdefault(price, size)
                        book.clear()
                        heap.clear()
                    for n in range(first, end):
                        price, size = prices[n], sizes[n]
                        if price != price:  # none: no level
                            continue
                        known = book.get(price)
                        old.setdefault(price, known)
                        if size == 0 or (snapshot and not size > 0):
                            book.pop(price, None)
                            continue
                        if known is None:
                            heapq.heappush(heap, sign * price)
                        book[price] = size
                    while heap and sign * heap[0] not in book:
                        heapq.heappop(heap)
                    best.append(sign * heap[0] if heap else None)
                changed.append({p: book.get(p, 0.0) for p, s in old.items() if book.get(p) != s})
                bests.append(np.array(best, float)[np.searchsorted(touched, np.arange(len(place)), side="right")])
            flat = lambda sides: tuple([*side, *side.values()] for side in sides)
            n = sum(map(len, changed))
            if kept + n > 2 * sum(map(len, books)):
                self.changes.put([flat(books)])
            elif n:
                self.changes.appendValue(flat(changed))
            yield pd.DataFrame({"key": str(key[0]), "ord": at[place], "best_bid": bests[0], "best_ask": bests[1]})

        def close(self) -> None:
            pass

    return Book()


def stateful_book(updates: DataFrame, key: str, order: str) -> DataFrame:
    """(key, ord, best_bid, best_ask) after every update of a stream: the book lives across micro-batches, its changed levels in one entry of
    state a batch. A key's updates meet as a few rows of arrays, not a row each."""
    return _packed(updates, key, order).groupBy(key).transformWithStateInPandas(statefulProcessor=_book(), outputStructType="key string, ord bigint, best_bid double, best_ask double", outputMode="Append", timeMode="None")


def observed(events: DataFrame, name: str = "progress") -> DataFrame:
    """Counters of each micro-batch, for `BatchMetrics`: rows, accepted, quarantined."""
    return events.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if("accepted").alias("accepted"), F.count_if(~_C("accepted")).alias("quarantined"))


class BatchMetrics(StreamingQueryListener):
    """Turns what `observed` counts into rows, one a batch, without a second pass over the data.

    The latest `keep` batches are held on the driver; a batch that is delivered again replaces its row.
    """

    def __init__(self, name: str = "progress", keep: int = 10_000):
        self.name, self.keep = name, keep
        self.rows: dict[tuple[str, int], tuple[int, int, int]] = {}

    def onQueryStarted(self, event: object) -> None:
        pass

    def onQueryProgress(self, event: object) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            self.rows[str(event.progress.id), event.progress.batchId] = found.rows, found.accepted, found.quarantined
            while len(self.rows) > self.keep:
                del self.rows[next(iter(self.rows))]

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        """query, batch, rows, accepted, quarantined, partial (more may follow)."""
        rows = [(*k, *v, True) for k, v in self.rows.items()]
        return spark.createDataFrame(rows, "query string, batch bigint, rows bigint, accepted bigint, quarantined bigint, partial boolean")


def with_metrics(write: Callable[[DataFrame, int], None], path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that also leaves a metrics row per key and batch (partial: more may follow), replaced if the batch comes again.

    The batch is gated: `accepted` says what became of each row.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        rows = gates.run_counters(batch, keys).withColumn("partial", F.lit(True))
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run
