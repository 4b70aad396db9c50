"""Resumable runs over arriving files with Structured Streaming; all of them stop when what has arrived is done."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.operators import items
from quarry.session import importable
from quarry.sources.versions import Table

#: Pages that Spark is handed at a time.
PIECE = 10_000


def arriving(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = 100, format: str = "parquet") -> DataFrame:
    """Rows of files as they arrive, at most so many files a batch; None: all that are there."""
    reader = spark.readStream.schema(schema).format(format)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def new_only(stream: DataFrame, key: str, time: str | None = None, delay: str | None = None) -> DataFrame:
    """Rows whose key wasn't seen before; with a watermark, keys are forgotten after ``delay``."""
    if time and delay:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def take_new(stream: DataFrame, table: Table, checkpoint: str, order: Sequence[str], keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> StreamingQuery:
    """Adds the items (url, content_hash) of each batch that are to be taken to ``table``, until what has arrived is done.

    Only what was taken is remembered, by URL and by content: an item that goes as a duplicate or isn't kept (``keep``: those large
    enough, say) leaves no trace, and its URL may be taken later with another content.  A batch is the table's version of its number, so
    that one that is run again after a failure changes nothing.  The table belongs to the checkpoint.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)

    def take(batch: DataFrame, n: int) -> None:
        if n < (table.versions() or [0])[-1]:
            return
        before = table.parts(n)
        seen = table.read(schema, n)
        fresh = items.unseen(items.unseen(keep(batch), seen, "url"), seen, "content_hash")
        taken = items.first_arrivals(fresh, "url", "content_hash", order).filter("outcome = 'ok'").select(*batch.columns)
        table.commit(table.merged([*before, table.write(taken)], schema), n)

    return for_each_batch(stream, take, checkpoint)


def take_until(stream: DataFrame, table: Table, checkpoint: str, order: Sequence[str], target: int, seconds: float = 600) -> int:
    """Adds batches to ``table`` until it has ``target`` rows (of the last batch those that came first; the rest of it is given up),
    then stops the stream; how many rows it has.  It also stops after ``seconds``, since more may never arrive."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    reached = threading.Event()

    def take(batch: DataFrame, n: int) -> None:
        if n >= (table.versions() or [0])[-1]:
            missing = target - table.read(schema, n).count()
            some = batch.orderBy(*order).limit(max(0, missing))
            table.commit(table.merged([*table.parts(n), table.write(some)], schema), n)
        if table.read(schema).count() >= target:
            reached.set()

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).start()
    try:
        end = time.monotonic() + seconds
        while query.isActive and time.monotonic() < end and not reached.wait(0.1):
            pass
    finally:
        query.stop()
    if query.exception():
        raise query.exception()
    return table.read(schema).count()


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the stream to a table of files, from where the checkpoint stands, until what has arrived is done."""
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def for_each_batch(stream: DataFrame, work: Callable[[DataFrame, int], Any], checkpoint: str) -> StreamingQuery:
    """Runs ``work`` on each batch; it should be repeatable by the batch's number."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _streaks(yielded: np.ndarray, before: int, gap: np.ndarray | None = None) -> np.ndarray:
    """How many pages in a row have yielded nothing, at each page; ``before`` it starts with so many.  Where a page is missing (``gap``) it starts anew."""
    at = np.arange(len(yielded))
    last = np.full(len(at), -1 - before)
    if gap is not None:
        last[gap] = at[gap] - 1
    last[yielded] = at[yielded]
    return at - np.maximum.accumulate(last)


def _until(streak: np.ndarray, most: int) -> int:
    """How many pages there are up to the first stop, itself included."""
    stops = streak >= most
    return int(stops.argmax()) + 1 if stops.any() else len(stops)


def barren_streaks(stream: DataFrame, by: str, order: str, yielded: str, most: int) -> DataFrame:
    """``by, order, streak, stop`` of each page, with each listing's streak kept between batches.  Pages of a listing arrive in order from
    batch to batch, and in any order within one: a task sorts a listing's pages of a batch, some 60 bytes each.  After a stop they are
    left out."""
    importable(stream.sparkSession)

    def follow(key: tuple[Any, ...], pages: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        held = [batch[[order, yielded]] for batch in pages if streak < most]  # Spark hands over a listing in pieces, of which none is in order
        if not held:
            return
        whole = pd.concat(held, ignore_index=True).sort_values(order, kind="stable")
        streaks = _streaks(whole[yielded].to_numpy(bool), streak)
        n = _until(streaks, most)
        if n:
            state.update((int(streaks[n - 1]),))
        for low in range(0, n, PIECE):
            own = slice(low, min(n, low + PIECE))
            yield pd.DataFrame({by: key[0], order: whole[order].iloc[own], "streak": streaks[own], "stop": streaks[own] >= most})

    fields = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    schema = f"{by} {fields[by]}, {order} {fields[order]}, streak int, stop boolean"
    return stream.select(by, order, F.col(yielded)).groupBy(by).applyInPandasWithState(follow, schema, "streak int", "append", GroupStateTimeout.NoTimeout)


def _packed(pages: pd.DataFrame) -> bytes:
    if not len(pages):
        return b""
    rows, sink = pa.Table.from_pandas(pages, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def late_streaks(stream: DataFrame, by: str, number: str, page: str, yielded: str, most: int, wait: str | None = None) -> DataFrame:
    """``by, page, streak, stop`` as ``barren_streaks``, for pages that arrive in any order: ``number`` counts a listing's pages from 0, and a page
    is held until all before it have come.  With ``wait`` (in a query that goes on), what is held is let go in order when that time
    has passed without a new page.  After a stop nothing is held, and a page that comes twice counts once.

    Where ``most`` pages in a row have come that yielded nothing, the listing stops there or before, whatever comes: no page behind them
    is held.  What is held is packed; it grows only with pages that may still count."""
    importable(stream.sparkSession)
    columns = [number, page, yielded]

    def follow(key: tuple[Any, ...], pages: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        due, streak, raw = state.get if state.exists else (0, 0, b"")

        def may_count(parts: list[pd.DataFrame]) -> pd.DataFrame:
            whole = pd.concat(parts, ignore_index=True).drop_duplicates(number)
            whole = whole[whole[number] >= due].sort_values(number)
            n = whole[number].to_numpy(np.int64)
            return whole[: _until(_streaks(whole[yielded].to_numpy(bool), streak, np.diff(n, prepend=due - 1) != 1), most)]

        held = [pa.ipc.open_stream(raw).read_pandas()] if raw else []
        limit = 2 * sum(map(len, held)) + PIECE
        for batch in pages:
            if streak < most and len(batch):
                held.append(batch[columns])
            if sum(map(len, held)) > limit:
                held = [may_count(held)]
                limit = 2 * len(held[0]) + PIECE
        if not held:
            return
        waiting = may_count(held)
        n = waiting[number].to_numpy(np.int64)
        ready = len(n) if state.hasTimedOut else int(np.logical_and.accumulate(n == due + np.arange(len(n))).sum())
        streaks = _streaks(waiting[yielded].to_numpy(bool)[:ready], streak)
        ready = _until(streaks, most)
        if ready:
            due, streak = int(n[ready - 1]) + 1, int(streaks[ready - 1])
        rest = waiting[ready:] if streak < most else waiting[:0]
        state.update((due, streak, _packed(rest)))
        if wait and len(rest):
            state.setTimeoutDuration(wait)
        for low in range(0, ready, PIECE):
            own = slice(low, min(ready, low + PIECE))
            yield pd.DataFrame({by: key[0], page: waiting[page].iloc[own], "streak": streaks[own], "stop": streaks[own] >= most})

    fields = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    schema = f"{by} {fields[by]}, {page} {fields[page]}, streak int, stop boolean"
    timeout = GroupStateTimeout.ProcessingTimeTimeout if wait else GroupStateTimeout.NoTimeout
    return stream.select(by, number, page, yielded).groupBy(by).applyInPandasWithState(follow, schema, "due long, streak int, held binary", "append", timeout)


def unseen_pages(pages: DataFrame, items: DataFrame, seen: DataFrame, page: Sequence[str], key: str) -> DataFrame:
    """Pages of which at least one item isn't among those seen; the others are skipped."""
    new = items.join(seen.select(key).distinct(), key, "left_anti").select(*page).distinct()
    return pages.join(new, list(page), "left_semi")
