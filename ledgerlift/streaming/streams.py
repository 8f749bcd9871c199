"""Structured Streaming forms of the stateful parts (ST-1 to ST-3); an extension, the source system is batch only."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerlift.operators.receipts import extract_receipts


def stream_receipts(boxes: DataFrame, docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Receipts of each micro-batch of boxes, as Parquet; a document's boxes must arrive in one batch (`whole_documents`).

    A batch without boxes writes nothing.
    """
    def sink(batch: DataFrame, epoch: int) -> None:
        held = batch.persist()  # read several times; a stateful batch is not to be run again for each
        if held.isEmpty():  # while documents are still open, batches often release none
            held.unpersist()
            return
        seen = docs.join(held.select("doc_id").distinct(), "doc_id", "left_semi")
        try:
            extract_receipts(held, seen).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")  # a retried batch replaces itself
        finally:
            held.unpersist()

    return boxes.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def whole_documents(boxes: DataFrame, late: str = "1 hour", at: str = "ts", total: str = "n_boxes") -> DataFrame:
    """The rows of `boxes`, each document's together in one micro-batch, once it is whole.

    Boxes of a document may come in any batches and order. They are held as state until there are as many as `total` says,
    or, where that is null or never reached, until the watermark (`late` behind the latest time) passes the last one.
    Boxes that come later than the watermark are left out. Only open documents are held, each under its own key.
    """
    spelled = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    schema = boxes.schema

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, wanted, last = state.get if state.exists else ("", 0, 0)
        rows = held.split("\n") if held else []
        timed_out = state.hasTimedOut
        for batch in () if timed_out else batches:
            rows += batch["row"].tolist()
            wanted = max([wanted, *(int(n) for n in batch["wanted"])])
            last = max(last, int(batch["millis"].max()))
        if timed_out or 0 < wanted <= len(rows):
            if state.exists:
                state.remove()
            yield pd.DataFrame({"row": rows})
        else:
            state.update(("\n".join(rows), wanted, last))
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs() + 1))

    marked = boxes.withWatermark(at, late)
    spread = marked.select("doc_id", at, F.coalesce(F.col(total), F.lit(0)).cast("long").alias("wanted"), F.unix_millis(at).alias("millis"), F.to_json(F.struct(*boxes.columns), spelled).alias("row"))
    whole = spread.groupBy("doc_id").applyInPandasWithState(step, "row string", "held string, wanted long, last long", "append", GroupStateTimeout.EventTimeTimeout)
    return whole.select(F.from_json("row", schema, spelled).alias("b")).select("b.*")


def windowed_demand(events: DataFrame, late: str = "1 day", width: str = "1 day", slide: str | None = None) -> DataFrame:
    """(start, user_id, n, value) by tumbling or sliding window; rows later than `late` are left out."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    out = events.withWatermark("ts", late).groupBy(window.alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return out.select(F.col("w.start").alias("start"), "user_id", "n", "value")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events without a longer pause."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def stream_ledger(sales: DataFrame, lead: int = 3, reorder: int = 3, up_to: int = 20) -> DataFrame:
    """(sku_id, day, opening, sold, lost, closing): the reorder recurrence over a stream of (sku_id, day int, qty int), days
    ascending within an item; stock and the outstanding order are state."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stock, due, qty = state.get if state.exists else (up_to, -1, 0)
        rows = pd.concat(list(batches)).sort_values("day")
        out = []
        for day, want in zip(rows["day"], rows["qty"], strict=True):
            if 0 <= due <= day:
                stock, due, qty = stock + qty, -1, 0
            sold = min(int(want), stock)
            out.append((key[0], int(day), stock, sold, int(want) - sold, stock - sold))
            stock -= sold
            if stock <= reorder and due < 0:
                due, qty = int(day) + lead, max(1, up_to - stock)
        state.update((stock, due, qty))
        yield pd.DataFrame(out, columns=["sku_id", "day", "opening", "sold", "lost", "closing"])

    return sales.groupBy("sku_id").applyInPandasWithState(step, "sku_id long, day int, opening int, sold int, lost int, closing int", "stock int, due int, qty int", "append", GroupStateTimeout.NoTimeout)
