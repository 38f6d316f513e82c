"""I3 (streaming): assemble streamed text deltas into final items.

Events ``(item_id, seq, type, text)`` arrive as files.  Each triggered run takes the
unseen ones (``foreachBatch``) into a keyed table of open parts in the shared folder
(``streaming.buckets``, bucketed by item).  An item whose ``output_item.done`` event,
which carries the number of parts, and all its parts have arrived is finished: its
text is appended to the finished items, its parts leave the table.  Parts arrive in
any order; one delivered twice counts once (of differing texts the least).  Events
of a finished item are ignored.  Open parts stay until their item is finished,
however long that takes: no timeout gives an item up.  A replayed batch changes
nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import scratch_path
from shelfline.streaming.buckets import BUCKETS, Buckets

EVENT_SCHEMA = "item_id string, seq long, type string, text string"
OUT_SCHEMA = "item_id string, text string"
DELTA, DONE = "output_text.delta", "output_item.done"


class Items:
    """The open parts and finished items in a folder."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark = spark
        self.store = Buckets(spark, folder, {"open": EVENT_SCHEMA, "done": OUT_SCHEMA}, buckets)

    def take(self, events: DataFrame, stream: str, batch: int) -> None:
        """Take in a batch of events."""
        store = self.store
        if store.contains(stream, batch):
            return
        events = events.select("item_id", "seq", "type", "text").where(F.col("type").isin(DELTA, DONE))
        touched = store.touched(events.select(store.bucket("item_id").alias("bucket")))
        finished = store.read("done", touched).select("item_id")
        # one row a part: repeats are reduced before the shuffle
        parts = (store.read("open", touched).unionByName(events).join(finished, "item_id", "left_anti")
                 .groupBy("item_id", "type", "seq").agg(F.min("text").alias("text")))
        whole = (parts.groupBy("item_id").agg(F.max(F.when(F.col("type") == DONE, F.col("seq"))).alias("expected"),
                                              F.count_if(F.col("type") == DELTA).alias("n"))
                 .where("expected between 0 and n").select("item_id"))
        texts = F.sort_array(F.collect_list(F.when(F.col("type") == DELTA, F.struct("seq", "text"))))
        done = (parts.join(whole, "item_id", "left_semi").groupBy("item_id").agg(texts.alias("p"))
                .select("item_id", F.array_join(F.transform("p", lambda x: x["text"]), " ").alias("text")))
        still = parts.join(whole, "item_id", "left_anti").select("item_id", "seq", "type", "text")
        done, still = (x.withColumn("bucket", store.bucket("item_id")) for x in (done, still))
        store.switch(touched, {"open": store.written("open", still)}, {"done": store.written("done", done)},
                     stream=stream, batch=batch, rows=0)

    def finished(self) -> DataFrame:
        return self.store.read("done")

    def open_parts(self) -> DataFrame:
        return self.store.read("open")


def assemble_stream(items: Items, events_dir: str, checkpoint: str) -> None:
    """One triggered run: consume unseen event files, finish items."""
    q = (items.spark.readStream.schema(EVENT_SCHEMA).parquet(events_dir).writeStream
         .foreachBatch(lambda df, batch: items.take(df, checkpoint, batch))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def done_events(deltas: DataFrame) -> DataFrame:
    """One ``output_item.done`` event per item, carrying its part count."""
    return (deltas.groupBy("item_id").agg(F.countDistinct("seq").alias("seq"))
            .select("item_id", "seq", F.lit(DONE).alias("type"), F.lit(None).cast("string")
                    .alias("text")))


def assemble_deltas_stream(spark: SparkSession, deltas: DataFrame, base: str | None = None
                           ) -> DataFrame:
    """Replay the delta events in two arrivals (all parts, then the done
    events) through the stream, so every item is held open across runs before it is
    finished; returns the finished items.  (Parts arriving out of order and after the
    done event are covered by the tests.)"""
    root = base or scratch_path(spark, "assemble-deltas")
    events, ckpt = os.path.join(root, "events"), os.path.join(root, "_checkpoint")
    items = Items(spark, os.path.join(root, "items"))
    ev = deltas.select("item_id", "seq", "type", "text")
    for arrival in (ev, done_events(ev)):
        arrival.write.mode("append").parquet(events)
        assemble_stream(items, events, ckpt)
    return items.finished()
