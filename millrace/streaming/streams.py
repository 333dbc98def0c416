"""Streaming variants: scoring of arriving files, caps with state, review upserts."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import columns as C
from ..functions import ontology as O
from ..sources.state import StateTable


def arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of files as they arrive below ``folder``: path, length, modificationTime."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime", "length")


def described(files: DataFrame) -> DataFrame:
    """Class, source and extension of each arriving image; stateless, so it works on streams and tables alike."""
    name = C.name_of(F.col("path"))
    rows = files.where(C.is_image(name, O.EXTS_ALL))
    return rows.withColumns({"class_raw": C.class_of(F.col("path")), "source": C.source_of(name, F.lit("web")), "ext": C.extension(name)})


class _Cap(StatefulProcessor):
    """Takes a key's items until there are ``cap``; what it took is a list, which goes when the key has been idle."""

    def __init__(self, cap: int, keys: list[str], idle: int | None):
        self.cap, self.keys, self.idle = cap, keys, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.taken = handle.getListState("taken", "item string")
        self.alarm = handle.getValueState("alarm", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        have = {r[0] for r in self.taken.get()} if self.taken.exists() else set()
        least: list[str] = []
        for f in rows:  # no more than the cap is held of a batch, whatever its size
            new = {x for x in f["item"] if x is not None and x not in have}
            least = heapq.nsmallest(max(0, self.cap - len(have)), {*least, *new})
        if least:
            self.taken.appendList([(x,) for x in least])
        if self.idle is not None:
            if self.alarm.exists():
                self.handle.deleteTimer(self.alarm.get()[0])
            at = timerValues.getCurrentProcessingTimeInMs() + self.idle
            self.handle.registerTimer(at)
            self.alarm.update((at,))
        if least:
            yield pd.DataFrame([(*key, x) for x in least], columns=[*self.keys, "item"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.taken.clear()
        self.alarm.clear()
        yield from ()

    def close(self) -> None:
        pass


def capped(items: DataFrame, cap: int, keys: list[str], key_schema: str, idle: str | None = None) -> DataFrame:
    """At most ``cap`` different items of each key over the life of a stream.

    ``items`` has the keys and ``item`` (string). Of a batch's items the least
    are taken, as many as are still free; one that was taken before isn't taken
    again. With ``idle`` (an interval such as ``7 days``) a key from which nothing
    has come for so long is forgotten, and its state with it: if it comes back it
    starts anew; such a stream has timers, so it runs on until it is stopped (also
    under ``availableNow``). The state is a list of the items taken, so at most ``cap`` a key;
    it is kept in RocksDB, which the session must name as its state store.
    """
    spark = items.sparkSession
    millis = None if idle is None else int(spark.sql(f"select unix_millis(timestamp_seconds(0) + interval {idle})").first()[0])
    grouped = items.select(*keys, "item").groupBy(*keys)
    return grouped.transformWithStateInPandas(_Cap(cap, keys, millis), f"{key_schema}, item string", "append", "none" if millis is None else "processingTime")


#: The state store that :func:`capped` needs.
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "1 hour", by: str = "event_type") -> DataFrame:
    """Counts by window and key; state for windows older than ``late`` is dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count(F.lit(1)).alias("n"))


def upserting(table: StateTable, writer: str = "stream") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps a state table: each batch commits a delta of what it changes.

    A batch that is run again after a restart is known by its number and changes
    nothing; other writers may commit meanwhile. Old versions and the deltas that
    were merged are removed as it goes.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        table.upsert(batch, writer, epoch)
        if epoch % table.compact_after == table.compact_after - 1:
            table.remove_old()

    return apply
