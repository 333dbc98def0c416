"""Queries that run as streams over the events table until it is read, and return what their sinks hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import fresh_folder
from ..sources.state import StateTable
from ..streaming import streams
from .core import EVENT_PAGES, _events_of, _service, query


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream: a file stream watches a folder, here for files of that name."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(stream: DataFrame, mode: str) -> DataFrame:
    """Run until all input is read; each batch is a table of its own (of a complete result the last counts)."""
    spark, folder = stream.sparkSession, fresh_folder(stream.sparkSession)
    seen: list[int] = []

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/{epoch}")
        seen.append(epoch)

    q = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    if not seen:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*[f"{folder}/out/{k}" for k in (seen[-1:] if mode == "complete" else seen)])


@query("st1_capped_items", "select event_type, user_id, event_id::varchar as item from (select *, row_number() over (partition by event_type, user_id order by event_id) as r from events) where r <= 3")
def st1(spark, d):
    """Events in four files by id, a batch each: of every type and user the first three."""
    folder = fresh_folder(spark)
    rows = spark.read.parquet(f"{d}/events.parquet").select("event_type", "user_id", "event_id", F.format_string("%012d", "event_id").alias("item"))
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    for k in range(4):
        mine = F.least(F.floor((F.col("event_id") - low) * 4 / (high - low + 1)), F.lit(3)) == k
        rows.where(mine).drop("event_id").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    items = spark.readStream.schema("event_type string, user_id long, item string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    before = {k: spark.conf.get(k) for k in streams.ROCKS}
    for k, v in streams.ROCKS.items():
        spark.conf.set(k, v)
    try:
        found = _drained(streams.capped(items, 3, ["event_type", "user_id"], "event_type string, user_id long"), "append")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return found.select("event_type", "user_id", F.col("item").cast("long").cast("string").alias("item"))


@query("st2_windowed_counts", "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by all")
def st2(spark, d):
    return _drained(streams.windowed_counts(_source(spark, d)), "complete").select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("st3_described_files", "select event_type || '__kd__' || event_id || '.jpg' as name, event_type as class_raw, 'kd' as source from events where event_id % 2 = 0")
def st3(spark, d):
    ext = F.when(F.col("event_id") % 2 == 0, ".jpg").otherwise(".txt")
    files = _source(spark, d).select(F.concat(F.lit("in/"), "event_type", F.lit("/"), "event_type", F.lit("__kd__"), "event_id", ext).alias("path"))
    return _drained(streams.described(files), "append").select(F.element_at(F.split("path", "/"), -1).alias("name"), "class_raw", "source")


@query("st4_review_upserts", """with c as (select (user_id % 60)::varchar as id, case event_id % 3 when 0 then 'accepted' when 1 then 'rejected' else 'pending' end as status, event_id as ts from events),
  last as (select id, max_by(status, ts) as status, max(ts) as ts from c group by id), old as (select n_nationkey::varchar || case when n_nationkey % 5 = 0 then 'x' else '' end as id, 'pending' as status, -1::bigint as ts from nation)
  select * from last union all select * from old where id not in (select id from last)""")
def st4(spark, d):
    k = F.col("event_id") % 3
    changes = _source(spark, d).select((F.col("user_id") % 60).cast("string").alias("id"), F.when(k == 0, "accepted").when(k == 1, "rejected").otherwise("pending").alias("status"), F.col("event_id").alias("ts"))
    old = F.concat(F.col("n_nationkey").cast("string"), F.when(F.col("n_nationkey") % 5 == 0, "x").otherwise(""))
    start = spark.read.parquet(f"{d}/nation.parquet").select(old.alias("id"), F.lit("pending").alias("status"), F.lit(-1).cast("long").alias("ts"))
    folder = fresh_folder(spark)
    states = StateTable(spark, f"{folder}/state")
    states.upsert(start)
    changes.writeStream.foreachBatch(streams.upserting(states)).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    return states.read().select("id", "status", "ts")


@query("st5_paged_stream", f"with {EVENT_PAGES} select keyword, page, event_id, case when page <= 2 then 0 else 1 end as run from paged where page <= 5")
def st5(spark, d):
    """A paged service as a stream: it has two pages of each keyword at first, five when the stream starts again."""
    options = _service(spark, d)
    folder = fresh_folder(spark)
    for run, has in enumerate((2, 5)):
        pages = spark.readStream.format("event_pages").options(**options | {"pages": str(has)}).load().withColumn("run", F.lit(run))
        pages.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    return _events_of(spark.read.schema(pages.schema).parquet(f"{folder}/out"), "run")
