"""Traffic per minute as a stream."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.streaming.compaction import compact, read_batches

MINUTES = T.StructType(
    [
        T.StructField("time_window", T.TimestampType()),
        T.StructField("label", T.StringType()),
        T.StructField("total_bytes", T.LongType()),
        T.StructField("flow_count", T.LongType()),
    ]
)


def traffic_stream(flows, class_column="label", late_after=None):
    """Streaming bytes and flows per minute and class.

    Without ``late_after`` no row is ever too late; the state then holds one
    row per minute and class, however many flows there are. With it, e.g.
    ``"2 hours"``, minutes older than the watermark leave the state and later
    flows for them no longer count.
    """
    timed = flows.withColumn("started", F.timestamp_millis("flow_start_milliseconds"))
    if late_after:
        timed = timed.withWatermark("started", late_after)
    return (
        timed.groupBy(
            F.window("started", "1 minute").alias("minute"),
            F.col(class_column).alias("label"),
        )
        .agg(
            F.sum(F.col("in_bytes") + F.col("out_bytes")).alias("total_bytes"),
            F.count("*").alias("flow_count"),
        )
        .select(
            F.col("minute.start").alias("time_window"), "label", "total_bytes", "flow_count"
        )
    )


def run_traffic_stream(flows, out, trigger=None, class_column="label", late_after=None):
    """Keep the per-minute table below ``out`` up to date.

    A batch writes only the minutes it changed, to a folder of its own.
    """

    def process(changed, batch_id):
        changed.write.mode("overwrite").parquet(f"{out}/minutes/batch_id={batch_id}")
        compact(changed.sparkSession, f"{out}/minutes", MINUTES, batch_id)

    return (
        traffic_stream(flows, class_column, late_after)
        .writeStream.outputMode("update")
        .foreachBatch(process)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def stream_traffic(spark, out):
    """Newest state of every minute and class the stream has written."""
    versions = read_batches(spark, f"{out}/minutes", MINUTES)
    latest = F.max(F.struct("batch_id", "total_bytes", "flow_count")).alias("last")
    return (
        versions.groupBy("time_window", "label")
        .agg(latest)
        .select("time_window", "label", "last.total_bytes", "last.flow_count")
    )
