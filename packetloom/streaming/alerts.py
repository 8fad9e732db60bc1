"""Packets to alerts as a stream."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from packetloom.operators.packets import auto_block, raise_alerts
from packetloom.schemas import ADDRESS_LIST, ALERTS, BLOCKED, BLOCKED_BY_BATCH, PACKETS
from packetloom.streaming.compaction import compact, read_batches


@dataclass(frozen=True)
class AlertTables:
    """Folders of the tables that the alert stream reads and writes.

    ``allow``, ``deny`` and ``blocked`` are Parquet tables kept by others and
    read again for each batch. Everything the stream writes is below ``out``,
    one folder per batch, so a batch that runs twice replaces its own rows.
    """

    allow: str
    deny: str
    blocked: str
    out: str

    @property
    def packets(self):
        return f"{self.out}/packets"

    @property
    def alerts(self):
        return f"{self.out}/alerts"

    @property
    def auto_blocks(self):
        return f"{self.out}/auto_blocks"

    @property
    def rejected(self):
        return f"{self.out}/rejected"

    @property
    def checkpoint(self):
        return f"{self.out}/checkpoint"


def read_table(spark, path, schema):
    """Parquet table, or no rows if nothing has been written yet."""
    try:
        rows = spark.read.schema(schema).option("basePath", path).parquet(path)
        return rows.select(*schema.names)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def packet_stream(spark, folder, format="parquet", max_files=None):
    """Packets as files appear in ``folder``; each file is read once.

    The checkpoint of the query that uses the stream remembers what was read,
    also across restarts. Captures that
    grow or are rotated in place are followed by ``streaming.captures``.
    """
    reader = spark.readStream.format(format).schema(PACKETS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def run_alert_stream(packets, tables, trigger=None, prepare=None, **rules):
    """Start the alert stream; ``trigger`` defaults to one batch per second.

    ``prepare`` makes packets of a batch and its number if the stream holds
    something else, such as frames of live captures.

    Each batch stores its packets, re-reads the lists, blocks deny-listed
    sources and raises graded alerts. The block list of a batch is the kept
    table plus the automatic blocks of earlier batches only, so running a batch
    again gives the same rows.
    """

    def process(batch, batch_id):
        spark = batch.sparkSession
        folder = f"batch_id={batch_id}"
        allow = read_table(spark, tables.allow, ADDRESS_LIST)
        deny = read_table(spark, tables.deny, ADDRESS_LIST)
        kept = read_table(spark, tables.blocked, BLOCKED).select("ip")
        blocked = kept.unionByName(_earlier_blocks(spark, tables, batch_id))
        taken = batch.persist() if prepare else batch
        try:
            if prepare:
                batch = prepare(taken, batch_id)
            stored = f"{tables.packets}/{folder}"
            batch.write.mode("overwrite").parquet(stored)
            # lists and rules read the stored packets: nothing is decoded twice
            batch = spark.read.schema(PACKETS).parquet(stored)
            new = auto_block(batch, deny, blocked, F.current_timestamp()).persist()
            target = f"{tables.auto_blocks}/{folder}"
            # Only batches that block somebody leave a folder, so there are
            # never more folders to list than addresses on the deny list.
            if not new.isEmpty() or not read_table(spark, target, BLOCKED).isEmpty():
                new.write.mode("overwrite").parquet(target)
            new.unpersist()
            raise_alerts(batch, allow, deny, blocked, **rules).write.mode(
                "overwrite"
            ).parquet(f"{tables.alerts}/{folder}")
        finally:
            taken.unpersist()
        # this batch may be made again, those before it not
        compact(spark, tables.packets, PACKETS, batch_id)
        compact(spark, tables.alerts, ALERTS, batch_id)

    return (
        packets.writeStream.foreachBatch(process)
        .option("checkpointLocation", tables.checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def _earlier_blocks(spark, tables, batch_id):
    """Addresses blocked automatically before ``batch_id``."""
    return (
        read_table(spark, tables.auto_blocks, BLOCKED_BY_BATCH)
        .filter(F.col("batch_id") < batch_id)
        .select("ip")
    )


def stream_alerts(spark, tables):
    """All alerts the stream has raised so far."""
    return read_batches(spark, tables.alerts, ALERTS).select(*ALERTS.names)


def stream_packets(spark, tables):
    """All packets the stream has taken so far."""
    return read_batches(spark, tables.packets, PACKETS).select(*PACKETS.names)
