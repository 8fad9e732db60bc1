"""Shards by fixed virtual slots.

Records are hashed into a fixed number of slots, bytes are summed per slot, and
a versioned table maps slots to shards. Rebalancing edits that table and moves
as few slots as it can; records never change their slot.

Law: ``bytes``. A null text has no byte, so its size is the overhead alone; its
checksum is that of an empty text. Records that are equal in id, size and
checksum are counted, not kept apart, and spread over slots in runs of
``RUN``, so a record repeated for a third of all rows fills no slot alone. A
null id is a value like any other. An empty table gives an empty result. Only
the id and text columns are read, so other columns cannot clash.
"""

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import load, settled
from packetloom.session import run_folder

SLOTS = 8192
SHARDS = 40
OVERHEAD = 16
RUN = 4096
MAP_SCHEMA = "version int, slot int, shard int"


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> list[tuple[int, int, int]]:
    return [(0, s, s % shards) for s in range(slots)]


def rebalance(rows, load_of: dict[int, int], shards: int = SHARDS) -> list[tuple[int, int, int]]:
    """The next version of a map: slots leave shards above the mean for those below.

    A shard gives up its smallest set of large slots first; what is released
    goes, largest first, to the lightest shard. Then the heaviest shard trades
    with the lightest while that narrows the gap.
    """
    version = max((r[0] for r in rows), default=-1)
    now = {slot: shard % shards for v, slot, shard in rows if v == version}
    held, total = {k: [] for k in range(shards)}, [0] * shards
    for slot, shard in now.items():
        held[shard].append((load_of.get(slot, 0), slot))
        total[shard] += load_of.get(slot, 0)
    mean, free = sum(total) / shards, []
    for k in range(shards):
        held[k].sort(reverse=True)
        for item in list(held[k]):
            if total[k] <= mean:
                break
            if item[0] and (total[k] - item[0] >= mean or item[0] <= 2 * (total[k] - mean)):
                held[k].remove(item)
                total[k] -= item[0]
                free.append(item)
    heap = [(t, k) for k, t in enumerate(total)]
    heapq.heapify(heap)
    for item in sorted(free, reverse=True):
        t, k = heapq.heappop(heap)
        held[k].append(item)
        total[k] += item[0]
        heapq.heappush(heap, (total[k], k))
    for _ in range(50 * shards):
        high, low = max(range(shards), key=total.__getitem__), min(range(shards), key=total.__getitem__)
        gap = total[high] - total[low]
        best = max((i for i in held[high] if 0 < i[0] < gap), key=lambda i: min(i[0], gap - i[0]), default=None)
        if best is None:
            break
        held[high].remove(best)
        held[low].append(best)
        total[high] -= best[0]
        total[low] += best[0]
    return sorted((version + 1, slot, k) for k in range(shards) for _, slot in held[k])


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Distinct records with their number of copies and their slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    counted = slim.groupBy("doc_id", "size", "text_crc32").count()
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("count") - 1) / RUN)))
    return counted.withColumn("run", run).select(
        "doc_id", "size", "text_crc32",
        F.least(F.lit(RUN).cast("long"), F.col("count") - F.col("run") * RUN).alias("copies"),
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32", "run"), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def newest_map(spark, folder: str) -> list[tuple[int, int, int]]:
    """The map of the highest version in ``folder``; empty if it holds none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path) or not any(f.getPath().getName().startswith("version=") for f in files.listStatus(path)):
        return []
    kept = spark.read.schema(MAP_SCHEMA).parquet(folder)
    version = kept.agg(F.max("version")).first()[0]
    return [] if version is None else sorted((r.version, r.slot, r.shard) for r in kept.filter(F.col("version") == version).collect())


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
           slots: int = SLOTS, map_folder: str | None = None) -> DataFrame:
    """Shard of every record, its place there (from 0, without gaps) and the slot map's version.

    The slot map has ``slots`` rows, whatever the input holds; only it and the
    bytes per slot pass through the driver. ``map_folder`` keeps the versions: if
    it holds any, the newest is rebalanced and the next one written.
    """
    spark = docs.sparkSession
    found = settled(records(docs, id_col, text_col, slots), "shard-records")
    per_slot = found.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))
    loads = {r.virtual_slot: r for r in per_slot.collect()}
    map_folder = map_folder or run_folder(spark, "slot-map")
    kept = newest_map(spark, map_folder)
    if kept and [r[1] for r in kept] != list(range(slots)):
        raise ValueError(f"the slot map in {map_folder} is not one of {slots} slots")
    old = kept or first_map(slots, shards)
    new = rebalance(old, {k: r.bytes for k, r in loads.items()}, shards)
    spark.createDataFrame(new if kept else old + new, MAP_SCHEMA).coalesce(1).write.mode("append").partitionBy("version").parquet(map_folder)
    first, seen = [], [0] * shards
    for version, slot, shard in new:
        first.append((version, slot, shard, seen[shard]))
        seen[shard] += loads[slot].rows if slot in loads else 0
    place = spark.createDataFrame(first, "map_version int, virtual_slot int, shard int, first long")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32", "copies").rowsBetween(Window.unboundedPreceding, -1)
    d = found.withColumn("before", F.coalesce(F.sum("copies").over(within), F.lit(0))).join(place, "virtual_slot")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    return d.select("*", copy).withColumn("slot", F.col("first") + F.col("before") + F.col("copy")).drop("copy", "first", "before", "copies")


def op6_sharding(spark, folder):
    return assign(load(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
