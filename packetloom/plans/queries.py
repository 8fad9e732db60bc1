"""Every operator as a query over the given tables.

``REGISTRY`` maps a name to a function of the session and the table folder.
"""

import math

from pyspark.sql import functions as F

from packetloom.functions import csvtext
from packetloom.functions.text import human_bytes, mask_address
from packetloom.operators import (
    assistant,
    catalog,
    federated,
    flows,
    lists,
    packets,
    uploads,
)
from packetloom.operators.profile import profile
from packetloom.plans.adapters import capture_files, catalog_table, frame, upload_files
from packetloom.schemas import BLOCKED, CATALOG
from packetloom.session import run_folder
from packetloom.sources import binary, captures, files, retention, snapshots
from packetloom.streaming import alerts as alert_stream
from packetloom.streaming import captures as capture_stream
from packetloom.streaming import traffic

REGISTRY = {}

# Moments written by the registered queries; nothing reads the clock.
AS_OF = "2024-02-01 00:00:00"


def query(run):
    REGISTRY[run.__name__] = run
    return run


def _alerts(spark, d):
    return packets.raise_alerts(
        frame(spark, d, "packets"),
        frame(spark, d, "allow"),
        frame(spark, d, "deny"),
        frame(spark, d, "held"),
    )


def _held(spark, d):
    """Block list after the automatic blocks of the packets."""
    new = packets.auto_block(
        frame(spark, d, "packets"), frame(spark, d, "deny"), frame(spark, d, "held"), AS_OF
    )
    return frame(spark, d, "held").unionByName(new.select("ip"))


def _newest(df):
    return df.agg(F.max("timestamp").alias("t")).scalar()


# Flow records


@query
def attack_summary(spark, d):
    return flows.attack_summary(frame(spark, d, "flows"))


@query
def attack_vector(spark, d):
    return (
        flows.with_attack_vector(frame(spark, d, "flows"))
        .groupBy("vettore_attacco", "label")
        .agg(F.count("*").alias("n"), F.sum("in_pkts").alias("packets"))
    )


@query
def top_attackers(spark, d):
    return flows.top_attackers(frame(spark, d, "flows"))


@query
def class_balance(spark, d):
    return flows.class_balance(frame(spark, d, "flows"))


@query
def protocol_ports(spark, d):
    return flows.protocol_ports(frame(spark, d, "flows"))


@query
def traffic_by_minute(spark, d):
    return flows.traffic_by_minute(frame(spark, d, "flows"))


@query
def top_talkers(spark, d):
    return flows.top_talkers(frame(spark, d, "flows"))


@query
def volume_text(spark, d):
    """Bytes per source as text, at magnitudes from bytes to terabytes."""
    sums = (
        frame(spark, d, "flows")
        .groupBy("ipv4_src_addr")
        .agg(F.sum(F.col("in_bytes") + F.col("out_bytes")).alias("total"))
    )
    scales = F.array(*[F.lit(1024**p) for p in range(3)])
    scaled = sums.select("ipv4_src_addr", "total", F.explode(scales).alias("scale"))
    larger = scaled.withColumn("total", F.col("total") * F.col("scale"))
    smaller = scaled.withColumn("total", F.expr("total div scale"))
    return larger.unionByName(smaller).select(
        "ipv4_src_addr", "total", human_bytes(F.col("total")).alias("volume")
    )


@query
def malicious_flows(spark, d):
    return flows.malicious(frame(spark, d, "flows"))


@query
def flow_kpis(spark, d):
    return flows.flow_kpis(frame(spark, d, "flows"))


@query
def attacker_status(spark, d):
    return flows.attacker_status(
        flows.top_attackers(frame(spark, d, "flows"), n=20), frame(spark, d, "held_sources")
    )


# Sources and sinks


@query
def flows_csv_round_trip(spark, d):
    path = run_folder(spark, "flows-csv")
    frame(spark, d, "flows").write.option("header", True).csv(path)
    return files.read_flows_csv(spark, path)


@query
def flows_csv_inferred(spark, d):
    path = run_folder(spark, "flows-csv")
    frame(spark, d, "flows").write.option("header", True).csv(path)
    return flows.attack_summary(files.read_flows_csv(spark, path, schema=None))


@query
def flows_parquet_round_trip(spark, d):
    path = run_folder(spark, "flows")
    files.write_flows(frame(spark, d, "flows"), path)
    return files.load_flows(spark, path)


@query
def ingest_if_absent(spark, d):
    """Ingest twice; the second call, with other rows, must change nothing."""
    first, second, target = (run_folder(spark, n) for n in ("csv", "csv", "flows"))
    df = frame(spark, d, "flows")
    df.write.option("header", True).csv(first)
    flows.malicious(df).write.option("header", True).csv(second)
    files.ingest_if_absent(spark, first, target)
    return (
        files.ingest_if_absent(spark, second, target)
        .groupBy("label")
        .agg(F.count("*").alias("n"), F.sum("in_bytes").alias("in_bytes"))
    )


@query
def packets_json_round_trip(spark, d):
    path = run_folder(spark, "packets-json")
    frame(spark, d, "packets").drop("event_id").write.json(path)
    return files.load_packets(spark, path)


@query
def saved_report(spark, d):
    path = run_folder(spark, "report")
    files.save_report(flows.class_balance(frame(spark, d, "flows")), path)
    files.save_report(flows.attack_summary(frame(spark, d, "flows")), path)
    return spark.read.parquet(path)


@query
def appended_alerts(spark, d):
    """Alerts of each grade appended in turn to one table."""
    path = run_folder(spark, "alerts")
    rows = _alerts(spark, d)
    files.append(rows.filter("status = 'ACTIVE'"), path)
    files.append(rows.filter("status <> 'ACTIVE'"), path)
    return spark.read.parquet(path)


@query
def mounted_views(spark, d):
    """A console query over views; the second mount keeps the first views."""
    flow_view, packet_view = "packetloom_storico", "packetloom_live"
    for name in (flow_view, packet_view):
        spark.catalog.dropTempView(name)
    files.mount_views(
        spark,
        {
            flow_view: lambda: frame(spark, d, "flows"),
            packet_view: lambda: frame(spark, d, "shared_packets"),
        },
    )
    files.mount_views(spark, {packet_view: lambda: frame(spark, d, "packets")})
    return spark.sql(
        f"""
        with old as (select ipv4_src_addr as ip, count(*) as flow_count from {flow_view} group by 1),
             new as (select src as ip, count(*) as packet_count from {packet_view} group by 1)
        select ip, flow_count, packet_count from old join new using (ip)
        """
    )


def _land_captures(spark, d, folder, share=1.0):
    """Capture files of the events, classic and pcapng, of which so much is written already."""
    whole = capture_files(spark, d)
    size = F.ceil(F.octet_length("content") * share).cast("int")
    binary.write_files(whole.withColumn("content", F.substring("content", F.lit(1), size)), folder).write.format(
        "noop"
    ).mode("overwrite").save()


@query
def decoded_captures(spark, d):
    """Files in a folder, read by blocks of bytes."""
    folder = run_folder(spark, "captures")
    _land_captures(spark, d, folder)
    return captures.read_captures(spark, folder).drop("path", "capture", "frame_no")


@query
def followed_captures(spark, d):
    """Captures taken half written and again when whole; every packet is taken once."""
    folder, out = run_folder(spark, "captures"), run_folder(spark, "followed")
    for share in (0.5, 1.0):
        _land_captures(spark, d, folder, share)
        packets_taken = capture_stream.take_captures(spark, folder, out)
    return packets_taken.drop("path", "capture", "frame_no")


@query
def capture_alert_run(spark, d):
    """From growing capture files to graded alerts, lists read in each batch."""
    base = run_folder(spark, "capture-alerts")
    tables = _alert_tables(spark, d, base)
    for share in (0.5, 1.0):
        _land_captures(spark, d, f"{base}/captures", share)
        capture_stream.run_capture_alerts(
            spark, f"{base}/captures", tables, trigger={"availableNow": True}
        ).awaitTermination()
    return alert_stream.stream_alerts(spark, tables)


def _land(df, folder, batches=3, file_rows=2_000_000):
    """Land ``df`` as files for so many batches; returns the files of one, as many as its rows need."""
    files = max(1, math.ceil(df.count() / (batches * file_rows)))
    df.repartition(batches * files).write.parquet(folder)
    return files


@query
def packet_stream(spark, d):
    """Packets taken from a landing folder by a stream, a third of the files per batch."""
    landing, out = run_folder(spark, "landing"), run_folder(spark, "packets")
    max_files = _land(frame(spark, d, "packets").drop("event_id"), landing)
    stream = alert_stream.packet_stream(spark, landing, max_files=max_files)
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", out + "-checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query
def retained_packets(spark, d):
    return retention.retain_latest(
        frame(spark, d, "packets"), max_bytes=1000000, tie_break=("event_id",)
    )


# Packets and alerts


@query
def normalized_packets(spark, d):
    return packets.normalize_packets(frame(spark, d, "headers"))


@query
def destination_part(spark, d):
    return frame(spark, d, "packets").select(
        "event_id", packets.destination_part(F.col("summary")).alias("part")
    )


@query
def alert_candidates(spark, d):
    return packets.alert_candidates(frame(spark, d, "packets"))


@query
def strict_alert_candidates(spark, d):
    return packets.alert_candidates(frame(spark, d, "packets"), strict=True)


@query
def allowed_alerts_removed(spark, d):
    return packets.suppress_allowed(
        packets.alert_candidates(frame(spark, d, "packets")), frame(spark, d, "allow")
    )


@query
def auto_blocks(spark, d):
    return packets.auto_block(
        frame(spark, d, "packets"), frame(spark, d, "deny"), frame(spark, d, "held"), AS_OF
    )


@query
def graded_alerts(spark, d):
    return _alerts(spark, d)


def _alert_tables(spark, d, base):
    tables = alert_stream.AlertTables(
        f"{base}/allow", f"{base}/deny", f"{base}/blocked", f"{base}/out"
    )
    frame(spark, d, "allow").write.parquet(tables.allow)
    frame(spark, d, "deny").write.parquet(tables.deny)
    frame(spark, d, "held").select(
        "ip",
        F.lit(AS_OF).cast("timestamp").alias("blocked_at"),
        F.lit("").alias("reason"),
        F.lit("BLOCKED").alias("status"),
    ).write.parquet(tables.blocked)
    return tables


@query
def alerts_by_block_log(spark, d):
    """Alerts graded by the block list as it was when their packets came."""
    alerts = packets.alert_candidates(frame(spark, d, "packets"))
    return packets.grade_alerts_at(alerts, frame(spark, d, "block_log"))


@query
def alert_stream_run(spark, d):
    """The alert stream over landed files in three batches, lists read in each batch."""
    base = run_folder(spark, "alert-stream")
    tables = _alert_tables(spark, d, base)
    max_files = _land(frame(spark, d, "packets").drop("event_id"), f"{base}/landing")
    stream = alert_stream.packet_stream(spark, f"{base}/landing", max_files=max_files)
    alert_stream.run_alert_stream(
        stream, tables, trigger={"availableNow": True}
    ).awaitTermination()
    return alert_stream.stream_alerts(spark, tables)


@query
def traffic_stream_run(spark, d):
    """Per-minute traffic as a stream over landed files in three batches."""
    base = run_folder(spark, "traffic-stream")
    df = frame(spark, d, "flows")
    max_files = _land(df, f"{base}/landing")
    stream = (
        spark.readStream.schema(df.schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(f"{base}/landing")
    )
    traffic.run_traffic_stream(
        stream, f"{base}/out", trigger={"availableNow": True}
    ).awaitTermination()
    return traffic.stream_traffic(spark, f"{base}/out")


@query
def latest_packets(spark, d):
    return packets.latest_packets(
        frame(spark, d, "packets"), zone="Europe/Rome", tie_break=("event_id",)
    )


@query
def masked_latest_packets(spark, d):
    return packets.latest_packets(
        frame(spark, d, "packets"), n=50, masked=True, tie_break=("event_id",)
    )


@query
def masked_addresses(spark, d):
    return frame(spark, d, "packets").select(
        "event_id",
        mask_address(F.col("src")).alias("src"),
        mask_address(F.col("dst")).alias("dst"),
    )


# Lists, alert views, audit


@query
def upserted_blocks(spark, d):
    log = frame(spark, d, "block_log")
    return lists.upsert_blocked(
        log.filter("status = 'BLOCKED'"), log.filter("status <> 'BLOCKED'")
    )


@query
def stored_blocks(spark, d):
    """The block list as a stored table that two changes replace, one after the other."""
    log = frame(spark, d, "block_log")
    table = snapshots.Snapshots(spark, run_folder(spark, "blocks"), BLOCKED)
    for status in ("BLOCKED", "REMOVED"):
        table.update(lambda rows, changes=log.filter(F.col("status") == status): lists.upsert_blocked(rows, changes))
    return table.read()


@query
def active_blocks(spark, d):
    return lists.active_blocks(lists.current_blocks(frame(spark, d, "block_log")))


@query
def recent_alerts(spark, d):
    return lists.recent_alerts(
        _alerts(spark, d), _newest(frame(spark, d, "packets")), seconds=86400
    )


@query
def attack_banner(spark, d):
    return lists.attack_banner(
        _alerts(spark, d), _held(spark, d), _newest(frame(spark, d, "packets")), seconds=7200
    )


@query
def alert_board(spark, d):
    return lists.alert_board(_alerts(spark, d), _held(spark, d))


@query
def audit_rows(spark, d):
    return lists.audit(frame(spark, d, "actions").select("user", "action", "details"), AS_OF)


@query
def latest_audit(spark, d):
    return lists.latest_audit(frame(spark, d, "actions"), zone="Europe/Rome")


@query
def platform_kpis(spark, d):
    return lists.platform_kpis(
        frame(spark, d, "actions"), _held(spark, d), frame(spark, d, "packets")
    )


# Both sources


@query
def flow_packet_matches(spark, d):
    return federated.flow_packet_matches(
        frame(spark, d, "flows"), frame(spark, d, "shared_packets")
    )


@query
def flows_with_packets(spark, d):
    return federated.flows_with_packets(
        frame(spark, d, "flows"), frame(spark, d, "shared_packets")
    )


@query
def addresses_by_source(spark, d):
    return federated.addresses_by_source(
        frame(spark, d, "flows"), frame(spark, d, "shared_packets")
    )


@query
def volume_both(spark, d):
    return federated.volume_both(
        frame(spark, d, "flows"), frame(spark, d, "shared_packets")
    )


@query
def sql_verdicts(spark, d):
    return federated.sql_verdict(frame(spark, d, "query_log"), "query")


# Catalog


@query
def catalog_fields(spark, d):
    return catalog.field_view(catalog.build_catalog(catalog_table(spark, d)))


@query
def catalog_search(spark, d):
    return catalog.search_catalog(frame(spark, d, "catalog"), r"SRC1\b|licen[sc]e|\bANE").select(
        "id", "name"
    )


@query
def catalog_preview(spark, d):
    return catalog.preview(
        frame(spark, d, "catalog"), F.desc("created_at"), "id"
    ).select("id", "name", "format", "created_at")


@query
def column_profile(spark, d):
    rounded = profile(frame(spark, d, "lineitem"))
    return rounded.select(
        "column",
        "type",
        "count",
        *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")],
    )


def _uploads(spark, d):
    return upload_files(spark, d), {}


@query
def registered_uploads(spark, d):
    table, limits = _uploads(spark, d)
    existing = catalog.build_catalog(catalog_table(spark, d))
    accepted = uploads.accepted_uploads(table, **limits)
    return catalog.field_view(
        catalog.register_accepted(existing, accepted, "/ingested", AS_OF)
    )


@query
def upload_entries(spark, d):
    table, limits = _uploads(spark, d)
    existing = catalog.build_catalog(catalog_table(spark, d))
    accepted = uploads.accepted_uploads(table, **limits)
    return catalog.register_accepted(existing, accepted, "/ingested", AS_OF).drop("schema", "description")


@query
def stored_catalog(spark, d):
    """The catalog as a stored table before and after datasets are removed."""
    rows = catalog_table(spark, d)
    table = snapshots.Snapshots(spark, run_folder(spark, "catalog"), CATALOG)
    table.update(lambda old: old.unionByName(rows))
    ids = frame(spark, d, "labels").filter("toxic = 1").select(F.concat(F.lit("ds_"), "doc_id").alias("id"))
    table.update(lambda old: catalog.deregister(old, ids))
    versions = [table.read(v).select("id", "name", F.lit(v).alias("version")) for v in (0, 1)]
    return versions[0].unionByName(versions[1])


@query
def deregistered_catalog(spark, d):
    ids = frame(spark, d, "labels").filter("toxic = 1").select(
        F.concat(F.lit("ds_"), "doc_id").alias("id")
    )
    builtin = frame(spark, d, "catalog").select("id").filter(F.col("id").isin(*catalog.PROTECTED_IDS))
    return catalog.deregister(
        frame(spark, d, "catalog"), ids.unionByName(builtin)
    ).select("id", "name")


@query
def dataset_freshness(spark, d):
    return catalog.dataset_freshness(
        frame(spark, d, "catalog"), frame(spark, d, "packets"), zone="Europe/Rome"
    )


# Upload screening


@query
def upload_verdicts(spark, d):
    table, limits = _uploads(spark, d)
    return uploads.screen_uploads(table, **limits).select(
        "path", "accepted", "reason", "delimiter", "formula_found"
    )


@query
def text_file_verdicts(spark, d):
    return uploads.screen_uploads(upload_files(spark, d, "text_files")).select("path", "accepted", "reason", "delimiter", "formula_found")


@query
def size_and_name_checks(spark, d):
    return frame(spark, d, "uploads").select(
        "path",
        uploads.size_reason(F.col("length"), 85).alias("size_reason"),
        uploads.name_reason(F.col("file")).alias("name_reason"),
    )


@query
def binary_signatures(spark, d):
    return upload_files(spark, d).select(
        "path", uploads.signature_reason(F.col("content")).alias("reason")
    )


@query
def decoded_uploads(spark, d):
    return upload_files(spark, d, "text_files").select(
        "path", F.md5(F.encode(uploads.decoded(F.col("content")), "UTF-8")).alias("digest")
    )


@query
def script_markers(spark, d):
    return frame(spark, d, "text_files").select(
        "path", uploads.script_reason(F.col("text")).alias("reason")
    )


@query
def csv_delimiters(spark, d):
    return frame(spark, d, "uploads").select(
        "path", csvtext.delimiter_of(F.col("text")).alias("delimiter")
    )


@query
def csv_shapes(spark, d):
    """Shape check of whole texts under their own delimiter."""
    found = frame(spark, d, "uploads").withColumn(
        "delimiter", csvtext.delimiter_of(F.col("text"))
    )
    return found.select(
        "path", uploads.shape_reason(F.col("text"), F.col("delimiter")).alias("reason")
    )


@query
def defused_cells(spark, d):
    return uploads.defuse_formulas(frame(spark, d, "cells"))


@query
def clean_upload_rows(spark, d):
    table, limits = _uploads(spark, d)
    rows = uploads.clean_rows(uploads.accepted_uploads(table, **limits))
    return rows.select("path", "row_no", F.posexplode("cells").alias("cell_no", "cell"))


@query
def cleaned_files(spark, d):
    """Cleaned uploads written, registered and read back from where the catalog says."""
    table, limits = _uploads(spark, d)
    # screened once, as four steps read what was accepted
    screened = run_folder(spark, "accepted-uploads")
    passed = uploads.accepted_uploads(table, **limits)
    passed.write.parquet(screened)
    accepted = spark.read.schema(passed.schema).parquet(screened)
    folder = run_folder(spark, "cleaned")
    existing = catalog.build_catalog(catalog_table(spark, d)).limit(0)
    # packed: a file for each upload is more than a disk takes; the catalog says where they are
    entries = files.ingest_uploads(existing, accepted, folder, AS_OF, packed=True)
    name = F.substring_index("path", "/", -1)
    found = binary.read_files(binary.by_pack(entries.select(F.col("location").alias("path"))))
    found = found.select(name.alias("name"), F.decode("content", "UTF-8").alias("text"))
    form = accepted.select(catalog.upload_file().alias("name"), "path", "delimiter")
    listed = entries.select(F.substring_index("location", "/", -1).alias("name"))
    cells = csvtext.cells(F.col("text"), F.col("delimiter"))
    rows = found.join(listed, "name").join(form, "name").select("path", F.posexplode(cells).alias("row_no", "cells"))
    return rows.select("path", (F.col("row_no") + 1).alias("row_no"), F.posexplode("cells").alias("cell_no", "cell"))


@query
def upload_audit(spark, d):
    table, limits = _uploads(spark, d)
    return uploads.upload_audit(uploads.screen_uploads(table, **limits), AS_OF)


# Assistant text


@query
def routed_questions(spark, d):
    return assistant.route_questions(frame(spark, d, "questions"), "text")


def _context(spark, d):
    blocks = lists.current_blocks(frame(spark, d, "block_log"))
    return assistant.security_context(blocks, _alerts(spark, d))


@query
def security_context(spark, d):
    return _context(spark, d)


@query
def assistant_prompts(spark, d):
    routed = assistant.route_questions(frame(spark, d, "questions"), "text")
    return assistant.build_prompts(routed, "text", _context(spark, d)).select(
        "conv_id", "turn", "prompt"
    )


@query
def sql_prompts(spark, d):
    return assistant.build_sql_prompts(frame(spark, d, "questions"), "text").select(
        "conv_id", "turn", "prompt"
    )


@query
def split_replies(spark, d):
    return assistant.split_reasoning(frame(spark, d, "replies"), "reply").drop("reply")


@query
def assembled_replies(spark, d):
    return assistant.assemble_chunks(frame(spark, d, "chunks"), "conv_id", "turn", block=3)
