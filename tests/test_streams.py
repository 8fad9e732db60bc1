from packetloom.operators import flows
from packetloom.operators.packets import auto_block
from packetloom.schemas import FLOWS, PACKETS
from packetloom.sources.retention import retain_latest
from packetloom.streaming import alerts, traffic
from test_flows import flow

NOW = {"availableNow": True}


def packet(time, src, dst_port=22):
    return (float(time), f"IP / TCP {src}:1 > d:{dst_port} S", 60, src, "d", "TCP")


def land(spark, path, *rows):
    spark.createDataFrame(list(rows), PACKETS).coalesce(1).write.mode("append").parquet(path)


def tables_in(spark, base, deny=(), allow=()):
    t = alerts.AlertTables(f"{base}/allow", f"{base}/deny", f"{base}/blocked", f"{base}/out")
    for path, values in ((t.allow, allow), (t.deny, deny)):
        spark.createDataFrame([(v,) for v in values], "ip string").write.parquet(path)
    return t


def test_alert_stream_across_restarts(spark, tmp_path):
    base, landing = str(tmp_path), str(tmp_path / "landing")
    t = tables_in(spark, base, deny=["bad"], allow=["good"])

    def run():
        stream = alerts.packet_stream(spark, landing, max_files=1)
        alerts.run_alert_stream(stream, t, trigger=NOW).awaitTermination()
        return sorted((r.timestamp, r.source, r.status) for r in alerts.stream_alerts(spark, t).collect())

    land(spark, landing, packet(1, "x"), packet(2, "bad"), packet(3, "good"))
    first = [(1.0, "x", "ACTIVE"), (2.0, "bad", "MITIGATED")]
    assert run() == first

    # The deny list empties; the automatic block of the first batch still holds.
    spark.createDataFrame([], "ip string").write.mode("overwrite").parquet(t.deny)
    land(spark, landing, packet(4, "bad"), packet(5, "x"))
    second = first + [(4.0, "bad", "MITIGATED"), (5.0, "x", "ACTIVE")]
    assert run() == second
    assert run() == second

    # The block list is read again for each batch.
    spark.sql("select 'x' ip, current_timestamp() blocked_at, '' reason, 'BLOCKED' status").write.parquet(t.blocked)
    land(spark, landing, packet(6, "x"))
    assert run() == second + [(6.0, "x", "MITIGATED")]
    assert spark.read.parquet(t.packets).count() == 6
    blocks = alerts.read_table(spark, t.auto_blocks, alerts.BLOCKED_BY_BATCH).collect()
    assert [(b.ip, b.batch_id) for b in blocks] == [("bad", 0)]


def test_a_batch_run_twice_replaces_its_rows(spark, tmp_path):
    base, landing = str(tmp_path), str(tmp_path / "landing")
    t = tables_in(spark, base, deny=["bad"])
    land(spark, landing, packet(1, "bad"))
    for run in ("one", "two"):
        # A new checkpoint repeats batch 0 over the same output folders.
        again = alerts.packet_stream(spark, landing)
        moved = type("T", (alerts.AlertTables,), {"checkpoint": f"{base}/{run}"})(t.allow, t.deny, t.blocked, t.out)
        alerts.run_alert_stream(again, moved, trigger=NOW).awaitTermination()
    assert [r.status for r in alerts.stream_alerts(spark, t).collect()] == ["MITIGATED"]
    assert alerts.read_table(spark, t.auto_blocks, alerts.BLOCKED).count() == 1


def test_missing_table_is_empty_but_other_errors_show(spark, tmp_path):
    assert alerts.read_table(spark, str(tmp_path / "none"), PACKETS).count() == 0


def test_late_flows_change_their_minute(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    minute = 60_000
    parts = [
        [flow(flow_start_milliseconds=5 * minute), flow(flow_start_milliseconds=5 * minute + 59_999)],
        [flow(flow_start_milliseconds=600 * minute), flow(label=None)],
        [flow(flow_start_milliseconds=5 * minute + 1), flow(label=None)],
    ]
    seen = []
    for part in parts:
        seen += part
        spark.createDataFrame(part, FLOWS).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(FLOWS).parquet(landing)
        traffic.run_traffic_stream(stream, out, trigger=NOW).awaitTermination()
    want = flows.traffic_by_minute(spark.createDataFrame(seen, FLOWS)).collect()
    got = traffic.stream_traffic(spark, out).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_watermark_is_an_option(spark, tmp_path):
    landing = str(tmp_path / "in")
    spark.createDataFrame([flow()], FLOWS).write.parquet(landing)
    stream = spark.readStream.schema(FLOWS).parquet(landing)
    traffic.run_traffic_stream(stream, str(tmp_path / "out"), trigger=NOW, late_after="1 hour").awaitTermination()
    assert traffic.stream_traffic(spark, str(tmp_path / "out")).count() == 1


def test_buffer_keeps_the_newest_that_fit(spark):
    df = spark.createDataFrame([packet(i, "s") for i in range(10)], PACKETS)
    assert [r.timestamp for r in retain_latest(df, n=4).collect()] == [9.0, 8.0, 7.0, 6.0]
    assert retain_latest(df, max_bytes=180).count() == 3


def test_auto_block_ignores_protocol_and_repeats(spark):
    df = spark.createDataFrame([(1.0, None, 1, "bad", None, "ARP")] * 3, PACKETS)
    deny = spark.createDataFrame([("bad",)], "ip string")
    assert auto_block(df, deny, deny.limit(0), "2024-01-01").count() == 1
    assert auto_block(df, deny, deny, "2024-01-01").count() == 0


def test_landed_files_grow_in_number_with_the_rows(spark, tmp_path):
    """So a task reads no more of a larger table; the batches stay three."""
    from packetloom.plans.queries import _land

    rows = spark.range(70)
    for file_rows, want in ((100, 1), (10, 3)):
        folder = tmp_path / str(file_rows)
        assert _land(rows, str(folder), file_rows=file_rows) == want
        assert len(list(folder.glob("*.parquet"))) == 3 * want
        assert sorted(r.id for r in spark.read.parquet(str(folder)).collect()) == list(range(70))
