"""Captures that grow, are rotated or damaged, taken as a stream across restarts."""

import struct

from test_capture_blocks import interface, packet, section
from test_captures import CASES, capture
from test_streams import NOW, tables_in

from packetloom.operators.packets import raise_alerts
from packetloom.schemas import PACKETS
from packetloom.sources.captures import read_captures
from packetloom.streaming import alerts
from packetloom.streaming.captures import CaptureReader, rejected_files, run_capture_alerts, take_captures

SSH, WEB = CASES[0][0], CASES[1][0]


def test_live_captures_raise_the_alerts_of_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    t = tables_in(spark, str(tmp_path / "t"), deny=["10.0.0.1"])

    def run():
        run_capture_alerts(spark, str(folder), t, trigger=NOW).awaitTermination()
        return alerts.read_table(spark, t.packets, PACKETS)

    whole, other = capture([SSH] * 4), capture([WEB] * 6, order=">")
    steps = [(whole[:-5], 3), (whole, 4), (other, 10), (other, 10)]
    for content, want in steps:
        (folder / "live.pcap").write_bytes(content)
        assert run().count() == want
    for name, content in (("one", whole), ("two", other)):
        (tmp_path / "batch" / name).mkdir(parents=True)
        (tmp_path / "batch" / name / "a.pcap").write_bytes(content)
    allow, deny = (spark.createDataFrame(x, "ip string") for x in ([], [("10.0.0.1",)]))
    both = [read_captures(spark, str(tmp_path / "batch" / n)).select(*PACKETS.names) for n in ("one", "two")]
    want = raise_alerts(both[0].unionByName(both[1]), allow, deny, deny.limit(0))
    got = alerts.stream_alerts(spark, t)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 4


def test_pcapng_grows_over_batches(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    parts = [section() + interface(), packet(SSH, 10**6), packet(SSH, 2 * 10**6) + section(">") + interface(order=">"), packet(WEB, 3 * 10**6, 0, ">")]
    for k, want in ((2, 1), (4, 3)):
        (folder / "live.pcapng").write_bytes(b"".join(parts[:k]))
        got = take_captures(spark, str(folder), out)
        assert got.count() == want
    rows = got.orderBy("frame_no").collect()
    assert [(r.frame_no, r.timestamp) for r in rows] == [(0, 1.0), (1, 2.0), (2, 3.0)] and rows[2].summary == CASES[1][4]


def test_a_damaged_file_does_not_stop_the_others(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    bad = capture([SSH] * 2) + struct.pack("<IIII", 1, 1, 1 << 30, 1 << 30)
    (folder / "bad.pcap").write_bytes(bad)
    (folder / "other.txt").write_bytes(b"no capture at all")
    (folder / "good.pcap").write_bytes(capture([SSH]))
    assert take_captures(spark, str(folder), out).count() == 3
    (folder / "bad.pcap").write_bytes(bad + bytes(500))
    (folder / "good.pcap").write_bytes(capture([SSH] * 3))
    assert take_captures(spark, str(folder), out).count() == 5
    found = sorted((r.path.rsplit("/", 1)[1], r.problem) for r in rejected_files(spark, out).collect())
    assert [f[0] for f in found] == ["bad.pcap", "other.txt"]
    assert "damaged capture record" in found[0][1] and "known kind" in found[1][1]


def frames(reader, start, end):
    return [(b["frame_no"][k].as_py(), b["frame"][k].as_py()) for p in reader.partitions(start, end) for b in reader.read(p) for k in range(b.num_rows)]


def test_a_batch_made_again_gives_the_same_frames(tmp_path):
    """Also by another reader, and after the state files are lost."""
    folder = tmp_path / "in"
    folder.mkdir()
    whole = capture([bytes([k]) * 20 for k in range(9)])
    offsets, out = [{}], []
    reader = CaptureReader(str(folder), str(tmp_path / "state"))
    for size in (70, 150, 151, len(whole)):
        (folder / "a.pcap").write_bytes(whole[:size])
        offsets.append(reader.latestOffset())
        out.append(frames(reader, *offsets[-2:]))
    assert [k for part in out for k in part] == [(k, bytes([k]) * 20) for k in range(9)]
    assert frames(CaptureReader(str(folder), str(tmp_path / "state")), *offsets[-2:]) == out[-1]
    lost = CaptureReader(str(folder), str(tmp_path / "lost"))
    assert [frames(lost, a, b) for a, b in zip(offsets, offsets[1:])] == out
    assert frames(lost, offsets[-1], offsets[-1]) == [] and len(list((tmp_path / "state").rglob("*.json"))) == 2
    (folder / "a.pcap").write_bytes(whole[:150])  # shorter: taken from its start
    assert len(frames(reader, offsets[-1], reader.latestOffset())) == 3


def test_small_captures_share_a_task(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(40):
        (folder / f"{k:02}.pcap").write_bytes(capture([bytes([k]) * 20] * 3))
    reader = CaptureReader(str(folder), str(tmp_path / "state"))
    end = reader.latestOffset()
    assert len(reader.partitions({}, end)) == 1
    assert sorted(f for f in frames(reader, {}, end)) == sorted((n, bytes([k]) * 20) for k in range(40) for n in range(3))
    assert reader.partitions(end, end) == []
    large = {f"{k}": {"capture": "x", "size": 3 << 20} for k in range(6)}
    assert [len(p.grown) for p in reader.partitions({}, large)] == [2, 2, 2]
