import struct

import pytest

from packetloom.sources.captures import read_frames
from packetloom.sources import captures
from packetloom.streaming.captures import take_captures


def ip(proto, payload, src=(10, 0, 0, 1), dst=(10, 0, 0, 2), fragment=0, options=0):
    size = 20 + options
    head = struct.pack(">BBHHHBBH", 0x40 | size // 4, 0, size + len(payload), 0, fragment, 64, proto, 0)
    return head + bytes(src) + bytes(dst) + bytes(options) + payload


def tcp(sport, dport, flags=0x02):
    return struct.pack(">HHIIBBHHH", sport, dport, 0, 0, 0x50, flags, 0, 0, 0)


def udp(sport, dport, payload=b""):
    return struct.pack(">HHHH", sport, dport, 8 + len(payload), 0) + payload


def ether(kind, payload, vlan=False):
    return bytes(12) + (b"\x81\x00\x00\x05" if vlan else b"") + struct.pack(">H", kind) + payload


ARP = struct.pack(">HHBBH", 1, 0x0800, 6, 4, 1) + bytes(6) + bytes((10, 0, 0, 3)) + bytes(6) + bytes((10, 0, 0, 4))


def capture(frames, order="<", nano=False, link=1):
    magic = 0xA1B23C4D if nano else 0xA1B2C3D4
    out = struct.pack(order + "IHHIIII", magic, 2, 4, 0, 0, 65535, link)
    for i, f in enumerate(frames):
        part = 250_000_000 if nano else 250_000
        out += struct.pack(order + "IIII", 1700000000 + i, part, len(f), len(f)) + f
    return out


CASES = [
    (ether(0x0800, ip(6, tcp(40000, 22))), "TCP", "10.0.0.1", "10.0.0.2", "Ether / IP / TCP 10.0.0.1:40000 > 10.0.0.2:ssh S"),
    (ether(0x0800, ip(6, tcp(1, 8443, 0x12), options=8), vlan=True), "TCP", "10.0.0.1", "10.0.0.2", "Ether / IP / TCP 10.0.0.1:1 > 10.0.0.2:8443 SA"),
    (ether(0x0800, ip(17, udp(1, 53))), "UDP", "10.0.0.1", "10.0.0.2", "Ether / IP / UDP 10.0.0.1:1 > 10.0.0.2:domain"),
    (ether(0x0800, ip(1, b"\0" * 8)), "IP", "10.0.0.1", "10.0.0.2", "Ether / 10.0.0.1 > 10.0.0.2"),
    (ether(0x0800, ip(6, b"\0" * 20, fragment=5)), "IP", "10.0.0.1", "10.0.0.2", "Ether / 10.0.0.1 > 10.0.0.2"),
    (ether(0x0806, ARP), "ARP", "10.0.0.3", "10.0.0.4", "Ether / ARP who has 10.0.0.4 says 10.0.0.3"),
    (ether(0x86DD, bytes(40)), "Ether", "Layer 2", "Broadcast", "Ether"),
    (b"\1\2", "Ether", "Layer 2", "Broadcast", "Ether"),
    (
        ether(0x0800, ip(17, udp(9, 4789, bytes(8) + ether(0x0800, ip(6, tcp(5, 179), (1, 1, 1, 1), (2, 2, 2, 2)))))),
        "TCP", "10.0.0.1", "10.0.0.2", "Ether / IP / UDP / VXLAN / Ether / IP / TCP 1.1.1.1:5 > 2.2.2.2:bgp S",
    ),
]


def rows(df):
    return [(r.proto, r.src, r.dst, r.summary) for r in df.orderBy("path", "frame_no").collect()]


def test_headers(spark, tmp_path):
    want = [c[1:] for c in CASES]
    for i, (order, nano) in enumerate([("<", False), (">", False), ("<", True), (">", True)]):
        folder = tmp_path / str(i)
        folder.mkdir()
        (folder / "a.pcap").write_bytes(capture([c[0] for c in CASES], order, nano))
        df = captures.read_captures(spark, str(folder))
        assert rows(df) == want
        first = df.orderBy("frame_no").first()
        assert (first.timestamp, first.length) == (1700000000.25, len(CASES[0][0]))


def test_cooked_frames(spark, tmp_path):
    inner = ip(6, tcp(7, 21))
    (tmp_path / "a.pcap").write_bytes(capture([bytes(14) + b"\x08\x00" + inner], link=113))
    (tmp_path / "b.pcap").write_bytes(capture([b"\x08\x00" + bytes(18) + inner, b"\x08\x06" + bytes(18) + ARP], link=276))
    got = rows(captures.read_captures(spark, str(tmp_path)))
    assert [g[0] for g in got] == ["TCP", "TCP", "ARP"]
    assert got[0][3].endswith("10.0.0.2:ftp S")


def test_files_still_written_or_empty(spark, tmp_path):
    whole = capture([CASES[0][0]] * 3)
    (tmp_path / "a.pcap").write_bytes(whole[:-5])
    (tmp_path / "b.pcap").write_bytes(b"")
    assert captures.read_captures(spark, str(tmp_path)).count() == 2
    (tmp_path / "c.pcap").write_bytes(b"not a capture file, but long enough")
    with pytest.raises(Exception, match="known kind"):
        captures.read_captures(spark, str(tmp_path)).collect()


def test_capture_stream_reads_each_file_once(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()

    def run():
        captures.stream_captures(spark, folder).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", mark
        ).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(out).count()

    (tmp_path / "in" / "1.pcap").write_bytes(capture([CASES[0][0]] * 2))
    assert run() == 2
    (tmp_path / "in" / "2.pcap").write_bytes(capture([CASES[0][0]] * 5))
    assert run() == 7
    assert run() == 7


@pytest.mark.parametrize("content, words", [(b"\x1f\x8b" + bytes(40), "known kind"), (struct.pack(">IHHIIIIIIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1, 0, 0, 1 << 30, 1 << 30), "damaged")])
def test_rejected_captures_raise(spark, content, words):
    files = spark.createDataFrame([("a.pcap", bytearray(content))], "path string, content binary")
    with pytest.raises(Exception, match=words):
        read_frames(files).collect()


def test_growing_and_rotated_captures(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    whole, other = capture([CASES[0][0]] * 4), capture([CASES[1][0]] * 6)
    for content, want in ((b"", 0), (whole[:-5], 3), (whole, 4), (whole, 4), (other, 10), (other, 10)):
        (folder / "live.pcap").write_bytes(content)
        assert take_captures(spark, str(folder), out).count() == want
    summaries = sorted(r.summary for r in take_captures(spark, str(folder), out).collect())
    assert summaries == sorted([CASES[0][4]] * 4 + [CASES[1][4]] * 6)
