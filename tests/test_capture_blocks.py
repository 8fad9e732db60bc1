"""Captures read in blocks of bytes against one walk through the whole file; pcapng."""

import random
import struct

import pytest
from test_captures import CASES, capture

from packetloom.sources import captures, walk


def block(kind, body, order="<"):
    body += bytes(-len(body) % 4)
    size = struct.pack(order + "I", len(body) + 12)
    return struct.pack(order + "I", kind) + size + body + size


def section(order="<"):
    return block(0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1), order)


def interface(link=1, order="<", snap=0, options=()):
    body = struct.pack(order + "HHI", link, 0, snap)
    for code, value in options:
        body += struct.pack(order + "HH", code, len(value)) + value + bytes(-len(value) % 4)
    return block(1, body, order)


def packet(frame, ticks, number=0, order="<", kind=6):
    head = struct.pack(order + ("I" if kind == 6 else "HH"), *((number,) if kind == 6 else (number, 0)))
    return block(kind, head + struct.pack(order + "IIII", ticks >> 32, ticks & 0xFFFFFFFF, len(frame), len(frame)) + frame, order)


def simple(frame, order="<"):
    return block(3, struct.pack(order + "I", len(frame)) + frame, order)


def one_walk(content):
    data = walk.Content(content)
    steps = walk.walker(data)
    return [(link, time, data.read(a, b - a)) for _, (link, time, a, b) in walk.packets(steps, steps.start, data.size)]


def by_blocks(spark, folder, size):
    index = captures.index_captures(captures.list_captures(spark, str(folder)), size)
    out = {}
    for r in sorted(captures.indexed_frames(index).collect(), key=lambda r: (r.path, r.frame_no)):
        frames = out.setdefault(r.path.rsplit("/", 1)[1], [])
        assert r.frame_no == len(frames) and r.length == len(r.frame)
        frames.append((r.link_type, r.timestamp, bytes(r.frame)))
    return out


def random_frames(rng, n):
    inner = capture([bytes(rng.randbytes(40))] * 30)  # a capture within a packet misleads guesses
    for _ in range(n):
        yield rng.choice([rng.randbytes(rng.randrange(200)), bytes(90), inner, rng.randbytes(9000) if rng.random() < 0.1 else b"", b"\xff" * 60])


@pytest.mark.parametrize("order, nano", [("<", False), (">", True)])
def test_blocks_equal_one_walk(spark, tmp_path, order, nano):
    rng = random.Random(3)
    whole = {"a.pcap": capture(list(random_frames(rng, 300)), order, nano), "b.pcap": capture([]), "c.pcap": capture([b"x" * 70]), "d.pcap": b"\xd4\xc3"}
    whole["e.pcap"] = whole["a.pcap"][:-7]
    for name, content in whole.items():
        (tmp_path / name).write_bytes(content)
    want = {name: frames for name in whole if name != "d.pcap" and (frames := one_walk(whole[name]))}
    for size in (9_970, 50_000):
        assert by_blocks(spark, tmp_path, size) == want


def pcapng(rng, frames):
    """Sections of both byte orders, several interfaces, unknown blocks in between."""
    out, order, links = b"", "<", 0
    for k, f in enumerate(frames):
        if k % 90 == 0:
            order, links = rng.choice("<>"), 0
            out += section(order)
        if k % 30 == 0:
            out += interface(rng.choice([1, 113]), order, 0, [(9, bytes([rng.choice([3, 6, 9, 0x8A])])), (14, struct.pack(order + "q", k)), (0, b"")])
            links += 1
        out += rng.choice([b"", b"", block(5, rng.randbytes(12), order), block(0x0BAD, rng.randbytes(rng.randrange(40)), order)])
        out += rng.choice([packet(f, 10**15 + k, rng.randrange(links), order), simple(f, order), packet(f, 7 << 33, 0, order, 2)])
    return out


def test_pcapng_blocks_equal_one_walk(spark, tmp_path):
    rng = random.Random(4)
    content = pcapng(rng, random_frames(rng, 300))
    (tmp_path / "a.pcapng").write_bytes(content)
    want = one_walk(content)
    assert len(want) == 300
    for size in (5_001, 50_000):
        assert by_blocks(spark, tmp_path, size) == {"a.pcapng": want}


@pytest.mark.parametrize("order", "<>")
def test_pcapng_equals_its_classic_twin(spark, tmp_path, order):
    frames = [c[0] for c in CASES]
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    (tmp_path / "one" / "a.pcap").write_bytes(capture(frames))
    ticks = [(1700000000 + i) * 10**6 + 250_000 for i in range(len(frames))]
    twin = section(order) + block(4, b"\0" * 4, order) + interface(1, order) + b"".join(packet(f, t, 0, order) for f, t in zip(frames, ticks))
    (tmp_path / "two" / "a.pcapng").write_bytes(twin)
    got = [captures.read_captures(spark, str(tmp_path / d)).drop("path", "capture").orderBy("frame_no").collect() for d in ("one", "two")]
    assert got[0] == got[1] and len(got[0]) == len(frames)
    whole = spark.createDataFrame([("x", bytearray(twin))], "path string, content binary")
    assert captures.read_frames(whole).count() == len(frames)


def test_time_and_interface_rules():
    times = [(b"\x06", 5_000_000, 5.0), (b"\x09", 5, 5e-9), (b"\x81", 9, 4.5), (None, 2_500_000, 2.5)]
    for resolution, ticks, want in times:
        options = [(9, resolution)] if resolution else []
        assert one_walk(section() + interface(options=options) + packet(b"abc", ticks)) == [(1, want, b"abc")]
    assert one_walk(section() + interface(snap=2) + simple(b"abcd")) == [(1, None, b"ab")]
    assert one_walk(section() + packet(b"abc", 1, 3)) == [(None, None, b"abc")]
    assert one_walk(section() + interface(options=[(14, struct.pack("<q", 100))]) + packet(b"a", 10**6)) == [(1, 101.0, b"a")]


DAMAGED = {
    "kind.pcap": (b"\x1f\x8b" + bytes(40), 0, "known kind"),
    "size.pcap": (capture([b"a" * 50] * 20) + struct.pack("<IIII", 1, 1, 1 << 30, 1 << 30) + bytes(4000), 20, "damaged capture record"),
    "block.pcapng": (section() + interface() + packet(b"a" * 40, 1) * 30 + struct.pack("<II", 6, 13) + bytes(3000), 30, "damaged block"),
    "tail.pcapng": (section() + interface() + packet(b"a", 1) + block(6, bytes(24))[:-4] + b"\0\0\0\1" + bytes(60), 1, "does not end"),
    "short.pcapng": (section() + interface() + packet(b"a", 1) + block(6, bytes(8)) + packet(b"a", 1), 1, "too short"),
}


def test_damaged_files_are_set_aside(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for name, (content, _, _) in DAMAGED.items():
        (folder / name).write_bytes(content)
    (folder / "good.pcap").write_bytes(capture([b"x" * 60] * 9))
    for size in (300, 1 << 20):
        got = captures.read_captures(spark, str(folder), rejected=out, block_bytes=size)
        counts = {r.path.rsplit("/", 1)[1]: r["count"] for r in got.groupBy("path").count().collect()}
        assert counts == {"good.pcap": 9, **{name: n for name, (_, n, _) in DAMAGED.items() if n}}
        problems = {r.path.rsplit("/", 1)[1]: r.problem for r in spark.read.parquet(out).collect()}
        assert set(problems) == set(DAMAGED) and all(DAMAGED[n][2] in text for n, text in problems.items())
    with pytest.raises(ValueError, match="|".join(x[2] for x in DAMAGED.values())):
        captures.read_captures(spark, str(folder))


def test_small_files_share_a_task(spark):
    from packetloom.sources.captures import _tasks

    cores = spark.sparkContext.defaultParallelism
    blocks = spark.range(1000).selectExpr("0L as lo", "80000L as hi")
    assert _tasks(blocks) == 2 * cores and _tasks(blocks.limit(3)) == 3 and _tasks(blocks.limit(0)) == 1
    assert _tasks(blocks.selectExpr("lo", "33554432L as hi")) == 1000
