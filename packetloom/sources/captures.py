"""Packet capture files, classic and pcapng.

Only the walk from record to record needs Python (``sources.walk``). Files are cut
into blocks of bytes, many tasks a large file and many small files a task: each block guesses where its first
record starts and walks to the first record of the next block. A block whose
guess is not where the block before it ended is walked again from there; so the
result is that of one walk through the whole file, whatever the payloads hold. What is kept of a block is one row: places, number of frames,
and the section and interface blocks that later blocks need. A second pass
reads frames, numbered from the counts. All headers are then read by Spark
expressions on the frame bytes.
"""

import math

import pyarrow as pa
from pyspark.sql import functions as F

from packetloom.functions.text import first_match
from packetloom.operators.packets import normalize_packets
from packetloom.schemas import CAPTURE_BLOCKS, CAPTURE_FILES, FRAMES
from packetloom.session import run_folder, ship
from packetloom.sources import walk

ETHERNET, COOKED, COOKED_V2 = 1, 113, 276
TYPE_IPV4, TYPE_ARP, TYPES_VLAN = 0x0800, 0x0806, (0x8100, 0x88A8)
PROTO_TCP, PROTO_UDP, VXLAN_PORT = 6, 17, 4789
TCP_FLAGS = "FSRPAUEC"
PORT_NAMES = {
    20: "ftp_data",
    21: "ftp",
    22: "ssh",
    53: "domain",
    80: "http",
    179: "bgp",
    443: "https",
    989: "ftps_data",
    990: "ftps",
    8080: "http_alt",
}

BLOCK_BYTES, MOST_TASKS = 32 * 1024 * 1024, 20_000
#: Small files share a task up to so many bytes.
TASK_BYTES = 8 * 1024 * 1024
BATCH_FRAMES, BATCH_BYTES = 4096, 8 * 1024 * 1024
_ARROW = pa.schema(
    [
        ("path", pa.string()), ("capture", pa.string()), ("frame_no", pa.int64()), ("link_type", pa.int32()),
        ("timestamp", pa.float64()), ("length", pa.int64()), ("frame", pa.binary()),
    ]
)


def frame_batches(data, found, path, capture, frame_no):
    """Arrow batches of bounded size of the packets that a walk has ``found``."""
    held, size = [], 0

    def batch():
        link, time, frames = zip(*held)
        n = len(held)
        columns = [
            [path] * n, [capture] * n, range(frame_no, frame_no + n), link, time, [len(f) for f in frames], frames,
        ]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _ARROW)]
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    for _, (link, time, start, end) in found:
        held.append((link, time, data.read(start, end - start)))
        size += end - start
        if len(held) == BATCH_FRAMES or size >= BATCH_BYTES:
            yield batch()
            frame_no += len(held)
            held, size = [], 0
    if held:
        yield batch()


def _whole_files(batches):
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            data = walk.Content(memoryview(content.as_buffer()).tobytes() if content.is_valid else b"")
            steps = walk.walker(data)
            if steps:
                capture = walk.capture_name(data, walk.walker(data))
                yield from frame_batches(data, walk.packets(steps, steps.start, data.size), path, capture, 0)


def read_frames(files):
    """Frames of capture files that are rows (``path``, ``content``); works on streams too.

    An incomplete last record, as in a file still being written, is left out.
    A file of another kind or with a damaged record raises an error. Files in
    a folder are better read by ``index_captures`` and ``indexed_frames``.
    """
    ship(files.sparkSession)
    return files.select("path", "content").mapInArrow(_whole_files, FRAMES)


def list_captures(spark, folder):
    """``path`` and ``length`` of the files in ``folder``; no bytes are read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def _walk(row):
    """Walk one block from ``start``, or from where a record seems to start."""
    row |= {"end": None, "frames": 0, "problem": None, "heads": None, "order_out": row["order_in"]}
    data = walk.File(row["path"], row["length"])
    try:
        steps = walk.walker(data, row["order_in"])
        if steps is None:
            return row | {"start": 0, "end": 0}
        row["order_in"] = steps.order
        if row["block"] == 0:
            row |= {"start": steps.start, "capture": walk.capture_name(data, walk.walker(data))}
        elif row["start"] is None:
            row["start"] = walk.plausible_start(steps, row["lo"], row["hi"])
            if row["start"] is None:
                return row
        at = row["start"]
        while at < row["hi"] and (found := steps.step(at)):
            at, packet = found
            row["frames"] += packet is not None
        row["end"] = at
    except walk.Damaged as damage:
        row["problem"] = str(damage)
        return row
    finally:
        data.close()
    return row | {"order_out": steps.order, "heads": steps.heads or None}


def _guessed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_walk(row) for row in batch.to_pylist()], schema=batch.schema)


def _agreed(batches):
    """Blocks of a file in order, each starting where the one before ended; walked again if guessed otherwise."""
    last = None
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if last and last["path"] == row["path"]:
                if last["problem"]:
                    continue
                if (row["start"], row["order_in"]) != (last["end"], last["order_out"]):
                    row = _walk(row | {"start": last["end"], "order_in": last["order_out"]})
                heads, new = last["known_heads"], last["heads"] or b""
                row |= {
                    "capture": last["capture"],
                    "first_frame": last["first_frame"] + last["frames"],
                    "known_heads": new if walk.starts_section(new) else heads + new,
                }
            else:
                row |= {"first_frame": 0, "known_heads": b""}
            rows.append(row)
            last = row
        yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)


def index_captures(files, block_bytes=BLOCK_BYTES):
    """Blocks of capture ``files`` (``path``, ``length``) as a table in the shared folder.

    All blocks are walked at once from guessed starts; then the rows of a file,
    one per block, are read in order, and only blocks with a wrong guess are walked
    again. Blocks after a damaged record are left out; its block has a ``problem``.
    """
    spark = files.sparkSession
    ship(spark)
    size = F.lit(block_bytes).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), size)
    rows = files.select("path", "length", F.posexplode(starts).alias("block", "lo")).withColumn(
        "hi", F.least(F.col("lo") + size, F.col("length"))
    )
    known = [F.col(f.name) if f.name in rows.columns else F.lit(None) for f in CAPTURE_BLOCKS]
    rows = rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(known, CAPTURE_BLOCKS)])
    # a block is a small row but much work, so blocks are dealt by number, not by bytes
    guessed = rows.repartition(_tasks(rows)).mapInArrow(_guessed, CAPTURE_BLOCKS)
    folder = run_folder(spark, "capture-blocks")
    guessed.repartition("path").sortWithinPartitions("path", "block").mapInArrow(
        _agreed, CAPTURE_BLOCKS
    ).write.parquet(folder)
    return spark.read.schema(CAPTURE_BLOCKS).parquet(folder)


def _tasks(blocks):
    """So many that a task has about ``TASK_BYTES``, however many small files these are, and each core has some."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    n, size = blocks.agg(F.count(F.lit(1)), F.sum(F.col("hi") - F.col("lo"))).first()
    return max(1, min(n, max(math.ceil((size or 0) / TASK_BYTES), 2 * cores), MOST_TASKS))


def _up_to_damage(found):
    try:
        yield from found
    except walk.Damaged:
        return  # the index has it


def _read_blocks(batches):
    for batch in batches:
        for row in batch.to_pylist():
            data = walk.File(row["path"], row["length"])
            steps = walk.walker(data, row["order_in"], row["known_heads"])
            found = _up_to_damage(walk.packets(steps, row["start"], row["hi"]))
            yield from frame_batches(data, found, row["path"], row["capture"], row["first_frame"])
            data.close()


def indexed_frames(index):
    """Frames of all readable blocks, those before a damaged record included."""
    rows = index.filter("frames > 0")
    return rows.repartition(_tasks(rows)).mapInArrow(_read_blocks, FRAMES)


def rejected_captures(index):
    """``path`` and ``problem`` of the files that could not be read to their end."""
    return index.filter(F.col("problem").isNotNull()).select("path", "problem")


def _number(data, at, size):
    """Big-endian unsigned number of ``size`` bytes at 0-based ``at``; NULL past the end."""
    part = F.substring(data, at + 1, size)
    number = F.conv(F.hex(part), 16, 10).cast("int")
    return F.when(F.octet_length(part) == size, number)


def _address(data, at):
    return F.concat_ws(".", *[_number(data, at + i, F.lit(1)).cast("string") for i in range(4)])


def _network(frames, frame, start, prefix, link=None):
    """Add type and offset of the network header that follows a link header."""
    two = F.lit(2)
    ether_type = _number(frame, start + 12, two)
    tagged = ether_type.isin(*TYPES_VLAN)
    kind = F.when(tagged, _number(frame, start + 16, two)).otherwise(ether_type)
    offset = F.when(tagged, start + 18).otherwise(start + 14)
    if link is not None:
        kind = first_match(
            [
                (link == ETHERNET, kind),
                (link == COOKED, _number(frame, F.lit(14), two)),
                (link == COOKED_V2, _number(frame, F.lit(0), two)),
            ]
        )
        offset = first_match(
            [
                (link == ETHERNET, offset),
                (link == COOKED, F.lit(16)),
                (link == COOKED_V2, F.lit(20)),
            ]
        )
    return frames.withColumns({prefix + "kind": kind, prefix + "at": offset})


def _transport(frames, frame, prefix):
    """Add protocol and transport offset of the IPv4 header at ``prefix + at``."""
    at = F.col(prefix + "at")
    version = _number(frame, at, F.lit(1))
    is_ip = (F.col(prefix + "kind") == TYPE_IPV4) & (F.shiftright(version, 4) == 4)
    fragment = _number(frame, at + 6, F.lit(2)).bitwiseAND(0x1FFF)
    return frames.withColumns(
        {
            prefix + "is_ip": F.coalesce(is_ip, F.lit(False)),
            prefix + "proto": F.when(is_ip & (fragment == 0), _number(frame, at + 9, F.lit(1))),
            prefix + "data": at + version.bitwiseAND(0x0F) * 4,
        }
    )


def read_headers(frames):
    """Header columns of frames: addresses, TCP / UDP flags and a summary text.

    Reads Ethernet (with one VLAN tag) and Linux cooked frames, ARP, IPv4, TCP,
    UDP, and the same behind one VXLAN header. The summary names the innermost
    TCP or UDP ports.
    """
    frame = F.col("frame")
    two, one = F.lit(2), F.lit(1)
    df = _network(frames, frame, F.lit(0), "o_", F.col("link_type"))
    df = _transport(df, frame, "o_")
    tunnel = (F.col("o_proto") == PROTO_UDP) & (
        _number(frame, F.col("o_data") + 2, two) == VXLAN_PORT
    )
    df = df.withColumn("tunnel", F.coalesce(tunnel, F.lit(False)))
    df = _network(df, frame, F.when(F.col("tunnel"), F.col("o_data") + 16), "i_")
    df = _transport(df, frame, "i_")

    inner = F.col("tunnel") & F.col("i_is_ip")
    proto = F.when(inner, F.col("i_proto")).otherwise(F.col("o_proto"))
    ip_at = F.when(inner, F.col("i_at")).otherwise(F.col("o_at"))
    data = F.when(inner, F.col("i_data")).otherwise(F.col("o_data"))
    is_arp = F.col("o_kind") == TYPE_ARP
    df = df.withColumns(
        {
            "proto_no": proto,
            "ip_at": ip_at,
            "sport": F.when(proto.isin(PROTO_TCP, PROTO_UDP), _number(frame, data, two)),
            "dport": F.when(proto.isin(PROTO_TCP, PROTO_UDP), _number(frame, data + 2, two)),
            "flags": F.when(proto == PROTO_TCP, _number(frame, data + 13, one)),
            "ip_src": F.when(F.col("o_is_ip"), _address(frame, F.col("o_at") + 12)),
            "ip_dst": F.when(F.col("o_is_ip"), _address(frame, F.col("o_at") + 16)),
            "arp_src": F.when(is_arp, _address(frame, F.col("o_at") + 14)),
            "arp_dst": F.when(is_arp, _address(frame, F.col("o_at") + 24)),
            "has_tcp": F.coalesce(proto == PROTO_TCP, F.lit(False)),
            "has_udp": F.coalesce(F.col("o_proto") == PROTO_UDP, F.lit(False)),
        }
    )
    return df.withColumn("summary", _summary(frame)).select(
        "path", "capture", "frame_no", "timestamp", "length", "summary",
        "ip_src", "ip_dst", "arp_src", "arp_dst", "has_tcp", "has_udp",
    )


def _port(number):
    names = F.create_map(*[F.lit(x) for pair in PORT_NAMES.items() for x in pair])
    return F.coalesce(F.element_at(names, number), number.cast("string"))


def _summary(frame):
    proto = F.col("proto_no")
    flags = F.concat(
        *[
            F.when(F.col("flags").bitwiseAND(1 << bit) != 0, letter).otherwise("")
            for bit, letter in enumerate(TCP_FLAGS)
        ]
    )
    ends = F.concat(
        _address(frame, F.col("ip_at") + 12), F.lit(":"), _port(F.col("sport")),
        F.lit(" > "),
        _address(frame, F.col("ip_at") + 16), F.lit(":"), _port(F.col("dport")),
    )
    start = F.when(F.col("tunnel"), "Ether / IP / UDP / VXLAN / Ether / IP / ").otherwise(
        "Ether / IP / "
    )
    return first_match(
        [
            (proto == PROTO_TCP, F.concat(start, F.lit("TCP "), ends, F.lit(" "), flags)),
            (proto == PROTO_UDP, F.concat(start, F.lit("UDP "), ends)),
            (
                F.col("o_is_ip"),
                F.concat(F.lit("Ether / "), F.col("ip_src"), F.lit(" > "), F.col("ip_dst")),
            ),
            (
                F.col("arp_src").isNotNull(),
                F.concat(F.lit("Ether / ARP who has "), F.col("arp_dst"), F.lit(" says "), F.col("arp_src")),
            ),
        ],
        F.lit("Ether"),
    )


def decode_captures(files):
    """Packet rows of capture files; the file and frame number identify each."""
    return normalize_packets(read_headers(read_frames(files)))


def read_captures(spark, folder, rejected=None, block_bytes=BLOCK_BYTES):
    """Packet rows of every capture file in ``folder``, read by blocks of bytes.

    A file of another kind or with a damaged record raises an error. With
    ``rejected``, a folder, such files are written there with the reason, and
    what stands before the damage is read. File systems are those pyarrow knows.
    """
    index = index_captures(list_captures(spark, folder), block_bytes)
    problems = rejected_captures(index)
    if rejected is not None:
        problems.write.mode("overwrite").parquet(rejected)
    elif (bad := problems.first()) is not None:
        raise ValueError(f"{bad.path}: {bad.problem}")
    rows = normalize_packets(read_headers(indexed_frames(index)))
    # Decoded once: a filter on packets would else be pushed down through every
    # header column, and its expression would grow with each of them.
    stored = run_folder(spark, "packets")
    rows.write.parquet(stored)
    return spark.read.schema(rows.schema).parquet(stored)


def stream_captures(spark, folder):
    """Packet rows of capture files as they appear in ``folder``, each read once.

    Captures that grow or are rotated in place: ``streaming.captures``.
    """
    files = spark.readStream.format("binaryFile").schema(CAPTURE_FILES).load(folder)
    return decode_captures(files)
