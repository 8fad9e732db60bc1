"""Capture files that grow or are rotated under one name, as a stream.

Spark's file source knows a file by its path and reads it once. This source knows
a capture by the digest of its first packet: an offset holds, for each path, that
name and the bytes taken. A batch reads the complete records that were added, a
file in one task, small ones many a task; a path that holds another capture, or a shorter one, is read from its
start. The driver lists the folder and reads first packets, nothing else.

Where the taken records of a capture end, and how many they are, a task leaves in a
small file below ``state``, for the task of the next batch. It says what the
capture's bytes say, so a batch that is made again finds or writes the same; if it
is missing, the task walks from the start of the capture.
"""

import base64
import hashlib
import json

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from packetloom.operators.packets import normalize_packets
from packetloom.schemas import FRAMES, PACKETS
from packetloom.session import ship
from packetloom.sources import walk
from packetloom.sources.captures import frame_batches, read_headers
from packetloom.streaming.alerts import read_table, run_alert_stream
from packetloom.streaming.compaction import compact, read_batches

FORMAT = "packetloom_captures"
NEW_FRAMES = T.StructType([*FRAMES.fields, T.StructField("problem", T.StringType(), True)])
REJECTED = T.StructType([T.StructField("path", T.StringType()), T.StructField("problem", T.StringType())])
#: Files of an unknown kind are told by so many first bytes.
HEAD = 4096
#: Files share a task up to so many added bytes; a file counts as so many at least.
TASK_BYTES, FILE_BYTES = 4 * 1024 * 1024, 16 * 1024


def _name(data):
    """A capture's name; files without a complete first packet have none yet."""
    try:
        steps = walk.walker(data)
        return walk.capture_name(data, steps) if steps else ""
    except walk.Damaged:
        return "damaged-" + hashlib.md5(data.read(0, HEAD)).hexdigest()


class Grown:
    """What was added to the capture at ``path``."""

    def __init__(self, path, capture, taken, size):
        self.path, self.capture, self.taken, self.size = path, capture, taken, size


class Share(InputPartition):
    """Grown captures that one task reads."""

    def __init__(self, grown):
        self.grown = grown


class CaptureReader(DataSourceStreamReader):
    def __init__(self, folder, state):
        self.folder, self.state, self.seen = folder, state, {}

    def initialOffset(self):
        return {}

    def latestOffset(self):
        system, name = walk.located(self.folder)
        prefix = self.folder[: len(self.folder) - len(name)] if self.folder.endswith(name) else ""
        out = {}
        for info in system.get_file_info(fs.FileSelector(name, allow_not_found=True)):
            if info.type != fs.FileType.File or info.base_name[0] in "._":
                continue
            path, version = prefix + info.path, (info.size, info.mtime_ns)
            if self.seen.get(path, (None, ""))[0] != version:
                data = walk.File(path, info.size, HEAD)
                self.seen[path] = version, _name(data)
                data.close()
            if capture := self.seen[path][1]:
                out[path] = {"capture": capture, "size": info.size}
        return out

    def partitions(self, start, end):
        shares, room = [], 0
        for path, now in end.items():
            old = start.get(path, {})
            taken = old["size"] if old.get("capture") == now["capture"] and old["size"] <= now["size"] else 0
            if taken < now["size"]:
                if room <= 0:
                    shares.append([])
                    room = TASK_BYTES
                shares[-1].append(Grown(path, now["capture"], taken, now["size"]))
                room -= max(now["size"] - taken, FILE_BYTES)
        return [Share(grown) for grown in shares]

    def read(self, partition):
        for part in partition.grown:
            data = walk.File(part.path, part.size)
            try:
                if _name(data) == part.capture:
                    yield from self._added(part, data)
            finally:
                data.close()

    def _added(self, part, data):
        left = Left(self.state, part.path, part.capture)
        known = left.read(part.taken)
        if known["problem"]:
            left.write(part.taken, part.size, known)
            return
        found = _Found(data, known)
        try:
            for batch in frame_batches(data, found, part.path, part.capture, known["frames"]):
                yield _with_problem(batch.columns, batch.num_rows)
        finally:
            now = found.state()
        if now["problem"]:
            yield _with_problem([pa.array([v], f.type) for v, f in zip([part.path, part.capture] + [None] * 5, _SCHEMA)], 1, now["problem"])
        left.write(part.taken, part.size, now)


_SCHEMA = pa.schema(
    [
        ("path", pa.string()), ("capture", pa.string()), ("frame_no", pa.int64()), ("link_type", pa.int32()),
        ("timestamp", pa.float64()), ("length", pa.int64()), ("frame", pa.binary()), ("problem", pa.string()),
    ]
)


def _with_problem(columns, n, problem=None):
    return pa.RecordBatch.from_arrays([*columns, pa.array([problem] * n, pa.string())], schema=_SCHEMA)


class _Found:
    """Packets from where earlier batches stopped; remembers where this walk stops."""

    def __init__(self, data, known):
        self.data, self.frames, self.problem = data, known["frames"], None
        self.at, self.order, self.heads = known["at"], known["order"], base64.b64decode(known["heads"])

    def __iter__(self):
        try:
            steps = walk.walker(self.data, self.order, self.heads)
            self.at = steps.start if self.at is None else self.at
            while found := steps.step(self.at):
                self.at, packet = found
                self.order = steps.order
                if packet:
                    self.frames += 1
                    yield self.at, steps.packet(packet)
            self.heads = steps.heads if walk.starts_section(steps.heads) else self.heads + steps.heads
        except walk.Damaged as damage:
            self.problem = str(damage)

    def state(self):
        heads = base64.b64encode(self.heads).decode()
        return {"at": self.at, "frames": self.frames, "order": self.order, "heads": heads, "problem": self.problem}


class Left:
    """The small files that tell where a capture's taken records end."""

    def __init__(self, state, path, capture):
        self.system, folder = walk.located(state)
        self.folder, self.capture = f"{folder}/{hashlib.md5(path.encode()).hexdigest()}", capture

    def _file(self, size):
        return f"{self.folder}/{self.capture}-{size}.json"

    def read(self, size):
        try:
            with self.system.open_input_file(self._file(size)) as file:
                return json.loads(file.read())
        except FileNotFoundError:
            return {"at": None, "frames": 0, "order": None, "heads": "", "problem": None}

    def write(self, before, size, state):
        """Leave ``state``; files that no batch can need again go."""
        self.system.create_dir(self.folder, recursive=True)
        with self.system.open_output_stream(self._file(size)) as file:
            file.write(json.dumps(state).encode())
        needed = {self._file(before), self._file(size)}
        for info in self.system.get_file_info(fs.FileSelector(self.folder)):
            if info.path not in needed:
                try:
                    self.system.delete_file(info.path)
                except FileNotFoundError:
                    pass  # another attempt of this task was faster


class CaptureSource(DataSource):
    """``spark.readStream.format(FORMAT)`` with the options ``path`` and ``state``."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return NEW_FRAMES

    def streamReader(self, schema):
        return CaptureReader(self.options["path"], self.options["state"])


def stream_frames(spark, folder, state):
    """Frames as they are added to the captures in ``folder``.

    A file that cannot be read further gives one row with a ``problem`` and no
    frame; the others go on. ``state`` is a folder that all executors reach.
    """
    ship(spark)
    spark.dataSource.register(CaptureSource)
    return spark.readStream.format(FORMAT).option("state", state).load(folder)


def sorted_out(rejected):
    """Function of a batch of frames: writes problems to ``rejected``, gives packets."""

    def prepare(batch, batch_id):
        problems = batch.filter("problem is not null").select(*REJECTED.names)
        if not problems.isEmpty():
            problems.write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")
        return normalize_packets(read_headers(batch.filter("problem is null")))

    return prepare


def run_capture_alerts(spark, folder, tables, trigger=None, **rules):
    """From live captures to packets and alerts; the tables are those of the alert stream.

    Files that cannot be read are listed in ``tables.rejected`` with the reason.
    """
    frames = stream_frames(spark, folder, f"{tables.out}/captures")
    prepare = sorted_out(tables.rejected)
    return run_alert_stream(
        frames, tables, trigger, lambda batch, n: prepare(batch, n).select(*PACKETS.names), **rules
    )


def take_captures(spark, folder, out):
    """Take what is new in ``folder`` into ``out``; returns all packets taken so far.

    A batch that broke off is made again and replaces its packets. Rejected files:
    ``rejected_files``.
    """
    prepare = sorted_out(f"{out}/rejected")

    def process(batch, batch_id):
        batch = batch.persist()
        try:
            prepare(batch, batch_id).write.mode("overwrite").parquet(f"{out}/packets/batch_id={batch_id}")
        finally:
            batch.unpersist()
        compact(batch.sparkSession, f"{out}/packets", empty.schema, batch_id)

    empty = normalize_packets(read_headers(spark.createDataFrame([], FRAMES)))
    frames = stream_frames(spark, folder, f"{out}/captures")
    frames.writeStream.foreachBatch(process).option("checkpointLocation", f"{out}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return read_batches(spark, f"{out}/packets", empty.schema).select(*empty.columns)


def rejected_files(spark, out):
    """``path`` and ``problem`` of the captures that could not be read further."""
    return read_table(spark, f"{out}/rejected", REJECTED)
