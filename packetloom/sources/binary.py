"""Files written from rows and read by rows, byte for byte.

A file stands under its own name, or with others in a pack: one stored file that
holds their bytes end to end. A member's path is ``<pack>#<first byte>+<length>/<name>``.
"""

import re
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from packetloom.session import ship
from packetloom.sources.walk import located

WRITTEN = "path string, length bigint"
PACKED = "name string, path string, length bigint"
READ = "path string, content binary"
#: Contents are handed on in batches of so many files or about so many bytes.
BATCH_FILES, BATCH_BYTES = 1024, 8 * 1024 * 1024
#: A pack that holds so many files or about so many bytes is closed.
PACK_FILES, PACK_BYTES = 65536, 32 * 1024 * 1024
#: Members of a pack that are so near are read at once, with what lies between.
NEAR_BYTES = 64 * 1024
_MEMBER = re.compile(r"(.+?/[0-9a-f]{32}\.pack)#(\d+)\+(\d+)/.*", re.DOTALL)


def write_files(files, folder):
    """Write ``content`` of each row to ``folder`` under its ``name``; one row per file written.

    Nothing is written before the result is used. A file comes under its name
    by a rename when it is whole, so a reader sees the old or the new one, and a task
    that is made again replaces its files. Rows of one name: the last one stays.
    """
    ship(files.sparkSession)

    def write(batches):
        system, base = located(folder)
        for batch in batches:
            done = []
            for name, content in zip(batch["name"].to_pylist(), batch["content"]):
                target = f"{base}/{name}"
                parent = target.rpartition("/")[0]
                system.create_dir(parent, recursive=True)
                # a draft of its own: tasks may write one name at the same time
                draft = f"{parent}/.{uuid.uuid4().hex}.part"
                with system.open_output_stream(draft) as out:
                    if content.is_valid:
                        out.write(content.as_buffer())
                system.move(draft, target)
                done.append((f"{folder}/{name}", len(content.as_buffer()) if content.is_valid else 0))
            yield pa.RecordBatch.from_pydict(
                {"path": pa.array([d[0] for d in done], pa.string()), "length": pa.array([d[1] for d in done], pa.int64())}
            )

    return files.select("name", "content").mapInArrow(write, WRITTEN)


def pack_files(files, folder, most_files=PACK_FILES, most_bytes=PACK_BYTES):
    """Write ``content`` of each row to a pack in ``folder``; one row per file: its name, path and length.

    Packs grow in number with the bytes and with the tasks, not with the files. Nothing
    is written before the result is used. A pack's name is its own, and its rows
    come when it is whole; what a task that failed has packed, no row names.
    """
    ship(files.sparkSession)

    def write(batches):
        system, base = located(folder)
        system.create_dir(base, recursive=True)
        pack = None
        try:
            for batch in batches:
                for name, content in zip(batch["name"].to_pylist(), batch["content"]):
                    pack = pack or _Pack(system, base, folder)
                    pack.add(name, content)
                    if len(pack.names) >= most_files or pack.size >= most_bytes:
                        rows, pack = pack.close(), None
                        yield rows
            if pack:
                rows, pack = pack.close(), None
                yield rows
        finally:
            if pack:
                pack.drop()

    return files.select("name", "content").mapInArrow(write, PACKED)


class _Pack:
    """A pack that is being written."""

    def __init__(self, system, base, folder):
        own = f"{uuid.uuid4().hex}.pack"
        self.system, self.target, self.path = system, f"{base}/{own}", f"{folder}/{own}"
        self.out = system.open_output_stream(self.target, buffer_size=1 << 20)
        self.names, self.paths, self.lengths, self.size = [], [], [], 0

    def add(self, name, content):
        length = 0
        if content.is_valid:
            self.out.write(content.as_buffer())
            length = len(content.as_buffer())
        self.names.append(name)
        # of equal width, so that paths sort as the bytes lie
        self.paths.append(f"{self.path}#{self.size:012d}+{length}/{name}")
        self.lengths.append(length)
        self.size += length

    def close(self):
        self.out.close()
        columns = [pa.array(self.names, pa.string()), pa.array(self.paths, pa.string()), pa.array(self.lengths, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["name", "path", "length"])

    def drop(self):
        self.out.close()
        self.system.delete_file(self.target)


def by_pack(files):
    """Each ``path`` once; those in one pack come to one task, as they lie in it."""
    pack = F.substring_index("path", ".pack#", 1)
    return files.select("path", pack.alias("pack")).repartition("pack").distinct().sortWithinPartitions("path").select("path")


def read_files(files):
    """``path`` and ``content`` of the file that each row's ``path`` names; one that is missing raises an error.

    Files are opened where their rows are, a pack once for a batch of rows. No folder is listed, so
    the driver holds nothing of them, however many they are.
    """
    ship(files.sparkSession)

    def read(batches):
        for batch in batches:
            paths, contents, size = [], [], 0
            for path, content in _opened(batch["path"].to_pylist()):
                paths.append(path)
                contents.append(content)
                size += len(content)
                if len(paths) == BATCH_FILES or size >= BATCH_BYTES:
                    yield _contents(paths, contents)
                    paths, contents, size = [], [], 0
            if paths:
                yield _contents(paths, contents)

    return files.select("path").mapInArrow(read, READ)


def _opened(paths):
    packs = {}
    for path in paths:
        member = _MEMBER.fullmatch(path)
        if member:
            packs.setdefault(member[1], []).append((int(member[2]), int(member[3]), path))
        else:
            system, name = located(path)
            with system.open_input_file(name) as file:
                yield path, file.read()
    for pack, members in packs.items():
        system, name = located(pack)
        with system.open_input_file(name) as file:
            for start, end, run in _runs(sorted(members)):
                block = file.read_at(end - start, start)
                if len(block) < end - start:
                    raise EOFError(f"{pack} ends before byte {end}")
                for at, length, path in run:
                    yield path, block[at - start : at - start + length]


def _runs(members):
    """First byte, end and members of each stretch that is read at once."""
    run, start, end = [], 0, 0
    for member in members:
        at, length, _ = member
        if run and (at > end + NEAR_BYTES or at + length > start + BATCH_BYTES):
            yield start, end, run
            run = []
        if not run:
            start = end = at
        run.append(member)
        end = max(end, at + length)
    if run:
        yield start, end, run


def _contents(paths, contents):
    return pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "content": pa.array(contents, pa.binary())})
