"""Prefix trie of conversations, one row per distinct sequence of first turns.

Turns become the MD5 of role and text before anything is shuffled, so a
conversation is a string of 16 bytes a turn. Equal strings are merged, the rest
is sorted by range over all tasks. In a task, sorted neighbours are joined by
their longest common prefix (LCP): union-find takes these edges in descending
depth, and every merge of components makes a branching node; the nodes between
it and the components below have one child each.

A component that touches a task's first or last string may go on in the next
task: its branching nodes stay open, as partial sums. What a task hands on is
this contracted forest: at most the branching prefixes of two strings. Forests
of ``FAN`` neighbouring tasks are merged by the same union-find, until one is
left. A batch of strings in a task is taken the same way, so memory is bounded
by a batch and two conversations' prefixes, whatever the group.

Ids of the members that end in a node are joined in pieces of an id range and
hashed piece by piece in sorted order, so a hot group is never in memory.

Null role or text is empty. A null turn comes first; turns of one number are
taken in the order of their MD5, so repeated rows are two turns. Rows with a null
conv_id belong to no conversation. An empty table has no node. Other columns
are not read, so names cannot clash. One conversation must fit into a task.
"""

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import load, prepare, settled

#: A conversation takes fewer than so many turns of the first one of five.
HEADS, GROUP = 9, 5
#: Bytes of a turn in a string.
WIDE = 16
#: Neighbouring forests merged at a time.
FAN = 64
#: Members' ids are joined in pieces; ids of a piece differ in so many low bits.
RANGE_BITS = 12
NOBODY = hashlib.sha256(b"").hexdigest()

_STATS = "conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, at binary"
#: Finished nodes have a depth; open ones a key, their task and the bytes of their texts.
FOREST = f"{_STATS}, depth bigint, parent_conv_id bigint, under binary, part bigint, key binary, sizes array<bigint>"
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends", pa.string()), ("at", pa.binary()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("under", pa.binary()), ("part", pa.int64()), ("key", pa.binary()),
    ("sizes", pa.list_(pa.int64())),
])


def turn_strings(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``ids`` (hex MD5 of each turn, in order) and ``sizes`` (bytes of its text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn", name.alias("id"), F.octet_length(text).cast("long").alias("size"))
    d = conversations.filter("conv_id is not null").select("conv_id", turn.alias("turn"))
    d = d.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return d.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation with its first h turns taken from the first one of its group of five."""
    own = settled(turn_strings(conversations), "turn-strings")
    # a decimal of all digits, as text, gives the checksum's bytes
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    heads = own.select(
        F.col("conv_id").alias("head_id"), F.slice("ids", 1, HEADS - 1).alias("head_ids"), F.slice("sizes", 1, HEADS - 1).alias("head_sizes"))
    d = own.withColumn("h", h).withColumn("head", F.col("conv_id") - F.col("conv_id") % GROUP)
    d = d.join(heads, F.col("head") == F.col("head_id"), "left")

    def joined(first, rest):
        taken = F.when(F.col("h") > 0, F.slice(first, F.lit(1), F.col("h")))
        kept = F.slice(rest, F.col("h") + 1, F.greatest(F.size(rest) - F.col("h"), F.lit(0)))
        return F.concat(F.coalesce(taken, F.slice(rest, 1, 0)), kept)

    return d.select("conv_id", joined("head_ids", "ids").alias("ids"), joined("head_sizes", "sizes").alias("sizes"))


def ends(strings: DataFrame) -> DataFrame:
    """``name`` and hash of the sorted, comma-joined ids of all conversations of that name."""
    piece = F.concat_ws(",", F.array_sort(F.collect_list("conv_id")).cast("array<string>"))
    pieces = strings.groupBy("name", F.shiftright("conv_id", RANGE_BITS).alias("range")).agg(piece.alias("piece"))

    def hashed(batches):
        name = sha = None
        for batch in batches:
            done = []
            for own, piece in zip(batch["name"].to_pylist(), batch["piece"].to_pylist(), strict=True):
                if own == name:
                    sha.update(b",")
                else:
                    done += [(name, sha.hexdigest())] if sha else []
                    name, sha = own, hashlib.sha256()
                sha.update(piece.encode())
            yield pa.record_batch([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], ["name", "ends"])
        if sha:
            yield pa.record_batch([pa.array([name], pa.binary()), pa.array([sha.hexdigest()], pa.string())], ["name", "ends"])

    return pieces.repartition("name").sortWithinPartitions("name", "range").mapInArrow(hashed, "name binary, ends string")


@dataclass
class Part:
    """A node as far as it is known: what ends in it or hangs below it, but for open nodes."""

    key: bytes
    sizes: list
    conv: int | None = None
    n: int = 0
    kids: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None
    awaited: bool = False
    rows: list = field(default_factory=list)  # finished children that wait for this node's conv_id

    @property
    def depth(self):
        return len(self.key) // WIDE

    def add(self, other):
        self.conv = other.conv if self.conv is None else self.conv if other.conv is None else min(self.conv, other.conv)
        self.n += other.n
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends
        self.awaited |= other.awaited
        self.rows += other.rows


def common(a: bytes, b: bytes) -> int:
    """Turns that two strings begin with in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDE
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // WIDE


def _digest(key):
    return hashlib.md5(key).digest()


def _close(part, down_to, rows):
    """Finish a node and the nodes above it with one child, to below depth ``down_to``; what its parent gets."""
    n, conv, depth = part.n, part.conv, part.depth
    leaves, saved, kids = part.leaves if part.kids else 1, part.saved, part.kids
    for r in part.rows:
        rows[r]["parent_conv_id"] = conv
    for d in range(depth, down_to, -1):
        saved += (n - 1) * (part.sizes[d - 1] if d else 0)
        rows.append({
            "conv_id": conv, "depth": d, "parent_conv_id": conv if d else None, "n_convs": n, "n_children": kids, "n_leaves": leaves,
            "saved_tokens": saved, "ends": (d == depth and part.ends) or NOBODY, "at": _digest(part.key) if d == depth and part.awaited else None})
        kids = 1
    if down_to < 0:
        return None
    return Part(part.key[: down_to * WIDE], part.sizes, conv, n, 1, leaves, saved, rows=[len(rows) - 1])


def contract(parts: list, whole: bool = False) -> tuple[list, list]:
    """Rows of the nodes that are finished within ``parts`` of one range, and the open nodes as parts.

    Edges between neighbours are taken in descending depth. Where two components
    meet, the deeper of them are closed or, if they touch a bound, left open.
    ``whole`` says that nothing comes before or after, so nothing stays open.
    """
    rows, left_open, m = [], [], len(parts)
    if not m:
        return rows, left_open
    parts = sorted(parts, key=lambda p: p.key)
    lcp = [common(parts[i].key, parts[i + 1].key) for i in range(m - 1)]
    # the first string comes after the parts that are its prefixes; the last one after all
    first = next((i for i in range(m - 1) if lcp[i] < parts[i].depth), m - 1)
    boss, low, high = list(range(m)), list(range(m)), list(range(m))
    top = list(parts)

    def find(i):
        while boss[i] != i:
            boss[i] = boss[boss[i]]
            i = boss[i]
        return i

    def leave(part):
        if part.n:
            part.awaited |= bool(part.rows)
            for r in part.rows:
                rows[r]["under"] = _digest(part.key)
            part.rows = []
            left_open.append(part)

    def lifted(i, depth):
        part = top[i]
        if part.depth == depth:
            return part
        if not whole and (low[i] <= first or high[i] == m - 1):
            leave(part)
            return Part(part.key[: depth * WIDE], part.sizes)
        return _close(part, depth, rows)

    for e in sorted(range(m - 1), key=lambda e: -lcp[e]):
        a, b = find(e), find(e + 1)
        node = lifted(a, lcp[e])
        node.add(lifted(b, lcp[e]))
        boss[b], high[a], top[a], top[b] = a, high[b], node, None
    last = top[find(0)]
    if whole:
        _close(last, -1, rows)
    else:
        leave(last)
    return rows, left_open


def _batches(rows, left_open=(), part=0, most=4096):
    out = rows + [{
        "conv_id": p.conv, "n_convs": p.n, "n_children": p.kids, "n_leaves": p.leaves, "saved_tokens": p.saved, "ends": p.ends,
        "at": _digest(p.key) if p.awaited else None, "part": part, "key": p.key, "sizes": p.sizes[: p.depth]} for p in left_open]
    for i in range(0, len(out), most):
        yield pa.RecordBatch.from_pylist(out[i : i + most], schema=_ARROW)


def _parts(table):
    names = ("key", "sizes", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "at")
    for *stats, at in zip(*(table[name].to_pylist() for name in names), strict=True):
        yield Part(*stats, at is not None)


def _forest(batches):
    """Finished nodes of a task's sorted strings, then its open ones."""
    held, part = [], 0
    for batch in batches:
        if batch.num_rows:
            part = batch["part"][0].as_py()
            rows, held = contract(held + list(_parts(batch)))
            yield from _batches(rows)
    yield from _batches([], held, part)


def forests(strings: DataFrame) -> DataFrame:
    """Finished nodes and contracted forests, by task, of sorted ``strings``."""
    none, zero = F.lit(None), F.lit(0).cast("long")
    d = strings.repartitionByRange("key").sortWithinPartitions("key").select(
        F.spark_partition_id().cast("long").alias("part"), "key", "sizes", "conv_id", "n_convs", zero.alias("n_children"),
        zero.alias("n_leaves"), zero.alias("saved_tokens"), "ends", none.cast("binary").alias("at"))
    return d.mapInArrow(_forest, FOREST)


def merged(open_nodes: DataFrame, whole: bool) -> DataFrame:
    """Forests of ``FAN`` neighbouring tasks as one; all of them, if ``whole``."""

    def merge(key, table):
        rows, held = contract(list(_parts(table)), whole)
        return pa.Table.from_batches(_batches(rows, held, key[0].as_py()), schema=_ARROW)

    return open_nodes.groupBy(F.floor(F.col("part") / FAN).alias("joined")).applyInArrow(merge, FOREST)


def trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    prepare(conversations.sparkSession)
    strings = rebuilt(conversations).select("conv_id", F.unhex(F.concat_ws("", "ids")).alias("key"), "sizes")
    strings = settled(strings.withColumn("name", F.unhex(F.md5("key"))), "rebuilt-conversations")
    kinds = strings.groupBy("name").agg(
        F.first("key").alias("key"), F.first("sizes").alias("sizes"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    kinds = kinds.join(ends(strings.select("name", "conv_id")), "name")
    level = settled(forests(kinds), "forests")
    nodes = level.filter("key is null")
    while (last := level.agg(F.max("part")).first()[0]) is not None:
        level = settled(merged(level.filter("key is not null"), last < FAN), "forests")
        nodes = nodes.unionByName(level.filter("key is null"))
    nodes = nodes.select(*[c for c in nodes.columns if c not in ("part", "key", "sizes")])
    # children that were finished before their parent learn its conv_id
    parents = nodes.filter("at is not null").select(F.col("at").alias("parent_at"), F.col("conv_id").alias("late_id"))
    late = nodes.filter("under is not null").drop("parent_conv_id")
    late = late.join(parents, F.col("under") == F.col("parent_at"), "left").withColumnRenamed("late_id", "parent_conv_id")
    return nodes.filter("under is null").unionByName(late.select(*nodes.columns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))


def op12_conversation_trie(spark, folder):
    return trie(load(spark, folder, "conversations"))


ORACLE = r"""
with turns as (
  select conv_id, coalesce(text, '') as body, md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as id,
    row_number() over (partition by conv_id order by turn nulls first,
      md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
bits as (
  select conv_id, flatten(list_transform(string_split(conv_id::varchar, ''),
    lambda c: list_transform(range(8), lambda k: ((ascii(c) >> k) & 1)::bigint))) as message
  from (select distinct conv_id from conversations where conv_id is not null)),
convs as (
  select conv_id, conv_id - conv_id % 5 as head,
    xor(list_reduce(list_concat([4294967295::bigint], message),
      lambda crc, b: xor(crc >> 1, 3988292384 * xor(crc & 1, b))), 4294967295::bigint) % 9 as h
  from bits),
path as (
  select c.conv_id, t.pos, t.id, t.body from convs c join turns t on t.conv_id = c.head and t.pos <= c.h
  union all
  select c.conv_id, t.pos, t.id, t.body from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h),
ranked as (
  select conv_id, id, body, row_number() over (partition by conv_id order by pos) as depth from path),
prefixed as (
  select conv_id, depth, strlen(body) as size,
    string_agg(id, '') over (partition by conv_id order by depth rows unbounded preceding) as prefix from ranked
  union all
  select conv_id, 0, 0, '' from convs),
sized as (
  select *, max(depth) over (partition by conv_id) as length from prefixed),
nodes as (
  select prefix, depth, min(conv_id) as conv_id, count(*) as n, any_value(size) as size,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = length), '')) as ends_sha256
  from sized group by 1, 2),
linked as (
  select a.prefix, a.depth, a.conv_id, a.n, a.size, a.ends_sha256, b.prefix as above, b.conv_id as above_id
  from nodes a left join prefixed p on p.conv_id = a.conv_id and p.depth = a.depth - 1
    left join nodes b on b.prefix = p.prefix),
kids as (select above, count(*) as n_children from linked where above is not null group by 1),
sums as (
  select p.prefix, sum((q.n - 1) * q.size) as saved, count(*) filter (k.n_children is null) as leaves
  from nodes q join prefixed p on p.conv_id = q.conv_id and p.depth <= q.depth left join kids k on k.above = q.prefix
  group by 1)
select l.conv_id, l.depth, l.above_id as parent_conv_id, l.n as n_convs, coalesce(k.n_children, 0) as n_children,
  s.leaves as n_leaves, s.saved::bigint as saved_tokens, l.ends_sha256
from linked l left join kids k on k.above = l.prefix join sums s on s.prefix = l.prefix
"""
