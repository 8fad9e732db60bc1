"""Stream tables that stay a bounded number of folders.

A stream writes a folder per batch, so that a batch made again replaces its rows.
Only the newest batch can be made again; older ones are closed. ``compact`` merges
every ``EACH`` closed batches into one folder and, as soon as there are ``FAN`` merged
folders of equal span, those into one: a row is written anew once for each power of
``FAN``. A version of the log below ``_merged`` names the merged folders and the
last batch they hold; publishing it is the swap. Folders that it replaces are
deleted when the next version is published, so readers that run meanwhile end well.
"""

import uuid

from pyspark.sql import types as T

from packetloom.sources.shared import Exists, Store, VersionLog

EACH, FAN = 20, 10
BATCH = "batch_id"


def _log(spark, path):
    return VersionLog(spark, f"{path}/_merged/_log")


def _batches(store, path):
    names = (n.partition("=") for n in store.names(path))
    return sorted(int(number) for key, _, number in names if key == BATCH and number.isdigit())


def _merged(spark, path, schema, folders):
    full = T.StructType([*[f for f in schema if f.name != BATCH], T.StructField(BATCH, T.LongType())])
    return spark.read.schema(full).parquet(*[f"{path}/_merged/{f}" for f in folders])


def _plain(spark, path, schema, batches):
    full = T.StructType([*[f for f in schema if f.name != BATCH], T.StructField(BATCH, T.LongType())])
    folders = [f"{path}/{BATCH}={b}" for b in batches]
    return spark.read.schema(full).option("basePath", path).parquet(*folders)


def read_batches(spark, path, schema):
    """Rows of all batches, merged or not, with ``batch_id``; no rows if there are none."""
    _, state = _log(spark, path).newest()
    merged = [e["folder"] for e in state["merged"]] if state else []
    last = state["last"] if state else -1
    open_batches = [b for b in _batches(Store(spark, path), path) if b > last]
    parts = []
    if merged:
        parts.append(_merged(spark, path, schema, merged))
    if open_batches:
        parts.append(_plain(spark, path, schema, open_batches))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, *([] if BATCH in schema.names else [T.StructField(BATCH, T.LongType())])]))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def compact(spark, path, schema, before, each=EACH, fan=FAN):
    """Merge closed batches, those below ``before``, once there are ``each`` of them.

    Returns whether a version was published. If another call was faster, nothing
    changes. A call that breaks off leaves only folders that no version names.
    """
    log, store = _log(spark, path), Store(spark, path)
    version, state = log.newest()
    state = state or {"last": -1, "merged": [], "replaced": []}
    closed = [b for b in _batches(store, path) if state["last"] < b < before]
    if len(closed) < each:
        return False
    entries = [*state["merged"], {"folder": f"rows-{uuid.uuid4().hex}", "span": 1}]
    replaced = [f"{path}/{BATCH}={b}" for b in closed]
    rows, gone = _plain(spark, path, schema, closed), []
    while len(entries) > fan and len({e["span"] for e in entries[-fan - 1 : -1]} | {entries[-1]["span"]}) == 1:
        gone = entries[-fan - 1 : -1]
        entries = [*entries[: -fan - 1], {"folder": entries[-1]["folder"], "span": entries[-1]["span"] * (fan + 1)}]
        rows = rows.unionByName(_merged(spark, path, schema, [e["folder"] for e in gone]))
        replaced += [f"{path}/_merged/{e['folder']}" for e in gone]
    target = f"{path}/_merged/{entries[-1]['folder']}"
    # as many files as there is data for, hot batches split
    rows.hint("rebalance").write.parquet(target)
    try:
        log.add(version + 1, {"last": closed[-1], "merged": entries, "replaced": replaced})
    except Exists:
        store.delete(target)
        return False
    for old in state["replaced"]:
        store.delete(old)
    if version >= 0:
        log.drop(version)
    return True
