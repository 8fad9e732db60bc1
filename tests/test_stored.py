"""Stored tables under crashes, conflicts and long streams."""

import threading

import pytest

from packetloom.operators import lists
from packetloom.schemas import BLOCKED, PACKETS
from packetloom.sources import files, snapshots
from packetloom.sources.shared import Exists, Store, VersionLog
from packetloom.streaming import compaction


def block(spark, ip, at, status="BLOCKED"):
    return spark.sql(f"select '{ip}' ip, timestamp '2024-01-01 00:00:{at:02d}' blocked_at, 'r' reason, '{status}' status")


def listed(df):
    return sorted((r.ip, r.status) for r in df.collect())


def test_versions_and_old_readers(spark, tmp_path):
    table = snapshots.Snapshots(spark, str(tmp_path / "t"), BLOCKED)
    assert table.version() == -1 and listed(table.read()) == []
    for k, (ip, status) in enumerate([("a", "BLOCKED"), ("b", "BLOCKED"), ("a", "REMOVED")]):
        assert table.update(lambda rows: lists.upsert_blocked(rows, block(spark, ip, k, status))) == k
    old = table.read(1)
    table.update(lambda rows: rows.filter("ip <> 'b'"))
    assert listed(table.read()) == [("a", "REMOVED")] and listed(old) == [("a", "BLOCKED"), ("b", "BLOCKED")]
    table.expire(keep=2)
    assert table.log.versions() == [2, 3] and listed(table.read(2)) == [("a", "REMOVED"), ("b", "BLOCKED")]


def test_the_slower_of_two_writers_starts_again(spark, tmp_path):
    table = snapshots.Snapshots(spark, str(tmp_path / "t"), BLOCKED)
    table.publish(block(spark, "a", 0), -1)
    calls = []

    def change(rows):
        if not calls:  # another writer comes between reading and publishing
            snapshots.Snapshots(spark, table.path, BLOCKED).update(lambda now: lists.upsert_blocked(now, block(spark, "b", 1)))
        calls.append(1)
        return lists.upsert_blocked(rows, block(spark, "c", 2))

    assert table.update(change) == 2 and len(calls) == 2
    assert [ip for ip, _ in listed(table.read())] == ["a", "b", "c"]
    with pytest.raises(snapshots.Conflict):
        table.publish(block(spark, "z", 3), 0)
    folders = [n for n in Store(spark, table.path).names(table.path) if n.startswith("rows-")]
    assert len(folders) == 3  # losers leave nothing


def test_a_crash_before_the_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    table = snapshots.Snapshots(spark, str(tmp_path / "t"), BLOCKED)
    table.publish(block(spark, "a", 0), -1)
    monkeypatch.setattr(table.log, "add", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.update(lambda rows: rows.limit(0))
    again = snapshots.Snapshots(spark, table.path, BLOCKED)
    assert again.version() == 0 and listed(again.read()) == [("a", "BLOCKED")]
    assert again.update(lambda rows: rows.limit(0)) == 1 and listed(again.read()) == []


def test_a_number_is_given_once(spark, tmp_path):
    won, log = [], VersionLog(spark, str(tmp_path / "log"))

    def write(k):
        try:
            log.add(0, {"by": k})
            won.append(k)
        except Exists:
            pass

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert log.newest() == (0, {"by": log.read(0)["by"]}) and len(won) >= 1
    with pytest.raises(Exists):
        log.add(0, {})


def numbers(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_replacing_a_table_survives_a_crash(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(3), path)
    files.replace_table(spark.range(5), path)
    assert numbers(spark, path) == list(range(5))
    real = Store.rename
    for stop in (1, 2):  # the call breaks off before its first, its second rename
        seen = []

        def rename(self, name, target):
            seen.append(name)
            if len(seen) == stop:
                raise RuntimeError("killed")
            real(self, name, target)

        monkeypatch.setattr(Store, "rename", rename)
        with pytest.raises(RuntimeError):
            files.replace_table(spark.range(7), path)
        monkeypatch.setattr(Store, "rename", real)
        assert files.recover(spark, path)
        assert numbers(spark, path) == list(range(5 if stop == 1 else 7))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_ingest_after_a_broken_write(spark, tmp_path):
    source, target = str(tmp_path / "csv"), tmp_path / "flows"
    spark.sql("select 1 in_bytes, 'Benign' label").write.option("header", True).csv(source)
    (target / "_temporary" / "0").mkdir(parents=True)
    assert files.ingest_if_absent(spark, source, str(target)).count() == 1
    assert files.ingest_if_absent(spark, "nowhere", str(target)).count() == 1


def test_a_long_stream_keeps_few_folders(spark, tmp_path):
    path, total = str(tmp_path / "t"), 100
    store, held = Store(spark, path), None
    for batch in range(total):
        rows = spark.range(batch * 2, batch * 2 + 2).selectExpr("double(id) timestamp", "'s' summary", "1L length", "'a' src", "'b' dst", "'TCP' proto")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch}")
        if compaction.compact(spark, path, PACKETS, batch, each=4, fan=3) and batch > 20:
            if held is not None:  # a reader that began before this swap
                reader, n = held
                assert reader.count() == n
            held = compaction.read_batches(spark, path, PACKETS), 2 * (batch + 1)
    got = compaction.read_batches(spark, path, PACKETS)
    assert sorted((r.timestamp, r.batch_id) for r in got.collect()) == [(float(k), k // 2) for k in range(2 * total)]
    assert len(store.names(path)) <= 2 * 4 + 3 and len(store.names(f"{path}/_merged")) <= 20
    # the newest batch is still one that can be made again
    spark.createDataFrame([], PACKETS).write.mode("overwrite").parquet(f"{path}/batch_id={total - 1}")
    assert compaction.read_batches(spark, path, PACKETS).count() == 2 * (total - 1)
    assert compaction.read_batches(spark, str(tmp_path / "none"), PACKETS).count() == 0
