"""Cleaned uploads as files: round trip, names, what is registered."""

import csv
import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from packetloom.operators.catalog import build_catalog
from packetloom.operators.uploads import cleaned_text
from packetloom.schemas import CATALOG
from packetloom.sources.files import ingest_uploads


@pytest.mark.parametrize("d", [",", ";", "\t", "|"])
def test_written_rows_are_the_cleaned_ones(spark, d):
    text = f'a{d}b{d}c\n=1+2{d}"x{d}y"{d} +z \n\n"say ""hi"""{d}"two\nlines"{d}\n"  "\n'
    got = spark.createDataFrame([(text, d)], "text string, d string").select(cleaned_text(F.col("text"), F.col("d")).alias("t")).first().t
    rows = list(csv.reader(io.StringIO(got), delimiter=d))
    assert rows == [["a", "b", "c"], ["'=1+2", f"x{d}y", "'+z"], [], ['say "hi"', "two\nlines", ""], [""]]


def test_only_written_uploads_are_registered(spark, tmp_path):
    folder = str(tmp_path / "out")
    schema = "path string, file string, dataset string, description string, category string, text string, delimiter string"
    rows = [
        ("/u/1.csv", "1.csv", "My Set", "d", "x", "a,b\n=1,2\n", ","), ("/u/2.csv", "2.csv", "\t", "d", "x", "a,b\n", ","),
        ("/u/3.csv", "3.csv", "../up\\x", "d", "x", "a;b\n1;2\n", ";")]
    empty = spark.createDataFrame([], CATALOG)
    got = ingest_uploads(empty, spark.createDataFrame(rows, schema), folder, "2024-01-01").collect()
    assert sorted(r.file for r in spark.createDataFrame([(r.location.rsplit("/", 1)[1],) for r in got], "file string").collect()) == sorted(
        p.name for p in (tmp_path / "out").iterdir() if p.name[0] != ".")
    text = {r.name: open(r.location).read() for r in got}
    assert text == {"My Set": "a,b\n'=1,2\n", "../up\\x": "a;b\n1;2\n"}
    assert build_catalog(empty) is not None


def test_files_are_read_where_their_rows_are(spark, tmp_path):
    """Those named, byte for byte, in batches; others in the folder are not touched."""
    from packetloom.sources import binary

    for k in range(5):
        (tmp_path / f"{k} ü.csv").write_bytes(bytes([k]) * (k * 1000))
    paths = [(f"{tmp_path}/{k} ü.csv",) for k in (0, 3, 4)]
    got = binary.read_files(spark.createDataFrame(paths, "path string")).collect()
    assert {(r.path, bytes(r.content)) for r in got} == {(p, open(p, "rb").read()) for p, in paths}


def test_cleaned_files_are_read_back_without_listing_them(spark, tmp_path):
    """The driver must not hold a list of all files: the query scans no folder of them."""
    from packetloom.plans.queries import REGISTRY

    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
    # of the keys, 37 and 31 make files that are refused; the form of 46 has a blank name
    rows = [(k, 7, "O", "1-URGENT") for k in (44, 46, 58, 58)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders.parquet")
    documents = "doc_id bigint, text string, lang string, source string"
    spark.createDataFrame([], documents).write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["cleaned_files"](spark, str(tmp_path))
    assert "binaryFile" not in got._jdf.queryExecution().toString()
    cells = {(r.path, r.row_no, r.cell_no): r.cell for r in got.collect()}
    assert {p.split("/")[2] for p, _, _ in cells} == {"44", "58"}
    assert cells["/uploads/44/Order 44.csv", 2, 0] == "44" and cells["/uploads/44/Order 44.csv", 1, 1] == "state"


def _small_tables(spark, folder, keys):
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
    spark.createDataFrame([(k, 7, "O", "1-URGENT") for k in keys], schema).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    documents = "doc_id bigint, text string, lang string, source string"
    spark.createDataFrame([], documents).write.parquet(f"{folder}/documents.parquet")


def test_stored_files_do_not_grow_in_number_with_the_uploads(spark, tmp_path, monkeypatch):
    """A disk has room for some millions of files only, and each takes a block of it."""
    from packetloom.plans import queries
    from packetloom.sources import files

    for module in (queries, files):
        monkeypatch.setattr(module, "run_folder", lambda spark, name: f"{tmp_path}/kept/{name}")
    _small_tables(spark, tmp_path, range(400))
    uploads = queries.cleaned_files(spark, str(tmp_path)).select("path").distinct().collect()
    assert len(uploads) > 150
    assert 0 < len([p for p in (tmp_path / "kept").rglob("*") if p.is_file()]) < 50


def test_packed_uploads_are_read_back_by_their_locations(spark, tmp_path):
    """Every row's file is the one that a file of its own would hold; a name that comes twice stands once."""
    from packetloom.sources import binary

    schema = "path string, file string, dataset string, description string, category string, text string, delimiter string"
    rows = [(f"/u/{k}.csv", f"{k}.csv", "My/S#t.pack", "d", "x", f"a,b\n={k},ü\n", ",") for k in range(50)]
    rows += [("/u/blank.csv", "b.csv", "\t", "d", "x", "a,b\n", ","), ("/u/7.csv", "7.csv", "My/S#t.pack", "d", "x", "a,b\n=7,ü\n", ",")]
    rows += [(None, "n.csv", "none", "d", "x", "a,b\n", ",")]
    accepted, empty = spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame([], CATALOG)
    single = ingest_uploads(empty, accepted, str(tmp_path / "single"), "2024-01-01").collect()
    packed = ingest_uploads(empty, accepted, str(tmp_path / "packed"), "2024-01-01", packed=True)
    read = binary.read_files(binary.by_pack(packed.select(F.col("location").alias("path"))))
    content = {r.path: bytes(r.content) for r in read.collect()}
    packed = packed.collect()
    assert read.count() == len(content) == 50 and len(packed) == 51

    def seen(entries, contents):
        return sorted((r.id, r.name, r.source, r.location.rsplit("/", 1)[1], contents[r.location], str(r.schema)) for r in entries)

    own = {r.location: Path(r.location).read_bytes() for r in single}
    assert seen(packed, content) == seen(single, own)
    assert len(list((tmp_path / "packed").glob("*.pack"))) <= 3


def test_packs_close_at_their_bounds_and_are_read_in_pieces(spark, tmp_path, monkeypatch):
    from packetloom.sources import binary

    contents = [bytes([k]) * (k * 997 % 300) for k in range(100)] + [b"x" * 5000, None]
    rows = [(f"{k}/ü \n.csv", c) for k, c in enumerate(contents)]
    files = spark.createDataFrame(rows, "name string, content binary").coalesce(1)
    written = binary.pack_files(files, str(tmp_path / "p"), most_files=30, most_bytes=4000)
    written.write.parquet(str(tmp_path / "rows"))
    written = spark.read.parquet(str(tmp_path / "rows"))
    sizes = [p.stat().st_size for p in (tmp_path / "p").iterdir()]
    assert len(sizes) >= 5 and max(sizes) < 9000
    want = {name: content or b"" for name, content in rows}
    assert {r.name: r.length for r in written.collect()} == {name: len(content) for name, content in want.items()}
    names = {r.path: r.name for r in written.collect()}
    got = {names[r.path]: bytes(r.content) for r in binary.read_files(written.select("path")).collect()}
    assert got == want
    some = written.filter(F.col("length") % 3 == 1).select("path")
    assert {names[r.path] for r in binary.read_files(some).collect()} == {n for n, c in want.items() if len(c) % 3 == 1}
    monkeypatch.setattr(binary, "NEAR_BYTES", 10)
    monkeypatch.setattr(binary, "BATCH_BYTES", 700)
    members = list(names)[::2][::-1]
    assert {names[p]: c for p, c in binary._opened(members)} == {names[p]: want[names[p]] for p in members}


def test_a_cut_pack_raises_an_error(spark, tmp_path):
    from packetloom.sources import binary

    rows = spark.createDataFrame([("a", b"12345"), ("b", b"678")], "name string, content binary").coalesce(1)
    paths = [r.path for r in binary.pack_files(rows, str(tmp_path / "p")).collect()]
    pack = Path(paths[0].partition("#")[0])
    pack.write_bytes(pack.read_bytes()[:-1])
    with pytest.raises(EOFError):
        list(binary._opened(paths))
