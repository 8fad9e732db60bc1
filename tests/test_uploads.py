import csv
import io
import random

from pyspark.sql import functions as F

from packetloom.functions import csvtext
from packetloom.operators import catalog, uploads
from packetloom.sources.files import read_uploads


def texts(seed, n=400):
    """Random CSV-like texts rich in quotes, delimiters and line breaks."""
    rng = random.Random(seed)
    parts = [",", ",", ";", '"', '""', "\n", "\n", "\r\n", "a", "b c", " ", "=1", "-2", "é"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return made + ["", "\n", "a", "a,", ",", '"', '"a,b', 'x"y,z', '"a"b,c\n', '"a\n\n",b\n', "a,b\r", "a\rb"]


def rows_of(text, delimiter):
    return list(csv.reader(io.StringIO(text), delimiter=delimiter))


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, text string")


def test_cells_equal_the_csv_module(spark):
    values = [t for t in texts(1) if t]
    df = frame(spark, values).select(
        "i",
        csvtext.cells(F.col("text"), ",").alias("cells"),
        csvtext.has_stray_return(F.col("text"), ",").alias("stray"),
    )
    for row in df.collect():
        try:
            want = rows_of(values[row.i], ",")
        except csv.Error:
            assert row.stray, values[row.i]
            continue
        assert not row.stray, values[row.i]
        # An unclosed last field may gain the line feed that ends the text.
        got = [[c for c in r] for r in row.cells]
        if got and got[-1] and want[-1] and got[-1] != want[-1]:
            assert got[-1][-1].rstrip("\n") == want[-1][-1].rstrip("\n"), values[row.i]
            got[-1][-1] = want[-1][-1]
        assert got == want, values[row.i]


def test_shape_reason_equals_the_csv_module(spark):
    values = texts(2)
    df = frame(spark, values).select(
        "i",
        uploads.shape_reason(F.col("text"), F.lit(",")).alias("all_rows"),
    )
    for row in df.collect():
        for limit, got in ((None, row.all_rows),):
            try:
                rows = rows_of(values[row.i], ",")
            except csv.Error:
                assert got == uploads.BROKEN_CSV
                continue
            if not rows:
                want = uploads.EMPTY_FILE
            elif not rows[0]:
                want = uploads.NO_COLUMNS
            else:
                bad = [k for k, r in enumerate(rows[:limit], 1) if len(r) != len(rows[0])]
                want = uploads.RAGGED_ROW.format(bad[0]) if bad else None
            assert got == want, values[row.i]


def test_delimiters(spark):
    cases = {
        "a,b\n1,2\n": ",",
        "a;b\n1;2,5\n": ";",
        "a\tb\n\n1\t2": "\t",
        "a|b\n1|2\n": "|",
        'a;b\n"x;y";2\n': ";",
        "one\ntwo\n": ",",
        "a;b\nc\n": ";",
        "a,b\nc|d\n": "|",
    }
    df = frame(spark, list(cases)).select(csvtext.delimiter_of(F.col("text")))
    assert [r[0] for r in df.collect()] == list(cases.values())


def test_large_quoted_text_needs_no_stack(spark):
    df = spark.range(1).select(
        F.repeat(F.concat(F.lit('a,"'), F.repeat(F.lit('x""'), 20000), F.lit('"\n')), 5).alias("t")
    )
    assert df.select(F.size(csvtext.cells(F.col("t"), F.lit(",")))).first()[0] == 5


def test_signatures_and_encodings(spark):
    heads = [h for h, _ in uploads.SIGNATURES]
    rows = [(bytearray(h + b"rest"),) for h in heads] + [(bytearray(b"a,b"),), (bytearray("é".encode()),), (bytearray(b"\xe9"),)]
    df = spark.createDataFrame(rows, "content binary").select(
        uploads.signature_reason(F.col("content")), uploads.decoded(F.col("content"))
    )
    got = df.collect()
    assert [r[0] for r in got[: len(heads)]] == [uploads.BINARY_FILE.format(k) for _, k in uploads.SIGNATURES]
    assert [tuple(r) for r in got[len(heads) :]] == [(None, "a,b"), (None, "é"), (None, "é")]


def test_first_script_marker_in_list_order(spark):
    df = frame(spark, ["eval( </script> <script>", "<SCRIPT>", "ok"]).select(uploads.script_reason(F.col("text")))
    assert [r[0] for r in df.collect()] == [uploads.SCRIPT_FOUND.format("<script>"), None, None]


def test_folder_is_screened_cleaned_and_registered(spark, tmp_path):
    good = "name;value\n=cmd;  -1 \n\"x;y\";2\n".encode()
    latin = "città,n\nforlì,1\n".encode("latin-1")
    for name, content in {
        "good.csv": good, "latin.CSV": latin, "big.csv": b"a,b\n" * 200, "note.txt": b"a,b\n",
        "zip.csv": b"PK\x03\x04", "late.csv": b"a,b\n" * 60 + b"a\n",
    }.items():
        (tmp_path / name).write_bytes(content)
    files, contents = read_uploads(spark, str(tmp_path))
    verdicts = uploads.screen_uploads(files, contents, max_bytes=500)
    got = {r.file: (r.accepted, r.reason, r.formula_found) for r in verdicts.collect()}
    assert got == {
        "good.csv": (True, None, True),
        "latin.CSV": (True, None, False),
        "big.csv": (False, uploads.TOO_LARGE, None),
        "note.txt": (False, uploads.WRONG_NAME, None),
        "zip.csv": (False, uploads.BINARY_FILE.format("Archivio ZIP/Office (DOCX/XLSX)"), None),
        "late.csv": (False, uploads.RAGGED_ROW.format(61), None),
    }
    accepted = uploads.accepted_uploads(contents, max_bytes=500).persist()
    rows = uploads.clean_rows(accepted.filter("file = 'good.csv'")).orderBy("row_no").collect()
    assert [r.cells for r in rows] == [["name", "value"], ["'=cmd", "'-1"], ["x;y", "2"]]

    form = accepted.withColumns(
        {"dataset": F.col("file"), "category": F.lit("Altro"),
         "description": F.when(F.col("file") == "good.csv", "d").otherwise(" ")}
    )
    empty = catalog.build_catalog(spark.createDataFrame([], "id string, name string, description string, source string, format string, location string, category string, created_at timestamp, schema array<struct<name string, type string, description string>>"))
    (entry,) = catalog.register_accepted(empty, form, "/in/", "2024-01-01").collect()
    assert [(f.name, f.type) for f in entry.schema] == [("name", "String"), ("value", "String")]
    assert entry.location.startswith("/in/good.csv_")


def test_empty_file_in_a_table(spark):
    df = spark.createDataFrame([("/u/e.csv", 0, bytearray())], "path string, length long, content binary")
    assert uploads.screen_uploads(df).first().reason == uploads.EMPTY_FILE


def test_size_filter_reaches_the_file_source(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"a")
    files, _ = read_uploads(spark, str(tmp_path))
    plan = uploads.screen_uploads(files)._jdf.queryExecution().executedPlan().toString()
    assert f"LessThanOrEqual(length,{uploads.MAX_BYTES})" in plan


def test_builtin_datasets_cannot_be_removed(spark):
    table = spark.createDataFrame([("ds_live_sniffer",), ("x",), ("y",)], "id string")
    ids = spark.createDataFrame([("ds_live_sniffer",), ("x",), (None,)], "id string")
    assert sorted(r.id for r in catalog.deregister(table, ids).collect()) == ["ds_live_sniffer", "y"]


def test_catalog_search_folds_case_and_bounds_words(spark):
    df = spark.createDataFrame([("Été", None), ("xane", ""), ("a ane", ""), (None, "èane")], "name string, description string")
    assert catalog.search_catalog(df, "éTÉ").count() == 1
    assert catalog.search_catalog(df, r"\bANE").count() == 2
    assert catalog.search_catalog(df, "").count() == 4
