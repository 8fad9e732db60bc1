"""Screening and cleaning of uploaded CSV files, a whole folder at once.

Input is a table of files with ``path, length, content`` as Spark's
``binaryFile`` source gives it. Size and name are tested first: they reach the
file source as filters, so a rejected file's bytes are not read.
"""

from pyspark.sql import functions as F

from packetloom.functions import csvtext
from packetloom.functions.text import WHITE_SPACE, first_match, let, strip
from packetloom.operators.lists import audit

# Size limit, file name ending, signatures of binary files,
# script markers, formula starts, limits of the interactive check and all
# verdict texts.
MAX_BYTES = 10 * 1024 * 1024
EXTENSION = ".csv"
SIGNATURES = (
    (b"\x7fELF", "Eseguibile ELF (Linux)"),
    (b"MZ", "Eseguibile PE (Windows)"),
    (b"%PDF", "File PDF"),
    (b"PK\x03\x04", "Archivio ZIP/Office (DOCX/XLSX)"),
    (b"\x1f\x8b", "Archivio GZIP"),
    (b"\x42\x5a\x68", "Archivio BZIP2"),
    (b"\xd0\xcf\x11\xe0", "File Microsoft Office Legacy"),
    (b"\x89PNG\r\n\x1a\n", "Immagine PNG"),
    (b"\xff\xd8\xff", "Immagine JPEG"),
    (b"GIF89a", "Immagine GIF"),
    (b"GIF87a", "Immagine GIF"),
)
SCRIPT_MARKERS = (
    "#!/bin/bash",
    "#!/bin/sh",
    "#!/usr/bin/env python",
    "<script>",
    "</script>",
    "<?php",
    "eval(",
    "exec(",
    "os.system(",
    "subprocess.run(",
)
FORMULA_STARTS = "=+@-"
FORMULA_GUARD = "'"
TOO_LARGE = "File troppo grande. Il limite massimo è 10MB."
WRONG_NAME = "Estensione del file non valida. È consentito solo il formato .csv."
BINARY_FILE = "Rilevato file binario non autorizzato ({}). Iniezione bloccata!"
SCRIPT_FOUND = "Rilevato codice/script sospetto all'interno del file CSV: '{}'. Iniezione bloccata!"
EMPTY_FILE = "Il file CSV è vuoto."
NO_COLUMNS = "Struttura CSV non valida (nessuna colonna trovata)."
RAGGED_ROW = "Inconsistenza nel numero di colonne alla riga {}."
BROKEN_CSV = "Struttura CSV corrotta o non valida: ritorno a capo fuori da un campo tra virgolette"
UPLOAD_USER = "Admin"
BLOCKED_ACTION, BLOCKED_DETAILS = "UploadBlocked", "File: {} - Motivo: {}"
ACCEPTED_ACTION = "UploadSuccess"
ACCEPTED_DETAILS = "Dataset: {} - File: {} - Formule bonificate: {}"


def _filled(template, *columns):
    """``template`` with each ``{}`` replaced by a column."""
    pieces = template.split("{}")
    parts = [F.lit(pieces[0])]
    for column, piece in zip(columns, pieces[1:]):
        parts += [column, F.lit(piece)]
    return F.concat(*parts)


def size_reason(length, max_bytes=MAX_BYTES):
    return F.when(length > max_bytes, F.lit(TOO_LARGE))


def name_reason(name):
    return F.when(~F.endswith(F.lower(name), F.lit(EXTENSION)), F.lit(WRONG_NAME))


def signature_reason(content):
    """Reason if the bytes start like a known binary format."""
    return first_match(
        [
            (F.startswith(content, F.lit(head)), F.lit(BINARY_FILE.format(kind)))
            for head, kind in SIGNATURES
        ]
    )


def decoded(content):
    """Bytes as text: UTF-8 if valid, else Latin-1, which accepts every byte."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(
        F.decode(content, "ISO-8859-1")
    )


def script_reason(text):
    """Reason naming the first script marker, in list order, found in ``text``."""
    return first_match(
        [
            (F.contains(text, F.lit(marker)), F.lit(SCRIPT_FOUND.format(marker)))
            for marker in SCRIPT_MARKERS
        ]
    )


def shape_reason(text, delimiter):
    """Reason if the text is empty, has no columns or any row of unequal width."""

    def uneven_reason(widths):
        first = F.get(widths, F.lit(0))
        row = let(
            first,
            lambda w0: F.array_position(F.transform(widths, lambda w: w != w0), True),
        )
        return F.when(first == 0, F.lit(NO_COLUMNS)).otherwise(
            let(row, lambda r: F.when(r > 0, _filled(RAGGED_ROW, r.cast("string"))))
        )

    return first_match(
        [
            (text == "", F.lit(EMPTY_FILE)),
            (csvtext.has_stray_return(text, delimiter), F.lit(BROKEN_CSV)),
        ],
        let(csvtext.row_widths(text, delimiter), uneven_reason),
    )


def defused(cell):
    """Trimmed cell; one that starts like a formula gets a leading quote mark."""
    bare = strip(cell)
    return F.when(_is_formula(cell), F.concat(F.lit(FORMULA_GUARD), bare)).otherwise(bare)


def _is_formula(cell):
    """The cell starts like a formula, white space aside."""
    return F.rlike(cell, F.lit(rf"^[{WHITE_SPACE}]*+[{FORMULA_STARTS}]"))


def defuse_formulas(df, columns=None):
    """Clean every string column of any table in one projection."""
    names = columns or [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({name: defused(F.col(f"`{name}`")) for name in names})


def screen_uploads(files, contents=None, max_bytes=MAX_BYTES):
    """Verdict per file: ``accepted``, ``reason``, ``delimiter``, ``formula_found``.

    The first failing check names the reason. ``contents`` may be a second read
    of the same files that already leaves out wrong names (see
    ``sources.files.read_uploads``). Text and bytes are not in the result.
    """
    cheap = _cheap_reason(max_bytes)
    rejected = (
        _named(files)
        .drop("content")
        .withColumn("reason", cheap)
        .filter(F.col("reason").isNotNull())
        .withColumns(
            {
                "delimiter": F.lit(None).cast("string"),
                "accepted": F.lit(False),
                "formula_found": F.lit(None).cast("boolean"),
            }
        )
    )
    read = _read(files if contents is None else contents, max_bytes)
    return rejected.unionByName(read.drop("text"))


def _named(files):
    """Table with a ``file`` column; ``binaryFile`` gives the name in the path."""
    if "file" in files.columns:
        return files
    return files.withColumn("file", F.element_at(F.split("path", "/"), -1))


def _cheap_reason(max_bytes):
    return F.coalesce(size_reason(F.col("length"), max_bytes), name_reason(F.col("file")))


def _read(files, max_bytes):
    """Verdicts of the files whose size and name are in order.

    The verdict is one struct made in a single pass over the text. It is
    exploded from a one-element array so that a later filter on it is not
    moved below, where the whole check would run a second time.
    """
    small = _named(files.filter(F.col("length") <= max_bytes)).filter(
        name_reason(F.col("file")).isNull()
    )
    kept = [F.col(f"`{name}`") for name in small.columns if name != "content"]
    verdict = _verdict(F.col("content"))
    return small.select(*kept, F.explode_outer(F.array(verdict)).alias("verdict")).select(
        *kept, "verdict.*"
    )


def _verdict(content):
    def of_content(content):
        return let(decoded(content), lambda text: of_text(content, text))

    def of_text(content, text):
        early = F.coalesce(signature_reason(content), script_reason(text))
        return let(early, lambda reason: of_early(text, reason))

    def of_early(text, early):
        found = F.when(early.isNull(), csvtext.delimiter_of(text))
        return let(found, lambda delimiter: of_shape(text, early, delimiter))

    def of_shape(text, early, delimiter):
        shape = F.when(early.isNull(), shape_reason(text, delimiter))
        return let(F.coalesce(early, shape), lambda reason: verdict(text, delimiter, reason))

    def verdict(text, delimiter, reason):
        accepted = reason.isNull()
        # Most texts hold none of the start characters and need no splitting.
        formula = F.when(
            F.rlike(text, F.lit(f"[{FORMULA_STARTS}]")),
            F.exists(
                csvtext.cells(text, delimiter),
                lambda row: F.exists(row, _is_formula),
            ),
        ).otherwise(False)
        return F.struct(
            reason.alias("reason"),
            accepted.alias("accepted"),
            F.when(accepted, text).alias("text"),
            F.when(accepted, delimiter).alias("delimiter"),
            F.when(accepted, formula).alias("formula_found"),
        )

    return let(content, of_content)


def accepted_uploads(files, max_bytes=MAX_BYTES):
    """Files that pass, with ``text``, ``delimiter`` and ``formula_found``."""
    return (
        _read(files, max_bytes)
        .filter("accepted")
        .drop("accepted", "reason")
    )


def clean_rows(accepted):
    """Rows of accepted files: path, row number from 1, defused cells."""
    rows = csvtext.cells(F.col("text"), F.col("delimiter"))
    return accepted.select("path", F.posexplode_outer(rows).alias("row_no", "cells")).select(
        "path",
        (F.col("row_no") + 1).alias("row_no"),
        F.transform("cells", defused).alias("cells"),
    )


def cleaned_text(text, delimiter):
    """CSV text of the defused cells with the file's own delimiter.

    Cells that hold the delimiter, a quote mark or a line end are quoted, and so is
    the only cell of a row if it is empty.
    """
    special = F.concat(F.lit("[\"\r\n"), F.when(delimiter == "|", r"\|").otherwise(delimiter), F.lit("]"))

    def written(cell):
        quoted = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(F.rlike(cell, special), quoted).otherwise(cell)

    def row(cells):
        line = F.call_function("array_join", F.transform(cells, lambda c: written(defused(c))), delimiter)
        return F.when((F.size(cells) == 1) & (line == ""), '""').otherwise(line)

    lines = F.transform(csvtext.cells(text, delimiter), row)
    return F.concat(F.array_join(lines, "\n"), F.lit("\n"))


def upload_audit(verdicts, at, user=UPLOAD_USER):
    """One audit row per screened file. Needs ``dataset`` and ``description`` beside the verdict.

    As at registration, a form whose name or description is blank is not
    processed, so it leaves no row.
    """
    verdicts = verdicts.filter((strip(F.col("dataset")) != "") & (strip(F.col("description")) != ""))
    found = F.when(F.col("formula_found"), "True").otherwise("False")
    details = F.when(
        F.col("accepted"), _filled(ACCEPTED_DETAILS, F.col("dataset"), F.col("file"), found)
    ).otherwise(_filled(BLOCKED_DETAILS, F.col("file"), F.col("reason")))
    actions = verdicts.select(
        F.lit(user).alias("user"),
        F.when(F.col("accepted"), ACCEPTED_ACTION).otherwise(BLOCKED_ACTION).alias("action"),
        details.alias("details"),
    )
    return audit(actions, at)
