"""CSV structure of a whole text held in one column.

A quoted field may hold delimiters and line breaks. The expressions below find
quoted fields with possessive patterns, which take time linear in the text and
no stack, so a 10 MiB text is safe.
"""

from pyspark.sql import functions as F

from packetloom.functions.text import first_match, let

# Delimiters that can be found, in order of preference, the order
# tried when no delimiter is consistent, and the last resort.
CANDIDATES = (",", "\t", ";", "|")
FALLBACK = (";", "\t", "|")
DEFAULT_DELIMITER = ","

# Unicode noncharacters, reserved for use inside a program.
_CELL_END, _ROW_END = chr(0xFDD0), chr(0xFDD1)

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"?'


def ended(text):
    """Text whose last line has its line feed."""
    return F.when(F.endswith(text, F.lit("\n")), text).otherwise(
        F.concat(text, F.lit("\n"))
    )


def _per_delimiter(delimiter, build):
    """``build(d)`` for the delimiter of each row.

    ``delimiter`` is a text or a column. Patterns stay constant this way, so
    each is compiled once per task and not for every row.
    """
    if isinstance(delimiter, str):
        return build(delimiter)
    return first_match([(delimiter == d, build(d)) for d in CANDIDATES])


def without_quoted(text, delimiter):
    """Replace each quoted field by one plain character."""

    def replaced(d):
        return F.regexp_replace(text, rf"(^|[{d}\r\n]){_QUOTED}", "$1q")

    return F.when(
        F.contains(text, F.lit('"')), _per_delimiter(delimiter, replaced)
    ).otherwise(text)


def lines(text):
    """Lines of a text; the end of the last line opens no further line."""
    whole = F.regexp_replace(
        F.replace(text, F.lit("\r\n"), F.lit("\n")), r"[\r\n]\z", ""
    )
    return F.split(whole, "\n")


def line_width(line, delimiter):
    """Number of fields in a line without quoted fields; 0 if it is empty."""
    mark = F.lit(delimiter) if isinstance(delimiter, str) else delimiter
    count = F.length(line) - F.length(F.replace(line, mark, F.lit("")))
    return F.when(line == "", F.lit(0)).otherwise(count + 1)


def row_widths(text, delimiter):
    """Array with the number of fields of each row of ``text``."""
    plain = without_quoted(text, delimiter)
    return F.transform(lines(plain), lambda line: line_width(line, delimiter))


def _consistent(text, delimiter):
    """``delimiter`` occurs equally often, at least once, on all non-blank lines."""
    filled = F.filter(row_widths(text, delimiter), lambda width: width > 0)
    widths = F.array_distinct(filled)
    same = let(widths, lambda w: (F.size(w) == 1) & (F.get(w, F.lit(0)) > 1))
    return F.when(F.contains(text, F.lit(delimiter)), same).otherwise(False)


def delimiter_of(text):
    """Delimiter of a CSV text; all of its lines decide."""
    rules = [(_consistent(text, d), F.lit(d)) for d in CANDIDATES]
    rules += [(F.contains(text, F.lit(d)), F.lit(d)) for d in FALLBACK]
    return first_match(rules, F.lit(DEFAULT_DELIMITER))


def has_stray_return(text, delimiter):
    """A carriage return outside quotes that does not end a line."""
    return F.rlike(without_quoted(text, delimiter), F.lit(r"\r(?!\n|\z)"))


def cells(text, delimiter):
    """Rows of a CSV text as an array of arrays of unquoted fields."""
    return _per_delimiter(delimiter, lambda d: _cells(text, d))


def _cells(text, d):
    field = rf"({_QUOTED}[^{d}\r\n]*+|[^{d}\r\n]*+)(?:([{d}])|(\r?\n)|\z)"
    # Each field is followed by what ended it, between the two marks. The text
    # ends with a line feed, so the match at its very end is always surplus.
    marked = F.regexp_replace(ended(text), field, f"$1{_CELL_END}$2$3{_ROW_END}")
    marked = F.regexp_replace(marked, rf"{_CELL_END}{_ROW_END}\z", "")
    marked = F.replace(marked, F.lit(f"{_CELL_END}{d}{_ROW_END}"), F.lit(_CELL_END))
    marked = F.regexp_replace(marked, f"{_CELL_END}(?:\r?\n)?{_ROW_END}", _ROW_END)
    rows = F.split(F.regexp_replace(marked, rf"{_ROW_END}\z", ""), _ROW_END)
    return F.transform(rows, _row_cells)


def _row_cells(row):
    fields = F.transform(F.split(row, _CELL_END), unquoted)
    return F.when(row == "", F.array().cast("array<string>")).otherwise(fields)


def unquoted(field):
    """Field without its quotes; text after the closing quote is kept."""
    parts = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?(.*)\z'
    inner = F.replace(F.regexp_extract(field, parts, 1), F.lit('""'), F.lit('"'))
    return F.when(
        F.startswith(field, F.lit('"')),
        F.concat(inner, F.regexp_extract(field, parts, 2)),
    ).otherwise(field)
