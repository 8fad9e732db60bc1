"""String helpers shared by the operators."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

# Fixed value: white space in the Unicode sense plus the four separators
# U+001C to U+001F, as a regex class body.
WHITE_SPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Byte units by power of 1024, largest first.
BYTE_UNITS = ((4, "TB"), (3, "GB"), (2, "MB"), (1, "KB"))


def strip(col):
    """Remove white space (Unicode) at both ends; inner white space stays."""
    return F.regexp_replace(
        col, rf"^[{WHITE_SPACE}]+|(?<![{WHITE_SPACE}])[{WHITE_SPACE}]+\z", ""
    )


def contains_any(col, words):
    """True if any of ``words`` is a substring."""
    return reduce(or_, [F.contains(col, F.lit(word)) for word in words])


def first_match(rules, default=None):
    """Value of the first rule whose predicate holds; ``rules`` are pairs."""
    (predicate, value), *rest = rules
    chain = F.when(predicate, value)
    for predicate, value in rest:
        chain = chain.when(predicate, value)
    return chain.otherwise(default)


def let(value, body):
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def human_bytes(col):
    """Byte count as text, e.g. ``1.27KB``; below 1024 it is ``80B``."""

    def scaled(power, unit):
        size = F.lit(1024**power).cast("decimal(20,0)")
        number = F.round(col.cast("decimal(20,0)") / size, 2)
        return col >= F.lit(1024**power), F.concat(number.cast("string"), F.lit(unit))

    return first_match(
        [scaled(power, unit) for power, unit in BYTE_UNITS],
        F.concat(col.cast("string"), F.lit("B")),
    )


def mask_address(col, mask=".xxx"):
    """Hide what follows the last dot; values without a dot stay as they are."""
    return F.regexp_replace(col, r"\.[^.]*\z", mask)


def local_text(seconds, zone, pattern):
    """Epoch seconds (double) as formatted wall-clock text in ``zone``."""
    instant = F.timestamp_micros(F.floor(seconds * 1000000).cast("long"))
    return zoned_text(instant, zone, pattern)


def zoned_text(instant, zone, pattern):
    """Timestamp as formatted wall-clock text in ``zone``."""
    wall = F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz"))
    return F.date_format(wall, pattern)
