"""Explicit schemas of the tables the operators work on."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_STR, _INT, _LONG, _DBL, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampType(),
)

FLOWS = _struct(
    ("ipv4_src_addr", _STR),
    ("ipv4_dst_addr", _STR),
    ("l4_src_port", _INT),
    ("l4_dst_port", _INT),
    ("protocol", _INT),
    ("in_bytes", _LONG),
    ("out_bytes", _LONG),
    ("in_pkts", _LONG),
    ("out_pkts", _LONG),
    ("flow_duration_milliseconds", _LONG),
    ("flow_start_milliseconds", _LONG),
    ("label", _STR),
    ("attack", _STR),
)

PACKETS = _struct(
    ("timestamp", _DBL),
    ("summary", _STR),
    ("length", _LONG),
    ("src", _STR),
    ("dst", _STR),
    ("proto", _STR),
)

ALERTS = _struct(
    ("timestamp", _DBL),
    ("message", _STR),
    ("severity", _STR),
    ("source", _STR),
    ("target", _STR),
    ("status", _STR),
)

BLOCKED = _struct(("ip", _STR), ("blocked_at", _TS), ("reason", _STR), ("status", _STR))

BLOCKED_BY_BATCH = T.StructType([*BLOCKED.fields, T.StructField("batch_id", _LONG, True)])

ADDRESS_LIST = _struct(("ip", _STR))

AUDIT = _struct(("timestamp", _TS), ("user", _STR), ("action", _STR), ("details", _STR))

FIELD_LIST = T.ArrayType(_struct(("name", _STR), ("type", _STR), ("description", _STR)))

CATALOG = _struct(
    ("id", _STR),
    ("name", _STR),
    ("description", _STR),
    ("source", _STR),
    ("format", _STR),
    ("location", _STR),
    ("category", _STR),
    ("created_at", _TS),
    ("schema", FIELD_LIST),
)

CAPTURE_FILES = _struct(
    ("path", _STR),
    ("modificationTime", _TS),
    ("length", _LONG),
    ("content", T.BinaryType()),
)

FRAMES = _struct(
    ("path", _STR),
    ("capture", _STR),
    ("frame_no", _LONG),
    ("link_type", _INT),
    ("timestamp", _DBL),
    ("length", _LONG),
    ("frame", T.BinaryType()),
)

# One row per block of bytes of a capture file, see ``sources.captures``.
CAPTURE_BLOCKS = _struct(
    ("path", _STR),
    ("length", _LONG),
    ("block", _LONG),
    ("lo", _LONG),
    ("hi", _LONG),
    ("start", _LONG),
    ("end", _LONG),
    ("order_in", _STR),
    ("order_out", _STR),
    ("frames", _LONG),
    ("heads", T.BinaryType()),
    ("capture", _STR),
    ("problem", _STR),
    ("first_frame", _LONG),
    ("known_heads", T.BinaryType()),
)
