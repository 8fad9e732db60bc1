"""Bounded packet buffer."""

from pyspark.sql import Window
from pyspark.sql import functions as F

# The buffer holds this many packets and bytes.
BUFFER_ROWS, BUFFER_BYTES = 5000, 10 * 1024 * 1024


def retain_latest(packets, n=BUFFER_ROWS, max_bytes=BUFFER_BYTES, tie_break=()):
    """The newest ``n`` packets that together fit into ``max_bytes``.

    A distributed top-k leaves at most ``n`` rows; only they see the running
    total.
    """
    order = [F.desc("timestamp"), *tie_break]
    newest = packets.orderBy(*order).limit(n)
    running = F.sum("length").over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        newest.withColumn("running", running)
        .filter(F.col("running") <= max_bytes)
        .drop("running")
    )
