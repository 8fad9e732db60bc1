"""Block list, alert views, audit log and home-page counts."""

from pyspark.sql import functions as F

from packetloom.functions.text import zoned_text
from packetloom.operators.packets import BLOCKED_STATUS, DISPLAY_TIME

# Banner texts and the size of the live packet buffer.
BANNER_MITIGATED = "ATTACCO MITIGATO"
BANNER_ONGOING = "ATTACCO IN CORSO"
BUFFER_PACKETS = 5000


def current_blocks(log):
    """One row per address of a log of changes: the latest wins.

    The maximum is taken before the shuffle as well, so an address with many
    changes costs one row per task. Equal times are settled by status, then
    reason, so that results repeat.
    """
    latest = F.max(F.struct("blocked_at", "status", "reason"))
    return (
        log.groupBy("ip")
        .agg(latest.alias("last"))
        .select("ip", "last.blocked_at", "last.reason", "last.status")
    )


def upsert_blocked(table, changes):
    """Block list after ``changes``: one row per address, the latest wins."""
    return current_blocks(table.unionByName(changes))


def active_blocks(table):
    """Blocks in force, for listing or for replay to a gateway."""
    return table.filter(F.col("status") == BLOCKED_STATUS)


def recent_alerts(alerts, as_of, seconds=300, n=5, tie_break=("source", "message")):
    """Newest ``n`` alerts of the last ``seconds``, each with their full number.

    ``as_of`` is a column or number (epoch seconds). The count is a scalar
    subquery over the same filter.
    """
    window = alerts.filter(F.col("timestamp") > F.lit(as_of) - seconds)
    number = window.agg(F.count("*").alias("n")).scalar()
    return (
        window.orderBy(F.desc("timestamp"), *tie_break)
        .limit(n)
        .withColumn("recent_count", number)
    )


def attack_banner(alerts, blocked, as_of, seconds=300, tie_break=("source", "message")):
    """Newest recent alert and whether it is mitigated; no row if all is quiet."""
    newest = (
        alerts.filter(F.col("timestamp") > F.lit(as_of) - seconds)
        .orderBy(F.desc("timestamp"), *tie_break)
        .limit(1)
    )
    return _flagged(newest, blocked).select(
        F.when(F.col("is_blocked"), BANNER_MITIGATED)
        .otherwise(BANNER_ONGOING)
        .alias("banner"),
        "source",
        "message",
    )


def alert_board(alerts, blocked, n=10, tie_break=("source", "message")):
    """Newest ``n`` alerts of any age, flagged blocked or not."""
    newest = alerts.orderBy(F.desc("timestamp"), *tie_break).limit(n)
    return _flagged(newest, blocked).select(
        "timestamp", "source", "message", "is_blocked"
    )


def _flagged(alerts, blocked):
    listed = blocked.select("ip").distinct().withColumn("hit", F.lit(True))
    joined = alerts.join(listed, alerts["source"] == listed["ip"], "left")
    return joined.withColumn("is_blocked", F.col("hit").isNotNull())


def audit(actions, at):
    """Audit rows from a table of ``user, action, details``."""
    return actions.select(
        F.lit(at).cast("timestamp").alias("timestamp"), "user", "action", "details"
    )


def latest_audit(table, n=10, zone="UTC", tie_break=("user", "action", "details")):
    """Newest ``n`` audit rows with formatted time."""
    return (
        table.orderBy(F.desc("timestamp"), *tie_break)
        .limit(n)
        .withColumn("timestamp", zoned_text(F.col("timestamp"), zone, DISPLAY_TIME))
    )


def platform_kpis(audit_table, blocked, packets, capacity=BUFFER_PACKETS):
    """Audit rows, blocked addresses and packets held, in one row.

    Each count is one small aggregate; the last two are scalar subqueries.
    """

    def number(table):
        return table.agg(F.count("*").alias("n")).scalar()

    return audit_table.agg(F.count("*").alias("audit_rows")).select(
        "audit_rows",
        number(blocked).alias("blocked_addresses"),
        number(packets).alias("packets_held"),
        F.lit(capacity).cast("long").alias("packet_capacity"),
    )
