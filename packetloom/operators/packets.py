"""Live packets: normal form, alert rules, lists, grading, display.

List lookups carry no broadcast hint. Spark broadcasts a list whose measured
size is below ``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined
by a sort-merge join whose hot sources adaptive execution splits.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from packetloom.functions.text import first_match, let, local_text, mask_address

# Protocol names, placeholders, alert rules (port name, port
# number, message, whether exempt sources raise no alert), the exempt source,
# the reason of automatic blocks, alert grades, the separator of a summary and
# the display format.
LINK_SOURCE, LINK_TARGET, LINK_PROTOCOL = "Layer 2", "Broadcast", "Ether"
UNKNOWN = "???"
ALERT_RULES = (
    ("bgp", "179", "POSSIBILE BGP HIJACKING: Tentativo di connessione alla porta 179 del nodo ", False),
    ("ftp", "21", "TENTATIVO FILE INJECTION: Tentativo FTP verso ", False),
    ("ssh", "22", "TENTATIVO BRUTE FORCE SSH: Tentativo SSH verso ", False),
    ("http", "80", "POSSIBILE DOS/SYN FLOOD: Traffico HTTP anomalo verso ", True),
    ("27017", "27017", "ACCESSO DATABASE NON AUTORIZZATO: Tentativo verso MongoDB su ", True),
)
EXEMPT_SOURCES = ("10.0.0.2",)
AUTO_BLOCK_REASON = "AUTO-BLOCK: Presente in Black-List"
BLOCKED_STATUS = "BLOCKED"
MITIGATED_GRADE = ("INFO", "MITIGATED")
ACTIVE_GRADE = ("CRITICAL", "ACTIVE")
SEPARATOR = " > "
DISPLAY_TIME = "dd-MM-yyyy HH:mm:ss"
DISPLAY_SUMMARY_CHARS = 80


def _known(name):
    return F.coalesce(F.col(name), F.lit(UNKNOWN))


def normalize_packets(headers):
    """Addresses and protocol from nullable header columns.

    Needs ``ip_src, ip_dst, arp_src, arp_dst, has_tcp, has_udp``; an IP header
    wins over ARP, a frame with neither is a link-layer frame.
    """
    is_ip = F.col("ip_src").isNotNull()
    is_arp = F.col("arp_src").isNotNull()
    proto = first_match(
        [
            (is_ip & F.col("has_tcp"), F.lit("TCP")),
            (is_ip & F.col("has_udp"), F.lit("UDP")),
            (is_ip, F.lit("IP")),
            (is_arp, F.lit("ARP")),
        ],
        F.lit(LINK_PROTOCOL),
    )
    src = F.coalesce("ip_src", "arp_src", F.lit(LINK_SOURCE))
    dst = first_match(
        [(is_ip, F.col("ip_dst")), (is_arp, F.col("arp_dst"))], F.lit(LINK_TARGET)
    )
    return headers.withColumns({"src": src, "dst": dst, "proto": proto}).drop(
        "ip_src", "ip_dst", "arp_src", "arp_dst", "has_tcp", "has_udp"
    )


def destination_part(summary):
    """Text after the first `` > `` in lower case; NULL without a separator."""

    def part(text):
        start = F.instr(text, SEPARATOR) + len(SEPARATOR)
        after = F.substring(text, start, F.length(text))
        found = F.contains(text, F.lit(SEPARATOR))
        return F.when(found, F.substring_index(after, SEPARATOR, 1))

    return let(F.lower(summary), part)


def alert_candidates(packets, exempt=EXEMPT_SOURCES, strict=False):
    """Alerts raised by the port rules, before any list is consulted.

    By default a rule looks for ``:name`` or ``:number`` anywhere in the
    destination part, so ``:8080`` and ``:https`` raise the HTTP alert.
    ``strict`` compares the whole port instead.
    """
    part = destination_part(F.coalesce("summary", F.lit("")))
    exempted = _known("src").isin(*exempt) if exempt else F.lit(False)

    def hit(part, name, number, may_exempt):
        if strict:
            port = F.regexp_extract(part, r":([^\s:]+)(?:\s|\z)", 1)
            found = port.isin(name, number)
        else:
            found = F.contains(part, F.lit(f":{name}")) | F.contains(
                part, F.lit(f":{number}")
            )
        return found & ~exempted if may_exempt else found

    def message(part):
        return first_match(
            [
                (hit(part, name, number, may_exempt), F.concat(F.lit(text), _known("dst")))
                for name, number, text, may_exempt in ALERT_RULES
            ]
        )

    return (
        packets.filter(F.col("proto") == "TCP")
        .select(
            "timestamp",
            let(part, message).alias("message"),
            _known("src").alias("source"),
            _known("dst").alias("target"),
        )
        .filter(F.col("message").isNotNull())
    )


def suppress_allowed(alerts, allow):
    """Drop alerts whose source is on the allow list."""
    return alerts.join(allow.select("ip"), alerts["source"] == F.col("ip"), "left_anti")


def auto_block(packets, deny, blocked, now):
    """Block rows for deny-listed sources that are not blocked yet.

    Any protocol counts and the allow list does not protect. Sources are made
    distinct first, with partial aggregation, so a hot source is one row per
    task; Spark moves the list joins below that step when they broadcast.
    """
    sources = packets.select(_known("src").alias("ip")).distinct()
    return (
        sources.join(deny.select("ip"), "ip", "left_semi")
        .join(blocked.select("ip"), "ip", "left_anti")
        .select(
            "ip",
            F.lit(now).cast("timestamp").alias("blocked_at"),
            F.lit(AUTO_BLOCK_REASON).alias("reason"),
            F.lit(BLOCKED_STATUS).alias("status"),
        )
    )


def grade_alerts(alerts, blocked):
    """Severity and status: alerts of a blocked source are already mitigated."""
    listed = blocked.select("ip").distinct().withColumn("hit", F.lit(True))
    hit = F.col("hit").isNotNull()
    return alerts.join(listed, alerts["source"] == listed["ip"], "left").select(
        "timestamp",
        "message",
        F.when(hit, MITIGATED_GRADE[0]).otherwise(ACTIVE_GRADE[0]).alias("severity"),
        "source",
        "target",
        F.when(hit, MITIGATED_GRADE[1]).otherwise(ACTIVE_GRADE[1]).alias("status"),
    )


def grade_alerts_at(alerts, log, seconds=3600):
    """Severity and status by the state of the block list when each packet came.

    ``log`` has the changes (``ip, blocked_at, status, reason``). The last change of the
    source up to the packet's time counts; of changes at one time the largest status,
    then reason. Changes are gathered by source and stretch of ``seconds``, with
    the state that the stretch begins with, so an alert meets one row and
    adaptive execution can split a hot source. Alerts without a time are active.
    """
    time = F.col("blocked_at").cast("double")
    changes = (
        log.filter(F.col("ip").isNotNull() & time.isNotNull())
        .select("ip", F.floor(time / seconds).alias("stretch"), F.struct(time.alias("time"), "status", "reason").alias("change"))
        .groupBy("ip", "stretch")
        .agg(F.array_sort(F.collect_list("change")).alias("changes"), F.max("change").alias("last"))
    )
    stretch = F.floor(F.col("timestamp") / seconds)
    asked = alerts.select(F.col("source").alias("ip"), stretch.alias("stretch")).distinct()
    before = Window.partitionBy("ip").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    known = changes.join(asked, ["ip", "stretch"], "full_outer").select(
        F.col("ip").alias("known_ip"),
        F.col("stretch").alias("known_stretch"),
        "changes",
        F.last("last", ignorenulls=True).over(before).alias("begins"),
    )
    joined = alerts.withColumn("stretch", stretch).join(
        known, (F.col("source") == F.col("known_ip")) & (F.col("stretch") == F.col("known_stretch")), "left"
    )
    past = F.filter(F.coalesce("changes", F.array().cast(changes.schema["changes"].dataType)), lambda c: c["time"] <= F.col("timestamp"))
    state = F.coalesce(F.try_element_at(past, F.lit(-1)), F.col("begins"))["status"]
    hit = F.coalesce(state == BLOCKED_STATUS, F.lit(False))
    return joined.select(
        "timestamp",
        "message",
        F.when(hit, MITIGATED_GRADE[0]).otherwise(ACTIVE_GRADE[0]).alias("severity"),
        "source",
        "target",
        F.when(hit, MITIGATED_GRADE[1]).otherwise(ACTIVE_GRADE[1]).alias("status"),
    )


def raise_alerts(packets, allow, deny, blocked, exempt=EXEMPT_SOURCES, strict=False):
    """Graded alerts of a set of packets.

    A deny-listed source is blocked from its first packet on, and the source of
    an alert has sent a packet. So an alert is mitigated exactly if its source
    is on the block list or the deny list: the packets are read once.
    """
    candidates = alert_candidates(packets, exempt, strict)
    held = blocked.select("ip").unionByName(deny.select("ip"))
    return grade_alerts(suppress_allowed(candidates, allow), held)


def latest_packets(packets, n=20, zone="UTC", masked=False, tie_break=()):
    """The newest ``n`` packets as shown on a screen."""
    shown = mask_address if masked else (lambda col: col)
    return (
        packets.orderBy(F.desc("timestamp"), *tie_break)
        .limit(n)
        .select(
            local_text(F.col("timestamp"), zone, DISPLAY_TIME).alias("time"),
            shown(_known("src")).alias("src"),
            shown(_known("dst")).alias("dst"),
            _known("proto").alias("proto"),
            F.substring(
                F.coalesce("summary", F.lit("")), 1, DISPLAY_SUMMARY_CHARS
            ).alias("summary"),
        )
    )
