"""Analytics over historical flow records.

All reports are one filter-and-aggregate pass: Spark aggregates before the
shuffle, so a source or port that holds a third of the rows sends one row per
task. Ordered reports with a limit become a distributed top-k, never a full
sort. Every sort is completed with the group keys so that results repeat.
"""

from pyspark.sql import functions as F

from packetloom.functions.text import first_match, human_bytes
from packetloom.functions.vectors import DEFAULT_RULES, attack_vector

# The class of harmless traffic and the protocol names.
BENIGN = "Benign"
PROTOCOL_NAMES = ((6, "TCP"), (17, "UDP"), (1, "ICMP"))
PROTECTED, THREAT = "Protetto", "Minaccia"


def _traffic():
    return F.col("in_bytes") + F.col("out_bytes")


def malicious(flows, class_column="label", benign=BENIGN):
    """Flows of any class but ``benign``. A NULL class is dropped."""
    return flows.filter(F.col(class_column) != benign)


def with_attack_vector(flows, name="vettore_attacco", rules=DEFAULT_RULES):
    return flows.withColumn(name, attack_vector(rules))


def attack_summary(flows, class_column="label", benign=BENIGN, rules=DEFAULT_RULES):
    """Malicious flows by vector and class, largest volume first."""
    return (
        malicious(flows, class_column, benign)
        .groupBy(
            attack_vector(rules).alias("vettore_attacco"),
            F.col(class_column).alias("etichetta_dataset"),
        )
        .agg(
            F.count("*").alias("occorrenze"),
            F.round(F.avg("flow_duration_milliseconds"), 2).alias("durata_media_flusso"),
            F.sum(F.col("in_pkts") + F.col("out_pkts")).alias("pacchetti_totali"),
            F.sum(_traffic()).alias("traffico_b"),
        )
        .withColumn("traffico_h", human_bytes(F.col("traffico_b")))
        .orderBy(
            F.desc_nulls_last("traffico_b"), "vettore_attacco", "etichetta_dataset"
        )
    )


def top_attackers(flows, n=5, class_column="label", benign=BENIGN, rules=DEFAULT_RULES):
    """The ``n`` (source, vector) pairs with most malicious flows.

    A NULL source is a group like any other and comes first among ties.
    """
    return (
        malicious(flows, class_column, benign)
        .groupBy(
            F.col("ipv4_src_addr").alias("ip_attaccante"),
            attack_vector(rules).alias("tipo_attacco"),
        )
        .agg(F.count("*").alias("occorrenze"), F.sum(_traffic()).alias("traffico_b"))
        .orderBy(F.desc("occorrenze"), F.asc_nulls_first("ip_attaccante"), "tipo_attacco")
        .limit(n)
        .select(
            "ip_attaccante",
            "occorrenze",
            "tipo_attacco",
            human_bytes(F.col("traffico_b")).alias("traffico_h"),
        )
    )


def class_balance(flows, class_column="attack"):
    """Flows per class, NULL kept, with the share of all flows in percent.

    The total is a scalar subquery, not a join: Parquet answers it from the
    row counts in the file footers.
    """
    total = flows.agg(F.count("*").alias("n")).scalar()
    return (
        flows.groupBy(F.col(class_column).alias("label"))
        .agg(F.count("*").alias("occorrenze"))
        .withColumn(
            "percentuale",
            F.round(F.col("occorrenze").cast("double") / total * 100, 4),
        )
    )


def protocol_ports(flows, n=50, class_column="label"):
    """The ``n`` most frequent (port, protocol, class) with mean flow bytes."""
    protocol = F.col("protocol")
    name = first_match(
        [(protocol == number, F.lit(text)) for number, text in PROTOCOL_NAMES],
        protocol.cast("string"),
    )
    return (
        flows.groupBy(
            F.col("l4_dst_port").alias("port"),
            name.alias("protocol_name"),
            F.col(class_column).alias("label"),
        )
        .agg(F.count("*").alias("flow_count"), F.avg(_traffic()).alias("avg_bytes"))
        .orderBy(
            F.desc("flow_count"),
            F.asc_nulls_first("port"),
            F.asc_nulls_first("protocol_name"),
            F.asc_nulls_first("label"),
        )
        .limit(n)
    )


def traffic_by_minute(flows, class_column="label"):
    """Bytes and flows per minute and class, in time order."""
    minute = F.date_trunc("minute", F.timestamp_millis("flow_start_milliseconds"))
    return (
        flows.groupBy(minute.alias("time_window"), F.col(class_column).alias("label"))
        .agg(F.sum(_traffic()).alias("total_bytes"), F.count("*").alias("flow_count"))
        .orderBy("time_window", F.asc_nulls_first("label"))
    )


def top_talkers(flows, n=100, class_column="label"):
    """The ``n`` (source, destination, class) with most bytes; both ends known."""
    return (
        flows.filter(
            F.col("ipv4_src_addr").isNotNull() & F.col("ipv4_dst_addr").isNotNull()
        )
        .groupBy(
            F.col("ipv4_src_addr").alias("source_ip"),
            F.col("ipv4_dst_addr").alias("destination_ip"),
            F.col(class_column).alias("label"),
        )
        .agg(F.sum(_traffic()).alias("total_bytes"), F.count("*").alias("flow_count"))
        .orderBy(
            F.desc_nulls_last("total_bytes"),
            "source_ip",
            "destination_ip",
            F.asc_nulls_first("label"),
        )
        .limit(n)
    )


def flow_kpis(flows, class_column="label", benign=BENIGN, rules=DEFAULT_RULES):
    """Flows analysed, malicious flows and anomaly groups, in one pass.

    The first aggregate leaves a row per (vector, class); only those few rows
    reach the final one-row aggregate.
    """
    groups = flows.groupBy(
        attack_vector(rules).alias("vector"), F.col(class_column).alias("class")
    ).agg(F.count("*").alias("n"))
    bad = F.col("class") != benign
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("flows_analysed"),
        F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("malicious_flows"),
        F.count_if(bad).alias("anomaly_groups"),
    )


def attacker_status(top, blocked):
    """Top attackers with ``is_blocked`` and the status text shown for it."""
    listed = blocked.select("ip").distinct().withColumn("is_blocked", F.lit(True))
    flagged = top.join(listed, top["ip_attaccante"] == listed["ip"], "left").drop("ip")
    return flagged.withColumn(
        "is_blocked", F.coalesce("is_blocked", F.lit(False))
    ).withColumn("status", F.when(F.col("is_blocked"), PROTECTED).otherwise(THREAT))
