"""Queries across flow records and live packets, and the query-text check."""

from pyspark.sql import functions as F

from packetloom.functions.text import contains_any, first_match, strip

# Allowed first words, forbidden words (each with its space) and
# the verdict reasons.
ALLOWED_STARTS = ("select", "with")
FORBIDDEN_WORDS = (
    "insert ",
    "update ",
    "delete ",
    "drop ",
    "truncate ",
    "alter ",
    "create ",
    "replace ",
    "grant ",
    "revoke ",
)
NOT_A_READ = (
    "Operazione Negata: Per motivi di sicurezza è consentita SOLO "
    "l'istruzione SELECT o WITH in questa console."
)
FORBIDDEN_FOUND = (
    "Operazione Negata: Rilevata istruzione di manipolazione dati (DML/DDL). "
    "Puoi usare solo query di lettura (SELECT)."
)


def flow_packet_matches(flows, packets, class_column="label"):
    """Flow and packet counts of the sources seen on both sides.

    ``pairs`` is the row count the plain join would have. Both sides are
    aggregated before they meet, so no source multiplies its rows.
    """
    left = flows.groupBy(
        F.col("ipv4_src_addr").alias("ip"), F.col(class_column).alias("label")
    ).agg(F.count("*").alias("flow_count"))
    right = packets.groupBy(F.col("src").alias("ip")).agg(
        F.count("*").alias("packet_count")
    )
    return left.join(right, "ip").select(
        "ip",
        "label",
        "flow_count",
        "packet_count",
        (F.col("flow_count") * F.col("packet_count")).alias("pairs"),
    )


def flows_with_packets(flows, packets, n=10):
    """First ``n`` rows of the join on source address, by address and summary.

    The join runs on counts. A row is repeated only after the ``n`` smallest
    distinct rows are known, and never more than ``n`` times.
    """
    left = flows.groupBy(F.col("ipv4_src_addr").alias("src")).agg(
        F.count("*").alias("flow_count")
    )
    right = packets.groupBy("src", "summary").agg(F.count("*").alias("packet_count"))
    pairs = F.col("flow_count") * F.col("packet_count")
    order = ("ipv4_src_addr", F.asc_nulls_first("summary"))
    return (
        right.join(left, "src")
        .select(F.col("src").alias("ipv4_src_addr"), "summary", pairs.alias("pairs"))
        .orderBy(*order)
        .limit(n)
        .select(
            "ipv4_src_addr",
            "summary",
            F.explode(F.sequence(F.lit(1), F.least("pairs", F.lit(n)).cast("int"))),
        )
        .select("ipv4_src_addr", "summary")
        .orderBy(*order)
        .limit(n)
    )


def addresses_by_source(flows, packets):
    """Every address seen as a source, per data source, with its row count."""

    def seen(df, column, origin):
        return (
            df.filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("ip"))
            .agg(F.count("*").alias("rows"))
            .withColumn("origin", F.lit(origin))
        )

    return seen(flows, "ipv4_src_addr", "storico").unionByName(
        seen(packets, "src", "live")
    )


def volume_both(flows, packets):
    """Historical and live volume of the addresses present in both sources."""
    old = flows.groupBy(F.col("ipv4_src_addr").alias("ip")).agg(
        F.sum(F.col("in_bytes") + F.col("out_bytes")).alias("flow_bytes")
    )
    new = packets.groupBy(F.col("src").alias("ip")).agg(
        F.sum("length").alias("packet_bytes")
    )
    return old.join(new, "ip")


def sql_verdict(df, col):
    """Verdict and reason for each query text in ``col``."""
    text = F.lower(strip(F.col(col)))
    starts = F.lit(False)
    for word in ALLOWED_STARTS:
        starts = starts | F.startswith(text, F.lit(word))
    reason = first_match(
        [
            (~starts, F.lit(NOT_A_READ)),
            (contains_any(text, FORBIDDEN_WORDS), F.lit(FORBIDDEN_FOUND)),
        ]
    )
    return df.withColumn("reason", reason).withColumn(
        "allowed", F.col("reason").isNull() & F.col(col).isNotNull()
    )
