"""Attack vector of a flow."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from packetloom.functions.text import first_match


@dataclass(frozen=True)
class VectorRules:
    """Vector names, ports and limits, in order of precedence."""

    routing_name: str = "BGP Hijacking/Exploit"
    routing_port: int = 179
    service_ports: tuple = (
        ("SSH Brute Force", (22,)),
        ("DNS Amplification", (53,)),
        ("Web Attack (HTTP/S)", (80, 443)),
        ("FTP File Ingestion Exploit", (21,)),
    )
    flood_name: str = "L3/L4 Flood (DDoS)"
    flood_max_ms: int = 100
    flood_min_packets: int = 1000
    volumetric_name: str = "Volumetric DDoS"
    volumetric_min_packets: int = 5000
    volumetric_min_bytes: int = 100000
    other_name: str = "Altro / Malicious General"


DEFAULT_RULES = VectorRules()


def attack_vector(rules=DEFAULT_RULES):
    """First matching rule; port rules win over volume rules."""
    src, dst = F.col("l4_src_port"), F.col("l4_dst_port")
    packets = F.col("in_pkts")
    chain = [((dst == rules.routing_port) | (src == rules.routing_port), rules.routing_name)]
    chain += [(dst.isin(*ports), name) for name, ports in rules.service_ports]
    chain.append(
        (
            (F.col("flow_duration_milliseconds") < rules.flood_max_ms)
            & (packets > rules.flood_min_packets),
            rules.flood_name,
        )
    )
    chain.append(
        (
            (packets > rules.volumetric_min_packets)
            & (F.col("in_bytes") > rules.volumetric_min_bytes),
            rules.volumetric_name,
        )
    )
    return first_match([(p, F.lit(n)) for p, n in chain], F.lit(rules.other_name))
