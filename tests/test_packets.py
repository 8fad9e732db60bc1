import random

from packetloom.operators import lists, packets
from packetloom.schemas import PACKETS

PORTS = [":bgp", ":179", ":ftp", ":21", ":2100", ":ssh", ":22", ":http", ":https", ":8080", ":27017", ":5353"]


def sample(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        src = rng.choice([None, "10.0.0.2", "192.168.1.5", "192.168.3.7", "192.168.2.14", "172.16.0.1"])
        summary = rng.choice([None, "Ether / IP", f"IP / TCP {src}:1 > D{rng.choice(PORTS)} S", f"a > b{rng.choice(PORTS)} > c:22"])
        rows.append((float(i), summary, 60, src, rng.choice([None, "10.0.0.1"]), rng.choice(["TCP", "TCP", "UDP", None])))
    return rows


def by_loop(rows, allow, deny, blocked):
    """Row-by-row account of the rules, kept apart from the library."""
    names = {"bgp": "179", "ftp": "21", "ssh": "22", "http": "80", "27017": "27017"}
    blocked, new, out = set(blocked), [], []
    for time, summary, _, src, dst, proto in rows:
        src, dst = src or "???", dst or "???"
        if src in deny and src not in blocked:
            blocked.add(src)
            new.append(src)
        pieces = (summary or "").lower().split(" > ")
        if proto != "TCP" or len(pieces) < 2 or src in allow:
            continue
        for name, number in names.items():
            spared = name in ("http", "27017") and src == "10.0.0.2"
            if not spared and (f":{name}" in pieces[1] or f":{number}" in pieces[1]):
                text = next(r[2] for r in packets.ALERT_RULES if r[0] == name)
                grade = packets.MITIGATED_GRADE if src in blocked else packets.ACTIVE_GRADE
                out.append((time, text + dst, grade[0], src, dst, grade[1]))
                break
    return out, new


def ips(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "ip string")


def test_set_form_equals_the_loop(spark):
    rows = sample(3000, 1)
    allow, deny, blocked = ["192.168.1.5"], ["192.168.3.7", "192.168.1.5", "203.0.113.9"], ["192.168.2.14"]
    want, new = by_loop(rows, allow, deny, blocked)
    df = spark.createDataFrame(rows, PACKETS)
    args = (ips(spark, *allow), ips(spark, *deny), ips(spark, *blocked))
    got = packets.raise_alerts(df, *args).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    blocks = packets.auto_block(df, args[1], args[2], "2024-01-01").collect()
    assert sorted(r.ip for r in blocks) == sorted(new)
    assert {r.reason for r in blocks} == {packets.AUTO_BLOCK_REASON}


def test_substring_traps_and_strict(spark):
    rows = [(0.0, f"TCP a:1 > b{p} S", 60, "s", "b", "TCP") for p in (":https", ":8080", ":2200", ":2100", ":80", ":ssh")]
    df = spark.createDataFrame(rows, PACKETS)
    assert packets.alert_candidates(df).count() == 6
    assert packets.alert_candidates(df, strict=True).count() == 2


def test_no_exempt_sources(spark):
    df = spark.createDataFrame([(0.0, "a > b:80 S", 1, "10.0.0.2", "b", "TCP")], PACKETS)
    assert packets.alert_candidates(df).count() == 0
    assert packets.alert_candidates(df, exempt=()).count() == 1


def test_block_list_with_repeats_does_not_multiply_alerts(spark):
    df = spark.createDataFrame([(0.0, "a > b:22 S", 1, "s", "b", "TCP")], PACKETS)
    none = ips(spark).limit(0)
    alerts = packets.raise_alerts(df, none, ips(spark, "s", "s"), ips(spark, "s", "s"))
    assert [r.status for r in alerts.collect()] == ["MITIGATED"]


def test_latest_packets_fills_and_cuts(spark):
    rows = [(1.5, "x" * 100, 1, None, "1.2.3.4", None), (0.0, None, 1, "a.b", None, "TCP")]
    first, second = packets.latest_packets(spark.createDataFrame(rows, PACKETS), zone="Europe/Rome", masked=True).collect()
    assert tuple(first) == ("01-01-1970 01:00:01", "???", "1.2.3.xxx", "???", "x" * 80)
    assert tuple(second) == ("01-01-1970 01:00:00", "a.xxx", "???", "TCP", "")


def test_quiet_and_banner(spark):
    alerts = spark.createDataFrame(
        [(100.0, "m1", "CRITICAL", "a", "t", "ACTIVE"), (400.0, "m2", "INFO", "b", "t", "MITIGATED")],
        "timestamp double, message string, severity string, source string, target string, status string",
    )
    assert lists.attack_banner(alerts, ips(spark, "b"), 700.0).collect() == []
    assert lists.attack_banner(alerts, ips(spark, "b"), 699.0).first().banner == lists.BANNER_MITIGATED
    assert lists.attack_banner(alerts, ips(spark, "a"), 699.0).first().banner == lists.BANNER_ONGOING
    recent = lists.recent_alerts(alerts, 399.0, n=1).collect()
    assert [(r.message, r.recent_count) for r in recent] == [("m2", 2)]


def test_upsert_keeps_the_latest_change(spark):
    schema = "ip string, blocked_at timestamp, reason string, status string"
    table = spark.sql("select 'a' ip, timestamp'2024-01-01' blocked_at, 'r' reason, 'BLOCKED' status")
    changes = spark.sql(
        "select 'a' ip, timestamp'2024-01-02' blocked_at, 's' reason, 'REMOVED' status union all "
        "select 'b', timestamp'2024-01-01', 's', 'BLOCKED'"
    )
    after = lists.upsert_blocked(table, changes)
    assert {r.ip: r.status for r in after.collect()} == {"a": "REMOVED", "b": "BLOCKED"}
    assert [r.ip for r in lists.active_blocks(after).collect()] == ["b"]
    assert len(schema.split(",")) == len(after.columns)
