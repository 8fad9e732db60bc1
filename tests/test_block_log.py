"""Alerts graded by a changing block list against a row-by-row replay."""

import datetime
import random

from packetloom.operators.packets import grade_alerts_at

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def test_replay(spark):
    rng = random.Random(2)
    ips = ["hot"] * 6 + ["a", "b", "never", None]
    log = [(rng.choice(ips[:8]), rng.choice([None, *range(40)]), rng.choice(["BLOCKED", "REMOVED"]), rng.choice(["x", "y"])) for _ in range(80)]
    alerts = [(rng.choice([None, *range(45)]), "m", rng.choice(ips), "t") for _ in range(400)]
    base = START.timestamp()

    def status(at, ip):
        past = [(t, s, r) for i, t, s, r in log if i == ip and None not in (i, t, at) and t <= at]
        return "MITIGATED" if past and max(past)[1] == "BLOCKED" else "ACTIVE"

    changes = spark.createDataFrame(
        [(i, None if t is None else START + datetime.timedelta(seconds=t), s, r) for i, t, s, r in log],
        "ip string, blocked_at timestamp, status string, reason string")
    rows = spark.createDataFrame([(None if t is None else base + t, m, i, x) for t, m, i, x in alerts], "timestamp double, message string, source string, target string")
    want = sorted(map(repr, [(None if t is None else base + t, i, status(t, i)) for t, _, i, _ in alerts]))
    for seconds in (3600, 7, 1):
        got = grade_alerts_at(rows, changes, seconds)
        assert sorted(repr((r.timestamp, r.source, r.status)) for r in got.collect()) == want
    assert grade_alerts_at(rows.limit(0), changes).count() == 0
    assert {r.status for r in grade_alerts_at(rows, changes.limit(0)).collect()} == {"ACTIVE"}
