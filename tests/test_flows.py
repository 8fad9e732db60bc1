import pytest
from pyspark.sql import functions as F

from packetloom.functions.text import human_bytes, mask_address, strip
from packetloom.operators import flows
from packetloom.schemas import FLOWS
from packetloom.sources import files


def flow(**values):
    base = dict(
        ipv4_src_addr="10.0.0.1", ipv4_dst_addr="10.0.0.9", l4_src_port=4000, l4_dst_port=9999,
        protocol=6, in_bytes=10, out_bytes=5, in_pkts=1, out_pkts=1,
        flow_duration_milliseconds=500, flow_start_milliseconds=1718000000000,
        label="DDoS", attack="DDoS",
    )
    return tuple({**base, **values}[name] for name in FLOWS.names)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), FLOWS)


def test_attack_vector_branches_and_limits(spark):
    cases = [
        (dict(l4_dst_port=179), "BGP Hijacking/Exploit"),
        (dict(l4_src_port=179, l4_dst_port=22), "BGP Hijacking/Exploit"),
        (dict(l4_dst_port=22), "SSH Brute Force"),
        (dict(l4_dst_port=53), "DNS Amplification"),
        (dict(l4_dst_port=80), "Web Attack (HTTP/S)"),
        (dict(l4_dst_port=443, in_pkts=9000, in_bytes=900000), "Web Attack (HTTP/S)"),
        (dict(l4_dst_port=21), "FTP File Ingestion Exploit"),
        (dict(flow_duration_milliseconds=99, in_pkts=1001), "L3/L4 Flood (DDoS)"),
        (dict(flow_duration_milliseconds=100, in_pkts=1001), "Altro / Malicious General"),
        (dict(flow_duration_milliseconds=99, in_pkts=1000), "Altro / Malicious General"),
        (dict(in_pkts=5001, in_bytes=100001), "Volumetric DDoS"),
        (dict(in_pkts=5000, in_bytes=100001), "Altro / Malicious General"),
        (dict(in_pkts=5001, in_bytes=100000), "Altro / Malicious General"),
        (dict(l4_dst_port=None, l4_src_port=179), "BGP Hijacking/Exploit"),
        (dict(l4_dst_port=None, l4_src_port=None), "Altro / Malicious General"),
    ]
    rows = flows.with_attack_vector(table(spark, *[flow(**c) for c, _ in cases])).collect()
    assert [r.vettore_attacco for r in rows] == [want for _, want in cases]


def test_malicious_drops_null_class_and_balance_keeps_it(spark):
    df = table(spark, flow(), flow(label=None, attack=None), flow(label="Benign", attack="Benign"))
    assert [r.label for r in flows.malicious(df).collect()] == ["DDoS"]
    assert {r.label: r.percentuale for r in flows.class_balance(df).collect()} == {
        "DDoS": 33.3333, None: 33.3333, "Benign": 33.3333,
    }


def test_numeric_class_column_keeps_every_row_unless_told(spark):
    df = table(spark, flow(label="0"), flow(label="1"))
    assert flows.malicious(df).count() == 2
    assert flows.malicious(df, benign="0").count() == 1
    assert flows.attack_summary(df, class_column="attack").first().occorrenze == 2


def test_human_bytes(spark):
    cases = {
        0: "0B", 1023: "1023B", 1024: "1.00KB", 1300: "1.27KB", 1024**2 - 1: "1024.00KB",
        1024**2: "1.00MB", 1024**3: "1.00GB", 1024**4: "1.00TB", 5 * 1024**5: "5120.00TB",
        1024 + 128: "1.13KB",
    }
    df = spark.createDataFrame([(k,) for k in cases], "b long")
    assert [r[0] for r in df.select(human_bytes(F.col("b"))).collect()] == list(cases.values())


def test_top_attackers_ties_and_null_source(spark):
    df = table(spark, flow(ipv4_src_addr="b"), flow(ipv4_src_addr=None), flow(ipv4_src_addr="a"))
    assert [r.ip_attaccante for r in flows.top_attackers(df, 2).collect()] == [None, "a"]


def test_top_talkers_needs_both_ends(spark):
    df = table(spark, flow(ipv4_src_addr=None), flow(ipv4_dst_addr=None), flow())
    (row,) = flows.top_talkers(df).collect()
    assert (row.total_bytes, row.flow_count) == (15, 1)


def test_kpis_of_no_flows(spark):
    assert tuple(flows.flow_kpis(table(spark)).first()) == (0, 0, 0)


def test_mask_and_strip(spark):
    df = spark.createDataFrame([("192.168.1.7",), ("Layer 2",), ("a.",), (" \x1c x y\xa0\n",)], "a string")
    assert [r[0] for r in df.select(mask_address(F.col("a"))).collect()][:3] == [
        "192.168.1.xxx", "Layer 2", "a.xxx",
    ]
    assert df.select(strip(F.col("a"))).collect()[3][0] == " \x1c x y\xa0\n".strip()


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "flows")
    files.write_flows(table(spark, flow(), flow(label="Benign")), path)
    plan = flows.top_attackers(files.load_flows(spark, path))._jdf.queryExecution().toString()
    assert "Not(EqualTo(label,Benign))" in plan and "TakeOrderedAndProject" in plan
    scan = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "out_pkts" not in scan and "protocol" not in scan


def test_csv_types_follow_the_header_not_the_position(spark, tmp_path):
    path = tmp_path / "flows.csv"
    path.write_text("LABEL,IN_BYTES,EXTRA\n1,7,x\n,8,y\n")
    df = files.read_flows_csv(spark, str(path))
    assert dict(df.dtypes) == {"LABEL": "string", "IN_BYTES": "bigint", "EXTRA": "string"}
    assert [tuple(r) for r in df.collect()] == [("1", 7, "x"), (None, 8, "y")]
    inferred = files.read_flows_csv(spark, str(path), schema=None, class_column="LABEL")
    assert dict(inferred.dtypes)["LABEL"] == "string"


def test_upper_case_parquet_columns_open_in_lower_case(spark, tmp_path):
    path = str(tmp_path / "flows")
    table(spark, flow()).toDF(*[n.upper() for n in FLOWS.names]).write.parquet(path)
    df = files.load_flows(spark, path, view="flows_by_name")
    assert df.columns == FLOWS.names
    assert spark.table("flows_by_name").first().in_bytes == 10


def test_csv_with_swapped_headers_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("L4_SRC_PORT,L4_DST_PORT,label\n1,22,Benign\n")
    (tmp_path / "b.csv").write_text("L4_DST_PORT,L4_SRC_PORT,label\n22,1,Benign\n")
    for schema in (files.FLOWS, None):
        with pytest.raises(Exception, match="(?i)header"):
            files.read_flows_csv(spark, str(tmp_path), schema).collect()


def test_csv_with_a_wrong_value_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("L4_SRC_PORT,label\n1,Benign\nabc,Benign\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_flows_csv(spark, str(tmp_path)).collect()
    kinds = dict(files.read_flows_csv(spark, str(tmp_path), None).dtypes)
    assert kinds["L4_SRC_PORT"] == "string"
