"""Projections that give the given tables the shapes the operators expect.

Each text is valid in Spark SQL and, once its ``{...}`` places are filled, in
DuckDB, so a query and its counterpart start from the same rows. A place named
after a table or another adapter is a relation; the rest are dialect forms.
"""

from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

SPARK_FORMS = {
    "epoch": "unix_micros(cast(ts as timestamp))/1000000D",
    "instant": "cast(ts as timestamp)",
    "sec_open": "timestamp_seconds(",
    "sec_close": ")",
    "byte_length": "octet_length",
}
DUCKDB_FORMS = {
    "epoch": "epoch_us(ts)/1000000.0::double",
    "instant": "ts",
    "sec_open": "make_timestamp(1000000 * (",
    "sec_close": "))",
    "byte_length": "strlen",
}

FLOWS = """
select
 case when l_partkey % 50 = 0 then null else concat('10.0.', l_suppkey % 4, '.', l_suppkey) end as ipv4_src_addr,
 concat('2.0.0.', l_partkey % 16) as ipv4_dst_addr,
 cast(case when l_orderkey % 97 = 0 then 179 else 1024 + l_orderkey % 40000 end as int) as l4_src_port,
 cast(case l_partkey % 10 when 0 then 22 when 1 then 53 when 2 then 80 when 3 then 443 when 4 then 21
      when 5 then 179 when 6 then 3306 when 7 then 8080 when 8 then 123 else 5060 end as int) as l4_dst_port,
 cast(case l_linenumber when 1 then 1 when 2 then 17 when 3 then 17 when 7 then 47 else 6 end as int) as protocol,
 cast(floor(l_extendedprice) as bigint) as in_bytes,
 cast((l_orderkey % 1500) * 10 as bigint) as out_bytes,
 cast(l_quantity as bigint) * (case when l_orderkey % 11 = 0 then 400 else 1 end) as in_pkts,
 cast(l_quantity as bigint) as out_pkts,
 cast((l_orderkey * 7 + l_linenumber * 13) % 400 as bigint) as flow_duration_milliseconds,
 cast(1718000000000 as bigint) + (l_orderkey * 37 + l_linenumber * 100900) % 7200000 as flow_start_milliseconds,
 case when l_returnflag = 'N' then 'Benign' when l_returnflag = 'A' and l_linestatus = 'F' then 'DDoS'
      when l_returnflag = 'A' then 'Brute Force' when l_linestatus = 'F' then 'Bot' else 'Exploits' end as label,
 case when l_returnflag = 'N' then 'Benign' when l_returnflag = 'A' and l_linestatus = 'F' then 'DDoS'
      when l_returnflag = 'A' then 'Brute Force' when l_linestatus = 'F' then 'Bot' else 'Exploits' end as attack
from {lineitem}
"""

PACKETS = """
select event_id, {epoch} as timestamp,
 case when user_id % 11 = 0 then 'Layer 2' when user_id % 13 = 0 then '10.0.0.2'
      else concat('192.168.', user_id % 4, '.', user_id) end as src,
 case when user_id % 11 = 0 then 'Broadcast' else concat('10.0.0.', event_id % 9) end as dst,
 case when user_id % 11 = 0 then 'Ether' when event_type = 'signup' then 'ARP'
      when event_type = 'view' then 'UDP' else 'TCP' end as proto,
 case when user_id % 11 = 0 then 'Ether / 802.3'
      when event_type = 'signup' then concat('Ether / ARP who has 10.0.0.', event_id % 9)
      else concat('Ether / IP / TCP 192.168.', user_id % 4, '.', user_id, ':', 40000 + event_id % 9000,
                  ' > 10.0.0.', event_id % 9,
                  case event_id % 8 when 0 then ':bgp' when 1 then ':ftp' when 2 then ':ssh' when 3 then ':http'
                       when 4 then ':27017' when 5 then ':https' when 6 then ':8080' else ':5353' end, ' S') end as summary,
 cast(60 + event_id % 1400 as bigint) as length
from {events}
"""

# The packet side with the address range of the flow side.
SHARED_PACKETS = """
select event_id, timestamp, replace(src, '192.168.', '10.0.') as src, dst, proto, summary, length
from {packets}
"""

HEADERS = """
select event_id, timestamp, summary, length,
 case when proto in ('TCP', 'UDP') then src end as ip_src,
 case when proto in ('TCP', 'UDP') then dst end as ip_dst,
 case when proto = 'ARP' then src end as arp_src,
 case when proto = 'ARP' then dst end as arp_dst,
 proto = 'TCP' as has_tcp, proto = 'UDP' and event_id % 5 <> 0 as has_udp
from {packets}
"""

ALLOW = "select '192.168.1.5' as ip union all select '192.168.2.10' as ip"
DENY = (
    "select '192.168.3.7' as ip union all select '192.168.1.5' as ip "
    "union all select '203.0.113.9' as ip"
)
HELD = "select '192.168.2.14' as ip"
HELD_SOURCES = "select '10.0.1.5' as ip union all select '10.0.2.14' as ip"

BLOCK_LOG = """
select concat('192.168.', user_id % 4, '.', user_id) as ip, {instant} as blocked_at,
 concat('Evento ', event_type) as reason,
 case when event_id % 5 = 0 then 'REMOVED' else 'BLOCKED' end as status
from {events}
"""

ACTIONS = """
select {instant} as timestamp, concat('user', user_id) as user, event_type as action, props as details
from {events}
"""

QUERY_LOG = """
select event_id, case event_id % 9
  when 0 then concat(' ', chr(10), 'SELECT src FROM live WHERE length > ', event_id)
  when 1 then concat('with t as (select ', user_id, ' as u) select * from t')
  when 2 then concat('drop table t', user_id)
  when 3 then concat('select 1; DELETE from t where id = ', event_id)
  when 4 then concat('select updated_at from t', user_id)
  when 5 then concat('explain select ', event_id)
  when 6 then concat('Select ''grant all'' from t', user_id)
  when 7 then concat('withdraw ', event_type)
  else concat('select created, dropped', chr(9), 'from t', user_id) end as query
from {events}
"""

CATALOG = """
select case doc_id when 0 then 'ds_historical_nids' when 1 then 'ds_live_sniffer'
       when 2 then 'ds_llm_models' else concat('ds_', doc_id) end as id,
 concat(source, ' ', lang) as name, text as description, source,
 case doc_id % 3 when 0 then 'CSV' when 1 then 'Parquet' else 'PCAP' end as format,
 concat('/data/', source, '/', doc_id) as location,
 concat('Lingua ', lang) as category,
 {sec_open}1704067200 + doc_id * 60{sec_close} as created_at
from {documents}
"""

# One small CSV file per order: four delimiters, quoted fields, formulas,
# ragged and empty files, script markers, binary signatures.
UPLOADS = """
select concat('/uploads/', o_orderkey, '/', file) as path, file, dataset, description, category,
 cast({byte_length}(text) as bigint) as length, text
from (
 select o_orderkey,
  concat('Order ', o_orderkey, case when o_orderkey % 17 = 0 then '.txt' when o_orderkey % 19 = 0 then '.CSV' else '.csv' end) as file,
  case when o_orderkey % 23 = 0 then '  ' else concat('Ordini Cliente ', o_custkey) end as dataset,
  concat('Ordini ', o_orderpriority) as description,
  case when o_orderkey % 2 = 0 then 'Anagrafiche' else 'Altro' end as category,
  case o_orderkey % 37 when 0 then '' when 1 then chr(10) when 2 then concat('a,b', chr(13), 'c,d') else concat(
   case o_orderkey % 31 when 0 then 'MZ' when 1 then '%PDF-1.7' when 2 then 'GIF89a' when 3 then concat(chr(127), 'ELF')
        when 4 then concat('PK', chr(3), chr(4)) else '' end,
   'order', d, 'state', d, 'note', chr(10),
   o_orderkey, d, o_orderstatus, d, note, chr(10),
   o_custkey, d, o_orderpriority, tail, chr(10)) end as text
 from (
  select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, d,
   case o_orderkey % 9 when 0 then '=SUM(A1:A9)' when 1 then '-12.5' when 2 then '@cmd' when 3 then ' +1 '
        when 4 then '"all, of; these | here"' when 5 then 'plain' when 6 then concat('"two', chr(10), 'lines"')
        when 7 then 'say "hi" there' else concat('"=1+""2""', '"') end as note,
   case o_orderkey % 13 when 0 then '' when 1 then concat(d, '<script>x</script>') when 2 then concat(d, 'eval(x)')
        when 3 then concat(d, 'os.system(x)') else concat(d, 'x') end as tail
  from (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         case o_orderkey % 4 when 0 then ',' when 1 then ';' when 2 then chr(9) else '|' end as d from {orders}) o
 ) p
) q
"""

# Whole pages and documents as uploaded contents.
TEXT_FILES = """
select concat('/pages/', page_id, '.csv') as path, concat(page_id, '.csv') as file, html as text,
 cast({byte_length}(html) as bigint) as length from {pages}
union all
select concat('/documents/', doc_id, '.csv') as path, concat(doc_id, '.csv') as file, text,
 cast({byte_length}(text) as bigint) as length from {documents}
"""

CELLS = """
select o_orderkey, case o_orderkey % 6 when 0 then concat('=', o_orderstatus) when 1 then concat(' -', o_custkey)
   when 2 then concat(chr(160), '@', o_orderstatus, chr(28)) when 3 then concat(chr(9), 'a b', chr(10))
   when 4 then '+' else o_orderpriority end as cell_a, o_orderpriority as cell_b
from {orders}
"""

QUESTIONS = "select conv_id, turn, text from {conversations} where role = 'user'"

REPLIES = """
select conv_id, turn, case conv_id % 3
  when 0 then concat('<think>', text, '</think>', chr(10), text, '<think>b</think>')
  when 1 then concat(text, '<think>', text) else text end as reply
from {conversations} where role = 'assistant'
"""

CHUNKS = """
select conv_id, turn,
 case (conv_id * 3 + turn) % 4 when 0 then concat('<think>', text) when 1 then concat('</think>', text) else text end as response,
 case when (conv_id + turn) % 3 = 0 then concat('hm ', text) end as thinking
from {conversations}
"""

_TEXTS = {
    "flows": FLOWS,
    "packets": PACKETS,
    "shared_packets": SHARED_PACKETS,
    "headers": HEADERS,
    "allow": ALLOW,
    "deny": DENY,
    "held": HELD,
    "held_sources": HELD_SOURCES,
    "block_log": BLOCK_LOG,
    "actions": ACTIONS,
    "query_log": QUERY_LOG,
    "catalog": CATALOG,
    "uploads": UPLOADS,
    "text_files": TEXT_FILES,
    "cells": CELLS,
    "questions": QUESTIONS,
    "replies": REPLIES,
    "chunks": CHUNKS,
}


def _relations(text):
    return [n for n in (*TABLES, *_TEXTS) if "{" + n + "}" in text]


def _fill(text, forms):
    for name, form in forms.items():
        text = text.replace("{" + name + "}", form)
    return text


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def frame(spark, folder, name):
    """Adapter or given table ``name`` as a DataFrame."""
    if name in TABLES:
        return table(spark, folder, name)
    text = _TEXTS[name]
    sources = {n: frame(spark, folder, n) for n in _relations(text)}
    return spark.sql(_fill(text, SPARK_FORMS), **sources)


def with_frames(*names):
    """``with ...`` clause defining adapters and what they build on, in order."""
    ordered = []

    def add(name):
        if name in TABLES or name in ordered:
            return
        for inner in _relations(_TEXTS[name]):
            add(inner)
        ordered.append(name)

    for name in names:
        add(name)
    parts = []
    for name in ordered:
        forms = {n: n for n in _relations(_TEXTS[name])}
        parts.append(f"{name} as ({_fill(_TEXTS[name], {**DUCKDB_FORMS, **forms})})")
    return "with " + ", ".join(parts)


def upload_files(spark, folder, name="uploads"):
    """An upload adapter as ``binaryFile`` rows, with the form's columns."""
    return (
        frame(spark, folder, name)
        .withColumn("content", F.encode("text", "UTF-8"))
        .drop("text")
    )


def catalog_table(spark, folder):
    """Catalog adapter with a nested field list."""

    def field(name, kind, text):
        return F.struct(
            F.lit(name).alias("name"), F.lit(kind).alias("type"), text.alias("description")
        )

    fields = F.array(
        field("id", "Long", F.col("location")), field("text", "String", F.col("name"))
    )
    return frame(spark, folder, "catalog").withColumn("schema", fields)


def capture_files(spark, folder, per_file=1000):
    """Capture files built from the events, ``per_file`` packets in each.

    Frames are Ethernet with ARP, TCP, UDP, another IP protocol or none; every
    second file is pcapng.
    """
    events = table(spark, folder, "events")

    def byte(col):
        return F.lpad(F.hex(col.cast("long")), 2, "0")

    def word(col, digits):
        return F.lpad(F.hex(col.cast("long")), digits, "0")

    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    user, event = F.col("user_id"), F.col("event_id")
    src = F.concat(F.lit("C0A8"), byte(user % 4), byte(user % 250))
    dst = F.concat(F.lit("0A0000"), byte(event % 9))
    port = F.element_at(
        F.array(*[F.lit(p) for p in (179, 21, 22, 80, 27017, 443, 8080, 5353)]),
        (event % 8 + 1).cast("int"),
    )
    proto = F.when(event % 7 == 0, 1).when(F.col("event_type") == "view", 17).otherwise(6)
    ip = F.concat(
        F.lit("0800450000280000000040"), byte(proto), F.lit("0000"), src, dst,
        word(40000 + event % 9000, 4), word(port, 4), F.lit("0000000000000000500220000000"), F.lit("0000"),
    )
    arp = F.concat(
        F.lit("080600010800060400010000000000AA"), src, F.lit("000000000000"), dst
    )
    frame_hex = F.concat(
        F.lit("0" * 24),
        F.when(user % 11 == 0, F.lit("88CC00000000"))
        .when(F.col("event_type") == "signup", arp)
        .otherwise(ip),
    )
    size = word(F.length(frame_hex) / 2, 8)
    record = F.concat(
        word(F.floor(micros / 1000000), 8), word(F.pmod(micros, F.lit(1000000)), 8), size, size, frame_hex
    )
    padded = F.rpad(frame_hex, F.ceil(F.length(frame_hex) / 8).cast("int") * 8, F.lit("0"))
    whole = word(F.length(padded) / 2 + 32, 8)
    block = F.concat(
        F.lit("00000006"), whole, F.lit("00000000"), word(F.shiftright(micros, 32), 8),
        word(micros.bitwiseAND(0xFFFFFFFF), 8), size, size, padded, whole,
    )
    header = "A1B2C3D4" + "00020004" + "0" * 16 + "0000FFFF" + "00000001"
    section = "0A0D0D0A" + "0000001C" + "1A2B3C4D" + "00010000" + "F" * 16 + "0000001C"
    interface = "00000001" + "00000014" + "00010000" + "0000FFFF" + "00000014"
    file_no = F.floor(event / per_file)
    return (
        events.select(
            file_no.alias("file_no"),
            F.struct("event_id", F.when(file_no % 2 == 0, record).otherwise(block).alias("record")).alias("item"),
        )
        .groupBy("file_no")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .withColumn("head", F.when(F.col("file_no") % 2 == 0, header).otherwise(section + interface))
        .select(
            F.concat(F.lit("capture-"), "file_no", F.lit(".cap")).alias("name"),
            F.unhex(F.concat("head", F.array_join(F.col("items.record"), ""))).alias("content"),
        )
    )
