"""The registered queries in SQL, stated on their own terms.

They read the same adapters and use relational forms (rule tables, set
membership, list functions) rather than the expressions of the operators.
"""

from packetloom.plans.adapters import with_frames

ORACLES = {}


def _add(name, frames, body, extra=""):
    head = with_frames(*frames) if frames else ""
    if extra:
        head = f"{head}, {extra}" if head else f"with {extra}"
    ORACLES[name] = f"{head} {body}".strip()


# Shared pieces

_VECTORS = """
port_vectors(port, vector) as (values (22, 'SSH Brute Force'), (53, 'DNS Amplification'),
  (80, 'Web Attack (HTTP/S)'), (443, 'Web Attack (HTTP/S)'), (21, 'FTP File Ingestion Exploit')),
vectors as (
  select f.*, coalesce(
    if(179 in (l4_src_port, l4_dst_port), 'BGP Hijacking/Exploit', null), v.vector,
    if(in_pkts > 1000 and flow_duration_milliseconds < 100, 'L3/L4 Flood (DDoS)', null),
    if(in_bytes > 100000 and in_pkts > 5000, 'Volumetric DDoS', null),
    'Altro / Malicious General') as vector
  from flows f left join port_vectors v on v.port = f.l4_dst_port)
"""


def _human(b):
    steps = " + ".join(f"({b} >= {1024**p})::int" for p in range(1, 5))
    unit = f"['B', 'KB', 'MB', 'GB', 'TB'][1 + {steps}]"
    number = f"cast(round({b} / pow(1024, {steps}), 2) as decimal(18, 2))"
    return f"concat(if({b} < 1024, cast({b} as varchar), cast({number} as varchar)), {unit})"


_SUMMARY = f"""
select vector as vettore_attacco, label as etichetta_dataset, occorrenze, durata_media_flusso,
  pacchetti_totali, traffico_b, {_human('traffico_b')} as traffico_h
from (select vector, label, count(*) as occorrenze,
        round(avg(flow_duration_milliseconds), 2) as durata_media_flusso,
        cast(sum(in_pkts + out_pkts) as bigint) as pacchetti_totali,
        cast(sum(in_bytes + out_bytes) as bigint) as traffico_b
      from vectors where label <> 'Benign' group by all) s
order by traffico_b desc, vettore_attacco, etichetta_dataset
"""


def _top(n):
    return f"""
    select ip_attaccante, occorrenze, tipo_attacco, {_human('b')} as traffico_h
    from (select ipv4_src_addr as ip_attaccante, vector as tipo_attacco, count(*) as occorrenze,
            cast(sum(in_bytes + out_bytes) as bigint) as b
          from vectors where label <> 'Benign' group by all
          order by occorrenze desc, ip_attaccante nulls first, tipo_attacco limit {n}) t
    """


_MINUTES = """
select date_trunc('minute', make_timestamp(flow_start_milliseconds * 1000)) as time_window, label,
  cast(sum(in_bytes + out_bytes) as bigint) as total_bytes, count(*) as flow_count
from flows group by all
"""

_BALANCE = """
select attack as label, count(*) as occorrenze,
  round(count(*)::double / (select count(*) from flows) * 100, 4) as percentuale
from flows group by attack
"""


def _rules(test):
    return f"""
    rules(nr, name, num, msg, spared) as (values
      (1, 'bgp', '179', 'POSSIBILE BGP HIJACKING: Tentativo di connessione alla porta 179 del nodo ', false),
      (2, 'ftp', '21', 'TENTATIVO FILE INJECTION: Tentativo FTP verso ', false),
      (3, 'ssh', '22', 'TENTATIVO BRUTE FORCE SSH: Tentativo SSH verso ', false),
      (4, 'http', '80', 'POSSIBILE DOS/SYN FLOOD: Traffico HTTP anomalo verso ', true),
      (5, '27017', '27017', 'ACCESSO DATABASE NON AUTORIZZATO: Tentativo verso MongoDB su ', true)),
    hits as (
      select event_id, timestamp, src as source, dst as target, nr, concat(msg, dst) as message
      from (select *, string_split(lower(summary), ' > ')[2] as part from packets where proto = 'TCP') p
      join rules r on ({test}) and not (spared and src = '10.0.0.2')),
    candidates as (
      select timestamp, arg_min(message, nr) as message, source, target
      from hits group by event_id, timestamp, source, target)
    """


_CANDIDATES = _rules("contains(part, ':' || name) or contains(part, ':' || num)")
_STRICT = _rules(
    "list_contains([name, num], regexp_extract(part, ':([^ :]+)( |$)', 1))"
)
_ALERTS = (
    _CANDIDATES
    + """,
    blocks as (
      select ip from held union
      select src from packets where src in (select ip from deny)),
    alerts as (
      select timestamp, message, if(source in (select ip from blocks), 'INFO', 'CRITICAL') as severity,
        source, target, if(source in (select ip from blocks), 'MITIGATED', 'ACTIVE') as status
      from candidates where source not in (select ip from allow))
    """
)
_ALERT_FRAMES = ("packets", "allow", "deny", "held")
_LATEST_BLOCKS = """
latest as (
  select ip, s.blocked_at as blocked_at, s.reason as reason, s.status as status from (
    select ip, max({'blocked_at': blocked_at, 'status': status, 'reason': reason}) as s
    from block_log group by ip))
"""
_NOW = "(select max(timestamp) from packets)"
_LOCAL = "strftime(timezone('Europe/Rome', timezone('UTC', {})), '%d-%m-%Y %H:%M:%S')"
_PACKET_TIME = "make_timestamp(cast(floor(timestamp * 1000000) as bigint))"

# Flow records

_add("attack_summary", ["flows"], _SUMMARY, _VECTORS)
_add(
    "attack_vector",
    ["flows"],
    """select vector as vettore_attacco, label, count(*) as n, cast(sum(in_pkts) as bigint) as packets
       from vectors group by all""",
    _VECTORS,
)
_add("top_attackers", ["flows"], _top(5), _VECTORS)
_add("class_balance", ["flows"], _BALANCE)
_add(
    "protocol_ports",
    ["flows"],
    """select l4_dst_port as port, coalesce(p.name, cast(protocol as varchar)) as protocol_name, label,
         count(*) as flow_count, avg(in_bytes + out_bytes) as avg_bytes
       from flows left join (values (1, 'ICMP'), (6, 'TCP'), (17, 'UDP')) p(number, name) on number = protocol
       group by all
       order by flow_count desc, port nulls first, protocol_name nulls first, label nulls first limit 50""",
)
_add("traffic_by_minute", ["flows"], _MINUTES)
_add(
    "top_talkers",
    ["flows"],
    """select ipv4_src_addr as source_ip, ipv4_dst_addr as destination_ip, label,
         cast(sum(in_bytes + out_bytes) as bigint) as total_bytes, count(*) as flow_count
       from flows where ipv4_src_addr is not null and ipv4_dst_addr is not null group by all
       order by total_bytes desc, source_ip, destination_ip, label nulls first limit 100""",
)
_add(
    "volume_text",
    ["flows"],
    f"select ipv4_src_addr, total, {_human('total')} as volume from scaled",
    """sums as (select ipv4_src_addr, cast(sum(in_bytes + out_bytes) as bigint) as t from flows group by 1),
       scaled as (select ipv4_src_addr, unnest([t, t * 1024, t * 1048576, t, t // 1024, t // 1048576]) as total from sums)""",
)
_add("malicious_flows", ["flows"], "select * from flows where label <> 'Benign'")
_add(
    "flow_kpis",
    ["flows"],
    """select count(*) as flows_analysed, count(*) filter (label <> 'Benign') as malicious_flows,
         (select count(*) from (select distinct vector, label from vectors where label <> 'Benign')) as anomaly_groups
       from vectors""",
    _VECTORS,
)
_add(
    "attacker_status",
    ["flows", "held_sources"],
    """select t.*, coalesce(ip_attaccante in (select ip from held_sources), false) as is_blocked,
         if(coalesce(ip_attaccante in (select ip from held_sources), false), 'Protetto', 'Minaccia') as status
       from top t""",
    f"{_VECTORS}, top as ({_top(20)})",
)

# Sources and sinks

_add("flows_csv_round_trip", ["flows"], "select * from flows")
_add("flows_csv_inferred", ["flows"], _SUMMARY, _VECTORS)
_add("flows_parquet_round_trip", ["flows"], "select * from flows")
_add(
    "ingest_if_absent",
    ["flows"],
    "select label, count(*) as n, cast(sum(in_bytes) as bigint) as in_bytes from flows group by label",
)
_add("packets_json_round_trip", ["packets"], "select * exclude (event_id) from packets")
_add("saved_report", ["flows"], _SUMMARY, _VECTORS)
_add("appended_alerts", _ALERT_FRAMES, "select * from alerts", _ALERTS)
_add(
    "mounted_views",
    ["flows", "shared_packets"],
    """select ipv4_src_addr as ip, count(*) as flow_count,
         (select count(*) from shared_packets where src = ipv4_src_addr) as packet_count
       from flows where ipv4_src_addr in (select src from shared_packets) group by 1""",
)
_DECODED = """select event_id, epoch_us(ts) / 1000000.0::double as timestamp, case kind when 'Ether' then 18 when 'ARP' then 42 else 54 end::bigint as length,
         case kind when 'Ether' then 'Ether' when 'ARP' then concat('Ether / ARP who has ', d, ' says ', s)
           when 'IP' then concat('Ether / ', s, ' > ', d)
           else concat('Ether / IP / ', kind, ' ', s, ':', 40000 + event_id % 9000, ' > ', d, ':',
             ['bgp', 'ftp', 'ssh', 'http', '27017', 'https', 'http_alt', '5353'][1 + event_id % 8], if(kind = 'TCP', ' S', '')) end as summary,
         if(kind = 'Ether', 'Layer 2', s) as src, if(kind = 'Ether', 'Broadcast', d) as dst, kind as proto
       from (select *, concat('192.168.', user_id % 4, '.', user_id % 250) as s, concat('10.0.0.', event_id % 9) as d,
               case when user_id % 11 = 0 then 'Ether' when event_type = 'signup' then 'ARP'
                 when event_id % 7 = 0 then 'IP' when event_type = 'view' then 'UDP' else 'TCP' end as kind
             from events) e"""
_add("decoded_captures", [], f"select * exclude (event_id) from ({_DECODED})")
ORACLES["followed_captures"] = ORACLES["decoded_captures"]
_add("packet_stream", ["packets"], "select * exclude (event_id) from packets")
_add(
    "retained_packets",
    ["packets"],
    """select * exclude (total) from (
         select *, sum(length) over (order by timestamp desc, event_id) as total
         from (select * from packets order by timestamp desc, event_id limit 5000) n) r
       where total <= 1000000""",
)

# Packets and alerts

_add(
    "normalized_packets",
    ["headers"],
    """select event_id, timestamp, summary, length,
         coalesce(ip_src, arp_src, 'Layer 2') as src,
         case when ip_src is not null then ip_dst when arp_src is not null then arp_dst else 'Broadcast' end as dst,
         case when ip_src is not null and has_tcp then 'TCP' when ip_src is not null and has_udp then 'UDP'
              when ip_src is not null then 'IP' when arp_src is not null then 'ARP' else 'Ether' end as proto
       from headers""",
)
_add(
    "destination_part",
    ["packets"],
    "select event_id, nullif(split_part(lower(summary), ' > ', 2), '') as part from packets",
)
_add("alert_candidates", ["packets"], "select * from candidates", _CANDIDATES)
_add("strict_alert_candidates", ["packets"], "select * from candidates", _STRICT)
_add(
    "allowed_alerts_removed",
    ["packets", "allow"],
    "select * from candidates where source not in (select ip from allow)",
    _CANDIDATES,
)
_add(
    "auto_blocks",
    _ALERT_FRAMES,
    """select ip, timestamp '2024-02-01 00:00:00' as blocked_at,
         'AUTO-BLOCK: Presente in Black-List' as reason, 'BLOCKED' as status
       from deny where ip in (select src from packets) and ip not in (select ip from held)""",
)
_add("graded_alerts", _ALERT_FRAMES, "select * from alerts", _ALERTS)
_add(
    "alerts_by_block_log",
    ["packets", "block_log"],
    """select timestamp, message, if(state = 'BLOCKED', 'INFO', 'CRITICAL') as severity, source, target,
         if(state = 'BLOCKED', 'MITIGATED', 'ACTIVE') as status
       from candidates c asof left join changes l on c.source = l.ip and c.timestamp >= l.at""",
    _CANDIDATES
    + """, changes as (
      select ip, epoch_us(blocked_at) / 1000000.0::double as at, max({'status': status, 'reason': reason}).status as state
      from block_log group by ip, blocked_at)""",
)
_add("capture_alert_run", _ALERT_FRAMES[1:], "select * from alerts", f"packets as ({_DECODED}), {_ALERTS}")
_add("alert_stream_run", _ALERT_FRAMES, "select * from alerts", _ALERTS)
_add("traffic_stream_run", ["flows"], _MINUTES)
_add(
    "latest_packets",
    ["packets"],
    f"""select {_LOCAL.format(_PACKET_TIME)} as time, src, dst, proto, left(summary, 80) as summary
        from packets order by timestamp desc, event_id limit 20""",
)
_add(
    "masked_latest_packets",
    ["packets"],
    f"""select strftime({_PACKET_TIME}, '%d-%m-%Y %H:%M:%S') as time,
          if(contains(src, '.'), array_to_string(string_split(src, '.')[:-2], '.') || '.xxx', src) as src,
          if(contains(dst, '.'), array_to_string(string_split(dst, '.')[:-2], '.') || '.xxx', dst) as dst,
          proto, left(summary, 80) as summary
        from packets order by timestamp desc, event_id limit 50""",
)
_add(
    "masked_addresses",
    ["packets"],
    """select event_id,
         if(contains(src, '.'), array_to_string(string_split(src, '.')[:-2], '.') || '.xxx', src) as src,
         if(contains(dst, '.'), array_to_string(string_split(dst, '.')[:-2], '.') || '.xxx', dst) as dst
       from packets""",
)

# Lists, alert views, audit

_add("upserted_blocks", ["block_log"], "select * from latest", _LATEST_BLOCKS)
ORACLES["stored_blocks"] = ORACLES["upserted_blocks"]
_add(
    "stored_catalog",
    ["catalog"],
    """select id, name, 0 as version from catalog
       union all
       select id, name, 1 from catalog
       where id in ('ds_historical_nids', 'ds_live_sniffer', 'ds_llm_models')
          or id not in (select concat('ds_', doc_id) from labels where toxic = 1)""",
)
_add(
    "active_blocks",
    ["block_log"],
    "select * from latest where status = 'BLOCKED'",
    _LATEST_BLOCKS,
)
_add(
    "recent_alerts",
    _ALERT_FRAMES,
    f"""select *, (select count(*) from alerts where timestamp > {_NOW} - 86400) as recent_count
        from alerts where timestamp > {_NOW} - 86400
        order by timestamp desc, source, message limit 5""",
    _ALERTS,
)
_add(
    "attack_banner",
    _ALERT_FRAMES,
    f"""select if(source in (select ip from blocks), 'ATTACCO MITIGATO', 'ATTACCO IN CORSO') as banner, source, message
        from (select * from alerts where timestamp > {_NOW} - 7200
              order by timestamp desc, source, message limit 1) a""",
    _ALERTS,
)
_add(
    "alert_board",
    _ALERT_FRAMES,
    """select timestamp, source, message, source in (select ip from blocks) as is_blocked
       from alerts order by timestamp desc, source, message limit 10""",
    _ALERTS,
)
_add(
    "audit_rows",
    ["actions"],
    """select timestamp '2024-02-01 00:00:00' as timestamp, "user", action, details from actions""",
)
_add(
    "latest_audit",
    ["actions"],
    f"""select {_LOCAL.format('timestamp')} as timestamp, "user", action, details
        from (select * from actions order by timestamp desc, "user", action, details limit 10) a""",
)
_add(
    "platform_kpis",
    ("actions",) + _ALERT_FRAMES,
    """select (select count(*) from actions) as audit_rows, (select count(*) from blocks) as blocked_addresses,
         (select count(*) from packets) as packets_held, 5000::bigint as packet_capacity""",
    _ALERTS,
)

# Both sources

_add(
    "flow_packet_matches",
    ["flows", "shared_packets"],
    """select ip, label, flow_count, packet_count, flow_count * packet_count as pairs
       from (select ipv4_src_addr as ip, label, count(*) as flow_count from flows group by all) f
       join (select src as ip, count(*) as packet_count from shared_packets group by all) p using (ip)""",
)
_add(
    "flows_with_packets",
    ["flows", "shared_packets"],
    """select ipv4_src_addr, summary from flows join shared_packets on ipv4_src_addr = src
       order by ipv4_src_addr, summary limit 10""",
)
_add(
    "addresses_by_source",
    ["flows", "shared_packets"],
    """select ip, origin, count(*) as rows from (
         select ipv4_src_addr as ip, 'storico' as origin from flows
         union all select src, 'live' from shared_packets) u
       where ip is not null group by all""",
)
_add(
    "volume_both",
    ["flows", "shared_packets"],
    """select ip, flow_bytes, packet_bytes
       from (select ipv4_src_addr as ip, cast(sum(in_bytes + out_bytes) as bigint) as flow_bytes from flows group by 1) f
       join (select src as ip, cast(sum(length) as bigint) as packet_bytes from shared_packets group by 1) p using (ip)""",
)
_READ_ONLY = (
    "Operazione Negata: Per motivi di sicurezza è consentita SOLO "
    "l''istruzione SELECT o WITH in questa console."
)
_CHANGES = (
    "Operazione Negata: Rilevata istruzione di manipolazione dati (DML/DDL). "
    "Puoi usare solo query di lettura (SELECT)."
)
_add(
    "sql_verdicts",
    ["query_log"],
    f"""select event_id, query, reason, reason is null as allowed from (
          select event_id, query, case
            when not regexp_matches(t, '^(select|with)') then '{_READ_ONLY}'
            when regexp_matches(t, '(insert|update|delete|drop|truncate|alter|create|replace|grant|revoke) ')
              then '{_CHANGES}' end as reason
          from (select *, lower(regexp_replace(query, '^\\s+', '')) as t from query_log) q) v""",
)

# Catalog

_FIELDS = """
catalog_fields as (
  select id, 0 as position, 'id' as name, 'Long' as type, location as description from catalog
  union all select id, 1, 'text', 'String', name from catalog)
"""
_add("catalog_fields", ["catalog"], "select * from catalog_fields", _FIELDS)
_add(
    "catalog_search",
    ["catalog"],
    r"""select id, name from catalog
        where regexp_matches(name, 'src1\b|licen[sc]e|\bane', 'i')
           or regexp_matches(description, 'src1\b|licen[sc]e|\bane', 'i')""",
)
_add(
    "catalog_preview",
    ["catalog"],
    "select id, name, format, created_at from catalog order by created_at desc, id limit 10",
)

_NUMERIC = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"),
)
_OTHER = (
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
)


def _profile(name, kind):
    v = f"{name}::double"
    return f"""select '{name}' as "column", '{kind}' as type, count({v}) as count, round(avg({v}), 4) as mean,
      round(stddev_samp({v}), 4) as std, round(min({v}), 4) as min, round(quantile_cont({v}, 0.25), 4) as p25,
      round(quantile_cont({v}, 0.5), 4) as p50, round(quantile_cont({v}, 0.75), 4) as p75, round(max({v}), 4) as max
      from lineitem"""


def _no_profile(name, kind):
    empty = ", ".join(f"null::double as {c}" for c in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    return f"""select '{name}' as "column", '{kind}' as type, 0::bigint as count, {empty}"""


_add(
    "column_profile",
    [],
    " union all ".join([_profile(*c) for c in _NUMERIC] + [_no_profile(*c) for c in _OTHER]),
)
_add(
    "deregistered_catalog",
    ["catalog"],
    """select id, name from catalog
       where id in ('ds_historical_nids', 'ds_live_sniffer', 'ds_llm_models')
          or id not in (select concat('ds_', doc_id) from labels where toxic = 1)""",
)
_add(
    "dataset_freshness",
    ["catalog", "packets"],
    """select id, name, if(id = 'ds_live_sniffer', n, null) as records, t as last_update,
         strftime(timezone('Europe/Rome', timezone('UTC', t)), 'Ultimo aggiornamento: %H:%M:%S (%d-%m-%Y)') as last_update_text
       from (select *, if(id = 'ds_live_sniffer', make_timestamp(cast(floor(newest * 1000000) as bigint)), created_at) as t
             from catalog cross join (select count(*) as n, max(timestamp) as newest from packets) p) c""",
)

# Upload screening

_MARKERS = (
    "#!/bin/bash", "#!/bin/sh", "#!/usr/bin/env python", "<script>", "</script>",
    "<?php", "eval(", "exec(", "os.system(", "subprocess.run(",
)
_HEADS = (
    ("chr(127) || 'ELF'", "Eseguibile ELF (Linux)"), ("'MZ'", "Eseguibile PE (Windows)"),
    ("'%PDF'", "File PDF"), ("'PK' || chr(3) || chr(4)", "Archivio ZIP/Office (DOCX/XLSX)"),
    ("'BZh'", "Archivio BZIP2"), ("'GIF89a'", "Immagine GIF"), ("'GIF87a'", "Immagine GIF"),
)
_HEAD_REASON = (
    "(select concat('Rilevato file binario non autorizzato (', k, '). Iniezione bloccata!') "
    "from (values " + ", ".join(f"({h}, '{k}')" for h, k in _HEADS) + ") h(b, k) where starts_with(text, b) limit 1)"
)
_MARKER_REASON = "case " + " ".join(
    f"when contains(text, '{m}') then 'Rilevato codice/script sospetto all''interno del file CSV: ''{m}''. Iniezione bloccata!'"
    for m in _MARKERS
) + " end"
_TOO_LARGE = "File troppo grande. Il limite massimo è 10MB."
_BAD_NAME = "Estensione del file non valida. È consentito solo il formato .csv."


def _size_reason(limit):
    return f"if(length > {limit}, '{_TOO_LARGE}', null)"


_NAME_REASON = f"if(regexp_matches(file, '\\.csv$', 'i'), null, '{_BAD_NAME}')"


def _screen(frame, limit):
    """CTEs up to ``verdicts``: path, text, accepted, reason, delimiter."""
    return f"""
    early as (select *, coalesce({_size_reason(limit)}, {_NAME_REASON}, {_HEAD_REASON}, {_MARKER_REASON}) as early_reason from {frame}),
    {_shapes('early')},
    judged as (
      select e.*, coalesce(early_reason, s.shape) as reason, s.delimiter as found
      from early e join shapes s using (path)),
    verdicts as (
      select *, reason is null as accepted, if(reason is null, found, null) as delimiter from judged),
    {_CELLS},
    flags as (
      select path, bool_or(regexp_matches(cell, '^[=+@-]')) as formula_found from clean group by path)
    """


def _shapes(frame):
    """CTE ``shapes``: delimiter and shape reason of every text in ``frame``."""
    return rf"""
    plain as (
      select path, text, d, nr, string_split_regex(p, '\r?\n')[:-2] as rows,
        regexp_matches(p, '\r[^\n]') as stray
      from (
        select path, text, nr, d, regexp_replace(if(suffix(text, chr(10)), text, text || chr(10)),
            '(^|[' || d || '\r\n])"[^"]*(?:""[^"]*)*"?', '\1q', 'g') as p
        from {frame} cross join (values (1, ','), (2, chr(9)), (3, ';'), (4, '|')) c(nr, d)) m),
    measured as (
      select path, text, d, nr, stray,
        list_transform(rows, lambda r: if(r = '', 0, len(r) - len(replace(r, d, '')) + 1)) as widths
      from plain),
    chosen as (
      select path, any_value(text) as text, coalesce(
        min(nr) filter (contains(text, d) and len(list_distinct(list_filter(widths, lambda w: w > 0))) = 1
          and list_filter(widths, lambda w: w > 0)[1] > 1),
        min(if(d = ';', 3, null)) filter (contains(text, d)), min(if(d = chr(9), 2, null)) filter (contains(text, d)),
        min(if(d = '|', 4, null)) filter (contains(text, d)), 1) as nr
      from measured group by path),
    shapes as (
      select path, d as delimiter, case
        when m.text = '' then 'Il file CSV è vuoto.'
        when stray then 'Struttura CSV corrotta o non valida: ritorno a capo fuori da un campo tra virgolette'
        when widths[1] = 0 then 'Struttura CSV non valida (nessuna colonna trovata).'
        when len(list_distinct(widths)) > 1 then concat('Inconsistenza nel numero di colonne alla riga ',
          list_position(list_transform(widths, lambda w: w <> widths[1]), true), '.') end as shape
      from measured m join chosen c using (path, nr))
    """


_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(c):
    return f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


_CELLS = rf"""
tokens as (
  select path, nr, token, coalesce(sum(suffix(token, chr(10))::int) over (partition by path order by nr rows between unbounded preceding and 1 preceding), 0) as row_nr
  from (
    select path, unnest(t) as token, generate_subscripts(t, 1) as nr
    from (select path, regexp_extract_all(if(suffix(text, chr(10)), text, text || chr(10)),
            '("[^"]*(?:""[^"]*)*"?[^' || delimiter || '\r\n]*|[^"' || delimiter || '\r\n][^' || delimiter || '\r\n]*|)([' || delimiter || ']|\r?\n)') as t
          from verdicts where accepted) x) y),
clean as (
  select path, cast(row_nr + 1 as int) as row_no, cast(row_number() over (partition by path, row_nr order by nr) - 1 as int) as cell_no,
    {_strip('''case when starts_with(body, '"') then replace(regexp_extract(body, '(?s)^"([^"]*(?:""[^"]*)*)"?', 1), '""', '"')
         || regexp_extract(body, '(?s)^"[^"]*(?:""[^"]*)*"?(.*)$', 1) else body end''')} as cell
  from (select path, row_nr, nr, regexp_replace(token, '(?s)(.|\r?\n)$', '') as body from tokens) b)
"""
_VERDICT_COLUMNS = """
select path, accepted, reason, delimiter, if(accepted, coalesce(formula_found, false), null) as formula_found
from verdicts left join flags using (path)
"""
_add("upload_verdicts", ["uploads"], _VERDICT_COLUMNS, _screen("uploads", 10485760))
_add("text_file_verdicts", ["text_files"], _VERDICT_COLUMNS, _screen("text_files", 10485760))
_add(
    "size_and_name_checks",
    ["uploads"],
    f"select path, {_size_reason(85)} as size_reason, {_NAME_REASON} as name_reason from uploads",
)
_add("binary_signatures", ["uploads"], f"select path, {_HEAD_REASON} as reason from uploads")
_add("decoded_uploads", ["text_files"], "select path, md5(text) as digest from text_files")
_add("script_markers", ["text_files"], f"select path, {_MARKER_REASON} as reason from text_files")
_add("csv_delimiters", ["uploads"], "select path, delimiter from shapes", _shapes("uploads"))
_add("csv_shapes", ["uploads"], "select path, shape as reason from shapes", _shapes("uploads"))
_add(
    "defused_cells",
    ["cells"],
    """select o_orderkey, if(left(a, 1) in ('=', '+', '-', '@'), '''' || a, a) as cell_a,
         if(left(b, 1) in ('=', '+', '-', '@'), '''' || b, b) as cell_b
       from (select o_orderkey, """
    + f"{_strip('cell_a')} as a, {_strip('cell_b')} as b from cells) c",
)
_add(
    "clean_upload_rows",
    ["uploads"],
    """select path, row_no, cell_no, if(left(cell, 1) in ('=', '+', '-', '@'), '''' || cell, cell) as cell from clean""",
    _screen("uploads", 10485760),
)
_add(
    "cleaned_files",
    ["uploads"],
    """select path, row_no, cell_no, if(left(cell, 1) in ('=', '+', '-', '@'), '''' || cell, cell) as cell
       from clean join (select path, dataset, description from uploads) using (path)
       where trim(dataset) <> '' and trim(description) <> ''""",
    _screen("uploads", 10485760),
)
_add(
    "upload_audit",
    ["uploads"],
    """select timestamp '2024-02-01 00:00:00' as timestamp, 'Admin' as "user",
         if(accepted, 'UploadSuccess', 'UploadBlocked') as action,
         if(accepted, concat('Dataset: ', dataset, ' - File: ', file, ' - Formule bonificate: ', if(formula_found, 'True', 'False')),
           concat('File: ', file, ' - Motivo: ', reason)) as details
       from verdicts left join flags using (path)
       where trim(dataset) <> '' and trim(description) <> ''""",
    _screen("uploads", 10485760),
)
_ENTRIES = (
    _screen("uploads", 10485760)
    + r""",
    entries as (
      select *, md5(path) as key from verdicts
      where accepted and trim(dataset) <> '' and trim(description) <> ''),
    header as (
      select path, key, cell_no, case when starts_with(body, '"') then trim(body, '"') else body end as name
      from (select path, nr - 1 as cell_no, regexp_replace(token, '(.|\n)$', '') as body from tokens where row_nr = 0) t
      join entries using (path))
    """
)
_add(
    "registered_uploads",
    ["uploads", "catalog"],
    """select * from catalog_fields union all
       select concat('ds_', key), cast(cell_no as int), name, 'String', null from header""",
    f"{_ENTRIES}, {_FIELDS}",
)
_add(
    "upload_entries",
    ["uploads", "catalog"],
    """select id, name, source, format, location, category, created_at from catalog union all
       select concat('ds_', key), dataset, concat('Uploaded File (', file, ')'), 'CSV',
         concat('/ingested/', replace(lower(dataset), ' ', '_'), '_', key, '.csv'), category,
         timestamp '2024-02-01 00:00:00' from entries""",
    _ENTRIES,
)

# Assistant text

_SECURITY = (
    "ip|block|bloccat|firewall|attacc|alert|allarm|traffico|sniffer|sicurezza|nids|intrusion|catalogo|"
    "dataset|mongo|database|cyber|porta|port|conness"
)
_GREETING = "ciao|buongiorno|salve|buonasera|test|hola|hello|hi|hey|chi sei|aiuto"
_ROUTED = f"""
routed as (
  select conv_id, turn, text, s as is_security, g as is_greeting, not s and (g or length(t) < 16) as is_generic
  from (select *, regexp_matches(t, '{_SECURITY}') as s, regexp_matches(t, '{_GREETING}') as g
        from (select *, lower({_strip('text')}) as t from questions) a) b)
"""
_CONTEXT = (
    _ALERTS
    + f""", {_LATEST_BLOCKS},
    block_lines as (
      select string_agg(concat('- IP: ', ip, ' | Bloccato il: ', strftime(blocked_at, '%Y-%m-%d %H:%M'), ' | Motivo: ', reason, chr(10)),
               '' order by blocked_at desc, ip) as t
      from (select * from latest where status = 'BLOCKED' order by blocked_at desc, ip limit 5) b),
    alert_lines as (
      select string_agg(concat('- Alert: ', message, ' | Stato: ', status, ' | Severità: ', severity, chr(10)),
               '' order by timestamp desc, source, message) as t
      from (select * from alerts order by timestamp desc, source, message limit 5) a),
    context as (
      select concat(chr(10), '[CONTESTO REALE DEL DATA CENTER - DA MONGO DB]', chr(10), 'IP bloccati nel firewall edge:', chr(10),
        coalesce(b.t, concat('- Nessun IP bloccato al momento.', chr(10))),
        chr(10), 'Allarmi di sicurezza recenti:', chr(10),
        coalesce(a.t, concat('- Nessun allarme recente.', chr(10)))) as context
      from block_lines b, alert_lines a)
    """
)
_CONTEXT_FRAMES = _ALERT_FRAMES + ("block_log",)
_add("routed_questions", ["questions"], "select * from routed", _ROUTED)
_add("security_context", _CONTEXT_FRAMES, "select * from context", _CONTEXT)
_add(
    "assistant_prompts",
    _CONTEXT_FRAMES + ("questions",),
    """select conv_id, turn, if(is_generic, 'Rispondi in lingua italiana: ' || text,
         concat('[IMPORTANTE - RISPONDI IN LINGUA ITALIANA]', chr(10),
           'Usa questi dati reali del Data Center per rispondere alla domanda dell''utente se pertinenti:', chr(10),
           (select context from context), chr(10), chr(10), 'Domanda dell''utente: ', text)) as prompt
       from routed""",
    f"{_CONTEXT}, {_ROUTED}",
)
_add(
    "sql_prompts",
    ["questions"],
    """select conv_id, turn, concat('L''utente richiede: ', text, chr(10),
         'Genera solo la query SQL, senza markdown.') as prompt from questions""",
)
_THOUGHT = r"<think>(.*?)(?:</think>|(\n?)\z)"


def _split(c):
    return (
        f"regexp_extract({c}, '{_THOUGHT}', 1, 's') as reasoning, "
        f"regexp_replace({c}, '{_THOUGHT}', '\\2', 'gs') as answer"
    )


_add(
    "split_replies",
    ["replies"],
    f"select conv_id, turn, {_split('reply')} from replies",
)
_add(
    "assembled_replies",
    ["chunks"],
    """select conv_id, answer || tail_response as answer,
         if(contains(raw, '<think>'), reasoning || tail_thinking, all_thinking) as reasoning
       from (select *, """
    + _split("raw")
    + " from joined) s",
    """last_plain as (select conv_id, max(turn) as t from chunks where thinking is null group by 1),
       joined as (
         select conv_id,
           coalesce(string_agg(response, '' order by turn) filter (thinking is null), '') as raw,
           coalesce(string_agg(thinking, '' order by turn), '') as all_thinking,
           coalesce(string_agg(response, '' order by turn) filter (turn > coalesce(t, -1)), '') as tail_response,
           coalesce(string_agg(thinking, '' order by turn) filter (turn > coalesce(t, -1)), '') as tail_thinking
         from chunks left join last_plain using (conv_id) group by conv_id)""",
)
