"""Log lines made from the ``events`` table.

The tables hold no log lines, so each event is written out as one line in one of
twelve shapes.  ``SEED`` and ``LINE`` use only SQL that Spark and DuckDB share: the
oracles start from the same seed columns and state the expected result from them,
without ever parsing a line.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.functions.plan import evaluate_once

# A task gets no more events than it can sort whole, as forensic rows, in its memory.
TASK_EVENTS = 100_000


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


SEED = {
    "fmt": "event_id % 12",
    "src_ip": f"""CASE user_id % 9
        WHEN 0 THEN '185.220.101.5'
        WHEN 1 THEN '10.0.' || {_s('event_id % 250')} || '.' || {_s('user_id % 250 + 1')}
        WHEN 2 THEN '192.168.1.' || {_s('user_id % 250 + 1')}
        WHEN 3 THEN '198.51.100.' || {_s('event_id % 250 + 1')}
        WHEN 4 THEN '8.8.8.' || {_s('event_id % 250 + 1')}
        WHEN 5 THEN '45.33.32.156'
        WHEN 6 THEN '172.20.' || {_s('event_id % 250')} || '.7'
        WHEN 7 THEN '104.20.' || {_s('event_id % 250')} || '.9'
        ELSE '100.64.0.' || {_s('event_id % 250')} END""",
    "src_kind": "user_id % 9",
    "dst_ip": f"""CASE event_id % 7
        WHEN 0 THEN '10.1.2.' || {_s('user_id % 250 + 1')}
        WHEN 1 THEN '192.168.5.' || {_s('event_id % 250')}
        WHEN 2 THEN '194.26.29.112'
        WHEN 3 THEN '1.1.1.1'
        WHEN 4 THEN '52.10.' || {_s('event_id % 250')} || '.3'
        WHEN 5 THEN '172.16.9.' || {_s('user_id % 250 + 1')}
        ELSE '203.0.113.' || {_s('event_id % 250')} END""",
    "dst_kind": "event_id % 7",
    "sport": "1024 + (event_id * 13) % 64000",
    "dport": """CASE user_id % 10
        WHEN 0 THEN 22 WHEN 1 THEN 23 WHEN 2 THEN 3389 WHEN 3 THEN 80 WHEN 4 THEN 443
        WHEN 5 THEN 8080 WHEN 6 THEN 53 WHEN 7 THEN 445 WHEN 8 THEN 2323
        ELSE 1000 + event_id % 50000 END""",
    "out_bytes": "CAST(floor(value * 1000) AS BIGINT)",
    "in_bytes": "user_id * 37 + event_id % 5",
    "dur": "event_id % 3000",
    "sess": "100000 + event_id",
    "verb": """CASE event_type WHEN 'click' THEN 'allow' WHEN 'view' THEN 'Accept'
        WHEN 'purchase' THEN 'deny' WHEN 'error' THEN 'DROP' ELSE 'reset-both' END""",
    "proto_name": "CASE event_id % 4 WHEN 0 THEN 'tcp' WHEN 1 THEN 'udp' WHEN 2 THEN 'icmp' ELSE 'gre' END",
    "proto_num": "CASE event_id % 4 WHEN 0 THEN 6 WHEN 1 THEN 17 WHEN 2 THEN 1 ELSE 99 END",
    "level": """CASE user_id % 6 WHEN 0 THEN 'notice' WHEN 1 THEN 'warning' WHEN 2 THEN 'error'
        WHEN 3 THEN 'critical' WHEN 4 THEN 'information' ELSE '' END""",
    "rule": f"CASE WHEN event_id % 5 = 0 THEN 'deny, \"all\" web' ELSE 'rule-' || {_s('user_id % 20')} END",
    "cef_level": "CASE user_id % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Low' ELSE '10' END",
    "cef_name": "CASE WHEN user_id % 4 = 0 THEN 'Port Scan seen' WHEN user_id % 4 = 1 THEN 'Directory walk' ELSE 'Packet' END",
    "sig_name": """'ET ' || CASE user_id % 3 WHEN 0 THEN 'SCAN' WHEN 1 THEN 'Tor' ELSE 'INFO' END || ' rule'""",
}

_COUNTER_TIME = "2024/01/01 00:00:00"


def _kv(*pairs: tuple[str, str], glue: str = "' '") -> str:
    return f" || {glue} || ".join(f"'{key}=' || {value}" for key, value in pairs)


_LEEF_PAIRS = [
    ("src", "src_ip"), ("srcPort", _s("sport")), ("dst", "dst_ip"), ("dstPort", _s("dport")),
    ("proto", "proto_name"), ("action", "verb"), ("sev", "'Critical'"), ("totalBytes", _s("out_bytes")),
]

LINE = f"""CASE fmt
WHEN 0 THEN '<134>1,{_COUNTER_TIME},0018,TRAFFIC,end,1,{_COUNTER_TIME},' || src_ip || ',' || dst_ip
    || ',0.0.0.0,0.0.0.0,' || CASE WHEN event_id % 5 = 0 THEN '"deny, ""all"" web"' ELSE rule END
    || ',,,web-browsing,vsys1,untrust, trust ,e1,e2,default,{_COUNTER_TIME},' || {_s('sess')} || ',1,'
    || {_s('sport')} || ',' || {_s('dport')} || ',0,0,0x0,' || proto_name || ',' || verb || ','
    || {_s('in_bytes + out_bytes + 1')} || ',' || {_s('out_bytes')} || ',' || {_s('in_bytes')}
    || ',9,{_COUNTER_TIME},' || {_s('dur')} || ',any' || CASE WHEN event_id % 7 = 0 THEN ',x1,x2' ELSE '' END
WHEN 1 THEN '<166>Mar 04 06:11:40 edge-a %ASA-6-302013: Built outbound TCP connection ' || {_s('sess')}
    || ' for outside:' || dst_ip || '/' || {_s('dport')} || ' (' || dst_ip || '/' || {_s('dport')}
    || ') to inside:' || src_ip || '/' || {_s('sport')} || ' (' || src_ip || '/' || {_s('sport')} || ')'
WHEN 2 THEN '<164>Mar 04 06:11:52 edge-a %ASA-4-106023: Deny udp src outside:' || src_ip || '/' || {_s('sport')}
    || ' dst inside:' || dst_ip || '/' || {_s('dport')} || ' by access-group "OUT" [0x0, 0x0]'
WHEN 3 THEN '009077: 2024 Jan 01 13:05:59.417 UTC: %SEC_LOGIN-'
    || CASE WHEN event_id % 24 = 3 THEN '4-LOGIN_FAILED: Login failed' ELSE '5-LOGIN_SUCCESS: Login Success' END
    || ' [user: u' || {_s('user_id')} || '] [Source: ' || src_ip || '] [port: ' || {_s('dport')} || ']'
    || CASE WHEN event_id % 24 = 3 THEN ' [Reason: Authentication Failure]' ELSE '' END
WHEN 4 THEN '<189>date=2024-01-01 time=10:00:00 devname="FGT-1" type="traffic" level="' || level || '" srcip=' || src_ip
    || ' srcport=' || {_s('sport')} || ' srcintf="port1" dstip=' || dst_ip || ' dstport=' || {_s('dport')}
    || ' dstintf="wan1" proto=' || {_s('proto_num')} || ' action="' || verb || '" policyid=' || {_s('user_id % 20')}
    || ' app="HTTPS" sentbyte=' || {_s('out_bytes')} || ' rcvdbyte=' || {_s('in_bytes')} || ' duration=' || {_s('dur')}
    || ' note="" vd=root vd=' || 'root2'
WHEN 5 THEN '{{"timestamp":"2024-01-01T00:00:00","flow_id":' || {_s('sess')} || ',"event_type":"alert","src_ip":"' || src_ip
    || '","src_port":' || {_s('sport')} || ',"dest_ip":"' || dst_ip || '","dest_port":' || {_s('dport')} || ',"proto":"'
    || upper(proto_name) || '","app_proto":"http","alert":{{"action":"' || CASE WHEN user_id % 2 = 0 THEN 'allowed' ELSE 'blocked' END
    || '","gid":1,"signature_id":' || {_s('2010000 + user_id')} || ',"rev":0,"signature":"' || sig_name
    || '","category":"Misc","severity":' || {_s('user_id % 4')} || '}},"flow":{{"pkts_toserver":1,"pkts_toclient":0,"bytes_toserver":'
    || {_s('out_bytes')} || ',"bytes_toclient":' || {_s('in_bytes')} || '}},"tls":{{}}}}'
WHEN 6 THEN '<134>Mar 04 06:12:09 gate filterlog: 4,,,1770009331,em2,match,' || CASE WHEN user_id % 2 = 0 THEN 'pass' ELSE 'block' END
    || ',in,4,0x8,,57,311,0,none,6,' || proto_name || ',' || {_s('out_bytes')} || ',' || src_ip || ',' || dst_ip || ','
    || {_s('sport')} || ',' || {_s('dport')}
WHEN 7 THEN '1704067200.' || {_s('event_id')} || chr(9) || 'C' || {_s('sess')} || chr(9) || src_ip || chr(9) || {_s('sport')}
    || chr(9) || dst_ip || chr(9) || {_s('dport')} || chr(9) || proto_name || chr(9) || 'dns' || chr(9) || {_s('dur')} || '.75'
    || chr(9) || {_s('out_bytes')} || chr(9) || {_s('in_bytes')} || chr(9) || 'SF' || chr(9) || 'T'
WHEN 8 THEN 'CEF:0|Acme Networks|EdgeGuard|5.2|pkt-7|' || cef_name || '|' || cef_level || '|'
    || {_kv(("src", "src_ip"), ("dst", "dst_ip"), ("spt", _s("sport")), ("dpt", _s("dport")), ("proto", _s("proto_num")), ("act", "verb"), ("in", _s("in_bytes")), ("out", _s("out_bytes")), ("app", "'ssh'"))}
WHEN 9 THEN 'LEEF:2.0|Acme Networks|WebShield|3.1|ALERT|' || CASE event_id % 36
    WHEN 9 THEN {_kv(*_LEEF_PAIRS, glue="chr(9)")}
    WHEN 21 THEN '^|' || {_kv(*_LEEF_PAIRS, glue="'^'")}
    ELSE '0x3B|' || {_kv(*_LEEF_PAIRS, glue="';'")} END
WHEN 10 THEN '<13>' || {_kv(("src_ip", "src_ip"), ("src_port", _s("sport")), ("dst_ip", "dst_ip"), ("dst_port", _s("dport")), ("proto", "proto_name"), ("action", "verb"), ("bytes_in", _s("in_bytes")), ("bytes_out", _s("out_bytes")))}
    || ', severity=4 custom_tag="a b" saddr=9.9.9.9 bytes='
    || CASE WHEN event_id % 36 = 10 THEN '1e400' ELSE {_s('out_bytes')} || '.9' END
ELSE CASE WHEN event_id % 24 = 11 THEN '<13>app[12]: user ' ELSE 'user ' END || {_s('user_id')} || ' did ' || event_type
    || ' at gateway'
END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_lines(events: DataFrame) -> DataFrame:
    """Event ids with their log line."""
    seeded = events.select("event_id", "user_id", "event_type", *[F.expr(v).alias(k) for k, v in SEED.items()])
    return evaluate_once(seeded.select("event_id", F.expr(LINE).alias("raw_event")))


def lines(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Event ids with their log line.

    ``tasks`` redistributes the events first, to at least so many tasks: parsing is by far
    the heaviest part, and a small table is one file that cannot be split.  Larger tables
    get more tasks, not larger ones, and a task gets neighbouring ids: events of few days,
    so a table by days gets few files.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    if tasks:
        events = events.repartitionByRange(max(tasks, math.ceil(events.count() / TASK_EVENTS)), "event_id")
    return with_lines(events)


# The same lines for DuckDB: ``seed`` has every seed column, ``line`` and the keys.
SEED_CTE = f"""seed0 AS (SELECT event_id, user_id, event_type,
{', '.join(f'{v} AS {k}' for k, v in SEED.items())} FROM events),
seed AS (SELECT *, {LINE} AS line FROM seed0)"""
