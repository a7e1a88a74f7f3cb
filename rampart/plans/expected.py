"""What normalizing the derived lines must give, stated from the seed columns."""

from __future__ import annotations

from rampart.plans.lines import SEED_CTE


def _case(on: str, branches: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {key} THEN {value}" for key, value in branches.items())
    return f"CASE {on} {whens} ELSE {default} END"


_SYSLOG = "event_id % 24 = 11"
_FAILED = "event_id % 24 = 3"

_PARSER = _case("fmt", {
    0: "'palo_alto_traffic'", 1: "'cisco_asa'", 2: "'cisco_asa'", 3: "'cisco_ios'",
    4: "'fortinet_fortios'", 5: "'suricata_eve'", 6: "'pfsense_filterlog'", 7: "'zeek_conn'",
    8: "'generic_cef'", 9: "'generic_leef'", 10: "'generic_kv'",
}, f"CASE WHEN {_SYSLOG} THEN 'generic_syslog' ELSE 'generic_raw' END")

_CONFIDENCE = _case("fmt", {
    0: "0.95", 1: "0.99", 2: "0.99", 3: "0.95", 4: "0.95", 5: "0.99", 6: "0.95", 7: "0.9",
    8: "0.98", 9: "0.98", 10: "0.8",
}, f"CASE WHEN {_SYSLOG} THEN 0.75 ELSE 0.5 END")

_STEP1 = f"""step1 AS (SELECT *, {_PARSER} AS parser, CAST({_CONFIDENCE} AS DOUBLE) AS confidence,
    (fmt = 10 AND event_id % 36 = 10) AS bad FROM seed)"""

_NET = "fmt <= 10 AND NOT bad"
_DISPOSITION = """CASE lower(verb) WHEN 'allow' THEN 'Allowed' WHEN 'accept' THEN 'Allowed'
    WHEN 'deny' THEN 'Blocked' WHEN 'drop' THEN 'Dropped' ELSE 'Reset' END"""
_PROTO_BY_NAME = "upper(proto_name)"
_PROTO_BY_NUM = "CASE proto_num WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' WHEN 1 THEN 'ICMP' ELSE 'IP-99' END"

_STEP2 = f"""step2 AS (SELECT *,
    CASE WHEN bad THEN 'unknown' ELSE parser END AS parser_id,
    {_case('CASE WHEN bad THEN -1 ELSE fmt END', {
        -1: "'Unknown'", 0: "'Palo Alto Networks'", 1: "'Cisco Systems'", 2: "'Cisco Systems'",
        3: "'Cisco Systems'", 4: "'Fortinet'", 5: "'OISF'", 6: "'pfSense / Netgate'", 7: "'Zeek'",
        8: "'Standard CEF'", 9: "'Standard LEEF'"}, "'Generic'")} AS vendor,
    {_case('CASE WHEN bad THEN -1 ELSE fmt END', {
        -1: "'Unknown'", 0: "'PAN-OS Next-Gen Firewall'",
        1: "'Cisco Adaptive Security Appliance (ASA)'", 2: "'Cisco Adaptive Security Appliance (ASA)'",
        3: "'Cisco IOS / IOS-XE Network OS'", 4: "'FortiGate Next-Gen Firewall'",
        5: "'Suricata IDS/IPS Engine'", 6: "'pfSense Packet Filter (pf)'",
        7: "'Zeek Network Security Monitor'", 8: "'Perimeter Security Appliance'",
        9: "'Perimeter Security Gateway'", 10: "'Network Device'"},
        f"CASE WHEN {_SYSLOG} THEN 'Syslog Perimeter Relay' ELSE 'Perimeter Device' END")} AS product,
    CASE WHEN {_NET} THEN src_ip END AS e_src_ip,
    CASE WHEN {_NET} AND fmt <> 3 THEN dst_ip END AS e_dst_ip,
    CASE WHEN {_NET} AND fmt <> 3 THEN sport END AS e_sport,
    CASE WHEN {_NET} THEN dport END AS e_dport,
    CASE fmt WHEN 0 THEN 'untrust' WHEN 1 THEN 'inside' WHEN 2 THEN 'outside' WHEN 4 THEN 'port1' END AS e_src_zone,
    CASE fmt WHEN 0 THEN 'trust' WHEN 1 THEN 'outside' WHEN 2 THEN 'inside' WHEN 4 THEN 'wan1' END AS e_dst_zone,
    CASE WHEN bad OR fmt = 11 THEN 'unknown' WHEN fmt IN (4, 8) THEN {_PROTO_BY_NUM}
        WHEN fmt = 1 THEN 'TCP' WHEN fmt = 2 THEN 'UDP'
        WHEN fmt = 3 THEN CASE WHEN dport = 22 THEN 'TCP' ELSE 'unknown' END
        ELSE {_PROTO_BY_NAME} END AS e_proto,
    CASE WHEN fmt IN (0, 1, 5) THEN CAST(sess AS STRING) WHEN fmt = 7 THEN 'C' || CAST(sess AS STRING) END AS e_session,
    CASE WHEN bad THEN 0 WHEN fmt IN (0, 4, 5, 7, 8, 10) THEN in_bytes ELSE 0 END AS e_in,
    CASE WHEN bad THEN 0 WHEN fmt IN (0, 4, 5, 7, 8, 10) THEN out_bytes ELSE 0 END AS e_out,
    CASE WHEN bad THEN 0 WHEN fmt = 0 THEN in_bytes + out_bytes + 1 WHEN fmt IN (4, 5, 7, 8) THEN in_bytes + out_bytes
        WHEN fmt IN (6, 9, 10) THEN out_bytes ELSE 0 END AS e_total,
    CASE WHEN fmt IN (0, 4, 7) THEN dur ELSE 0 END AS e_dur,
    CASE WHEN bad OR fmt IN (7, 11) THEN 'Unknown' WHEN fmt = 1 THEN 'Allowed' WHEN fmt = 2 THEN 'Blocked'
        WHEN fmt = 3 THEN CASE WHEN {_FAILED} THEN 'Blocked' ELSE 'Allowed' END
        WHEN fmt IN (5, 6) THEN CASE WHEN user_id % 2 = 0 THEN 'Allowed' ELSE 'Blocked' END
        ELSE {_DISPOSITION} END AS vendor_disposition,
    CASE WHEN bad THEN NULL WHEN fmt = 1 THEN '6' WHEN fmt = 2 THEN '4' WHEN fmt = 3 THEN CASE WHEN {_FAILED} THEN '4' ELSE '5' END
        WHEN fmt = 4 THEN nullif(level, '') WHEN fmt = 5 THEN nullif(CAST(user_id % 4 AS STRING), '0')
        WHEN fmt = 8 THEN cef_level WHEN fmt = 9 THEN 'Critical' WHEN fmt = 10 THEN '4' END AS e_vendor_severity,
    CASE WHEN fmt = 1 THEN '302013' WHEN fmt = 2 THEN '106023' WHEN fmt = 3 THEN CASE WHEN {_FAILED} THEN 'LOGIN_FAILED' ELSE 'LOGIN_SUCCESS' END
        WHEN fmt = 5 THEN CAST(2010000 + user_id AS STRING) WHEN fmt = 8 THEN 'pkt-7' WHEN fmt = 9 THEN 'ALERT' END AS v_sig,
    CASE WHEN fmt = 5 THEN sig_name WHEN fmt = 8 THEN cef_name END AS v_sig_name,
    CASE WHEN bad THEN NULL WHEN fmt = 0 THEN 'web-browsing' WHEN fmt = 4 THEN 'HTTPS' WHEN fmt = 5 THEN 'http' WHEN fmt = 6 THEN proto_name
        WHEN fmt = 7 THEN 'dns' WHEN fmt = 8 THEN 'ssh' WHEN fmt <> 11 AND dport = 22 THEN 'ssh' END AS e_app,
    CASE fmt WHEN 0 THEN '2024/01/01 00:00:00' WHEN 3 THEN '2024 Jan 01 13:05:59.417 UTC' WHEN 4 THEN '10:00:00'
        WHEN 5 THEN '2024-01-01T00:00:00' WHEN 7 THEN '1704067200.' || CAST(event_id AS STRING) END AS e_time,
    CASE WHEN fmt = 0 THEN 22 + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END WHEN fmt IN (1, 2) THEN 7 WHEN fmt IN (3, 5) THEN 5
        WHEN fmt = 4 THEN 6 WHEN fmt = 6 THEN 15 WHEN fmt = 7 THEN 0 WHEN fmt IN (8, 9) THEN 4
        WHEN fmt = 10 THEN CASE WHEN bad THEN 1 ELSE 2 END WHEN {_SYSLOG} THEN 1 ELSE 0 END AS n_unmapped,
    CASE WHEN fmt = 0 THEN 38 + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END WHEN fmt IN (1, 2) THEN 18 WHEN fmt = 3 THEN 10
        WHEN fmt IN (4, 5) THEN 20 WHEN fmt = 6 THEN 22 WHEN fmt IN (7, 10) THEN 12 WHEN fmt = 8 THEN 16 WHEN fmt = 9 THEN 13
        WHEN {_SYSLOG} THEN 1 ELSE 0 END AS n_fields,
    CASE WHEN fmt = 0 THEN 134 WHEN fmt = 1 THEN 166 WHEN fmt = 2 THEN 164 WHEN fmt = 4 THEN 189 WHEN fmt = 6 THEN 134
        WHEN fmt = 10 THEN 13 WHEN {_SYSLOG} THEN 13 END AS pri
    FROM step1)"""

_STEP3 = """step3 AS (SELECT *,
    CASE e_proto WHEN 'TCP' THEN 6 WHEN 'UDP' THEN 17 WHEN 'ICMP' THEN 1 WHEN 'GRE' THEN 47 WHEN 'IP-99' THEN 99 END AS e_proto_num,
    CASE WHEN v_sig IS NULL AND e_src_ip IS NOT NULL THEN
        CASE WHEN src_kind = 0 THEN 'IOC-TOR-EXIT' WHEN src_kind = 5 THEN 'IOC-LOG4J-PROBE' WHEN dst_kind = 2 THEN 'IOC-MIRAI-SCANNER' END
    END AS ioc,
    CASE WHEN e_src_ip IS NOT NULL THEN src_kind IN (1, 2, 6) END AS src_int,
    CASE WHEN e_dst_ip IS NOT NULL THEN dst_kind IN (0, 1, 5) END AS dst_int,
    CASE WHEN e_src_ip IS NULL THEN NULL ELSE CASE src_kind WHEN 0 THEN 'DE' WHEN 4 THEN 'US' WHEN 5 THEN 'US' WHEN 7 THEN 'US'
        WHEN 8 THEN 'GLOBAL' ELSE 'INTERNAL' END END AS src_country,
    CASE WHEN e_src_ip IS NULL THEN NULL ELSE CASE src_kind WHEN 0 THEN 'Frankfurt' WHEN 4 THEN 'Mountain View' WHEN 5 THEN 'Fremont'
        WHEN 7 THEN 'San Francisco' WHEN 8 THEN 'External' ELSE 'LAN' END END AS src_city,
    CASE WHEN e_src_ip IS NULL THEN NULL ELSE CASE src_kind WHEN 0 THEN 'AS205100 Tor Exit Relay' WHEN 4 THEN 'AS15169 Google LLC'
        WHEN 5 THEN 'AS63949 Linode LLC' WHEN 7 THEN 'AS13335 Cloudflare Inc' WHEN 8 THEN 'Public Internet'
        ELSE 'Private Network (RFC 1918)' END END AS src_asn,
    CASE WHEN e_dst_ip IS NULL THEN NULL ELSE CASE dst_kind WHEN 2 THEN 'RU' WHEN 3 THEN 'AU' WHEN 4 THEN 'US' ELSE 'INTERNAL' END END AS dst_country,
    CASE WHEN e_dst_ip IS NULL THEN NULL ELSE CASE dst_kind WHEN 2 THEN 'Moscow' WHEN 3 THEN 'Sydney' WHEN 4 THEN 'Ashburn' ELSE 'LAN' END END AS dst_city,
    CASE WHEN e_dst_ip IS NULL THEN NULL ELSE CASE dst_kind WHEN 2 THEN 'AS57523 Suspicious Scanner Range' WHEN 3 THEN 'AS13335 Cloudflare Inc'
        WHEN 4 THEN 'AS16509 Amazon.com Inc' ELSE 'Private Network (RFC 1918)' END END AS dst_asn,
    CASE coalesce(e_vendor_severity, '') WHEN '4' THEN 'Medium' WHEN '5' THEN 'Low' WHEN 'notice' THEN 'Low' WHEN 'warning' THEN 'Medium'
        WHEN 'error' THEN 'High' WHEN 'critical' THEN 'Critical' WHEN 'Critical' THEN 'Critical' WHEN '1' THEN 'Critical'
        WHEN '2' THEN 'Critical' WHEN '3' THEN 'High' WHEN 'High' THEN 'High' WHEN 'Low' THEN 'Low'
        ELSE 'Informational' END AS base_severity
    FROM step2)"""

_TAG = "' [Air-Gapped Enclave Cache (Strict Offline)]'"
_STEP4 = f"""expected AS (SELECT *,
    CASE WHEN ioc IS NOT NULL AND vendor_disposition = 'Unknown' THEN 'Alerted' ELSE vendor_disposition END AS e_disposition,
    CASE WHEN ioc IS NOT NULL AND base_severity IN ('Informational', 'Low') THEN 'High' ELSE base_severity END AS e_severity,
    coalesce(v_sig, ioc) AS threat_id,
    coalesce(v_sig_name, CASE ioc WHEN 'IOC-TOR-EXIT' THEN 'Traffic Originating from Known Tor Exit Node' || {_TAG}
        WHEN 'IOC-LOG4J-PROBE' THEN 'Exploitation Probe: Apache Log4j RCE (Log4Shell)' || {_TAG}
        WHEN 'IOC-MIRAI-SCANNER' THEN 'Mirai Botnet Telnet/SSH Scanner' || {_TAG} END) AS threat_name,
    CASE WHEN fmt = 5 THEN 'Misc' ELSE CASE ioc WHEN 'IOC-TOR-EXIT' THEN 'Anonymization Network'
        WHEN 'IOC-LOG4J-PROBE' THEN 'Exploit Attempt' WHEN 'IOC-MIRAI-SCANNER' THEN 'Botnet Activity' END END AS threat_category,
    CASE ioc WHEN 'IOC-TOR-EXIT' THEN CAST(0.95 AS DOUBLE) WHEN 'IOC-LOG4J-PROBE' THEN CAST(0.92 AS DOUBLE)
        WHEN 'IOC-MIRAI-SCANNER' THEN CAST(0.99 AS DOUBLE) END AS threat_confidence,
    CASE ioc WHEN 'IOC-TOR-EXIT' THEN '185.220.101.5' WHEN 'IOC-LOG4J-PROBE' THEN '45.33.32.156'
        WHEN 'IOC-MIRAI-SCANNER' THEN '194.26.29.112' END AS threat_indicator,
    CASE WHEN e_src_ip IS NULL OR e_dst_ip IS NULL THEN 'Unknown' WHEN src_int AND dst_int THEN 'Lateral'
        WHEN src_int THEN 'Outbound' WHEN dst_int THEN 'Inbound' ELSE 'External' END AS e_direction,
    e_src_ip IS NOT NULL OR fmt = 11 AS known
    FROM step3)"""

# Blocking verdicts and the risk terms, used by several oracles.
_STEP5 = """scored AS (SELECT *,
    e_disposition IN ('Blocked', 'Dropped', 'Reset') AS blocked,
    threat_id IS NOT NULL AS has_threat,
    coalesce(e_dport, 0) AS port
    FROM expected),
risky AS (SELECT *,
    least(100, 15 + CASE WHEN has_threat THEN 50 ELSE 0 END + CASE WHEN blocked THEN 20 ELSE 0 END
      + CASE WHEN port IN (3389, 22, 23, 445, 139) THEN 15 ELSE 0 END
      + CASE WHEN e_direction = 'Inbound' THEN 10 ELSE 0 END
      + CASE WHEN e_out > 20000 AND CAST(e_out AS DOUBLE) / (e_in + 1) > 2.5 THEN 15 ELSE 0 END) AS score,
    CASE WHEN has_threat AND (lower(coalesce(threat_name, '')) LIKE '%scan%' OR port IN (23, 2323)) THEN 'T1046'
      WHEN port = 3389 AND blocked THEN 'T1021.001' WHEN port = 22 AND blocked THEN 'T1021.004'
      WHEN has_threat AND lower(coalesce(threat_name, '')) LIKE '%tor%' THEN 'T1090.003'
      WHEN e_out > 50000 AND CAST(e_out AS DOUBLE) / (e_in + 1) > 3.0 THEN 'T1048'
      WHEN port IN (80, 443, 8080) THEN 'T1071.001' ELSE 'T1562.004' END AS technique
    FROM scored)"""

EXPECTED_CTE = f"WITH {SEED_CTE},\n{_STEP1},\n{_STEP2},\n{_STEP3},\n{_STEP4},\n{_STEP5}"
