"""Registered queries: each operator over whole tables, with its oracle.

A query takes ``(spark, sf_dir)``.  Most oracles select from the ``risky`` step of
``EXPECTED_CTE``, which knows the right answer without parsing anything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.functions import net
from rampart.functions.session import fresh_path, stored
from rampart.functions.text import strip
from rampart.operators import enrich, export, features, report, risk, search
from rampart.operators.classify import with_parser
from rampart.operators.extract import with_fields
from rampart.operators.normalize import normalize, verify_integrity
from rampart.plans.expected import EXPECTED_CTE
from rampart.plans.lines import SEED_CTE, table, with_lines
from rampart.plans.lines import lines as derived_lines
from rampart.schema import LAKE_COLUMNS
from rampart.sinks import writers
from rampart.sources import readers
from rampart.specs import parser_catalog, shipped_specs
from rampart.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a query under its function name; ``oracle`` selects from the CTEs."""

    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def expect(select: str) -> str:
    return f"{EXPECTED_CTE}\n{select}"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived lines, dealt to all cores."""
    return derived_lines(spark, sf_dir, spark.sparkContext.defaultParallelism)


def events(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Canonical events of all derived lines, with repeatable ids and times."""
    return normalize(
        lines(spark, sf_dir),
        id_cols=["event_id"],
        keep=["event_id"],
        ingested_at=F.timestamp_seconds(F.lit(1704067200) + F.col("event_id")),
        **options,
    )


# ------------------------------------------------------------------ classification
# The signatures in their order, as the classifier has them.
_LADDER = r"""CASE
  WHEN x = '' THEN 'generic_raw'
  WHEN regexp_matches(x, 'CEF:\s*\d+\|') THEN 'generic_cef'
  WHEN regexp_matches(x, 'LEEF:\s*[\d\.]+\|') THEN 'generic_leef'
  WHEN regexp_matches(x, '%ASA-\d+-\d+:') OR regexp_matches(x, '%FTD-\d+-\d+:') THEN 'cisco_asa'
  WHEN regexp_matches(x, '%[A-Z0-9_]+-\d+-[A-Z0-9_]+:') THEN 'cisco_ios'
  WHEN (starts_with(x, '{') OR contains(x, '"event_type"'))
    AND regexp_matches(x, '"event_type"\s*:\s*"(alert|flow|dns|http|tls|netflow)"') THEN 'suricata_eve'
  WHEN (starts_with(x, '{') OR contains(x, '"event_type"')) AND contains(x, '"src_ip"') AND contains(x, '"dest_ip"') THEN 'generic_json'
  WHEN regexp_matches(x, 'devname=|logid=|type=["'']?traffic|subtype=["'']?forward') THEN 'fortinet_fortios'
  WHEN regexp_matches(x, 'filterlog(:|\[\d+\]:)?\s*\d+,\d+,|,\d+,[a-zA-Z0-9_-]+,match,') OR contains(x, 'filterlog:') OR contains(x, 'filterlog[') THEN 'pfsense_filterlog'
  WHEN regexp_matches(x, '\[\*\*\]\s*\[\d+:\d+:\d+\]') THEN 'snort_fast'
  WHEN regexp_matches(x, '^#separator\s+|^\d+\.\d+\t\w+\t[\d\.]+\t\d+\t[\d\.]+\t\d+') OR length(x) - length(replace(x, chr(9), '')) >= 8 THEN 'zeek_conn'
  WHEN contains(x, ',TRAFFIC,') OR contains(x, ',THREAT,') OR contains(x, ',SYSTEM,') THEN 'palo_alto_traffic'
  WHEN length(x) - length(replace(x, ',', '')) >= 15 AND regexp_matches(x, '\d{4}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2}') THEN 'palo_alto_traffic'
  WHEN length(x) - length(replace(x, '=', '')) >= 4 AND (contains(x, ' ') OR contains(x, ',')) THEN 'generic_kv'
  WHEN starts_with(x, '<') AND contains(substr(x, 1, 5), '>') THEN 'generic_syslog'
  ELSE 'generic_raw' END"""
_DUCK_STRIP = r"regexp_replace(text, '^[\s\x{85}\x{A0}\x0b\x1c-\x1f\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1680}]+|[\s\x{85}\x{A0}\x0b\x1c-\x1f\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1680}]+$', '', 'g')"


@query(expect("SELECT event_id, parser AS parser_id, confidence FROM expected"))
def classify(spark, sf_dir):
    return with_parser(lines(spark, sf_dir), shipped_specs()).select("event_id", "parser_id", "confidence")


@query(f"WITH d AS (SELECT doc_id, {_DUCK_STRIP} AS x FROM documents) SELECT doc_id, {_LADDER} AS parser_id FROM d")
def classify_prose(spark, sf_dir):
    """Whole documents as single 'lines': text that is no log at all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", strip(F.col("text")).alias("raw_event"))
    return with_parser(docs, shipped_specs()).select("doc_id", "parser_id")


@query(f"""WITH d AS (SELECT {_DUCK_STRIP.replace('text', 'html')} AS x FROM pages)
SELECT {_LADDER} AS parser_id, count(*) AS pages FROM d GROUP BY 1""")
def classify_pages_histogram(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(strip(F.col("html")).alias("raw_event"))
    return with_parser(pages, shipped_specs()).groupBy("parser_id").agg(F.count("*").alias("pages"))


@query(expect("SELECT parser AS parser_id, count(*) AS lines, min(confidence) AS confidence FROM expected GROUP BY 1"))
def classify_histogram(spark, sf_dir):
    routed = with_parser(lines(spark, sf_dir), shipped_specs())
    return routed.groupBy("parser_id").agg(
        F.count("*").alias("lines"), F.min("confidence").alias("confidence")
    )


@query(expect("""SELECT event_id, CASE WHEN bad THEN NULL WHEN fmt IN (4, 8, 10) OR event_id % 36 = 9 THEN src_ip
WHEN fmt = 9 THEN substr(line, strpos(line, 'src=') + 4) END AS src_ip, CAST(1.0 AS DOUBLE) AS confidence FROM expected"""))
def forced_parser(spark, sf_dir):
    """Every line read as generic key=value, whatever it is."""
    forced = normalize(lines(spark, sf_dir), parser_id="generic_kv", keep=["event_id"], details=True)
    return forced.select("event_id", F.col("src_endpoint.ip").alias("src_ip"), "confidence")


@query(expect("SELECT event_id, parser_id, vendor FROM expected WHERE fmt = 11"))
def fallback_parser(spark, sf_dir):
    """Lines whose detected parser has no spec, or only the generic one."""
    found = events(spark, sf_dir).where("lineage.parser_id IN ('generic_raw', 'generic_syslog')")
    return found.select("event_id", "lineage.parser_id", F.col("product.vendor_name").alias("vendor"))


# --------------------------------------------------------------------- extraction
@query(expect("""SELECT event_id, CAST(pri AS INTEGER) AS pri, CAST(floor(pri / 8) AS INTEGER) AS facility, CAST(pri % 8 AS INTEGER) AS severity
FROM expected WHERE pri IS NOT NULL"""))
def syslog_pri(spark, sf_dir):
    meta = F.col("syslog_meta")
    parsed = events(spark, sf_dir, details=True).where(meta.isNotNull())
    return parsed.select(
        "event_id",
        meta["syslog_pri"].alias("pri"),
        meta["syslog_facility"].alias("facility"),
        meta["syslog_severity"].alias("severity"),
    )


def extracted(spark: SparkSession, sf_dir: str, parser_id: str) -> DataFrame:
    routed = with_parser(lines(spark, sf_dir), shipped_specs()).where(F.col("parser_id") == parser_id)
    parsed = with_fields(routed, shipped_specs())
    return parsed.where(F.col("parser_id") == parser_id)


def tokens(spark: SparkSession, sf_dir: str, parser_id: str, names: list[str], where: str = "true") -> DataFrame:
    return extracted(spark, sf_dir, parser_id).where(where).select(
        "event_id",
        *[F.col("fields")[name].alias(name.replace(".", "_")) for name in names],
        F.size("fields").alias("n_fields"),
    )


def _text(*names: str) -> str:
    return ", ".join(f"CAST({name} AS VARCHAR)" for name in names)


@query(expect("""SELECT event_id, src_ip AS srcip, CAST(sport AS VARCHAR) AS srcport, verb AS action, nullif(level, '') AS level,
'FGT-1' AS devname, 'root2' AS vd, CAST(NULL AS VARCHAR) AS note, CAST(20 AS INTEGER) AS n_fields FROM expected WHERE fmt = 4"""))
def extract_key_value(spark, sf_dir):
    names = ["srcip", "srcport", "action", "level", "devname", "vd", "note"]
    return tokens(spark, sf_dir, "fortinet_fortios", names)


@query(expect("""SELECT event_id, '0' AS cef_version, 'Acme Networks' AS device_vendor, cef_name AS event_name, cef_level AS severity,
verb AS act, CAST(in_bytes AS VARCHAR) AS "in", 'ssh' AS app, CAST(16 AS INTEGER) AS n_fields FROM expected WHERE fmt = 8"""))
def extract_cef(spark, sf_dir):
    names = ["cef_version", "device_vendor", "event_name", "severity", "act", "in", "app"]
    return tokens(spark, sf_dir, "generic_cef", names)


@query(expect("""SELECT event_id, '2.0' AS leef_version, 'ALERT' AS event_id_token, src_ip AS src, CAST(sport AS VARCHAR) AS "srcPort",
verb AS action, CAST(out_bytes AS VARCHAR) AS "totalBytes", CAST(13 AS INTEGER) AS n_fields FROM expected WHERE fmt = 9"""))
def extract_leef(spark, sf_dir):
    names = {"leef_version": "leef_version", "event_id": "event_id_token", "src": "src", "srcPort": "srcPort", "action": "action", "totalBytes": "totalBytes"}
    return extracted(spark, sf_dir, "generic_leef").select(
        "event_id",
        *[F.col("fields")[name].alias(alias) for name, alias in names.items()],
        F.size("fields").alias("n_fields"),
    )


@query(expect("""SELECT event_id, CAST(sess AS VARCHAR) AS flow_id, CAST(sport AS VARCHAR) AS src_port, sig_name AS alert_signature,
CAST(user_id % 4 AS VARCHAR) AS alert_severity, CAST(in_bytes AS VARCHAR) AS flow_bytes_toclient,
CAST(20 AS INTEGER) AS n_fields FROM expected WHERE fmt = 5"""))
def extract_json(spark, sf_dir):
    names = ["flow_id", "src_port", "alert.signature", "alert.severity", "flow.bytes_toclient"]
    return tokens(spark, sf_dir, "suricata_eve", names)


@query(expect("""SELECT event_id, rule AS rule_name, '' AS src_user, 'trust' AS dst_zone, verb AS action, CAST(dur AS VARCHAR) AS elapsed,
CASE WHEN event_id % 7 = 0 THEN 'x1' END AS extra_col_38, CAST(n_fields AS INTEGER) AS n_fields FROM expected WHERE fmt = 0"""))
def extract_csv(spark, sf_dir):
    names = ["rule_name", "src_user", "dst_zone", "action", "elapsed", "extra_col_38"]
    return tokens(spark, sf_dir, "palo_alto_traffic", names)


@query(expect("""SELECT event_id, '6' AS severity_digit, 'Built' AS action_verb, 'outbound' AS direction_word, CAST(sess AS VARCHAR) AS conn_id,
dst_ip, src_ip, CAST(sport AS VARCHAR) AS src_port, CAST(NULL AS VARCHAR) AS src_ip2, CAST(18 AS INTEGER) AS n_fields FROM expected WHERE fmt = 1"""))
def extract_regex_asa_built(spark, sf_dir):
    names = ["severity_digit", "action_verb", "direction_word", "conn_id", "dst_ip", "src_ip", "src_port", "src_ip2"]
    return tokens(spark, sf_dir, "cisco_asa", names, "fields['action_verb'] = 'Built'")


@query(expect("""SELECT event_id, 'Deny' AS action_verb, CAST(NULL AS VARCHAR) AS direction_word, CAST(NULL AS VARCHAR) AS src_ip, src_ip AS src_ip2,
CAST(dport AS VARCHAR) AS dst_port2, 'inside' AS dst_zone2, CAST(18 AS INTEGER) AS n_fields FROM expected WHERE fmt = 2"""))
def extract_regex_asa_deny(spark, sf_dir):
    names = ["action_verb", "direction_word", "src_ip", "src_ip2", "dst_port2", "dst_zone2"]
    return tokens(spark, sf_dir, "cisco_asa", names, "fields['action_verb'] = 'Deny'")


@query(expect("""SELECT event_id, '009077' AS seq_num, CASE WHEN event_id % 24 = 3 THEN 'LOGIN_FAILED' ELSE 'LOGIN_SUCCESS' END AS mnemonic,
CASE WHEN event_id % 24 = 3 THEN 'Login failed' ELSE 'Login Success' END AS message, 'u' || CAST(user_id AS VARCHAR) AS "user", src_ip,
CASE WHEN event_id % 24 = 3 THEN 'Authentication Failure' END AS reason, CAST(10 AS INTEGER) AS n_fields FROM expected WHERE fmt = 3"""))
def extract_regex_ios(spark, sf_dir):
    return tokens(spark, sf_dir, "cisco_ios", ["seq_num", "mnemonic", "message", "user", "src_ip", "reason"])


@query(expect("""SELECT event_id, '4' AS rule, '' AS sub_rule, '' AS anchor, proto_name, CAST(out_bytes AS VARCHAR) AS length, src_ip,
CAST(dport AS VARCHAR) AS dst_port, CAST(22 AS INTEGER) AS n_fields FROM expected WHERE fmt = 6"""))
def extract_regex_pfsense(spark, sf_dir):
    return tokens(spark, sf_dir, "pfsense_filterlog", ["rule", "sub_rule", "anchor", "proto_name", "length", "src_ip", "dst_port"])


@query(expect("""SELECT event_id, 'C' || CAST(sess AS VARCHAR) AS uid, src_ip, CAST(dur AS VARCHAR) || '.75' AS duration,
CAST(out_bytes AS VARCHAR) AS orig_bytes, 'SF' AS conn_state, CAST(12 AS INTEGER) AS n_fields FROM expected WHERE fmt = 7"""))
def extract_regex_zeek(spark, sf_dir):
    return tokens(spark, sf_dir, "zeek_conn", ["uid", "src_ip", "duration", "orig_bytes", "conn_state"])


@query(expect("""SELECT event_id, substr(line, 5) AS message FROM expected WHERE fmt = 11 AND event_id % 24 = 11"""))
def extract_syslog_message(spark, sf_dir):
    only = extracted(spark, sf_dir, "generic_syslog")
    return only.select("event_id", F.col("fields")["message"].alias("message"))


# ------------------------------------------------------------------ normalization
@query(expect("""SELECT event_id, e_src_ip AS src_ip, CAST(e_sport AS INTEGER) AS src_port, e_src_zone AS src_zone,
e_dst_ip AS dst_ip, CAST(e_dport AS INTEGER) AS dst_port, e_dst_zone AS dst_zone FROM expected"""))
def normalize_endpoints(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        *[F.col(f"{side}_endpoint.{part}").alias(f"{side}_{part}") for side in ("src", "dst") for part in ("ip", "port", "zone")],
    )


@query(expect("SELECT event_id, e_proto AS protocol_name, CAST(e_proto_num AS INTEGER) AS protocol_num, e_session AS session_id FROM expected"))
def normalize_protocol(spark, sf_dir):
    c = "connection_info"
    return events(spark, sf_dir).select("event_id", f"{c}.protocol_name", f"{c}.protocol_num", f"{c}.session_id")


@query(expect("""SELECT event_id, CAST(e_in AS BIGINT) AS bytes_in, CAST(e_out AS BIGINT) AS bytes_out, CAST(e_total AS BIGINT) AS total_bytes,
CAST(0 AS BIGINT) AS packets_in, CAST(0 AS BIGINT) AS total_packets, CAST(e_dur AS BIGINT) AS duration_ms FROM expected"""))
def normalize_traffic(spark, sf_dir):
    names = ["bytes_in", "bytes_out", "total_bytes", "packets_in", "total_packets", "duration_ms"]
    return events(spark, sf_dir).select("event_id", *[f"traffic.{n}" for n in names])


@query(expect("SELECT event_id, e_disposition AS disposition FROM expected"))
def normalize_action(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "disposition")


@query(expect("SELECT event_id, e_severity AS severity, e_vendor_severity AS vendor_severity FROM expected"))
def normalize_severity(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "severity", "vendor_severity")


@query(expect("SELECT event_id, e_app AS app_name, e_time AS event_timestamp FROM expected"))
def normalize_app_and_time(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "app_name", "lineage.event_timestamp")


@query(expect("""SELECT event_id, vendor AS vendor_name, product AS product_name, parser_id, 'ocsf-1.2.0-network' AS schema_version FROM expected"""))
def normalize_lineage(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "product.vendor_name", "product.product_name", "lineage.parser_id", "lineage.schema_version")


@query(expect("SELECT event_id, threat_id, threat_name, threat_category, threat_indicator, threat_confidence FROM expected"))
def normalize_threat(spark, sf_dir):
    parts = {"signature_id": "threat_id", "signature_name": "threat_name", "category": "threat_category", "indicator_matched": "threat_indicator", "confidence_score": "threat_confidence"}
    return events(spark, sf_dir).select("event_id", *[F.col(f"threat.{k}").alias(v) for k, v in parts.items()])


@query(expect("""SELECT event_id, CAST(n_unmapped AS INTEGER) AS n_unmapped,
CASE WHEN fmt = 10 AND NOT bad THEN 'a b' END AS custom_tag, CASE WHEN fmt = 10 AND NOT bad THEN '9.9.9.9' END AS saddr,
CASE WHEN fmt = 0 THEN rule END AS rule_name, CASE WHEN fmt = 4 THEN CAST(user_id % 20 AS VARCHAR) END AS policyid,
CASE WHEN bad THEN 'cannot convert float infinity to integer' END AS parse_error FROM expected"""))
def unmapped_retention(spark, sf_dir):
    names = ["custom_tag", "saddr", "rule_name", "policyid", "parse_error"]
    return events(spark, sf_dir).select(
        "event_id", F.size("unmapped").alias("n_unmapped"), *[F.col("unmapped")[n].alias(n) for n in names]
    )


@query(expect("SELECT event_id, sha256(line) AS raw_hash, true AS verified FROM expected"))
def raw_hash_integrity(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "lineage.raw_hash", verify_integrity().alias("verified"))


@query(expect("""SELECT event_id, NOT bad AS is_valid, CASE WHEN bad THEN 'cannot convert float infinity to integer' END AS error,
line AS raw_event FROM expected"""))
def error_capture(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", "lineage.is_valid", F.get("lineage.validation_errors", F.lit(0)).alias("error"), "raw_event"
    )


# --------------------------------------------------------------------- enrichment
@query(f"""WITH {SEED_CTE} SELECT event_id, CASE src_kind WHEN 0 THEN 'IOC-TOR-EXIT' WHEN 5 THEN 'IOC-LOG4J-PROBE'
ELSE CASE WHEN dst_kind = 2 THEN 'IOC-MIRAI-SCANNER' END END AS signature_id,
CASE src_kind WHEN 0 THEN src_ip WHEN 5 THEN src_ip ELSE CASE WHEN dst_kind = 2 THEN dst_ip END END AS indicator_matched FROM seed""")
def ioc_join(spark, sf_dir):
    """Indicator lookup as two joins with an indicator table."""
    pairs = addresses(spark, sf_dir)
    hits = enrich.with_indicator(pairs, enrich.indicator_table(spark))
    return hits.select("event_id", "indicator.signature_id", "indicator.indicator_matched")


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rampart.plans.lines import SEED

    source = table(spark, sf_dir, "events")
    return source.select("event_id", *[F.expr(SEED[name]).alias(name) for name in ("src_ip", "dst_ip")])


_PLACES = """SELECT event_id, src_is_internal, dst_is_internal, src_country, src_city, src_asn, dst_country, dst_city, dst_asn, direction FROM (
SELECT event_id, src_kind IN (1, 2, 6) AS src_is_internal, dst_kind IN (0, 1, 5) AS dst_is_internal,
CASE src_kind WHEN 0 THEN 'DE' WHEN 4 THEN 'US' WHEN 5 THEN 'US' WHEN 7 THEN 'US' WHEN 8 THEN 'GLOBAL' ELSE 'INTERNAL' END AS src_country,
CASE src_kind WHEN 0 THEN 'Frankfurt' WHEN 4 THEN 'Mountain View' WHEN 5 THEN 'Fremont' WHEN 7 THEN 'San Francisco' WHEN 8 THEN 'External' ELSE 'LAN' END AS src_city,
CASE src_kind WHEN 0 THEN 'AS205100 Tor Exit Relay' WHEN 4 THEN 'AS15169 Google LLC' WHEN 5 THEN 'AS63949 Linode LLC' WHEN 7 THEN 'AS13335 Cloudflare Inc' WHEN 8 THEN 'Public Internet' ELSE 'Private Network (RFC 1918)' END AS src_asn,
CASE dst_kind WHEN 2 THEN 'RU' WHEN 3 THEN 'AU' WHEN 4 THEN 'US' ELSE 'INTERNAL' END AS dst_country,
CASE dst_kind WHEN 2 THEN 'Moscow' WHEN 3 THEN 'Sydney' WHEN 4 THEN 'Ashburn' ELSE 'LAN' END AS dst_city,
CASE dst_kind WHEN 2 THEN 'AS57523 Suspicious Scanner Range' WHEN 3 THEN 'AS13335 Cloudflare Inc' WHEN 4 THEN 'AS16509 Amazon.com Inc' ELSE 'Private Network (RFC 1918)' END AS dst_asn,
CASE WHEN src_kind IN (1, 2, 6) AND dst_kind IN (0, 1, 5) THEN 'Lateral' WHEN src_kind IN (1, 2, 6) THEN 'Outbound' WHEN dst_kind IN (0, 1, 5) THEN 'Inbound' ELSE 'External' END AS direction
FROM seed)"""


@query(f"WITH {SEED_CTE} {_PLACES}")
def geo_range_join(spark, sf_dir):
    """Place lookup as block joins with a network table."""
    index = enrich.place_index(enrich.place_table(spark))
    return enrich.with_network_context(addresses(spark, sf_dir), index).drop("src_ip", "dst_ip")


@query(f"WITH {SEED_CTE} {_PLACES}")
def geo_shipped(spark, sf_dir):
    """The same with the shipped networks as literals."""
    return enrich.with_network_context(addresses(spark, sf_dir)).drop("src_ip", "dst_ip")


@query(expect("SELECT event_id, src_int AS src_internal, dst_int AS dst_internal, e_direction AS direction, src_country, dst_country, src_asn FROM expected"))
def normalize_direction(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        F.col("src_endpoint.is_internal").alias("src_internal"),
        F.col("dst_endpoint.is_internal").alias("dst_internal"),
        "connection_info.direction",
        F.col("src_endpoint.country").alias("src_country"),
        F.col("dst_endpoint.country").alias("dst_country"),
        F.col("src_endpoint.asn").alias("src_asn"),
    )


@query(f"""WITH {SEED_CTE} SELECT event_id, CAST(split_part(src_ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(src_ip, '.', 2) AS BIGINT) * 65536
+ CAST(split_part(src_ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(src_ip, '.', 4) AS BIGINT) AS address FROM seed""")
def ip_to_number(spark, sf_dir):
    return addresses(spark, sf_dir).select("event_id", F.expr(net.ipv4_long_sql("src_ip")).alias("address"))


# -------------------------------------------------------------- derived analytics
_FEATURES = """SELECT event_id, CAST(coalesce(e_sport, 0) AS DOUBLE) AS src_port, CAST(port AS DOUBLE) AS dst_port,
CAST(port > 0 AND port < 1024 AS DOUBLE) AS is_well_known_port, CAST(coalesce(e_sport, 0) >= 49152 AS DOUBLE) AS is_ephemeral_src_port,
CAST(coalesce(src_int, false) AS DOUBLE) AS is_internal_src, CAST(coalesce(dst_int, false) AS DOUBLE) AS is_internal_dst,
CAST(e_direction = 'Inbound' AS DOUBLE) AS direction_inbound, CAST(e_direction = 'Outbound' AS DOUBLE) AS direction_outbound,
CAST(e_direction = 'Lateral' AS DOUBLE) AS direction_lateral, CAST(e_direction = 'External' AS DOUBLE) AS direction_external,
CAST(e_proto = 'TCP' AS DOUBLE) AS proto_tcp, CAST(e_proto = 'UDP' AS DOUBLE) AS proto_udp, CAST(e_proto = 'ICMP' AS DOUBLE) AS proto_icmp,
CAST(e_proto NOT IN ('TCP', 'UDP', 'ICMP') AS DOUBLE) AS proto_other,
round_even(ln(1 + e_in), 4) AS bytes_in_log, round_even(ln(1 + e_out), 4) AS bytes_out_log,
round_even(ln(1 + CASE WHEN e_total <> 0 THEN e_total ELSE e_in + e_out END), 4) AS total_bytes_log,
round_even(ln(1 + e_out) / (ln(1 + e_in) + 1.0), 4) AS bytes_ratio_out_in, CAST(0 AS DOUBLE) AS packets_total_log,
round_even(CAST(e_dur AS DOUBLE) / 1000, 4) AS duration_sec,
round_even(CAST(e_total AS DOUBLE) / (CAST(e_dur AS DOUBLE) / 1000 + CAST(0.001 AS DOUBLE)), 2) AS bytes_per_second,
CAST(blocked AS DOUBLE) AS action_blocked, CAST(e_disposition = 'Allowed' AS DOUBLE) AS action_allowed,
CASE e_severity WHEN 'Low' THEN CAST(1 AS DOUBLE) WHEN 'Medium' THEN CAST(2 AS DOUBLE) WHEN 'High' THEN CAST(3 AS DOUBLE) WHEN 'Critical' THEN CAST(4 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS severity_level,
CAST(has_threat AS DOUBLE) AS threat_flag, coalesce(threat_confidence, CAST(0 AS DOUBLE)) AS threat_confidence FROM risky"""


@query(expect(_FEATURES))
def feature_matrix(spark, sf_dir):
    return features.feature_matrix(events(spark, sf_dir), "event_id")


@query(expect(f"SELECT vendor, count(*) AS events, CAST(26 AS INTEGER) AS width, sum(src_port) AS port_sum FROM (SELECT r.vendor, f.* FROM ({_FEATURES}) f JOIN risky r USING (event_id)) GROUP BY 1"))
def feature_vector(spark, sf_dir):
    vectors = features.with_feature_vector(events(spark, sf_dir))
    return vectors.groupBy(F.col("product.vendor_name").alias("vendor")).agg(
        F.count("*").alias("events"),
        F.max(F.size("features")).alias("width"),
        F.sum(F.get("features", F.lit(0))).alias("port_sum"),
    )


_TECHNIQUE_ROWS = ", ".join(
    f"('{technique}', '{tactic_name}', '{name}', '{url}')" for _, tactic_name, technique, name, url in risk.TECHNIQUES.values()
)


@query(expect(f"""SELECT event_id, technique AS technique_id, CASE technique WHEN 'T1046' THEN 'TA0043' WHEN 'T1021.001' THEN 'TA0001' WHEN 'T1021.004' THEN 'TA0001'
WHEN 'T1090.003' THEN 'TA0011' WHEN 'T1048' THEN 'TA0010' WHEN 'T1071.001' THEN 'TA0011' ELSE 'TA0005' END AS tactic_id,
t.technique_name, t.tactic_name, t.url FROM risky JOIN (VALUES {_TECHNIQUE_ROWS}) t(id, tactic_name, technique_name, url) ON technique = t.id"""))
def attack_technique(spark, sf_dir):
    mapped = events(spark, sf_dir).select("event_id", risk.attack_technique().alias("t"))
    return mapped.select("event_id", "t.*")


@query(expect("""SELECT technique, count(*) AS events, CAST(3 AS INTEGER) AS pci, CAST(3 AS INTEGER) AS nist, CAST(2 AS INTEGER) AS iso,
'Article 33 (Breach notification and audit trail traceability)' AS last_gdpr FROM risky GROUP BY 1"""))
def compliance(spark, sf_dir):
    scored = risk.with_risk(events(spark, sf_dir))
    return scored.groupBy(F.col("mitre.technique_id").alias("technique")).agg(
        F.count("*").alias("events"),
        F.max(F.size("compliance.pci_dss")).alias("pci"),
        F.max(F.size("compliance.nist_800_53")).alias("nist"),
        F.max(F.size("compliance.iso_27001")).alias("iso"),
        F.max(F.col("compliance.gdpr")[1]).alias("last_gdpr"),
    )


@query(expect("""SELECT event_id, CAST(score AS INTEGER) AS score, CASE WHEN score >= 75 THEN 'Critical' WHEN score >= 50 THEN 'High' WHEN score >= 30 THEN 'Medium' ELSE 'Low' END AS level,
CAST(has_threat AS INTEGER) + CAST(blocked AS INTEGER) + CAST(port IN (3389, 22, 23, 445, 139) AS INTEGER) + CAST(e_direction = 'Inbound' AS INTEGER)
+ CAST(e_out > 20000 AND CAST(e_out AS DOUBLE) / (e_in + 1) > 2.5 AS INTEGER) AS factors,
CASE WHEN has_threat THEN 'Threat Match: ' || coalesce(threat_name, 'None') || ' (+50)' END AS threat_factor FROM risky"""))
def risk_score(spark, sf_dir):
    scored = risk.with_risk(events(spark, sf_dir))
    first = F.get("risk.factors", F.lit(0))
    return scored.select(
        "event_id",
        "risk.score",
        "risk.level",
        F.size("risk.factors").alias("factors"),
        F.when(F.startswith(first, F.lit("Threat")), first).alias("threat_factor"),
    )


_ENDPOINT_TEXT = """coalesce(e_src_ip || CASE WHEN e_sport IS NOT NULL THEN ':' || CAST(e_sport AS VARCHAR) ELSE '' END, 'Unknown Source') AS src_text,
CASE WHEN e_dport IS NOT NULL THEN coalesce(e_dst_ip, 'None') || ':' || CAST(e_dport AS VARCHAR) ELSE coalesce(e_dst_ip, 'Unknown Target') END AS dst_text,
CASE WHEN src_int THEN 'Internal LAN' ELSE coalesce(src_country, 'Public Internet') END AS src_at,
CASE WHEN dst_int THEN 'Internal Protected LAN' ELSE coalesce(dst_country, 'Public Internet') END AS dst_at,
CASE WHEN fmt = 0 THEN rule WHEN fmt = 4 THEN CAST(user_id % 20 AS VARCHAR) WHEN fmt = 6 THEN '4' ELSE 'Default Perimeter Policy' END AS rule_text"""


@query(expect(f"""SELECT event_id, CASE WHEN e_disposition = 'Allowed' THEN 'Authorized network connection permitted from ' || src_text || ' (' || src_at || ') to ' || dst_text || ' (' || dst_at
|| ') over ' || upper(e_proto) || '. Firewall policy ''' || rule_text || ''' on ' || vendor || ' granted ' || lower(e_direction) || ' session. Zero active security violations detected.'
ELSE 'Perimeter security policy ''' || rule_text || ''' on ' || vendor || ' actively BLOCKED traffic from ' || src_text || ' (' || src_at || ') targeting ' || dst_text || ' (' || dst_at
|| ') via ' || upper(e_proto) || '. Ingress inspection resulted in an immediate ' || e_disposition || ' decision to protect internal resources.' END AS narrative
FROM (SELECT *, {_ENDPOINT_TEXT} FROM risky)"""))
def narrative(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", risk.narrative().alias("narrative"))


@query(expect(f"""SELECT event_id, sha256(line) AS sha256, CAST(strlen(line) AS INTEGER) AS raw_length,
CASE parser WHEN 'palo_alto_traffic' THEN 'CSV' WHEN 'cisco_asa' THEN 'REGEX' WHEN 'cisco_ios' THEN 'REGEX' WHEN 'pfsense_filterlog' THEN 'REGEX' WHEN 'zeek_conn' THEN 'REGEX'
WHEN 'suricata_eve' THEN 'JSON' WHEN 'generic_cef' THEN 'CEF' WHEN 'generic_leef' THEN 'LEEF' WHEN 'generic_syslog' THEN 'SYSLOG' ELSE 'KEY_VALUE' END AS format,
round_even(confidence * 100, 1) AS confidence, CAST(n_fields + CASE WHEN pri IS NULL THEN 0 ELSE 1 END AS INTEGER) AS extracted_count,
CAST(n_unmapped AS INTEGER) AS unmapped_retained, src_text AS src_endpoint, dst_text AS dst_endpoint, CAST(score AS INTEGER) AS risk_score
FROM (SELECT *, {_ENDPOINT_TEXT} FROM risky) WHERE NOT bad"""))
def processing_trace(spark, sf_dir):
    detailed = risk.with_risk(events(spark, sf_dir, details=True).where("lineage.is_valid"))
    traced = export.processing_trace(detailed)
    return traced.select(
        "event_id",
        "phase_1.sha256",
        "phase_1.raw_length",
        "phase_2.format",
        "phase_2.confidence",
        "phase_2.extracted_count",
        "phase_2.unmapped_retained",
        "phase_3.src_endpoint",
        "phase_3.dst_endpoint",
        "phase_3.risk_score",
    )


@query(expect("""SELECT event_id, CASE WHEN has_threat THEN threat_id ELSE '100201' END AS rule_id,
CAST(least(greatest(floor(score / 6.5), 1), 15) AS INTEGER) AS level,
coalesce(threat_name, 'Perimeter firewall traffic: ' || e_disposition) AS description,
CASE WHEN lower(coalesce(threat_name, '')) LIKE '%scan%' THEN 'T1046' ELSE 'T1071' END AS technique,
'rampart-' || replace(lower(vendor), ' ', '-') AS agent, CASE WHEN e_dport IS NULL THEN '' ELSE CAST(e_dport AS VARCHAR) END AS dstport,
CAST(e_total AS VARCHAR) AS bytes, 'network-perimeter:' || parser_id AS location FROM risky"""))
def export_siem(spark, sf_dir):
    alerts = events(spark, sf_dir).select("event_id", export.siem_alert(risk.risk_score()).alias("a"))
    return alerts.select(
        "event_id",
        F.col("a.rule.id").alias("rule_id"),
        "a.rule.level",
        "a.rule.description",
        F.col("a.rule.mitre.id")[0].alias("technique"),
        F.col("a.agent.name").alias("agent"),
        "a.data.dstport",
        "a.data.bytes",
        "a.location",
    )


@query(expect("""SELECT event_id, CASE WHEN e_disposition = 'Allowed' THEN 'success' ELSE 'failure' END AS outcome, lower(e_disposition) AS action,
CAST(e_dur AS BIGINT) * 1000000 AS duration, e_src_ip AS source_ip, dst_country AS destination_country, lower(e_proto) AS transport,
lower(e_direction) AS direction, CAST(n_unmapped AS INTEGER) AS unmapped_count FROM risky"""))
def export_ecs(spark, sf_dir):
    layout = events(spark, sf_dir).select("event_id", export.ecs_event().alias("e"))
    return layout.select(
        "event_id",
        "e.event.outcome",
        "e.event.action",
        "e.event.duration",
        F.col("e.source.ip").alias("source_ip"),
        F.col("e.destination.geo.country_iso_code").alias("destination_country"),
        "e.network.transport",
        "e.network.direction",
        "e.labels.unmapped_count",
    )


@query(expect("""SELECT event_id, sha256(line) AS digest, true AS verified, CAST(strlen(line) AS INTEGER) AS raw_byte_length, vendor,
CAST(n_unmapped AS INTEGER) AS unmapped, line AS raw FROM risky"""))
def export_forensic(spark, sf_dir):
    bundles = events(spark, sf_dir).select("event_id", export.forensic_bundle().alias("b"))
    return bundles.select(
        "event_id",
        F.col("b.forensic_record.sha256_digest").alias("digest"),
        F.col("b.forensic_record.integrity_verified").alias("verified"),
        "b.forensic_record.raw_byte_length",
        "b.forensic_record.vendor",
        F.size("b.unmapped_vendor_partition").alias("unmapped"),
        F.col("b.verbatim_raw_payload").alias("raw"),
    )


_TRACE = [
    ("src_ip / src", "src_endpoint.ip", "coalesce(e_src_ip, '-')", "RFC 1918 Scope Classification + GeoIP Enrichment"),
    ("src_port / spt", "src_endpoint.port", "coalesce(CAST(e_sport AS VARCHAR), '-')", "Integer Cast + Ephemeral Port Flagging"),
    ("dst_ip / dst", "dst_endpoint.ip", "coalesce(e_dst_ip, '-')", "RFC 1918 Scope Classification + GeoIP Enrichment"),
    ("dst_port / dpt", "dst_endpoint.port", "coalesce(CAST(e_dport AS VARCHAR), '-')", "Well-known Service Classification (IANA Registry)"),
    ("proto / protocol", "connection_info.protocol_name", "e_proto", "IANA Protocol Normalization (TCP/UDP/ICMP)"),
    ("action / act", "disposition", "e_disposition", "Canonical Enum Mapping (Allowed / Blocked / Dropped)"),
    ("bytes / sent / rcvd", "traffic.total_bytes", "CAST(e_total AS VARCHAR) || ' B'", "Log-Scale Metric Vectorization + Exfiltration Ratio"),
    ("raw_payload", "lineage.raw_hash", "'SHA256: ' || substr(sha256(line), 1, 16) || '...'", "Cryptographic Hash Computation (Zero-Loss Lineage)"),
]


@query(expect(" UNION ALL ".join(
    f"SELECT event_id, '{token}' AS source_token, {value} AS extracted_val, '{field}' AS canonical_field, '{how}' AS transformation FROM risky"
    for token, field, value, how in _TRACE
)))
def traceability(spark, sf_dir):
    return export.traceability(events(spark, sf_dir), "event_id")


@query(expect("""SELECT event_id, line AS raw_event, length(line) AS chars, 'Allowed' = e_disposition AS allowed FROM risky"""))
def export_native(spark, sf_dir):
    text = events(spark, sf_dir).select("event_id", export.native_json().alias("j"))
    raw = F.get_json_object("j", "$.raw_event")
    return text.select(
        "event_id",
        raw.alias("raw_event"),
        F.length(raw).cast("bigint").alias("chars"),
        (F.get_json_object("j", "$.disposition") == "Allowed").alias("allowed"),
    )


@query(expect("""SELECT event_id, CASE WHEN e_total > 1024 THEN printf('%.1f KB', floor(CAST(e_total AS DOUBLE) / 1024 * 10 + 0.5) / 10) ELSE CAST(e_total AS VARCHAR) || ' B' END AS bytes_label,
coalesce(e_app, CASE WHEN port IN (80, 443) THEN 'HTTP/HTTPS Web Traffic' ELSE 'Standard IP Session' END) AS app_label,
'Policy: ' || CASE WHEN fmt = 0 THEN rule WHEN fmt = 4 THEN CAST(user_id % 20 AS VARCHAR) WHEN fmt = 6 THEN '4' ELSE 'Access Policy Enforced' END AS rule_label FROM risky"""))
def display_labels(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", *export.display_columns())


# -------------------------------------------------------------------- aggregation
@query(expect("""SELECT CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) AS total_processed, CAST(sum(strlen(line)) FILTER (WHERE NOT bad) AS BIGINT) AS total_bytes_ingested,
CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS total_errors FROM expected"""))
def telemetry_totals(spark, sf_dir):
    return report.telemetry_totals(events(spark, sf_dir))


_COUNTS = """SELECT 'vendor' AS dimension, vendor AS name, count(*) AS events FROM expected WHERE NOT bad GROUP BY 2
UNION ALL SELECT 'action', e_disposition, count(*) FROM expected WHERE NOT bad GROUP BY 2
UNION ALL SELECT 'severity', e_severity, count(*) FROM expected WHERE NOT bad GROUP BY 2"""


@query(expect(_COUNTS))
def telemetry_grouping_sets(spark, sf_dir):
    return report.telemetry_counts(events(spark, sf_dir))


@query(expect("SELECT vendor, e_disposition AS action, count(*) AS events, CAST(sum(e_total) AS BIGINT) AS total_bytes FROM expected GROUP BY 1, 2"))
def vendor_action_summary(spark, sf_dir):
    grouped = events(spark, sf_dir).groupBy(
        F.col("product.vendor_name").alias("vendor"), F.col("disposition").alias("action")
    )
    return grouped.agg(F.count("*").alias("events"), F.sum("traffic.total_bytes").alias("total_bytes"))


@query(expect("""SELECT parser_id, count(*) AS events, CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) AS passed,
CAST(count(*) FILTER (WHERE NOT bad) AS DOUBLE) / count(*) AS pass_rate FROM expected GROUP BY 1"""))
def parser_report(spark, sf_dir):
    return report.parser_report(events(spark, sf_dir))


@query(expect("""SELECT parser_id, count(*) AS events, CAST(sum(n_fields + CASE WHEN pri IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS extracted_tokens,
CAST(sum(n_unmapped) AS BIGINT) AS unmapped_tokens FROM expected GROUP BY 1"""))
def unmapped_report(spark, sf_dir):
    return report.unmapped_report(events(spark, sf_dir, details=True))


@query(expect("""SELECT quantile_cont(CAST(e_total AS DOUBLE), 0.5) AS p50, quantile_cont(CAST(e_total AS DOUBLE), 0.95) AS p95,
quantile_cont(CAST(e_total AS DOUBLE), 0.99) AS p99 FROM expected"""))
def traffic_percentiles(spark, sf_dir):
    return report.column_percentiles(events(spark, sf_dir), "traffic.total_bytes", accuracy=None)


@query()
def traffic_percentiles_sketch(spark, sf_dir):
    return report.column_percentiles(events(spark, sf_dir), "traffic.total_bytes")


# ----------------------------------------------------------- sinks, search, streams
_LAKE = """SELECT {key}, id AS lake_event_id, sha256(line) AS raw_hash, line AS raw_event, CAST(1704067200 + event_id AS BIGINT) AS ingestion_epoch,
coalesce(e_time, '') AS event_timestamp, parser_id, vendor AS vendor_name, product AS product_name, coalesce(e_src_ip, '') AS src_ip,
CAST(coalesce(e_sport, 0) AS INTEGER) AS src_port, coalesce(e_src_zone, '') AS src_zone, coalesce(src_country, '') AS src_country, coalesce(src_asn, '') AS src_asn,
coalesce(src_int, false) AS src_is_internal, coalesce(e_dst_ip, '') AS dst_ip, CAST(coalesce(e_dport, 0) AS INTEGER) AS dst_port, coalesce(e_dst_zone, '') AS dst_zone,
coalesce(dst_country, '') AS dst_country, coalesce(dst_asn, '') AS dst_asn, coalesce(dst_int, false) AS dst_is_internal, e_direction AS direction, e_proto AS protocol,
CAST(e_in AS BIGINT) AS bytes_in, CAST(e_out AS BIGINT) AS bytes_out, CAST(e_total AS BIGINT) AS total_bytes, CAST(0 AS BIGINT) AS packets_in, CAST(0 AS BIGINT) AS packets_out,
CAST(e_dur AS BIGINT) AS duration_ms, e_disposition AS action, e_severity AS severity, coalesce(e_app, '') AS app_name,
CASE WHEN threat_id IS NULL THEN '' ELSE threat_name END AS threat_signature, CAST(n_unmapped AS INTEGER) AS unmapped_tokens
FROM (SELECT *, sha256('default-collector' || chr(1) || CAST(event_id AS VARCHAR)) AS digest FROM expected),
LATERAL (SELECT substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-' || substr(digest, 13, 4) || '-' || substr(digest, 17, 4) || '-' || substr(digest, 21, 12) AS id)"""


def _all_lake_columns(rows: DataFrame, *keep: str) -> DataFrame:
    """All 33 columns: the id under another name, the time in seconds, and of the JSON text
    of the unmapped tokens how many it holds."""
    as_is = [c for c in LAKE_COLUMNS if c not in ("event_id", "ingestion_timestamp", "unmapped_json")]
    return rows.select(
        *keep,
        F.col("lake_event_id") if "lake_event_id" in rows.columns else F.col("event_id").alias("lake_event_id"),
        F.unix_seconds("ingestion_timestamp").alias("ingestion_epoch"),
        F.coalesce(F.size(F.json_object_keys("unmapped_json")), F.lit(0)).alias("unmapped_tokens"),
        *as_is,
    )


@query(expect(_LAKE.format(key="event_id")))
def lake_flatten(spark, sf_dir):
    source = events(spark, sf_dir, details=True)
    rows = export.lake_rows(source, F.col("event_id").alias("source_id"))
    named = rows.withColumnRenamed("event_id", "lake_event_id").withColumnRenamed("source_id", "event_id")
    return _all_lake_columns(named, "event_id")


@query(expect(_LAKE.format(key="'lake' AS table_name")))
def lake_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "lake")
    writers.write_lake(events(spark, sf_dir), path)
    return _all_lake_columns(readers.read_lake(spark, path).withColumn("table_name", F.lit("lake")), "table_name")


@query(expect("""SELECT line AS raw_event, e_disposition AS disposition, e_src_ip AS src_ip, CAST(e_dport AS INTEGER) AS dst_port, CAST(n_unmapped AS INTEGER) AS n_unmapped FROM expected"""))
def jsonl_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "jsonl")
    writers.write_jsonl(events(spark, sf_dir), path)
    return readers.read_events_jsonl(spark, path).select(
        "raw_event",
        "disposition",
        F.col("src_endpoint.ip").alias("src_ip"),
        F.col("dst_endpoint.port").alias("dst_port"),
        F.size("unmapped").alias("n_unmapped"),
    )


@query(expect("""SELECT v.vendor, count(*) AS rows, count(DISTINCT v.line) AS hashes, CAST(count(*) FILTER (WHERE v.e_disposition = 'Blocked') AS BIGINT) AS replaced
FROM expected v GROUP BY 1"""))
def forensic_upsert(spark, sf_dir):
    """All events, then the blocked ones again under another severity: no row may appear
    twice, and the later one counts."""
    path = fresh_path(spark, "forensic")
    source = stored(events(spark, sf_dir), "events")
    writers.upsert_forensic(source, path)
    changed = source.where("disposition = 'Blocked'").withColumn("severity", F.lit("Reviewed"))
    writers.upsert_forensic(changed, path)
    counting = writers.read_forensic(spark, path)
    return counting.groupBy("vendor").agg(
        F.count("*").alias("rows"),
        F.countDistinct("raw_event").alias("hashes"),
        F.count_if(F.col("severity") == "Reviewed").alias("replaced"),
    )


@query(expect("SELECT event_id, line AS payload_raw FROM expected"))
def siem_outbox(spark, sf_dir):
    path = fresh_path(spark, "outbox")
    source = events(spark, sf_dir)
    writers.write_outbox(source, path, F.struct("event_id", export.siem_alert().alias("alert")))
    rows = spark.read.text(path)
    return rows.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object("value", "$.alert.full_log").alias("payload_raw"),
    )


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a stored forensic table."""
    path = fresh_path(spark, "forensic")
    writers.upsert_forensic(events(spark, sf_dir), path, fresh_ids=True)
    return writers.read_forensic(spark, path)


@query(expect("""SELECT sha256(line) AS raw_hash, vendor, e_disposition AS action FROM expected WHERE vendor = 'Cisco Systems' AND e_disposition = 'Blocked'
ORDER BY event_id DESC LIMIT 50"""))
def forensic_search_topk(spark, sf_dir):
    stored = stored_events(spark, sf_dir)
    found = search.search_events(stored, "vendor = :v AND action = :a", {"v": "Cisco Systems", "a": "Blocked"})
    return found.select("raw_hash", "vendor", "action")


@query(expect("SELECT sha256(line) AS raw_hash, vendor FROM expected WHERE vendor = 'Zeek' ORDER BY event_id DESC LIMIT 20"))
def forensic_search_vendor(spark, sf_dir):
    stored = stored_events(spark, sf_dir)
    return search.events_of_vendor(stored, "Zeek", limit=20).select("raw_hash", "vendor")


@query(expect("""SELECT sha256(line) AS raw_hash, vendor, e_src_ip AS src_ip FROM expected WHERE lower(vendor) LIKE '%10.1%' OR lower(e_disposition) LIKE '%10.1%' OR lower(e_proto) LIKE '%10.1%'
OR e_src_ip LIKE '%10.1%' OR e_dst_ip LIKE '%10.1%'"""))
def substring_search(spark, sf_dir):
    return search.matching_text(stored_events(spark, sf_dir), " 10.1").select("raw_hash", "vendor", "src_ip")


@query(expect("SELECT sha256(line) AS raw_hash, e_dst_ip AS dst_ip, e_severity AS severity FROM expected WHERE e_src_ip = '45.33.32.156' AND e_severity = 'High'"))
def indexed_lookup(spark, sf_dir):
    found = search.events_by_key(stored_events(spark, sf_dir), src_ip="45.33.32.156", severity="High")
    return found.select("raw_hash", "dst_ip", "severity")


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "events")
    schema = T.StructType(stored.schema.fields)
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    source = source.select("event_id", "user_id", "event_type", "value")
    return with_lines(source.repartition(spark.sparkContext.defaultParallelism, "event_id"))


@query(expect("SELECT event_id, parser_id, e_disposition AS disposition, e_direction AS direction, sha256(line) AS raw_hash FROM expected"))
def stream_normalize(spark, sf_dir):
    path = fresh_path(spark, "stream")
    run = jobs.stream_events(
        streamed(spark, sf_dir), path, fresh_path(spark, "progress"), once=True, id_cols=["event_id"], keep=["event_id"]
    )
    run.awaitTermination()
    return spark.read.parquet(path).select(
        "event_id", "lineage.parser_id", "disposition", "connection_info.direction", "lineage.raw_hash"
    )


@query(expect(_COUNTS))
def stream_counts(spark, sf_dir):
    """Running counters: the last state of each counter in complete mode."""
    path = fresh_path(spark, "counts")
    counts = jobs.running_counts(normalize(streamed(spark, sf_dir)))

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(path)

    run = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", fresh_path(spark, "progress"))
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    stored = spark.read.parquet(path)
    last = stored.agg(F.max("batch").alias("batch"))
    return stored.join(F.broadcast(last), "batch").select("dimension", "name", "events")


@query(expect("""SELECT event_id, e_disposition AS disposition, CAST(NULL AS VARCHAR) AS lake_error, 'sink is down' AS broken_error,
CAST(NULL AS VARCHAR) AS rows_error FROM expected"""))
def stream_fan_out(spark, sf_dir):
    """Micro-batches to three sinks, the second of which always fails."""
    lake, rows = fresh_path(spark, "lake"), fresh_path(spark, "rows")

    def broken(batch: DataFrame) -> None:
        raise OSError("sink is down")

    sinks = {
        "lake": lambda batch: writers.write_lake(batch, lake),
        "broken": broken,
        "rows": lambda batch: batch.write.mode("append").parquet(rows),
    }
    outcomes: list[dict] = []
    run = jobs.stream_to_sinks(
        streamed(spark, sf_dir), sinks, fresh_path(spark, "progress"), once=True,
        on_batch=lambda batch_id, outcome: outcomes.append(outcome), id_cols=["event_id"], keep=["event_id"],
    )
    run.awaitTermination()
    ids = spark.read.parquet(lake).select(F.col("event_id").alias("lake_id"))
    events_ = spark.read.parquet(rows)
    both = events_.join(ids, F.col("lineage.event_id") == F.col("lake_id"))
    # What the sinks reported, the same for every batch.
    reported = {name: {outcome[name] for outcome in outcomes} for name in sinks}
    errors = [F.lit("; ".join(sorted(x or "" for x in reported[name])) or None).cast("string").alias(f"{name}_error") for name in sinks]
    return both.select("event_id", "disposition", *errors)


@query(expect("SELECT parser AS parser_id, max(CASE WHEN NOT bad THEN vendor END) AS vendor, count(*) AS lines FROM expected GROUP BY 1"))
def parser_catalog_usage(spark, sf_dir):
    """The parser catalogue joined to the lines each parser gets."""
    catalog = parser_catalog(spark).select(F.col("id"), F.col("vendor"))
    routed = with_parser(lines(spark, sf_dir), shipped_specs())
    counted = routed.groupBy("parser_id").agg(F.count("*").alias("lines"))
    joined = counted.join(F.broadcast(catalog), F.col("parser_id") == F.col("id"), "left")
    return joined.select("parser_id", F.coalesce("vendor", F.lit("Generic")).alias("vendor"), "lines")


@query(r"""WITH c AS (SELECT conv_id, turn, unnest(string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')) AS part FROM conversations)
SELECT conv_id, turn, count(*) AS lines FROM c WHERE trim(part, chr(9) || ' ' || chr(160)) <> '' GROUP BY 1, 2""")
def datagram_lines(spark, sf_dir):
    """Multi-line payloads to lines (conversation texts as payloads)."""
    payloads = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").cast("binary").alias("value"))
    parts = readers.split_datagrams(payloads, keep=["conv_id", "turn"])
    return parts.groupBy("conv_id", "turn").agg(F.count("*").alias("lines"))


@query(expect("SELECT parser AS parser_id, count(*) AS lines, CAST(sum(strlen(line)) AS BIGINT) AS bytes FROM expected GROUP BY 1"))
def text_file_scan(spark, sf_dir):
    """Lines written as text files with comments and blanks, then read back."""
    path = fresh_path(spark, "text")
    source = lines(spark, sf_dir)
    noisy = source.select(
        F.explode(
            F.array(F.col("raw_event"), F.lit("   "), F.concat(F.lit("  # note "), F.col("raw_event")))
        ).alias("value")
    )
    noisy.write.text(path)
    routed = with_parser(readers.read_lines(spark, path), shipped_specs())
    return routed.groupBy("parser_id").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("raw_event")).alias("bytes")
    )
