"""The canonical event and its flat at-rest layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# Lineage constants of an event.
DEFAULT_COLLECTOR = "default-collector"
SCHEMA_VERSION = "ocsf-1.2.0-network"

_ENDPOINT = (
    "struct<ip: string, port: int, hostname: string, mac: string, zone: string,"
    " interface: string, is_internal: boolean, country: string, city: string, asn: string>"
)

# Column order of a canonical event table.
EVENT_DDL = f"""
    raw_event string,
    lineage struct<event_id: string, raw_hash: string, collector_id: string, parser_id: string,
        parser_version: string, schema_version: string, ingestion_timestamp: timestamp,
        event_timestamp: string, is_valid: boolean, validation_errors: array<string>>,
    product struct<vendor_name: string, product_name: string, product_version: string, feature: string>,
    src_endpoint {_ENDPOINT},
    dst_endpoint {_ENDPOINT},
    connection_info struct<protocol_name: string, protocol_num: int, direction: string,
        session_id: string, tcp_flags: string, state: string>,
    traffic struct<bytes_in: bigint, bytes_out: bigint, total_bytes: bigint, packets_in: bigint,
        packets_out: bigint, total_packets: bigint, duration_ms: bigint>,
    disposition string,
    disposition_reason string,
    severity string,
    vendor_severity string,
    app_name string,
    url string,
    domain string,
    threat struct<signature_id: string, signature_name: string, category: string, cve: string,
        threat_actor: string, indicator_matched: string, confidence_score: double>,
    unmapped map<string, string>
"""


def event_schema() -> T.StructType:
    """Schema of a canonical event table (for reading it back from JSON lines)."""
    return T.StructType.fromDDL(EVENT_DDL)


EVENT_COLUMNS = [
    "raw_event", "lineage", "product", "src_endpoint", "dst_endpoint", "connection_info",
    "traffic", "disposition", "disposition_reason", "severity", "vendor_severity", "app_name",
    "url", "domain", "threat", "unmapped",
]

LAKE_COLUMNS = [
    "event_id", "raw_hash", "raw_event", "ingestion_timestamp", "event_timestamp", "parser_id",
    "vendor_name", "product_name", "src_ip", "src_port", "src_zone", "src_country", "src_asn",
    "src_is_internal", "dst_ip", "dst_port", "dst_zone", "dst_country", "dst_asn",
    "dst_is_internal", "direction", "protocol", "bytes_in", "bytes_out", "total_bytes",
    "packets_in", "packets_out", "duration_ms", "action", "severity", "app_name",
    "threat_signature", "unmapped_json",
]

FORENSIC_COLUMNS = [
    "event_id", "raw_hash", "raw_event", "ingestion_timestamp", "event_timestamp", "parser_id",
    "vendor", "product", "src_ip", "src_port", "src_country", "dst_ip", "dst_port",
    "dst_country", "protocol", "direction", "bytes_in", "bytes_out", "total_bytes", "action",
    "severity", "app_name", "threat_signature", "normalized_json",
]
