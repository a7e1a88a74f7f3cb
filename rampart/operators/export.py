"""Layouts in which events leave: SIEM alert, ECS, forensic bundle, traceability,
native JSON, processing trace and the two flat at-rest tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.operators.risk import applied_rule, endpoint_text, protocol_text
from rampart.schema import EVENT_COLUMNS, FORENSIC_COLUMNS, LAKE_COLUMNS
from rampart.specs import FALLBACK, SpecSet, shipped_specs

_JSON = {"ignoreNullFields": "false"}


def iso_text(timestamp: Column) -> Column:
    """A timestamp as ISO-8601 text in UTC with microseconds."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), timestamp.cast("timestamp_ntz"))
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def event_time() -> Column:
    """The device's own time text, else the ingestion time."""
    own = F.nullif(F.col("lineage.event_timestamp"), F.lit(""))
    return F.coalesce(own, iso_text(F.col("lineage.ingestion_timestamp")))


def siem_alert(score: Column | int = 25, prefix: str = "rampart") -> Column:
    """Alert layout as a struct; the level is the risk score on a 1 to 15 scale.

    ``prefix`` names the installation in the group, agent, manager and decoder.
    """
    risk = F.lit(score) if isinstance(score, int) else score
    level = F.least(F.greatest(F.floor(risk / 6.5).cast("int"), F.lit(1)), F.lit(15))
    name = F.coalesce("threat.signature_name", F.lit(""))
    parser = F.col("lineage.parser_id")

    def port(side: str) -> Column:
        number = F.col(f"{side}.port")
        return F.when(F.coalesce(number, F.lit(0)) != 0, number.cast("string")).otherwise("")

    # Fixed values below: constant members of the alert layout.
    return F.struct(
        event_time().alias("timestamp"),
        F.struct(
            F.when(F.col("threat").isNotNull(), F.col("threat.signature_id")).otherwise("100201").alias("id"),
            level.alias("level"),
            F.when(name != "", name)
            .otherwise(F.concat(F.lit("Perimeter firewall traffic: "), "disposition"))
            .alias("description"),
            F.array(F.lit("firewall"), F.lit("network"), F.lit(f"{prefix}_normalized")).alias("groups"),
            F.struct(
                F.array(
                    F.when(F.contains(F.lower(name), F.lit("scan")), "T1046").otherwise("T1071")
                ).alias("id"),
                F.array(F.lit("Reconnaissance")).alias("tactic"),
            ).alias("mitre"),
        ).alias("rule"),
        F.struct(
            F.lit("000").alias("id"),
            F.concat(
                F.lit(f"{prefix}-"), F.replace(F.lower("product.vendor_name"), F.lit(" "), F.lit("-"))
            ).alias("name"),
            F.lit("127.0.0.1").alias("ip"),
        ).alias("agent"),
        F.struct(F.lit(f"{prefix}-core-manager").alias("name")).alias("manager"),
        F.col("lineage.event_id").alias("id"),
        F.struct(parser.alias("name"), F.lit(f"{prefix}-universal-decoder").alias("parent")).alias("decoder"),
        F.struct(
            F.col("src_endpoint.ip").alias("srcip"),
            port("src_endpoint").alias("srcport"),
            F.col("dst_endpoint.ip").alias("dstip"),
            port("dst_endpoint").alias("dstport"),
            F.col("connection_info.protocol_name").alias("proto"),
            F.col("disposition").alias("action"),
            F.col("app_name").alias("app"),
            F.coalesce(F.col("traffic.total_bytes"), F.lit(0)).cast("string").alias("bytes"),
            F.col("product.vendor_name").alias("vendor"),
        ).alias("data"),
        F.concat(F.lit("network-perimeter:"), parser).alias("location"),
        F.col("lineage.raw_hash").alias("sha256"),
        F.col("raw_event").alias("full_log"),
    )


def ecs_event() -> Column:
    """Elastic Common Schema layout as a struct."""
    transport = F.coalesce(F.nullif(F.col("connection_info.protocol_name"), F.lit("")), F.lit("tcp"))

    def endpoint(side: str) -> Column:
        return F.struct(
            F.col(f"{side}.ip").alias("ip"),
            F.col(f"{side}.port").alias("port"),
            F.struct(F.col(f"{side}.country").alias("country_iso_code")).alias("geo"),
        )

    # Fixed values below: constant members of the layout.
    return F.struct(
        event_time().alias("@timestamp"),
        F.struct(F.lit("8.11.0").alias("version")).alias("ecs"),
        F.struct(
            F.col("lineage.event_id").alias("id"),
            F.lit("event").alias("kind"),
            F.array(F.lit("network")).alias("category"),
            F.array(F.lit("connection"), F.lit("access")).alias("type"),
            F.when(F.col("disposition") == "Allowed", "success").otherwise("failure").alias("outcome"),
            F.lower("disposition").alias("action"),
            F.try_multiply(
                F.coalesce(F.col("traffic.duration_ms"), F.lit(0)).cast("bigint"),
                F.lit(1_000_000).cast("bigint"),
            ).alias("duration"),
            F.col("raw_event").alias("original"),
            F.struct(F.col("lineage.raw_hash").alias("sha256")).alias("hash"),
        ).alias("event"),
        endpoint("src_endpoint").alias("source"),
        endpoint("dst_endpoint").alias("destination"),
        F.struct(
            F.lower(transport).alias("transport"),
            F.lower("connection_info.direction").alias("direction"),
            F.coalesce(F.col("traffic.total_bytes"), F.lit(0)).alias("bytes"),
        ).alias("network"),
        F.struct(
            F.col("product.vendor_name").alias("vendor"),
            F.col("product.product_name").alias("product"),
            F.lit("firewall").alias("type"),
        ).alias("observer"),
        F.struct(F.size("unmapped").alias("unmapped_count")).alias("labels"),
    )


def forensic_bundle() -> Column:
    """Raw text, its digest and the lineage that proves it, as a struct."""
    return F.struct(
        F.struct(
            "lineage.event_id",
            iso_text(F.col("lineage.ingestion_timestamp")).alias("ingestion_timestamp"),
            "lineage.event_timestamp",
            "lineage.parser_id",
            F.col("product.vendor_name").alias("vendor"),
            F.col("product.product_name").alias("product"),
            F.col("lineage.raw_hash").alias("sha256_digest"),
            (F.col("lineage.raw_hash") == F.sha2("raw_event", 256)).alias("integrity_verified"),
            F.octet_length("raw_event").alias("raw_byte_length"),
            # Fixed value.
            F.lit("100.00% Zero Information Loss").alias("lossless_guarantee"),
        ).alias("forensic_record"),
        F.col("unmapped").alias("unmapped_vendor_partition"),
        F.col("raw_event").alias("verbatim_raw_payload"),
    )


def event_members() -> list[Column]:
    """The members of a canonical event for JSON: times as ISO-8601 text in UTC with
    microseconds, whatever the session's zone."""
    lineage = F.col("lineage").withField("ingestion_timestamp", iso_text(F.col("lineage.ingestion_timestamp")))
    return [lineage.alias("lineage") if name == "lineage" else F.col(name) for name in EVENT_COLUMNS]


def native_json(*, typed: bool = False) -> Column:
    """The whole canonical event as JSON text.

    ``typed`` keeps the types of unmapped tokens (see :func:`unmapped_json`); it needs
    events normalized with ``details=True``.
    """
    members = event_members()
    if not typed:
        return F.to_json(F.struct(*members), _JSON)
    # The unmapped tokens are the last member.
    text = F.to_json(F.struct(*members[:-1]), _JSON)
    head = F.substring(text, F.lit(1), F.length(text) - 1)
    return F.concat(head, F.lit(',"unmapped":'), unmapped_json(literals="json_literals"), F.lit("}"))


def to_json_rows(events: DataFrame, layout: Column, name: str = "payload") -> DataFrame:
    """One JSON text per event in a given layout."""
    return events.select(F.to_json(layout, _JSON).alias(name))


def traceability(events: DataFrame, *keep: str) -> DataFrame:
    """How eight canonical fields came about: eight rows per event."""

    def text(column: str) -> Column:
        value = F.col(column)
        zero = "" if column.endswith((".ip", "_name")) else "0"
        return F.coalesce(F.nullif(value.cast("string"), F.lit(zero)), F.lit("-"))

    # Source tokens, canonical fields and descriptions.
    rows = [
        ("src_ip / src", text("src_endpoint.ip"), "src_endpoint.ip", "RFC 1918 Scope Classification + GeoIP Enrichment"),
        ("src_port / spt", text("src_endpoint.port"), "src_endpoint.port", "Integer Cast + Ephemeral Port Flagging"),
        ("dst_ip / dst", text("dst_endpoint.ip"), "dst_endpoint.ip", "RFC 1918 Scope Classification + GeoIP Enrichment"),
        ("dst_port / dpt", text("dst_endpoint.port"), "dst_endpoint.port", "Well-known Service Classification (IANA Registry)"),
        ("proto / protocol", text("connection_info.protocol_name"), "connection_info.protocol_name", "IANA Protocol Normalization (TCP/UDP/ICMP)"),
        ("action / act", F.col("disposition"), "disposition", "Canonical Enum Mapping (Allowed / Blocked / Dropped)"),
        (
            "bytes / sent / rcvd",
            F.concat(F.coalesce(F.col("traffic.total_bytes"), F.lit(0)).cast("string"), F.lit(" B")),
            "traffic.total_bytes",
            "Log-Scale Metric Vectorization + Exfiltration Ratio",
        ),
        (
            "raw_payload",
            F.concat(F.lit("SHA256: "), F.substring("lineage.raw_hash", 1, 16), F.lit("...")),
            "lineage.raw_hash",
            "Cryptographic Hash Computation (Zero-Loss Lineage)",
        ),
    ]
    entries = [
        F.struct(
            F.lit(token).alias("source_token"),
            value.alias("extracted_val"),
            F.lit(field).alias("canonical_field"),
            F.lit(how).alias("transformation"),
        )
        for token, value, field, how in rows
    ]
    return events.select(*keep, F.inline(F.array(*entries)))


def processing_trace(events: DataFrame, specs: SpecSet | None = None) -> DataFrame:
    """What the three phases did to an event.

    Needs events normalized with ``details=True`` and passed through ``with_risk``.
    """
    specs = shipped_specs() if specs is None else specs

    def spec_text(attribute: str) -> Column:
        value = F.lit(FALLBACK[attribute])
        for spec in specs:
            value = F.when(F.col("lineage.parser_id") == spec.id, getattr(spec, attribute)).otherwise(value)
        return value

    has_meta = F.when(F.col("syslog_meta").isNotNull(), 1).otherwise(0)
    return events.select(
        "*",
        F.struct(
            F.col("lineage.raw_hash").alias("sha256"),
            F.col("raw_event").alias("raw_log"),
            F.octet_length("raw_event").alias("raw_length"),
            iso_text(F.col("lineage.ingestion_timestamp")).alias("ingestion_timestamp"),
            event_time().alias("event_timestamp"),
        ).alias("phase_1"),
        F.struct(
            "lineage.parser_id",
            F.col("product.vendor_name").alias("vendor"),
            spec_text("name").alias("parser_name"),
            F.upper(spec_text("format")).alias("format"),
            F.bround(F.col("confidence") * 100, 1).alias("confidence"),
            F.col("fields").alias("extracted_fields"),
            # The PRI header counts as one extracted field.
            (F.size("fields") + has_meta).alias("extracted_count"),
            F.size("unmapped").alias("unmapped_retained"),
        ).alias("phase_2"),
        F.struct(
            F.col("disposition").alias("action"),
            "connection_info.direction",
            protocol_text().alias("protocol"),
            endpoint_text("src_endpoint", "Unknown Source").alias("src_endpoint"),
            endpoint_text("dst_endpoint", "Unknown Target").alias("dst_endpoint"),
            F.col("mitre.tactic_name").alias("mitre_tactic"),
            F.col("mitre.technique_name").alias("mitre_technique"),
            F.col("risk.score").alias("risk_score"),
            F.col("risk.level").alias("risk_level"),
            F.col("risk.factors").alias("risk_factors"),
            F.lit(26).alias("ml_features_count"),
        ).alias("phase_3"),
    )


def unmapped_json(unmapped: str = "unmapped", literals: str | None = None) -> Column:
    """Unmapped tokens as JSON text with sorted keys.

    With ``literals`` (see ``normalize(details=True)``) numbers, booleans and
    arrays keep their JSON type.
    """
    keys = f"array_sort(map_keys({unmapped}))"
    if literals is None:
        ordered = f"map_from_arrays({keys}, transform({keys}, k -> {unmapped}[k]))"
        return F.expr(f"to_json({ordered}, map('ignoreNullFields', 'false'))")
    # A key or text inside a one-element array, cut out of its brackets.
    quoted = "substr({0}, 2, length({0}) - 2)"
    key = quoted.format("to_json(array(k))")
    text = quoted.format(f"to_json(array({unmapped}[k]))")
    return F.expr(
        f"concat('{{', array_join(transform({keys}, k -> concat({key}, ':',"
        f" coalesce({literals}[k], {text}))), ','), '}}')"
    )


def lake_rows(events: DataFrame, *keep: str, literals: str | None = None) -> DataFrame:
    """The 33-column data lake layout; most missing values become empty, 0 or false."""
    if literals is None and "json_literals" in events.columns:
        literals = "json_literals"

    def text(column: str, default: str = "") -> Column:
        return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))

    def number(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    columns = {
        "event_id": F.col("lineage.event_id"),
        "raw_hash": F.col("lineage.raw_hash"),
        "raw_event": F.col("raw_event"),
        "ingestion_timestamp": F.col("lineage.ingestion_timestamp"),
        "event_timestamp": text("lineage.event_timestamp"),
        "parser_id": F.col("lineage.parser_id"),
        "vendor_name": F.col("product.vendor_name"),
        "product_name": F.col("product.product_name"),
        "direction": F.col("connection_info.direction"),
        "protocol": text("connection_info.protocol_name", "unknown"),
        "action": F.col("disposition"),
        "severity": F.col("severity"),
        "app_name": text("app_name"),
        # NULL for a threat without a name, empty without a threat.
        "threat_signature": F.when(F.col("threat").isNotNull(), F.col("threat.signature_name")).otherwise(""),
        "unmapped_json": unmapped_json(literals=literals),
    }
    for short, side in (("src", "src_endpoint"), ("dst", "dst_endpoint")):
        for part in ("ip", "zone", "country", "asn"):
            columns[f"{short}_{part}"] = text(f"{side}.{part}")
        columns[f"{short}_port"] = number(f"{side}.port")
        columns[f"{short}_is_internal"] = F.coalesce(F.col(f"{side}.is_internal"), F.lit(False))
    for name in ("bytes_in", "bytes_out", "total_bytes", "packets_in", "packets_out", "duration_ms"):
        columns[name] = number(f"traffic.{name}")
    return events.select(*keep, *[columns[name].alias(name) for name in LAKE_COLUMNS])


def forensic_rows(events: DataFrame, *keep: str) -> DataFrame:
    """The 24-column forensic layout; missing values stay NULL."""
    columns = {
        "event_id": F.col("lineage.event_id"),
        "raw_hash": F.col("lineage.raw_hash"),
        "raw_event": F.col("raw_event"),
        "ingestion_timestamp": F.col("lineage.ingestion_timestamp"),
        "event_timestamp": F.coalesce("lineage.event_timestamp", F.lit("")),
        "parser_id": F.col("lineage.parser_id"),
        "vendor": F.col("product.vendor_name"),
        "product": F.col("product.product_name"),
        "src_ip": F.col("src_endpoint.ip"),
        "src_port": F.col("src_endpoint.port"),
        "src_country": F.col("src_endpoint.country"),
        "dst_ip": F.col("dst_endpoint.ip"),
        "dst_port": F.col("dst_endpoint.port"),
        "dst_country": F.col("dst_endpoint.country"),
        "protocol": F.col("connection_info.protocol_name"),
        "direction": F.col("connection_info.direction"),
        "bytes_in": F.col("traffic.bytes_in"),
        "bytes_out": F.col("traffic.bytes_out"),
        "total_bytes": F.col("traffic.total_bytes"),
        "action": F.col("disposition"),
        "severity": F.col("severity"),
        "app_name": F.col("app_name"),
        "threat_signature": F.col("threat.signature_name"),
        "normalized_json": native_json(),
    }
    return events.select(*keep, *[columns[name].alias(name) for name in FORENSIC_COLUMNS])


def display_columns() -> list[Column]:
    """Labels a report shows next to an event: volume, application and rule."""
    volume = F.coalesce(F.col("traffic.total_bytes"), F.lit(0))
    web = F.coalesce(F.col("dst_endpoint.port"), F.lit(0)).isin(80, 443)
    # Fallback labels.
    return [
        F.when(volume > 1024, F.format_string("%.1f KB", volume / 1024))
        .otherwise(F.concat(volume.cast("string"), F.lit(" B")))
        .alias("bytes_label"),
        F.coalesce(
            F.nullif(F.col("app_name"), F.lit("")),
            F.when(web, "HTTP/HTTPS Web Traffic").otherwise("Standard IP Session"),
        ).alias("app_label"),
        F.concat(
            F.lit("Policy: "),
            F.when(applied_rule() == "Default Perimeter Policy", "Access Policy Enforced").otherwise(applied_rule()),
        ).alias("rule_label"),
    ]
