"""Numeric features of canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.functions.plan import in_small_methods
from rampart.functions.taxonomy import BLOCKING, SEVERITY_RANK
from rampart.functions.text import round_half_even

# Feature names in vector order.
FEATURE_NAMES = [
    "src_port", "dst_port", "is_well_known_port", "is_ephemeral_src_port", "is_internal_src",
    "is_internal_dst", "direction_inbound", "direction_outbound", "direction_lateral",
    "direction_external", "proto_tcp", "proto_udp", "proto_icmp", "proto_other", "bytes_in_log",
    "bytes_out_log", "total_bytes_log", "bytes_ratio_out_in", "packets_total_log", "duration_sec",
    "bytes_per_second", "action_blocked", "action_allowed", "severity_level", "threat_flag",
    "threat_confidence",
]


def _flag(test: Column) -> Column:
    return F.when(test, 1.0).otherwise(0.0)


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("double")


def feature_columns() -> list[Column]:
    """The 26 features as columns over an event table, in vector order."""
    src_port, dst_port = _count("src_endpoint.port"), _count("dst_endpoint.port")
    protocol = F.lower(F.coalesce("connection_info.protocol_name", F.lit("")))
    tcp, udp, icmp = (F.contains(protocol, F.lit(name)) for name in ("tcp", "udp", "icmp"))
    bytes_in, bytes_out = _count("traffic.bytes_in"), _count("traffic.bytes_out")
    total = F.when(_count("traffic.total_bytes") != 0, _count("traffic.total_bytes")).otherwise(
        bytes_in + bytes_out
    )
    packets = F.when(_count("traffic.total_packets") != 0, _count("traffic.total_packets")).otherwise(
        _count("traffic.packets_in") + _count("traffic.packets_out")
    )
    seconds = _count("traffic.duration_ms") / 1000.0
    ranks = F.lit(0.0)
    for name, rank in SEVERITY_RANK.items():
        if rank:
            ranks = F.when(F.col("severity") == name, rank).otherwise(ranks)
    features = {
        "src_port": src_port,
        "dst_port": dst_port,
        "is_well_known_port": _flag((dst_port > 0) & (dst_port < 1024)),
        "is_ephemeral_src_port": _flag(src_port >= 49152),
        "is_internal_src": _flag(F.col("src_endpoint.is_internal")),
        "is_internal_dst": _flag(F.col("dst_endpoint.is_internal")),
        "proto_tcp": _flag(tcp),
        "proto_udp": _flag(udp),
        "proto_icmp": _flag(icmp),
        "proto_other": _flag(~(tcp | udp | icmp)),
        "bytes_in_log": round_half_even(F.log1p(bytes_in), 4),
        "bytes_out_log": round_half_even(F.log1p(bytes_out), 4),
        "total_bytes_log": round_half_even(F.log1p(total), 4),
        "bytes_ratio_out_in": round_half_even(F.log1p(bytes_out) / (F.log1p(bytes_in) + 1.0), 4),
        "packets_total_log": round_half_even(F.log1p(packets), 4),
        "duration_sec": round_half_even(seconds, 4),
        "bytes_per_second": round_half_even(total / (seconds + 0.001), 2),
        "action_blocked": _flag(F.col("disposition").isin(BLOCKING)),
        "action_allowed": _flag(F.col("disposition") == "Allowed"),
        "severity_level": ranks,
        "threat_flag": _flag(F.col("threat").isNotNull()),
        "threat_confidence": F.expr(in_small_methods("coalesce(threat.confidence_score, 0D)")),
    }
    for name in ("Inbound", "Outbound", "Lateral", "External"):
        features[f"direction_{name.lower()}"] = _flag(F.col("connection_info.direction") == name)
    return [features[name].alias(name) for name in FEATURE_NAMES]


def feature_matrix(events: DataFrame, *keep: str) -> DataFrame:
    """One row of 26 doubles per event, after the kept columns."""
    return events.select(*keep, *feature_columns())


def with_feature_vector(events: DataFrame, name: str = "features") -> DataFrame:
    """Add the features as one ``array<double>`` in vector order."""
    return events.withColumn(name, F.array(*feature_columns()))
