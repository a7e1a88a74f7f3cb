"""Attack technique, compliance citations, risk score and narrative of an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.functions.taxonomy import BLOCKING

# Fixed values: (tactic id, tactic, technique id, technique, page) by rule.
_PAGE = "https://attack.mitre.org/techniques/"
TECHNIQUES = {
    "scan": ("TA0043", "Reconnaissance", "T1046", "Network Service Discovery", _PAGE + "T1046/"),
    "rdp": ("TA0001", "Initial Access", "T1021.001", "Remote Services: Remote Desktop Protocol", _PAGE + "T1021/"),
    "ssh": ("TA0001", "Initial Access", "T1021.004", "Remote Services: SSH", _PAGE + "T1021/"),
    "tor": ("TA0011", "Command and Control", "T1090.003", "Proxy: Multi-hop Proxy (Tor)", _PAGE + "T1090/003/"),
    "exfiltration": ("TA0010", "Exfiltration", "T1048", "Exfiltration Over Alternative Protocol", _PAGE + "T1048/"),
    "web": ("TA0011", "Command and Control", "T1071.001", "Application Layer Protocol: Web Protocols", _PAGE + "T1071/001/"),
    "other": ("TA0005", "Defense Evasion", "T1562.004", "Impair Defenses: Disable or Modify System Firewall", _PAGE + "T1562/004/"),
}
TECHNIQUE_PARTS = ["tactic_id", "tactic_name", "technique_id", "technique_name", "url"]

# Citations that hold for every perimeter event.
COMPLIANCE = {
    "pci_dss": [
        "Req 10.2.1 (Audit log generation for perimeter ingress/egress)",
        "Req 10.2.4 (Log access to all firewall and perimeter security functions)",
        "Req 1.3 (Prohibit direct public access between Internet and Cardholder Data)",
    ],
    "nist_800_53": [
        "AC-4 (Information Flow Enforcement via Perimeter Gateways)",
        "AU-12 (Audit Record Generation & Non-Repudiation)",
        "SC-7 (Boundary Protection)",
    ],
    "iso_27001": [
        "Control A.12.4.1 (Event Logging & System Activity Monitoring)",
        "Control A.13.1.1 (Network Controls & Segregation)",
    ],
    "hipaa": [
        "164.312(b) (Audit Controls on Network Transmission)",
        "164.312(e)(1) (Transmission Security across Public Networks)",
    ],
    "gdpr": [
        "Article 32(1)(b) (Ability to ensure ongoing confidentiality and resilience)",
        "Article 33 (Breach notification and audit trail traceability)",
    ],
}

# Keys that may name the rule a device applied, and texts around it.
RULE_KEYS = ["rule_name", "policyid", "rule", "access-group"]
DEFAULT_RULE = "Default Perimeter Policy"


def _port() -> Column:
    return F.coalesce(F.col("dst_endpoint.port"), F.lit(0))


def _skew(floor: int, ratio: float) -> Column:
    """More than ``floor`` bytes out and more than ``ratio`` times the bytes in."""
    out = F.coalesce(F.col("traffic.bytes_out"), F.lit(0))
    into = F.coalesce(F.col("traffic.bytes_in"), F.lit(0))
    return (out > floor) & (out / (into + 1) > ratio)


def attack_technique() -> Column:
    """First matching technique rule, as a struct."""
    threat = F.col("threat").isNotNull()
    name = F.lower(F.coalesce("threat.signature_name", F.lit("")))
    blocked = F.col("disposition").isin(BLOCKING)
    rules = [
        (threat & (F.contains(name, F.lit("scan")) | _port().isin(23, 2323)), "scan"),
        ((_port() == 3389) & blocked, "rdp"),
        ((_port() == 22) & blocked, "ssh"),
        (threat & F.contains(name, F.lit("tor")), "tor"),
        (_skew(50000, 3.0), "exfiltration"),
        (_port().isin(80, 443, 8080), "web"),
    ]

    def technique(key: str) -> Column:
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(TECHNIQUE_PARTS, TECHNIQUES[key])])

    ladder = F
    for test, key in rules:
        ladder = ladder.when(test, technique(key))
    return ladder.otherwise(technique("other"))


def compliance_citations() -> Column:
    """The citations as a constant struct of string arrays."""
    return F.struct(
        *[F.array(*[F.lit(text) for text in texts]).alias(name) for name, texts in COMPLIANCE.items()]
    )


def _risk_terms() -> list[tuple[Column, int, Column]]:
    """Tests, points and explanations of the risk score."""
    # A threat without a name shows up as the text None.
    threat_name = F.coalesce("threat.signature_name", F.lit("None"))
    return [
        (F.col("threat").isNotNull(), 50, F.concat(F.lit("Threat Match: "), threat_name, F.lit(" (+50)"))),
        (
            F.col("disposition").isin(BLOCKING),
            20,
            F.lit("Security Policy Enforced: Connection Blocked/Dropped (+20)"),
        ),
        (
            _port().isin(3389, 22, 23, 445, 139),
            15,
            F.concat(
                F.lit("Sensitive Remote Management Port ("),
                _port().cast("string"),
                F.lit(") Targeted (+15)"),
            ),
        ),
        (
            F.col("connection_info.direction") == "Inbound",
            10,
            F.lit("Inbound Public Traffic into Internal Perimeter (+10)"),
        ),
        (_skew(20000, 2.5), 15, F.lit("Abnormal Outbound/Inbound Byte Volume Ratio (+15)")),
    ]


def risk_score() -> Column:
    score = F.lit(15)
    for test, points, _ in _risk_terms():
        score = score + F.when(test, points).otherwise(0)
    return F.least(F.greatest(score, F.lit(5)), F.lit(100))


def risk_level(score: Column) -> Column:
    return F.when(score >= 75, "Critical").when(score >= 50, "High").when(score >= 30, "Medium").otherwise("Low")


def risk_factors() -> Column:
    return F.array_compact(F.array(*[F.when(test, text) for test, _, text in _risk_terms()]))


def with_risk(events: DataFrame) -> DataFrame:
    """Add ``mitre``, ``compliance`` and ``risk`` (score, level, factors)."""
    scored = events.select(
        "*",
        attack_technique().alias("mitre"),
        compliance_citations().alias("compliance"),
        risk_score().alias("_score"),
    )
    risk = F.struct(
        F.col("_score").alias("score"),
        risk_level(F.col("_score")).alias("level"),
        risk_factors().alias("factors"),
    )
    return scored.withColumn("risk", risk).drop("_score")


def endpoint_text(side: str, unknown: str) -> Column:
    """``ip:port``, or the bare address when there is no port.

    With a port but no address the address reads None.
    """
    ip, port = F.col(f"{side}.ip"), F.col(f"{side}.port")
    return F.when(
        F.coalesce(port, F.lit(0)) != 0,
        F.concat(F.coalesce(ip, F.lit("None")), F.lit(":"), port.cast("string")),
    ).otherwise(F.coalesce(F.nullif(ip, F.lit("")), F.lit(unknown)))


def applied_rule() -> Column:
    """Name of the rule a device applied, from the first rule key with a value."""
    values = [F.nullif(F.col("unmapped")[key], F.lit("")) for key in RULE_KEYS]
    return F.coalesce(*values, F.lit(DEFAULT_RULE))


def protocol_text() -> Column:
    return F.upper(F.coalesce(F.nullif(F.col("connection_info.protocol_name"), F.lit("")), F.lit("IP")))


def narrative() -> Column:
    """One plain sentence per event."""
    src, dst = endpoint_text("src_endpoint", "Unknown Source"), endpoint_text("dst_endpoint", "Unknown Target")

    def location(side: str, internal: str) -> Column:
        place = F.coalesce(F.nullif(F.col(f"{side}.country"), F.lit("")), F.lit("Public Internet"))
        return F.when(F.col(f"{side}.is_internal"), internal).otherwise(place)

    src_at = location("src_endpoint", "Internal LAN")
    dst_at = location("dst_endpoint", "Internal Protected LAN")
    vendor = F.col("product.vendor_name")
    # The two sentence templates.
    allowed = F.format_string(
        "Authorized network connection permitted from %s (%s) to %s (%s) over %s. Firewall policy '%s' on %s granted %s session. Zero active security violations detected.",
        src, src_at, dst, dst_at, protocol_text(), applied_rule(), vendor,
        F.lower("connection_info.direction"),
    )
    stopped = F.format_string(
        "Perimeter security policy '%s' on %s actively BLOCKED traffic from %s (%s) targeting %s (%s) via %s. Ingress inspection resulted in an immediate %s decision to protect internal resources.",
        applied_rule(), vendor, src, src_at, dst, dst_at, protocol_text(), F.col("disposition"),
    )
    return F.when(F.col("disposition") == "Allowed", allowed).otherwise(stopped)
