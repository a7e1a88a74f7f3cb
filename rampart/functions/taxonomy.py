"""Shared vocabularies for action, severity and protocol."""

from __future__ import annotations

from rampart.functions.text import literal, string_map, strip_sql

# Disposition names.
DISPOSITIONS = ["Allowed", "Blocked", "Dropped", "Reset", "Alerted", "Quarantined", "Unknown"]
BLOCKING = ["Blocked", "Dropped", "Reset"]

# Severity names with their rank as a model feature.
SEVERITY_RANK = {
    "Informational": 0.0,
    "Low": 1.0,
    "Medium": 2.0,
    "High": 3.0,
    "Critical": 4.0,
    "Fatal": 5.0,
    "Unknown": 0.0,
}

# Vendor verb to disposition.
ACTION_WORDS = {
    "Allowed": ["allow", "allowed", "accept", "accepted", "permit", "permitted", "pass", "success", "open", "built", "teardown"],
    "Blocked": ["deny", "denied", "block", "blocked", "reject", "rejected", "disallowed"],
    "Dropped": ["drop", "dropped"],
    "Reset": ["reset", "reset-server", "reset-client", "reset-both"],
    "Alerted": ["alert", "alerted", "alarm"],
    "Quarantined": ["quarantine", "quarantined"],
}

# Vendor severity text or syslog digit to severity.
SEVERITY_WORDS = {
    "Fatal": ["0", "emerg", "emergency", "fatal"],
    "Critical": ["1", "2", "alert", "crit", "critical"],
    "High": ["3", "err", "error", "high"],
    "Medium": ["4", "warn", "warning", "medium"],
    "Low": ["5", "notice", "low"],
    "Informational": ["6", "7", "info", "informational", "debug"],
}

# IP protocol numbers and names.
PROTOCOLS = {
    1: "ICMP",
    2: "IGMP",
    6: "TCP",
    17: "UDP",
    47: "GRE",
    50: "ESP",
    51: "AH",
    58: "IPv6-ICMP",
    89: "OSPF",
    132: "SCTP",
}


def _by_word(groups: dict[str, list[str]]) -> dict[str, str]:
    return {word: name for name, words in groups.items() for word in words}


ACTION_BY_WORD = _by_word(ACTION_WORDS)
SEVERITY_BY_WORD = _by_word(SEVERITY_WORDS)


def action_name(word: object) -> str:
    """Disposition for one verb of a parser spec (used when specs are compiled)."""
    text = str(word) if word else ""
    if text in DISPOSITIONS:
        return text
    return ACTION_BY_WORD.get(text.strip().lower(), "Unknown")


def action_sql(verb: str) -> str:
    """Disposition of a verb, NULL when the vocabulary does not know it."""
    return f"try_element_at({string_map(ACTION_BY_WORD)}, lower({strip_sql(verb)}))"


def severity_sql(word: str) -> str:
    """Severity of a word; unknown or missing is Informational."""
    found = f"try_element_at({string_map(SEVERITY_BY_WORD)}, lower({strip_sql(word)}))"
    return f"coalesce({found}, 'Informational')"


def protocol_name_sql(text: str) -> str:
    """Canonical protocol name of a number or a name; ``unknown`` when missing."""
    by_number = string_map({str(n): name for n, name in PROTOCOLS.items()})
    digits = f"coalesce(nullif(ltrim('0', {text}), ''), '0')"
    return (
        f"CASE WHEN {text} IS NULL THEN 'unknown'"
        f" WHEN {text} RLIKE '^[0-9]+$' THEN"
        f" upper(coalesce(try_element_at({by_number}, {digits}), concat('IP-', {digits})))"
        f" ELSE upper({text}) END"
    )


def protocol_number_sql(text: str) -> str:
    """Protocol number of a number or a name.

    Names are compared in upper case, so the one mixed-case name never resolves.
    """
    pairs = ", ".join(f"{literal(name)}, {number}" for number, name in PROTOCOLS.items())
    return (
        f"CASE WHEN {text} RLIKE '^[0-9]+$' THEN try_cast({text} AS INT)"
        f" ELSE try_element_at(map({pairs}), upper({text})) END"
    )
