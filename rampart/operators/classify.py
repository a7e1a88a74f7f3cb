"""Which parser does a line belong to?

An ordered ladder of tests; the first hit wins.  Every regular expression stands
behind a plain substring test, so a line pays for a pattern only when it could
match at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.functions.plan import evaluate_once
from rampart.functions.text import char_count
from rampart.specs import SpecSet

# Line signatures.
CEF = r"CEF:\s*\d+\|"
LEEF = r"LEEF:\s*[\d\.]+\|"
CISCO_ASA = r"%ASA-\d+-\d+:"
CISCO_FTD = r"%FTD-\d+-\d+:"
CISCO_IOS = r"%(?:SEC_LOGIN|[A-Z0-9_]+)-\d+-[A-Z0-9_]+:"
SURICATA = r'"event_type"\s*:\s*"(?:alert|flow|dns|http|tls|netflow)"'
FORTINET_TEXTS = [
    "devname=", "logid=",
    "type=traffic", "type='traffic", 'type="traffic',
    "subtype=forward", "subtype='forward", 'subtype="forward',
]
PFSENSE = r"filterlog(?::|\[\d+\]:)?\s*\d+,\d+,"
PFSENSE_BODY = r",\d+,[a-zA-Z0-9_-]+,match,"
SNORT = r"\[\*\*\]\s*\[\d+:\d+:\d+\]"
ZEEK = r"(?:^#separator\s+|^\d+\.\d+\t\w+\t[\d\.]+\t\d+\t[\d\.]+\t\d+)"
PAN_TEXTS = [",TRAFFIC,", ",THREAT,", ",SYSTEM,"]
PAN_DATE = r"\d{4}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2}"


def _any(tests: list[Column]) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def classify(line: Column) -> Column:
    """``struct(parser_id, confidence)`` for a stripped line."""

    def has(text: str) -> Column:
        return F.contains(line, F.lit(text))

    def guarded(text: str, pattern: str) -> Column:
        return has(text) & line.rlike(pattern)

    json_like = F.startswith(line, F.lit("{")) | has('"event_type"')
    ladder = [
        (line == "", "generic_raw", 0.0),
        (guarded("CEF:", CEF), "generic_cef", 0.98),
        (guarded("LEEF:", LEEF), "generic_leef", 0.98),
        (guarded("%ASA-", CISCO_ASA), "cisco_asa", 0.99),
        (guarded("%FTD-", CISCO_FTD), "cisco_asa", 0.95),
        (guarded("%", CISCO_IOS), "cisco_ios", 0.95),
        (json_like & guarded('"event_type"', SURICATA), "suricata_eve", 0.99),
        (json_like & has('"src_ip"') & has('"dest_ip"'), "generic_json", 0.85),
        (_any([has(text) for text in FORTINET_TEXTS]), "fortinet_fortios", 0.95),
        (
            guarded("filterlog", PFSENSE)
            | guarded(",match,", PFSENSE_BODY)
            | has("filterlog:")
            | has("filterlog["),
            "pfsense_filterlog",
            0.95,
        ),
        (guarded("[**]", SNORT), "snort_fast", 0.95),
        (
            (F.startswith(line, F.lit("#separator")) & line.rlike(ZEEK))
            | (has("\t") & (line.rlike(ZEEK) | (char_count(line, "\t") >= 8))),
            "zeek_conn",
            0.90,
        ),
        (_any([has(text) for text in PAN_TEXTS]), "palo_alto_traffic", 0.95),
        ((char_count(line, ",") >= 15) & line.rlike(PAN_DATE), "palo_alto_traffic", 0.90),
        ((char_count(line, "=") >= 4) & (has(" ") | has(",")), "generic_kv", 0.80),
        (
            F.startswith(line, F.lit("<")) & F.contains(F.substring(line, 1, 5), F.lit(">")),
            "generic_syslog",
            0.75,
        ),
    ]
    route = F
    for test, parser_id, confidence in ladder:
        route = route.when(test, _verdict(parser_id, confidence))
    return route.otherwise(_verdict("generic_raw", 0.50))


def _verdict(parser_id: str, confidence: float) -> Column:
    return F.struct(F.lit(parser_id).alias("parser_id"), F.lit(confidence).alias("confidence"))


def with_parser(
    df: DataFrame, specs: SpecSet, *, line: str = "raw_event", parser_id: str | None = None
) -> DataFrame:
    """Add ``parser_id`` and ``confidence``.

    A known forced id is taken as is; an unknown one falls back to the ladder.
    """
    if parser_id and parser_id in specs:
        return df.select("*", F.lit(parser_id).alias("parser_id"), F.lit(1.0).alias("confidence"))
    routed = evaluate_once(df.select("*", classify(F.col(line)).alias("_route")))
    return routed.select(*df.columns, "_route.parser_id", "_route.confidence")
