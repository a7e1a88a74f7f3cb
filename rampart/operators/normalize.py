"""From raw lines to canonical events.

``normalize`` is one chain of projections and small-table joins: no shuffle, no
Python, and the same for batch and streaming.  Each canonical field is its own
column expression until the very end, so a query that only looks at a few fields
lets Catalyst drop the work for all the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.functions import taxonomy
from rampart.functions.plan import evaluate_once, in_small_methods
from rampart.functions.text import (
    last_wins_map_sql,
    literal,
    number_sql,
    string_map,
    strip,
    strip_sql,
)
from rampart.operators.classify import with_parser
from rampart.functions.session import stored
from rampart.operators.enrich import (
    Indicators,
    PlaceIndex,
    PrefixIndex,
    asks_distinct,
    prepared_indicators,
    with_indicator,
    with_network_context,
)
from rampart.operators.extract import syslog_meta, with_fields
from rampart.schema import DEFAULT_COLLECTOR, EVENT_COLUMNS, SCHEMA_VERSION
from rampart.specs import DEFAULT_KEYS, FALLBACK, SpecSet, shipped_specs

# Canonical field to working column.  Text fields count as missing when their
# value is "falsy" (empty text, JSON 0, false or []); number fields do not.
TEXT_FIELDS = {
    "src_endpoint.ip": "src_ip",
    "src_endpoint.zone": "src_zone",
    "dst_endpoint.ip": "dst_ip",
    "dst_endpoint.zone": "dst_zone",
    "connection_info.protocol": "protocol",
    "connection_info.session_id": "session_id",
    "disposition.action": "action",
    "severity.level": "level",
    "app_name": "app",
    "threat.signature_id": "signature_id",
    "threat.signature_name": "signature_name",
    "threat.category": "category",
    "timestamp": "event_time",
}
NUMBER_FIELDS = {
    "src_endpoint.port": "src_port",
    "dst_endpoint.port": "dst_port",
    "traffic.bytes_in": "bytes_in",
    "traffic.bytes_out": "bytes_out",
    "traffic.total_bytes": "bytes",
    "traffic.packets_in": "packets_in",
    "traffic.packets_out": "packets_out",
    "traffic.duration_ms": "duration_ms",
}
FIELDS = TEXT_FIELDS | NUMBER_FIELDS

# Numbers from here on do not fit their column: the token stays in ``unmapped`` and the
# event says so among its validation errors.
LIMITS = {name: 2.0**31 if name.endswith("_port") else 2.0**63 for name in NUMBER_FIELDS.values()}

# A JSON object of which nothing could be read (repeated members below the top level)
# makes an event invalid; its raw text stays.
NON_EMPTY_OBJECT = r"\{\s*+[^\s}]"
UNREAD_JSON = "JSON object could not be read"

# Fixed value: what makes an event invalid is a number too large to be finite.
OVERFLOW_ERROR = "cannot convert float infinity to integer"


# ------------------------------------------------------------------- spec lookups
def _per_parser(values: dict[str, str], default: str) -> str:
    """Value of the row's parser from a literal map (SQL fragments as values)."""
    differing = {k: v for k, v in values.items() if v != default}
    if not differing:
        return default
    pairs = ", ".join(f"{literal(k)}, {v}" for k, v in differing.items())
    return f"coalesce(try_element_at(map({pairs}), parser_id), {default})"


def _spec_text(specs: SpecSet, attribute: str) -> str:
    values = {s.id: literal(getattr(s, attribute)) for s in specs}
    return _per_parser(values, literal(FALLBACK[attribute]))


def _source_key(specs: SpecSet, canonical: str) -> str:
    """Token that feeds a canonical field of the row.

    A single-key rule names its token outright (one literal map for all such
    parsers); a list takes its first token with a value.
    """

    def first_present(keys: list[str]) -> str:
        tests = " ".join(f"WHEN fields[{literal(k)}] IS NOT NULL THEN {literal(k)}" for k in keys)
        return f"CASE {tests} END" if keys else "CAST(NULL AS STRING)"

    single: dict[str, str] = {}
    lists: dict[tuple[str, ...], list[str]] = {}
    for spec in specs:
        keys, is_single = spec.source_keys(canonical)
        if is_single:
            single[spec.id] = keys[0]
        elif keys != DEFAULT_KEYS[canonical]:
            lists.setdefault(tuple(keys), []).append(spec.id)
    branches = " ".join(
        f"WHEN parser_id IN ({', '.join(literal(i) for i in ids)}) THEN {first_present(list(keys))}"
        for keys, ids in lists.items()
    )
    default = first_present(DEFAULT_KEYS[canonical])
    by_list = f"CASE {branches} ELSE {default} END" if branches else default
    if not single:
        return by_list
    return f"coalesce(try_element_at({string_map(single)}, parser_id), {by_list})"


def _custom_actions(specs: SpecSet) -> str:
    """Verb translations of the row's parser, resolved to dispositions."""
    values = {}
    for spec in specs:
        verbs = spec.value_maps.get("disposition.action") or {}
        values[spec.id] = string_map(
            {k: taxonomy.action_name(v) for k, v in verbs.items() if isinstance(k, str)}
        )
    return _per_parser(values, string_map({}))


# ------------------------------------------------------------------------ operators
def with_source_values(df: DataFrame, specs: SpecSet) -> DataFrame:
    """Resolve every canonical field to its source value (``v_*``) and collect
    what no field used in ``unmapped``."""
    falsy = "map_keys(map_filter(json_literals, (k, v) -> v IN ('false', '[]') OR try_cast(v AS DOUBLE) = 0))"
    keyed = df.select(
        "*",
        *[F.expr(_source_key(specs, canonical)).alias(f"k_{name}") for canonical, name in FIELDS.items()],
        F.expr(falsy).alias("_falsy"),
    )
    text = "CASE WHEN fields[{0}] <> '' AND NOT coalesce(array_contains(_falsy, {0}), false) THEN fields[{0}] END"
    used = f"array_compact(array({', '.join(f'k_{n}' for n in FIELDS.values())}))"
    # The keys in use are bound once per row, not worked out again for every token.
    unmapped = (
        f"get(transform(array({used}), used -> map_filter(fields, (k, v) ->"
        f" NOT startswith(k, '_syslog') AND NOT array_contains(used, k))), 0)"
    )
    return keyed.select(
        *df.columns,
        *[F.expr(text.format(f"k_{n}")).alias(f"v_{n}") for n in TEXT_FIELDS.values()],
        *[F.expr(f"fields[k_{n}]").alias(f"v_{n}") for n in NUMBER_FIELDS.values()],
        *[f"k_{n}" for n in NUMBER_FIELDS.values()],
        F.expr(unmapped).alias("unmapped"),
    )


def with_typed_values(df: DataFrame, specs: SpecSet) -> DataFrame:
    """Types, defaults and vocabularies on top of the source values.

    A row with an infinite number keeps its raw text and hash, gets ``error`` and
    otherwise looks like an event about which nothing is known.
    """
    base = [c for c in df.columns if not c.startswith(("v_", "k_"))]
    texts = [f"v_{n}" for n in TEXT_FIELDS.values()]
    numbers = [f"n_{n}" for n in NUMBER_FIELDS.values()]
    tokens = [f"{part}_{n}" for part in "kv" for n in NUMBER_FIELDS.values()]
    df = df.select(
        *base, *texts, *tokens, *[F.expr(number_sql(f"v_{n}")).alias(f"n_{n}") for n in NUMBER_FIELDS.values()]
    )
    infinite = " OR ".join(f"abs({n}) = double('Infinity')" for n in numbers)
    error = F.expr(f"CASE WHEN {infinite} THEN {literal(OVERFLOW_ERROR)} END").alias("error")
    # Numbers too large for their column, as (field, token, text).
    large = ", ".join(
        f"CASE WHEN abs(n_{n}) >= double({limit!r}) THEN named_struct('field', {literal(n)}, 'k', k_{n}, 'v', v_{n}) END"
        for n, limit in LIMITS.items()
    )
    df = evaluate_once(df).select("*", error, F.expr(f"array_compact(array({large}))").alias("_large"))
    back = last_wins_map_sql(
        "concat(map_keys(unmapped), transform(_large, e -> e.k))", "concat(map_values(unmapped), transform(_large, e -> e.v))"
    )
    kept_tokens = f"CASE WHEN error IS NOT NULL THEN map('parse_error', error) WHEN size(_large) = 0 THEN unmapped ELSE {back} END"
    json_ids = ", ".join(map(literal, specs.ids("json"))) or "NULL"
    unread = f"(parser_id IN ({json_ids}) AND size(fields) = 0 AND payload RLIKE {literal(NON_EMPTY_OBJECT)})"
    notes = (
        f"CASE WHEN error IS NOT NULL THEN array(error) WHEN {unread} THEN array({literal(UNREAD_JSON)})"
        " ELSE transform(_large, e -> concat(e.field, ' out of range')) END"
    )

    def valid(column: str) -> Column:
        return F.when(F.col("error").isNull(), F.col(column))

    df = df.select(
        *[c for c in base if c not in ("parser_id", "unmapped")],
        "error",
        F.coalesce(valid("parser_id"), F.lit("unknown")).alias("parser_id"),
        F.expr(kept_tokens).alias("unmapped"),
        F.expr(notes).alias("notes"),
        *[valid(t).alias(t) for t in texts],
        *[
            F.expr(f"CASE WHEN error IS NULL AND abs(n_{n}) < double({limit!r}) THEN CAST(n_{n} AS BIGINT) END").alias(f"n_{n}")
            for n, limit in LIMITS.items()
        ],
    )
    df = evaluate_once(df)
    kept = [c for c in df.columns if c not in texts and c not in numbers]
    unknown = "CASE WHEN error IS NULL THEN {0} ELSE {1} END"
    is_ssh = "(try_cast(n_dst_port AS INT) = 22 OR try_cast(n_src_port AS INT) = 22)"
    protocol = f"{strip_sql('v_protocol')}"
    expressions = {
        "vendor_name": unknown.format(_spec_text(specs, "vendor"), "'Unknown'"),
        "product_name": unknown.format(_spec_text(specs, "product"), "'Unknown'"),
        "parser_version": unknown.format(_spec_text(specs, "version"), "'1.0.0'"),
        "event_timestamp": "v_event_time",
        "src_ip": strip_sql("v_src_ip"),
        "src_port": "try_cast(n_src_port AS INT)",
        "src_zone": strip_sql("v_src_zone"),
        "dst_ip": strip_sql("v_dst_ip"),
        "dst_port": "try_cast(n_dst_port AS INT)",
        "dst_zone": strip_sql("v_dst_zone"),
        "_protocol": f"coalesce({protocol}, CASE WHEN {is_ssh} THEN 'tcp' END)",
        "session_id": "v_session_id",
        "bytes_in": "coalesce(n_bytes_in, 0L)",
        "bytes_out": "coalesce(n_bytes_out, 0L)",
        "total_bytes": "coalesce(n_bytes, try_add(coalesce(n_bytes_in, 0L), coalesce(n_bytes_out, 0L)))",
        "packets_in": "coalesce(n_packets_in, 0L)",
        "packets_out": "coalesce(n_packets_out, 0L)",
        "total_packets": "try_add(coalesce(n_packets_in, 0L), coalesce(n_packets_out, 0L))",
        "duration_ms": "coalesce(n_duration_ms, 0L)",
        "vendor_disposition": (
            f"coalesce(try_element_at({_custom_actions(specs)}, lower(v_action)),"
            f" {taxonomy.action_sql('v_action')}, 'Unknown')"
        ),
        "vendor_severity": "v_level",
        "vendor_severity_level": taxonomy.severity_sql("v_level"),
        "app_name": f"coalesce({strip_sql('v_app')}, CASE WHEN {is_ssh} THEN 'ssh' END)",
        "vendor_threat": (
            "CASE WHEN v_signature_id IS NOT NULL OR v_signature_name IS NOT NULL THEN"
            " named_struct('signature_id', v_signature_id, 'signature_name', v_signature_name,"
            " 'category', v_category, 'cve', CAST(NULL AS STRING), 'threat_actor', CAST(NULL AS STRING),"
            " 'indicator_matched', CAST(NULL AS STRING), 'confidence_score', CAST(NULL AS DOUBLE)) END"
        ),
    }
    return df.select(*kept, *[F.expr(sql).alias(name) for name, sql in expressions.items()])


def event_id(id_columns: list[str] | None, collector: str) -> Column:
    """Random id, or one derived from key columns (the same on every run)."""
    if not id_columns:
        return F.uuid()
    key = F.concat_ws("\x01", F.lit(collector), *[F.col(c).cast("string") for c in id_columns])
    digest = F.sha2(key, 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def normalize(
    df: DataFrame,
    *,
    raw_col: str = "raw_event",
    specs: SpecSet | None = None,
    parser_id: str | None = None,
    parsers: list[str] | None = None,
    mode: str = "air_gapped",
    indicators: DataFrame | Indicators | None = None,
    places: PlaceIndex | PrefixIndex | None = None,
    collector_id: str = DEFAULT_COLLECTOR,
    id_cols: list[str] | None = None,
    ingested_at: Column | None = None,
    keep: list[str] | None = None,
    details: bool = False,
) -> DataFrame:
    """One canonical event per input row.

    ``raw_col``      string column holding the line
    ``specs``        parser specs (default: the shipped ones)
    ``parser_id``    parser to use for every line instead of classifying
    ``parsers``      only lines of these parsers; others go before any field is cut, and
                     what their specs would need is left out of the plan (default: all)
    ``mode``         ``air_gapped`` or ``internet``; tags indicator names
    ``indicators``   threat table keyed by ``ip``, or the result of
                     ``prepared_indicators`` (default: the shipped one)
    ``places``       result of ``place_index`` or ``prefix_index`` (default: the shipped
                     networks)
    ``id_cols``      input columns that identify a row, for repeatable event ids
    ``ingested_at``  ingestion time (default: start of the query)
    ``keep``         input columns to pass through
    ``details``      also return ``confidence``, ``fields``, ``syslog_meta`` and
                     ``json_literals``

    With a lookup table too large for a broadcast, a batch of events is stored in the
    shared folder between parsing and the lookups, so lines are parsed once.
    """
    specs = shipped_specs() if specs is None else specs
    keep = list(keep or [])
    source = df.select(
        strip(F.col(raw_col)).alias("raw_event"),
        *[F.col(c).alias(f"keep_{c}") for c in keep],
        event_id(id_cols, collector_id).alias("event_id"),
        (F.current_timestamp() if ingested_at is None else ingested_at.cast("timestamp")).alias("ingested_at"),
    )
    # The event id is fixed here, before anything that could be evaluated twice.
    routed = with_parser(source, specs, parser_id=parser_id)
    if parsers is not None:
        routed = routed.where(F.col("parser_id").isin(list(parsers)))
        specs = SpecSet(spec for spec in specs if spec.id in parsers)
    parsed = evaluate_once(with_fields(routed, specs))
    typed = with_typed_values(evaluate_once(with_source_values(parsed, specs)), specs)
    if isinstance(indicators, DataFrame):
        indicators = prepared_indicators(indicators)
    typed, kept_rows = evaluate_once(typed), None
    if not typed.isStreaming and asks_distinct(places, indicators):
        typed = kept_rows = stored(typed, "parsed")
    placed = with_network_context(typed, places, source=kept_rows)
    matched = with_indicator(placed, indicators, mode=mode, source=kept_rows)
    return _as_event(evaluate_once(matched), collector_id, keep, details)


def _as_event(df: DataFrame, collector_id: str, keep: list[str], details: bool) -> DataFrame:
    """Nest the working columns into the canonical layout."""
    col = F.col
    none = F.lit(None).cast("string")

    def endpoint(side: str) -> Column:
        named = {
            "ip": col(f"{side}_ip"),
            "port": col(f"{side}_port"),
            "hostname": none,
            "mac": none,
            "zone": col(f"{side}_zone"),
            "interface": none,
            "is_internal": col(f"{side}_is_internal"),
            "country": col(f"{side}_country"),
            "city": col(f"{side}_city"),
            "asn": col(f"{side}_asn"),
        }
        return F.struct(*[value.alias(name) for name, value in named.items()]).alias(f"{side}_endpoint")

    # An indicator only counts where the vendor itself reported no threat.
    escalate = col("vendor_threat").isNull() & col("indicator").isNotNull()
    columns = {
        "raw_event": col("raw_event"),
        "lineage": F.struct(
            "event_id",
            F.sha2("raw_event", 256).alias("raw_hash"),
            F.lit(collector_id).alias("collector_id"),
            "parser_id",
            "parser_version",
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            col("ingested_at").alias("ingestion_timestamp"),
            "event_timestamp",
            (col("error").isNull() & ~F.array_contains("notes", UNREAD_JSON)).alias("is_valid"),
            col("notes").alias("validation_errors"),
        ),
        "product": F.struct(
            "vendor_name", "product_name", none.alias("product_version"), none.alias("feature")
        ),
        "src_endpoint": endpoint("src"),
        "dst_endpoint": endpoint("dst"),
        "connection_info": F.struct(
            F.expr(taxonomy.protocol_name_sql("_protocol")).alias("protocol_name"),
            F.expr(taxonomy.protocol_number_sql("_protocol")).alias("protocol_num"),
            "direction",
            "session_id",
            none.alias("tcp_flags"),
            none.alias("state"),
        ),
        "traffic": F.struct(
            "bytes_in", "bytes_out", "total_bytes", "packets_in", "packets_out", "total_packets", "duration_ms"
        ),
        "disposition": F.expr(
            in_small_methods(
                "CASE WHEN vendor_threat IS NULL AND indicator IS NOT NULL AND vendor_disposition = 'Unknown'"
                " THEN 'Alerted' ELSE vendor_disposition END"
            )
        ),
        "disposition_reason": none,
        "severity": F.when(
            escalate & col("vendor_severity_level").isin("Informational", "Low"), "High"
        ).otherwise(col("vendor_severity_level")),
        "vendor_severity": col("vendor_severity"),
        "app_name": col("app_name"),
        "url": none,
        "domain": none,
        "threat": F.coalesce("vendor_threat", "indicator"),
        "unmapped": col("unmapped"),
    }
    extra = []
    if details:
        extra = ["confidence", "fields", syslog_meta(col("syslog_pri")).alias("syslog_meta"), "json_literals"]
    return df.select(
        *[columns[name].alias(name) for name in EVENT_COLUMNS],
        *extra,
        *[col(f"keep_{c}").alias(c) for c in keep],
    )


def verify_integrity(event_hash: Column | None = None) -> Column:
    """Does the stored hash still match the raw text?"""
    stored = F.col("lineage.raw_hash") if event_hash is None else event_hash
    return stored == F.sha2("raw_event", 256)
