"""From a line to its raw tokens.

``with_fields`` works in three narrow projections over the same rows, with no
shuffle and no Python: payload, captured cells, then token keys and values.  The
last step turns them into one ``map<string,string>``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.functions.plan import evaluate_once
from rampart.functions.text import SPACE_CLASS, last_wins_map_sql, literal, string_array, strip_sql
from rampart.specs import ParserSpec, SpecSet

# Header layouts of the two vendor-neutral formats.
CEF_HEADER = r"^(?:<(?:\d+)>)?\s*(?:[A-Za-z]{3}\s+\d+\s+[\d:]+\s+\S+\s+)?CEF:\s*(\d+)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|(.*)$"
CEF_KEYS = ["cef_version", "device_vendor", "device_product", "device_version", "device_event_class_id", "event_name", "severity"]
LEEF_HEADER = r"^(?:<(?:\d+)>)?\s*(?:[A-Za-z]{3}\s+\d+\s+[\d:]+\s+\S+\s+)?LEEF:\s*([\d\.]+)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|(?:(0x[0-9a-fA-F]+|[^\w|])\|)?(.*)$"
LEEF_KEYS = ["leef_version", "device_vendor", "device_product", "device_version", "event_id"]

# One key=value pair.  Key characters are possessive and may not be preceded by
# another key character: the same pairs are found, but a long word without "="
# is scanned once instead of once per letter.  (Java's \w is [a-zA-Z0-9_], and
# several times faster than spelling that out.)
KEY_VALUE = rf"""(?<![\w.\-])([\w.\-]++)[{SPACE_CLASS}]*+=[{SPACE_CLASS}]*+("[^"]*+"|'[^']*+'|[^{SPACE_CLASS},]++)"""

MARK = "\x01"  # separates captured groups within one string


# --------------------------------------------------------------------- fragments
def key_value_sql(text: str) -> tuple[str, str]:
    """Keys and values of all ``key=value`` pairs; an empty quoted value is NULL."""
    keys = f"regexp_extract_all({text}, {literal(KEY_VALUE)}, 1)"
    # A value that starts and ends with the same quote can only have matched a
    # quoted alternative, so the quotes go.
    quoted = "length(v) > 1 AND left(v, 1) IN ('\"', '\\'') AND right(v, 1) = left(v, 1)"
    vals = (
        f"transform(regexp_extract_all({text}, {literal(KEY_VALUE)}, 2),"
        f" v -> nullif(CASE WHEN {quoted} THEN substr(v, 2, length(v) - 2) ELSE v END, ''))"
    )
    return keys, vals


def capture_sql(text: str, java: str, numbers: list[int]) -> str:
    """Captured groups of the first match as an array, NULL without a match.

    One replace pass writes all groups behind markers and one split cuts them,
    instead of one scan per group.  Text that holds the marker goes group by group.
    """
    flags, body = ("(?d)", java.removeprefix("(?d)"))
    whole = f"{flags}^(?s:.*?)(?:{body})(?s:.*)$"
    template = "".join(f"{MARK}${n}" for n in numbers)
    one_pass = (
        f"get(transform(array(regexp_replace({text}, {literal(whole)}, {literal(template)})),"
        f" r -> CASE WHEN startswith(r, {literal(MARK)})"
        f" THEN slice(split(r, {literal(MARK)}), 2, {len(numbers)}) END), 0)"
    )
    wanted = ", ".join(str(n) for n in numbers)
    per_group = f"transform(array({wanted}), n -> regexp_extract({text}, {literal(java)}, n))"
    return (
        f"CASE WHEN NOT contains({text}, {literal(MARK)}) THEN {one_pass}"
        f" WHEN {text} RLIKE {literal(java)} THEN {per_group} END"
    )


def csv_cells_sql(text: str, delimiter: str) -> str:
    """Cells of the first CSV row, NULL for an empty or malformed one.

    Without quotes this is a split; with quotes one pattern walks cell by cell.
    """
    if len(delimiter) != 1:
        return "CAST(NULL AS ARRAY<STRING>)"
    mark = delimiter if delimiter.isalnum() else "\\" + delimiter
    first_row = f"regexp_replace(substring_index({text}, '\\n', 1), '\\r$', '')"
    plain = f"CASE WHEN NOT contains({first_row}, '\\r') THEN split({first_row}, {literal(mark)}, -1) END"
    # After the delimiter: a quoted part (doubled quotes inside) with whatever
    # follows it, or an unquoted cell.  The text gets one delimiter in front.
    cell = (
        rf'\G{mark}(?:"((?:[^"]++|"")*+)(?:"([^{mark}\r\n]*+)|$)|([^"{mark}\r\n][^{mark}\r\n]*+|))'
    )
    lead = f"concat({literal(delimiter)}, {text})"
    group = [f"regexp_extract_all({lead}, {literal(cell)}, {n})" for n in (1, 2, 3)]
    quoted = (
        f"zip_with(zip_with({group[0]}, {group[1]}, (q, t) -> concat(replace(q, '\"\"', '\"'), t)),"
        f" {group[2]}, (q, u) -> concat(q, u))"
    )
    return f"CASE WHEN {text} = '' THEN NULL WHEN contains({text}, '\"') THEN {quoted} ELSE {plain} END"


def csv_tokens_sql(cells: str, columns: tuple[str, ...]) -> tuple[str, str]:
    """Named cells; missing ones are NULL and surplus ones are numbered."""
    count = len(columns)
    surplus = f"greatest(size({cells}) - {count}, 0)"
    keys = (
        f"concat({string_array(columns)},"
        f" transform(slice({cells}, {count + 1}, {surplus}),"
        f" (c, i) -> concat('extra_col_', i + {count})))"
    )
    missing = f"array_repeat(CAST(NULL AS STRING), greatest({count} - size({cells}), 0))"
    vals = (
        f"concat(transform(slice({cells}, 1, {count}), c -> {strip_sql('c')}), {missing},"
        f" transform(slice({cells}, {count + 1}, {surplus}), c -> {strip_sql('c')}))"
    )
    return keys, vals


def regex_tokens_sql(cells: str, spec: ParserSpec) -> tuple[str, str]:
    vals = ", ".join(
        f"nullif(get({cells}, {i}), '')" if missing else f"get({cells}, {i})"
        for i, missing in enumerate(spec.pattern.empty_is_missing)
    )
    return string_array(spec.pattern.names), f"array({vals})"


def cef_tokens_sql(cells: str) -> tuple[str, str]:
    """Header tokens followed by the extension, whose keys win."""
    keys, vals = key_value_sql(f"get({cells}, 7)")
    header = f"array(get({cells}, 0), " + ", ".join(
        strip_sql(f"get({cells}, {i})") for i in range(1, 7)
    ) + ")"
    return f"concat({string_array(CEF_KEYS)}, {keys})", f"concat({header}, {vals})"


def leef_tokens_sql(cells: str) -> tuple[str, str]:
    """Header tokens followed by the delimited extension.

    When the extension adds no key of its own, the key=value scan is added.
    """
    extension = f"get({cells}, 6)"
    given = f"get({cells}, 5)"
    digits = f"lower(ltrim('0', substr({given}, 3)))"
    # 0x.. names one code point; beyond Unicode it falls back to a tab.
    usable = f"length({digits}) <= 6 AND lpad({digits}, 6, '0') <= '10ffff' AND NOT {digits} RLIKE '^d[89a-f]..$'"
    delimiter = (
        f"CASE WHEN {given} = '' THEN '\\t' WHEN NOT startswith({given}, '0x') THEN {given}"
        f" WHEN {usable}"
        f" THEN decode(unhex(lpad({digits}, 8, '0')), 'UTF-32') ELSE '\\t' END"
    )
    pairs = (
        f"transform(filter(split({extension}, concat('\\\\Q', {delimiter}, '\\\\E'), -1),"
        f" p -> contains(p, '=')), p -> struct("
        f"{strip_sql(_before_equals('p'))} AS k, {strip_sql(_after_equals('p'))} AS v))"
    )
    header_vals = f"array(get({cells}, 0), " + ", ".join(
        strip_sql(f"get({cells}, {i})") for i in range(1, 5)
    ) + ")"
    kv_keys, kv_vals = key_value_sql(extension)
    header_keys = string_array(LEEF_KEYS)

    def build(header: str, part: str, scanned: str) -> str:
        return (
            f"get(transform(array({pairs}), e -> concat({header}, e.{part},"
            f" CASE WHEN size(array_except(e.k, {header_keys})) = 0 THEN {scanned}"
            f" ELSE CAST(array() AS ARRAY<STRING>) END)), 0)"
        )

    return build(header_keys, "k", kv_keys), build(header_vals, "v", kv_vals)


def _before_equals(text: str) -> str:
    return f"substring_index({text}, '=', 1)"


def _after_equals(text: str) -> str:
    return f"substr({text}, instr({text}, '=') + 1)"


LEAF_DDL = "struct<key: string, text: string, kind: string, top: boolean>"


def json_root_sql(text: str) -> str:
    """The JSON object of a text as a variant, NULL when there is none.

    The parser ignores what follows the object.  Where a brace is followed by
    something that may not follow it, the text is parsed once more inside an array,
    which makes trailing text an error.  A text that the strict parser refuses is read
    once more member by member: of repeated members the last counts, and bare NaN and
    Infinity are texts.
    """
    trimmed = (
        f"CASE WHEN startswith({text}, '{{') AND endswith({text}, '}}') THEN {text}"
        f" WHEN instr({text}, '{{') > 0 AND instr(reverse({text}), '}}') > 0"
        f" THEN substr({text}, instr({text}, '{{'),"
        f" greatest(length({text}) - instr(reverse({text}), '}}') + 2 - instr({text}, '{{'), 0)) END"
    )
    odd = literal(r"\}\s*[^\s,\}\]]")
    alone = "coalesce(size(try_variant_get(try_parse_json(concat('[', t, ']')), '$', 'array<variant>')) = 1, false)"
    return (
        f"get(transform(array({trimmed}), t ->"
        f" CASE WHEN t RLIKE {odd} AND NOT {alone} THEN NULL"
        f" ELSE coalesce(try_parse_json(t), {_lenient_object_sql('t')}) END), 0)"
    )


def _lenient_object_sql(text: str) -> str:
    """A JSON object with repeated members or bare NaN and Infinity, as a variant."""
    nan, inf = (literal(rf'("\s*:\s*){word}(?=\s*[,}}])') for word in ("NaN", "(-?)Infinity"))
    quoted = f"regexp_replace(regexp_replace({text}, {nan}, '$1\"nan\"'), {inf}, '$1\"$2inf\"')"
    members = f"from_json({quoted}, 'map<string, variant>')"
    merged = last_wins_map_sql("map_keys(m)", "map_values(m)")
    return f"get(transform(array({members}), m -> CASE WHEN m IS NOT NULL THEN to_variant_object({merged}) END), 0)"


def json_leaves_sql(root: str, text: str) -> str:
    """Leaves of a JSON object with dotted keys, as ``array<LEAF_DDL>``.

    Each round of the fold opens the objects found by the round before; the number
    of braces bounds the depth, so any depth is covered.  Objects without members
    vanish, arrays stay values.
    """
    members = "map_entries(CAST({0} AS MAP<STRING, VARIANT>))"
    node = "struct({0} AS key, c.value AS value, schema_of_variant(c.value) AS kind)"
    first = f"transform({members.format(root)}, c -> {node.format('c.key')})"
    deeper = (
        f"flatten(transform(acc.open, o -> transform({members.format('o.value')},"
        f" c -> {node.format(chr(39).join(['concat(o.key, ', '.', ', c.key)']))})))"
    )

    def split(nodes: str, done: str, top: str) -> str:
        is_open = "startswith(n.kind, 'OBJECT')"
        leaf = (
            "struct(n.key AS key, CASE WHEN startswith(n.kind, 'ARRAY') THEN to_json(n.value)"
            f" ELSE CAST(n.value AS STRING) END AS text, n.kind AS kind, {top} AS top)"
        )
        leaves = f"transform(filter(ns, n -> NOT {is_open}), n -> {leaf})"
        return (
            f"get(transform(array({nodes}), ns -> struct("
            f"{f'concat({done}, {leaves})' if done else leaves} AS done,"
            f" filter(ns, n -> {is_open}) AS open)), 0)"
        )

    depth = f"length({text}) - length(replace({text}, '{{', ''))"
    return (
        f"CASE WHEN startswith(schema_of_variant({root}), 'OBJECT') THEN"
        f" aggregate(sequence(1, {depth}), {split(first, '', 'true')},"
        f" (acc, level) -> CASE WHEN size(acc.open) = 0 THEN acc ELSE {split(deeper, 'acc.done', 'false')} END,"
        f" acc -> acc.done) END"
    )


def json_tokens_sql(leaves: str) -> tuple[str, str, str]:
    """Keys, text values and, for what is not a string, JSON literals.

    A member written with a literal dot at the top beats a nested one of that name,
    hence the order.
    """
    ordered = f"concat(filter({leaves}, e -> NOT e.top), filter({leaves}, e -> e.top))"
    # A number written with a fraction keeps one: 1.0 reads as "1.0", not "1".
    number = (
        "CASE WHEN startswith(e.kind, 'DECIMAL') AND NOT contains(e.text, '.')"
        " AND length(e.text) < 19 THEN concat(e.text, '.0') ELSE e.text END"
    )
    value = f"CASE WHEN e.kind = 'BOOLEAN' THEN initcap(e.text) ELSE {number} END"
    json = f"CASE WHEN e.kind NOT IN ('STRING', 'VOID') THEN {number} END"
    return (
        f"transform({ordered}, e -> e.key)",
        f"transform({ordered}, e -> {value})",
        f"transform({ordered}, e -> {json})",
    )


# ----------------------------------------------------------------------- operators
def with_payload(df: DataFrame, line: str = "raw_event") -> DataFrame:
    """Add ``syslog_pri`` and ``payload`` (the line without its PRI header)."""
    pri = (
        f"CASE WHEN startswith({line}, '<') AND NOT contains({line}, '\\n') THEN"
        f" try_cast(nullif(regexp_extract(substr({line}, 1, 5), '^<([0-9]{{1,3}})>', 1), '') AS INT) END"
    )
    payload = (
        f"CASE WHEN syslog_pri IS NULL THEN {line}"
        f" ELSE {strip_sql(f'substr({line}, instr({line}, chr(62)) + 1)')} END"
    )
    return df.select("*", F.expr(pri).alias("syslog_pri")).select("*", F.expr(payload).alias("payload"))


def syslog_meta(pri: Column) -> Column:
    """Facility and severity of a PRI value; NULL without one."""
    return F.when(
        pri.isNotNull(),
        F.struct(
            pri.alias("syslog_pri"),
            F.shiftright(pri, 3).alias("syslog_facility"),
            pri.bitwiseAND(7).alias("syslog_severity"),
        ),
    )


def _python_capture(spec: ParserSpec):
    """Arrow UDF for a pattern the JVM cannot run: captured groups, in order."""
    source, names = spec.pattern.source, spec.pattern.names

    @F.pandas_udf("array<string>")
    def capture(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import re

        pattern = re.compile(source)

        def groups(text):
            found = pattern.search(text) if text is not None else None
            return [found.group(n) for n in names] if found else None

        for batch in batches:
            yield batch.map(groups)

    return capture


def with_fields(df: DataFrame, specs: SpecSet, line: str = "raw_event") -> DataFrame:
    """Add ``fields`` and ``json_literals`` to rows that have a ``parser_id``.

    ``fields`` maps token to text (never NULL, maybe empty); ``json_literals``
    holds the JSON text of tokens that were not strings.
    """
    base = df.columns
    df = with_payload(df, line)

    # Cells: one array of strings per row, whatever the format.
    cells = []
    python_specs = []
    for spec in specs:
        if spec.format == "regex" and spec.pattern is not None:
            if spec.pattern.runs_on_jvm:
                cells.append(([spec.id], capture_sql("payload", spec.pattern.java, list(spec.pattern.numbers))))
            else:
                python_specs.append(spec)
        elif spec.format == "csv":
            cells.append(([spec.id], csv_cells_sql("payload", spec.delimiter)))
    cells.append((specs.ids("cef"), capture_sql(line, "(?d)" + CEF_HEADER, list(range(1, 9)))))
    cells.append((specs.ids("leef"), capture_sql(line, "(?d)" + LEEF_HEADER, list(range(1, 8)))))
    python_cells = []
    for number, spec in enumerate(python_specs):
        name = f"_python_cells_{number}"
        text = F.when(F.col("parser_id") == spec.id, F.col("payload"))
        df = df.select("*", _python_capture(spec)(text).alias(name))
        cells.append(([spec.id], name))
        python_cells.append(name)
    df = df.select(
        "*",
        F.expr(_by_parser(cells, "CAST(NULL AS ARRAY<STRING>)")).alias("_cells"),
        F.expr(
            _by_parser([(specs.ids("json"), json_root_sql("payload"))], "CAST(NULL AS VARIANT)")
        ).alias("_root"),
    )
    leaves = json_leaves_sql("_root", "payload")
    df = df.select("*", F.expr(f"CASE WHEN _root IS NOT NULL THEN {leaves} END").alias("_leaves"))

    # Tokens: parallel key and value arrays.
    def tokens(keys: str, vals: str, json: str = "CAST(NULL AS ARRAY<STRING>)") -> str:
        return f"named_struct('keys', {keys}, 'vals', {vals}, 'json', {json})"

    nothing = tokens("CAST(array() AS ARRAY<STRING>)", "CAST(array() AS ARRAY<STRING>)")

    def unless_missing(source: str, sql: str) -> str:
        return f"CASE WHEN {source} IS NULL THEN {nothing} ELSE {sql} END"

    cut = []
    for spec in specs:
        if spec.format == "regex" and spec.pattern is not None:
            cut.append(([spec.id], unless_missing("_cells", tokens(*regex_tokens_sql("_cells", spec)))))
        elif spec.format == "csv":
            cut.append(([spec.id], unless_missing("_cells", tokens(*csv_tokens_sql("_cells", spec.columns)))))
    cut.append((specs.ids("cef"), unless_missing("_cells", tokens(*cef_tokens_sql("_cells")))))
    cut.append((specs.ids("leef"), unless_missing("_cells", tokens(*leef_tokens_sql("_cells")))))
    cut.append((specs.ids("json"), unless_missing("_leaves", tokens(*json_tokens_sql("_leaves")))))
    cut.append((specs.ids("syslog"), tokens("array('message')", "array(payload)")))
    scan = tokens(*key_value_sql("payload"))
    df = df.select(
        *base, "syslog_pri", "payload", F.expr(_by_parser(cut, scan)).alias("_tokens")
    )

    literals = "map_filter({0}, (k, v) -> v IS NOT NULL)".format(
        last_wins_map_sql("_tokens.keys", "_tokens.json")
    )
    return evaluate_once(df).select(
        *base,
        "syslog_pri",
        "payload",
        F.expr(last_wins_map_sql("_tokens.keys", "_tokens.vals")).alias("fields"),
        F.expr(f"CASE WHEN _tokens.json IS NOT NULL THEN {literals} END").alias("json_literals"),
    )


def _by_parser(branches: list[tuple[list[str], str]], otherwise: str) -> str:
    """CASE over parser ids."""
    whens = [
        f"WHEN parser_id IN ({', '.join(literal(i) for i in ids)}) THEN {sql}"
        for ids, sql in branches
        if ids
    ]
    return f"CASE {' '.join(whens)} ELSE {otherwise} END" if whens else otherwise
