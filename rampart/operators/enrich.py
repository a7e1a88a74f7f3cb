"""Network and threat context of an event: direction, place and indicator hits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.functions import net
from rampart.functions.plan import evaluate_once
from rampart.functions.text import literal
from rampart.functions.session import stored
from rampart.operators.lookup import BROADCAST_BYTES, attach, by_value, found_values, prepared

# Threat indicators shipped with the engine.
INDICATORS = [
    ("185.220.101.5", "IOC-TOR-EXIT", "Traffic Originating from Known Tor Exit Node", "Anonymization Network", None, "Unknown / Anonymized", 0.95),
    ("194.26.29.112", "IOC-MIRAI-SCANNER", "Mirai Botnet Telnet/SSH Scanner", "Botnet Activity", "CVE-2017-17215", "Mirai Variant", 0.99),
    ("45.33.32.156", "IOC-LOG4J-PROBE", "Exploitation Probe: Apache Log4j RCE (Log4Shell)", "Exploit Attempt", "CVE-2021-44228", "Mass Scanner", 0.92),
]

# Networks with a known place, first match wins.
PLACES = [
    ("8.8.8.0/24", "US", "Mountain View", "AS15169 Google LLC"),
    ("1.1.1.0/24", "AU", "Sydney", "AS13335 Cloudflare Inc"),
    ("104.16.0.0/12", "US", "San Francisco", "AS13335 Cloudflare Inc"),
    ("185.220.101.0/24", "DE", "Frankfurt", "AS205100 Tor Exit Relay"),
    ("45.33.32.0/24", "US", "Fremont", "AS63949 Linode LLC"),
    ("198.51.100.0/24", "US", "Reston", "AS12345 Documentation Range"),
    ("203.0.113.0/24", "IN", "Mumbai", "AS55836 Reliance Jio"),
    ("52.0.0.0/11", "US", "Ashburn", "AS16509 Amazon.com Inc"),
    ("13.107.0.0/16", "US", "Redmond", "AS8075 Microsoft Corp"),
    ("194.26.29.0/24", "RU", "Moscow", "AS57523 Suspicious Scanner Range"),
]

# Place of private and of unlisted addresses; origin tag per mode.
PRIVATE_PLACE = ("INTERNAL", "LAN", "Private Network (RFC 1918)")
UNLISTED_PLACE = ("GLOBAL", "External", "Public Internet")
FEED_TAG = {
    "air_gapped": " [Air-Gapped Enclave Cache (Strict Offline)]",
    "internet": " [Cloud Threat Feed (Live Online Sync)]",
}

INDICATOR_DDL = (
    "ip string, signature_id string, signature_name string, category string,"
    " cve string, threat_actor string, confidence_score double"
)
PLACE_DDL = "list_order int, lo bigint, hi bigint, country string, city string, asn string"


def indicator_table(spark: SparkSession) -> DataFrame:
    """The shipped indicators (one row per address)."""
    return spark.createDataFrame(INDICATORS, INDICATOR_DDL)


def place_table(spark: SparkSession, networks=None) -> DataFrame:
    """Networks with a place, in order of precedence.

    ``networks`` are ``(cidr, country, city, asn)`` tuples.  Larger tables are best
    given to the operators as a DataFrame of this schema.
    """
    rows = [
        (order, *net.ipv4_bounds(cidr), country, city, asn)
        for order, (cidr, country, city, asn) in enumerate(PLACES if networks is None else networks)
    ]
    return spark.createDataFrame(rows, PLACE_DDL)


@dataclass(frozen=True)
class PlaceIndex:
    """Networks keyed for equi-joins.

    A range join compares every event with every network.  Instead, networks of
    /16 and wider are listed under each /16 block they touch and narrower ones
    under each /24 block, so an address meets at most one row per table and then
    tests only the few networks of its own block.  Overlaps stay in list order.
    """

    wide: DataFrame
    narrow: DataFrame
    wide_broadcast: bool
    narrow_broadcast: bool


_CANDIDATE = "struct<list_order: int, lo: bigint, hi: bigint, country: string, city: string, asn: string>"


def place_index(table: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> PlaceIndex:
    """Index a table of networks of any size (schema ``PLACE_DDL``).

    Of equal ranges only the first listed can win.  CIDR networks nest, so a block
    then lists at most 17 wide or 511 narrow ones, however large the table.
    """
    place = F.struct("list_order", "country", "city", "asn")
    ranges = table.groupBy("lo", "hi").agg(F.min(place).alias("place"))
    ranges = ranges.select("lo", "hi", "place.*")

    def blocks(part: DataFrame, bits: int) -> DataFrame:
        block = F.explode(F.sequence(F.shiftright("lo", bits), F.shiftright("hi", bits)))
        candidate = F.struct("list_order", "lo", "hi", "country", "city", "asn")
        return (
            part.select(block.alias("block"), candidate.alias("candidate"))
            .groupBy("block")
            .agg(F.sort_array(F.collect_list("candidate")).alias("candidates"))
        )

    is_wide = (F.col("hi") - F.col("lo")) >= 65535
    # Ranges that are no CIDR network could pile up in a block without bound.
    size = F.col("hi") - F.col("lo") + 1
    odd = ranges.where((F.col("lo") > F.col("hi")) | (size.bitwiseAND(size - 1) != 0) | (F.col("lo") % size != 0)).limit(1).collect()
    if odd:
        raise ValueError(f"not a CIDR network: {odd[0].lo} to {odd[0].hi}")
    wide, wide_fits = prepared(blocks(ranges.where(is_wide), 16), broadcast_bytes)
    narrow, narrow_fits = prepared(blocks(ranges.where(~is_wide), 8), broadcast_bytes)
    return PlaceIndex(wide, narrow, wide_fits, narrow_fits)


@dataclass(frozen=True)
class PrefixIndex:
    """Networks of both families and of any length, searched by prefix length.

    ``table`` has a row per entry: its bits (as of 128, IPv4 last), both halves of its
    address, and ``hit``, the first listed of all networks that hold it.  ``bits`` are the
    lengths in use, per family.  An address is looked for by a binary search over them:
    each network has marker entries at the shorter lengths where the search for it
    passes, so an entry that is there sends the search to longer ones.
    """

    table: DataFrame
    bits: tuple[tuple[int, ...], tuple[int, ...]]
    broadcast: bool


NETWORK_DDL = "list_order int, network string, country string, city string, asn string"


def network_table(spark: SparkSession, networks) -> DataFrame:
    """``(cidr, country, city, asn)`` tuples of both families, in order of precedence."""
    rows = [(order, *row) for order, row in enumerate(networks)]
    return spark.createDataFrame(rows, NETWORK_DDL)


def _markers(lengths: tuple[int, ...]) -> dict[int, list[int]]:
    """For each length the shorter ones where a binary search for it passes."""
    passed: dict[int, list[int]] = {}
    for wanted in lengths:
        low, high, seen = 0, len(lengths) - 1, []
        while low <= high:
            middle = (low + high) // 2
            if lengths[middle] == wanted:
                break
            if lengths[middle] < wanted:
                seen.append(lengths[middle])
                low = middle + 1
            else:
                high = middle - 1
        passed[wanted] = seen
    return passed


def prefix_index(table: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> PrefixIndex:
    """Index a table of networks of any size and family (schema ``NETWORK_DDL``).

    A network is an address and, after a slash, its number of bits (none: one address).
    Text that is no network, or has bits beyond its length, is an error.
    """
    bits_text = F.expr("try_cast(get(split(network, '/'), 1) AS INT)").alias("_bits")
    parts = table.select("*", F.substring_index("network", "/", 1).alias("_ip"), bits_text)
    parts = parts.select("*", F.expr(net.ipv4_long_sql("_ip")).alias("_v4"), F.expr(net.ipv6_hex_sql("_ip")).alias("_v6"))
    high, low = net.halves_sql("_v4", "_v6")
    width = "CASE WHEN _v4 IS NOT NULL THEN 32 WHEN _v6 IS NOT NULL THEN 128 END"
    own = f"CASE WHEN contains(network, '/') THEN _bits ELSE {width} END"
    parts = parts.select(
        "list_order", "network", "country", "city", "asn",
        F.expr("CASE WHEN _v4 IS NOT NULL THEN 4 ELSE 6 END").alias("family"),
        F.expr(f"CASE WHEN {own} BETWEEN 0 AND {width} THEN {own} + 128 - {width} END").alias("bits"),
        F.expr(high).alias("high"), F.expr(low).alias("low"),
    )
    kept = net.masked_sql("high", "low", "bits")
    odd = parts.where(f"bits IS NULL OR high <> {kept[0]} OR low <> {kept[1]}").limit(1).collect()
    if odd:
        raise ValueError(f"not a network: {odd[0].network}")
    # Of equal networks only the first listed can win.
    first = F.min(F.struct("list_order", "country", "city", "asn")).alias("hit")
    networks = stored(parts.groupBy("family", "bits", "high", "low").agg(first), "networks")
    # At most 33 and 129 lengths.
    found = networks.select("family", "bits").distinct().collect()
    bits = tuple(tuple(sorted(r.bits for r in found if r.family == family)) for family in (4, 6))
    marks, shorter = [], []
    for family, lengths in zip((4, 6), bits):
        for length, passed in _markers(lengths).items():
            up_to = [b for b in lengths if b <= length]
            test = f"WHEN family = {family} AND bits = {length} THEN"
            marks.append(f"{test} array({', '.join(map(str, [*passed, length]))})")
            shorter.append(f"{test} array({', '.join(map(str, up_to))})")
    if not found:
        return PrefixIndex(networks.select("family", "bits", "high", "low", "hit"), bits, True)

    def cut(rows: DataFrame, to: list[str], name: str) -> DataFrame:
        rows = rows.withColumn(name, F.explode(F.expr(f"CASE {' '.join(to)} END")))
        upper, lower = net.masked_sql("high", "low", name)
        return rows.select("*", F.expr(upper).alias(f"{name}_high"), F.expr(lower).alias(f"{name}_low"))

    entries = cut(networks, marks, "at").select("family", F.col("at").alias("bits"), F.col("at_high").alias("high"), F.col("at_low").alias("low")).distinct()
    holders = networks.select("family", F.col("bits").alias("in"), F.col("high").alias("in_high"), F.col("low").alias("in_low"), "hit")
    held = cut(entries, shorter, "in").join(holders, ["family", "in", "in_high", "in_low"], "left")
    best = held.groupBy("family", "bits", "high", "low").agg(F.min("hit").alias("hit"))
    kept_table, fits = prepared(best, broadcast_bytes)
    return PrefixIndex(kept_table, bits, fits)


def _place_by_prefix(df: DataFrame, v4: str, v6: str, private: str, index: PrefixIndex) -> DataFrame:
    """Add ``_hit``: the first listed network with the address, by a join per step of the
    search; private and invalid addresses look for nothing."""
    base = df.columns
    high, low = net.halves_sql(v4, v6)
    family = f"CASE WHEN {private} THEN NULL WHEN {v4} IS NOT NULL THEN 4 WHEN {v6} IS NOT NULL THEN 6 END"
    none = F.lit(None).cast(index.table.schema["hit"].dataType)
    df = df.select(
        "*", F.expr(family).alias("_family"), F.expr(high).alias("_high"), F.expr(low).alias("_low"),
        F.lit(0).alias("_from"), F.expr(f"CASE WHEN {family} = 4 THEN {len(index.bits[0])} ELSE {len(index.bits[1])} END - 1").alias("_to"),
        none.alias("_hit"),
    )
    entry = [F.col(c).alias(f"_e_{c}") for c in ("family", "bits", "high", "low", "hit")]
    side = index.table.select(*entry, F.lit(True).alias("_there"))
    side = F.broadcast(side) if index.broadcast else side
    lists = [f"array({', '.join(map(str, b))})" if b else "CAST(array() AS ARRAY<INT>)" for b in index.bits]
    for _ in range(max(len(b) for b in index.bits).bit_length()):
        middle = "CAST(floor((_from + _to) / 2) AS INT)"
        at = f"CASE WHEN _from <= _to THEN get(CASE WHEN _family = 4 THEN {lists[0]} ELSE {lists[1]} END, {middle}) END"
        asked = df.withColumn("_middle", F.expr(middle)).withColumn("_at", F.expr(at))
        upper, lower = net.masked_sql("_high", "_low", "_at")
        asked = asked.withColumn("_k_high", F.expr(upper)).withColumn("_k_low", F.expr(lower))
        same = (
            (asked["_family"] == side["_e_family"]) & (asked["_at"] == side["_e_bits"])
            & (asked["_k_high"] == side["_e_high"]) & (asked["_k_low"] == side["_e_low"])
        )
        joined = asked.join(side, same, "left")
        there = F.coalesce("_there", F.lit(False))
        df = joined.select(
            *base, "_family", "_high", "_low",
            F.when(there, F.col("_middle") + 1).otherwise(F.col("_from")).alias("_from"),
            F.when(there, F.col("_to")).otherwise(F.col("_middle") - 1).alias("_to"),
            F.when(there, F.col("_e_hit")).otherwise(F.col("_hit")).alias("_hit"),
        )
    return df.select(*base, "_hit")


def _in_memory(index: PlaceIndex | PrefixIndex | None) -> bool:
    """Whether looking up an address needs no shuffle."""
    if isinstance(index, PrefixIndex):
        return index.broadcast
    return index is None or (index.wide_broadcast and index.narrow_broadcast)


def _resolved_places(values: DataFrame, index: PlaceIndex | PrefixIndex) -> DataFrame:
    """The distinct addresses (value) that are in a listed network, and the network."""
    addressed = evaluate_once(with_address(values, "value", "a"))
    if isinstance(index, PrefixIndex):
        placed = _place_by_prefix(addressed, "a_v4", "a_v6", "a_private", index)
    else:
        placed = _place_from_index(addressed, "a_v4", "a_private", index)
    return placed.where("_hit IS NOT NULL").select("value", F.struct("_hit.country", "_hit.city", "_hit.asn").alias("hit"))


def with_address(df: DataFrame, ip: str, prefix: str) -> DataFrame:
    """Add numeric address, internal flag and private flag of one IP column."""
    v4, v6 = f"{prefix}_v4", f"{prefix}_v6"
    df = df.select(
        "*",
        F.expr(net.ipv4_long_sql(ip)).alias(v4),
        F.expr(net.ipv6_hex_sql(ip)).alias(v6),
    )
    return df.select(
        "*",
        F.expr(f"CASE WHEN {ip} <> '' THEN {net.internal_sql(v4)} END").alias(f"{prefix}_is_internal"),
        F.expr(net.private_sql(v4, v6)).alias(f"{prefix}_private"),
    )


def with_place(df: DataFrame, prefix: str, index: PlaceIndex | PrefixIndex | None, found: str | None = None) -> DataFrame:
    """Add country, city and asn of an address prepared by ``with_address``.

    ``found`` names a column that has the network already.

    Without an index the shipped networks are used as literals: ten range tests
    that are dropped from any query not asking for places, which a join is not.
    """
    v4, v6 = f"{prefix}_v4", f"{prefix}_v6"
    if found is not None:
        placed = df.withColumnRenamed(found, "_hit")
    elif isinstance(index, PrefixIndex):
        placed = _place_by_prefix(df, v4, v6, f"{prefix}_private", index)
    elif index is None:
        tests = []
        for cidr, country, city, asn in PLACES:
            lo, hi = net.ipv4_bounds(cidr)
            place = f"named_struct('country', {literal(country)}, 'city', {literal(city)}, 'asn', {literal(asn)})"
            tests.append(f"WHEN {v4} BETWEEN {lo}L AND {hi}L THEN {place}")
        placed = df.select("*", F.expr(f"CASE {' '.join(tests)} END").alias("_hit"))
    else:
        placed = _place_from_index(df, v4, f"{prefix}_private", index)

    def part(name: str, position: int) -> str:
        return (
            f"CASE WHEN {prefix}_private THEN {literal(PRIVATE_PLACE[position])}"
            f" WHEN _hit IS NOT NULL THEN _hit.{name}"
            f" WHEN {v4} IS NOT NULL OR {v6} IS NOT NULL THEN {literal(UNLISTED_PLACE[position])} END"
        )

    return placed.select(
        *[c for c in df.columns if c != found],
        *[
            F.expr(part(name, i)).alias(f"{prefix}_{name}")
            for i, name in enumerate(("country", "city", "asn"))
        ],
    )


def _place_from_index(df: DataFrame, v4: str, private: str, index: PlaceIndex) -> DataFrame:
    """Join both block tables; private and invalid addresses have no block."""
    public = f"CASE WHEN NOT {private} THEN {v4} END"
    keyed = df.select(
        "*",
        F.expr(f"shiftright({public}, 16)").alias("_block16"),
        F.expr(f"shiftright({public}, 8)").alias("_block24"),
    )
    for key, table, broadcast, name in (
        ("_block16", index.wide, index.wide_broadcast, "_wide"),
        ("_block24", index.narrow, index.narrow_broadcast, "_narrow"),
    ):
        keyed = attach(
            keyed,
            table.withColumnRenamed("candidates", name),
            key,
            "block",
            name,
            broadcast=broadcast,
        )
    inside = f"c -> {v4} BETWEEN c.lo AND c.hi"
    first = "get(filter({0}, " + inside + "), 0)"
    found = keyed.select(
        *df.columns,
        F.expr(first.format("_wide")).alias("_in_wide"),
        F.expr(first.format("_narrow")).alias("_in_narrow"),
    )
    hit = (
        "CASE WHEN coalesce(_in_narrow.list_order < _in_wide.list_order, _in_narrow IS NOT NULL)"
        " THEN _in_narrow ELSE _in_wide END"
    )
    return found.select(*df.columns, F.expr(hit).alias("_hit"))


def direction_sql(src: str, dst: str) -> str:
    """Direction of a connection from both addresses and their internal flags."""
    return (
        f"CASE WHEN coalesce({src}_ip, '') = '' OR coalesce({dst}_ip, '') = '' THEN 'Unknown'"
        f" WHEN {src}_is_internal AND {dst}_is_internal THEN 'Lateral'"
        f" WHEN {src}_is_internal THEN 'Outbound'"
        f" WHEN {dst}_is_internal THEN 'Inbound' ELSE 'External' END"
    )


def with_network_context(
    df: DataFrame, index: PlaceIndex | PrefixIndex | None = None, *, source: DataFrame | None = None
) -> DataFrame:
    """Add internal flags, places and ``direction`` from ``src_ip`` and ``dst_ip``.

    An index that is too large for a broadcast is asked about distinct addresses; for that
    the rows are stored first, unless ``source`` is a stored table with both addresses.
    """
    large = not _in_memory(index) and not df.isStreaming
    if large and source is None:
        df = source = stored(df, "addresses")
    base = df.columns
    if large:
        df = by_value(df, ["src_ip", "dst_ip"], lambda values: _resolved_places(values, index), source=source)
    for prefix in ("src", "dst"):
        df = with_address(df, f"{prefix}_ip", prefix)
    df = evaluate_once(df)
    for prefix in ("src", "dst"):
        df = with_place(df, prefix, index, f"_hit_{prefix}_ip" if large else None)
    df = evaluate_once(df)
    keep = [f"{p}_{c}" for p in ("src", "dst") for c in ("is_internal", "country", "city", "asn")]
    return df.select(*base, *keep, F.expr(direction_sql("src", "dst")).alias("direction"))


def with_indicator(
    df: DataFrame,
    indicators: DataFrame | Indicators | None = None,
    *,
    mode: str = "air_gapped",
    broadcast_bytes: int = BROADCAST_BYTES,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add ``indicator``: the threat known for ``src_ip``, else for ``dst_ip``.

    The shipped indicators are a literal map.  A table of any size is joined instead, by
    broadcast if its checked size allows.  A larger one is asked about the distinct
    addresses, for which the rows are stored first unless ``source`` is a stored table
    with both addresses; of a stream, rows are joined on salted keys.
    """
    tag = FEED_TAG.get(mode, FEED_TAG["air_gapped"])
    if indicators is None:
        entries = []
        for ip, signature, name, category, cve, actor, confidence in INDICATORS:
            entries.append(
                f"{literal(ip)}, named_struct('signature_id', {literal(signature)},"
                f" 'signature_name', {literal(name + tag)}, 'category', {literal(category)},"
                f" 'cve', {literal(cve)}, 'threat_actor', {literal(actor)},"
                f" 'indicator_matched', {literal(ip)}, 'confidence_score', double({confidence}))"
            )
        known = f"map({', '.join(entries)})"
        return df.select(
            "*",
            F.expr(
                f"coalesce(try_element_at({known}, src_ip), try_element_at({known}, dst_ip))"
            ).alias("indicator"),
        )
    known = indicators if isinstance(indicators, Indicators) else prepared_indicators(indicators, broadcast_bytes)
    tagged = _tagged(F.col("hit"), tag)
    table = known.table.select("ip", tagged.alias("hit"))
    base = df.columns
    if not known.broadcast and not df.isStreaming:
        if source is None:
            df = source = stored(df, "addresses")
        df = by_value(
            df, ["src_ip", "dst_ip"], lambda values: found_values(values, table, "ip", F.col("hit")), source=source, limit=broadcast_bytes
        )
        return df.select(*base, F.coalesce("_hit_src_ip", "_hit_dst_ip").alias("indicator"))
    for side in ("src", "dst"):
        df = attach(
            df, table.withColumnRenamed("hit", f"_{side}_hit"), f"{side}_ip", "ip", f"_{side}_hit",
            broadcast=known.broadcast,
        )
    return df.select(*base, F.coalesce("_src_hit", "_dst_hit").alias("indicator"))


@dataclass(frozen=True)
class Indicators:
    """A threat table with one row per address (ip, hit), stored, and whether it may be
    broadcast.  Prepared once, it serves many batches of a stream."""

    table: DataFrame
    broadcast: bool


def prepared_indicators(indicators: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Indicators:
    """One row per address: with repeats, the alphabetically first signature counts."""
    hit = F.struct(
        "signature_id", "signature_name", "category", "cve", "threat_actor",
        F.col("ip").alias("indicator_matched"), "confidence_score",
    )
    return Indicators(*prepared(indicators.groupBy("ip").agg(F.min(hit).alias("hit")), broadcast_bytes))


def _tagged(hit: Column, tag: str) -> Column:
    return hit.withField("signature_name", F.concat(hit["signature_name"], F.lit(tag)))


def asks_distinct(index: PlaceIndex | PrefixIndex | None, indicators: Indicators | None) -> bool:
    """Whether one of the tables is too large for a broadcast."""
    return not _in_memory(index) or (indicators is not None and not indicators.broadcast)
