"""Registered queries over lines made to be awkward, and lookups that shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from rampart.functions.session import fresh_path
from rampart.operators import enrich, export
from rampart.operators.normalize import normalize
from rampart.plans.lines import SEED_CTE, table
from rampart.plans.queries import _PLACES, addresses, events, expect, query, streamed
from rampart.sinks import writers
from rampart.streaming import jobs

_WIDE_SPACE = "　"


def _awkward(spark, sf_dir, line: str, **options):
    """Events of one line per row of the events table, written as a SQL text."""
    source = table(spark, sf_dir, "events").select("event_id", "user_id", F.expr(line).alias("raw_event"))
    return normalize(source, keep=["event_id"], id_cols=["event_id"], **options)


@query("""SELECT event_id, CAST(NULL AS INTEGER) AS dst_port, CAST(0 AS BIGINT) AS bytes_in, CAST(user_id AS BIGINT) AS total_bytes,
CAST(event_id + 1 AS VARCHAR) || '00000000000000000000' AS kept_bytes, CAST(event_id AS VARCHAR) || '9999999999' AS kept_port,
'dst_port out of range, bytes_in out of range' AS notes, true AS is_valid FROM events""")
def big_numbers(spark, sf_dir):
    """Counts beyond 64 bits and ports beyond 32: the text stays, and the event says so."""
    line = (
        "'src_ip=10.0.0.1 dst_ip=10.0.0.2 action=allow proto=tcp dst_port=' || event_id || '9999999999 bytes_in='"
        " || (event_id + 1) || '00000000000000000000 bytes_out=' || user_id"
    )
    found = _awkward(spark, sf_dir, line)
    return found.select(
        "event_id",
        F.col("dst_endpoint.port").alias("dst_port"),
        "traffic.bytes_in",
        "traffic.total_bytes",
        F.col("unmapped")["bytes_in"].alias("kept_bytes"),
        F.col("unmapped")["dst_port"].alias("kept_port"),
        F.array_join("lineage.validation_errors", ", ").alias("notes"),
        "lineage.is_valid",
    )


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id % 256 AS VARCHAR) || '.2.2.2' END AS src_ip,
CASE WHEN event_id % 2 = 0 THEN 'nan' END AS score, CASE WHEN event_id % 2 = 0 THEN '-inf' END AS low,
CASE WHEN event_id % 2 = 0 THEN 'true' END AS ok_literal, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) END AS n_literal,
event_id % 2 = 0 AS is_valid FROM events""")
def json_edge_events(spark, sf_dir):
    """JSON with a repeated member, bare NaN and Infinity; every other line repeats a member
    below the top level, which is not read and makes the event invalid.  What the parser
    gave, nothing from a line that is not read."""
    line = (
        """'{"event_type":"dns","src_ip":"1.1.1.1","src_ip":"' || user_id % 256 || '.2.2.2","score":NaN,"low":-Infinity,"ok":true,"n":'"""
        """ || event_id || CASE WHEN event_id % 2 = 0 THEN '}' ELSE ',"d":{"a":1,"a":2}}' END"""
    )
    found = _awkward(spark, sf_dir, line, details=True)
    return found.select(
        "event_id",
        F.col("src_endpoint.ip").alias("src_ip"),
        F.col("unmapped")["score"].alias("score"),
        F.col("unmapped")["low"].alias("low"),
        F.col("json_literals")["ok"].alias("ok_literal"),
        F.col("json_literals")["n"].alias("n_literal"),
        F.col("lineage.is_valid").alias("is_valid"),
    )


@query("""SELECT event_id, '10.0.0.1' AS src_ip, '10.0.0.' || CAST(user_id % 250 AS VARCHAR) AS dst_ip, 'UDP' AS protocol,
CAST(event_id AS VARCHAR) AS tag FROM events""")
def unicode_space(spark, sf_dir):
    """Key=value pairs between ideographic and control white space."""
    line = (
        f"'src_ip=10.0.0.1{_WIDE_SPACE}dst_ip=10.0.0.' || user_id % 250 || chr(28) || 'proto=udp{_WIDE_SPACE}action=deny tag=' || event_id"
    )
    found = _awkward(spark, sf_dir, line)
    return found.select(
        "event_id",
        F.col("src_endpoint.ip").alias("src_ip"),
        F.col("dst_endpoint.ip").alias("dst_ip"),
        F.col("connection_info.protocol_name").alias("protocol"),
        F.col("unmapped")["tag"].alias("tag"),
    )


_TYPED = """SELECT event_id, sha256(line) AS raw_hash, '{"alert.gid":1,"alert.rev":0,"event_type":"alert","flow.pkts_toclient":0,"flow.pkts_toserver":1}' AS unmapped,
strftime(make_timestamp((1704067200 + event_id) * 1000000), '%Y-%m-%dT%H:%M:%S.000000+00:00') AS ingested FROM expected WHERE fmt = 5"""


@query(expect(_TYPED))
def native_json_typed(spark, sf_dir):
    """Native JSON of JSON lines: unmapped members keep their types."""
    source = events(spark, sf_dir, details=True).where("lineage.parser_id = 'suricata_eve'")
    return _typed(source.select("event_id", export.native_json(typed=True).alias("j")))


@query(expect(_TYPED))
def jsonl_typed_roundtrip(spark, sf_dir):
    """The same through JSON lines; the event number comes back from the ingestion time."""
    path = fresh_path(spark, "jsonl")
    writers.write_jsonl(events(spark, sf_dir, details=True).where("lineage.parser_id = 'suricata_eve'"), path)
    rows = spark.read.text(path).withColumnRenamed("value", "j")
    time = F.get_json_object("j", "$.lineage.ingestion_timestamp").cast("timestamp")
    return _typed(rows.select((F.unix_seconds(time) - 1704067200).alias("event_id"), "j"))


def _typed(rows):
    return rows.select(
        "event_id",
        F.get_json_object("j", "$.lineage.raw_hash").alias("raw_hash"),
        F.get_json_object("j", "$.unmapped").alias("unmapped"),
        F.get_json_object("j", "$.lineage.ingestion_timestamp").alias("ingested"),
    )


@query(f"WITH {SEED_CTE} {_PLACES}")
def geo_join_shuffled(spark, sf_dir):
    """Place lookup by salted shuffle joins, as for a table too large to broadcast."""
    index = enrich.place_index(enrich.place_table(spark), broadcast_bytes=0)
    return enrich.with_network_context(addresses(spark, sf_dir), index).drop("src_ip", "dst_ip")


@query(expect("""SELECT event_id, CASE WHEN src_ip IN ('185.220.101.5', '45.33.32.156', '194.26.29.112') THEN src_ip
WHEN dst_ip IN ('185.220.101.5', '45.33.32.156', '194.26.29.112') THEN dst_ip END AS matched FROM expected"""))
def ioc_join_shuffled(spark, sf_dir):
    """Indicators joined on salted keys, as for a table too large to broadcast."""
    known = enrich.indicator_table(spark)
    found = enrich.with_indicator(addresses(spark, sf_dir), known, broadcast_bytes=0)
    return found.select("event_id", F.col("indicator.indicator_matched").alias("matched"))


@query(f"WITH {SEED_CTE} {_PLACES}")
def geo_prefix_join(spark, sf_dir):
    """Place lookup by a binary search over prefix lengths, joined by broadcast."""
    index = enrich.prefix_index(enrich.network_table(spark, enrich.PLACES))
    return enrich.with_network_context(addresses(spark, sf_dir), index).drop("src_ip", "dst_ip")


_MIXED = [
    ("2001:4860:5000::/36", "V6-INNER", "a", "AS1"),
    ("2001:4860::/32", "V6-OUTER", "b", "AS2"),
    ("2001:4860:4000::/36", "V6-LATE", "c", "AS3"),
    ("2a00:1450:4000::/37", "V6-HALF", "d", "AS4"),
    ("20.128.0.0/9", "V4-HIGH", "e", "AS5"),
    ("20.0.0.0/8", "V4-ALL", "f", "AS6"),
    ("20.7.0.1", "V4-LATE", "g", "AS7"),
]


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CASE WHEN user_id % 10 = 5 THEN 'V6-INNER' ELSE 'V6-OUTER' END
WHEN event_id % 10 <= 7 THEN 'V6-HALF' ELSE 'GLOBAL' END AS src_country, CASE WHEN event_id % 250 >= 128 THEN 'V4-HIGH' ELSE 'V4-ALL' END AS dst_country,
CASE WHEN event_id % 250 >= 128 THEN 'AS5' ELSE 'AS6' END AS dst_asn FROM events""")
def geo_mixed_families(spark, sf_dir):
    """IPv4 and IPv6 networks of many lengths in one table, asked about distinct addresses."""
    source = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("""CASE WHEN event_id % 2 = 0 THEN '2001:4860:' || user_id % 10 || '000::' || event_id % 1000
            ELSE '2A00:1450:4' || event_id % 10 || '00:0:0:0:0:' || user_id % 1000 END""").alias("src_ip"),
        F.expr("'20.' || event_id % 250 || '.0.1'").alias("dst_ip"),
    )
    index = enrich.prefix_index(enrich.network_table(spark, _MIXED), broadcast_bytes=0)
    return enrich.with_network_context(source, index).select("event_id", "src_country", "dst_country", "dst_asn")


@query(expect("""SELECT event_id, src_country, src_asn, dst_country, e_direction AS direction, threat_id, threat_indicator, e_severity AS severity FROM expected"""))
def stream_with_tables(spark, sf_dir):
    """Micro-batches that are enriched from a network and an indicator table too large to
    broadcast; the tables are prepared once for all batches."""
    path = fresh_path(spark, "rows")
    places = enrich.prefix_index(enrich.network_table(spark, enrich.PLACES), broadcast_bytes=0)
    indicators = enrich.prepared_indicators(enrich.indicator_table(spark), broadcast_bytes=0)
    run = jobs.stream_to_sinks(
        streamed(spark, sf_dir), {"rows": lambda batch: batch.write.mode("append").parquet(path)}, fresh_path(spark, "progress"),
        once=True, id_cols=["event_id"], keep=["event_id"], places=places, indicators=indicators,
    )
    run.awaitTermination()
    return spark.read.parquet(path).select(
        "event_id",
        F.col("src_endpoint.country").alias("src_country"),
        F.col("src_endpoint.asn").alias("src_asn"),
        F.col("dst_endpoint.country").alias("dst_country"),
        "connection_info.direction",
        F.col("threat.signature_id").alias("threat_id"),
        F.col("threat.indicator_matched").alias("threat_indicator"),
        "severity",
    )
