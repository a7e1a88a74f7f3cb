"""Registered queries for the ways in and out of the engine that no other query takes."""

from __future__ import annotations

from pyspark.sql import functions as F

from rampart.functions.session import fresh_path
from rampart.operators.classify import with_parser
from rampart.operators.extract import with_fields
from rampart.operators.normalize import normalize
from rampart.plans.queries import _FEATURES, events, expect, lines, query
from rampart.schema import DEFAULT_COLLECTOR
from rampart.sinks import writers
from rampart.sources import readers
from rampart.specs import shipped_specs

_PER_PARSER = "SELECT parser AS parser_id, count(*) AS lines, CAST(sum(strlen(line)) AS BIGINT) AS bytes FROM expected GROUP BY 1"


def _per_parser(found):
    """Lines and bytes of each parser."""
    return found.groupBy("parser_id").agg(F.count("*").alias("lines"), F.sum(F.octet_length("raw_event")).alias("bytes"))


@query(expect(_PER_PARSER))
def lines_of_a_column(spark, sf_dir):
    """Lines that stand in a table's column between white space, beside blank ones."""
    padded = F.array(F.concat(F.lit(" \t"), "raw_event", F.lit("　 ")), F.lit("　"), F.lit(""))
    column = lines(spark, sf_dir).select(F.explode(padded).alias("text"))
    return _per_parser(with_parser(readers.lines_from(column, "text"), shipped_specs()))


@query(expect(_PER_PARSER))
def stream_line_files(spark, sf_dir):
    """Text files with comments and blanks, read as a stream a few files at a time."""
    folder, routed = fresh_path(spark, "text"), fresh_path(spark, "routed")
    noisy = F.array(F.col("raw_event"), F.lit(" "), F.concat(F.lit(" # "), "raw_event"))
    lines(spark, sf_dir).select(F.explode(noisy)).write.text(folder)
    found = with_parser(readers.stream_lines(spark, folder, max_files=3), shipped_specs())
    run = (
        found.writeStream.format("parquet").option("path", routed)
        .option("checkpointLocation", fresh_path(spark, "progress")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return _per_parser(spark.read.parquet(routed))


@query(expect("""SELECT event_id, parser_id, e_src_ip AS src_ip, e_disposition AS disposition, CAST(n_unmapped AS INTEGER) AS n_unmapped, sha256(line) AS raw_hash
FROM expected WHERE parser IN ('suricata_eve', 'generic_kv', 'cisco_asa')"""))
def chosen_parsers(spark, sf_dir):
    """Events of three parsers; other lines are left out before any field is cut."""
    found = events(spark, sf_dir, parsers=["suricata_eve", "generic_kv", "cisco_asa", "no_such_parser"])
    return found.select(
        "event_id", "lineage.parser_id", F.col("src_endpoint.ip").alias("src_ip"), "disposition",
        F.size("unmapped").alias("n_unmapped"), "lineage.raw_hash",
    )


@query(expect("""SELECT event_id, src_ip AS srcip, CAST(sport AS VARCHAR) AS srcport, verb AS action, nullif(level, '') AS level,
'FGT-1' AS devname, CAST(20 AS INTEGER) AS n_fields FROM expected WHERE fmt = 4"""))
def unknown_format(spark, sf_dir):
    """A spec whose format nobody knows: its lines are scanned for key=value pairs."""
    specs = shipped_specs().register({"id": "house_format", "format": "made_up"})
    routed = with_parser(lines(spark, sf_dir), specs).where("parser_id = 'fortinet_fortios'")
    found = with_fields(routed.withColumn("parser_id", F.lit("house_format")), specs)
    names = ["srcip", "srcport", "action", "level", "devname"]
    return found.select("event_id", *[F.col("fields")[n].alias(n) for n in names], F.size("fields").alias("n_fields"))


@query(expect("SELECT vendor, count(*) AS events, count(*) AS ids, true AS are_uuids, true AS are_now FROM expected GROUP BY 1"))
def default_ids_and_times(spark, sf_dir):
    """Without key columns each event has a random id of its own; without a given time it
    was ingested when the query started."""
    found = normalize(lines(spark, sf_dir))
    row_id = F.col("lineage.event_id")
    is_uuid = row_id.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    is_now = F.col("lineage.ingestion_timestamp") == F.current_timestamp()
    rows = found.select(F.col("product.vendor_name").alias("vendor"), row_id.alias("id"), is_uuid.alias("u"), is_now.alias("t"))
    return rows.groupBy("vendor").agg(
        F.count("*").alias("events"), F.count_distinct("id").alias("ids"), F.every("u").alias("are_uuids"), F.every("t").alias("are_now")
    )


_ID = f"sha256('{DEFAULT_COLLECTOR}' || chr(1) || CAST(event_id AS VARCHAR))"
_UUID = " || '-' || ".join(f"substr({_ID}, {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


@query(expect(f"SELECT * REPLACE ({_UUID} AS event_id) FROM ({_FEATURES})"))
def stored_features(spark, sf_dir):
    """The feature matrix as a stored table, under ids derived from key columns."""
    path = fresh_path(spark, "features")
    writers.write_features(events(spark, sf_dir), path)
    return spark.read.parquet(path)
