"""Registered queries over the stored forensic table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rampart.functions.plan import evaluate_once
from rampart.functions.session import fresh_path, shuffles_removed, stored_meanwhile
from rampart.operators import search
from rampart.plans.queries import events, expect, query
from rampart.schema import FORENSIC_COLUMNS
from rampart.sinks import forensic

_FORENSIC = """SELECT id AS row_id, sha256(line) AS raw_hash, line AS raw_event, CAST(1704067200 + event_id AS BIGINT) AS ingestion_epoch,
coalesce(e_time, '') AS event_timestamp, parser_id, vendor, product, e_src_ip AS src_ip, CAST(e_sport AS INTEGER) AS src_port, src_country,
e_dst_ip AS dst_ip, CAST(e_dport AS INTEGER) AS dst_port, dst_country, e_proto AS protocol, e_direction AS direction,
CAST(e_in AS BIGINT) AS bytes_in, CAST(e_out AS BIGINT) AS bytes_out, CAST(e_total AS BIGINT) AS total_bytes, e_disposition AS action,
{severity} AS severity, e_app AS app_name, threat_name AS threat_signature,
line || '|' || id || '|' || e_disposition || '|' || {severity} || '|' || coalesce(e_src_ip, '-') || '|' || CAST(n_unmapped AS VARCHAR) AS json_parts
FROM (SELECT *, sha256('default-collector' || chr(1) || CAST(event_id AS VARCHAR)) AS digest FROM expected),
LATERAL (SELECT substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-' || substr(digest, 13, 4) || '-' || substr(digest, 17, 4) || '-' || substr(digest, 21, 12) AS id)"""
_MEMBERS = (
    "raw_event string, lineage struct<event_id: string>, disposition string, severity string, "
    "src_endpoint struct<ip: string>, unmapped map<string, string>"
)
_REVIEWED = "CASE WHEN e_disposition = 'Blocked' THEN 'Reviewed' ELSE e_severity END"


def _whole(rows):
    """All columns; of the JSON text members that only the whole event has."""
    as_is = [c for c in FORENSIC_COLUMNS if c not in ("event_id", "ingestion_timestamp", "normalized_json")]

    members = F.from_json("normalized_json", _MEMBERS)
    parts = F.concat_ws(
        "|",
        "_json.raw_event",
        "_json.lineage.event_id",
        "_json.disposition",
        "_json.severity",
        F.coalesce("_json.src_endpoint.ip", F.lit("-")),
        F.coalesce(F.size("_json.unmapped"), F.lit(0)).cast("string"),
    )
    epoch = F.unix_seconds("ingestion_timestamp").alias("ingestion_epoch")
    # Parsed once per row, not once per member.
    read = evaluate_once(rows.select("event_id", "ingestion_timestamp", *as_is, members.alias("_json")))
    return read.select(F.col("event_id").alias("row_id"), epoch, *as_is, parts.alias("json_parts"))


def _upserted(spark, sf_dir) -> str:
    """All events, then the blocked ones again under another severity.  Both batches come
    from events that are parsed once and stored as long as they are needed."""
    path = fresh_path(spark, "forensic")
    with shuffles_removed(spark), stored_meanwhile(events(spark, sf_dir), "events") as source:
        forensic.upsert_forensic(source, path, label="first")
        forensic.upsert_forensic(source.where("disposition = 'Blocked'").withColumn("severity", F.lit("Reviewed")), path)
    return path


@query(expect(_FORENSIC.format(severity=_REVIEWED)))
def forensic_merge_on_read(spark, sf_dir):
    """Whole rows of a table whose second batch replaces rows of the first where it is read."""
    return _whole(forensic.read_forensic(spark, _upserted(spark, sf_dir)))


@query(expect(_FORENSIC.format(severity=_REVIEWED)))
def forensic_compacted(spark, sf_dir):
    """The same after compaction and a replayed first batch, which is not written again."""
    path = _upserted(spark, sf_dir)
    forensic.compact_forensic(spark, path)
    # Nobody else knows this table.
    forensic.vacuum_forensic(spark, path)
    forensic.upsert_forensic(events(spark, sf_dir), path, label="first")
    return _whole(forensic.read_forensic(spark, path))


@query(expect("""SELECT sha256(line) AS raw_hash, CAST(1704067200 + event_id AS BIGINT) AS ingestion_epoch, vendor, 'Reviewed' AS severity
FROM expected WHERE e_disposition = 'Blocked' ORDER BY event_id DESC LIMIT 50"""))
def forensic_newest(spark, sf_dir):
    """The newest 50 replaced rows, from the newest day backwards."""
    found = search.newest_events(spark, _upserted(spark, sf_dir), "severity = :s", {"s": "Reviewed"}, limit=50)
    return found.select("raw_hash", F.unix_seconds("ingestion_timestamp").alias("ingestion_epoch"), "vendor", "severity")
