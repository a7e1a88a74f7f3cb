"""Lookups, specs, sinks and sources on small inputs, against brute force."""

import ipaddress
import json
import random

import pytest
from pyspark.sql import functions as F

from rampart import ParserSpec, normalize, shipped_specs
from rampart.functions.text import round_half_even
from rampart.operators import enrich, lookup
from rampart.operators.extract import csv_cells_sql
from rampart.sinks import writers
from rampart.sources import readers
from rampart.specs import SpecSet
from rampart.specs.patterns import to_java
from rampart.streaming import jobs


def test_rounding_matches_python(spark):
    generator = random.Random(3)
    values = [2.675, 15.625, 0.125, 1.005, 2.5, 0.0, 1e9 + 0.005] + [generator.randint(0, 10**6) / 1000 for _ in range(300)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for row in frame.select("v", round_half_even(F.col("v"), 2).alias("r")).collect():
        assert row.r == round(row.v, 2), row


@pytest.mark.parametrize("broadcast", [True, False])
def test_attach_keeps_every_row(spark, broadcast):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.when(F.col("id") % 3 == 1, F.col("id").cast("string"))).alias("k"))
    table = spark.createDataFrame([("hot", 1), ("4", 2)], "key string, p int")
    found = lookup.attach(facts, table, "k", "key", "p", broadcast=broadcast)
    counts = {r.p: r["count"] for r in found.groupBy("p").count().collect()}
    assert counts == {1: 1000, 2: 1, None: 1999}


def test_rows_without_a_key_fill_all_partitions(spark):
    facts = spark.range(20_000).select("id", F.nullif((F.col("id") % 1).cast("string"), F.lit("0")).alias("k"))
    table = spark.createDataFrame([("hot", 1)], "key string, p int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup.attach(facts, table, "k", "key", "p", broadcast=False)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 40 and max(sizes) < 3 * 20_000 / 40


def test_ranges_that_are_no_network_are_refused(spark):
    odd = spark.createDataFrame([(0, 5, 9, "A", "a", "1")], enrich.PLACE_DDL)
    with pytest.raises(ValueError):
        enrich.place_index(odd)


def test_places_with_overlaps_match_brute_force(spark):
    generator = random.Random(5)
    networks = [("20.0.0.0/8", "A", "a", "1"), ("20.1.0.0/16", "B", "b", "2")]
    for i in range(60):
        network = ipaddress.ip_network((generator.randrange(20 << 24, 22 << 24), generator.choice([7, 9, 14, 17, 20, 24, 28, 32])), strict=False)
        networks.insert(generator.randrange(len(networks)), (str(network), f"C{i}", "c", "x"))
    addresses = [str(ipaddress.ip_address(generator.randrange(20 << 24, 23 << 24))) for _ in range(400)] + ["8.8.8.8", "x", "10.0.0.1"]

    def brute(text):
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return None
        if address.is_private:
            return "INTERNAL"
        return next((c for n, c, *_ in networks if address in ipaddress.ip_network(n)), "GLOBAL")

    index = enrich.place_index(enrich.place_table(spark, networks))
    frame = spark.createDataFrame([(a, "1.2.3.4") for a in addresses], "src_ip string, dst_ip string")
    for row in enrich.with_network_context(frame, index).select("src_ip", "src_country").collect():
        assert row.src_country == brute(row.src_ip), row


def test_indicator_table_equals_shipped(spark):
    frame = spark.createDataFrame(
        [("185.220.101.5", "8.8.8.8"), ("1.1.1.1", "45.33.32.156"), ("1.1.1.1", None), (None, None)], "src_ip string, dst_ip string"
    )
    shipped = enrich.with_indicator(frame, mode="internet")
    joined = enrich.with_indicator(frame, enrich.indicator_table(spark), mode="internet")
    assert sorted(map(str, shipped.collect())) == sorted(map(str, joined.collect()))


def test_pattern_translation(spark):
    assert to_java(r"(?P<a_b>x)(?P<c>\d+)?").empty_is_missing == (True, True)
    assert to_java(r"(?P<a>x*)").runs_on_jvm and not to_java(r"(?P<a>x*)?y").runs_on_jvm
    assert to_java(r"[[]").java == r"(?d)[\[]"


def test_spec_on_the_arrow_path(spark):
    specs = shipped_specs().register(
        {"id": "mine", "vendor": "Me", "format": "regex", "parser_config": {"pattern": r"id=(?P<x>\d*)?;(?P<src_ip>\S+)"}, "mapping": {"src_endpoint.ip": "src_ip"}}
    )
    frame = spark.createDataFrame([("id=;1.1.1.1",), ("nothing",)], "raw_event string")
    rows = normalize(frame, specs=specs, parser_id="mine", details=True).collect()
    assert rows[0].fields == {"x": "", "src_ip": "1.1.1.1"} and rows[0].product.vendor_name == "Me"
    assert rows[1].fields == {}


def test_marker_character_in_a_line(spark):
    frame = spark.createDataFrame([("1.5\tC1\t1.1.1.1\t5\t2.2.2.2\t6\ttcp\tx\x01y\t1\t2\t3\tSF",)], "raw_event string")
    event = normalize(frame, details=True).first()
    assert event.fields["service"] == "x\x01y" and event.fields["conn_state"] == "SF"


def test_csv_shapes(spark):
    frame = spark.createDataFrame([("a,,b",), (',"x,y",',), ("a\rb",), ("a,b\nc",), ('a"b,"un',), ("",)], "t string")
    cells = [r.c for r in frame.select(F.expr(csv_cells_sql("t", ",")).alias("c")).collect()]
    assert cells == [["a", "", "b"], ["", "x,y", ""], None, ["a", "b"], ['a"b', "un"], None]


def test_specs_from_files(tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"id": "one", "format": "key_value", "mapping": {"app_name": ["a"]}}))
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "broken.json").write_text(json.dumps({"id": "b", "format": "regex", "parser_config": {"pattern": "("}}))
    with pytest.warns(UserWarning):
        specs = SpecSet().load(str(tmp_path))
    assert specs.ids() == ["one"] and isinstance(specs.get("one"), ParserSpec)
    assert specs.get("one").source_keys("app_name") == (["a"], False)


def test_line_files(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\n\n# note\n  # indented\n  two \xff\n")
    read = [r.raw_event for r in readers.read_lines(spark, str(tmp_path)).collect()]
    assert read == ["one", "two �"]
    kept = readers.read_lines(spark, str(tmp_path), comment_before_strip=True)
    assert [r.raw_event for r in kept.collect()] == ["one", "# indented", "two �"]


def test_datagrams(spark):
    frame = spark.createDataFrame([(bytearray("a\r\nb  \nc".encode()),)], "value binary")
    assert [r.raw_event for r in readers.split_datagrams(frame).collect()] == ["a", "b", "c"]


def test_upsert_replaces_and_fan_out_isolates(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"src_ip=10.0.0.{i} x=1 y=2 action=allow") for i in range(5)], "i int, raw_event string")
    first = normalize(frame, id_cols=["i"], ingested_at=F.timestamp_seconds(F.lit(0)))
    later = normalize(
        frame.where("i < 2").withColumn("raw_event", F.lit("src_ip=10.0.0.9 x=1 y=2 action=deny")),
        id_cols=["i"], ingested_at=F.timestamp_seconds(F.lit(9)),
    )
    path = str(tmp_path / "forensic")

    def broken(batch):
        raise OSError("down")

    outcome = {}
    with pytest.warns(UserWarning):
        outcome = writers.fan_out(first, {"bad": broken, "good": lambda batch: writers.upsert_forensic(batch, path)})
    assert outcome["good"] is None and "down" in outcome["bad"]
    writers.upsert_forensic(later, path)
    actions = sorted(r.action for r in writers.read_forensic(spark, path).collect())
    assert actions == ["Allowed"] * 3 + ["Blocked"] * 2
    assert writers.write_outbox(first, str(tmp_path / "out")) == 5


def test_lookups_are_pushed_to_the_stored_table(spark):
    from rampart import normalize
    from rampart.functions.session import fresh_path
    from rampart.operators import search
    from rampart.sinks import writers

    path = fresh_path(spark, "forensic-test")
    frame = spark.createDataFrame([(f"src_ip=10.0.0.{i} dst_ip=10.0.1.{i} action=allow",) for i in range(50)], "raw_event string")
    writers.upsert_forensic(normalize(frame), path, fresh_ids=True)
    stored = writers.read_forensic(spark, path)
    found = search.events_by_key(stored, src_ip="10.0.0.7", action="Allowed")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(src_ip,10.0.0.7)" in plan and "EqualTo(action,Allowed)" in plan
    assert [r.dst_ip for r in found.collect()] == ["10.0.1.7"]


def test_chosen_parsers(spark):
    rows = spark.createDataFrame([("CEF:0|a|b|1|1|n|3|src=10.0.0.1",), ("x=1 y=2 z=3 w=4",), ("plain",)], "raw_event string")
    chosen = normalize(rows, parsers=["generic_kv", "no_such_parser"])
    assert [r.parser_id for r in chosen.select("lineage.parser_id").collect()] == ["generic_kv"]
    # What only other specs need is not in the plan.
    plans = [df.select("unmapped")._jdf.queryExecution().analyzed().toString() for df in (normalize(rows), chosen)]
    assert ["device_event_class_id" in plan for plan in plans] == [True, False]
    assert chosen.count() == 1 and normalize(rows, parsers=[]).collect() == []
    assert normalize(rows, parser_id="generic_kv", parsers=["generic_kv"]).count() == 3


def test_specs_are_read_again_for_each_batch(spark, tmp_path):
    inbox, specs = tmp_path / "inbox", tmp_path / "specs"
    inbox.mkdir()
    specs.mkdir()
    found = {}

    def run(name):
        (inbox / f"{name}.txt").write_text(f"tag={name}\n# a comment\n")
        job = jobs.stream_to_sinks(
            readers.stream_lines(spark, str(inbox)),
            {"seen": lambda batch: found.update({r.raw_event: r.parser_id for r in batch.select("raw_event", "lineage.parser_id").collect()})},
            str(tmp_path / "progress"), specs_dir=str(specs), parser_id="late", once=True,
        )
        job.awaitTermination()

    run("before")
    (specs / "late.json").write_text(json.dumps({"id": "late", "format": "kv"}))
    run("after")
    assert found == {"tag=before": "generic_raw", "tag=after": "late"}
