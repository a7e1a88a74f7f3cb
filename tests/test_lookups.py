"""Large lookups: networks of both families, Bloom filters, rows that are not shuffled."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from rampart import normalize
from rampart.operators import enrich, lookup


def networks(count=150):
    rng = random.Random(7)
    found = [("0.0.0.0/0", "ANY4", "z", "0"), ("2001:4860::/32", "V6", "a", "1"), ("20.0.0.0/8", "A", "b", "2"), ("20.1.2.3", "ONE", "c", "3")]
    for i in range(count):
        if i % 2:
            base, bits = rng.randrange(20 << 24, 22 << 24), rng.choice([5, 7, 9, 14, 17, 20, 24, 28, 30, 32])
        else:
            base, bits = (0x2001_4860 << 96) + (rng.randrange(1 << 20) << rng.choice([0, 44, 76])), rng.choice([20, 33, 47, 48, 64, 65, 96, 127, 128])
        kind = ipaddress.IPv4Address if i % 2 else ipaddress.IPv6Address
        network = ipaddress.ip_network((kind(base), bits), strict=False)
        found.insert(rng.randrange(len(found)), (str(network), f"C{i}", "c", "x"))
    return found


def addresses(nets):
    rng = random.Random(8)
    found = ["8.8.8.8", "x", "", "10.0.0.1", "::1", "fe80::1%eth0", "2A00:1450:4001::200e", "20.1.2.3", None]
    for cidr, *_ in nets:
        net = ipaddress.ip_network(cidr)
        for offset in (0, -1, rng.randrange(net.num_addresses)):
            found.append(str(net[offset]))
        step = int(net.network_address) - 1
        found.append(str(type(net.network_address)(max(0, step))))
    return found


def brute(text, nets):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None
    if address.is_private:
        return "INTERNAL"
    return next((c for n, c, *_ in nets if address in ipaddress.ip_network(n)), "GLOBAL")


@pytest.mark.parametrize("limit, hits", [(lookup.BROADCAST_BYTES, lookup.BROADCAST_BYTES), (0, lookup.BROADCAST_BYTES), (0, 0)])
def test_networks_of_both_families_match_brute_force(spark, monkeypatch, limit, hits):
    nets = networks()
    index = enrich.prefix_index(enrich.network_table(spark, nets), broadcast_bytes=limit)
    assert index.broadcast == (limit > 0)
    if not hits:
        real = lookup.prepared
        monkeypatch.setattr(lookup, "prepared", lambda table, limit: (real(table, limit)[0], False))
    texts = addresses(nets)
    frame = spark.createDataFrame([(a, b) for a, b in zip(texts, texts[::-1])], "src_ip string, dst_ip string")
    found = enrich.with_network_context(frame, index).select("src_ip", "src_country", "dst_ip", "dst_country").collect()
    assert len(found) == len(texts)
    for row in found:
        for ip, country in ((row.src_ip, row.src_country), (row.dst_ip, row.dst_country)):
            assert country == (brute(ip, nets) if ip else None), row


def test_no_networks_and_odd_networks(spark):
    index = enrich.prefix_index(enrich.network_table(spark, []))
    frame = spark.createDataFrame([("8.8.8.8", "2a00::1")], "src_ip string, dst_ip string")
    row = enrich.with_network_context(frame, index).first()
    assert (row.src_country, row.dst_country) == ("GLOBAL", "GLOBAL")
    for odd in ("10.0.0.1/8", "nonsense", "10.0.0.0/33", "2001:db8::/x", "2001:db8::1/64"):
        with pytest.raises(ValueError, match="not a network"):
            enrich.prefix_index(enrich.network_table(spark, [("1.0.0.0/8", "a", "a", "a"), (odd, "b", "b", "b")]))


def test_filters_pass_all_keys_and_few_others(spark):
    keys = spark.range(5_000).select(F.concat(F.lit("k"), "id").alias("value"))
    filter_ = lookup.key_filter(keys, "value")
    rows = spark.range(50_000).select(F.when(F.col("id") % 10 != 9, F.concat(F.lit("k"), "id")).alias("ip"), "id")
    found = lookup.with_maybe(rows, "ip", filter_, "maybe").where("maybe")
    ids = {r.id for r in found.collect()}
    assert {i for i in range(5_000) if i % 10 != 9} <= ids and len(ids) < 5_000 + 5_000 and not any(i % 10 == 9 for i in ids)


def many_indicators(spark, count=3_000):
    base = spark.range(count).select(F.concat_ws(".", F.lit("45"), (F.col("id") / 250).cast("int"), F.col("id") % 250, F.lit("1")).alias("ip"), "id")
    return base.selectExpr("ip", "concat('S', id) AS signature_id", "'n' AS signature_name", "'c' AS category", "'v' AS cve", "'t' AS threat_actor", "0.5D AS confidence_score")


def event_rows(spark):
    """A third of the rows have one source, most others no hit."""
    return spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, "45.0.7.1").when(F.col("id") % 3 == 1, F.concat_ws(".", F.lit("9.9"), F.col("id") % 200, F.lit("1"))).alias("src_ip"),
        F.when(F.col("id") % 50 == 0, F.concat_ws(".", F.lit("45.1"), F.col("id") % 250, F.lit("1"))).otherwise("8.8.8.8").alias("dst_ip"),
        "id",
    )


@pytest.mark.parametrize("hits_fit", [True, False])
def test_large_indicator_tables(spark, monkeypatch, hits_fit):
    rows, table = event_rows(spark), many_indicators(spark)
    joined = enrich.with_indicator(rows, table)
    known = enrich.Indicators(enrich.prepared_indicators(table).table, False)
    if not hits_fit:
        real = lookup.prepared
        monkeypatch.setattr(lookup, "prepared", lambda table, limit: (real(table, limit)[0], False))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich.with_indicator(rows, known)
        plan = large._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.id, str(r.indicator)) for r in large.select("id", "indicator").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted((r.id, str(r.indicator)) for r in joined.select("id", "indicator").collect())
    assert sum(v != "None" for _, v in got) > 2_000
    if hits_fit:
        assert "Exchange hashpartitioning" not in plan
    else:
        # One branch, of the rows without a hit, has no shuffle below the union.
        assert "Union" in plan
        missed = plan[plan.index("Union") : plan.index("Exchange hashpartitioning")]
        assert "FileScan parquet" in missed and "BroadcastExchange" in missed


def test_events_with_large_tables_equal_shipped_ones(spark):
    lines = spark.createDataFrame([(i, f"src_ip={a} dst_ip={b} x=1 y=2 action=allow") for i, (a, b) in enumerate([("185.220.101.5", "8.8.8.8"), ("1.1.1.1", "45.33.32.156"), ("10.0.0.1", "9.9.9.9"), ("::1", "x")])], "i int, raw_event string")
    options = {"id_cols": ["i"], "keep": ["i"], "ingested_at": F.timestamp_seconds(F.lit(0))}
    shipped = normalize(lines, **options)
    places = enrich.prefix_index(enrich.network_table(spark, enrich.PLACES), broadcast_bytes=0)
    indicators = enrich.Indicators(enrich.prepared_indicators(enrich.indicator_table(spark)).table, False)
    large = normalize(lines, places=places, indicators=indicators, **options)
    assert sorted(map(str, large.collect())) == sorted(map(str, shipped.collect()))
