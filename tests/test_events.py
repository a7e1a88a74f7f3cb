"""Whole lines to canonical events: one line per supported shape, and edge rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from rampart import normalize, verify_integrity
from rampart.operators import features, risk
from rampart.schema import EVENT_COLUMNS

LINES = {
    "pan": "<141>1,2025/11/19 22:41:07,7733,TRAFFIC,end,9,2025/11/19 22:41:06,10.44.3.17,151.101.9.6,100.66.0.4,151.101.9.6,web out,acme\\lee,,ssl,vsys3,office,internet,ae2,ae9,soc,2025/11/19 22:41:07,88123,2,40112,8443,21007,8443,0x1c,tcp,allow,9120,7020,2100,31,2025/11/19 22:40:55,12,news",
    "asa": "<190>Nov 19 22:43:31 border2 %ASA-6-302014: Teardown UDP connection 70441 for dmz:9.9.9.9/53 to lan:10.8.0.23/60111 duration 0:00:04 bytes 351",
    "deny": '<188>Nov 19 22:44:02 border2 %ASA-4-106023: Deny udp src wan:91.198.174.5/4242 dst dmz:172.19.4.8/161 by access-group "edge-in" [0x1f, 0x2]',
    "forti": '<185>date=2025-11-19 time=22:45:50 devname="branch-7" type="traffic" level="warning" srcip=172.30.6.2 srcport=51020 srcintf="lan3" dstip=93.184.216.34 dstport=993 dstintf="isp2" proto=6 action="deny" policyid=41 app="IMAPS" sentbyte=310 rcvdbyte=0 duration=3',
    "eve": '{"timestamp":"2025-11-19T22:46","flow_id":551,"event_type":"alert","src_ip":"10.77.1.9","src_port":39001,"dest_ip":"45.155.205.9","dest_port":8081,"proto":"TCP","app_proto":"http","alert":{"action":"allowed","gid":1,"signature_id":9000417,"rev":6,"signature":"LOCAL beacon interval","category":"Trojan","severity":2},"flow":{"pkts_toserver":12,"pkts_toclient":9,"bytes_toserver":1840,"bytes_toclient":6011}}',
    "pf": "<131>Nov 19 22:47:15 gate filterlog: 77,,,1700000521,vtnet3,match,pass,out,4,0x10,,61,4110,0,none,17,udp,92,10.2.2.14,149.112.112.9,55010,853",
    "zeek": "1763592480.51\tCq9\t10.90.0.3\t47001\t172.16.40.2\t445\ttcp\tsmb\t2.5\t900\t4100\tSF\tT\tT",
    "cef": "CEF:0|Northgate|Sentry|9.4|auth-12|Password spray|Low|src=10.5.5.5 dst=10.6.6.6 spt=61002 dpt=3306 proto=17 act=permit in=77 out=33 app=mysql",
    "leef": "LEEF:1.0|Northgate|Relay|2.2|LOGIN|src=10.5.9.1\tsrcPort=4100\tdst=10.2.0.9",
    "ios": "031877: 2025 Nov 19 22:49:03.104 UTC: %SEC_LOGIN-5-LOGIN_SUCCESS: Login Success [user: ops7] [Source: 10.12.0.77] [port: 2202]",
    "ioc": "<140>src_ip=45.33.32.156 dst_ip=10.3.3.3 dst_port=22 proto=tcp action=deny tenant=blue",
    "overflow": "<13>src_ip=10.0.0.1 dst_ip=10.0.0.2 proto=tcp action=allow bytes=1e400",
    "odd numbers": "a=1 src_ip=10.0.0.1 src_port=120.9 dst_ip=010.0.0.1 dst_port=1d bytes_in=nan bytes_out=1_000 action= b=c src_ip=10.0.0.9 note=\"\"",
    "ftd": "%FTD-4-106023: Deny something",
    "snort": "[**] [1:2:3] alert [**]",
    "blank": " \t  ",
    "ipv6": "src_ip=2001:db8::1 dst_ip=2606:4700::1111 proto=58 action=Permit severity=0",
    "bad json": '{"event_type":"dns", "src_ip":"1.1.1.1"} trailing',
    "deep json": '<14>x {"event_type":"dns","a":{"b":{"c":{"d":[1,2]}}},"a.b":0,"f":1.50,"t":true,"src_ip":"","proto":0,"e":{}}',
    "quoted csv": '1,"2026/02/03 10:00:15",s,TRAFFIC,"a ""b"", c"x,1',
    "carriage": "<14>a=1\rb=2, c=3 d=4",
}


@pytest.fixture(scope="module")
def events(spark):
    frame = spark.createDataFrame(list(LINES.items()), "name string, line string")
    found = normalize(frame, raw_col="line", keep=["name"], id_cols=["name"], details=True)
    scored = features.with_feature_vector(risk.with_risk(found))
    rows = scored.select("*", verify_integrity().alias("verified")).collect()
    assert len(rows) == len(LINES)
    return {row["name"]: row for row in rows}


def summary(e):
    return (
        e.lineage.parser_id, e.src_endpoint.ip, e.src_endpoint.port, e.dst_endpoint.ip, e.dst_endpoint.port,
        e.connection_info.protocol_name, e.connection_info.protocol_num, e.disposition, e.severity,
        e.connection_info.direction, e.threat.signature_id if e.threat else None,
        (e.traffic.bytes_in, e.traffic.bytes_out, e.traffic.total_bytes), len(e.unmapped),
        e.mitre.technique_id, e.risk.score, e.risk.level, e.app_name,
    )


EXPECTED = {
    "pan": ("palo_alto_traffic", "10.44.3.17", 40112, "151.101.9.6", 8443, "TCP", 6, "Allowed", "Informational", "Outbound", None, (2100, 7020, 9120), 22, "T1562.004", 15, "Low", "ssl"),
    "asa": ("cisco_asa", "10.8.0.23", 60111, "9.9.9.9", 53, "UDP", 17, "Allowed", "Informational", "Outbound", "302014", (0, 0, 0), 7, "T1562.004", 65, "High", None),
    "deny": ("cisco_asa", "91.198.174.5", 4242, "172.19.4.8", 161, "UDP", 17, "Blocked", "Medium", "Inbound", "106023", (0, 0, 0), 7, "T1562.004", 95, "Critical", None),
    "forti": ("fortinet_fortios", "172.30.6.2", 51020, "93.184.216.34", 993, "TCP", 6, "Blocked", "Medium", "Outbound", None, (0, 310, 310), 4, "T1562.004", 35, "Medium", "IMAPS"),
    "eve": ("suricata_eve", "10.77.1.9", 39001, "45.155.205.9", 8081, "TCP", 6, "Allowed", "Critical", "Outbound", "9000417", (6011, 1840, 7851), 5, "T1562.004", 65, "High", "http"),
    "pf": ("pfsense_filterlog", "10.2.2.14", 55010, "149.112.112.9", 853, "UDP", 17, "Allowed", "Informational", "Outbound", None, (0, 0, 92), 15, "T1562.004", 15, "Low", "udp"),
    "zeek": ("zeek_conn", "10.90.0.3", 47001, "172.16.40.2", 445, "TCP", 6, "Unknown", "Informational", "Lateral", None, (4100, 900, 5000), 0, "T1562.004", 30, "Medium", "smb"),
    "cef": ("generic_cef", "10.5.5.5", 61002, "10.6.6.6", 3306, "UDP", 17, "Allowed", "Low", "Lateral", "auth-12", (77, 33, 110), 4, "T1562.004", 65, "High", "mysql"),
    "leef": ("generic_leef", "10.5.9.1", 4100, "10.2.0.9", None, "unknown", None, "Unknown", "Informational", "Lateral", "LOGIN", (0, 0, 0), 4, "T1562.004", 65, "High", None),
    "ios": ("cisco_ios", "10.12.0.77", None, None, 2202, "unknown", None, "Allowed", "Low", "Unknown", "LOGIN_SUCCESS", (0, 0, 0), 5, "T1562.004", 65, "High", None),
    "ioc": ("generic_kv", "45.33.32.156", None, "10.3.3.3", 22, "TCP", 6, "Blocked", "High", "Inbound", "IOC-LOG4J-PROBE", (0, 0, 0), 1, "T1021.004", 100, "Critical", "ssh"),
}


@pytest.mark.parametrize("name", EXPECTED)
def test_supported_shapes(events, name):
    assert summary(events[name]) == EXPECTED[name]


def test_raw_text_and_hash_survive(events):
    for name, line in LINES.items():
        event = events[name]
        assert event.raw_event == line.strip()
        assert event.lineage.raw_hash == hashlib.sha256(line.strip().encode()).hexdigest()
        assert event.verified


def test_event_ids_repeat(spark, events):
    frame = spark.createDataFrame(list(LINES.items()), "name string, line string")
    again = normalize(frame, raw_col="line", keep=["name"], id_cols=["name"])
    ids = {r["name"]: r["event_id"] for r in again.select("name", "lineage.event_id").collect()}
    assert ids == {name: e.lineage.event_id for name, e in events.items()}
    assert len(set(ids.values())) == len(LINES)


def test_overflow_is_kept_as_invalid(events):
    event = events["overflow"]
    assert not event.lineage.is_valid
    assert event.lineage.parser_id == "unknown" and event.product.vendor_name == "Unknown"
    assert event.unmapped == {"parse_error": "cannot convert float infinity to integer"}
    assert event.src_endpoint.ip is None and event.traffic.total_bytes == 0


def test_odd_numbers_and_addresses(events):
    event = events["odd numbers"]
    assert event.lineage.parser_id == "generic_kv"
    # The later of two equal keys counts, 120.9 is cut, 1d and nan are no numbers.
    assert (event.src_endpoint.ip, event.src_endpoint.port, event.dst_endpoint.port) == ("10.0.0.9", 120, None)
    assert (event.traffic.bytes_in, event.traffic.bytes_out) == (0, 1000)
    assert event.dst_endpoint.country is None and event.dst_endpoint.is_internal is False
    assert event.fields["action"] == "b=c" and event.fields["note"] is None
    assert event.unmapped == {"a": "1", "note": None}


def test_nothing_is_lost_in_silence(spark):
    rows = {
        "big": "src_ip=1.2.3.4 dst_ip=10.0.0.1 src_port=70000 dst_port=9999999999 bytes_in=10000000000000000000 bytes_out=5 action=allow",
        "space": "<13>src_ip=1.1.1.1\u3000dst_ip=2.2.2.2\x1cproto=udp action=deny x=1",
        "repeated": '{"event_type":"dns","src_ip":"1.1.1.1","src_ip":"2.2.2.2","dest_ip":"3.3.3.3","n":7,"ok":true}',
        "not a number": '{"event_type":"dns","src_ip":"1.1.1.1","score":NaN,"low":-Infinity, "deep":{"a":1}}',
        "deep": '{"event_type":"dns","src_ip":"1.1.1.1","d":{"a":1,"a":2}}',
    }
    frame = spark.createDataFrame(list(rows.items()), "name string, raw_event string")
    found = {r["name"]: r for r in normalize(frame, keep=["name"], details=True).collect()}
    big = found["big"]
    assert big.unmapped == {"dst_port": "9999999999", "bytes_in": "10000000000000000000"}
    assert big.lineage.validation_errors == ["dst_port out of range", "bytes_in out of range"]
    assert (big.src_endpoint.port, big.dst_endpoint.port, big.traffic.total_bytes) == (70000, None, 5)
    space = found["space"]
    assert (space.src_endpoint.ip, space.dst_endpoint.ip, space.connection_info.protocol_name) == ("1.1.1.1", "2.2.2.2", "UDP")
    assert found["repeated"].src_endpoint.ip == "2.2.2.2" and found["repeated"].json_literals == {"n": "7", "ok": "true"}
    assert found["not a number"].unmapped == {"event_type": "dns", "score": "nan", "low": "-inf", "deep.a": "1"}
    deep = found["deep"].lineage
    assert not deep.is_valid and deep.validation_errors == ["JSON object could not be read"]
    assert all(r.lineage.is_valid for name, r in found.items() if name != "deep")


def test_json_times_are_utc_text(spark):
    import json

    from rampart.operators.export import native_json

    frame = spark.createDataFrame([("x=1",)], "raw_event string").selectExpr("*", "timestamp'2026-01-02T03:04:05.123456Z' AS at")
    row = normalize(frame, ingested_at=F.col("at")).select(native_json().alias("j")).first()
    assert json.loads(row.j)["lineage"]["ingestion_timestamp"] == "2026-01-02T03:04:05.123456+00:00"


def test_lines_without_a_spec(events):
    assert events["ftd"].lineage.parser_id == "cisco_asa" and events["ftd"].fields == {}
    assert events["snort"].lineage.parser_id == "snort_fast"
    assert events["snort"].product.vendor_name == "Generic"
    assert events["blank"].lineage.parser_id == "generic_raw" and events["blank"].confidence == 0.0


def test_ipv6(spark):
    from rampart.operators.enrich import with_network_context

    pairs = [
        ("2001:db8::1", "INTERNAL"), ("2606:4700::1111", "GLOBAL"), ("::1", "INTERNAL"), ("::ffff:8.8.8.8", "INTERNAL"),
        ("fe80::1%eth0", "INTERNAL"), ("1:2:3:4:5:6:7:8:9", None), ("1::2::3", None), ("2001:20::1", "GLOBAL"),
        ("12345::", None), ("192.0.2.1", "INTERNAL"), ("192.0.0.9", "GLOBAL"), ("100.64.0.1", "GLOBAL"), ("300.1.1.1", None),
    ]
    frame = spark.createDataFrame([(a, "10.0.0.1") for a, _ in pairs], "src_ip string, dst_ip string")
    found = {r.src_ip: r.src_country for r in with_network_context(frame).collect()}
    assert found == dict(pairs)


def test_json(events):
    event = events["deep json"]
    assert event.lineage.parser_id == "suricata_eve" and event.syslog_meta.syslog_severity == 6
    assert event.fields == {
        "event_type": "dns", "a.b.c.d": "[1,2]", "a.b": "0", "f": "1.5", "t": "True", "src_ip": "", "proto": "0",
    }
    # JSON 0 and an empty text do not count as values.
    assert event.connection_info.protocol_name == "unknown" and event.src_endpoint.ip is None
    assert event.json_literals["a.b"] == "0" and "event_type" not in event.json_literals
    assert events["bad json"].fields["src_ip"] == "1.1.1.1"


def test_quoted_csv(events):
    fields = events["quoted csv"].fields
    assert fields["receive_time"] == "2026/02/03 10:00:15" and fields["subtype"] == 'a "b", cx'
    assert fields["future_use_2"] == "1" and fields["time_generated"] is None


def test_feature_vector(events):
    assert list(events["forti"].features) == [
        51020, 993, 1, 1, 1, 0, 0, 1, 0, 0, 1, 0, 0, 0, 0, 5.7398, 5.7398, 5.7398, 0, 0.003, 77500, 1, 0, 2, 0, 0,
    ]


def test_column_order(spark, events):
    frame = spark.createDataFrame([("x",)], "raw_event string")
    assert normalize(frame).columns == EVENT_COLUMNS


def test_filters_on_events_stay_plannable(spark):
    frame = spark.createDataFrame([(line,) for line in LINES.values()], "raw_event string")
    found = normalize(frame).where("src_endpoint.ip = '45.33.32.156' AND disposition = 'Blocked'")
    assert [r.severity for r in found.collect()] == ["High"]
