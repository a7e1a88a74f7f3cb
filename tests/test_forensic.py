"""The forensic table: replaced rows, crashes, replays, compaction, layout, newest first."""

import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rampart import normalize
from rampart.operators import search
from rampart.schema import FORENSIC_COLUMNS
from rampart.sinks import forensic

DAY = 86_400


def batch(spark, ids, action="allow", at=0, spread=0):
    """Events with the given ids; row i is ingested ``spread`` seconds after row i - 1."""
    rows = [
        (i, f"src_ip=10.{i % 7}.{i % 11}.{i % 250} dst_ip=10.9.{i % 5}.{i % 13} x=1 y=2 action={action} tag={i}", at + spread * k)
        for k, i in enumerate(ids)
    ]
    frame = spark.createDataFrame(rows, "i long, raw_event string, at long").repartition(2)
    return normalize(frame, id_cols=["i"], ingested_at=F.timestamp_seconds("at"), keep=["at"]).cache()


def expected(frames):
    """Rows that count: of one batch the newest of an id, of several the last."""
    newest = {}
    for frame in frames:
        own = {}
        for row in forensic.forensic_rows(frame).collect():
            if row.event_id not in own or tuple_key(row) > tuple_key(own[row.event_id]):
                own[row.event_id] = row
        newest |= own
    return sorted(map(tuple, newest.values()))


def tuple_key(row):
    return (row.ingestion_timestamp, *(str(v) for v in row))


def stored(spark, path):
    frame = forensic.read_forensic(spark, path)
    assert frame.columns == FORENSIC_COLUMNS
    return sorted(map(tuple, frame.collect()))


def size(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*.parquet"))


def test_whole_rows_through_upserts_and_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    frames = [
        batch(spark, range(40), spread=DAY // 8),
        batch(spark, range(30, 50), action="deny", at=3 * DAY),
        batch(spark, [5, 5, 5, 60, 61], action="drop", at=DAY, spread=100),
    ]
    for k, frame in enumerate(frames):
        assert forensic.upsert_forensic(frame, path)
        assert stored(spark, path) == expected(frames[: k + 1])
    days = forensic.compact_forensic(spark, path, rows_per_file=10)
    assert stored(spark, path) == expected(frames) and len(days) == 5
    state = forensic.manifest(spark, path)
    assert forensic.winners(spark, path, state) is None and forensic.compact_forensic(spark, path) == []
    # A later batch hits two of the days: the others are not written again.
    frames.append(batch(spark, [0, 1], action="deny", at=2 * DAY))
    forensic.upsert_forensic(frames[-1], path)
    assert stored(spark, path) == expected(frames)
    assert forensic.compact_forensic(spark, path) == ["1970-01-01", "1970-01-03"]
    assert stored(spark, path) == expected(frames)
    before = size(tmp_path / "t")
    assert forensic.vacuum_forensic(spark, path) > 0 and size(tmp_path / "t") < before
    assert stored(spark, path) == expected(frames)


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "t")
    forensic.upsert_forensic(batch(spark, range(3_000), spread=60), path)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    small = batch(spark, range(10), action="deny", at=9 * DAY)
    forensic.upsert_forensic(small, path)
    after = set(Path(path).rglob("*.parquet"))
    assert all(p.stat().st_mtime_ns == t for p, t in before.items()) and set(before) < after
    new = sum(p.stat().st_size for p in after - set(before))
    alone = str(tmp_path / "alone")
    forensic.upsert_forensic(small, alone)
    assert new <= 1.1 * size(alone) < size(path) / 5
    assert sum(pq.read_metadata(p).num_rows for p in after - set(before)) == 10
    assert forensic.read_forensic(spark, path).where("action = 'Blocked'").count() == 10


@pytest.mark.parametrize("step", ["_written", "publish"])
def test_a_crash_between_steps_loses_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    first, second = batch(spark, range(20)), batch(spark, range(10, 30), action="deny", at=DAY)
    forensic.upsert_forensic(first, path)

    def broken(*args):
        raise OSError("lost")

    for job in (lambda: forensic.upsert_forensic(second, path), lambda: forensic.compact_forensic(spark, path)):
        with monkeypatch.context() as m:
            m.setattr(forensic, step, broken)
            with pytest.raises(OSError):
                job()
        assert stored(spark, path) == expected([first])
    forensic.upsert_forensic(second, path)
    assert stored(spark, path) == expected([first, second])
    forensic.compact_forensic(spark, path)
    assert forensic.vacuum_forensic(spark, path) >= 3 and stored(spark, path) == expected([first, second])


def test_replayed_and_rival_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first, second = batch(spark, range(5)), batch(spark, range(3, 8), action="deny", at=DAY)
    assert forensic.upsert_forensic(first, path, label="batch 0")
    assert not forensic.upsert_forensic(first, path, label="batch 0")
    forensic.compact_forensic(spark, path)
    assert not forensic.upsert_forensic(first, path, label="batch 0")
    # Another writer commits between reading the manifest and publishing.
    real, rivals = forensic.publish, [second]

    def slow(*args):
        if rivals:
            forensic.upsert_forensic(rivals.pop(), path)
        return real(*args)

    monkeypatch.setattr(forensic, "publish", slow)
    third = batch(spark, [100], at=2 * DAY)
    assert forensic.upsert_forensic(third, path)
    assert stored(spark, path) == expected([first, second, third])
    rivals.append(batch(spark, [101], at=2 * DAY))
    assert forensic.compact_forensic(spark, path)
    assert forensic.read_forensic(spark, path).count() == 10


def test_empty_batches_and_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        forensic.read_forensic(spark, path)
    forensic.upsert_forensic(batch(spark, range(3)).where("false"), path)
    assert stored(spark, path) == [] and search.newest_events(spark, path).collect() == []
    frame = batch(spark, range(3))
    forensic.upsert_forensic(frame, path)
    assert stored(spark, path) == expected([frame])


def test_every_key_prunes_row_groups_of_a_compacted_table(spark, tmp_path):
    path = str(tmp_path / "t")
    vendors = ["%ASA-4-106023: Deny udp src outside:{0}/5 dst inside:{1}/6 by access-group", "filterlog: 4,,,1,em2,match,pass,in,4,0x8,,57,311,0,none,6,tcp,9,{0},{1},5,6",
               "src_ip={0} dst_ip={1} x=1 y=2 action={2} severity={3}", "CEF:0|A|B|1|x|n|{3}|src={0} dst={1} act={2}"]
    rows = []
    for i in range(6_000):
        a, b = f"{20 + i * 7919 % 60}.1.{i % 250}.9", f"{90 + i * 104_729 % 70}.2.{i % 240}.8"
        rows.append((i, vendors[i % 4].format(a, b, ["allow", "deny", "drop"][i // 4 % 3], i // 12 % 5)))
    frame = spark.createDataFrame(rows, "i long, raw_event string")
    forensic.upsert_forensic(normalize(frame, id_cols=["i"], ingested_at=F.timestamp_seconds(F.lit(5))), path, fresh_ids=True)
    forensic.compact_forensic(spark, path, rows_per_file=60)
    (segment,) = [s.name for s in forensic.manifest(spark, path).segments if s.days]
    groups = [pq.read_metadata(p).row_group(g) for p in Path(path, "data", f"segment={segment}").rglob("*.parquet") for g in range(pq.read_metadata(p).num_row_groups)]
    assert len(groups) >= 80
    sample = forensic.read_forensic(spark, path).orderBy(F.xxhash64("event_id")).limit(40).collect()
    for key in forensic.KEYS:
        place = next(k for k in range(groups[0].num_columns) if groups[0].column(k).path_in_schema == key)
        stats = [g.column(place).statistics for g in groups]
        values = [r[key] for r in sample if r[key] is not None]
        read = sum(s.min <= v <= s.max for v in values for s in stats) / (len(values) * len(stats))
        assert read < 0.75, (key, read)


def test_newest_of_a_year_read_few_days(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    frame = batch(spark, range(150), spread=DAY)
    forensic.upsert_forensic(frame, path)
    forensic.upsert_forensic(batch(spark, range(140, 145), action="deny", at=151 * DAY), path)
    read = []
    real = forensic.read_forensic

    def seen(*args, days=None, **kw):
        read.extend(days)
        return real(*args, days=days, **kw)

    monkeypatch.setattr(forensic, "read_forensic", seen)
    found = search.newest_events(spark, path, limit=50)
    monkeypatch.undo()
    wanted = search.search_events(forensic.read_forensic(spark, path), limit=50)
    assert found.collect() == wanted.collect() and len(read) <= 63
    plan = forensic.read_forensic(spark, path, days=read)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ingest_day" in plan
    one = search.newest_events(spark, path, "action = :a AND src_ip LIKE :s", {"a": "Allowed", "s": "10.%"}, limit=7)
    assert one.collect() == search.search_events(forensic.read_forensic(spark, path), "action = 'Allowed'", limit=7).collect()
    assert search.newest_events(spark, path, "action = 'Nothing'").collect() == []


def test_larger_tables_get_more_tasks_of_neighbouring_ids(spark, tmp_path, monkeypatch):
    from rampart.plans import lines

    columns = "event_id long, user_id long, event_type string, value double"
    rows = [(i * 37 % 1_000, i % 50, "click", i / 7) for i in range(1_000)]
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "events.parquet"))
    few = lines.lines(spark, str(tmp_path), 2)
    monkeypatch.setattr(lines, "TASK_EVENTS", 100)
    many = lines.lines(spark, str(tmp_path), 2)
    assert sorted(few.collect()) == sorted(many.collect()) and few.count() == 1_000
    parts = many.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    found = parts.orderBy("a").collect()
    assert len(found) >= 8 and max(r.n for r in found) <= 250
    assert all(x.b < y.a for x, y in zip(found, found[1:]))


def test_a_task_that_sorts_rows_reads_few_stored_ones(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    frame = batch(spark, range(60), spread=DAY // 20)
    frame.repartition(6).write.parquet(str(tmp_path / "events"))
    sorting = []

    def writer(rows, row_group_bytes, given=forensic._writer):
        sorting.append(int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")))
        return given(rows, row_group_bytes)

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(forensic, "_writer", writer)
    forensic.upsert_forensic(spark.read.parquet(str(tmp_path / "events")), path, fresh_ids=True)
    forensic.compact_forensic(spark, path)
    assert len(sorting) == 2 and max(sorting) <= 16 << 20
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert stored(spark, path) == expected([frame])
    clustered = next(s.name for s in forensic.manifest(spark, path).segments if s.clustered and s.days)
    files = (tmp_path / "t" / "data" / f"segment={clustered}").rglob("*.parquet")
    assert {pq.read_metadata(p).row_group(0).column(0).compression for p in files} == {"ZSTD"}
    assert forensic.ROWS_PER_FILE <= 200_000


def test_batches_of_a_query_parse_lines_once(spark, tmp_path, monkeypatch):
    from rampart.plans import queries, store

    rows = [(i, i % 50, "purchase", i / 7) for i in range(120)]
    columns = "event_id long, user_id long, event_type string, value double"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "events.parquet"))
    sources = []
    given = forensic.upsert_forensic

    def upsert(events, path, **options):
        sources.append(events.inputFiles())
        return given(events, path, **options)

    for module in (store.forensic, queries.writers):
        monkeypatch.setattr(module, "upsert_forensic", upsert)
    store._upserted(spark, str(tmp_path))
    queries.forensic_upsert(spark, str(tmp_path))
    assert len(sources) == 4 and not any("events.parquet/" in f for files in sources for f in files)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.length()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("ids_sent", [0, 20])
def test_compaction_goes_in_rounds_and_leaves_nothing_behind(spark, tmp_path, monkeypatch, ids_sent):
    path = str(tmp_path / "t")
    # 12 days of 20 rows; most of them replaced, some by rows of other days, two ids twice.
    frames = [batch(spark, range(240), spread=DAY // 20), batch(spark, [*range(40, 220), 50, 51], action="deny", at=9, spread=DAY // 15)]
    monkeypatch.setattr(forensic, "BROADCAST_BYTES", ids_sent * forensic._ID_BYTES)
    wanted, before = expected(frames), shuffle_files(spark)
    for frame in frames:
        forensic.upsert_forensic(frame, path)
    rounds = []

    def writer(rows, row_group_bytes, given=forensic._writer):
        rounds.append(rows.groupBy("ingest_day").count().collect())
        return given(rows, row_group_bytes)

    with monkeypatch.context() as m:
        m.setattr(forensic, "_writer", writer)
        days = forensic.compact_forensic(spark, path, rows_per_file=5)
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert stored(spark, path) == wanted and forensic.winners(spark, path, forensic.manifest(spark, path)) is None
    dealt = [str(r.ingest_day) for found in rounds for r in found]
    assert len(rounds) >= 5 and len(dealt) == len(set(dealt)) and set(dealt) <= set(days)
    most = 5 * max(8, spark.sparkContext.defaultParallelism)
    assert all(len(found) == 1 or sum(r["count"] for r in found) <= most for found in rounds)
    # The two batches, the second segment of the repeated ids, the compacted one.
    assert len(list((tmp_path / "t" / "data").iterdir())) == 4


def test_an_empty_table_is_compacted(spark, tmp_path):
    path = str(tmp_path / "t")
    forensic.upsert_forensic(batch(spark, range(3)).where("false"), path, label="none")
    assert forensic.compact_forensic(spark, path) == [] and stored(spark, path) == []
    assert not forensic.upsert_forensic(batch(spark, range(3)), path, label="none")


def test_files_of_a_batch_are_small_and_packed(spark, tmp_path):
    path = str(tmp_path / "t")
    forensic.upsert_forensic(batch(spark, range(10)).coalesce(1), path)
    (file,) = Path(path).rglob("*.parquet")
    assert file.stat().st_size < 64 << 10
    columns = [pq.read_metadata(file).row_group(0).column(i) for i in range(24)]
    assert {c.compression for c in columns} == {"ZSTD"}


def test_queries_keep_no_table_they_are_done_with(spark, tmp_path, monkeypatch):
    from rampart.functions import session
    from rampart.plans import store

    rows = [(i * 5_000, i % 50, "purchase", i / 7) for i in range(120)]
    columns = "event_id long, user_id long, event_type string, value double"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path / "kept"))
    found = store.forensic_compacted(spark, str(tmp_path))
    assert [p.name.split("-")[0] for p in (tmp_path / "kept").iterdir()] == ["forensic"]
    assert len(list((tmp_path / "kept").glob("*/data/*"))) == 1
    assert found.count() == 120 and found.where("severity = 'Reviewed'").count() > 0
