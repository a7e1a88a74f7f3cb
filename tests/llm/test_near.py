"""Near-duplicates, vectors, components and the pipeline against brute force."""

import contextlib
import io
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import rampart.llm.components as stars
from rampart.llm import covertree, language, minhash, mixing, pq, stages, toxicity
from rampart.llm.common import WORD, few_rows, staged, with_offsets
from rampart.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


class Groups:
    """Union-find whose roots are least members."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, words):
    found = re.findall(WORD, (text or "").translate(LOWER))
    width = min(words, len(found))
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)} if found else set()


def brute_groups(rows, words, percent):
    """Per row of (doc_id, text): the set's size, and the root row."""
    sets = [shingles(text, words) for _, text in rows]
    groups, postings = Groups(), defaultdict(list)
    for i, own in enumerate(sets):
        same = defaultdict(int)
        for s in own:
            for j in postings[s]:
                same[j] += 1
            postings[s].append(i)
        for j, n in same.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                groups.join(i, j)
    return [(len(own), groups.root(i)) for i, own in enumerate(sets)]


def check_near(frame, words, percent):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    groups = brute_groups(rows, words, percent)
    least = {}
    for (doc_id, _), (_, root) in zip(rows, groups):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    wanted = [(d, n, least.get(g), d is not None and d == least.get(g)) for (d, _), (n, g) in zip(rows, groups)]
    found = minhash.near_duplicates(frame, words=words, percent=percent).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in found) == sorted(map(str, wanted))


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, odd_docs, prose, words, percent):
    document, near = prose
    rows = [(i, " ".join(document(80))) for i in range(60)]
    for base in range(8):
        words_of = document(120)
        rows += [(1000 + 100 * base + i, " ".join(near(words_of, random.Random(i).randrange(0, 9)))) for i in range(25)]
    # A chain: neighbours are alike, the ends are not.
    chain = document(100)
    for i in range(30):
        chain = near(chain, 2)
        rows.append((5000 + i, " ".join(chain)))
    rows += [(6000 + i, rows[5][1].upper()) for i in range(40)]
    # Documents that share a long passage and are not alike.
    passage = " ".join(document(60))
    rows += [(7000 + i, passage + " " + " ".join(document(30))) for i in range(60)]
    frame = spark.createDataFrame(rows, DOCS).unionByName(odd_docs, allowMissingColumns=True)
    check_near(frame, words, percent)


def test_large_buckets_are_compared_in_blocks(spark, prose, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 3)
    monkeypatch.setattr(minhash, "LEFT_BLOCK", 4)
    monkeypatch.setattr(minhash, "RIGHT_BLOCK", 9)
    monkeypatch.setattr(minhash, "_COLUMNS", 50)
    document, near = prose
    base = document(60)
    rows = [(i, " ".join(near(base, 5))) for i in range(120)]
    check_near(spark.createDataFrame(rows, DOCS), 3, 70)


def test_near_duplicates_of_nothing(no_docs, spark):
    assert minhash.near_duplicates(no_docs).collect() == []
    check_near(spark.createDataFrame([(1, None), (2, ""), (3, " ")], DOCS), 3, 85)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(5000, 5000 + i) for i in range(1, 700)] + [(9, 9)]
    groups = Groups()
    for a, b in links:
        groups.join(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {x: groups.root(x) for x in linked}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_steps_of_components_have_short_plans(spark, monkeypatch):
    """A step reads its links a few times, whether a key is hot or not: the driver holds
    each plan, and works on it again after each of its stages."""
    scans = []

    def counted(df, name):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain()
        scans.append(plan.getvalue().count("FileScan"))
        return staged(df, name)

    monkeypatch.setattr(stars, "staged", counted)
    chain, star = [(100 + i, 101 + i) for i in range(6)], [(0, i) for i in range(1, 50)]
    for hot_rows in (stars.HOT_ROWS, 20):
        monkeypatch.setattr(stars, "HOT_ROWS", hot_rows)
        found = components(spark.createDataFrame(chain + star, "u long, v long")).collect()
        assert {(r.node, r.component) for r in found} == {(i, 0) for i in range(50)} | {(100 + i, 100) for i in range(7)}
    assert 0 < max(scans) <= 8


# ----------------------------------------------------------------------- vectors
def vector_rows():
    rng = np.random.default_rng(2)
    rows = []
    for label in (1, 2):
        for center in rng.normal(size=(40, 12)):
            for _ in range(rng.integers(1, 9)):
                rows.append((len(rows), (center + rng.normal(size=12) * 0.06).tolist(), label))
    rows += [(500 + i, rows[3][1], 1) for i in range(60)]
    rows += [(600, [2 * x for x in rows[3][1]], 1), (600, rows[7][1], 1), (601, rows[3][1], None)]
    rows += [(602, None, 1), (603, [0.0] * 12, 1), (603, [0.0] * 12, 1), (604, [float("nan")] * 12, 1), (605, [float("inf")] + [1.0] * 11, 2)]
    rows += [(606, [None] + [1.0] * 11, 2), (607, [], 1), (608, [1.0, 2.0], 1), (609, [2.0, 4.0], 1), (None, rows[9][1], 2), (None, None, None)]
    return rows


def fine(vector):
    return vector is not None and len(vector) > 0 and all(x is not None and np.isfinite(x) for x in vector)


VECTORS = "vec_id long, embedding array<float>, label int"


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pq, "BLOCK", 50)
    frame = spark.createDataFrame([(*r, r[0], 1) for r in vector_rows()], f"{VECTORS}, node long, cell int")
    rows = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    groups, links = Groups(), [0] * len(rows)
    for i, (_, a, x) in enumerate(rows):
        groups.root(i)
        for j, (_, b, y) in enumerate(rows[:i]):
            if x is not None and x == y and fine(a) and fine(b) and len(a) == len(b) and any(a) and any(b):
                a_, b_ = np.array(a, float), np.array(b, float)
                if a_ @ b_ / np.sqrt((a_ @ a_) * (b_ @ b_)) >= 0.98:
                    groups.join(i, j)
                    links[i] += 1
                    links[j] += 1
    least = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[groups.root(i)] = min(vec_id, least.get(groups.root(i), vec_id))
    wanted = [(v, links[i], least.get(groups.root(i)), v is not None and v == least.get(groups.root(i))) for i, (v, _, _) in enumerate(rows)]
    for lists in (20, 1000):
        found = pq.near_vectors(frame, list_rows=lists).collect()
        assert sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in found) == sorted(map(str, wanted))
    assert pq.near_vectors(frame.where("vec_id < -5")).collect() == []
    alone = pq.near_vectors(frame.where("vec_id IN (602, 603)")).collect()
    assert {(r.n_links, r.component_id, r.kept) for r in alone} == {(0, 602, True), (0, 603, True)}


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 64)
    frame = spark.createDataFrame([(*r, 5, "x") for r in vector_rows()], f"{VECTORS}, width int, block string")
    rows = [(r.vec_id, [int(np.floor(256 * x)) for x in map(float, r.embedding)]) for r in frame.collect() if fine(r.embedding) and r.vec_id is not None]
    wanted = []
    for query, a in rows:
        if query % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in rows if v != query and len(a) == len(b))
            wanted += [(query, i + 1, v, -s) for i, (s, v) in enumerate(scored[:5])]
    found = covertree.top_k(frame).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted(wanted)
    assert covertree.top_k(frame.where("vec_id < -5")).collect() == []
    assert covertree.top_k(frame.where("vec_id = 602")).collect() == []


def test_top_k_of_equal_query_rows(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 64)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    # Query 50 twice, 100 three times and once with another vector; a candidate twice.
    rows += [rows[50], rows[100], rows[100], (100, rows[7][1]), rows[13]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(v, [int(np.floor(256 * x)) for x in e]) for v, e in rows]
    wanted = []
    for query, a in whole:
        if query % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in whole if v != query)
            wanted += [(query, i + 1, v, -s) for i, (s, v) in enumerate(scored[:5])]
    found = covertree.top_k(frame).collect()
    assert len(wanted) == 5 * (6 + 4) and sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted(wanted)


def test_cover_tree_covers():
    points = np.random.default_rng(4).integers(-99, 99, (3000, 3)).astype(float)

    def walk(node):
        gaps = np.sqrt(((points[node.rows] - node.center) ** 2).sum(axis=1))
        assert gaps.max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            for child in node.children:
                walk(child)

    walk(covertree.cover_tree(points))


# ---------------------------------------------------------------------- pipeline
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged_docs(spark, tmp_path_factory):
    """Input and result of every stage on the smallest tables."""
    sf_dir = "/root/testdata/sf0.001"
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found[-1], sf_dir).write.parquet(str(folder / name))
        found.append(spark.read.parquet(str(folder / name)))
    return found


def bag(frame):
    return sorted(str(tuple(r)) for r in frame.select(COLUMNS).collect())


def test_pipeline_filters(spark, staged_docs):
    docs, clean, known = staged_docs[:3]
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.train(docs, labels)
    scores = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    keep = [d for d, s in scores.items() if s < stages.TOXIC]
    assert bag(clean) == bag(docs.where(F.col("doc_id").isin(keep))) and len(keep) < len(scores)
    judged = language.detect(clean, language.train(clean, F.lit(True))).collect()
    keep = [r.doc_id for r in judged if r.lang_pred != "und" and not r.ambiguous]
    assert bag(known) == bag(clean.where(F.col("doc_id").isin(keep)))


def test_pipeline_dedup(staged_docs):
    before, after = staged_docs[2:4]
    rows = [(r.doc_id, r.text) for r in before.orderBy("doc_id").collect()]
    groups = brute_groups(rows, 5, 80)
    keep = {rows[root][0] for _, root in groups}
    assert bag(after) == bag(before.where(F.col("doc_id").isin(sorted(keep))))
    assert after.count() < before.count()


def test_pipeline_mixing_and_packing(staged_docs):
    before, mixed, packed = staged_docs[3:6]
    times = {r.doc_id: int(r.taken / r.size + 0.5) if r.size else 0 for r in mixing.mix(before).collect()}
    found = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert found == {d: n for d, n in times.items() if n}
    starts = {r.doc_id: r["count"] for r in packed.where("start = 0").groupBy("doc_id").count().collect()}
    assert starts == found
    pieces = packed.orderBy("sequence_id", "offset").collect()
    place = 0
    for p in pieces:
        assert p.sequence_id * 2048 + p.offset == place
        place += p.length


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    sf_dir = "/root/testdata/sf0.001"
    for frame in (odd_docs, no_docs):
        docs, total = frame, frame.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
            if name != "packing":
                assert docs.columns == COLUMNS
        assert docs.count() >= 0 and (total > 0 or docs.count() == 0)
    kept = stages.dedup_stage(spark, odd_docs, sf_dir).collect()
    assert sum(r.text == "plain words, here and there" for r in kept) == 1
    assert sum(r.text == "other words under the same id" for r in kept) == 1
    assert sum(r.text == "a text without an id" for r in kept) == 1


def batch_sizes(docs):
    """How many rows a job that starts now hands to Python at once."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return [r.n for r in docs.mapInArrow(sizes, "n long").collect()]


@pytest.mark.parametrize("name", ["toxicity", "language", "near_dedup", "packing"])
def test_stages_hand_few_texts_at_once_to_python(spark, name):
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(option)
    docs = spark.range(1_200).coalesce(1).selectExpr("id doc_id", "'a text' text", "'en' lang", "'a' source", "6L n_chars")
    try:
        spark.conf.set(option, "10000")
        dict(corpus_pipeline.STAGES)[name](spark, docs.limit(3), "/root/testdata/sf0.001")
        # The stage's result is computed later, by whoever writes it.
        assert batch_sizes(docs) == [500, 500, 200]
        spark.conf.set(option, "300")
        stages.most_arrow_rows(spark, stages.TEXT_ROWS)
        assert max(batch_sizes(docs)) == 300
    finally:
        spark.conf.set(option, before)


def test_pipeline_leaves_the_session_as_it_was(spark, monkeypatch):
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, inside = spark.conf.get(option), []

    def stage(spark, docs, sf_dir):
        stages.most_arrow_rows(spark, stages.TEXT_ROWS)
        inside.append(spark.conf.get(option))
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage)])
    try:
        spark.conf.set(option, "4000")
        assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
        assert inside == ["500", "500"] and spark.conf.get(option) == "4000"
    finally:
        spark.conf.set(option, before)


def test_offsets_of_the_driver_need_no_python_workers(spark, capsys):
    rows = spark.createDataFrame([(2, 5), (0, 1), (0, 2), (2, 1), (7, 4)], "part int, n long").localCheckpoint()
    placed = with_offsets(rows.where("n > 0"), "part", "n", "before")
    assert sorted(tuple(r) for r in placed.select("part", "n", "before").collect()) == [(0, 1, 0), (0, 2, 0), (2, 1, 3), (2, 5, 3), (7, 4, 9)]
    offsets = few_rows(spark, [(0, 0), (2, 3)], pa.schema([("part", pa.int32()), ("before", pa.int64())]))
    offsets.explain()
    assert "LocalTableScan" in capsys.readouterr().out and offsets.dtypes == [("part", "int"), ("before", "bigint")]
    assert with_offsets(rows.where("n < 0"), "part", "n", "before").collect() == []
