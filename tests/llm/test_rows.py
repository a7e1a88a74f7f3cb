"""URL rules, mixing and models on odd rows; every oracle on the smallest tables."""

import itertools
from collections import Counter, defaultdict

import pytest
from compare import mismatch, oracle_connection
from pyspark.sql import functions as F

from rampart.llm import language, mixing, stages, toxicity, urls
from rampart.llm.queries import ORACLES, QUERIES, URL_RULES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, connection, name):
    assert mismatch(spark, connection, name, QUERIES[name], ORACLES[name], SF_DIR) is None


# ------------------------------------------------------------------------- URLs
def test_urls(spark):
    cases = [
        (1, "https://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        (2, "http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        (3, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        (4, "http://example.com", "example.com", "", None, "allow"),
        (5, "x://b.net/es/1", "b.net", "/es/1", "net/es/", "block"),
        (6, "x://net/fr/", "net", "/fr/", "net/fr/", "block"),
        (7, "x://b.net/ES/1", "b.net", "/ES/1", None, "allow"),
        (8, None, "", "", None, "allow"),
        (9, "no scheme/en/", "", "", None, "allow"),
        (9, "a://b?c://d.com/", "b", "", None, "allow"),
        (None, "", "", "", None, "allow"),
        (10, "a://h.com/\n/" + "p" * 50_000, "h.com", "/\n/" + "p" * 50_000, "com/", "allow"),
    ]
    pages = spark.createDataFrame([c[:2] + ("rule", "host") for c in cases], "page_id long, url string, rule string, verdict string")
    found = urls.judge(pages, urls.rules_table(spark, URL_RULES)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((c[0], *c[2:])) for c in cases)
    assert urls.judge(pages.where("page_id = 99"), urls.rules_table(spark, URL_RULES)).collect() == []
    nothing = urls.judge(pages, urls.rules_table(spark, URL_RULES).where("host = 'none'"), default="block").collect()
    assert {(r.rule, r.verdict) for r in nothing} == {(None, "block")}


def test_equal_digests_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(urls, "_key", lambda text: 7)
    pages = spark.createDataFrame([(1, "a://b.net/es/"), (2, "a://b.net/")], "page_id long, url string")
    path = urls.fresh_path(spark, "digests-test")
    urls._build(urls.rules_table(spark, URL_RULES), path)
    array = urls.DigestArray(path.removeprefix("file://"))
    rows = array.find([b"net\0/es/", b"net\0/xx/", b"com\0/"])
    texts = [array.strings[array.offsets[r] : array.offsets[r + 1]].tobytes() for r in rows if r >= 0]
    assert rows[1] == -1 and texts == [b"net\0/es/", b"com\0/"]
    assert pages.count() == 2


# ------------------------------------------------------------------------ mixing
def water(sizes, weights, share, most):
    """Reshare by weight until no target is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = dict(zip(order, itertools.cycle(weights)))
    left, total, target = set(order), share * sum(sizes.values()), {}
    while left:
        each = total / sum(weight[s] for s in left)
        full = [s for s in left if each * weight[s] > most * sizes[s]]
        if not full:
            return target | {s: each * weight[s] for s in left}
        for s in full:
            target[s] = most * sizes[s]
            total -= target[s]
            left.remove(s)
    return target


def test_mixing(spark, odd_docs):
    more = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.array_repeat(F.col("id").cast("string"), (F.col("id") % 40).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
    )
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    found = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: str((r.doc_id, r.text, r.source, r.taken))
    assert sorted(map(key, found)) == sorted(map(key, again)) and len(found) == docs.count()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.size == len(mixing.WORD and __import__("re").findall(mixing.WORD, r.text or "")) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    wanted = water(sizes, (5, 2, 1), 1.5, 2)
    for r in found:
        assert r.target == pytest.approx(wanted[r.source]) and r.source_size == sizes[r.source]
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 1
    assert {"_key", "part", "n_chars"} <= set(found[0].asDict())


def test_better_documents_come_first(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    heavy = lambda text: F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    rows = mixing.mix(docs, share=0.3, quality=heavy).where("taken > 0").collect()
    assert 0.7 < sum(r.doc_id % 2 == 0 for r in rows) / len(rows) < 0.85


def test_mixing_of_nothing(no_docs):
    assert mixing.mix(no_docs).collect() == []
    assert mixing.mix(no_docs.limit(0)).columns[-4:] == ["size", "source_size", "target", "taken"]


# ------------------------------------------------------------------------ models
def test_language_on_held_out_documents(spark):
    rows = QUERIES["op9_language"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    right = [truth[r.doc_id] == r.lang_pred for r in rows]
    assert sum(right) / len(right) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd_docs, no_docs):
    model = language.train(odd_docs, F.lit(True))
    rows = language.detect(odd_docs, model, keep=("doc_id", "text", "part")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und" and r.lang_score == 0 and r.ambiguous) if not has_letter else r.lang_pred in {"en", "de", "fr"}
    nothing = language.train(no_docs, F.lit(True))
    assert {r.lang_pred for r in language.detect(odd_docs, nothing).collect()} == {"und"}
    assert language.detect(no_docs, model).collect() == []
    only = language.train(odd_docs.where("lang = 'fr'"), F.lit(True))
    assert {r.lang_pred for r in language.detect(odd_docs, only).collect()} == {"fr", "und"}


def test_every_language_is_learned_from_few_of_many_rows(spark):
    rows = [("en", f"the words number {i} of many") for i in range(4_000)]
    rows += [("de", f"die W\u00f6rter mit der Zahl {i}") for i in range(5)]
    rows += [("fr", "les mots sont toujours les m\u00eames")] * 3_000
    docs = spark.createDataFrame(rows, "lang string, text string")
    drawn = [tuple(r) for r in language._sample(docs, 200).collect()]
    assert len(set(drawn)) == len(drawn) and set(drawn) <= set(rows)
    per = Counter(lang for lang, _ in drawn)
    assert per["de"] == 5 and per["fr"] == 1 and 120 < per["en"] < 270
    assert language.train(docs, F.lit(True), rows=200).langs == ["de", "en", "fr"]
    # Copies change neither the size of the sample nor the model, below the bound as above it.
    copies = docs.union(docs.where("text LIKE '% number 7 %'").crossJoin(spark.range(3_000)).drop("id"))
    for rows in (200, 100_000):
        once, more = (language.train(x, F.lit(True), rows=rows) for x in (docs, copies))
        assert once.langs == more.langs and (once.weights == more.weights).all() and (once.bit_weights == more.bit_weights).all()


def test_codewords_are_distinct():
    for count in range(2, 40):
        code = language.codewords(count)
        assert len({tuple(row) for row in code}) == count and (abs(code.sum(axis=0)) < count).all()


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op7_toxicity"](spark, sf_dir).where("held_out").collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    pairs = [(truth[r.doc_id], r.predicted) for r in rows if r.doc_id in truth]
    bad, good = [p for t, p in pairs if t == 1], [p for t, p in pairs if t == 0]
    assert sum(bad) / len(bad) > 0.9 and sum(good) / len(good) < 0.03


def test_toxicity_recall_at_the_threshold_of_the_pipeline(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op7_toxicity"](spark, sf_dir).where("held_out").collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    hits = [(truth[r.doc_id], r.score >= stages.TOXIC) for r in rows if r.doc_id in truth]
    bad, good = [p for t, p in hits if t == 1], [p for t, p in hits if t == 0]
    assert sum(bad) / len(bad) > 0.9 and sum(good) / len(good) < 0.01


def test_toxic_spans(spark, odd_docs, no_docs):
    rows = [(i, f"some words {i} then you awful zork and more words {i % 5}", 1) for i in range(60)]
    rows += [(100 + i, f"some words {i} then you kind friend and more words {i % 5}", 0) for i in range(120)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(labelled.select("doc_id", "text"), labelled.drop("text"))
    docs = odd_docs.unionByName(labelled.select("doc_id", "text"), allowMissingColumns=True)
    found = toxicity.score(docs, model, keep=("doc_id", "text", "part")).collect()
    assert len(found) == docs.count() and all(0 <= r.toxicity <= 1 for r in found)
    empty = {r.toxicity for r in found if not (r.text or "").strip()}
    assert len(empty) == 1 and empty.pop() < 0.3
    for r in found:
        if r.doc_id is not None and r.text and "zork" in r.text:
            assert r.toxicity > 0.5
            assert any("zork" in r.text[s.start : s.stop] for s in r.spans)
        elif r.text and "friend" in r.text:
            assert r.toxicity < 0.3 and not r.spans
    nothing = toxicity.train(labelled.select("doc_id", "text"), labelled.where("toxic = 7"))
    assert {r.toxicity for r in toxicity.score(odd_docs, nothing).collect()} == {0.0}
    assert toxicity.score(no_docs, model).collect() == []


def test_forward_backward_equals_all_paths():
    import numpy as np

    rng = np.random.default_rng(0)
    emit, move = rng.normal(size=(1, 6)), rng.normal(size=(2, 2))
    weight = {}
    for path in itertools.product((0, 1), repeat=6):
        weight[path] = np.exp(sum(emit[0, i] for i in range(6) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:])))
    odds, _ = toxicity.forward_backward(emit, move)
    for i in range(6):
        bad = sum(w for path, w in weight.items() if path[i])
        assert odds[0, i] == pytest.approx(np.log(bad / (sum(weight.values()) - bad)))
