"""Whitening, decontamination and sharded k-means against plain versions."""

import hashlib
import math
import re

import numpy as np
import pytest

from rampart.llm import lloyd, whitening, winnowing

VECTORS = "vec_id long, embedding array<float>, label int"


# ------------------------------------------------------------------------- whitening
def odd_vectors(spark, width=5, count=300):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(width, width))
    good = (rng.normal(size=(count, width)) @ mix).astype(np.float32)
    rows = [(i, [float(c) for c in v], i % 3) for i, v in enumerate(good)]
    rows += rows[:7]  # repeated rows
    rows += [(3, rows[9][1], 1), (None, rows[10][1], None), (None, rows[11][1], 2)]
    rows += [
        (900, None, 1),
        (901, [float("nan")] * width, 1),
        (902, [float("inf")] + [0.0] * (width - 1), 1),
        (903, [None] + [0.5] * (width - 1), 1),
        (904, [], 1),
    ]
    return spark.createDataFrame(rows, VECTORS)


def plain_whitening(rows, scale=64, offset=1_000_000):
    x = [[math.floor(scale * c) + offset for c in v] for _, v in rows]
    fit = np.array(sorted(set(map(tuple, x))), np.int64)
    n, sums = len(fit), [sum(int(c) for c in col) for col in fit.T]
    centred = fit - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    out = []
    for (vec_id, _), own in zip(rows, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(own, sums))
        y = (np.array(own) - np.array(sums) / n) @ vectors / np.sqrt(values)
        out.append((vec_id, n, deviation, y, values / values.sum()))
    return out


def test_whitening_equals_dense_eigenvectors(spark):
    table = odd_vectors(spark).withColumnRenamed("label", "component")
    good = [(r.vec_id, r.embedding) for r in table.collect() if r.embedding and None not in r.embedding and all(map(math.isfinite, r.embedding))]
    found = {}
    for r in whitening.whiten(table, scale=64, offset=1_000_000).collect():
        found.setdefault((r.vec_id, int(r.deviation)), []).append(r)
        assert r.identity_error < 1e-12
    wanted = plain_whitening(good)
    assert sum(map(len, found.values())) == 5 * len(good)
    signs = None
    for vec_id, n, deviation, y, explained in wanted:
        rows = found[(vec_id, deviation)]
        mine = {r.component: r for r in rows}
        assert {r.n for r in rows} == {n} and sorted(mine) == [1, 2, 3, 4, 5]
        own = np.array([mine[k].whitened for k in sorted(mine)])
        if signs is None:
            signs = np.sign(own * y)
        assert np.allclose(own * signs, y, rtol=1e-9, atol=1e-9)
        assert np.allclose([mine[k].explained for k in sorted(mine)], explained, rtol=1e-9)


def test_whitening_of_empty_equal_flat_and_mixed_vectors(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, VECTORS), scale=64, offset=1_000_000).collect()

    assert run([]) == []
    assert run([(1, None, 1)]) == []
    one = run([(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1)])
    assert len(one) == 4
    assert {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, 0.0)}
    # One direction without variance; vectors of another width have a fit of their own.
    flat = run([(i, [float(i), 1.0], 1) for i in range(6)] + [(9, [1.0], 1), (10, [3.0], 1)])
    by = {(r.vec_id, r.component): r for r in flat}
    assert len(flat) == 14 and by[(0, 1)].n == 6 and by[(9, 1)].n == 2
    assert by[(3, 2)].whitened is None and by[(3, 2)].explained == 0.0 and by[(3, 1)].explained == 1.0
    assert abs(by[(9, 1)].whitened) == pytest.approx(1.0)
    # Far apart magnitudes stay exact.
    far = run([(1, [1e9, 0.0], 1), (2, [-1e9, 1.0], 1), (3, [0.0, 0.0], 1)])
    x = [[math.floor(64 * np.float32(c)) + 1_000_000 for c in v] for v in ([1e9, 0.0], [-1e9, 1.0], [0.0, 0.0])]
    sums = [sum(c) for c in zip(*x)]
    assert {r.vec_id: int(r.deviation) for r in far} == {
        i + 1: sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)
    }


@pytest.mark.parametrize("kind", ["spread", "equal", "near", "nested"])
def test_eigenvectors_of_clustered_eigenvalues(kind):
    rng = np.random.default_rng(1)
    size = 40
    q = whitening._orthonormal(np.linalg.qr(rng.normal(size=(size, size)))[0].astype(whitening.WIDE))
    values = np.linspace(1, 50, size)
    if kind == "equal":
        values[10:20] = 7.0
    if kind == "near":
        values[10:20] = 7.0 + 1e-9 * np.arange(10)
    if kind == "nested":
        values[10:15] = 7.0 + 1e-6 * np.arange(5)
        values[15:20] = 7.001 + 1e-12 * np.arange(5)
    a = (q * values.astype(whitening.WIDE)) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(size)).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-15 * 50
    assert np.allclose(found.astype(float), np.sort(values)[::-1], rtol=1e-15)
    if kind in ("spread", "near"):
        wanted = q[:, np.argsort(-values)]
        close = np.abs((wanted * x).sum(axis=0))
        assert (np.abs(close - 1) < (1e-15 if kind == "spread" else 1e-12)).all()


# -------------------------------------------------------------------- decontamination
def plain_words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def plain_hits(text, items):
    words, hit, ids = plain_words(text), set(), set()
    for item_id, item in items:
        own = plain_words(item)
        size = min(10, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                ids.add(item_id)
    return len(words), len(hit), sorted(str(i) for i in ids if i is not None)


def stretches(spans):
    return sum(b - a for a, b in spans)


def check_hits(spark, docs, items, frame=None):
    frame = frame if frame is not None else spark.createDataFrame(docs, "doc_id long, text string")
    found = winnowing.contamination(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r.item_ids)) for r in found.collect())
    wanted = []
    for doc_id, text in docs:
        words, hit, ids = plain_hits(text, items)
        wanted.append((str(doc_id), words, hit, ids))
    assert got == sorted(wanted)
    for r in found.collect():
        assert stretches(r.spans) == r.n_hit
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_hits_equal_brute_force(spark, prose):
    document, near = prose
    items = [(i, " ".join(document(n))) for i, n in enumerate([40, 25, 11, 10, 9, 5, 4, 2, 1, 30])]
    items += [(3, " ".join(document(14))), (None, " ".join(document(20))), (77, None), (78, " ...! "), (79, items[0][1])]
    docs = []
    for i in range(60):
        text = document(80)
        whole = (items[i % len(items)][1] or "").split()
        cut = whole[i % 3 : len(whole) - i % 4]
        text[20:20] = cut
        text[70:70] = near(cut, 1) if cut else []
        docs.append((i, ", ".join(text) if i % 2 else " ".join(text).upper()))
    docs += [docs[0], (0, docs[1][1]), (None, docs[2][1]), (None, docs[2][1]), (200, None), (201, ""), (202, " \n "), (203, "é Ñ ñ")]
    check_hits(spark, docs, items)


def test_repeated_words_and_long_texts(spark):
    items = [(1, "a " * 30), (2, "a b " * 12), (3, "x y z"), (4, "Ñandú " * 3)]
    docs = [(1, "a " * 5_000), (2, "b a " * 2_000), (3, "a " * 9 + "b"), (4, "x y z x y z q x y"), (5, "ñandú " * 3), (6, "ÑandÚ Ñandú Ñandú Ñandú")]
    check_hits(spark, docs, items)


def test_hits_of_odd_documents(spark, odd_docs, no_docs):
    items = [(1, "other words under the same id"), (2, "word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11"), (2, "it's")]
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_hits(spark, docs, items, odd_docs)
    table = spark.createDataFrame(items, "item_id long, text string")
    assert winnowing.contamination(no_docs, table).collect() == []
    none = winnowing.contamination(odd_docs, table.where("item_id = 9")).collect()
    assert len(none) == len(docs) and {(r.n_hit, len(r.spans), len(r.item_ids)) for r in none} == {(0, 0, 0)}


def test_shuffled_item_tables_give_the_same(spark, prose, monkeypatch):
    document, _ = prose
    items = [(i, " ".join(document(20))) for i in range(12)]
    docs = [(i, " ".join(document(10)) + " " + items[i % 12][1] + " tail") for i in range(40)]
    monkeypatch.setattr(winnowing, "BROADCAST_BYTES", 0)
    check_hits(spark, docs, items)


# ----------------------------------------------------------------------------- k-means
def plain_lloyd(rows, clusters, rounds, scale=1024):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centers))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for k, own in members.items():
            centers[k] = [sum(col) // len(own) for col in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {k: sum(d for _, d, c in found if c == k) for k in range(clusters)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted((str(i), c, d, inertia[c], sum(inertia.values()), digest[c]) for i, d, c in found)


@pytest.mark.parametrize("broadcast", [True, False])
def test_clusters_equal_plain_lloyd(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(lloyd, "BROADCAST_BYTES", 0)
    table = odd_vectors(spark, width=20, count=150).withColumnRenamed("label", "chunk")
    good = [
        (r.vec_id, r.embedding)
        for r in table.collect()
        if r.embedding is not None and len(r.embedding) == 20 and None not in r.embedding and all(map(math.isfinite, r.embedding))
    ]
    found = lloyd.cluster_vectors(table, width=20, scale=1024, clusters=6, rounds=4, chunk_rows=32)
    got = sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found.collect())
    assert got == plain_lloyd(good, 6, 4)


def test_few_equal_and_no_vectors(spark):
    def run(rows, width=3):
        table = spark.createDataFrame(rows, VECTORS)
        return lloyd.cluster_vectors(table, width=width, scale=1024, clusters=4, rounds=2).collect()

    assert run([]) == [] and run([(1, [1.0], 1), (2, None, 1)]) == []
    few = run([(1, [1.0, 2.0, 3.0], 1), (1, [1.0, 2.0, 3.0], 1), (None, [0.0, 0.5, -0.001], None)])
    assert sorted((str(r.vec_id), r.distance) for r in few) == [("1", 0), ("1", 0), ("None", 0)]
    # The same vector twice among the first centroids: the smaller number wins.
    assert len({r.cluster for r in few}) == 2 and min(r.cluster for r in few) == 0
    with pytest.raises(Exception, match="or more"):
        run([(1, [1e30, 0.0, 0.0], 1)])


def test_partial_distances_are_exact_at_any_size():
    rng = np.random.default_rng(2)
    for top in (100, 1 << 25):
        x, c = rng.integers(-top, top, (9, 16)), rng.integers(-top, top, (4, 16))
        wanted = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]
        assert lloyd.partial_distances(x.astype(np.int32), c).tolist() == wanted


def test_a_round_moves_no_vectors(spark, monkeypatch):
    """Slices are read in their buckets: only labels and partial distances are shuffled."""
    plans = []
    real = lloyd._moved

    def seen(*args):
        frame = real(*args)
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return frame

    monkeypatch.setattr(lloyd, "_moved", seen)
    lloyd.cluster_vectors(odd_vectors(spark, width=20), width=20, scale=1024, clusters=3, rounds=1).count()
    moved = [line for line in plans[0].splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) >= 3 and not any("data" in line for line in moved)
    below = plans[0][plans[0].index("Scan parquet") - 200 :]
    assert "Bucketed: true" in below


# ------------------------------------------------ near-duplicates of odd ids and vectors
def test_extreme_vectors_do_not_disturb_others(spark):
    from rampart.llm import pq

    rows = [
        (1, [1.0, 1.0], 1), (2, [3.0, 3.0], 1), (3, [1e-200, 1e-200], 1), (4, [1e200, 1e200], 1), (5, [1.0, -1.0], 1),
        (6, [1e-300, 1e300], 1), (7, [0.0, 5.0], 1), (8, [5e-324, 5e-324], 1), (9, [1e200, -1e200], 1), (10, [0.0, 0.0], 1),
    ]
    found = pq.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert {got[i] for i in (1, 2, 3, 4, 8)} == {(4, 1)}
    assert got[5] == got[9] == (1, 5) and got[6] == got[7] == (1, 6) and got[10] == (0, 10)


def test_probes_leave_out_no_partner():
    from rampart.llm import pq

    rng = np.random.default_rng(3)
    unit = pq._units(rng.normal(size=(900, 6)))
    model = pq.Quantiser(unit[:400], 40)
    own, _, _ = model.encode(unit)
    probes = model.probes(unit, own, 0.4)
    assert len(probes) == len(unit)
    for i, lists in enumerate(probes):
        near = np.flatnonzero(((unit - unit[i]) ** 2).sum(axis=1) <= 0.16)
        assert set(own[near]) <= set(lists.tolist())
    assert np.mean([len(x) for x in probes]) < 20


def test_many_near_copies_under_one_id(spark, prose):
    import time

    from rampart.llm import minhash

    document, near = prose
    base = document(120)
    texts = [" ".join(near(base, 1)) for _ in range(500)]
    took = []
    for own in (True, False):
        rows = [(i if own else None, text) for i, text in enumerate(texts)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        start = time.time()
        found = minhash.near_duplicates(docs, words=3, percent=85).collect()
        took.append(time.time() - start)
        assert len(found) == 500 and len({r.group for r in found}) == 1
        assert {r.component_id for r in found} == ({0} if own else {None})
    assert took[1] < 2 * took[0] + 5


def test_equal_node_numbers_of_different_sets(spark):
    from rampart.llm import minhash

    rows = [(1, 10, 5, 3), (2, 10, 5, 3), (3, 10, 7, 4), (4, 11, 5, 3)]
    signed = spark.createDataFrame(rows, "doc_id long, node long, other long, n_shingles long")
    got = {r.doc_id: r.of_set for r in minhash._told_apart(signed).collect()}
    assert got[1] == got[2] == 10 and got[4] == 11 and got[3] not in (10, 11)
    assert all(r.of_set == r.node for r in minhash._told_apart(signed.where("doc_id <> 3")).collect())


# ------------------------------------------------------------ one chain over a whole text
def plain_marginals(emit, move):
    """Forward and backward over all tokens in one go, in logs."""
    n = len(emit)
    score = np.stack([np.zeros(n), np.clip(emit, -20, 20)], 1)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = score[0]
    for i in range(1, n):
        ahead[i] = np.logaddexp(ahead[i - 1][0] + move[0], ahead[i - 1][1] + move[1]) + score[i]
    for i in range(n - 2, -1, -1):
        behind[i] = np.logaddexp(move[:, 0] + score[i + 1, 0] + behind[i + 1, 0], move[:, 1] + score[i + 1, 1] + behind[i + 1, 1])
    both = ahead + behind
    return both[:, 1] - both[:, 0], ahead[:, 1] - ahead[:, 0]


def test_messages_run_over_whole_texts():
    from rampart.llm import toxicity

    rng = np.random.default_rng(6)
    counts = np.array([1, 63, 64, 65, 0, 128, 700, 2, 129, 0])
    emit = rng.normal(scale=6, size=counts.sum())
    for move in (rng.normal(scale=2, size=(2, 2)), np.array([[3.0, -4.0], [-4.0, 3.0]])):
        marginal, forward = toxicity.messages(emit, counts, move)
        stop = 0
        for count in counts:
            own = slice(stop, stop + count)
            stop += count
            if count:
                wanted, ahead = plain_marginals(emit[own], move)
                assert np.allclose(marginal[own], wanted, atol=1e-9) and np.allclose(forward[own], ahead, atol=1e-9)


def test_marginals_equal_all_paths_over_a_block_edge(monkeypatch):
    from itertools import product

    from rampart.llm import toxicity

    monkeypatch.setattr(toxicity, "CHAIN", 4)
    rng = np.random.default_rng(7)
    emit, move = rng.normal(size=10), rng.normal(size=(2, 2))
    odds = np.zeros((10, 2))
    for path in product((0, 1), repeat=10):
        weight = np.exp(sum(emit[i] for i in range(10) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:])))
        for i, label in enumerate(path):
            odds[i, label] += weight
    found, _ = toxicity.messages(np.concatenate([emit, emit[:3]]), np.array([10, 3]), move)
    assert np.allclose(found[:10], np.log(odds[:, 1] / odds[:, 0]))


def test_a_word_in_front_moves_no_other_word(spark):
    """Far from the front, marginals do not depend on where a block ends."""
    from rampart.llm import toxicity

    rng = np.random.default_rng(8)
    emit, move = rng.normal(scale=2, size=400), np.array([[1.0, -1.0], [-1.0, 1.0]])
    plain, _ = toxicity.messages(emit, np.array([400]), move)
    shifted, _ = toxicity.messages(np.concatenate([[0.3], emit]), np.array([401]), move)
    assert np.abs(plain[50:] - shifted[51:]).max() < 1e-9
