"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are runs of anything but ASCII characters other than digits and letters, A-Z in lower
case.  A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer words
is one window of its own length.  A document word is hit if it lies in an occurrence of a
window.

1. Every window is stood for by its fingerprint: the least hash of the ``GRAM``-word grams
   in it.  Neighbouring windows mostly share it, so a document keeps one row per run of
   windows with one fingerprint, about 2 per 7 words.  Equal windows have equal
   fingerprints, so every shared span of ``WINDOW`` words is found.
2. Documents' runs are joined with the items' fingerprints: few are left.
3. Those are extended: each window of a run is compared, as text, with the items' windows.
   A run carries its words, so texts are neither read again nor shuffled.

Windows that lie in the same items share a class, and documents are joined with classes,
not with each window's items.  Tables of the items are broadcast if their size allows it
(``BROADCAST_BYTES``); otherwise joins are shuffled with salted keys.

Rows: every input row gets a row, also with a NULL or repeated id; rows that are equal in id
and text get equal results.  NULL, empty and wordless texts have no words and no hits.
Items without words have no windows, items of one id count once, and an item with a NULL
id marks words but is neither counted nor named.  Other columns are not used.  Without
items nothing is hit; without documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import staged
from rampart.llm.urls import UPPER

WINDOW = 10
GRAM = 5
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 32 << 20
SALTS = 16


def words_of(text: Column) -> Column:
    folded = F.translate(text, UPPER, UPPER.lower())
    return F.coalesce(F.regexp_extract_all(folded, F.lit(ITEM_WORD), F.lit(0)), F.array().cast("array<string>"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _runs(words: Column, hashes: Column, length: int) -> Column:
    """Runs of windows of ``length`` words with one fingerprint: structs of length,
    fingerprint, place of the first window, and the words of all windows of the run."""
    gram = min(GRAM, length)
    wide = length - gram + 1

    def joined(h: Column) -> Column:
        return F.transform(
            F.slice(h, F.lit(1), F.size(h) - F.lit(gram - 1)),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + F.lit(j)) for j in range(1, gram))),
        )

    def least(g: Column) -> Column:
        if wide == 1:
            return g
        return F.transform(
            F.slice(g, F.lit(1), F.size(g) - F.lit(wide - 1)),
            lambda x, i: F.least(x, *(F.get(g, i + F.lit(j)) for j in range(1, wide))),
        )

    def cut(m: Column) -> Column:
        firsts = F.filter(
            F.sequence(F.lit(0), F.size(m) - F.lit(1)), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - F.lit(1)))
        )
        return _let(
            firsts,
            lambda s: F.transform(
                s,
                lambda a, j: F.struct(
                    F.lit(length).alias("length"),
                    F.xxhash64(F.get(m, a), F.lit(length)).alias("print"),
                    a.alias("place"),
                    F.slice(words, a + 1, F.coalesce(F.get(s, j + 1), F.size(m)) - a + F.lit(length - 1)).alias("words"),
                ),
            ),
        )

    none = F.array().cast("array<struct<length:int,print:bigint,place:int,words:array<string>>>")
    return F.when(F.size(hashes) >= length, _let(_let(joined(hashes), least), cut)).otherwise(none)


def _windows(items: DataFrame) -> DataFrame:
    """length, window (its words with spaces between) and item_id, each once."""
    rows = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(WINDOW))
    place = F.explode(F.sequence(F.lit(1), F.size("words") - length + 1))
    rows = rows.select("item_id", length.alias("length"), "words", place.alias("place"))
    window = F.concat_ws(" ", F.slice("words", F.col("place"), F.col("length"))).alias("window")
    return rows.select("length", window, F.col("item_id").cast("string").alias("item_id")).distinct()


def _found(rows: DataFrame, table: DataFrame, key: str, how: str, spread: list[str]) -> DataFrame:
    """``rows`` joined with ``table`` on ``key``: broadcast if the table's measured size
    allows it, otherwise rows of one key go to ``SALTS`` tasks by their ``spread``."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(64))
    size = table.agg(F.sum(width.cast("long"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), key, how)
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)))
    return salted.join(table.withColumn("_salt", F.explode(salts)), [key, "_salt"], how).drop("_salt")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, spans (start and stop in
    words, stop exclusive, of the hit stretches; empty if none) and item_ids (ids of the
    items with occurring windows, as sorted texts)."""
    windows = staged(_windows(items.select("item_id", "text")), "item-windows")
    # At most WINDOW values.
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())

    def marks(words: Column) -> Column:
        head = F.struct(
            F.lit(0).alias("length"),
            F.xxhash64("doc_id", "text").alias("print"),
            F.size(words).alias("place"),
            F.array().cast("array<string>").alias("words"),
        )
        if not lengths:
            return F.array(head)
        return F.concat(F.array(head), _let(_hashed(words), lambda h: F.concat(*(_runs(words, h, n) for n in lengths))))

    key = ["doc_id", "text_a", "text_b"]
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_a"),
        F.xxhash64(F.lit(1), "text").alias("text_b"),
        F.explode(_let(words_of(F.col("text")), marks)).alias("run"),
    ).select(*key, "run.*")
    split = windows.select("length", "window").distinct().select("length", F.split("window", " ").alias("words"))
    prints = None
    for n in lengths:
        run = _let(_hashed(F.col("words")), lambda h: _runs(F.col("words"), h, n))[0]
        own = split.where(F.col("length") == n).select(run["print"].alias("print"))
        prints = own if prints is None else prints.union(own)
    if prints is not None:
        known = staged(prints.distinct().withColumn("known", F.lit(True)), "item-prints")
        rows = _found(rows, known, "print", "left", key).where("length = 0 OR known")
    rows = staged(rows.select(*key, "length", "place", "words"), "runs")
    heads = rows.where("length = 0").select(*key, F.col("place").cast("long").alias("n_words"))
    nowhere = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    no_items = F.array().cast("array<string>")
    if prints is None:
        return heads.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), nowhere.alias("spans"), no_items.alias("item_ids"))

    classed = windows.groupBy("window").agg(
        F.md5(F.concat_ws("/", F.count("*"), *(F.sum(F.xxhash64(F.lit(k), "item_id").cast("decimal(38,0)")) for k in (1, 2)))).alias("class")
    )
    classed = staged(classed, "window-classes")
    first = classed.groupBy("class").agg(F.min("window").alias("window"))
    of_class = staged(first.join(windows, "window").where("item_id IS NOT NULL").select("class", "item_id"), "class-items")

    each = F.transform(
        F.sequence(F.lit(0), F.size("words") - F.col("length")),
        lambda j: F.struct((F.col("place") + j).alias("start"), F.concat_ws(" ", F.slice("words", j + 1, F.col("length"))).alias("window")),
    )
    tried = rows.where("length > 0").select(*key, "length", F.explode(each).alias("at")).select(*key, "length", "at.*")
    hits = staged(_found(tried, classed, "window", "inner", [*key, "start"]).select(*key, "start", "length", "class"), "hits")
    places = hits.groupBy(*key).agg(
        F.array_sort(F.collect_set(F.struct(F.col("start").cast("long").alias("start"), (F.col("start") + F.col("length")).cast("long").alias("stop")))).alias("at")
    )
    places = places.select(*key, _united(F.col("at"), len(lengths)).alias("spans"))
    pairs = _found(hits.select(*key, "class").distinct(), of_class, "class", "inner", key).select(*key, "item_id")
    named = pairs.groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    found = staged(places.join(named, _same(places, named, key), "left").select(*(places[c] for c in key), "spans", "item_ids"), "contaminated")
    out = heads.join(found, _same(heads, found, key), "left")
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select(
        heads["doc_id"],
        "n_words",
        F.coalesce(total, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", nowhere).alias("spans"),
        F.coalesce("item_ids", no_items).alias("item_ids"),
    )


def _same(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    """Whether rows of two frames are of one document; only the id can be NULL."""
    first, second, third = key
    same_id = left[first].eqNullSafe(right[first])
    return same_id & (left[second] == right[second]) & (left[third] == right[third])


def _united(spans: Column, kinds: int) -> Column:
    """Sorted spans of at most ``WINDOW`` words, at most ``kinds`` of one start, with those
    that touch or overlap made one.

    No span reaches further than ``WINDOW`` words, so whether an earlier one reaches a span,
    and where a stretch stops, is told by the last ``WINDOW * kinds`` spans before.
    """
    near = WINDOW * kinds

    def before(all_: Column, i: Column) -> Column:
        low = F.greatest(i - F.lit(near), F.lit(0))
        return F.slice(all_, low + 1, i - low)

    def stretches(all_: Column) -> Column:
        firsts = F.filter(
            F.sequence(F.lit(0), F.size(all_) - 1),
            lambda i: ~F.exists(before(all_, i), lambda s: s["stop"] >= F.get(all_, i)["start"]),
        )
        return _let(
            firsts,
            lambda f: F.transform(
                f,
                lambda i, k: F.struct(
                    F.get(all_, i)["start"].alias("start"),
                    F.array_max(F.transform(before(all_, F.coalesce(F.get(f, k + 1), F.size(all_))), lambda s: s["stop"])).alias("stop"),
                ),
            ),
        )

    return _let(spans, stretches)
