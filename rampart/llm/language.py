"""Language identification with error-correcting output codes.

Every learned language has a codeword of bits; a binary classifier over hashed byte
n-grams predicts each bit, and the language whose codeword has the least weighted loss
under the predictions wins.  With up to five languages the code is exhaustive (all splits
of the languages in two), with more it is a fixed dense code of about 10 log2(k) bits.

A bit's classifier is a multinomial model: per n-gram the log ratio of its mean frequency
among the languages with the bit to that among the others.  Bits weigh by how often they
were right on the training rows.  Training rows are the distinct texts of each language,
or from about ``TRAIN_ROWS`` on a sample of that size: drawn by a hash of the text at a share
per language, at least one text of each; everything else covers all rows.

Rows: every input row is judged, also with a NULL or repeated id.  ``und`` with score 0 is
the answer for a text that is NULL or has no letter, and for all texts if there was
nothing to learn from.  ``ambiguous`` marks texts whose two best languages are nearly as
likely.  Columns of the input other than the named ones are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import few_rows, lean, slices, staged

TRAIN_ROWS = 20_000
HASH_BITS = 16
ORDERS = (2, 3, 4)
SMOOTHING = 0.5
# Weights are kept as integers, so that sums do not depend on their order.
SCALE = 256
# The evidence for a bit is at most this many nats, whatever the length of the text.
MOST_EVIDENCE = 30.0
AMBIGUOUS_BELOW = 0.7
UNKNOWN = "und"
_SLICE = 500_000


def codewords(count: int) -> np.ndarray:
    """One row of +-1 per language."""
    if count <= 1:
        return np.ones((count, 1), np.int8)
    if count <= 5:
        splits = [bits for bits in product((1, -1), repeat=count) if bits[0] == 1 and -1 in bits]
        return np.array(splits, np.int8).T
    width = int(np.ceil(10 * np.log2(count)))
    rng = np.random.default_rng(1)
    code = np.where(rng.random((count, width)) < 0.5, 1, -1).astype(np.int8)
    constant = np.abs(code.sum(axis=0)) == count
    code[0, constant] *= -1
    return code


def _grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed n-grams that start at each byte, per order, and where each text begins.

    A text is in lower case between spaces; the n-grams at its end reach into zero bytes
    that follow every text.
    """
    tail = b"\0" * max(ORDERS)
    coded = [b" " + text.lower().encode("utf-8", "replace") + b" " + tail for text in texts]
    data = np.frombuffer(b"".join(coded) + tail, np.uint8).astype(np.uint32)
    starts = np.append(0, np.cumsum([len(x) for x in coded]))[:-1]
    n = sum(map(len, coded))
    hashes, gram = [], data[:n].copy()
    for order in range(2, max(ORDERS) + 1):
        gram *= np.uint32(0x01000193)
        gram ^= data[order - 1 : order - 1 + n]
        if order in ORDERS:
            mixed = (gram + np.uint32(order)) * np.uint32(2654435761)
            hashes.append(mixed >> np.uint32(32 - HASH_BITS))
    return hashes, starts


def _sums(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Evidence per text (rows) and bit (columns), in nats."""
    hashes, starts = _grams(texts)
    out = np.zeros((len(texts), len(weights)))
    for bit, own in enumerate(weights):
        total = own[hashes[0]]
        for more in hashes[1:]:
            total = total + own[more]
        out[:, bit] = np.add.reduceat(total, starts, dtype=np.int64) / SCALE
    return out


def _loss(evidence: np.ndarray, code: np.ndarray, bit_weights: np.ndarray) -> np.ndarray:
    """Weighted logistic loss per text and language."""
    clipped = np.clip(evidence, -MOST_EVIDENCE, MOST_EVIDENCE)
    agree = np.logaddexp(0, -clipped) @ (bit_weights[:, None] * (code.T == 1))
    return agree + np.logaddexp(0, clipped) @ (bit_weights[:, None] * (code.T == -1))


def _profiles(sample: DataFrame) -> DataFrame:
    """Rows (lang, bucket, n) over the n-grams of the sample, summed per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, texts in slices(batch, "text", _SLICE):
                own = langs[first : first + len(texts)]
                for lang in set(own):
                    hashes, _ = _grams([t for t, x in zip(texts, own) if x == lang])
                    counts = totals.setdefault(lang, np.zeros(1 << HASH_BITS, np.int64))
                    for grams in hashes:
                        counts += np.bincount(grams, minlength=1 << HASH_BITS)
        for lang, counts in totals.items():
            used = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    found = sample.mapInArrow(count, "lang string, bucket int, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Languages, their codewords, the classifiers' weights and the bits' weights."""

    def __init__(self, langs: list[str], weights: np.ndarray, bit_weights: np.ndarray) -> None:
        self.langs, self.code = langs, codewords(len(langs))
        self.weights, self.bit_weights = weights, bit_weights

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is ambiguous, per text."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        loss = _loss(_sums(texts, self.weights), self.code, self.bit_weights)
        likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
        score = 1 / likely.sum(axis=1)
        best = loss.argmin(axis=1)
        return [self.langs[i] for i in best], score, score < AMBIGUOUS_BELOW


def _level(counts: list[int], rows: int) -> float:
    """The greatest number that, as a bound of each count, keeps their sum within ``rows``."""
    left = rows
    for place, count in enumerate(sorted(counts)):
        share = left / (len(counts) - place)
        if count > share:
            return share
        left -= count
    return float("inf")


def _sample(known: DataFrame, rows: int) -> DataFrame:
    """Distinct (lang, text), about ``rows`` of them: all of the languages with few, and of
    the others as many as are left for each."""
    draw = F.shiftrightunsigned(F.xxhash64("text", F.lit(3)), 1)
    hashed = known.select("lang", draw.alias("draw")).groupBy("lang", "draw").count()
    found = hashed.groupBy("lang").agg(F.count("*"), F.min("draw")).collect()
    level, full = _level([r[1] for r in found], rows), (1 << 63) - 1
    # The text with the least hash is drawn at any share, so that no language is lost.
    limits = [(r[0], full if r[1] <= level else max(r[2], int(full * (level / r[1])))) for r in found]
    shares = few_rows(known.sparkSession, limits, pa.schema([("lang", pa.string()), ("most", pa.int64())]))
    drawn = known.join(F.broadcast(shares), "lang").where(draw <= F.col("most"))
    return staged(drawn.select("lang", "text").dropDuplicates(), "language-sample")


def train(docs: DataFrame, usable: Column, *, rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fit on about ``rows`` distinct texts of the rows where ``usable`` holds and text and
    lang are not NULL.  What reaches the driver is one table of counts: languages times 2^16
    at most."""
    known = docs.where(usable & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    known = _sample(known, rows)
    counts = _profiles(known).toPandas()
    langs = sorted(counts["lang"].unique(), key=lambda x: x.encode())
    if not langs:
        return LanguageModel([], np.zeros((0, 1 << HASH_BITS), np.int32), np.zeros(0))
    profile = np.full((len(langs), 1 << HASH_BITS), SMOOTHING)
    np.add.at(profile, (counts["lang"].map(langs.index).to_numpy(), counts["bucket"].to_numpy()), counts["n"].to_numpy())
    profile /= profile.sum(axis=1, keepdims=True)
    code = codewords(len(langs))
    weights = np.zeros((code.shape[1], 1 << HASH_BITS), np.int32)
    if len(langs) > 1:
        for bit, column in enumerate(code.T):
            ratio = np.log(profile[column == 1].mean(axis=0)) - np.log(profile[column == -1].mean(axis=0))
            weights[bit] = np.rint(ratio * SCALE)
    return LanguageModel(langs, weights, _bit_weights(known, langs, code, weights))


def _bit_weights(sample: DataFrame, langs: list[str], code: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The share of sample rows that each bit gets right, as weights that sum to 1."""
    model = sample.sparkSession.sparkContext.broadcast((langs, code, weights))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, code, weights = model.value
        right, rows = np.zeros(code.shape[1], np.int64), 0
        for batch in batches:
            own = batch.column("lang").to_pylist()
            for first, texts in slices(batch, "text", _SLICE):
                truth = code[[langs.index(x) for x in own[first : first + len(texts)]]]
                right += (np.sign(_sums(texts, weights)) == truth).sum(axis=0)
                rows += len(texts)
        columns = [pa.array(np.arange(len(right), dtype=np.int32)), pa.array(right), pa.array(np.full(len(right), rows))]
        yield pa.RecordBatch.from_arrays(columns, names=["bit", "hits", "seen"])

    found = sample.mapInArrow(judge, "bit int, hits long, seen long").groupBy("bit").agg(F.sum("hits"), F.sum("seen"))
    share = np.zeros(code.shape[1])
    for bit, hits, seen in found.collect():
        share[bit] = (hits + 1) / (seen + 2)
    return share / share.sum() * len(share)


def detect(docs: DataFrame, model: LanguageModel, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with lang_pred, lang_score and ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A name that no kept column has.
    flag = "_letters_" + "_".join(keep)
    rows = docs.select(*dict.fromkeys([*keep, "text"]), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(flag))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column(flag).to_pylist()
            for first, texts in slices(batch, "text", _SLICE):
                part = batch.slice(first, len(texts))
                langs, scores, unsure = shared.value.predict(texts)
                has = np.array(letters[first : first + len(texts)], bool)
                columns = [
                    *(part.column(c) for c in keep),
                    pa.array([x if ok else UNKNOWN for x, ok in zip(langs, has)], pa.string()),
                    pa.array(np.where(has, scores, 0.0)),
                    pa.array(unsure | ~has),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "lang_score", "ambiguous"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(lean(predict), f"{schema}, lang_pred string, lang_score double, ambiguous boolean")
