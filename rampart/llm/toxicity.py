"""Toxic spans with a linear-chain conditional random field.

Tokens are words (runs of anything but ASCII white space).  A token's features are hashes
of the word in lower case without outer punctuation, and of its first 4, 5 and 6 letters.
Two labels, clean and toxic; one chain runs over all tokens of a text.  Messages are
computed for blocks of ``CHAIN`` tokens side by side: what a block makes of a message is a
matrix of 2 x 2, so a message is handed on from block to block before the blocks' own
tokens are gone through.

Training takes a bounded sample of labelled documents: about ``TRAIN_ROWS`` toxic ones and
twice as many clean ones, drawn by a hash of the id, equal texts once.  Documents carry the
labels, so tokens are labelled first: a token of a toxic document is toxic if one of its
features is far more frequent in toxic documents than in clean ones.  The weights then
maximise the conditional likelihood of the token labels, by gradients from
forward-backward.  A document's score is a logistic function of its greatest marginal
log-odds, the expected number of toxic tokens and its length, fitted on the sample with
each label at its weight among all labelled documents.

Rows: every input row is scored, also with a NULL or repeated id.  A NULL or empty text
has no tokens and the lowest score.  Without toxic labels all scores are 0.  Columns of
the input other than the named ones are not used.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import WORD, give_back, lean, slices

TRAIN_ROWS = 1_500
FEATURE_BITS = 18
PREFIXES = (4, 5, 6)
CHAIN = 64
STEPS = 40
# A feature makes a token toxic from so many toxic documents (and this share of them) and
# this log ratio on.
LEAST_DOCS = 3
LEAST_SHARE = 0.01
LEAST_RATIO = 2.5
# Log-odds of a document without tokens, and bound for all.
FAR = 20.0
# At so many remembered words, and after each task, the memory of a worker starts afresh.
MEMORY = 300_000
_WORD = re.compile(WORD)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_WIDTH = 1 + len(PREFIXES)
_NONE = (1 << FEATURE_BITS) - 1


def features(word: str) -> list[int]:
    """Hashed features, always ``_WIDTH`` of them (the last bucket is for 'none')."""
    plain = _EDGES.sub("", word).lower()
    found = [plain, *(plain[:n] if len(plain) >= n else "" for n in PREFIXES)]
    return [
        zlib.crc32(f"{kind}:{text}".encode("utf-8", "replace")) % _NONE if text else _NONE
        for kind, text in enumerate(found)
    ]


class _Words:
    """Numbers of words and the features of each, remembered."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.features = np.zeros((0, _WIDTH), np.int32)

    def of(self, documents: list[list[str]]) -> np.ndarray:
        number = self.number
        new = {word for words in documents for word in words if word not in number}
        if new:
            number.update(zip(new, range(len(number), len(number) + len(new))))
            self.features = np.concatenate([self.features, np.array([features(w) for w in new], np.int32)])
        return np.array([number[word] for words in documents for word in words], np.int64)


def _blocks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each token in a table of blocks (rows of ``CHAIN`` cells), and the number of
    blocks per document.  Each document begins a block."""
    rows = -(-counts // CHAIN)
    first = (np.cumsum(rows) - rows) * CHAIN
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(first - before, counts), rows


def _scaled(p: list[np.ndarray]) -> list[np.ndarray]:
    top = np.maximum(np.maximum(p[0], p[1]), np.maximum(p[2], p[3]))
    return [x / top for x in p]


def messages(emit: np.ndarray, counts: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal log-odds of the toxic label per token, and the forward log-odds.

    ``emit`` holds the tokens' own log-odds, document after document, ``counts`` the tokens
    of each, ``transition`` the log potentials [clean, toxic] x [clean, toxic].  With two
    labels messages are ratios, and a step takes a ratio r to (c + d r) / (a + b r).
    """
    t = np.exp(transition)
    cells, blocks = _blocks(counts)
    total = int(blocks.sum())
    up, real = np.ones(total * CHAIN), np.zeros(total * CHAIN, bool)
    up[cells], real[cells] = np.exp(np.clip(emit, -FAR, FAR)), True
    up, real = up.reshape(total, CHAIN), real.reshape(total, CHAIN)
    first = np.cumsum(blocks) - blocks
    filled = blocks > 0
    begins = np.zeros(total, bool)
    begins[first[filled]] = True
    into, out = np.ones(total), np.ones(total)
    if (blocks > 1).any():
        forth, back = _across(up, real, begins, t)
        most = int(blocks.max())
        for k in range(1, most):
            here = first[blocks > k] + k
            r = into[here - 1]
            into[here] = (forth[2][here - 1] + forth[3][here - 1] * r) / (forth[0][here - 1] + forth[1][here - 1] * r)
        for k in range(most - 1, 0, -1):
            here = first[blocks > k] + k
            r = out[here]
            out[here - 1] = (back[2][here] + back[3][here] * r) / (back[0][here] + back[1][here] * r)
    ahead, behind = np.empty_like(up), np.empty_like(up)
    ahead[:, 0] = np.where(begins, up[:, 0], up[:, 0] * (t[0, 1] + t[1, 1] * into) / (t[0, 0] + t[1, 0] * into))
    for i in range(1, CHAIN):
        r = ahead[:, i - 1]
        ahead[:, i] = up[:, i] * (t[0, 1] + t[1, 1] * r) / (t[0, 0] + t[1, 0] * r)
    behind[:, -1] = out
    for i in range(CHAIN - 2, -1, -1):
        r = up[:, i + 1] * behind[:, i + 1]
        behind[:, i] = np.where(real[:, i + 1], (t[1, 0] + t[1, 1] * r) / (t[0, 0] + t[0, 1] * r), behind[:, i + 1])
    forward = np.log(ahead.reshape(-1)[cells])
    return forward + np.log(behind.reshape(-1)[cells]), forward


def _across(up: np.ndarray, real: np.ndarray, begins: np.ndarray, t: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """What each block makes of a forward message from before it, and of a backward message
    from behind it: a, b, c, d of the step."""
    one, none = np.ones(len(up)), np.zeros(len(up))
    forth, back = [one, none, none, one], [one, none, none, one]
    for i in range(up.shape[1]):
        u, (a, b, c, d) = up[:, i], forth
        step = [t[0, 0] * a + t[1, 0] * c, t[0, 0] * b + t[1, 0] * d, u * (t[0, 1] * a + t[1, 1] * c), u * (t[0, 1] * b + t[1, 1] * d)]
        # At the first token of a document nothing comes from before.
        forth = _scaled([np.where(begins, w, x) for w, x in zip((one, one, u, u), step)] if i == 0 else step)
    for i in range(up.shape[1] - 1, -1, -1):
        u, (a, b, c, d) = up[:, i], back
        step = [t[0, 0] * a + t[0, 1] * u * c, t[0, 0] * b + t[0, 1] * u * d, t[1, 0] * a + t[1, 1] * u * c, t[1, 0] * b + t[1, 1] * u * d]
        back = _scaled([np.where(real[:, i], x, y) for x, y in zip(step, back)])
    return forth, back


def forward_backward(emit: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The messages of texts of equal length, one per row of ``emit``."""
    counts = np.full(emit.shape[0], emit.shape[1])
    marginal, forward = messages(emit.reshape(-1), counts, transition)
    return marginal.reshape(emit.shape), forward.reshape(emit.shape)


def _marginals(emit: np.ndarray, counts: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Marginal log-odds of tokens, document after document, from their own log-odds."""
    return np.clip(messages(emit, counts, transition)[0], -FAR, FAR)


def _measures(odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document 1, the greatest log-odds, log(1 + expected toxic tokens) and
    log(1 + tokens), of similar size each."""
    top, expected = np.full(len(counts), -FAR), np.zeros(len(counts))
    filled = np.flatnonzero(counts)
    if len(filled):
        begins = (np.cumsum(counts) - counts)[filled]
        top[filled] = np.maximum.reduceat(odds, begins)
        expected[filled] = np.add.reduceat(1 / (1 + np.exp(-odds)), begins)
    return np.stack([np.ones(len(top)), top / 5, np.log1p(expected), np.log1p(counts) / 3], 1)


class ToxicityModel:
    def __init__(self, weights: np.ndarray, bias: float, transition: np.ndarray, curve: list[float] | None) -> None:
        self.weights, self.bias, self.transition, self.curve = weights, bias, transition, curve
        self._words, self._emit = _Words(), np.zeros(0)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_words", "_emit")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._words, self._emit = _Words(), np.zeros(0)

    def forget(self) -> None:
        self._words, self._emit = _Words(), np.zeros(0)

    def odds(self, documents: list[list[str]]) -> np.ndarray:
        """Marginal log-odds of all tokens, document after document."""
        if len(self._words.number) > MEMORY:
            self.forget()
        places = self._words.of(documents)
        new = self._words.features[len(self._emit) :]
        self._emit = np.append(self._emit, self.bias + self.weights[new].sum(axis=1))
        counts = np.array([len(x) for x in documents], np.int64)
        return _marginals(self._emit[places], counts, self.transition)

    def measures(self, documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """What the score of each document depends on, and all odds."""
        odds = self.odds(documents)
        return _measures(odds, np.array([len(x) for x in documents], np.int64)), odds

    def score(self, measures: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(measures))
        return 1 / (1 + np.exp(-np.clip(measures @ np.array(self.curve), -FAR, FAR)))


def _telling(documents: list[np.ndarray], table: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which features are far more frequent in toxic documents than in clean ones.

    A document is the numbers of its words, ``table`` has the features of each number.
    """
    size = 1 << FEATURE_BITS
    bad, good = np.zeros(size), np.zeros(size)
    for words, is_toxic in zip(documents, toxic):
        (bad if is_toxic else good)[np.unique(table[np.unique(words)])] += 1
    ratio = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))
    telling = (bad >= max(min(LEAST_DOCS, toxic.sum()), LEAST_SHARE * toxic.sum())) & (ratio >= LEAST_RATIO)
    telling[_NONE] = False
    return telling


def _numbered(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The texts as numbers of their words, and the features of each number."""
    known, documents = _Words(), []
    for first in range(0, len(texts), 200):
        part = [_WORD.findall(text) for text in texts[first : first + 200]]
        codes = known.of(part).astype(np.int32)
        documents += np.split(codes, np.cumsum([len(words) for words in part])[:-1])
    return documents, known.features


def fit(texts: list[str], toxic: np.ndarray, weight: np.ndarray, chain_docs: int = TRAIN_ROWS) -> ToxicityModel:
    """Train on whole texts with document labels and the documents' weights; the field
    itself on the toxic ones and half of ``chain_docs`` clean ones."""
    size = 1 << FEATURE_BITS
    empty = ToxicityModel(np.zeros(size), 0.0, np.zeros((2, 2)), None)
    if not toxic.any() or toxic.all():
        return empty
    everything, features_of = _numbered(texts)
    telling = _telling(everything, features_of, toxic)
    used = np.flatnonzero(toxic | (np.cumsum(~toxic) <= chain_docs // 2))
    counts = np.array([len(everything[i]) for i in used], np.int64)
    words = np.concatenate([everything[i] for i in used])
    if not len(words):
        return empty
    labels = telling[features_of].any(axis=1)[words] & np.repeat(toxic[used], counts)
    share = max(labels.mean(), 1e-6)
    weights, bias, transition = np.zeros(size), float(np.log(share / (1 - share))), np.zeros((2, 2))
    gain_w, gain_t, gain_b = np.full(size, 1e-4), np.full((2, 2), 1e-4), 1e-4
    # Pairs of neighbouring tokens of one document, by their labels.
    document = np.repeat(np.arange(len(counts)), counts)
    both = document[:-1] == document[1:]
    pairs = np.bincount((2 * labels[:-1] + labels[1:])[both], minlength=4).reshape(2, 2)
    for _ in range(STEPS):
        emit = (bias + weights[features_of].sum(axis=1))[words]
        marginal, ahead = messages(emit, counts, transition)
        lack = labels - 1 / (1 + np.exp(-marginal))
        by_word = np.bincount(words, lack, minlength=len(features_of))
        grad_w = sum(np.bincount(column, by_word, minlength=size) for column in features_of.T) - 1e-3 * weights
        grad_t = pairs - _expected_pairs(emit, marginal, ahead, transition, both) - 1e-3 * transition
        grad_b = lack.sum()
        gain_w += grad_w**2
        gain_t += grad_t**2
        gain_b += grad_b**2
        weights += 1.0 * grad_w / np.sqrt(gain_w)
        transition += 0.2 * grad_t / np.sqrt(gain_t)
        bias += 0.2 * grad_b / np.sqrt(gain_b)
    weights[_NONE] = 0.0
    model = ToxicityModel(np.round(weights, 6), round(float(bias), 6), np.round(transition, 6), None)
    emit = model.bias + model.weights[features_of].sum(axis=1)
    parts = []
    for first in range(0, len(everything), 500):
        part = everything[first : first + 500]
        sizes = np.array([len(x) for x in part], np.int64)
        parts.append(_measures(_marginals(emit[np.concatenate(part)], sizes, model.transition), sizes))
    model.curve = _curve(np.concatenate(parts), toxic, weight)
    return model


def _expected_pairs(emit: np.ndarray, marginal: np.ndarray, ahead: np.ndarray, transition: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Expected label pairs of neighbouring tokens (``both``: of one document): forward at
    i, transition, emission and backward at i + 1; summed in slices of tokens."""
    total, t = np.zeros(4), np.exp(transition)
    for first in range(0, len(both), 250_000):
        here = slice(first, min(first + 250_000, len(both)))
        after_ = slice(here.start + 1, here.stop + 1)
        f1 = 1 / (1 + np.exp(-ahead[here]))
        after = marginal[after_] - ahead[after_] + np.clip(emit[after_], -FAR, FAR)
        g = np.exp(np.clip(after, -3 * FAR, 3 * FAR))
        joint = np.stack([(1 - f1) * t[0, 0], (1 - f1) * t[0, 1] * g, f1 * t[1, 0], f1 * t[1, 1] * g])
        joint /= joint.sum(axis=0)
        total += (joint * both[here]).sum(axis=1)
    return total.reshape(2, 2)


def _curve(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> list[float]:
    """Weighted logistic regression with a ridge, by Newton steps."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [1e-1] * (x.shape[1] - 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -FAR, FAR)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ (weight * (toxic - p)) - ridge @ w)
        w = w + step * min(1.0, 2 / np.abs(step).max())
    return [round(float(v), 9) for v in w]


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit on documents (doc_id, text) with a label (doc_id, toxic): about ``rows`` toxic
    and twice as many clean ones, which reach the driver.

    The sample is drawn among the labels, so of the documents only those in it are moved.
    An id with several labels counts as toxic if one of them is.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    known = known.agg((F.max("toxic") == 1).alias("toxic"))
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    million = 1_000_000
    limits = [int(million * min(1.0, most / max(1, counts.get(bad, 0)))) for bad, most in ((False, 2 * rows), (True, rows))]
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(million))
    drawn = known.where(draw < F.when(F.col("toxic"), limits[True]).otherwise(limits[False])).limit(6 * rows)
    drawn = drawn.select(F.col("doc_id").alias("_drawn"), "toxic")
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_drawn"))
    # Many texts under one id are cut by a hash, the same on every run.
    sample = texts.dropDuplicates(["text", "toxic"]).orderBy(F.xxhash64("text"), "text").limit(6 * rows)
    found = sample.select("text", "toxic").toPandas()
    toxic = found["toxic"].to_numpy(bool)
    weight = np.ones(len(found))
    for bad in (False, True):
        weight[toxic == bad] = counts.get(bad, 0) / max(1, (toxic == bad).sum())
    # To one per row on average, so that the ridge means the same for any number of labels.
    model = fit(found["text"].tolist(), toxic, weight / max(1e-9, weight.mean()) if len(weight) else weight)
    # The driver would keep the sample's memory beside its JVM's for as long as it lives.
    del found
    give_back()
    return model


def score(docs: DataFrame, model: ToxicityModel, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, toxicity (0 to 1) and spans: start and stop (in characters,
    stop exclusive) of runs of tokens that are toxic rather than not, with the greatest
    marginal of the run."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = "toxicity double, spans array<struct<start:int,stop:int,marginal:double>>"
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("marginal", pa.float64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, texts in slices(batch, "text", 1_000_000):
                documents = [_WORD.findall(text) for text in texts]
                measures, odds = model.measures(documents)
                stops = np.cumsum([len(x) for x in documents])
                spans = []
                for text, words, high, stop in zip(texts, documents, measures[:, 1], stops.tolist()):
                    spans.append(_spans(text, odds[stop - len(words) : stop]) if high > 0 else [])
                part = batch.slice(first, len(texts))
                columns = [*(part.column(c) for c in keep), pa.array(model.score(measures)), pa.array(spans, span_type)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "toxicity", "spans"])
        model.forget()

    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(lean(judge), f"{schema}, {out}")


def _spans(text: str, odds: np.ndarray) -> list[dict]:
    found: list[dict] = []
    last = -2
    for place, match in enumerate(_WORD.finditer(text)):
        if odds[place] <= 0:
            continue
        marginal = float(1 / (1 + np.exp(-odds[place])))
        if last == place - 1:
            found[-1] |= {"stop": match.end(), "marginal": max(found[-1]["marginal"], marginal)}
        else:
            found.append({"start": match.start(), "stop": match.end(), "marginal": marginal})
        last = place
    return found


def split(doc_id: Column, held_out: int = 2) -> Column:
    """Whether a document is held out: crc32 of its id as text, modulo 4."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == F.lit(held_out)
