"""Token counts under a unigram model, by dynamic programming over a trie.

A pre-token is a word (a run of anything but ASCII white space) behind the word mark.
The distinct pre-tokens of a slice of documents, in sorted order, are walked as a trie:
the best score and token count of a prefix are computed once and serve every pre-token
below it; the counts at the terminals are remembered by pre-token, for later slices of
the same worker too.  A document's count is the sum over its pre-tokens.

The model is a fixed vocabulary in order of rank; a piece of rank r scores -ln(r + 1), as
words do by Zipf's law.  Characters outside the vocabulary count one token per byte.  Of
equal scores the segmentation with the longest last piece is taken.

Rows: every input row is counted, also with a NULL or repeated id.  A NULL or empty text
has no words and no tokens.  Other columns are not used.  An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import WORD, slices

WORD_MARK = "▁"
# A character outside the vocabulary scores this much less than the last piece.
UNKNOWN_PENALTY = 10.0
# At so many remembered pre-tokens the memory of a worker starts afresh.
MEMORY = 1_000_000
_SCORE = ""


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    return {piece: -math.log(rank + 1) for rank, piece in enumerate(pieces)}


class TrieCounter:
    def __init__(self, scores: dict[str, float]) -> None:
        # The vocabulary as a trie of dicts; the score of a piece is under "".
        self._root: dict = {}
        for piece, score in scores.items():
            node = self._root
            for char in piece:
                node = node.setdefault(char, {})
            node[_SCORE] = score
        self._unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.forget()

    def forget(self) -> None:
        self._number: dict[str, int] = {}
        self._counts = np.zeros(0, np.int64)

    def _score(self, words: list[str]) -> list[int]:
        """Token counts of sorted distinct pre-tokens.

        ``path[j]`` is the state of the prefix of length j: its best score, its count, and
        the pieces that may go on (vocabulary node, score and count before the piece).
        """
        root, unknown, counts = self._root, self._unknown, []
        path = [(0.0, 0, [])]
        previous = ""
        for word in words:
            shared, limit = 0, min(len(word), len(previous))
            while shared < limit and word[shared] == previous[shared]:
                shared += 1
            del path[shared + 1 :]
            for char in word[shared:]:
                score, count, going = path[-1]
                best, best_count, on = -math.inf, 0, []
                for node, before, number in going:
                    node = node.get(char)
                    if node is not None:
                        on.append((node, before, number))
                        own = node.get(_SCORE)
                        if own is not None and before + own > best:
                            best, best_count = before + own, number + 1
                node = root.get(char)
                own = None
                if node is not None:
                    on.append((node, score, count))
                    own = node.get(_SCORE)
                if own is not None:
                    if score + own > best:
                        best, best_count = score + own, count + 1
                elif score + unknown > best:
                    best, best_count = score + unknown, count + len(char.encode("utf-8", "surrogatepass"))
                path.append((best, best_count, on))
            counts.append(path[-1][1])
            previous = word
        return counts

    def count(self, documents: list[list[str]]) -> np.ndarray:
        """Tokens per document, given as a list of words."""
        number = self._number
        if len(number) > MEMORY:
            self.forget()
            number = self._number
        new = sorted({word for words in documents for word in words if word not in number})
        number.update(zip(new, range(len(number), len(number) + len(new))))
        self._counts = np.append(self._counts, np.array(self._score([WORD_MARK + w for w in new]), np.int64))
        places = np.array([number[word] for words in documents for word in words], np.int64)
        sums = np.append(0, np.cumsum(self._counts[places]))
        stops = np.cumsum([len(words) for words in documents])
        return np.diff(sums[stops], prepend=0)


@lru_cache(maxsize=2)
def counter(model_path: str) -> TrieCounter:
    """The counter of a worker for the pieces of a sentencepiece vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return TrieCounter(zipf_scores([model.id_to_piece(i) for i in plain]))


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every document."""
    word = re.compile(WORD)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = counter(model_path)
        for batch in batches:
            for first, texts in slices(batch, "text"):
                documents = [word.findall(text) for text in texts]
                columns = [
                    batch.column("doc_id").slice(first, len(texts)),
                    pa.array(list(map(len, documents)), pa.int64()),
                    pa.array(trie.count(documents)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(count, "doc_id long, n_words long, n_tokens long")
