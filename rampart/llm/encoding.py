"""Encoding of whole texts with the tokenizers library, once per distinct piece.

A tokenizer that first splits a text at white space and between letters and punctuation
gives each piece between two such places the same ids wherever it stands.  Prose repeats
its words, so the ids of a piece are kept and looked up, and only new pieces are encoded.
Pieces are cut in the UTF-8 bytes of a batch of texts at once, and each distinct piece of
a batch is looked up once.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from rampart.llm.common import keep_heap, kept_between_tasks

# Letters that become a letter and a mark in lower case or in composed form: a tokenizer
# joins the mark with punctuation that follows, so a piece does not end at one.
_MARKED = {0x130}
# With other kinds of white space than these two a text is encoded as a whole.
_SPACES = b" \n"
_OTHER_SPACE = re.compile(r"[^\S \n]")
_OTHER_ASCII_SPACE = [chr(c) for c in range(128) if _OTHER_SPACE.match(chr(c))]
# With so many pieces, or so many characters in them, a worker forgets those it used once.
MEMORY = 700_000
MEMORY_CHARS = 16_000_000
# So many new pieces are encoded as one text.
_JOINED = 500


def _letter_ends() -> np.ndarray:
    """For two bytes as a number (first one high): do they end with a letter or digit that
    has one or two bytes?  Longer ones are not looked at: there a piece goes on."""
    ends = np.zeros((256, 256), bool)
    for code in range(0x800):
        if chr(code).isalnum() and code not in _MARKED:
            utf8 = chr(code).encode()
            ends[utf8[-2] if code >= 0x80 else slice(None), utf8[-1]] = True
    return ends.reshape(-1)


def _byte_table(wanted: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(wanted, np.uint8)] = True
    return table


_LETTER_END = _letter_ends()
_SPACE = _byte_table(_SPACES)
# ASCII, but neither letter nor digit.
_BREAK = _byte_table(bytes(c for c in range(128) if not chr(c).isalnum()))


def _cuts(data: np.ndarray) -> np.ndarray:
    """Marks where pieces start in UTF-8 bytes: at the first byte, at white space that
    follows something else, and at any ASCII sign that follows a letter or digit.  Before
    something that is not ASCII a piece goes on, as that may have to be composed with what
    is before it."""
    before, here = data[:-1], data[1:]
    pairs = before.astype(np.uint16)
    pairs[1:] |= data[:-2].astype(np.uint16) << np.uint16(8)
    space = _SPACE[data]
    start = np.ones(len(data), bool)
    start[1:] = _BREAK[here] & _LETTER_END[pairs] | space[1:] & ~space[:-1]
    return start


def _has_other_space(text: str) -> bool:
    if text.isascii():
        return any(x in text for x in _OTHER_ASCII_SPACE)
    return _OTHER_SPACE.search(text) is not None


def gather(starts: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[start : start + length]``."""
    if not len(starts):
        return flat[:0]
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(lengths.sum())]


class _Numbers(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Encoder:
    """``added_tokens``: the strings of added tokens in a text stand for these tokens, as
    in the library's own call; otherwise they are ordinary text.  ``memory``: of so many
    pieces it keeps the ids."""

    def __init__(self, path: str, added_tokens: bool = False, memory: int = MEMORY) -> None:
        self._most, self._most_chars = memory, MEMORY_CHARS * memory // MEMORY
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not added_tokens
        # A text that holds one of these is encoded as a whole.
        found = self._tokenizer.get_added_tokens_decoder().values() if added_tokens else ()
        self._added = [token.content for token in found]
        # The string of a special token between pieces keeps their ids apart.
        self._joiner = self._tokenizer if added_tokens else Tokenizer.from_file(path)
        plain = [
            token.content
            for token in self._joiner.get_added_tokens_decoder().values()
            if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word)
        ]
        self._mark = plain[-1] if plain else None
        self._mark_id = self._joiner.token_to_id(self._mark) if plain else None
        self._specials = [token.content for token in self._joiner.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self._number = _Numbers()
        self._pieces = self._chars = 0
        self._start = np.zeros(0, np.int64)
        self._length = np.zeros(0, np.int64)
        self._uses = np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.uint32)

    def _shrink(self) -> None:
        """Forget all pieces but those used more than once since the last time (of too many
        of them the most used)."""
        keep = np.flatnonzero(self._uses > 1)
        if len(keep) > self._most // 2:
            keep = np.sort(keep[np.argsort(self._uses[keep])[-(self._most // 2) :]])
        pieces = list(self._number)
        kept = [pieces[i] for i in keep]
        chars = sum(map(len, kept))
        start, length, flat = self._start[keep], self._length[keep], self._flat
        self._forget()
        if chars <= self._most_chars // 2:
            self._number.update(zip(kept, range(len(kept))))
            self._pieces, self._chars = len(kept), chars
            self._start, self._length = np.cumsum(length) - length, length
            self._uses = np.zeros(len(kept), np.int64)
            self._flat = gather(start, length, flat)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _ids_of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and the number of ids per piece."""
        joined = self._mark.join(pieces) if self._mark else ""
        if joined and sum(map(joined.count, self._specials)) == len(pieces) - 1:
            found = self._joiner.encode_batch_fast([joined], add_special_tokens=False)[0]
            ids = np.array(found.ids, np.uint32)
            marks = np.flatnonzero(ids == self._mark_id)
            if len(marks) == len(pieces) - 1:
                lengths = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
                return ids[ids != self._mark_id], lengths
        parts = self._ids(pieces)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def _learn(self, new: list[str]) -> None:
        """Encode pieces that were just numbered."""
        flats, lengths = [self._flat], []
        for first in range(0, len(new), _JOINED):
            flat, length = self._ids_of_pieces(new[first : first + _JOINED])
            flats.append(flat)
            lengths.append(length)
        if lengths:
            length = np.concatenate(lengths)
            self._start = np.append(self._start, len(self._flat) + np.cumsum(length) - length)
            self._length = np.append(self._length, length)
            self._uses = np.append(self._uses, np.zeros(len(length), np.int64))
            self._flat = np.concatenate(flats)
            self._pieces = len(self._number)
            self._chars += sum(map(len, new))

    def _numbers_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pieces of the texts, and how many pieces each text has."""
        blobs = [text.encode() for text in texts]
        stops = np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)))
        data = b"".join(blobs)
        del blobs
        if not data:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        is_start = _cuts(np.frombuffer(data, np.uint8))
        is_start[stops[stops < len(data)]] = True
        starts = np.flatnonzero(is_start)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, bounds, pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self._number.__getitem__, distinct), np.int64, len(distinct))
        # New ones were numbered in this order.
        self._learn(distinct[numbers >= self._pieces].tolist())
        order = coded.indices.to_numpy(zero_copy_only=False)
        self._uses[numbers] += np.bincount(order, minlength=len(numbers))
        return numbers[order], np.diff(np.searchsorted(starts, stops), prepend=0)

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each followed by ``end``, and the
        number of ids per text."""
        if len(self._number) > self._most or self._chars > self._most_chars:
            self._shrink()
        whole = {
            place: text
            for place, text in enumerate(texts)
            if any(x in text for x in self._added) or _has_other_space(text)
        }
        order, counts = self._numbers_of(["" if place in whole else text for place, text in enumerate(texts)])
        lengths = self._length[order]
        flat = gather(self._start[order], lengths, self._flat)
        ends = np.append(0, np.cumsum(lengths))[np.cumsum(counts)]
        sizes = np.diff(ends, prepend=0)
        direct = dict(zip(whole, self._ids(list(whole.values())))) if whole else {}
        for place, ids in direct.items():
            sizes[place] = len(ids)
        out = np.full(int(sizes.sum()) + len(texts), end, np.uint32)
        # Where the ids of the texts go: everywhere but at the end marks.
        free = np.ones(len(out), bool)
        free[np.cumsum(sizes + 1) - 1] = False
        if not direct:
            out[free] = flat
        else:
            stops = np.cumsum(sizes + 1)
            for place in range(len(texts)):
                ids = direct.get(place)
                if ids is None:
                    ids = flat[ends[place] - sizes[place] : ends[place]]
                out[stops[place] - 1 - len(ids) : stops[place] - 1] = ids
        return out, sizes + 1


@kept_between_tasks
@lru_cache(maxsize=2)
def encoder(path: str, added_tokens: bool = False, memory: int = MEMORY, heap_mb: int = 256) -> Encoder:
    """One per worker process, kept from task to task of operators that encode."""
    keep_heap(heap_mb)
    return Encoder(path, added_tokens, memory)
