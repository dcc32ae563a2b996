"""Tokens of whole columns of texts, by the files of public tokenizers.

``WordTokenizer`` is for vocabularies whose tokens never cross white space and whose pre-tokenizer splits letters from
punctuation: the tokens of a text are those of its parts in order, so a part is encoded once and looked up afterwards.
The parts of a batch are found, and told apart by their whole content, in Arrow: words between white space, A-Z in lower
case, cut between plain letters and punctuation that starts neither a contraction nor a special token. New ones go to the
tokenizer library. Parts of plain letters are encoded many at a time, and cut apart again after the tokens that end a
word; if the number of ends is not that of the parts, the library gets them one by one, as it gets all other parts.

Defined results: NULL and empty texts have no tokens. The cache holds ``cache_words`` words at most and starts again when
it is full, which changes nothing but the time.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: white space that is a boundary for every tokenizer of this kind; rarer kinds stay inside of a part
_BLANKS = b"\t\n\r"
_PUNCTUATION = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_LETTERS = "^[a-zà-öø-ÿ]+$"


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_IS_PUNCTUATION = _table(_PUNCTUATION)
_IS_LETTER = _table(bytes(range(97, 123)) + bytes(range(65, 91)))
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[list(_BLANKS)] = 32
_LOWERED = _SPACED.copy()
_LOWERED[65:91] += 32


def _parts(texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
    """The parts of all texts in order, and where those of each text start."""
    _, places, data = texts.buffers()
    if not len(texts) or data is None:
        return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[places[0] : places[-1]]
    places = places - places[0]
    # special tokens are found in texts as they are
    raw = (_SPACED if b"<|" in raw.tobytes() else _LOWERED)[raw]
    mark, letter = _IS_PUNCTUATION[raw], _IS_LETTER[raw]
    # two bytes of Latin letters: C3 and 80 to BF, but for the signs of multiplication and division
    second = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0xBF) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    after, before = letter.copy(), letter
    after[1:] |= second
    before[:-1] |= second
    cut = np.flatnonzero((after[:-1] & mark[1:]) | (mark[:-1] & before[1:])) + 1
    raw = np.insert(raw, cut, 32)
    places = places + np.searchsorted(cut, places, side="left")
    spaced = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(places), pa.py_buffer(raw))
    split = pc.split_pattern(spaced, " ")
    return split.values, np.asarray(split.offsets).astype(np.int64)


@lru_cache(maxsize=4)
def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the cores belong to Spark's tasks
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Runs:
    """Ids of many strings in one array: string -> number, and where the ids of a number start and how many they are."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.starts = self.sizes = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def add(self, names: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.numbers)
        self.numbers.update(zip(names, range(known, known + len(names))))
        starts = len(self.flat) + np.cumsum(sizes, dtype=np.int32) - sizes
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, ids])

    def numbers_of(self, names: list[str]) -> np.ndarray:
        """-1 for those that are not there."""
        return np.fromiter(map(self.numbers.get, names, repeat(-1)), np.int32, len(names))

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these numbers in turn, and how many each has."""
        sizes = self.sizes[numbers]
        filled = numbers[sizes > 0]
        # one step from id to id, and from the last id of a number to the first of the next
        step = np.ones(int(sizes.sum(dtype=np.int64)), np.int32)
        if len(filled):
            begin, n = self.starts[filled], self.sizes[filled]
            places = np.cumsum(n, dtype=np.int64) - n
            step[places] = begin
            step[places[1:]] -= (begin + n - 1)[:-1]
        return self.flat[np.cumsum(step, dtype=np.int32)], sizes


class WordTokenizer:
    def __init__(self, path: str, cache_words: int = 600_000) -> None:
        from tokenizers import pre_tokenizers

        self.whole = _library(path)
        self.plain = type(self.whole).from_str(self.whole.to_str())
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        names = self.whole.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(names.values(), default=0) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.cache_words = cache_words
        self._clear()

    def _clear(self) -> None:
        self.known = _Runs()

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.whole.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int32)

    def _together(self, units: list[str], step: int = 512) -> tuple[np.ndarray, np.ndarray]:
        parts = [units[i : i + step] for i in range(0, len(units), step)]
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int32)]
        for part, e in zip(parts, self.plain.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            found = np.array(e.ids, np.uint32)
            n = np.diff(np.flatnonzero(self.ends[found]), prepend=-1)
            if len(n) != len(part):
                found, n = self._one_by_one(part)
            ids.append(found)
            sizes.append(n.astype(np.int32))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, parts: pa.Array) -> None:
        """Adds parts that are not in the cache."""
        plain = pc.match_substring_regex(parts, _LETTERS)
        for kind, encode in ((pc.filter(parts, plain), self._together), (pc.filter(parts, pc.invert(plain)), self._one_by_one)):
            names = kind.to_numpy(zero_copy_only=False).tolist()
            self.known.add(names, *encode(names))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order (uint32), and for each text the place where its ids start; one place more than texts."""
        parts, bounds = _parts(pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")]))
        found = parts.dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known.numbers) > self.cache_words:
            self._clear()
        numbers = self.known.numbers_of(distinct)
        if (new := np.flatnonzero(numbers < 0)).size:
            self._learn(found.dictionary.take(pa.array(new)))
            numbers = self.known.numbers_of(distinct)
        ids, sizes = self.known.ids(numbers[np.asarray(found.indices)])
        return ids, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[bounds]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each file and Python worker, so that tasks of a worker share the cache."""
    return WordTokenizer(path)


def encode_texts(texts: pa.Array, path: str, by_word: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids and starts as of ``WordTokenizer.encode``; without ``by_word`` by the library alone, for any tokenizer."""
    if by_word:
        return word_tokenizer(path).encode(texts)
    found = _library(path).encode_batch([x or "" for x in texts.to_pylist()], add_special_tokens=False)
    ids = [np.array(e.ids, np.uint32) for e in found]
    return np.concatenate([np.zeros(0, np.uint32), *ids]), np.cumsum([0, *map(len, ids)], dtype=np.int64)
