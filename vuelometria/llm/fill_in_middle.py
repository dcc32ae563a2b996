"""Fill-in-the-middle texts by content-defined chunks with a memo of boundary summaries.

A text has n tokens: a word with the white space before it, or the white space at the end. Where its prefix and middle
end follows from n and seeded numbers of its id. Both take the places of two word ends, and the count n, of every text:

1. A rolling hash over the last 32 bytes cuts the text into chunks, so texts that share a passage share its chunks wherever
   the passage stands in them. Chunks have ``least`` bytes at least, and end between two characters.
2. A chunk has a summary: words that end inside of it, code points, and whether it begins and ends inside of a word. It
   is computed once for each content and kept in a memo under that content, so equal hashes of other chunks do no harm.
3. Counts of neighbours combine: a word that goes on in the next chunk ends there. Running sums over the chunks of a text
   give n and the chunk in which a token ends; only this chunk is looked through.

Python returns n and two places a text; texts are cut and joined by SQL functions. The memo belongs to a Python worker,
holds ``memo_bytes`` of chunks at most, and starts again when it is full, which changes nothing but the time.

Defined results: NULL and empty texts have no tokens and are plain; texts of white space are one token; a text that holds
a mark is plain, so the output can always be taken apart again; a NULL id draws as the empty string; equal rows have
equal results; very long texts are chunks like any other; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WINDOW = 32


@dataclass(frozen=True)
class FillInMiddle:
    seed: int = 42
    rate_percent: int = 50
    spm_percent: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


@dataclass(frozen=True)
class Chunking:
    least: int = 128
    #: a chunk ends where so many bits of the hash are zero: 2^bits bytes after ``least``, on average
    bits: int = 9
    memo_bytes: int = 64_000_000


def _gear() -> np.ndarray:
    """A number for each byte value, by a fixed mixing rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def chunk_ends(raw: np.ndarray, bounds: np.ndarray, c: Chunking) -> np.ndarray:
    """Where chunks end in ``raw``, many texts that end at ``bounds``; every text ends a chunk."""
    # the sum of the window's numbers, each shifted by its distance, from sums of windows half as long
    hashed, width = _GEAR[raw], 1
    while width < _WINDOW:
        hashed[width:] += hashed[:-width] << np.uint32(width)
        width *= 2
    ends = np.flatnonzero(hashed >> np.uint32(32 - c.bits) == 0) + 1
    ends = ends[ends < len(raw)]
    ends = ends[raw[ends] & 0xC0 != 0x80]
    out: list[int] = []
    least = max(c.least, _WINDOW)  # no window reaches into another text
    last, candidates = 0, iter(np.append(ends, len(raw)).tolist())
    end = next(candidates)
    for bound in bounds.tolist():
        while end < bound:
            if end - last >= least:
                out.append(end)
                last = end
            end = next(candidates)
        if bound > last:
            out.append(bound)
            last = bound
    return np.array(out, np.int64)


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Runs of word bytes, code points, and whether the chunk begins and ends inside of a word."""
    found = np.frombuffer(chunk, np.uint8)
    return len(_WORD.findall(chunk)), int((found & 0xC0 != 0x80).sum()), not _BLANK[found[0]], not _BLANK[found[-1]]


class Cutter:
    """Counts the tokens of texts, and finds the ends of tokens."""

    def __init__(self, c: Chunking = Chunking()) -> None:
        self.c, self.memo, self.held = c, {}, 0
        self.asked = self.computed = 0

    def _summaries(self, raw: bytes, ends: list[int]) -> np.ndarray:
        out, start = [], 0
        for end in ends:
            chunk = raw[start:end]
            known = self.memo.get(chunk)
            if known is None:
                if self.held > self.c.memo_bytes:
                    self.memo, self.held = {}, 0
                self.memo[chunk] = known = summary(chunk)
                self.held += len(chunk)
                self.computed += 1
            out.append(known)
            start = end
        self.asked += len(ends)
        return np.array(out, np.int64).reshape(-1, 4).T

    def cuts(self, texts: list[bytes], draws: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(n, code points before the middle, code points before the suffix) of each text, from two draws for each."""
        raw = b"".join(texts)
        stops = np.cumsum([len(t) for t in texts], dtype=np.int64)
        ends = chunk_ends(np.frombuffer(raw, np.uint8), stops, self.c)
        runs, chars, begins, leaves = self._summaries(raw, ends.tolist())
        # a word that goes on in the next chunk of its text ends there
        goes_on = np.zeros(len(ends), bool)
        goes_on[:-1] = (leaves[:-1] & begins[1:]).astype(bool) & ~np.isin(ends[:-1], stops)
        words, points = np.cumsum(runs - goes_on), np.cumsum(chars)
        of_text = np.searchsorted(ends, stops, side="right")
        first = 0
        for after, draw in zip(of_text.tolist(), draws.tolist()):
            if after == first:
                yield 0, 0, 0
                continue
            before, skipped = (int(words[first - 1]), int(points[first - 1])) if first else (0, 0)
            n_words, n_chars = int(words[after - 1]) - before, int(points[after - 1]) - skipped
            n = n_words + (not leaves[after - 1])
            places = []
            for k in sorted(x % (n + 1) for x in draw):
                if not 0 < k <= n_words:
                    places.append(0 if k == 0 else n_chars)
                    continue
                i = int(np.searchsorted(words[first:after], before + k)) + first
                start = int(ends[i - 1]) if i else 0
                rank = k - (int(words[i - 1]) - before if i > first else 0)
                chunk = raw[start : ends[i]]
                *_, found = (m for m, _ in zip(_WORD.finditer(chunk), range(rank)))
                inside = np.frombuffer(chunk[: found.end()], np.uint8)
                places.append((int(points[i - 1]) if i else 0) - skipped + int((inside & 0xC0 != 0x80).sum()))
            first = after
            yield n, *places


def _places_udf(c: Chunking):
    @F.arrow_udf("struct<n:bigint,before_middle:int,before_suffix:int>")
    def places(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        cutter = Cutter(c)
        for text, h1, h2 in parts:
            draws = np.stack([h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)], axis=1)
            rows = cutter.cuts([x.as_py() or b"" for x in text], draws)
            yield pa.array([dict(zip(("n", "before_middle", "before_suffix"), r)) for r in rows],
                           pa.struct([("n", pa.int64()), ("before_middle", pa.int32()), ("before_suffix", pa.int32())]))

    return places


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four seeded numbers below 2^32 of an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substr(digest, F.lit(8 * i + 1), F.lit(8)), 16, 10).cast("long") for i in range(4)]


def rearranged(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", p: FillInMiddle = FillInMiddle(), c: Chunking = Chunking()
) -> DataFrame:
    """One row per document: id, n, form (plain, psm, spm), prefix, middle, suffix (NULL if plain) and output."""
    raw = F.coalesce(docs[text], F.lit(""))
    h = draws(docs[id_col], p.seed)
    marked = [F.contains(raw, F.lit(m)) for m in (p.prefix, p.suffix, p.middle)]
    plain = (raw == "") | marked[0] | marked[1] | marked[2] | (F.pmod(h[2], F.lit(100)) >= p.rate_percent)
    form = F.when(plain, "plain").when(F.pmod(h[3], F.lit(100)) < p.spm_percent, "spm").otherwise("psm")
    rows = docs.select(docs[id_col].alias("id"), raw.alias("raw"), form.alias("form"), h[0].alias("h1"), h[1].alias("h2"))
    cut = rows.select("id", "raw", "form", _places_udf(c)(F.col("raw").cast("binary"), "h1", "h2").alias("at"))
    a, b = F.col("at.before_middle"), F.col("at.before_suffix")
    moved = F.col("form") != "plain"
    parts = cut.select(
        "id", "form", "raw", F.col("at.n").alias("n"),
        F.when(moved, F.substr("raw", F.lit(1), a)).alias("prefix"),
        F.when(moved, F.substr("raw", a + 1, b - a)).alias("middle"),
        F.when(moved, F.substr("raw", b + 1)).alias("suffix"),
    )
    marks = {k: F.lit(v) for k, v in (("P", p.prefix), ("S", p.suffix), ("M", p.middle))}
    output = (
        F.when(F.col("form") == "psm", F.concat(marks["P"], "prefix", marks["S"], "suffix", marks["M"], "middle"))
        .when(F.col("form") == "spm", F.concat(marks["S"], "suffix", marks["P"], "prefix", marks["M"], "middle"))
        .otherwise(F.col("raw"))
    )
    return parts.select(F.col("id").alias(id_col), "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restored(output: Column, form: Column, p: FillInMiddle = FillInMiddle()) -> Column:
    """The text that an output was made of, from the output and its form alone."""

    def taken_apart(first: str, second: str) -> tuple[Column, Column, Column]:
        b, c = F.locate(second, output), F.locate(p.middle, output)
        start = len(first) + 1
        return (
            F.substr(output, F.lit(start), b - start),
            F.substr(output, b + len(second), c - b - len(second)),
            F.substr(output, c + len(p.middle)),
        )

    prefix, suffix, middle = taken_apart(p.prefix, p.suffix)
    late_suffix, early_prefix, last_middle = taken_apart(p.suffix, p.prefix)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(early_prefix, last_middle, late_suffix))
        .otherwise(output)
    )
