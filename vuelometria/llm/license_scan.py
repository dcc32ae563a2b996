"""License scan: passages against license notices by the Dice coefficient over word bigrams.

A text is looked at whole, by paragraph and by line, each passage once. Passages and notices become bags of word bigrams
(letters and digits, lower case). Dice = 2 * common / (a + b) can reach the limit ``t`` only if the bags differ in size by
a factor of (2 - t) / t at most, so each notice is entered under the sizes that can match, and passages are joined on
their size. A bound from the distinct bigrams comes next, the exact bags last.

The notices under their sizes are broadcast up to ``broadcast_rows`` rows, else joined by shuffle; the result is the same.
Texts never travel: a passage that matches is a row with the key of its document.

``anywhere=True`` looks at every run of words of a text instead, whatever its lines, so a notice inside of a line or of running
prose is found as well: the best Dice of all runs, exactly. A best run starts and ends with a bigram of the notice, so only
the places of such bigrams are looked at, and only where enough of them lie close to each other to reach the limit. Notices that
differ by a name or a number fit the same run, so a run counts for the license that fits it best. SPDX identifiers count as well. That is
an Arrow UDF over each row by itself; the notices go with it, and nothing is shuffled. It is used with ``full_notices()``, the
short notices with the license texts and file headers of ``licenses/``.

Defined results: NULL and empty texts have no license; a passage of one word has no bigrams and matches nothing; the best
notice of a document is that with the highest Dice, then by name; equal rows get equal results; empty tables are allowed.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key

# License names and the wording of their usual notices.
NOTICES = (
    ("All-Rights-Reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_WORD = r"[\p{L}\p{N}]+"
_PYTHON_WORD = re.compile(r"[^\W_]+")
#: An identifier line: names joined by AND, OR and WITH, up to what cannot belong to it.
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*((?:\([ \t]*)*[A-Za-z0-9.+-]+(?:[ \t)]+(?:AND|OR|WITH)[ \t(]+[A-Za-z0-9.+-]+)*)")
_FOUND = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64())]))


def full_notices() -> tuple[tuple[str, str], ...]:
    """``NOTICES`` and the texts of ``licenses/``: whole licenses, and headers of source files (``name+variant.txt``)."""
    files = sorted((Path(__file__).parent / "licenses").glob("*.txt"))
    return (*NOTICES, *((f.stem.split("+")[0], f.read_text(encoding="utf-8")) for f in files))


def _bigrams(text: Column) -> Column:
    """The bigrams of a text in order, as hashes."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))

    def pairs(w: Column) -> Column:
        return F.when(
            F.size(w) > 1, F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))
        ).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(words), pairs), F.lit(0))


def _numbered(grams: Column) -> Column:
    """A bag as a set: each bigram with the number of equal ones before it. For short passages."""
    return F.transform(
        grams, lambda g, i: F.xxhash64(g, F.size(F.filter(F.slice(grams, 1, i), lambda x: x == g)))
    )


def admissible(size: int, limit: float) -> range:
    """The sizes of bags that can reach ``limit`` against one of ``size``."""
    low, high = size * limit / (2 - limit), size * (2 - limit) / limit
    return range(max(1, math.ceil(low - 1e-9)), math.floor(high + 1e-9) + 1)


def license_matches(
    parts: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, limit: float = 0.8, broadcast_rows: int = 200_000
) -> DataFrame:
    """(k1, k2, license, dice): per document (id, text) and license the best passage that reaches the limit."""
    spark = parts.sparkSession
    sized = [(name, text, n) for name, text in notices for n in admissible(len(re.findall(r"[^\W_]+", text)) - 1, limit)]
    sizes = [n for _, _, n in sized]
    entered = spark.createDataFrame(sized, "license string, notice string, n int").withColumn("grams_b", _bigrams(F.col("notice")))
    entered = entered.select("license", "n", "grams_b", _numbered(F.col("grams_b")).alias("bag_b"))
    if len(sized) <= broadcast_rows:
        entered = F.broadcast(entered)
    whole = F.coalesce("text", F.lit(""))
    passages = F.array_distinct(F.concat(F.split(whole, "\n", -1), F.split(whole, r"\n[ \t\r]*\n", -1), F.array(whole)))
    counted = F.filter(
        F.transform(passages, lambda x: F.struct(x.alias("x"), (F.regexp_count(x, F.lit(_WORD)) - 1).alias("n"))),
        lambda s: s.n.between(min(sizes, default=1), max(sizes, default=0)),
    )
    rows = parts.select(*row_key(F.col("id"), F.col("text")), F.explode(counted).alias("p")).select("k1", "k2", "p.x", "p.n")
    near = rows.withColumn("grams", _bigrams(F.col("x"))).drop("x").join(entered, "n")
    near = near.withColumn("common", F.size(F.array_intersect("grams", "grams_b")))
    spare = F.least(F.size("grams") - F.size(F.array_distinct("grams")), F.size("grams_b") - F.size(F.array_distinct("grams_b")))
    near = near.where(2 * (F.col("common") + spare) >= limit * (F.size("grams") + F.size("grams_b")))
    common = F.size(F.array_intersect(_numbered(F.col("grams")), F.col("bag_b")))
    dice = 2 * common / (F.size("grams") + F.size("grams_b"))
    return (
        near.select("k1", "k2", "license", dice.alias("dice")).where(F.col("dice") >= limit)
        .groupBy("k1", "k2", "license").agg(F.max("dice").alias("dice"))
    )


class Finder:
    """The best run of words of a text for each notice. ``limit`` is above 0."""

    def __init__(self, notices: tuple[tuple[str, str], ...], limit: float) -> None:
        self.limit = limit
        bags = [(name, _PYTHON_WORD.findall(text.lower())) for name, text in notices]
        bags = [(name, w) for name, w in bags if len(w) > 1]
        self.words: dict[str, int] = {}
        for _, w in bags:
            for x in w:
                self.words.setdefault(x, len(self.words) + 1)
        self.base = len(self.words) + 1
        codes = [self._codes(w)[0] for _, w in bags]
        self.grams = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
        self.names = [name for name, _ in bags]
        self.sizes = [len(c) for c in codes]
        #: how often each bigram is in each notice
        self.counts = np.zeros((len(self.grams), len(bags)), np.int32)
        for i, c in enumerate(codes):
            found, n = np.unique(c, return_counts=True)
            self.counts[np.searchsorted(self.grams, found), i] = n
        self.held = self.counts > 0
        #: the fewest common bigrams that reach the limit
        self.least = np.array([max(1, math.ceil(n * limit / (2 - limit) - 1e-9)) for n in self.sizes], np.int64)

    def _codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A number for each pair of neighbours, and which pairs consist of known words."""
        ids = np.fromiter((self.words.get(x, 0) for x in words), np.int64, len(words))
        return ids[:-1] * self.base + ids[1:], (ids[:-1] > 0) & (ids[1:] > 0)

    def found(self, text: str | None) -> dict[str, float]:
        """license -> best Dice, of those that reach the limit with a run that fits no other license better."""
        if not text or not len(self.grams):
            return {}
        words = _PYTHON_WORD.findall(text.lower())
        if len(words) < 2:
            return {}
        codes, known = self._codes(words)
        places = np.flatnonzero(known)
        index = np.searchsorted(self.grams, codes[places])
        hit = index < len(self.grams)
        hit[hit] = self.grams[index[hit]] == codes[places[hit]]
        places, index = places[hit], index[hit]
        if len(places) < self.least.min():
            return {}
        totals = self.held[index].sum(axis=0)
        best, own = {}, {}
        for i in np.flatnonzero(totals >= self.least).tolist():
            mask = self.held[index, i]
            run = self._best(places[mask], index[mask], i)
            if run:
                best[i], own[i] = run, (places[mask], index[mask])
        if len({self.names[i] for i in best}) > 1:
            runs = {i: self._runs(*own[i], i, best[i]) for i in best}
            best = {i: run for i in best if (run := self._unbeaten(i, runs))}
        out: dict[str, float] = {}
        for i, run in best.items():
            out[self.names[i]] = max(run[0], out.get(self.names[i], 0.0))
        return out

    def _unbeaten(self, i: int, runs: dict[int, list[tuple[float, int, int]]]) -> tuple[float, int, int] | None:
        """The best run of a notice that no notice of another license fits better. Ties go to the longer notice, then by name.

        A run is beaten by one that covers more than half of it, which therefore holds its middle.
        """
        rivals = [(j, [r[1] for r in runs[j]]) for j in runs if self.names[j] != self.names[i]]
        for dice, first, last in sorted(runs[i], key=lambda r: (-r[0], r[1])):
            for j, firsts in rivals:
                k = bisect_right(firsts, (first + last + 1) // 2) - 1
                if k < 0:
                    continue
                other, a, b = runs[j][k]
                covered = min(b, last) - max(a, first) + 1
                mine, theirs = (-dice, -self.sizes[i], self.names[i]), (-other, -self.sizes[j], self.names[j])
                if 2 * covered > last - first + 1 and theirs < mine:
                    break
            else:
                return dice, first, last
        return None

    def _runs(self, places: np.ndarray, grams: np.ndarray, i: int, best: tuple[float, int, int]) -> list[tuple[float, int, int]]:
        """Runs of a notice that reach the limit and do not overlap, in order: the best one, and those left and right of it."""
        reach = math.floor(self.sizes[i] * (2 - self.limit) / self.limit + 1e-9)
        out = [best]
        parts = [(0, int(np.searchsorted(places, best[1]))), (int(np.searchsorted(places, best[2], "right")), len(places))]
        while parts:
            a, b = parts.pop()
            if b - a < self.least[i]:
                continue
            # runs that start within one reach of the first place end within two
            until = places[a] + reach
            c = min(b, int(np.searchsorted(places, until + reach)))
            run = self._best(places[a:c], grams[a:c], i, until)
            if run is None:
                parts.append((int(np.searchsorted(places, until, "right")), b))
                continue
            out.append(run)
            parts.append((int(np.searchsorted(places, run[2], "right")), b))
            parts.append((a, int(np.searchsorted(places, run[1]))))
        return sorted(out, key=lambda r: r[1])

    def _best(self, places: np.ndarray, grams: np.ndarray, i: int, until: int | None = None) -> tuple[float, int, int] | None:
        """(dice, first bigram, last bigram) of the best run, if it reaches the limit; of those that start up to ``until``."""
        size, least = self.sizes[i], int(self.least[i])
        longest = math.floor(size * (2 - self.limit) / self.limit + 1e-9)
        if len(places) < least:
            return None
        starts = np.flatnonzero(places[least - 1 :] - places[: len(places) - least + 1] < longest)
        if until is not None:
            starts = starts[places[starts] <= until]
        if not len(starts):
            return None
        # a bigram counts in runs that start after the place where the notice would have one less of it
        order = np.argsort(grams, kind="stable")
        ordered, earlier = grams[order], np.arange(len(order)) - self.counts[grams[order], i]
        same = (earlier >= 0) & (ordered[earlier] == ordered)
        after = np.full(len(order), -1, np.int64)
        after[order[same]] = places[order[earlier[same]]]
        ends = np.searchsorted(places, places[starts] + longest)

        best = (0.0, 0, 0)

        def of_start(f: int, l: int) -> float:
            """The best Dice of a start, over the ends of all starts up to ``l``: runs beyond its own ends miss the limit."""
            nonlocal best
            a, b = starts[f], ends[l - 1]
            dice = 2 * np.cumsum(after[a:b] < places[a]) / (places[a:b] - places[a] + 1 + size)
            k = int(dice.argmax())
            if dice[k] > best[0]:
                best = (float(dice[k]), int(places[a]), int(places[a + k]))
            return float(dice[k])

        def bounded(dice: float, f: int, l: int) -> tuple[float, int, int, float]:
            # A run that starts g places later shares no more with the notice and is shorter by g, so its Dice is higher by a
            # factor of 1 + g / (its length + size) at most. That bounds all starts that lie close together by the first.
            return -dice * (1 + (places[starts[l - 1]] - places[starts[f]]) / (size + least)), f, l, dice

        block = (places[starts] - places[starts[0]]) // max(1, size // 32)
        edges = [*np.flatnonzero(np.r_[True, block[1:] != block[:-1]]).tolist(), len(starts)]
        heap = [bounded(of_start(f, l), f, l) for f, l in zip(edges, edges[1:])]
        heapify(heap)
        while heap:
            bound, f, l, dice = heappop(heap)
            if 1e-9 - bound < max(best[0], self.limit) or best[0] == 1.0:
                break
            if l - f > 1:
                half = (f + l) // 2
                heappush(heap, bounded(dice, f, half))
                heappush(heap, bounded(of_start(half, l), half, l))
        return best if best[0] >= self.limit else None


def identified(text: str | None) -> set[str]:
    """The licenses of SPDX lines, under the names of ``NOTICES``: without ``-only``, ``-or-later`` and ``+``, BSD as one."""
    names = set()
    for line in _SPDX.findall(text or ""):
        for name in re.sub(r"\bWITH\s+\S+", "", line).replace("(", " ").replace(")", " ").split():
            if name not in ("AND", "OR"):
                base = re.sub(r"(-only|-or-later|\+)$", "", name)
                names.add("BSD" if re.match(r"(?:0?BSD|BSD-\d-Clause\b.*)$", base) else base)
    return names


def scan_licenses(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", notices: tuple[tuple[str, str], ...] = NOTICES, limit: float = 0.8,
    anywhere: bool = False,
) -> DataFrame:
    """One row per document: id, license (the best, or NULL), dice and n_licenses."""
    parts = docs.select(docs[id_col].alias("id"), docs[text].alias("text"))
    if anywhere:
        finder = Finder(notices, limit)

        @F.arrow_udf("array<struct<license:string,dice:double>>")
        def all_found(texts: pa.Array) -> pa.Array:
            # an identifier is exact, whatever a notice of the same license reaches
            rows = (finder.found(x) | dict.fromkeys(identified(x), 1.0) for x in (t.as_py() for t in texts))
            return pa.array([[{"license": k, "dice": v} for k, v in r.items()] for r in rows], type=_FOUND)

        less = F.array_min(F.transform("found", lambda x: F.struct((-x.dice).alias("less"), x.license.alias("license"))))
        best = parts.select("id", all_found("text").alias("found")).select("id", F.size("found").cast("long").alias("n_licenses"), less.alias("m"))
        return best.select(F.col("id").alias(id_col), "m.license", (-F.col("m.less")).alias("dice"), "n_licenses")
    found = license_matches(parts, notices, limit).groupBy("k1", "k2").agg(
        F.min(F.struct((-F.col("dice")).alias("less"), "license")).alias("m"), F.count("*").alias("n_licenses")
    )
    rows = parts.select("id", *row_key(F.col("id"), F.col("text")))
    return rows.join(found, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), "m.license", (-F.col("m.less")).alias("dice"),
        F.coalesce("n_licenses", F.lit(0).cast("long")).alias("n_licenses"),
    )
