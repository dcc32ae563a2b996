"""Benchmark decontamination by template windows.

Numbers, names and units become typed placeholders, so that a question with other figures or other names keeps its
template. Windows of ``window`` template tokens of all documents are hash-joined with those of the benchmark. A matched
window carries the values of its slots on both sides; along one alignment of an item in a document, a value of the item
must stand for one value of the document: the one that it meets most often. Windows whose slots say otherwise do not
count, windows without slots always do. A document is contaminated by an item if the windows that count cover
``coverage`` of the windows of the item, or if ``verbatim`` tokens of it or more follow each other word for word.

Names are capitalised words inside of a sentence (upper case, then lower case). The items are also entered with their
names as plain words, for texts that lost their case. Numbers have digits, and a unit is a word of ``UNITS`` after a number.
The template of a window with fewer than ``literals`` plain words says too little, so such a window is matched by its exact
values instead. An item may be covered by all its windows, or by its templates alone where these are
``least_share`` of its windows that count.

The windows of the benchmark are broadcast up to ``broadcast_rows`` of them, a few dozen bytes each, and their hashes go
to the Python workers, which hash the windows of documents and return those that match. A larger benchmark is joined by
shuffle, with the same result.

Defined results: NULL and empty texts match nothing; NULL or empty items are no items; an item shorter than a window is
one window of all its tokens, and matches these tokens anywhere in a text, were it a single word; items with equal texts all match; documents with
equal id and text get equal results; empty tables give no matches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, stored, whole_row

# Words that are units after a number.
UNITS = (
    "percent mm cm m km mi miles inches feet ft yards mg g kg lb lbs pounds ounces tons ml l liters litres gallons ms s sec "
    "seconds min minutes h hours days weeks months years dollars cents euros usd eur kb mb gb tb bytes hz khz mhz ghz w kw "
    "kwh volts amps degrees celsius kelvin mph kmh people students items"
).split()

#: tokens whose windows are hashed together
AT_A_TIME = 250_000

# Markers put before the value of a slot, and the sign inside of a number.
NAME, NUMBER, UNIT, INSIDE = "\u0001", "\u0002", "\u0003", "\u0004"


@dataclass(frozen=True)
class Templates:
    window: int = 5
    literals: int = 3
    coverage: float = 0.5
    least_share: float = 0.3
    verbatim: int = 50
    broadcast_rows: int = 2_000_000


def marked_text(text: Column, names: bool = True) -> Column:
    """Lower-case text with a marker before the value of each slot."""
    raw = F.coalesce(text, F.lit(""))
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    joined = F.regexp_replace(raw, r"(?<=\d)[.,:/](?=\d)", INSIDE)
    numbers = F.regexp_replace(
        joined, rf"(?<![\p{{L}}\d{INSIDE}])(\d[\d{INSIDE}]*)(?: ?((?i:{units})|%)(?![\p{{L}}\d]))?", f" {NUMBER}$1 {UNIT}$2 "
    )
    numbers = F.replace(numbers, F.lit(UNIT + " "), F.lit(""))
    marked = F.when(raw.rlike(r"\d"), numbers).otherwise(raw)
    # the blank comes first in the pattern, so that only blanks are looked at twice
    return F.lower(F.regexp_replace(marked, r" (?<=[\p{Ll},;] )(?=\p{Lu}\p{Ll})", " " + NAME) if names else marked)


def _split(marked: Column) -> Column:
    return F.split(marked, rf"[^\p{{L}}\p{{M}}\p{{N}}{NAME}-{INSIDE}]+")


def _full(parts: Column) -> Column:
    """Without the empty parts, which are at the ends only."""
    start = F.when(F.get(parts, F.lit(0)) == "", 2).otherwise(1)
    n = F.size(parts) - start + 1 - F.when(F.get(parts, F.size(parts) - 1) == "", 1).otherwise(0)
    return F.slice(parts, start, F.greatest(n, F.lit(0)))


def template_tokens(text: Column, names: bool = True) -> Column:
    """Lower-case tokens; those of slots start with their marker, followed by the value."""
    return F.get(F.transform(F.array(_split(marked_text(text, names))), _full), F.lit(0))


def _is_slot(token: Column) -> Column:
    return token < INSIDE


def _codes(tokens: Column, slotted: Column) -> Column:
    """A number per token; its last two bits are 0, or tell the kind of a slot, which is its marker."""
    plain = lambda t: F.xxhash64(t).bitwiseAND(F.lit(-4))
    kind = lambda t: F.when(_is_slot(t), F.ascii(t)).otherwise(0).cast("long")
    return F.when(slotted, F.transform(tokens, lambda t: plain(t).bitwiseOR(kind(t)))).otherwise(F.transform(tokens, plain))


def _mixed(seed: int, parts: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(parts[0]), seed, np.uint64)
    for x in parts:
        out = (out ^ x) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def window_hashes(codes: np.ndarray, stops: np.ndarray, length: int, literals: int) -> tuple[np.ndarray, ...]:
    """(start, hash, slots, exact) of the windows of ``length`` tokens inside of texts that end at ``stops``."""
    codes = codes.view(np.uint64)
    inside = np.ones(max(len(codes) - length + 1, 0), bool)
    for k in range(1, length):
        late = stops - k
        inside[late[(late >= 0) & (late < len(inside))]] = False
    start = np.flatnonzero(inside)
    kinds = codes & np.uint64(3)
    templates = np.where(kinds > 0, kinds, codes)
    slots = (kinds > 0).astype(np.int32)
    n_slots = sum(slots[start + k] for k in range(length))
    hashes = _mixed(length, [templates[start + k] for k in range(length)])
    # a window with too few plain words is known by its exact values
    exact = (n_slots > 0) & (length - n_slots < min(literals, length))
    at = start[exact]
    hashes[exact] = _mixed(length + 64, [codes[at + k] for k in range(length)]) if len(at) else 0
    return start, hashes, n_slots, exact


def _windows_udf(p: Templates, short: tuple[int, ...], known: np.ndarray | None, whole: bool):
    """All windows of each text, or those with a hash in ``known``; with ``whole`` a text shorter than a window is one."""
    # a table of the first bits of the known hashes leaves few windows to look up
    first = np.zeros(1 << 16, bool)
    if known is not None:
        first[known.view(np.uint64) >> np.uint64(48)] = True

    def of(arrays: pa.Array) -> pa.Array:
        codes = arrays.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(arrays.offsets.to_numpy(zero_copy_only=False))
        stops = np.cumsum(sizes, dtype=np.int64)
        rows = []
        for length in (*range(1, p.window), p.window) if whole else (p.window, *short):
            start, hashes, n_slots, exact = window_hashes(codes, stops, length, p.literals)
            text = np.searchsorted(stops, start, side="right")
            if known is not None:
                keep = np.flatnonzero(first[hashes.view(np.uint64) >> np.uint64(48)])
                keep = keep[np.isin(hashes[keep], known)]
            elif whole and length < p.window:
                keep = np.flatnonzero(sizes[text] == length)
            else:
                keep = slice(None)
            parts = (text, start - (stops - sizes)[text], hashes, n_slots, exact, np.full(len(start), length))
            rows.append([x[keep] for x in parts])
        text, pos, hashes, n_slots, exact, length = (np.concatenate(x) for x in zip(*rows))
        order = np.lexsort((pos, text))
        fields = [pa.array(x[order].astype(t)) for x, t in ((pos, np.int32), (hashes, np.int64), (n_slots, np.int32), (exact, bool), (length, np.int32))]
        ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(arrays)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["pos", "hash", "n_slots", "exact", "length"]))

    @F.arrow_udf("array<struct<pos:int,hash:bigint,n_slots:int,exact:boolean,length:int>>")
    def found(arrays: pa.Array) -> pa.Array:
        # some texts at a time, as each token takes several numbers here
        ends = arrays.offsets.to_numpy(zero_copy_only=False)
        starts = np.unique(np.searchsorted(ends, np.arange(ends[0], ends[-1] + 1, AT_A_TIME))).tolist() or [0]
        return pa.concat_arrays([of(arrays.slice(a, b - a)) for a, b in zip([0, *starts[1:]], [*starts[1:], len(arrays)])])

    return found


def windows(
    texts: DataFrame, keep: list[str], p: Templates, benchmark: bool, names: bool = True, short: tuple[int, ...] = (),
    known: np.ndarray | None = None,
) -> DataFrame:
    """One row per window of ``text``: the columns ``keep``, pos, hash and the slots of the window in order.

    Of the benchmark, also n_tokens and whether the hash is that of the exact values; an item shorter than a window is
    one. Of documents, windows of the lengths ``short`` are added, and with ``known`` only windows with a hash in it are made.
    """

    def tokens(df: DataFrame) -> DataFrame:
        marked = df.withColumn("marked", marked_text(F.col("text"), names))
        slotted = F.col("marked").contains(NAME) | F.col("marked").contains(NUMBER)
        parts = marked.withColumns({"parts": _split(F.col("marked")), "slotted": slotted})
        return parts.withColumn("tokens", _full(F.col("parts")))

    # as if not deterministic, or the filter on what it finds would have it run twice
    find = _windows_udf(p, short, known, benchmark).asNondeterministic()
    coded = tokens(texts).select(*keep, "text", _codes(F.col("tokens"), F.col("slotted")).alias("codes"))
    found = coded.select(*keep, "text", find("codes").alias("found")).where(F.size("found") > 0)
    # tokens are made again, of texts with a window only, as they would cost more to keep
    again = tokens(found).withColumn("n_tokens", F.size("tokens"))

    def with_slots(x: Column) -> Column:
        slots = F.filter(F.slice("tokens", x.pos + 1, x.length), _is_slot)
        own = F.when((x.n_slots > 0) & ~x.exact, slots).otherwise(F.array().cast("array<string>"))
        return F.struct(x.pos.alias("pos"), x.hash.alias("hash"), x.exact.alias("exact"), own.alias("slots"))

    x = again.select(*keep, "n_tokens", F.explode(F.transform("found", with_slots)).alias("x"))
    return x.select(*keep, *(["n_tokens", "x.exact"] if benchmark else []), "x.pos", "x.hash", "x.slots")


def leaks(docs: DataFrame, items: DataFrame, p: Templates = Templates()) -> DataFrame:
    """(k1, k2, item_id, covered, windows, changed) for documents (id, text) that hold an item (item_id, text).

    ``changed`` says that some slot has another value than in the benchmark.
    """
    known = items.select("item_id", "text")
    both = [windows(known, ["item_id"], p, True, names) for names in (True, False)]
    theirs = stored(both[0].unionByName(both[1]).distinct().withColumnRenamed("slots", "item_slots"), "benchmark")
    # windows by their template alone, and all windows: whichever share is larger counts
    templates = F.count_distinct(F.when(~F.col("exact"), F.col("pos")))
    sizes = theirs.groupBy("item_id").agg(templates.alias("templates"), F.count_distinct("pos").alias("all_windows"))
    side = theirs.select("item_id", F.col("pos").alias("item_pos"), F.col("hash").alias("item_hash"), "item_slots", "exact")
    short = tuple(sorted(r.n_tokens for r in theirs.where(F.col("n_tokens") < p.window).select("n_tokens").distinct().collect()))
    known = None
    if theirs.count() <= p.broadcast_rows:
        side = F.broadcast(side)
        known = np.sort(np.array([r.hash for r in theirs.select("hash").distinct().collect()], np.int64))
    ours = windows(docs.select(*row_key(F.col("id"), F.col("text")), "text"), ["k1", "k2"], p, False, short=short, known=known)
    hits = (
        ours.join(side, F.col("hash") == F.col("item_hash"))
        .where(F.size("slots") == F.size("item_slots"))
    )
    # one row per item window and alignment, so a group is never longer than its item
    aligned = (
        hits.groupBy("k1", "k2", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos")
        .agg(F.max(F.struct("item_slots", "slots")).alias("s"), F.min("exact").alias("exact"))
        .groupBy("k1", "k2", "item_id", "shift")
        .agg(F.collect_list(F.struct("item_pos", "exact", F.arrays_zip("s.item_slots", "s.slots").alias("pairs"))).alias("hit"))
    )
    pairs = aligned.withColumn("pairs", F.flatten(F.transform("hit", lambda h: h.pairs)))

    def bound(name: Column) -> Column:
        """What a value of the item stands for: the value it meets most often, on a tie itself, then the last one."""
        own = F.filter("pairs", lambda x: x.item_slots == name)
        times = lambda v: F.size(F.filter(own, lambda x: x.slots == v))
        met = F.array_distinct(F.transform(own, lambda x: x.slots))
        best = F.array_max(F.transform(met, lambda v: F.struct(times(v).alias("n"), (v == name).alias("same"), v.alias("v"))))
        return F.struct(name, best.v)

    names = F.array_distinct(F.transform("pairs", lambda x: x.item_slots))
    with_binding = pairs.withColumn("binding", F.map_from_entries(F.transform(names, bound)))
    counted = F.filter("hit", lambda h: F.forall(h.pairs, lambda x: F.element_at("binding", x.item_slots) == x.slots))
    kept = with_binding.withColumn("hit", counted).where(F.size("hit") > 0)
    # windows in a row have one difference of place and number
    same = F.filter("hit", lambda h: F.forall(h.pairs, lambda x: x.item_slots == x.slots))
    rows = F.transform(F.array_sort(F.transform(same, lambda h: h.item_pos)), lambda x, i: x - i)
    longest = F.array_max(F.transform(F.array_distinct("rows"), lambda r: F.size(F.filter("rows", lambda x: x == r))))
    consistent = kept.withColumn("rows", rows).select(
        "k1", "k2", "item_id", F.exists("hit", lambda h: F.exists(h.pairs, lambda x: x.item_slots != x.slots)).alias("changed"),
        F.coalesce(longest, F.lit(0)).alias("in_a_row"), F.explode("hit").alias("hit"),
    )
    covered = consistent.groupBy("k1", "k2", "item_id").agg(
        F.count_distinct(F.when(~F.col("hit.exact"), F.col("hit.item_pos"))).alias("c_templates"),
        F.count_distinct("hit.item_pos").alias("c_all"), F.max("changed").alias("changed"), F.max("in_a_row").alias("in_a_row"),
    )
    joined = covered.withColumnRenamed("item_id", "hit_item").join(sizes, F.col("hit_item").eqNullSafe(F.col("item_id")))
    by_template = F.col("c_templates") * F.col("all_windows") >= F.col("c_all") * F.col("templates")
    by_template = (F.col("templates") > 0) & by_template & (F.col("c_all") >= F.col("all_windows") * p.least_share)
    best = joined.withColumns({
        "covered": F.when(by_template, F.col("c_templates")).otherwise(F.col("c_all")),
        "windows": F.when(by_template, F.col("templates")).otherwise(F.col("all_windows")),
    })
    verbatim = (F.col("in_a_row") > 0) & (F.col("in_a_row") + p.window - 1 >= p.verbatim)
    return best.where((F.col("covered") >= F.col("windows") * p.coverage) | verbatim).select(
        "k1", "k2", "item_id", "covered", "windows", "changed"
    )


def _inputs(docs: DataFrame, items: DataFrame, text: str, id_col: str, item_text: str, item_id: str):
    return (
        docs.select(docs[id_col].alias("id"), docs[text].alias("text")),
        items.select(items[item_id].alias("item_id"), items[item_text].alias("text")),
    )


def decontamination(
    docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text",
    item_id: str = "item_id", p: Templates = Templates(),
) -> DataFrame:
    """One row per document: id, contaminated, kept, n_items, and of the item covered best: item_id, coverage, changed."""
    parts, theirs = _inputs(docs, items, text, id_col, item_text, item_id)
    best = leaks(parts, theirs, p).groupBy("k1", "k2").agg(
        F.count("*").alias("n_items"),
        F.max_by(F.struct("item_id", "covered", "windows", "changed"), F.struct(F.col("covered") / F.col("windows"), -F.col("item_id"))).alias("b"),
    )
    rows = parts.select("id", *row_key(F.col("id"), F.col("text")))
    return rows.join(best, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        F.col("n_items").isNotNull().alias("contaminated"),
        F.col("n_items").isNull().alias("kept"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        "b.item_id",
        (F.col("b.covered") / F.col("b.windows")).alias("coverage"),
        F.coalesce("b.changed", F.lit(False)).alias("changed"),
    )


def without_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text",
    item_id: str = "item_id", p: Templates = Templates(),
) -> DataFrame:
    """The documents that hold no item, with the columns of ``docs``."""
    parts, theirs = _inputs(docs, items, text, id_col, item_text, item_id)
    bad = leaks(parts, theirs, p).select("k1", "k2").distinct()
    keyed = docs.select(whole_row(docs).alias("doc"), *row_key(docs[id_col], docs[text]))
    return keyed.join(bad, ["k1", "k2"], "left_anti").select("doc.*")
