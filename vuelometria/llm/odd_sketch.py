"""MinHash near copies with odd sketches.

1. Each text becomes its set of distinct word shingles (hashes of 64 bits). Equal sets form a class; only classes go on.
2. Each class gets ``samples`` MinHash values. Groups of ``rows`` values are band keys; all values are folded into an odd
   sketch, a bitmap in which each value flips one bit. The XOR of two bitmaps counts the values that differ, which tells
   high similarities apart more sharply than the values themselves do in the same space.
3. In each bucket of a band, every class is paired with one centre, the class with most documents, not with all others.
   Pairs whose sketches are far apart are dropped (``sigmas`` standard deviations below the limit), the rest are checked
   on the full sets. Linked classes are joined into components.
4. Buckets whose other classes are still in more than one component are compared in blocks of about ``block`` shingles:
   sketches first, then the full sets, and a link goes out only if it joins two components. So no link inside of a bucket
   is lost, a large bucket is many tasks of bounded size, and no task gives more rows than it has classes.

Missed pairs: with 24 bands of 4 a pair of similarity 0.8 shares no bucket with a chance of 3 in a million.

Defined results: NULL texts and texts without words have no shingles, are linked with nothing and are components of
their own; texts shorter than a shingle are one shingle; a NULL id takes part but is the smallest of a component only if
all ids there are NULL; rows with equal id and text are one document; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, row_key, stored, whole_row, words
from .components import connected_components

SALTS = 16


@dataclass(frozen=True)
class NearCopies:
    shingle: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 4
    samples: int = 128
    bits: int = 512
    sigmas: float = 5.0
    block: int = 400_000

    def most_bits(self) -> int:
        """The XOR count that a pair at the limit exceeds with next to no chance."""
        j, k, n = self.percent / 100, self.samples, self.bits
        differ = k * (1 - j) + self.sigmas * math.sqrt(k * j * (1 - j))
        expected = n / 2 * (1 - math.exp(-4 * differ / n))
        return math.ceil(expected + self.sigmas / 2 * math.sqrt(n / 4 * (1 - math.exp(-8 * differ / n))))


def shingle_set(text: Column, size: int) -> Column:
    """The distinct shingles of a text as hashes; all words as one where there are fewer than ``size``."""
    hashes = F.transform(words(text, lower=True), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])
        )
        return (
            F.when(F.size(h) >= size, F.array_distinct(runs))
            .when(F.size(h) > 0, F.array(F.xxhash64(h)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return F.get(F.transform(F.array(hashes), shingles), F.lit(0))


def _mix(x: np.ndarray, odd: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(odd)
    return x ^ (x >> np.uint64(29))


def signature_udf(p: NearCopies):
    """Shingle sets to (class key, odd sketch, band keys), all sets of a batch at once."""
    draw = np.random.default_rng(20240229)
    factors = draw.integers(1, 2**32, p.samples, dtype=np.uint32) | np.uint32(1)
    shifts = draw.integers(0, 2**32, p.samples, dtype=np.uint32)

    def lists(rows: np.ndarray) -> pa.Array:
        flat = pa.array(np.ascontiguousarray(rows).reshape(-1))
        return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), flat)

    def sketch(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class keys, odd sketches and band keys of some sets, which stand one after the other in ``values``."""
        full = np.flatnonzero(sizes)  # reduceat must not see empty sets
        starts = (np.cumsum(sizes) - sizes)[full].astype(np.int64)
        n = len(sizes)
        low = _mix(values, 0xFF51AFD7ED558CCD).astype(np.uint32)
        least = np.zeros((n, p.samples), dtype=np.uint32)
        for i in range(p.samples if len(full) else 0):
            x = low * factors[i] + shifts[i]
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            x ^= x >> np.uint32(13)
            least[full, i] = np.minimum.reduceat(x, starts)
        places = _mix(least.astype(np.uint64) + (np.arange(p.samples, dtype=np.uint64) << np.uint64(32)), 0xC4CEB9FE1A85EC53)
        parity = np.zeros((n, p.bits), dtype=np.uint8)
        every = np.arange(n)
        for i in range(p.samples):
            parity[every, (places[:, i] % np.uint64(p.bits)).astype(np.int64)] ^= 1
        keys = np.empty((n, p.bands), dtype=np.uint64)
        for b in range(p.bands):
            key = np.full(n, b + 1, dtype=np.uint64)
            for i in range(b * p.rows, (b + 1) * p.rows):
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + least[:, i], 0xBF58476D1CE4E5B9)
            keys[:, b] = key
        halves = np.zeros((n, 2), dtype=np.uint64)
        for i, odd in enumerate((0x94D049BB133111EB, 0xD6E8FEB86659FD93)):
            if len(full):
                halves[full, i] = np.add.reduceat(_mix(values, odd), starts)
        return halves, np.packbits(parity, axis=1).view(np.int64), keys.view(np.int64)

    @F.arrow_udf("struct<node:binary,sketch:array<bigint>,bands:array<bigint>>")
    def signature(sets: pa.Array) -> pa.Array:
        values = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        sizes = sets.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        # some hundred thousand shingles at a time, so that a batch of long texts takes no more memory than others
        parts, row = [] if len(sizes) else [sketch(values, sizes)], 0
        while row < len(sizes):
            begin = int(ends[row] - sizes[row])
            to = max(row + 1, int(np.searchsorted(ends, begin + 250_000, side="right")))
            parts.append(sketch(values[begin : int(ends[to - 1])], sizes[row:to]))
            row = to
        halves, sketches, keys = (np.concatenate(x) for x in zip(*parts))
        node = pa.array([x.tobytes() if size else None for x, size in zip(halves, sizes)], type=pa.binary())
        return pa.StructArray.from_arrays([node, lists(sketches), lists(keys)], ["node", "sketch", "bands"])

    return signature


def _documents(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("id"), docs[text].alias("text"))


def signatures(parts: DataFrame, p: NearCopies) -> DataFrame:
    """One stored row per document (id, text): row key, set size, class key (NULL without shingles), sketch and bands."""
    sized = parts.select(
        "id", *row_key(F.col("id"), F.col("text")), shingle_set(F.col("text"), p.shingle).alias("set")
    ).withColumn("n_shingles", F.size("set").cast("long"))
    signed = sized.withColumn("s", signature_udf(p)("set"))
    return stored(signed.select("id", "k1", "k2", "n_shingles", "s.node", "s.sketch", "s.bands"), "signatures")


def _verified(pairs: DataFrame, sets: DataFrame, p: NearCopies) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    return both.where(100 * F.col("common") >= p.percent * union).select("a", "b")


def _close(a: Column, b: Column, p: NearCopies) -> Column:
    """Whether two sketches are near enough for a check on the full sets."""
    differ = [F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(p.bits // 64)]
    return sum(differ[1:], differ[0]) <= p.most_bits()


def _sketch_pairs(pairs: DataFrame, classes: DataFrame, p: NearCopies) -> DataFrame:
    left = classes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"), F.col("n_shingles").alias("n_a"))
    right = classes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"), F.col("n_shingles").alias("n_b"))
    joined = pairs.join(left, "a").join(right, "b")
    fits = 100 * F.least("n_a", "n_b") >= p.percent * F.greatest("n_a", "n_b")
    return joined.where(fits & _close(F.col("sketch_a"), F.col("sketch_b"), p)).select("a", "b")


def _salted(buckets: DataFrame, one_per_bucket: DataFrame) -> DataFrame:
    """Each row of ``buckets`` with the columns of its bucket; large buckets are spread by a salt."""
    copies = one_per_bucket.withColumnRenamed("bucket", "in_bucket").withColumn(
        "in_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    spread = buckets.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    met = spread.join(copies, (F.col("bucket") == F.col("in_bucket")) & (F.col("salt") == F.col("in_salt")))
    return met.drop("in_bucket", "in_salt", "salt")


def _compare_udf(p: NearCopies):
    """Compares two blocks of a bucket; gives exact links that join classes of different components."""
    most = p.most_bits()

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        # rows of the second block come last; within one block (x = y) each pair is met in both orders
        rows = rows.sort_values(["second", "node"]).drop_duplicates(["second", "node"])
        nodes, roots, second = rows["node"].to_numpy(), rows["root"].to_numpy(), rows["second"].to_numpy()
        sketches = np.stack(rows["sketch"].to_numpy()).view(np.uint64)
        bands = np.stack(rows["bands"].to_numpy())
        bucket = rows["bucket"].iloc[0]
        sets = rows["set"].to_numpy()
        sizes = np.array([len(x) for x in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        shingles, ids = np.unique(np.concatenate(sets), return_inverse=True)
        two_blocks = rows["x"].iloc[0] != rows["y"].iloc[0]
        top = {r: r for r in set(roots)}

        def root(r):
            while top[r] != r:
                top[r] = top[top[r]]
                r = top[r]
            return r

        found = []
        for i in range(len(nodes)):
            other = roots != roots[i]
            if two_blocks:
                other &= second != second[i]
            other &= np.bitwise_count(sketches ^ sketches[i]).sum(axis=1) <= most
            other &= 100 * np.minimum(sizes, sizes[i]) >= p.percent * np.maximum(sizes, sizes[i])
            if not other.any():
                continue
            # a pair that shares several buckets is met in the first of them
            other[other] = bands[i][(bands[other] == bands[i]).argmax(axis=1)] == bucket
            if not other.any():
                continue
            inside = np.zeros(len(shingles), dtype=np.int32)
            inside[ids[starts[i] : starts[i] + sizes[i]]] = 1
            shared = np.add.reduceat(inside[ids], starts)
            for j in np.flatnonzero(other & (100 * shared >= p.percent * (sizes + sizes[i] - shared))):
                a, b = root(roots[i]), root(roots[j])
                if a != b:
                    top[a] = b
                    found.append((nodes[i], nodes[j]))
        return pd.DataFrame(found, columns=["a", "b"])

    return compare


def _rest_links(open_ones: DataFrame, classes: DataFrame, sets: DataFrame, p: NearCopies) -> DataFrame:
    """Links between different components of a bucket (bucket, node, root), from exact comparison in blocks."""
    full = open_ones.join(classes.select("node", "n_shingles", "sketch", "bands"), "node")
    parts = full.groupBy("bucket").agg(F.ceil(F.sum("n_shingles") / p.block).cast("int").alias("parts"))
    placed = _salted(full, parts).withColumn("part", F.pmod(F.hash("node"), F.col("parts")).cast("int"))
    met = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.struct(F.least("part", o).alias("x"), F.greatest("part", o).alias("y")),
    )
    dealt = (
        placed.withColumn("pair", F.explode(met))
        .select("bucket", "node", "root", "sketch", "bands", "pair.x", "pair.y", (F.col("part") == F.col("pair.y")).alias("second"))
        .join(sets, "node")
    )
    return dealt.groupBy("bucket", "x", "y").applyInPandas(_compare_udf(p), "a binary, b binary").distinct()


def class_components(parts: DataFrame, p: NearCopies) -> tuple[DataFrame, DataFrame]:
    """Documents (id, k1, k2, n_shingles, node), and classes (node, root, first); first is that of the whole component.

    ``first`` has the smallest id (NULL last) and the row key of its document. Documents without shingles have no node.
    """
    signed = signatures(parts, p)
    classes = stored(
        signed.where("node is not null")
        .groupBy("node", "n_shingles", "sketch", "bands")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")).alias("first"), F.count("*").alias("copies")),
        "classes",
    )
    # classes that share no bucket with any other are done; the others go on as (bucket, node)
    exploded = classes.select("node", "copies", F.explode("bands").alias("bucket"))
    shared = (
        exploded.groupBy("bucket")
        .agg(F.max(F.struct("copies", "node")).alias("most"), F.min("node").alias("n1"), F.max("node").alias("n2"))
        .where("n1 <> n2")
        .select("bucket", F.col("most.node").alias("centre"))
    )
    buckets = stored(_salted(exploded, shared).select("bucket", "node", "centre").where("node <> centre"), "buckets")
    centred = buckets.select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    involved = buckets.select("node").unionByName(buckets.select(F.col("centre").alias("node"))).distinct()
    chosen = classes.join(involved, "node").select("node", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2"))
    keyed = parts.select("text", *row_key(F.col("id"), F.col("text")))
    sets = stored(
        keyed.join(chosen, (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")))
        .select("node", "text").dropDuplicates(["node"])
        .select("node", shingle_set(F.col("text"), p.shingle).alias("set")),
        "sets",
    )
    links = stored(_verified(_sketch_pairs(centred, classes, p), sets, p), "links")
    roots = stored(connected_components(links), "roots")
    placed = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("bucket").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("bucket")
    open_ones = stored(_salted(placed.drop("centre"), several), "open-buckets")
    if not open_ones.isEmpty():
        rest = stored(_rest_links(open_ones, classes, sets, p), "links")
        if not rest.isEmpty():
            spanning = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = stored(connected_components(spanning.unionByName(rest)), "roots")
    rooted = classes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    best = stored(rooted.groupBy("root").agg(F.min("first").alias("best")), "components")
    labels = rooted.drop("first").join(best.withColumnRenamed("root", "of_root"), F.col("root") == F.col("of_root"))
    return signed, stored(labels.select("node", "root", F.col("best").alias("first")), "labels")


def near_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", p: NearCopies = NearCopies()) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id (smallest id that can be reached) and kept."""
    signed, labels = class_components(_documents(docs, text, id_col), p)
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("first.id"))
    return signed.join(labels, "node", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def without_near_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", p: NearCopies = NearCopies()) -> DataFrame:
    """One document of each component, that with the smallest id, with the columns of ``docs``.

    Documents without shingles are no copies of each other and all stay.
    """
    _, labels = class_components(_documents(docs, text, id_col), p)
    winners = labels.select(F.col("first.k1").alias("w1"), F.col("first.k2").alias("w2")).distinct()
    keyed = docs.select(
        whole_row(docs).alias("doc"), *row_key(docs[id_col], docs[text]), docs[text].rlike(WORD).alias("has_words")
    )
    one = (
        keyed.where("has_words")
        .join(winners, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")))
        .dropDuplicates(["k1", "k2"])
    )
    empty = keyed.where(~F.coalesce("has_words", F.lit(False)))
    return one.select("doc.*").unionByName(empty.select("doc.*"))
