"""Packing documents into as few token sequences as possible, by a configuration linear program.

1. Every text becomes its token ids and an end id; only documents longer than a sequence are cut, into full pieces and a
   rest. Pieces are stored once, with the task that made them and their number among that task's pieces of equal length.
2. The histogram of piece lengths, one row per length and so ``capacity`` rows at most, is all that the linear program
   sees. Its variables are configurations, multisets of lengths that fit in a sequence: cover the count of every length
   with as few as possible. It is solved by multiplicative weights: in each round the lengths have prices, higher the less
   they are covered so far; a knapsack by dynamic programming over the tokens of a sequence gives the best configuration,
   and the best one through each length; all that come within ``slack`` of the best get a share of the round.
3. The fractional amounts, or a share of them, are rounded by their running sum, so that no more than the counts is used,
   and pieces that are left over go, longest first, where they leave the least room, in sequences with room or new ones.
   Of the ``roundings``, each a share and whether configurations that leave room are used, the best one counts.
4. A piece finds its place by its length and its rank among pieces of this length: the pieces of earlier tasks and its
   number in its own task. No length is ever sorted or gathered in one task, a length that holds a third of all pieces
   included; the table of places has a row per configuration and length.

Defined results: a NULL or empty text is one piece with the end id alone; repeated rows are packed as often as they are
there; a NULL id is kept; an empty table gives no rows. Which of the pieces of a length stands where may differ between
runs, the number of sequences does not.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import stored
from .tokens import encode_texts


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    end_id: int = 0
    #: whether tokens stay inside of words, see ``tokens.WordTokenizer``; False takes any tokenizer
    by_word: bool = True
    rounds: int = 120
    slack: float = 0.02
    rate: float = 3.0
    roundings: tuple[tuple[float, bool], ...] = ((1.0, True), (0.9, True), (0.9, False), (0.5, False), (0.2, False))


# ---- the linear program


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(best, last): the most that lengths within c tokens are worth, and the place of one of them, or -1 to leave a token.

    ``lengths`` rise; any of them may be taken more than once.
    """
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := fitting[c]:
            worth = best[c - lengths[:n]] + prices[:n]
            k = int(worth.argmax())
            if worth[k] > best[c]:
                best[c], last[c] = worth[k], k
    return best, last


def fractional(lengths: np.ndarray, counts: np.ndarray, p: Packing) -> tuple[dict[tuple[int, ...], float], float]:
    """Configurations (places in ``lengths``, with repetition) and their amounts, and a lower bound of the optimum."""
    need, share = counts.astype(float), lengths / p.capacity
    mass = float((share * need).sum()) / p.rounds
    covered = np.zeros(len(lengths))
    amounts: dict[tuple[int, ...], float] = defaultdict(float)
    bound = 0.0
    for turn in range(p.rounds):
        prices = share * np.exp(p.rate * np.clip(turn / p.rounds - covered, -1, 1))
        best, last = knapsack(lengths, prices, p.capacity)
        # prices over the best are a solution of the dual, so what they say all pieces are worth is a lower bound
        bound = max(bound, float((prices * need).sum() / best[-1]))
        through = prices + best[p.capacity - lengths]
        near = np.flatnonzero(through >= (1 - p.slack) * best[-1])
        wanted = (prices * need)[near]
        for k, x in zip(near.tolist(), (mass * wanted / wanted.sum()).tolist()):
            chosen, room = [k], p.capacity - int(lengths[k])
            while room and best[room]:
                if last[room] < 0:
                    room -= 1
                else:
                    chosen.append(int(last[room]))
                    room -= int(lengths[chosen[-1]])
            amounts[tuple(sorted(chosen, reverse=True))] += x
            np.add.at(covered, chosen, x / need[chosen])
    return amounts, bound


def rounded(amounts: dict[tuple[int, ...], float], lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Counter[tuple[int, ...]]:
    """Whole numbers of configurations that hold every piece once; the last ones take what rounding left."""
    left, total = counts.astype(np.int64).copy(), 0.0
    used: Counter[tuple[int, ...]] = Counter()
    for chosen, x in amounts.items():
        times = int(total + x + 1e-9) - int(total + 1e-9)
        total += x
        for k, n in Counter(chosen).items() if times else ():
            times = min(times, int(left[k]) // n)
        if times:
            used[chosen] += times
            np.subtract.at(left, list(chosen), times)
    # sequences with equal content together, by the room they have
    room: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    for chosen, times in used.items():
        room[capacity - int(lengths[list(chosen)].sum())][chosen] = times
    open_rooms = np.array([bool(x) for x in room])
    for k in range(len(lengths) - 1, -1, -1):
        size, n = int(lengths[k]), int(left[k])
        while n:
            found = size + int(open_rooms[size:].argmax())
            if not open_rooms[found]:  # new sequences, with as many of this length as fit
                each = min(n, capacity // size)
                chosen, times, found = (k,) * each, n // each, capacity - each * size
                n -= each * times
            else:
                was, have = room[found].popitem()
                times = min(n, have)
                if have > times:
                    room[found][was] = have - times
                open_rooms[found] = bool(room[found])
                chosen, found = (*was, k), found - size
                n -= times
            room[found][chosen] = room[found].get(chosen, 0) + times
            open_rooms[found] = True
    return Counter({chosen: times for x in room for chosen, times in x.items()})


@dataclass(frozen=True)
class Places:
    """Where the pieces of each length go. Arrays of equal length, by ``key``: length * 2^44 and the first rank of a row."""

    key: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    bound: float

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, (length.astype(np.int64) << 44) + rank, side="right") - 1
        turn, nth = np.divmod(rank - self.first[row], self.each[row])
        return self.sequence[row] + turn, self.offset[row] + nth * length


def plan(histogram: dict[int, int], p: Packing) -> Places:
    """From length -> count. Sequences of one configuration have consecutive numbers."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    amounts, bound = fractional(lengths, counts, p) if len(lengths) else ({}, 0.0)
    rows, taken, sequence = [], Counter(), 0
    full = {c for c in amounts if int(lengths[list(c)].sum()) == p.capacity}
    tries = [{c: x * share for c, x in amounts.items() if loose or c in full} for share, loose in p.roundings]
    found = [rounded(x, lengths, counts, p.capacity) for x in tries]
    for chosen, times in min(found, key=Counter.total).items():
        offset = 0
        for k, each in sorted(Counter(chosen).items(), reverse=True):
            size = int(lengths[k])
            rows.append(((size << 44) + taken[k], taken[k], each, sequence, offset))
            taken[k] += each * times
            offset += each * size
        sequence += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Places(*columns, sequences=sequence, bound=bound)


# ---- on tables


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id", p: Packing = Packing()) -> DataFrame:
    """id, piece, start, length, ids (little-endian, 4 bytes each), and task and nth of the piece among those of its length.

    Write it before use: task and nth hold for one run of a task.
    """
    given = docs.select(docs[id_col].alias("id"), docs[text].alias("text"))
    kind = given.schema["id"]
    schema = StructType([StructField("id", kind.dataType)]).simpleString()[len("struct<") : -1].replace(":", " ", 1)
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
    names = ["id", "piece", "start", "length", "ids", "task", "nth"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(p.capacity + 1, np.int64)
        for batch in batches:
            ids, at = encode_texts(batch.column(1), tokenizer, p.by_word)
            # the end id after each text
            ids = np.insert(ids, at[1:], p.end_id).astype("<u4", copy=False)
            at = at + np.arange(len(at))
            sizes = np.diff(at)
            parts = -(-sizes // p.capacity)
            doc = np.repeat(np.arange(len(sizes)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * p.capacity
            length = np.minimum(sizes[doc] - start, p.capacity)
            order = np.argsort(length, kind="stable")
            same, n = np.unique(length[order], return_index=True, return_counts=True)[1:] if len(order) else (order, order)
            nth = np.empty_like(length)
            nth[order] = np.arange(len(order)) - np.repeat(same, n)
            nth += seen[length]
            np.add.at(seen, length, 1)
            ends = np.cumsum(length)
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(doc), [None, pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int64)), pa.py_buffer(ids.tobytes())]
            )
            columns = [piece, start, length, raw.cast(pa.binary()), np.full(len(doc), task), nth]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc))] + [pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(columns, types)],
                names,
            )

    return given.mapInArrow(cut, f"{schema}, piece int, start bigint, length int, ids binary, task int, nth bigint")


def packed_documents(
    docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id", p: Packing = Packing(), carry: Column | None = None
) -> DataFrame:
    """One row per piece: id, piece, start, length, ``carry`` (of its ids; the ids themselves), sequence_id and offset."""
    cut = pieces(docs, tokenizer, text, id_col, p)
    kept = stored(cut.select("id", "piece", "start", "length", (F.col("ids") if carry is None else carry).alias("carry"), "task", "nth"), "pieces")
    counts = stored(kept.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    # a row per length: no more than the tokens of a sequence
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan(histogram, p)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("earlier"))

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = places.find(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], ["sequence_id", "offset"])

    ranked = kept.join(earlier, ["length", "task"])
    placed = ranked.withColumn("at", place(F.col("length").cast("long"), F.col("earlier") + F.col("nth")))
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", F.col("length").cast("long").alias("length"), "carry", "at.sequence_id", "at.offset"
    )
