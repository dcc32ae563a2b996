import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from vuelometria.llm.packing import Packing, knapsack, packed_documents, plan
from vuelometria.llm.tokens import encode_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "a", "  x ", "don't 'stuff I'LL rock'n'roll", "\x1cfoo\x1fbar", "a b c", "é ́x Å", "İstanbul ΣΑΣ",
    "<|endoftext|> x<|endoftext|>y <|ENDOFTEXT|>.a", "日本語 テキスト", "12 3a4 a,b;c", "naïve!!! (hm)... [x] É.À", "ﬁ ẞ ß", "​z",
    "a\x0bb\x0cc\rd", None, "x" * 5000, "a\x00b", "ª º µ ×.÷", "😀 ok😀ok.", "it's's", "a'", "<b>x</b>", "\x85a\x85b", "¿qué? —,a",
]


def rows_of(texts):
    ids, at = encode_texts(pa.array(texts, pa.string()), PATH, False)
    return [[*ids[a:b].tolist(), 0] for a, b in zip(at, at[1:])]


@pytest.mark.parametrize("texts", [ODD, ODD[::-1] * 2, [], [None]])
def test_words_give_the_tokens_of_the_library(texts):
    for a, b in zip(encode_texts(pa.array(texts, pa.string()), PATH, True), encode_texts(pa.array(texts, pa.string()), PATH, False)):
        assert a.tolist() == b.tolist()


def test_words_give_the_tokens_of_documents(spark, folder):
    texts = pa.array([r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])
    for a, b in zip(encode_texts(texts.slice(3), PATH, True), encode_texts(texts.slice(3), PATH, False)):
        assert a.tolist() == b.tolist()


def fewest(sizes, capacity):
    """The least number of sequences, by trying all."""
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            go(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_whole_and_near_the_optimum(seed):
    r = random.Random(seed)
    capacity = r.choice((10, 20, 31))
    sizes = sorted((r.randint(1, capacity) for _ in range(r.randint(0, 11))), reverse=True)
    p = plan(dict(Counter(sizes)), Packing(capacity=capacity))
    best = fewest(sizes, capacity)
    assert p.bound <= best + 1e-6 and best <= p.sequences <= best + 1


@pytest.mark.parametrize("low_high", [(600, 900), (300, 1100), (1, 2048), (2048, 2048)])
def test_large_histograms(low_high):
    r = random.Random(1)
    sizes = np.array([r.randint(*low_high) for _ in range(4000)])
    p = plan(dict(Counter(sizes.tolist())), Packing())
    rank = np.zeros(len(sizes), np.int64)
    for x in np.unique(sizes):
        rank[sizes == x] = np.arange((sizes == x).sum())
    sequence, offset = p.find(sizes, rank)
    filled = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), sizes.tolist()):
        filled[s].append((o, n))
    assert len(filled) == p.sequences
    for parts in filled.values():
        place = 0
        for o, n in sorted(parts):
            assert o == place
            place += n
        assert place <= 2048
    # best fit, longest first, is worse by several percent where pieces are long, and better by a few sequences in other cases
    rooms = []
    for n in sorted(sizes.tolist(), reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= n
        else:
            rooms.append(2048 - n)
    assert p.bound - 1e-6 <= p.sequences <= len(rooms) * 1.002 + 1


def test_knapsack_against_all_multisets():
    r = random.Random(5)
    lengths, prices = np.array([2, 3, 7, 11]), np.array([r.random() for _ in range(4)])
    best, last = knapsack(lengths, prices, 23)
    worth = [0.0] * 24
    for c in range(24):
        worth[c] = max([0.0, *(worth[c - n] + p for n, p in zip(lengths, prices) if n <= c), *([worth[c - 1]] if c else [])])
    assert np.allclose(best, worth)


@pytest.mark.parametrize("capacity", [8, 64])
def test_pieces_hold_the_documents(spark, capacity):
    r = random.Random(6)
    texts = ODD + ["word " * r.randint(0, 90) for _ in range(60)] + ["same text here"] * 40
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "no id", None)]
    docs = docs_frame(spark, rows).repartition(5)
    got = packed_documents(docs, PATH, p=Packing(capacity=capacity)).collect()
    by = defaultdict(list)
    for g in got:
        by[g.doc_id].append(g)
    for (i, _, _), ids in zip(rows, rows_of([t for _, t, _ in rows])):
        parts = sorted(by[i], key=lambda g: g.piece)
        assert [g.piece for g in parts] == list(range(len(parts))) and [g.start for g in parts] == [capacity * g.piece for g in parts]
        assert b"".join(g.carry for g in parts) == np.array(ids, "<u4").tobytes()
        assert [g.length for g in parts] == [len(g.carry) // 4 for g in parts] and all(g.length == capacity for g in parts[:-1])
    sequences = defaultdict(list)
    for g in got:
        sequences[g.sequence_id].append((g.offset, g.length))
    for parts in sequences.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= capacity
    total = sum(g.length for g in got)
    assert len(sequences) <= -(-total // capacity) * 1.02 + 2


def test_carried_digest_and_empty_table(spark):
    docs = docs_frame(spark, [(1, "A text.", "s")])
    row = packed_documents(docs, PATH, carry=F.crc32("ids")).first()
    assert row.carry == zlib.crc32(np.array(rows_of(["A text."])[0], "<u4").tobytes()) and (row.piece, row.start, row.offset) == (0, 0, 0)
    assert packed_documents(docs.limit(0), PATH).collect() == []
