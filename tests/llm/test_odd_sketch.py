import random

import pytest

from tests.llm.helpers import components, docs_frame, shingles
from vuelometria.llm.components import connected_components
from vuelometria.llm.odd_sketch import NearCopies, near_copies, without_near_copies


def sample(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(5))
    rows = []
    for group in range(12):
        base = [word() for _ in range(r.choice((6, 40, 160)))]
        for _ in range(r.choice((1, 2, 15))):
            copy = list(base)
            for _ in range(r.choice((0, 1, 3, 8))):
                copy[r.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy), f"s{group % 3}"))
    rows += [(900, "A b", "s"), (901, "a  B\n", "s"), (902, None, None), (903, " \t", "s"), (904, "", "s")]
    return rows


@pytest.mark.parametrize("size, block", [(5, 400_000), (4, 900)])
def test_against_all_pairs(spark, size, block):
    rows = sample()
    got = {r.doc_id: r for r in near_copies(docs_frame(spark, rows), p=NearCopies(shingle=size, block=block)).collect()}
    want = components({i: t for i, t, _ in rows}, size=size)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(shingles(t, size)) for i, t, _ in rows)
    assert all(r.kept == (r.component_id == r.doc_id) for r in got.values())
    assert want[901] == 900 and got[902].kept and got[903].kept


def test_one_of_each_group_stays(spark):
    rows = sample()
    docs = docs_frame(spark, rows + rows[:5])
    left = without_near_copies(docs)
    assert left.columns == docs.columns
    want = {i for i, top in components({i: t for i, t, _ in rows}).items() if i == top}
    assert sorted(r.doc_id for r in left.collect()) == sorted(want)


def test_null_ids_and_empty_table(spark):
    docs = docs_frame(spark, [(None, "x y z u v", "a"), (None, "X y z u v", "a"), (7, "x y z u v", "a")])
    assert {r.component_id for r in near_copies(docs).collect()} == {7}
    assert [r.doc_id for r in without_near_copies(docs).collect()] == [7]
    assert near_copies(docs.limit(0)).collect() == [] and without_near_copies(docs.limit(0)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(60, 50), (50, 70), (70, 60), (80, 80), (50, 60)] + [(100, i) for i in range(101, 140)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and {got[i] for i in (50, 60, 70)} == {50}
    assert all(got[i] == 100 for i in range(100, 140)) and 80 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
