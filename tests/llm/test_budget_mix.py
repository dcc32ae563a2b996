import random
from collections import Counter

import pytest

from tests.llm.helpers import docs_frame, words
from vuelometria.llm.budget_mix import Mix, fill, mixed_documents, mixture


def level_targets(sizes, mix):
    """Shares by weight, excess dealt again until nobody is above."""
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    rest, open_, out = sum(sizes.values()) * mix.percent / 100, set(order), {}
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > mix.most * sizes[s]}
        if not full:
            return out | {s: unit * weight[s] for s in open_}
        out |= {s: float(mix.most * sizes[s]) for s in full}
        rest -= sum(out[s] for s in full)
        open_ -= full
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_are_met(spark, seed):
    r = random.Random(seed)
    rows = [(i, "w " * r.choice((1, 2, 7, 30, 200)), r.choice(("a", "b", "b", "b", "c", "é", None))) for i in range(300)]
    rows += [(500, None, "a"), (501, "", "b"), (502, " \n", "empty"), (None, "x y", None)]
    mix = Mix()
    docs = docs_frame(spark, rows)
    got = mixture(docs, mix=mix).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixture(docs.repartition(7), mix=mix).collect()))
    source = {i: s for i, _, s in rows}
    sizes, taken, target = Counter(), Counter(), {}
    for i, t, s in rows:
        sizes[s] += len(words(t))
    for x in got:
        s = source[x.doc_id]
        assert x.source_size == sizes[s] and x.taken in (0, x.size, 2 * x.size)
        taken[s] += x.taken
        target[s] = x.target
    want = level_targets(sizes, mix)
    assert all(abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - want[s]) <= 1 + 0.01 * sizes[s] for s in sizes)
    mixed = mixed_documents(docs, mix=mix)
    assert mixed.columns == docs.columns
    assert sum(len(words(x.text)) for x in mixed.collect()) == sum(taken.values())


def test_knapsack():
    sums = {3 * a + 5 * b + 7 * c for a in range(11) for b in range(11) for c in range(11)}
    for target in range(1, 160):
        out = fill([3, 5, 7], [10, 10, 10], target, 40)
        assert all(n <= 10 for n in out.values())
        assert sum(s * n for s, n in out.items()) == max(x for x in sums if x <= target)
    assert fill([0, 5], [3, 2], 100, 10) == {5: 2} and fill([], [], 5, 10) == {} and fill([4], [5], 0, 10) == {}


def test_a_size_with_a_third_of_all_documents(spark):
    rows = [(i, "x " * 50, "a") for i in range(300)] + [(300 + i, "y " * (i % 90), "b") for i in range(600)]
    got = mixture(docs_frame(spark, rows)).collect()
    taken = Counter()
    for x in got:
        taken[x.target] += x.taken
    assert all(abs(t - n) <= 50 for t, n in taken.items())


def test_empty_table(spark):
    docs = docs_frame(spark, [(1, None, None)])
    assert [tuple(r) for r in mixture(docs).collect()] == [(1, 0, 0, 0.0, 0)]
    assert mixture(docs.limit(0)).collect() == [] and mixed_documents(docs.limit(0)).collect() == []
