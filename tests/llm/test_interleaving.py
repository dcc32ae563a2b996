import random
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import docs_frame
from vuelometria.llm.interleaving import interleaved, sharded_documents


@pytest.mark.parametrize("n", [0, 5, 16, 1003])
def test_every_shard_matches_the_mixture(spark, n):
    r = random.Random(n)
    rows = [(i, r.choice((None, "", "é" * 9, f"t{i}")), r.choice(("a", "a", "a", "b", None))) for i in range(n)]
    docs = docs_frame(spark, rows)
    got = interleaved(docs).collect()
    assert sorted(x.doc_id for x in got) == list(range(n))
    shards = defaultdict(list)
    mix = defaultdict(Counter)
    for x in got:
        _, text, source = rows[x.doc_id]
        raw = (text or "").encode()
        assert (x.size, x.text_crc32, x.law, x.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        shards[x.shard].append(x.slot)
        mix[source][x.shard] += 1
    counts = [len(shards[i]) for i in range(16)]
    assert max(counts) - min(counts) <= 1 and set(shards) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    for source, c in mix.items():
        share = sum(c.values()) / 16
        assert all(abs(c[i] - share) <= 2 for i in range(16))


def test_places_follow_the_fractional_rank(spark):
    rows = [(i, f"t{i}", "ab"[i % 4 == 0]) for i in range(400)]
    got = sorted((x.shard, x.slot, rows[x.doc_id][2]) for x in interleaved(docs_frame(spark, rows)).collect())
    sequence = [s for *_, s in got]
    want = sorted([((2 * r - 1) / 600, "a") for r in range(1, 301)] + [((2 * r - 1) / 200, "b") for r in range(1, 101)])
    assert sequence == [s for _, s in want]


def test_runs_agree_and_repeated_rows_stay(spark):
    rows = [(1, "x", "a")] * 40 + [(None, None, None)] * 3
    docs = docs_frame(spark, rows)
    once, again = (sorted(map(str, interleaved(d).collect())) for d in (docs, docs.repartition(5)))
    assert once == again and len(once) == 43
    out = sharded_documents(docs)
    assert out.count() == 43 and out.select("doc.*").columns == docs.columns
