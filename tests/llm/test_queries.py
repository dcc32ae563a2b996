"""Registered queries against their SQL counterparts, and the pipeline against plain versions."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.helpers import components, words
from vuelometria.checks.compare import connect, differences
from vuelometria.llm.common import stored, table
from vuelometria.llm.queries import QUERIES
from vuelometria.llm.sql import ORACLES


@pytest.fixture(scope="module")
def duck(folder):
    con = connect(folder)
    yield con
    con.close()


@pytest.mark.parametrize("key", list(ORACLES))
def test_sql(spark, folder, duck, key):
    assert differences(QUERIES[key](spark, folder), duck, ORACLES[key]) == []


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))


def test_whole_tables(spark, folder):
    docs = table(spark, folder, "documents").count()
    for key in ("op1_surrogates", "op2_template_windows", "op4_budget_mix", "op6_license_scan", "op9_interleaving", "op11_fill_in_middle"):
        assert QUERIES[key](spark, folder).count() == docs
    assert QUERIES["op7_wrapper"](spark, folder).count() == table(spark, folder, "pages").count()


@pytest.mark.parametrize("key", ["op1_surrogates", "op5_line_frequency", "op10_reply_trees"])
def test_no_python_on_the_way(spark, folder, key):
    text = QUERIES[key](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoopJoin", text)


def test_verbatim_leaks(spark, folder):
    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    items = [plain(r.text) for r in table(spark, folder, "benchmark").collect()]
    want = {r.doc_id for r in table(spark, folder, "documents").collect() if any(i in plain(r.text) for i in items)}
    assert {r.doc_id for r in QUERIES["op2_template_windows"](spark, folder).collect() if r.contaminated} == want


def test_pipeline(spark, folder):
    docs = table(spark, folder, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        seen[name] = docs.collect()
        assert docs.columns == (columns if name != "shard" else [*columns, "shard", "slot"])
    kept = {r.doc_id for r in QUERIES["op5_line_frequency"](spark, folder).collect() if r.kept}
    assert sorted(r.doc_id for r in seen["quality_rules"]) == sorted(kept)
    tops = components({r.doc_id: r.text for r in seen["quality_rules"]})
    assert sorted(r.doc_id for r in seen["near_dedup"]) == sorted(set(tops.values()))
    assert {r.doc_id for r in seen["decontaminate"]} < {r.doc_id for r in seen["near_dedup"]}
    times = Counter(r.doc_id for r in seen["mix_sources"])
    assert set(times) <= {r.doc_id for r in seen["decontaminate"]} and max(times.values()) <= 2
    total = sum(len(words(r.text)) for r in seen["decontaminate"])
    assert abs(sum(len(words(r.text)) for r in seen["mix_sources"]) - 1.5 * total) < 0.01 * total
    assert Counter(r.doc_id for r in seen["shard"]) == times
    assert len({(r.shard, r.slot) for r in seen["shard"]}) == len(seen["shard"])
