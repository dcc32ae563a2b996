import random

import duckdb

from tests.llm.helpers import docs_frame, words
from vuelometria.checks.compare import differences
from vuelometria.llm.line_frequency import LineLimits, clean_documents, line_quality
from vuelometria.llm.sql import LINE_FREQUENCY

LIMITS = LineLimits(min_documents=3, min_share=0.0)


def text(seed, n=30):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def test_boilerplate_goes_and_depleted_documents_are_rejected(spark):
    line = "Accept   ALL cookies now please thank you very much 2024"
    rows = [(i, f"{text(i)}\n{line.lower() if i % 2 else line}", "a") for i in range(6)]
    rows += [(10, f"{line.replace('4', '7')}\n{text(10, 2)}", "a"), (11, f"{text(11)}\n{line}", "b")]
    docs = docs_frame(spark, rows)
    got = {r.doc_id: r for r in line_quality(docs, limits=LIMITS).collect()}
    assert [got[i].removed_words for i in (0, 10, 11)] == [10, 10, 0]
    assert not got[10].kept and not got[10].base_failed
    assert all(got[i].kept for i in (*range(6), 11))
    cleaned = {r.doc_id: r for r in clean_documents(docs, limits=LIMITS).collect()}
    assert set(cleaned) == {0, 1, 2, 3, 4, 5, 11}
    assert cleaned[3].text == text(3) and cleaned[3].n_chars == len(text(3)) and cleaned[3].k1 == "k"
    assert cleaned[11].text == rows[7][1]


def test_copies_of_a_document_are_no_boilerplate(spark):
    copies = "\n".join(text(i, 8) for i in range(5))
    rows = [(i, copies, "a") for i in range(40)]
    assert all(r.kept for r in line_quality(docs_frame(spark, rows), limits=LIMITS).collect())
    assert clean_documents(docs_frame(spark, rows), limits=LIMITS).count() == 40


def test_measures(spark):
    again = "one two three four five"
    t = f"{again} # x\n\n \t\n{again} | y\nz z\nz z\r\nz z"
    rows = [(1, t, "a"), (2, None, None), (3, "", None), (4, " \n ", "a"), (5, "ü" * 70000 + " b" * 12, "a"), (1, t, "a")]
    got = {r.doc_id: r for r in line_quality(docs_frame(spark, rows)).collect()}
    m = got[1]
    assert (m.n_words, m.word_chars) == (len(words(t)), sum(map(len, words(t))))
    # "z z z z z" is found twice, "z z\r" is another line than "z z"
    assert (m.n_symbols, m.n_dup_lines, m.n_repeat_words) == (2, 1, 16)
    assert m.base_failed and not m.kept
    assert all(got[i].n_words == 0 and got[i].base_failed and not got[i].kept for i in (2, 3, 4))
    assert got[5].word_chars == 70012 and got[5].n_repeat_words == 12 and got[5].base_failed


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, text(1), None)] * 3 + [(None, text(2), "a")]
    docs = docs_frame(spark, rows)
    assert [r.kept for r in line_quality(docs).collect()] == [True] * 4
    assert clean_documents(docs).count() == 4
    assert line_quality(docs.limit(0)).collect() == [] and clean_documents(docs.limit(0)).collect() == []


def test_long_lines_count_too(spark):
    notice = "We value your privacy and use cookies for " + text("notice", 60)
    rows = [(i, f"{text(i)}\n{notice}", "a") for i in range(6)] + [(10, f"{notice}\n{text(10, 2)}", "a"), (11, f"{text(11)}\n{notice}", "b")]
    docs = docs_frame(spark, rows)
    got = {r.doc_id: r for r in line_quality(docs, limits=LIMITS).collect()}
    assert len(notice) > 200 and [got[i].removed_words for i in (0, 10, 11)] == [68, 68, 0]
    assert not got[10].kept and all(got[i].kept for i in (*range(6), 11))
    cleaned = {r.doc_id: r.text for r in clean_documents(docs, limits=LIMITS).collect()}
    assert cleaned == {**{i: text(i) for i in range(6)}, 11: rows[7][1]}


def test_long_shared_lines_agree_with_sql(spark, tmp_path):
    notice = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{notice}\n{text(i)}", "host") for i in range(40)]
    docs_frame(spark, rows).select("doc_id", "text", "source").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    result = line_quality(spark.read.parquet(str(tmp_path / "documents.parquet")))
    assert differences(result, con, LINE_FREQUENCY) == [] and {r.removed_words for r in result.collect()} == {60}
