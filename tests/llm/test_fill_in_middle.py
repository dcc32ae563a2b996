import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.helpers import docs_frame
from vuelometria.llm.fill_in_middle import Chunking, Cutter, FillInMiddle, chunk_ends, rearranged, restored

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def cut(text, draws):
    tokens = TOKEN.findall(text)
    a, b = sorted(x % (len(tokens) + 1) for x in draws)
    return len(tokens), len("".join(tokens[:a])), len("".join(tokens[:b]))


def plain_version(doc_id, text, seed=42):
    text, p = text or "", FillInMiddle()
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n, a, b = cut(text, h[:2])
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= p.rate_percent:
        return n, "plain", None, None, text
    x, y, z = text[:a], text[a:b], text[b:]
    if h[3] % 100 < p.spm_percent:
        return n, "spm", x, y, f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", x, y, f"<P>{x}<S>{z}<M>{y}"


def texts(r, n):
    kinds = ("", " ", " \n", "word", "<P> x", "a <S", "é日本 語\t😀", "x" * 5000, "<<S", "tail ")
    return [r.choice(kinds) + "".join(r.choice("aé日 \n\tb <") for _ in range(r.choice((0, 3, 60, 4000)))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_cuts_are_those_of_the_tokens(seed):
    r = random.Random(seed)
    rows = texts(r, 60)
    rows += rows[:5] + [rows[1] * 3 + rows[2], rows[5] + rows[3] * 9]
    draws = np.array([[r.getrandbits(32), r.getrandbits(32)] for _ in rows])
    for chunking in (Chunking(), Chunking(least=32, bits=3, memo_bytes=200)):
        got = list(Cutter(chunking).cuts([t.encode() for t in rows], draws))
        assert got == [cut(t, d.tolist()) for t, d in zip(rows, draws)]


def test_shared_passages_are_looked_at_once():
    r = random.Random(1)
    passage = " ".join(str(r.random()) for _ in range(4000))
    rows = [passage.encode(), b"something else before " + passage.encode() + b" and behind"]
    cutter = Cutter()
    list(cutter.cuts(rows, np.zeros((2, 2), np.int64)))
    assert cutter.computed < 0.6 * cutter.asked


def test_chunks_end_at_characters_and_texts():
    raw = ("日本é" * 3000).encode()
    ends = chunk_ends(np.frombuffer(raw, np.uint8), np.array([1000, 1000, len(raw)]), Chunking(bits=4))
    assert ends[-1] == len(raw) and 1000 in ends and (np.diff(ends) > 0).all()
    assert all(raw[e] & 0xC0 != 0x80 for e in ends.tolist() if e < len(raw) and e != 1000)


def test_against_a_plain_version(spark):
    r = random.Random(3)
    rows = [(i, t, "s") for i, t in enumerate(texts(r, 120))] + [(None, "no id here", "s"), (7, None, None), (8, "a b c", "s"), (8, "a b c", "s")]
    out = rearranged(docs_frame(spark, rows))
    got = out.withColumn("back", restored(out.output, out.form)).collect()
    want = [(i, *plain_version(i, t), t or "") for i, t, _ in rows]
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((g.doc_id, g.n, g.form, g.prefix, g.middle, g.output, g.back) for g in got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert rearranged(docs_frame(spark, []).limit(0)).collect() == []
