import random
import re
import time
from collections import Counter

from tests.llm.helpers import docs_frame
from vuelometria.llm.license_scan import NOTICES, Finder, admissible, full_notices, scan_licenses


def test_notices(spark):
    texts = {
        1: "Some text\nRELEASED under the mit license\nmore", 2: "Licensed under CC BY-NC 4.0.", 3: "nothing of that kind here at all",
        4: None, 5: "", 6: "word", 7: "All rights reserved. " * 3000, 8: "Permission is hereby granted, free of charge,\nto any person "
        "obtaining a copy of this software and\nassociated documentation files, to deal in the Software\nwithout restriction.",
        9: "intro\n\nThis work is licensed under the GNU General\nPublic License, version 3.\n\nend", 10: "All rights reserved.\nAll rights reserved.",
    }
    docs = docs_frame(spark, [(i, t, "a") for i, t in texts.items()] + [(1, texts[1], "a")])
    got = {r.doc_id: r.license for r in scan_licenses(docs).collect()}
    names = {1: "MIT", 2: "CC-BY-NC-4.0", 8: "MIT", 9: "GPL-3.0", 10: "All-Rights-Reserved"}
    assert got == {i: names.get(i) for i in texts}
    assert scan_licenses(docs).count() == 11
    assert scan_licenses(docs.limit(0)).collect() == []
    assert {r.license for r in scan_licenses(docs, notices=()).collect()} == {None}


def test_size_bounds_lose_nothing():
    for a in range(1, 60):
        for b in range(1, 120):
            if 2 * min(a, b) / (a + b) >= 0.8:
                assert b in admissible(a, 0.8)
    assert len(NOTICES) == len(set(NOTICES))


def test_notices_anywhere(spark):
    prose = "the weather was fine and nobody thought of anything "
    full = dict(full_notices()[len(NOTICES) :])
    texts = {
        1: "Copyright 2020 Foo Inc. All rights reserved. Home About", 2: prose * 20 + "Released under the MIT License. " + prose * 20,
        3: prose * 40, 4: prose * 30 + " ".join(full["MIT"].split()) + prose * 30, 5: prose + full["GPL-3.0"] + prose, 6: None, 7: "", 8: "word",
        9: "/* " + full["MPL-2.0"].replace("\n", "\n * ") + " */", 10: "All rights reserved. " * 3000, 11: "rights reserved all",
    }
    docs = docs_frame(spark, [(i, t, "a") for i, t in texts.items()] + [(1, texts[1], "a")])
    got = {r.doc_id: r for r in scan_licenses(docs, notices=full_notices(), anywhere=True).collect()}
    names = {1: "All-Rights-Reserved", 2: "MIT", 4: "MIT", 5: "GPL-3.0", 9: "MPL-2.0", 10: "All-Rights-Reserved"}
    assert {i: r.license for i, r in got.items()} == {i: names.get(i) for i in texts}
    assert all(got[i].dice == 1.0 for i in names)
    assert scan_licenses(docs, notices=full_notices(), anywhere=True).count() == 12
    assert {r.license for r in scan_licenses(docs, notices=(), anywhere=True).collect()} == {None}


def test_best_run_is_exact():
    r = random.Random(5)
    for _ in range(300):
        notice = [r.choice("abc") for _ in range(r.randint(2, 9))]
        text = [r.choice("abcd") for _ in range(r.randint(0, 30))]
        want = Counter(zip(notice, notice[1:]))
        best = 0.0
        for i in range(len(text)):
            for j in range(i + 2, len(text) + 1):
                bag = Counter(zip(text[i:j], text[i + 1 : j]))
                best = max(best, 2 * sum((bag & want).values()) / (sum(bag.values()) + sum(want.values())))
        found = Finder((("x", " ".join(notice)),), 0.8).found(" ".join(text))
        assert found == ({"x": best} if best >= 0.8 else {}), (notice, text)
    assert all(re.search(r"[^\W_]+ ", text) for _, text in full_notices())


def test_one_run_is_one_license():
    finder = Finder(full_notices(), 0.8)
    own = [(name, text) for name, text in full_notices() if len(text.split()) > 8]
    for name, text in own:
        assert set(finder.found(text)) - {"All-Rights-Reserved"} == {name}, name
    by_name = dict(full_notices()[len(NOTICES) :])
    both = f"{by_name['LGPL-2.0']}\n\nsome words between them\n\n{by_name['GPL-2.0']}\n\n{by_name['LGPL-2.0']}"
    assert set(finder.found(both)) == {"GPL-2.0", "LGPL-2.0"}
    # the own run of a license counts, also if it fits a better run elsewhere
    short = [t for n, t in NOTICES if n in ("GPL-2.0", "GPL-3.0")]
    assert set(finder.found(f"{short[0]} and then {short[1].replace('work', 'thing')}")) == {"GPL-2.0", "GPL-3.0"}


def test_identifier_lines(spark):
    texts = {
        1: "# SPDX-License-Identifier: Apache-2.0\nimport x", 2: "/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-3-Clause */",
        3: "// SPDX-License-Identifier: MPL-2.0 and so on", 4: "SPDX-License-Identifier:", 5: "// SPDX-License-Identifier: LGPL-2.1+\n" + "Released under the MIT License.",
    }
    rows = scan_licenses(docs_frame(spark, [(i, t, "a") for i, t in texts.items()]), notices=full_notices(), anywhere=True).collect()
    assert {r.doc_id: (r.license, r.n_licenses) for r in rows} == {
        1: ("Apache-2.0", 1), 2: ("BSD", 2), 3: ("MPL-2.0", 1), 4: (None, 0), 5: ("LGPL-2.1", 2),
    }


def plain_runs(notice, text, limit):
    want, out = Counter(zip(notice, notice[1:])), []
    for i in range(len(text)):
        for j in range(i + 2, len(text) + 1):
            bag = Counter(zip(text[i:j], text[i + 1 : j]))
            dice = 2 * sum((bag & want).values()) / (sum(bag.values()) + sum(want.values()))
            if dice >= limit:
                out.append((dice, i, j - 2))
    return out


def test_blocks_of_starts_lose_nothing():
    r = random.Random(8)
    for _ in range(25):  # notices long enough for blocks of several starts
        notice = [r.choice("abcdefgh") for _ in range(r.randint(70, 100))]
        near = [x if r.random() < 0.95 else r.choice("abcdefghz") for x in notice]
        text = [r.choice("abz") for _ in range(r.randint(0, 20))] + near + [r.choice("abz") for _ in range(r.randint(0, 20))]
        best = max((d for d, _, _ in plain_runs(notice, text, 0.8)), default=None)
        assert Finder((("x", " ".join(notice)),), 0.8).found(" ".join(text)) == ({"x": best} if best else {})


def test_a_long_text_of_many_near_copies_is_quick():
    r, gpl = random.Random(3), dict(full_notices())["GPL-3.0"].split()
    text = " ".join(x if r.random() < 0.975 else "changed" for _ in range(40) for x in gpl)
    finder = Finder(full_notices(), 0.8)
    began = time.process_time()
    assert set(finder.found(text)) == {"GPL-3.0"}
    assert time.process_time() - began < 20
