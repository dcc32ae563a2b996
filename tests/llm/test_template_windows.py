import random
from collections import Counter

import pytest
import regex

from tests.llm.helpers import docs_frame
from vuelometria.llm.template_windows import INSIDE, NAME, NUMBER, UNIT, UNITS, Templates, decontamination, without_leaks

QUESTION = (
    "A farmer named Bertha drives 120 km to the market and sells 35 apples for 2 dollars each, "
    "then Bertha drives back 120 km and buys bread for the rest of the money. How much bread does she get?"
)
OTHER = QUESTION.replace("Bertha", "Ludwig").replace("120", "95").replace("35", "1,200")
MIXED = QUESTION.replace("sells 35", "sells 40").replace("back 120 km", "back 70 km").replace("named Bertha", "named Ludwig")
FILLER = "the weather was fine and nobody thought of anything but the long way home through the hills . "


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, QUESTION), (2, "short one"), (3, None), (4, ""), (5, "1 2 3 4 5 6 7 8"), (6, QUESTION.upper())]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("rows", [2_000_000, 0])
def test_leaks(spark, items, rows):
    docs = docs_frame(spark, [
        (1, FILLER + QUESTION + FILLER, "a"), (2, FILLER * 3 + OTHER, "a"), (3, FILLER * 9, "a"),
        (4, FILLER + QUESTION[:60] + FILLER, "a"), (5, (FILLER + QUESTION).upper(), "a"), (6, (QUESTION + FILLER).lower(), "a"),
        (7, None, None), (8, "", "a"), (9, "9 8 7 6 5 4 3 2 1 0 12 13 14", "a"), (10, "Short one!", "a"),
        (11, FILLER * 20000 + QUESTION, "a"), (12, QUESTION.replace(" ", "\n"), "a"),
    ])
    got = {r.doc_id: r for r in decontamination(docs, items, p=Templates(broadcast_rows=rows)).collect()}
    assert {i for i, r in got.items() if r.contaminated} == {1, 2, 5, 6, 10, 11, 12}
    assert got[2].changed and not got[1].changed and got[1].coverage > 0.85 and got[10].item_id == 2
    assert sorted(r.doc_id for r in without_leaks(docs, items).collect()) == [3, 4, 7, 8, 9]


def test_slots_that_contradict_each_other_do_not_count(spark, items):
    shuffled = QUESTION
    for old, new in (("drives 120", "drives 7"), ("back 120", "back 8"), ("35", "36"), ("2 dollars", "35 dollars")):
        shuffled = shuffled.replace(old, new)
    pair = "It has 12 plums, 12 pears"
    both = spark.createDataFrame([(1, QUESTION), (2, pair)], "item_id long, text string")
    docs = docs_frame(spark, [(1, OTHER, "a"), (2, MIXED, "a"), (3, shuffled, "a"), (4, pair.replace("12 pears", "9 pears"), "a")])
    got = {r.doc_id: (r.contaminated, r.coverage) for r in decontamination(docs, both).collect()}
    assert got[1][0] and got[2][0] and got[3][0] and got[1][1] > got[2][1]
    # of four windows, those with both amounts count for nothing
    assert got[4] == plain_result(docs.collect()[3].text, {1: QUESTION, 2: pair})


def test_long_excerpts_and_common_templates(spark):
    r = random.Random(1)
    long_item = " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    sums = "What is the value of 12 * 7 + 3 - 9 / 4 + 8 * 6?"
    items = spark.createDataFrame([(1, long_item), (2, sums)], "item_id long, text string")
    parts = long_item.split()
    docs = docs_frame(spark, [
        (1, FILLER + " ".join(parts[100:280]) + FILLER, "a"), (2, FILLER + " ".join(parts[100:140]) + FILLER, "a"),
        (3, "She asked what is the value of 5 pounds today. " + FILLER, "a"), (4, FILLER + sums, "a"),
    ])
    got = {r.doc_id: r.item_id for r in decontamination(docs, items).collect() if r.contaminated}
    assert got == {1: 1, 4: 2}


# ---- a plain version

_UNITS = "|".join(sorted(UNITS, key=len, reverse=True))


def plain_tokens(text, names=True):
    joined = regex.sub(r"(?<=\d)[.,:/](?=\d)", INSIDE, text or "")

    def number(m):
        return f" {NUMBER}{m[1]} " + (f"{UNIT}{m[2]} " if m[2] else "")

    marked = regex.sub(rf"(?<![\p{{L}}\d{INSIDE}])(\d[\d{INSIDE}]*)(?: ?((?i:{_UNITS})|%)(?![\p{{L}}\d]))?", number, joined)
    if names:
        marked = regex.sub(r" (?<=[\p{Ll},;] )(?=\p{Lu}\p{Ll})", " " + NAME, marked)
    return [t for t in regex.split(rf"[^\p{{L}}\p{{M}}\p{{N}}{NAME}-{INSIDE}]+", marked.lower()) if t]


def plain_windows(tokens, p, short=()):
    """(pos, key, slots, exact) of every window."""
    out = []
    for length in (p.window, *short):
        for i in range(len(tokens) - length + 1):
            run = tokens[i : i + length]
            slots = tuple(t for t in run if t[0] < INSIDE)
            if slots and length - len(slots) < min(p.literals, length):
                out.append((i, ("exact", *run), (), True))
            else:
                out.append((i, tuple(t[0] if t[0] < INSIDE else t for t in run), slots, False))
    return out


def plain_result(text, items, p=Templates()):
    """(contaminated, coverage of the item covered best) of one document."""
    best = None
    short = {len(t) for x in items.values() for names in (True, False) if 0 < len(t := plain_tokens(x, names)) < p.window}
    ours = plain_windows(plain_tokens(text), p, sorted(short))
    for item in items.values():
        theirs = {}
        for names in (True, False):
            tokens = plain_tokens(item, names)
            for w in plain_windows(tokens, p) if len(tokens) >= p.window else plain_windows(tokens, p, [len(tokens)] if tokens else []):
                theirs[w] = None
        if not theirs:
            continue
        alignments = {}
        for pos, key, slots, _ in ours:
            for item_pos, item_key, item_slots, exact in theirs:
                if key == item_key and len(slots) == len(item_slots):
                    at = alignments.setdefault(pos - item_pos, {})
                    known = at.get(item_pos)
                    new = ((item_slots, slots), exact)
                    at[item_pos] = new if known is None else (max(known[0], new[0]), min(known[1], exact))
        templates, every, longest = set(), set(), 0
        for at in alignments.values():
            met = Counter(x for (a, b), _ in at.values() for x in zip(a, b))
            bound = {}
            for (a, b), n in met.items():
                bound[a] = max(bound.get(a, (0, False, "")), (n, a == b, b))
            kept = {q: (s, e) for q, (s, e) in at.items() if all(bound[a][2] == b for a, b in zip(*s))}
            every |= set(kept)
            templates |= {q for q, (_, e) in kept.items() if not e}
            row = 0
            for q in range(max(kept, default=-1) + 1):
                row = row + 1 if q in kept and kept[q][0][0] == kept[q][0][1] else 0
                longest = max(longest, row)
        if not every:
            continue
        n_templates, n_all = len({w[0] for w in theirs if not w[3]}), len({w[0] for w in theirs})
        share = len(every) / n_all
        if n_templates and len(every) >= p.least_share * n_all:
            share = max(share, len(templates) / n_templates)
        if share >= p.coverage or (longest and longest + p.window - 1 >= p.verbatim):
            best = max(best or 0, share)
    return best is not None, best


@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_version(spark, seed):
    r = random.Random(seed)
    vocabulary = ["pays", "for", "the", "tram", "and", "7", "12", "3 km", "12 km", "Otto", "Mia", "1,200", "5%", "every", "day", "bread,"]

    def text(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    p = Templates(verbatim=14)
    items = {i: text(r.choice((1, 3, 6, 9, 14, 25))) for i in range(12)}
    docs = []
    for i in range(90):
        parts = r.choice(list(items.values())).split()
        start = r.randint(0, len(parts))
        piece = [r.choice(vocabulary) if r.random() < 0.12 else w for w in parts[start // 2 :]]
        docs.append((i, " ".join([text(r.randint(0, 6)), *piece, text(r.randint(0, 6))]), "s"))
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in items.items()], "item_id long, text string, hash string, pos int")
    got = {x.doc_id: (x.contaminated, x.coverage) for x in decontamination(docs_frame(spark, docs), frame, p=p).collect()}
    want = {i: plain_result(t, items, p) for i, t, _ in docs}
    assert got == want and 0 < sum(c for c, _ in want.values()) < len(docs)


def test_empty_tables_and_repeated_rows(spark, items):
    docs = docs_frame(spark, [(1, QUESTION, "a"), (1, QUESTION, "a"), (None, FILLER, "a")])
    assert [r.contaminated for r in decontamination(docs, items.limit(0)).collect()] == [False] * 3
    assert without_leaks(docs, items.limit(0)).count() == 3
    assert without_leaks(docs, items).columns == docs.columns and without_leaks(docs, items).count() == 1
    assert decontamination(docs.limit(0), items).collect() == []


@pytest.mark.parametrize("rows", [2_000_000, 0])
def test_few_words_and_short_items(spark, rows):
    sums, few = "What is 12 * 7 + 3?", "Add 12 km, 30 kg and 9."
    items = spark.createDataFrame(
        [(1, sums), (2, few), (3, "Define entropy"), (4, "Is 7 prime?"), (5, QUESTION), (6, "Solve 3 5 7 9 11 13 15 quickly by some known method")],
        "item_id long, text string",
    )
    docs = docs_frame(spark, [
        (1, FILLER + sums + FILLER, "a"), (2, FILLER + few.lower() + FILLER, "a"), (3, FILLER + "Define entropy. " + FILLER, "a"),
        (4, FILLER + "Is 7 prime? " + FILLER, "a"), (5, FILLER + "Is 8 prime? " + FILLER, "a"), (6, FILLER + OTHER, "a"),
        (7, FILLER + "What is 13 * 8 + 4? " + FILLER, "a"), (8, FILLER + "Define energy. " + FILLER, "a"), (9, "is 7 prime", "a"),
        (10, FILLER + "Solve 2 4 6 8 10 12 14 quickly by some known method " + FILLER, "a"), (11, "define", "a"), (12, None, "a"), (13, "", "a"),
    ])
    got = {r.doc_id: r.item_id for r in decontamination(docs, items, p=Templates(broadcast_rows=rows)).collect() if r.contaminated}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 6: 5, 9: 4, 10: 6}
