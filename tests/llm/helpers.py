"""Plain Python versions of what the operators compute, for small tables."""

import re
from collections import Counter, defaultdict

WORD = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(WORD, text or "")


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def components(texts, percent=80, size=5):
    """id -> smallest id reachable over links of similar shingle sets."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    seen = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in seen[s])
        for s in sets[i]:
            seen[s].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def docs_frame(spark, rows):
    """(doc_id, text, source) rows as documents, with columns whose names the operators use themselves."""
    schema = "doc_id long, text string, source string, lang string, n_chars long, k1 string, host string, size string, rank int"
    full = [(i, t, s, "en", len(t) if t is not None else None, "k", "h", "z", 1) for i, t, s in rows]
    return spark.createDataFrame(full, schema)
