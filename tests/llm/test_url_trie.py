import random

import pytest

from vuelometria.llm.url_trie import filter_urls

RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
    ("block", "com/fr"), ("allow", "a.com/fr/x/y"), ("block", "B.COM"), ("block", "dup.net/"), ("allow", "dup.net/"),
]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:end].translate(LOWER), rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for verdict, rule in RULES:
        rh, slash, rp = rule.partition("/")
        rh, rp = rh.translate(LOWER), slash + rp
        if (host == rh or host.endswith("." + rh)) and path.startswith(rp):
            best = max(best or (), (rh.count(".") + 1, len(rp), verdict == "allow", rule, verdict))
    return host, path, best and best[3], best[4] if best else "allow"


@pytest.mark.parametrize("limit", [100, 0])
def test_longest_match(spark, limit):
    r = random.Random(5)
    urls = [None, "", "x", "://", "http://", "http://ORG", "http://com/fr", "ftp://a.b.com?x=/de/", "http://dup.net/", "a://b://com/fr/"]
    urls += [
        "http://" + ".".join(r.choice(("a", "b", "example", "m")) for _ in range(r.randint(0, 2))) + r.choice((".org", ".com", ".net", "com"))
        + r.choice(("", "/")) + "/".join(r.choice(("fr", "de", "en", "es", "1", "12", "x", "y", "")) for _ in range(4)) + r.choice(("", "?q", "#a"))
        for _ in range(400)
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {x.page_id: tuple(x)[1:] for x in filter_urls(pages, RULES, max_rules=limit).collect()}
    assert got == {i: plain(u) for i, u in enumerate(urls)}


def test_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")] * 2 + [(None, None)], "page_id long, url string")
    for limit in (10, -1):
        assert {x.verdict for x in filter_urls(pages, [], default="block", max_rules=limit).collect()} == {"block"}
        assert filter_urls(pages.limit(0), RULES, max_rules=limit).collect() == []
    with pytest.raises(ValueError):
        filter_urls(pages, [("maybe", "org/")]).collect()
    with pytest.raises(ValueError):
        filter_urls(pages, [("allow", "/x")]).collect()
