"""Wrapper induction: same-host pages are aligned by simple tree matching; what varies in the page body is the article.

1. Every page has a skeleton: the labels of its containers from the body down, outside of articles. Of each host and
   skeleton a bounded sample of pages is taken, ``sample`` at most, one per salt: the page with the least hash of each
   (host, skeleton, salt), which is a partial aggregate, so a host with a third of all pages is no burden. The sample of the
   host is the page with the least hash of each (host, salt).
2. The trees of the sample are compared by simple tree matching (equal labels, most matched pairs, order kept). Pages that
   share ``LAYOUT_SHARE`` of their nodes are one layout and are aligned with its first page. A node whose text agrees on
   all pages of the layout, three or more with different texts, is template; others are slots.
3. The wrapper of a host has the path to the content of each layout: from the body down, as long as one child holds nearly
   all of the slot text that is not in links and not in an element that never belongs to an article (menus, adverts, ...).
   It also has the template nodes that lie outside of ``article`` and ``main``, each as a hash of its labels and its text.
4. Skeletons that are not in the sample of the host, or only in layouts with fewer than three different pages there though the
   host has more, are compared with the first pages of the other layouts, ``SKELETONS`` to a group. One that shares ``LAYOUT_SHARE`` of its nodes is of that layout. The others are layouts of their own, together
   with those of the group that are like them: they have a path and template nodes from their own samples, and the template
   nodes of the host as well. So no layout of a host is left out, however many it has.
5. The wrapper is applied to every page of the host or of the skeleton: the deepest path that leads to text, without the
   template nodes. A page without any of the paths is its own sample.

Only elements that hold blocks (``div``, ``section``, lists, tables, ...) are taken for template, never single paragraphs
or headings, nor what stands beside these, and none that holds half of a page: lines and lists that all articles share stay,
and so do copies of one article. Inside of ``article`` and ``main`` an element is left out by its role (tag, class, id)
alone, never by its text.

Wrappers are broadcast up to ``broadcast_hosts`` hosts, and as many skeletons, some paths and hashes each; beyond that pages
and wrappers are joined on the host, and on host and skeleton.

Defined results: NULL or empty pages give an empty text; a NULL url is the empty host; pages without a body or with broken
markup are read as far as they go; equal pages give equal texts; a host with fewer than three different pages has no template,
and a layout of its own (step 4) with fewer has only that of the host; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Set
from itertools import groupby

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .dom import BLOCK, VOID, Element, blocks, parse
from .url_trie import url_parts


#: levels that are aligned; what lies deeper belongs to the node above it
MATCHED_DEPTH = 100
#: equal children in a row that are aligned one by one, first ones and last ones; what lies between is one repeated slot
RUN_ENDS = (6, 2)
#: pairs of nodes that are looked at for one alignment; beyond it nodes match by their labels alone
MATCHED_PAIRS = 200_000
#: share of matched nodes from which on two pages are of one layout
LAYOUT_SHARE = 0.6
#: skeletons of a host, on average, that are compared with its layouts and with each other in one group
SKELETONS = 16

# Elements that hold blocks and may be template.
CONTAINERS = frozenset("div section ul ol dl table tbody tr td center address span figure details fieldset".split())


def simple_tree_matching(
    a: Element,
    b: Element,
    pairs: list[tuple[Element, Element]] | None = None,
    depth: int = MATCHED_DEPTH,
    known: dict[tuple[int, int], tuple[int, list[tuple[Element, Element]]]] | None = None,
) -> int:
    """The number of matched nodes of two trees with equal root labels, order kept; ``pairs`` gets the matching.

    Long runs of children with one label (paragraphs, items) are matched by their ends: they are one repeated slot.
    Nodes more than ``depth`` levels down are not looked at. ``known`` keeps what was matched below a pair of nodes.
    """
    if a.label != b.label:
        return 0
    known = {} if known is None else known
    size = _matched(a, b, depth, known)
    if pairs is not None:
        stack = [(a, b)]
        while stack:
            x, y = stack.pop()
            pairs.append((x, y))
            stack += known.get((id(x), id(y)), (1, []))[1]
    return size


def _matched(a: Element, b: Element, depth: int, known: dict) -> int:
    """Matched nodes of two trees whose roots match; ``known`` gets the matched children of all pairs."""
    if (id(a), id(b)) in known:
        return known[id(a), id(b)][0]
    if not depth or len(known) >= MATCHED_PAIRS:
        return 1
    xs, ys = _ends_of_runs(a), _ends_of_runs(b)
    weight = [[_matched(x, y, depth - 1, known) if x.label == y.label else 0 for y in ys] for x in xs]
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i in range(len(xs)):
        for j in range(len(ys)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight[i][j])
    chosen = []
    i, j = len(xs), len(ys)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            chosen.append((xs[i], ys[j]))
    known[id(a), id(b)] = 1 + best[-1][-1], chosen
    return 1 + best[-1][-1]


def _ends_of_runs(x: Element) -> list[Element]:
    """The children, of more than ``sum(RUN_ENDS)`` equal ones in a row the first and last ones."""
    out: list[Element] = []
    for _, run in groupby(x.children, key=lambda c: c.label):
        same = list(run)
        first, last = RUN_ENDS
        out += same if len(same) <= first + last else same[:first] + same[-last:]
    return out


def _nodes(x: Element, depth: int = MATCHED_DEPTH) -> Counter[str]:
    """The nodes that a matching of the tree with itself would match, by their labels."""
    labels, stack = [], [(x, depth)]
    while stack:
        y, left = stack.pop()
        labels.append(y.label)
        if left:
            stack += [(c, left - 1) for c in _ends_of_runs(y)]
    return Counter(labels)


def _body(page: Element) -> Element:
    """The body, or what stands for it."""
    while inner := next((c for c in page.children if c.tag in ("body", "html")), None):
        page = inner
        if page.tag == "body":
            break
    return page


def _mass(x: Element, template: set[int]) -> int:
    """Characters below an element that may be article text."""
    total, stack = 0, [x]
    while stack:
        y = stack.pop()
        if isinstance(y, str):
            total += len(" ".join(y.split()))
        elif not (y.left_out() or y.tag == "a" or id(y) in template):
            stack += y.inner
    return total


def _text(x: Element) -> str:
    return "\n".join(blocks(x))


def constant_nodes(pages: list[Element]) -> set[int]:
    """The ``id`` of the nodes of the first page whose text agrees on all pages they are matched on, two more at least.

    Pages with one text are one page. A node that holds half of the largest page is no template.
    """
    bodies = _different(pages)
    found: dict[int, tuple[Element, list[Element]]] = {}
    for other in bodies[1:]:
        pairs: list[tuple[Element, Element]] = []
        simple_tree_matching(bodies[0], other, pairs)
        for x, y in pairs:
            found.setdefault(id(x), (x, []))[1].append(y)
    most = max((_mass(b, set()) for b in bodies), default=0) / 2
    return {
        key
        for key, (x, others) in found.items()
        if len(others) > 1 and _mass(x, set()) < max(most, 1) and len({_text(x), *map(_text, others)}) == 1
    }


def _alike(a: Element, b: Element, nodes_a: Counter[str], nodes_b: Counter[str]) -> bool:
    """Whether two pages, with the labels that a matching looks at, share ``LAYOUT_SHARE`` of their nodes."""
    least = LAYOUT_SHARE * (nodes_a.total() + nodes_b.total())
    # no matching has more nodes of a label than the page with fewer of them
    if 2 * (nodes_a & nodes_b).total() < least:
        return False
    return 2 * simple_tree_matching(_body(a), _body(b)) >= least


def _different(pages: list[Element]) -> list[Element]:
    """The bodies of the pages, one for each text."""
    bodies: dict[str, Element] = {}
    for body in map(_body, pages):
        bodies.setdefault(_text(body), body)
    return list(bodies.values())


def layouts(pages: list[Element]) -> list[list[Element]]:
    """Pages that share ``LAYOUT_SHARE`` of their nodes with the first one of a group; others found a group."""
    groups: list[list[Element]] = []
    nodes = {id(p): _nodes(_body(p)) for p in pages}
    for page in pages:
        for group in groups:
            if _alike(group[0], page, nodes[id(group[0])], nodes[id(page)]):
                group.append(page)
                break
        else:
            groups.append([page])
    return groups


def induce(pages: list[Element], share: float = 0.9) -> list[str]:
    """The labels from the body to the content, after alignment of all pages with the first."""
    return _path(pages[0], constant_nodes(pages), share)


def _path(page: Element, template: set[int], share: float = 0.9) -> list[str]:
    path, node = [], _body(page)
    while node.tag not in ("article", "main"):
        masses = {id(c): _mass(c, template) for c in node.children}
        whole = _mass(node, template) or sum(masses.values())
        heavy = max(node.children, key=lambda c: masses[id(c)], default=None)
        if heavy is None or not whole or masses[id(heavy)] < share * whole or heavy.tag in ("p", "a", "span", "b", "i"):
            break
        # a run of equal children is one slot; none of them is the content alone
        if sum(c.label == heavy.label for c in node.children) > 1:
            break
        path.append(heavy.label)
        node = heavy
    return path


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts))) - 2**63


def _containers(page: Element, visit: Callable[[Element, int], bool]) -> None:
    """Calls ``visit`` with elements outside of the article that may be template, outer ones first, and the hash of their
    labels from the body on. What is inside of an element is passed over if ``visit`` is true for it, or if the element
    holds text, paragraphs or headings itself, as articles do."""
    stack = [(_body(page), 0, MATCHED_DEPTH)]
    while stack:
        x, place, left = stack.pop()
        if left and not (place and visit(x, place)) and _frame(x):
            inner = (c for c in x.children if c.tag in CONTAINERS and not c.left_out())
            stack += [(c, _hash(place, c.label), left - 1) for c in inner]


def _frame(x: Element) -> bool:
    """Whether an element holds nothing but containers, articles and what never belongs to one."""
    return all(
        not y.strip() if isinstance(y, str) else y.tag in CONTAINERS or y.tag in VOID or y.tag in ("article", "main") or y.left_out()
        for y in x.inner
    )


def template_keys(page: Element, constant: set[int]) -> set[int]:
    """The outermost constant containers of a page, each as the hash of its place and the hash of place and text."""
    keys: set[int] = set()

    def visit(x: Element, place: int) -> bool:
        if id(x) not in constant or not (text := _text(x)):
            return False
        keys.update((place, _hash(place, text)))
        return True

    _containers(page, visit)
    return keys


def template_nodes(page: Element, keys: Set[int]) -> set[int]:
    """The ``id`` of the outermost containers of a page that are template."""
    nodes: set[int] = set()

    def visit(x: Element, place: int) -> bool:
        if place not in keys or _hash(place, _text(x)) not in keys:
            return False
        nodes.add(id(x))
        return True

    if keys:
        _containers(page, visit)
    return nodes


def _at(page: Element, path: list[str]) -> list[Element]:
    found = [_body(page)]
    for label in path:
        found = [child for x in found for child in x.children if child.label == label]
    return found


def article_text(tree: Element, paths: list[list[str]], keys: Set[int] = frozenset()) -> str:
    """The text at the deepest path that leads to some, without template nodes; by the page alone if there is none."""
    for without in (template_nodes(tree, keys), frozenset()):
        for path in sorted(paths, key=len, reverse=True):
            if texts := [b for root in _at(tree, path) for b in blocks(root, without)]:
                return "\n".join(texts)
        if not without:
            break
    return "\n".join(b for root in _at(tree, induce([tree])) for b in blocks(root))


def extract(page: str | None, path: list[str] | None) -> str:
    """The article text of a page by one path, or by its own tree where that does not fit."""
    return article_text(parse(page), [path] if path is not None else []) if page else ""


def skeleton(page: Element) -> int:
    """A hash of the paths of labels from the body to all containers, as far as a path to the content may go."""
    places, stack = set(), [(_body(page), 0, MATCHED_DEPTH)]
    while stack:
        x, place, left = stack.pop()
        places.add(place)
        if left and x.tag not in ("article", "main"):
            inner = (c for c in x.children if _holds_blocks(c) and not c.left_out())
            stack += [(c, _hash(place, c.label), left - 1) for c in inner]
    return _hash(*sorted(places))


def _holds_blocks(x: Element) -> bool:
    return x.tag in CONTAINERS or x.tag in ("article", "main") or any(c.tag in BLOCK for c in x.children)


def _skeleton(html: str) -> Column:
    @F.arrow_udf("bigint")
    def of(html_: pa.Array) -> pa.Array:
        return pa.array([skeleton(parse(h)) if h is not None else None for h in html_.to_pylist()], type=pa.int64())

    return of(html)


def sampled_pages(parts: DataFrame, sample: int) -> DataFrame:
    """(host, skeleton, salt, h, html) from (host, html): the page with the least hash of each host, skeleton and salt."""
    spread = parts.where("html is not null").select("host", _skeleton("html").alias("skeleton"), F.xxhash64("html").alias("h"), "html")
    salted = spread.withColumn("salt", F.pmod("h", F.lit(sample)))
    return salted.groupBy("host", "skeleton", "salt").agg(F.min("h").alias("h"), F.min_by("html", "h").alias("html"))


def host_wrappers(picked: DataFrame) -> DataFrame:
    """(w_host, paths, template, skeletons, firsts, few) from ``sampled_pages``: a path per layout and hashes of template nodes.

    Of the layouts with three different pages or more in the sample of the host there are the skeletons and the first pages, of
    the others the skeletons, one per page.
    """
    of_host = picked.groupBy("host", "salt").agg(F.min_by(F.struct("skeleton", "html"), "h").alias("page"))

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("salt")
        trees = [parse(x) for x in rows["html"]]
        origin = {id(tree): (label, text) for tree, label, text in zip(trees, rows["skeleton"], rows["html"])}
        paths, template, skeletons, firsts, few = [], set(), set(), [], []
        for pages in layouts(trees):
            constant = constant_nodes(pages)
            paths.append(_path(pages[0], constant))
            template |= template_keys(pages[0], constant)
            labels = [origin[id(page)][0] for page in pages]
            if len(_different(pages)) > 2:
                skeletons.update(labels)
                firsts.append(origin[id(pages[0])][1])
            else:
                few += labels
        row = {
            "w_host": rows["host"].iloc[0],
            "paths": [list(p) for p in dict.fromkeys(map(tuple, paths))],
            "template": sorted(template),
            "skeletons": sorted(skeletons),
            "firsts": firsts,
            "few": few,
        }
        return pd.DataFrame([row])

    schema = "w_host string, paths array<array<string>>, template array<bigint>, skeletons array<bigint>, firsts array<string>, few array<bigint>"
    return of_host.select("host", "salt", "page.*").groupBy("host").applyInPandas(learn, schema)


def other_skeletons(picked: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, skeleton, part) of the skeletons that the wrapper of their host does not stand for, dealt to groups."""
    keys = ["host", "skeleton"]
    known = wrappers.select(F.col("w_host").alias("host"), F.explode("skeletons").alias("skeleton"))
    few = wrappers.select(F.col("w_host").alias("host"), F.explode("few").alias("skeleton")).groupBy(*keys).agg(F.count(F.lit(1)).alias("seen"))
    pages = picked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    others = pages.join(known, keys, "left_anti").join(few, keys, "left").where("seen is null or n > seen").select(*keys)
    parts = others.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / SKELETONS).cast("int").alias("parts"))
    return others.join(parts, "host").select(*keys, F.pmod("skeleton", "parts").cast("int").alias("part"))


def skeleton_wrappers(picked: DataFrame, wrappers: DataFrame, others: DataFrame) -> DataFrame:
    """(s_host, s_skeleton, s_paths, s_template) of the skeletons in ``others`` that are of no layout of the host's sample."""
    pages = picked.join(others, ["host", "skeleton"])
    groups_of_host = others.select(F.col("host").alias("w_host"), F.col("part").alias("w_part")).distinct()
    known = wrappers.select("w_host", "template", "firsts").join(groups_of_host, "w_host")

    def learn(rows: pd.DataFrame, of_host: pd.DataFrame) -> pd.DataFrame:
        keys = frozenset(map(int, of_host["template"].iloc[0]))
        host_pages = [parse(text) for text in of_host["firsts"].iloc[0]]
        host_layouts = [(page, _nodes(_body(page))) for page in host_pages]
        groups: list[tuple[Element, Counter[str], list[int], list[Element]]] = []
        for label, same in rows.sort_values(["skeleton", "salt"]).groupby("skeleton", sort=True):
            pages_ = [parse(text) for text in same["html"]]
            first, nodes = pages_[0], _nodes(_body(pages_[0]))
            if any(_alike(page, first, other, nodes) for page, other in host_layouts):
                continue
            for page, other, labels, members in groups:
                if _alike(page, first, other, nodes):
                    labels.append(label)
                    members += pages_
                    break
            else:
                groups.append((first, nodes, [label], pages_))
        out = []
        for first, _, labels, members in groups:
            constant = constant_nodes(members)
            path = _path(first, constant | template_nodes(first, keys))
            template = sorted(keys | template_keys(first, constant))
            out += [(rows["host"].iloc[0], label, [path], template) for label in labels]
        return pd.DataFrame(out, columns=["s_host", "s_skeleton", "s_paths", "s_template"])

    schema = "s_host string, s_skeleton bigint, s_paths array<array<string>>, s_template array<bigint>"
    return pages.groupBy("host", "part").cogroup(known.groupBy("w_host", "w_part")).applyInPandas(learn, schema)


def extract_articles(
    pages: DataFrame, html: str = "html", url: str = "url", id_col: str = "page_id", sample: int = 12, broadcast_hosts: int = 100_000
) -> DataFrame:
    """One row per page: id, url, text and n_chars."""
    host, _ = url_parts(pages[url])
    parts = pages.select(pages[id_col].alias("id"), pages[url].alias("url"), pages[html].alias("html"), host.alias("host"))
    picked = stored(sampled_pages(parts.select("host", "html"), sample), "sample")
    wrappers = stored(host_wrappers(picked), "wrappers")
    others = stored(other_skeletons(picked, wrappers), "skeletons")

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= broadcast_hosts else df

    by_host = small(wrappers.select("w_host", "paths", "template"))
    joined = parts.join(by_host, F.col("host") == F.col("w_host"), "left")
    if not others.isEmpty():
        by_skeleton = small(stored(skeleton_wrappers(picked, wrappers, others), "wrappers"))
        same = (F.col("host") == F.col("s_host")) & (F.col("skeleton") == F.col("s_skeleton"))
        joined = joined.withColumn("skeleton", _skeleton("html")).join(by_skeleton, same, "left")
        joined = joined.withColumns({c: F.coalesce(f"s_{c}", c) for c in ("paths", "template")})

    @F.arrow_udf("string")
    def article(html_: pa.Array, paths: pa.Array, template: pa.Array) -> pa.Array:
        rows = zip(html_.to_pylist(), paths.to_pylist(), template.to_pylist())
        texts = [article_text(parse(h), p or [], frozenset(t or ())) if h else "" for h, p, t in rows]
        return pa.array(texts, type=pa.string())

    return joined.select(F.col("id").alias(id_col), "url", article("html", "paths", "template").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
