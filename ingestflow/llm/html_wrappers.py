"""Main text of web pages by wrappers inferred per host (operator 2).

A wrapper is a union-free regular expression over block elements: a tree of
elements, each marked optional or repeated, with text slots.  It is inferred
from the pages of one host: a page's token stream becomes a tree in which
neighbouring equal elements fold into a repeated group; two trees are aligned
element by element, and what only one of them has becomes optional, what
repeats in either becomes a repeated group, and where texts differ the text
becomes a slot of data.

Every page takes part.  Pages of a host with the same tree are one row before
anything is aligned, trees are merged first within ``MERGE_GROUPS`` groups of
a host and then across them, and the text statistics of the slots are sums, so
a host with a third of all pages costs no task more than its different trees.

The wrapper's slots are then judged once for the host: boilerplate by element,
role, class and id, where class and id words do not leave out what holds most of
the text (see ``spared``); every content region (article, main, or a content class),
in an order of preference; and blocks that are neither mostly links nor the
same on all pages.  Extraction aligns each page with its host's wrapper and
joins the text of its regions: of those that the page has, and that hold at
least half as much text as its largest, the first in the host's order, and all
regions beside it (not around or within it), in page order.  A page with no
region gives the blocks.

Block texts: character references decoded, runs of white space one space,
trimmed, empty ones left out, joined in page order by ``\\n``.

Defined results: a null or empty page has an empty text; a page without a URL
or host belongs to the host ``""``; unclosed and stray tags are mended as
browsers do, and elements nested deeper than ``MAX_DEPTH`` are flat; every row gives one result row, repeated rows and null ids
included; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.llm.common import Workspace
from ingestflow.llm.url_rules import host_of

MERGE_GROUPS = 64
# Wrappers of all hosts are broadcast up to this size, and joined by host beyond it.
BROADCAST_BYTES = 16 << 20

# A quoted value may hold a ">".
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|"
                   r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*)(?:>|$)""", re.S)
# Elements nested deeper are taken as parts of the one at this depth, as browsers bound their trees.
MAX_DEPTH = 200
# Numbers of an alignment's table held at once.
TABLE_CELLS = 1 << 22
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
                       re.I)
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
BLOCKS = {"html", "body", "head", "address", "article", "aside", "blockquote", "center", "dd",
          "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
          "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li",
          "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
          "tfoot", "th", "thead", "tr", "ul", "button", "select", "option", "label", "legend",
          "caption", "object", "canvas"}
# An element of the key ends an open one of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = {"ul", "ol", "dl", "table", "tbody", "select", "body", "article", "section", "div", "main"}

BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "option", "menu", "dialog",
                    "label", "legend", "fieldset", "head", "object", "canvas", "hidden"}
BOILERPLATE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "menu nav navbar navigation topnav sidebar sidenav footer header masthead topbar cookie cookies "
    "consent gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup "
    "share sharing social related recommended recommendations trending breadcrumb breadcrumbs "
    "pagination pager comment comments commentlist reply replies respond discussion disqus widget "
    "widgets login search toolbar copyright disclaimer hidden skip tagcloud".split())
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form",
                     "dialog", "alert", "menu", "menubar", "toolbar"}
# Such words tell what readers wrote, however much it is.
DISCUSSION_WORDS = {"comment", "comments", "commentlist", "reply", "replies", "respond", "discussion",
                    "disqus"}
# "has-sidebar" says nothing of what the element is.
COMPOUNDS = {"has", "no", "with", "without"}
CONTENT_WORDS = {"article", "articlebody", "post", "entry", "story", "content", "main", "maincontent"}


class Node:
    """A block element; ``texts`` and ``children`` in page order."""

    __slots__ = ("tag", "label", "parts", "link")

    def __init__(self, tag: str, label: str):
        self.tag, self.label = tag, label
        self.parts: list = []  # Node, or [text, characters in links]


def _words(token: str) -> list[str]:
    """The words of a class; what it has, has not or comes with is one word with that."""
    words = [w for w in re.split(r"[^a-z]+", token) if w]
    at = next((i for i, w in enumerate(words[:-1]) if w in COMPOUNDS), len(words))
    return words[:at] + ["-".join(words[at:])] * (at < len(words))


def _label(tag: str, attributes: str) -> str:
    """The element with what its attributes say of its purpose; digits of ids do not tell pages apart."""
    words = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1-\2", "".join(values)).lower()
        if name.lower() == "hidden":
            words.add("hidden")
        else:
            found = {w for t in value.split() for w in _words(t)}
            if name.lower() == "role":
                found = {f"role:{w}" for w in found}
            elif name.lower() != "class":  # ids may differ from page to page
                found &= BOILERPLATE_WORDS | CONTENT_WORDS
            words |= found
    return " ".join([tag, *sorted(words)])


def parse(page: str | None) -> Node:
    """The tree of block elements of a page."""
    root = Node("", "")
    stack, at, links, text = [root], 0, 0, []

    def flush() -> None:
        if text:
            joined = " ".join(entities.unescape("".join(t for t, _ in text)).split())
            if joined:
                linked = sum(len(t) for t, in_link in text if in_link)
                stack[-1].parts.append([joined, min(linked, len(joined))])
            text.clear()

    def leave(depth: int) -> None:
        flush()
        del stack[depth:]

    page = page or ""
    while at < len(page):
        m = TOKEN.search(page, at)
        upto = m.start() if m else len(page)
        if upto > at:
            text.append((page[at:upto], links > 0))
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        leave(depth)
                        break
                links = 0
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            if end and not end.group().endswith(">"):
                close = page.find(">", at)
                at = close + 1 if close >= 0 else len(page)
            continue
        if tag == "a":
            links += 1
        elif tag == "br":
            text.append((" ", False))
        elif tag in BLOCKS:
            flush()
            links = 0
            ends = CLOSES.get(tag, set())
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = stack[depth].tag
                if open_tag in ends or open_tag == "p":
                    leave(depth)
                    if open_tag != "p":
                        break
                elif open_tag in SCOPES:
                    break
            if tag != "hr":
                node = Node(tag, _label(tag, m.group(3)))
                if len(stack) > MAX_DEPTH:
                    node.parts = stack[-1].parts
                else:
                    stack[-1].parts.append(node)
                if tag not in VOID and not m.group(3).endswith("/"):
                    stack.append(node)
    flush()
    return root


# A wrapper is [label, repeated, optional, children]; a text slot has the label "#".

def fold(node: Node) -> tuple[list, list]:
    """The wrapper of one element, and for each wrapper child the page parts it stands for."""
    shapes, parts = [], []
    for part in node.parts:
        shape = fold(part)[0] if isinstance(part, Node) else ["#", 0, 0, []]
        if shapes and shapes[-1][0] == shape[0] and _alike(shapes[-1], shape):
            merged = shapes[-1] if shapes[-1][3] == shape[3] else align(shapes[-1], shape)
            shapes[-1] = [merged[0], 1, 0, merged[3]]
            parts[-1].append(part)
        else:
            shapes.append(shape)
            parts.append([part])
    return [node.label, 0, 0, shapes], parts


def _alike(a: list, b: list) -> bool:
    """Neighbours of one label are a repeated group unless their contents have nothing in common."""
    if a[3] == b[3] or not a[3] or not b[3]:
        return True
    return bool({c[0] for c in a[3]} & {c[0] for c in b[3]})


def _matches(a: list[list], b: list[list]) -> list[tuple[int, int]]:
    """Pairs of a longest common subsequence of labels, preferring children in common.

    The table is computed row by row; of large ones only some rows are kept,
    and those between are computed again when the pairs are read off.
    """
    n, m = len(a), len(b)
    if [x[0] for x in a] == [y[0] for y in b]:
        return [(i, i) for i in range(n)]
    if not n or not m:
        return []
    # What two elements weigh depends on their labels and their children's labels alone.
    kinds: dict[tuple, int] = {}
    of_a, of_b = ([kinds.setdefault((x[0], frozenset(c[0] for c in x[3])), len(kinds)) for x in side]
                  for side in (a, b))
    pairs = np.zeros((len(kinds), len(kinds)), np.int32)
    for (label, held), i in kinds.items():
        for (other, theirs), j in kinds.items():
            if label == other:
                pairs[i, j] = 2 + (not held or not theirs or bool(held & theirs))
    of_b = np.array(of_b)

    def above(row: np.ndarray, i: int) -> np.ndarray:
        """The table's row ``i`` from the row ``i + 1``; its last entry is 0."""
        weight = pairs[of_a[i]][of_b]
        best = row.copy()
        np.maximum(best[:-1], np.where(weight, row[1:] + weight, 0), out=best[:-1])
        return np.maximum.accumulate(best[::-1])[::-1]

    step = max(1, min(n, TABLE_CELLS // (m + 1)), int(n ** 0.5))
    kept = {n: np.zeros(m + 1, np.int32)}
    row = kept[n]
    for i in range(n - 1, -1, -1):
        row = above(row, i)
        if i % step == 0:
            kept[i] = row
    out, i, j = [], 0, 0
    rows: dict[int, np.ndarray] = {}
    while i < n and j < m:
        if i + 1 not in rows or i not in rows:
            upto = min(n, (i // step + 1) * step)
            rows, row = {upto: kept[upto]}, kept[upto]
            for k in range(upto - 1, i // step * step - 1, -1):
                rows[k] = row = above(row, k)
        weight = pairs[of_a[i], of_b[j]]
        if weight and rows[i][j] == rows[i + 1][j + 1] + weight:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif rows[i][j] == rows[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def align(a: list, b: list) -> list:
    """The union-free expression that covers both wrappers of one element."""
    if a == b:
        return a
    out, i, j = [], 0, 0
    for p, q in [*_matches(a[3], b[3]), (len(a[3]), len(b[3]))]:
        for x in (*a[3][i:p], *b[3][j:q]):
            out.append([x[0], x[1], 1, x[3]])
        if p < len(a[3]):
            x, y = a[3][p], b[3][q]
            both = align(x, y)
            out.append([x[0], x[1] | y[1], x[2] | y[2], both[3]])
        i, j = p + 1, q + 1
    return [a[0], a[1] | b[1], a[2] | b[2], out]


def slots(node: Node, path: str = "") -> Iterator[tuple[str, str, int]]:
    """(path, text, characters in links) of every text of a page."""
    for part in node.parts:
        if isinstance(part, Node):
            yield from slots(part, f"{path}/{part.label}")
        else:
            yield path, part[0], part[1]


def is_firm(label: str) -> bool:
    """Boilerplate by element or role."""
    tag, *words = label.split()
    return tag in BOILERPLATE_TAGS or any(
        w.removeprefix("role:") in BOILERPLATE_ROLES and ":" in w for w in words)


def is_boilerplate(label: str) -> bool:
    return is_firm(label) or any(w in BOILERPLATE_WORDS for w in label.split()[1:])


def is_article(label: str) -> bool:
    tag, *words = label.split()
    return tag in ("article", "main") or "role:main" in words


def page_slots(root: Node) -> dict[str, list]:
    """By path of a page's texts: characters, those in links, and a hash of the texts.

    Each has also the characters outside links of the whole page, and of its
    articles, without what is boilerplate by element or role.
    """
    by: dict[str, list] = {}
    for path, text, linked in slots(root):
        s = by.setdefault(path, [0, 0, xxhash.xxh64()])
        s[0] += len(text)
        s[1] += linked
        s[2].update(text + "\n")
    whole = article = 0
    for path, (chars, linked, _) in by.items():
        labels = path.split("/")[1:]
        if not any(map(is_firm, labels)):
            whole += chars - linked
            article += (chars - linked) * any(map(is_article, labels))
    return {p: [c, k, h.intdigest() - (1 << 63), whole, article] for p, (c, k, h) in by.items()}


def spared(wrapper: list, stats: dict[str, tuple]) -> set[str]:
    """Paths of elements whose class says boilerplate but which hold what their pages are about.

    That is: body and html; what holds most of the text of the pages that have
    it, where they have no article beside it; and what holds most of their
    articles' text and a fifth of all.  Readers' comments in an article are
    never that.
    """
    out: set[str] = set()

    def weigh(node: list, path: str, inside: bool, clean: bool) -> tuple[float, float, float, float]:
        here = f"{path}/{node[0]}" if node[0] else ""
        if node[0] and is_firm(node[0]):
            return 0, 0, 0, 0
        soft = bool(node[0]) and is_boilerplate(node[0])
        of_article = inside or bool(node[0]) and is_article(node[0])
        chars, links, _, _, whole, article = stats.get(here, (0,) * 6)
        own = held = chars - links
        held *= of_article
        for c in node[3]:
            if c[0] != "#":
                v, w, a, b = weigh(c, here, of_article, clean or bool(node[0]) and not soft and is_content(node[0]))
                own, whole, held, article = own + v, max(whole, w), held + a, max(article, b)
        if soft:
            tag, *words = node[0].split()
            most = own > 0.5 * whole and article - held < 0.25 * own
            articles = not inside and held > 0.5 * article and own > 0.2 * whole
            told = clean and bool(DISCUSSION_WORDS & set(words))
            if tag in ("html", "body") or own and (most or articles) and not told:
                out.add(here)
        return own, whole, held, article

    weigh(wrapper, "", False, False)
    return out


def is_content(label: str) -> bool:
    tag, *words = label.split()
    return tag in ("article", "main") or "role:main" in words or bool(CONTENT_WORDS & set(words))


def judge(wrapper: list, stats: dict[str, tuple], pages: int) -> list:
    """The wrapper with what to keep in place of each element's marks.

    The first mark is 0 for left out, 1 for kept in a content region and 2 for
    kept by the block rule too; the second is 0, or the content region that the
    element is, numbered in the host's order of preference.  Elements of one
    tag under one path are one region, whatever else their classes say.

    ``stats``: by path, the texts' characters, characters in links, pages,
    whether all pages have the same text there, and the characters outside
    links of those pages and of their articles.
    """
    held = spared(wrapper, stats)

    def drops(label: str, here: str) -> bool:
        return bool(label) and is_boilerplate(label) and here not in held

    def volume(node: list, path: str, inside: bool) -> float:
        here = f"{path}/{node[0]}"
        if drops(node[0], here) or (node[0].split()[0] == "header" and not inside):
            return 0
        own = stats.get(here, (0,) * 6)
        inside = inside or is_content(node[0])
        return own[0] - own[1] + sum(volume(c, here, inside) for c in node[3] if c[0] != "#")

    volumes: dict[tuple[str, str], float] = {}

    def regions(node: list, path: str) -> None:
        here = f"{path}/{node[0]}" if node[0] else ""
        if drops(node[0], here):
            return
        if node[0] and is_content(node[0]):
            of = path, node[0].split()[0]
            volumes[of] = volumes.get(of, 0) + volume(node, path, False)
        for c in node[3]:
            if c[0] != "#":
                regions(c, here)

    regions(wrapper, "")
    # The innermost of the regions that hold nearly as much as the largest; articles before others.
    order: dict[tuple[str, str], int] = {}
    left = sorted((r for r in volumes if volumes[r] > 0), key=lambda r: (-volumes[r], r))
    while left:
        n = sum(volumes[r] >= 0.8 * volumes[left[0]] for r in left)
        for r in sorted(left[:n], key=lambda r: (r[1] == "article", len(r[0])), reverse=True):
            order[r] = len(order) + 1
        left = left[n:]

    def mark(node: list, path: str, inside: bool, dropped: bool) -> list:
        here = f"{path}/{node[0]}" if node[0] else ""
        tag = node[0].split()[0] if node[0] else ""
        dropped = dropped or drops(node[0], here)
        region = order.get((path, tag), 0) if node[0] and is_content(node[0]) and not dropped else 0
        inside = inside or region > 0
        dropped = dropped or tag == "header" and not inside
        chars, links, seen, same, _, _ = stats.get(here, (0,) * 6)
        block = not (chars and links > 0.5 * chars) and not (same and seen >= 3 and pages >= 3)
        keep = 0 if dropped else 1 + block
        return [node[0], keep, region, [mark(c, here, inside, dropped) for c in node[3] if c[0] != "#"]]

    return mark(wrapper, "", False, False)


def extract(root: Node, judged: list) -> str:
    """The kept texts of a page, found by aligning it with its host's judged wrapper."""
    found: list[tuple[str, int, int, tuple[int, ...]]] = []

    def walk(node: Node, shape: list, groups: list, wrapper: list, inside: tuple[int, ...]) -> None:
        elements = [k for k, s in enumerate(shape[3]) if s[0] != "#"]
        to = {elements[i]: j for i, j in _matches([shape[3][k] for k in elements], wrapper[3])}
        by_label = {w[0]: w for w in reversed(wrapper[3])}
        if wrapper[2]:
            inside = (*inside, wrapper[2])
        for k, group in enumerate(groups):
            for part in group:
                if not isinstance(part, Node):
                    if wrapper[1]:
                        found.append((part[0], len(part[0]) - part[1], wrapper[1], inside))
                    continue
                of = wrapper[3][to[k]] if k in to else by_label.get(part.label, [part.label, 0, 0, []])
                inner, inner_groups = fold(part)
                walk(part, inner, inner_groups, of, inside)

    shape, groups = fold(root)
    walk(root, shape, groups, judged, ())
    held: dict[int, int] = {}
    for _, size, _, inside in found:
        for region in inside:
            held[region] = held.get(region, 0) + size
    if not held:
        return "\n".join(text for text, _, keep, _ in found if keep == 2)
    most = max(held.values())
    chosen = {min(region for region, size in held.items() if size >= 0.5 * most)}
    # Regions beside the chosen one hold content too; those around or within it are the same content.
    together = {frozenset((x, y)) for _, _, _, inside in found for x in inside for y in inside}
    for region in sorted(held):
        if not any(frozenset((region, c)) in together for c in chosen):
            chosen.add(region)
    return "\n".join(text for text, _, _, inside in found if not chosen.isdisjoint(inside))


SLOT = ("array<struct<path: string, chars: long, links: long, text: long, whole: long, "
        "article: long>>")


def shapes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, tree, page, slots`` of every page: its folded tree and text statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("path", pa.string()), ("chars", pa.int64()), ("links", pa.int64()),
                                   ("text", pa.int64()), ("whole", pa.int64()), ("article", pa.int64())]))
        for batch in batches:
            trees, digests, found = [], [], []
            for page in batch.column(1).to_pylist():
                root = parse(page)
                trees.append(json.dumps(fold(root)[0]))
                found.append([{"path": p, "chars": c, "links": k, "text": h, "whole": w, "article": a}
                              for p, (c, k, h, w, a) in page_slots(root).items()])
                digests.append(xxhash.xxh64_intdigest(page or "") - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(trees, pa.string()), pa.array(digests, pa.int64()),
                 pa.array(found, kind)], ["host", "tree", "page", "slots"])

    return pages.select(host_of(F.col(url_col).cast("string")).alias("host"),
                        F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(run, f"host string, tree string, page long, slots {SLOT}")


def _merge(frames: pd.Series) -> str:
    merged = None
    for tree in sorted(frames, key=lambda t: (len(t), t)):
        merged = json.loads(tree) if merged is None else align(merged, json.loads(tree))
    return json.dumps(merged)


def infer(pages: DataFrame, ws: Workspace, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, wrapper``: the judged wrapper of every host, written."""
    shaped = ws.write(shapes(pages, url_col, html_col), "shapes")
    trees = ws.write(shaped.groupBy("host", "tree").agg(F.count("*").alias("pages")), "trees")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": frame["host"].iloc[:1], "tree": [_merge(frame["tree"])]})

    grouped = trees.withColumn("part", F.pmod(F.xxhash64("tree"), F.lit(MERGE_GROUPS))) \
        .groupBy("host", "part").applyInPandas(merge, "host string, tree string")
    one_page = F.min("page") == F.max("page")
    paths = shaped.select("host", "page", F.explode("slots").alias("s")) \
        .groupBy("host", "s.path").agg(
            F.sum("s.chars").alias("chars"), F.sum("s.links").alias("links"),
            F.count("*").alias("seen"), F.sum("s.whole").alias("whole"), F.sum("s.article").alias("article"),
            ((F.min("s.text") == F.max("s.text")) & ~one_page).alias("same"))
    counted = trees.groupBy("host").agg(F.sum("pages").alias("pages"))
    stats = paths.groupBy("host").agg(F.collect_list(F.struct("path", "chars", "links", "seen", "same",
                                                             "whole", "article")).alias("stats")).join(counted, "host")
    parts = ws.write(grouped, "parts").groupBy("host").agg(F.collect_list("tree").alias("trees"))

    @F.pandas_udf("string")
    def judged(trees: pd.Series, stats: pd.Series, pages: pd.Series) -> pd.Series:
        out = []
        for t, s, n in zip(trees, stats, pages, strict=True):
            by = {x["path"]: (x["chars"], x["links"], x["seen"], x["same"], x["whole"], x["article"])
                  for x in (s if s is not None else [])}
            out.append(json.dumps(judge(json.loads(_merge(t)), by, int(n))))
        return pd.Series(out)

    joined = parts.join(counted, "host").join(stats.drop("pages"), "host", "left")
    return ws.write(joined.select("host", judged("trees", "stats", "pages").alias("wrapper")), "wrappers")


def main_text(pages: DataFrame, wrappers: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``id, url, text`` for every row of ``pages``."""
    size = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    keyed = pages.select(id_col, url_col, F.col(html_col).cast("string").alias("__html"),
                         host_of(F.col(url_col).cast("string")).alias("__host"))
    of = wrappers.select(F.col("host").alias("__host"), F.col("wrapper").alias("__wrapper"))
    # Beyond the bound the join is a shuffle by host, whose large partitions Spark splits.
    joined = keyed.join(F.broadcast(of) if size <= BROADCAST_BYTES else of, "__host", "left")

    @F.pandas_udf("string")
    def extracted(html: pd.Series, wrapper: pd.Series) -> pd.Series:
        known: dict[str, list] = {}
        out = []
        for page, w in zip(html, wrapper, strict=True):
            if not isinstance(page, str) or not isinstance(w, str):
                out.append("")
                continue
            if w not in known:
                known[w] = json.loads(w)
            out.append(extract(parse(page), known[w]))
        return pd.Series(out)

    return joined.select(id_col, url_col, extracted("__html", "__wrapper").alias("text"))
