"""HTML extraction by union-free regular-expression wrappers, one per host.

A page is a tree of block elements and text; inline markup is part of the
text around it.  A block's label is its element with its class, id and role
names.  A wrapper is such a tree with multiplicities: an element, an optional
one ``?``, a repeated one ``+``, or a repeated group ``( )+``, and text slots.
Wrappers are inferred by alignment: neighbours with the same labels (single or
in groups) fold into repeats, children of two trees are aligned by a longest
common subsequence of their labels, what one side lacks becomes optional, and
texts that differ become slots.

Texts that stand on half of a host's pages or more, and on two at least, are the
template's, not data (``fixed``): a block of nothing but such texts has a label
of its own, marked ``!``, so that it never folds with the slots beside it.  Where
a host names its article by element, all in it stays but what is marked as
outside.  Elsewhere the article is what holds the slots: fixed blocks, and lists
of links, are menus, notices and sign-ups, and go.

All pages take part.  Each batch of a map task folds its pages into one small
wrapper per host; partial wrappers are folded per (host, salt) and then per
host, so a host with a third of all pages is never gathered in one task.  The
finished wrapper tells which of its nodes hold the article; pages are aligned
with their host's wrapper again, and the texts in these nodes come out.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens.llm.scratch import cut

#: Elements that are part of the text around them.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd mark nobr q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr""".split())
#: Elements without content.
VOID = frozenset("area base col embed hr input link meta param source track br img wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements that never hold the article's text.
OUTSIDE = frozenset("""head script style noscript template nav footer aside form button select option textarea title iframe
svg canvas object embed dialog menu input xmp noembed noframes""".split())
#: Classes and ids of blocks that are not the article's (whole names, never words within longer ones).
OUTSIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices alert popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs header masthead
footer comment comments reply replies respond disqus share sharing social related recommended newsletter subscribe subscription
signup login search widget widgets toolbar pager pagination skip copyright disclaimer""".split())
#: Elements that name the article.
ARTICLE = ("article", "main")
#: Classes and ids that name the article.
ARTICLE_WORDS = frozenset("article main content post story entry body text".split())
#: Elements that an opening block element closes.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*'|["'])*+)>|<[!?/][^>]*>""", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+))""", re.I)
DIGIT = re.compile(r"[0-9]")

#: Labels of a repeated group at most, partial wrappers' shares of a host, nesting from which plain blocks are not
#: told apart (their texts belong to the block around them).
GROUP, SALTS, DEPTH = 3, 32, 60
#: Children of a wrapper's node at most, the rarest optional ones go (pages then follow the node itself), and bits
#: of an alignment held at once.
CHILDREN_KEPT, BITS = 1000, 1 << 30
#: Elements whose text is prose even where most of it is links.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote figcaption td th pre dd".split())
#: Decisions up to this size are broadcast (after measuring); more are joined by shuffle, salted.
BROADCAST_BYTES = 32 << 20


def _label(tag: str, attributes: str) -> str:
    """Element name with its names in class, id and role; those with digits differ from page to page."""
    names = set()
    if attributes:
        for _, *values in NAMES.findall(attributes):
            names.update(n.replace(".", "_").replace("!", "_") for n in "".join(values).lower().split() if not DIGIT.search(n))
    return ".".join([tag, *sorted(names)])


def _kind(label: str) -> str:
    """What a block must be told apart for at any nesting; empty if nothing."""
    tag = label.split(".")[0]
    if _outside(label):
        return "header" if tag == "header" else "outside"
    return tag if tag in ARTICLE else ""


def parse(page: str) -> list:
    """The tree of a page: nodes are ``[label, children]`` or ``["#", text, linked]``,
    a text and how many of its code points are links.

    Every open element stays open until it is closed, at any nesting.  From
    ``DEPTH`` on, plain blocks get no node of their own, and their texts go to
    the node around them; outside blocks and articles still get one, each kind
    once and none within an outside block, whose texts all go.
    """
    root: list = ["", []]
    stack, names, text = [root], [""], []
    linked: list[str] = []
    in_link = False
    kinds: list[frozenset] = [frozenset()]  # told apart beyond DEPTH, of the open elements
    opened: dict[str, int] = {}

    def shut() -> None:
        opened[names.pop()] -= 1
        stack.pop()
        kinds.pop()

    def flush() -> None:
        if text:
            block = " ".join("".join(text).split())
            if block:
                stack[-1][1].append(["#", block, len(" ".join("".join(linked).split()))])
            text.clear()
            linked.clear()

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text.append(html_lib.unescape(page[at:]))
            break
        if m.start() > at:
            text.append(html_lib.unescape(page[at:m.start()]))
            if in_link:
                linked.append(text[-1])
        at = m.end()
        closing, tag, attributes = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            end = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = n if close < 0 else close + 1
            flush()
            continue
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                in_link = not closing
            continue
        flush()
        if closing:
            if opened.get(tag):
                while names[-1] != tag:
                    shut()
                shut()
            continue
        if names[-1] == "p" or names[-1] in CLOSED_BY.get(tag, ()):
            shut()
        if tag in VOID:
            continue
        node, told = [_label(tag, attributes), []], kinds[-1]
        if len(stack) >= DEPTH:
            kind = _kind(node[0])
            if not kind or kind in told or "outside" in told:
                node = stack[-1]
            else:
                told = told | {kind}
        if node is not stack[-1]:
            stack[-1][1].append(node)
        stack.append(node)
        names.append(tag)
        kinds.append(told)
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    return root


# A wrapper node is [label, optional, repeated, pages, chars, value, children]: pages that have it, code points of
# text in it, and for a text its value as long as it is the same in all pages (None: a slot).
LABEL, OPTIONAL, REPEATED, PAGES, CHARS, VALUE, CHILDREN = range(7)


def text_key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def texts_of(tree: list) -> Iterator[str]:
    stack = [tree]
    while stack:
        node = stack.pop()
        if node[0] == "#":
            yield node[1]
        else:
            stack.extend(node[1])


def marked(tree: list, fixed: frozenset[int]) -> list:
    """The tree with ``!`` behind the labels of fixed texts and of blocks with fixed texts only."""
    if not fixed:
        return tree

    def mark(node: list) -> tuple[list, bool, bool]:
        """The node, whether it holds text, and whether all of that is fixed."""
        if node[0] == "#":
            known = text_key(node[1]) in fixed
            return ["#!" if known else "#", *node[1:]], True, known
        inner = [mark(c) for c in node[1]]
        some = any(text for _, text, _ in inner)
        known = some and all(k for _, text, k in inner if text)
        return [node[0] + "!" if known and node[0] else node[0], [n for n, _, _ in inner]], some, known

    return mark(tree)[0]


def _signature(nodes: list) -> list[str]:
    return [n[LABEL] for n in nodes]


def _folded(nodes: list) -> list:
    """Neighbours with the same labels, single or in groups, as one repeated node or group."""
    out = list(nodes)
    for size in range(1, GROUP + 1):
        i = 0
        while i + 2 * size <= len(out):
            a, b = out[i:i + size], out[i + size:i + 2 * size]
            if _signature(a) != _signature(b) or (size > 1 and len(set(_signature(a))) == 1):
                i += 1
                continue
            merged = [merge(x, y, False) for x, y in zip(a, b)]
            if size == 1:
                merged[0][REPEATED] = True
                out[i:i + 2] = merged
                continue
            group = ["()", False, True, max(x[PAGES] for x in merged), sum(x[CHARS] for x in merged), None, merged]
            j = i + 2 * size
            while _signature(out[j:j + size]) == _signature(merged):
                merged[:] = [merge(x, y, False) for x, y in zip(merged, out[j:j + size])]
                group[CHARS] = sum(x[CHARS] for x in merged)
                j += size
            out[i:j] = [group]
            i += 1
    return out


def _vectors(a: list[str], b: list[str]) -> Iterator[int]:
    """After each of ``b``: a bit per place of ``a``, 0 where the longest common subsequence grows."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    v = every
    for y in b:
        u = v & places.get(y, 0)
        v = (v + u | v - u) & every
        yield v


def _growth(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each prefix of ``a`` with ``b``."""
    v = (1 << len(a)) - 1
    for v in _vectors(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(a)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, by machine words of bits; long lists are halved first."""
    lo, end = 0, 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while end < min(len(a), len(b)) - lo and a[-1 - end] == b[-1 - end]:
        end += 1
    m, n = len(a) - lo - end, len(b) - lo - end
    out = [(i, i) for i in range(lo)]
    x, y = a[lo:lo + m], b[lo:lo + n]
    if m and n and m * n > BITS and n > 1:
        half = n // 2
        cut = int(np.argmax(_growth(x, y[:half]) + _growth(x[::-1], y[half:][::-1])[::-1]))
        out += [(i + lo, j + lo) for i, j in _matches(x[:cut], y[:half])]
        out += [(i + lo + cut, j + lo + half) for i, j in _matches(x[cut:], y[half:])]
    elif m and n:
        rows = [(1 << m) - 1, *_vectors(x, y)]
        found, i, j = [], m, n
        while i and j:
            if rows[j] >> (i - 1) & 1:
                i -= 1
            elif not rows[j - 1] >> (i - 1) & 1:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((i + lo, j + lo))
        out += found[::-1]
    return out + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]


def _aligned(a: list, b: list) -> list:
    """Children of two trees by a longest common subsequence of labels; the rest is optional."""
    out, i, j = [], 0, 0
    for k, m in [*_matches(_signature(a), _signature(b)), (len(a), len(b))]:
        out += [[x[LABEL], True, *x[REPEATED:]] for x in (*a[i:k], *b[j:m])]
        if k < len(a):
            out.append(merge(a[k], b[m], True))
        i, j = k + 1, m + 1
    if len(out) > CHILDREN_KEPT:  # a bound on the wrapper: pages' rarest blocks follow the block around them
        often = sorted(range(len(out)), key=lambda i: (out[i][OPTIONAL], -out[i][PAGES], i))[:CHILDREN_KEPT]
        out = [out[i] for i in sorted(often)]
    return out


def merge(a: list, b: list, pages: bool) -> list:
    """Two nodes of the same label in one, of different ``pages`` or of the same."""
    children = a[CHILDREN] if not b[CHILDREN] else b[CHILDREN] if not a[CHILDREN] else None
    if children is None:
        children = ([merge(x, y, pages) for x, y in zip(a[CHILDREN], b[CHILDREN])]
                    if _signature(a[CHILDREN]) == _signature(b[CHILDREN]) else _folded(_aligned(a[CHILDREN], b[CHILDREN])))
    elif pages or len(a[CHILDREN]) != len(b[CHILDREN]):
        children = [[c[LABEL], True, *c[REPEATED:]] for c in children]
    return [a[LABEL], a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED],
            a[PAGES] + b[PAGES] if pages else max(a[PAGES], b[PAGES]), a[CHARS] + b[CHARS],
            a[VALUE] if a[VALUE] == b[VALUE] else None, children]


def wrapper_of(tree: list) -> list:
    """The wrapper of one page: neighbours folded into repeats."""
    if tree[0][:1] == "#":
        return [tree[0], False, False, 1, len(tree[1]), tree[1], []]
    children = _folded([wrapper_of(c) for c in tree[1]])
    return [tree[0], False, False, 1, sum(c[CHARS] for c in children), None, children]


def pattern(node: list) -> str:
    """A wrapper as a union-free regular expression, for people."""
    inner = " ".join(map(pattern, node[CHILDREN]))
    body = f"({inner})" if node[LABEL] == "()" else (repr(node[VALUE]) if node[VALUE] is not None else "#") if node[LABEL][:1] == "#" \
        else f"<{node[LABEL]}>{inner}</>"
    return body + ("*" if node[OPTIONAL] and node[REPEATED] else "+" if node[REPEATED] else "?" if node[OPTIONAL] else "")


def _outside(label: str) -> bool:
    tag, *names = label.rstrip("!").split(".")
    return tag in OUTSIDE or tag not in ARTICLE and not ARTICLE_WORDS.intersection(names) and any(n in OUTSIDE_WORDS for n in names) \
        or any(n in ("comment", "comments", "disqus", "sidebar", "cookie", "cookies", "ad", "ads", "advert") for n in names)


def _inner_chars(node: list) -> int:
    """Code points of text in a node that is neither marked as outside nor fixed."""
    if node[LABEL] == "#":
        return node[CHARS]
    return 0 if node[LABEL][-1:] == "!" or _outside(node[LABEL]) else sum(map(_inner_chars, node[CHILDREN]))


def decide(wrapper: list) -> list:
    """The wrapper reduced to what extraction needs: ``[label, kept, children]``,
    for the root with whether the article is named.

    The article is the ``article`` or ``main`` element with most text, else the
    deepest element with over half of the slots' text that is not marked as
    outside.  In it, nodes marked as outside go.  In an article that its element,
    or a class or id of its own, names, all other texts stay, also those that
    are the same on all pages; else fixed ones go.
    """
    articles: list = []

    def find(node: list) -> None:
        if node[LABEL][:1] != "#" and not _outside(node[LABEL]):
            if node[LABEL].rstrip("!").split(".")[0] in ARTICLE:
                articles.append(node)
            for c in node[CHILDREN]:
                find(c)

    find(wrapper)
    whole = _inner_chars(wrapper)
    best = max(articles, key=_inner_chars, default=None)
    named = best is not None and 5 * _inner_chars(best) >= whole
    if not named:
        best = wrapper
        while True:
            inner = [c for c in best[CHILDREN] if c[LABEL][:1] != "#" and 2 * _inner_chars(c) > whole]
            if not inner or inner[0][REPEATED] or inner[0][OPTIONAL] and inner[0][PAGES] < 0.8 * best[PAGES]:
                break
            best = inner[0]
            named = named or bool(ARTICLE_WORDS.intersection(best[LABEL].rstrip("!").split(".")[1:]))
    if best[LABEL].split(".")[0] == "main":  # an article within, without what stands around it
        inner = [c for c in articles if c is not best and c[LABEL].startswith("article") and 2 * _inner_chars(c) > _inner_chars(best)]
        best = inner[0] if inner else best

    def reduced(node: list, inside: bool) -> list:
        inside = inside or node is best
        label = node[LABEL]
        if inside and not named and label[-1:] == "!":
            return [label, False, []]
        if label[:1] == "#":
            return [label, inside, []]
        if inside and label.rstrip("!").split(".")[0] == "header" or not _outside(label):
            return [label, inside, [reduced(c, inside) for c in node[CHILDREN]]]
        return [label, False, []]

    return [*reduced(wrapper, False), named]


def extract(tree: list, decision: list) -> str:
    """The texts of a page that lie in kept nodes of its wrapper, one block a line."""
    out: list[str] = []
    named = decision[3]

    def flat(nodes: list) -> list:
        return [x for n in nodes for x in (flat(n[2]) if n[0] == "()" else [n])]

    def walk(children: list, decided: list, kept: bool, prose: bool) -> None:
        slots, at = flat(decided), 0
        for child in children:
            label = child[0]
            order = [*range(at, len(slots)), *range(min(at, len(slots)))]
            found = next((i for i in order if slots[i][0] == label), None)
            if found is not None:
                at = found  # it may repeat
            usual = kept and (label[:1] == "#" or not _outside(label)) and (named or label[-1:] != "!")
            keep, inner = (slots[found][1], slots[found][2]) if found is not None else (usual, [])
            if label[:1] == "#":
                if keep and (named or prose or 2 * child[2] <= len(child[1])):
                    out.append(child[1])
                continue
            tag = label.rstrip("!").split(".")[0]
            if not _outside(label) or tag == "header" and keep:
                walk(child[1], inner, keep, prose or tag in PROSE)

    walk(tree[1], decision[2], decision[1], False)
    return "\n".join(out)


def host_of(url: str | None) -> str:
    """Lower-case host of a URL; empty if there is none."""
    m = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _fold(wrappers: list[str]) -> str:
    """Partial wrappers in one, in a fixed order."""
    out = None
    for text in sorted(wrappers):
        one = json.loads(text)
        out = one if out is None else merge(out, one, True)
    return json.dumps(out)


def page_host(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def fixed_texts(pages: DataFrame) -> DataFrame:
    """``host, fixed``: hashes of the texts on half of a host's ``pages`` or
    more, and on two at least; at most twice a page's blocks, so lists stay short."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys = [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = {text_key(t) for t in texts_of(parse(page.as_py() or ""))}
                keys += [None, *found]  # one row without a key for each page
                hosts += [host] * (len(found) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64())], names=["host", "key"])

    counts = cut(pages.select(page_host().alias("host"), "html").mapInArrow(blocks, "host string, key long")
                 .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter("key IS NULL OR n > 1"))
    on = counts.filter("key IS NULL").select("host", F.col("n").alias("pages"))
    often = counts.filter("key IS NOT NULL").join(on, "host").filter("2 * n >= pages")
    return often.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("fixed"))


def with_host_rows(pages: DataFrame, made: DataFrame, columns: list[str], weight: Column) -> DataFrame:
    """``pages`` with the row of ``made`` (by ``host``): broadcast after measuring, else by a salted join."""
    size = made.agg(F.coalesce(F.sum(weight + F.length("host") + 64), F.lit(0)).alias("n")).first()["n"]
    rows = pages.select(*columns, page_host().alias("host"))
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(made), "host", "left")
    salted = made.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (JSON), ``fixed`` over all ``pages`` (``url, html``; NULL html is empty)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {}
            for host, page, fixed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                one = wrapper_of(marked(parse(page.as_py() or ""), frozenset(fixed.as_py() or ())))
                made[host] = merge(made[host], one, True) if host in made else one
            yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.string()),
                                              pa.array([json.dumps(w) for w in made.values()], pa.string())], names=["host", "wrapper"])

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [_fold(rows["wrapper"].tolist())]})

    fixed = cut(fixed_texts(pages))
    known = with_host_rows(pages, fixed, ["url", "html"], 8 * F.size("fixed"))
    parts = known.select("host", "html", "fixed").mapInArrow(partial, "host string, wrapper string")
    salted = parts.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).alias("salt")).applyInPandas(fold, "host string, wrapper string")
    return salted.groupBy("host").applyInPandas(fold, "host string, wrapper string").join(fixed, "host", "left")


def extract_articles(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    Texts are the article's blocks in page order, joined by one ``\\n``, with
    white space in a block turned into one space; empty if there is none.  A
    page without text in its host's article nodes is its own wrapper.
    NULL html is empty; NULL or odd URLs share the wrapper of the empty host.
    Repeated rows come out repeatedly; other columns are ignored.
    """

    def decisions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"host": batch["host"], "fixed": batch["fixed"], "decision": [json.dumps(decide(json.loads(w))) for w in batch["wrapper"]]})

    made = cut(wrappers.mapInPandas(decisions, "host string, fixed array<long>, decision string"))
    joined = with_host_rows(pages, made, ["page_id", "url", "html"], F.length("decision") + 8 * F.coalesce(F.size("fixed"), F.lit(0)))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, list] = {}
        for batch in batches:
            out = []
            for page, decision, fixed in zip(batch.column(2), batch.column(3), batch.column(4)):
                key = decision.as_py() or '["", true, [], false]'
                if key not in read:
                    if len(read) > 2000:
                        read.clear()
                    read[key] = json.loads(key)
                tree = parse(page.as_py() or "")
                out.append(extract(marked(tree, frozenset(fixed.as_py() or ())), read[key]) or extract(tree, decide(wrapper_of(tree))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return joined.select(F.col("page_id").cast("long"), "url", "html", "decision", "fixed").mapInArrow(
        texts, "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_articles(pages, infer_wrappers(pages))
