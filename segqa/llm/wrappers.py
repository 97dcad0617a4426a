"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of block tags and texts. The streams of a host are aligned one after the other into
one expression. Where they agree it stays as it is. Where neighbours repeat, one or several at a time,
they become a repeated group; where one stream has what the other lacks, an optional part; where texts
differ, a text slot. What the pages of a host have told about its slots decides which hold main text,
and a page's texts are those that its own stream brings to such slots.

Pages are aligned in the tasks that read them, so that only one small wrapper per host and task is
shuffled; wrappers of a host are aligned in two steps, so that no task gets all of a large host.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import slices, worker_store
from .markup import Node, leaves, parse, role_of

SALTS = 64
HELD_BYTES = 16 << 20  # of html per wrapper set that a task holds before it ships it
MOST_PARTS, MOST_KEYS = 64, 256  # parts of an element told in order; keys told apart otherwise
CONSTANT_PAGES = 3  # a text that so many pages share, and all that have it, is the host's own


_ANY = "(*)"  # a repeated group of optional parts


def _tell(a: Node, b: Node, pages: bool) -> Node:
    """Two nodes of one key as one; ``pages``: of different pages."""
    a.pages = a.pages + b.pages if pages else max(a.pages, b.pages)
    a.optional |= b.optional
    a.repeated |= b.repeated
    a.runs += b.runs
    if a.texts is not None:
        p, chars, links, digest = b.texts
        own = a.texts
        own[0] = own[0] + p if pages else max(own[0], p)
        own[1] += chars
        own[2] += links
        if own[3] != digest:
            own[3] = 0
    else:
        together = _any_parts if a.key == _ANY else align
        a.children = together(a.children, b.children, pages)
    return a


def _squares(nodes: list[Node]) -> list[Node]:
    """Neighbouring repeats of several nodes as repeated groups, short ones first."""
    width = 2
    while 2 * width <= len(nodes):
        names: dict[str, int] = {}
        keys = np.array([names.setdefault(n.key, len(names)) for n in nodes])
        if len(names) == len(nodes):
            return nodes  # nothing repeats
        same = np.concatenate([[0], np.cumsum(keys[:-width] == keys[width:])])
        starts = np.flatnonzero(same[width:] - same[:-width] == width)
        if not len(starts):
            width += 1
            continue
        begin = int(starts[0])
        end = begin + 2 * width
        while end + width <= len(nodes) and (keys[end : end + width] == keys[begin : begin + width]).all():
            end += width
        group = nodes[begin : begin + width]
        for k in range(begin + width, end, width):
            group = [_tell(x, y, False) for x, y in zip(group, nodes[k : k + width])]
        nodes = _neighbours([*nodes[:begin], _group(group), *nodes[end:]])
        width = 2
    return nodes


def _kind(key: str) -> str:
    """The key without names, but for one that stands for its role."""
    return key.split(".")[0] + {"other": ".widget", "header": ".header"}.get(role_of(key), "")


def _bounded(nodes: list[Node]) -> list[Node]:
    """Lists beyond ``MOST_PARTS`` as one repeated group of optional parts, one of each key.

    Without it an expression would grow with every page of a host whose pages are alike in nothing.
    """
    general = any(n.key == _ANY for n in nodes)
    if not general and len(nodes) <= MOST_PARTS or len(nodes) == 1 and general:
        return nodes
    parts: dict[str, Node] = {}

    def add(key: str, node: Node) -> None:
        if key in parts:
            _tell(parts[key], node, False)
        else:
            parts[key], node.key, node.optional = node, key, True

    for node in nodes:
        for part in node.children if node.key[0] == "(" else [node]:
            add(part.key, part)
    if len(parts) > MOST_KEYS:
        held, parts = parts, {}
        for key, part in held.items():
            add(_kind(key) if key[0] not in "(#" else key, part)
    group = Node(_ANY, list(parts.values()))
    group.repeated, group.pages = True, max(n.pages for n in nodes)
    return [group]


def _group(nodes: list[Node]) -> Node:
    node = Node("(" + " ".join(n.key for n in nodes) + ")", nodes)
    node.repeated, node.pages = True, max(n.pages for n in nodes)
    return node


def _neighbours(nodes: list[Node]) -> list[Node]:
    """Neighbours of one key as one repeated node."""
    out: list[Node] = []
    for node in nodes:
        if out and out[-1].key == node.key:
            _tell(out[-1], node, False).repeated = True
        else:
            out.append(node)
    return out


def collapse(node: Node) -> Node:
    """The page's own expression: repeats as groups, at every depth."""
    for child in node.children:
        collapse(child)
    node.children = _bounded(_squares(_neighbours(node.children)))
    return node


def _folded(nodes: list[Node], others: list[Node]) -> list[Node]:
    """``nodes`` with what ``others`` have as a group as such a group too."""
    for group in others:
        if group.key[0] != "(" or any(n.key == group.key for n in nodes):
            continue
        keys = [n.key for n in group.children]
        for k in range(len(nodes) - len(keys) + 1):
            if [n.key for n in nodes[k : k + len(keys)]] == keys:
                nodes = [*nodes[:k], _group(nodes[k : k + len(keys)]), *nodes[k + len(keys) :]]
                break
    return nodes


def _pairs(a: list[Node], b: list[Node]) -> Iterator[tuple[Node | None, Node | None]]:
    """Nodes of both lists in one order, those of one key together."""
    x, y = [n.key for n in a], [n.key for n in b]
    if x == y:
        yield from zip(a, b)
        return
    if x == [_ANY] and y == [_ANY]:
        yield a[0], b[0]
        return
    for kind, i, j, k, m in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if kind == "equal":
            yield from zip(a[i:j], b[k:m])
        else:
            yield from ((n, None) for n in a[i:j])
            yield from ((None, n) for n in b[k:m])


def align(a: list[Node], b: list[Node], pages: bool = True) -> list[Node]:
    """One expression for both; what only one has is optional."""
    if any(n.key == _ANY for n in (*a, *b)):
        a, b = _as_any(a), _as_any(b)
        return [_tell(a[0], b[0], pages)] if a and b else a or b
    a, b = _folded(a, b), _folded(b, a)
    out, equal = [], True
    for x, y in _pairs(a, b):
        if x is not None and y is not None:
            out.append(_tell(x, y, pages))
        else:
            node = x if y is None else y
            node.optional, equal = True, False
            out.append(node)
    return out if equal else _bounded(_squares(_neighbours(out)))


def _as_any(nodes: list[Node]) -> list[Node]:
    if not nodes or nodes[0].key == _ANY and len(nodes) == 1:
        return nodes
    return _bounded([Node(_ANY), *nodes])


def _any_parts(a: list[Node], b: list[Node], pages: bool) -> list[Node]:
    """The parts of two such groups, one of each key."""
    parts = {n.key: n for n in a}
    for node in b:
        key = node.key if node.key in parts or len(parts) < MOST_KEYS else _kind(node.key)
        if key in parts:
            _tell(parts[key], node, pages)
        else:
            parts[key], node.key = node, key
    return list(parts.values())


def _dump(node: Node) -> list:
    head = [node.key, node.pages, int(node.optional), int(node.repeated)]
    return [*head, node.texts] if node.texts is not None else [*head, *map(_dump, node.children)]


def _load(data: list) -> Node:
    node = Node(data[0])
    node.pages, node.optional, node.repeated = data[1], bool(data[2]), bool(data[3])
    if node.key == "#":
        node.texts = data[4]
    else:
        node.children = [_load(child) for child in data[4:]]
    return node


def expression(wrapper: str) -> str:
    """A stored wrapper as text: ``(...)?`` optional, ``(...)+`` repeated, ``#`` a text slot and the
    like of ``<p>#</p>`` an element."""

    def show(node: Node) -> str:
        inner = "".join(map(show, node.children))
        if node.key == "#":
            body = "#"
        elif node.key[0] == "(":
            body = inner
        else:
            body = f"<{node.key}>{inner}</{node.key.split('.')[0]}>"
        for sign, wanted in (("+", node.repeated), ("?", node.optional)):
            body = f"({body}){sign}" if wanted else body
        return body

    return "".join(map(show, _load(json.loads(wrapper)).children))


def mark(root: Node, single: bool = False) -> bool:
    """Set which slots hold main text, and tell whether there is an element meant for it.

    Never in menus, footers, forms and the like. If there are elements for the main text, all in
    them; else what is neither mostly links nor the same on all pages, in the innermost element with
    more than half of that.
    """
    found, free = [], []  # slots in such elements, and candidates with their ancestors
    content = False

    def walk(node: Node, inside: bool, way: list[Node]) -> None:
        nonlocal content
        role = role_of(node.key) if node.key[0] not in "(#" else ""
        if role == "other" or role == "header" and not inside:
            return
        if role == "content":
            inside = content = True
        if node.texts is not None:
            node.main = False
            if inside:
                found.append(node)
            pages, chars, links, digest = node.texts
            if 2 * links <= chars and not (digest and pages >= CONSTANT_PAGES):
                free.append((node, way))
        for child in node.children:
            walk(child, inside, [*way, child])

    for slot in leaves(root):
        slot.main = False
    walk(root, False, [root])
    if found or single and content:
        for slot in found:
            slot.main = True
        return True
    within = root
    total = sum(slot.texts[1] for slot, _ in free)
    while total:
        weights: dict[int, list] = {}
        for slot, way in free:
            depth = next((k for k, n in enumerate(way) if n is within), None)
            if depth is not None and depth + 1 < len(way) and way[depth + 1].texts is None:
                weights.setdefault(id(way[depth + 1]), [way[depth + 1], 0])[1] += slot.texts[1]
        best = max(weights.values(), key=lambda w: w[1], default=None)
        if best is None or 2 * best[1] <= total or best[0].repeated:
            break
        within = best[0]
    for slot, way in free:
        slot.main = any(n is within for n in way)
    return content


def _match(wrapper: Node, page: Node, chosen: list[bool | None]) -> None:
    """Bring the page's texts to the wrapper's slots."""
    if wrapper.key == _ANY:
        slots = {n.key: n for n in wrapper.children}
        pairs = [(slots.get(n.key) or slots.get(_kind(n.key)), n) for n in page.children]
    elif any(n.key == _ANY for n in wrapper.children):
        pairs = zip(wrapper.children, _as_any(page.children))
    else:
        pairs = _pairs(wrapper.children, _folded(page.children, wrapper.children))
    for slot, own in pairs:
        if own is None or slot is None:
            continue
        if own.texts is not None:
            for run in own.runs:
                chosen[run] = slot.main
        else:
            _match(slot, own, chosen)


def main_text(html: str | None, wrapper: Node | None = None) -> str:
    """The page's main text under a marked ``wrapper``, or under its own expression alone."""
    page, texts = parse(html or "")
    if not texts:
        return ""
    collapse(page)
    own = [False] * len(texts)
    mark(page, single=True)
    for slot in leaves(page):
        for run in slot.runs:
            own[run] = slot.main
    chosen: list[bool | None] = [None] * len(texts)
    if wrapper is not None:
        _match(wrapper, page, chosen)
        # texts without a slot, and pages none of whose slots count, are judged by themselves
        chosen = [o if c is None else c for c, o in zip(chosen, own)]
        if not any(chosen):
            chosen = own
    else:
        chosen = own
    return "\n".join(t for t, c in zip(texts, chosen) if c)


def host_of(url: str | Column) -> Column:
    """The url's host in lower case; empty if there is none."""
    found = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def infer_wrappers(pages: DataFrame, host: Column, html_col: str = "html") -> DataFrame:
    """``(host, wrapper)``: one expression per host, stored; see ``expression``."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Node] = {}
        size = 0
        for batch in slices(batches, "html"):
            for name, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = collapse(parse(html or "")[0])
                held[name] = _tell(held[name], page, True) if name in held else page
                size += len(html or "")
            if size > HELD_BYTES:
                yield ship(held)
                held, size = {}, 0
        if held:
            yield ship(held)

    def ship(held: dict[str, Node]) -> pa.RecordBatch:
        stored = [json.dumps(_dump(node), separators=(",", ":")) for node in held.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(stored, pa.string())], ["host", "wrapper"]
        )

    def join(table: pa.Table) -> pa.Table:
        parts = [_load(json.loads(w)) for w in sorted(table.column("wrapper").to_pylist())]
        whole = parts[0]
        for part in parts[1:]:
            whole = _tell(whole, part, True)
        stored = json.dumps(_dump(whole), separators=(",", ":"))
        return pa.table([table.column("host")[:1], pa.array([stored])], ["host", "wrapper"])

    schema = "host string, wrapper string"
    parts = pages.select(host.alias("host"), F.col(html_col).alias("html")).mapInArrow(learn, schema)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    joined = salted.groupBy("host", "salt").applyInArrow(join, schema)
    return materialize(joined.groupBy("host").applyInArrow(join, schema), "wrappers")


def extract_main(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, their main text: blocks in page order, one to a line.

    In a block all white space is one blank, character references are decoded. A page without main
    text, a null or empty one too, has an empty text. Pages without a host form one host; repeated
    rows count as pages of their own and get the same text; an empty table stays empty. A column
    ``text`` is replaced, all others are kept.
    """
    docs = pages.drop("text")
    wrappers = infer_wrappers(docs, host_of(url_col), html_col)
    stored = wrappers.select(F.col("host").alias(_HOST), F.col("wrapper").alias(_WRAPPER))
    joined = docs.withColumn(_HOST, host_of(url_col)).join(stored, _HOST, "left").drop(_HOST)
    schema = T.StructType([*docs.schema.fields, T.StructField("text", T.StringType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_store().setdefault("wrappers", {})
        for batch in slices(batches, html_col):
            texts = []
            for html, stored in zip(
                batch.column(html_col).to_pylist(), batch.column(_WRAPPER).to_pylist()
            ):
                if stored is not None and stored not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[stored] = _load(json.loads(stored))
                    mark(known[stored])
                texts.append(main_text(html, known.get(stored)))
            rest = batch.drop_columns([_WRAPPER])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(texts, pa.string())], names=[*rest.schema.names, "text"]
            )

    return joined.mapInArrow(extract, schema)


_HOST, _WRAPPER = "__segqa_host", "__segqa_wrapper"
