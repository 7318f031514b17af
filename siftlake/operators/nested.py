"""Problem 6: deeply nested records as flat tables linked by interval labels.

One depth-first walk numbers every non-null JSON value of a document: ``pre`` when the walk enters
it, ``post`` when it leaves (one counter serves both), so ``a`` contains ``b`` exactly when
``a.pre < b.pre`` and ``b.post < a.post``.  Typed nodes go to the table of their type, and a child
finds its parent by interval containment within its document.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Where each provider keeps an item's authors and an author's affiliations.
AUTHORS = {
    "europe_pmc": ("authorList", "author"),
    "pubmed": ("authors",),
    "semantic_scholar": ("authors",),
    "openalex": ("authorships",),
    "crossref": ("author",),
    "unpaywall": ("z_authors",),
    "clinical_trials": ("protocolSection", "contactsLocationsModule", "overallOfficials"),
}
AFFILIATIONS = {
    "europe_pmc": ("authorAffiliationDetailsList", "authorAffiliation"),
    "pubmed": ("affiliations",),
    "semantic_scholar": ("affiliations",),
    "openalex": ("institutions",),
    "crossref": ("affiliation",),
    "unpaywall": ("affiliation",),
    "clinical_trials": ("affiliation",),
}
LISTS = ("papers", "trials")
LEVELS = ("item", "author", "affiliation")
DDL = "doc_key string, node_type string, pre bigint, post bigint, position int, label string"
TYPE = "#type"


def provider_key(provider: Column) -> Column:
    """A provider's name in one way of writing: lower case, blanks and hyphens as underscores."""
    return F.regexp_replace(F.lower(F.trim(provider)), "[^a-z0-9]+", "_")


def _within(path: tuple[str, ...], below: dict) -> dict:
    for step in reversed(path):
        below = {step: below}
    return below


def shape(provider: str | None, rooted: bool) -> dict:
    """The places of typed nodes: a tree of steps; ``[]`` is the step from a list to its elements.

    ``rooted``: the document is one item (a source record) rather than a response with lists of them.
    """
    record: dict = {}
    if provider in AUTHORS:
        affiliation = _within(AFFILIATIONS[provider], {"[]": {TYPE: "affiliation"}})
        record = _within(AUTHORS[provider], {"[]": {TYPE: "author", **affiliation}})
    item = {TYPE: "item", "providerRecord": record}
    return item if rooted else {name: {"[]": item} for name in LISTS}


def count_nodes(value: object) -> int:
    """Non-null values in a JSON value, itself included; nesting of any depth."""
    if not isinstance(value, (dict, list)):
        return 1
    total, open_ = 0, [value]
    while open_:
        value = open_.pop()
        total += 1
        for child in value.values() if isinstance(value, dict) else value:
            if isinstance(child, (dict, list)):
                open_.append(child)
            elif child is not None:
                total += 1
    return total


def label_of(node: object) -> str | None:
    """What an item, author or affiliation is called, whatever its provider's field is."""
    if isinstance(node, str):
        return node
    if not isinstance(node, dict):
        return None if node is None else json.dumps(node)
    inner = node.get("author")
    for source in (inner, node) if isinstance(inner, dict) else (node,):
        for field in ("title", "fullName", "display_name", "name", "affiliation"):
            if isinstance(source.get(field), str):
                return source[field]
    return " ".join(x for x in (node.get("given"), node.get("family")) if isinstance(x, str)) or None


def walk(value: object, places: dict, pre: int, position: int, out: list) -> int:
    """Append ``(type, pre, post, position, label)`` of the typed nodes in ``value``; return its post.

    Only branches that can hold typed nodes are entered (their depth is that of ``places``); the nodes of
    all others are counted, which keeps the numbering that of a complete walk.
    """
    if isinstance(value, str) and TYPE not in places and "[]" not in places and value.lstrip()[:1] == "{":
        value = parse(value, value)
    clock = pre
    at = len(out)
    if TYPE in places:
        out.append(None)
    elements = places.get("[]")
    if elements is not None:
        rows = value if isinstance(value, list) else [value]
        for i, child in enumerate(rows, 1):
            if child is not None:
                clock = walk(child, elements, clock + 1, i, out)
    elif isinstance(value, dict):
        for key, child in value.items():
            if child is None:
                continue
            below = places.get(key)
            clock = walk(child, below, clock + 1, 1, out) if below else clock + 2 * count_nodes(child)
    else:
        clock += 2 * (count_nodes(value) - 1)
    if TYPE in places:
        out[at] = (places[TYPE], pre, clock + 1, position, label_of(value))
    return clock + 1


def parse(text: str | None, otherwise: object = None) -> object:
    try:
        return json.loads(text)
    except (ValueError, TypeError, RecursionError):
        return otherwise


def interval_nodes(documents: DataFrame, key: str, provider: str, text: str, rooted: bool = False) -> DataFrame:
    """The typed nodes of each document: ``doc_key, node_type, pre, post, position, label``.

    Types are ``item``, ``author`` and ``affiliation``; ``position`` counts from 1 in the node's list.  A
    list may be absent, null or empty; a lone element in its stead is numbered as a list of one; null elements keep
    their place and give no node; ``providerRecord`` may be JSON text.  A null or empty text gives no
    nodes; text that no parser reads gives one node of type ``unreadable``.  One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict = {}
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for doc, name, body in zip(*(c.to_pylist() for c in batch.columns)):
                if not body:
                    continue
                tree = trees.get(name)
                if tree is None:
                    tree = trees[name] = shape(name, rooted)
                root, out = parse(body), []
                if root is None:
                    out.append(("unreadable", 1, 2, 1, None))
                else:
                    walk(root, tree, 1, 1, out)
                cols[0].extend([doc] * len(out))
                for i, column in enumerate(cols[1:]):
                    column.extend([x[i] for x in out])
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in DDL.split(", ")])

    given = documents.select(F.col(key).alias("doc_key"), provider_key(F.col(provider)).alias("provider"), F.col(text).alias("body"))
    return given.mapInArrow(run, DDL)


def link_by_containment(nodes: DataFrame, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Give every node the nodes of the levels above that contain its interval, by one window.

    Adds ``<level>_pre`` and ``<level>_pos`` for each level but the last.  Nodes of one level never
    contain each other, so the container is the level's last node opened before, if it is still open.
    Linear in the nodes; a document's nodes meet in one task, and a document is one JSON text.
    """
    order = W.partitionBy("doc_key").orderBy("pre").rowsBetween(W.unboundedPreceding, 0)
    linked = nodes
    for level in levels[:-1]:
        opened = F.last(F.when(F.col("node_type") == level, F.struct("pre", "post", "position")), ignorenulls=True).over(order)
        linked = linked.withColumn(f"_{level}", opened)
    for level in levels[:-1]:
        inside = (F.col(f"_{level}.pre") < F.col("pre")) & (F.col("post") < F.col(f"_{level}.post"))
        linked = linked.withColumn(f"{level}_pre", F.when(inside, F.col(f"_{level}.pre")))
        linked = linked.withColumn(f"{level}_pos", F.when(inside, F.col(f"_{level}.position")))
    return linked.drop(*(f"_{level}" for level in levels[:-1]))


def item_table(nodes: DataFrame) -> DataFrame:
    """Items with their interval; rows delivered twice count once."""
    return nodes.filter("node_type = 'item'").select("doc_key", F.col("position").alias("item_pos"), "pre", "post", "label").distinct()


def author_table(nodes: DataFrame) -> DataFrame:
    """Authors with the place of their item."""
    linked = link_by_containment(nodes.filter("node_type in ('item', 'author')"), ("item", "author"))
    return (
        linked.filter("node_type = 'author' and item_pre is not null")
        .select("doc_key", "item_pos", F.col("position").alias("author_pos"), "item_pre", "pre", "post", "label")
        .distinct()
    )


def affiliation_table(nodes: DataFrame) -> DataFrame:
    """Affiliations with the places of their author and item."""
    return (
        link_by_containment(nodes)
        .filter("node_type = 'affiliation' and author_pre is not null and item_pre is not null")
        .select("doc_key", "item_pos", "author_pos", F.col("position").alias("affiliation_pos"), "author_pre", "pre", "post", "label")
        .distinct()
    )


KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", int: "number", float: "number", type(None): "null"}
NODES = "doc_key string, node_no bigint, pre bigint, post bigint, depth int, node_type string, position int, kind string, value string"


def label_tree(root: object) -> list[tuple]:
    """Every node of a JSON value in pre-order: ``(node_no, pre, post, depth, node_type, position, kind, value)``.

    ``pre`` and ``post`` are the ticks at which a depth-first traversal enters and leaves the node.  The type is the node's path without the places in lists
    (``$.papers[].title``), the position its place from 1 in its list or object, the value the text of a leaf (null for null).  No depth is too deep.
    """
    out: list[list] = []
    clock = 0
    open_: list[tuple] = [("$", 1, root, 0)]
    while open_:
        path, position, value, depth = open_.pop()
        clock += 1
        if position < 0:  # the node is left
            out[value][2] = clock
            continue
        kind = KINDS[type(value)]
        inner = kind in ("object", "array")
        text = None if inner or value is None else value if kind == "string" else json.dumps(value)
        out.append([len(out) + 1, clock, clock + 1, depth, path, position, kind, text])
        if not inner:
            clock += 1
            continue
        open_.append((path, -1, len(out) - 1, depth))
        below = [(f"{path}.{k}", v) for k, v in value.items()] if kind == "object" else [(f"{path}[]", v) for v in value]
        open_.extend((p, i, v, depth + 1) for i, (p, v) in zip(range(len(below), 0, -1), reversed(below)))
    return [tuple(x) for x in out]


def every_node(documents: DataFrame, key: str, text: str) -> DataFrame:
    """All nodes of each document with their interval labels (``NODES``); one pass, no shuffle.

    A null, empty or unreadable text has no nodes; equal rows give equal nodes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), *(pa.int64(),) * 3, pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string())
        names = [x.split()[0] for x in NODES.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py()
                try:
                    nodes = label_tree(json.loads(body)) if body else []
                except (ValueError, RecursionError):
                    nodes = []
                rows.extend((doc, *n) for n in nodes)
                if len(rows) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return documents.select(F.col(key).cast("string").alias("doc_key"), F.col(text).alias("body")).mapInArrow(run, NODES)


def node_table(nodes: DataFrame, node_type: str) -> DataFrame:
    """The table of one type of nodes, without the rows of documents delivered twice."""
    return nodes.filter(F.col("node_type") == node_type).distinct()


def link_parents(nodes: DataFrame) -> DataFrame:
    """Every node with ``parent_no``, the node whose interval contains its own most closely; null for a root.

    The parent is the last node of the level above that was opened before, so one window over a document's nodes finds it for each level; a document is one text.
    """
    once = nodes.distinct()
    above = once.select("doc_key", F.col("depth").alias("level"), "pre", "node_no", F.lit(True).alias("opens"))
    rows = once.select("doc_key", (F.col("depth") - 1).alias("level"), "pre", "node_no", F.lit(False).alias("opens")).unionByName(above)
    order = W.partitionBy("doc_key", "level").orderBy("pre").rowsBetween(W.unboundedPreceding, 0)
    parent = F.last(F.when(F.col("opens"), F.col("node_no")), ignorenulls=True).over(order)
    linked = rows.withColumn("parent_no", parent).filter("not opens").select("doc_key", "node_no", "parent_no")
    return once.join(linked, ["doc_key", "node_no"])
