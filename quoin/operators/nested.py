"""Nested property documents to related flat tables, through interval labels.

Every document is walked depth first. A node gets a number when the walk enters it (pre) and one when it
leaves (post), so that a node lies under another exactly if its interval lies inside the other's. The walk
writes one table of typed nodes; children are linked to their parents by interval containment: in the order
of ``pre`` within a document, the parent of a node is the last node of the parent's type that began before
it, if it hasn't ended yet. That is one sort per document, not a join of all nodes with all nodes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NODE_SCHEMA = "det_id long, doc string, pre int, post int, kind string, pos int, label string, body string"
#: Types of nodes that can hold a child of each type.
PARENT_OF = {"facility": "category", "room": "document", "image": "room", "review": "tags"}
ROOM_MEMBERS = ("name", "facilities", "gallery", "livingscore")


def _items(value) -> list:
    """(pos, element) of a container; a value without its container is its only element."""
    if value is None:
        return []
    return list(enumerate(value)) if isinstance(value, list) else [(0, value)]


def _text(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _groups(value, name: str, member: str) -> list:
    """(label, container) of facilities or reviews, which are an object by label or a list of objects with both."""
    if isinstance(value, dict) and name in value and member in value:
        value = [value]
    if isinstance(value, dict):
        return list(value.items())
    out = []
    for x in value if isinstance(value, list) else []:
        if isinstance(x, dict):
            label = x.get(name)
            if isinstance(label, list):
                label = ",".join(_text(t) for t in label if t is not None)
            out.append(("" if label is None else _text(label), x.get(member)))
    return out


def _rooms(value) -> list:
    if isinstance(value, dict):
        if any(k in ROOM_MEMBERS for k in value):
            return [(0, value)]
        return list(enumerate(value.values()))
    return _items(value)


def unwrap(doc):
    """The property object inside a crawler's envelope, or the object itself; None if there is none."""
    while isinstance(doc, dict) and isinstance(doc.get("payload"), dict):
        inner = doc["payload"]
        doc = inner["body"] if isinstance(inner.get("body"), dict) else {k: v for k, v in inner.items() if k != "payload"} | ({"payload": inner["payload"]} if isinstance(inner.get("payload"), dict) else {})
    return doc if isinstance(doc, dict) else None


def walk(doc: dict) -> list[tuple]:
    """Nodes (pre, post, kind, pos, label, body) of one document in the order of pre."""
    out: list[list] = []
    clock = 0

    def enter(kind: str, pos: int, label: str, body=None) -> list:
        nonlocal clock
        node = [clock, -1, kind, pos, label, None if body is None else _text(body)]
        clock += 1
        out.append(node)
        return node

    def leave(node: list) -> None:
        nonlocal clock
        node[1] = clock
        clock += 1

    top = enter("document", 0, "")
    for label, items in _groups(doc.get("facilities"), "category", "items"):
        group = enter("category", 0, label)
        for pos, x in _items(items):
            if x is not None:
                leave(enter("facility", pos, label, x.get("name", x) if isinstance(x, dict) else x))
        leave(group)
    for pos, room in _rooms(doc.get("rooms")):
        if room is None:
            continue
        flat = {k: v for k, v in room.items() if k != "gallery"} if isinstance(room, dict) else {"name": room}
        node = enter("room", pos, str(pos), flat)
        for i, x in _items(room.get("gallery") if isinstance(room, dict) else None):
            if x is not None:
                leave(enter("image", i, str(pos), x))
        leave(node)
    for label, items in _groups(doc.get("reviews"), "tags", "items"):
        group = enter("tags", 0, label)
        for pos, x in _items(items):
            if x is not None:
                leave(enter("review", pos, label, x))
        leave(group)
    leave(top)
    return [tuple(x) for x in out]


def _label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for det_id, doc, body in zip(pdf["det_id"], pdf["doc"], pdf["body"]):
            try:
                parsed = unwrap(json.loads(body)) if isinstance(body, str) else None
            except (ValueError, RecursionError):
                parsed = None
            if parsed is not None:
                rows += [(det_id, doc, *x) for x in walk(parsed)]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def label_nodes(docs: DataFrame) -> DataFrame:
    """docs(det_id long, body string of JSON) -> node table with interval labels.

    Null, cut-off and non-object bodies give no node. A null det_id is kept. Documents with the same
    det_id but another body stay apart through ``doc``. Extra columns are ignored.
    """
    docs = docs.select(F.col("det_id").cast("long").alias("det_id"), F.col("body").cast("string").alias("body"))
    docs = docs.where(F.col("body").isNotNull()).withColumn("doc", F.hex(F.xxhash64("det_id", "body")))
    return docs.mapInPandas(_label, NODE_SCHEMA)


def link_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes with ``parent_pre`` and ``parent_label``: the innermost node of the parent's type around each child."""
    before = Window.partitionBy("det_id", "doc").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    ident = F.struct("pre", "post", "label")
    found = None
    for child, parent in PARENT_OF.items():
        last = F.last(F.when(F.col("kind") == parent, ident), ignorenulls=True).over(before)
        found = F.when(F.col("kind") == child, last) if found is None else found.when(F.col("kind") == child, last)
    out = nodes.withColumn("up", found)
    inside = (F.col("up.pre") < F.col("pre")) & (F.col("post") < F.col("up.post"))
    return out.select(*nodes.columns, F.when(inside, F.col("up.pre")).alias("parent_pre"), F.when(inside, F.col("up.label")).alias("parent_label"))


def details_as_json(details: DataFrame) -> DataFrame:
    """The typed table in the form label_nodes takes; null members are left out, null elements stay."""
    return details.select("det_id", F.to_json(F.struct("facilities", "rooms", "reviews")).alias("body"))


def flat_tables(nodes: DataFrame) -> dict[str, DataFrame]:
    """One table per child type: facilities, rooms, images and reviews, each with its parent's label and place."""
    linked = link_nodes(nodes)
    base = ["det_id", "doc", "pre", "parent_pre", "parent_label", "pos"]
    of = lambda kind: linked.where((F.col("kind") == kind) & F.col("parent_pre").isNotNull())
    body = lambda name, kind="string": F.get_json_object("body", f"$.{name}").cast(kind).alias(name)
    return {
        "facilities": of("facility").select(*base, F.col("body").alias("facility")),
        "rooms": of("room").select(*base, body("name"), body("facilities"), body("livingscore", "double")),
        "images": of("image").select(*base, F.col("body").alias("url")),
        "reviews": of("review").select(*base, body("positive"), body("negative")),
    }


def children(details: DataFrame, raw_details: DataFrame) -> DataFrame:
    """(det_id, child, parent, pos) of every non-null child element of both tables."""
    docs = details_as_json(details).unionByName(raw_details.select("det_id", "body"))
    linked = link_nodes(label_nodes(docs)).where(F.col("kind").isin(*PARENT_OF) & F.col("parent_pre").isNotNull())
    return linked.select("det_id", F.col("kind").alias("child"), F.when(F.col("kind") == "room", F.lit("")).otherwise(F.col("parent_label")).alias("parent"), "pos")
