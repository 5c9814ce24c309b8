"""Problem 1: deeply nested records into flat tables with parent links.

Each record is shredded into columns, one per leaf path, as value sequences
with repetition and definition levels; the table of any repeated ancestor is
put together from the level sequences of one leaf below it, without looking at
the record again. A record is one row, so nothing is shuffled.

Levels. A repeated field adds three definition levels: the list is there, it
has an entry, the entry is an object (or value). An entry's repetition level
is the depth of the list that it continues, 0 where it starts a record.

The tree of ``judgment`` is recursive, so its columns are as deep as the
record: ``judgment``, ``judgment.elements*1``, ``judgment.elements*2`` and so on.

Defined results: null, blank or unreadable JSON, and JSON of another shape,
has no node. One object in place of a list is a list of one. Null entries and
entries of another type take a place but are no node. JSON text inside a JSON
string, and objects that only wrap the list, add no node. Repeated rows give
repeated results. Nothing recurses, so depth is bounded by memory alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = "path string, rep array<int>, def array<int>, leaf array<string>"
_NODE_KEYS = {"content", "elements", "section_name", "level", "node_type", "attributes"}
_SCALAR = re.compile(r'[ \t\r\n]*(?:"((?:[^"\\]|\\.)*)"|(-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(true|false|null)|([\[\]{},:]))', re.S)


def _deep(text: str):
    """json.loads without recursion, for texts nested beyond the interpreter's limit."""
    root: list = []
    stack, keys, at, key = [root], [None], 0, None
    expect_key = False
    while at < len(text):
        m = _SCALAR.match(text, at)
        if not m:
            if text[at:].strip():
                raise ValueError("not JSON")
            break
        at, sign, value = m.end(), m[4], None
        if sign in ("{", "["):
            value = {} if sign == "{" else []
        elif sign in ("}", "]"):
            if len(stack) == 1 or isinstance(stack[-1], dict) != (sign == "}"):
                raise ValueError("not JSON")
            stack.pop()
            key = keys.pop()
            expect_key = isinstance(stack[-1], dict)
            continue
        elif sign == ",":
            expect_key = isinstance(stack[-1], dict)
            continue
        elif sign == ":":
            expect_key = False
            continue
        else:
            value = json.loads(m[0])
            if expect_key:
                key, expect_key = value, False
                continue
        if isinstance(stack[-1], dict):
            stack[-1][key] = value
        else:
            stack[-1].append(value)
        if sign:
            keys.append(key)
            stack.append(value)
            expect_key = sign == "{"
    if len(stack) != 1 or len(root) != 1:
        raise ValueError("not JSON")
    return root[0]


def parse(text: str | None):
    """The value of a JSON text, encoded once or several times; None where it can't be read."""
    value = text
    while isinstance(value, str):
        try:
            value = json.loads(value)
        except RecursionError:
            try:
                value = _deep(value)
            except ValueError:
                return None
        except ValueError:
            return None
    return value


def top_list(value) -> list:
    """The list of top nodes, freed of objects that only wrap it."""
    while True:
        if isinstance(value, str):
            value = parse(value)
        elif isinstance(value, dict):
            inner = value.get("content")
            if isinstance(inner, (dict, list)) and "elements" not in value:
                value = inner
            elif value and not _NODE_KEYS & value.keys() and any(isinstance(v, (dict, list)) for v in value.values()):
                inside = [v for v in value.values() if isinstance(v, (dict, list))]
                value = inside[0] if len(inside) == 1 else [x for v in inside for x in (v if isinstance(v, list) else [v])]
            else:
                return [value]
        else:
            return value if isinstance(value, list) else []


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def shred_tree(
    top: list, path: str = "judgment", child: str = "elements", leaves: tuple[str, ...] = ("content",)
) -> dict[str, tuple[list, list, list]]:
    """Columns of a recursive list of objects: leaf path to (repetition, definition, value) sequences."""
    columns: dict[str, tuple[list, list, list]] = {}
    depth_of: list[str] = []

    def put(depth: int, rep: int, level: int, value, leaf: str) -> None:
        rs, ds, vs = columns[f"{depth_of[depth]}.{leaf}"]
        rs.append(rep)
        ds.append(level)
        vs.append(value)

    # Depth first; each work item is a list at some depth with the repetition level it starts at.
    work: list[tuple] = [("list", top, 0, 0, 0)]
    entries: list[tuple[int, int, int, object]] = []  # (depth, rep, def, node or None) in record order
    while work:
        kind, value, depth, rep, level = work.pop()
        if kind == "list":
            if not value:
                entries.append((depth, rep, level + (1 if value is not None else 0), None))
                continue
            work.extend(
                ("entry", v, depth, rep if k == 0 else depth + 1, level + 2) for k, v in reversed(list(enumerate(value)))
            )
        elif isinstance(value, dict):
            entries.append((depth, rep, level + 1, value))
            inner = value.get(child)
            if isinstance(inner, str):
                inner = parse(inner) if inner.lstrip()[:1] in ("[", "{") else None
            inner = [inner] if isinstance(inner, dict) else inner if isinstance(inner, list) else None
            work.append(("list", inner, depth + 1, rep, level + 1))
        else:
            entries.append((depth, rep, level, None))
    deepest = max((d for d, *_ in entries), default=0)
    for d in range(deepest + 1):
        depth_of.append(f"{path}.{child}*{d}" if d else path)
        for leaf in leaves:
            columns[f"{depth_of[d]}.{leaf}"] = ([], [], [])
    for depth, rep, level, node in entries:
        if node is not None:
            for leaf in leaves:
                value = _text(node.get(leaf))
                put(depth, rep, level + (value is not None), value, leaf)
        else:  # what is absent here is absent in every deeper column too
            for d in range(depth, deepest + 1):
                for leaf in leaves:
                    put(d, rep, level, None, leaf)
    return columns


def shred_list(values, path: str, leaves: dict[str, str | None]) -> dict[str, tuple[list, list, list]]:
    """Columns of a list of structs; a leaf is a scalar member (None) or a list of values (a name)."""
    columns: dict[str, tuple[list, list, list]] = {f"{path}.{leaf}": ([], [], []) for leaf in leaves}

    def put(leaf: str, rep: int, level: int, value=None) -> None:
        rs, ds, vs = columns[f"{path}.{leaf}"]
        rs.append(rep)
        ds.append(level)
        vs.append(value)

    if values is None or len(values) == 0:
        for leaf in leaves:
            put(leaf, 0, 0 if values is None else 1)
        return columns
    for k, entry in enumerate(values):
        rep = 0 if k == 0 else 1
        for leaf, kind in leaves.items():
            value = None if entry is None else entry.get(leaf)
            if entry is None:
                put(leaf, rep, 2)
            elif kind is None:
                put(leaf, rep, 3 + (value is not None), _text(value))
            elif value is None or len(value) == 0:
                put(leaf, rep, 3 + (value is not None))
            else:
                for j, x in enumerate(value):
                    put(leaf, rep if j == 0 else 2, 5 + (x is not None), _text(x))
    return columns


def assemble(path: str, rep: list[int], level: list[int], depth: int) -> Iterator[tuple[str, str, int]]:
    """(parent path, own path, index of the entry) of every instance of the ancestor that is repeated ``depth`` times.

    Only the levels are read: an entry of repetition level r continues the
    r-th list, so it counts there and starts anew below.
    """
    place = [-1] * depth
    root = path
    for k, (r, d) in enumerate(zip(rep, level)):
        if r > depth:
            continue
        if r == 0:
            place = [0] * depth
        else:
            place[r - 1] += 1
            for below in range(r, depth):
                place[below] = 0
        if d >= 3 * depth:
            parent = ".".join([root, *map(str, place[:-1])])
            yield parent, f"{parent}.{place[-1]}", k


# The struct members of a conclusion: None for a scalar, else a list of values.
CONCLUSION = {"element": None, "type": None, "article": None, "base_article": None, "details": "list", "mentions": "list"}


def _shred(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for record, judgment, conclusions in zip(batch[key], batch["judgment"], batch["conclusions"]):
            for columns in (
                shred_tree(top_list(parse(judgment))),
                shred_list(conclusions, "conclusions", CONCLUSION),
            ):
                rows.extend((record, p, r, d, v) for p, (r, d, v) in columns.items())
        yield pd.DataFrame(rows, columns=[key, "path", "rep", "def", "leaf"])


def shred(df: DataFrame, key: str = "record_no") -> DataFrame:
    """(key, path, rep, def, leaf): the column of every leaf path of every record, in level sequences."""
    kind = dict(df.dtypes)[key]
    return df.select(key, "judgment", "conclusions").mapInPandas(lambda b: _shred(b, key), f"{key} {kind}, {LEVELS}")


def _nodes(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for record, path, rep, level, leaf in zip(batch[key], batch["path"], batch["rep"], batch["def"], batch["leaf"]):
            root, *members = path.split(".")
            rep, level = list(rep), list(level)
            if root == "judgment":
                found = assemble(root, rep, level, 1 + int(members[0].partition("*")[2] or 0))
                rows.extend((record, "node", a, b, leaf[k]) for a, b, k in found)
            elif members == ["element"]:
                rows.extend((record, "conclusion", a, b, leaf[k]) for a, b, k in assemble(root, rep, level, 1))
            elif members[-1] in ("details", "mentions"):
                for parent, own, k in assemble(root, rep, level, 2):
                    place = own.rpartition(".")[2]
                    rows.append((record, members[-1], parent, f"{parent}.{members[-1]}.{place}", leaf[k]))
        yield pd.DataFrame(rows, columns=[key, "kind", "parent_path", "child_path", "value"])


def nodes(shredded: DataFrame, key: str = "record_no") -> DataFrame:
    """(key, kind, parent_path, child_path, value): the flat tables, tied to their parents by path."""
    kind = dict(shredded.dtypes)[key]
    wanted = F.col("path").rlike(r"^judgment(\.elements\*[0-9]+)?\.content$|^conclusions\.(element|details|mentions)$")
    return shredded.where(wanted).mapInPandas(
        lambda b: _nodes(b, key), f"{key} {kind}, kind string, parent_path string, child_path string, value string"
    )
