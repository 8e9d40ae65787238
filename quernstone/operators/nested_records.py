"""Deeply nested records as flat tables that keep their links to record, container and parent element."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions.shredding import Column, rebuild

# Keys of the public CVE JSON 5 record format.
#: kind, path below a container, and the leaves that ``element_table`` makes columns of.
TABLES = [
    ("title", [("title", False)], ["title"]),
    ("description", [("descriptions", True)], ["lang", "value"]),
    ("affected", [("affected", True)], ["vendor", "product", "packageName", "collectionURL", "repo", "defaultStatus", "cpes", "platforms"]),
    ("version", [("affected", True), ("versions", True)], ["version", "status", "lessThan", "lessThanOrEqual", "versionType"]),
    ("reference", [("references", True)], ["url", "name", "tags"]),
    ("metric", [("metrics", True)], ["format", "scenarios"]),
    ("problem", [("problemTypes", True), ("descriptions", True)], ["cweId", "description", "lang", "type"]),
]
KINDS = [kind for kind, *_ in TABLES]
CONTAINERS = [("cna", [("containers", False), ("cna", False)]), ("adp", [("containers", False), ("adp", True)])]
#: Wrappings around a record that are taken off at most.
WRAPPED = 6
#: Records shredded at a time.
CHUNK = 500

SCHEMA = "record_id bigint, record_pos int, cve_id string, container string, container_pos int, kind string, item_pos int, sub_pos int, attributes map<string,string>"
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def _load(text: str):
    return json.loads(text.strip().lstrip("﻿"))


def _records(value, depth: int):
    """All records in a value: itself, or those in its elements, values or JSON text."""
    if depth == 0:
        return
    if isinstance(value, str):
        if value.strip().lstrip("﻿")[:1] in ('{', '[', '"'):
            try:
                value = _load(value)
            except (ValueError, RecursionError):
                return
            yield from _records(value, depth - 1)
    elif isinstance(value, list):
        for x in value:
            yield from _records(x, depth - 1)
    elif isinstance(value, dict):
        if "containers" in value or "cveMetadata" in value:
            yield value
        else:
            for x in value.values():
                yield from _records(x, depth - 1)


def read_records(payload: str | None) -> tuple[list[dict], str | None]:
    """The records in a payload (plain, as a JSON string, in arrays or under a wrapper's keys), or why there are none.

    The reason is null, blank, no JSON, or no record where nothing has ``cveMetadata`` or ``containers``.
    """
    if payload is None:
        return [], "null"
    if not payload.strip().lstrip("﻿"):
        return [], "blank"
    try:
        value = _load(payload)
    except (ValueError, RecursionError):
        return [], "no JSON"
    found = list(_records(value, WRAPPED))
    return found, None if found else "no record"


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _leaves(value, skip: frozenset[str], path: tuple[str, ...], out: dict[tuple[str, ...], None]) -> None:
    """Adds the paths of all leaves below an object; arrays and empty objects are leaves."""
    for key, inner in value.items():
        if not path and key in skip:
            continue
        if isinstance(inner, dict) and inner:
            _leaves(inner, skip, (*path, key), out)
        else:
            out[*path, key] = None


def _containers(record: dict):
    boxes = record.get("containers")
    for name, root in CONTAINERS if isinstance(boxes, dict) else ():
        box = boxes.get(name)
        for one in box if isinstance(box, list) and root[-1][1] else [box]:
            if isinstance(one, dict):
                yield one


def _tables(records: list[dict]) -> list[tuple[str, list, frozenset[str]]]:
    """The known tables and one for every other array of a container, with the keys that have tables of their own."""
    known = {path[0][0] for _, path, _ in TABLES}
    others: dict[str, None] = {}
    for record in records:
        for box in _containers(record):
            others.update((k, None) for k, v in box.items() if isinstance(v, list) and k not in known)
    below = {tuple(path): frozenset(p[len(path)][0] for _, p, _ in TABLES if len(p) > len(path) and p[: len(path)] == path) for _, path, _ in TABLES}
    # An element's own kind wins over a key of the same name.
    return [(kind, path, below[tuple(path)]) for kind, path, _ in TABLES] + [(k if k not in KINDS else f"{k}[]", [(k, True)], frozenset()) for k in others] + [("container", [], frozenset(known | set(others)))]


def _shred(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, CHUNK):
            part = batch.slice(first, CHUNK)
            records, of, place = [], [], []
            for i, payload in enumerate(part.column(1).to_pylist()):
                found, _ = read_records(payload)
                records += found
                of += [i] * len(found)
                place += range(len(found))
            if not records:
                continue
            ids = part.column(0).take(pa.array(of))
            names = [_text(r["cveMetadata"].get("cveId")) if isinstance(r.get("cveMetadata"), dict) else None for r in records]
            keys = (ids, np.array(place, np.int32), names)
            yield from _rows(keys, records, "record", [], "record", [], frozenset(["containers"]))
            for kind, path, skip in _tables(records):
                for container, root in CONTAINERS:
                    yield from _rows(keys, records, container, root, kind, path, skip)


def _rows(keys, records, container, root, kind, path, skip):
    base = root + path
    whole = Column(base)
    for record in records:
        whole.add(record)
    # Leaf paths come from the data: no key is lost because nobody listed it.
    paths: dict[tuple[str, ...], None] = {}
    for value in whole.values:
        if isinstance(value, dict):
            _leaves(value, skip, (), paths)
    columns = [whole]
    for leaf in paths:
        column = Column(base + [(step, False) for step in leaf])
        for record in records:
            column.add(record)
        columns.append(column)
    table = rebuild(columns, len(base) - 1)
    n = len(table.record)
    keep = np.arange(n)
    if kind == "title":
        keep = np.array([i for i in range(n) if isinstance(table.leaves[0][i], str) and table.leaves[0][i].strip()], np.int64)
    if not len(keep):
        return
    places = table.positions
    container_pos = places[0] if container == "adp" else np.zeros(n, np.int64)
    rest = places[1:] if container == "adp" else places
    unused = np.full(n, -1, np.int64)
    item_pos, sub_pos = (rest + [unused, unused])[:2]
    named = [(".".join(leaf), values) for leaf, values in zip(paths, table.leaves[1:])]
    # An element that is no object has its value under its kind.
    attributes = [
        [(leaf, t) for leaf, v in named if (t := _text(v[i])) is not None] if isinstance(table.leaves[0][i], dict) else [(kind, t)] if (t := _text(table.leaves[0][i])) is not None else []
        for i in keep
    ]
    ids, place, names = keys
    record = table.record[keep]
    yield pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(record)),
            pa.array(place[record]),
            pa.array([names[i] for i in record], pa.string()),
            pa.array([container] * len(keep)),
            pa.array(container_pos[keep].astype(np.int32)),
            pa.array([kind] * len(keep)),
            pa.array(item_pos[keep].astype(np.int32)),
            pa.array(sub_pos[keep].astype(np.int32)),
            pa.array(attributes, pa.map_(pa.string(), pa.string())),
        ],
        names=_NAMES,
    )


def _input(df: DataFrame, id_column: str, payload_column: str) -> DataFrame:
    return df.select(F.col(id_column).cast("bigint").alias("record_id"), F.col(payload_column).cast("string").alias("payload"))


def shred_records(df: DataFrame, id_column: str = "record_id", payload_column: str = "payload") -> DataFrame:
    """All elements of all payloads, keyed by record, container, its place, kind and positions.

    Beside the kinds in TABLES there are ``record`` (the fields outside of containers), ``container`` (a
    container's own fields) and one kind for each other array in a container, under the array's name.
    ``attributes`` holds every leaf of an element by its dotted path; arrays without a table are JSON text.
    Positions start at 0 and count null elements, which give no rows themselves; unused ones are -1.  An
    object where an array is expected counts as an array of one, any other shape as absent.  A payload of
    several records gives each a ``record_pos``.  Null and unreadable payloads give no rows here (see
    ``unreadable_records``), nor do empty tables; repeated rows are shredded each.  Other columns are
    ignored, whatever their names.
    """
    return _input(df, id_column, payload_column).mapInArrow(_shred, SCHEMA)


def _reasons(batches):
    for batch in batches:
        reasons = pa.array([read_records(p)[1] for p in batch.column(1).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), reasons], names=["record_id", "reason"]).filter(reasons.is_valid())


def unreadable_records(df: DataFrame, id_column: str = "record_id", payload_column: str = "payload") -> DataFrame:
    """(record_id, reason) of the rows whose payload holds no record: null, blank, no JSON or no record."""
    return _input(df, id_column, payload_column).mapInArrow(_reasons, "record_id bigint, reason string")


def element_table(elements: DataFrame, kind: str, leaves: list[str] | None = None) -> DataFrame:
    """One flat table: the rows of a kind, with a column for each leaf; those of TABLES if none are named."""
    leaves = leaves or next((x for k, _, x in TABLES if k == kind), [kind])
    return elements.where(F.col("kind") == kind).select("record_id", "record_pos", "cve_id", "container", "container_pos", "item_pos", "sub_pos", *(F.col("attributes")[leaf].alias(leaf.replace(".", "_")) for leaf in leaves))
