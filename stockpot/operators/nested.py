"""Problem 7: nested records of many shapes turned into flat child tables.

Method. A bottom-up tree automaton gives every JSON value a state (null, blank, text, scalar,
object with its fields, list, numbered object, section, JSON text). The state of the value that
holds the children of a kind is their structural variant, the state of a child its shape.
Children are routed by kind and shape into typed subtype tables, which keep the keys of the
common supertype: document, kind, section and place. Typed nested columns take the same route
without JSON, their variant being fixed by the schema.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpot.session import cut

# The child kinds, the keys that hold them, and the keys of a heading group's own list.
KINDS = {"ingredient": ("ingredients",), "instruction": ("instructions",), "category": ("categories",), "tag": ("tags",)}
WRAPPERS = ("recipe",)
TAXONOMY = "taxonomy"
GROUP_KEYS = ("ingredients", "items", "steps", "instructions", "lines")
HEADING = "section"
# The fields of the objects of each kind.
FIELDS = {
    "ingredient": ("ingredient_id", "name", "normalized_name", "quantity", "unit", "preparation", "position"),
    "instruction": ("position", "text"),
    "category": ("id", "slug", "name"),
    "tag": ("id", "slug", "name", "color"),
}
#: Names under which a field may be stored besides its own.
OTHER_NAMES = {"pos": "position"}
TEXTS = ("id", "slug", "name", "ingredient_id", "normalized_name", "quantity", "unit", "preparation", "color", "text")

#: The columns of the supertype, and those of all subtypes with the keys that no subtype has.
COMMON = ("rec_no", "child_kind", "section_no", "child_no", "variant", "shape", "heading")
CHILD = f"rec_no long, child_kind string, section_no int, child_no int, variant string, shape string, heading string, {', '.join(f'{t} string' for t in TEXTS)}, position int, extra map<string,string>, subtype string"
SUBTYPES = tuple(f"{kind}_{form}" for kind in KINDS for form in ("object", "text"))


def _step(value: Any) -> tuple[str, Any]:
    """The state of a value by its own make, and the value, parsed where it is JSON text."""
    if value is None:
        return "null", None
    if isinstance(value, str):
        text = value.strip()
        if text[:1] in ("[", "{"):
            try:
                inner = json.loads(text)
            except (ValueError, RecursionError):
                return "text", text
            return "json:" + _step(inner)[0], inner
        return ("text", text) if text else ("blank", None)
    if isinstance(value, list):
        return "list", value
    if isinstance(value, dict):
        if not value:
            return "blank", None
        if all(k.isdecimal() for k in value):
            return "numbered", value
        if HEADING in value and any(k in value and (value[k] is None or isinstance(value[k], (list, dict, str))) for k in GROUP_KEYS):
            return "section", value
        return "object", value
    return "scalar", value


def state(value: Any) -> str:
    """The automaton's state of a value; that of a list or object tells of its parts."""
    own, value = _step(value)
    made = own.removeprefix("json:")
    if made in ("list", "numbered"):
        parts = value if made == "list" else value.values()
        return f"{own}<{'|'.join(sorted({_step(v)[0] for v in parts} - {'null', 'blank'}))}>"
    return f"{own}{{{','.join(sorted(value))}}}" if made == "object" else own


def children(value: Any) -> list[tuple[int, str | None, Any]]:
    """(section_no, heading, child) of one kind, in stored order; section_no is 0 outside of a heading group."""
    found: list[tuple[int, str | None, Any]] = []
    groups = 0
    # what is still to be read, the next at the end
    stack: list[tuple[Any, int, str | None]] = [(value, 0, None)]
    while stack:
        v, section, heading = stack.pop()
        own, v = _step(v)
        made = own.removeprefix("json:")
        if made == "list":
            stack += ((x, section, heading) for x in reversed(v))
        elif made == "numbered":
            stack += ((v[k], section, heading) for k in sorted(v, key=int, reverse=True))
        elif made == "section":
            groups += 1
            name = v[HEADING]
            inner = next((v[k] for k in GROUP_KEYS if v.get(k) is not None), None)
            stack.append((inner, groups, name if isinstance(name, str) else None))
        elif made not in ("null", "blank"):
            found.append((section, heading, v))
    return found


def _text(value: Any) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _place(value: Any) -> int | None:
    number = int(value) if isinstance(value, int) and not isinstance(value, bool) or isinstance(value, str) and value.isdecimal() else None
    return number if number is not None and abs(number) < 2**31 else None


def typed(kind: str, child: Any) -> tuple[str, dict[str, Any], dict[str, str] | None]:
    """subtype, fields and the keys beyond them of a child."""
    if not isinstance(child, dict):
        return f"{kind}_text", {"text": child.strip() if isinstance(child, str) else _text(child)}, None
    fields: dict[str, Any] = {}
    extra: dict[str, str] = {}
    for key, value in child.items():
        name = OTHER_NAMES.get(key, key)
        if name not in FIELDS[kind] or name in fields:
            extra[key] = json.dumps(value, ensure_ascii=False)
        elif name != "position":
            fields[name] = _text(value)
        elif (place := _place(value)) is not None:
            fields[name] = place
        elif value is not None:
            extra[key] = json.dumps(value, ensure_ascii=False)
    return f"{kind}_object", fields, extra or None


def flatten_document(document: Any) -> Iterator[tuple[str, int, int, str, str, str | None, str, dict[str, Any], dict[str, str] | None]]:
    """(kind, section_no, child_no, variant, shape, heading, subtype, fields, extra) of each child of a parsed document."""
    if not isinstance(document, dict):
        return
    for wrapper in WRAPPERS:
        if isinstance(document.get(wrapper), dict):
            document = document[wrapper]
    holders = [document, document[TAXONOMY]] if isinstance(document.get(TAXONOMY), dict) else [document]
    for kind, keys in KINDS.items():
        number = 0
        for value in (holder[key] for holder in holders for key in keys if key in holder):
            variant = state(value)
            for section, heading, child in children(value):
                number += 1
                yield kind, section, number, variant, state(child) if isinstance(child, dict) else _step(child)[0], heading, *typed(kind, child)


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head = ["child_kind", "section_no", "child_no", "variant", "shape", "heading", "subtype"]
    names = ["rec_no", *head[:-1], *TEXTS, "position", "extra", "subtype"]
    types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), *[pa.string()] * (3 + len(TEXTS)), pa.int32(), pa.map_(pa.string(), pa.string()), pa.string()]
    # frames of Python live on the heap; the parser has a limit of its own
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 50_000))
    for batch in batches:
        out: dict[str, list] = {n: [] for n in names}
        for rec, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            try:
                rows = list(flatten_document(json.loads(body))) if body else []
            except (ValueError, RecursionError):
                continue
            for *common, fields, extra in rows:
                out["rec_no"].append(rec)
                for name, value in zip(head, common, strict=True):
                    out[name].append(value)
                for name in TEXTS:
                    out[name].append(fields.get(name))
                out["position"].append(fields.get("position"))
                out["extra"].append(extra and list(extra.items()))
        yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types, strict=True)], names)


def flatten_json(raw: DataFrame, key: str = "rec_no", body: str = "body") -> DataFrame:
    """The child rows of JSON documents (columns CHILD).

    A body that is null, empty, not complete JSON, or nested beyond what the parser of the
    standard library reads gives no rows; null elements and blank texts are no children; a
    missing or null kind gives none. Repeated rows are kept.
    """
    return raw.select(F.col(key).cast("long"), F.col(body)).where(F.length(body) > 1).mapInArrow(_flatten, CHILD)


def _json(value: Column) -> Column:
    """A value as JSON text; null for null."""
    whole = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), F.substr(whole, F.lit(6), F.length(whole) - 6))


def flatten_columns(docs: DataFrame, key: str = "rec_no") -> DataFrame:
    """The child rows of typed nested columns, by SQL expressions alone (columns CHILD).

    Null and empty arrays and null elements give no rows.
    """

    def rows(kind: str, column: str) -> Column:
        own = docs.schema[column].dataType.elementType.fieldNames()
        stored = {OTHER_NAMES.get(n, n): n for n in own if OTHER_NAMES.get(n, n) in FIELDS[kind]}
        field = lambda x, n, of: (x[stored[n]] if n in stored else F.lit(None)).cast(of).alias(n)
        more = [n for n in own if n not in stored.values()]
        extra = lambda x: F.map_from_arrays(F.array(*map(F.lit, more)), F.array(*(_json(x[n]) for n in more))) if more else F.lit(None).cast("map<string,string>")
        shape = f"object{{{','.join(sorted(own))}}}"
        child = lambda x, i: F.struct(
            F.lit(kind).alias("child_kind"), F.lit(0).alias("section_no"), (i + 1).cast("int").alias("child_no"), F.lit("list<object>").alias("variant"), F.lit(shape).alias("shape"), F.lit(None).cast("string").alias("heading"),
            *(field(x, n, "string") for n in TEXTS), field(x, "position", "int"), extra(x).alias("extra"), F.lit(f"{kind}_object").alias("subtype"),
        )
        return F.coalesce(F.transform(F.filter(F.col(column), lambda x: x.isNotNull()), child), F.array())

    lists = [rows(kind, columns[0]) for kind, columns in KINDS.items()]
    return docs.select(F.col(key).cast("long").alias("rec_no"), F.explode(F.concat(*lists)).alias("_c")).select("rec_no", "_c.*")


def variant_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The typed subtype tables of child rows, by subtype: the common columns, the fields of the kind and the keys beyond them.

    The rows are routed once, each subtype to a folder of its own, so a table is read without the others.
    """
    routed = cut(rows, "children", by="subtype")
    of = lambda kind, form: (*FIELDS[kind], "extra") if form == "object" else ("text",)
    return {s: routed.where(F.col("subtype") == s).select(*COMMON, *of(*s.split("_"))) for s in SUBTYPES}


def common_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of all subtype tables by the columns of the supertype, and their subtype."""
    return reduce(DataFrame.unionByName, (t.select(*COMMON, F.lit(s).alias("subtype")) for s, t in tables.items()))
