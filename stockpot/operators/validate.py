"""Validation rules compiled from JSON Schema to columns, so a batch is checked in one pass."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _resolve(schema: dict[str, Any], root: dict[str, Any]) -> dict[str, Any]:
    while "$ref" in schema:
        node: Any = root
        for part in schema["$ref"].lstrip("#/").split("/"):
            node = node[part]
        schema = node
    return schema


def _rules(schema: dict[str, Any], root: dict[str, Any], value: Column, path: Column, required: bool, depth: int = 0) -> list[Column]:
    """Arrays of messages, one column per keyword; an array of a rule that holds is empty."""
    schema = _resolve(schema, root)
    none = F.array().cast("array<string>")
    kinds = schema.get("type", [])
    kinds = kinds if isinstance(kinds, list) else [kinds]
    say = lambda broken, text: F.when(F.coalesce(broken, F.lit(False)), F.array(F.concat(path, F.lit(f": {text}")))).otherwise(none)
    out = []
    if required and kinds and "null" not in kinds:
        out.append(say(value.isNull(), f"is not of type {' or '.join(kinds)}"))
    if "enum" in schema:
        out.append(say(~value.isin([e for e in schema["enum"] if e is not None]), f"is not one of {schema['enum']}"))
    if "const" in schema:
        out.append(say(value != F.lit(schema["const"]), f"{schema['const']!r} was expected"))
    if "minimum" in schema:
        out.append(say(value < schema["minimum"], f"is less than the minimum of {schema['minimum']}"))
    if "minLength" in schema:
        out.append(say(F.length(value) < schema["minLength"], "is too short"))
    if "pattern" in schema:
        out.append(say(~value.rlike(schema["pattern"]), f"does not match {schema['pattern']!r}"))
    if "items" in schema:
        inner = lambda x, i: F.concat(none, *_rules(schema["items"], root, x, F.concat(path, F.lit("."), i.cast("string")), True, depth + 1))
        out.append(F.coalesce(F.flatten(F.transform(value, inner)), none))
    for name, sub in schema.get("properties", {}).items():
        out += [F.when(value.isNotNull(), r).otherwise(none) for r in _rules(sub, root, value[name], F.concat(path, F.lit(f".{name}")), name in schema.get("required", []), depth + 1)]
    return out


def violations(df: DataFrame, schema: dict[str, Any]) -> Column:
    """The messages of all rules that a row breaks, sorted by place; a key that is absent equals null.

    Keywords: type (null or not), required, properties, items, enum, const, minimum, minLength,
    pattern, $ref. Columns the schema does not name break additionalProperties: false for
    the table as a whole, so they are an error here and not a message of each row.
    """
    known = schema.get("properties", {})
    if schema.get("additionalProperties") is False and (extra := set(df.columns) - set(known)):
        raise ValueError(f"columns that the schema does not allow: {', '.join(sorted(extra))}")
    if missing := set(schema.get("required", [])) - set(df.columns):
        raise ValueError(f"columns that the schema requires: {', '.join(sorted(missing))}")
    rules = [r for name, sub in known.items() if name in df.columns for r in _rules(sub, schema, F.col(name), F.lit(name), name in schema.get("required", []))]
    return F.array_sort(F.concat(F.array().cast("array<string>"), *rules))


def split_valid(df: DataFrame, schema: dict[str, Any], shown: int = 5) -> tuple[DataFrame, DataFrame]:
    """The rows that break no rule, and those that do with the first messages in errors."""
    checked = df.withColumn("errors", violations(df, schema))
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0).withColumn("errors", F.slice("errors", 1, shown))


def require_valid(df: DataFrame, schema: dict[str, Any], name: str = "rows") -> DataFrame:
    """df, or an error at the first action that tells the messages of a row that breaks rules."""
    bad = F.array_join(F.slice(violations(df, schema), 1, 5), "\n")
    guard = F.when(bad != "", F.raise_error(F.concat(F.lit(f"schema validation failed for {name}:\n"), bad))).otherwise(F.lit(True))
    return df.where(F.coalesce(guard.cast("boolean"), F.lit(True)))
