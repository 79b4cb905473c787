"""Deterministic identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockpot.functions.words import NAMESPACES


def uuid5(namespace: str, key: Column) -> Column:
    """The version-5 UUID of a text key in a namespace, as text; null for a null key."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(key, "UTF-8")))
    part = lambda at, n: F.substring(digest, at, n)
    variant = F.translate(part(17, 1), "0123456789abcdef", "89ab" * 4)
    text = F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))
    return F.when(key.isNotNull(), text)


def entity_id(kind: str, key: Column) -> Column:
    """The id of a recipe, category, tag or ingredient by its natural key."""
    return uuid5(NAMESPACES[kind], key)


def content_hash(content: Column) -> Column:
    """SHA-256 in hex of bytes or text."""
    return F.sha2(content, 256)
