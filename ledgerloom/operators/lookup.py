"""Attach values from report settings to rows."""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import sql_text

Table = Mapping[tuple[str, ...], str | int]
# Stands between the texts of a key where they are hashed together.
_BETWEEN = "\0"


def _directory(table: Table) -> tuple[int, str, str]:
    """Number of buckets, the buckets as JSON, and their type. There are at least two buckets for
    each entry, chosen by a checksum that Spark computes just so; most hold one entry or none."""
    buckets: list[list[dict]] = [[] for _ in range(1 << len(table).bit_length() + 1)]
    for texts, value in table.items():
        slot = zlib.crc32(_BETWEEN.join(texts).encode()) % len(buckets)
        buckets[slot].append({"k": {f"k{i}": text for i, text in enumerate(texts)}, "v": value})
    width = len(next(iter(table)))
    fields = ", ".join(f"k{i}: string" for i in range(width))
    kind = "int" if isinstance(next(iter(table.values())), int) else "string"
    return len(buckets), json.dumps(buckets), f"array<array<struct<k: struct<{fields}>, v: {kind}>>>"


def lookup_value(keys: Sequence[Column], table: Table, default: Column) -> Column:
    """The ``table`` value for the texts in ``keys``, else ``default``.

    ``table`` comes from settings, so its size never depends on the data. It becomes a literal
    hash directory inside the row expression: no row moves, and a row looks at one bucket of few
    entries, however many there are. (Literal maps are searched from end to end, and Spark does not
    see that two of them are equal.) A NULL key gets the default.
    """
    if not table:
        return default
    n, buckets, kind = _directory(table)
    joined = F.concat(*[part for key in keys for part in (F.lit(_BETWEEN), key)][1:])
    bucket = F.get(F.from_json(F.lit(buckets), kind), (F.crc32(joined) % n).cast("int"))
    entry = F.struct(*[key.alias(f"k{i}") for i, key in enumerate(keys)])
    place = F.array_position(bucket["k"], entry).cast("int") - 1
    return F.coalesce(F.get(bucket["v"], place), default)


def lookup_sql(keys: Sequence[str], table: Table, default: str) -> str:
    """``lookup_value`` as SQL text over SQL expressions."""
    if not table:
        return default
    n, buckets, kind = _directory(table)
    joined = ", '\\0', ".join(keys)
    bucket = f"get(from_json({sql_text(buckets)}, '{kind}'), CAST(crc32(concat({joined})) % {n} AS INT))"
    entry = ", ".join(f"{key} AS k{i}" for i, key in enumerate(keys))
    return f"coalesce(get({bucket}.v, CAST(array_position({bucket}.k, struct({entry})) AS INT) - 1), {default})"


def lookup(df: DataFrame, keys: Sequence[Column], table: Table, name: str, default: Column) -> DataFrame:
    """Add column ``name``: ``lookup_value``."""
    return df.withColumn(name, lookup_value(keys, table, default))
