"""Mixing sources to target weights by Poisson replication.

A source's mean repetition is its target share of the output's characters over the characters it
has. Each document's count comes from inverting the Poisson distribution of that mean at a number
hashed from seed and doc_id; the document is exploded by its count and all copies are dealt out
and ordered by a hash of document and copy. Means over ``PART`` are sums of independent parts, so
no mean is too large for the table of one part.

Everything is a built-in expression. The only join is with one row per source, read from a table
so that Spark knows its true size: broadcast if that is small, else a sorted join whose hot
sources adaptive execution splits.

Defined results: a null text has no characters; null is a source of its own; a source without
characters, or with weight 0 or no weight among given weights, gives no rows; rows of equal
doc_id get equal counts; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep

SEED = 17
#: Without given weights, a source's target share goes with its characters to this power.
FLATTEN = 0.5
#: Largest mean of one part, and the counts its table goes up to (beyond: under 2**-52).
PART, COUNTS = 8, 60
_LOG_FACTORIALS = [math.lgamma(k + 1) for k in range(COUNTS + 1)]


def _hashed(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))


def _unit(digest: Column) -> Column:
    """52 bits of a digest as a number from 0 to 1, exact in a double."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def _cumulated(mean: Column) -> Column:
    """P(count <= k) for k from 0 to COUNTS, of a Poisson distribution."""
    chances = [F.exp(k * F.log(mean) - mean - log) for k, log in enumerate(_LOG_FACTORIALS)]
    chances[0] = F.exp(-mean)
    start = F.array().cast("array<double>")
    return F.aggregate(
        F.array(*chances), start,
        lambda sums, p: F.concat(sums, F.array(p + F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0.0)))),
    )


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, budget: int | None = None) -> DataFrame:
    """One row per source: its mean repetition, whole parts of it, and the table of the rest.
    ``budget`` is the output's expected number of characters (default: those there are)."""
    chars = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    sizes = keep(docs.groupBy("source").agg(F.sum(chars).alias("chars")).where("chars > 0"))
    if weights is None:
        weight = F.pow(F.col("chars").cast("double"), F.lit(FLATTEN))
    else:
        weight = F.lit(0.0)
        for source, share in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(share))).otherwise(weight)
    total, weighed = sizes.agg(F.sum("chars"), F.sum(weight)).first()
    target = float(total or 0) if budget is None else float(budget)
    mean = weight / F.lit(weighed or 1.0) * F.lit(target) / F.col("chars")
    parts = F.floor(F.col("mean") / PART).cast("int")
    return (
        sizes.select("source", mean.alias("mean")).where("mean > 0")
        .select("source", "mean", parts.alias("parts"), (F.col("mean") - parts * PART).alias("rest"))
        .withColumn("rest_table", F.when(F.col("rest") > 0, _cumulated(F.col("rest"))).otherwise(F.array(F.lit(1.0))))
    )


def dealt(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, budget: int | None = None, seed: int = SEED
) -> DataFrame:
    """The mixed corpus: ``_row`` (all columns of ``docs``), ``_copy`` (from 1) and ``_order``, by
    whose value the rows are dealt out and sorted."""
    table = keep(rates(docs, weights, budget)).select(F.col("source").alias("_source"), "parts", "rest_table")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col("source").alias("_source"), F.col("doc_id").alias("_id"))
    rows = rows.alias("d").join(table.alias("r"), F.expr("d._source <=> r._source"))
    full = _part_table()

    def drawn(part: Column, sums: Column) -> Column:
        # as an element, the number is made once and not for each entry of the table
        u = F.array(_unit(_hashed(F.lit(seed), F.col("_id"), part)))
        return F.get(F.transform(u, lambda u: F.size(F.filter(sums, lambda x: x <= u))), F.lit(0))

    # a part's number goes into its hash; the rest is the part after the last whole one
    whole = F.when(F.col("parts") > 0, F.aggregate(
        F.sequence(F.lit(0), F.col("parts") - 1), F.lit(0), lambda n, j: n + drawn(j, full)
    )).otherwise(0)
    count = whole + drawn(F.col("parts"), F.col("rest_table"))
    rows = rows.select("_row", "_id", F.posexplode(F.array_repeat(F.lit(True), count)).alias("_copy", "_"))
    rows = rows.withColumn("_copy", F.col("_copy") + 1)
    order = F.substring(_hashed(F.lit(seed), F.col("_id"), F.lit("copy"), F.col("_copy")), 1, 16)
    rows = rows.select("_row", "_copy", order.alias("_order"))
    return rows.repartition("_order").sortWithinPartitions("_order")


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None, budget: int | None = None) -> DataFrame:
    """The mixed corpus with just the columns of ``docs``."""
    return dealt(docs, weights, budget).select("_row.*")


def _part_table() -> Column:
    total, sums = 0.0, []
    for k, log in enumerate(_LOG_FACTORIALS):
        total += math.exp(k * math.log(PART) - PART - log)
        sums.append(total)
    return F.array(*[F.lit(x) for x in sums])


def report(docs: DataFrame) -> DataFrame:
    """Every copy, whole, in its place. Columns of ``docs`` called ``copy`` or ``shuffle_key`` give
    way to those made here."""
    own = [F.col(f"_row.`{c}`") for c in docs.columns if c not in ("copy", "shuffle_key")]
    return dealt(docs).select(*own, F.col("_copy").alias("copy"), F.col("_order").alias("shuffle_key"))


def oracle_sql() -> str:
    """The same rows over the table ``documents``, for DuckDB."""
    logs = ", ".join(repr(x) for x in _LOG_FACTORIALS)

    def sums(mean: str) -> str:
        return (
            f"list_transform(range(0, {COUNTS + 1}), lambda k: list_sum(list_transform(range(0, k + 1), "
            f"lambda i: exp(i * ln({mean}) - {mean} - ([{logs}])[i + 1]))))"
        )

    def unit(part: str) -> str:
        return f"CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || {part}), 1, 13) AS BIGINT) / {float(2**52)!r}"

    return f"""
WITH s AS (
  SELECT source, sum(length(coalesce(text, '')))::BIGINT AS chars FROM documents GROUP BY source HAVING chars > 0
), t AS (
  SELECT sum(chars) AS total, sum(pow(chars::DOUBLE, {FLATTEN})) AS weighed FROM s
), m AS (
  SELECT source, pow(chars::DOUBLE, {FLATTEN}) / weighed * total::DOUBLE / chars AS mean FROM s, t
), r AS (
  SELECT source, CAST(floor(mean / {PART}) AS INTEGER) AS parts, mean - floor(mean / {PART}) * {PART} AS rest FROM m
), u AS (
  SELECT source, parts, {sums('rest')} AS rest_table FROM r
), f AS (
  SELECT {sums(f'{PART}.0')} AS full_table
), c AS (
  SELECT d.*,
         coalesce(list_sum(list_transform(range(0, parts), lambda j: len(list_filter(full_table, lambda x: x <= {unit('j')})))), 0)
         + len(list_filter(rest_table, lambda x: x <= {unit('parts')})) AS n
  FROM documents d JOIN u ON d.source IS NOT DISTINCT FROM u.source, f
), e AS (
  SELECT * EXCLUDE (n), CAST(unnest(range(1, n::BIGINT + 1)) AS INTEGER) AS copy FROM c
)
SELECT *, substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':copy:' || copy), 1, 16) AS shuffle_key FROM e"""
