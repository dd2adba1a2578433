"""Money text: amounts to locale text, locale text back to amounts. JVM expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.config import BRL, MONEY, MoneyStyle

# Every character that counts as white space, no-break spaces included.
WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def format_money(
    amount: Column, style: MoneyStyle = BRL, inner_if: Column | None = None
) -> Column:
    """Amount as text; NULL stays NULL. Rounds half up to cents, and takes the sign after
    rounding, so -0.004 has none. Give decimals: a double loses cents at 17 digits.

    ``inner_if`` chooses the place of the minus row by row instead of ``style.negative``.
    """
    cents = F.round(amount, 2)
    digits = F.translate(
        F.format_number(F.abs(cents), 2), ",.", style.thousands + style.decimal
    )
    outer, inner = F.lit("-" + style.symbol), F.lit(style.symbol + "-")
    if inner_if is not None:
        negative = F.when(inner_if, inner).otherwise(outer)
    else:
        negative = inner if style.negative == "inner" else outer
    return F.concat(F.when(cents < 0, negative).otherwise(style.symbol), digits)


def parse_money(text: Column, style: MoneyStyle = BRL) -> Column:
    """Money text of a style to DECIMAL; anything that is no number becomes NULL.

    Parenthesised text goes first (a forecast mark, but also an accounting negative, which
    therefore becomes NULL), then currency characters, white space and thousands separators;
    the decimal separator turns into a point. A thousands separator after the decimal one shows
    that the text is of another style: NULL too.
    """
    bare = F.regexp_replace(text, r"\(.*?\)", "")
    symbol = "".join(c for c in style.symbol if c not in "-0123456789")
    dropped = style.thousands + symbol + WHITE_SPACE
    # a plain point is no part of a number unless the style says so
    other = "" if "." in style.decimal + style.thousands else "."
    value = F.translate(bare, style.decimal + other + dropped, "." + other.replace(".", "?")).try_cast(MONEY)
    fraction = F.substring_index(bare, style.decimal, -1)
    foreign = F.contains(bare, F.lit(style.decimal)) & F.contains(fraction, F.lit(style.thousands))
    return F.when(~foreign, value)


def format_money_columns(
    df: DataFrame, columns: Sequence[str] | None = None, style: MoneyStyle = BRL
) -> DataFrame:
    """``format_money`` over ``columns``, by default every numeric one; others are unchanged."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.withColumns({c: format_money(F.col(f"`{c}`"), style) for c in columns})


def parse_money_columns(df: DataFrame, columns: Sequence[str], style: MoneyStyle = BRL) -> DataFrame:
    return df.withColumns({c: parse_money(F.col(f"`{c}`"), style) for c in columns})


def _rejected(text: Column, style: MoneyStyle) -> Column:
    """Whether a text is not blank yet no amount."""
    return (F.translate(text, WHITE_SPACE, "") != "") & parse_money(text, style).isNull()


def money_reject_samples(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), style: MoneyStyle = BRL, k: int = 5
) -> DataFrame:
    """``k`` different rejected texts per column (and key), and how often each occurs:
    [keys], column_name, sample, reject, n_rows.

    The texts with the smallest digests, so any partitioning and any order of rows gives the same
    ones; k smallest of parts merge into the k smallest of all. Texts are counted on the map side
    first, so one that fills a third of the rows travels once per task; then each task sends its k.
    """
    texts = F.inline(F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").alias("reject")) for name in columns]))
    found = df.select(*keys, texts).where(_rejected(F.col("reject"), style))
    counted = found.groupBy(*keys, "column_name", "reject").agg(F.count("*").alias("n_rows"))
    order = Window.partitionBy(*keys, "column_name").orderBy(F.md5("reject"), "reject")
    numbered = counted.withColumn("sample", F.row_number().over(order)).where(F.col("sample") <= k)
    return numbered.select(*keys, "column_name", "sample", "reject", "n_rows")


def money_rejects(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), style: MoneyStyle = BRL
) -> DataFrame:
    """Per column (and key): texts seen, texts that are not blank yet parse to NULL, and the
    smallest and largest such text as samples. One partial aggregate, nothing is collected."""
    aggregates: list[Column] = []
    for i, name in enumerate(columns):
        text = F.col(f"`{name}`")
        bad = _rejected(text, style)
        aggregates += [
            F.count(text).alias(f"seen_{i}"),
            F.count(F.when(bad, 1)).alias(f"bad_{i}"),
            F.min(F.when(bad, text)).alias(f"first_{i}"),
            F.max(F.when(bad, text)).alias(f"last_{i}"),
        ]
    counted = df.groupBy(*keys).agg(*aggregates)
    report = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"seen_{i}").alias("n_texts"),
            F.col(f"bad_{i}").alias("n_rejects"),
            F.col(f"first_{i}").alias("first_reject"),
            F.col(f"last_{i}").alias("last_reject"),
        )
        for i, name in enumerate(columns)
    ])
    return counted.select(*keys, F.inline(report))


def sign_class(amount: Column) -> Column:
    """'neg' below zero, 'pos' otherwise, NULL for NULL."""
    return F.when(amount < 0, "neg").when(amount >= 0, "pos")
