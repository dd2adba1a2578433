"""Label and HTML text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_key(label: Column) -> Column:
    """Form in which labels, kinds and codes are compared, grouped and shown: upper case,
    no trailing spaces, accents kept."""
    return F.upper(F.rtrim(label))


def escape_html(text: Column) -> Column:
    escaped = F.replace(text, F.lit("&"), F.lit("&amp;"))
    escaped = F.replace(escaped, F.lit("<"), F.lit("&lt;"))
    return F.replace(escaped, F.lit(">"), F.lit("&gt;"))


def html_row(cells: list[Column]) -> Column:
    """One table row of cells that are HTML already; a missing cell is empty."""
    inner = F.concat_ws("</td><td>", *[F.coalesce(cell, F.lit("")) for cell in cells])
    return F.concat(F.lit("<tr><td>"), inner, F.lit("</td></tr>"))


def sql_text(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(name: str) -> str:
    """A column name in SQL."""
    return "`" + name.replace("`", "``") + "`"
