"""List text to rows and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import elements


def tokenize_list(df: DataFrame, text: str, name: str) -> DataFrame:
    """One row per element of the comma list; an empty list gives no row."""
    return df.withColumn(name, F.explode(elements(F.col(text))))


def render_list(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    text: str,
    name: str,
    sep: str = ", ",
    block: str | None = None,
) -> DataFrame:
    """Join the texts of each key in the given order.

    With `block`, a coarse prefix of the order, each block is joined first, so a
    key with very many rows is assembled from pieces made in different tasks.
    """
    if block is not None:
        parts = render_list(df, [*keys, block], order, text, name, sep)
        return render_list(parts, keys, [block], name, name, sep)
    by = ", ".join(f"`{c}`" for c in order)
    joined = F.expr(f"listagg(`{text}`, '{sep}') WITHIN GROUP (ORDER BY {by})")
    return df.groupBy(*keys).agg(joined.alias(name))
