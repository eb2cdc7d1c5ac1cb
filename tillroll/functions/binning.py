"""Binning of numeric columns into labelled intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def right_closed_bins(col, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the interval ``(edge, next edge]``; NULL outside all intervals.

    Spark's own Bucketizer closes intervals on the left, so it cannot stand in here.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    value = _double(col)
    chain = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > F.lit(float(low))) & (value <= F.lit(float(high)))
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def quantile_bins(col, cuts: Sequence[float], labels: Sequence) -> Column:
    """Label of the quantile bin, given the inner cut points; the lowest value is included.

    Equal cut points make empty bins: a value then gets the lowest bin that holds it.
    """
    if len(cuts) != len(labels) - 1:
        raise ValueError("need one cut less than labels")
    value = _double(col)
    chain = F.when(value.isNull(), F.lit(None))
    for cut, label in zip(cuts, labels):
        chain = chain.when(value <= F.lit(float(cut)), label)
    return chain.otherwise(labels[-1])


def equal_width_bin(col, low, high, bins: int) -> Column:
    """1-based bin of ``bins`` equal intervals over [low, high]; the last one is closed."""
    value, low, high = _double(col), _double(low), _double(high)
    position = F.floor((value - low) / F.nullif(high - low, F.lit(0.0)) * bins) + 1
    return F.when(value.isNull(), None).otherwise(
        F.least(F.coalesce(position, F.lit(1)), F.lit(bins))
    ).cast("int")


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The label of the first rule that holds."""
    chain = None
    for condition, label in rules:
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return chain.otherwise(otherwise) if otherwise is not None else chain


def _double(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")
