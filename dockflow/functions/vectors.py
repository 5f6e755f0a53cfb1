"""Feature vectors, sequences of vectors, category codes and their JSON form."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow.functions.keys import _col

MATRIX = "array<array<double>>"


def vector(columns: Sequence[str]) -> Column:
    """Ordered columns as one ``array<double>``; the order is the vector layout."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def to_json(matrix: Column | str) -> Column:
    return F.to_json(_col(matrix))


def from_json(text: Column | str) -> Column:
    return F.from_json(_col(text), MATRIX)


def named_json(name: str, value: Column | str) -> Column:
    """``{"name": value}`` as text."""
    return F.to_json(F.struct(_col(value).alias(name)))


def channel(matrix: Column | str, index: int) -> Column:
    """One feature of every step of a sequence (0-based)."""
    return F.transform(_col(matrix), lambda step: step[index])


def channels(matrix: Column | str, first: int, count: int) -> Column:
    """``count`` neighbouring features of every step, starting at ``first`` (0-based)."""
    return F.transform(_col(matrix), lambda step: F.slice(step, first + 1, count))


def fit_length(values: Column | str, size: int, pad: float = 0.0) -> Column:
    """Cut an array to ``size`` or fill it up with ``pad``."""
    return F.slice(F.concat(_col(values), F.array_repeat(F.lit(pad), size)), 1, size)


def ceil_at_zero(values: Column | str) -> Column:
    """Round every element up and replace negatives by zero (``array<bigint>``)."""
    return F.transform(_col(values), lambda x: F.greatest(F.lit(0).cast("bigint"), F.ceil(x)))


def clamp_code(code: Column | str, slots: int) -> Column:
    """Send category codes beyond the last slot to the last slot."""
    return F.least(_col(code).cast("bigint"), F.lit(slots - 1).cast("bigint"))


def is_clamped(code: Column | str, slots: int) -> Column:
    return _col(code).cast("bigint") >= slots


def one_hot(code: Column | str, classes: int) -> Column:
    """``array<double>`` with a single one at the (0-based) code."""
    code = _col(code).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.lit(classes - 1)),
        lambda i: F.when(i == code, F.lit(1.0)).otherwise(F.lit(0.0)),
    )


def position_wave(position: Column | str, index: int, width: int) -> Column:
    """Sine (even ``index``) or cosine (odd) position feature ``index`` of ``width``."""
    rate = math.exp(-(index - index % 2) * math.log(10000.0) / width)
    angle = _col(position).cast("double") * F.lit(rate)
    return F.cos(angle) if index % 2 else F.sin(angle)


def decoder_context(
    matrix: Column | str, known: int, ahead: int, width: int, target: int = 0
) -> Column:
    """Last ``known`` values of one channel, then ``ahead`` zeros, padded to ``width`` channels.

    The target comes first in every step; the other channels are zero.
    """
    matrix = _col(matrix)
    last = F.slice(channel(matrix, target), -known, known)
    values = F.concat(last, F.array_repeat(F.lit(0.0), ahead))
    rest = F.array_repeat(F.lit(0.0), width - 1)
    return F.transform(values, lambda v: F.concat(F.array(v), rest))
