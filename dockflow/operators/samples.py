"""Training samples cut from packed sequences, and their splits.

A packed sequence holds one entry per step of the range, so its size is bounded by the range
and not by the number of rides. Samples are slices of it, generated row by row without a
shuffle; only the slices leave the row, not copies of the sequence.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions import vectors as V
from dockflow.operators import numbering
from dockflow.operators.sequences import pack_sequences

# fixed values: day ranges (first, end) of the splits
OPEN_SPLITS = {"train": (0, 76), "val": (76, 107), "test": (107, 138)}
OVERLAP_HOURLY_SPLITS = {"train": (0, 35), "val": (17, 38), "test": (21, 42)}
OVERLAP_DAILY_SPLITS = {"train": (0, 18), "val": (18, 22), "test": (22, 26)}


def _exploded(df: DataFrame, count: Column, name: str) -> DataFrame:
    """One row per index 0..count-1; rows with no index fall out."""
    indices = F.sequence(F.lit(0), (count - 1).cast("int"))
    return df.filter(count > 0).select("*", F.explode(indices).alias(name))


def daily_samples(
    sequences: DataFrame,
    seq_days: int,
    targets: Mapping[str, int],
    gap_days: int = 0,
    reserve_days: int = 3,
    horizon: int = 24,
    per_day: int = 24,
    features: str = "features",
    static: str | None = None,
    width: int | None = None,
) -> DataFrame:
    """One sample per start day: ``x`` of ``seq_days`` days and one target array per horizon.

    The target starts ``gap_days`` after the input ends (3 where truth is known late, 0
    otherwise). A sequence of D days gives ``D - (seq_days + reserve_days)`` samples in both
    cases. With ``static`` the daily row of the sample's index goes along; with ``width`` only
    the first features enter ``x``.
    """
    count = _sample_count(features, seq_days + reserve_days, per_day)

    def sample(i: Column) -> Column:
        x = F.slice(features, i * per_day + 1, seq_days * per_day)
        fields = [i.alias("sample_idx"), (x if width is None else V.channels(x, 0, width)).alias("x")]
        label_start = (i + seq_days + gap_days) * per_day + 1
        for name, index in targets.items():
            fields.append(V.channel(F.slice(features, label_start, horizon), index).alias(name))
        if static is not None:
            fields.append(F.get(static, i).alias("static"))
        return F.struct(*fields)

    others = [c for c in sequences.columns if c not in (features, static)]
    indices = F.sequence(F.lit(0), count - 1)
    return sequences.filter(count > 0).select(*others, F.inline(F.transform(indices, sample)))


def _sample_count(features: str, days_used: int, per_day: int) -> Column:
    return (F.floor(F.size(features) / per_day) - days_used).cast("int")


def sample_counts(
    steps: DataFrame, site: str, seq_days: int, reserve_days: int = 3, per_day: int = 24
) -> DataFrame:
    """Number ``samples`` of :func:`daily_samples` per site, from counts of its steps; no sequence is packed."""
    n = F.floor(F.count("*") / per_day) - (seq_days + reserve_days)
    return steps.groupBy(site).agg(n.cast("int").alias("samples")).filter("samples > 0")


def packed_counts(
    sequences: DataFrame, site: str, seq_days: int, reserve_days: int = 3, per_day: int = 24, features: str = "features"
) -> DataFrame:
    """The same from sequences that are packed already."""
    n = _sample_count(features, seq_days + reserve_days, per_day)
    return sequences.select(site, n.alias("samples")).filter("samples > 0")


def sample_keys(counts: DataFrame) -> DataFrame:
    """The keys and indices of :func:`daily_samples` from the table of counts, without their slices."""
    return _exploded(counts, F.col("samples"), "sample_idx").drop("samples")


def split_days(
    sequences: DataFrame,
    splits: Mapping[str, tuple[int, int]],
    per_day: int = 24,
    features: str = "features",
    static: str | None = None,
    static_splits: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """One row per split with the sequence of its day range; ranges may overlap."""
    others = [c for c in sequences.columns if c not in (features, static)]

    def part(name: str) -> Column:
        first, end = splits[name]
        fields = [
            F.lit(name).alias("split"),
            F.slice(features, first * per_day + 1, (end - first) * per_day).alias(features),
        ]
        if static is not None:
            s_first, s_end = (static_splits or splits)[name]
            fields.append(F.slice(static, s_first + 1, s_end - s_first).alias(static))
        return F.struct(*fields)

    return sequences.select(*others, F.inline(F.array(*[part(n) for n in splits])))


def sliding_windows(
    steps: DataFrame,
    node: str,
    time: str,
    features: Sequence[str],
    past: int,
    future: int,
    y_start: int = 1,
) -> DataFrame:
    """Stride-1 windows of a dense panel: one row per (node, sample).

    ``x`` holds steps t-past+1..t and ``y`` steps t+y_start..t+future, both with all features;
    t runs over the steps where both are complete. ``samples`` is their number per node.
    """
    packed = pack_sequences(steps, [node], time, features, name="_steps_of_node")
    count = F.size("_steps_of_node") - future - (past - 1)
    rows = _exploded(packed, count, "sample_idx")
    t = F.col("sample_idx") + past - 1
    return rows.select(
        node,
        "sample_idx",
        count.alias("samples"),
        F.slice("_steps_of_node", F.col("sample_idx") + 1, past).alias("x"),
        F.slice("_steps_of_node", t + y_start + 1, future - y_start + 1).alias("y"),
    )


def window_offsets(past: int, future: int, y_start: int = 1) -> tuple[list[int], list[int]]:
    """Step offsets of ``x`` and ``y`` relative to the last observed step."""
    return list(range(-(past - 1), 1)), list(range(y_start, future + 1))


def ratio_split(
    df: DataFrame,
    train: float = 0.6,
    test: float = 0.2,
    index: str = "sample_idx",
    total: str | Column = "samples",
) -> DataFrame:
    """Split in time order: first ``round(n * train)``, last ``round(n * test)``, rest between.

    Rounding is half to even. No test rows if their number rounds to zero.
    """
    n = F.col(total) if isinstance(total, str) else total
    n_train = F.bround(n * F.lit(float(train)), 0)
    n_test = F.bround(n * F.lit(float(test)), 0)
    i = F.col(index)
    name = F.when(i < n_train, "train").when(i >= n - n_test, "test").otherwise("val")
    return df.withColumn("split", name)


def sample_rows(counts: DataFrame, site: str, name: str = "row_id") -> tuple[DataFrame, Column]:
    """Row id of every sample in (site, index) order, and their number.

    Both come from running sums of the sites' sample counts; n may differ from site to site.
    """
    before = numbering.running_totals(counts, [site], "samples", "_before")
    rows = _exploded(before, F.col("samples"), "sample_idx")
    total = before.agg(F.max(F.col("_before") + F.col("samples"))).scalar()
    return rows.withColumn(name, F.col("_before") + F.col("sample_idx") + 1).drop("_before", "samples"), total
