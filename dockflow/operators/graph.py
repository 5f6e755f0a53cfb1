"""Weighted neighbour sums over k hops and row-wise softmax of edge logits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.sources.scratch import bucketed, staged

#: Edges of one source that meet its values in one group; a source with more is cut into parts.
EDGES_PER_PART = 100_000


def prepare_edges(edges: DataFrame, edges_per_part: int = EDGES_PER_PART) -> tuple[DataFrame, DataFrame]:
    """Edges ``(src, part, dst, weight)`` in buckets of (src, part), and the sources of several parts.

    The number of a source's parts follows from its degree, which is counted before anything is shuffled by
    source; the table ``(src, parts)`` has a row per ``edges_per_part`` edges at most. Both are written once and read
    by every hop.
    """
    degrees = edges.groupBy("src").agg(F.ceil(F.count("*") / edges_per_part).cast("int").alias("parts"))
    hubs = staged(degrees.filter("parts > 1"), "hubs")
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    cut = edges.join(hubs, "src", "left").select("src", part, "dst", "weight")
    return bucketed(cut, "edges", ["src", "part"]), hubs


def hop(
    values: DataFrame, edges: tuple[DataFrame, DataFrame], node: str, time: str, value: str
) -> DataFrame:
    """``out(dst, t) = sum over src of weight(src, dst) * value(src, t)`` with :func:`prepare_edges`'s edges.

    The values of a source go to each of its parts, its edges stay where they lie; products are summed
    before they are shuffled by target and time.
    """
    cut, hubs = edges
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    spread = values.select(F.col(node).alias("src"), F.col(time).alias("_t"), F.col(value).alias("_v"))
    spread = spread.join(hubs, "src", "left").select("src", parts, "_t", "_v")
    # dealt as the edges lie, whichever join is chosen; few values may meet very many edges
    spread = spread.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), "src", "part")
    return (
        cut.join(spread, ["src", "part"])
        .groupBy(F.col("dst").alias(node), F.col("_t").alias(time))
        .agg(F.sum(F.col("weight") * F.col("_v")).alias(value))
    )


def khop(
    values: DataFrame,
    supports: Sequence[DataFrame],
    node: str,
    time: str,
    value: str,
    hops: int = 2,
    edges_per_part: int = EDGES_PER_PART,
) -> DataFrame:
    """Values next to their 1..``hops`` hop sums for every edge set, zero where nothing arrives.

    Every hop is written and read by the next; at the end all of them meet the values in one shuffle.
    Rows of ``values`` are unique by node and time.
    """
    own = staged(values.select(node, time, F.col(value).cast("double").alias(value)), "values")
    found = {}
    for s, support in enumerate(supports):
        edges = prepare_edges(support, edges_per_part)
        current = own
        for k in range(1, hops + 1):
            current = staged(hop(current, edges, node, time, value), "hop")
            found[f"{value}_hop{k}" if len(supports) == 1 else f"{value}_hop{k}_s{s}"] = current
    names = [value, *found]
    tagged = [df.select(node, time, F.lit(n).alias("_name"), value) for n, df in zip(names, [own, *found.values()])]
    stacked = reduce(DataFrame.unionByName, tagged)
    of = lambda n: F.max(F.when(F.col("_name") == n, F.col(value)))
    given = F.count_if(F.col("_name") == value).alias("_given")
    sums = [of(n).alias(n) if n == value else F.coalesce(of(n), F.lit(0.0)).alias(n) for n in names]
    return stacked.groupBy(node, time).agg(given, *sums).filter("_given > 0").drop("_given")


def edge_softmax(
    edges: DataFrame,
    logit: str,
    by: Sequence[str] = (),
    shift: str = "dst",
    name: str = "attention",
) -> DataFrame:
    """Softmax of edge logits over the targets of every source.

    The largest logit of the column ``shift`` is subtracted first. Shifting by ``src`` leaves
    the softmax as it is; shifting by ``dst`` (the default) weighs the targets differently.
    """
    largest = F.max(logit).over(W.partitionBy(*by, shift))
    power = F.exp(F.col(logit) - F.col("_largest"))
    total = F.sum("_power").over(W.partitionBy(*by, "src"))
    return (
        edges.withColumn("_largest", largest)
        .withColumn("_power", power)
        .withColumn(name, F.col("_power") / total)
        .drop("_largest", "_power")
    )
