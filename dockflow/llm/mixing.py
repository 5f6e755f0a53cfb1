"""Mixing sources to target weights by hash thresholds.

Every document has a hash that orders its source at random. Sizes are summed by source and hash
bucket, a running sum finds the bucket in which a source's budget ends, and only that bucket is cut
into finer ones. Documents below the threshold are taken; nothing is sorted, and a rerun takes the
same documents. A target above a source's size takes all of it once and, below a nested threshold,
once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.base import written

WORD = r"[^\x20\x09-\x0D]+"
#: Bits per refinement (a source has at most 4096 buckets each time) and refinements at most.
BITS, LEVELS = 12, 5


def n_words(text: Column | str) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def _named(source: Column) -> Column:
    """Source as a join key that is never null."""
    return F.when(source.isNull(), "0").otherwise(F.concat(F.lit("1"), source.cast("string")))


def _prefix(level: int) -> Column:
    return F.shiftrightunsigned("_h", 64 - BITS * level)


def weigh(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Targets per source: rows ``(_s, source_size, target)`` for ``(_s, _name, source_size)``.

    Sources in order of code points, null last, get ``weights`` in turn. All targets together are
    ``share`` of all sizes; none is above ``most`` times its source's size, and what is over goes to
    the others by weight. The level of the shares is found by sums over the sources only.
    """
    spark = sources.sparkSession
    ordered = sources.sort(F.col("_name").asc_nulls_last())
    schema = "_s string, source_size long, rank long"
    ranked = spark.createDataFrame(
        ordered.select("_s", "source_size").rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), schema
    )
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = written(ranked.withColumn("weight", cycle), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    limit, level = most * F.col("source_size"), 0.0
    while True:
        above = F.col("weight") * level > limit
        full, free = ranked.agg(
            F.sum(F.when(above, limit).otherwise(0.0)), F.sum(F.when(~above, F.col("weight")).otherwise(0.0))
        ).first()
        new = (share * total - full) / free if free else level
        if new <= level:
            break
        level = new
    return ranked.select("_s", "source_size", F.least(limit, F.col("weight") * level).alias("target"))


def thresholds(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2,
) -> tuple[DataFrame, DataFrame]:
    """Sizes of the documents, and per source its target and the hash threshold that meets it."""
    slim = written(
        df.select(
            F.col(key).alias("_k"), _named(F.col(source)).alias("_s"), F.col(source).cast("string").alias("_name"),
            n_words(text).alias("size"), _hash(key, text).alias("_h"),
        ),
        "sizes",
    )
    sources = slim.groupBy("_s", "_name").agg(F.sum("size").alias("source_size"))
    targets = weigh(sources, weights, share, most)
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0))
    state = written(
        targets.withColumn("whole", whole).select(
            "*", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
            F.lit(0).cast("long").alias("at"), F.lit(False).alias("take"),
        ),
        "targets",
    )
    order = Window.partitionBy("_s").orderBy("bucket")
    level = 0
    while level < LEVELS:
        level += 1
        inside = slim.join(state.select("_s", "at", "rest"), "_s").where(
            (_prefix(level - 1) == F.col("at")) & (F.col("rest") > 0) if level > 1 else F.col("rest") > 0
        )
        sums = inside.groupBy("_s", "rest", _prefix(level).alias("bucket")).agg(
            F.sum("size").alias("n"), F.count("*").alias("rows")
        )
        running = sums.withColumn("before", F.sum("n").over(order) - F.col("n"))
        # the last bucket that begins below the budget holds its end
        edge = running.where("before < rest").groupBy("_s").agg(
            F.max_by(F.struct("bucket", "before", "n", "rows"), "bucket").alias("e")
        )
        state = written(
            state.join(edge, "_s", "left").select(
                "_s", "source_size", "target", "whole",
                (F.col("rest") - F.coalesce("e.before", F.lit(0))).alias("rest"),
                F.coalesce("e.bucket", F.lit(0)).alias("at"),
                # the boundary bucket itself counts if that comes nearer to the budget
                F.coalesce(F.col("rest") - F.col("e.before") >= F.col("e.n") / 2, F.lit(False)).alias("take"),
                F.coalesce("e.rows", F.lit(0)).alias("rows"),
            ),
            "targets",
        )
        if (state.agg(F.max("rows")).first()[0] or 0) <= 1:
            break
    # where the budget is nil nothing lies below bucket 0
    return slim, state.select("_s", "source_size", "target", "whole", "at", "take", F.lit(level).alias("level"))


def _hash(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


def _copies(level: int) -> Column:
    prefix = _prefix(level)
    below = (prefix < F.col("at")) | ((prefix == F.col("at")) & F.col("take"))
    return (F.col("whole") + F.when(below, 1).otherwise(0)).cast("long")


def mixed(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """One row ``(key, size, source_size, target, copies, taken)`` per document.

    ``copies`` is how often the mix takes the document (0, 1 or more), ``taken`` its words in the
    mix. Null texts have size 0, a null source is a source of its own, the last one. Sources whose
    documents are all empty have target 0. Rows that repeat key and text are taken together.
    """
    slim, bounds = thresholds(df, key, text, source, **how)
    level = _level(bounds)
    out = slim.join(bounds, "_s").withColumn("copies", _copies(level))
    return out.select(
        F.col("_k").alias(key), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def _level(bounds: DataFrame) -> int:
    first = bounds.select("level").first()
    return first[0] if first else 1


def repeated(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, with ``df``'s columns."""
    _, bounds = thresholds(df, key, text, source, **how)
    level = _level(bounds)
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    row = lambda c: F.col(f"_row.`{c}`")
    own = own.withColumns({"_s": _named(row(source)), "_h": F.xxhash64(row(key), row(text))})
    return (
        own.join(bounds, "_s")
        .withColumn("_n", F.explode(F.array_repeat(F.lit(0), _copies(level).cast("int"))))
        .select("_row.*")
    )
