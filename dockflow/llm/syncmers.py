"""Document fingerprints from closed syncmers over words.

A text becomes a row of tokens; every run of ``k`` tokens holds ``k - s + 1`` shorter runs of ``s``
tokens, and it is an anchor if the smallest hash among these is that of the first or of the last.
Whether a run is an anchor depends on the run alone, so equal passages have equal anchors wherever
they stand. Everything here is Spark SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of ideographs and kana, which are tokens one by one.
SINGLE = r"\x{2e80}-\x{2fdf}\x{3005}-\x{30ff}\x{3400}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}"
#: Tokens: up to eight letters or digits from the start of a word, or one of the above.
TOKEN = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{SINGLE}]]{{1,8}}|[{SINGLE}]"
K, S = 8, 2


def token_hashes(text: Column) -> Column:
    """Hash of every token of ``text`` (null or blank: none); a text of other signs only is one token."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0))
    # inside an array of one, so that the tokens are extracted once
    found = F.transform(F.array(found), lambda f: F.when((F.size(f) > 0) | (~F.rlike(low, F.lit(r"\S"))), f).otherwise(F.array(low)))
    return F.transform(F.get(found, F.lit(0)), lambda t: F.xxhash64(t))


def _shifted(c: Column, by: int, n: Column) -> Column:
    return F.slice(c, by + 1, n)


def with_minima(df: DataFrame, runs: str, width: int, out: str) -> DataFrame:
    """``df`` with the minimum of every ``width`` neighbours in ``runs``, by doubling.

    Each step is a column of its own: as one nested expression every step would evaluate the one before twice.
    """
    df, span = df.withColumn(out, F.col(runs)), 1
    while span < width:
        step = min(span, width - span)
        rest = F.greatest(F.size(out) - step, F.lit(0))
        low = F.zip_with(F.slice(out, 1, rest), _shifted(F.col(out), step, rest), lambda a, b: F.least(a, b))
        df = df.withColumn(out, low)
        span += step
    return df


def anchors(df: DataFrame, hashes: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """``df`` with the anchors of the token hashes: array of ``(position, hash)``, in text order.

    A text of fewer than ``k`` tokens, or none of whose runs is an anchor, has one anchor, all its
    tokens; one without tokens has none.
    """
    if s != 2:
        raise ValueError("inner runs are pairs of tokens")
    n = F.size(hashes)
    runs = F.zip_with(
        F.slice(hashes, 1, F.greatest(n - 1, F.lit(0))), F.slice(hashes, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b),
    )
    width = k - s + 1
    df = df.withColumn("__llm_runs", runs)
    df = with_minima(df, "__llm_runs", width, "__llm_low")
    at_edge = F.zip_with(
        "__llm_low", F.zip_with(F.slice("__llm_runs", 1, F.size("__llm_low")), F.slice("__llm_runs", width, F.size("__llm_low")), lambda a, b: F.least(a, b)),
        lambda low, edge: edge == low,
    )
    places = F.filter(F.transform(at_edge, lambda hit, i: F.when(hit, i)), lambda i: i.isNotNull())
    found = F.transform(places, lambda i: F.struct(i.alias("position"), F.xxhash64(F.slice(hashes, i + 1, k)).alias("hash")))
    one = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(F.col(hashes)).alias("hash")))
    none = F.array().cast("array<struct<position:int,hash:bigint>>")
    df = df.withColumn(out, found).withColumn(out, F.when(F.size(out) > 0, F.col(out)).when(n > 0, one).otherwise(none))
    return df.drop("__llm_runs", "__llm_low")


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors over all anchors of two fingerprints (arrays of hashes); two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(either == 0, 1.0).otherwise(both / F.greatest(either, F.lit(1)))


def matches(left: DataFrame, right: DataFrame, anchors: str = "anchors") -> DataFrame:
    """Positional matches ``(left row, right row, position, other)`` of two frames with anchors.

    Frames hold ``id`` and the anchors; one row per pair of places with the same anchor.
    """
    a = left.select(F.col("id").alias("left"), F.inline(anchors)).withColumnRenamed("position", "at_left")
    b = right.select(F.col("id").alias("right"), F.inline(anchors)).withColumnRenamed("position", "at_right")
    return a.join(b, "hash").select("left", "right", "at_left", "at_right")


def shown(hashes: Column) -> Column:
    """Fingerprint as text: eight hexadecimal digits per anchor, in text order."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(F.shiftrightunsigned(h, 32)), 8, "0"))), "")


def with_next(df: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    """``df`` (of ``key`` and ``columns``) with ``next_<column>`` of the row that follows by key.

    After the last row comes the first. Rows are dealt to ranges of the key; the first row of each
    range is also dealt to the range before, so that no row needs another range. Null keys come
    first; rows with equal keys follow each other in order of the columns.
    """
    share = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(key, share, 100 * buckets)).first()[0] if buckets > 1 else []
    bounds = sorted(set(bounds or []))
    own = F.lit(0)
    if bounds:
        at = F.array(*map(F.lit, bounds))
        own = F.coalesce(F.size(F.filter(at, lambda b: b < F.col(key))), F.lit(0))
    dealt = df.withColumn("__llm_range", own)
    heads = dealt.groupBy("__llm_range").agg(F.min(F.struct(F.coalesce(F.col(key), F.lit(-(2**63))).alias("k"))).alias("h"))
    heads = {r["__llm_range"]: r["h"]["k"] for r in heads.collect()}  # one row per range
    order = sorted(heads)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    if not order:
        return dealt.drop("__llm_range").withColumns({f"next_{c}": F.col(c) for c in columns})
    least = F.create_map(*[F.lit(x).cast("bigint") for b in order for x in (b, heads[b])])
    prior = F.create_map(*[F.lit(x).cast("bigint") for b in order for x in (b, before[b])])
    is_head = F.coalesce(F.col(key), F.lit(-(2**63))) == least[F.col("__llm_range").cast("bigint")]
    previous = prior[F.col("__llm_range").cast("bigint")].cast("int")
    places = F.when(is_head, F.array(
        F.struct(F.col("__llm_range").alias("__llm_b"), F.lit(False).alias("__llm_copy")), F.struct(previous.alias("__llm_b"), F.lit(True).alias("__llm_copy"))
    )).otherwise(F.array(F.struct(F.col("__llm_range").alias("__llm_b"), F.lit(False).alias("__llm_copy"))))
    spread = dealt.withColumn("__llm_place", F.explode(places)).select("*", "__llm_place.*").drop("__llm_place", "__llm_range")
    follow = Window.partitionBy("__llm_b").orderBy("__llm_copy", F.col(key).asc_nulls_first(), *columns)
    return (
        spread.withColumns({f"next_{c}": F.lead(c).over(follow) for c in columns})
        .where("not __llm_copy").drop("__llm_b", "__llm_copy")
    )
