"""SimHash near-duplicates with Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into four segments of 16. Of three differing bits at least one
segment is free, so it is matched as it is; the other 48 bits hold two strings of 23 bits, and one
of them differs in at most one bit. That string is decoded with the perfect binary Golay code: its
keys are the indices of all codewords within distance 4 (six of them, or one if the nearest is
within 2), and any two strings at distance 2 or less share a codeword. Fingerprints that share a
free segment and a codeword index are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import LOWER, UPPER, components, number_batches, text_batches, written

#: Generator polynomial of the binary Golay code of length 23 and dimension 12 (fixed value).
GOLAY = 0b110001110101
SEED = 42
#: Fingerprints of one key that are compared in one go; a larger bucket is cut into blocks.
BLOCK = 1024

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


# ---- fingerprints --------------------------------------------------------------------------


def fingerprint(text: str | None, width: int = 3) -> int:
    """Fingerprint of one text as a signed long: bit by bit the majority over its shingles' XXH64.

    Texts with fewer than ``width`` words are one shingle; a null or blank text has fingerprint 0.
    """
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) > width:
        columns = [words[i : len(words) - width + 1 + i] for i in range(width)]
        shingles = map(b" ".join, zip(*columns))
    else:
        shingles = [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def with_fingerprints(df: DataFrame, text: str = "text", width: int = 3, name: str = "fp") -> DataFrame:
    """``df`` with the fingerprint of ``text`` as a long column."""
    text_batches(df.sparkSession)

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, width) for t in batch], dtype="int64")

    return df.withColumn(name, of(F.col(text)))


def hex_digits(c: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


# ---- Golay keys ----------------------------------------------------------------------------


def _remainder(v: np.ndarray) -> np.ndarray:
    v = v.copy()
    for bit in range(22, 10, -1):
        v ^= np.where(v >> bit & 1, GOLAY << (bit - 11), 0)
    return v


@lru_cache
def coset_patterns() -> np.ndarray:
    """Per syndrome the error patterns of weight 4 or less, six of them; short rows repeat the first."""
    table = [[] for _ in range(2048)]
    for weight in range(5):
        patterns = np.array([sum(1 << i for i in c) for c in combinations(range(23), weight)], dtype=np.int64)
        for pattern, syndrome in zip(patterns.tolist(), _remainder(patterns).tolist()):
            table[syndrome].append(pattern)
    return np.array([x + x[:1] * (6 - len(x)) for x in table], dtype=np.int64)


@lru_cache
def _high_syndromes() -> np.ndarray:
    return _remainder(np.arange(4096, dtype=np.int64) << 11)


def golay_indices(v: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords within distance 4 of 23-bit strings, six columns."""
    syndromes = _high_syndromes()[v >> 11] ^ (v & 2047)
    return (v[:, None] ^ coset_patterns()[syndromes]) >> 11


def fuzzy_keys(fp: np.ndarray) -> np.ndarray:
    """Keys of fingerprints (uint64), 48 columns; -1 where a key repeats another of its row."""
    segments = [(fp >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    out = []
    for free in range(4):
        a, b, c = (segments[i] for i in range(4) if i != free)
        rest = a | b << 16 | c << 32
        for half in range(2):
            indices = golay_indices(rest >> 23 * half & 0x7FFFFF)
            keys = (2 * free + half) << 28 | segments[free][:, None] << 12 | indices
            keys[:, 1:][indices[:, 1:] == indices[:, :1]] = -1
            out.append(keys)
    return np.concatenate(out, axis=1)


# ---- links ---------------------------------------------------------------------------------


def _star(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every fingerprint to the first one of its component, within one run."""
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= bits
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label[None, :], len(fp)).min(1)
        new = new[new]
        if (new == label).all():
            return fp, fp[label]
        label = new


def _run_edges(key: np.ndarray, fp: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(fp)])
    small = np.repeat(sizes <= 8, sizes)
    run = np.repeat(np.arange(len(starts)), sizes)
    for step in range(1, 8):
        at = np.flatnonzero((run[step:] == run[:-step]) & small[step:])
        at = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= bits]
        if len(at):
            yield fp[at], fp[at + step]
    for i in np.flatnonzero(sizes > 8):
        yield _star(np.unique(fp[starts[i] : starts[i] + sizes[i]]), bits)


def fuzzy_links(prints: DataFrame, bits: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges ``(u, v)`` that connect distinct fingerprints ``fp`` within ``bits``.

    The keys are complete for 3 bits; of pairs that differ in more, those that share a key are
    found as well (about 85, 77 and 45 % at 4, 5 and 6 bits). Every pair in reach is connected by edges, mostly not directly: a bucket gives each member's
    edge to one member of its component, not all pairs. A bucket of more than ``block``
    fingerprints is cut into blocks by hash, and every two blocks are compared in a group of their
    own, so that no task holds more than two blocks and nothing is left out.
    """
    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 4096):
                fp = frame["fp"].to_numpy()[at : at + 4096]
                keys = fuzzy_keys(fp.view(np.uint64))
                good = keys >= 0
                yield pd.DataFrame({"key": keys[good], "fp": np.repeat(fp, good.sum(1))})

    rows = prints.select("fp").mapInPandas(keyed, "key long, fp long")
    heavy = written(
        rows.groupBy("key").count().where(F.col("count") > block)
        .select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")),
        "heavy",
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    dealt = (
        rows.join(heavy, "key", "left")
        .select("key", "fp", F.explode(F.when(F.col("blocks").isNull(), one).otherwise(pairs)).alias("pair"))
        .select("key", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "fp")
    )

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = pd.DataFrame({"key": [], "i": [], "j": [], "fp": []}, dtype="int64")
        for frame in _and_end(frames):
            if frame is not None:
                rest = pd.concat([rest, frame], ignore_index=True)
            key = rest[["key", "i", "j"]].to_numpy()
            if frame is None or not len(key):
                whole = len(key)
            else:  # the last run may go on in the next batch
                whole = int(np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])[-1])
            if whole:
                fp = rest["fp"].to_numpy()[:whole].astype(np.int64).view(np.uint64)
                for u, v in _run_edges(key[:whole], fp, bits):
                    yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})
                rest = rest.iloc[whole:]

    return (
        dealt.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "fp")
        .mapInPandas(compare, "u long, v long")
        .where("u != v")
    )


def _and_end(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from frames
    yield None


def _named(classes: DataFrame, bits: int) -> DataFrame:
    """``(fp, root, component_id)`` of classes ``(fp, least)``: root fingerprint and smallest key."""
    spark = classes.sparkSession
    number_batches(spark)
    nodes = written(components(fuzzy_links(classes, bits)), "nodes")
    text_batches(spark)
    rooted = classes.join(nodes, classes.fp == nodes.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    roots = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    return written(rooted.join(roots, "root").select("fp", "root", "component_id"), "named")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, bits: int = 3
) -> DataFrame:
    """One row ``(key, fp, component_id)`` per row of ``df``.

    Rows are linked if their fingerprints differ in ``bits`` or fewer bits; ``component_id`` is the
    smallest key of all rows that links reach. Equal fingerprints form one class before anything
    is compared, so copies cost one comparison however many there are. Null texts count as empty;
    rows with a null key get a component like any other but never name one, unless all its keys
    are null. Repeated rows stay repeated.
    """
    plain = df.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t"))
    prints = written(with_fingerprints(plain, "_t", width).select("_k", "fp"), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("_k").alias("least")), "classes")
    return prints.join(_named(classes, bits), "fp").select(F.col("_k").alias(key), "fp", "component_id")


def without_copies(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, bits: int = 3
) -> DataFrame:
    """The rows of ``df`` of which one per component stays: that with the smallest key.

    If several rows have that key one of them stays; rows with a null key stay (one of them) only
    where their component has no other key. Who stays is found on keys and fingerprints; the rows meet the
    keys that stay once, by a broadcast of those if they are few. Only rows whose key others share are
    fingerprinted again and compared.
    """
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    row = row.select("_row", F.col(f"_row.`{key}`").alias("_k"), F.col(f"_row.`{text}`").alias("_t"))
    prints = written(with_fingerprints(row.select("_k", "_t"), "_t", width).select("_k", "fp"), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("_k").alias("least")), "classes")
    first = prints.join(_named(classes, bits), "fp").where(F.col("_k").eqNullSafe(F.col("component_id")))
    first = first.groupBy("root").agg(F.min("_k").alias("_k1"), F.min("fp").alias("_fp"))
    shared = prints.groupBy("_k").agg((F.count("*") > 1).alias("_shared")).withColumnRenamed("_k", "_k2")
    first = first.join(shared, F.col("_k1").eqNullSafe(F.col("_k2"))).select("root", "_k1", "_fp", "_shared")
    first = written(first, "first")
    alone = row.join(first.where("not _shared"), F.col("_k").eqNullSafe(F.col("_k1")), "left_semi").select("_row.*")
    several = first.where("_shared")
    if several.isEmpty():
        return alone
    again = row.join(several.select("_k1").distinct(), F.col("_k").eqNullSafe(F.col("_k1")), "left_semi")
    again = with_fingerprints(again, "_t", width).join(several, F.col("_k").eqNullSafe(F.col("_k1")) & (F.col("fp") == F.col("_fp")))
    return alone.union(again.dropDuplicates(["root"]).select("_row.*"))
