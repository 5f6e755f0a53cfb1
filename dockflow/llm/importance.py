"""Importance resampling towards a target collection, on hashed features.

A document's features are the runs of one to three of its words; each falls into a bucket by its CRC-32.
The buckets' shares in the target against those in the documents give a gain per bucket, a document's
weight is the sum of its features' gains, and Gumbel noise on the weight turns the highest scores into a
draw without replacement.

CRCs are computed on matrices: the distinct features of a chunk of text are grouped by their length in
bytes into two-dimensional uint8 arrays, and all CRCs of an array are updated column by column.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.llm.base import written
from dockflow.operators.numbering import row_numbers

BUCKETS = 10_000
#: Longest run of words that is a feature.
RUN = 3
SEED = 42
#: Bytes of text that are tokenized in one go, and words whose features are hashed in one go.
TEXT_BYTES, CHUNK_WORDS = 1 << 22, 1 << 17
#: Features beyond this many bytes are cut into rows of that many columns.
LONG = 1024

#: Digits, letters (capitals as small ones) and all bytes of non-ASCII characters; the rest is a space.
_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


# ---- CRC-32 of many byte strings -----------------------------------------------------------


def _byte_table() -> np.ndarray:
    """CRC-32 remainders of the 256 bytes, from the polynomial (reflected, a fixed value)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _byte_table()


def _update(crc: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes of their rows, one column of all rows at a time."""
    for column in np.ascontiguousarray(matrix.T):
        crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
    return crc


@lru_cache
def _shift() -> np.ndarray:
    """What LONG zero bytes make of a register, by its four bytes."""
    places = (np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    return _update(places, np.zeros((1024, LONG), np.uint8)).reshape(4, 256)


def _long_crc(data: np.ndarray) -> int:
    """CRC-32 of one long array: rows of LONG bytes side by side, then one row after the other.

    The register is linear in its start and its input, so a row's own register and the shifted one
    of the rows before add up. Zeros in front do not change a register of zero; the usual start value is the same
    as the first four bytes inverted.
    """
    rows = -(-len(data) // LONG)
    block = np.zeros(rows * LONG, np.uint8)
    block[len(block) - len(data) :] = data
    block[len(block) - len(data) :][:4] ^= 0xFF
    own = _update(np.zeros(rows, np.uint32), block.reshape(rows, LONG))
    shift, crc = _shift(), 0
    for r in own.tolist():
        moved = shift[0, crc & 255] ^ shift[1, crc >> 8 & 255] ^ shift[2, crc >> 16 & 255] ^ shift[3, crc >> 24]
        crc = int(moved) ^ r
    return crc ^ 0xFFFFFFFF


def crc32_slices(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start : start + length]`` for every slice, in the order given."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    sizes, first = np.unique(length[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, first[1:])):
        if size > LONG:
            out[rows] = [_long_crc(data[s : s + size]) for s in start[rows].tolist()]
            continue
        matrix = sliding_window_view(data, size)[start[rows]]
        out[rows] = _update(np.full(len(rows), 0xFFFFFFFF, np.uint32), matrix) ^ np.uint32(0xFFFFFFFF)
    return out


# ---- features ------------------------------------------------------------------------------


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Words of the texts as slices: ``(data, start, end, text index, whole)``.

    ``data`` holds the words with one space between them, so a run of words is one slice. A chunk's
    words from ``whole`` on are only there for the runs that begin before.
    """
    raw = np.frombuffer(b"\n".join(texts).translate(_WORD) + b" ", np.uint8)
    is_word = raw != 32
    before = np.r_[False, is_word[:-1]]
    begins = np.flatnonzero(is_word & ~before)
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begins, side="right")
    kept = is_word | before
    data = raw[kept]
    is_word = data != 32
    start = np.flatnonzero(is_word & ~np.r_[False, is_word[:-1]])
    end = np.flatnonzero(~is_word)
    for at in range(0, len(start), CHUNK_WORDS):
        part = slice(at, at + CHUNK_WORDS + RUN - 1)
        yield data, start[part], end[part], owner[part], min(CHUNK_WORDS, len(start) - at)


def feature_buckets(texts: list[bytes], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text index, bucket)`` of all features of the texts, chunk by chunk."""
    for data, start, end, owner, whole in _chunks(texts):
        lo, hi = int(start[0]), int(end[-1])
        first = {}
        words = data[lo:hi].tobytes().split(b" ")
        code = np.fromiter(map(first.setdefault, words, count()), np.int64, len(words))
        n, owners, keys, starts, lengths = len(words), [], [], [], []
        key = np.zeros(n, np.int64)
        for run in range(1, RUN + 1):
            # base len + 1 and codes from 1 on keep runs of different lengths apart
            size = min(whole, n - run + 1)
            if size <= 0:
                break
            key = key[:size] * (n + 1) + code[run - 1 : run - 1 + size] + 1
            same = owner[:size] == owner[run - 1 : run - 1 + size]
            owners.append(owner[:size][same])
            keys.append(key[same])
            starts.append(start[:size][same])
            lengths.append((end[run - 1 : run - 1 + size] - start[:size])[same])
        _, at, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        crc = crc32_slices(data, np.concatenate(starts)[at], np.concatenate(lengths)[at])
        yield np.concatenate(owners), (crc % np.uint32(buckets)).astype(np.int64)[back]


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, list[bytes]]]:
    """``(first row, texts)`` of a batch in parts of about TEXT_BYTES; null texts are empty."""
    part, at, size = [], 0, 0
    for i, t in enumerate(batch.column(name).cast(pa.large_binary())):
        part.append(t.as_py() or b"")
        size += len(part[-1])
        if size >= TEXT_BYTES:
            yield at, part
            part, at, size = [], i + 1, 0
    if part:
        yield at, part


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Features per bucket, rows ``(bucket, n)``; every task sums its texts before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in _texts(batch, "_t"):
                for _, bucket in feature_buckets(part, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.select(F.col(f"`{text}`").alias("_t")).mapInArrow(counted, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths of a nat: its share of the target against that of the documents.

    One is added to every count. The result has ``buckets`` numbers, whatever the data.
    """
    source = bucket_counts(documents, text, buckets).withColumnRenamed("n", "s")
    wanted = bucket_counts(target, text, buckets).withColumnRenamed("n", "t")
    both = written(source.join(wanted, "bucket", "full").na.fill(0), "counts")
    sums = both.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    s, t = (F.lit(n).cast("long") + buckets for n in sums)
    all_buckets = both.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    ratio = ((F.col("t") + 1) * s).cast("double") / ((F.col("s") + 1) * t).cast("double")
    gain = F.floor(F.log(ratio) * 1000).alias("gain")
    rows = all_buckets.join(both, "bucket", "left").na.fill(0).select("bucket", gain)
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():
        out[r["bucket"]] = r["gain"]
    return out


def with_weights(df: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """Columns of ``df`` but ``text``, and ``n_words``, ``n_features`` and ``weight`` (sum of gains)."""
    kept = [c for c in df.columns if c != text]
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{text}`").alias("_t"))
    sums = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]
    schema = T.StructType([packed.schema["_row"], *sums])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, features = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for at, part in _texts(batch, "_t"):
                n = len(part)
                for owner, bucket in feature_buckets(part, len(gain)):
                    features[at : at + n] += np.bincount(owner, minlength=n)
                    np.add.at(weight, at + owner, gain[bucket])
            # one word gives one feature, every further number w of words 3 w - 3
            words = np.where(features > 0, (features + 3) // 3, 0)
            arrays = [batch.column("_row"), pa.array(words), pa.array(features), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(arrays, ["_row", "n_words", "n_features", "weight"])

    return packed.mapInArrow(weigh, schema).select("_row.*", "n_words", "n_features", "weight")


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the SHA-256 of ``seed:key``; a null key counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    documents: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 5,
    least_words: int = 20,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row ``(key, n_features, weight, score, rank)`` per document; ``rank`` is null if it is not drawn.

    Drawn are ``percent`` per cent of the documents with ``least_words`` words or more, by descending score,
    ties to the smaller key (a null key last, repeated rows in any order). Null and empty texts have no feature
    and weight 0. Without documents the result is empty, without a target all shares of it count as equal.
    The texts are read twice and never shuffled; ranks come from ranges of the scores.
    """
    slim = documents.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    gain = gains(slim, target.select(F.col(f"`{text}`").alias("_text")), "_text", buckets)
    scored = with_weights(slim, gain, "_text").withColumn("score", F.col("weight") + noise(F.col("_key"), seed))
    scored = written(scored.withColumn("_fit", (F.col("n_words") >= least_words).cast("int")), "scores")
    drawn = scored.where("_fit = 1").count() * percent // 100
    order = [F.desc("_fit"), F.desc("score"), F.asc_nulls_last("_key")]
    place = F.when((F.col("_fit") == 1) & (F.col("_place") <= drawn), F.col("_place"))
    ranked = row_numbers(scored, order, "_place")
    return ranked.select(F.col("_key").alias(key), "n_features", "weight", "score", place.alias("rank"))
