"""Byte-level BPE: every distinct word of the corpus is encoded once.

Texts are read in blocks of some 24 million characters. A block is written as one dictionary of
its distinct pre-tokens and, per position, the dictionary number of the pre-token there. Only the
dictionaries are shuffled by word; each word is encoded where its entries meet, and the ids go back
to the blocks, where they are put in place by position. Both shuffles carry a word once per block,
not once per occurrence, and hold entries of many words in one compressed row.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.llm.base import bucketed, text_batches

BLOCK_CHARS = 24_000_000
_CACHE: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: base64 text, a blank and the id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def splitter(pattern: str):
    """Compiled pattern. White space means Unicode's property, as in the library whose ids are matched."""
    import regex

    spaced = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
    return regex.compile(spaced.replace(r"\S", r"\P{White_Space}"))


def _encoder(ranks: dict[bytes, int], pattern: str):
    """One encoder per Python worker."""
    key = (len(ranks), pattern)
    if key not in _CACHE:
        import tiktoken

        _CACHE[key] = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _CACHE[key]


def _packed(numbers: np.ndarray) -> bytes:
    """Compressed unsigned integers, byte plane by byte plane."""
    return zlib.compress(np.ascontiguousarray(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.uint32)


def _blocks(key: list[str], text: str, pattern: str, chars: int, buckets: int, schema: T.StructType) -> Callable:
    """Arrow batches of documents and of their blocks' dictionaries.

    A document's row has its ``place`` in the block and its number ``n`` of pre-tokens; the first
    row of each batch has the batch's dictionary numbers (``codes``), frequent words first. The
    dictionary has a row per ``bucket`` of word hashes.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        find = splitter(pattern).findall
        block, words, held, size = TaskContext.get().partitionId() << 24, {}, [], 0

        def rows(n: int, columns: dict):
            columns["block"] = pa.array(np.full(n, block))
            return pa.RecordBatch.from_arrays(
                [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in target], schema=target
            )

        def flush() -> Iterator:
            flat = np.concatenate([np.zeros(0, np.uint32), *(c for _, codes in held for c in codes)])
            frequent = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            number = np.empty(len(words), np.uint32)
            number[frequent] = np.arange(len(words), dtype=np.uint32)
            place = 0
            for part, codes in held:
                n = len(codes)
                packed = _packed(number[np.concatenate(codes)])
                yield rows(n, {c: part.column(c) for c in key} | {
                    "place": pa.array(np.arange(place, place + n)), "n": pa.array([len(c) for c in codes]),
                    "codes": pa.array([packed] + [None] * (n - 1), pa.binary()),
                })
                place += n
            raws = [word.encode() for word in words]
            of = np.fromiter((zlib.crc32(raw) % buckets for raw in raws), np.int32, len(raws))
            order = np.argsort(of, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(raws) else []:
                entries = sorted(own.tolist(), key=raws.__getitem__)
                yield rows(1, {
                    "bucket": pa.array(of[own[:1]]), "codes": pa.array([_packed(number[entries])], pa.binary()),
                    "words": pa.array([zlib.compress(b"\xff".join([raws[i] for i in entries]), 3)], pa.binary()),
                })

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column(text).to_pylist()]
                codes = [np.array([words.setdefault(w, len(words)) for w in find(t)], np.uint32) for t in texts]
                # taken, not sliced: a slice would keep the message with the texts in memory
                held.append((part.select(key).take(pa.array(np.arange(part.num_rows))), codes))
                size += sum(map(len, texts))
                if size >= chars:
                    yield from flush()
                    block, words, held, size = block + 1, {}, [], 0
        if held:
            yield from flush()

    return run


def encode(
    df: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``df`` without ``text``, with the token ids of ``text`` as an array of ints.

    Ids are those of byte-level BPE by ``ranks`` on every match of ``pattern``, without special
    tokens. Null and empty texts give an empty array. Other columns, null or repeated keys and
    repeated rows pass through; columns called like the operator's own are kept under their names.
    """
    spark = df.sparkSession
    text_batches(spark)
    names = [f for f in df.schema.fields if f.name != text]
    inner = [f"_c{i}" for i in range(len(names))]
    plain = df.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(names, inner)], F.col(f"`{text}`").alias("_t"))
    kinds = [T.StructField(n, f.dataType) for n, f in zip(inner, names)]
    schema = T.StructType([
        *kinds, T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()),
        T.StructField("n", T.IntegerType()), T.StructField("codes", T.BinaryType()),
        T.StructField("bucket", T.IntegerType()), T.StructField("words", T.BinaryType()),
    ])
    # a bucket of the dictionaries is one group of a task, so their number follows the shuffle's
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * partitions
    # the codes, which are most of what is written, stay where they are: only ids come to them
    blocks = bucketed(
        plain.mapInArrow(_blocks(inner, "_t", pattern, block_chars, buckets, schema), schema), "blocks", "block", partitions
    )
    table = spark.sparkContext.broadcast(ranks)  # as many entries as the vocabulary, whatever the data

    def encoded(entries):
        import pyarrow as pa

        encoder, known = _encoder(table.value, pattern), {}
        lengths, ids = [], []
        for raw in entries["words"].to_pylist():
            out = []
            for word in zlib.decompress(raw).split(b"\xff"):
                if (found := known.get(word)) is None:
                    found = known[word] = np.array(encoder.encode_ordinary(word.decode()), np.uint32)
                out.append(found)
            lengths.append(_packed(np.array([len(x) for x in out])))
            ids.append(_packed(np.concatenate(out)))
        return pa.table({
            "block": entries["block"], "numbers": entries["codes"],
            "lengths": pa.array(lengths, pa.binary()), "ids": pa.array(ids, pa.binary()),
        })

    entries = (
        blocks.where("bucket IS NOT NULL").select("block", "bucket", "codes", "words")
        .groupBy("bucket").applyInArrow(encoded, "block long, numbers binary, lengths binary, ids binary")
    )

    def placed(documents, words):
        import pyarrow as pa

        join = lambda c: np.concatenate([np.zeros(0, np.uint32), *map(_unpacked, words[c].to_pylist())])
        number, length, flat = join("numbers"), join("lengths").astype(np.int64), join("ids").astype(np.int32)
        begin, size = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        begin[number], size[number] = np.cumsum(length) - length, length
        documents = documents.sort_by("place")
        out, ends, counts, at = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], documents["n"].to_numpy(), 0
        starts = [i for i, raw in enumerate(documents["codes"].to_pylist()) if raw is not None]
        for i, after in zip(starts, [*starts[1:], len(counts)]):
            codes = _unpacked(documents["codes"][i].as_py())
            n = size[codes]
            shift = begin[codes] - (np.cumsum(n) - n)
            out.append(flat[np.arange(n.sum()) + np.repeat(shift, n)])
            tokens = np.r_[0, np.cumsum(n)][np.cumsum(counts[i:after])]
            ends.append(at + tokens)
            at += len(out[-1])
        offsets = pa.array(np.concatenate(ends).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(out)))
        return pa.table({**{c: documents[c] for c in inner}, "ids": lists})

    result = T.StructType([*kinds, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    reassembled = (
        blocks.where("place IS NOT NULL").select(*inner, "block", "place", "n", "codes").groupBy("block")
        .cogroup(entries.groupBy("block")).applyInArrow(placed, result)
    )
    return reassembled.select(*[F.col(n).alias(f.name) for f, n in zip(names, inner)], F.col("ids").alias(ids))


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the tokens in ``ids``, in order.

    Joins the ids with the table of token bytes, which is as long as the vocabulary and therefore
    broadcast. A null array gives null; an id without a token raises.
    """
    spark = df.sparkSession
    text_batches(spark)
    size = max(ranks.values(), default=-1) + 1
    by_id: list[bytes | None] = [None] * size
    for token, i in ranks.items():
        by_id[i] = token
    table = spark.sparkContext.broadcast(by_id)

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = np.array([*table.value, None], object)[:-1]
        for batch in batches:
            yield pd.Series([None if x is None else b"".join(tokens[x].tolist()) for x in batch], dtype=object)

    return df.withColumn(name, of(F.col(ids)))
