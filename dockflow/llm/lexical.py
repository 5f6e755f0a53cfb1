"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items of a block form one automaton, each term guarded by a blank on either side, so that
only whole terms match. One scan of the texts counts how often each term occurs (tf) and how many terms a
document has; no index of the documents is built. The automaton's outputs are term numbers, which map to the
items that hold the term; every task keeps the best documents of each item, and only those are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from dockflow.llm.base import LOWER, UPPER, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of the terms of one automaton; more items are searched in further scans.
BLOCK_BYTES = 1 << 21
#: Scores (documents x items) that a task holds at once, and products that it adds up at once.
CELLS, PRODUCTS = 1 << 21, 1 << 21

#: Bytes of terms, capitals as small ones; the rest is a blank.
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct rows ``(_item, _term)``; rows with equal ids are one item."""
    words = F.regexp_extract_all(F.translate(F.col(f"`{text}`"), UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select(F.col(f"`{item}`").alias("_item"), F.explode(F.array_distinct(words)).alias("_term")).distinct()


def automaton(terms: list[str]):
    """Automaton that gives the number of every guarded term it meets."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        machine.add_word(f" {term} ", i)
    machine.make_automaton()
    return machine


def scan(documents: DataFrame, terms: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(_key, n, terms, tf)``: number of terms of the text, those of ``terms`` in it and how often."""
    rows = documents.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_t"))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema["_key"], *[T.StructField(n, t) for n, t in (("n", T.LongType()), ("terms", ints), ("tf", ints))]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(terms)
        for batch in batches:
            lengths, ends, ids, times = [], [0], [], []
            for t in batch.column("_t").cast(pa.large_binary()):
                plain = (t.as_py() or b"").translate(_TERM)
                lengths.append(len(plain.split()))
                found = Counter(map(itemgetter(1), machine.iter(f" {plain.decode()} "))) if terms else {}
                ids += found.keys()
                times += found.values()
                ends.append(len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (ids, times)]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(lengths, pa.int64()), *lists], schema.names)

    return rows.mapInArrow(count, schema)


class _Best:
    """The best ``k`` documents per item among those offered, ties to the smaller key, null keys last."""

    def __init__(self, items: int, k: int):
        self.k, self.kept = k, None
        self.least = np.ones(items, np.int64)

    def offer(self, scores: np.ndarray, keys: pa.Array) -> None:
        row, item = np.nonzero(scores >= self.least)
        if len(row):
            new = pa.table({"item": item, "score": scores[row, item], "key": keys.take(pa.array(row))})
            self._keep(new if self.kept is None else pa.concat_tables([self.kept, new]))

    def _keep(self, found: pa.Table) -> None:
        order = [("item", "ascending"), ("score", "descending"), ("key", "ascending")]
        found = found.take(pc.sort_indices(found, order, null_placement="at_end"))
        item, score = found["item"].to_numpy(), found["score"].to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.k - 1
        self.least[item[full]] = score[full]
        self.kept = found.filter(pa.array(place < self.k)).combine_chunks()


def best_documents(
    hits: DataFrame, weights: np.ndarray, pairs: list[tuple[int, int]], items: list, kind: T.DataType,
    documents: int, length: int, k: int,
) -> DataFrame:
    """Rows ``(_item, _key, score)``: of every task's hits the ``k`` best per item.

    ``pairs`` are the places of items and terms in ``items`` and ``weights``; ``documents`` and ``length`` are
    the corpus's numbers of documents with a term and of terms.
    """
    by_term = np.array(sorted((t, i) for i, t in pairs), np.int64).reshape(-1, 2)
    owners = by_term[:, 1]
    begin = np.searchsorted(by_term[:, 0], np.arange(len(weights) + 1))
    named = T.StructField("_item", kind)
    schema = T.StructType([named, hits.schema["_key"], T.StructField("score", T.LongType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(items), k)
        rows = max(1, CELLS // max(1, len(items)))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                lists = part.column("terms")
                term = lists.flatten().to_numpy().astype(np.int64)
                tf = part.column("tf").flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                m = 50 + 50 * part.column("n").to_numpy() * documents // max(1, length)
                product = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
                sums = np.zeros(part.num_rows * len(items), np.int64)
                times = begin[term + 1] - begin[term]
                upto = np.cumsum(times)
                cuts = np.searchsorted(upto, np.arange(PRODUCTS, (upto[-1] if len(upto) else 0) + PRODUCTS, PRODUCTS), "right")
                for a, b in zip([0, *cuts], [*cuts, len(term)]):
                    if a < b:
                        n = times[a:b]
                        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        item = owners[np.repeat(begin[term[a:b]], n) + step]
                        np.add.at(sums, np.repeat(doc[a:b] * len(items), n) + item, np.repeat(product[a:b], n))
                best.offer(sums.reshape(part.num_rows, len(items)), part.column("_key"))
        if best.kept is not None:
            names = pa.array(items, to_arrow_type(kind)).take(best.kept["item"].combine_chunks())
            columns = [names, best.kept["key"].combine_chunks(), best.kept["score"].combine_chunks()]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return hits.mapInArrow(score, schema)


def search(
    documents: DataFrame,
    items: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows ``(item, rank, key, score)``: the ``k`` documents of highest score above 0 per item, rank from 1.

    Equal scores go by ascending key, null keys last; rows that repeat a key are documents of their own. Items that
    share an id are one item with the terms of all its rows, a null id is an id; items and documents without
    a term (null and empty texts) are in no result. Items fall into blocks by hash, so that an
    automaton has about ``block_bytes`` bytes of terms (one item's at least); every block is one scan. What a
    task holds is bounded by the block and ``k``, what is shuffled by tasks x items x ``k``.
    """
    spark = documents.sparkSession
    wanted = written(item_terms(items, item, item_text), "terms")
    kind, key_kind = wanted.schema["_item"].dataType, documents.schema[key].dataType
    size = wanted.agg(F.sum(F.octet_length("_term"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = None
    for block in range(blocks if size else 0):
        mine = wanted.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block).collect()
        terms = sorted({r["_term"] for r in mine})
        named = list(dict.fromkeys(r["_item"] for r in mine))
        if not terms:
            continue
        term_at, item_at = ({x: i for i, x in enumerate(xs)} for xs in (terms, named))
        pairs = [(item_at[r["_item"]], term_at[r["_term"]]) for r in mine]
        hits = written(scan(documents, terms, key, text), "hits")
        n, length = hits.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weight = F.floor(F.log(F.lit(2 * n + 2).cast("double") / (2 * F.col("df") + 1)) * 1000)
        weights = np.zeros(len(terms), np.int64)
        for r in df.select("term", weight.alias("w")).collect():
            weights[r["term"]] = r["w"]
        part = best_documents(hits, weights, pairs, named, kind, n, length, k)
        found = part if found is None else found.union(part)
    if found is None:
        empty = T.StructType([T.StructField("_item", kind), T.StructField("_key", key_kind), T.StructField("score", T.LongType())])
        found = spark.createDataFrame([], empty)
    order = Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("_key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("_item").alias(item), "rank", F.col("_key").alias(key), "score")
