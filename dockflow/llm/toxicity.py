"""Toxicity from two class-conditional Kneser-Ney models.

Both models are interpolated over one shared lower order, made of continuation counts of all
labelled text: in how many classes of preceding words an expression stands. What an expression's
own class count does not settle is left to that order, and it cancels out between the models, so
rare expressions say little. A word backs off to its beginnings: if its own counts say nothing,
those of its longest beginning that differs between the classes do. A text's score is a calibrated
comparison of its log-likelihoods under both models, per word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import text_batches, written

#: Words in the models: runs of letters, marks, digits and apostrophes, in lower case.
WORD = r"[\p{L}\p{M}\p{N}']+"


@dataclass(frozen=True)
class Settings:
    """``slots`` is a power of two: expressions are hashed into so many, which bounds the model.

    ``histories`` (64 at most) is the number of classes that preceding words are hashed into. Beginnings
    of words have ``shortest`` to ``longest`` letters. An expression's
    weight is dropped where the classes' counts do not differ by more than chance (``least_g2``, a
    log-likelihood ratio) or by less than the factor ``exp(least_weight)``. ``neutral`` words are
    added to every text, so that one word alone does not decide a short one. Both are chosen among ``least_weights``
    and ``neutrals``. ``calibration`` bounds the labelled rows that they and the final curve are
    fitted on; of the labelled rows one in ``fold`` is kept from the counts for it.
    """

    slots: int = 1 << 22
    histories: int = 64
    shortest: int = 3
    longest: int = 10
    least_g2: float = 30.0
    least_weights: tuple[float, ...] = (1.0, 1.5, 2.0, 2.5, 3.0)
    neutrals: tuple[int, ...] = (10, 20, 40, 80)
    fold: int = 6
    calibration: int = 20_000


@dataclass(frozen=True)
class Model:
    """Weights per slot (log-likelihood ratio, toxic over ordinary), what was chosen, and the calibration curve."""

    slots: np.ndarray
    weights: np.ndarray
    neutral: int
    curve: tuple[np.ndarray, np.ndarray]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def expression_counts(labelled: DataFrame, text: str, toxic: str, how: Settings) -> DataFrame:
    """Counts per slot: ``toxic``, ``ordinary`` and the number of history classes (``contexts``)."""
    words = F.col("_w")
    shifted = F.slice(F.concat(F.array(F.lit("")), words), F.lit(1), F.size(words))  # as many as words, also without any
    # a word counts once per text and history class: a line said a thousand times is one piece of evidence
    history = lambda w: F.lpad((F.crc32(w) % how.histories).cast("string"), 2, "0")
    marked = F.array_distinct(F.zip_with(words, shifted, lambda w, before: F.concat(history(before), w)))
    pairs = labelled.select(F.col(toxic).alias("_y"), _words(F.col(text)).alias("_w")).select(
        F.col("_y").cast("long").alias("y"), F.explode(marked).alias("m")
    )
    words = pairs.select("y", F.expr("substring(m, 3)").alias("word"), F.expr("shiftleft(1L, cast(substring(m, 1, 2) as int))").alias("h"))
    words = words.groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o"), F.bit_or("h").alias("h"))
    # slots by CRC-32, which the scoring side computes as well
    lengths = F.sequence(F.lit(how.shortest), F.lit(how.longest))
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.char_length("word")), lambda n: F.col("word").substr(F.lit(1), n)
    )
    forms = F.concat(F.array(F.concat("word", F.lit("$"))), prefixes)
    return (
        words.select(F.explode(forms).alias("form"), "t", "o", "h")
        .groupBy((F.crc32("form") % how.slots).cast("int").alias("slot"))
        .agg(F.sum("t").alias("toxic"), F.sum("o").alias("ordinary"), F.bit_or("h").alias("h"))
        .select("slot", "toxic", "ordinary", F.bit_count("h").alias("contexts"))
    )


def _discounts(by_count: dict[int, int]) -> tuple[float, float, float]:
    """Discounts for counts 1, 2 and 3 or more from the numbers of expressions with those counts."""
    n1, n2, n3, n4 = (max(1, by_count.get(i, 0)) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(i - 0.05, max(0.1, d)) for i, d in enumerate(raw, 1))


def weigh(counts: DataFrame, how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Slots and their log-likelihood ratios; no more entries than ``slots``."""
    counts = written(counts, "counts")
    totals = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("toxic", "ordinary", "contexts")]).first()
    n_t, n_o, n_c = (float(x) for x in totals)
    if not n_t or not n_o:
        return np.zeros(0, np.int64), np.zeros(0)
    log_p = {}
    shared = (F.col("contexts") + 0.5) / (n_c + 0.5 * how.slots)
    for name, total in (("toxic", n_t), ("ordinary", n_o)):
        few = counts.where((F.col(name) > 0) & (F.col(name) <= 4)).groupBy(name).count().collect()
        d = _discounts({int(r[0]): r[1] for r in few})
        n = F.col(name)
        discount = F.when(n == 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        mass = counts.agg(F.sum(discount)).first()[0] / total
        log_p[name] = F.log((n - discount) / total + mass * shared)
    # the ratio's significance: G squared of the two counts against equal shares
    both, expected = F.col("toxic") + F.col("ordinary"), n_t / (n_t + n_o)
    part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    g2 = 2 * (part(F.col("toxic"), both * expected) + part(F.col("ordinary"), both * (1 - expected)))
    weight = log_p["toxic"] - log_p["ordinary"]
    kept = counts.select("slot", weight.alias("w"), g2.alias("g2")).where(
        (F.col("g2") >= how.least_g2) & (F.abs("w") >= min(how.least_weights))
    )
    rows = kept.select("slot", "w").toPandas().sort_values("slot")
    return rows["slot"].to_numpy(np.int64), rows["w"].to_numpy(np.float64)


def _finder():
    import regex

    return regex.compile(WORD).findall


def _weight(word: str, table: np.ndarray, how: Settings) -> float:
    """Log-likelihood ratio of a word: its own, or that of its longest beginning that has one."""
    mask, raw = len(table) - 1, word.encode()
    found = table[zlib.crc32(raw + b"$") & mask]
    for n in range(min(how.longest, len(word)), how.shortest - 1, -1):
        if found:
            break
        found = table[zlib.crc32(word[:n].encode()) & mask]
    return float(found)


class Reader:
    """Sums of a text's weights, over tables by slot; weights of words met before are looked up."""

    def __init__(self, tables: list[np.ndarray], how: Settings):
        self.find, self.tables, self.how, self.known = _finder(), tables, how, {}

    def __call__(self, text: str | None) -> tuple[int, list[float]]:
        """Number of words and, per table, their log-likelihood ratio; nothing for a text without words."""
        words = self.find((text or "").lower())
        if len(self.known) > 200_000:  # a cache, so emptying it changes nothing
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = tuple(_weight(word, t, self.how) for t in self.tables)
        known = self.known
        return len(words), [sum([known[w][i] for w in words]) for i in range(len(self.tables))]


def _table(slots: np.ndarray, weights: np.ndarray, how: Settings) -> np.ndarray:
    out = np.zeros(how.slots, np.float32)
    out[slots] = weights
    return out


def choose(n: np.ndarray, sums: np.ndarray, y: np.ndarray, part: np.ndarray, how: Settings) -> tuple[int, int]:
    """Numbers of the ``least_weights`` and ``neutrals`` with the best likelihood of the labels.

    Every row is scored on a curve fitted without its ``part``. Of equal choices the first stands.
    """
    best, found = (0, 0), np.inf
    for i in range(len(how.least_weights)):
        for j, neutral in enumerate(how.neutrals):
            x, p = sums[:, i] / (n + neutral), np.zeros(len(y))
            for k in set(part.tolist()):
                p[part == k] = on_curve(x[part == k], calibrate(x[part != k], y[part != k]))
            loss = -np.log(np.clip(np.where(y == 1, p, 1 - p), 1e-4, 1)).sum()
            if loss < found - 1e-9:
                best, found = (i, j), loss
    return best


Curve = tuple[np.ndarray, np.ndarray]


def calibrate(x: np.ndarray, y: np.ndarray) -> Curve:
    """Rising steps of the share of toxic rows (isotonic regression), as points to interpolate.

    Unlike a logistic curve it is not flattened by rows whose label no word of theirs explains.
    Without rows, or with one label only, the curve stays at 0.
    """
    if not len(y) or y.min() == y.max():
        return np.zeros(1), np.zeros(1)
    values, at = np.unique(x, return_inverse=True)
    n, hits = np.bincount(at).astype(float), np.bincount(at, weights=y)
    blocks: list[tuple[float, float, float, float]] = []  # rows, hits, first and last x
    for v, a, b in zip(values, n, hits):
        blocks.append((a, b, v, v))
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last, before = blocks.pop(), blocks.pop()
            blocks.append((before[0] + last[0], before[1] + last[1], before[2], last[3]))
    b = np.array(blocks)
    share = np.maximum.accumulate((b[:, 1] + 0.1) / (b[:, 0] + 0.2))
    return b[:, 2:].ravel(), np.repeat(share, 2)


def on_curve(x: np.ndarray, curve: Curve) -> np.ndarray:
    """Score on the curve; a small share of it keeps rising between equal steps."""
    return 0.98 * np.interp(x, *curve) + 0.02 / (1 + np.exp(-np.clip(10 * x, -30, 30)))


def fit(
    labelled: DataFrame, text: str = "text", toxic: str = "toxic", key: str = "doc_id", how: Settings = Settings()
) -> Model:
    """Models and calibration from rows of text and label (0 or 1; rows with another label are left out).

    All rows but one in ``fold`` (by hash of key) give counts, however many there are. The least weight, the neutral
    words and the curve are fitted on the rest, on at most about ``calibration`` of them, picked by hash.
    """
    text_batches(labelled.sparkSession)
    rows = written(
        labelled.where(F.col(toxic).isin(0, 1)).select(
            F.col(text).alias("_t"), F.col(toxic).alias("_y"), F.xxhash64(F.lit(3), F.col(key)).alias("_h")
        ),
        "labelled",
    )
    part = F.pmod("_h", F.lit(how.fold))
    slots, weights = weigh(expression_counts(rows.where(part != 0), "_t", "_y", how), how)
    aside = rows.where(part == 0)
    n = aside.count()
    share = min(1.0, how.calibration / max(1, n))
    aside = aside.where(F.pmod(F.floor(F.col("_h") / how.fold), F.lit(1_000_003)) < F.lit(int(1_000_003 * share)))
    shared = labelled.sparkSession.sparkContext.broadcast((slots, weights))

    @F.pandas_udf("n long, sums array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        slots, weights = shared.value
        read = Reader([_table(slots, np.where(np.abs(weights) >= w, weights, 0), how) for w in how.least_weights], how)
        for batch in batches:
            yield pd.DataFrame(map(read, batch), columns=["n", "sums"])

    frame = aside.select("_y", F.pmod(F.floor(F.col("_h") / 97), F.lit(5)).alias("part"), measure("_t").alias("m"))
    frame = frame.select("_y", "part", "m.n", "m.sums").orderBy("n", "sums", "part", "_y").toPandas()
    n, y = frame["n"].to_numpy(float), frame["_y"].to_numpy(float)
    sums = np.array(frame["sums"].tolist(), float).reshape(len(y), len(how.least_weights))
    i, j = choose(n, sums, y, frame["part"].to_numpy(), how)
    kept, neutral = np.abs(weights) >= how.least_weights[i], how.neutrals[j]
    return Model(slots[kept], weights[kept], neutral, calibrate(sums[:, i] / (n + neutral), y))


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score", how: Settings = Settings()) -> DataFrame:
    """``df`` with the calibrated score (0 to 1) of ``text``; null and empty texts score like neutral ones.

    The weights are broadcast: there are no more of them than ``slots``.
    """
    text_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        read = Reader([_table(own.slots, own.weights, how)], how)
        for batch in batches:
            found = [(total[0], n) for n, total in map(read, batch)]
            total, n = np.array(found, np.float64).reshape(-1, 2).T
            yield pd.Series(on_curve(total / (n + own.neutral), own.curve), dtype="float64")

    return df.withColumn(name, measure(F.col(text)))


def held_out(key: Column | str) -> Column:
    """Rows whose labels are never learned: CRC-32 of the key as text is 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", how: Settings = Settings()) -> Model:
    """A model from the labels of rows that are not held out.

    A key that is labelled more than once counts as toxic if any of its labels is 1. Only text and
    label reach the model.
    """
    labels = labels.where(F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max("toxic").alias("toxic"))
    rows = documents.where(F.col(key).isNotNull() & ~held_out(key)).select(key, text)
    # a sort-merge join at every size: small labels are not broadcast, large ones could not be
    return fit(rows.join(labels.hint("merge"), key), text, "toxic", key, how)
