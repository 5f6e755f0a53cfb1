"""License scans: ordered signatures over a text's words, behind a keyword prefilter.

Everything here is Spark SQL functions. A text without any stem costs one pass over its words;
otherwise the signatures whose keyword occurs are tried. A detection that lies within another one
is suppressed if the other has a better priority, or the same and is longer or comes first in order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import LOWER, UPPER
from dockflow.llm.license_rules import SIGNATURES, STEMS

#: How sure a detection of each priority is.
CONFIDENCE = (1.0, 0.95, 0.9, 0.75)
N_BASE = 3


@dataclass(frozen=True)
class Signature:
    priority: int
    label: str
    keyword: str
    pattern: str


def _parsed(text: str) -> tuple[Signature, ...]:
    out = []
    for line in text.strip().splitlines():
        priority, label, keyword, pattern = line.split(" ; ")
        out.append(Signature(int(priority), label, keyword, pattern))
    return tuple(out)


#: The first three are the base phrases, which are never suppressed.
RULES = _parsed(SIGNATURES)


def words_of(text: Column) -> Column:
    """Words of a text in lower case (A-Z only), one blank between them."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _blanks(c: Column) -> Column:
    return F.char_length(c) - F.char_length(F.replace(c, F.lit(" ")))


def _places(words: Column, rule: Column) -> Column:
    """Start and end (exclusive) in words of every match of a rule."""
    pattern = F.concat(F.lit("(?<![^ ])(?:"), rule["pattern"], F.lit(")(?![^ ])"))
    found = F.regexp_extract_all(words, pattern, F.lit(0))
    between = F.split(words, pattern, F.lit(-1))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        at = acc["at"] + _blanks(pair["between"])
        end = at + _blanks(pair["found"])
        place = F.struct(at.alias("start"), (end + 1).alias("end"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(place)).alias("out"))

    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda f, b: F.struct(f.alias("found"), b.alias("between")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(start["out"])


def detect(
    df: DataFrame, text: str = "text", name: str = "detections", n_words: str = "n_words",
    rules: tuple[Signature, ...] = RULES, stems: tuple[str, ...] = STEMS,
) -> DataFrame:
    """``df`` with the number of words of ``text`` and its license detections.

    A detection has ``start`` and ``end`` (words, end exclusive), ``rule`` (number), ``priority``,
    ``label``, ``text`` and ``kept``; they are in order of start, longer ones first. ``kept`` is
    false where another detection suppresses it. Null and empty texts have no words and no
    detections; the same text always has the same detections.
    """
    rule_type = "array<struct<rule:int,priority:int,label:string,keyword:string,pattern:string>>"
    table = F.array(*[
        F.struct(F.lit(i).alias("rule"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"),
                 F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"))
        for i, r in enumerate(rules)
    ]).cast(rule_type)
    df = df.withColumn("__llm_words", words_of(F.col(text)))
    words = F.col("__llm_words")
    gate = F.lit(False)
    for stem in stems:
        gate = gate | F.contains(words, F.lit(stem))
    tried = F.filter(table, lambda r: F.contains(words, r["keyword"]))
    found = F.flatten(F.transform(tried, lambda r: F.transform(_places(words, r), lambda p: F.struct(
        p["start"].alias("start"), (-p["end"]).alias("minus_end"), r["priority"].alias("priority"),
        r["rule"].alias("rule"), r["label"].alias("label"),
    ))))
    none = F.array().cast("array<struct<start:int,minus_end:int,priority:int,rule:int,label:string>>")
    df = df.withColumn("__llm_found", F.when(gate, F.array_sort(found)).otherwise(none))
    # in this order whatever holds a detection comes before it: one running maximum of ends per priority
    ends = F.struct(F.array(*[F.lit(-1)] * 4).alias("far"), F.array().cast("array<boolean>").alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["minus_end"]
        kept = F.get(acc["far"], d["priority"] - 1) < end
        far = F.transform(acc["far"], lambda x, p: F.when(p >= d["priority"] - 1, F.greatest(x, end)).otherwise(x))
        return F.struct(far.alias("far"), F.concat(acc["kept"], F.array(kept)).alias("kept"))

    kept = F.when(F.size("__llm_found") > 0, F.aggregate("__llm_found", ends, step, lambda acc: acc["kept"])).otherwise(F.array().cast("array<boolean>"))
    split = F.when(F.size("__llm_found") > 0, F.split(words, " "))
    out = F.zip_with("__llm_found", kept, lambda d, k: F.struct(
        d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["rule"].alias("rule"),
        d["priority"].alias("priority"), d["label"].alias("label"), k.alias("kept"),
    ))
    df = df.withColumn("__llm_kept", out).withColumn("__llm_split", split)
    shown = F.transform("__llm_kept", lambda d: d.withField("text", F.array_join(F.slice("__llm_split", d["start"] + 1, d["end"] - d["start"]), " ")))
    count = F.when(words == "", 0).otherwise(_blanks(words) + 1).cast("long")
    return df.withColumns({name: shown, n_words: count}).drop("__llm_words", "__llm_found", "__llm_kept", "__llm_split")


def summary(detections: str = "detections", n_base: int = N_BASE) -> dict[str, Column]:
    """Columns over the detections: places and labels of the base phrases, all labels, a score.

    The score is the confidence of the best priority among the detections kept, 0 without any.
    """
    base = F.filter(detections, lambda d: d["rule"] < n_base)
    counted = F.filter(detections, lambda d: d["kept"] | (d["rule"] < n_base))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c["label"])), ",")
    best = F.array_min(F.transform(counted, lambda d: d["priority"]))
    confidence = F.array(*map(F.lit, CONFIDENCE))
    return {
        "n_base": F.size(base).cast("long"),
        "first_word": F.array_min(base["start"]).cast("long"),
        "last_word": F.array_max(base["start"]).cast("long"),
        "base_labels": labels(base),
        "labels": labels(counted),
        "score": F.coalesce(F.get(confidence, best - 1), F.lit(0.0)),
    }
