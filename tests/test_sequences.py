"""Packing, decoding, samples and splits."""

import json

import numpy as np
from pyspark.sql import functions as F

from dockflow.operators import numbering, samples, sequences


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _steps(frame, lengths):
    rows = [(k, i, float(i), float(10 * i)) for k, n in lengths.items() for i in range(n)]
    return frame(rows, "k string, t int, a double, b double")


def test_pack_takes_latest_in_order_and_drops_short(spark, frame):
    df = _steps(frame, {"x": 5, "y": 2, "z": 3}).repartition(6)
    out = sequences.pack_sequences(df, ["k"], "t", ["a", "b"], 3)
    assert {r.k: r.features for r in out.collect()} == {
        "x": [[2.0, 20.0], [3.0, 30.0], [4.0, 40.0]],
        "z": [[0.0, 0.0], [1.0, 10.0], [2.0, 20.0]],
    }


def test_pack_is_the_same_for_any_partitioning(spark, frame):
    df = _steps(frame, {"x": 50, "y": 60})
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            packed = sequences.pack_sequences(df.repartition(int(n) + 1), ["k"], "t", ["a"], 40)
            results.append(_rows(packed.select("k", F.to_json("features"))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


def test_rank_limit_is_applied_before_the_shuffle(frame):
    df = _steps(frame, {"x": 3})
    for steps in (2, 1008):
        latest = sequences.latest_rows(df, "k", "t", steps)
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_json_round_trip_and_reasons(frame):
    good = [[1.0, 2.5], [3.0, -4.0]]
    cases = {
        "good": json.dumps(good),
        "text": '[["1", "2.5"], [3, -4]]',
        "nan": "[[1.0, NaN], [3, 4]]",
        "cut": json.dumps(good)[:9],
        "object": '{"a": 1}',
        "flat": "[1, 2]",
        "null": None,
        "empty": "[]",
        "long": "[[1,2],[3,4],[5,6]]",
        "ragged": "[[1,2],[3]]",
        "hole": "[[1,null],[3,4]]",
        "word": '[[1,"x"],[3,4]]',
        "missing_step": "[[1,2],null]",
    }
    df = frame(list(cases.items()), "id string, features string")
    decoded = sequences.decode_sequences(df, "features", 2, 2)
    reasons = {r.id: r.reject_reason for r in decoded.collect()}
    assert reasons == {
        "good": None,
        "text": None,
        "nan": None,
        "cut": "bad_json",
        "object": "bad_json",
        "flat": "bad_json",
        "null": "bad_json",
        "empty": "bad_length",
        "long": "bad_length",
        "ragged": "bad_width",
        "hole": "bad_value",
        "word": "bad_value",
        "missing_step": "bad_width",
    }
    values = {r.id: r.steps for r in sequences.accepted(decoded).collect()}
    assert values["good"] == values["text"] == good
    assert np.isnan(values["nan"][0][1])
    bad = sequences.rejected(decoded)
    assert bad.count() == 10 and "features" in bad.columns
    assert sequences.as_float32(decoded).schema["steps"].dataType.simpleString() == "array<array<float>>"


def test_alignment(frame):
    a = frame([("x", 0), ("y", 0), ("z", 1)], "k string, b int")
    b = frame([("x", 0), ("z", 1), ("w", 1)], "k string, b int")
    assert _rows(sequences.alignment(a, b, "k", ["b"], ("l", "r"))) == [(0, 1, 1, 0), (1, 1, 0, 1)]


def _sequence(frame, days, sites="ab"):
    rows = [(s, [[float(1000 * k + t), float(t % 24)] for t in range(days * 24)]) for k, s in enumerate(sites)]
    return frame(rows, "site string, features array<array<double>>")


def test_daily_samples_against_slices(frame):
    seqs = _sequence(frame, 12)
    arrays = {r.site: np.array(r.features) for r in seqs.collect()}
    for gap in (0, 3):
        out = samples.daily_samples(seqs, 4, {"y0": 0, "y1": 1}, gap_days=gap).collect()
        assert len(out) == 2 * (12 - (4 + 3))
        for r in out:
            a, i = arrays[r.site], r.sample_idx
            end = (i + 4) * 24
            assert np.array_equal(np.array(r.x), a[i * 24 : end])
            start = end + gap * 24
            assert r.y0 == a[start : start + 24, 0].tolist()
            assert r.y1 == a[start : start + 24, 1].tolist()


def test_no_samples_from_short_sequences(frame):
    assert samples.daily_samples(_sequence(frame, 7), 4, {"y": 0}).count() == 0
    assert samples.daily_samples(_sequence(frame, 3), 4, {"y": 0}).count() == 0


def test_static_row_and_width(frame):
    seqs = _sequence(frame, 9, "a").withColumn(
        "st", F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.array(i * 10))
    )
    out = samples.daily_samples(seqs, 4, {"y": 0}, static="st", width=1).orderBy("sample_idx").collect()
    assert [r.static for r in out] == [[0], [10]]
    assert {len(step) for r in out for step in r.x} == {1}


def test_day_splits_overlap_and_count(frame):
    seqs = _sequence(frame, 42, "a").withColumn(
        "st", F.transform(F.sequence(F.lit(0), F.lit(25)), lambda i: F.array(i))
    )
    parts = samples.split_days(
        seqs,
        samples.OVERLAP_HOURLY_SPLITS,
        static="st",
        static_splits=samples.OVERLAP_DAILY_SPLITS,
    )
    out = samples.daily_samples(parts, 14, {"y": 0}, gap_days=3, static="st")
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 18, "val": 4, "test": 4}
    firsts = {r.split: (r.x[0][0], r.static[0]) for r in out.filter("sample_idx = 0").collect()}
    assert firsts == {"train": (0.0, 0), "val": (17 * 24.0, 18), "test": (21 * 24.0, 22)}


def test_open_splits(frame):
    parts = samples.split_days(_sequence(frame, 138, "a"), samples.OPEN_SPLITS)
    counts = samples.daily_samples(parts, 7, {"y": 0}).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in counts} == {"train": 66, "val": 21, "test": 21}


def test_sliding_windows_against_numpy(frame):
    df = _steps(frame, {"x": 20, "y": 20}).repartition(4)
    out = samples.sliding_windows(df, "k", "t", ["a", "b"], 5, 3).collect()
    data = np.array([[i, 10 * i] for i in range(20)], dtype=float)
    assert len(out) == 2 * (20 - 5 - 3 + 1)
    for r in out:
        t = r.sample_idx + 4
        assert np.array_equal(np.array(r.x), data[t - 4 : t + 1])
        assert np.array_equal(np.array(r.y), data[t + 1 : t + 4])
        assert r.samples == 13
    later = samples.sliding_windows(df, "k", "t", ["a"], 5, 3, y_start=2).first()
    assert len(later.y) == 2 and later.y[0][0] == later.x[-1][0] + 2
    assert samples.window_offsets(5, 3) == ([-4, -3, -2, -1, 0], [1, 2, 3])


def test_ratio_split_sizes_round_half_to_even(spark):
    for n in (1, 2, 5, 13, 25, 625):
        df = spark.range(n).select(F.col("id").alias("sample_idx"), F.lit(n).alias("samples"))
        counts = {r.split: r["count"] for r in samples.ratio_split(df).groupBy("split").count().collect()}
        test, train = round(n * 0.2), round(n * 0.6)
        assert counts.get("test", 0) == test
        assert counts.get("train", 0) == train
        assert counts.get("val", 0) == n - test - train


def test_sample_rows_follow_site_and_index(spark, frame):
    sizes = {"b": 2, "a": 3, "d": 0, "c": 5}
    steps = frame([(s, i) for s, n in sizes.items() for i in range((n + 10) * 24 + 7)], "site string, t int")
    counts = samples.sample_counts(steps, "site", 7)
    assert _rows(counts) == [("a", 3), ("b", 2), ("c", 5)]
    expected = [(s, i) for s in sorted(sizes) for i in range(sizes[s])]
    assert _rows(samples.sample_keys(counts)) == expected
    out, total = samples.sample_rows(counts, "site")
    assert _rows(out.select("site", "sample_idx", "row_id")) == [(s, i, n) for n, (s, i) in enumerate(expected, 1)]
    assert numbering.full_pages_only(out, 4, total=total).count() == 8
    assert samples.sample_rows(counts.limit(0), "site")[0].count() == 0


def test_row_numbers_run_the_plan_before_them_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    keys = spark.range(1000, numPartitions=5).mapInPandas(count, "id long")
    keys = keys.select(F.format_string("k%05d", F.pmod(F.col("id") * 389, F.lit(1000))).alias("k"))
    numbered = numbering.row_numbers(keys, ["k"], rows_per_range=90)
    for _ in range(2):
        assert _rows(numbered) == [(f"k{i:05d}", i + 1) for i in range(1000)]
    assert seen.value == 1000
    assert _rows(numbering.row_numbers(keys.limit(0), ["k"])) == []


def test_ranges_grow_with_the_rows_and_cut_groups(spark):
    df = spark.range(3000).select((F.col("id") % 1000 % 7 == 0).cast("int").alias("g"), "id")
    parts = numbering.ranged(df, ["g", "id"], rows_per_range=100)
    sizes = [r["count"] for r in parts.groupBy("_range").count().collect()]
    assert len(sizes) == 30 and max(sizes) < 300
    got = numbering.row_numbers(df, [F.desc("id")], by=["g"], rows_per_range=100).collect()
    for g in (0, 1):
        ids = [r["id"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["row_id"])]
        assert ids == sorted(ids, reverse=True) and len(ids) == sum(r["g"] == g for r in got)
        assert sorted(r["row_id"] for r in got if r["g"] == g) == list(range(1, len(ids) + 1))
    sums = numbering.running_totals(df, ["id"], "g", "before", rows_per_range=100).orderBy("id").collect()
    total = 0
    for r in sums:
        assert r["before"] == total
        total += r["g"]


def test_sample_slices_do_not_carry_the_sequence(spark, frame):
    df = frame([("a", [[float(i)] for i in range(24 * 12)])], "k string, features array<array<double>>")
    plan = samples.daily_samples(df, 7, {"y": 0})._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan and "explode" not in plan
    generate = next(line for line in plan.splitlines() if "Generate inline" in line)
    assert "[1]" in generate  # the packed array is not among the columns that the generator carries


