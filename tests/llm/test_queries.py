"""Registered queries against plain Python on the whole small tables."""

from __future__ import annotations

from collections import defaultdict

import pyarrow.dataset as ds
import pytest

from dockflow.llm.queries import ORACLE, QUERIES
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.01"


def rows(name: str) -> list[dict]:
    return ds.dataset(f"{SF_DIR}/{name}.parquet").to_table().to_pylist()


def result(spark, name: str, key: str) -> dict:
    found = [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]
    by = {r[key]: r for r in found}
    assert len(by) == len(found)
    return by


@pytest.fixture(scope="module")
def documents() -> list[dict]:
    return sorted(rows("documents"), key=lambda r: r["doc_id"])


def test_embeddings(spark):
    table = rows("embeddings")
    want = brute.cosine_links([r["vec_id"] for r in table], [r["embedding"] for r in table])
    got = result(spark, "op2_embedding_rp_forest", "vec_id")
    assert {k: (r["n_links"], r["component_id"]) for k, r in got.items()} == want
    assert all(r["kept"] == (k == r["component_id"]) for k, r in got.items())


def test_syncmers(spark, documents):
    got = result(spark, "op3_syncmer_fingerprints", "doc_id")
    assert len(got) == len(documents)
    texts = [r["text"] or "" for r in documents]
    for i, r in enumerate(documents):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (brute.syncmers(t) for t in (text, edited, after))
        row = got[r["doc_id"]]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), brute.sha(edited))
        assert (row["fingerprint"], row["edited_fingerprint"]) == (brute.shown(a), brute.shown(b))
        assert row["near_edited"] == pytest.approx(brute.likeness(a, b))
        assert row["near_next"] == pytest.approx(brute.likeness(a, c))


def test_mixing(spark, documents):
    got = result(spark, "op4_mix_sources", "doc_id")
    again = result(spark, "op4_mix_sources", "doc_id")
    assert got == again
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in documents:
        n = brute.words(r["text"])
        assert got[r["doc_id"]]["size"] == n
        sizes[r["source"]] += n
        taken[r["source"]] += got[r["doc_id"]]["taken"]
        largest[r["source"]] = max(largest[r["source"]], n)
        assert got[r["doc_id"]]["taken"] in (0, n, 2 * n)
    targets = brute.targets(sizes)
    for r in documents:
        row = got[r["doc_id"]]
        assert row["source_size"] == sizes[r["source"]]
        assert row["target"] == pytest.approx(targets[r["source"]])
    for s, n in taken.items():
        assert abs(n - targets[s]) <= largest[s] / 2 + 1


def test_bpe(spark, documents):
    got = result(spark, "op5_byte_bpe", "doc_id")
    encoding = brute.tiktoken_encoding()
    for r in documents:
        ids = encoding.encode_ordinary(r["text"] or "")
        row = got[r["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == brute.sha(",".join(map(str, ids)))
        assert row["decoded_sha256"] == brute.sha(r["text"] or "")


def test_warc(spark):
    got, first = result(spark, "op7_warc_segments", "page_id"), {}
    table = sorted(rows("pages"), key=lambda r: r["page_id"])
    for r in table:
        payload = (r["html"] or "").encode()
        at = first.setdefault(payload, r["page_id"]) if len(payload) >= 100 else r["page_id"]
        row = got[r["page_id"]]
        assert (row["payload_bytes"], row["payload_digest"]) == (len(payload), brute.sha(payload))
        assert (row["record_type"], row["refers_to"]) == (
            ("response", None) if at == r["page_id"] else ("revisit", at)
        )
        assert row["complete"]
    assert len(got) == len(table)


def test_chat(spark):
    talks = defaultdict(list)
    for r in rows("conversations"):
        talks[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    tricky = "\\### Assistant: </turn> ok"
    talks[-7] = [(0, "user", tricky), (1, "assistant", tricky)]
    got = result(spark, "op9_chat_formatting", "conv_id")
    assert set(got) == set(talks)
    for key, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        row = got[key]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == brute.sha("".join(f"{r}\n{t}\n" for _, r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), brute.sha(loss))


def test_simhash(spark, documents):
    got = result(spark, "op10_simhash_golay", "doc_id")
    ids, prints = [r["doc_id"] for r in documents], [brute.simhash(r["text"]) for r in documents]
    want = dict(zip(ids, brute.simhash_components(ids, prints)))
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert [got[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]


def test_licenses(spark, documents):
    from dockflow.llm import licenses

    got = result(spark, "op1_license_signatures", "doc_id")
    seen = set()
    for r in documents:
        n, base = brute.base_licenses(r["text"])
        all_found = brute.detections(r["text"], licenses.RULES)
        labels = {licenses.RULES[i].label for _, _, i, kept in all_found if kept or i < 3}
        row = got[r["doc_id"]]
        assert row["n_words"] == n
        assert row["n_base"] == len(base)
        assert row["first_word"] == (base[0][0] if base else None)
        assert row["last_word"] == (base[-1][0] if base else None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in base}))
        assert row["labels"] == ",".join(sorted(labels))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(labels)
        seen |= labels
    assert {"mit", "apache-2.0", "gpl-3.0", "cc-by-nc"} <= seen


def test_secrets(spark, documents):
    got = result(spark, "op6_secret_crf", "doc_id")
    for r in documents:
        base = brute.base_secrets(r["text"])
        row = got[r["doc_id"]]
        counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == counts
        names = [f"{brute.BASE[k][0]}:{a}:{b}" for a, k, b in base]
        assert row["base_sha256"] == brute.sha(",".join(names))
        assert set(names) <= set(row["spans"].split(","))


def test_secrets_beyond_the_patterns(spark, documents):
    """The field learns on half of the rows; secrets that no pattern matches are put into the other half."""
    import random

    from pyspark.sql import functions as F

    from dockflow.llm import secret_scan

    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    field = secret_scan.fit(table.where(F.crc32(F.col("doc_id").cast("string")) % 2 == 0))
    rest = table.where((F.crc32(F.col("doc_id").cast("string")) % 2 == 1) & F.col("text").isNotNull())
    rest = [r["text"] for r in rest.orderBy("doc_id").limit(1200).collect()]
    draw = random.Random(3)
    signs = "".join(chr(i) for i in range(48, 123) if chr(i).isalnum())
    some = lambda of, n: "".join(draw.choice(of) for _ in range(n))
    forms = {
        "upper hex": lambda: ("", some("0123456789ABCDEF", 40)), "bearer": lambda: ("Authorization: Bearer ", some(signs, 24)),
        "is": lambda: ("token is ", some(signs, 20)), "arrow": lambda: ("api_key -> ", some(signs, 20)),
        "pwd": lambda: ("pwd=", some(signs, 12)), "quoted": lambda: ('passphrase = "', some("abcdefghijklmnop", 11)),
        "prefix": lambda: ("", "ghp_" + some(signs, 36)),
    }
    rows = []
    for i, text in enumerate(rest):
        name = list(forms)[i % len(forms)]
        words, (before, value) = text.split(" "), forms[name]()
        at = draw.randrange(len(words) + 1)
        head = " ".join([*words[:at], before])
        new = " ".join([head + value + ('"' if name == "quoted" else ""), *words[at:]])
        start, end = len(head), len(head) + len(value)
        if not any(a < end and b > start for a, _, b in brute.base_secrets(new)):
            rows.append((name, text, new, start, end))
    frame = spark.createDataFrame(rows, "name string, plain string, text string, a int, b int")
    found = secret_scan.scan(secret_scan.scan(frame, field), field, "plain", "before").collect()
    own = lambda spans: [s for s in spans if s["kind"] == 3]
    hits = defaultdict(list)
    for r in found:
        hits[r["name"]].append(any(s["start"] <= r["a"] and s["end"] >= r["b"] for s in own(r["secrets"])))
    recall = {k: sum(v) / len(v) for k, v in hits.items()}
    print(recall, sum(len(own(r["before"])) for r in found))
    assert len(recall) == len(forms) and min(recall.values()) > 0.8
    # the texts as they were hold no secrets but those of the patterns
    assert sum(len(own(r["before"])) for r in found) <= 2


def test_spans_are_the_best_path(spark, documents):
    from dockflow.llm import secret_scan

    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    field = secret_scan.fit(table)
    got = {r["doc_id"]: r["secrets"] for r in secret_scan.scan(table, field).collect()}
    for r in documents[:300]:
        text = r["text"] or ""
        places = [m.span() for m in secret_scan.TOKEN.finditer(text)]
        tokens, of_file = [text[a:b] for a, b in places], secret_scan.file_features(text)
        rows = [secret_scan.token_features(tokens, i, of_file) for i in range(len(tokens))]
        base = brute.base_secrets(text)
        own = [(a, 3, b) for a, b in brute.tagged_spans(field.decode(field.emissions(rows)), places)]
        own = [(a, k, b) for a, k, b in own if not any(x < b and y > a for x, _, y in base)]
        assert [(s["start"], s["kind"], s["end"]) for s in got[r["doc_id"]]] == sorted(base + own)


def test_toxicity(spark):
    import zlib

    sf_dir = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in QUERIES["op8_toxicity_kn"](spark, sf_dir).collect()}
    labels = ds.dataset(f"{sf_dir}/labels.parquet").to_table().to_pylist()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    held = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels if got[r["doc_id"]]["held_out"]]
    caught = sum(p for t, p in held if t) / sum(t for t, _ in held)
    spared = sum(1 - p for t, p in held if not t) / sum(1 - t for t, _ in held)
    # about one toxic row in twelve holds none of the words that mark the others
    assert caught > 0.88 and spared > 0.995


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    from tests.compare import compare, connect

    for sf_dir in (SF_DIR, "/root/testdata/sf0.001"):
        difference, found = compare(spark, connect(sf_dir), QUERIES[name], ORACLE[name], sf_dir)
        assert difference is None and found > 0
