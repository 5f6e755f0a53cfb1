"""Plain Python versions of the contracts, to hold the queries against on small tables."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import combinations

import numpy as np
import xxhash

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
BLANKS = r"[^\x20\x09-\x0D]+"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def groups(n: int, links: list[tuple[int, int]]) -> list[int]:
    """Smallest member of each item's component."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def cosine_links(ids: list, vectors: list, threshold: float = 0.9) -> dict:
    good = [
        i for i, v in enumerate(vectors)
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for a, b in combinations(good, 2):
        x, y = (np.array(vectors[i], np.float64) for i in (a, b))
        if len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
            links.append((a, b))
    count = Counter(i for link in links for i in link)
    part = groups(len(ids), links)
    least = defaultdict(list)
    for i, p in enumerate(part):
        least[p].append(ids[i])
    return {i: (count[k], min(least[part[k]])) for k, i in enumerate(ids)}


def simhash(text: str | None, width: int = 3) -> int:
    words = re.findall(BLANKS, (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or (
        [" ".join(words)] if words else []
    )
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(ids: list, prints: list[int], bits: int = 3) -> list:
    p = np.array(prints, np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(p[:, None] ^ p[None, :]) <= bits, 1))
    part = groups(len(ids), [tuple(x) for x in near.tolist()])
    least = {}
    for i, g in zip(ids, part):
        least[g] = min(least.get(g, i), i)
    return [least[g] for g in part]


def _chained(values: list[int]) -> int:
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def syncmers(text: str, k: int = 8, s: int = 2) -> list[int]:
    import regex

    single = r"\u2e80-\u2fdf\u3005-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
    token = rf"[[\p{{L}}\p{{M}}\p{{N}}]--[{single}]]{{1,8}}|[{single}]"
    found = regex.findall(token, text.lower(), regex.V1)
    if not found and re.search(r"[^ \t\n\x0b\f\r]", text):
        found = [text.lower()]  # other signs only: one token
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    h = [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in found]
    if len(h) < k:
        return [_chained(h)] if h else []
    runs = [_chained(h[i : i + s]) for i in range(len(h) - s + 1)]
    w = k - s + 1
    out = []
    for i in range(len(h) - k + 1):
        part = runs[i : i + w]
        if min(part) in (part[0], part[-1]):
            out.append(_chained(h[i : i + k]))
    return out or [_chained(h)]


def shown(anchors: list[int]) -> str:
    return "".join(f"{(a & (1 << 64) - 1) >> 32:08x}" for a in anchors)


def likeness(a: list[int], b: list[int]) -> float:
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    """Targets by source; ``sizes`` by source, None last."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        room = budget - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in free)
        new = {s for s in free if room * weight[s] / total > most * sizes[s]} if total else set()
        if not new:
            return {s: most * sizes[s] if s in full else room * weight[s] / total for s in names}
        full |= new


def words(text: str | None) -> int:
    return len(re.findall(BLANKS, text or ""))


@lru_cache
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


BASE = (
    ("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
     r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


def base_secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) in order."""
    return sorted(
        (m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m)
    )


def tagged_spans(tags: list[int], places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of secrets: 0 begins one, 1 goes on with it or begins one behind 2."""
    out, before = [], 2
    for tag, (a, b) in zip(tags, places):
        if tag == 0 or tag == 1 and before == 2:
            out.append([a, b])
        elif tag == 1:
            out[-1][1] = b
        before = tag
    return [(a, b) for a, b in out]


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def base_licenses(text: str | None) -> tuple[int, list[tuple[int, str]]]:
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [
        (i, label) for phrase, label in PHRASES.items() for i in range(len(found))
        if found[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(found), sorted(places)


def detections(text: str | None, rules) -> list[tuple]:
    """(start, end, rule, kept) of all signatures, every one tried, all pairs compared."""
    words = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
    found = []
    for i, r in enumerate(rules):
        if r.keyword not in words:
            continue
        for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", words):
            start = words.count(" ", 0, m.start())
            found.append((start, start + m[0].count(" ") + 1, i, r.priority))
    found.sort(key=lambda d: (d[0], -d[1], d[3], d[2]))
    out = []
    for a, b, i, p in found:
        covered = any(
            x <= a and y >= b and (q < p or q == p and ((y - x) > (b - a) or j < i))
            for x, y, j, q in found if j != i or (x, y) != (a, b)
        )
        out.append((a, b, i, not covered))
    return out
