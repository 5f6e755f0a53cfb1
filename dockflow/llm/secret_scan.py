"""Secret scans: fixed patterns, and a linear-chain conditional random field beside them.

The field tags tokens as begin, inside or outside of a secret from their shape, their neighbours
and features of the file. It learns from what the patterns mark on a bounded sample, and from the same
windows with other keywords, separators and values, so that either the place or the look of a value can
give it away. Viterbi decodes every token of every text.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import text_batches, written

# ---- patterns ------------------------------------------------------------------------------

#: Kinds in the order in which spans with one start are listed (fixed values).
KINDS = ("assign", "access", "hex", "crf")
_EITHER = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
ASSIGN = re.compile(
    "(" + "|".join((*map(_EITHER, ("password", "passwd", "secret", "token")), _EITHER("api") + "_?" + _EITHER("key")))
    + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: Greedy runs, so a least length in the pattern drops what a later check would drop.
ACCESS, HEX = re.compile("AKIA[A-Z0-9]{16,}"), re.compile("[0-9a-f]{24,}")
_HINTS = ("passw", "secret", "token", "api")

Span = tuple[int, int, int, int]  # start, kind, end, start of the value


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


# ---- tokens and features ---------------------------------------------------------------------

TOKEN = re.compile(r"[\w+/-]+|[^\w\s]")
#: Tokens whose neighbours see their shape or word; neighbours of other words see a plain word.
TRIGGER = re.compile(r"[0-9]|[a-z][A-Z]|[A-Za-z+/_-]{32}|(?i:passw|secret|token|api_?key|credential|bearer|passphrase|pwd)")
#: A word of lower-case letters, below 32 of them, is no trigger unless it holds one of these.
TRIGGER_WORDS = ("passw", "secret", "token", "apikey", "credential", "bearer", "passphrase", "pwd")
#: Words that announce a secret, alone or as the last part of a name; they share one context.
KEYWORD = re.compile(r"(?i)(?:\w*[_-])?(?:password|passwd|pwd|passphrase|secret|token|api_?key|credential|bearer)s?")
WINDOW = 6


_SHAPES = str.maketrans({c: "9" if c.isdigit() else "a" if c.islower() else "A" for c in map(chr, range(128)) if c.isalnum()})
_REPEAT, _LETTER = re.compile(r"(.)\1+"), re.compile(r"[^\W\d_]")


def shape(token: str) -> str:
    """Kinds of signs in order, repeats once: the letters of any script, digits and what else there is."""
    out = token.translate(_SHAPES)
    if not token.isascii():
        out = _LETTER.sub(lambda m: m[0] if m[0] in "aA" else "a", out)
    return _REPEAT.sub(r"\1", out)


def own_key(token: str) -> tuple:
    """What the token's own features depend on; few of them, as most tokens are plain words."""
    n = len(token)
    if n < 6:
        return (token.lower(), shape(token))
    if token.isalpha():
        return (min(6, n // 6), "a" if token.islower() else shape(token))
    digits = sum(map(token.count, "0123456789"))
    bits = log2(n) - sum(c * log2(c) for c in map(token.count, set(token))) / n
    only_hex = digits > 0 and not token.lower().strip("0123456789abcdef")
    return (min(6, n // 6), shape(token), -(-4 * digits // n), int(bits * 2), only_hex)


def key_features(key: tuple) -> list[str]:
    if isinstance(key[0], str):
        word, form = key
        return ["t:" + word] if len(word) == 1 and not word.isalnum() else ["s:" + form, "n:0", "w:" + word]
    n, form, *more = key
    out = ["s:" + form[:8], f"n:{n}", "c:" + "".join(sorted(set(form))), f"k:{min(8, len(form))}"]
    if more:
        out += [f"d:{more[0]}", f"e:{more[1]}", f"ne:{n}:{more[1]}", f"hex:{more[2]}"]
    return out


def _own(token: str) -> list[str]:
    return key_features(own_key(token))


def _near(token: str | None) -> str:
    if token is None:
        return "-"
    low = token.lower()
    if TRIGGER.search(token):
        return "<key>" if KEYWORD.fullmatch(token) else "#" + shape(token)[:8]
    return low if not low.isalnum() else "a"


def file_features(text: str) -> list[str]:
    """Length of the file and its share of digits and of assignment signs, in coarse steps."""
    n = max(1, len(text))
    digits = sum(map(text.count, "0123456789")) / n
    return [f"fl:{int(log2(n)) // 3}", f"fd:{min(4, int(digits * 20))}", f"fe:{min(3, text.count('='))}"]


def token_features(tokens: list[str], i: int, of_file: list[str]) -> list[str]:
    at = lambda j: _near(tokens[j]) if 0 <= j < len(tokens) else "-"
    before, two, after = at(i - 1), at(i - 2), at(i + 1)
    return ["b", *_own(tokens[i]), "p:" + before, "q:" + two + before, "r:" + at(i - 3) + two + before, "x:" + after, *of_file]


def windows(tokens: list[str], longest: int = 60) -> list[tuple[int, int]]:
    """Ranges of tokens around triggers, in pieces of ``longest``: what the field trains on."""
    out: list[list[int]] = []
    for i, token in enumerate(tokens):
        if TRIGGER.search(token):
            a, b = max(0, i - WINDOW), min(len(tokens), i + WINDOW + 1)
            if out and a <= out[-1][1]:
                out[-1][1] = b
            else:
                out.append([a, b])
    return [(i, min(b, i + longest)) for a, b in out for i in range(a, b, longest)]


# ---- the field -------------------------------------------------------------------------------

BEGIN, INSIDE, OUTSIDE = range(3)


@dataclass
class Field:
    """Weights of features per tag, and of transitions (a sequence starts and ends outside)."""

    weights: dict[str, np.ndarray]
    moves: np.ndarray

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        out, get, none = np.zeros((len(rows), 3)), self.weights.get, np.zeros(3)
        for e, row in zip(out, rows):
            for f in row:
                e += get(f, none)
        return out

    def decode(self, emissions: np.ndarray) -> list[int]:
        """Viterbi path."""
        moves = self.moves.tolist()
        score, back = moves[OUTSIDE], []
        score = [s + e for s, e in zip(score, emissions[0].tolist())] if len(emissions) else []
        for e in emissions[1:].tolist():
            best = [max(range(3), key=lambda s: score[s] + moves[s][t]) for t in range(3)]  # noqa: B023
            back.append(best)
            score = [score[best[t]] + moves[best[t]][t] + e[t] for t in range(3)]
        if not score:
            return []
        path = [max(range(3), key=lambda s: score[s] + moves[s][OUTSIDE])]
        for best in reversed(back):
            path.append(best[path[-1]])
        return path[::-1]


def train(samples: list[tuple[list[list[str]], list[int]]], rounds: int = 8, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood by stochastic gradients with adaptive steps, in the order given.

    Without samples the field has no weights and tags everything as outside. A secret cannot start
    inside: those two moves keep a large penalty.
    """
    if not samples:
        return Field({}, np.zeros((3, 3)))
    number: dict[str, int] = {"b": 0}
    windows_ = [
        (np.array([number.setdefault(f, len(number)) for row in rows for f in row]), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), tags)
        for rows, tags in samples
    ]
    weights, seen = np.zeros((len(number), 3)), np.full((len(number), 3), 1e-6)
    moves, moved = np.zeros((3, 3)), np.full((3, 3), 1e-6)
    moves[OUTSIDE, INSIDE] = -20.0
    weights[0] = [-1.0, -1.0, 1.0]
    for _ in range(rounds):
        for flat, row, tags in windows_:
            n = len(tags)
            e = np.stack([np.bincount(row, weights[flat, t], n) for t in range(3)], 1)
            gap, step = _gradient(e, moves, tags)
            # a window is one step: gradients of a feature are summed over its tokens
            used, at = np.unique(flat, return_inverse=True)
            own = np.stack([np.bincount(at, gap[row, t], len(used)) for t in range(3)], 1) - decay * weights[used]
            seen[used] += own * own
            weights[used] += rate * own / np.sqrt(seen[used])
            moved += step * step
            moves += rate * step / np.sqrt(moved)
            moves[OUTSIDE, INSIDE] = -20.0
    return Field({f: weights[i] for f, i in number.items()}, moves)


def _gradient(e: np.ndarray, moves: np.ndarray, tags: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """What the tags have more of than the field expects: per token and tag, and per move."""
    n = len(e)
    # forward and backward in probabilities scaled at every token
    p, move = np.exp(e - e.max(1, keepdims=True)), np.exp(moves)
    alpha, beta = np.empty((n, 3)), np.ones((n, 3))
    alpha[0] = move[OUTSIDE] * p[0]
    alpha[0] /= alpha[0].sum()
    beta[-1] = move[:, OUTSIDE]
    for i in range(1, n):
        a = (alpha[i - 1] @ move) * p[i]
        alpha[i] = a / a.sum()
    for i in range(n - 2, -1, -1):
        b = move @ (p[i + 1] * beta[i + 1])
        beta[i] = b / b.sum()
    gap = alpha * beta
    gap = -gap / gap.sum(1, keepdims=True)
    step = np.zeros((3, 3))
    step[OUTSIDE] += gap[0]
    step[:, OUTSIDE] += gap[-1]
    both = alpha[:-1, :, None] * move[None] * (p[1:] * beta[1:])[:, None, :]
    step -= (both / both.sum((1, 2), keepdims=True)).sum(0)
    path = [OUTSIDE, *tags, OUTSIDE]
    np.add.at(step, (path[:-1], path[1:]), 1)
    gap[np.arange(n), tags] += 1
    return gap, step


def tagged(tokens: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """Tags of token ranges by the values of spans."""
    tags = [OUTSIDE] * len(tokens)
    starts, ends = [a for a, _ in tokens], [b for _, b in tokens]
    for _, _, end, value in spans:
        first = bisect_right(ends, value)
        for i in range(first, bisect_left(starts, end)):
            tags[i] = INSIDE if i > first else BEGIN
    return tags


#: Words before a value and signs between, beyond those of the patterns (fixed values).
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey", "credential", "passphrase", "pwd")
SEPARATORS = (("=",), (":",), ("is",), ("-", ">"), ("=", ">"), ("bearer",), ())


def reworded(tokens: list[str], tags: list[int], seed: int, copies: int = 4) -> list[tuple[list[str], list[int]]]:
    """A window with one secret in other words: other keywords, separators and values.

    The value stays a secret if it still looks like one, or stands as a plain word behind a keyword and
    an assignment; a plain word behind a plain word, or behind a bare keyword, is none.
    """
    draw = random.Random(seed)
    first, last = tags.index(BEGIN), max(i for i, t in enumerate(tags) if t != OUTSIDE)
    before = [t for t in tokens[max(0, first - 8) : first] if t.isalnum() and not TRIGGER.search(t)]
    after = [t for t in tokens[last + 1 :] if not TRIGGER.search(t)]
    plain = [t for t in before + after if t.isalpha()] or ["word"]
    value = max(tokens[first : last + 1], key=len)
    telling = len(value) >= 16 and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    signs = "".join(chr(i) for i in range(48, 123) if chr(i).isalnum())
    out = []

    def add(key: str, between: tuple[str, ...], word: str, secret: bool) -> None:
        quote = [draw.choice("\"'")] if between and draw.random() < 0.5 else []
        head = [*before, key, *between, *quote]
        out.append(([*head, word, *quote, *after], [OUTSIDE] * len(head) + [BEGIN if secret else OUTSIDE] + [OUTSIDE] * len(quote + after)))

    for _ in range(copies):
        key, word, between = draw.choice(KEYWORDS), draw.choice(plain), draw.choice(SEPARATORS)
        assigned = draw.choice(SEPARATORS[:2])
        if telling:
            any_signs = "".join(draw.choices(signs, k=draw.randrange(16, 41)))
            look = draw.choice((value, value.upper(), any_signs, any_signs, word[:3].lower() + "_" + any_signs))
            add(key, between, look, True)
            add(word, draw.choice((assigned, ())), look, True)
        add(key, assigned, word, True)
        add(draw.choice(plain), assigned, word, False)
        add(key, (), word, False)
    return out


def samples_of(text: str) -> Iterator[tuple[int, list[list[str]], list[int]]]:
    """Training windows of one text: kind, features and tags.

    Kinds are 2 with a secret (as it stands and reworded), 1 around triggers without one and 0 for two
    stretches of the text, picked by its hash.
    """
    places = [m.span() for m in TOKEN.finditer(text)]
    tokens = [text[a:b] for a, b in places]
    if not tokens:
        return
    tags, of_file, seed = tagged(places, base_spans(text)), file_features(text), zlib.crc32(text.encode())
    features = lambda words, a, b: [token_features(words, i, of_file) for i in range(a, b)]
    for at in (seed % len(tokens), seed // 7 % len(tokens)):
        end = min(len(tokens), at + 24)
        if min(tags[at:end]) == OUTSIDE:
            yield 0, features(tokens, at, end), tags[at:end]
    for a, b in windows(tokens):
        hit = BEGIN in tags[a:b]
        yield 1 + hit, features(tokens, a, b), tags[a:b]
        if tags[a:b].count(BEGIN) == 1:
            for k, (t, g) in enumerate(reworded(tokens[a:b], tags[a:b], seed + a)):
                signs = f"fe:{(seed + k) % 4}"  # reworded, it could stand in a file without any assignment
                yield 2, [token_features(t, i, [*of_file[:2], signs]) for i in range(len(t))], g


class _Numbers(dict):
    """Numbers of tokens; ``new`` gives those of tokens not met before."""

    def __init__(self, new: Callable[[str], int]):
        self.new = new

    def __missing__(self, token: str) -> int:
        number = self[token] = self.new(token)
        return number


class Emitter:
    """Emissions of tokens in their places; tokens and contexts met before are looked up."""

    def __init__(self, field: Field):
        self.field = field
        self.clear()

    def clear(self) -> None:
        self.ids = _Numbers(self._token)
        self.keys: dict[tuple, int] = {}
        self.own = np.zeros((1024, 3))
        self.key_of, self.near = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.names: list[str] = []
        self.name_ids: dict[str, int] = {}
        self.after = np.zeros((1024, 3))
        self.contexts: dict[tuple[int, int, int], np.ndarray] = {}
        self._name("-")
        self.word = self._name("a")

    def _name(self, near: str) -> int:
        i = self.name_ids.get(near)
        if i is None:
            i = self.name_ids[near] = len(self.names)
            self.names.append(near)
            if i == len(self.after):
                self.after = np.concatenate([self.after] * 2)
            self.after[i] = self.field.emissions([["x:" + near]])[0]
        return i

    def _token(self, token: str) -> int:
        i = len(self.ids)
        if i == len(self.near):
            self.key_of, self.near = np.concatenate([self.key_of] * 2), np.concatenate([self.near] * 2)
        n = len(token)
        # most tokens are lower-case words, whose key and name need no search for signs or keywords
        plain = token.isalpha() and token.islower() and n < 32
        key = own_key(token) if not plain else (token.lower(), "a") if n < 6 else (min(6, n // 6), "a")
        k = self.keys.get(key)
        if k is None:
            k = self.keys[key] = len(self.keys)
            if k == len(self.own):
                self.own = np.concatenate([self.own] * 2)
            self.own[k] = self.field.emissions([["b", *key_features(key)]])[0]
        self.key_of[i] = k
        self.near[i] = self.word if plain and not self.hinted else self._name(_near(token))
        return i

    def numbers(self, piece: str) -> np.ndarray:
        """Numbers of the tokens of a piece of text."""
        low = piece.lower().replace("\u017f", "s").replace("\u0131", "i")  # signs that (?i) takes for s and i
        self.hinted = any(word in low for word in TRIGGER_WORDS)
        tokens = TOKEN.findall(piece)
        return np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))

    def __call__(self, before: np.ndarray, ids: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Emissions of ``ids`` between the (up to three) tokens before and the one after."""
        n, edge = len(ids), [0] * (3 - len(before))
        near = np.concatenate([edge, self.near[before], self.near[ids], self.near[after], [0]]).astype(np.int64)
        third, second, first, next_ = near[:n], near[1 : n + 1], near[2 : n + 2], near[4 : n + 4]
        word = self.word
        out = self.own[self.key_of[ids]] + self.after[next_]
        other = (third != word) | (second != word) | (first != word)
        out[~other] += self._context(word, word, word)
        third, second, first = third[other], second[other], first[other]
        pairs, pair = np.unique(second * len(self.names) + first, return_inverse=True)
        triples, triple = np.unique(third * len(pairs) + pair, return_inverse=True)
        found = np.empty((len(triples), 3))
        for k, code in enumerate(triples.tolist()):
            found[k] = self._context(code // len(pairs), *divmod(int(pairs[code % len(pairs)]), len(self.names)))
        out[other] += found[triple]
        return out

    def _context(self, third: int, second: int, first: int) -> np.ndarray:
        """Emission of the names of three tokens before."""
        out = self.contexts.get((third, second, first))
        if out is None:
            c, b, a = self.names[third], self.names[second], self.names[first]
            out = self.contexts[third, second, first] = self.field.emissions([["p:" + a, "q:" + b + a, "r:" + c + b + a]])[0]
        return out


def may_be_secret(e: np.ndarray, moves: np.ndarray, before: float, behind: float) -> tuple[np.ndarray, float]:
    """Tokens that a run of secrets could hold which scores no less than the same tokens outside.

    A run gains at most the sum of its tokens' gains, over its moves' largest ones; all other tokens are outside
    on the best path. ``before`` and ``behind`` are what a run may gain beyond these tokens. Also returns what
    it may gain up to the last of them.
    """
    stay = moves[OUTSIDE, OUTSIDE]
    middle = moves[:OUTSIDE, :OUTSIDE].max() - stay
    ends = moves[OUTSIDE, :OUTSIDE].max() + moves[:OUTSIDE, OUTSIDE].max() - 2 * stay - middle
    gain = e[:, :OUTSIDE].max(1) - e[:, OUTSIDE] + middle
    total = np.cumsum(gain)
    up_to = total - np.minimum(np.minimum.accumulate(np.concatenate([[0.0], total[:-1]])), -before)
    rest = np.maximum.accumulate(np.concatenate([total, [total[-1] + behind]])[::-1])[::-1]
    from_here = rest[:-1] - total + gain
    return up_to + from_here - gain + ends >= -1e-9, max(0.0, up_to[-1])


def ahead(e: np.ndarray, moves: np.ndarray) -> float:
    """What a run may gain from tokens behind; unbounded where it gains up to the last of them."""
    total = np.cumsum(e[:, :OUTSIDE].max(1) - e[:, OUTSIDE] + moves[:OUTSIDE, :OUTSIDE].max() - moves[OUTSIDE, OUTSIDE])
    return np.inf if total.argmax() == len(total) - 1 and total[-1] > 0 else max(0.0, total.max())


_BLANK = re.compile(r"\s")


def pieces(text: str, size: int) -> Iterator[tuple[int, str]]:
    """The text in pieces that end at a blank, which no token holds, with their places."""
    at = 0
    while at < len(text):
        found = _BLANK.search(text, at + size)
        end = found.end() if found else len(text)
        yield at, text[at:end]
        at = end


def emissions(text: str, emit: Emitter, size: int) -> Iterator[tuple[int, str, np.ndarray]]:
    """Place, text and emissions of the pieces of a text that hold tokens."""
    of_file = emit.field.emissions([file_features(text)])[0]
    parts = ((at, piece, ids) for at, piece in pieces(text, size) if len(ids := emit.numbers(piece)))
    before, held = np.zeros(0, np.int64), next(parts, None)
    while held:
        coming = next(parts, None)
        at, piece, ids = held
        yield at, piece, emit(before, ids, coming[2][:1] if coming else ids[:0]) + of_file
        before, held = np.concatenate([before, ids])[-3:], coming


def field_spans(text: str, emit: Emitter, size: int = 1_000_000) -> list[tuple[int, int]]:
    """Code point ranges that the field tags as secrets on the best path through the whole text.

    Tokens that cannot be secrets split the path into short runs; pieces of about ``size`` characters only bound
    the memory.
    """
    if not emit.field.weights:
        return []
    if len(emit.ids) > 200_000:  # a cache, so emptying it changes nothing
        emit.clear()
    moves, done, last, before = emit.field.moves, 0, -2, 0.0
    runs: list[tuple[list[np.ndarray], list[tuple[int, int]]]] = []
    scored = emissions(text, emit, size)
    held = next(scored, None)
    while held:
        coming = next(scored, None)
        start, piece, e = held
        may, before = may_be_secret(e, moves, before, ahead(coming[2], moves) if coming else 0.0)
        if may.any():
            for i, m in enumerate(TOKEN.finditer(piece)):
                if may[i]:
                    if done + i != last + 1:
                        runs.append(([], []))
                    runs[-1][0].append(e[i])
                    runs[-1][1].append((start + m.start(), start + m.end()))
                    last = done + i
        done, held = done + len(e), coming
    out = []
    for rows, places in runs:
        before_tag = OUTSIDE
        for tag, (a, b) in zip(emit.field.decode(np.array(rows)), places):
            if tag == BEGIN or tag == INSIDE and before_tag == OUTSIDE:
                out.append([a, b])
            elif tag == INSIDE:
                out[-1][1] = b
            before_tag = tag
    return [(a, b) for a, b in out]


def all_spans(text: str | None, emit: Emitter | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, and of the field where it overlaps none of theirs."""
    if not text:
        return []
    base = [(a, k, b) for a, k, b, _ in base_spans(text)]
    added = []
    if emit is not None:
        # both lists rise, but base spans may hold each other: furthest end of those before
        far = np.maximum.accumulate([b for _, _, b in base]) if base else []
        starts = [a for a, _, _ in base]
        for a, b in field_spans(text, emit):
            k = bisect_left(starts, b)
            if not k or far[k - 1] <= a:
                added.append((a, KINDS.index("crf"), b))
    return sorted(base + added)


# ---- on Spark --------------------------------------------------------------------------------


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", documents: int = 6000, most: int = 2000) -> Field:
    """A field from a sample of about ``documents`` rows (by hash of key and text).

    At most ``most`` training windows are used: half of them with secrets, as they stand and reworded, a quarter
    around triggers without one, a quarter from anywhere; of one text the first 200. All three bounds are
    for training only; the scan reads everything.
    """
    text_batches(df.sparkSession)
    rows = df.select(F.xxhash64(F.lit(5), F.col(key), F.col(text)).alias("h"), F.col(text).alias("t")).where("t IS NOT NULL")
    n = rows.count()
    share = min(1.0, documents / max(1, n))
    sampled = rows.where(F.pmod("h", F.lit(1_000_003)) < F.lit(int(1_000_003 * share) or 1)) if share < 1 else rows

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for h, t in zip(frame["h"], frame["t"]):
                for i, (kind, features, tags) in enumerate(islice(samples_of(t), 200)):
                    out.append((h, i, kind, ["\n".join(f) for f in features], tags))
            yield pd.DataFrame(out, columns=["h", "i", "kind", "features", "tags"])

    found = written(
        sampled.mapInPandas(cut, "h long, i int, kind int, features array<string>, tags array<int>"), "windows"
    )
    picked = []
    for kind, part in ((0, 4), (1, 4), (2, 2)):
        got = found.where(F.col("kind") == kind).orderBy(F.pmod("h", F.lit(1 << 20)), "h", "i").limit(most // part).collect()
        picked += [(zlib.crc32(f"{r['h']}:{r['i']}".encode()), r["h"], r["i"], r) for r in got]
    picked.sort(key=lambda x: x[:3])
    return train([([f.split("\n") for f in r["features"]], list(r["tags"])) for _, _, _, r in picked])


def scan(df: DataFrame, field: Field, text: str = "text", name: str = "secrets") -> DataFrame:
    """``df`` with the secrets of ``text``: array of (start, kind, end), in order of start and kind.

    ``kind`` is the number in ``KINDS``; positions are code points, the end exclusive. A null or empty text
    has none. The patterns' spans are always there; the field's are added where they overlap none.
    """
    text_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(field)  # bounded by the training windows

    @F.pandas_udf("array<struct<start:int,kind:int,end:int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Emitter(shared.value)
        for batch in batches:
            yield pd.Series([
                [{"start": a, "kind": k, "end": b} for a, k, b in all_spans(t, own)] for t in batch
            ], dtype=object)

    return df.withColumn(name, find(F.col(text)))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redacted(df: DataFrame, field: Field, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``mark``; spans that touch or overlap become one mark."""
    text_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(field)

    def cut(t: str | None, own: Emitter) -> str | None:
        out, at = [], 0
        for a, _, b in all_spans(t, own):
            if a > at or not out:
                out += [t[at:a], mark]
            at = max(at, b)
        return t if not out else "".join(out) + t[at:]

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Emitter(shared.value)
        for batch in batches:
            yield pd.Series([cut(t, own) for t in batch], dtype=object)

    return df.withColumn(text, clean(F.col(text)))
