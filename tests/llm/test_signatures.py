"""Every wording that a license signature matches passes its keyword and the stems."""

from __future__ import annotations

import re
from itertools import product
from re import _constants as c
from re import _parser

import pytest

from dockflow.llm import licenses


def wordings(parsed) -> list[str]:
    """All strings of a pattern, with the fewest and the most repeats of what may repeat."""
    parts = []
    for op, value in parsed:
        if op is c.LITERAL:
            parts.append([chr(value)])
        elif op is c.ANY:
            parts.append(["x"])
        elif op is c.IN:
            found = [chr(i) for kind, v in value for i in ([v] if kind is c.LITERAL else range(v[0], v[1] + 1))]
            parts.append(found[:: max(1, len(found) - 1)])
        elif op is c.BRANCH:
            parts.append([w for branch in value[1] for w in wordings(branch)])
        elif op is c.SUBPATTERN:
            parts.append(wordings(value[3]))
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            low, high, inner = value
            parts.append([w * n for w in wordings(inner) for n in sorted({low, min(int(high), max(low, 2)) if low != high else low})])
        else:
            raise ValueError(op)
    return list(map("".join, product(*parts)))


def test_every_wording_passes_its_keyword_and_the_stems():
    for rule in licenses.RULES:
        found = wordings(_parser.parse(rule.pattern))
        for text in found:
            assert re.fullmatch(rule.pattern, text), (rule, text)
            assert rule.keyword in text, (rule, text)
            assert any(s in text for s in licenses.STEMS), (rule, text)


@pytest.mark.parametrize("text, label", [
    ("For research purposes only!", "non-commercial"), ("for academic use only", "non-commercial"),
    ("for educational use only", "non-commercial"), ("for non-commercial use only", "non-commercial"),
    ("MIT No Attribution", "mit-0"), ("PSF license", "psf"),
    ("Neither the name of X nor the names of its contributors may be used to endorse or promote products derived from this software", "bsd-3-clause"),
    ("As long as you retain this notice you can do whatever you want with this stuff", "beerware"),
])
def test_wordings_alone_are_found(spark, text, label):
    df = spark.createDataFrame([(text,)], "text string")
    assert [d["label"] for d in licenses.detect(df).first()["detections"] if d["kept"]] == [label]
