from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# Python workers import the package by name.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

DOC = "doc_id long, text string, lang string, source string, n_chars long, k int, n string, h string, start string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text[, lang, source]); further columns have names that operators use inside."""

    def make(rows):
        full = [(i, t, *(rest or ("en", "s0")), None if t is None else len(t), 1, "n", "h", "s") for i, t, *rest in [(r[0], r[1], *r[2:]) for r in rows] for rest in [tuple(rest)]]
        return spark.createDataFrame(full, DOC)

    return make


LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(70))
#: Nulls, empty and blank texts, a very long one, ties, repeated rows and ids, copies, near copies, other scripts.
EDGES = [
    (1, None), (2, ""), (3, " \t\n\x0b"), (4, "one"), (5, "A b C d e f g h i j k l."), (6, "a B c d e f g h i j k l."),
    (7, LONG), (8, LONG + " tail"), (9, PASSAGE), (10, "before " + PASSAGE + " after"), (10, "before " + PASSAGE + " after"),
    (10, "same id, other text " + PASSAGE), (None, PASSAGE + " no id"), (None, None), (11, "x" * 5000), (12, "x" * 450),
    (13, "ab" * 700), (14, "déjà vu – 日本語 \U0001f600 " * 30), (15, "double  blanks \n\n and \r\n ends "), (-5, PASSAGE + " negative id"),
    (16, "don't stop now ok\x1fend"),
]


@pytest.fixture(params=["edges", "empty", "one"])
def small(request, docs_of):
    rows = {"edges": EDGES, "empty": [], "one": [(3, "just a few words of one document here, ten words.")]}[request.param]
    return rows, docs_of(rows)
