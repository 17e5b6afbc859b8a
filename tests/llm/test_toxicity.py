"""Segments against brute force, scores against held-out labels."""

import random

import numpy as np
import pytest

from xoutcome.llm import toxicity as T
from xoutcome.llm.queries import QUERIES


def brute(values):
    """All maximal segments by the recursive definition: the best one, then left and right of it."""
    best = None
    for a in range(len(values)):
        for b in range(a, len(values)):
            s = sum(values[a:b + 1])
            if s > 1e-9 and (best is None or s > best[2] + 1e-9):
                best = (a, b, s)
    if best is None:
        return []
    a, b, _ = best
    return brute(values[:a]) + [best] + [(x + b + 1, y + b + 1, s) for x, y, s in brute(values[b + 1:])]


@pytest.mark.parametrize("seed", range(12))
def test_segments(seed):
    draw = random.Random(seed)
    values = [draw.choice([-1.0, -1.0, -1.0, draw.uniform(0.3, 4)]) for _ in range(30)]
    found = T.maximal_segments([(i, v) for i, v in enumerate(values) if v > 0], 1.0)
    assert [(a, b, round(s, 6)) for a, b, s in found] == [(a, b, round(s, 6)) for a, b, s in brute(values)]


def test_held_out_labels(spark, middle):
    got = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, middle).collect()}
    labels = [r for r in spark.read.parquet(f"{middle}/labels.parquet").collect() if got[r.doc_id].held_out]
    clean = [r for r in labels if not r.toxic]
    assert len(got) == 1000 and sum(got[r.doc_id].predicted for r in clean) <= 0.02 * len(clean)
    right = [got[r.doc_id].predicted == r.toxic for r in labels]
    assert sum(right) >= 0.93 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_passages_and_odd_rows(spark, odd_docs):
    docs = [(i, ("nice calm words here " * 20 + ("you utter scumbags " if i % 3 == 0 else ""))) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = T.fit(df, labels)
    for r in T.score(df, model).collect():
        assert (r.score >= 0.5) == (r.doc_id % 3 == 0)
        assert bool(r.passages) == (r.doc_id % 3 == 0)
        for p in r.passages:
            assert "scumbag" in docs[r.doc_id][1][p.begin:p.end]
    assert T.score(odd_docs, model).count() == odd_docs.count()
    assert T.score(odd_docs.limit(0), model).count() == 0
    none = T.fit(df, labels.limit(0))
    assert {round(r.score, 6) for r in T.score(odd_docs, none).collect()} == {0.5}


def test_many_weak_hits_in_a_falling_text():
    """Each hit starts below all before it, and nothing merges: 20,000 of them take no quadratic time."""
    import time
    start = time.perf_counter()
    found = T.maximal_segments([(10 * i, 1.0) for i in range(20_000)], 1.0)
    assert len(found) == 20_000 and time.perf_counter() - start < 1.0


def test_one_word_does_not_speak_for_its_first_letters(spark):
    calm = ["pathway", "pattern", "patience", "patrol"]
    docs = [(i, f"{calm[i % 4]} {calm[i % 3]} words " * 8 + ("pathetic " if i % 3 == 0 else "")) for i in range(240)]
    docs += [(1000 + i, f"words pathos{chr(97 + i)} words") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "doc_id as score", "text as passages")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)], "doc_id long, toxic int")
    model = T.fit(df.select("doc_id", "text"), labels)
    assert all((r.score >= 0.5) == (r.doc_id < 240 and r.doc_id % 3 == 0) for r in T.score(df, model).collect())


@pytest.mark.parametrize("last_clean", range(13))
def test_curve_of_kinds_that_evidence_tells_apart(last_clean):
    """Whole Newton steps threw the curve to a slope of 0 for some of these, so that no text was predicted toxic."""
    x = np.arange(90.0)
    n = np.where(x == 0, 14_000.0, 12.0)
    base, slope = T._logistic(x, n, np.where(x > last_clean, n, 0.0))
    predicted = base + slope * x >= 0
    assert (predicted == (x > last_clean)).all()
