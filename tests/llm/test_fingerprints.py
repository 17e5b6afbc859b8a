"""Edited texts exactly, likeness against the generalised Jaccard similarity."""

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from xoutcome.llm import fingerprints as P
from xoutcome.llm.queries import QUERIES


def jaccard(x, y):
    a, b = Counter(x.encode().split()), Counter(y.encode().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def check(rows, got):
    rows = sorted(rows)
    near = []
    assert len(rows) == len(got)
    for k, (i, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1] or "", len(text or "") // 2
        edited = (text or "")[:len(text or "") - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(text or "") and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        near += [(r.near_edited, jaccard(text or "", edited), len(text or "")), (r.near_next, jaccard(text or "", after), len(text or ""))]
    return near


def test_all_documents(spark, middle):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{middle}/documents.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op4_weighted_sampling"](spark, middle).collect()}
    near = np.array([(a, b) for a, b, n in check(rows, got) if n > 600])
    error = near[:, 0] - near[:, 1]
    assert abs(error.mean()) < 0.01 and np.sqrt((error ** 2).mean()) < 0.07
    by_text = {}
    for i, t in rows:
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint


def test_odd_texts(spark, odd_docs):
    rows = [(1, None), (2, ""), (3, "ä ö ü"), (4, "ä ö ü"), (5, "one"), (7, "long " * 40_000), (9, "\U0001f600 b")]
    got = {r.doc_id: r for r in P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    check(rows, got)
    assert got[1].near_next == 1.0 and got[3].near_next == 1.0 and got[2].near_next == 0.0
    assert got[3].fingerprint == got[4].fingerprint and got[1].fingerprint == got[2].fingerprint
    assert P.fingerprints(odd_docs).count() == odd_docs.count()
    assert P.fingerprints(odd_docs.limit(0)).count() == 0
    one = P.fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()


def test_weights_count(spark):
    rows = [(1, "x " * 30 + "y " * 10 + " ".join(f"a{i}" for i in range(500))), (2, "x " * 10 + "y " * 30 + " ".join(f"a{i}" for i in range(250, 750)))]
    got = {r.doc_id: r for r in P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert abs(got[1].near_next - jaccard(rows[0][1], rows[1][1])) < 0.25


def test_skewed_weights(spark):
    """A heavy term has its whole weight: estimates over many differently named texts against the exact value."""
    def words(tag, n):
        return " ".join(f"{tag}_{i}" for i in range(n))

    def case(kind, k):
        if kind == 0:  # one word 1000 times against once, with 63 shared words
            shared = words(f"s{k}", 63)
            return f"h{k} " * 1000 + shared, f"h{k} " + shared
        if kind == 1:  # one word 5000 times in both, with 300 unlike words each
            return f"h{k} " * 5000 + words(f"a{k}", 300), f"h{k} " * 5000 + words(f"b{k}", 300)
        line, shared = words(f"l{k}", 10) + " ", words(f"s{k}", 200)  # a line 500 against 100 times, with 200 shared words
        return line * 500 + shared, line * 100 + shared
    pairs = [(kind, case(kind, k)) for kind in range(3) for k in range(20)]
    rows = [(i, x, y) for i, (_, (x, y)) in enumerate(pairs)]
    made = P.sampled(spark.createDataFrame(rows, "block long, x string, y string").repartition("block"), ["block"], ["x", "y"])
    got = {r.block: r.near for r in made.select("block", P.likeness(made["fp_x"], made["fp_y"]).alias("near")).collect()}
    for kind in range(3):
        error = np.array([got[i] - jaccard(*p) for i, (k, p) in enumerate(pairs) if k == kind])
        assert abs(error.mean()) < 0.04 and np.abs(error).max() < 0.3, kind


def test_texts_are_shuffled_once(spark, small, monkeypatch):
    plans, real = {}, P.stored

    def told(df, name):
        out = real(df, name)
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return out
    monkeypatch.setattr(P, "stored", told)
    QUERIES["op4_weighted_sampling"](spark, small)
    lines = [x.strip(" :+-|") for x in plans["fingerprints"].splitlines()]
    below = [lines[i + 1:] for i, x in enumerate(lines) if x.startswith("RepartitionByExpression")]
    shapes = {tuple(x.split(" ")[0] for x in part[:part.index(next(y for y in part if y.startswith("Relation"))) + 1]) for part in below}
    assert len(below) == 2 and len(shapes) == 1, shapes  # both sides alike, so that Spark reuses the exchange


def test_a_term_makes_few_rows_and_is_hashed_once_in_each(spark):
    """A search for its group by each row, and hashes over term and numbers for each draw, were over the CPU budget."""
    made = P.sampled(spark.createDataFrame([(1, "a b b")], "block long, x string").repartition("block"), ["block"], ["x"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(term") == 1 and "explode([0,1,2,3,4,5,6,7])" in plan, plan


def test_draws_are_independent_and_uniform(spark):
    """Gamma(2, 1) and uniform draws of all samples of a row, by their means, and by each pair's correlation."""
    rows = spark.range(4000).select(F.xxhash64("id").alias("hash"))
    draws = np.array(rows.select(*[u for i in range(3 * P._IN_ROW) for u in P._uniforms(F.col("hash"), i)]).collect())
    assert np.abs(draws.mean(axis=0) - 0.5).max() < 0.025 and np.abs(draws.var(axis=0) - 1 / 12).max() < 0.008
    assert np.abs(np.corrcoef(draws.T) - np.eye(draws.shape[1])).max() < 0.09
