"""The language model against a plain implementation over dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from xoutcome.llm import katz
from xoutcome.llm.queries import QUERIES


def plain(rows):
    docs = [(i, [*(t or "").encode().lower().split(), b"</s>"]) for i, t in rows]
    train = [w for i, w in docs if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    c1 = Counter(x for w in train for x in w)
    n, v = sum(c1.values()), len(c1)
    c2 = defaultdict(Counter)
    for w in train:
        for h, x in zip([b"</s>", *w], w):
            c2[h][x] += 1
    times = Counter(c for s in c2.values() for c in s.values())
    d = katz.discounts({r: times[r] for r in range(1, 6)}, times[6])
    p1 = lambda x: (c1[x] + 1) / (n + v + 1)

    known = {}
    for h, s in c2.items():
        total, seen = sum(s.values()), sum(d[min(c, 6)] * c for c in s.values())
        total += seen >= total * (1 - 1e-12)
        known[h] = total, (1 - seen / total) / (1 - sum(map(p1, s)))

    def p(x, h):
        if h not in c2:
            return p1(x)
        c = c2[h].get(x, 0)
        return d[min(c, 6)] * c / known[h][0] if c else known[h][1] * p1(x)
    for h in sorted(c2, key=lambda h: -len(c2[h]))[:5]:
        assert abs(sum(p(x, h) for x in [*c1, b"<unknown>"]) - 1) < 1e-9

    def score(w):
        return sum(math.log10(p(x, h)) for h, x in zip([b"</s>", *w], w))
    return {i: (zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(c1[x] > 0 for x in w), n, sum(math.log10(p1(x)) for x in w), score(w)) for i, w in docs}


def compare(rows, got):
    wanted = plain(rows)
    assert len(got) == len(rows)
    for r in got:
        w = wanted[r.doc_id]
        assert (r.held_out or r.doc_id is None, r.n_tokens, r.n_known, r.train_tokens) == (w[0] or r.doc_id is None, *w[1:4])
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r.score, w[5], rel_tol=1e-9, abs_tol=1e-9), (r, w)


@pytest.mark.parametrize("block", [8 << 20, 20_000])
def test_every_document(spark, small, block, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_BYTES", block)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = QUERIES["op6_katz"](spark, small).collect()
    compare(rows, got)
    assert sum(r.score > r.base_score for r in got) > 0.9 * len(got)


def test_odd_texts(spark, odd_docs):
    rows = [(i, "a b a c a b") for i in range(20)] + [(50, None), (51, ""), (52, "A\tB new"), (None, "a b"), (53, "x " * 5000), (53, "x " * 5000)]
    got = katz.language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    compare(rows, got)
    assert katz.language_model_scores(odd_docs.limit(0)).count() == 0
    alone = katz.language_model_scores(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert (alone[0].score, alone[0].n_known, alone[0].train_tokens) == (0.0, 0, 0)


def by_recursion(rows, order):
    """Scores of an n-gram model over dictionaries, each probability by recursion to the shorter history."""
    docs = [(i, [*(t or "").encode().lower().split(), b"</s>"]) for i, t in rows]
    train = [w for i, w in docs if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    c1 = Counter(x for w in train for x in w)
    total = sum(c1.values()) + len(c1) + 1
    grams = {k: defaultdict(Counter) for k in range(1, order)}  # by number of words in the history

    def histories(w, k):
        padded = [b"</s>"] * k + w
        return [tuple(padded[i:i + k]) for i in range(len(w))]
    for k, of in grams.items():
        for w in train:
            for h, x in zip(histories(w, k), w):
                of[h][x] += 1
    d = {}
    for k, of in grams.items():
        times = Counter(c for s in of.values() for c in s.values())
        d[k] = katz.discounts({r: times[r] for r in range(1, 6)}, times[6])
    known = {}

    def p(x, h):
        if not h:
            return (c1[x] + 1) / total
        k, seen = len(h), grams[len(h)].get(h)
        if seen is None:
            return p(x, h[1:])
        if h not in known:
            whole, less = sum(seen.values()), sum(d[k][min(c, 6)] * c for c in seen.values())
            whole += less >= whole * (1 - 1e-12)
            known[h] = whole, (1 - less / whole) / (1 - sum(p(y, h[1:]) for y in seen))
        c = seen.get(x, 0)
        return d[k][min(c, 6)] * c / known[h][0] if c else known[h][1] * p(x, h[1:])
    for h in sorted(grams[order - 1], key=lambda h: -len(grams[order - 1][h]))[:3]:
        assert abs(sum(p(x, h) for x in [*c1, b"<unknown>"]) - 1) < 1e-9
    return [(i, sum(math.log10(p(x, h)) for h, x in zip(histories(w, order - 1), w))) for i, w in docs]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_backs_off_through_all_orders(spark, small, order, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 20_000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows += [(10**6 + i, "a b c a b d a b c a") for i in range(40)] + [(2 * 10**6, None), (2 * 10**6 + 1, "x " * 3000)]
    got = katz.language_model_scores(spark.createDataFrame(rows, "doc_id long, text string"), order=order).collect()
    wanted = dict(by_recursion(rows, order))
    assert len(got) == len(rows)
    assert all(math.isclose(r.score, wanted[r.doc_id], rel_tol=1e-9, abs_tol=1e-9) for r in got)
    scores = katz.language_model_scores(spark.createDataFrame([(7, "x y"), (7, "x y"), (8, "x y")], "doc_id long, text string"), order=order)
    again = dict(by_recursion([(7, "x y"), (7, "x y"), (8, "x y")], order))
    assert all(math.isclose(r.score, again[r.doc_id], rel_tol=1e-9) for r in scores.collect())
