"""Ranked search against scores of all documents."""

import math
import random
import re

import numpy as np
import pytest

from xoutcome.llm import ranked
from xoutcome.llm.common import table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_by_hand(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, k=20):
    docs = [(i, terms_by_hand(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    n, total = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, t in docs:
            m = 100 - 25 + (25 * len(t) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * t.count(w)) // (1000 * t.count(w) + 12 * m))
                        for w in terms_by_hand(text) if w in df)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_terms():
    text = "Ünïcode's A1b2 x\x00end ÀB-c_d\x7fé"
    assert [t.decode() for t in ranked.terms(text.encode())] == terms_by_hand(text)


@pytest.mark.parametrize("item_bytes,k", [(ranked.ITEM_BYTES, 20), (30, 3)])
def test_small_corpus(spark, monkeypatch, item_bytes, k):
    """Ties, repeats, nulls, frequent terms; with small blocks of items, too."""
    rng = random.Random(5)
    words = ["the", "The", "rare", "räre", "x1", "of", "and"] + [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, [30, 9, 1, 1, 2, 20, 20] + [1] * 40, k=rng.randint(1, 60)))) for i in range(300)]
    docs += [(500, None), (501, ""), (502, "?! \n"), (None, "rare w1 w2"), (None, "rare w1 w2"), docs[3], docs[3], (503, "the " * 20_000), (504, "Rare-rare")]
    items = [(1, "the rare w1 w1 x1"), (2, "of the and"), (2, "w7 unknown"), (3, None), (4, "nothingelse"), (5, "the"), (1, "the rare w1 w1 x1"), (6, "räre W3 the w4 w5")]
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "text as rank").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 as doc_id")
    got = ranked.search(a, b, k, item_bytes=item_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(docs, items, k)


def test_accumulators_are_refused():
    """Beyond the bound no document gets an accumulator, and the results are those of all documents."""
    rng = np.random.default_rng(3)
    docs, n = 4000, 4000
    term, doc, tf = [], [], []
    for t, share in enumerate((0.005, 0.01, 0.5, 0.9, 0.95)):
        own = np.flatnonzero(rng.random(docs) < share)
        term += [t] * len(own)
        doc += own.tolist()
        tf += rng.integers(1, 4, len(own)).tolist()
    lengths = rng.integers(20, 200, docs)
    block = ranked.Block(np.arange(docs), lengths, *(np.array(x, "<u4") for x in (term, doc, tf)), n, int(lengths.sum()))
    wanted = [(t, ranked.weight(n, term.count(t))) for t in range(5)]
    ids, scores, refused = block.scores(wanted, 0, 20)
    every = np.zeros(docs, np.int64)
    np.add.at(every, block.doc, np.array([w for _, w in wanted])[np.array(term)] * block.share)
    best = np.lexsort((np.arange(docs), -every))[:20]
    mine = np.lexsort((ids, -scores))[:20]
    assert refused > docs / 2 and ids[mine].tolist() == best.tolist() and scores[mine].tolist() == every[best].tolist()
    assert len(block.scores(wanted, int(every.max()) + 1, 20)[0]) == 0


def test_empty_tables(spark, small):
    docs, items = table(spark, small, "documents"), table(spark, small, "benchmark")
    assert ranked.search(docs.limit(0), items).collect() == []
    assert ranked.search(docs, items.limit(0)).collect() == []


def test_same_as_sql(spark, middle):
    from tests.compare import connect, difference
    from xoutcome.llm.queries import ORACLE_SQL, QUERIES
    for name in ("op13_limited_accumulators",):
        assert difference(QUERIES[name](spark, middle).toArrow(), connect(middle).sql(ORACLE_SQL[name]).to_arrow_table()) is None
