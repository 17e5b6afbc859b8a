"""Benchmark items in documents against SQL and brute force."""

import random

import duckdb
import pytest

from tests.compare import connect, difference
from xoutcome.llm import decontaminate as D
from xoutcome.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_as_sql(spark, folder):
    found = QUERIES["op5_containment"](spark, folder).toArrow()
    assert difference(found, connect(folder).sql(ORACLE_SQL["op5_containment"]).to_arrow_table()) is None
    assert sum(found["contaminated"].to_pylist()) > 0


def shingles(text):
    w = (text or "").lower().split()
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_planted_items_of_all_sizes(spark, odd_docs):
    draw = random.Random(4)

    def prose(n, tag):
        return [f"{tag}{draw.randrange(10**6)}" for _ in range(n)]
    items = [(i, prose(n, f"i{i}_")) for i, n in enumerate([1, 3, 5, 6, 8, 9, 12, 40, 90, 400])] + [(50, []), (51, prose(8, "z"))]
    docs = []
    for i, words in items:
        for cut in (0, 1, len(words) // 8, len(words) // 4, len(words) // 2):
            kept = list(words)
            for _ in range(cut if kept else 0):
                kept[draw.randrange(len(kept))] = "changed" + str(draw.randrange(10**6))
            docs.append((len(docs), " ".join(prose(draw.choice([0, 30, 3000]), "d") + kept + prose(20, "e"))))
    docs += [(900, None), (901, ""), (902, docs[0][1]), (902, docs[0][1]), (None, " ".join(items[7][1]))]
    texts = [(i, " ".join(w)) for i, w in items] + [(60, None), (None, "lost words of an item without id")]
    got = sorted((str(r.doc_id), list(r.items), round(r.best_containment, 9)) for r in D.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(texts, "item_id long, text string")).collect())
    wanted = []
    for i, t in docs:
        have = shingles(t) if i is not None else set()
        share = {j: len(shingles(x) & have) / len(shingles(x)) for j, x in texts if j is not None and shingles(x)}
        hits = sorted(j for j, s in share.items() if s >= 0.75)
        wanted.append((str(i), hits, round(max([share[j] for j in hits], default=0.0), 9)))
    assert got == sorted(wanted)
    assert D.contamination(odd_docs.limit(0), spark.createDataFrame(texts, "item_id long, text string")).count() == 0
    none = D.contamination(odd_docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(none) == odd_docs.count() and not any(r.contaminated for r in none)
