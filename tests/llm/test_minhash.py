"""Near-duplicate classes against all pairs of full sets."""

import random

from xoutcome.llm import graph, minhash
from xoutcome.llm.queries import QUERIES


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_classes_of_all_documents(spark, middle):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{middle}/documents.parquet").collect()]
    assert found(QUERIES["op3_minhash"](spark, middle)) == brute(rows)


def test_chains_and_large_groups(spark):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows, words = [], list(base)
    for i in range(40):  # a chain in which neighbours are alike and the ends are not
        rows.append((i, " ".join(words)))
        at = draw.randrange(115)
        words = words[:at] + [f"c{i}"] + words[at + 1:]
    rows += [(100 + i, " ".join(base[:60] + [f"x{i}_{j}" for j in range(draw.choice([5, 10, 20, 40]))])) for i in range(60)]
    rows += [(300 + i, "the same short text") for i in range(50)] + [(400, None), (401, " "), (402, "The same  short\ttext")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", __import__("pyspark").sql.functions.lit(1))
    assert found(minhash.near_duplicates(df)) == brute(rows)


def test_tiles_find_what_stars_miss(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 4)
    draw = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:150] + [f"y{i // 2}_{j}" for j in range(45)] + [f"z{i}"])) for i in range(40)]
    draw.shuffle(rows)
    assert found(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_empty_table_and_odd_rows(spark, odd_docs):
    assert minhash.near_duplicates(odd_docs.limit(0)).count() == 0
    got = [r for r in minhash.near_duplicates(odd_docs).collect()]
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert (by[4].component_id, by[5].component_id, by[5].kept, by[1].n_shingles, by[2].kept) == (4, 4, False, 0, True)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 199: 199, 200: 199}
