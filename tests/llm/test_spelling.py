"""Spelling variants against all pairs."""

import random
import zlib

import pytest

from xoutcome.llm import spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def by_hand(counts: dict[str, int]) -> set:
    out, form = {}, {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return set(out.values())


def words_by_hand(rows) -> dict[str, int]:
    counts: dict[str, int] = {}
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            c = c.lower() if "A" <= c <= "Z" else c
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= 7:
                    counts[run] = counts.get(run, 0) + 1
            run = ""
    return {w: n for w, n in counts.items() if n >= 2}


def rows_of(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("limits", [{}, {"tile": 5, "slot_rows": 40}])
def test_all_edits_are_found(spark, limits):
    """Every edit at every place, dense short alphabets, accented letters; long lists are cut into parts."""
    rng = random.Random(7)
    counts: dict[str, int] = {}
    for base in ("abababa", "aaaaaaa", "straßenbahn", "correctly", "naïvetéé"):
        counts[base] = 5000
        for at in range(len(base) + 1):
            counts.setdefault(base[:at] + "é" + base[at:], rng.choice([3, 500, 50]))
            if at < len(base):
                counts.setdefault(base[:at] + "x" + base[at + 1:], rng.choice([3, 500]))
                if len(base) > 7:
                    counts.setdefault(base[:at] + base[at + 1:], 2)
    for _ in range(400):
        counts.setdefault("".join(rng.choice("ab") for _ in range(rng.randint(7, 10))), rng.choice([2, 20, 200, 2000]))
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows_of(spelling.variants(table, **limits)) == by_hand(counts)


def test_words_of_texts(spark):
    rng = random.Random(3)
    vocabulary = ["Correctly", "correctly", "naïveté", "été", "straßenbahn", "x" * 40, "seventh", "×÷ÀÿabcZ", "short"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(60)) + ("," if i % 2 else "\n")) for i in range(80)]
    rows += [(None, "Correctly nullified nullified"), (5, None), (6, ""), (7, "12 34"), rows[0], (8, "Z" * 30_000 + " " + "Z" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as word", "text as n", "1 as root")
    found = rows_of(spelling.spelling_variants(docs))
    assert found == by_hand(words_by_hand(rows)) and len(found) > 10


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(docs).collect() == []


def test_whole_documents(spark, middle):
    from xoutcome.llm.common import table
    docs = table(spark, middle, "documents")
    counts = words_by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()])
    expected_near: dict[str, set] = {w: set() for w in counts}
    wild: dict[str, list] = {}
    for w in counts:  # a word and one of its deletions meet under the shorter text
        for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            wild.setdefault(key, []).append(w)
    for group in wild.values():
        for a in group:
            expected_near[a] |= {b for b in group if one_edit(a, b)}
    got = {r["word"]: r for r in spelling.spelling_variants(docs).collect()}
    assert got.keys() == counts.keys()
    for w, n in counts.items():
        best = min(expected_near[w], key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        assert (got[w]["n"], got[w]["n_near"], got[w]["form"]) == (n, len(expected_near[w]), form)
