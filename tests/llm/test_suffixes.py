"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from xoutcome.llm import suffixdedup, suffixes, winnow
from xoutcome.llm.queries import QUERIES

L = 400


def brute(rows):
    seen = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        seen.update(b[s:s + L] for s in range(len(b) - L + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - L + 1):
            if seen[b[s:s + L]] > 1:
                gone[s:s + L] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]) if b else b""
        out.append((str(i), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_every_document(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert found(QUERIES["op8_suffix_array"](spark, small)) == brute(rows)


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(3)

    def prose(n):
        return "".join(draw.choice("abcdeé ") for _ in range(n))
    passage, line = prose(900), prose(70)
    rows = [(i, prose(draw.choice([0, 50, 399, 900])) + passage[draw.randrange(300):] + prose(draw.randrange(200))) for i in range(30)]
    rows += [(100 + i, passage[:450] + prose(300)) for i in range(5)] + [(200, line * 30), (201, "a" * 1500), (202, prose(5000)), (203, None), (204, "")]
    rows += [(300, rows[3][1]), (300, rows[3][1]), (None, prose(500) + passage), (301, passage[:399]), (302, passage[100:500]), (303, "x" * 400)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"bucket_bytes": 2000}, {"hot_bytes": 3000}])
def test_planted_passages(spark, planted, limits, monkeypatch):
    monkeypatch.setattr(suffixdedup, "BUCKET_BYTES", limits.get("bucket_bytes", 1 << 20))
    monkeypatch.setattr(suffixdedup, "HOT_BYTES", limits.get("hot_bytes", 8 << 20))
    df = spark.createDataFrame(planted, "doc_id long, text string")
    got = suffixdedup.remove_repeats(df, **limits).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got)
    assert got == brute(planted)


def test_no_rows(spark, odd_docs):
    assert suffixdedup.remove_repeats(odd_docs.limit(0)).count() == 0
    assert found(suffixdedup.digests(odd_docs)) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])


@pytest.mark.parametrize("text", [b"", b"a", b"banana", b"mississippi", b"aaaaabaaaa", bytes(random.Random(1).choices(b"ab", k=500))])
def test_suffix_order(text):
    assert suffixes.suffix_order(text, 600).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(winnow, "PIECE", 3000)
    draw = random.Random(2)
    shared = bytes(draw.choices(b"abcdefgh", k=700))
    texts = [bytes(draw.choices(b"abcdefgh", k=k)) + shared + b"zz" for k in (0, 10, 2500, 4000)]
    anchors = []
    for k, t in enumerate(texts):
        own = {}
        for _, number, shift, first, last, at, h in winnow.runs([t]):
            for f, l, a, x in zip((first + shift).tolist(), (last + shift).tolist(), (at + shift).tolist(), h.tolist()):
                own.update({t[s:s + L]: (a - s, x) for s in range(f, l + 1)})
        assert len(t) < L or set(own) == {t[s:s + L] for s in range(len(t) - L + 1)}
        anchors.append(own)
    for w in (shared[i:i + L] for i in range(301)):
        assert len({a[w] for a in anchors}) == 1


def test_unlike_texts_under_one_id(spark):
    """The windows of one text are never cut out of another that has its id."""
    draw = random.Random(9)
    prose = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage = prose(600)
    rows = [(1, prose(50) + passage), (1, prose(700)), (2, passage), (None, prose(30) + passage), (None, prose(800))]
    assert found(suffixdedup.digests(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_other_lengths_and_runs_of_few_words(spark):
    draw = random.Random(10)
    prose = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n))
    long, short = prose(56), prose(40)
    rows = [(1, f"{prose(80)} {long} {prose(30)}"), (2, f"{prose(30)} {long} {prose(9)} {short}"), (3, f"{short} {prose(60)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in suffixdedup.rewritten(df, least_words=51, length=180, gram=60).collect()}
    assert long not in got[1] and long not in got[2] and len(got[1]) < len(rows[0][1]) - len(long) + 3 and short in got[2] and got[3] == rows[2][1]
    both = {r.doc_id: r.text for r in suffixdedup.rewritten(df, length=180, gram=60).collect()}
    assert short not in both[2] and short not in both[3]


@pytest.mark.parametrize("length", [8, 50, 180, 181, 400])
def test_windows_of_any_length(length):
    draw = random.Random(length)
    shared = bytes(draw.choices(b"abcd", k=600))
    parts = [shared[:300], shared[100:500], shared[200:], bytes(draw.choices(b"abcd", k=500)), shared[:length], shared[5:5 + length + 3]]
    seen = Counter(x[s:s + length] for x in parts for s in range(len(x) - length + 1))
    for found_, part in zip(suffixes.repeated(parts, length), parts):
        assert sorted(found_.tolist()) == [s for s in range(len(part) - length + 1) if seen[part[s:s + length]] > 1]


def test_passages_shorter_than_the_removed_strings(spark):
    """51 repeated words are told by columns of their own, and strings of 400 bytes go as before."""
    draw = random.Random(13)
    prose = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 7))) for _ in range(n))
    passage, fifty, long = prose(51), prose(50), prose(130)
    rows = [(1, f"{prose(80)} 1{passage}2 {prose(30)}"), (2, f"3{passage}4"), (3, f"{prose(9)} 5{fifty}6"), (4, f"7{fifty}8 {prose(90)}"),
            (5, f"{prose(40)} 9{long}0 {prose(5)} -{passage}+"), (6, f"2{long}4"), (7, prose(200)), (8, None), (9, f"{long}{long}"), (None, f"5{passage}7"),
            (10, "ö" * 900), (11, "x" + "ö" * 300 + prose(60)), (12, prose(300)), (12, "")]
    rows.append(rows[-2])
    assert len(passage) < 390 and len(long) > 420
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(suffixdedup.digests(df)) == brute(rows)
    got = [(r.doc_id, r.n_passages, r.n_passage_bytes) for r in suffixdedup.digests(df).collect()]
    n, m = len(passage), len(long)
    whole = len(rows[-1][1])
    assert sorted(got, key=str) == sorted([(1, 1, n), (2, 1, n), (3, 0, 0), (4, 0, 0), (5, 2, n + m), (6, 1, m), (7, 0, 0), (8, 0, 0), (9, 1, 2 * m),
                                           (None, 1, n), (10, 0, 0), (11, 0, 0), (12, 1, whole), (12, 1, whole), (12, 0, 0)], key=str)
