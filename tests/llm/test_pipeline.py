"""Each stage of the pipeline against brute force on its own input."""

import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_containment import shingles
from tests.llm.test_minhash import brute as classes
from tests.llm.test_suffixes import Counter
from xoutcome.llm import bpe, toxicity
from xoutcome.llm.common import texts
from xoutcome.llm.words import vocabulary_path


def test_stages(spark, small):
    read = lambda name: spark.read.parquet(f"{small}/{name}.parquet")
    docs = read("documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "decontaminate", "bpe"]
    rows = {r.doc_id: r for r in docs.collect()}

    docs = stages["toxicity"](spark, docs, small)
    bad = {r.doc_id for r in toxicity.toxicity(read("documents"), read("labels")).collect() if r.predicted}
    rows = {i: r for i, r in rows.items() if i not in bad}
    assert {r.doc_id: r for r in docs.collect()} == rows and docs.columns == read("documents").columns

    docs = stages["near_dedup"](spark, docs, small)
    kept = {i for i, c in classes([(i, r.text) for i, r in rows.items()]).items() if c[2]}
    rows = {i: r for i, r in rows.items() if i in kept}
    assert {r.doc_id: r for r in docs.collect()} == rows

    docs = stages["suffix_dedup"](spark, docs, small)
    data = {i: r.text.encode() for i, r in rows.items()}
    L = corpus_pipeline.PASSAGE_BYTES
    seen = Counter(b[s:s + L] for b in data.values() for s in range(len(b) - L + 1))
    wanted = {}
    for i, b in data.items():
        stay = np.ones(len(b), bool)
        for s in range(len(b) - L + 1):
            if seen[b[s:s + L]] > 1:
                stay[s:s + L] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[True], stay, [True]]).astype(int)))
        for first, last in zip(edges[::2], edges[1::2]):  # runs of 50 words and fewer stay
            stay[first:last] = len(b[first:last].split()) < 51
        wanted[i] = np.frombuffer(b, np.uint8)[stay].tobytes().decode("utf-8", "ignore")
    got = {r.doc_id: r for r in docs.collect()}
    assert {i: r.text for i, r in got.items()} == wanted and all(r.n_chars == len(r.text) for r in got.values())
    assert all((r.lang, r.source) == (rows[i].lang, rows[i].source) for i, r in got.items())

    docs = stages["decontaminate"](spark, docs, small)
    items = [s for s in (shingles(r.text) for r in read("benchmark").collect()) if s]
    clean = {i for i, t in wanted.items() if not any(len(s & shingles(t)) >= 0.75 * len(s) for s in items)}
    assert {r.doc_id for r in docs.collect()} == clean

    tokenizer = Tokenizer.from_file(vocabulary_path())
    for r in stages["bpe"](spark, docs, small).collect():
        ids = tokenizer.encode(wanted[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_repeated_rows_and_rows_without_id(spark, small, odd_docs):
    draw = np.random.default_rng(8)

    def prose(n):
        return " ".join(f"w{i}" for i in draw.integers(0, 10**6, n))
    item = max((r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()), key=lambda t: len(t or ""))
    twice, lost, under_two, other, leaked = (prose(120) for _ in range(5))
    more = [(20, twice, 1), (20, twice, 1), (None, lost, 1), (None, lost, 1), (21, under_two, 1), (21, other, 1), (22, under_two, 1),
            (None, f"{leaked} {item}", 1)]
    rows = odd_docs.union(spark.createDataFrame(more, odd_docs.schema))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        rows = corpus_pipeline.stored(stage(spark, rows, small), name)
        assert rows.columns == odd_docs.columns
    got = sorted(((r.doc_id, r.text) for r in rows.collect()), key=str)
    kept = [(r.doc_id, r.text) for r in odd_docs.where("doc_id is null or doc_id not in (6, 7)").collect()] + [(6, "a b c d e f")]
    assert [g for g in got if g[0] != 7] == sorted(
        [k for k in kept if k[0] != 5] + [(20, twice), (None, lost), (21, under_two), (21, other)], key=str)
    last = corpus_pipeline.encode(spark, rows, small)
    assert last.count() == rows.count()


def test_passages_of_short_words_and_in_short_texts(spark, odd_docs):
    """Passages of 51 words go whatever their bytes and the size of their texts; 50 words stay."""
    draw = np.random.default_rng(11)

    def prose(n, letters):
        return " ".join("".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), draw.integers(1, letters + 1))) for _ in range(n))
    least, brief, fifty = prose(51, 1), prose(51, 6), prose(50, 6)
    rows = [(30, f"{prose(90, 9)} 1 {least} 2 {prose(90, 9)}", 1), (31, f"{prose(90, 9)} 3 {least} 4 {prose(60, 9)}", 1), (32, f"5{brief}6", 1),
            (33, f"7{brief}8", 1), (34, f"9{fifty}0", 1), (35, f"8{fifty}1", 1)]
    assert len(least) == 101 and len(brief) < 390
    got = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, odd_docs.schema), "").collect()}
    assert got[30] == rows[0][1].replace(f" {least} ", "") and got[31] == rows[1][1].replace(f" {least} ", "")
    assert (got[32], got[33], got[34], got[35]) == ("56", "78", rows[4][1], rows[5][1])


def test_last_stage_takes_small_blocks(spark, odd_docs, monkeypatch):
    """Fewer bytes of text at a time, whatever the batches, and the same ids."""
    draw = np.random.default_rng(12)
    rows = [(40 + i, " ".join(f"w{n}" for n in draw.integers(0, 10**6, 100_000)), 1) for i in range(6)]
    docs = odd_docs.union(spark.createDataFrame(rows, odd_docs.schema)).coalesce(1)
    sizes = bpe.word_numbers(texts(docs), 4, corpus_pipeline.BLOCK_BYTES).collect()
    length = {r.doc_id: len((r.text or "").encode()) for r in docs.where("doc_id is not null and doc_id <> 6").collect()}
    assert len(sizes) >= 3 and all(sum(length.get(i, 0) for i in r.doc_ids) <= corpus_pipeline.BLOCK_BYTES for r in sizes)
    got, asked = [], []
    monkeypatch.setattr(bpe, "word_lists", lambda *a, f=bpe.word_lists: asked.append(a[2]) or f(*a))
    for query in (lambda: corpus_pipeline.encode(spark, docs, ""), lambda: bpe.digests(docs)):
        got.append(sorted(query().collect(), key=str))
    assert got[0] == got[1] and len(got[0]) == 6 + odd_docs.count() and asked[0] == corpus_pipeline.BLOCK_BYTES < asked[1]
