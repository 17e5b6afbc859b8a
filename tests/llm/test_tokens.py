"""Encoding against the tokenizers library itself, for the word table and the binary files."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from xoutcome.llm import binary, bpe
from xoutcome.llm import words as W
from xoutcome.llm.common import pack, ragged, unpack
from xoutcome.llm.queries import QUERIES
from xoutcome.llm.words import vocabulary_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def encoded(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_every_document_as_the_library_does(spark, small, tokenizer):
    found = {r.doc_id: r for r in QUERIES["op1_bpe"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        ids, r = encoded(tokenizer, d.text), found[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(raw(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_texts_and_repeated_rows(spark, odd_docs, tokenizer):
    found = bpe.bpe(odd_docs, buckets=3).collect()
    rows = odd_docs.collect()
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in found) == sorted(
        (str(r.doc_id), raw(encoded(tokenizer, r.text)),
         tokenizer.decode(encoded(tokenizer, r.text), skip_special_tokens=False).encode()) for r in rows)
    twice = bpe.bpe(odd_docs.coalesce(1).union(odd_docs.coalesce(1)), buckets=3)
    assert twice.count() == 2 * len(rows)
    assert bpe.bpe(odd_docs.limit(0)).count() == 0


def test_files_hold_all_ids_in_order(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    found = {r.doc_id: r for r in QUERIES["op7_bit_planes"](spark, small).collect()}
    start = 0
    for d in docs:
        ids, r = [*encoded(tokenizer, d.text), 2], found[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(raw(ids)))
        start += len(ids)


def test_small_chunks_and_odd_texts(spark, odd_docs, tokenizer, tmp_path):
    path = str(tmp_path / "ids")
    binary.write_ids(odd_docs, path, 2, chunk_ids=64, shards=3)
    found = sorted(binary.read_ids(spark, path, chunk_ids=64).collect(), key=lambda r: r.start)
    wanted = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert [(r.doc_id, bytes(r.ids)) for r in found] == [(w.doc_id, raw([*encoded(tokenizer, w.text), 2])) for w in wanted]
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found]])[:-1].tolist()
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in found)


def test_no_documents_give_no_ids(spark, odd_docs, tmp_path):
    path = str(tmp_path / "none")
    binary.write_ids(odd_docs.limit(0), path, 2)
    assert binary.read_ids(spark, path).count() == 0


@pytest.mark.parametrize("values", [[], [0], [0, 0, 7], [49407] * 5, list(range(1000)), [2**32 - 1, 1]])
def test_planes_and_packs_round_trip(values):
    ids = np.array(values, np.uint32)
    assert binary.from_planes(binary.to_planes(ids), len(ids)).tolist() == values
    assert unpack(pack(ids), np.uint32).tolist() == values


def test_ragged_positions():
    assert ragged(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]


def test_workers_keep_few_parts_of_distinct_words(tokenizer, monkeypatch):
    """A worker that lives on holds no more than a small cache of a group's words, and encodes those beyond it alike."""
    import pandas as pd
    import zstandard
    made = []
    monkeypatch.setattr(bpe, "encoder", lambda *a: made.append(W.encoder.__wrapped__(*a)) or made[-1])
    words = ["".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(30_000)]
    group = pd.DataFrame({"block": ["b"], "bucket": [0], "payload": [zstandard.ZstdCompressor().compress("\n".join(words).encode())]})
    seen = {}

    class Words:
        def groupBy(self, *_):
            return self

        def applyInPandas(self, run, _):
            seen["out"] = run(group)
    bpe.encode_words(Words(), vocabulary_path())
    assert len(made[0].parts) <= 20_000
    data = seen["out"]["payload"][0]
    size, width = np.frombuffer(data[:8], "<u4").tolist()
    ids = unpack(data[8 + size:], np.uint16 if width == 2 else np.uint32)
    assert unpack(data[8:8 + size], np.uint32).sum() == len(ids) and ids.tolist() == encoded(tokenizer, " ".join(words))
