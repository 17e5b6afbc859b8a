"""The registered queries of this package; those that SQL can't state are held to brute force by the tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from xoutcome.llm import binary, bpe, decontaminate, fingerprints, katz, minhash, pii, ranked, sitetree, spelling, suffixdedup, toxicity, warc
from xoutcome.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": lambda spark, folder: bpe.digests(table(spark, folder, "documents")),
    "op2_site_style_tree": lambda spark, folder: sitetree.main_text(table(spark, folder, "pages")),
    "op3_minhash": lambda spark, folder: minhash.near_duplicates(table(spark, folder, "documents")),
    "op4_weighted_sampling": lambda spark, folder: fingerprints.fingerprints(table(spark, folder, "documents")),
    "op5_containment": lambda spark, folder: decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")),
    "op6_katz": lambda spark, folder: katz.language_model_scores(table(spark, folder, "documents")),
    "op7_bit_planes": lambda spark, folder: binary.round_trip(table(spark, folder, "documents")),
    "op8_suffix_array": lambda spark, folder: suffixdedup.digests(table(spark, folder, "documents")),
    "op9_warc_derivatives": lambda spark, folder: warc.digests(table(spark, folder, "pages")),
    "op10_toxicity": lambda spark, folder: toxicity.toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels")).drop("passages"),
    "op11_lstm_crf": lambda spark, folder: pii.digests(table(spark, folder, "documents")),
    "op12_spelling_lists": lambda spark, folder: spelling.spelling_variants(table(spark, folder, "documents")),
    "op13_limited_accumulators": lambda spark, folder: ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
}
_CLASSES = f"""WITH RECURSIVE s AS ({decontaminate._SETS.format(id='doc_id', table='documents')}),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(coalesce(b, doc_id), doc_id) AS component_id, coalesce(b >= doc_id, TRUE) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = doc_id"""
ORACLE_SQL: dict[str, str] = {"op3_minhash": _CLASSES, "op5_containment": decontaminate.ORACLE, "op13_limited_accumulators": ranked.ORACLE}
