"""The registered queries of this subpackage: ``name: (function, checking SQL or None)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslab.llm import decontaminate, exact, jaccard, langid, licenses, lines, mixing, pages, phrases, pii, repeats, sharding, whitening
from corpuslab.llm.common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return pages.extract_text(table(spark, sf_dir, "pages"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of all documents: 4-word shingles, Jaccard 0.85."""
    return jaccard.component_rows(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot under the law of equal row counts."""
    return sharding.shard_digests(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of all documents, a stored half screened against an incoming half."""
    return exact.exact_digests(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without chunks of lines that occur earlier."""
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell share, calibrated probability and draw of all documents; targets: present marginals to the power 0.9."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return mixed.drop("text")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.pii_digests(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents."""
    return langid.language_digests(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaking pairs of documents and benchmark items."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the four strongest components of their distinct vectors, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without strings of 50 bytes that also start in an earlier one."""
    return repeats.repeat_digests(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of every language from all documents."""
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS kept,
       h AS text_sha256
FROM d
"""

QUERIES = {
    "op1_html_extraction": (op1_html_extraction, None),
    "op2_jaccard_join": (op2_jaccard_join, None),
    "op3_sharding": (op3_sharding, None),
    "op4_exact_dedup": (op4_exact_dedup, EXACT_SQL),
    "op5_line_dedup": (op5_line_dedup, lines.SQL),
    "op6_mixing": (op6_mixing, None),
    "op7_pii": (op7_pii, None),
    "op8_decontaminate": (op8_decontaminate, None),
    "op9_language": (op9_language, None),
    "op10_licenses": (op10_licenses, None),
    "op11_whitening": (op11_whitening, None),
    "op12_suffix_dedup": (op12_suffix_dedup, repeats.SQL),
    "op13_collocations": (op13_collocations, phrases.SQL),
}
