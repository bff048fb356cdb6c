"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import (align, counts, jaccard, licenses, lines, mixing, phrases, pieces, pii,
                           quality, secrets, simhash, suffixes)
from tidewater.sources.tables import read_table


#: The public vocabularies: of ops 3, 10 and 12, and of op 12 alone.
PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return jaccard.jaccard_join(docs).select("doc_id", "n_shingles", "component_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return lines.line_digests(lines.dedup_lines(docs))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return pieces.code_digests(docs, vocabulary(PIECES))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return secrets.span_digests(secrets.secret_spans(docs))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return quality.quality_rules(docs, read_table(spark, sf_dir, "labels"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return simhash.fingerprint_report(docs)


#: The key of the registered query; a user passes a secret one.
PII_KEY = b"surrogates of the registered query"


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return pii.pseudonymise(docs, PII_KEY)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken",
                                           "source", "copies")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return suffixes.remove_repeats(docs, keep_bytes=False).withColumnRenamed("kept", "kept_sha256")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return counts.count_tokens(docs, vocabulary(PIECES))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return licenses.license_digests(licenses.license_matches(docs))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return align.align_tokenizers(docs, vocabulary(BYTES), vocabulary(PIECES))[0]


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents", ["lang", "text"]))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_line_dedup, op3_sentencepiece,
                                   op4_secret_scan, op5_quality_rules, op6_fingerprints, op7_pii_surrogates, op8_mix_sources, op9_suffix_dedup,
                                   op10_token_counts, op11_license_scan, op12_token_alignment,
                                   op13_phrase_collocations)}

ORACLE: dict[str, str] = {"op1_ngram_jaccard_join": jaccard.oracle(),
                          "op2_line_dedup": lines.oracle(),
                          "op9_suffix_dedup": suffixes.oracle(),
                          "op13_phrase_collocations": phrases.oracle()}
