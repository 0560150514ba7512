"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync.llm.classifier import scored
from docsync.llm.common import table
from docsync.llm.fingerprints import fingerprints
from docsync.llm.jaccard import similar
from docsync.llm.licenses import scan
from docsync.llm.merkle import manifest, tampered_text
from docsync.llm.mixing import mix
from docsync.llm.packing import matrices, pack
from docsync.llm.quality import quality
from docsync.llm.suffixes import dedup
from docsync.llm.toxicity import toxicity
from docsync.llm.variants import variants
from docsync.llm.warc import archived


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: a directory for each 1000, 100 and 10 ids, whose first
    document plays its licence file."""
    docs = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    folder = [F.concat(F.lit(f"{mark}/" if mark == "t" else f"{mark}"), F.floor(i / size).cast("string"))
              for mark, size in (("t", 1000), ("h", 100), ("d", 10))]
    name = F.when(i % 10 == 0, F.lit("LICENSE")).otherwise(F.concat(i.cast("string"), F.lit(".txt")))
    path = (F.when(i % 1000 == 0, F.concat_ws("/", folder[0], name))
            .when(i % 100 == 0, F.concat_ws("/", *folder[:2], name))
            .otherwise(F.concat_ws("/", *folder, name)))
    return scan(docs.select("doc_id", F.when(i.isNotNull(), path).alias("path"), "text"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer())


def op6_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrices(table(spark, sf_dir, "documents"), tokenizer())


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), tampered_text())


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op6_token_matrices": op6_token_matrices,
    "op5_mixing": op5_mixing,
    "op7_warc": op7_warc,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_toxicity": op11_toxicity,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}
