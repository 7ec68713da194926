"""Corpus pipeline: five stages from raw documents to a mixed corpus.

Each stage works on all rows its predecessor kept, is written as Parquet to
the cluster's shared folder and read again as the next stage's input. All
but the last return the columns of ``documents``; the last adds where a
document stands in the mix.

1. language ID: texts without a letter and texts between two languages go
2. similarity join: one document of each group of near copies stays
   (5-word shingles, Jaccard similarity of 0.8 or more)
3. decontamination: documents with a passage of a benchmark item go
4. personal data: replaced in the text, ``n_chars`` counted again
5. mixing: sources are dealt out to blocks by tempered weights

Every stage gives an empty result for an empty input and handles null in
any column as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, lang_ecoc, mix_sources, ngram_join, pii_anchors
from strata.llm.common import load, staged
from strata.session import ensure_checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_ecoc.identified(docs, lang_ecoc.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, params=ngram_join.Join(80, 100, 5))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii_anchors.redact(docs)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))) if "n_chars" in out.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources.mixed(docs, mix_sources.Mix(block_tokens=250_000))


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("PII", personal_data),
    ("mixing sources", mix),
]

#: Learnt language codes and sampled edit search have no SQL form; the stages
#: are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"stage-{k + 1}")
    return docs
