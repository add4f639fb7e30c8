"""Corpus pipeline: language ID, exact dedup, n-gram Jaccard join, mixing and
packing, each stage over all that its predecessor kept.

Every stage but the last returns the columns of ``documents``. ``run`` writes
each stage's result as Parquet into the shared folder and reads it again.

Stages and what they decide:

1. ``language_id``: rows without a letter, or whose 3-grams are known from the
   learning texts to a share below ``MIN_SCORE`` (``langid``: ``known``), go:
   noise, foreign letters, a single letter. Short clean texts stay. ``lang`` of
   the rows that stay is the language predicted from the text.
2. ``exact_dedup``: of texts that are equal but for ASCII white space the owner
   stays.
3. ``ngram_jaccard``: five-word n-grams, similarity 0.8; of each group of linked
   documents exactly one row stays, that with the smallest id (NULL ids last,
   then by text). Documents without words are their own groups.
4. ``mix_sources``: whole documents, each as often as the mix takes it (0, 1 or
   2 times, as repeated rows). What the mix weighs are the sources of each
   predicted language.
5. ``pack``: one row per piece with its place in a sequence.

NULL texts have no letter and go in stage 1. An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.llm import exact_dedup, langid, mixing, ngram_jaccard, packing
from eddy.llm.common import stored

#: held-out rows of a file of check_s have 0.90 at least, their first three words
#: 0.79, random letters 0.55 at most
MIN_SCORE = 0.7
SHINGLE, SIMILARITY = 5, (80, 100)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_confident(docs, min_score=MIN_SCORE, label="lang")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d = exact_dedup.exact_dedup(docs, carry=tuple(docs.columns))
    return d.where("kept").select("extra.*")


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    num, den = SIMILARITY
    return ngram_jaccard.one_of_each(docs, n=SHINGLE, num=num, den=den)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    group = F.concat(F.col("lang"), F.lit("/"), F.coalesce("source", F.lit("")))
    return mixing.mix_documents(docs.withColumn("_group", group), source_col="_group").drop("_group")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(docs, packing.contract_tokenizer())


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("ngram_jaccard", jaccard),
          ("mix_sources", mix_sources), ("best_fit_packing", pack)]

#: string kernels, tries and tokenizers are beyond SQL; tests/llm compares the
#: stages with plain-Python versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
