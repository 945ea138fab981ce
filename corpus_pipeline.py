"""From raw documents to token ids: language, exact copies, near copies, mixture, tokens.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame``. Its result is written as Parquet and read again as the next
stage's ``docs``; all stages but the last return the columns of ``documents``. Empty tables pass through all stages; null and empty
texts are rejected by the first; repeated rows leave one in the second, and ids that stand for several texts stay apart; texts are whole,
however long. Extra columns of the input stay up to the tokens, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.llm.bpe import Bpe
from loreweave.llm.exact_dedup import exact_dedup
from loreweave.llm.langid import keep_identified
from loreweave.llm.mixing import mix_documents
from loreweave.llm.near_copies import near_dedup
from loreweave.session import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough certainty; a null ``lang`` is filled, one that the text clearly contradicts corrected."""
    return keep_identified(docs, "doc_id", "text", "lang")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text the one with the largest id."""
    return exact_dedup(docs, "doc_id", "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (SimHash and MinHash candidates with a Jaccard similarity of at least 0.8 on shingles of five words) the document with the smallest id."""
    return near_dedup(docs, "doc_id", "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, towards the target weights of their sources; shuffled globally."""
    return mix_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, source, ids, n_tokens, intact)``: token ids, and whether decoding them gives the text back."""
    encoded = Bpe(spark).encode(docs.select("doc_id", "lang", "source", "text"), "text", intact="intact")
    return encoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "intact")


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixture", mix_sources),
    ("tokens", encode_tokens),
]

# learned languages, fingerprint groups and tokens are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
