"""The training-corpus pipeline: each stage is written as Parquet and reread as the next one's docs.

All stages: null or repeated doc_ids are allowed, as rows are told by themselves; texts of any length are worked on whole;
columns of any name are carried along; an empty table gives an empty one. Null text has no language, so it goes in the
first stage; later stages alone would keep it (as empty text).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm import exact_dedup, language_id, ngram_join, packing, substring_dedup
from tracklake.llm.common import keyed, shared_dir


#: A document whose language is less certain than this is rejected; with clean text it is near 1.
LEAST_CERTAIN = 0.5


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key of each row, and the name of that column; a row keeps its key however often it is read."""
    key = "row_key"
    while key in docs.columns:
        key += "_"
    return keyed(docs, key), key


def _only(docs: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The rows of docs whose key is in kept."""
    return docs.join(kept.select(key), key, "left_semi").drop(key)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay: not `und`, and not less certain than LEAST_CERTAIN."""
    found = language_id.identify(docs, carry=True)
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_CERTAIN)).select("carried.*")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, with the largest doc_id; rows of different texts stay, whatever their ids."""
    docs, key = _keyed(docs)
    return _only(docs, exact_dedup.duplicates(docs, key=key).where("kept"), key)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that names its group (the smallest doc_id) stays, and of rows that repeat that id in the group just one."""
    docs, key = _keyed(docs)
    return _only(docs, ngram_join.near_groups(docs, key=key).where("kept"), key)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages that earlier documents hold; a text that loses nothing stays as it is.

    A document of which nothing is left stays, with an empty text; n_chars is counted anew.
    """
    out = substring_dedup.remove_repeats(docs, carry=True)
    new = {"text": F.when(~F.col("carried.no_text"), F.col("new_text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("new_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("carried.row.n_chars"))
    return out.select(*[new.get(c, F.col("carried.row").getField(c) if c != "text" else None).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences, as packing.pack gives them."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_join", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]
#: Packing needs the tokenizer, and language ID a trained model: no SQL for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}_{name}")
        docs = spark.read.parquet(f"{base}/{k}_{name}")
    return docs
