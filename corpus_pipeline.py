"""From raw documents to training files.

``STAGES``: quality classifier, near duplicates, benchmark decontamination,
mixing of sources, token files. Each stage takes (spark, docs, sf_dir) and
returns a DataFrame; ``run`` writes it as Parquet in the shared folder and
gives the table read back to the next, so a lost executor repeats no stage.
All stages but the last keep the columns of ``documents``; the last returns
what it has read back from the files it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm.catalog import tokenizer_path
from pulsegrid.llm.common import read_documents, stored
from pulsegrid.llm.inverted_index import drop_contaminated
from pulsegrid.llm.line_crf import keep_good
from pulsegrid.llm.mixing import mix
from pulsegrid.llm.ngram_join import keep_one
from pulsegrid.llm.token_files import token_digest


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model does not reject."""
    return keep_good(docs, read_documents(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of the benchmark."""
    return drop_contaminated(docs, read_documents(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources."""
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, length, checksum."""
    return token_digest(docs, str(tokenizer_path()), end_id=1)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

#: Training, components and tokenizer can't be said in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
