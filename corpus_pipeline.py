"""A corpus pipeline: language, quality rules, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. Stages but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableprofile.functions.checkpoints import scratch_path
from tableprofile.llm.chosen_path import similarity_classes
from tableprofile.llm.compression import compression_bands
from tableprofile.llm.languages import UNKNOWN, fit_languages, predict_language
from tableprofile.llm.packing import pack_pieces, token_pieces
from tableprofile.llm.queries import tokenizer_file
from tableprofile.llm.shared import fold_of, unused

# A text whose language is this uncertain is in none of the learned ones.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without a letter go.

    The machines learn from the documents of the table whose fold is not 2.
    """
    fold = fold_of(F.col("doc_id"), 4)
    machines = fit_languages(docs, (fold >= 0) & (fold != 2))
    own = unused("_", docs.columns)
    judged = predict_language(docs, machines, keep=tuple(docs.columns), prefix=own)
    return judged.where(
        (F.col(f"{own}lang_pred") != UNKNOWN) & (F.col(f"{own}score") >= LEAST_SCORE)
    ).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands."""
    own = unused("_", docs.columns)
    judged = compression_bands(docs, keep=tuple(docs.columns), prefix=own)
    return judged.where(f"{own}kept").select(*docs.columns)


def placed_rows(docs: DataFrame, column: str) -> DataFrame:
    """The rows with a key of their own, which stays the same wherever they are read.

    It is a hash of the row's file and its place in it. Rows that do not come straight from
    files are written first.
    """
    spark = docs.sparkSession
    try:
        place = docs.metadataColumn("_metadata")
        path = place.getField("file_path")
        files = docs.select(path.alias("path")).distinct()
    except AnalysisException:
        folder = scratch_path(spark, "rows")
        docs.write.parquet(folder)
        return placed_rows(spark.read.parquet(folder), column)
    seed = 0
    # No two files may share a hash; the first seed does, bar a chance of 2 ** -64 a pair.
    while files.groupBy(F.xxhash64("path", F.lit(seed))).count().where("count > 1").count():
        seed += 1
    key = F.struct(
        F.xxhash64(path, F.lit(seed)).alias("file"), place.getField("row_index").alias("at"))
    return docs.select("*", key.alias(column))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the least id, then the least hash of
    the text, then the first row.

    Rows are told apart by their place, so ids may be missing or repeated. As Spark sorts, a
    row without an id comes before one with an id. Groups are led by the row that stays, so
    only keys are compared; whole rows are shuffled once, to take those that stay.
    """
    own = unused("_row", docs.columns)
    rows = placed_rows(docs, own)
    rank = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"), F.col(own).alias("row"))
    classes = similarity_classes(rows.select("text", rank.alias(own)), key=own)
    lead = classes.where(F.col(own) == F.col("class_id")).select(F.col(f"{own}.row").alias(own))
    return rows.join(lead, own, "left_semi").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack_pieces(token_pieces(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Trained machines, zstandard and a genetic algorithm are beyond SQL; the tests compare
# the stages with brute force.
ORACLE_SQL = None
