"""The corpus pipeline: from raw documents to packed training bins.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the documents of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.llm import mixing, ngram_join, packing, quality, secrets
from skyfare.llm.store import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    NULL, empty and short texts go, having too few words. Repeated rows are judged alike; a NULL id is no
    reason to go, and a NULL language or source is a group like any other. Columns beyond COLUMNS are left out.
    """
    return quality.judged(docs.select(*COLUMNS)).where("quality.kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, one row: of least id, or any if none has an id.

    Rows without words, NULL texts included, are linked with nothing and stay, each of them. Repeated rows are
    copies, whatever their ids. Columns beyond COLUMNS are left out, as by all stages.
    """
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "numbered")
    groups = ngram_join.grouped(rows, {"doc_id": F.col("doc_id"), "row": F.col("row")})
    groups = stored(groups, "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = groups.where("component is not null").groupBy("component").agg(first.alias("first")).select("first.row")
    kept = kept.unionByName(groups.where("component is null").select("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret, and the length of the text that is left.

    No row goes, and none changes but by its secrets; a NULL text stays NULL and has no length.
    """
    model = secrets.train(secrets.labelled_samples(docs))
    found = secrets.scanned(docs, model, COLUMNS)
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col("secrets.spans")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, each row once at most.

    NULL, empty and blank texts have no tokens. Rows without id, or of one id, are drawn in the order of a hash of their
    text, of equal rows as many as fit. A NULL language or source is one of its own.
    """
    drawn = mixing.mixed(docs, mixing.document_levels(), mixing.WEIGHTS, epochs=1, columns=COLUMNS)
    return drawn.select(*COLUMNS)


def packed_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document is packed: rows of ``packing.PLACED``.

    A document without words has one row without bin. A NULL source is in conflict with nothing; repeated rows are
    copies and lie in different bins.
    """
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packed_bins),
]

#: SQL cannot express robust outliers, Markov models and packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{number}")
    return docs
