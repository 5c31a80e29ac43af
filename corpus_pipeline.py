"""From documents to packed sequences: rules, classifier, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept and returns the columns of ``docs``, but for the last,
which returns the packed pieces. ``run`` writes what a stage returns as Parquet and reads it back for the next.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolith.llm.line_rules import quality_rules
from phenolith.llm.near_duplicates import near_duplicates
from phenolith.llm.packing import pack_best_fit
from phenolith.llm.quality_model import fit_quality, with_scores
from phenolith.llm.secret_scan import redact, scan_secrets
from phenolith.session import write_once

SCORE_CUT = 0.3
NEAR_PERCENT = 80


def _free_name(columns: list[str], name: str) -> str:
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def _with_text(rows: DataFrame, row: str, text: str, like: DataFrame) -> DataFrame:
    """The columns of ``like`` from the struct ``row``, with the new ``text`` and, where there is such a column, its length."""
    changed = {"text": F.col(text)}
    if "n_chars" in like.columns:
        changed["n_chars"] = F.length(text).cast(like.schema["n_chars"].dataType)
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(row).getField(c).alias(c) for c in like.columns])


def _row(docs: DataFrame):
    """All columns in one struct, out of the way of any name that a stage gives."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bad lines go, and so do documents that fail the rules or lose too much.

    Null, empty and blank texts have no words and go. Rows are judged one by one, so repeated ones share their fate; an empty table gives an empty
    one; further columns stay as they are, whatever their names.
    """
    judged = quality_rules(docs.select(_row(docs).alias("_row_"), F.col("text"))).where(F.col("rules.kept"))
    return _with_text(judged.select("_row_", F.col("rules.clean_text").alias("_text_")), "_row_", "_text_", docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut go. The model comes from the labelled documents as they were given: what is left here is of one class.

    Null and empty texts get the score of a text without words. Rows are scored one by one, so repeated ones share their fate; an empty table gives an
    empty one; further columns stay as they are, whatever their names.
    """
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    vectors, net = fit_quality(given, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _free_name(docs.columns, "_score")
    return with_scores(docs, vectors, net, score=score).where(F.col(f"`{score}`") >= SCORE_CUT).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicate texts stays, the one with the smallest id; rows of one id with different texts all stay.

    Of equal rows one stays. Rows with a null id or without a word are like no other and stay; an empty table gives an empty one; further columns stay as they
    are, whatever their names.
    """
    row = _free_name(docs.columns, "_row")
    numbered = write_once(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, percent=NEAR_PERCENT, row=row)
    gone = found.where(~F.col("kept")).select(row)
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in their own row; values that many owners or repositories share are examples and stay. Without an id, all spans are masked.

    Null texts stay null. Repeated rows are masked alike and all stay; an empty table gives an empty one; further columns stay as they are, whatever their names.
    """
    scanned = scan_secrets(docs, carried="_row_").select("spans", "_row_")
    text, key = F.col("_row_").getField("text"), F.col("_row_").getField("doc_id")
    masked = F.filter("spans", lambda s: (s["verdict"] != "example") | key.isNull())
    spans = F.transform(masked, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
    new = F.when(F.size(spans) > 0, redact(text, spans)).otherwise(text)
    return _with_text(scanned.select(new.alias("_text_"), "_row_"), "_row_", "_text_", docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in sequences of up to 4096 words, one row per piece.

    Null, empty and blank texts have no pieces, repeated rows and null ids are packed like others, an empty table gives an empty one, and further columns are left
    out.
    """
    return pack_best_fit(docs)


STAGES = [
    ("quality rules", rules_stage), ("quality classifier", classifier_stage), ("minhash near-dedup", near_duplicates_stage),
    ("secret scans", secrets_stage), ("best-fit packing", packing_stage)]

#: A trained network decides in the second stage; SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
