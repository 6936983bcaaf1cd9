"""The corpus pipeline: five stages over documents, each written as Parquet and
read again as the next one's input. Every stage works on all rows that its
predecessor kept; all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctflow.llm import langid, packing, quality, secret_scan, simhash
from acctflow.llm.common import shared_folder, table, written
from acctflow.llm.queries import BYTE_TOKENIZER


#: Rows a task holds in one Arrow batch at most; texts can be long.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def bounded(spark: SparkSession) -> None:
    """Keeps the session's Arrow batches at ``BATCH_ROWS`` or less."""
    name, rows = BATCH_ROWS
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def apart(docs: DataFrame) -> DataFrame:
    """``docs`` with a prefix on its columns, so that none is named like a result
    of an operator."""
    return docs.toDF(*[f"in_{c}" for c in docs.columns])


def as_before(rows: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` from prefixed rows, those in ``new`` anew."""
    return rows.select(*[new.get(c, F.col(f"in_{c}")).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go."""
    bounded(spark)
    model = langid.train_on_folds(docs)
    held = apart(docs)
    found = langid.identify(held, model, text_col="in_text", keep=tuple(held.columns))
    return as_before(found.where("accepted"), docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the compression bands keep."""
    bounded(spark)
    held = apart(docs)
    found = quality.quality(held, text_col="in_text", keep=tuple(held.columns))
    return as_before(found.where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with its smallest id (any
    id before none), then its smallest fingerprint, text and other columns."""
    bounded(spark)
    held = apart(docs)
    rows = written(
        simhash.fingerprints(held, text_col="in_text", keep=tuple(held.columns)), shared_folder(spark, "pipeline-fp")
    )
    labels = simhash.components(rows, id_col="in_doc_id")
    narrow = rows.select("in_doc_id", "fp").join(labels.select("fp", "root"), "fp")
    first = F.min(F.struct(F.col("in_doc_id").isNull().alias("nameless"), F.col("in_doc_id").alias("id"), "fp")).alias("first")
    chosen = written(narrow.groupBy("root").agg(first).select("first.id", "first.fp"), shared_folder(spark, "pipeline-chosen"))
    same = (rows["fp"] == chosen["fp"]) & rows["in_doc_id"].eqNullSafe(chosen["id"])
    found = rows.join(chosen, same).select(rows["fp"], *held.columns)
    # A chosen fingerprint is one group's; its rows left differ in the text at most by what the fingerprint misses.
    order = F.struct("in_text", F.to_json(F.struct(*[c for c in held.columns if c != "in_text"])))
    kept = found.groupBy("fp").agg(F.min_by(F.struct(*held.columns), order).alias("row")).select("row.*")
    return as_before(kept, docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by its kind in
    brackets; n_chars is that of the new text."""
    bounded(spark)
    held = apart(docs)
    found = secret_scan.scan(held, text_col="in_text", keep=tuple(held.columns))
    changed = F.col("spans") != ""
    return as_before(
        found,
        docs,
        text=F.when(changed, F.col("redacted")).otherwise(F.col("in_text")),
        n_chars=F.when(changed, F.length("redacted").cast("long")).otherwise(F.col("in_n_chars")),
    )


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into training sequences, one row per piece."""
    bounded(spark)
    return packing.pack_documents(docs, BYTE_TOKENIZER)


STAGES = [
    ("language", language),
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", sequences),
]

# Trained models and tokenizer libraries can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
