"""Documents to packed training windows: toxic ones and copies go, secrets are masked, the rest is packed.

All stages: null ids, null and empty texts stay unless a stage says otherwise; an empty table gives an empty
one; columns beyond doc_id, source and text pass through untouched, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import table
from skyledger.llm.near_duplicates import near_duplicates
from skyledger.llm.packing import digest, pack
from skyledger.llm.secret_scan import redact, scan
from skyledger.llm.toxicity import fit, score
from skyledger.llm.vocabulary import public_path
from skyledger.session import stage_table

#: Documents that share so much of their word shingles are copies.
SIMILAR_PERCENT = 80


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and the new name of each column."""
    names = {name: f"in_{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(new).alias(name) for name, new in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the examples do not call toxic. Rows with one text go or stay together; texts
    without a known term are judged like the examples without any."""
    model, _ = fit(docs, table(spark, sf_dir, "labels"))
    rows, names = _apart(docs)
    return _back(score(rows, model, text=names["text"]).where("predicted = 0"), names)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest doc_id; ids may be null or repeated.
    Rows without words are no copies of each other and stay."""
    rows, names = _apart(docs)
    rows = stage_table(rows.withColumn("key", F.monotonically_increasing_id()), "keyed")
    texts = rows.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["text"]).alias("text"), "key")
    gone = near_duplicates(texts, percent=SIMILAR_PERCENT, key="key").where("not first").select(F.col("row").alias("key"))
    return _back(rows.join(gone, "key", "left_anti"), names)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars, if there is one, follows the text."""
    rows, names = _apart(docs)
    clean = redact(scan(rows, text=names["text"]), text=names["text"])
    if "n_chars" in names:
        count, kind = names["n_chars"], docs.schema["n_chars"].dataType
        clean = clean.withColumn(
            count, F.when(F.size("secrets") > 0, F.length(names["text"]).cast(kind)).otherwise(F.col(count)))
    return _back(clean, names)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens, each source at its share of the corpus. An empty
    document is its end token; repeated rows are packed as often as they occur."""
    return digest(pack(docs, public_path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]

#: The scores of the first stage cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
