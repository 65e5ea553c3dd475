"""A training-corpus pipeline over ``documents``: five stages, each on all that its predecessor kept.

In every stage null texts count as empty, ids may be null or repeat, texts are read whole
however long, other columns pass through whatever their names, and no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm import minhash, mixing, packing, quality, secrets
from pagetables.llm.tables import read, stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 3) does not reject.

    Empty and null texts are scored like any other; repeated rows stay or go together;
    without labels nothing is rejected."""
    return quality.keep(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each near-duplicate group (operator 7).

    Rows are judged by their own text: a repeated row and a near copy under a null
    id go, another text under the id of a copy stays."""
    return minhash.one_of_each(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret found (operator 8) replaced; ``n_chars`` follows the text.

    No row is lost or added: a null text stays null (and its ``n_chars`` null), an empty one
    empty; repeated rows and rows of one id are rewritten by their own texts."""
    ledger = stored(secrets.scan(docs), "ledger")
    out = secrets.redact(docs, ledger)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix (operator 9) takes it: 0 to 3 times.

    A null source is a source of its own, the last; texts without words have size 0 and are
    taken as their source's fraction says; of rows of one id, source and size some may be
    taken once more than others."""
    return mixing.resample(docs)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document copy (operator 6).

    Texts without words lie in the first bucket; copies and rows of one id and length are
    interchangeable; rows with a null id are placed like any other."""
    return packing.pack(docs)


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("secrets", secret_redaction),
          ("mixing", mix_sources), ("packing", length_packing)]

# The classifier's fit and the hashed choices of the mix have no SQL: tests/llm/test_pipeline.py
# and test_models.py hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
