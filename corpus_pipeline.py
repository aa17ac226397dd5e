"""The training-data pipeline: five stages from ``documents`` to weighted documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of its input.  A stage's result is written as Parquet and
read again as the next one's docs.  Columns of other names, and rows with nulls
in any of them, go through all stages; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import staged, table
from caselake.llm.decontamination import drop_leaking
from caselake.llm.mixing import label_domains, mix_to_targets
from caselake.llm.near_duplicates import drop_near_duplicates
from caselake.llm.secrets import fit_secrets, mask_secrets
from caselake.llm.toxicity import drop_toxic, fit_toxicity, held_out


#: Shares of tokens that the last stage gives documents of high and low quality; toxic ones are gone by then.
TARGETS = {"high": 0.9, "low": 0.1}


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.7 or more go.

    Each row is judged by its own text, so rows that repeat an id may part.  A
    null or empty text has the score of the bias alone, 0.5 without labels, and
    an empty table stays empty.
    """
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels").filter(~held_out())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8) the smallest id stays.

    Rows without id, and texts without words, null ones included, stay.  Rows that
    repeat an id stay or go together.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage like a benchmark item go.

    Null and empty texts stay; items without id or words leak nowhere, and with
    an empty benchmark all rows stay.
    """
    return drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, and n_chars follows; no document goes.

    A null text stays null, and its n_chars becomes null.
    """
    masked = mask_secrets(docs, fit_secrets(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets posteriors, a rate and copies that meet the target shares.

    No document goes.  A null or empty text has the prior as its posterior and
    no tokens; columns named as the new ones are replaced.
    """
    return mix_to_targets(docs, label_domains(table(spark, sf_dir, "labels")), TARGETS)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: The stages learn models and compare sets; SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
