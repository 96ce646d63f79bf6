"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import stored

__all__ = ["FOLDS", "held_out", "stored", "table"]

#: A learned model sees only documents whose crc32(doc_id as text) modulo this is not 0.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Named columns of an input table, so that others never reach an operator."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def held_out(doc_id: str = "doc_id"):
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as held out,
    since nothing is learned from it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))
