"""Corpus preparation: language, quality, near copies, benchmark passages, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All stages but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from claimlens.llm import bytecnn, decontam, langid, pieces, simhash
from claimlens.llm.base import stored, table


def language(spark, docs, sf_dir):
    """Drops documents without a letter or without any n-gram of a learned language."""
    return langid.keep_known(docs, langid.fit(docs))


def quality(spark, docs, sf_dir):
    """Drops documents that score below 0.3; a null text is scored as empty."""
    return bytecnn.keep_good(docs, bytecnn.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def near_copies(spark, docs, sf_dir):
    """Keeps the document of the smallest doc_id of each SimHash class (3 words, 2 bits)."""
    return simhash.keep_first(docs, radius=2, shingle=3)


def benchmark(spark, docs, sf_dir):
    """Drops documents in which a window of a benchmark item occurs."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def sentencepiece(spark, docs, sf_dir):
    """Piece ids of what is left, the text decoded from them, and whether it is exact."""
    return pieces.tokenise(docs)


STAGES = [("language id", language), ("quality classifier", quality), ("simhash near-dedup", near_copies),
          ("benchmark decontamination", benchmark), ("sentencepiece", sentencepiece)]

#: The classifiers are learned and fingerprints hashed, which SQL can't express;
#: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
