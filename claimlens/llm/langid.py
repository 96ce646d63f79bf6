"""Language identification with language-bitmask n-gram filters.

Training keeps, for every language, the byte n-grams that are common in a
bounded sample of its documents. All languages share one bit-sliced Bloom
filter: slot ``s`` holds a mask with one bit per language, and the AND of the
masks at an n-gram's hash slots names every language that contains it.
Prediction counts these bits per language over the whole text, subtracts the
hits that a filter of that fill gives by chance, and takes the largest count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import held_out

UND = "und"
#: Bytes of an n-gram; n-grams run over lower-cased words with one space between.
GRAM = 4
#: Odd multipliers of the hash functions (fixed values).
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
#: Bytes worked on at a time, so that a very long text needs bounded memory.
PIECE = 1 << 19
#: ASCII bytes that are not letters become spaces; other bytes stay.
_TO_SPACE = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


@dataclass
class LanguageFilters:
    """``slices[w, s]``: bits of languages 64 w to 64 w + 63 at slot ``s``.
    ``chance[l]``: share of unseen n-grams that language ``l`` claims falsely."""

    languages: list[str]
    bits: int
    slices: np.ndarray
    chance: np.ndarray


def has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


def gram_codes(text: str):
    """Arrays of n-gram codes that together cover the whole text."""
    data = b" " + b" ".join(text.lower().encode().translate(_TO_SPACE).split()) + b" "
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, max(1, len(raw) - GRAM + 1), PIECE):
        x = raw[at : at + PIECE + GRAM - 1].astype(np.uint32)
        if len(x) >= GRAM:
            yield x[:-3] << np.uint32(24) | x[1:-2] << np.uint32(16) | x[2:-1] << np.uint32(8) | x[3:]


def slots(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(codes * np.uint32(m)) >> np.uint32(32 - bits) for m in MULTIPLIERS]


def fit(docs: DataFrame, max_docs: int = 2000, max_grams: int = 60_000, min_docs: int = 2,
        min_share: float = 0.05, bits: int = 20) -> LanguageFilters:
    """Learn from (doc_id, text, lang) rows outside the held-out fold.

    Bound of the sample: about ``max_docs`` documents of each language, drawn by a
    hash of doc_id, each read whole. An n-gram enters a language's filter if it is
    in ``min_docs`` of its documents, among its ``max_grams`` most frequent, and
    at least ``min_share`` times as frequent as in any other language. Rows with a
    null text, lang or doc_id teach nothing. No rows: no languages.
    """
    train = docs.select("doc_id", "text", "lang").where(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in train.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageFilters([], bits, np.zeros((1, 1 << bits), np.uint64), np.zeros(0))
    languages = sorted(sizes)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
    part = F.element_at(F.create_map(*[F.lit(x) for k in languages
                                       for x in (k, int(min(1.0, max_docs / sizes[k]) * 1_000_000))]), F.col("lang"))

    def count(batches):
        for b in batches:
            got: dict[str, list] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                codes = [np.unique(c) for c in gram_codes(text)]
                if codes:
                    got.setdefault(lang, []).append(np.unique(np.concatenate(codes)) if len(codes) > 1 else codes[0])
            for lang, seen in got.items():
                code, n = np.unique(np.concatenate(seen), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(code)), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64)),
                     pa.array([len(seen)] + [0] * (len(code) - 1), pa.int64())], names=["lang", "code", "n", "docs"])

    counted = (train.where(draw < part).select("lang", "text")
               .mapInArrow(count, "lang string, code long, n long, docs long")
               .groupBy("lang", "code").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    # Codes are 4 bytes, and the sample is bounded: so is this table, whatever the corpus.
    pdf = counted.where(F.col("n") >= min_docs).toPandas()
    slices = np.zeros((-(-len(languages) // 64), 1 << bits), np.uint64)
    if len(pdf):
        total = pdf.lang.map({k: min(max_docs, sizes[k]) for k in languages})
        pdf["rate"] = pdf.n / total
        pdf = pdf[pdf.rate >= min_share * pdf.groupby("code").rate.transform("max")]
        pdf = pdf.sort_values(["lang", "n", "code"], ascending=[True, False, True]).groupby("lang").head(max_grams)
        for k, lang in enumerate(languages):
            for s in slots(pdf.code[pdf.lang == lang].to_numpy(np.uint32), bits):
                slices[k // 64][s] |= np.uint64(1 << (k % 64))
    fill = np.array([np.count_nonzero(slices[k // 64] >> np.uint64(k % 64) & np.uint64(1)) / (1 << bits)
                     for k in range(len(languages))])
    return LanguageFilters(languages, bits, slices, fill ** len(MULTIPLIERS))


def classify(model: LanguageFilters, text: str | None) -> tuple[str, float]:
    """Language and score in [0, 1] of one whole text.

    ``und`` and 0 for a null text, one without a letter, or a model without
    languages. A text none of whose n-grams is known gets the first language
    with score 0. Ties go to the first language by name."""
    if text is None or not model.languages or not has_letter(text):
        return UND, 0.0
    size = len(model.languages)
    hits, n = np.zeros(size), 0
    for codes in gram_codes(text):
        at = slots(codes, model.bits)
        n += len(codes)
        for w in range(len(model.slices)):
            mask = model.slices[w][at[0]]
            for s in at[1:]:
                mask &= model.slices[w][s]
            own = min(64, size - 64 * w)
            if own <= 8:
                by = np.bincount(mask.astype(np.intp), minlength=1 << own)
                hits[64 * w : 64 * w + own] += by @ (np.arange(len(by))[:, None] >> np.arange(own) & 1)
            else:
                hits[64 * w : 64 * w + own] += [np.count_nonzero(mask >> np.uint64(k) & np.uint64(1)) for k in range(own)]
    real = np.maximum(0.0, (hits - n * model.chance) / np.maximum(1e-9, 1 - model.chance))
    best = int(np.argmax(real))
    if real[best] <= 0:
        return model.languages[best], 0.0
    rest = np.delete(real, best).max(initial=0.0)
    return model.languages[best], float(real[best] / (real[best] + rest))


def identify(docs: DataFrame, model: LanguageFilters) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            got = [classify(shared.value, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: LanguageFilters, min_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (all columns) whose text has a language: not ``und`` and a
    score of at least ``min_score``. A score below one half means that no known
    n-gram was found."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            got = [classify(shared.value, t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([g[0] != UND and g[1] >= min_score for g in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
