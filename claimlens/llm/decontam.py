"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words with one space between; the windows of all
benchmark items form the patterns of one automaton, and each document is scanned
once. Hits are mapped back to word numbers and to offsets in the original text.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import stored

#: Bytes of benchmark text that one automaton holds (its windows are about ten times as many). A
#: larger benchmark is dealt to shards, each of which scans the documents in a pass of its own.
SHARD_BYTES = 1_000_000
#: Bytes outside [0-9A-Za-z] and below 0x80 separate words; A-Z become a-z.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def automaton(items: list[tuple[object, str]], window: int):
    """Aho-Corasick automaton over the items' windows. Patterns are words between
    spaces, one character a byte; a value holds the word count and item numbers."""
    owners: dict[str, tuple[int, set]] = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            owners.setdefault(" " + b" ".join(w[k : k + n]).decode("latin-1") + " ", (n, set()))[1].add(item)
    found = ahocorasick.Automaton()
    for pattern, (n, who) in owners.items():
        found.add_word(pattern, (n, tuple(sorted(who, key=str))))
    found.make_automaton()
    return found


def scan(found, text: str | None) -> tuple[int, np.ndarray, set]:
    """Number of words, a mask of hit words, and the items with occurring windows."""
    w = words(text)
    hit = np.zeros(len(w) + 1, np.int64)
    items: set = set()
    if w and len(found):
        line = " " + b" ".join(w).decode("latin-1") + " "
        ends = [(end, value) for end, value in found.iter(line)]
        if ends:
            # a pattern ends on the space after its last word
            spaces = np.nonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)[0]
            for end, (n, who) in ends:
                last = int(np.searchsorted(spaces, end))
                hit[last - n] += 1
                hit[last] -= 1
                items.update(who)
    return len(w), np.cumsum(hit[:-1]) > 0, items


def original_spans(text: str, mask: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges of the original text that runs of hit words cover."""
    data = text.encode()
    word = np.frombuffer(data.translate(_TABLE), np.uint8) != 0x20
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    begin, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    run = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    first, last = np.nonzero(run == 1)[0], np.nonzero(run == -1)[0] - 1
    chars = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return [(int(chars[begin[a]]) - 1, int(chars[end[b] - 1])) for a, b in zip(first, last, strict=True)]


def shards(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[DataFrame]:
    """(item_id, text) in parts of about that size, the items dealt by hash. Rows with a
    null item_id or text have no part. Nothing is collected but the total size."""
    rows = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + total // shard_bytes
    if parts == 1:
        return [rows]
    rows = stored(rows.withColumn("_shard", F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(parts))), "benchmark")
    return [rows.where(F.col("_shard") == k).select("item_id", "text") for k in range(parts)]


_BUILT: dict = {}


def built(shared, window: int):
    """The automaton of a broadcast shard, built once in each Python worker, which holds one at a time."""
    name, texts = shared
    if (name, window) not in _BUILT:
        _BUILT.clear()
        _BUILT[name, window] = automaton(texts.value, window)
    return _BUILT[name, window]


def _broadcast(shard: DataFrame):
    """A name and the texts of one shard, which ``SHARD_BYTES`` bounds (a single longer item is one shard's)."""
    return uuid.uuid4().hex, shard.sparkSession.sparkContext.broadcast([tuple(r) for r in shard.collect()])


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_HITS = "n_words long, n_hit long, items array<string>, spans array<struct<begin:long,end:long>>"


def _contamination(docs: DataFrame, shard: DataFrame, window: int) -> DataFrame:
    shared = _broadcast(shard)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        found = built(shared, window)
        for b in batches:
            n_words, n_hit, items, spans = [], [], [], []
            for text in b.column(1).to_pylist():
                n, mask, who = scan(found, text)
                n_words.append(n)
                n_hit.append(int(mask.sum()))
                items.append(sorted(map(str, who)))
                spans.append([{"begin": x, "end": y} for x, y in original_spans(text, mask)] if who else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(_SPAN))],
                names=["doc_id", "n_words", "n_hit", "items", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_HITS}")


def _merged(docs: DataFrame, parts: list[DataFrame], window: int) -> DataFrame:
    """Hits of several shards as those of one: each shard's pass keeps what it found, by document
    and digest of its text; items are united, and the words that any span covers are counted anew."""
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    tables = []
    for shard in parts:
        found = _contamination(docs.select(F.struct("doc_id", digest.alias("digest")).alias("doc_id"), "text"), shard, window)
        tables.append(stored(found.where("n_hit > 0").select("doc_id.*", "items", "spans").dropDuplicates(["doc_id", "digest"]), "hits"))
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    every = every.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            n_words, n_hit, spans = [], [], []
            for text, own in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                n, mask = covered(text, [(s["begin"], s["end"]) for s in own or []])
                n_words.append(n)
                n_hit.append(int(mask.sum()))
                spans.append([{"begin": x, "end": y} for x, y in original_spans(text, mask)] if own else [])
            items = pa.array([x or [] for x in b.column(2).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), items, pa.array(spans, pa.list_(_SPAN))],
                                             names=["doc_id", "n_words", "n_hit", "items", "spans"])

    own = docs.select("doc_id", "text", digest.alias("digest"))
    both = own.join(every, own["doc_id"].eqNullSafe(every["_id"]) & own["digest"].eqNullSafe(every["_digest"]), "left")
    return both.select("doc_id", "text", "items", "spans").mapInArrow(run, f"doc_id {kind}, {_HITS}")


def covered(text: str | None, spans: list[tuple[int, int]]) -> tuple[int, np.ndarray]:
    """Number of words of a text, and a mask of those inside any of the character ranges."""
    data = (text or "").encode()
    word = np.frombuffer(data.translate(_TABLE), np.uint8) != 0x20
    begin = np.nonzero(np.diff(np.concatenate([[0], word.view(np.int8)])) == 1)[0]
    if not spans or not len(begin):
        return len(begin), np.zeros(len(begin), bool)
    char = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[begin] - 1     # each word's first character
    change = np.zeros(len(begin) + 1, np.int64)
    for a, z in spans:
        change[np.searchsorted(char, a)] += 1
        change[np.searchsorted(char, z)] -= 1
    return len(begin), np.cumsum(change[:-1]) > 0


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans), one row per row of ``docs`` (doc_id, text).

    ``items``: ids, as strings in order, of the items one of whose windows of
    ``window`` words (of all its words, if fewer) occurs; ``spans``: character
    ranges [begin, end) of the original text. A null text has no words. A benchmark within
    ``shard_bytes`` is one automaton and one pass over the documents, a larger one a pass per shard."""
    parts = shards(benchmark, shard_bytes)
    return _contamination(docs, parts[0], window) if len(parts) == 1 else _merged(docs, parts, window)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows of ``docs`` (all columns) in which no window of the benchmark occurs. A null or empty
    text has no words and stays; repeated rows stay or go each; an empty benchmark keeps all."""
    at = docs.columns.index("text")
    parts = shards(benchmark, shard_bytes)
    for k, shard in enumerate(parts):
        docs = _without(docs, _broadcast(shard), window, at)
        docs = stored(docs, "clean") if k < len(parts) - 1 else docs
    return docs


def _without(docs: DataFrame, shared, window: int, at: int) -> DataFrame:
    def run(batches):
        found = built(shared, window)
        for b in batches:
            yield b.filter(pa.array([not scan(found, t)[2] for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
