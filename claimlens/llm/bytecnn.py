"""Quality classifier: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes step over the UTF-8 bytes two at a time. Each block
of ``BLOCK`` positions is max-pooled (neighbouring blocks share WIDTH - 2 bytes,
so blocks overlap and together cover the whole document), the pooled values are
averaged over the blocks, and a logistic unit with a bias for the length class
of the text turns them into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import held_out

WIDTH, STEP, FILTERS = 8, 2, 16
#: Filter positions of a block; a block sees BLOCK * STEP + WIDTH - STEP bytes.
BLOCK = 128
SPAN = BLOCK * STEP + WIDTH - STEP
#: Upper bounds in bytes of the length classes that have a bias each.
LENGTHS = (24, 48, 96, 192, 512)
#: Blocks of a document that are worked on at a time.
AT_ONCE = 256


@dataclass
class ByteNet:
    """``taps[j, b]``: what byte ``b`` at offset ``j`` adds to each filter."""

    taps: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: np.ndarray

    def paired(self) -> np.ndarray:
        """Taps for two bytes at a time, indexed by a little-endian pair."""
        return np.stack([(self.taps[j][None, :, :] + self.taps[j + 1][:, None, :]).reshape(1 << 16, FILTERS).astype(np.float32)
                         for j in range(0, WIDTH, 2)])


def length_class(n):
    return np.searchsorted(LENGTHS, n, side="left")


def _windows(data: bytes, most: int) -> np.ndarray:
    """At most ``most`` block spans, evenly spaced over the whole text (training only)."""
    data = data + bytes(max(0, SPAN - len(data)))
    raw = np.frombuffer(data, np.uint8)
    at = np.unique(np.linspace(0, len(raw) - SPAN, most).astype(int) // STEP * STEP)
    at = np.resize(at, most)
    return raw[at[:, None] + np.arange(SPAN)]


def sample(docs: DataFrame, labels: DataFrame, max_docs: int, windows: int):
    """Training rows: (windows, length, label) of at most ``max_docs`` labelled
    documents outside the held-out fold, chosen by a hash of doc_id. Of conflicting labels
    of an id the smallest counts; of several texts of an id the one whose windows come first as bytes,
    so the net is the same in every run."""
    chosen = (labels.select("doc_id", "quality").where(~held_out() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_docs))
    picked = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")

    def cut(batches):
        for b in batches:
            texts = [t.encode() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_windows(t, windows).tobytes() for t in texts], pa.binary()),
                 pa.array([len(t) for t in texts], pa.int64()), b.column(2).cast(pa.int64())],
                names=["doc_id", "windows", "n", "quality"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return picked.select("doc_id", "text", "quality").mapInArrow(
        cut, f"doc_id {kind}, windows binary, n long, quality long").groupBy("doc_id").agg(
            F.min(F.struct("windows", "n", "quality")).alias("one")).select("doc_id", "one.*").toPandas().sort_values("doc_id", ignore_index=True)


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 4000, windows: int = 6, rounds: int = 10, rate: float = 0.01,
        seed: int = 7) -> ByteNet:
    """Learn the filters from (doc_id, text) and (doc_id, quality).

    Bound of the sample: ``max_docs`` documents, ``windows`` spans of SPAN bytes
    each. Without rows, or with one class only, the net returns that class's
    share for every text. A quarter of each batch is seen through one short crop,
    so that short texts aren't taken for monotonous ones."""
    pdf = sample(docs, labels, max_docs, windows)
    rng = np.random.default_rng(seed)
    net = ByteNet(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.normal(0, 0.1, FILTERS).astype(np.float32), np.zeros(len(LENGTHS) + 1, np.float32))
    y = (pdf.quality == 1).to_numpy(np.float32)
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        net.weight[:] = 0
        net.offset[:] = 0.0 if not len(y) else 10.0 if share else -10.0
        return net
    spans = np.stack([np.frombuffer(w, np.uint8).reshape(windows, SPAN) for w in pdf.windows])
    size = pdf.n.to_numpy()
    # the classes weigh the same, however rare one is
    weigh = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    params = [net.taps, net.bias, net.weight, net.offset]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    lanes = np.arange(FILTERS)
    for _ in range(rounds):
        order = rng.permutation(len(y))
        for s in range(0, len(order), 64):
            ix = order[s : s + 64]
            x, n, t = spans[ix].copy(), size[ix].copy(), y[ix]
            for k in range(0, len(ix), 4):
                keep = int(rng.integers(16, SPAN))
                if keep < n[k]:
                    lo = int(rng.integers(0, SPAN - keep + 1))
                    crop = np.zeros(SPAN, np.uint8)
                    crop[:keep] = x[k, rng.integers(0, windows), lo : lo + keep]
                    x[k], n[k] = crop, keep
            kind = length_class(n)
            z = sum(net.taps[j][x[..., j : j + STEP * BLOCK : STEP]] for j in range(WIDTH)) + net.bias
            # positions that begin in the padding of a short text don't count
            z[np.broadcast_to((np.arange(BLOCK) * STEP >= np.maximum(n - WIDTH + STEP, 1)[:, None])[:, None, :], z.shape[:3])] = -1e9
            top = z.argmax(2)
            peak = np.take_along_axis(z, top[:, :, None, :], 2)[:, :, 0, :]
            pooled = np.maximum(peak, 0).mean(1)
            p = 1 / (1 + np.exp(-(pooled @ net.weight + net.offset[kind])))
            g = ((p - t) * weigh[ix] / len(ix)).astype(np.float32)
            back = (g[:, None] * net.weight)[:, None, :] / windows * (peak > 0)
            taps = np.zeros_like(net.taps)
            for j in range(WIDTH):
                byte = np.take_along_axis(x, (top * STEP + j).reshape(len(ix), windows, FILTERS), 2)
                np.add.at(taps[j], (byte, np.broadcast_to(lanes, byte.shape)), back)
            grads = [taps, back.sum((0, 1)), pooled.T @ g, np.bincount(kind, g, len(net.offset)).astype(np.float32)]
            step += 1
            for p_, g_, a, b in zip(params, grads, first, second, strict=True):
                a += 0.1 * (g_ - a)
                b += 0.001 * (g_ * g_ - b)
                p_ -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def probability(net: ByteNet, pairs: np.ndarray, text: str | None) -> float:
    """Score of one whole text; a null text counts as empty. ``pairs``: net.paired()."""
    data = (text or "").encode()
    n = len(data)
    places = max(1, -(-(n - WIDTH) // STEP) + 1)
    raw = np.frombuffer(data + bytes(max(0, places * STEP + WIDTH - STEP - n)), np.uint8)[: places * STEP + WIDTH - STEP].view("<u2")
    total, blocks = np.zeros(FILTERS, np.float64), -(-places // BLOCK)
    for at in range(0, places, BLOCK * AT_ONCE):
        m = min(BLOCK * AT_ONCE, places - at)
        z = pairs[0][raw[at : at + m]]
        for j in range(1, WIDTH // 2):
            z += pairs[j][raw[at + j : at + j + m]]
        total += np.maximum(np.maximum.reduceat(z, np.arange(0, m, BLOCK), axis=0) + net.bias, 0).sum(0)
    logit = total / blocks @ net.weight + net.offset[int(length_class(n))]
    return float(1 / (1 + np.exp(-np.clip(logit, -60, 60))))


def score(docs: DataFrame, net: ByteNet) -> DataFrame:
    """(doc_id, score), one row per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        pairs = shared.value.paired()
        for b in batches:
            got = [probability(shared.value, pairs, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, net: ByteNet, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` (all columns) whose text scores at least ``threshold``. A null text is scored as
    an empty one; repeated rows stay or go alike; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index("text")

    def run(batches):
        pairs = shared.value.paired()
        for b in batches:
            yield b.filter(pa.array([probability(shared.value, pairs, t) >= threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
