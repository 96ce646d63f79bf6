"""Chat formatting at token level.

Every turn is encoded on its own: the header and the text are segments of
ordinary tokens, and the reserved ids of the turn marks are spliced between them,
so no text can make a mark. Prefix sums of the segment lengths give each turn's
place in its conversation and the ranges that the loss counts. Control strings
in texts are escaped reversibly, so the decoded string can be read back too.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Path of a public vocabulary of byte-level ranks; a parameter of every function here.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary cuts texts before merging (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
START, END = "<|im_start|>", "<|im_end|>"
_OPEN, _SHUT = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_ENCODERS: dict = {}


def escape(text: str) -> str:
    r"""No ``<|`` remains: ``<|``, ``<\|``, ... get one more backslash."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    if id(ranks) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[id(ranks)] = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[id(ranks)]


def marks(ranks: dict[bytes, int]) -> tuple[int, int]:
    """Reserved ids of the start and end mark: the first two after the vocabulary's
    own end-of-text id, which follows its ranks."""
    return len(ranks) + 1, len(ranks) + 2


def format_turns(rows: DataFrame, path: str = RANKS) -> DataFrame:
    """(conv_id, position, ids, token_start, loss_start, loss_end), one row per turn.

    ``rows``: (conv_id, turn, role, text). Turns are ordered by turn (null first),
    then role and text; a null role or text is empty; a null conv_id is a
    conversation like any other. ``ids`` are the turn's tokens, ``token_start`` its
    offset among the conversation's tokens, and [loss_start, loss_end) the tokens
    there that the loss counts (assistant texts; else empty). Turns are encoded
    before they are brought together, and a task reads its conversations as a
    stream, so a conversation of any length needs bounded memory."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(path))
    kind = rows.schema["conv_id"].dataType.simpleString()
    rank = rows.schema["turn"].dataType.simpleString()
    clean = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def encode(batches):
        enc, (start, end) = encoder(shared.value), marks(shared.value)
        tail = enc.encode_ordinary("\n")
        for b in batches:
            ids, lead, size = [], [], []
            for role, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                head = [start, *enc.encode_ordinary(escape_role(role) + "\n")]
                body = enc.encode_ordinary(escape(text))
                ids.append(np.array(head + body + [end] + tail, np.int32))
                lead.append(len(head))
                size.append(len(body) if role == "assistant" else 0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(lead, pa.int32()), pa.array(size, pa.int32())],
                names=["conv_id", "turn", "role", "text", "ids", "lead", "size"])

    coded = clean.mapInArrow(encode, f"conv_id {kind}, turn {rank}, role string, text string, ids array<int>, lead int, size int")
    # the text only breaks ties between equal turns of a role
    ordered = (coded.select("conv_id", "turn", "role", F.col("text").alias("tie"), "ids", "lead", "size")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie")
               .select("conv_id", "ids", "lead", "size"))

    def place(batches):
        key, offset, position = object(), 0, 0
        for b in batches:
            starts, at = [], []
            for conv, n in zip(b.column(0).to_pylist(), b.column(1).value_lengths().to_pylist(), strict=True):
                if conv != key:
                    key, offset, position = conv, 0, 0
                starts.append(offset)
                at.append(position)
                offset += n
                position += 1
            begin = np.array(starts, np.int64) + b.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(at, pa.int64()), b.column(1), pa.array(starts, pa.int64()), pa.array(begin, pa.int64()),
                 pa.array(begin + b.column(3).to_numpy(), pa.int64())],
                names=["conv_id", "position", "ids", "token_start", "loss_start", "loss_end"])

    return ordered.mapInArrow(
        place, f"conv_id {kind}, position long, ids array<int>, token_start long, loss_start long, loss_end long")


def mask(ids_length: int, token_start: int, loss_start: int, loss_end: int) -> np.ndarray:
    """Loss mask of one turn's tokens: the prefix sum of +1 where it begins and -1 where it ends."""
    step = np.zeros(ids_length + 1, np.int64)
    step[loss_start - token_start] += 1
    step[loss_end - token_start] -= 1
    return np.cumsum(step[:-1]) > 0


def read_back(turns: DataFrame, path: str = RANKS) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from
    the tokens and masks of ``format_turns`` alone, read as a stream in its order."""
    shared = turns.sparkSession.sparkContext.broadcast(read_ranks(path))
    kind = turns.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        enc, (start, end) = encoder(shared.value), marks(shared.value)
        state: list | None = None
        out: list = []

        def close():
            if state:
                out.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        def flush():
            got = [[x[k] for x in out] for k in range(6)]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(got[0], conv_type), pa.array(got[1], pa.int64()), pa.array(got[2], pa.string()), pa.array(got[3], pa.int64()),
                 pa.array(got[4], pa.string()), pa.array(got[5], pa.int64())], names=names)

        conv_type = pa.int64()
        for b in batches:
            conv_type = b.column(0).type
            for conv, position, ids, at, lo, hi in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not position:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if ids[0] != start or ids.count(start) != 1 or ids.count(end) != 1:
                    raise ValueError("a turn has one start and one end mark")
                close_at = ids.index(end)
                inner = enc.decode(ids[1:close_at])
                tail = enc.decode(ids[close_at + 1 :])
                role, _, text = inner.partition("\n")
                loss = unescape(enc.decode([i for i, m in zip(ids, mask(len(ids), at, lo, hi), strict=True) if m]))
                state[1] += 1
                state[2].update((unescape_role(role) + "\n" + unescape(text) + "\n").encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(START) + len(inner) + len(END) + len(tail)
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    return turns.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
