"""SentencePiece encoding and decoding.

The pieces of a model file form one Aho-Corasick automaton. Encoding walks the
text once: at each position the automaton's output links give every piece that
ends there, longest first, and a Viterbi step relaxes the best score. Characters
that no piece covers fall back to byte pieces, so decoding gives the text back.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Path of a public model file on the driver; a parameter of every function here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Piece types of a model file, and what an uncovered character scores below the worst piece (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PENALTY = 10.0
#: Segments whose ids a worker remembers; the memory is emptied when full.
REMEMBERED = 600_000


def _fields(data: bytes):
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Pieces:
    """Pieces, scores and types in the order of their ids."""

    text: list[str]
    score: list[float]
    kind: list[int]
    prefix: bool = True
    squeeze: bool = False
    built: tuple | None = field(default=None, repr=False)
    single: frozenset = frozenset()
    known: dict = field(default_factory=dict, repr=False)

    @classmethod
    def load(cls, data: bytes) -> Pieces:
        """From the bytes of a model file. Its normaliser must be the identity,
        but for the space put in front and the squeezing of spaces."""
        text, score, kind = [], [], []
        prefix = squeeze = True
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                text.append(own[1].decode())
                score.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kind.append(own.get(3, NORMAL))
            elif number == 3:
                own = dict(_fields(value))
                if own.get(2):
                    raise ValueError("a model with a character map isn't supported")
                prefix, squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
        return cls(text, score, kind, prefix, squeeze)

    def __getstate__(self):
        return self.__dict__ | {"built": None, "known": {}}

    def build(self) -> tuple:
        if self.built is None:
            found = ahocorasick.Automaton()
            used = [k for k, t in enumerate(self.kind) if t in (NORMAL, USER_DEFINED) and self.text[k]]
            scores = [self.score[k] for k in used if self.kind[k] == NORMAL]
            top, low = max(scores, default=0.0), min(scores, default=0.0)
            for k in reversed(used):  # of equal pieces the first counts
                size = len(self.text[k])
                found.add_word(self.text[k], (size, size * top - 0.1 if self.kind[k] == USER_DEFINED else self.score[k], k))
            found.make_automaton()
            bytes_ = {int(self.text[k][3:5], 16): k for k, t in enumerate(self.kind) if t == BYTE}
            unk = next((k for k, t in enumerate(self.kind) if t == UNKNOWN), 0)
            split = _segments([self.text[k] for k in used])
            self.single = frozenset(self.text[k] for k in used if len(self.text[k]) == 1)
            self.built = found, bytes_, unk, low - PENALTY, split
        return self.built


def normalise(model: Pieces, text: str) -> str:
    """Spaces become the space mark. A mark that the text itself holds is kept
    apart as U+FFFF 0 so that it's spelt in bytes and decodes to itself."""
    if SPACE in text or "\uffff" in text:
        text = text.replace("\uffff", "\uffff1").replace(SPACE, "\uffff0")
    if model.squeeze:
        text = re.sub(" +", " ", text).strip(" ")
    if not text:
        return ""
    return (SPACE if model.prefix else "") + text.replace(" ", SPACE)


def _spell(model: Pieces, char: str) -> list[int]:
    _, bytes_, unk, _, _ = model.built
    raw = char.encode()
    return [bytes_[b] for b in raw] if all(b in bytes_ for b in raw) else [unk]


def viterbi(model: Pieces, segment: str) -> list[int]:
    """Ids of the best-scoring split of one segment; of equal scores the split
    whose last piece begins first wins. A character that is no piece of its own
    may be spelt out at a score below any piece's."""
    found, _, _, miss, _ = model.build()
    n = len(segment)
    low = float("-inf")
    best = [0.0] + [low] * n
    back: list = [None] * n + [(0, -1)]
    if model.single.issuperset(segment):
        for end, (size, score, piece) in found.iter(segment):
            total = best[end + 1 - size] + score
            if total > best[end + 1]:
                best[end + 1], back[end + 1] = total, (end + 1 - size, piece)
    else:
        by_end: dict[int, list] = {}
        for end, value in found.iter(segment):
            by_end.setdefault(end + 1, []).append(value)
        for end in range(1, n + 1):
            for size, score, piece in by_end.get(end, ()):
                total = best[end - size] + score
                if total > best[end]:
                    best[end], back[end] = total, (end - size, piece)
            if segment[end - 1] not in model.single and best[end - 1] + miss > best[end]:
                best[end], back[end] = best[end - 1] + miss, (end - 1, -1)
    out: list[int] = []
    while n:
        start, piece = back[n]
        out.extend([piece] if piece >= 0 else reversed(_spell(model, segment[start:n])))
        n = start
    return out[::-1]


#: Letters (Latin, Greek, Cyrillic) after whose runs texts may be split.
_LETTER = "[A-Za-zÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ]"


def _segments(used: list[str]):
    """Pattern of the stretches that can be split on their own, or None if pieces
    reach across words or lines. Stretches end before a space mark, around line ends
    and escapes, and after a run of letters (with the marks that pieces hold after
    letters): no piece reaches across these ends."""
    if any(re.search(f"[^{SPACE}]{SPACE}|\n", t) for t in used):
        return None
    letter = re.compile(_LETTER)
    joins: set[str] = set()
    while True:
        more = {b for t in used for a, b in zip(t, t[1:], strict=False)
                if (a in joins or letter.match(a)) and b not in joins and not letter.match(b)}
        if not more:
            break
        joins |= more
    run = f"{_LETTER}+" + (f"(?:[{''.join(map(re.escape, sorted(joins)))}]{_LETTER}*)*" if joins else "")
    other = f"[^{SPACE}\n\uffff{_LETTER[1:]}"
    return re.compile(f"{SPACE}*{other}*{run}|{SPACE}*{other}+|{SPACE}+|\n|\uffff.")


def encode(model: Pieces, text: str) -> np.ndarray:
    """Ids of a whole text. The model remembers segments between calls, as bytes
    that are joined and that the garbage collector needn't walk."""
    split = model.build()[4]
    known = model.known
    line = normalise(model, text)

    def fresh(part: str) -> bytes:
        if part[0] == "\uffff":
            ids = _spell(model, SPACE if part[1] == "0" else "\uffff")
        else:
            ids = viterbi(model, part)
        coded = np.array(ids, np.int32).tobytes()
        if len(part) <= 64:
            if len(known) >= REMEMBERED:
                known.clear()
            known[part] = coded
        return coded

    # where pieces reach across words, what lies between two escapes is one segment
    parts = split.findall(line) if split else [p for p in re.split("(\uffff.)", line) if p]
    get = known.get
    return np.frombuffer(b"".join([get(p) or fresh(p) for p in parts]), np.int32)


def byte_table(model: Pieces) -> list[bytes]:
    """What each id stands for in a decoded text."""
    return [bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN
            else t.replace(SPACE, " ").encode() for t, k in zip(model.text, model.kind, strict=True)]


def decode(model: Pieces, ids, table: list[bytes] | None = None) -> str:
    """Text of ids; the space that encoding puts in front is taken off."""
    table = table or byte_table(model)
    data = b"".join(map(table.__getitem__, ids))
    return (data[1:] if model.prefix and data[:1] == b" " else data).decode(errors="replace")


def read_model(path: str = MODEL) -> Pieces:
    with open(path, "rb") as f:
        return Pieces.load(f.read())


def tokenise(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, piece_ids, n_pieces, decoded, exact), one row per row of ``docs``
    (doc_id, text): the ids of the whole text, the text decoded from them, and
    whether it equals the input. A null text has null ids and decoded text, no
    pieces and counts as exact; an empty text has no pieces.

    The driver reads the model file and broadcasts its table of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(path))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = shared.value
        table = byte_table(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                texts = b.column(1).to_pylist()
                ids = [None if t is None else encode(model, t) for t in texts]
                back = [None if i is None else decode(model, i.tolist(), table) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([0 if i is None else len(i) for i in ids], pa.int64()),
                     pa.array(back, pa.string()), pa.array([x == y for x, y in zip(texts, back, strict=True)], pa.bool_())],
                    names=["doc_id", "piece_ids", "n_pieces", "decoded", "exact"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece_ids array<int>, n_pieces long, decoded string, exact boolean")
