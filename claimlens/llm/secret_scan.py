"""Secret scan: an Aho-Corasick prefilter, anchored expressions, embedded checksums.

One automaton holds the keywords of all kinds (in every case where case does not
count) and all strings of four hex digits. It passes over a text once; only where it
hits is an expression tried, anchored there. Tokens that carry a checksum of
themselves are kept only if it is right.
"""

from __future__ import annotations

import re
import zlib
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "github", "npm")
_WORD = r'(?:password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)'
#: Anchored expression of each kind; ASCII letters alone have two cases.
EXPRESSIONS = {
    "assign": re.compile(_WORD, re.ASCII | re.IGNORECASE),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})"),
    "npm": re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})"),
}
#: Keywords by kind; those of ``assign`` in either case.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
HEX, BASE62 = "0123456789abcdef", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Rows whose texts are Python strings at a time.
ROWS = 256


def automaton():
    """Keywords of all kinds, those of ``assign`` in every mix of cases, and hex quadruples."""
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            forms = product(*({c.lower(), c.upper()} for c in word)) if kind == "assign" else [word]
            for form in forms:
                found.add_word("".join(form), (kind, len(word)))
    for quad in product(HEX, repeat=4):
        found.add_word("".join(quad), ("hex", 4))
    found.make_automaton()
    return found


def checksum(payload: str) -> str:
    """The six base-62 digits that such a token ends in: the CRC-32 of what lies between."""
    n, out = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out


def passes(kind: str, match) -> bool:
    """Whether a match is long enough or has the right checksum."""
    if kind == "assign":
        return len(match[1]) >= LEAST_VALUE
    if kind in ("access", "hex"):
        return match.end() - match.start() >= (LEAST_ACCESS if kind == "access" else LEAST_HEX)
    return checksum(match[1]) == match[2]


def spans(found, text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets of a text, by start, then kind as listed.

    Hits come by their ends; two keywords of one kind never start in one place or lie in one
    another, and hex quadruples have one length, so the hits of a kind come by start. A match of
    a kind hides later hits inside it whether it passes or not, as a leftmost search would."""
    out, after = [], dict.fromkeys(KINDS, 0)
    for last, (kind, size) in found.iter(text or ""):
        start = last - size + 1
        if start < after[kind]:
            continue
        match = EXPRESSIONS[kind].match(text, start)
        if match:
            after[kind] = match.end()
            if passes(kind, match):
                out.append((start, KINDS.index(kind), match.end()))
    return [(start, KINDS[k], end) for start, k, end in sorted(out)]


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, begin, end>>), one row per row of ``docs``
    (doc_id, text; other columns are ignored), code points, end exclusive.

    A null text is empty and has none; repeated rows have rows each; an empty table gives no
    rows. Whole texts are scanned, whatever their length."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton())  # 70,000 nodes, whatever the input
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                got = [[{"kind": k, "begin": a, "end": z} for a, k, z in spans(shared.value, t)] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.list_(span))], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,begin:long,end:long>>")
