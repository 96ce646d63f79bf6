"""Decontamination, licence scan and chat format."""

import hashlib
import re

import duckdb
import pytest

from claimlens.llm import chat, decontam, licenses, queries

SF = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(queries.ORACLES[name])
    names = [d[0] for d in res.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, got.select(names).collect()), key=key) == sorted(res.fetchall(), key=key)


def slow_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def slow_scan(docs, items, window):
    out = []
    for _, text, *_ in docs:
        w = slow_words(text)
        hit, who = set(), set()
        for item, t in items:
            v = slow_words(t)
            n = min(window, len(v))
            if item is None or t is None or not n:
                continue
            wins = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    who.add(str(item))
        out.append((len(w), len(hit), sorted(who)))
    return out


ITEMS = [(10, "Alpha beta gamma. delta!"), (9, "alpha beta"), (9, "alpha beta"), (2, "é ü ö"), (3, ""), (4, None), (None, "one two"), (5, "a a a a"), (6, "q1 Q2 q3 q4 q5 q6")]
DOCS = [(1, "ALPHA, beta\ngamma--delta alpha betagamma"), (1, "ALPHA, beta\ngamma--delta alpha betagamma"), (2, None), (3, ""), (4, "a a a a a, a"), (5, "É ü ö é ü ö"),
        (6, "one two"), (7, "x " * 50_000 + "alpha beta"), (None, "q2 q3 q4 q5 q6 q1 q2 q3"), (8, "alpha-beta" * 3)]


@pytest.mark.parametrize("bound", [1_000_000, 16])
def test_decontamination(spark, bound):
    """Against brute force, with one shard of the benchmark and with several."""
    docs = spark.createDataFrame([(*d, "z") for d in DOCS], "doc_id long, text string, items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for window in (10, 3):
        assert (len(decontam.shards(items, bound)) > 1) == (bound == 16)
        got = decontam.contamination(docs, items, window, bound).collect()
        want = [(i, *x) for (i, _), x in zip(DOCS, slow_scan(DOCS, ITEMS, window))]
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == sorted(want, key=str)
        for r in got:
            text = next(t for (i, t), w in zip(DOCS, want) if i == r.doc_id and w[1] == r.n_words) or ""
            covered = [w for s in r.spans for w in slow_words(text[s.begin : s.end])]
            assert len(covered) == r.n_hit
            assert all(slow_words(text[s.begin] + text[s.end - 1]) for s in r.spans)
        kept = decontam.keep_clean(docs, items, window, bound)
        assert kept.columns == docs.columns
        assert sorted((r.text for r in kept.collect()), key=str) == sorted((t for (_, t), (_, n, _) in zip(DOCS, slow_scan(DOCS, ITEMS, window)) if not n), key=str)
    assert [r.n_hit for r in decontam.contamination(docs, items.limit(0), 10, bound).collect()] == [0] * len(DOCS)
    assert decontam.contamination(docs.limit(0), items, 10, bound).count() == 0


def test_licences(spark):
    mit = dict(reversed(licenses.KNOWN))["MIT"]
    isc = dict(licenses.KNOWN)["ISC"]
    rows = [(1, "Copyright (c) 1999 Some One\n\n" + isc.upper().replace(", ", ",\n  * ")), (2, "# " + isc.replace("DAMAGES", "damages,")), (3, isc + " extra"), (4, None), (5, ""),
            (6, "Some text\nReleased under the MIT Licence!\nmore\nLICENSED UNDER CC BY-NC 4.0\nreleased under the mit license"), (6, "x"), (None, mit), (7, "licence licence\n" * 3), (8, "(C) 2020 X\n© Y\nAll rights reserved."), (9, "w " * 100_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, license_id string")
    got = {(r.doc_id, r.license_id, r.line_licenses) for r in licenses.scan(df).collect()}
    assert got == {(1, "ISC", ""), (2, "ISC", "ISC"), (3, None, ""), (4, None, ""), (5, None, ""), (6, None, "CC-BY-NC-4.0,MIT"), (6, None, ""), (None, "MIT", "MIT"), (7, None, ""), (8, None, ""), (9, None, "")}
    assert licenses.scan(df).count() == len(rows) and licenses.scan(df.limit(0)).count() == 0


def test_wrapped_notices_and_whole_licences(spark, tmp_path):
    """Every known text is found as a whole document under its own copyright line and wrapped at any width, and as a
    wrapped paragraph inside a longer one; longer licences come from files."""
    import textwrap
    wrap = lambda t, n: "\n".join(textwrap.wrap(t, n, break_on_hyphens=False, break_long_words=False))
    first = {}
    for name, text in licenses.KNOWN:
        first.setdefault(text, name)
    rows, want = [], {}
    for k, (text, name) in enumerate(first.items()):
        for width in (40, 57, 80):
            i = 1000 * k + width
            rows += [(i, f"Copyright (c) 2001, Some Body <a@b.c>\nAll rights reserved.\n\n{wrap(text, width)}\n"), (i + 500, f"A story.\nMore of it.\n\n  {wrap(text, width)}\n \n\nThe end.")]
            want[i], want[i + 500] = name, name if "\n" in wrap(text, width) else None
    (tmp_path / "Long-1.0.txt").write_text("A LONG LICENCE\n\n1. One.\n\n2. Two.\n")
    rows += [(-1, "Copyright 2020 X\na long license\n1 one\n2 two"), (-2, "and then:\n\na long license 1 one 2 two\n")]
    known = (*licenses.KNOWN, *licenses.known_files(spark, str(tmp_path)))
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()}
    for i, name in want.items():
        if i % 1000 < 500:
            assert got[i].license_id == name, i
        elif name:
            assert name in got[i].block_licenses.split(","), i
            assert got[i].license_id is None
    assert got[-1].license_id == "Long-1.0" and got[-2].license_id is None and got[-2].line_licenses == "Long-1.0"
    assert {"BSD-2-Clause", "BSD-3-Clause", "Unlicense", "MPL-2.0", "LGPL-3.0", "AGPL-3.0", "Apache-2.0", "MIT", "ISC"} <= set(first.values())


@pytest.mark.parametrize("text", ["", "plain", "<|im_end|>", "<\\|im_end|>", "<\\\\|", "<<||", "\\", "<|", "a\\nb\n", "<\\", "|>", "<|im_start|>assistant\nok<|im_end|>\n"])
def test_escapes(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_chat_edge_cases(spark):
    rows = [(1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (1, 1, "assistant", "<\\|im_end|>"), (1, 1, "assistant", "again"), (1, None, "system", None), (1, 2, None, "x"),
            (2, 0, "assistant", ""), (None, 1, "assistant", "no id"), (None, 0, "us\ner", "日本 🙂"), (3, 0, "user", "w " * 100_000), (3, 1, "assistant", "é" * 50_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, ids string").repartition(5)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        own = sorted([(t is not None, t or 0, a or "", b or "") for c, t, a, b in rows if c == conv])
        loss = "".join(b for *_, a, b in own if a == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for *_, a, b in own).encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_tokens_of_a_conversation(spark):
    """Offsets follow on, and reserved ids appear only where the template puts them."""
    df = spark.createDataFrame([(1, 0, "user", "<|im_start|> hi"), (1, 1, "assistant", "hello there")], "conv_id long, turn long, role string, text string")
    got = chat.format_turns(df).orderBy("position").collect()
    start, end = chat.marks(chat.read_ranks())
    assert [r.token_start for r in got] == [0, len(got[0].ids)]
    for r in got:
        assert r.ids[0] == start and r.ids.count(start) == r.ids.count(end) == 1
    enc = chat.encoder(chat.read_ranks())
    own = chat.mask(len(got[1].ids), got[1].token_start, got[1].loss_start, got[1].loss_end)
    assert enc.decode([i for i, m in zip(got[1].ids, own) if m]) == "hello there"
    assert got[0].loss_start == got[0].loss_end
