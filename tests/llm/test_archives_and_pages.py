"""ARC to WARC and wrapper inference."""

import base64
import gzip
import hashlib
import io
import json
import random
import zlib

import pytest

from claimlens.llm import arc, queries, wrappers

SF = "/root/testdata/sf0.01"


def arc_file(version):
    about = f"{version} 0 converter\n{arc.ARC_FIELDS[version]}\n"
    more = "" if version == 1 else " 200 - - 0 -"
    out = f"filedesc://x.arc 0.0.0.0 19970101000000 text/plain{more} {len(about)}\n{about}".encode()
    for url, block in (("http://a.example/one two", b"HTTP/1.1 200 OK\r\nX-Page-Id: 1\r\n\r\nbody\n\nhttp://b.example/ 1 2 3 4\n"), ("http://b.example/", b"")):
        extra = "" if version == 1 else " 404 ABC http://c.example/ 17 x.arc"
        out += b"\n" + f"{url} 1.2.3.4 19970102030405 text/html{extra} {len(block)}\n".encode() + block
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_arc_by_version(version):
    """Declared lengths rule: a payload may hold what looks like a header or a separator."""
    got = list(arc.arc_records(io.BytesIO(arc_file(version))))
    assert [f["URL"] for f, _ in got] == ["http://a.example/one two", "http://b.example/"]
    assert got[0][1].endswith(b"body\n\nhttp://b.example/ 1 2 3 4\n") and got[1][1] == b""
    assert got[0][0]["IP-address"] == "1.2.3.4" and got[0][0]["Archive-date"] == "19970102030405"
    assert ("Result-code" in got[0][0]) == (version == 2)
    with pytest.raises(ValueError):
        list(arc.arc_records(io.BytesIO(arc_file(version)[:-80])))


def rows():
    long = "<p>é\r\n\r\nWARC/1.1\n" * 20_000
    return [(1, "http://a/ b", "same", 1), (2, None, "same", 1), (3, "u", "same", 1), (3, "u", "same", 1), (4, "", None, 1), (5, "x", "", 1),
            (6, "é", long, 1), (7, "y", "alone\r\n\r\n", 1), (None, "z", "same", 1), (None, "z", "nobody's", 1), (None, "z", "nobody's", 1)]


def expected(pages, least=0):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    out = []
    for i, _, h, *_ in pages:
        n = len((h or "").encode())
        ids = [j for j, _, g, *_ in pages if digest(g) == digest(h) and j is not None]
        top = max(ids) if ids and n >= least else None
        first = top is None or i == top
        out.append((i, n, digest(h), "response" if first else "revisit", None if first else top))
    return out


order = lambda x: tuple((v is None, v) for v in x)


@pytest.mark.parametrize("least,limit", [(0, 500_000), (5, 500_000), (0, 0), (5, 1)])
def test_archive(spark, least, limit):
    """Files of a few records, with the index of repeated digests broadcast and shuffled."""
    df = spark.createDataFrame(rows(), "page_id long, url string, html string, payload_digest int").repartition(3)
    got = arc.archive(df, least, file_bytes=1000, limit=limit).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted([tuple(r[n] for n in names) for r in got], key=order) == sorted(expected(rows(), least), key=order)
    assert {r.date for r in got} == {"2020-01-01T00:00:00Z"}
    assert arc.archive(df.limit(0)).count() == 0


def test_files_are_warc(spark, tmp_path):
    """Each file opens on its own, begins with its own record, and revisits name response records.
    A file ends with the record that reaches the bound, so a long page has no later ones beside it."""
    df = spark.createDataFrame(rows(), "page_id long, url string, html string, n int").coalesce(2)
    arc.write_arc(df, f"file://{tmp_path}/arc", file_bytes=600)
    arc.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc", file_bytes=1500).count()
    assert len(list(tmp_path.glob("arc/*.gz"))) >= 3
    ids, to, n = set(), set(), 0
    for f in tmp_path.glob("warc/*.gz"):
        data = gzip.decompress(f.read_bytes())
        assert data.endswith(b"\r\n\r\n")
        got = list(arc.warc_records(io.BytesIO(data)))
        assert got[0][0]["warc-type"] == "warcinfo"
        for h, block in got[1:]:
            n += 1
            assert h["content-type"].startswith("application/http") and block.startswith(b"HTTP/1.1 200")
            (ids if h["warc-type"] == "response" else set()).add(h["warc-record-id"])
            to |= {h["warc-refers-to"]} if h["warc-type"] == "revisit" else set()
    assert n == len(rows()) and to and to <= ids
    assert {1, 2} >= {int(gzip.decompress(f.read_bytes()).split(b"\n")[1].split(b" ")[0]) for f in tmp_path.glob("arc/*.gz")}


def test_archive_query(spark):
    got = queries.QUERIES["op3_arc_to_warc"](spark, SF).collect()
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, got), key=order) == sorted(expected(pages), key=order)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p><p>no</p>";</script></head><body>
<div id="menu"><ul>{menu}</ul></div><div class="cookie-notice">We use cookies</div>
<div class="post"><h1>{head}</h1>{body}<div class="share">Share this</div></div>
<aside><p>{side}</p></aside><form><p>Search</p><input name=q></form><div class="comments"><p>{reader}</p></div><footer>&copy; host</footer></body></html>"""


def page(k):
    body = "".join(f"<p>Text {k} part {j} with <b>bold</b> &amp; more words to read here.</p>" for j in range(2 + k % 3))
    return PAGE.format(menu="<li><a href=x>Item</a></li>" * (3 + k % 2), head=f"Head {k}", body=body, side=f"Side {k} " * 5, reader=f"Reader {k} says")


def wanted(k):
    return "\n".join([f"Head {k}", *(f"Text {k} part {j} with bold & more words to read here." for j in range(2 + k % 3))])


def test_article_without_article_tag(spark):
    df = spark.createDataFrame([(k, "http://One.example:80/p", page(k), "q") for k in range(30)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in wrappers.extract(df).collect()}
    assert {k: r.text for k, r in got.items()} == {k: wanted(k) for k in range(30)}
    assert all(r.n_chars == len(r.text) for r in got.values())
    w = wrappers.wrappers(df).collect()
    assert len(w) == 1 and w[0].host == "one.example" and w[0].start == "<div.post"


def shape(items):
    return "".join({"t": x[1] if x[0] == "t" else "", "f": "=", "s": "_"}.get(x[0]) if x[0] in "tfs" else f"({shape(x[1])}){x[0]}" for x in items)


def test_wrapper_groups():
    """Texts that differ are slots, repeated stretches repeat, what one page lacks is optional."""
    a = wrappers.skeleton("<div><h1>Same</h1><ul><li>x<li>y</ul><p>one</p></div>")
    b = wrappers.skeleton("<div><h1>Same</h1><ul><li>z</ul><hr><div class=n>new</div><p>two</p></div>")
    w = wrappers.infer([a, b])
    assert shape(w) == "<div.<h1.=>h1<ul.(<li._>li)+>ul(<div.n=>div)?<p._>p>div"
    assert shape(wrappers.infer([b, a])) == shape(w)
    assert wrappers.infer([]) == [] and wrappers.infer([[], []]) == []


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b<br>c", "a\nb c"), ("<article><p>x &lt;b&gt; &#233;&eacute;&nbsp;y</article>z", "x <b> éé y"),
    ("<article><p><b>one<br><p>two<ul><li>l1<li>l2</ul></article>", "one\ntwo\nl1\nl2"), ("<body><nav>n</nav><p>t<!-- c --> u</p><footer>f", "t u"),
    ("<article>a <a href='x>y'>b</a> c<script>if(a<b){}</script></article>", "a b c"), ("<p>a < b & c</p>", "a < b & c"), ("<p>cut <a href=", "cut"),
    ("<article><div class='ad'>buy</div><p>t</p><div class=\"comments\"><p>c</p></div></article>", "t"), ("<p>" * 3000 + "deep", "deep")])
def test_main_text(html, text):
    assert wrappers.main_text(html, wrappers.article(wrappers.infer([wrappers.skeleton(html or "")]))) == text


def test_extract_edge_cases(spark):
    df = spark.createDataFrame([(1, None, None), (2, "odd", "<p>x"), (2, "odd", "<p>x"), (None, "http://h/", "<article>y</article>"), (5, "http://h/", "w " * 200_000)], "page_id long, url string, html string")
    got = sorted([(r.page_id or 0, r.text[:9], r.n_chars) for r in wrappers.extract(df).collect()])
    assert got == [(0, "y", 1), (1, "", 0), (2, "x", 1), (2, "x", 1), (5, "w w w w w", 399_999)]
    assert wrappers.extract(df.limit(0)).count() == 0


def test_pages_are_their_documents(spark):
    """Every page's text after its headline is one of the documents, line by line."""
    norm = lambda t: "\n".join(x for x in (" ".join(y.split()) for y in t.split("\n")) if x)
    docs = {norm(r[0]) for s in ("sf0.01", "sf0.1") for r in spark.read.parquet(f"/root/testdata/{s}/documents.parquet").select("text").collect()}
    got = queries.QUERIES["op8_html_extraction"](spark, SF).collect()
    assert len(got) == 250 and all(r.text.split("\n", 1)[1] in docs for r in got)


LONG = "A sentence of the post that goes on for a while. " * 5


@pytest.mark.parametrize("body, inner", [("home has-sidebar", "post"), ("nav-open", "post"), ("home", "post-body no-comments"), ("home", "layout-sidebar"), ("home", "social")])
def test_class_words_never_lose_a_host(spark, body, inner):
    """Classes of the body or of what holds the article leave its text; real boilerplate stays out."""
    html = (f'<html><body class="{body}"><div class="site-nav"><a>Home</a></div><div class="{inner}"><h1>Head %d</h1><p>{LONG}%d</p>'
            '<div class="comments"><p>First!</p></div></div><div class="page-footer">Imprint</div></body></html>')
    df = spark.createDataFrame([(k, f"http://a.example/{k}", html % (k, k)) for k in range(6)], "page_id long, url string, html string")
    want = {k: f"Head {k}\n{LONG}{k}" for k in range(6)}
    got = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    assert got == want


def test_marked_holder_of_the_article():
    html = f'<body><div class="widget"><article><p>{LONG}</p></article></div><div class="related"><p>More</p></div></body>'
    assert wrappers.main_text(html, "<article.") == LONG.strip()
    both = f'<body><article><p>{LONG}</p></article><div class="related"><article><p>Teaser</p></article></div></body>'
    assert wrappers.main_text(both, "<article.") == LONG.strip()


SAID = "This very sentence stands in the article of each page and belongs to the template only."


def texts(spark, htmls, url="http://one.example/p"):
    df = spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string").selectExpr("page_id", f"'{url}' AS url", "html")
    return [r.text for r in wrappers.extract(df).orderBy("page_id").collect()]


def test_fixed_text_of_the_template_is_no_main_text(spark):
    body = "<html><body><article><h1>Head {0}</h1><p>Words of page {0} that no other has.</p>{1}<ul><li>point {0}</ul></article></body></html>"
    assert texts(spark, [body.format(k, f"<div>{SAID}</div>") for k in range(8)]) == [f"Head {k}\nWords of page {k} that no other has.\npoint {k}" for k in range(8)]
    # copies of one page show nothing about the template, nor do three pages
    assert texts(spark, [body.format(1, f"<div>{SAID}</div>")] * 9) == [f"Head 1\nWords of page 1 that no other has.\n{SAID}\npoint 1"] * 9
    assert all(SAID in t for t in texts(spark, [body.format(k, f"<div>{SAID}</div>") for k in range(3)]))
    # half of the pages without it: the text is not the template's
    got = texts(spark, [body.format(k, f"<div>{SAID}</div>" if k % 2 else "<div>other</div>") for k in range(40)])
    assert sum(SAID in t for t in got) == 20
    # near copies: same heading and first paragraph, one paragraph of their own
    near = [f"<article><h1>Head</h1><p>{SAID}</p><div>Part {k} of its own, longer than all that the others share, {'w' * 99}</div></article>" for k in range(9)]
    assert all(SAID in t for t in texts(spark, near))


def test_container_with_a_page_id_in_its_class(spark):
    html = "<body><div class=menu-bar><p>Menu of page {0}</p></div><div class='post-{0}'><h1>H{0}</h1><p>Long text of page {0}, the words that matter here.</p></div><div class=imprint><p>Imprint {0}</p></div></body>"
    assert texts(spark, [html.format(k) for k in (7, 17, 140, 2, 33)]) == [f"H{k}\nLong text of page {k}, the words that matter here." for k in (7, 17, 140, 2, 33)]


def test_numbers_that_both_pages_have_stay():
    a, b = (wrappers.skeleton(f"<div class=col-8><p>{k}</p></div><div class=col-4><p>x{k}</p></div><div class=id-{k}>z</div>") for k in (1, 2))
    assert shape(wrappers.infer([a, b])) == "<div.col-8<p._>p>div<div.col-4<p._>p>div<div.id-*=>div"


def test_faint_marks_and_whole_forms(spark):
    html = "<article><h1>T</h1><section id='related-work'><p>Earlier studies {0}</p></section><p class='ad-hoc'>An ad-hoc way {0}</p></article>"
    assert texts(spark, [html.format(0)]) == ["T\nEarlier studies 0\nAn ad-hoc way 0"]
    # an element with such a mark on most pages of the template is a standing part of it
    own = "<article><h1>T{0}</h1><p>Main words {0} of this page</p><div class='ad-slot'><p>Buy {0}</p></div></article>"
    assert texts(spark, [own.format(k) for k in range(5)]) == [f"T{k}\nMain words {k} of this page" for k in range(5)]
    form = "<body><form action=x><div class=menu><p>Menu</p></div><div id=main><p>All the text of an old page {0}</p></div><input name=q></form></body>"
    assert texts(spark, [form.format(0)]) == ["All the text of an old page 0"]
    assert texts(spark, ["<article><p>Main words of this page</p><form><p>Search</p></form></article>"]) == ["Main words of this page"]


def test_two_templates_of_a_host(spark):
    one = "<body><div class=top><p>Top</p></div><div class=story><h1>S{0}</h1><p>Story of page {0} at length</p></div><table><tr><td>t{0}</table></body>"
    two = "<body><section><h2>x</h2><blockquote>y{0}</blockquote></section><main><h3>M{0}</h3><pre>Main of page {0} at length</pre></main></body>"
    got = texts(spark, [(one if k % 2 else two).format(k) for k in range(10)])
    assert got == [f"S{k}\nStory of page {k} at length" if k % 2 else f"M{k}\nMain of page {k} at length" for k in range(10)]


def test_lists_of_different_items_align():
    a, b = wrappers.skeleton("<ul><li>x<li>y</ul>"), wrappers.skeleton("<ul><li><p>x</p></li><li><p>y</p></li></ul>")
    w = wrappers.infer([a, b])
    assert all(None not in wrappers.match(w, page) for page in (a, b))


@pytest.mark.parametrize("seed", range(40))
def test_match_against_pages_made_from_a_wrapper(seed):
    """Pages drawn from a wrapper whose tags all differ: every token comes back to the item that made it."""
    rng, n = random.Random(seed), iter(range(10_000))

    def block(depth):
        name = f"<x{next(n)}."
        inner = [part(depth - 1) for _ in range(rng.randrange(3))] if depth else []
        return [["t", name], *inner, *([["s", 1]] if rng.random() < 0.5 else []), ["t", ">" + name[1:-1]]]

    def part(depth):
        group = block(depth)
        return [rng.choice("+?"), group]

    def write(items, out):
        for w in items:
            if w[0] in "+?":
                for _ in range(rng.randrange(1, 4) if w[0] == "+" else rng.randrange(2)):
                    write(w[1], out)
            else:
                out.append((f"#1.{rng.randrange(99)}" if w[0] == "s" else w[1], w))

    wrapper = [x for _ in range(3) for x in ([part(2)] if rng.random() < 0.5 else block(2))]
    for _ in range(5):
        made = []
        write(wrapper, made)
        got = wrappers.match(wrapper, [t for t, _ in made])
        assert all(g is w for g, (_, w) in zip(got, made, strict=True))
        # a stretch that the wrapper doesn't know leaves all else in place
        at = rng.randrange(len(made) + 1)
        extra = [t for t, _ in made[:at]] + ["<odd.", "#3.3", ">odd"] + [t for t, _ in made[at:]]
        got = wrappers.match(wrapper, extra)
        assert got[at] is None and got[at + 2] is None


@pytest.mark.parametrize("chunk", [3, 256])
def test_every_page_takes_part_in_its_template(spark, chunk):
    """One page of 60 says something else where the others say the same: the text is not the
    template's, whichever page that is; so with parts of a host aligned part by part."""
    body = "<html><body><article><h1>Head {0}</h1><p>Words of page {0} that no other has.</p><div>{1}</div></article><p class=end>{0}</p></body></html>"
    rows = [(k + 100 * odd, f"http://h{odd}.example/{k}", body.format(k, "Other words" if k == odd else SAID)) for odd in (7, 30, 58, 99) for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in wrappers.extract(df, chunk).collect()}
    assert got == {k + 100 * odd: f"Head {k}\nWords of page {k} that no other has." + ("" if odd == 99 else "\nOther words" if k == odd else f"\n{SAID}")
                   for odd in (7, 30, 58, 99) for k in range(60)}


def test_a_block_on_few_pages_is_no_standing_one(spark):
    """A faint mark counts by all pages of the template: here by 40 of 90, and by 50 of 90."""
    own = "<article><h1>T{0}</h1><p>Main words {0} of this page</p>{1}</article>"
    rows = [(k + 100 * n, f"http://h{n}.example/{k}", own.format(k, f"<div class='ad-slot'><p>Buy {k}</p></div>" if k < n else "")) for n in (40, 50) for k in range(90)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(df, 4).collect()}
    assert got == {k + 100 * n: f"T{k}\nMain words {k} of this page" + (f"\nBuy {k}" if n == 40 and k < n else "") for n in (40, 50) for k in range(90)}


def test_wrappers_stay_bounded():
    """A block of its own on every page: the wrapper keeps a bounded number of leaves, what all
    pages share, and the weight of the container whose blocks went."""
    html = "<body><div class=top><p>Top</p></div><div class=story><h1>S{0}</h1><section class={1}><p>{2} {0}</p></section></div><div class=low><p>a{0} few words</p></div></body>"
    names = ["".join("abcdefgh"[int(d)] for d in f"{k:04o}") for k in range(900)]
    pages = [wrappers.skeleton(html.format(k, n, LONG)) for k, n in enumerate(names)]
    parts = [t for lo in range(0, 900, 150) for t in wrappers.templates(pages[lo : lo + 150], [1] * 150)]
    tags, wrapper, n, *_ = wrappers.gathered(parts)[0]
    assert n == 900 and sum(1 for _ in wrappers._leaves(wrapper)) <= wrappers.ROOM * max(map(len, pages))
    assert wrappers.article(wrapper) == "<div.story"
    [[total, on, *_]] = wrappers.survey([[tags, wrapper]], pages, [1] * 900)
    assert total == 900 and {w[1] for at, w in enumerate(wrappers._leaves(wrapper)) if w[0] == "t" and on.get(at) == 900} >= {"<div.story", "<div.top", "<h1."}


def test_many_templates_of_a_host(spark):
    """More templates than are kept: pages of the others are extracted by themselves."""
    rows = [(k, "http://one.example/p", f"<body>{''.join(f'<x{k}y{j}z><p>m</p></x{k}y{j}z>' for j in 'abcdef')}<main><p>Main of page {k}</p></main></body>".replace("<x", f"<{chr(97 + k % 26)}{chr(97 + k // 26)}")
             .replace("</x", f"</{chr(97 + k % 26)}{chr(97 + k // 26)}")) for k in range(90)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extract(df, 8).collect()} == {k: f"Main of page {k}" for k in range(90)}
    assert len(json.loads(zlib.decompress(wrappers.wrappers(df, 8).first().templates))) == wrappers.KINDS


def test_join_of_optional_parts():
    """Two wrappers with the same optional blocks join without doubling them, and match the pages of both."""
    make = lambda k, *on: wrappers.skeleton("<div>" + "".join(f"<{x}><p>{k}</p></{x}>" for x in ("h2", "ul", "ol", "pre") if x in on) + f"<p>{k}</p></div>")
    pages = [make(1), make(2, "h2"), make(3, "h2", "ol"), make(4, "ul"), make(5, "ul", "pre"), make(6, "pre")]
    one, two = wrappers.templates(pages[::2], [1] * 3), wrappers.templates(pages[1::2], [1] * 3)
    [[_, wrapper, n, *_]] = wrappers.gathered(one + two)
    assert n == 6 and all(None not in wrappers.match(wrapper, p) for p in pages)
    assert sum(1 for x in wrappers._leaves(wrapper) if x[0] == "t" and x[1][0] == "<") <= 12
