"""Main text of web pages by inferred wrappers.

The pages of a host come from one template or a few. A template's wrapper is a
union-free regular expression over tags and text: token streams of all the host's
pages are aligned one after the other; where they differ, two texts make a text
slot, a repeated stretch makes a group that may repeat, and what only one of them
has makes an optional group. Wrappers of parts of a host are aligned in the same way,
part by part. Every page is then matched against the wrapper of its template, which
counts what is fixed or standing, and again for its text. The container whose slots carry the text is the article; a page's main
text is what stands in that container, without the texts that the wrapper shows to
be fixed over unlike pages and without what is marked as something else. A mark
that says little (``ad-hoc``) counts only where the wrapper has the element as a
standing part of the template.
"""

from __future__ import annotations

import html as markup
import json
import re
import zlib
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import stored
from claimlens.operators.stats import bounded_broadcast

#: Unlike skeletons, or wrappers of parts of a host, that one task aligns at once.
CHUNK = 256
#: Leaves of a wrapper, as a multiple of its longest page, above which the rarest optional ones go.
ROOM = 16
#: Templates that are kept of a host; pages unlike all of them are templates of their own.
KINDS = 64
#: Compressed templates of all hosts that a broadcast may hold.
BROADCAST_BYTES = 32 << 20
#: Unlike pages that a text must be the same on, at the same place, to be part of the template.
FIXED_FROM = 4
#: Share of tags that two pages of one template have in common, of those that either has.
ALIKE = 0.5
#: Tags of the longest stretch that is tried as a repeated group.
LONGEST = 24
#: Elements that never hold main text; those whose content isn't markup.
APART = frozenset("nav header footer aside button select textarea script style noscript template svg iframe head title dialog menu object canvas".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
#: Words in class, id or role that mark an element as no part of the article.
MARKED = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus "
                   "footer header masthead menu nav navbar navigation newsletter notice notices pagination popup promo promoted related "
                   "reply replies share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
#: Words before a marked one by which a class says what an element has or lacks, and not what it is.
ABOUT = frozenset("no not non without with has have hide".split())
#: Elements that are never marked.
WHOLE = frozenset(("html", "body"))
#: Elements without an end tag, and those that go on inside a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var wbr".split())
#: Elements that end an open one of the given names.
CLOSES = {"body": {"head"}, "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>|<[/a-zA-Z!?][^>]*\Z|([^<]+|<)", re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_END = {name: re.compile(rf"</{name}\b[^>]*>|\Z", re.I) for name in RAW}


def tokens(html: str):
    """(kind, name, marks, text) of a page: kind ``<`` begins an element, ``>`` ends
    one, ``#`` is text. Comments, declarations and contents that aren't markup are left out."""
    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.match(html, at)
        at = m.end()  # a tag that never ends is no text
        if m[4] is not None:
            yield "#", "", "", m[4]
        elif m[2]:
            name = m[2].lower()
            if m[1]:
                yield ">", name, "", ""
                continue
            named = " ".join(x for t in _NAMED.findall(m[3]) for x in t if x).lower() if "=" in m[3] else ""
            yield "<", name, named, ""
            if name in RAW and not m[3].endswith("/"):
                at = _END[name].search(html, at).end()
                yield ">", name, "", ""


@lru_cache(100_000)
def marked(name: str, marks: str) -> int:
    """2 for an element that a whole class, id or role marks as no part of the
    article (``comments``) and for a form, 1 if only a part of one does (``site-nav``,
    ``nav-open``), else 0. ``no-comments`` and ``has-sidebar`` mark nothing, nor do html and body."""
    if name == "form":
        return 2
    if not marks or name in WHOLE:
        return 0
    found = 0
    for token in marks.split():
        if token in MARKED:
            return 2
        for part in re.split(r"[^a-z0-9]+", token):
            if part in ABOUT:
                break
            found |= part in MARKED
    return int(found)


@lru_cache(100_000)
def faint(name: str, marks: str) -> bool:
    """Whether an element is marked by the first part of a name alone (``ad-hoc``,
    ``related-work``), which says what it is about as often as what it is."""
    if marked(name, marks) != 1:
        return False
    for token in marks.split():
        parts = [p for p in re.split(r"[^a-z0-9]+", token) if p]
        if any(p in ABOUT for p in parts):
            continue
        if sum(p in MARKED for p in parts) > 1 or (parts and parts[-1] in MARKED):
            return False
    return True


def _token(name: str, marks: str) -> str:
    return f"<{name}.{marks.split(' ')[0]}"


@lru_cache(100_000)
def general(token: str) -> str:
    """A start token without the numbers and ids in its mark: ``<div.post-17`` is ``<div.post-*``."""
    name, dot, mark = token.partition(".")
    return name + dot + re.sub(r"[a-z0-9]*\d[a-z0-9]*", "*", mark)


def fits(item: str, token: str) -> bool:
    """Whether a page's token is the one a wrapper asks for."""
    return item == token or "*" in item and token[0] == "<" and general(token) == item


def skeleton(html: str) -> list[str]:
    """What alignment sees: block elements with their first mark, ends that the page
    leaves out filled in, and for text its length and a check sum. Inline elements
    belong to the text around them."""
    return outline(tokens(html))[0]


def outline(seen) -> tuple[list[str], dict[int, int]]:
    """The skeleton of a page's tokens, and for each of them that begins a block or
    holds text its place in the skeleton."""
    out: list[str] = []
    path: list[str] = []
    places: dict[int, int] = {}
    waiting: list[int] = []
    held, size = 0, 0
    for at, (kind, name, marks, text) in enumerate(seen):
        if kind == "#":
            text = text.strip()
            if text:
                held, size = zlib.crc32(text.encode(), held), size + len(text)
                waiting.append(at)
            continue
        if name in INLINE or name in VOID:
            continue
        if size:
            places.update(dict.fromkeys(waiting, len(out)))
            waiting.clear()
            out.append(f"#{size}.{held}")
        held = size = 0
        if kind == "<":
            while path and path[-1] in CLOSES.get(name, ()):
                out.append(">" + path.pop())
            path.append(name)
            places[at] = len(out)
            out.append(_token(name, marks))
        elif name in path:
            while True:
                out.append(">" + path[-1])
                if path.pop() == name:
                    break
    if size:
        places.update(dict.fromkeys(waiting, len(out)))
        out.append(f"#{size}.{held}")
    return out + [">" + x for x in reversed(path)], places


# A wrapper is a list of items: ["t", tag, pages], ["f", check sum, pages, length] for a
# fixed text, ["s", pages, length] for a slot, ["+", items] for a group that may repeat,
# ["?", items] for an optional one, and ["r", lengths] where rare optional items stood
# (text outside marks, under a part of a class, under a whole mark). ``pages`` says how
# many were aligned here, lengths are sums over them.

def _same(a, b) -> bool:
    """Whether two items can stand for the same place of the template."""
    if a[0] in "fs" and b[0] in "fs":
        return True
    if a[0] != b[0]:
        return False
    return a[0] == "r" or (a[1] == b[1] if a[0] == "t" else len(a[1]) == len(b[1]) and all(map(_same, a[1], b[1])))


def _merge(a, b):
    """Of two pages' items."""
    if a[0] in "fs":
        pages, size = a[-2] + b[-2], a[-1] + b[-1]
        return ["f", a[1], pages, size] if a[0] == b[0] == "f" and a[1] == b[1] else ["s", pages, size]
    if a[0] == "t":
        return ["t", a[1], a[2] + b[2]]
    return [a[0], [x + y for x, y in zip(a[1], b[1], strict=True)] if a[0] == "r" else list(map(_merge, a[1], b[1]))]


def _gather(a, b):
    """Of two turns of a repeated group: a slot has the length of both."""
    if a[0] in "fs":
        return ["s", max(a[-2], b[-2]), a[-1] + b[-1]]
    if a[0] == "t":
        return ["t", a[1], max(a[2], b[2])]
    return _merge(a, b) if a[0] == "r" else [a[0], list(map(_gather, a[1], b[1]))]


def fold(items: list) -> list:
    """Neighbouring stretches of the same shape become one repeated group."""
    for width in range(1, LONGEST + 1):
        out, k = [], 0
        while k < len(items):
            n = k + width
            if n + width > len(items) or items[k][0] != "t" or items[k][1][0] != "<" or not _same(items[k], items[n]):
                out.append(items[k])
                k += 1
                continue
            group = items[k:n]
            whole = _balanced(group)
            first = n
            while whole and n + width <= len(items) and all(map(_same, group, items[n : n + width])):
                group = list(map(_gather, group, items[n : n + width]))
                n += width
            if n > first:
                out.append(["+", group])
                k = n
            else:
                out.append(items[k])
                k += 1
        items = out
    return items


def _balanced(group: list) -> bool:
    depth = 0
    for x in group:
        if x[0] == "t":
            depth += 1 if x[1][0] == "<" else -1
            if depth < 0:
                return False
    return not depth


def align(left: list, right: list) -> list:
    """The wrapper that matches whatever either of two matches. Equal items are kept, two
    texts become a slot, a group that repeats in one and stands alone in the other repeats,
    and what lies between two matches on one side only becomes optional."""
    out, i, j = [], 0, 0
    spots: list[dict[str, list[int]]] = [{}, {}]
    for items, where in zip((left, right), spots, strict=True):
        for k, x in enumerate(items):
            where.setdefault(_key(x), []).append(k)

    def ahead(x, items, where, at):
        places = where.get(_key(x), ())
        return next((k for k in places[bisect_left(places, at):] if _same(x, items[k])), None)

    while i < len(left) and j < len(right):
        a, b = left[i], right[j]
        if a[0] == "r" or b[0] == "r":
            _put(out, [a if a[0] == "r" else b])
            i, j = i + (a[0] == "r"), j + (a[0] != "r")
            continue
        maybe, other = a[0] == "?", b[0] == "?"
        one, two = a[1] if maybe else [a], b[1] if other else [b]
        if len(one) == len(two) and all(map(_same, one, two)):
            both = list(map(_merge, one, two))
            out.extend([["?", both]] if maybe or other else both)
            i, j = i + 1, j + 1
        elif maybe and not other:
            n = len(one)
            if len(right) - j >= n and all(map(_same, one, right[j : j + n])):
                out.append(["?", list(map(_merge, one, right[j : j + n]))])
                j += n
            else:
                out.append(a)
            i += 1
        elif other and not maybe:
            n = len(two)
            if len(left) - i >= n and all(map(_same, two, left[i : i + n])):
                out.append(["?", list(map(_merge, left[i : i + n], two))])
                i += n
            else:
                out.append(b)
            j += 1
        elif maybe:
            if ahead(b, left, spots[0], i + 1) is None and ahead(a, right, spots[1], j + 1) is not None:
                out.append(b)
                j += 1
            else:
                out.append(a)
                i += 1
        elif n := _alone(a, right, j):
            out.append(["+", list(map(_merge, a[1], right[j : j + n]))])
            i, j = i + 1, j + n
        elif n := _alone(b, left, i):
            out.append(["+", list(map(_merge, b[1], left[i : i + n]))])
            i, j = i + n, j + 1
        else:
            # the nearest place where one goes on as the other does
            on, back = ahead(a, right, spots[1], j), ahead(b, left, spots[0], i + 1)
            if on is not None and (back is None or on - j <= back - i):
                _put(out, right[j:on])
                j = on
            else:
                end = back if back is not None else i + 1
                _put(out, left[i:end])
                i = end
    _put(out, left[i:])
    _put(out, right[j:])
    return out


def _put(out: list, stretch: list) -> None:
    """Appends what only one side has: optional as a whole, or item by item if parts of it are."""
    if stretch and not any(x[0] in "?r" for x in stretch):
        out.append(["?", stretch])
        return
    for x in stretch:
        if x[0] == "r" and out and out[-1][0] == "r":
            out[-1] = _merge(out[-1], x)
        else:
            out.append(x if x[0] in "?r" else ["?", [x]])


def bounded(wrapper: list, longest: int) -> list:
    """A wrapper of more than ``ROOM`` times the leaves of its longest page without its
    rarest optional items, so that half of that is left. All leaves together are aligned with
    ``longest`` tokens a page at most, so what goes stands on a small share of the pages: it
    is neither fixed nor standing. The length of its texts stays, for the container's weight."""
    room = ROOM * max(longest, 1)
    if sum(1 for _ in _leaves(wrapper)) <= room:
        return wrapper
    sizes = {k: [sum(1 for _ in _leaves([x])), max((y[-2] if y[0] != "t" else y[2] for y in _leaves([x]) if y[0] != "r"), default=0)]
             for k, x in enumerate(wrapper) if x[0] == "?"}
    left = room // 2 - sum(1 for x in wrapper if x[0] != "?" for _ in _leaves([x]))
    kept = set()
    for k in sorted(sizes, key=lambda k: (-sizes[k][1], k)):
        left -= sizes[k][0]
        if left < 0:
            break
        kept.add(k)
    out: list = []
    for k, x in enumerate(wrapper):
        if x[0] != "?" or k in kept:
            out.append(x)
        else:
            _put(out, [["r", _lengths(x[1])]])
    return out


def _lengths(items: list) -> list:
    sizes, path = [0, 0, 0], []
    for x in _leaves(items):
        if x[0] == "t" and x[1][0] == "<":
            path.append(_apart(x[1]))
        elif x[0] == "t":
            if path:
                path.pop()
        elif x[0] == "r":
            level = max(path, default=0)
            for k, n in enumerate(x[1]):
                if max(level, k) < 3:
                    sizes[max(level, k)] += n
        elif max(path, default=0) < 3:
            sizes[max(path, default=0)] += x[-1]
    return sizes


def _key(x) -> str:
    return "#" if x[0] in "fs" else x[1] if x[0] == "t" else "r" if x[0] == "r" else x[0] + _key(x[1][0])


def _alone(group, items: list, at: int) -> int:
    """Length of one occurrence of a repeated group that begins at ``at``, else 0."""
    if group[0] != "+":
        return 0
    n = len(group[1])
    return n if len(items) - at >= n and all(map(_same, group[1], items[at : at + n])) else 0


def _leaves(items: list):
    for x in items:
        if x[0] in "+?":
            yield from _leaves(x[1])
        else:
            yield x


def unify(wrapper: list, page: list) -> None:
    """Start tags that differ in numbers or ids only, each on one side alone, become
    the same (``<div.post-*``). Those that both sides have (``col-8``, ``col-4``) stay."""
    left, right = ({x[1] for x in _leaves(side) if x[0] == "t"} for side in (wrapper, page))
    both = {general(t) for t in left - right} & {general(t) for t in right - left}
    for side, other in ((wrapper, right), (page, left)):
        for x in _leaves(side):
            if x[0] == "t" and x[1] not in other and general(x[1]) in both:
                x[1] = general(x[1])


def infer(pages: list[list[str]], counts: list[int] | None = None) -> list:
    """Wrapper of skeletons, from the shortest page to the longest; of each there are
    ``counts`` copies. Pages with the same tags are one before they are aligned."""
    alike: dict[tuple, list] = {}
    for page, n in sorted(zip(pages, counts or [1] * len(pages), strict=True), key=lambda p: (len(p[0]), p[0])):
        items = [_text_item(x, n) if x[0] == "#" else ["t", x, n] for x in page]
        tags = _tags(page)
        alike[tags] = list(map(_merge, alike[tags], items)) if tags in alike else items
    wrapper: list | None = None
    for tags, items in alike.items():
        wrapper = fold(items) if wrapper is None else joined(wrapper, fold(items), len(tags))
    return wrapper or []


def joined(left: list, right: list, longest: int) -> list:
    """Wrapper of two wrappers' pages, of which the longest has ``longest`` tokens."""
    unify(left, right)
    return bounded(fold(align(left, right)), longest)


def _tags(page: list[str]) -> tuple[str, ...]:
    return tuple("#" if x[0] == "#" else x for x in page)


def _text_item(token: str, n: int = 1) -> list:
    size, _, held = token[1:].partition(".")
    return ["f", int(held), n, n * int(size)]


def match(wrapper: list, page: list[str]) -> list:
    """For each token of a page's skeleton the wrapper's item that it stands at, or
    None where the wrapper has nothing for it. Groups match as a whole or not at all;
    after a mismatch both go on at the nearest place where they agree again."""
    found: list = [None] * len(page)
    where: dict[str, list[int]] = {}
    for k, x in enumerate(page):
        for key in {x, general(x)} if x[0] == "<" else ("#" if x[0] == "#" else x,):
            where.setdefault(key, []).append(k)

    def one(w, j, out):
        if w[0] == "r":
            return j
        if w[0] in "tfs":
            if j < len(page) and (fits(w[1], page[j]) if w[0] == "t" else page[j][0] == "#"):
                out.append((j, w))
                return j + 1
            return -1
        got: list = []
        end = run(w[1], j, got)
        while end >= 0:
            out.extend(got)
            if w[0] == "?" or end == j:
                return end
            j, got = end, []
            end = run(w[1], j, got)
            if end < 0:
                return j
        return j if w[0] == "?" else -1

    def run(items, j, out):
        for w in items:
            j = one(w, j, out)
            if j < 0:
                return -1
        return j

    i = j = 0
    while i < len(wrapper) and j < len(page):
        out: list = []
        end = one(wrapper[i], j, out)
        if end >= 0:
            for k, w in out:
                found[k] = w
            i, j = i + 1, end
            continue
        first = next(_leaves([wrapper[i]]), None)
        spots = where.get("#" if first is None or first[0] in "fsr" else first[1], ())
        k = bisect_left(spots, j + 1)
        ahead = spots[k] if k < len(spots) else None
        back = next((k for k in range(i + 1, len(wrapper)) if wrapper[k][0] != "?" and one(wrapper[k], j, []) >= 0), None)
        if ahead is not None and (back is None or ahead - j <= back - i):
            j = ahead
        else:
            i = back if back is not None else i + 1
    return found


def _texts(page: list[str]) -> tuple[dict[str, int], set[str]]:
    """Texts of a page with their lengths, and those that are headings."""
    heads = {x for before, x in zip(page, page[1:], strict=False) if x[0] == "#" and re.match(r"<h\d\.", before)}
    return {x: int(x[1:].partition(".")[0]) for x in page if x[0] == "#"}, heads


def unlike(pages: list, sizes) -> dict[int, list]:
    """For each length of a text that stands on all pages, at most ``FIXED_FROM`` unlike
    ones but for that text, those for a smaller length among them: pages (texts with
    their lengths, headings) are alike if they share a heading, or over half of the shorter
    one's text. Of two parts' pages it suffices to give those that it chose of each."""
    chosen: list = []
    out = {}
    for size in sorted(sizes):
        for own, heads in pages:
            if len(chosen) >= FIXED_FROM:
                break
            total = sum(own.values())
            if not any(heads & h or 2 * (sum(n for x, n in own.items() if x in t) - size) >= min(total, sum(t.values())) - size for t, h in chosen):
                chosen.append((own, heads))
        out[size] = list(chosen)
    return out


def survey(known: list, pages: list[list[str]], counts: list[int]) -> list:
    """What pages show of their ``templates``: for each [pages, {leaf: pages on which it
    stands}, {leaf: length} of fixed texts, unlike pages]; a fixed text stands where it is
    the same and no heading."""
    shapes = [frozenset(t[0]) for t in known]
    leaves = [list(_leaves(t[1])) for t in known]
    numbers = [{id(w): at for at, w in enumerate(own)} for own in leaves]
    out: list = [[0, {}, {at: w[3] // w[2] for at, w in enumerate(own) if w[0] == "f"}, []] for own in leaves]
    met: dict = {}
    seen: list = [[] for _ in known]
    for page, n in zip(pages, counts, strict=True):
        tags = _tags(page)
        if tags not in met:
            k = nearest(shapes, page)
            met[tags] = (None, []) if _alone_of_its_kind(shapes, k, page) else (k, [None if w is None else numbers[k][id(w)] for w in match(known[k][1], page)])
        k, found = met[tags]
        if k is None:
            continue
        own, heads = _texts(page)
        items = leaves[k]
        on = {at for token, at in zip(page, found, strict=True) if at is not None and
              (items[at][0] == "t" or items[at][0] == "f" and token not in heads and _text_item(token)[1] == items[at][1])}
        out[k][0] += n
        for at in on:
            out[k][1][at] = out[k][1].get(at, 0) + n
        seen[k].append((own, heads))
    return [_closed(*part[:3], own) for part, own in zip(out, seen, strict=True)]


def _closed(total: int, on: dict, fixed: dict, pages: list) -> list:
    """A part's survey with the unlike ones of its pages, for the fixed texts that stand on all."""
    got = unlike(pages, {size for at, size in fixed.items() if on.get(at) == total})
    return [total, on, fixed, [[own, sorted(heads)] for own, heads in max(got.values(), key=len, default=[])]]


def added(surveys: list) -> list:
    """The ``survey`` of all pages from those of parts, as JSON has them."""
    out = []
    for parts in zip(*surveys, strict=True):
        on: dict = {}
        for p in parts:
            for at, n in p[1].items():
                on[at] = on.get(at, 0) + n
        out.append(_closed(sum(p[0] for p in parts), on, parts[0][2], [(own, frozenset(heads)) for p in parts for own, heads in p[3]]))
    return out


def annotate(wrapper: list, part: list) -> list:
    """The wrapper with what the ``survey`` of its pages shows: a fixed text, no heading, that
    stands on all pages, ``FIXED_FROM`` unlike ones or more, is part of the template (["f",
    check sum, pages, length, 1]); a tag that stands on three pages or more and on half of
    them at least is a standing one (["t", tag, pages, 1])."""
    total, on, fixed, pages = part
    on, fixed = {int(at): n for at, n in on.items()}, {int(at): n for at, n in fixed.items()}
    got = unlike([(own, frozenset(heads)) for own, heads in pages], {size for at, size in fixed.items() if on.get(at) == total})
    for at, w in enumerate(_leaves(wrapper)):
        n = on.get(at, 0)
        if w[0] == "f" and n == total >= FIXED_FROM and len(got[fixed[at]]) >= FIXED_FROM or \
                w[0] == "t" and w[1][0] == "<" and n >= 3 and 2 * n >= total:
            w.append(1)
    return wrapper


def _shape(page: list[str]) -> frozenset[str]:
    return frozenset(general(x) for x in page if x[0] == "<")


def _alike(a, b) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def nearest(shapes: list, page: list[str]) -> int:
    """Which template is most like a page."""
    if len(shapes) == 1:
        return 0
    own = _shape(page)
    return max(range(len(shapes)), key=lambda k: (_alike(shapes[k], own), -k))


def _alone_of_its_kind(shapes: list, k: int, page: list[str]) -> bool:
    """Whether a page may be of a template that wasn't kept: it is unlike even the nearest."""
    return len(shapes) >= KINDS and _alike(shapes[k], _shape(page)) < ALIKE


def gathered(parts: list) -> list:
    """[tags, wrapper, pages, shortest, longest] of each template of a host from those of
    parts of it, the one with most pages first. A part belongs to the first template whose
    shortest page shares half of the tags with its own. ``KINDS`` templates stay."""
    groups: list[tuple[frozenset, list]] = []
    for part in sorted(parts, key=lambda p: (p[3], sorted(p[0]))):
        own = frozenset(part[0])
        group = next((g for tags, g in groups if _alike(tags, own) >= ALIKE), None)
        if group is None:
            groups.append((own, group := []))
        group.append(part)
    out = []
    for tags, group in groups:
        wrapper, longest = group[0][1], group[0][4]
        for part in group[1:]:
            longest = max(longest, part[4])
            wrapper = joined(wrapper, part[1], longest)
        out.append([sorted(tags), wrapper, sum(p[2] for p in group), group[0][3], longest])
    return sorted(out, key=lambda t: -t[2])[:KINDS]


def templates(pages: list[list[str]], counts: list[int]) -> list:
    """``gathered`` of skeletons, of each of which there are ``counts`` copies."""
    groups: list[tuple[frozenset, list]] = []
    for page, n in sorted(zip(pages, counts, strict=True), key=lambda p: (len(p[0]), p[0])):
        own = _shape(page)
        group = next((g for tags, g in groups if _alike(tags, own) >= ALIKE), None)
        if group is None:
            groups.append((own, group := []))
        group.append((page, n))
    return gathered([[sorted(tags), infer(*map(list, zip(*group, strict=True))), sum(n for _, n in group), len(group[0][0]), len(group[-1][0])]
                     for tags, group in groups])


@lru_cache(512)
def _known(packed: bytes) -> tuple:
    return tuple((frozenset(tags), wrapper, start) for tags, wrapper, start in json.loads(zlib.decompress(packed)))


def page_text(html: str | None, packed: bytes | None) -> str:
    """Main text of a page by the ``templates`` of its host (JSON, compressed): it is
    matched against the wrapper of the template most like it."""
    seen = list(tokens(html or ""))
    known = _known(packed) if packed else ()
    if not known:
        return main_text(html, "", seen)
    own, places = outline(seen)
    shapes = [t[0] for t in known]
    _, wrapper, start = known[k := nearest(shapes, own)]
    if _alone_of_its_kind(shapes, k, own):
        wrapper = infer([own])
        start = article(wrapper)
    found = match(wrapper, own)
    fixed, standing = set(), set()
    for at, k in places.items():
        w = found[k]
        if w is None:
            continue
        if w[0] == "t" and len(w) == 4:
            standing.add(at)
        elif w[0] == "f" and len(w) == 5 and _text_item(own[k])[1] == w[1]:
            fixed.add(at)
    return main_text(html, start, seen, fixed, standing)


def article(wrapper: list) -> str:
    """Start token of the container that is the host's article: ``article`` or
    ``main`` where the template has one with text, else the deepest container that
    holds over half of the template's text outside what is marked as something else.
    A part of a class marks no container that holds over half of the text, and no
    mark counts for one that holds over half of it in an ``article`` or ``main`` or beside an h1."""
    def weigh(apart, least):
        """Of what ``apart`` leaves; of rare items that of marks below ``least``. A container
        that stands on fewer pages than the text below it counts for their share of it only,
        and an end closes starts that stand on as many pages in all."""
        weight: dict[tuple, float] = {}
        total = 0.0
        path: list[str] = []
        open_: list[int] = []

        def walk(items):
            nonlocal total
            for x in items:
                if x[0] == "t" and x[1][0] == "<":
                    path.append(x[1])
                    open_.append(x[2])
                elif x[0] == "t":
                    left = x[2]
                    for k in range(len(path) - 1, -1, -1):
                        if left and path[k][1:].partition(".")[0] == x[1][1:]:
                            took = min(left, open_[k])
                            left -= took
                            open_[k] -= took
                            if not open_[k]:
                                del path[k], open_[k]
                elif x[0] in "+?":
                    walk(x[1])
                else:
                    shares = [1.0 if x[0] == "r" else min(1.0, n / x[-2]) for n in open_]
                    free = 1 - max((shares[k] for k in range(len(path)) if apart(path, k)), default=0.0)
                    size = free * (sum(x[1][:least]) if x[0] == "r" else x[-1])
                    if not size:
                        continue
                    total += size
                    least_share = 1.0
                    for k in range(1, len(path) + 1):
                        key = tuple(path[:k])
                        least_share = min(least_share, shares[k - 1])
                        weight[key] = weight.get(key, 0.0) + size * least_share

        walk(wrapper)
        return weight, total

    bare, all_ = weigh(lambda path, k: _apart(path[k]) == 3, 3)
    headed = {k[:n] for k in bare if k[-1].startswith("<h1.") for n in range(1, len(k)) if 2 * bare[k[:n]] > all_}
    strong = lambda path, k: (a := _apart(path[k])) == 3 or a == 2 and tuple(path[: k + 1]) not in headed
    held, most = weigh(strong, 2)
    weight, total = weigh(lambda path, k: strong(path, k) or _apart(path[k]) == 1 and 2 * held.get(tuple(path[: k + 1]), 0) <= most, 1)
    if not total:
        weight, total = bare, all_
    plain = [k for k in weight if k[-1][1:].partition(".")[0] not in CLOSES and not re.match(r"<h\d\.", k[-1])]
    for name in ("<article.", "<main."):
        if own := [k for k in plain if k[-1].startswith(name)]:
            return max(own, key=lambda k: (weight[k], -len(k)))[-1]
        if own := [k for k in bare if k[-1].startswith(name) and 2 * bare[k] > all_]:
            return max(own, key=lambda k: (bare[k], -len(k)))[-1]
    half = [k for k in plain if 2 * weight[k] > total]
    return max(half, key=len)[-1] if half else ""


def _apart(token: str) -> int:
    """3 for an element that never holds main text, else as ``marked`` has it."""
    name, _, marks = token[1:].partition(".")
    return 3 if name in APART else marked(name, marks)


def main_text(html: str | None, start: str, seen: list | None = None, fixed=frozenset(), standing=frozenset()) -> str:
    """Text of the page's containers that begin as ``start`` says (of the whole body,
    if there is none), one line for each block. Character references are decoded.
    ``seen`` are its tokens; of these the texts in ``fixed`` belong to the template,
    and the elements in ``standing`` are on most of its pages.

    A marked element is left out, but not one that holds over half of the page's text
    and is marked by a part of a class only or holds an h1; nor one that holds the
    container, if there is none elsewhere; nor, if nothing is left, one with over half of the text;
    nor a form with over half of it. A ``faint`` mark counts for ``standing`` elements only."""
    seen = list(tokens(html or "")) if seen is None else seen
    if not any(kind == "<" and name not in APART and marked(name, marks) for kind, name, marks, _ in seen):
        found, inside = _blocks(seen, start, frozenset(), fixed)
        return "\n".join(found if inside else _blocks(seen, "", frozenset(), fixed)[0])
    most, holders, half = _spared(seen, start)
    most |= {k for k, (kind, name, marks, _) in enumerate(seen) if kind == "<" and (k in half and name == "form" or k not in standing and faint(name, marks))}
    found, inside = _blocks(seen, start, most, fixed)
    if not inside and holders:
        found, inside = _blocks(seen, start, most | holders, fixed)
    if not inside:
        found = _blocks(seen, "", most, fixed)[0] or _blocks(seen, "", most | half, fixed)[0]
    return "\n".join(found)


def _spared(seen: list, start: str):
    """Marked elements of a page, by their place in it: (1) what holds over half of its
    text and an h1, or over half of it outside whole marks, an h1 or a p and is marked by
    a part of a class; (2) what holds a container that begins as ``start`` says; (3) what
    holds over half of its text."""
    path: list[tuple[str, int, int]] = []  # name, place, 3 for apart or what ``marked`` says
    texts: list[tuple[int, list]] = []
    kinds: dict[int, int] = {}
    holders, headed, written = set(), set(), set()
    for at, (kind, name, marks, text) in enumerate(seen):
        if kind == "#":
            n = len(text.strip())
            if n and not any(a == 3 for _, _, a in path):
                texts.append((n, [k for _, k, a in path if a]))
        elif name in VOID:
            continue
        elif kind == "<":
            while path and path[-1][0] in CLOSES.get(name, ()):
                path.pop()
            if not any(a == 3 for _, _, a in path):
                around = [k for _, k, a in path if a]
                if start and fits(start, _token(name, marks)):
                    holders.update(around)
                if name == "h1":
                    headed.update(around)
                if name in ("h1", "p"):
                    written.update(around)
            kinds[at] = 3 if name in APART else marked(name, marks)
            path.append((name, at, kinds[at]))
        else:
            k = next((k for k in range(len(path) - 1, -1, -1) if path[k][0] == name), None)
            if k is None or (name in INLINE and any(n not in INLINE for n, _, _ in path[k + 1 :])):
                continue
            del path[k:]

    def halves(texts):
        size: dict[int, int] = {}
        for n, around in texts:
            for k in around:
                size[k] = size.get(k, 0) + n
        total = sum(n for n, _ in texts)
        return {k for k, n in size.items() if 2 * n > total}

    half = halves(texts)
    most = half & headed
    rest = halves([(n, around) for n, around in texts if all(kinds[k] == 1 or k in most for k in around)])
    return most | {k for k in rest & written if kinds[k] == 1}, holders, half


def _blocks(seen: list, start: str, spared, fixed):
    out: list[str] = []
    parts: list[str] = []
    path: list[tuple[str, bool]] = []  # open elements, and whether they are apart
    apart, inside = 0, not start
    level = 0 if not start else -1

    def close():
        text = " ".join(markup.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append(text)

    for at, (kind, name, marks, text) in enumerate(seen):
        if kind == "#":
            if level >= 0 and not apart and at not in fixed:
                parts.append(text)
            continue
        if name in VOID:
            if level >= 0 and not apart:
                if name == "hr":
                    close()
                elif name == "br":
                    parts.append(" ")
            continue
        if name not in INLINE and level >= 0 and not apart:
            close()
        if kind == "<":
            while path and path[-1][0] in CLOSES.get(name, ()):
                apart -= path.pop()[1]
            own = name in APART or (at not in spared and marked(name, marks) > 0)
            if level < 0 and fits(start, _token(name, marks)) and not apart:
                level, inside, own = len(path), True, False
            path.append((name, own))
            apart += own
        else:
            k = next((k for k in range(len(path) - 1, -1, -1) if path[k][0] == name), None)
            if k is None or (name in INLINE and any(n not in INLINE for n, _ in path[k + 1 :])):
                continue
            apart -= sum(a for _, a in path[k:])
            del path[k:]
            if start and level >= 0 and len(path) <= level:
                close()
                level = -1
    if level >= 0:
        close()
    return out, inside


def host(url):
    """Host of a URL column, in lower case; a null or odd URL has the host ''."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def _unpacked(skeleton: bytes) -> list[str]:
    return [x for x in zlib.decompress(skeleton).decode().split("\n") if x]


def _packed(value) -> bytes:
    return zlib.compress(json.dumps(value).encode())


def _by_chunk(rows: DataFrame, kind: str, width: int, chunk: int, first, merge) -> DataFrame:
    """(host, ``kind``), one row per host: ``first`` makes one of the rows (host, chunk, ...)
    of each of a host's ``width`` chunks, then ``chunk`` of them at a time become one by ``merge``."""
    def one(rows: DataFrame, make) -> DataFrame:
        def run(group: pa.Table) -> pa.Table:
            return pa.table({"host": group["host"].slice(0, 1), "chunk": group["chunk"].slice(0, 1), kind: pa.array([make(group)], pa.binary())})
        return rows.groupBy("host", "chunk").applyInArrow(run, f"host string, chunk int, {kind} binary")

    parts = one(rows, first)
    while width > 1:
        parts = one(parts.withColumn("chunk", F.floor(F.col("chunk") / chunk).cast("int")), merge)
        width = -(-width // chunk)
    return parts.select("host", kind)


def wrappers(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(host, wrapper, start, templates), one row per host: of its commonest template
    the wrapper, as JSON, and the start token of its article; and all ``templates``,
    compressed. All pages take part: copies of a skeleton are counted, each task aligns
    about ``chunk`` skeletons of a host, or wrappers of that many parts, and what is fixed or
    standing is counted by a match of every skeleton."""
    def skeletons(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([zlib.compress("\n".join(skeleton(h or "")).encode()) for h in b.column(1).to_pylist()], pa.binary())],
                names=["host", "skeleton"])

    drawn = stored(pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(skeletons, "host string, skeleton binary")
                   .groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("n")), "skeletons")
    chunks = drawn.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")).where("chunks > 1")
    width = chunks.agg(F.max("chunks")).first()[0] or 1
    # unlike skeletons spread evenly, whatever the ids and however many copies there are
    drawn = (drawn.join(bounded_broadcast(chunks), "host", "left")
             .select("host", F.pmod(F.xxhash64("skeleton"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk"), "skeleton", "n"))

    def learn(group: pa.Table) -> bytes:
        return _packed(templates([_unpacked(p) for p in group["skeleton"].to_pylist()], group["n"].to_pylist()))

    def together(group: pa.Table) -> bytes:
        parts = group["known"].to_pylist()
        return parts[0] if len(parts) == 1 else _packed(gathered([t for p in parts for t in json.loads(zlib.decompress(p))]))

    known = stored(_by_chunk(drawn, "known", width, chunk, learn, together), "known")

    def look(batches):
        for b in batches:
            own: dict = {}
            for h, c, p, n, k in zip(*(x.to_pylist() for x in b.columns), strict=True):
                own.setdefault((h, c, k), []).append((_unpacked(p), n))
            got = [_packed(survey(json.loads(zlib.decompress(k)), *map(list, zip(*seen, strict=True)))) for (_, _, k), seen in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _, _ in own], pa.string()), pa.array([c for _, c, _ in own], pa.int32()),
                                              pa.array(got, pa.binary())], names=["host", "chunk", "seen"])

    def total(group: pa.Table) -> bytes:
        return _packed(added([json.loads(zlib.decompress(s)) for s in group["seen"].to_pylist()]))

    seen = (_joined(drawn, known, "known").select("host", "chunk", "skeleton", "n", "known")
            .mapInArrow(look, "host string, chunk int, seen binary"))

    def finish(batches):
        for b in batches:
            rows = []
            for k, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                rows.append([[t[0], annotate(t[1], part), article(t[1])]
                             for t, part in zip(json.loads(zlib.decompress(k)), json.loads(zlib.decompress(s)), strict=True)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([json.dumps(r[0][1]) for r in rows], pa.string()),
                                              pa.array([r[0][2] for r in rows], pa.string()), pa.array([_packed(r) for r in rows], pa.binary())],
                                             names=["host", "wrapper", "start", "templates"])

    return (known.join(_by_chunk(seen, "seen", width, chunk, total, total), "host").select("host", "known", "seen")
            .mapInArrow(finish, "host string, wrapper string, start string, templates binary"))


def _joined(pages: DataFrame, known: DataFrame, name: str = "templates") -> DataFrame:
    """Pages with the templates of their host: these are broadcast while their counted
    bytes are below ``BROADCAST_BYTES``, else joined by host."""
    size = known.agg(F.sum(F.length(name) + F.length("host"))).first()[0] or 0
    return pages.join(bounded_broadcast(known) if size <= BROADCAST_BYTES else known, "host", "left")


def extract(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages`` (page_id, url, html).

    A null html is empty and gives an empty text; pages with a null or odd url
    share the host ''. Repeated rows give a row each."""
    own = pages.select("page_id", "url", "html")
    known = stored(wrappers(own, chunk).select("host", "templates"), "wrappers")
    joined = _joined(own.withColumn("host", host(F.col("url"))), known).select("page_id", "url", "html", "templates")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                text = [page_text(h, t) for h, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
