"""Main text of web pages: structure, and a suffix array over each host's pages.

Pages of one host are parsed together, in groups of bounded size (a host with more pages is
dealt over several groups by page). Each page becomes blocks of words, marked as main (inside
an article), chrome (menus, headers, footers, sidebars, notices, adverts, forms, comments) or
other. The token streams of the group are concatenated and each suffix gets a key by prefix
doubling up to ``RUN`` tokens; suffixes are sorted by it. Prefixes that stand on two pages of
the host are repeated substrings, and longer ones are their overlaps. A host of several
groups counts its pages over all of them: each group sends its distinct keys, once, to the
key's bucket and gets back those that are repeated. Where all pages have articles it first asks
which blocks begin as chrome does, and sends the keys of these blocks and of chrome only.

* Chrome goes.
* In a page without an article, tokens that repeated substrings cover go and unique runs stay.
  Pages with the same text outside chrome count as one. A page that has under ``LEAST_OWN``
  of its words for itself is a near copy: it loses only substrings that also stand in chrome.
* An article's block goes only if such substrings cover it wholly and each of them also
  stands in the chrome of some page of the host: passages that articles share are kept.

Scripts, styles, markup and comments in markup are never text. Null html gives an empty text,
a page whose address is null or names no
host is a host of its own. Cut-off pages are read to their end.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import text_or_empty, written

RUN = 8
GROUP_PAGES = 256
#: Share of its words that a page with less has in common with a near copy, not with boilerplate.
LEAST_OWN = 0.1
#: Groups of a host whose keys are counted in one task.
BUCKET_GROUPS = 64
_ODD, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
MAIN, CHROME, OTHER = 0, 1, 2

# Elements by their part in a page, and words of class, id or role that mark chrome.
_BREAKING = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table tbody tfoot thead tr "
    "ul".split()
)
_SPACING = frozenset("br td th img".split())
_CHROME = frozenset(
    "head nav header footer aside form menu button select textarea iframe noscript template svg object canvas audio "
    "video dialog".split()
)
_CHROME_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice "
    "notices pagination popup promo related search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar topbar widget alert".split()
)
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<raw>script|style|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"""
    r"""|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|(?P<text>[^<]+|<)""",
    re.I | re.S,
)
_MARKS = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_ENDS_P = _BREAKING | {"form", "nav", "p", "hr", "table"}
_CELLS, _LISTS = frozenset("td th tr tbody thead tfoot".split()), frozenset("ul ol menu dir".split())
#: Elements that end without a tag: at the start of which ones, unless inside which ones.
_IMPLICIT = {
    "p": (_ENDS_P, frozenset()), "li": (frozenset(("li",)), _LISTS), "dd": (frozenset(("dd", "dt")), frozenset(("dl",))),
    "dt": (frozenset(("dd", "dt")), frozenset(("dl",))), "td": (_CELLS, frozenset(("table",))),
    "th": (_CELLS, frozenset(("table",))), "tr": (_CELLS - {"td", "th"}, frozenset(("table",))),
    "option": (frozenset(("option", "optgroup")), frozenset(("select",))), "head": (_BREAKING, frozenset()),
}


def _marks_chrome(rest: str) -> bool:
    """By role, or by a class or id all of whose parts are chrome words (not ``has-sidebar``)."""
    for m in _MARKS.finditer(rest):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value in _CHROME_ROLES:
                return True
        elif m[1].lower() in ("class", "id"):
            if any(_CHROME_WORDS.issuperset(filter(None, _PARTS.split(n))) and _PARTS.sub("", n) for n in value.split()):
                return True
    return False


def _holders(tokens: list[re.Match]) -> set[int]:
    """Places of the main element and of the first article (inside it, if there is one), and of
    the elements around them. Those inside a chrome element do not count."""
    opened: list[tuple[str, int]] = []
    wanted = {"article"} | {"main" for m in tokens if m["name"] and not m["close"] and m["name"].lower() == "main"}
    inside = "main" in wanted
    out: set[int] = set()
    for m in tokens:
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["close"]:
            if any(n == name for n, _ in opened):
                while opened.pop()[0] != name:
                    pass
            continue
        if name in _VOID or m["rest"].endswith("/") or name == "p":
            continue
        opened.append((name, m.start()))
        if name in wanted and _CHROME.isdisjoint(n for n, _ in opened):
            if name == "main" or not inside or any(n == "main" for n, _ in opened):
                out.update(place for _, place in opened)
                wanted.discard(name)
                if not wanted:
                    break
    return out


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of each block in page order, white space inside a block made one space."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    chrome = ""  # the open chrome element
    within: list[str] = []  # open elements in it that matter for its end
    main: list[str] = []
    holders: set[int] | None = None

    def end_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append((CHROME if chrome else MAIN if main else OTHER, text))

    tokens = list(_TOKEN.finditer(page))
    for m in tokens:
        text = m["text"]
        if text is not None:
            parts.append(entities.unescape(text) if "&" in text else text)
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in _SPACING:
            parts.append(" ")
        if m["close"]:
            if name in _BREAKING or name in _CHROME:
                end_block()
            if chrome:
                if name in within:
                    while within.pop() != name:
                        pass
                    continue
                # Of an element that needs no end tag, its parent's end is the end.
                over = chrome in _IMPLICIT and name != "p" and (name in _BREAKING or name in _CHROME)
                if name == chrome or over or name == "body":
                    end_block()
                    chrome = ""
                if not over or name == "body":
                    continue
            if name in _MAIN and name in main:
                main.remove(name)
            continue
        rest = m["rest"]
        if name in _BREAKING or name in _CHROME:
            end_block()
        if chrome in _IMPLICIT:
            starts, scope = _IMPLICIT[chrome]
            if name in starts and scope.isdisjoint(within):
                end_block()
                chrome = ""
                within.clear()
        if name == "body":
            chrome = ""
            within.clear()
        if name in _VOID or rest.endswith("/"):
            continue
        if chrome:
            if name == chrome or (chrome in _IMPLICIT and name in _BREAKING):
                within.append(name)
            continue
        marked = name in _CHROME
        if not marked and rest and name not in ("html", "body", "main") and _marks_chrome(rest):
            # An article inside another one may be a comment.
            if name != "article" or "article" in main:
                if holders is None:
                    holders = _holders(tokens)
                marked = m.start() not in holders
        if marked:
            end_block()
            chrome = name
            within.clear()
        elif name in _MAIN:
            main.append(name)
    end_block()
    return out


def _hashed(strings: list[str]) -> np.ndarray:
    digests = [blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest() for s in strings]
    return np.frombuffer(b"".join(digests), "<u8")


class Windows:
    """The ``RUN``-token windows of a group's pages, in token order: ``place`` of the first token,
    ``key``, ``owner`` (number of the page) and ``chrome`` (begins in chrome).

    Equal keys mean equal windows: each doubling mixes the hashes of two neighbours, so that
    keys of any group can be compared. No window runs over the end of a page.
    """

    def __init__(self, parsed: list[list[tuple[int, str]]]):
        numbers: defaultdict[str, int] = defaultdict(count().__next__)
        tokens: list[int] = []
        owner, kinds, sizes = [], [], []
        for i, page in enumerate(parsed):
            for kind, text in page:
                words = text.split(" ")
                tokens += map(numbers.__getitem__, words)
                owner.append(i)
                kinds.append(kind)
                sizes.append(len(words))
        self.size = len(tokens)
        pages = np.repeat(np.array(owner, np.int64), sizes)
        chrome = np.repeat(np.array(kinds, np.int64) == CHROME, sizes)
        rank, width = _hashed(list(numbers))[np.array(tokens, np.int64)], 1
        while width < RUN and len(rank) > width:
            rank = _mixed(rank[:-width] * _ODD + rank[width:])
            width *= 2
        if width < RUN:
            rank = rank[:0]
        self.place = np.flatnonzero(pages[: len(rank)] == pages[RUN - 1 : RUN - 1 + len(rank)])
        self.key, self.owner = rank[self.place], pages[self.place]
        self.chrome = chrome[self.place]

    def covered(self, chosen: np.ndarray) -> np.ndarray:
        """For each token: inside one of the chosen windows."""
        edge = np.zeros(self.size + 1, np.int64)
        np.add.at(edge, self.place[chosen], 1)
        np.add.at(edge, self.place[chosen] + RUN, -1)
        return np.cumsum(edge[:-1]) > 0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _SPREAD
    return x ^ (x >> np.uint64(29))


def merged(
    key: np.ndarray, page: np.ndarray, many: np.ndarray, chrome: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One row a key, in order: key, a page of it, stands on two pages or more, stands in chrome."""
    if not len(key):
        return key, page, many, chrome
    order = np.argsort(key, kind="stable")
    key, page, many, chrome = key[order], page[order], many[order], chrome[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    least, most = np.minimum.reduceat(page, first), np.maximum.reduceat(page, first)
    return (
        key[first], least, np.logical_or.reduceat(many, first) | (least != most),
        np.logical_or.reduceat(chrome, first),
    )


def _table(windows: Windows, parsed: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    names = _page_names(parsed)
    return merged(windows.key, names[windows.owner], np.zeros(len(windows.key), bool), windows.chrome)


def _held(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of the keys are among the wanted ones, which are in order."""
    if not len(wanted):
        return np.zeros(len(keys), bool)
    return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys


def main_texts(pages: list[str], repeated: tuple[np.ndarray, np.ndarray] | None = None) -> list[str]:
    """The main text of each page of a group. ``repeated``: the keys, in order, that stand on
    two pages of the host, and those of them in chrome; by default the group is the host."""
    return _main_texts([blocks(p) for p in pages], repeated)


def _main_texts(
    parsed: list[list[tuple[int, str]]], repeated: tuple[np.ndarray, np.ndarray] | None
) -> list[str]:
    if repeated is not None and not len(repeated[0]) and not len(repeated[1]):
        # Nothing is shared: articles, or else all that is not chrome.
        shown = [MAIN if any(kind == MAIN for kind, _ in page) else OTHER for page in parsed]
        return ["\n\n".join(text for kind, text in page if kind == k) for k, page in zip(shown, parsed)]
    windows = Windows(parsed)
    if repeated is None:
        key, _, many, chrome = _table(windows, parsed)
        repeated = key[many], key[many & chrome]
    covered = windows.covered(_held(windows.key, repeated[0]))
    from_chrome = windows.covered(_held(windows.key, repeated[1]))
    out, at = [], 0
    for page in parsed:
        article = any(kind == MAIN for kind, _ in page)
        kept = []
        gone_words = covered if article or _has_own(page, covered[at:]) else from_chrome
        for kind, text in page:
            span = slice(at, at + text.count(" ") + 1)
            at = span.stop
            if kind == MAIN:
                if not from_chrome[span].all():
                    kept.append(text)
            elif kind == OTHER and not article:
                unique = [w for w, gone in zip(text.split(" "), gone_words[span]) if not gone]
                if unique:
                    kept.append(" ".join(unique))
        out.append("\n\n".join(kept))
    return out


def _has_own(page: list[tuple[int, str]], covered: np.ndarray) -> bool:
    """Whether ``LEAST_OWN`` of the page's words outside chrome stand in no repeated substring."""
    at, words, own = 0, 0, 0
    for kind, text in page:
        n = text.count(" ") + 1
        if kind != CHROME:
            words += n
            own += n - int(covered[at : at + n].sum())
        at += n
    return own >= LEAST_OWN * words


def _page_names(parsed: list[list[tuple[int, str]]]) -> np.ndarray:
    """The hash of each page's text outside chrome, so that copies of a page count as one."""
    return _hashed(["\n".join(text for kind, text in page if kind != CHROME) for page in parsed])


def _host(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    group_pages: int = GROUP_PAGES,
) -> DataFrame:
    """(page_id, url, text) of each page; repeated rows give repeated rows."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        text_or_empty(html_col).alias("html"), _host(url_col).alias("host"),
    )
    large = written(
        rows.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > group_pages)
        .select("host", F.ceil(F.col("n") / group_pages).cast("int").alias("groups")),
        "hosts",
    )
    deal = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("groups", F.lit(1)))
    dealt = rows.mapInArrow(_parse, _PARSED).join(large, "host", "left").select(
        "page_id", "url", "blocks", "host", deal.cast("int").alias("part"), "groups"
    )
    whole = dealt.where("host = '' or groups is null").groupBy("host", "part").applyInArrow(_run, _TEXTS)
    parts = dealt.where("host <> '' and groups is not null").groupBy("host", "part")
    hits = parts.applyInArrow(_ask, _ASKS).groupBy("host", "bucket").applyInArrow(_answer, _HITS)
    tables = parts.cogroup(hits.groupBy("host", "part")).applyInArrow(_emit, _TABLES)
    found = tables.groupBy("host", "bucket").applyInArrow(_settle, _FOUND)
    return whole.unionByName(parts.cogroup(found.groupBy("host", "part")).applyInArrow(_finish, _TEXTS))


_PARSED = "page_id long, url string, host string, blocks binary"
_TEXTS = "page_id long, url string, text string"
_ASKS = "host string, part int, bucket int, chrome binary, asked binary, bare boolean"
_HITS = "host string, part int, hits binary, hit boolean, bare boolean"
_TABLES = "host string, part int, bucket int, keys binary, pages binary, marks binary, bare boolean"
_FOUND = "host string, part int, keys binary, chrome_keys binary"
_NONE = (np.array([], np.uint64), np.array([], np.uint64))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's blocks, packed: a line a block, its kind before its text."""
    for batch in batches:
        packed = []
        for page in batch.column("html").to_pylist():
            lines = "\n".join(f"{kind}{text}" for kind, text in blocks(page))
            packed.append(zlib.compress(lines.encode("utf-8", "surrogatepass"), 4))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(packed, pa.binary())],
            names=["page_id", "url", "host", "blocks"],
        )


def _unpacked(group: pa.Table) -> list[list[tuple[int, str]]]:
    out = []
    for packed in group.column("blocks").to_pylist():
        lines = zlib.decompress(packed).decode("utf-8", "surrogatepass")
        out.append([(int(line[0]), line[1:]) for line in lines.split("\n")] if lines else [])
    return out


def _texts(group: pa.Table, repeated: tuple[np.ndarray, np.ndarray] | None) -> pa.Table:
    texts = _main_texts(_unpacked(group), repeated) if len(group) else []
    return pa.table({
        "page_id": group.column("page_id"), "url": group.column("url"), "text": pa.array(texts, pa.string()),
    })


def _run(group: pa.Table) -> pa.Table:
    # Pages without a host share nothing.
    return _texts(group, None if group.column("host")[0].as_py() else _NONE)


def _finish(group: pa.Table, found: pa.Table) -> pa.Table:
    return _texts(group, (_joined(found, "keys"), _joined(found, "chrome_keys")))


def _joined(table: pa.Table, column: str, kind: type = np.uint64) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(table.column(column).to_pylist()), kind))


def _by_bucket(group: pa.Table, bucket: np.ndarray, buckets: int, columns: dict, bare: bool) -> pa.Table:
    """A row for each bucket with its elements of the columns, which may bring a bucket array of their own."""
    host, part = group.column("host")[0].as_py(), group.column("part")[0].as_py()
    cut = {}
    for name, values in columns.items():
        own, values = values if isinstance(values, tuple) else (bucket, values)
        cut[name] = pa.array([values[own == b].tobytes() for b in range(buckets)], pa.binary())
    return pa.table({
        "host": pa.array([host] * buckets, pa.string()), "part": pa.array([part] * buckets, pa.int32()),
        "bucket": pa.array(range(buckets), pa.int32()), **cut, "bare": pa.array([bare] * buckets, pa.bool_()),
    })


def _buckets(group: pa.Table) -> int:
    """One for every ``BUCKET_GROUPS`` of the host's groups, so that no bucket grows with the host."""
    return -(-group.column("groups")[0].as_py() // BUCKET_GROUPS)


def _short(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(32)).astype(np.uint32)


def _main_spans(parsed: list[list[tuple[int, str]]]) -> list[tuple[int, int]]:
    out, at = [], 0
    for page in parsed:
        for kind, text in page:
            stop = at + text.count(" ") + 1
            if kind == MAIN:
                out.append((at, stop))
            at = stop
    return out


def _leads(windows: Windows, parsed: list[list[tuple[int, str]]]) -> np.ndarray:
    """The windows over the first token of an article's block."""
    first = np.zeros(windows.size, bool)
    for start, _ in _main_spans(parsed):
        first[max(0, start - RUN + 1) : start + 1] = True
    return first[windows.place]


def _ask(group: pa.Table) -> pa.Table:
    """What is needed to tell which windows have to be counted over the host: half keys of the
    chrome windows and of the lead windows, and whether a page has text but no article.

    An article's block goes only if all of its tokens are covered, so its first one too.
    """
    parsed = _unpacked(group)
    windows = Windows(parsed)
    chrome = np.unique(_short(windows.key[windows.chrome]))
    asked = np.unique(_short(windows.key[_leads(windows, parsed)]))
    kinds = [{kind for kind, _ in page} for page in parsed]
    bare = any(OTHER in k and MAIN not in k for k in kinds)
    n = _buckets(group)
    return _by_bucket(group, asked, n, {"chrome": (chrome % n, chrome), "asked": (asked % n, asked)}, bare)


def _answer(asks: pa.Table) -> pa.Table:
    chrome = np.unique(np.frombuffer(b"".join(asks.column("chrome").to_pylist()), np.uint32))
    asked = [np.frombuffer(x, np.uint32) for x in asks.column("asked").to_pylist()]
    hits = [a[_held(a, chrome)] for a in asked]
    bare, hit = any(asks.column("bare").to_pylist()), any(len(h) for h in hits)
    return pa.table({
        "host": asks.column("host"), "part": asks.column("part"),
        "hits": pa.array([h.tobytes() for h in hits], pa.binary()),
        "hit": pa.array([hit] * len(hits), pa.bool_()), "bare": pa.array([bare] * len(hits), pa.bool_()),
    })


def _emit(group: pa.Table, answers: pa.Table) -> pa.Table:
    """The key table of a group, cut into buckets of keys. On a host whose pages all have
    articles, only windows of chrome and of the blocks whose first token may be covered."""
    bare = any(answers.column("bare").to_pylist())
    if not len(group) or not (bare or any(answers.column("hit").to_pylist())):
        empty = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
        return pa.table({n: pa.array([], empty[t]) for n, t in (f.split() for f in _TABLES.split(", "))})
    parsed = _unpacked(group)
    windows = Windows(parsed)
    if bare:
        asking = np.ones(len(windows.key), bool)
    else:
        hit = _leads(windows, parsed) & _held(_short(windows.key), _joined(answers, "hits", np.uint32))
        covered, near = windows.covered(hit), np.zeros(windows.size, bool)
        for start, stop in _main_spans(parsed):
            if covered[start]:
                near[max(0, start - RUN + 1) : stop] = True
        asking = near[windows.place]
    wanted, names = windows.chrome | asking, _page_names(parsed)
    key, page, many, chrome = merged(
        windows.key[wanted], names[windows.owner[wanted]], np.zeros(int(wanted.sum()), bool), windows.chrome[wanted]
    )
    asked = _held(key, np.unique(windows.key[asking]))
    n = _buckets(group)
    marks = many.astype(np.uint8) | chrome.astype(np.uint8) << 1 | asked.astype(np.uint8) << 2
    columns = {"keys": key, "pages": _short(page), "marks": marks}
    return _by_bucket(group, (key % np.uint64(n)).astype(np.int64), n, columns, bare)


def _settle(tables: pa.Table) -> pa.Table:
    """Of a bucket's keys, to each group those it asks for and two pages of the host hold."""
    keys = [np.frombuffer(x, np.uint64) for x in tables.column("keys").to_pylist()]
    each = [np.frombuffer(x, np.uint8) for x in tables.column("marks").to_pylist()]
    marks = np.concatenate(each)
    page = np.frombuffer(b"".join(tables.column("pages").to_pylist()), np.uint32)
    key, _, many, chrome = merged(np.concatenate(keys), page, (marks & 1) > 0, (marks & 2) > 0)
    # Only pages without an article ask for substrings that do not stand in chrome.
    asked = [k[(m & 4) > 0] for k, m in zip(keys, each)]
    both, in_chrome = key[many & any(tables.column("bare").to_pylist())], key[many & chrome]
    return pa.table({
        "host": tables.column("host"), "part": tables.column("part"),
        "keys": pa.array([k[_held(k, both)].tobytes() for k in asked], pa.binary()),
        "chrome_keys": pa.array([k[_held(k, in_chrome)].tobytes() for k in asked], pa.binary()),
    })
