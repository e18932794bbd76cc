"""Main text of HTML pages by tag-path ratios.

A page is read as a stream of tags and texts. Inline tags join their text to the block they
stand in; every block has a path of block tags from the root. Text length and punctuation are
added up per path and divided by the number of blocks on the path; the two ratios are fused,
smoothed over neighbouring blocks in page order, and blocks at or above one standard deviation
of the page's scores are content. The article is the article or main element around all
content blocks, else the nearest element that holds all of them and their headline; its blocks
are kept whole and in order, short ones and headings too. Parts that HTML itself names as not being the article (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, comments, hidden parts), by tag, role, or class and id words,
are left out before. An article element is never left out for its names, and a name, role or
form is overruled if it stands on what is around the page's article, or holds MOST of the scored
text, or if nothing with a score would be left; this is looked at where the parts left out by
name hold an article element or more text than the rest. Names on headings and ids of sections
inside the article are those of its own headings and leave nothing out. Reader comments, by
class or id, are left out however much of the page they are, unless it holds nothing else.

Defined results: null or empty html and pages without text give an empty string; unclosed and
misnested tags close as browsers close them; the whole page is read whatever its length;
repeated rows give equal texts; extra columns are kept, text and n_chars are replaced.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<=\s)(hidden)(?=[\s>/]|$)", re.S)
_MAIN_ROLE = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre section select summary table tbody "
    "td tfoot th thead tr ul".split())
#: Parts that are not the article, by tag.
LEFT_OUT = frozenset("head nav footer aside dialog menu button select option svg canvas object script style noscript "
                     "template iframe textarea title xmp".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar note".split())
#: ... and by a word of class or id.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted popup modal overlay "
    "cookie cookies consent gdpr notice notices alert nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar "
    "sidebars aside widget widgets footer header masthead topbar toolbar comment comments disqus reply replies respond discussion "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search pagination "
    "pager disclaimer paywall".split())
#: Reader comments, which are left out even where they are most of a page.
COMMENTS = frozenset("comment comments disqus replies respond".split())
_NOT_A_PART = frozenset("no with without has have".split())
_NO_COMMENTS = _NOT_A_PART | frozenset("open closed status enabled disabled allowed on off count counts link links".split())
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: A start tag closes these open elements first.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
ARTICLE = frozenset(("article", "main"))
#: Elements that can hold a whole article.
HOLDERS = ARTICLE | {"html", "body", "div", "center"}
#: A named part with this share of the scored text is the article's wrapper, not a part beside it.
MOST = 0.8
#: How an element is left out: by a name, role or form, which the scores can overrule, or always.
NAMED, ALWAYS = 1, 2


def _left_out(tag: str, attributes: str, inside: bool, comments: bool = False) -> int:
    """0, NAMED or ALWAYS; inside: within an article or main element, whose own header holds its
    headline and whose sections have ids that their headings gave them; comments: whether
    reader comments are read as other named parts are."""
    if tag in LEFT_OUT or tag == "header" and not inside:
        return ALWAYS
    if tag in ("html", "body", "main") or tag in _HEADINGS and "hidden" not in attributes and "display" not in attributes:
        return 0
    out = NAMED if tag == "form" else 0
    for m in _ATTRIBUTE.finditer(attributes) if "=" in attributes or "hidden" in attributes else ():
        name, value = (m[1] or "hidden").lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return ALWAYS
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return ALWAYS
        if tag in _HEADINGS:
            continue
        if name in ("class", "id"):
            for one in value.split():
                found = set(_WORDS.findall(one))
                if not comments and found & COMMENTS and not found & _NO_COMMENTS:
                    return ALWAYS
        if tag == "article":
            continue
        if name == "role" and value in ROLES:
            out = NAMED
        if name in ("class", "id") and not (inside and tag == "section" and name == "id"):
            for one in value.split():
                found = set(_WORDS.findall(one))
                hits = found & NAMES - ({"header"} if inside else set())
                if hits and not found & _NOT_A_PART:
                    out = NAMED
    return out


def blocks(page: str, kept: frozenset[int] | None = frozenset(), comments: bool = False) -> tuple[list[tuple[tuple[int, ...], str, str]], set[int], bool]:
    """(ids of the open elements, tag path, text) of every block with text, in page order; the
    ids of the named parts; and whether those left out hold an article, or more text than is read.

    kept: ids of named parts that are read all the same; None: all are, inline ones as blocks."""
    out, words, at, serial = [], [], 0, 0
    stack: list[tuple[str, int, int]] = []  # tag, id, how left out
    hidden = always = read = left = 0
    named: set[int] = set()
    mains: set[int] = set()  # elements of the role main
    article = False

    def flush() -> None:
        if words:
            text = " ".join(entities.unescape("".join(words)).split())
            words.clear()
            if text:
                out.append((tuple(x[1] for x in stack), "/".join(x[0] for x in stack), text))

    def pop(k: int) -> None:
        nonlocal hidden, always
        hidden -= sum(x[2] > 0 for x in stack[k:])
        always -= sum(x[2] == ALWAYS for x in stack[k:])
        del stack[k:]

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not hidden:
            words.append(page[at:m.start() if m else len(page)])
            read += len(words[-1].strip())
        elif not always:
            left += len(page[at:m.start() if m else len(page)].strip())
        if not m:
            break
        at = m.end()
        slash, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        block = tag in BLOCK
        if slash:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if block or kept is None and k >= 0:
                flush()
            if k >= 0 and (block or not any(x[0] in BLOCK for x in stack[k + 1:])):
                pop(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            if not hidden:
                words.append(" ")
            continue
        if tag in VOID:
            if block:
                flush()
            continue
        if block:
            flush()
            top = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCK and stack[i][0] != "p"), -1)
            p = next((i for i in range(top + 1, len(stack)) if stack[i][0] == "p"), -1)
            if p >= 0:
                pop(p)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _SCOPE.get(tag, ()):
                    break
                if stack[i][0] in _CLOSES.get(tag, ()):
                    pop(i)
                    break
        kind = _left_out(tag, attributes, any(x[0] in ARTICLE or x[1] in mains for x in stack), comments)
        serial += 1
        if "main" in attributes and _MAIN_ROLE.search(attributes):
            mains.add(serial)
        if kind == NAMED:
            named.add(serial)
            if kept is None:
                flush()
        here = kind if kind == ALWAYS or kept is not None and serial not in kept else 0
        if (block or here or kind and kept is None) and not attributes.endswith("/"):
            article |= tag in ARTICLE and hidden > 0 and not always
            stack.append((tag, serial, here))
            hidden += here > 0
            always += here == ALWAYS
    flush()
    return out, named, article or left > read


def scores(paths: list[str], texts: list[str]) -> np.ndarray:
    """Fused and smoothed tag-path ratios of the blocks."""
    total: dict[str, list[float]] = {}
    for path, text in zip(paths, texts, strict=True):
        t = total.setdefault(path, [0.0, 0.0, 0.0])
        t[0] += len(text)
        t[1] += len(_PUNCTUATION.findall(text))
        t[2] += 1
    raw = np.array([total[p][0] / total[p][2] * (1 + total[p][1] / total[p][2]) for p in paths])
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    padded = np.pad(raw, 2, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def _content(found: list[tuple[tuple[int, ...], str, str]]) -> list[int]:
    score = scores([p for _, p, _ in found], [t for _, _, t in found])
    return np.flatnonzero(score >= min(score.std(), score.max())).tolist()


def _overruled(page: str, comments: bool) -> frozenset[int]:
    """Named parts that are read all the same: what is around the page's article, what holds MOST
    of the scored text, and every named part if nothing with a score is left without them."""
    found, named, _ = blocks(page, None, comments)
    scored = set(_content(found)) if found else set()
    rows = [(ids, path.split("/"), len(t) * (k in scored)) for k, (ids, path, t) in enumerate(found)]
    kept: set[int] = set()

    def total() -> int:
        return sum(n for *_, n in rows)

    def removed() -> bool:
        out = named - kept
        return total() > 0 and all(not out.isdisjoint(ids) for ids, _, n in rows if n)

    for inner in (ARTICLE, frozenset(("article",))):  # an article or main; then an article in it
        held: dict[int, int] = {}
        around: dict[int, tuple[int, ...]] = {}
        for ids, tags, n in rows:
            d = next((i for i, t in enumerate(tags[:len(ids)]) if t in inner), None)
            if d is not None:
                held[ids[d]] = held.get(ids[d], 0) + n
                around[ids[d]] = ids[:d]
        one = max(held, key=lambda i: held[i], default=None)
        if one is None:
            continue
        wrappers = named & set(around[one])
        if inner == ARTICLE and not wrappers or 2 * held[one] > total() or removed():
            kept |= wrappers
            rows = [r for r in rows if one in r[0]]
    parts: dict[int, int] = {}
    for ids, _, n in rows:
        for i in (x for x in ids if x in named) if n else ():
            parts[i] = parts.get(i, 0) + n
    least = MOST * total()
    kept |= {i for i, n in parts.items() if n >= least}
    if removed():
        kept |= named & {i for ids, *_ in rows for i in ids}
    return frozenset(kept)


def _holder(ids: tuple[int, ...], path: str) -> tuple[int, ...]:
    """The open elements down to the article's: the outermost article or main, else the deepest
    element of HOLDERS (a list, table, quote or section is a part of something larger)."""
    tags = path.split("/")[:len(ids)]
    last = max((i for i, t in enumerate(tags) if t in HOLDERS), default=-1)
    return ids[:next((i for i, t in enumerate(tags) if t in ARTICLE), last) + 1]


def _common(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[:n]


def main_text(page: str | None) -> str:
    found: list[tuple[tuple[int, ...], str, str]] = []
    for comments in (False, True):  # reader comments are read only where a page has nothing else
        found, _, doubtful = blocks(page or "", comments=comments)
        if doubtful and (kept := _overruled(page, comments)):
            found = blocks(page, kept, comments)[0]
        if found:
            break
    if not found:
        return ""
    content = _content(found)
    ids, path, _ = found[content[0]]
    for k in content:
        ids = _common(ids, found[k][0])
    ids = _holder(ids, path)
    # a headline that stands outside: the nearest h1 before the content, else the nearest heading
    tops = [k for k in range(content[0] + 1) if found[k][1].rsplit("/", 1)[-1] in _HEADINGS]
    tops = [k for k in tops if found[k][1].rsplit("/", 1)[-1] == "h1"] or tops
    held = any(x[:len(ids)] == ids and p.rsplit("/", 1)[-1] == "h1" for x, p, _ in found)
    if tops and not held:
        ids = _holder(_common(ids, found[tops[-1]][0]), path)
    return "\n".join(t for x, _, t in found if x[:len(ids)] == ids)


def _main_texts(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(x) for x in pages.to_pylist()], pa.string())


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points); no shuffle."""
    bounded_batches(pages.sparkSession)
    pages = pages.drop(*(c for c in pages.columns if c.lower() in ("text", "n_chars") and c != html))
    out = pages.withColumn("text", F.arrow_udf(_main_texts, "string")(F.col(html)))
    return out.withColumn("n_chars", F.length("text").cast("long"))
