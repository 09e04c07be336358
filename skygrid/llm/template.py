"""Main text of web pages by equivalence-class template deduction.

Pages of one host meet in blocks of about ``block_pages`` (a host with more is
split by a hash of page_id). In a block:

1. Each page is a sequence of tag tokens; a token's role is its tag with the
   path of structural elements around it and their class or id names.
2. Roles with the same occurrence vector over the pages form a class.
3. The class of tokens that stand once in each page, without inline ones and
   those that break its order, spans the template. Of the other classes, the
   tokens that lie in one and the same gap of it in every page nest there; they
   are valid if they keep one order and repeat as whole rounds in all pages.
4. The gaps of the spanning class are the template's slots. Pages with text in
   an article or main element have a template of their own, and there only such
   text is main. In the others it is the slots whose text varies over the
   pages and is not mostly link text; names such as "content" break ties only.
   A heading that is the same on all pages stays where what stands beside it in
   one element varies.
5. Within main slots, text of a valid role (or of the rest of a slot) that is
   the same in all pages that have it is the template's, if these pages have
   different texts beside it. That holds for boxes only: headings, paragraphs,
   items of lists and the like are an author's, however often they repeat, and
   no page is emptied.
6. A page's text is what remains, without elements that are never main text
   (menus, forms, scripts, adverts, comments, ...). Names tell such elements
   only as whole words of a class or id, and never an article or main element
   or what stands around one; a page of which they leave nothing is read
   without them.

Pages are compressed before they move, and each moves once.

Defined cases: null or empty html has the empty text; a null url belongs to
the host without a name; a page alone on its host is its own template; equal
rows are each extracted and change no other page's text; page_ids keep all 64
bits, beside nulls too; very long pages are worked through whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .urls import host_of

BLOCK_PAGES = 200
BROADCAST_HOSTS = 100_000

# Element names of HTML by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
NEVER = frozenset("head nav footer aside form script style noscript template iframe svg canvas button select textarea dialog menu object map title".split())
MAIN = frozenset(("article", "main"))
#: Class and id names that tell what is no main text: each word of a name must
#: be one of these, or of the words that go with them.
NEVER_WORDS = frozenset("ad ads advert adverts advertisement advertisements adbox banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo related replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
WITH_WORDS = frozenset("area bar bottom box buttons container form inner left links list main page panel reader right section site slot the top user wrap wrapper".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
HEADER_WORDS = frozenset("banner header masthead".split())
#: Elements that authors write their text in.
WRITTEN = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|story)(?:$|[\s_-])")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

OPEN, CLOSE, TEXT = 0, 1, 2


def parse(html: str) -> Iterator[tuple[int, str, str]]:
    """(OPEN, name, class names), (CLOSE, name, "") and (TEXT, "", raw text)."""
    at, skip = 0, None
    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at:
            yield TEXT, "", html[at : m.start()]
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            yield CLOSE, name, ""
            continue
        attrs = m[3] or m[6] or ""
        yield OPEN, name, " ".join(next(filter(None, g), "") for g in NAMES.findall(attrs)).lower() if attrs else ""
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
            yield CLOSE, name, ""
            at = end.end() if end else len(html)
        elif name in VOID or attrs.endswith("/"):
            yield CLOSE, name, ""
    if at < len(html):
        yield TEXT, "", html[at:]


#: Why text is never main: its element, a form, a name, a name of comments.
ELEMENT, FORM, NAMED, COMMENTS = 1, 2, 4, 8


def named_never(names: str, main: bool) -> int:
    """What the class and id names of an element say, inside an article or not."""
    found = 0
    for token in names.split():
        words = [w for w in re.split("[-_]+", token) if w]
        telling = NEVER_WORDS.intersection(words) - (HEADER_WORDS if main else frozenset())
        if telling and all(w in NEVER_WORDS or w in WITH_WORDS for w in words):
            found |= COMMENTS if telling & COMMENT_WORDS else NAMED
    return found


def read_page(html: str) -> Page:
    """A page; without regard to names if they would leave nothing of it."""
    page = Page(html)
    return page if page.has_text() else Page(html, by_names=False)


class Page:
    """A page's tag tokens with roles, and its texts between them."""

    __slots__ = ("roles", "texts")

    def __init__(self, html: str, by_names: bool = True):
        #: roles: (role, number of texts before it); texts: (raw text, kind)
        #: with kind 0 text, 1 block bound, 2 white space; flags as bits.
        self.roles: list[tuple[str, int]] = []
        self.texts: list[tuple[str, bool, bool, bool, str]] = []  # text, never, in main, in link, path
        stack: list[tuple[str, str, int, bool, bool]] = [("", "", 0, False, False)]  # name, path, never (bits), main, link
        for kind, name, names in parse(html):
            if kind == TEXT:
                _, path, never, main, link = stack[-1]
                self.texts.append((name or names, never > 0, main, link, path))
                continue
            if kind == OPEN:
                if name in CLOSES_P and stack[-1][0] == "p" or name == "li" and stack[-1][0] == "li":
                    self._end(stack)
                _, path, never, main, link = stack[-1]
                inline = name in INLINE
                if not inline:
                    self.texts.append(("\n" if name != "br" else " ", never > 0, main, link, path))
                    path = f"{path}/{name}.{names}" if names else f"{path}/{name}"
                if name in MAIN:
                    # What a name or a form around it says does not hold for an
                    # article, unless it stands among comments.
                    never &= ~(NAMED | FORM)
                    main = True
                elif name == "form":
                    never |= FORM
                # A header inside an article may hold its heading; one outside
                # is the page's.
                elif name in NEVER or name == "header" and not main:
                    never |= ELEMENT
                elif names and by_names and name not in ("html", "body"):
                    never |= named_never(names, main)
                self.roles.append((f"{path}|{name}", len(self.texts)))
                stack.append((name, path, never, main, link or name == "a"))
            else:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        while len(stack) > i:
                            self._end(stack)
                        break

    def _end(self, stack: list) -> None:
        name, path, *_ = stack.pop()
        if name not in INLINE and name != "br":
            _, outer, never, main, link = stack[-1]
            self.texts.append(("\n", never > 0, main, link, outer))
        self.roles.append((f"{path}|/{name}", len(self.texts)))

    def has_text(self) -> bool:
        return any(not never and t.strip() for t, never, *_ in self.texts)

    def has_main(self) -> bool:
        """Some text of an article or main element may be main text."""
        return any(main and not never and t.strip() for t, never, main, _, _ in self.texts)


def structural(role: str) -> bool:
    """Whether a token bounds blocks of text."""
    name = role.rpartition("|")[2].lstrip("/")
    return name not in INLINE and name != "br"


def clean(parts: list[str]) -> str:
    """Blocks joined by one space, white space runs as one, references decoded.
    A new line in ``parts`` by itself ends a block."""
    blocks, run = [], []
    for p in [*parts, "\n"]:
        if p == "\n":
            if run:
                blocks.append(" ".join(unescape("".join(run)).split()))
                run = []
        else:
            run.append(p)
    return " ".join(b for b in blocks if b)


def equivalence_classes(pages: list[Page]) -> list[list[str]]:
    """Roles grouped by equal occurrence vectors, the spanning class (vector of
    ones) first, each in order of first place."""
    vectors: dict[str, np.ndarray] = {}
    for i, p in enumerate(pages):
        for role, _ in p.roles:
            v = vectors.get(role)
            if v is None:
                v = vectors[role] = np.zeros(len(pages), np.int32)
            v[i] += 1
    classes: dict[bytes, list[str]] = defaultdict(list)
    for role, v in vectors.items():
        classes[v.tobytes()].append(role)
    ones = np.ones(len(pages), np.int32).tobytes()
    return [classes.pop(ones, []), *classes.values()]


def spanning(pages: list[Page], roles: list[str]) -> list[str]:
    """The roles that keep the first page's order in all pages: the spanning
    class without tokens that would make it invalid."""
    wanted = set(roles)
    order = [r for r, _ in pages[0].roles if r in wanted]
    place = {r: i for i, r in enumerate(order)}
    bad = set()
    for p in pages[1:]:
        top = -1
        for r, _ in p.roles:
            if r in wanted and r not in bad:
                if place[r] < top:
                    bad.add(r)
                else:
                    top = place[r]
    return [r for r in order if r not in bad]


def whole_rounds(pages: list[Page], roles: list[str]) -> bool:
    """Whether some roles of one class keep one order and repeat as whole
    rounds of it in all pages."""
    wanted, order = set(roles), []
    for p in pages:
        found = [r for r, _ in p.roles if r in wanted]
        order = order or found[: len(wanted)]
        if len(found) % len(wanted) or found != order * (len(found) // len(wanted)):
            return False
    return True


def nested(pages: list[Page], span: list[str], classes: list[list[str]]) -> dict[int, list[list[str]]]:
    """Valid classes by the slot of the spanning class that holds them."""
    place = {r: i + 1 for i, r in enumerate(span)}
    found: dict[int, list[list[str]]] = defaultdict(list)
    where: dict[str, set[int]] = defaultdict(set)
    held: dict[str, set[int]] = defaultdict(set)
    for i, p in enumerate(pages):
        slot = 0
        for r, _ in p.roles:
            slot = place.get(r, slot)
            if r not in place:
                where[r].add(slot)
                held[r].add(i)
    for c in classes:
        parts: dict[int, list[str]] = defaultdict(list)
        for r in c:
            if len(where[r]) == 1:
                parts[next(iter(where[r]))].append(r)
        for slot, part in parts.items():
            if whole_rounds([pages[i] for i in sorted(held[part[0]])], part):
                found[slot].append(part)
    return found


def extract(htmls: list[str]) -> list[str]:
    """Main texts of pages of one host. Pages with and without text in an
    article or main element have a template each."""
    pages = [read_page(h) for h in htmls]
    out = [""] * len(htmls)
    for in_main in (True, False):
        rows = [i for i, p in enumerate(pages) if p.has_main() == in_main]
        for i, text in zip(rows, _extract([htmls[i] for i in rows], [pages[i] for i in rows], in_main)):
            out[i] = text
    return out


def _extract(htmls: list[str], pages: list[Page], whole: bool) -> list[str]:
    """Main texts of pages of one template; ``whole`` if only what stands in an
    article or main element is one."""
    distinct = list({h: p for h, p in zip(htmls, pages) if h}.values())
    if not distinct:
        return [""] * len(htmls)
    classes = equivalence_classes(distinct)
    span = spanning(distinct, [r for r in classes[0] if structural(r)])
    taken = set(span)
    inner = nested(distinct, span, [[r for r in classes[0] if r not in taken], *classes[1:]])
    place = {r: i + 1 for i, r in enumerate(span)}

    def slots_of(p: Page) -> np.ndarray:
        """The slot of each text."""
        out, slot, at = np.zeros(len(p.texts), np.int32), 0, 0
        for r, n in p.roles:
            k = place.get(r)
            if k is not None:
                out[at:n] = slot
                slot, at = k, n
        out[at:] = slot
        return out

    n = len(span) + 1
    chars, linked, usable = (np.zeros(n, np.int64) for _ in range(3))
    texts: list[dict[int, str]] = []
    slots = {id(p): slots_of(p) for p in pages}
    for p in distinct:
        held: dict[int, str] = {}
        for (t, never, main, link, _), s in zip(p.texts, slots[id(p)].tolist()):
            t = t.strip()
            if t and not never and (main or not whole):
                usable[s] += 1
                chars[s] += len(t)
                linked[s] += len(t) * link
                held[s] = held.get(s, "") + t
        texts.append(held)
    main_slots = usable > 0
    # The path of the element whose tag opens a slot, and what it stands in.
    opens = [""] + [r.rpartition("|")[0] if not r.rpartition("|")[2].startswith("/") else r.rpartition("|")[0].rpartition("/")[0] for r in span]

    def beside(varied: np.ndarray) -> np.ndarray:
        """Slots of headings that stand in one element, not the body, with text that varies."""
        held = {opens[i].rpartition("/")[0] for i in np.flatnonzero(varied)}
        return np.array([re.match(r"h[1-6](\.|$)", p.rpartition("/")[2]) is not None and p.count("/") > 3 and p.rpartition("/")[0] in held for p in opens])

    if not whole:
        # Slots that vary over the pages are main; repeated lists of links are
        # menus even if nothing names them so.
        menu = np.array([any("/a" in r.rpartition("|")[2] or r.endswith("|a") for c in inner.get(s, ()) for r in c) for s in range(n)])
        dense = (linked * 2 > chars) | (menu & (linked * 3 > chars))
        if (main_slots & ~dense).any():
            main_slots &= ~dense
        if len(distinct) > 2:
            fixed = np.array([len({h.get(s, "") for h in texts}) == 1 for s in range(n)])
            if (main_slots & ~fixed).any():
                varied = main_slots & ~fixed
                main_slots = varied | (main_slots & beside(varied))
        # Names only break ties: where few pages show no variation, or among
        # slots of which the named ones hold most of the text.
        paths = [""] + [r.rpartition("|")[0] for r in span]
        named = main_slots & np.array([bool(MAIN_NAMES.search(x.replace("/", " ").replace(".", " "))) for x in paths])
        if named.any() and (len(distinct) <= 2 or 2 * chars[named].sum() >= chars[main_slots].sum()):
            main_slots = named
    valid = {r.rpartition("|")[0] for r in [*span, *(r for found in inner.values() for c in found for r in c)] if structural(r)}

    def kept(p: Page) -> list[tuple[str, tuple[int, str]]]:
        """Texts of main slots, with what they vary by: slot and valid role."""
        found = zip(p.texts, slots[id(p)].tolist(), main_slots[slots[id(p)]].tolist())
        return [(t, (s, path if path in valid else "")) for (t, never, main, _, path), s, k in found if k and not never and (main or not whole or t == "\n")]

    values: dict[tuple[int, str], set[str]] = defaultdict(set)
    around: dict[tuple[int, str], set[int]] = defaultdict(set)
    for p in distinct:
        here: dict[tuple[int, str], list[str]] = defaultdict(list)
        found = kept(p)
        for t, u in found:
            if t.strip():
                here[u].append(t.strip())
        text = hash(" ".join(t.strip() for t, _ in found))
        for u, parts in here.items():
            if len(values[u]) < 2:
                values[u].add(" ".join(parts))
            around[u].add(text)
    template = {u for u, v in values.items() if len(v) == 1 and len(around[u]) > 1 and re.split(r"[.]", u[1].rpartition("/")[2])[0] not in WRITTEN}
    out = []
    for p in pages:
        found = kept(p)
        text = clean([t for t, u in found if t == "\n" or u not in template])
        out.append(text or clean([t for t, _ in found]))
    return out


def extract_pages(pages: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    bounded_batches(pages.sparkSession)
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    large = p.groupBy("host").count().where(F.col("count") > block_pages).select(F.col("host").alias("large_host"), F.ceil(F.col("count") / block_pages).alias("blocks"))
    if large.count() <= BROADCAST_HOSTS:
        large = F.broadcast(large)
    p = p.join(large, F.col("host") == F.col("large_host"), "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("page_id", "url", F.monotonically_increasing_id()), F.col("blocks")), F.lit(0)))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=6)
        for b in batches:
            packed = [z.compress(h or b"") for h in b["html"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b["host"], b["block"], b["page_id"], b["url"], pa.array(packed, pa.binary())], names=["host", "block", "page_id", "url", "html"])

    def run(rows: pa.Table) -> pa.Table:
        import zstandard

        z = zstandard.ZstdDecompressor()
        texts = extract([z.decompress(h).decode("utf-8", "replace") for h in rows["html"].to_pylist()])
        return pa.table({"page_id": rows["page_id"], "url": rows["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    moved = p.select("host", "block", "page_id", "url", "html").mapInArrow(squeeze, "host string, block long, page_id long, url string, html binary")
    return moved.groupBy("host", "block").applyInArrow(run, "page_id long, url string, text string, n_chars long")
