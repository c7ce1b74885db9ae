"""HTML extraction by removing each site's recurring template.

1. Every page is parsed into an element tree.  Its subtrees are hashed with all below them,
   menus, adverts and footers as well as what stands in articles, and Spark counts on how many
   different texts of a host each hash occurs, so copies of a page count once.
2. Subtrees that recur are the site's template and are deleted.  A container outside articles
   is template from a few texts on.  Inside an article, containers and prose are template if
   they stand on many texts at one place, and mostly at that place: a sentence or a quote may
   well stand in many articles, but then here and there.  The same number is asked of a
   container that holds most of its page's text, and a page is not emptied of all its prose.
3. Of what remains the articles are read, without one the body, less the elements that are
   furniture by name or role: names decide where a site shows too few pages to tell.  Text is
   read block by block.

Pages are parsed on their own.  Only hashes are shuffled, unless the templates of all hosts are
too many to be sent to every task: then the pages on which one stands are shuffled to meet it.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lectern.llm.common import col, flat_python, key_filter, mix, stored, with_python

#: A container is template from so many different texts of its host on.  No share of the
#: host's pages is asked, so the rule is the same on hosts of any size.
LEAST_PAGES = 3
#: What stands in an article, and a container with most of its page's text, from so many on.
LEAST_PROSE = 50
#: Template subtrees, of eight bytes each, that are sent to every task; beyond that the pages
#: are shuffled to them.
MOST_SHARED = 1 << 22

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
FURNITURE = frozenset(
    "script style noscript template head title nav footer aside form button select option "
    "textarea iframe svg canvas dialog menu object embed audio video xmp noembed noframes".split())
#: Elements whose content is no text of the page.
UNSEEN = frozenset("script style noscript template head title iframe svg object embed".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
PROSE = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th "
    "figure figcaption a b i em strong span code br hr sub sup small q cite mark u s".split())
#: Prose that is deleted where it recurs at one place; headings and cells name what follows.
UNITS = frozenset("p ul ol dl li blockquote pre table figure".split())
#: The same, if no running text stands beside it.
INLINE = frozenset("a b i em strong span code sub sup small q cite mark u s".split())
PAGE = frozenset(("#root", "html", "body"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of a class, id or role that mark furniture.
MARKS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disclaimer disqus footer gdpr header masthead menu modal nav "
    "navbar navigation newsletter notice notices pagination popup promo promoted related "
    "reader-comments search share sharing sidebar skip social sponsor sponsored subscribe "
    "toolbar widget contentinfo complementary".split())
#: Elements that close an open one of the same kind or of the set.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
NOT_IN_P = BLOCKS - {"br"}
#: By element that starts: names of the open element that it ends, and names that shield it.
LISTS = {"ul", "ol", "dl", "table", "select", "#root"}
ENDS = {"p": ({"p"}, BLOCKS - {"p"})} | {
    name: (names, {"tr", "table", "#root"} if name == "td" else LISTS)
    for name, names in CLOSED_BY.items()}
#: The rules of ENDS that look at an element of a name.
WATCHED = {name: [rule for rule, (names, stop) in ENDS.items() if name in names | stop]
           for name in BLOCKS | LISTS | set(CLOSED_BY)}

#: What ends a tag, or opens a value in which it does not end.
TAG_END = re.compile(r"""=\s*(["'])|>""")
TAG_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
#: One attribute with its whole value; read one after another from the start of the tag.
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
MARK_SPLIT = re.compile(r"[^a-z0-9]+")


class Element:
    __slots__ = ("name", "marks", "attributes", "children")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.attributes = name, attributes
        self.children: list[Element | str] = []
        self.marks = marks_of(attributes) if attributes else ()

    def furniture(self, in_article: bool) -> bool:
        """By name or mark; an article may have a header and title of its own."""
        if self.name in PAGE:
            return False
        if self.name in FURNITURE or self.name == "header" and not in_article:
            return True
        return any(m in MARKS and not (in_article and m == "header") for m in self.marks)


def marks_of(attributes: str) -> tuple[str, ...]:
    found = []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            found.append("popup")
        elif name in ("class", "id", "role"):
            for word in value.split():
                found.append(word)
                found += MARK_SPLIT.split(word)
    return tuple(found)


class OpenElements:
    """The open elements, innermost last, with what tells the nearest of some at once.

    Every lookup is constant or ends elements, so that a page of any form takes linear time.
    """

    def __init__(self, root: Element):
        self.stack, self.open = [root], Counter([root.name])
        self.watched: dict[str, list[int]] = {rule: [] for rule in ENDS}

    def push(self, element: Element) -> None:
        for rule in WATCHED.get(element.name, ()):
            self.watched[rule].append(len(self.stack))
        self.stack.append(element)
        self.open[element.name] += 1

    def pop(self) -> str:
        name = self.stack.pop().name
        self.open[name] -= 1
        for rule in WATCHED.get(name, ()):
            self.watched[rule].pop()
        return name

    def close(self, name: str) -> None:
        """End the nearest open element of a name, if there is one."""
        if self.open[name] and name != "#root":
            while self.pop() != name:
                pass

    def make_way(self, rule: str) -> None:
        """End the nearest element that the rule ends, unless a shielding one is nearer."""
        at = self.watched[rule]
        if at and self.stack[at[-1]].name in ENDS[rule][0]:
            self.close(self.stack[at[-1]].name)


class Scanner:
    """Finds the ends of tags, comments and such; what is never closed is looked for once."""

    def __init__(self, page: str):
        self.page, self.missing = page, set()

    def after(self, mark: str, at: int) -> int:
        """The place after the next mark, or -1."""
        if mark in self.missing:
            return -1
        found = self.page.find(mark, at)
        if found < 0:
            self.missing.add(mark)
            return -1
        return found + len(mark)

    def tag_end(self, at: int) -> int:
        """The place after a tag's end; quoted values that are closed may hold a ``>``."""
        start = at
        while "values" not in self.missing:
            found = TAG_END.search(self.page, at)
            if not found:
                self.missing.add("values")  # quotes do not pair up on this page
                break
            at = found.end()
            if not found[1]:
                return at
            at = max(at, self.after(found[1], at))
        return self.after(">", start)

    def special_end(self, at: int) -> int:
        """The place after a comment or declaration that begins at ``<!`` or ``<?``."""
        if self.page.startswith("<!--", at):
            end = self.after("-->", at + 4)
            return end if end >= 0 else len(self.page)
        if self.page.startswith("<![CDATA[", at):
            end = self.after("]]>", at)
            if end >= 0:
                return end
        return self.after(">", at)


def parse(page: str) -> Element:
    """Element tree of any page, in time linear in its length; what is left open is closed
    where its parent ends."""
    root = Element("#root")
    elements, scanner = OpenElements(root), Scanner(page)
    text, at, end = 0, 0, len(page)  # where text not yet kept begins
    while True:
        start = page.find("<", at)
        if start < 0:
            break
        after, tag = start + 1, TAG_NAME.match(page, start + 1)
        if not tag and page[after:after + 1] not in ("!", "?"):
            at = after
            continue
        past = scanner.tag_end(tag.end()) if tag else scanner.special_end(start)
        if past < 0:  # nothing ends from here on, but a comment takes the rest
            comment = page.find("<!--", start)
            end = comment if comment >= 0 else end
            break
        if start > text:
            elements.stack[-1].children.append(page[text:start])
        text = at = past
        if not tag:
            continue
        closing, name = tag[1], tag[2].lower()
        if closing:
            elements.close(name)
            continue
        if name in NOT_IN_P:
            elements.make_way("p")
        if name in CLOSED_BY:
            elements.make_way(name)
        attributes = page[tag.end():past - 1]
        element = Element(name, attributes)
        elements.stack[-1].children.append(element)
        if name in VOID or attributes.endswith("/"):
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            element.children.append(page[at:close.start()] if close else page[at:])
            text = at = close.end() if close else len(page)
            continue
        elements.push(element)
    if text < end:
        elements.stack[-1].children.append(page[text:end])
    return root


def starts_of(root: Element) -> list[Element]:
    """Topmost articles that do not lie in furniture, without one the whole page.

    An article that is furniture by its own marks counts only where no other one stands, one
    in furniture only where the page has no text besides.  A form may hold a whole page.
    """
    plain, marked, within, stack = [], [], [], [(root, False)]
    while stack:
        element, hidden = stack.pop()
        if element.name in ("article", "main"):
            (within if hidden else marked if element.furniture(False) else plain).append(element)
            continue
        hidden = hidden or element.name != "form" and element.furniture(False)
        stack += [(c, hidden) for c in reversed(element.children) if not isinstance(c, str)]
    found = plain or marked
    if not found and within and not text_from([root], False, set())[0]:
        found = within
    return found or [root]


@dataclass(slots=True)
class Part:
    """An element with what stands above it.

    ``read`` is false for furniture and what lies outside of the articles.  The path is a hash
    of the names from the start that is read; the place is one of the path and the position
    below the parent, counted from the nearer end.
    """

    element: Element
    parent: Part | None
    read: bool
    path: int = 0
    place: int = 0


def parts_of(root: Element) -> tuple[list[Element], list[Part]]:
    """Starts, and every element that can show text, parents first."""
    starts = starts_of(root)
    first, whole = {id(s) for s in starts}, starts[0] is root
    found: list[Part] = []
    stack = [Part(root, None, whole)]
    while stack:
        part = stack.pop()
        found.append(part)
        path = zlib.crc32(part.element.name.encode("utf-8", "replace"), part.path)
        below = [c for c in part.element.children if not isinstance(c, str)]
        for i in range(len(below) - 1, -1, -1):
            child, end = below[i], len(below) - 1 - i
            if id(child) in first:
                stack.append(Part(child, part, True))
            elif part.read and not child.furniture(not whole or in_article(part)):
                at = b"<%d" % i if i <= end else b">%d" % end
                stack.append(Part(child, part, True, path, zlib.crc32(at, path)))
            elif child.name not in UNSEEN:
                stack.append(Part(child, part, False))
    return starts, found


def in_article(part: Part) -> bool:
    return part.element.name in ("article", "main")


#: Places of containers, without and with most of the page's text; those of others are above.
CONTAINER, HOLDER = 0, -1


def candidates(root: Element) -> tuple[dict[int, tuple[int, int]], int]:
    """id(element) -> (hash, place) of every subtree that may be deleted for recurring, and
    a hash of the text read."""
    return chosen_parts(*parts_of(root))


def chosen_parts(starts: list[Element], found: list[Part]
                 ) -> tuple[dict[int, tuple[int, int]], int]:
    root = found[0].element
    known = {id(part.element): part for part in found}
    hashes: dict[int, int] = {}
    sizes: dict[int, int] = {}
    loose = set()
    body = hashlib.blake2b(digest_size=8)
    for part in reversed(found):  # children before parents
        element = part.element
        digest, size = hashlib.blake2b(f"{element.name} {element.attributes.strip()}".encode(
            "utf-8", "replace"), digest_size=8), 0
        for child in element.children:
            if isinstance(child, str):
                text = " ".join(child.split())
                if text:
                    piece = b"\0t" + text.encode("utf-8", "replace")
                    digest.update(piece)
                    size += len(text)
                    loose.add(id(element))
                    if part.read:
                        body.update(piece)
            elif id(child) in hashes and known[id(child)].read == part.read:
                digest.update(b"\0e" + hashes[id(child)].to_bytes(8, "little", signed=True))
                size += sizes[id(child)]
        hashes[id(element)] = int.from_bytes(digest.digest(), "little", signed=True)
        sizes[id(element)] = size
    total, whole = sum(sizes[id(s)] for s in starts), starts[0] is root
    first = {id(s) for s in starts}
    chosen = {}
    for part in found:
        element, name, size = part.element, part.element.name, sizes[id(part.element)]
        if id(element) in first or not size or name in PAGE or in_article(part):
            continue
        own = hashes[id(element)]
        if not part.read:
            if name not in PROSE:
                chosen[id(element)] = own, CONTAINER
        # a bare container of running text is a paragraph of the article
        elif name not in PROSE and whole:
            chosen[id(element)] = own, HOLDER if 2 * size >= total else CONTAINER
        elif name not in PROSE and (element.attributes.strip() or id(element) not in loose):
            chosen[id(element)] = (own, HOLDER) if 2 * size >= total else (own, part.place + 1)
        elif name in UNITS or name not in PROSE or name in INLINE \
                and part.parent.element.name not in PROSE and id(part.parent.element) not in loose:
            chosen[id(element)] = own, part.place + 1
    return chosen, int.from_bytes(body.digest(), "little", signed=True)


def removed(found: list[Part], gone: set[int]) -> tuple[int, int]:
    """Characters of text that went with the elements ``gone``, and with names besides."""
    by_recurrence = by_name = 0
    below: set[int] = set()
    for part in found:
        element, parent = part.element, part.parent
        if gone and (id(element) in gone or parent and id(parent.element) in below):
            below.add(id(element))
        elif part.read:
            continue
        size = sum([len(" ".join(c.split())) for c in element.children if isinstance(c, str)])
        if id(element) in below:
            by_recurrence += size
        else:
            by_name += size
    return by_recurrence, by_name


Known = Callable[[list[int]], set[int]]


def main_text(page: str | None, known: Known = lambda _: set()) -> str:
    """Text of the article without template and furniture, blocks joined by one space."""
    return read_page(page, known)[0]


def read_page(page: str | None, known: Known = lambda _: set()) -> tuple[str, int, int]:
    """A page's main text, and the characters that recurrence and names took from the page.

    ``known`` picks those of hash ^ place that recur.
    """
    if not page:
        return "", 0, 0
    root = parse(page)
    starts, found = parts_of(root)
    chosen, _ = chosen_parts(starts, found)
    keys = {e: h ^ p for e, (h, p) in chosen.items()}
    recurring_keys = known(list(keys.values())) if keys else set()
    gone = {e for e, key in keys.items() if key in recurring_keys}
    whole = starts[0] is not root
    text, told = text_from(starts, whole, gone)
    if gone and not told:  # headings at most: these pages are made of what recurs
        gone = {e for e in gone if chosen[e][1] == CONTAINER}
        text, _ = text_from(starts, whole, gone)
    return text, *removed(found, gone)


def text_from(starts: list[Element], inside: bool, gone: set[int]) -> tuple[str, bool]:
    blocks: list[list[str]] = [[]]
    told = False
    for start in starts:
        # text, an element to enter, or None where a block ends; the next one is last
        todo: list[tuple[Element | str | None, bool, bool]] = [(start, inside, False)]
        while todo:
            item, in_article, heading = todo.pop()
            if item is None:
                blocks.append([])
            elif isinstance(item, str):
                blocks[-1].append(item)
                told = told or not heading and bool(entities.unescape(item).strip())
            elif item is start or id(item) not in gone and not item.furniture(in_article):
                if item.name in BLOCKS:
                    blocks.append([])
                    todo.append((None, in_article, heading))
                below = in_article or item.name in ("article", "main")
                heading = heading or item.name in HEADINGS
                todo += [(c, below, heading) for c in reversed(item.children)]
    texts = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks)
    return " ".join(t for t in texts if t), told


def host_key(url: Column) -> Column:
    """64-bit hash of the lower-cased host; of the empty one for null and for what has no
    ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.xxhash64(F.lower(rest))


def site_keys(hosts: np.ndarray, own: np.ndarray) -> np.ndarray:
    """One 64-bit number for each host and subtree."""
    return mix(mix(hosts.astype(np.int64).view(np.uint64)) ^ own.astype(np.int64).view(np.uint64))


def subtrees(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(page_id, host, hash, place, body) of every subtree that may be deleted, stored."""
    def worker():
        def work(ids, hosts, texts):
            rows = ([], [], [], [], [])
            for page, host, text in zip(ids, hosts, texts, strict=True):
                chosen, body = candidates(parse(text)) if text else ({}, 0)
                for found, place in sorted(set(chosen.values())):
                    for values, value in zip(rows, (page, host, found, place, body), strict=True):
                        values.append(value)
            if rows[0]:
                yield rows

        return work

    each = flat_python(pages, [col(page_id).cast("long"), host_key(col(url)), col(html)],
                       [(name, T.LongType()) for name in
                        ("page_id", "host", "hash", "place", "body")], worker)
    return stored(each, "subtrees")


def templates(each: DataFrame) -> DataFrame:
    """(host, hash, place): subtrees that are template of their host.

    Counted over the different texts of all pages.  Rows of a host and hash are summed on the
    map side first, and only those seen often enough are told apart by text, so a large host
    adds no more rows to a task than its distinct subtrees.
    """
    key = F.xxhash64("host", "hash")
    often = each.groupBy(key.alias("key")).agg(F.count("*").alias("n")) \
        .where(F.col("n") >= LEAST_PAGES).select("key")
    each = each.where(key_filter(often)(key))
    counts = each.select("host", "hash", "place", "body").distinct() \
        .groupBy("host", "hash", "place").agg(F.count("*").alias("n"))
    contained = F.coalesce(F.sum(F.when(F.col("place") <= 0, F.col("n"))), F.lit(0))
    standing = F.coalesce(F.sum(F.when(F.col("place") > 0, F.col("n"))), F.lit(0))
    main_place = F.max(F.when(F.col("place") > 0, F.struct("n", "place")))
    places = F.array(
        F.when(F.col("contained") >= LEAST_PAGES, F.lit(CONTAINER)),
        F.when(F.col("contained") >= LEAST_PROSE, F.lit(HOLDER)),
        F.when((F.col("top.n") >= LEAST_PROSE) & (2 * F.col("top.n") > F.col("standing")),
               F.col("top.place")))
    return counts.groupBy("host", "hash") \
        .agg(contained.alias("contained"), standing.alias("standing"), main_place.alias("top")) \
        .select("host", "hash", F.explode(F.array_compact(places)).alias("place"))


def recurring(pages: DataFrame, page_id: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """(host, hash, place, page_id): the template subtrees that stand on each page."""
    each = subtrees(pages, page_id, url, html)
    return each.drop("body").join(templates(each), ["host", "hash", "place"])


FOUND = [("text", T.StringType()), ("by_recurrence", T.LongType()), ("by_name", T.LongType())]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """page_id, url, ``text``, the main text of each page, and the characters that recurrence
    and then names took from it.

    A null or empty page has an empty text.  Repeated rows stay; a page without a host
    belongs to the host without a name.  Other columns are not used.
    """
    each = subtrees(pages, page_id, url, html)
    template = stored(templates(each), "templates")
    named = pages.select(col(page_id).alias("page_id"), col(url).alias("url"),
                         col(html).alias("html"), host_key(col(url)).alias("page_host"))
    keyed = F.col("hash").bitwiseXOR(F.col("place"))
    if template.count() <= MOST_SHARED:
        rows = template.select("host", keyed.alias("own")).toArrow()
        keys = site_keys(rows["host"].to_numpy(), rows["own"].to_numpy())
        shared = pages.sparkSession.sparkContext.broadcast(np.sort(keys))

        def from_all():
            held = shared.value

            def work(hosts, texts):
                rows = []
                for host, text in zip(hosts, texts, strict=True):
                    def known(own, host=host):
                        keys = site_keys(np.full(len(own), host), np.array(own))
                        at = np.minimum(np.searchsorted(held, keys), max(0, len(held) - 1))
                        return {k for k, met in zip(own, held[at] == keys) if met} \
                            if len(held) else set()

                    rows.append(read_page(text, known))
                return list(map(list, zip(*rows, strict=True))) or [[], [], []]

            return work

        return with_python(named, [F.col("page_host"), F.col("html")], FOUND, from_all,
                           ["page_id", "url"])
    by_page = stored(
        each.drop("body").join(template, ["host", "hash", "place"]).groupBy("page_id", "host")
        .agg(F.collect_set(keyed).alias("template")), "page-templates")
    some = key_filter(by_page.select(F.xxhash64("page_id", "host").alias("key")))(
        F.xxhash64(F.col("page_id").cast("long"), F.col("page_host")))
    met = named.where(some).join(
        by_page, F.col("page_host").eqNullSafe(F.col("host"))
        & named["page_id"].cast("long").eqNullSafe(by_page["page_id"]), "left") \
        .select(named["page_id"], "url", "html", "template")
    bare = named.where(~some).select("page_id", "url", "html", F.lit(None).cast(
        by_page.schema["template"].dataType).alias("template"))

    def from_own():
        def work(texts, own):
            rows = [read_page(t, frozenset(h or ()).intersection)
                    for t, h in zip(texts, own, strict=True)]
            return list(map(list, zip(*rows, strict=True))) or [[], [], []]

        return work

    return with_python(met.unionByName(bare), [F.col("html"), F.col("template")], FOUND,
                       from_own, ["page_id", "url"])
