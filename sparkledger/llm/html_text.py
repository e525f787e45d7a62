"""Operator 1: main text of web pages by wrapper induction.

1. A page's blocks form a tree of slots, labelled by tag and names; siblings in a row that are built
   alike share a slot.  What by tag, role or class is a menu, header, footer, sidebar, notice,
   advert, form, script, style or reader comment is no part of it.
2. Pages of a host whose main elements lie below the same labels have one layout.  One page of it
   is the reference (any of at most REFERENCE_SLOTS slots, else the smallest), and every page is aligned with
   it by simple tree matching (children are matched in order, most matched nodes win).
3. Over all pages of the layout each slot is counted: a text that a slot holds on at least CONSTANT of
   the pages is template, and a slot that looks like a menu on that share of them (``is_menu``), its text
   varying, is one.  Pages of one signature, copies, count once; layouts with fewer than LEAST_PAGES
   different pages have no wrapper.
4. A page's text is that of its blocks without template texts and menu slots.  Blocks that match
   nothing in the reference stay.

Null and empty pages have empty text; a page without any article takes its main element,
else the body.  Pages without a host have no wrapper.  Repeated rows give repeated results.  Whatever its
size a page is read whole.  Matching costs at most the slots of the page times those of the reference.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Generator, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_steps, written

#: Different pages that a wrapper takes at least, and the usual size of a reference.
LEAST_PAGES, REFERENCE_SLOTS = 4, 256
#: Keys that the pages of a layout are dealt to.
SALTS = 16
#: Share of a layout's pages that makes a text template, a slot a menu.
CONSTANT = 0.8
#: Share of a menu's text in links; longest item of a menu without links.
LINKS, SHORT = 0.6, 25
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
DIGITS = re.compile("[0-9]+")
NUMBERS = pa.list_(pa.int32())
FEATURES = (("grp", pa.int64()), ("sign", pa.int64()), ("size", pa.int64()), ("shape", pa.binary()), ("page_hash", pa.int64()), ("slots", NUMBERS), ("menus", NUMBERS), ("at", NUMBERS), ("texts", pa.list_(pa.int64())))
COUNTS = (("grp", pa.int64()), ("slot", pa.int32()), ("txt", pa.int64()), ("sign", pa.int64()), ("menu", pa.int32()))

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template")}
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol p pre search section summary table caption thead tbody tfoot tr td th ul option".split()
)
#: A start tag closes an open element of these, looked for up to an element of the scope.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select", "datalist")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody"), ("table",)),
}
#: Elements that never hold main text, and those that do not outside an article.
NEVER = frozenset("nav footer aside form script style textarea title iframe noembed noframes noscript template head button select input label dialog svg object canvas audio video menu datalist".split())
#: Words of a class, id or role that tell of what is not the article.
CHROME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe subscription signup sidebar sidebars rail menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead "
    "comment comments commentlist reply replies respond disqus discussion related recommended recommendations share sharing social popup modal overlay widget widgets "
    "toolbar login search skip copyright contentinfo complementary".split()
)
#: Words that say how such an element is built, not what it is about: "share-buttons" is chrome, "social-history" is not.
PARTS = frozenset(
    "area articles bar block body bottom box btn button buttons card cards cell center col column container content cta desktop div form frame global group head header holder "
    "horizontal icon icons inline inner item items left level link links list local main message mobile module news outer page pages panel post posts primary right row "
    "secondary section sections site slot sticky stories text this title top unit vertical wrap wrapper zone".split()
)
PAGE_HEADER = frozenset(("header", "topbar"))
SPLIT = re.compile(r"[^a-z0-9]+")


class Node:
    __slots__ = ("tag", "names", "children", "parent", "holds_article")

    def __init__(self, tag: str, names: str, parent: Node | None):
        self.tag, self.names, self.parent, self.children, self.holds_article = tag, names, parent, [], False

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.names}"


def parse(source: str) -> Node:
    """The tree of a page: children are nodes and (decoded) strings."""
    root = here = Node("#", "", None)
    at, end = 0, len(source)
    while at < end:
        m = TAG.search(source, at)
        if m is None:
            here.children.append(html.unescape(source[at:]))
            break
        if m.start() > at:
            here.children.append(html.unescape(source[at:m.start()]))
        at = m.end()
        if m[1] is not None:
            here.children.append(m[1])
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        if m[2] or m[5]:
            node = here
            while node is not root and node.tag != name:
                if name not in BLOCKS and node.tag in BLOCKS:  # an inline end tag does not close blocks
                    node = root
                else:
                    node = node.parent
            if node is not root:
                here = node.parent
            elif name == "br":
                here.children.append(Node("br", "", here))
            continue
        if name in BLOCKS:
            node = here  # an open paragraph ends where a block starts
            while node is not root and node.tag != "p" and node.tag not in BLOCKS:
                node = node.parent
            if node.tag == "p":
                here = node.parent
        if name in CLOSES:
            ends, scope = CLOSES[name]
            node = here
            while node is not root and node.tag not in scope:
                if node.tag in ends:
                    here = node.parent
                node = node.parent
        attributes = m[4] or ""
        names = ""
        if attributes and attributes.strip(" /"):
            found = [(k.lower(), (v or "").strip("\"'").lower()) for k, v in ATTRIBUTE.findall(attributes)]
            if any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in found):
                names = "hidden "
            names += " ".join(v for k, v in found if k in ("class", "id", "role"))
        node = Node(name, names, here)
        here.children.append(node)
        if name in ("article", "main"):
            above = here
            while above is not None and not above.holds_article:
                above.holds_article, above = True, above.parent
        if name in RAW:
            stop = RAW[name].search(source, at)
            at = stop.end() if stop else end
        elif name not in VOID:
            here = node
    return root


@lru_cache(maxsize=10_000)
def chrome_names(names: str) -> tuple[bool, bool]:
    """(some name tells of chrome, some word tells of a page header).  A name such as "cookie-notice" does
    if its last word does, or if one does and the others only say how the element is built."""
    chrome = header = False
    for name in names.split():
        words = [w for w in SPLIT.split(name) if w]
        known = [w in CHROME for w in words]
        chrome |= any(known) and (known[-1] or all(k or w in PARTS or len(w) < 3 or w[0].isdigit() for k, w in zip(known, words, strict=True)))
        header |= not PAGE_HEADER.isdisjoint(words)
    return chrome, header


def is_chrome(node: Node, inside: bool) -> bool:
    """The element is no part of an article; ``inside``: it lies in one."""
    if node.tag in NEVER:
        return True
    chrome, header = chrome_names(node.names) if node.names else (False, False)
    if node.names.startswith("hidden ") or chrome or (not inside and (node.tag == "header" or header)):
        return not node.holds_article
    return False


def visit(node: Node, inside: bool) -> Iterator[tuple[Node | str, bool]]:
    """(what lies below ``node``, whether its end is reached) in page order, without what is
    chrome; elements come before and after what lies in them.  Pages may nest as deep as they like."""
    stack: list[tuple[Node, Iterator]] = [(node, iter(node.children))]
    while stack:
        at, rest = stack[-1]
        for c in rest:
            if isinstance(c, str):
                yield c, False
            elif not is_chrome(c, inside):
                yield c, False
                stack.append((c, iter(c.children)))
                break
        else:
            stack.pop()
            if stack:
                yield at, True


def text_size(node: Node) -> int:
    size, stack = 0, [node]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, str):
                size += len(c)
            elif c.tag not in NEVER:
                stack.append(c)
    return size


def main_node(root: Node) -> Node:
    """The largest article outside chrome, else the main element (the outermost, where they nest), else the whole page."""
    articles, mains, article, main = [], [], None, None
    for c, done in visit(root, False):
        if isinstance(c, str):
            continue
        if done:
            article, main = None if c is article else article, None if c is main else main
        elif article is None:
            if c.tag == "article":
                articles.append(c)
                article = c
            elif main is None and (c.tag == "main" or "main" in c.names.split()):
                mains.append(c)
                main = c
    return max(articles or mains or [root], key=text_size)


# Layout: the tree of a page's blocks ----------------------------------------------------------


@lru_cache(maxsize=50_000)
def label_hash(label: str) -> int:
    """Label of a slot; numbers in names (``post-123``) count as one."""
    return digest(DIGITS.sub("0", label))


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Slot:
    """Position of blocks in a page: siblings in a row that are built alike share one."""

    __slots__ = ("label", "tag", "children", "shape", "into", "number")

    def __init__(self, label: int | str, tag: str = ""):
        self.label, self.tag, self.children, self.shape, self.into, self.number = label, tag, [], 0, None, -1


@dataclass(slots=True)
class Block:
    slot: Slot
    text: str
    links: int  # code points inside links, without blanks
    anchors: int


def fold(kept: Slot, same: Slot) -> None:
    """Every slot below ``same`` stands for its counterpart below ``kept``, which is built alike."""
    stack = [(kept, same)]
    while stack:
        x, y = stack.pop()
        y.into = x
        stack += zip(x.children, y.children, strict=True)


def layout(node: Node) -> tuple[Slot, list[Block]]:
    """Slots below ``node``, numbered in page order, and its blocks with text."""
    root = Slot(label_hash(node.label), node.tag)
    path, out, held = [root], [], []
    links = anchors = depth = 0

    def close() -> None:
        nonlocal links, anchors
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(Block(path[-1], text, links, anchors))
        links, anchors = 0, min(depth, 1)

    for c, done in visit(node, True):
        if isinstance(c, str):
            held.append(c)
            if depth:
                links += sum(map(len, c.split()))
        elif c.tag in ("br", "wbr", "hr"):
            if not done:
                held.append("" if c.tag == "wbr" else " ")
                if c.tag == "hr":
                    close()
        elif c.tag == "a":
            depth += -1 if done else 1
            anchors += not done
        elif c.tag in BLOCKS:
            close()
            if done:
                slot = path.pop()
                slot.shape = hash((slot.label, *(k.shape for k in slot.children)))
                above = path[-1].children
                if above and above[-1].shape == slot.shape:
                    fold(above[-1], slot)
                else:
                    above.append(slot)
            else:
                path.append(Slot(label_hash(c.label), c.tag))
    close()
    for number, (_, slot) in enumerate(walk(root)):
        slot.number = number
    for b in out:
        while b.slot.into is not None:
            b.slot = b.slot.into
    return root, out


def walk(root: Slot) -> Iterator[tuple[int, Slot]]:
    """(depth, slot) in page order."""
    stack = [(0, root)]
    while stack:
        depth, slot = stack.pop()
        yield depth, slot
        stack += ((depth + 1, c) for c in reversed(slot.children))


def pack(root: Slot) -> bytes:
    return np.array([(depth, slot.label) for depth, slot in walk(root)], np.int64).tobytes()


def unpack(shape: bytes) -> Slot:
    path: list[Slot] = []
    for number, (depth, label) in enumerate(np.frombuffer(shape, np.int64).reshape(-1, 2).tolist()):
        slot = Slot(label)
        slot.number = number
        del path[depth:]
        if path:
            path[-1].children.append(slot)
        path.append(slot)
    return path[0]


#: References come again page after page.
reference_tree = lru_cache(maxsize=64)(unpack)


# Induction ---------------------------------------------------------------------------------


def match(a: Slot, b: Slot) -> tuple[int, list[tuple[Slot, Slot]]]:
    """Simple tree matching: (matched nodes, pairs)."""
    result = None
    stack = [_match(a, b)]
    while stack:  # subtrees are matched as their parents ask for them
        try:
            asked, result = stack[-1].send(result), None
            stack.append(_match(*asked))
        except StopIteration as end:
            stack.pop()
            result = end.value
    return result


def _match(a: Slot, b: Slot) -> Generator[tuple[Slot, Slot], tuple[int, list], tuple[int, list]]:
    if a.label != b.label:
        return 0, []
    n, m = len(a.children), len(b.children)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    found: dict[tuple[int, int], tuple[int, list]] = {}
    for i in range(1, n + 1):
        x = a.children[i - 1]
        row, above = best[i], best[i - 1]
        for j in range(1, m + 1):
            y = b.children[j - 1]
            v = max(above[j], row[j - 1])
            if x.label == y.label:
                w = 1
                if x.children and y.children:
                    found[i, j] = yield x, y
                    w = found[i, j][0]
                v = max(v, above[j - 1] + w)
            row[j] = v
    pairs, i, j = [(a, b)], n, m
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs += found[i, j][1] if (i, j) in found else [(a.children[i - 1], b.children[j - 1])]
            i, j = i - 1, j - 1
    return 1 + best[n][m], pairs


def numbers(root: Slot, reference: bytes) -> dict[int, int]:
    """Slot of the reference for each slot of a page that is matched to one."""
    return {x.number: y.number for x, y in match(root, reference_tree(reference))[1]}


def is_menu(blocks: list[Block], in_article: bool) -> bool:
    """The blocks of a slot look like a menu: several links that hold most of the text, or, in a page
    without any article or main element, items that are all short and no sentences."""
    tag = blocks[0].slot.tag
    if tag in HEADINGS:
        return False
    chars = sum(len(b.text) - b.text.count(" ") for b in blocks)
    if sum(b.anchors for b in blocks) >= 2 and sum(b.links for b in blocks) >= LINKS * chars:
        return True
    return not in_article and tag in ("li", "div", "td", "dd") and len(blocks) >= 3 and all(len(b.text) <= SHORT and b.text[-1] not in ".!?:;…" for b in blocks)


def group_of(host: str, page: str, main: Node) -> int:
    """Pages of a host whose main elements lie below the same labels have one wrapper; pages without a host have none."""
    if not host:
        return digest(f"\0{page}")
    chain, at = [], main
    while at is not None:
        chain.append(label_hash(at.label))
        at = at.parent
    return digest(f"{host}\0{chain}")


def signature(page: str | None) -> int:
    """Middle checksum of the longer texts between tags: copies and near copies mostly share it, pages that
    share a notice do not."""
    found = sorted({zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in re.findall(r">([^<]{30,})<", page or "")})
    return found[len(found) // 2] if found else 0


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(grp, shape, menus, constants): the reference of every layout of a host, its slots that are menus, and
    the texts that are constant in a slot.  Every page counts; no page is gathered with another."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, "page"):
            rows = []
            for host, page in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                main = main_node(parse(page))
                root, found = layout(main)
                by_slot: dict[int, list[Block]] = {}
                for b in found:
                    by_slot.setdefault(b.slot.number, []).append(b)
                menus = [n for n, held in by_slot.items() if is_menu(held, main.tag != "#")]
                texts = sorted({(b.slot.number, digest(b.text)) for b in found})
                shape = pack(root)
                rows.append((group_of(host, page, main), signature(page), len(shape) // 16, shape, digest(page), sorted(by_slot), menus, [n for n, _ in texts], [t for _, t in texts]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), FEATURES, strict=True)], names=[n for n, _ in FEATURES])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                to = numbers(unpack(r["shape"]), r["reference"])
                menus = set(r["menus"])
                rows += ((r["grp"], to[n], 0, r["sign"], int(n in menus)) for n in {0, *r["slots"]} if n in to)
                rows += ((r["grp"], to[n], t or 1, r["sign"], 0) for n, t in zip(r["at"], r["texts"], strict=True) if n in to)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), COUNTS, strict=True)], names=[n for n, _ in COUNTS])

    src = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("page")).where((F.col("host") != "") & (F.length("page") > 0))
    seen = written(src.mapInArrow(read, "grp long, sign long, size long, shape binary, page_hash long, slots array<int>, menus array<int>, at array<int>, texts array<long>"), "layouts")
    # Any page of a usual size, else the smallest; chosen inside every task first.
    order = F.struct(F.greatest("size", F.lit(REFERENCE_SLOTS)), "page_hash")
    chosen = seen.groupBy("grp").agg(F.min_by("shape", order).alias("reference"), F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES)
    spread = chosen.select("grp", "reference", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = seen.drop("size").withColumn("salt", F.pmod("page_hash", F.lit(SALTS)).cast("int"))
    counted = dealt.join(spread, ["grp", "salt"]).mapInArrow(count, "grp long, slot int, txt long, sign long, menu int")
    # Copies (pages of one signature) count once.
    once = counted.groupBy("grp", "slot", "txt", "sign").agg(F.max("menu").alias("menu"))
    sums = written(once.groupBy("grp", "slot", "txt").agg(F.count("*").alias("n"), F.sum("menu").alias("menu")).where(F.col("n") >= CONSTANT * LEAST_PAGES), "slots")
    whole = sums.where("slot = 0 and txt = 0").where(F.col("n") >= LEAST_PAGES).select("grp", F.col("n").alias("pages"))
    menus = sums.where("txt = 0").where((F.col("n") >= LEAST_PAGES) & (F.col("menu") >= CONSTANT * F.col("n")))
    each = whole.select("grp", "pages", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    texts = sums.where("txt <> 0").withColumn("salt", F.pmod("txt", F.lit(SALTS)).cast("int")).join(each, ["grp", "salt"]).where(F.col("n") >= CONSTANT * F.col("pages"))
    # At most the slots of the reference, and texts that nearly every page holds.
    kept = menus.select("grp", "slot", "txt").unionAll(texts.select("grp", "slot", "txt")).groupBy("grp").agg(F.collect_list(F.struct("slot", "txt")).alias("drops"))
    return kept.join(chosen.select("grp", "reference"), "grp")


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def keep(root: Slot, found: list[Block], reference: bytes | None, drops: list[tuple[int, int]]) -> str:
    """Text of the blocks that a wrapper leaves; ``drops``: (slot, text hash), 0 for all texts of a slot."""
    if reference is None:
        return "\n".join(b.text for b in found)
    gone, to = frozenset(drops), numbers(root, reference)

    def stays(number: int, text: str) -> bool:
        slot = to.get(number)
        return slot is None or ((slot, 0) not in gone and (slot, digest(text) or 1) not in gone)

    return "\n".join(b.text for b in found if stays(b.slot.number, b.text))


def main_text(page: str | None) -> str:
    """The text without a wrapper."""
    return keep(*layout(main_node(parse(page))), None, []) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The query: (page_id, url, text, n_chars) of every page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for piece in arrow_steps(batches, "page"):
            grp, salt, shape, slots, texts = [], [], [], [], []
            for host, page in zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True):
                main = main_node(parse(page or ""))
                root, found = layout(main)
                grp.append(group_of(host, page or "", main))
                salt.append(row % SALTS)
                shape.append(pack(root))
                slots.append([b.slot.number for b in found])
                texts.append([b.text for b in found])
                row += 1
            columns = [piece.column(0), piece.column(1), pa.array(grp, pa.int64()), pa.array(salt, pa.int32()), pa.array(shape, pa.binary()), pa.array(slots, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "grp", "salt", "shape", "slots", "texts"])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for r in batch.drop_columns(["page_id", "url"]).to_pylist():
                found = [Block(Slot(0), t, 0, 0) for t in r["texts"]]
                for b, n in zip(found, r["slots"], strict=True):
                    b.slot.number = n
                drops = [(d["slot"], d["txt"]) for d in r["drops"] or ()]
                texts.append(keep(unpack(r["shape"]), found, r["reference"], drops))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("page"))
    # A host may hold a large share of all pages: its rows go to SALTS keys, its one wrapper to each of them
    # (and AQE may split further).  What travels is the text, not the page.
    rows = rows.mapInArrow(read, "page_id long, url string, grp long, salt int, shape binary, slots array<int>, texts array<string>")
    known = wrappers(pages, url_col, html_col).select("grp", "reference", "drops", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.join(known, ["grp", "salt"], "left").mapInArrow(clean, "page_id long, url string, text string, n_chars long")
