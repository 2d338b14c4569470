"""HTML extraction by wrapper induction.

Pages of one host are aligned as trees of their block elements. Siblings with the same label (tag and classes) count as
one repeatable node, so that places do not hang on the length of a page; two trees are aligned by simple tree matching (of their children, the sequence of pairs
with the greatest number of matching nodes below), and nodes without a partner are taken over. What all pages of a
host come to is its wrapper. Every text of a page then has a slot, the node of the wrapper its element is aligned
with. A text found in the same slot of nearly all different pages of the host that have the slot, or of those of them in
one language, is constant and belongs to the template; what varies is content. Layouts whose elements or classes differ
have slots of their own. A page more than half of which would go as constant is taken for a copy and keeps its text.
Regions that say what they are (menus, page headers and footers, sidebars, adverts, notices,
forms, reader comments, scripts, styles, hidden parts) are never content, and if a page marks its article, only that is.
A region says so by a class or id that is such a name, alone or among plain words (inside an article, fewer of them); a comment
marked as an article is none. A form or a named region, comments aside, that holds more than half of the page's text is the frame the
page is built into, and content. Bylines that are named so stay in an article, also where they are equal on all pages.

Blocks are runs of text between block elements, character references decoded, white space as one space, trimmed, and
joined in page order by line feeds. Broken markup is read as browsers do in the main: missing ends of paragraphs, items
and cells are implied, unknown ends are skipped, elements nested deeper than `MOST_DEPTH` have
the slot of the one at that depth, buttons, lists of choices, drawings and formulas without an end of their own end with
their line. A null
or empty page has an empty text; a null or odd url stands for one host of its own; rows that repeat a page are read
each on its own, but equal pages count once for the template; an empty table gives an empty result. Only page_id, url
and html are read.

Structures are reduced to distinct ones by partial aggregates and folded in two levels, and constants are counted by
partial aggregates, so a host may hold any share of the pages.
"""

from __future__ import annotations

import html as markup
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import slices, stage

MOST_DEPTH = 100
# A constant stands on this share of the different pages that have its place, which must be so many, or all of a host or
# language that has fewer.
SHARE, LEAST_PAGES = 0.8, 5
FOLDS = 64
# Wrappers up to so many characters go to all tasks.
MOST_BYTES = 1 << 24

# What HTML says of its elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike "
    "strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe".split())
# Not content, and inside a line of text that goes on behind them.
ASIDE = frozenset("svg math object select button".split())
FOREIGN = frozenset(["svg", "math"])
HTML_IN_FOREIGN = frozenset("foreignobject desc annotation-xml".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
IMPLIED = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("table ul ol dl body html article section div td th nav".split())
# Elements, roles and names that say a region is not the article.
NEVER = frozenset("nav aside footer form head dialog menu search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisement|advertising|adbox|adsense|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|"
    r"notices?|alert|newsletter|subscribe|subscription|signup|login|comments?|commentlist|disqus|replies|reply|respond|share|sharing|"
    r"social|sidebar|side-bar|widget|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|toolbar|related|"
    r"recommend(?:ed|ations)?|popup|modal|overlay|pagination|pager|skip-link|skiplink|paywall)(?:$|[^a-z])"
)
# Names of readers' comments, and words that stand beside a name without saying what a region tells of.
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies reply respond".split())
PLAIN_NAMES = frozenset(
    "area bar block body box button buttons container content entry form group holder icon icons inner item items left link links list "
    "article articles cookie outer panel post posts reader right section slot story stories top bottom unit user wrap wrapper".split()
)
# The same around the article, where a page is put together; "no", "with", "open" and the like are none of them.
AROUND = frozenset(
    "aside col column columns desktop dropdown fixed float floating foot global head header home horizontal img inline large level "
    "lower main mobile module navs over page primary region row secondary side site sticky sub text title toggle upper vertical web wp".split()
)
# Names of who wrote an article and when: part of it, also where they are equal on all pages.
AUTHORED = re.compile(r"(?:^|[^a-z])(?:author|authors|byline|dateline|writer)(?:$|[^a-z])")
# Elements whose id can name a region; on others it is an anchor.
REGIONS = frozenset("div ul ol table".split())
_NAMED = REGIONS | frozenset("section form nav aside header footer dl table tbody tr td center figure details".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+)|<",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_DIGITS = re.compile(r"\d+")
_NO_LETTERS = re.compile(r"[^a-z]+")


class Node:
    """A block element: its label, its children, and whether its text can be content."""

    __slots__ = ("article", "children", "depth", "label", "language", "off", "parent", "parked", "said", "tag", "top", "slot")

    def __init__(self, tag: str, label: str, parent: Node | None, said: str, article: bool):
        self.tag, self.label, self.parent, self.said, self.article = tag, label, parent, said, article
        self.off = bool(said) or (parent is not None and parent.off)
        self.children: list[Node] = []
        self.slot: str | None = None
        self.language = ""  # what the page says, kept at its root
        self.depth = parent.depth + 1 if parent else 0
        # Text of the line around an element that is not content, with its open hidden elements.
        self.parked: tuple[list[str], list[str]] | None = None
        # The nearest node of the tree: this one, or above one that is too deep to belong to it.
        self.top = self


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _says_off(tag: str, said: dict[str, str], in_article: bool) -> str:
    """Whether an element is not content by what it says of itself: "hard", "soft" where a page may be built into it, or ""."""
    if (tag in NEVER and tag != "form") or (tag == "header" and not in_article):
        return "hard"
    soft = "soft" if tag == "form" else ""
    if not said:
        return soft
    role = said.get("role", "").lower()
    if (role in ROLES and role != "form") or "hidden" in said or said.get("aria-hidden", "").lower() == "true":
        return "hard"
    if re.search(r"display\s*:\s*none", said.get("style", "").lower()):
        return "hard"
    if role == "form":
        soft = "soft"
    if tag in ("body", "html", "main"):
        return soft
    classes, anchor = said.get("class", "").lower().split(), said.get("id", "").lower()
    # The id of many an element is an anchor, in an article even that of a section.
    named = REGIONS if in_article else _NAMED
    names = [*classes, anchor if tag in named or tag == "article" else ""]
    if any(_is_name(x, COMMENT_NAMES) for x in names):
        return "hard"
    if tag != "article" and any(_is_name(x, None, frozenset() if in_article else AROUND) for x in names):
        return "soft"
    return soft


def _is_name(said: str, names: frozenset[str] | None = None, plain: frozenset[str] = frozenset()) -> bool:
    """Whether a class or id is a known name, alone or among plain words."""
    parts = [x for x in _NO_LETTERS.split(said) if x]
    known = [x in names if names is not None else bool(NAMES.search(x)) for x in parts]
    if names is None and NAMES.fullmatch(said.replace("_", "-")):
        return True
    return any(known) and all(k or x in PLAIN_NAMES or x in plain for k, x in zip(known, parts))


def _relieve(nodes: list[Node], blocks: list[tuple[Node, str]]) -> None:
    """Regions that hold most of the text of a page are its frame, however they are named, and forms around it no forms."""
    if not any(n.said == "soft" for n in nodes):
        return
    size = dict.fromkeys(map(id, nodes), 0)
    total = 0
    hard: dict[int, bool] = {}
    for n in nodes:
        hard[id(n)] = n.said == "hard" or (n.parent is not None and hard[id(n.parent)])
    for n, text in blocks:
        if not hard[id(n)]:
            size[id(n)] += len(text)
            total += len(text)
    for n in reversed(nodes):
        if n.parent is not None:
            size[id(n.parent)] += size[id(n)]
    for n in nodes:
        frame = n.said == "soft" and 2 * size[id(n)] > total
        n.off = (n.parent is not None and n.parent.off) or (bool(n.said) and not frame)


def parse(page: str | None) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree of block elements and the blocks of text in page order, each with its element."""
    page = page or ""
    root = Node("", "", None, "", False)
    nodes = [root]
    here, blocks, held, at = root, [], [], 0
    hidden: list[str] = []  # inline elements that are not content and still open
    opened: Counter[str] = Counter()  # elements open at this place
    last_end: dict[str, int] = {}

    def flush() -> None:
        nonlocal held
        if held:
            text = " ".join(markup.unescape("".join(held)).split())
            if text:
                blocks.append((here, text))
            held = []

    def close(to: Node) -> None:
        """End all elements below `to`."""
        nonlocal here, held, hidden
        while here is not to:
            flush()
            hidden = []
            opened[here.tag] -= 1
            if here.parked is not None:
                held, hidden = here.parked
            here = here.parent

    def ends(tag: str) -> bool:
        """Whether an element that starts here has an end tag, before the next one of its kind starts."""
        if tag not in last_end:
            last_end[tag] = max((e.start() for e in re.finditer(rf"</{tag}(?=[\s/>])", page, re.IGNORECASE)), default=-1)
        if last_end[tag] < at:
            return False
        if tag == "object":
            return True
        return re.compile(rf"<(/?){tag}(?=[\s/>])", re.IGNORECASE).search(page, at)[1] == "/"

    def foreign() -> Node | None:
        """The drawing or formula that this place is directly in."""
        if not (opened["svg"] or opened["math"]):
            return None
        up = here
        while up is not root and up.tag not in HTML_IN_FOREIGN:
            if up.tag in FOREIGN:
                return up
            up = up.parent
        return None

    while m := _TOKEN.match(page, at):
        at = m.end()
        closing, tag, rest, text = m.groups()
        if text is not None or (tag is None and m.group() == "<"):
            if not hidden:
                held.append(text if text is not None else "<")
            continue
        if tag is None:
            if m.group().startswith("<![CDATA[") and not hidden:
                held.append(markup.escape(m.group()[9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if closing:
            if tag in INLINE:
                if tag in hidden:
                    del hidden[hidden.index(tag) :]
                continue
            if opened[tag]:
                up = here
                while up.tag != tag:
                    up = up.parent
                close(up.parent)
            elif tag in ASIDE and tag in hidden:
                del hidden[hidden.index(tag) :]
            elif tag == "p":
                flush()
            continue
        drawing = foreign()
        if drawing is not None:
            if tag in ENDS_PARAGRAPH or tag in IMPLIED or tag in ("body", "img", "br"):
                close(drawing.parent)
            elif rest.rstrip().endswith("/"):
                continue
        if tag in ASIDE:
            if tag not in FOREIGN:
                held.append(" ")
            elif rest.rstrip().endswith("/"):
                continue
            if ends(tag):
                # Kept out of the tree, so that a wrapper is not made of drawings.
                node = Node(tag, tag, here, "hard", here.article)
                nodes.append(node)
                node.top, node.parked = here.top, (held, hidden)
                here, held, hidden = node, [], []
                opened[tag] += 1
            else:
                # Without an end of its own it ends with the line.
                hidden.append(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.IGNORECASE).search(page, at)
            at = end.end()
            if not rest.rstrip().endswith("/"):
                held.append(" ")
            continue
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                held.append(" " if tag == "br" else "")
            elif hidden or (rest and _says_off(tag, _attributes(rest), here.article)):
                hidden.append(tag)
            continue
        flush()
        hidden = []
        if tag in ENDS_PARAGRAPH:
            if opened["p"]:
                up = here
                while up is not root and up.tag != "p" and up.tag not in SCOPES and up.tag not in ASIDE:
                    up = up.parent
                if up.tag == "p":
                    close(up.parent)
        elif tag in IMPLIED and any(opened[x] for x in IMPLIED[tag]):
            up, last = here, None
            while up is not root and (up.tag in IMPLIED[tag] or up.tag not in SCOPES) and up.tag not in ASIDE:
                if up.tag in IMPLIED[tag]:
                    last = up
                up = up.parent
            if last is not None:
                close(last.parent)
        if tag in VOID:
            continue
        said = _attributes(rest) if rest else {}
        if tag == "html" and not root.language:
            root.language = _NO_LETTERS.split(said.get("lang", "").lower())[0]
        names = " ".join(sorted(_DIGITS.sub("", said.get("class", "")).split()))
        marked = here.article or tag in ("article", "main") or said.get("role", "").lower() == "main"
        node = Node(tag, f"{tag}.{names}" if names else tag, here, _says_off(tag, said, here.article), marked)
        nodes.append(node)
        if here.top is here and here.depth <= MOST_DEPTH:
            here.children.append(node)
        else:
            node.top = here.top
        here = node
        opened[tag] += 1
    close(root)
    flush()
    _relieve(nodes, blocks)
    return root, blocks


# Structures: (label, (children...)), hashable and free of text.


def matching(a: tuple, b: tuple) -> list[tuple[int, int]]:
    """Simple tree matching of two sequences of structures: the pairs that match the most nodes, in order."""
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    worth = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            w = 0
            if x[0] == y[0]:
                w = worth[i, j] = nodes_matched(x, y)
            rows[i + 1][j + 1] = max(rows[i][j + 1], rows[i + 1][j], rows[i][j] + w)
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def nodes_matched(a: tuple, b: tuple) -> int:
    if a[0] != b[0]:
        return 0
    if a[1] == b[1]:
        return _size(a)
    return 1 + sum(nodes_matched(a[1][i], b[1][j]) for i, j in matching(a[1], b[1]))


def _size(a: tuple) -> int:
    return 1 + sum(map(_size, a[1]))


def merge(a: tuple, b: tuple) -> tuple:
    """Both structures in one: matched nodes once, the others where they stand."""
    if a == b:
        return a
    out, i, j = [], 0, 0
    for x, y in [*matching(a[1], b[1]), (len(a[1]), len(b[1]))]:
        out += a[1][i:x] + b[1][j:y]
        if x < len(a[1]):
            out.append(merge(a[1][x], b[1][y]))
        i, j = x + 1, y + 1
    return a[0], collapse(out)


def collapse(children: list[tuple]) -> tuple:
    """Siblings with the same label as one, however many and in whatever order they come."""
    by_label: dict[str, tuple] = {}
    for child in children:
        known = by_label.get(child[0])
        by_label[child[0]] = merge(known, child) if known else child
    return tuple(by_label.values())


def structure(node: Node) -> tuple:
    return node.label, collapse([structure(c) for c in node.children])


def place(node: Node, wrapper: tuple, slot: str = "") -> None:
    """Give every node its slot: the place of its partner in the wrapper, or the labels that lead to it."""
    # A byline is told by its labels, at any place.
    node.slot = f"{slot}@" if "@" not in slot and node.article and AUTHORED.search(node.label) else slot
    partners = {child[0]: (f"{node.slot}.{j}", child) for j, child in enumerate(wrapper[1])}
    for child in node.children:
        at, partner = partners.get(child.label) or (f"{node.slot}/{child.label.replace('@', '')}", (child.label, ()))
        place(child, partner, at)


def _dump(shape: tuple) -> str:
    return json.dumps(shape, separators=(",", ":"))


def _load(text: str) -> tuple:
    def tupled(x):
        return x[0], tuple(map(tupled, x[1]))

    return tupled(json.loads(text))


def _structures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", 1 << 22):
        found = {}
        for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
            found[host, _dump(structure(parse(page)[0]))] = True
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in found], pa.string()) for i in (0, 1)], ["host", "shape"])


def _fold(rows: pa.Table) -> pa.Table:
    shapes = sorted(rows["shape"].to_pylist())
    wrapper = _load(shapes[0])
    for shape in shapes[1:]:
        wrapper = merge(wrapper, _load(shape))
    return pa.table({"host": rows["host"][:1].cast(pa.string()), "shape": pa.array([_dump(wrapper)])})


def induce(pages: DataFrame) -> DataFrame:
    """host, shape: the wrapper of every host of `pages` (host, html)."""
    shapes = pages.select("host", "html").mapInArrow(_structures, "host string, shape string").distinct()
    shapes = shapes.withColumn("fold", F.pmod(F.xxhash64("shape"), F.lit(FOLDS)))
    schema = "host string, shape string"
    parts = shapes.groupBy("host", "fold").applyInArrow(_fold, schema)
    return parts.groupBy("host").applyInArrow(_fold, schema)


def _candidates(page: str | None, wrapper: tuple) -> tuple[list[tuple[str, str]], str]:
    """Slot and text of the blocks that can be content, in page order, and the language of the page."""
    root, blocks = parse(page)
    place(root, wrapper)
    able = [(n, t) for n, t in blocks if not n.off]
    marked = [(n, t) for n, t in able if n.article]
    return [(f"{root.language}|{n.top.slot}", t) for n, t in marked or able], root.language


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


class _Wrappers(dict):
    """Wrappers read from their text, the last few kept."""

    def __missing__(self, text: str) -> tuple:
        if len(self) > 1000:
            self.clear()
        self[text] = found = _load(text)
        return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each slot and text of a page once, with a hash of the page; and each slot, that of the page itself too, without."""
    known = _Wrappers()
    for batch in slices(batches, "html", 1 << 22):
        hosts, pages, slots, texts = [], [], [], []
        for host, page, shape in zip(*(batch[c].to_pylist() for c in ("host", "html", "shape"))):
            able, language = _candidates(page, known[shape])
            found = {(s, _hash(t)) for s, t in able}
            found = sorted(found) + [(s, None) for s in sorted({s for s, _ in found} | {language + "|"})]
            number = _hash(page or "")
            for slot, text in found:
                hosts.append(host)
                pages.append(number)
                slots.append(slot)
                texts.append(text)
        columns = [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(slots, pa.string()), pa.array(texts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["host", "page", "slot", "text"])


def template_texts(pages: DataFrame) -> DataFrame:
    """host, constants: the (slot, text hash) pairs that belong to the template of each host; pages: host, html, shape."""
    found = pages.mapInArrow(_texts, "host string, page long, slot string, text long").distinct()
    counts = stage(found.groupBy("host", "slot", "text").agg(F.count("*").alias("n")), "slot-texts")
    # Slots begin with the language of the page; without it they stand for all pages of the host.
    anywhere = counts.groupBy("host", F.regexp_replace("slot", r"^[^|]*\|", "").alias("slot"), "text").agg(F.sum("n").alias("n"))
    counts = counts.unionByName(anywhere).withColumn("scope", F.regexp_extract("slot", r"^([a-z]*\|)?", 0))
    totals = counts.where("text IS NULL")
    slots = totals.select("host", "slot", F.col("n").alias("pages"))
    scopes = totals.where("slot = scope").select("host", "scope", F.col("n").alias("scope_pages"))
    often = counts.where("text IS NOT NULL AND n >= 2").join(slots, ["host", "slot"]).join(scopes, ["host", "scope"])
    often = often.where(F.expr(f"pages >= least({LEAST_PAGES}, scope_pages) AND n >= {SHARE} * pages"))
    # On at least that share of the pages of a slot: no more of them than a few times the blocks of one page of each layout.
    return often.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("slot", "text"))).alias("constants"))


def _without(found: list[tuple[str, str]], constants: set) -> list[str]:
    """The texts that are not constant, of blocks with their slots; all, if that would take more than half of the page."""

    def constant(slot: str, text: str) -> bool:
        # The labels of the element and what is around it are not in a slot's number, those of bylines are marked in it.
        return "@" not in slot and bool({(slot, h := _hash(text)), (slot.split("|", 1)[1], h)} & constants)

    rest = [t for s, t in found if not constant(s, t)] if constants else [t for _, t in found]
    if 2 * sum(map(len, rest)) < sum(len(t) for _, t in found):
        return [t for _, t in found]
    return rest


def _extracted(keep: list[str]) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Wrappers()
        for batch in slices(batches, "html", 1 << 22):
            texts = []
            for page, shape, constants in zip(*(batch[c].to_pylist() for c in ("html", "shape", "constants"))):
                found, _ = _candidates(page, known[shape])
                texts.append("\n".join(_without(found, {(c["slot"], c["text"]) for c in constants or ()})))
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keep), pa.array(texts, pa.string())], [*keep, "text"])

    return step


def _small(told: DataFrame) -> DataFrame:
    """A stored table of hosts, to be sent to the tasks if it is small, so that pages are not moved to meet it.

    Else both sides are shuffled, and Spark splits the pages of a hot host.
    """
    sizes = [F.length("shape"), *([40 * F.coalesce(F.size("constants"), F.lit(0))] if "constants" in told.columns else [])]
    size = told.agg(F.coalesce(F.sum(sum(sizes[1:], sizes[0]) + F.length("host") + 64), F.lit(0))).first()[0]
    return F.broadcast(told) if size <= MOST_BYTES else told


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of `pages` (page_id, url, html)."""
    url = F.col("url").cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))
    wrappers = stage(induce(rows), "wrappers")
    constants = stage(template_texts(rows.select("host", "html").join(_small(wrappers), "host")), "template")
    told = stage(wrappers.join(constants, "host", "left"), "told")
    return rows.join(_small(told), "host").mapInArrow(_extracted(["page_id", "url"]), "page_id long, url string, text string")
