"""HTML main text by tree scoring (operator 4).

Paragraphs pass points for their length and commas to their parent and, halved, on to the ancestors; a container's
points are discounted by the share of its text that lies in links. The best container and those of its siblings that aren't mostly links
are kept, without what is no article text: menus, headers, footers, sidebars, notices, adverts, forms, comments of readers. What is named as comments goes
wherever it stands and whatever it holds, unless the page has no other text. Other names (class, id, role) and forms take away an element unless the best
container lies in it and nothing outside comes near its points. Articles in containers of their own are joined if their points come near the best one's.
Pages are judged one by one where they lie, without a shuffle; a page becomes a small tree while it is read, in time linear in its length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_arrow, struct

# Element and name lists.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video textarea select xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul br".split())
CONTAINERS = frozenset("article main section div td body blockquote".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 div section article main figcaption".split())
UNWANTED = frozenset("nav header footer aside form menu button dialog head title label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
UNWANTED_NAMES = frozenset(
    "nav navbar navigation menu header masthead banner footer foot sidebar side rail aside ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion"
    " comment comments commentlist reply replies respond disqus discussion share sharing social related recommended newsletter subscribe signup login popup modal overlay"
    " cookie cookies consent gdpr notice notices alert warning breadcrumb breadcrumbs pagination pager tagcloud widget search form toolbar copyright legal disclaimer skip".split()
)
NEUTRAL_NAMES = frozenset(
    "list box inner outer wrapper wrap container section block area bar item items links link top bottom left right main site page global primary secondary content module slot unit panel text button buttons"
    " post posts article articles user reader thread card row col column group title heading image img icon icons media the by my sub small large fixed sticky mobile desktop and in of for".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
#: A container with this share of the best one's points comes near it.
NEAR = 0.25
#: Closing one of these elements is implied when such another opens.
CLOSES_P = BLOCKS - frozenset("br option optgroup body html caption tbody td tfoot th thead tr".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TAG_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
TAG_STOP = re.compile(r"[>\"']")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
SPACES = re.compile(r"\s+")
#: Elements nest at most so deep; those below lie in the last one, as in browsers.
DEEPEST = 512


class Node:
    __slots__ = ("tag", "parent", "items", "unwanted", "doubted", "remark", "depth", "block", "points", "size", "linked")

    def __init__(self, tag: str, parent: Node | None, unwanted: bool = False, doubted: bool = False, remark: bool = False):
        self.tag, self.parent, self.unwanted, self.doubted, self.remark = tag, parent, unwanted, doubted, remark
        self.depth = parent.depth + 1 if parent else 0
        self.block = self if tag in BLOCKS else parent.block if parent else None  # the nearest block, itself included
        self.items: list = []
        self.points = 0.0
        self.size = self.linked = 0


def is_named(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names is made of unwanted or neutral words only, at least one of them among the given."""
    for name in value.split():
        parts = [p.lower() for p in NAME_PART.findall(name)]
        if any(p in words for p in parts) and all(p in UNWANTED_NAMES or p in NEUTRAL_NAMES or len(p) == 1 for p in parts):
            return True
    return False


def judged(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element is unwanted for certain; whether it is so only by its name, role or as a form; whether it is named as readers' comments, as an article may be too."""
    doubted, remark = tag == "form", False
    if tag in UNWANTED and not doubted:
        return True, False, False
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or name == "style" and HIDING.search(value) or name == "aria-hidden" and value.lower() == "true":
            return True, False, False
        if tag in ("body", "html", "main"):
            continue
        if name == "role" and value.lower() in ROLES:
            doubted = True
        if name in ("class", "id"):
            remark = remark or is_named(value, COMMENT_NAMES)
            doubted = doubted or tag != "article" and is_named(value, UNWANTED_NAMES)
        elif name == "itemprop" and value == "comment" or name == "itemtype" and value.endswith("/Comment"):
            remark = True
    return False, doubted and not remark, remark


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """Texts ("", text, "") and tags (name, with a slash before it if it closes, attributes, ""), in order; comments, scripts and the like leave nothing.

    Every search goes forward only, and one that reaches the end in vain isn't made again, so the time is linear.
    """
    place, end, quoted = 0, len(page), True
    without: set[str] = set()
    while place < end:
        at = page.find("<", place)
        if at < 0:
            break
        if at > place:
            yield "", page[place:at], ""
        place = at
        if page.startswith("<!--", at):
            close = page.find("-->", at + 2)
            place = end if close < 0 else close + 3
            continue
        found = TAG_NAME.match(page, at + 1)
        if not found:
            if page.startswith(("<!", "<?", "</"), at):
                close = page.find(">", at)
                place = end if close < 0 else close + 1
            else:  # a sign, not a tag
                yield "", "<", ""
                place = at + 1
            continue
        close = found.end()
        while quoted and (stop := TAG_STOP.search(page, close)):
            close = stop.start()
            if stop[0] == ">":
                break
            close = page.find(stop[0], close + 1) + 1
            if not close:
                stop = None
                break
        if not quoted or not stop:  # a quote that never ends: from here on a tag ends at the next >
            quoted = False
            close = page.find(">", found.end())
            if close < 0:
                yield "", page[at:], ""
                return
        place = close + 1
        name = found[0].lower()
        if name in RAW or name == "title":
            over = None if name in without else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, place)
            if over:
                place = over.end()
            else:
                without.add(name)
                place = place if name in ("object", "noscript") else end
            continue
        yield name, page[found.end() : close], ""
    if place < end:
        yield "", page[place:], ""


def tree(page: str) -> Node:
    """Elements and texts of a page. Unclosed and misplaced tags are closed as browsers would, by and large."""
    root = at = Node("#", None)
    open_tags: Counter = Counter()
    buried: Counter = Counter()  # open elements below the deepest level

    def close(up: Node) -> Node:
        """Closes the elements from here up to one, and gives its parent."""
        here = at
        while here is not up:
            open_tags[here.tag] -= 1
            here = here.parent
        open_tags[up.tag] -= 1
        return up.parent

    for name, text, _ in tokens(page):
        if not name:
            at.items.append(text)
            continue
        if name[0] == "/":
            tag = name[1:]
            if buried[tag]:
                buried[tag] -= 1
            elif open_tags[tag]:
                up = at
                while up.tag != tag:
                    up = up.parent
                at = close(up)
            continue
        tag = name
        if tag in CLOSES_P and at.block is not None and at.block.tag == "p":
            at = close(at.block)
        if tag in SAME:
            up = at
            while up.parent is not None and up.tag not in SAME[tag] and up.tag not in STOPS[tag]:
                up = up.parent
            while up.parent is not None and up.tag in SAME[tag]:
                at = up = close(up)
        node = Node(tag, at, *judged(tag, text))
        at.items.append(node)
        if tag not in VOID and not text.endswith("/"):
            if node.depth < DEEPEST:
                at = node
                open_tags[tag] += 1
            else:
                buried[tag] += 1
    settle(root)
    return root


def settle(root: Node) -> None:
    """Decides what names, roles and forms leave in doubt; twelve scorings at most, as elements nest at most DEEPEST deep."""
    doubted, remarks = [], []
    for node, begins in in_order(root):
        if begins and node.remark:
            remarks.append(node)
        elif begins and node.doubted:
            doubted.append(node)
    for node in remarks:
        node.unwanted = True
    if remarks and best_of(score(root)) is None:
        for node in remarks:
            node.unwanted = False
    if not doubted or (best := best_of(score(root))) is None:
        return
    points, chain, marked, holds = best.points, [], set(), False
    for node in around_of(best):
        holds = holds or node.tag in ("article", "main")
        if node.doubted:
            chain.insert(0, node)
            if holds:
                marked.add(id(node))
    for node in doubted:
        node.unwanted = True
    for node in chain:
        node.unwanted = False
    # the further in, the more lies outside: the outermost element goes that has a rival outside
    low, high = 0, len(chain)
    while low < high:
        middle = (low + high) // 2
        chain[middle].unwanted = True
        rival = best_of(score(root))
        chain[middle].unwanted = False
        need = 1.0 if id(chain[middle]) in marked and rival is not None and not is_marked(rival) else NEAR
        if rival is not None and rival.points >= need * points:
            high = middle
        else:
            low = middle + 1
    if low < len(chain):
        chain[low].unwanted = True


def around_of(node: Node) -> Iterator[Node]:
    """An element and those around it, outwards."""
    while node is not None:
        yield node
        node = node.parent


def is_marked(node: Node) -> bool:
    """Whether it is, or lies in, an article or main element."""
    return any(n.tag in ("article", "main") for n in around_of(node))


def best_of(found: list[Node]) -> Node | None:
    """The container with most points, in the article or main element with most points if there are any; None without points."""
    marked = [n for n in found if n.tag in ("article", "main") and n.points > 0]
    if marked:
        top = max(marked, key=lambda n: n.points)
        within = {id(n) for n, begins in in_order(top) if begins}
        found = [n for n in found if id(n) in within]
    best = max(found, key=lambda n: n.points, default=None)
    return best if best is not None and best.points > 0 else None


def in_order(node: Node) -> Iterator[tuple[Node, bool]]:
    """Every wanted node below with True as it begins and False as it ends; without recursion, as pages may nest deeply."""
    todo = [(node, True)]
    while todo:
        node, begins = todo.pop()
        yield node, begins
        if begins:
            todo.append((node, False))
            todo += [(x, True) for x in reversed(node.items) if isinstance(x, Node) and not x.unwanted]


def score(root: Node) -> list[Node]:
    """Fills size, linked and points; returns the containers that got points."""
    scored: dict[int, Node] = {}
    links = 0
    for node, begins in in_order(root):
        if begins:
            links += node.tag == "a"
            node.points, node.size, node.linked = 0.0, 0, 0
            continue
        texts = [x for x in node.items if isinstance(x, str)]
        own = sum(len(x.strip()) for x in texts)
        node.size += own
        node.linked += own if links else 0
        links -= node.tag == "a"
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.linked += node.linked
        inner = sum(x.size for x in node.items if isinstance(x, Node) and x.tag not in BLOCKS and not x.unwanted)
        length = own + inner
        if node.tag in PARAGRAPHS and length and node.parent is not None:
            commas = sum(x.count(",") for x in texts)
            points = (1 + commas + min(length / 100, 50)) * (1 - node.linked / max(1, node.size))
            up, share = (node if node.tag in ("div", "section", "article", "main", "td") else node.parent), 1.0
            while up is not None and share > 0.1:
                up.points += points * share
                scored[id(up)] = up
                up, share = up.parent, share / 2
    for node in scored.values():
        node.points *= 1 - node.linked / max(1, node.size)
    return [n for n in scored.values() if n.tag in CONTAINERS or n.tag == "#"]


def blocks_of(node: Node) -> Iterator[str]:
    """The texts of the blocks below, in page order."""
    held: list[str] = []
    todo: list = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            held.append(item)
            continue
        if item is None or item.tag in BLOCKS:  # a block begins or ends
            yield "".join(held)
            held = []
        if item is not None and not item.unwanted:
            if item.tag in BLOCKS:
                todo.append(None)
            todo += reversed(item.items)
    yield "".join(held)


def outermost(root: Node, chosen: set[int]) -> list[Node]:
    """The chosen wanted elements in page order, without those inside others of them."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if id(node) in chosen:
            out.append(node)
        else:
            todo += [x for x in reversed(node.items) if isinstance(x, Node) and not x.unwanted]
    return out


def main_text(page: str | None) -> str:
    """The article of a page: blocks joined by a line feed, white space in a block made one space, character references decoded; empty if there is none."""
    if not page:
        return ""
    root = tree(page.replace("\0", ""))
    found = score(root)
    marked = [n for n in found if n.tag in ("article", "main")]
    if not found:
        kept = [root]
    elif marked:
        best = max(marked, key=lambda n: n.points)
        # articles of one main element, or side by side, belong together
        if best.parent is not None and best.parent.tag in ("article", "main"):
            best = best.parent
        beside = {id(n) for n in (best.parent.items if best.parent is not None else ()) if isinstance(n, Node) and n.tag in ("article", "main")}
        holders = {id(n) for n in around_of(best)}
        near = {id(n) for n in marked if n.points >= NEAR * best.points and id(n) not in holders}
        kept = outermost(root, beside | near | {id(best)})
    else:
        best = max(found, key=lambda n: n.points)
        # whatever lies beside the best container, in page order, unless it is mostly links
        kept = [n for n in (best.parent.items if best.parent is not None else [best]) if isinstance(n, str) or not n.unwanted and (n is best or n.size and n.linked < 0.5 * n.size)]
    out = []
    for node in kept:
        for block in [node] if isinstance(node, str) else blocks_of(node):
            if text := SPACES.sub(" ", html.unescape(block)).strip():
                out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """pages without the html, with its main text and that text's length in code points. Null or empty html gives an empty text; all rows and other columns stay."""
    kept = [f for f in pages.schema.fields if f.name not in (html_col, text_col, chars_col)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, text_col, chars_col])

    return map_arrow(pages, run, T.StructType([*kept, *struct((text_col, "string"), (chars_col, "bigint")).fields]))
