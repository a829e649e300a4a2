"""Operator 9: main text of web pages by composite text density.

Each page becomes a light tree.  Parts that are never article text (scripts, controls, hidden parts) are
cut off.  Tags, roles and whole class names of menus, forms, adverts, notices, comments and so on only vote
against a node: what holds the article, the core or a large share of the text stays, and so does text with
a weak name (notice, related ...) inside an article.  For every remaining node the
link-adjusted characters per tag are computed, the densities of its children are summed, and the node
with the largest sum is the core.  The lowest density on the path from the core to the body is the
threshold.  Outside the core a block below the threshold goes, unless it holds a paragraph, a heading or stands
between two texts; a block whose text is mostly links goes there and in the core, where an article keeps all, the core
those after its first text, and any node those that stand between two texts.  Where articles (or else main elements)
hold a good part of the text or the core, only they and the headings before them are the main text.

Edge cases: NULL or empty html gives empty text; unclosed and crossing tags follow HTML's implied ends;
a page cut inside a tag ends there; very deep nesting is walked without recursion; repeated rows are
separate pages; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# ---- fixed values: HTML element groups ------------------------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
             "span strike strong sub sup time tt u var wbr nobr rp rt ruby".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
               "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
            "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})}
DROP_TAGS = set("script style noscript template iframe object embed svg canvas button select textarea input head "
                "title".split())
VOTE_TAGS = set("nav aside footer form menu dialog".split())
DROP_ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
STRONG = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr "
             "sidebar comment comments review reviews ratings disqus reply replies menu nav navbar navigation masthead breadcrumb breadcrumbs "
             "share sharing newsletter subscribe signup popup modal overlay pagination pager toolbar".split())
WEAK = set("promo promotion banner notice alert footer header social related recommended widget skip".split())
# words that may stand beside them in a whole name of a role, in any and in names with a strong word
BESIDE = set("site main page top bottom left right container wrapper wrap box list area section block inner outer bar "
             "link links button buttons icon icons form item items slot unit primary secondary global mobile desktop "
             "fixed sticky media module panel group posts articles stories user users customer reader readers".split())
OF_TEXT = set("post entry article content story".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
PARAGRAPH = 100                # characters outside links that make a p a paragraph of text
KEEP_TAGS = {"html", "body", "article", "main"}


class Node:
    __slots__ = ("tag", "kids", "parent", "cut", "vote", "inside", "chars", "tags", "links", "link_chars", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", cut: bool = False, vote: str = ""):
        self.tag, self.parent, self.cut, self.vote, self.inside = tag, parent, cut, vote, frozenset()
        self.kids: list = []
        self.chars = self.tags = self.links = self.link_chars = 0
        self.density = self.total = 0.0


def _role_name(name: str) -> str:
    """"strong" or "weak" when the whole name is one of a role, such as site-header, but not has-sidebar."""
    words = {w.lower() for w in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])", name) if w and not w[0].isdigit()}
    if words & STRONG and words <= STRONG | WEAK | BESIDE | OF_TEXT:
        return "strong"
    return "weak" if words & WEAK and words <= WEAK | BESIDE else ""


def _judge(tag: str, attrs: str) -> tuple[bool, str]:
    """(never text, vote against it): the votes are "strong", "weak", "header" or none."""
    if tag in DROP_TAGS:
        return True, ""
    vote = "strong" if tag in VOTE_TAGS else "header" if tag == "header" else ""
    if not attrs.strip() or tag in KEEP_TAGS:
        return False, vote
    for m in _ATTR.finditer(attrs):
        name, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "")
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and re.search(r"display\s*:\s*none", value)):
            return True, ""
        found = ""
        if name in ("class", "id"):
            roles = {_role_name(v) for v in value.split()}
            found = "strong" if "strong" in roles else "weak" if "weak" in roles else ""
        elif name == "role" and value.lower() in DROP_ROLES:
            found = "strong"
        if found == "strong" or not vote:
            vote = found or vote
    return False, vote


def parse(page: str) -> Node:
    """The page as a tree; text is kept as strings among a node's children."""
    root = Node("#root", None)
    cur, body, pos = root, None, 0
    n = len(page)
    opened: dict[str, int] = {}                             # open elements by tag

    def leave(low: Node, high: Node) -> None:
        while low is not high:
            opened[low.tag] -= 1
            low = low.parent

    while pos < n:
        m = _TOKEN.search(page, pos)
        if m is None:
            cur.kids.append(page[pos:])
            break
        if m.start() > pos:
            cur.kids.append(page[pos:m.start()])
        pos = m.end()
        close, tag = m.group(1), m.group(2)
        if tag is None or not m.group(4):                   # comment, doctype, or a tag cut off by the end
            continue
        tag = tag.lower()
        if close:
            node = cur if opened.get(tag) else None       # a stray end tag costs one look-up
            while node is not None and node.tag != tag and not (tag in INLINE and node.tag not in INLINE):
                node = node.parent
            if node is not None and node.tag == tag and node.parent is not None:
                leave(cur, node.parent)
                cur = node.parent
            continue
        if tag == "body" and body is not None:
            continue
        if tag in CLOSES_P or tag in SIBLINGS:              # implied end tags
            ends, stop = ({"p"}, {"table", "td", "th", "div", "article", "section", "body", "li", "blockquote"})
            if tag in SIBLINGS:
                ends, stop = SIBLINGS[tag]
            node, found = cur, None
            while node is not None and node.tag not in stop:
                if node.tag in ends:
                    found = node
                    if tag not in ("tr", "tbody"):
                        break
                node = node.parent
            if found is not None:
                leave(cur, found.parent)
                cur = found.parent
        node = Node(tag, cur, *_judge(tag, m.group(3)))
        cur.kids.append(node)
        if tag == "body":
            body = node
        if tag in RAW:                                      # up to its own end tag
            e = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            pos = e.end() if e else n
        elif tag not in VOID and not m.group(3).endswith("/"):
            cur = node
            opened[tag] = opened.get(tag, 0) + 1
    return body or root


def _walk(top: Node):
    """Nodes that are kept, parents first."""
    stack = [top]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(k for k in reversed(node.kids) if isinstance(k, Node) and not k.cut)


def measure(body: Node) -> list[Node]:
    """Composite text density of every kept node and the sums over children."""
    nodes = list(_walk(body))
    for x in reversed(nodes):
        x.chars = sum(len(" ".join(k.split())) for k in x.kids if isinstance(k, str))
        x.tags, x.links, x.link_chars, x.density = 1, 0, 0, 0.0
        for k in x.kids:
            if isinstance(k, Node) and not k.cut:
                x.chars += k.chars
                x.tags += k.tags
                x.links += k.links
                x.link_chars += k.link_chars
        if x.tag == "a":
            x.links, x.link_chars = x.links + 1, x.chars
    share = body.link_chars / max(body.chars, 1)
    for x in nodes:
        if x.chars:
            base = math.log(x.chars / max(x.chars - x.link_chars, 1) * x.link_chars + share * x.chars + math.e)
            ratio = x.chars / max(x.link_chars, 1) * x.tags / max(x.links, 1)
            x.density = x.chars / x.tags * math.log(max(ratio, 1.0)) / max(math.log(base), 1e-9) if base > 1 + 1e-9 \
                else x.chars / x.tags * math.log(max(ratio, 1.0) + math.e)
    for x in nodes:
        x.total = sum(k.density for k in x.kids if isinstance(k, Node) and not k.cut)
    return nodes


def _path(x: Node, top: Node) -> list[Node]:
    out = [x]
    while x is not top:
        x = x.parent
        out.append(x)
    return out


def _linked(x: Node) -> bool:
    return x.link_chars * 2 > x.chars


def settle(body: Node) -> list[Node]:
    """Cut the nodes whose vote stands; the nodes that are kept, measured.

    A vote never cuts what holds the page's article or main, nor, where these hold little, the core or a large
    share of the text outside links.  A weak word does not cut text inside an article or the core.
    """
    nodes = measure(body)
    voted = [x for x in nodes if x.vote]
    if not voted:
        return nodes
    plain = {id(x): x.chars - x.link_chars for x in nodes}
    bodies = [x for x in nodes if x.tag in ("article", "main")]
    most = max([plain[id(x)] for x in bodies], default=0)
    holds, with_article = set(), set()
    for x in bodies:
        up = x
        while x.tag == "article" and up is not body and id(up.parent) not in with_article:
            up = up.parent
            with_article.add(id(up))
        if most and plain[id(x)] * 2 >= most:
            while id(x) not in holds:
                holds.add(id(x))
                if x is body:
                    break
                x = x.parent
    for x in nodes:                                         # parents first
        if x is not body:
            p = x.parent
            x.inside = p.inside | ({p.tag} if p.tag in ("article", "main") else set()) | (
                {"text"} if p.tag == "article" or (p.tag == "main" and id(p) not in with_article) else set()) | (
                {"code"} if p.tag in ("pre", "code") else set()) if p.tag in ("article", "main", "pre", "code") else p.inside
    core = set(map(id, _path(max(nodes, key=lambda x: x.total), body)))
    spared = []
    for x in voted:
        if "code" in x.inside or id(x) in holds or (x.vote == "header" and x.inside & {"article", "main"}):
            continue
        if x.tag in VOTE_TAGS | {"header"} and x.tag != "form":    # says what it is: spared if nothing else has the text
            if not most and plain[id(x)] * 2 > plain[id(body)]:
                continue
        elif most * 4 < plain[id(x)] and (id(x) in core or plain[id(x)] * 5 >= plain[id(body)] * 2):
            continue
        if x.vote == "weak" and not _linked(x):
            if "text" in x.inside:
                continue
            spared.append(x)
        x.cut = x is not body
    nodes = measure(body)
    core, back = max(nodes, key=lambda x: x.total), False
    for x in spared:
        up = x.parent
        while up is not core and up is not body and not up.cut:
            up = up.parent
        if up is core and (core is not body or x.tag == "p"):
            x.cut, back = False, True
    return measure(body) if back else nodes


def _blocks(x: Node) -> list[tuple]:
    """The kept children of a node as (block or None, kids, chars, link_chars); text, inline tags and br run together."""
    out, run, chars, links = [], [], 0, 0
    for k in [*x.kids, None]:
        if isinstance(k, Node) and k.cut:
            continue
        if isinstance(k, str) or (k is not None and (k.tag in INLINE or k.tag in VOID)):
            run.append(k)
            chars += len(" ".join(k.split())) if isinstance(k, str) else k.chars
            links += 0 if isinstance(k, str) else k.link_chars
            continue
        if run:
            out.append((None, run, chars, links))
            run, chars, links = [], 0, 0
        if k is not None:
            out.append((k, [k], k.chars, k.link_chars))
    return out


def _heading(k: Node | None) -> bool:
    """A heading, or a box around nothing else."""
    while k is not None and k.tag not in HEADINGS:
        full = [b for b in _blocks(k) if b[2]]
        k = full[0][0] if len(full) == 1 else None
    return k is not None


def _articles(nodes: list[Node], body: Node, core: Node) -> list[Node]:
    """The outermost article elements, or else main elements, if they hold a quarter of the text or the core."""
    on_core = set(map(id, _path(core, body)))
    for tag in ("article", "main"):
        found, inner = [], set()
        for x in nodes:                                     # parents first
            if id(x.parent) in inner or x.tag == tag:
                inner.add(id(x))
                if id(x.parent) not in inner:
                    found.append(x)
        held = sum(x.chars - x.link_chars for x in found)
        if held and (held * 4 >= body.chars - body.link_chars or any(id(x) in on_core for x in found)):
            return found
    return []


def main_text(page: str | None) -> str:
    if not page:
        return ""
    body = parse(page)
    nodes = settle(body)
    core = max(nodes, key=lambda x: x.total)
    articles = _articles(nodes, body, core)
    around = {id(y) for x in articles for y in _path(x, body)[1:]}           # what an article stands in
    within = set(map(id, articles))
    headed = set()                                          # nodes with a heading inside
    for x in reversed(nodes):
        if x.tag in HEADINGS or id(x) in headed:
            headed |= {id(x), id(x.parent)}
    path = _path(core, body)
    limit, above = min(x.density for x in path), set(map(id, path[1:]))
    texts = set(map(id, path))                              # blocks that hold the core or a paragraph of text
    for x in reversed(nodes):
        if id(x) in texts or (x.tag == "p" and x.chars - x.link_chars >= PARAGRAPH and not _linked(x)):
            texts |= {id(x), id(x.parent)}
    # text in page order, blocks apart: (text or node, kept whole, part of the core, inside a heading, inside a link)
    out, seen, stack = [], 0, [(body, False, False, False, False)]
    while stack:
        x, whole, own, head, link = stack.pop()
        if isinstance(x, str):
            out.append(entities.unescape(x))
            if own and not link and x.strip():
                seen = max(seen, 1 if head else 2)
            continue
        if isinstance(whole, tuple):                        # a link list in the core: only after some of its text
            if seen < whole[1] and id(x) not in texts:
                continue
            whole = seen >= whole[1]
        if x.tag not in INLINE:
            out.append(" ")
            stack.append((" ", True, False, False, False))
        whole, own = whole or x.tag == "article", own or x is core or x.tag == "main"
        head, link = head or x.tag in HEADINGS, link or x.tag == "a"
        blocks = [] if whole else _blocks(x)
        plain = [i for i, (k, _, n, m) in enumerate(blocks)
                 if k is not None and id(k) in texts or n and m * 2 <= n and not _heading(k)]
        kept = [(k, True) for k in x.kids if isinstance(k, str) or not k.cut] if whole else []
        deep = [i for i, (k, *_) in enumerate(blocks) if k is not None and id(k) in texts]
        arts = [i for i, (k, *_) in enumerate(blocks) if k is not None and (id(k) in within or id(k) in around)]
        for i, (k, kids, n, m) in enumerate(blocks):
            free = False
            if id(x) in around:
                if i not in arts and not (_heading(k) and i < arts[0]):
                    continue
            elif (id(x) in above and not own and k is not None and k is not core and k.density < limit
                  and id(k) not in above and id(k) not in texts and id(k) not in headed and not (deep and deep[0] < i < deep[-1])):
                continue
            judged = id(x) in above and not own if k is None else k.density < limit and id(k) not in above and k is not core
            if judged and m * 2 > n and not _heading(k):
                if own and (core is not body or k is None or k.tag not in ("div", "section")):
                    free = ("after", 2 if core is body else 1)
                else:
                    free = bool(plain) and plain[0] < i < plain[-1]
                if not free and k is not None and id(k) in texts:
                    free = None                             # its own blocks are judged
                if free is False:
                    continue
            kept += [(c, free) for c in kids]
        for c, free in reversed(kept):
            stack.append((c, free, own, head, link))
    return " ".join("".join(out).split())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.col("html").cast("string").alias("html"))
    return p.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_html(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
