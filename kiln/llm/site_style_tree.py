"""Main text of web pages by site style trees.

The pages of one host are merged into one tree. A node is a path of elements from the root,
named by tag and class; pages that show the same sequence of child elements there share a
*style*. The importance of a node is made of two parts, both entropies to the base m, the
number of the host's pages that have the node:

* presentation: the entropy of its styles over the pages. One layout on every page says 0.
* content: 1 less the mean entropy of its texts' pages. A text on every page says 0, a text
  on one page 1.

A node with l child elements weighs them as (1 - DECAY^l) * presentation + DECAY^l * content.
A node that one page has is fully important. To the importance comes, as a term, what the
elements say of themselves: navigation, forms, adverts, comments and the like stay below any
limit; inside an article the term is IN_ARTICLE, and FEW / m more, as a few pages with one text
may be copies; outside of one, on pages that have an article, it is -OUT_OF_ARTICLE; on pages
without an article it is 0. A block is removed from its page if the sum for its node is below
MIN_IMPORTANCE. A branch thus goes as a whole only if all of it is unimportant: a layout that
all pages share does not take the texts in it along.

The nodes that lose a block are sent to every task if they are MAX_BROADCAST or fewer, which a
count checks first; else they are joined to the pages. Statistics are counted before each
shuffle, over all pages.

Null and empty html give an empty text, a url without a host the host "". Each row is cut by
itself, so repeated rows and ties give equal texts; in the statistics every row is a page.
A null url is a page without a host. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import pick, ship

DECAY = 0.9
MIN_IMPORTANCE = 0.3
#: Terms of the article. One text on every page is removed from articles from six pages on.
IN_ARTICLE, FEW, OUT_OF_ARTICLE = 0.2, 0.5, 0.5
MAX_BROADCAST = 100_000

#: Elements that do not end a block.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike "
                   "strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is no markup, and elements that never hold the article's text.
RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
BOILERPLATE = frozenset("nav footer aside form button menu dialog fieldset head".split())
ARTICLE = frozenset("article main".split())
#: Words of class, id and role that tell a part of the page.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar sidebars widget "
    "widgets cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription popup modal "
    "overlay breadcrumb breadcrumbs menu menus nav navbar navigation footer comment comments reply replies respond "
    "disqus social share sharing related recommended login signup search pagination pager toolbar skip complementary "
    "contentinfo".split())
HEADER_WORDS = frozenset("header masthead topbar".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>?""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.I) for tag in RAW}

#: What an element says of itself.
KEEP, DROP, OPEN = 1, -1, 0
#: Places of a block that is not dropped, as bits: in an article, on a page without one, outside of one.
INSIDE, PLAIN, OUTSIDE = 1, 2, 4


class Node:
    """An open element: its name and path in the tree, whether it is kept, and its children's names."""
    __slots__ = ("tag", "path", "state", "children")

    def __init__(self, tag: str, path: str, state: int):
        self.tag, self.path, self.state, self.children = tag, path, state, []


def _element(tag: str, attributes: str, parent: Node) -> Node:
    words, name = set(), tag
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            words.update(_WORD.findall(value))
            if m[1].lower() == "class":
                name = f"{tag}.{' '.join(sorted(value.split()))}"
    state = parent.state
    if state != DROP:
        if tag in BOILERPLATE or words & BOILERPLATE_WORDS:
            state = DROP
        elif state == OPEN and (tag == "header" or words & HEADER_WORDS):
            state = DROP
        elif tag in ARTICLE or "main" in words and tag != "body":
            state = KEEP
    return Node(tag, f"{parent.path}>{name}", state)


def parse(page: str) -> tuple[list[tuple[str, int, str]], list[tuple[str, str]], bool]:
    """Blocks (path, state, text) in page order, styles (path, names of the child elements) of the
    elements, and whether the page has an article."""
    root = Node("", "", OPEN)
    stack, blocks, styles, text, has_article = [root], [], [], [], False

    def flush():
        if text:
            words = " ".join(entities.unescape("".join(text)).split())
            if words:
                node = stack[-1]
                blocks.append((node.path, node.state, words))
            text.clear()

    def close():
        node = stack.pop()
        styles.append((node.path, ",".join(node.children)))

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            continue
        flush()
        if m[1]:
            if any(x.tag == tag for x in stack):
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            continue
        # A paragraph ends at the next block, a list item, cell or row at the next of its kind.
        if stack[-1].tag == "p" or stack[-1].tag == tag and tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
            close()
        node = _element(tag, m[3], stack[-1])
        has_article |= tag in ARTICLE and node.state == KEEP
        stack[-1].children.append(node.path.rpartition(">")[2])
        stack.append(node)
    flush()
    while stack:
        close()
    return blocks, styles, has_article


def place(state: int, has_article: bool) -> int:
    """Where a block stands; 0 if it names itself boilerplate."""
    return 0 if state == DROP else INSIDE if state == KEEP else OUTSIDE if has_article else PLAIN


def main_text(page: str, unimportant: dict[int, int] = {}) -> str:
    """The blocks of the page that are kept, one a line. ``unimportant``: the places from which a
    node's blocks are removed, by the hash of its path."""
    blocks, _, has_article = parse(page)
    return "\n".join(t for path, state, t in blocks
                     if (at := place(state, has_article)) and not unimportant.get(path_hash(path), 0) & at)


def path_hash(path: str) -> int:
    return xxhash.xxh64_intdigest(path.encode("utf-8", "surrogatepass")) - (1 << 63)


def host_of(url):
    """The url's host, lower-cased, without a port."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def style_tree(pages: DataFrame, host_col: str = "host", html_col: str = "html") -> DataFrame:
    """(host, path, pages, presentation, content, importance, places, cut) of every node of every
    host's tree. ``path`` is a hash; ``places``: where its blocks stand; ``cut``: those of the
    places where the sum of importance and term is too low."""
    ship(pages.sparkSession)
    rows = pick(pages, host=host_col, html=html_col)

    def run(batches):
        for batch in batches:
            out = {"host": [], "path": [], "kind": [], "feature": [], "children": [], "places": []}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blocks, styles, has_article = parse(page or "")
                seen = {(0, path, names) for path, names in styles}
                seen |= {(1, path, text) for path, _, text in blocks}
                places: dict[str, int] = {}
                for path, state, _ in blocks:
                    places[path] = places.get(path, 0) | place(state, has_article)
                for kind, path, value in seen:
                    out["host"].append(host)
                    out["path"].append(path_hash(path))
                    out["kind"].append(kind)
                    out["feature"].append(path_hash(value))
                    out["children"].append(value.count(",") + bool(value) if kind == 0 else 0)
                    out["places"].append(places.get(path, 0))
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    arrow = pa.schema([("host", pa.string()), ("path", pa.int64()), ("kind", pa.int8()), ("feature", pa.int64()),
                       ("children", pa.int32()), ("places", pa.int32())])
    seen = rows.mapInArrow(run, "host string, path long, kind byte, feature long, children int, places int")
    # One row a style or text, then one a node: both are combined before the shuffle.
    counted = (seen.groupBy("host", "path", "kind", "feature")
               .agg(F.count(F.lit(1)).alias("k"), F.max("children").alias("children"), F.bit_or("places").alias("places")))
    k, style, content = F.col("k"), F.col("kind") == 0, F.col("kind") == 1
    node = counted.groupBy("host", "path").agg(
        # Every page that has the node shows one style of it (more, if it has the node more often).
        F.sum(F.when(style, k)).alias("pages"), F.sum(F.when(style, k * F.log(k))).alias("style_logs"),
        F.sum(F.when(content, k)).alias("texts"), F.sum(F.when(content, k * F.log(k))).alias("text_logs"),
        F.max("children").alias("children"), F.bit_or("places").alias("places"))
    m = F.col("pages")
    several = m > 1
    presentation = F.when(several, 1 - F.col("style_logs") / (m * F.log(m))).otherwise(1.0)
    told = F.least(F.col("text_logs") / (F.col("texts") * F.log(m)), F.lit(1.0))
    own = F.when(several & (F.col("texts") > 0), 1 - told).otherwise(1.0)
    weight = F.pow(F.lit(DECAY), F.col("children"))
    importance = F.when(several, (1 - weight) * F.col("presentation") + weight * F.col("content")).otherwise(1.0)
    terms = {INSIDE: F.lit(IN_ARTICLE) + F.lit(FEW) / m, PLAIN: F.lit(0.0), OUTSIDE: F.lit(-OUT_OF_ARTICLE)}
    low = sum((F.when(F.col("importance") + term < MIN_IMPORTANCE, bit).otherwise(0) for bit, term in terms.items()), F.lit(0))
    return (node.withColumn("presentation", presentation).withColumn("content", own)
            .select("host", "path", "pages", "presentation", "content", importance.alias("importance"), "places")
            .withColumn("cut", F.col("places").bitwiseAND(low)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row."""
    ship(pages.sparkSession)
    rows = (pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", host_of(F.col("url")))
            .select("page_id", "url", "host", "html"))
    low = style_tree(rows).where("cut != 0").groupBy("host").agg(  # a host's layouts, not its pages
        F.map_from_entries(F.collect_list(F.struct("path", "cut"))).alias("low"))
    low = low.cache()
    size = low.agg(F.sum(F.size("low"))).first()[0] or 0
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2]) + ", text string"

    def cut(batch, drops):
        texts = [main_text(h or "", d) for h, d in zip(batch.column(3).to_pylist(), drops)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                          names=["page_id", "url", "text"])

    if size <= MAX_BROADCAST:
        table = pages.sparkSession.sparkContext.broadcast({r.host: r.low for r in low.collect()})

        def run(batches):
            for batch in batches:
                yield cut(batch, [table.value.get(h, {}) for h in batch.column(2).to_pylist()])

        return rows.mapInArrow(run, out)

    def run_joined(batches):
        for batch in batches:
            yield cut(batch, [dict(d or ()) for d in batch.column(4).to_pylist()])

    return rows.join(low, "host", "left").select("page_id", "url", "host", "html", "low").mapInArrow(run_joined, out)
