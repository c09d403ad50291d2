"""Main text of web pages by wrapper induction over pages of the same host.

The pages of a host are dealt into blocks of bounded size. In each block, the element trees of all pages are aligned
with that of the page that has most elements, by simple tree matching: two trees match where their roots do, and the
children of matched roots are aligned in order so that as many elements as possible match. An element whose own text
is the same on most pages that have it is template; what varies is a slot. Of the slots, those inside navigation,
headers, footers, forms, adverts, comments and the like, by element, role or class (a class
or id doesn't count where the element holds much of what varies on the page), are no content; the others are,
within the ``article`` or ``main`` of the page if it has one, else within the smallest element that holds all of their
text outside links and is no paragraph, heading or the like. Pages that share their main text (the longest that is not on most pages) count as one when texts
are compared, so that a group of copies doesn't turn its article into template.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in
page order by one space.

Inputs: NULL and empty pages give the empty text. A NULL or malformed URL belongs to the empty host. Hosts with few
pages have no template and rely on the other rules. Copies, repeated rows and ties give equal texts within a block.
Long pages are read whole. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import cut_lineage, read_table, text_or_empty

# Pages of one host that are aligned with each other; a host with more is dealt into several blocks.
BLOCK_PAGES = 256
# Pages with different main texts that must agree on a text before it is template, and their least share.
LEAST_PAGES, LEAST_SHARE = 4, 0.6

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noframes iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span"
    " strike strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
# An element that ends another one of its kind that is still open, up to the element that may hold both.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Blocks of text, which are taken with what stands beside them.
LEAVES = frozenset("p pre li dt dd td th h1 h2 h3 h4 h5 h6 blockquote figcaption caption address summary".split())
# Elements whose text may be a mere label, of so many words at most.
BARE, LABEL_WORDS = frozenset("div section center".split()), 3
NO_CONTENT = frozenset("nav footer aside form button select menu dialog noscript template svg canvas object head".split())
NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
NO_CONTENT_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav navbar"
    " navigation breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice alert popup modal"
    " overlay newsletter subscribe subscription signup login share sharing social related recommended comments comment"
    " respond reply replies disqus discussion widget toolbar pagination pager search copyright disclaimer skip"
    " notices announcement announcements notification feedback teaser teasers".split()
)
HEADER_CLASSES = frozenset("header topbar top".split())
# What a part of a page holds that is not boilerplate, and shares of the page's letters from which it is none.
LANDMARKS = frozenset("article main h1".split())
SMALL_SHARE, LARGE_SHARE = 0.3, 0.9


# Elements nested deeper than this are folded into their parent, text and all, which bounds every walk of the tree.
MAX_DEPTH = 200


class Node:
    __slots__ = ("tag", "kids", "parts", "skip", "listed", "linked", "sign", "size", "template", "depth")

    def __init__(self, tag: str, skip: bool, listed: int = 0, depth: int = 0) -> None:
        self.depth = depth
        # Listed: its class or id is one of boilerplate, whether it is skipped depends on the page.
        self.tag, self.skip, self.listed = tag, skip, listed
        # Child elements, and in page order texts (str) and places of child elements (int).
        self.kids: list[Node] = []
        self.parts: list = []
        self.linked = 0
        self.sign = self.size = 0
        self.template = False


def _is_boilerplate(tag: str, attributes: str, inside_article: bool) -> tuple[bool, int]:
    """Whether an element is no content by its kind, and whether it may be none by its class or id: 1 by a part of a
    word, 2 by a whole one."""
    if tag in NO_CONTENT or tag == "header" and not inside_article:
        return True, 0
    listed = 0
    for name, a, b, c in ATTRIBUTE.findall(attributes or ""):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, 0
        if name == "role" and value in NO_CONTENT_ROLES:
            return True, 0
        if name in ("class", "id"):
            for level, words in ((1, WORD.findall(value)), (2, value.split())):
                if NO_CONTENT_CLASSES.intersection(words) or not inside_article and HEADER_CLASSES.intersection(words):
                    listed = max(listed, level) if tag not in ("body", "html", "main", "article") else 0
    return False, listed


def settle(root: Node) -> None:
    """Skip the listed elements that hold a small part of the page's letters outside templates; those listed by a whole
    word also with more, unless they hold the article or the title or nearly all letters. A part of a word decides for
    no element with the article or the title."""
    held: dict[int, tuple[int, bool]] = {}

    def weigh(node: Node) -> tuple[int, bool]:
        letters = 0 if node.template else len(own_text(node))
        landmark = node.tag in LANDMARKS
        for kid in node.kids:
            if not kid.skip or kid.listed:
                n, has = weigh(kid)
                letters, landmark = letters + n, landmark or has
        held[id(node)] = letters, landmark
        return letters, landmark

    def decide(node: Node) -> None:
        for kid in node.kids:
            if kid.listed:
                letters, landmark = held[id(kid)]
                if kid.listed == 1:
                    kid.skip = not landmark and letters <= SMALL_SHARE * total
                else:
                    kid.skip = letters <= (SMALL_SHARE if landmark else LARGE_SHARE) * total
            if not kid.skip:
                decide(kid)

    total, _ = weigh(root)
    decide(root)


def parse(page: str) -> Node:
    """The element tree. Plain inline elements belong to the element around them, and so do elements nested deeper
    than ``MAX_DEPTH``. Tags are looked for up to the last ``>`` of the page only: a ``<`` that no ``>`` follows is
    text, and the search stays linear in the page."""
    root = Node("#page", False)
    stack, names = [root], ["#page"]  # inline elements stand on the stack as their block
    opened = Counter(names)
    articles = links = at = 0
    search, last = TOKEN.search, page.rfind(">") + 1

    def pop(k: int) -> None:
        nonlocal articles, links
        for name in names[k:]:
            articles -= name in ("article", "main")
            links -= name == "a"
            opened[name] -= 1
        del stack[k:], names[k:]

    def text(value: str) -> None:
        node = stack[-1]
        node.parts.append(html.unescape(value) if "&" in value else value)
        if links:
            node.linked += len(value)

    while match := search(page, at, last):
        if match.start() > at:
            text(page[at : match.start()])
        at = match.end()
        tag = match[2]
        if tag is None:
            if match[0].startswith("<!--") and not match[0].endswith("-->"):
                # A comment that is never closed holds the rest of the page.
                at = len(page)
                break
            continue
        tag = tag.lower()
        if match[1]:
            if opened[tag] > 0:
                k = len(names) - 1
                while names[k] != tag:
                    # The end of an inline element doesn't end the block that it is in.
                    if tag in INLINE and names[k] not in INLINE:
                        k = 0
                        break
                    k -= 1
                if k:
                    pop(k)
            elif tag == "br" or tag == "p":
                stack[-1].parts.append(" ")
            continue
        if tag in VOID:
            stack[-1].parts.append(" ")
            continue
        attributes = match[3]
        if tag in RAW:
            end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in CLOSES_P and opened["p"] > 0:
            k = len(names) - 1
            while k and names[k] != "p" and (names[k] in INLINE):
                k -= 1
            if names[k] == "p":
                pop(k)
        elif tag in SIBLINGS:
            same, around = SIBLINGS[tag]
            k = len(names) - 1
            while k and names[k] not in same and names[k] not in around:
                k -= 1
            if names[k] in same:
                pop(k)
        skip, listed = _is_boilerplate(tag, attributes, articles > 0)
        if tag in INLINE and not (skip or listed) or stack[-1].depth >= MAX_DEPTH:
            stack.append(stack[-1])
            links += tag == "a"
        else:
            parent = stack[-1]
            node = Node(tag, skip, listed, parent.depth + 1)
            parent.parts.append(len(parent.kids))
            parent.kids.append(node)
            stack.append(node)
            articles += tag in ("article", "main")
            links += tag == "a"
        names.append(tag)
        opened[tag] += 1
    if at < len(page):
        text(page[at:])
    settle(root)
    return root


def own_text(node: Node) -> str:
    """The text of an element without that of its children."""
    return " ".join("".join(p if isinstance(p, str) else " " for p in node.parts).split())


def measure(node: Node) -> None:
    """Size of each tree, and a sign that equal trees of tags have in common."""
    size, signs = 1, []
    for kid in node.kids:
        measure(kid)
        size += kid.size
        signs.append(kid.sign)
    node.size, node.sign = size, hash((node.tag, tuple(signs)))


def match_size(a: Node, b: Node, known: dict) -> int:
    """Most elements that two trees can match in order (simple tree matching)."""
    if a.tag != b.tag:
        return 0
    if a.sign == b.sign:
        return a.size
    if not a.kids or not b.kids:
        return 1
    key = (a.sign, b.sign)
    if key not in known:
        head, left, right, tail = _common_ends(a.kids, b.kids)
        inner = _table(left, right, known)[-1][-1] if left and right else 0
        known[key] = 1 + sum(k.size for k in a.kids[:head]) + inner + sum(k.size for k in tail)
    return known[key]


def _common_ends(left: list[Node], right: list[Node]):
    """How many children at the start have equal trees, the children between, and those of ``left`` at the end."""
    most = min(len(left), len(right))
    head = 0
    while head < most and left[head].sign == right[head].sign:
        head += 1
    tail = 0
    while tail < most - head and left[-1 - tail].sign == right[-1 - tail].sign:
        tail += 1
    return head, left[head : len(left) - tail], right[head : len(right) - tail], left[len(left) - tail :]


def _table(left: list[Node], right: list[Node], known: dict) -> list[list[int]]:
    rows = [[0] * (len(right) + 1)]
    for a in left:
        before, row = rows[-1], [0]
        for j, b in enumerate(right):
            row.append(max(row[j], before[j + 1], before[j] + match_size(a, b, known)))
        rows.append(row)
    return rows


def align(a: Node, b: Node, known: dict, pairs: list) -> None:
    """Append (element of a, element of b) of a largest match of two trees with equal root tags."""
    pairs.append((a, b))
    head, left, right, tail = _common_ends(a.kids, b.kids)
    for x, y in zip(a.kids[:head], b.kids[:head]):
        align(x, y, known, pairs)
    if left and right:
        table = _table(left, right, known)
        i, j, found = len(left), len(right), []
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((left[i], right[j]))
        for x, y in reversed(found):
            align(x, y, known, pairs)
    for x, y in zip(tail, b.kids[len(b.kids) - len(tail) :] if tail else []):
        align(x, y, known, pairs)


def _own_texts(node: Node, out: list[str]) -> None:
    if not node.skip:
        if value := own_text(node):
            out.append(value)
        for kid in node.kids:
            _own_texts(kid, out)


def _main_texts(trees: list[Node]) -> list[str]:
    """For each page its longest text among those that at most half of the pages have, or of all if there is none."""
    found: list[list[str]] = []
    for tree in trees:
        found.append([])
        _own_texts(tree, found[-1])
    seen = Counter(t for texts in found for t in set(texts))
    rare = [[t for t in texts if 2 * seen[t] <= len(trees)] for texts in found]
    return [max(r or texts, key=len, default="") for r, texts in zip(rare, found)]


def _labels(node: Node, out: list[tuple[Node, str]]) -> None:
    value = own_text(node)
    if node.tag in BARE and not node.kids and value and len(value.split()) <= LABEL_WORDS and value[-1] not in ".!?:;…":
        out.append((node, value))
    for kid in node.kids:
        _labels(kid, out)


def _mark_labels(trees: list[Node]) -> None:
    """Mark labels that all pages share, where the pages are copies and show no other template."""
    found: list[list[tuple[Node, str]]] = [[] for _ in trees]
    for tree, labels in zip(trees, found):
        _labels(tree, labels)
    shared = set.intersection(*({v for _, v in labels} for labels in found))
    for labels in found:
        for node, value in labels:
            node.template = value in shared


def mark_template(trees: list[Node]) -> None:
    """Mark the elements of aligned trees whose own text most of them share."""
    if len(trees) < LEAST_PAGES:
        return
    for tree in trees:
        measure(tree)
    reference = max(trees, key=lambda t: t.size)
    known: dict = {}
    aligned = []
    texts: dict[int, dict[str, set[str]]] = defaultdict(lambda: defaultdict(set))
    mains = _main_texts(trees)
    if len(set(mains)) < LEAST_PAGES:
        _mark_labels(trees)
        return
    for tree, main in zip(trees, mains):
        pairs: list = []
        align(reference, tree, known, pairs)
        held = [(id(r), node, own_text(node)) for r, node in pairs if node.parts]
        aligned.append(held)
        for slot, _, value in held:
            if value:
                texts[slot][value].add(main)
    constant = set()
    for slot, values in texts.items():
        pages = len(set().union(*values.values()))
        constant.update((slot, v) for v, seen in values.items() if len(seen) >= max(LEAST_PAGES, LEAST_SHARE * pages))
    for held in aligned:
        for slot, node, value in held:
            if (slot, value) in constant:
                node.template = True


def _content(node: Node, out: list[str]) -> None:
    """Texts of an element and its children in page order, template and other parts left out."""
    for part in node.parts:
        if isinstance(part, str):
            if not node.template:
                out.append(part)
        else:
            kid = node.kids[part]
            if not kid.skip:
                out.append(" ")
                _content(kid, out)
                out.append(" ")


def _find(node: Node, tags: tuple[str, ...], out: list[Node]) -> None:
    for kid in node.kids:
        if not kid.skip:
            if kid.tag in tags:
                out.append(kid)
            else:
                _find(kid, tags, out)


def _weight(node: Node, weights: dict[int, int]) -> int:
    """Letters outside links that a tree holds, for every tree in it."""
    total = 0 if node.template or node.skip else max(0, len(own_text(node)) - node.linked)
    if not node.skip:
        total += sum(_weight(kid, weights) for kid in node.kids)
    weights[id(node)] = total
    return total


def main_text(root: Node) -> str:
    regions: list[Node] = []
    _find(root, ("article",), regions)
    if not regions:
        _find(root, ("main",), regions)
    if not regions:
        weights: dict[int, int] = {}
        _weight(root, weights)
        node = root
        while True:
            heaviest = max(node.kids, key=lambda k: weights.get(id(k), 0), default=None)
            if heaviest is None or heaviest.tag in LEAVES or weights.get(id(heaviest), 0) < weights[id(node)] or not weights[id(node)]:
                break
            node = heaviest
        regions = [node]
    out: list[str] = []
    for region in regions:
        out.append(" ")
        _content(region, out)
    return " ".join("".join(out).split())


def extract_block(pages: list[str]) -> list[str]:
    """Main texts of pages of one host."""
    trees = [parse(p) for p in pages]
    mark_template(trees)
    for tree in trees:
        settle(tree)
    return [main_text(t) for t in trees]


def host_of(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", block_pages: int = BLOCK_PAGES
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    keyed = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(url).alias("host"), text_or_empty(page).alias("html"))
    # Written, so that its true size is known: Spark broadcasts the large hosts only where they are few.
    sizes = keyed.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") > block_pages)
    large = cut_lineage(sizes.select(F.col("host").alias("large"), F.ceil(F.col("pages") / block_pages).alias("blocks")), "large-hosts")
    dealt = keyed.join(large, F.col("host") == F.col("large"), "left").withColumn(
        "block", F.coalesce(F.pmod(F.xxhash64("page_id", "url"), F.col("blocks")), F.lit(0))
    )
    dealt = dealt.select("host", "block", "page_id", "url", "html").repartition("host", "block")
    dealt = dealt.sortWithinPartitions("host", "block", "page_id")
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"

    def run(batches):
        current, held, texts = None, [], []

        def flush():
            found = extract_block(texts)
            ids = pa.concat_arrays([h.column("page_id") for h in held])
            urls = pa.concat_arrays([h.column("url") for h in held])
            lengths = pa.array([len(f) for f in found], pa.int64())
            return pa.RecordBatch.from_arrays([ids, urls, pa.array(found, pa.string()), lengths], names=["page_id", "url", "text", "n_chars"])

        for batch in batches:
            keys = list(zip(batch.column("host").to_pylist(), batch.column("block").to_pylist()))
            low = 0
            while low < len(keys):
                high = low
                while high < len(keys) and keys[high] == keys[low]:
                    high += 1
                if keys[low] != current:
                    if texts:
                        yield flush()
                    current, held, texts = keys[low], [], []
                part = batch.slice(low, high - low)
                held.append(part.select(["page_id", "url"]))
                texts.extend(part.column("html").to_pylist())
                low = high
        if texts:
            yield flush()

    return dealt.mapInArrow(run, schema)


def op2_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))
