"""Main text of web pages by wrapper induction: pages of a host are aligned, what stays the same is template."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Container, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm.common import column_of, slices, table, work_folder, written

# Names of the elements of HTML by what they do to a text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style noscript template svg math iframe object select button textarea title head canvas audio video".split()
)
RAW = frozenset("script style textarea title iframe noscript".split())
#: What an opening tag ends before it: an open element of these names, no further up than its container.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
    "option": ("option",),
}
#: Elements beyond which a closing tag or an implied end doesn't reach.
CONTAINERS = frozenset("html body article main section div table ul ol dl nav aside footer header form blockquote td th".split())

#: Elements, roles and words in class or id of what is no article.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notices notification alert sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar toolbar"
    " comment comments disqus respond replies share sharing social related recommended newsletter subscribe signup login popup"
    " modal overlay widget pagination pager skip".split()
)
MAIN_TAGS, MAIN_WORDS = frozenset(("article", "main")), frozenset(("articlebody", "article-body", "post-content", "entry-content"))

#: Elements nested deeper than this count to the node at that depth.
DEPTH = 150

#: A text is template when at least this share, in percent, of the SEEN or more distinct pages with its node have it there.
CONSTANT, SEEN = 60, 4
#: A node with more of its characters in links, in percent, is no content of a page without an article.
LINKS = 50

#: Shapes of a host, or templates of such, that one task aligns.
CHUNK = 64

_TAG = re.compile(
    r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))
        |(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*+)
         (?P<attributes>(?:[\s/]++|[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s"'>][^\s>]*+))?|["'=])*+)(?:>|\Z)
        |[!?/][^>]*+(?:>|\Z))""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s"'>][^\s>]*+)))?""")
_WORDS = re.compile(r"[a-z]+")
#: Words by which a class says what an element has or lacks, not what it is.
_OTHERS = frozenset("no not non has have with without".split())
#: Headers of a page; those inside an article hold its heading.
_HEADER = re.compile(r"(?:^|[.\W_])header\b")


@dataclass
class Node:
    """A node of a page's skeleton: children of one label under one parent are one node."""

    label: str
    children: list[Node] = field(default_factory=list)
    at: int = 0


def says_aside(token: str) -> bool:
    """Whether a class or id names an aside: by its first or last word, as cookie-notice and site-footer do."""
    words = _WORDS.findall(token)
    return bool(words) and not _OTHERS & set(words) and (words[0] in ASIDE_WORDS or words[-1] in ASIDE_WORDS)


def label_of(name: str, attributes: str) -> str:
    """Element, first class without digits, and a mark: * article, + main, ~ either that says aside, ! aside."""
    values: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        values.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    names = f"{values.get('class', '')} {values.get('id', '')}".split()
    role = values.get("role", "")
    first = re.sub(r"[^a-z_-]+", "", names[0]) if names else ""
    aside = name in ASIDE_TAGS or role in ASIDE_ROLES or "hidden" in values or any(map(says_aside, names))
    if name == "main" or role == "main":
        mark = "~" if aside else "+"
    elif name in MAIN_TAGS or values.get("itemprop") == "articlebody" or MAIN_WORDS & set(names):
        mark = "~" if aside else "*"
    else:
        mark = "!" if aside else ""
    return name + (f".{first}" if first else "") + mark


def regions(root: Node, texts: Container[int]) -> tuple[list[int], list[int]]:
    """Nodes with text inside the articles and main elements of a page, and outside of them, without asides.

    A mark of an aside on an article or main, or above it, hides that element only where the page has
    another article, without such a mark, that has text. An aside inside an article is hidden whole.
    """
    clean: list[int] = []
    marked: list[int] = []
    outside: list[int] = []
    found = False

    def visit(node: Node, place: list[int] | None, hidden: bool, article: bool) -> None:
        nonlocal found
        mark = node.label[-1]
        if mark in "*+~" and (hidden or place is outside or not article):
            if mark == "~" and place is clean and article:
                return
            place = marked if hidden or mark == "~" or place is marked else clean
            hidden, article = False, article or mark != "+"
        elif mark in "!~" or (place is outside and _HEADER.search(node.label)):
            if article:
                return
            hidden = True
        if not hidden and node.at in texts:
            place.append(node.at)
            found |= article and place is clean
        for child in node.children:
            visit(child, place, hidden, article)

    visit(root, outside, False, False)
    return sorted(clean if found else clean + marked), outside


def numbered(root: Node) -> str:
    """The text of a tree, whose nodes get their numbers in preorder."""
    names: list[str] = []
    walk: list[Node | None] = [root]  # None: the end of a node that has children around it
    count = 0
    while walk:
        node = walk.pop()
        if node is None:
            names.append(")")
            continue
        node.at, count = count, count + 1
        names += [node.label] if node is root else ["(", node.label]
        walk += [None] * (node is not root)
        walk += reversed(node.children)
    return " ".join(names)


def parse(page: str) -> tuple[str, list[tuple[int, str, int]]]:
    """A page's skeleton and its blocks in order: (node in preorder, text, characters of it in links).

    White space in a block is one space, character references are decoded; comments, scripts, styles and
    the like have no text. Any string can be read: unknown or unclosed tags end as in browsers or at the
    end of the page.
    """
    root = Node("html")
    stack: list[tuple[str, Node]] = [("html", root)]  # block elements only
    unseen, links, at = 0, 0, 0
    blocks: list[tuple[Node, str, int]] = []
    parts: list[str] = []
    linked = 0

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            blocks.append((stack[-1][1], text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def pop(names: tuple[str, ...]) -> None:
        """Close the innermost element of these names, unless a container stands before it."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in names:
                del stack[depth:]
                return
            if stack[depth][0] in CONTAINERS:
                return

    size = len(page)
    while at < size:
        tag = _TAG.search(page, at)
        end = tag.start() if tag else size
        if end > at and not unseen:
            text = page[at:end]
            if "&" in text:
                text = entities.unescape(text)
            parts.append(text)
            if links:
                linked += len(text)
        if not tag:
            break
        at = tag.end()
        name = tag["name"]
        if not name:
            continue
        name, attributes = name.lower(), tag["attributes"]
        if tag["end"]:
            if name in UNSEEN:
                unseen = max(0, unseen - 1)
            elif name == "a":
                links = 0
            elif name in BLOCKS:
                close_block()
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == name:
                        del stack[depth:]
                        break
                    if name == "p" and stack[depth][0] in CONTAINERS:
                        break
            elif name == "br":
                parts.append(" ")
            continue
        if name in RAW:
            closing = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = closing.end() if closing else size
            continue
        if name in UNSEEN:
            if name == "head":
                continue  # what stands in it is unseen by itself, and its end is often left out
            unseen += not attributes.rstrip().endswith("/")
        elif name == "a":
            links = 1
        elif name in ("br", "hr", "img") or name in VOID:
            if name == "hr":
                close_block()
            elif name == "br":
                parts.append(" ")
        elif name in BLOCKS:
            if name in ("html", "body") and len(stack) == 1:
                continue
            close_block()
            pop(("p",))
            if name in ENDS:
                pop(ENDS[name])
            label, parent = label_of(name, attributes), stack[-1][1]
            if len(stack) > DEPTH:
                stack.append((name, parent))
                continue
            node = next((c for c in parent.children if c.label == label), None)
            if node is None:
                node = Node(label)
                parent.children.append(node)
            stack.append((name, node))
    close_block()

    skeleton = numbered(root)
    return skeleton, [(n.at, text, k) for n, text, k in blocks]


def tree_of(skeleton: str) -> Node:
    """The tree of a skeleton's text, nodes numbered in preorder."""
    root, stack, count = None, [], 0
    for word in skeleton.split(" "):
        if word == ")":
            stack.pop()
        elif word != "(":
            node = Node(word, at=count)
            count += 1
            if stack:
                stack[-1].children.append(node)
            else:
                root = node
            stack.append(node)
    return root


def simple_tree_matching(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Size of the largest order-preserving matching of two trees with equal labels, and its pairs."""
    if a.label != b.label:
        return 0, []
    places: dict[str, list[int]] = {}
    for j in range(len(b.children) - 1, -1, -1):
        places.setdefault(b.children[j].label, []).append(j)
    # Fenwick tree over b's children: the best matching that ends at or before one, as (size, (before, pairs)).
    size = len(b.children) + 1
    best: list[tuple] = [(0, None)] * size
    for child in a.children:
        for j in places.get(child.label, ()):
            weight, found = simple_tree_matching(child, b.children[j])
            before, k = (0, None), j
            while k > 0:
                before = max(before, best[k], key=lambda x: x[0])
                k -= k & -k
            now, k = (before[0] + weight, (before[1], found)), j + 1
            while k < size:
                if now[0] > best[k][0]:
                    best[k] = now
                k += k & -k
    top, k = (0, None), size - 1
    while k > 0:
        top = max(top, best[k], key=lambda x: x[0])
        k -= k & -k
    matched, chain = [(a, b)], top[1]
    while chain:
        matched += chain[1]
        chain = chain[0]
    return top[0] + 1, matched


class Template:
    """A host's template: the union of its aligned skeletons."""

    def __init__(self, label: str):
        self.root = Node(label)

    def align(self, skeleton: Node) -> dict[int, Node]:
        """Merge a skeleton; returns the template's node for each of its nodes."""
        _, matched = simple_tree_matching(self.root, skeleton)
        to = {s.at: t for t, s in matched}
        to.setdefault(skeleton.at, self.root)

        def fill(node: Node) -> None:
            own, merged, last = to[node.at].children, [], 0
            for child in node.children:
                if child.at in to:
                    while own[last] is not to[child.at]:
                        merged.append(own[last])
                        last += 1
                    last += 1
                else:
                    to[child.at] = Node(child.label)
                merged.append(to[child.at])
            to[node.at].children = merged + own[last:]
            for child in node.children:
                fill(child)

        fill(skeleton)
        return to


def induce(shapes: list[tuple[str, int]]) -> tuple[str, list[list[int]]]:
    """The template of (skeleton, pages), aligned commonest first, and its node for each node of each skeleton."""
    order = sorted(range(len(shapes)), key=lambda i: (-shapes[i][1], shapes[i][0]))
    trees = {i: tree_of(shapes[i][0]) for i in order}
    template = Template(trees[order[0]].label)
    maps = {i: template.align(trees[i]) for i in order}
    text = numbered(template.root)
    return text, [[maps[i][k].at for k in range(len(maps[i]))] for i in range(len(shapes))]


def hash_of(text: str) -> int:
    """63 bits of a text's hash."""
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(text.encode("utf-8", "replace")) >> 1


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, skeleton, page, blocks) of (page_id, url, html); null html has no blocks.

    A block's place is 2 in an article or main, 1 outside of them, 0 in an aside. `page` is a hash of all texts.
    """
    name = F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    host = F.coalesce(F.lower(name), F.lit(""))
    kind = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string()), ("links", pa.int64()), ("place", pa.int32()), ("hash", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            done = [parse(h or "") for h in column_of(batch, "html").to_pylist()]
            blocks = []
            for skeleton, b in done:
                inside, outside = regions(tree_of(skeleton), {n for n, _, _ in b})
                places = dict.fromkeys(outside, 1) | dict.fromkeys(inside, 2)
                blocks.append([{"node": n, "text": t, "links": k, "place": places.get(n, 0), "hash": hash_of(t)} for n, t, k in b])
            yield pa.RecordBatch.from_arrays(
                [
                    *(column_of(batch, c) for c in ("page_id", "url", "host")),
                    pa.array([s for s, _ in done], pa.string()),
                    pa.array([hash_of("\n".join(t for _, t, _ in b)) for _, b in done], pa.int64()),
                    pa.array(blocks, kind),
                ],
                ["page_id", "url", "host", "skeleton", "page", "blocks"],
            )

    ids = {f.name: f.dataType.simpleString() for f in pages.schema}
    block = "struct<node: int, text: string, links: long, place: int, hash: long>"
    schema = f"page_id {ids['page_id']}, url string, host string, skeleton string, page long, blocks array<{block}>"
    return pages.select("page_id", "url", host.alias("host"), "html").mapInArrow(run, schema)


def aligned(parsed: DataFrame, folder: str) -> DataFrame:
    """(host, shape, slots): the node of the host's template for each node of each shape of page.

    A task aligns about CHUNK shapes of a host, dealt by hash, to a template; the next round aligns these
    templates in the same way until each host has one.
    """
    shapes = parsed.groupBy("host", "shape").agg(F.first("skeleton").alias("skeleton"), F.count(F.lit(1)).alias("pages"))
    parts = shapes.withColumnRenamed("shape", "id")
    schema = "host string, id long, chunk long, slots array<int>, skeleton string, pages long"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        template, slots = induce([(s, int(n)) for s, n in zip(group["skeleton"], group["pages"])])
        host, chunk = group["host"].iloc[0], group["chunk"].iloc[0]
        rows = [(host, int(i), int(chunk), k, None, 0) for i, k in zip(group["id"], slots)]
        rows.append((host, 0, int(chunk), None, template, int(group["pages"].sum())))
        return pd.DataFrame(rows, columns=["host", "id", "chunk", "slots", "skeleton", "pages"])

    total, level, most = None, 0, 2
    while most > 1:
        counts = parts.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
        dealt = parts.join(counts, "host").withColumn("chunk", F.expr("pmod(id, chunks)")).drop("chunks")
        merged = written(dealt.groupBy("host", "chunk").applyInPandas(run, schema), f"{folder}/merged-{level}")
        maps = merged.where(F.col("skeleton").isNull()).select("host", "id", "chunk", "slots")
        if total is None:
            total = maps
        else:
            upper = maps.select("host", F.col("id").alias("chunk"), F.col("chunk").alias("up"), F.col("slots").alias("to"))
            slots = F.transform("slots", lambda k: F.get("to", k)).alias("slots")
            total = total.join(upper, ["host", "chunk"]).select("host", "id", F.col("up").alias("chunk"), slots)
        parts = merged.where(F.col("skeleton").isNotNull()).select("host", F.col("chunk").alias("id"), "skeleton", "pages")
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        level += 1
    return written(total.select("host", F.col("id").alias("shape"), "slots"), f"{folder}/slots")


def template_facts(parsed: DataFrame, slots: DataFrame) -> DataFrame:
    """(host, shape, facts): by node, hashes of the texts that are template there, and whether it is links.

    Counted are distinct pages, told apart by a hash of all their texts: copies of a page do not make
    its text template. Texts count one by one, so a node can hold several fixed ones beside others.
    """
    each = parsed.select("host", "shape", "page", F.explode("blocks").alias("b")).where("b.place > 0")
    each = each.select(
        "host", "shape", "page", "b.node", F.col("b.hash").alias("text"), F.length("b.text").alias("chars"), "b.links"
    )
    sums = [F.sum("chars").alias("chars"), F.sum("links").alias("links")]
    each = each.groupBy("host", "shape", "page", "node", "text").agg(*sums)
    each = each.join(slots, ["host", "shape"]).withColumn("slot", F.get("slots", F.col("node")))
    largest = [F.max("chars").alias("chars"), F.max("links").alias("links")]
    on_page = each.groupBy("host", "slot", "page", "text").agg(*largest)
    by_slot = on_page.groupBy("host", "slot", "page").agg(*sums)
    by_slot = by_slot.groupBy("host", "slot").agg(F.count(F.lit(1)).alias("pages"), *sums)
    by_text = on_page.groupBy("host", "slot", "text").agg(F.count(F.lit(1)).alias("n"))
    by_text = by_text.where(100 * F.col("n") >= CONSTANT * SEEN).join(by_slot, ["host", "slot"])
    fixed = by_text.where((F.col("pages") >= SEEN) & (100 * F.col("n") >= CONSTANT * F.col("pages")))
    fixed = fixed.groupBy("host", "slot").agg(F.collect_list("text").alias("texts"))
    linked = by_slot.select("host", "slot", (100 * F.col("links") > LINKS * F.col("chars")).alias("linked"))
    known = linked.join(fixed, ["host", "slot"], "left").where(F.col("linked") | F.col("texts").isNotNull())
    nodes = slots.select("host", "shape", F.posexplode("slots").alias("node", "slot")).join(known, ["host", "slot"])
    entry = F.struct("node", F.struct("texts", "linked"))
    return nodes.groupBy("host", "shape").agg(F.map_from_entries(F.collect_list(entry)).alias("facts"))


def main_texts(pages: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, text, n_chars) of (page_id, url, html): blocks of content joined by an empty line.

    Content is what lies in the article or main element, outside of asides in it; in pages without one
    it is what lies outside of asides and lists of links. Texts that are template of the host go, unless
    nothing else is there. Pages without url form a host of their own; null or empty html and pages
    without content have an empty text; repeated rows have equal texts. No block of content is cut.
    """
    parsed = parsed_pages(pages).withColumn("shape", F.xxhash64("skeleton"))
    parsed = written(parsed, f"{folder}/parsed", "zstd")
    facts = written(template_facts(parsed, aligned(parsed, folder)), f"{folder}/facts")

    def fact(b: Column, name: str) -> Column:
        return F.try_element_at("facts", b["node"])[name]

    def varies(b: Column) -> Column:
        return ~F.coalesce(F.array_contains(fact(b, "texts"), b["hash"]), F.lit(False))

    joined = parsed.join(facts, ["host", "shape"], "left")
    inside = F.filter("blocks", lambda b: b["place"] == 2)
    free = F.filter("blocks", lambda b: (b["place"] == 1) & ~F.coalesce(fact(b, "linked"), F.lit(False)))
    joined = joined.withColumn("inside", inside).withColumn("free", free)
    joined = joined.withColumn("content", F.when(F.size("inside") > 0, F.col("inside")).otherwise(F.col("free")))
    joined = joined.withColumn("varying", F.filter("content", varies))
    kept = F.when(F.size("varying") > 0, F.col("varying")).otherwise(F.col("content"))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n\n")
    joined = joined.select("page_id", "url", F.coalesce(text, F.lit("")).alias("text"))
    return joined.withColumn("n_chars", F.length("text").cast("long"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"), work_folder(spark, "html"))
