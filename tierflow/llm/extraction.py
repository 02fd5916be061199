"""Main text of web pages by wrapper induction.

A host's pages share a template. The most frequent tree shapes of a host are merged into one reference tree, and each
shape is aligned with it by simple tree matching, where runs of like siblings count as one node, so that lists of any length
align. A node without a partner is placed by its path below the closest node that has one. A text that most of the host's
different pages hold in one slot is template, and so is a slot whose other texts are few for its pages; what varies is content. This decides inside ``article`` and ``main`` too, where it takes more pages, and a heading that varies or the larger
part of the article: a page without either shows an article again, and what it shares is no template. Elements whose tag,
role or class says that they are menus, adverts, notices, forms or comments are never content.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# A text is template if it lies in the same slot on more than this share of the host's pages, and a slot, if it has at most
# this many other texts for each page that has them. Pages of equal text count once.
TEMPLATE_SHARE = 0.5
# Two articles may share a passage. Inside an article a slot or text is template if it was seen on so many pages.
ARTICLE_PAGES = 3
# So many of a host's most frequent shapes make its reference tree; nodes of others are placed by their path in it.
REFERENCE_SHAPES = 8
# Elements nested deeper are taken as children of the element at this depth.
DEEPEST = 120
# Tables of the wrapper up to this size are broadcast; larger ones are joined by a shuffle.
MOST_BROADCAST_BYTES = 64 << 20

# Names of HTML elements, and words in class names or ids of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea select".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - frozenset("button caption dd dt legend li option tbody td tfoot th thead tr summary".split())
CLOSED_BY_SIBLING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody", "thead"},
}
SCOPES = frozenset("table ul ol dl select body html div article main section nav aside td th".split())
FURNITURE = frozenset("nav footer aside form head menu dialog button label input fieldset".split()) | RAW
FURNITURE_WORDS = (
    "ad ads advert adverts advertisement sponsor sponsored banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer masthead cookie cookies consent notice notices notification popup modal subscribe newsletter comment comments "
    "reply replies disqus"
).split()
# Inside an article these words are a hint only: the wrapper judges as it does outside.
HINT_WORDS = (
    "promo side aside widget header alert overlay signup login search share sharing social related recommended pagination "
    "pager toolbar copyright legal disclaimer skip"
).split()
HEADINGS = frozenset("h1 h2 h3".split())
CONTAINERS = frozenset("article aside center details div dl figure footer header main ol section table ul".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar toolbar".split()
)
_NAMED = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(FURNITURE_WORDS)})(?:$|[\s_-])")
_HINTED = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(HINT_WORDS)})(?:$|[\s_-])")
_WHITE = re.compile(r"[\x20\x09-\x0D]+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


class Node:
    """An element; ``content`` has the texts and children in page order, ``place`` its number in the page's shape.

    ``furniture`` is never content; ``hinted`` may be furniture, by a word that articles use as well or, in elements that
    hold no others, by an id, which is often just the target of a link.
    """

    __slots__ = ("tag", "key", "furniture", "hinted", "content", "place")

    def __init__(self, tag: str, rest: str = "") -> None:
        marks = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(rest)} if rest else {}
        self.tag = tag
        self.key = f"{tag}.{marks['class']}" if marks.get("class") else tag
        self.furniture = tag in FURNITURE or marks.get("role") in FURNITURE_ROLES
        self.hinted = False
        if marks and tag not in ("html", "body"):
            name, mark = marks.get("class", ""), marks.get("id", "")
            surely = f"{name} {mark}" if tag in CONTAINERS else name
            self.furniture = self.furniture or bool(_NAMED.search(surely))
            self.hinted = bool(_HINTED.search(f"{name} {mark}") or _NAMED.search(mark))
        self.content: list[str | Node] = []
        self.place = 0

    def children(self) -> list[Node]:
        return [c for c in self.content if isinstance(c, Node)]


def parse(html: str) -> Node:
    """The page's tree. Whatever is not closed ends with its parent; stray end tags are passed over."""
    root = Node("#page")
    stack = [root]
    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() < at:
            continue  # inside raw text
        if token.start() > at:
            stack[-1].content.append(html[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if token["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if tag not in SCOPES and stack[depth].tag in SCOPES and tag in BLOCK:
                    break
            continue
        if tag in CLOSES_P:
            _close(stack, {"p"})
        if tag in CLOSED_BY_SIBLING:
            _close(stack, CLOSED_BY_SIBLING[tag])
        node = Node(tag, token["rest"])
        stack[-1].content.append(node)
        if tag in RAW and not token["rest"].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID and len(stack) <= DEEPEST:
            stack.append(node)
    if at < len(html):
        stack[-1].content.append(html[at:])
    return root


def _close(stack: list[Node], tags: set[str]) -> None:
    """End the innermost open element of ``tags``, unless a container lies between."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in SCOPES:
            return


# ---- wrapper ------------------------------------------------------------------------------------------------

Shape = list  # [key, children's shapes], runs of like siblings as one


def shape(node: Node) -> tuple[Shape, list]:
    """The node's shape, and the same tree as (nodes of the run, children's runs)."""
    shapes, runs = [], []
    for child in node.children():
        form, inner = shape(child)
        if shapes and shapes[-1] == form:
            runs[-1].append((child, inner))
        else:
            shapes.append(form)
            runs.append([(child, inner)])
    return [node.key, shapes], runs


def number(node: Node, runs: list, place: int = 0) -> int:
    """Numbers the nodes by the places of their shapes, in page order; returns the next number."""
    node.place = place
    place += 1
    for run in runs:
        place = [number(child, inner, place) for child, inner in run][0]
    return place


def tree_match(a: Shape, b: Shape, known: dict) -> tuple[int, list[tuple[int, int]]]:
    """Size of the largest order-preserving match of two trees with like roots, and the children paired for it."""
    if a[0] != b[0]:
        return 0, []
    pair = (id(a), id(b))
    if pair not in known:
        left, right = a[1], b[1]
        head = 0
        while head < min(len(left), len(right)) and left[head] == right[head]:
            head += 1
        tail = 0
        while tail < min(len(left), len(right)) - head and left[-1 - tail] == right[-1 - tail]:
            tail += 1
        paired = [(i, i) for i in range(head)]
        paired += [(len(left) - 1 - i, len(right) - 1 - i) for i in range(tail)]
        size = 1 + sum(tree_match(left[i], right[j], known)[0] for i, j in paired)
        rows, columns = range(head, len(left) - tail), range(head, len(right) - tail)
        best = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
        gain = {}
        for i, row in enumerate(rows, 1):
            for j, column in enumerate(columns, 1):
                g = gain[i, j] = tree_match(left[row], right[column], known)[0]
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + g)
        i, j = len(rows), len(columns)
        size += best[i][j]
        while i and j:
            if gain[i, j] and best[i][j] == best[i - 1][j - 1] + gain[i, j]:
                paired.append((rows[i - 1], columns[j - 1]))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        known[pair] = size, paired
    return known[pair]


def merged(a: Shape, b: Shape, known: dict) -> Shape:
    """Both trees in one: what matches once, the rest of either in its place."""
    out: list[Shape] = []
    i = j = 0
    for x, y in sorted(tree_match(a, b, known)[1]):
        out += [*a[1][i:x], *b[1][j:y], merged(a[1][x], b[1][y], known)]
        i, j = x + 1, y + 1
    return [a[0], [*out, *a[1][i:], *b[1][j:]]]


def reference_tree(shapes: list[Shape]) -> Shape:
    tree = shapes[0]
    for form in shapes[1:]:
        tree = merged(tree, form, {})
    return tree


def slots(form: Shape, reference: Shape) -> list[int]:
    """The slot of each place of ``form``: the number of its partner in the reference, or a digest of its path below one."""
    known: dict = {}
    out: list[int] = []
    sizes: dict[int, int] = {}

    def measure(tree: Shape) -> int:
        size = sizes[id(tree)] = 1 + sum(measure(child) for child in tree[1])
        return size

    def visit(tree: Shape, partner: Shape | None, slot: int) -> None:
        out.append(slot)
        paired = {}
        if partner is not None:
            paired = dict(tree_match(tree, partner, known)[1])
            starts = [slot + 1]
            for child in partner[1]:
                starts.append(starts[-1] + sizes[id(child)])
        for i, child in enumerate(tree[1]):
            if i in paired:
                visit(child, partner[1][paired[i]], starts[paired[i]])
            else:
                visit(child, None, common.text_hash(f"{slot}/{child[0]}"))

    measure(reference)
    visit(form, reference, 0)
    return out


# ---- blocks -------------------------------------------------------------------------------------------------


def blocks(root: Node) -> list[tuple[int, bool, bool, str]]:
    """Place, inside the page's own article and not hinted at, heading, text of each block that is not furniture, in order."""
    out: list[tuple[int, bool, bool, str]] = []
    open_text: list[str] = []
    where = [0, False, False]

    def flush() -> None:
        text = _WHITE.sub(" ", unescape("".join(open_text))).strip(" ")
        if text:
            out.append((*where, text))
        open_text.clear()

    todo: list = [(root, False, False)]
    while todo:  # depth first, in page order; (None, *where) goes back to the block around an element
        entry = todo.pop()
        if isinstance(entry, str):
            open_text.append(entry)
            continue
        node, *more = entry
        if node is None:
            flush()
            where[:] = more
            continue
        inside, hinted = more
        page_header = node.tag == "header" and not inside
        if node.furniture or page_header or node.hinted and not inside:
            if node.tag in BLOCK:
                flush()
            continue
        inside, hinted = inside or node.tag in ("article", "main"), hinted or node.hinted
        if node.tag in BLOCK:
            flush()
            todo.append((None, *where))
            where[:] = node.place, inside and not hinted, node.tag in HEADINGS
        elif node.tag == "br":
            open_text.append(" ")
        todo.extend(c if isinstance(c, str) else (c, inside, hinted) for c in reversed(node.content))
    flush()
    return out


_HOST = r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page: its article as blocks joined by line feeds.

    A null or empty html has an empty text. Pages without a host in their url are one group. The only page of a host, and
    pages of equal text, tell nothing about a template; names alone decide there. Repeated rows are extracted one by one; a
    null id is kept; other columns are not looked at; an empty table gives an empty result.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.regexp_extract(F.lower(url_col), _HOST, 1), F.lit("")).alias("host"),
        F.col(html_col).alias("html"),
    )
    parsed = common.stage(_parsed(rows), "wrapper-pages")
    aligned = _small(_aligned(parsed), F.size("slots") * 8 + F.octet_length("of"), "wrapper-slots")
    placed = parsed.join(aligned, (F.col("host") == F.col("of")) & (F.col("form") == F.col("like")))
    placed = placed.withColumn(
        "blocks", F.transform("blocks", lambda b: b.withField("slot", F.get("slots", b["place"])))
    )
    template = _small(_templates(placed), (F.size("weak") + F.size("strong")) * 8 + F.octet_length("on"), "wrapper-template")
    judged = placed.join(template, F.col("host") == F.col("on"), "left")

    def constant(b: Column) -> Column:
        def known(marks: str) -> Column:
            found = F.array_contains(marks, _slot(b)) | F.array_contains(marks, _slot_text(b))
            return F.coalesce(found, F.lit(False))

        return F.when(b["main"], known("strong")).otherwise(known("weak"))

    judged = judged.withColumn("blocks", F.transform("blocks", lambda b: b.withField("constant", constant(b))))
    inner_constant = F.filter("blocks", lambda b: b["main"] & b["constant"])
    inner_varying = F.filter("blocks", lambda b: b["main"] & ~b["constant"])

    def chars(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda n, b: n + F.char_length(b["text"]))

    lesser = (F.size(inner_constant) <= F.size(inner_varying)) | (chars(inner_constant) <= chars(inner_varying))
    named = F.exists("blocks", lambda b: b["main"] & b["heading"] & ~b["constant"])
    judged = judged.withColumn("own", named | lesser)
    content = F.filter("blocks", lambda b: ~b["constant"] | b["main"] & ~F.col("own"))
    text = F.array_join(F.transform(content, lambda b: b["text"]), "\n")
    return judged.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text")
    ).withColumn("n_chars", F.char_length("text").cast("long"))


def _small(table: DataFrame, size: Column, label: str) -> DataFrame:
    """The table, written; to be broadcast if it is small."""
    table = common.stage(table, label)
    total = table.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(table) if total <= MOST_BROADCAST_BYTES else table


def _slot(b: Column) -> Column:
    return F.xxhash64(b["slot"])


def _slot_text(b: Column) -> Column:
    return F.xxhash64(b["slot"], b["mark"])


def _parsed(rows: DataFrame) -> DataFrame:
    """``id, url, host``, the page's shape and a digest of it (``form``), a digest of its texts (``sign``), its ``blocks``."""
    block = "struct<place: int, main: boolean, heading: boolean, mark: long, text: string>"
    kind = f"id {rows.schema['id'].dataType.simpleString()}, url string, host string"
    kind += f", form long, shape string, sign long, blocks array<{block}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("place", pa.int32()), ("main", pa.bool_()), ("heading", pa.bool_()), ("mark", pa.int64())]
        block_type = pa.list_(pa.struct([*fields, ("text", pa.string())]))
        for batch in batches:
            for part, htmls in common.texts_in_groups(batch.column(3)):
                shapes, signs, found = [], [], []
                for html in htmls:
                    root = parse(html)
                    form, runs = shape(root)
                    number(root, runs)
                    texts = [
                        {"place": place, "main": main, "heading": heading, "mark": common.text_hash(text), "text": text}
                        for place, main, heading, text in blocks(root)
                    ]
                    shapes.append(json.dumps(form, separators=(",", ":")))
                    signs.append(common.text_hash(" ".join(str(b["mark"]) for b in texts)))
                    found.append(texts)
                here = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(here.column(c) for c in range(3)),
                        pa.array([common.text_hash(f) for f in shapes], pa.int64()),
                        pa.array(shapes, pa.string()),
                        pa.array(signs, pa.int64()),
                        pa.array(found, block_type),
                    ],
                    names=["id", "url", "host", "form", "shape", "sign", "blocks"],
                )

    return rows.mapInArrow(run, kind)


def _aligned(parsed: DataFrame) -> DataFrame:
    """``of, like, slots``: for each host and shape the slot of each place."""
    forms = common.stage(parsed.groupBy("host", "form", "shape").agg(F.count(F.lit(1)).alias("n")), "wrapper-shapes")
    order = Window.partitionBy("host").orderBy(F.desc("n"), "form")
    frequent = (
        forms.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= REFERENCE_SHAPES)
        .groupBy(F.col("host").alias("of"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", "shape"))).alias("ranked"))
        .select("of", F.transform("ranked", lambda r: r["shape"]).alias("shapes"))
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tree = reference_tree([json.loads(f) for f in batch.column(1)[row].as_py()])
                text = pa.array([json.dumps(tree, separators=(",", ":"))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), text], names=["of", "reference"])

    references = frequent.mapInArrow(merge, "of string, reference string")
    references = _small(references, F.octet_length("reference") + F.octet_length("of"), "wrapper-references")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, last, tree = [], None, None
            for form, reference in zip(batch.column(2), batch.column(3)):
                text = reference.as_py()
                if text != last:
                    last, tree = text, json.loads(text)
                found.append(slots(json.loads(form.as_py()), tree))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["of", "like", "slots"]
            )

    joined = forms.join(references, F.col("host") == F.col("of"))
    return joined.select("host", "form", "shape", "reference").mapInArrow(align, "of string, like long, slots array<long>")


def _templates(placed: DataFrame) -> DataFrame:
    """``on, weak, strong``: digests of a host's template slots and texts; the strong ones hold inside articles too."""
    cells = placed.select("host", "sign", F.explode("blocks").alias("b")).select("host", "sign", "b.slot", "b.mark")
    texts = cells.groupBy("host", "slot", "mark").agg(F.count_distinct("sign").alias("n"))
    pages = placed.groupBy(F.col("host").alias("on")).agg(F.count_distinct("sign").alias("pages"))
    pages = _small(pages, F.octet_length("on") + 8, "wrapper-hosts")
    most = (F.col("n") > 1) & (F.col("n") > TEMPLATE_SHARE * F.col("pages"))
    texts = texts.join(pages, F.col("host") == F.col("on")).select("host", "slot", "mark", "n", most.alias("most"))
    texts = common.stage(texts, "wrapper-texts")
    by_slot = texts.filter("not most").groupBy("host", "slot").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))
    by_slot = by_slot.filter(F.col("texts") <= TEMPLATE_SHARE * F.col("n"))
    marks = by_slot.select("host", "n", F.xxhash64("slot").alias("digest")).unionByName(
        texts.filter("most").select("host", "n", F.xxhash64("slot", "mark").alias("digest"))
    )
    strong = F.when(F.col("n") >= ARTICLE_PAGES, F.col("digest"))
    return marks.groupBy(F.col("host").alias("on")).agg(
        F.collect_set("digest").alias("weak"), F.collect_set(strong).alias("strong")
    )
