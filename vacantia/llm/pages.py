"""Main text of web pages by a site style tree.

Each page is parsed into blocks, a block being the text of one element between block-level tags, under its
path of tags and classes. The different pages of a host are merged by path into a tree; pages with equal
blocks count once, so a group of copies weighs as much as one page. The content importance of a path is one
less the mean entropy of its texts over the pages that have it: texts of their own give 1, a text on every
page gives 0. Its presentation importance is the entropy of the inline markup seen under it. A branch's
importance is composed of those of all paths below it, each weighed by its pages and less for each level
down. A branch whose own importance and that of every path in it are low is noise: it is taken out of every
page of the host, but for texts that only one page has, which are never what a site repeats.

Elements that say what they are by tag, or by the first or last word of a class, id or role (navigation,
footers, forms, adverts, comments) are taken out on any page. Other such words are only a prior: the
element goes, unless its branch is known to be important on the host and is no list of links, or the page
has nothing else. The inside of an article or main element is not judged by importance.

Defined results: null html is empty; a null or hostless url is a host of its own; repeated rows get equal
rows and count as one page; paths more than ``DEPTH`` levels deep are judged by themselves and by their first
``DEPTH`` levels; other columns are never read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import row_key, settle

#: A branch below this importance, seen on at least so many pages of a host, is noise.
MIN_IMPORTANCE = 0.4
MIN_PAGES = 8
#: Weight of the children against the node's own presentation, a style tree's attenuation.
GAMMA = 0.9
PARTS = 32
#: A branch under an ambiguous name is kept from this importance on.
PRIOR_IMPORTANCE = 0.9
#: Levels of a path that are branches of the tree.
DEPTH = 64
#: A block with a link for so many words, or more links, is a list of links.
LINK_WORDS = 8

# Element names by their role in HTML, and the words that name furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes noembed xmp svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
DROP = frozenset("nav footer aside form button select dialog menu head".split())
MAIN = frozenset("article main".split())
CUES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads adv advert adverts "
    "advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup "
    "modal overlay newsletter subscribe subscription signup login search share sharing social related recommended "
    "recommendations comment comments disqus reply replies respond discussion widget pagination pager toolbar skip "
    "copyright legal disclaimer alert".split()
)
#: Names that an article's own parts bear as well.
WEAK = frozenset("legal related social alert discussion promotion search login skip widget respond".split())
#: Last words of a name that tell nothing of what is inside, and words of an article's own header.
NEUTRAL = frozenset("container wrapper wrap inner outer list area box section block links item items bar content".split())
OWN = frozenset("article entry post story".split())
#: A name with one of these tells what a frame around other elements has, not what it is.
LAYOUT = frozenset("with has no without".split())
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table tbody thead tfoot div section article main body select".split())

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*+)>")
_NAMES = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PIECES = re.compile(r"[a-z]+|[A-Z][a-z]*")
_DIGITS = re.compile(r"[0-9]+")


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


class _Node:
    """An element: ``path`` names its place among the pages of a host, ``chain`` the places of its first
    levels, ``furniture`` is 2 by a clear name or tag, 1 by an ambiguous name."""

    __slots__ = ("name", "path", "chain", "depth", "main", "outer", "furniture", "role")

    def __init__(self, name, spelled, outer, furniture=0):
        self.name, self.outer, self.furniture, self.role = name, outer, furniture, None
        if outer is None:
            self.path, self.chain, self.depth, self.main = 0, (), 0, False
            return
        self.path = _hash(f"{outer.path}>{name}{spelled}")
        self.depth = outer.depth + 1
        self.chain = outer.chain + (self.path,) if self.depth <= DEPTH else outer.chain
        self.main = outer.main


def _names(attributes: str) -> tuple[str, int]:
    """(spelling for the path, 2 if a word of it clearly names furniture, 1 if it may)."""
    spelled, cue = "", 0
    for kind, *values in _NAMES.findall(attributes):
        value = next((v for v in values if v), "")
        if kind.lower() == "class":
            spelled = "." + _DIGITS.sub("0", ".".join(sorted(value.split())))
        for token in value.split():
            words = [w.lower() for w in _PIECES.findall(token)]
            if "header" in words and OWN.intersection(words):
                words = [w for w in words if w != "header"]
            found = CUES.intersection(words)
            if not found or LAYOUT.intersection(words):
                continue
            while words[-1] in NEUTRAL and len(words) > 1:
                words.pop()
            cue = max(cue, 2 if (CUES - WEAK).intersection((words[0], words[-1])) or kind.lower() == "role" else 1)
    return spelled, cue


def _roles(nodes) -> None:
    """Sets each node's role by its own and its outer elements' names, every element once."""
    for node in nodes:
        above, up = [], node
        while up is not None and up.role is None:
            above.append(up)
            up = up.outer
        level = 0 if up is None else {2: 2, 3: 1}.get(up.role, 0)
        for up in reversed(above):
            level = max(level, up.furniture)
            up.role = 2 if level == 2 else 3 if level else int(up.main)


def _blocks(page: str | None) -> list[tuple[_Node, str, str]]:
    """(element, text, inline markup) of each block in page order.

    An element with a furniture name that holds the page's main element is a frame around it, and its name
    is not heeded.
    """
    page = page or ""
    root = _Node("", "", None)
    node, out, texts, styles, at, size = root, [], [], [], 0, len(page)

    def end_block():
        joined = "".join(texts)
        if texts:
            words = html.unescape(joined).split()
            if words:
                out.append((node, " ".join(words), ",".join(styles)))
        texts.clear()
        styles.clear()

    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            texts.append(page[at:])
            break
        if mark > at:
            texts.append(page[at:mark])
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        if page[mark + 1 : mark + 2] in ("!", "?"):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        tag = _TAG.match(page, mark) or _LOOSE.match(page, mark)
        if not tag:
            # A lone sign is text; a tag that never ends is not.
            if re.match(r"</?[A-Za-z]", page[mark : mark + 3]):
                break
            texts.append("<")
            at = mark + 1
            continue
        at, closing, name = tag.end(), tag[1], tag[2].lower()
        if name in RAW and not closing:
            if not tag[3].endswith("/"):
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
                close = page.find(">", end.end()) if end else -1
                at = size if close < 0 else close + 1
            if name not in INLINE:
                texts.append(" ")
            continue
        if name in INLINE:
            if not closing:
                styles.append(name)
                if name != "img" and name != "wbr":
                    spelled, cue = _names(tag[3]) if tag[3] else ("", 0)
                    if cue:
                        end_block()
                        node = _Node(name, spelled, node, cue)
            elif node.name == name:
                end_block()
                node = node.outer
            continue
        if name == "br":
            texts.append(" ")
            continue
        end_block()
        if name in VOID:
            continue
        if closing:
            up = node
            while up is not root and up.name != name:
                up = up.outer
            if up is not root:
                node = up.outer
            continue
        # Tags whose end is implied by the next one.
        up = node
        while up is not root and up.name not in SCOPES and up.name not in DROP:
            if up.name == "p" or up.name in CLOSES.get(name, ()):
                node = up.outer
                if up.name == "p" and name not in CLOSES:
                    break
            up = up.outer
        spelled, cue = _names(tag[3]) if tag[3] else ("", 0)
        node = _Node(name, spelled, node)
        if name in MAIN and not cue:
            node.main = True
            frame = node if name == "main" else root
            while frame is not root:
                frame.furniture = frame.furniture if frame.name in DROP else 0
                frame = frame.outer
        elif name not in ("html", "body"):
            node.furniture = 2 if name in DROP or name == "header" and not node.main else cue
    end_block()
    _roles({id(n): n for n, _, _ in out}.values())
    return out


def blocks(page: str | None) -> list[tuple[int, str, str, int]]:
    """(path, text, inline markup, role) of each block in page order; role 0 plain, 1 article, 2 furniture,
    3 ambiguous by name."""
    return [(node.path, text, style, node.role) for node, text, style in _blocks(page)]


_BLOCK = "struct<path:bigint,text_hash:bigint,style:bigint,inline:int,role:int,links:boolean,text:string>"
_LINE = "struct<path:bigint,up:bigint,gap:int>"


def _parse_batches(batches):
    kind = pa.list_(pa.struct([
        ("path", pa.int64()), ("text_hash", pa.int64()), ("style", pa.int64()), ("inline", pa.int32()),
        ("role", pa.int32()), ("links", pa.bool_()), ("text", pa.string()),
    ]))
    lineage = pa.list_(pa.struct([("path", pa.int64()), ("up", pa.int64()), ("gap", pa.int32())]))
    for batch in batches:
        rows, lines, bodies = [], [], []
        for page in batch.column("html"):
            row, line = [], {}
            for node, text, style in _blocks(page.as_py()):
                if node.role == 2:
                    continue
                row.append({
                    "path": node.path, "text_hash": _hash(text), "style": _hash(style),
                    "inline": style.count(",") + bool(style), "role": node.role,
                    "links": style.split(",").count("a") * LINK_WORDS >= text.count(" ") + 1, "text": text,
                })
                if node.path not in line:
                    line[node.path] = [(node.path, 0)] if not node.chain or node.chain[-1] != node.path else []
                    line[node.path] += [(up, node.depth - i) for i, up in enumerate(node.chain, 1)]
            rows.append(row)
            lines.append([{"path": path, "up": up, "gap": gap} for path, ups in line.items() for up, gap in ups])
            bodies.append(_hash(repr(sorted((b["path"], b["text_hash"]) for b in row))))
        arrays = [batch.column(c) for c in ("key", "id", "url", "host")]
        arrays += [pa.array(bodies, pa.int64()), pa.array(rows, kind), pa.array(lines, lineage)]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "id", "url", "host", "body", "blocks", "lines"])


def parse(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Per row: key, id, url, host, body (hash of its blocks), its blocks but furniture, and the lines of
    their paths up the tree."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(
        row_key(id_col, url_col, html_col).alias("key"), F.col(id_col).alias("id"), F.col(url_col).alias("url"),
        host.alias("host"), F.col(html_col).alias("html"),
    )
    id_type = dict(rows.dtypes)["id"]
    return rows.mapInArrow(
        _parse_batches,
        f"key long, id {id_type}, url string, host string, body long, blocks array<{_BLOCK}>, lines array<{_LINE}>",
    )


def _distinct(*fields):
    """A page's different values of some fields of its blocks."""
    return F.array_distinct(F.transform("blocks", lambda b: F.struct(*[b[f].alias(f) for f in fields])))


def text_counts(seen: DataFrame) -> DataFrame:
    """(host, path, text_hash, k): how many pages of a host have a text at a path."""
    return (
        seen.select("host", F.explode(_distinct("path", "text_hash")).alias("f"))
        .groupBy("host", "f.path", "f.text_hash").agg(F.count(F.lit(1)).alias("k"))
    )


def importance(seen: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of the paths that hold text; ``seen`` are different pages."""
    pages = (
        seen.select("host", F.explode(_distinct("path")).alias("f")).groupBy("host", "f.path")
        .agg(F.count(F.lit(1)).alias("pages"))
    )
    # Sums over a path's texts and styles of k log k, and of k, where k pages have one.
    texts = text_counts(seen).groupBy("host", "path").agg(F.sum(F.col("k") * F.log("k")).alias("klogk"), F.sum("k").alias("n"))
    shown = (
        seen.select("host", F.explode(_distinct("path", "style", "inline")).alias("f"))
        .groupBy("host", "f.path", "f.style", "f.inline").agg(F.count(F.lit(1)).alias("k"))
        .groupBy("host", "path").agg(
            F.sum(F.col("k") * F.log("k")).alias("klogk2"), F.sum("k").alias("n2"),
            (F.sum(F.col("inline") * F.col("k")) / F.sum("k")).alias("inline"),
        )
    )
    size = F.log("pages")
    content = 1 - F.col("klogk") / F.col("n") / size
    # Entropy of the styles, to the base of the pages: (log n - sum(k log k) / n) / log pages.
    presentation = F.least(F.lit(1.0), (F.log("n2") - F.col("klogk2") / F.col("n2")) / size)
    weight = F.pow(F.lit(GAMMA), F.col("inline"))
    return (
        pages.join(texts, ["host", "path"]).join(shown, ["host", "path"])
        .select("host", "path", "pages", F.when(
            F.col("pages") > 1, (1 - weight) * presentation + weight * content
        ).otherwise(1.0).alias("importance"))
    )


def noise_paths(paths: DataFrame, lines: DataFrame, min_importance: float, min_pages: int) -> DataFrame:
    """(host, path) of all paths in a branch that is noise.

    ``paths`` is what ``importance`` gives, ``lines`` the different (host, path, up, gap). A branch's importance is
    the mean over the paths in it, by pages and ``GAMMA`` for each level; paths on few pages weigh in it, but do not
    speak for it alone. As a mean it never exceeds the greatest of them.
    """
    under = lines.join(paths, ["host", "path"])
    share = F.col("pages") * F.pow(F.lit(GAMMA), F.col("gap"))
    noisy = (
        under.groupBy("host", "up").agg(
            (F.sum(share * F.col("importance")) / F.sum(share)).alias("composed"), F.max("pages").alias("pages"),
            F.max(F.when(F.col("pages") >= min_pages, F.col("importance"))).alias("most"),
        )
        .where((F.col("pages") >= min_pages) & (F.col("composed") < min_importance) & (F.col("most") < min_importance))
        .select("host", "up")
    )
    return lines.join(noisy, ["host", "up"]).select("host", "path").distinct()


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_importance: float = MIN_IMPORTANCE, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Per row: id, url, text (the kept blocks in page order, joined by a space)."""
    whole = parse(pages, id_col, url_col, html_col)
    # Statistics are written without texts; pages are parsed again for theirs, which then move once.
    parsed = settle(
        whole.select("key", "host", "body", F.transform("blocks", lambda b: F.struct(
            b.path, b.text_hash, b.style, b.inline, b.role)).alias("blocks"), "lines"),
        "pages",
    )
    seen = parsed.dropDuplicates(["host", "body"])
    lines = seen.select("host", F.explode("lines").alias("l")).select("host", "l.path", "l.up", "l.gap").distinct()
    paths = settle(importance(seen), "page-paths")
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    noise = (
        text_counts(seen).where("k > 1").join(noise_paths(paths, lines, min_importance, min_pages), ["host", "path"])
        .select("host", "path", "text_hash", parts)
    )
    valued = (
        paths.where((F.col("importance") >= PRIOR_IMPORTANCE) & (F.col("pages") >= min_pages)).select("host", "path", parts)
    )

    def blocks_of(role):
        # Equal rows give equal blocks, which the set below joins; no text goes along.
        return (
            parsed.select("key", "host", F.explode(F.array_distinct(F.transform(
                F.filter("blocks", lambda b: b.role == role), lambda b: F.struct(b.path, b.text_hash)))).alias("b"))
            .select("key", "host", "b.path", "b.text_hash", F.pmod(F.col("key"), F.lit(PARTS)).cast("int").alias("part"))
        )

    marked = (
        blocks_of(0).join(noise, ["host", "path", "text_hash", "part"]).select("key", "path", "text_hash")
        .unionByName(blocks_of(3).join(valued, ["host", "path", "part"]).select("key", "path", "text_hash"))
        .groupBy("key").agg(F.collect_set(F.struct("path", "text_hash")).alias("marked"))
    )
    is_marked = lambda b: F.exists("marked", lambda m: (m.path == b.path) & (m.text_hash == b.text_hash))
    hit = lambda b: F.col("marked").isNotNull() & is_marked(b)
    kept = F.filter("blocks", lambda b: (b.role == 1) | (b.role == 0) & ~hit(b) | (b.role == 3) & ~b.links & hit(b))
    # A page of which nothing is left keeps its plain blocks, or else those of ambiguous names.
    left = F.coalesce(*[
        F.when(F.size(column) > 0, column)
        for column in (kept, F.filter("blocks", lambda b: b.role == 0), F.filter("blocks", lambda b: ~b.links))
    ], F.filter("blocks", lambda b: b.role == 1))
    return (
        whole.select("key", "id", "url", F.transform("blocks", lambda b: F.struct(
            b.path, b.text_hash, b.role, b.links, b.text)).alias("blocks"))
        .join(marked, "key", "left")
        .select("id", "url", F.array_join(F.transform(left, lambda b: b.text), " ").alias("text"))
    )
