"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: elements, told apart by their path of tags and
classes, and whole text blocks at their path.  For every host, a token's occurrence
vector says how often each of the host's distinct pages has it; pages that agree in all
text that may be the article's are copies and count as one.  Vectors are compared by
their fingerprint (the sum of a page hash times the count), which combines in any order, so a
host with very many pages is aggregated like any other.  Tokens that share a
vector form an equivalence class.  A class of enough pages is valid if it has an element, and
nested in the class of the nearest element that encloses its outermost one.  The root class (of
the page itself) and its descendants are the host's template: text blocks of these classes, within
the class's outermost element, are fixed text, and all else are slots.  So text that some pages
repeat without markup of its own, such as a copied article, is no template.  The article is the text of all slots,
without menus, headers, footers, sidebars, notices, adverts, forms and comments, which elements and roles tell, and, as far as they
differ from page to page, names of classes and ids that consist of such words (a shorter list of them within an article or main element).

Edge cases: null or empty html gives an empty text; pages without a host (null
or odd url) share the host ''; a host with a single page has every element in one
class and no fixed text; unclosed tags and comments reach to the end; repeated rows are
separate pages; of tokens on equally many pages none goes before another, as classes are sets; very long pages are read whole, some hundred
at a time and fewer where they are long; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_as_text, id_restored, materialize

#: A class is valid if that many distinct pages of its host, and that share of them, have its tokens.
LEAST_PAGES = 5
CLASS_SHARE = 0.6
#: Tokens that a task gathers before it passes them on.
FLUSH = 50_000
#: Pages whose texts a task holds at once, and their bytes (a single page may have more).
PAGES = 500
PAGE_BYTES = 8 << 20
#: Templates up to these many hosts and bytes are broadcast; more are joined by host.
MOST_HOSTS = 5_000
MOST_BYTES = 16 << 20

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes")
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body head html option caption tbody td tfoot th thead tr legend summary".split())
ASIDE = frozenset("nav footer aside form menu dialog button select fieldset head svg canvas object audio video search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of names (the parts of class and id attributes between blanks) that tell what is not the article.
NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs "
    "header masthead footer foot sidebar aside rail widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login register search share sharing social comment comments commentlist reply replies respond discussion disqus related recommended recommendations pagination pager toolbar copyright legal disclaimer".split()
)
#: Those that also tell it within an article or main element, where a header, notice or search is the article's own.
IN_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promos nav navbar navigation menu menus breadcrumb breadcrumbs sidebar cookie cookies consent gdpr newsletter subscribe subscription signup "
    "share sharing comment comments commentlist reply replies respond disqus related recommended recommendations pagination pager toolbar".split()
)
#: Words that say where or how big a part is, not what it is.
PLAIN = frozenset("site page main top bottom left right inner outer box block section area list item content body text bar slot unit zone form wrap button links policy thread primary secondary js small large fixed sticky global leaderboard rectangle".split())
#: Words that make a name describe the whole page ("has-sidebar", "page-wrapper").
OF_PAGE = frozenset("has with no without layout wrapper container".split())
#: Words that settle what a name means if they stand last.
HEADS = frozenset("ad ads advert adverts advertisement banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar comment comments commentlist newsletter pagination".split())
#: Of an article or main element, only these names count.
NEVER_ARTICLE = frozenset("comment comments commentlist reply replies ad ads advert adverts promo sponsored related recommended teaser".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}


def parse(source: str) -> list[tuple[tuple, bool, str]]:
    """The text blocks of a page in order: (paths of the enclosing elements, whether one of them is not the article's, text)."""
    out: list[tuple[tuple, bool, str]] = []
    stack: list[tuple[str, str, bool]] = []  # tag, path, excluded
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                # inline elements do not tell blocks apart
                out.append((tuple(path for tag, path, _ in stack if tag in BLOCKS), bool(stack) and stack[-1][2], text))

    def close(index: int) -> None:
        flush()
        del stack[index:]

    at, n = 0, len(source)
    while at < n:
        m = TOKEN.search(source, at)
        if m is None:
            pieces.append(source[at:])
            break
        if m.start() > at:
            pieces.append(source[at : m.start()])
        at = m.end()
        tag = m.group(2) or m.group(5)
        if tag is None:
            continue
        tag, ends, attributes = tag.lower(), m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if ends:
            if tag in BLOCKS or any(t == tag for t, _, _ in stack):
                found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
                if found is not None:
                    inline = tag not in BLOCKS
                    if inline and any(t in BLOCKS for t, _, _ in stack[found + 1 :]):
                        continue  # an inline end tag does not close blocks opened within
                    if inline and not stack[found][2]:
                        del stack[found:]
                    else:
                        close(found)
            continue
        if tag == "br" or tag == "hr" or tag == "wbr":
            pieces.append("" if tag == "wbr" else " ")
            continue
        if tag in RAW:
            if not attributes.endswith("/") or tag == "script":
                end = RAW_END[tag].search(source, at)
                at = end.end() if end else n
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag in BLOCKS:
            flush()
            if tag in CLOSES_P:
                # an open paragraph ends, with the inline elements opened in it
                found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCKS), None)
                if found is not None and stack[found][0] == "p":
                    del stack[found:]
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
                stop = {"li": ("ul", "ol", "menu"), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}.get(tag, ("dl",))
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in same:
                        del stack[i:]
                        break
                    if stack[i][0] in stop:
                        break
        names, excluded = "", bool(stack) and stack[-1][2]
        if attributes:
            for kind, a, b, c in ATTRIBUTE.findall(attributes):
                value, kind = a or b or c, kind.lower()
                if kind == "role":
                    excluded = excluded or value.lower() in ROLES
                else:
                    names += "." + "-".join(w.lower() for w in NAME_WORD.findall(value))
                    if not excluded:
                        bad = NEVER_ARTICLE if tag in ("article", "main") else IN_ARTICLE if any(t in ("article", "main") for t, _, _ in stack) else NOT_ARTICLE
                        excluded = any(names_part(part, bad) for part in value.split())
        if tag in ASIDE:
            excluded = True
        elif tag == "header" and not any(t in ("article", "main") for t, _, _ in stack):
            excluded = True
        elif tag in ("html", "body"):
            excluded = False
        if excluded and not (stack and stack[-1][2]) and tag not in BLOCKS:
            flush()
        stack.append((tag, (stack[-1][1] if stack else "") + "/" + tag.replace(".", "_") + names, excluded))
    flush()
    return out


def names_part(name: str, bad: frozenset) -> bool:
    """Whether a name tells that a part is not the article: all of its words say so, plain ones aside, or the last does and leaves no doubt ("reader-comments", not "promotion-of-health")."""
    words = [w.lower() for w in NAME_WORD.findall(name)]
    telling = [w for w in words if w not in PLAIN and len(w) > 1]
    if not telling or telling[-1] not in bad or not OF_PAGE.isdisjoint(words):
        return False
    return telling[-1] in HEADS or bad.issuperset(telling)


def token(path: str, text: str | None = None) -> int:
    """The 64-bit name of an element's or a text block's role."""
    return xxhash.xxh3_64_intdigest(path if text is None else f"{path}\0{text}") - (1 << 63)


#: The page itself, which encloses all of its elements.
PAGE = token("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def enclosing(path: str, known: dict[str, list[str]]) -> list[str]:
    """The paths of the block elements that a path leads through, its own last."""
    found = known.get(path)
    if found is None:
        parts = path.split("/")[1:]
        found = known[path] = ["/" + "/".join(parts[: i + 1]) for i, part in enumerate(parts) if part.split(".", 1)[0] in BLOCKS]
    return found


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches of at most PAGES rows and PAGE_BYTES of a column (a single page may have more)."""
    for batch in batches:
        each = max(1, int(PAGE_BYTES * len(batch) / max(1, batch.column(column).nbytes)))
        step = min(PAGES, each)
        for low in range(0, len(batch), step):
            yield batch.slice(low, step)


def read(pages: DataFrame) -> DataFrame:
    """(row, page_id, url, host, print, paths, names, texts): the parsed pages, written once. texts has null for excluded blocks, and print is of the others, so copies of an article share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            paths, names, texts, prints = [], [], [], []
            for source in batch.column("html").to_pylist():
                blocks = parse(source or "")
                paths.append([p[-1] if p else "" for p, _, _ in blocks])
                names.append([token(p, t) for p, (_, _, t) in zip(paths[-1], blocks, strict=True)])
                texts.append([None if x else t for _, x, t in blocks])
                prints.append(token(",".join(str(n) for n, t in zip(names[-1], texts[-1], strict=True) if t is not None)))
            kinds = (pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string()))
            made = [pa.array(prints, pa.int64()), *[pa.array(v, k) for v, k in zip((paths, names, texts), kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("page_id", "url", "host")], *made], ["page_id", "url", "host", "print", "paths", "names", "texts"])

    kind = "page_id string, url string, host string, print long, paths array<string>, names array<long>, texts array<string>"
    named = id_as_text(pages.select("page_id", "url", "html"), "page_id").withColumn("host", host_of(F.col("url")))
    return materialize(named.mapInArrow(run, kind).withColumn("row", F.monotonically_increasing_id()), "html-parsed", "zstd")


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, path, place, pages, count, vector): occurrence vectors of all tokens; path is null for text blocks, and '' stands for the page; place names the nearest enclosing element."""
    return vectors(read(pages))


def vectors(parsed: DataFrame) -> DataFrame:
    """The occurrence vectors over the distinct pages of each host: however many pages repeat an article, it is one sample of the template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        known: dict[str, list[str]] = {}

        def flush() -> pa.RecordBatch:
            hosts, tokens = zip(*found, strict=True)
            names = ("path", "place", "pages", "count", "vector")
            kinds = (pa.string(), *[pa.int64()] * 4)
            made = [pa.array(v, k) for v, k in zip(zip(*found.values(), strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(tokens, pa.int64()), *made], ["host", "token", *names])

        for batch in batches:
            for host, page, places, names in zip(*[batch.column(c).to_pylist() for c in ("host", "page", "paths", "names")], strict=True):
                own: dict[int, list] = {PAGE: ["", None, 1]}
                last: list[str] = []
                for place, text in zip(places, names, strict=True):
                    paths = enclosing(place, known)
                    same = next((i for i, (a, b) in enumerate(zip(paths, last)) if a != b), min(len(paths), len(last)))  # noqa: B905
                    if same == len(paths):
                        same = max(0, same - 1)  # another block in an element of the same path
                    above = PAGE
                    for i, path in enumerate(paths):
                        name = token(path)
                        entry = own.setdefault(name, [path, above, 0])
                        entry[2] += i >= same or entry[2] == 0
                        above = name
                    own.setdefault(text, [None, above, 0])[2] += 1
                    last = paths
                for name, (path, above, count) in own.items():
                    entry = found.setdefault((host, name), [path, above, 0, 0, 0])
                    entry[2] += 1
                    entry[3] += count
                    entry[4] = (entry[4] + page * count + (1 << 63)) % (1 << 64) - (1 << 63)
                if len(found) > FLUSH:
                    yield flush()
                    found.clear()
        if found:
            yield flush()

    kind = "host string, token long, path string, place long, pages long, count long, vector long"
    firsts = parsed.groupBy("host", "print").agg(F.min("row").alias("row")).select("row")
    rows = parsed.join(firsts, "row", "left_semi").select("host", F.xxhash64("row").alias("page"), "paths", "names").mapInArrow(run, kind)
    wrapped = F.sum(F.col("vector").cast("decimal(38,0)")) % F.lit(str(1 << 64)).cast("decimal(38,0)")
    # a token names its path and place, so these are part of the key: sums alone can be combined in a hash map
    return rows.groupBy("host", "token", "path", "place").agg(F.sum("pages").alias("pages"), F.sum("count").alias("count"), wrapped.alias("vector"))


def equivalence_classes(found: DataFrame) -> DataFrame:
    """(host, vector, class_pages, tokens, outermost, parent): tokens of a host that share an occurrence vector, nested by the nearest enclosing element in another class.

    outermost is the path of the class's outermost element, null without one. A page with an element has all that enclose it, so
    the classes with an element are nested in each other up to the root class, the one of the page itself.
    """
    sized = valid_tokens(found)
    depth = F.when(F.col("path").isNotNull(), F.length("path"))
    classes = sized.groupBy("host", "vector").agg(F.max("pages").alias("class_pages"), F.count("*").alias("tokens"), F.min_by("path", depth).alias("outermost"), F.min_by("place", depth).alias("above"))
    named = sized.filter("path IS NOT NULL").select(F.col("host").alias("h"), F.col("token").alias("t"), F.col("vector").alias("parent"))
    return classes.join(named, (F.col("host") == F.col("h")) & (F.col("above") == F.col("t")), "left").select("host", "vector", "class_pages", "tokens", "outermost", "parent")


def valid_tokens(found: DataFrame) -> DataFrame:
    """Tokens on at least CLASS_SHARE of their host's distinct pages (a host of a page of n tokens has n / CLASS_SHARE of them at most)."""
    whole = found.filter(F.col("path") == "").select(F.col("host").alias("_h"), F.col("pages").alias("all_pages"))
    # while the hosts are few, a broadcast spares the shuffle of all tokens of a large host to one task
    side = F.broadcast(whole) if whole.count() <= MOST_HOSTS else whole
    return found.join(side, F.col("host") == F.col("_h")).drop("_h").filter(F.col("pages") >= F.lit(CLASS_SHARE) * F.col("all_pages"))


def templates(found: DataFrame) -> DataFrame:
    """(host, fixed): the names of each host's fixed text blocks, those of the root class and the valid classes nested in it."""
    sized = materialize(valid_tokens(found), "html-valid")
    root = (F.col("outermost") == "") | F.col("parent").isNotNull()
    valid = equivalence_classes(found).filter((F.col("class_pages") >= LEAST_PAGES) & F.col("outermost").isNotNull() & root).select(F.col("host").alias("h"), F.col("vector").alias("v"), "outermost")
    places = sized.filter("path IS NOT NULL").select(F.col("host").alias("g"), F.col("token").alias("t"), F.col("path").alias("at"))
    texts = sized.filter("path IS NULL").select("host", "token", "place", "vector")
    texts = texts.join(valid, (F.col("host") == F.col("h")) & (F.col("vector") == F.col("v"))).join(places, (F.col("host") == F.col("g")) & (F.col("place") == F.col("t")))
    # a text of a nested class lies within the class's outermost element
    inside = (F.col("outermost") == "") | (F.col("at") == F.col("outermost")) | F.startswith("at", F.concat("outermost", F.lit("/")))
    return texts.filter(inside).groupBy("host").agg(F.array_sort(F.collect_set("token")).alias("fixed"))


def article(names: list[int], texts: list[str | None], fixed: set[int]) -> str:
    """The text of all slots, the blocks that are neither excluded nor fixed, joined by two line feeds."""
    return "\n\n".join(t for n, t in zip(names, texts, strict=True) if t is not None and n not in fixed)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    parsed = read(pages)
    found = materialize(vectors(parsed), "html-tokens")
    models = materialize(templates(found), "html-templates")
    size = models.agg(F.count("*").alias("n"), F.sum(F.lit(64) + 8 * F.size("fixed")).alias("bytes")).first()
    small = size["n"] <= MOST_HOSTS and (size["bytes"] or 0) <= MOST_BYTES
    models = models.withColumnRenamed("host", "h")
    side = F.broadcast(models) if small else models
    joined = parsed.join(side, F.col("host") == F.col("h"), "left").select("page_id", "url", "names", "texts", "fixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "texts"):
            rows = zip(*[batch.column(c).to_pylist() for c in ("names", "texts", "fixed")], strict=True)
            texts = [article(names, blocks, set(fixed or ())) for names, blocks, fixed in rows]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return id_restored(joined.mapInArrow(run, "page_id string, url string, text string, n_chars long"), pages, "page_id")
