"""Main text of HTML pages: structure first, then a host suffix array for what structure leaves open.

A page's markup splits it into text blocks. Blocks inside menus, headers, footers, sidebars, notices, adverts,
forms, comments and the like are out; blocks inside the page's article (or main) element are its text, all of it, as
passages that articles share belong to each of them. Pages without such an element have open blocks only, and for them
the host decides: the token streams of all the host's pages (without the articles) are laid end to end, and their
suffixes sorted by their first DEPTH tokens. A group of suffixes with those tokens in common that begin in two
distinct pages is a repeated substring of that length or more; longer repeats are chains of such suffixes, so the tokens
that repeats of DEPTH or more tokens cover are known without sorting any further. They leave the open blocks; the
unique runs between them stay.

The groups are aggregates (smallest and largest page), so neither a hot host nor a footer on all its pages
meets in one task; only pages that have open blocks look their suffixes up again. Pages with the same token stream
are one page to the array: a copied page keeps its text. A page is read once from its beginning to its end, however
broken its markup is.

Defined cases: null or empty html gives the empty text; a null url makes the page a host of its own; open
blocks shorter than DEPTH tokens are kept unless their whole text is such a block elsewhere on the host; rows of
one url are extracted each, as are repeated rows; very long pages are read whole; an empty table gives an empty result;
of other columns none is read, and text and n_chars are the only ones added.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialize, ship

#: Tokens by which suffixes are sorted: the least length of a repeat.
DEPTH = 8
# Elements and names by which pages mark what is not their main text.
OUT = frozenset(
    "head title script style noscript template iframe object svg canvas nav header footer aside form button select textarea dialog menu audio video".split()
)
RAW = {x: re.compile(rf"</{x}\s*>", re.I | re.A) for x in "script style noscript template textarea title iframe svg".split()}
BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre section article main header footer nav aside form figure figcaption address details summary fieldset hr center dialog menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CORE = frozenset(("article", "main"))
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations trending comment comments disqus replies respond widget toolbar pagination pager".split()
)
#: What is never part of a text, whatever element it marks: adverts, calls to act and readers' comments.
HARD = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr newsletter subscribe share sharing comment comments disqus".split())
#: Words that make compounds with the last: ad-slot, user-comments.
HARD_WITH = frozenset("count inline label native post reader readers slot text thread user users zone".split())
#: Words that make compounds with those: cookie-bar, related-posts.
WITH = frozenset("area articles bar block box button buttons container content footer form global group inner item items left links list main message page panel posts right section site top unit widget wrap wrapper".split())
#: Elements of running text: their class says how they look, not what they are.
TEXT = frozenset("p li td th dt dd h1 h2 h3 h4 h5 h6 blockquote pre span b i em strong a code q u s small sub sup mark".split())
#: Elements whose end may be left out: which they end.
ENDS = {x: frozenset(y.split()) for x, y in (("li", "li"), ("dt", "dt dd"), ("dd", "dt dd"), ("td", "td th"), ("th", "td th"), ("tr", "td th tr"))}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_NAME_OF = re.compile(r"(/?)([a-zA-Z][\w:-]*+)")
_REST = re.compile(r"""((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-hidden|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_PARTS = re.compile(r"[_-]+")


def _tags(page: str):
    """What stands between the texts of a page: where it begins and ends and, of a tag, whether it closes, its name
    and its attributes. Every search that fails is the last of its kind, so the page is read in linear time."""
    at, quoted = page.find("<"), True
    while at >= 0:
        if page.startswith("<!--", at) or page.startswith("<![CDATA[", at):
            mark = "-->" if page[at + 2] == "-" else "]]>"
            end = page.find(mark, at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, None
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1
            if not end:
                return
            yield at, end, None
        elif name := _NAME_OF.match(page, at + 1):
            rest = _REST.match(page, name.end()) if quoted else None
            if rest:
                end, attributes = rest.end(), rest[1]
            else:  # quotes that do not end: from here on none are trusted
                quoted = False
                end = page.find(">", name.end()) + 1
                if not end:
                    return
                attributes = page[name.end() : end - 1]
            tag = name[2].lower()
            if not name[1] and tag in RAW:
                close = RAW[tag].search(page, end)
                end = close.end() if close else len(page)
                yield at, end, None
            else:
                yield at, end, (name[1], tag, attributes)
        else:
            end = at + 1
        at = page.find("<", end)


def _named_out(names: str, running: bool) -> bool:
    """Whether class names or an id say that an element is out; of running text only the plainest do."""
    for name in names.split():
        parts = [x for x in _PARTS.split(name) if x]
        hard = not HARD.isdisjoint(parts)
        if hard and all(x in NAMES or x in WITH or x in HARD_WITH or x.isdigit() for x in parts):
            return True
        if not running and not NAMES.isdisjoint(parts) and all(x in NAMES or x in WITH for x in parts):
            return True
    return False


def _marks(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is out by its attributes, and whether they make it the article."""
    out = core = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            out |= _named_out(value, tag in TEXT)
        elif name == "role":
            out |= value in ROLES
            core |= value in CORE
        elif name == "itemprop":
            core |= value == "articlebody"
        elif name == "aria-hidden":
            out |= value == "true"
        elif name == "hidden":
            out = True
        elif "display:none" in value.replace(" ", ""):
            out = True
    return out, core


def blocks_of(page: str | None) -> tuple[list[str], list[str], list[str]]:
    """The texts of a page's article blocks, of its open blocks and of its blocks that are out. Where a page has a main
    element with text, articles beside it are not its text. An article that its class names as a comment or an advert is none."""
    found: tuple[list[str], list[str], list[str]] = ([], [], [])
    beside: list[bool] = []  # of each article block, whether it lies outside a main element
    page = page or ""
    stack: list[tuple[str, bool, int]] = []  # containers: name, out, in an article (1) or main element (2)
    out, core = False, 0
    run: list[str] = []
    at = 0

    def flush():
        text = " ".join(html.unescape("".join(run)).split()) if run else ""
        run.clear()
        if text:
            found[2 if out else 0 if core else 1].append(text)
            if core and not out:
                beside.append(core < 2)

    for start, end, found_tag in _tags(page):
        if start > at:
            run.append(page[at:start])
        at = end
        if not found_tag:
            continue
        close, tag, attributes = found_tag
        if tag == "br":
            run.append(" ")
            continue
        block = tag in BLOCKS
        if block:
            flush()
            if stack and stack[-1][0] == "p" and (not close or tag != "p"):  # a block ends an open paragraph
                stack.pop()
                out, core = stack[-1][1:] if stack else (False, 0)
            while not close and stack and stack[-1][0] in ENDS.get(tag, ()):
                stack.pop()
                out, core = stack[-1][1:] if stack else (False, 0)
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if not block:
                        flush()
                    del stack[i:]
                    out, core = stack[-1][1:] if stack else (False, 0)
                    break
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        is_out, is_core = _marks(tag, attributes) if attributes else (False, False)
        is_main = is_core or tag == "main"
        is_core |= tag in CORE
        is_out = tag in OUT or is_out and not (is_main or tag in ("html", "body"))
        if is_out or is_core or block and tag not in ("p", "li", "td", "th", "tr", "dt", "dd"):
            if is_out and not block:
                flush()
            stack.append((tag, out or is_out, max(core, 2 * is_main, int(is_core))))
            out, core = stack[-1][1:]
    run.append(page[at:])
    flush()
    if all(beside) or not any(beside):
        return found
    return [t for t, b in zip(found[0], beside, strict=True) if not b], found[1], found[2] + [t for t, b in zip(found[0], beside, strict=True) if b]


def _host(url: str) -> Column:
    return F.lower(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def parse(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, host, main (article blocks joined), open and other (blocks)."""
    ship(pages.sparkSession)
    identity = F.coalesce(F.col(url), F.concat(F.lit("id:"), F.coalesce(F.col(page_id).cast("string"), F.lit(""))))
    host = F.when(F.col(url).isNull() | (_host(url) == ""), identity).otherwise(_host(url))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(page).alias("html"))
    schema = rows.drop("html").withColumns({"main": F.lit(""), "open": F.array(F.lit("")), "other": F.array(F.lit(""))}).schema

    def run(batches):
        import pyarrow as pa

        from .bpe import slices

        for batch in batches:
            column = batch.column(3)
            for s in slices(column):
                found = [blocks_of(x) for x in column[s].to_pylist()]
                main = ["\n".join(x[0]) for x in found]
                # Blocks beside an article are not its text.
                opened = [[] if x[0] else x[1] for x in found]
                other = [x[2] + x[1] if x[0] else x[2] for x in found]
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[s] for i in range(3)), pa.array(main, pa.string()), *(pa.array(x, pa.list_(pa.string())) for x in (opened, other))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _suffixes(block: Column) -> Column:
    """The hashes of a block's suffixes by their first DEPTH tokens; a shorter block is one suffix."""
    return let(
        F.split(block, " "),
        lambda t: F.when(F.size(t) <= DEPTH, F.array(F.xxhash64(block))).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(t) - DEPTH + 1), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(t, i, F.lit(DEPTH)))))
        ),
    )


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row of pages: page_id, url, text and n_chars."""
    parsed = materialize(parse(pages, page_id, url, page), "parsed")
    streams = parsed.select("host", F.xxhash64("open", "other").alias("page"), F.explode(F.concat("open", "other")).alias("block"))
    repeated = (
        streams.select("host", "page", F.explode(_suffixes(F.col("block"))).alias("h"))
        .groupBy("host", "h").agg(F.min("page").alias("lo"), F.max("page").alias("hi")).where("lo <> hi").select("host", "h")
    )
    # Blocks are known by their host and text here: equal blocks have equal fates.
    blocks = parsed.select("host", F.explode("open").alias("block")).distinct()
    looked = blocks.select("host", "block", F.posexplode(_suffixes(F.col("block"))).alias("pos", "h"))
    hits = looked.join(repeated, ["host", "h"], "left_semi").groupBy("host", "block").agg(F.sort_array(F.collect_list("pos")).alias("at"))
    cut = hits.select("host", "block", _unique_runs(F.col("block"), F.col("at")).alias("left"))
    opened = parsed.where(F.size("open") > 0).withColumn("row", F.monotonically_increasing_id())
    opened = materialize(opened.select("row", "page_id", "url", "host", F.posexplode_outer("open").alias("pos", "block")), "open")
    kept = opened.join(cut, ["host", "block"], "left").withColumn("said", F.coalesce("left", "block"))
    texts = kept.groupBy("row").agg(
        F.first("page_id").alias("page_id"), F.first("url").alias("url"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("said") != "", F.struct("pos", "said")))), lambda x: x["said"]), "\n").alias("text"),
    ).drop("row")
    plain = parsed.where(F.size("open") == 0).select("page_id", "url", F.col("main").alias("text"))
    out = plain.unionByName(texts)
    return out.select(F.col("page_id").alias(page_id), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))


def _unique_runs(block: Column, at: Column) -> Column:
    """A block's tokens that none of the repeats covers which begin at the places at (ascending)."""

    def of(t: Column) -> Column:
        # From the end of one repeat to the beginning of the next; before the first and after the last too.
        ends = F.concat(F.array(F.lit(0)), F.transform(at, lambda p: F.least(p + F.lit(DEPTH), F.size(t))))
        begins = F.concat(at, F.array(F.size(t)))
        runs = F.filter(F.zip_with(ends, begins, lambda e, b: F.when(b > e, F.slice(t, e + 1, b - e))), lambda r: r.isNotNull())
        return F.array_join(F.flatten(runs), " ")

    return let(F.split(block, " "), of)
