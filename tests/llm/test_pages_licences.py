"""What is a page's text by its structure, over generated pages; and licences against brute force."""

import math
import random
import re

import pytest

from tessera.llm import html_text, licences

DOCS = "doc_id long, text string, license string"


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article><p>Body</p><article class="comment"><p>no</p></article><p>More</p></article>', "Body\nMore"),
        ('<article><p>A</p><p class="advert">buy<p>B</p><ul><li>x<li class="share">s<li>y</ul></article>', "A\nB\nx\ny"),
        ('<article>a <span class="ad">z</span><div class="ad-slot">q</div><div class="post-ad">r</div><div id="disqus_thread">c</div><div class="user-comments">d</div></article>', "a"),
        ("<article>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</article>", "Let x=1 be"),
        ("<main><h1>T</h1><p>M</p></main><article>teaser</article>", "T\nM"),
        ("<article>only</article><main></main>", "only"),
        ('<div class="comments"><article>c</article></div><article class="post"><div class="post-header"><h1>T</h1></div><p class="notice">n</p></article>', "T\nn"),
        ("<article><table><tr><td>a<td class=ad>b<td>c<tr><td>d</table></article>", "a\nc\nd"),
        ("<article><dl><dt>t<dd class=sponsored>s<dt>u<dd>v</dl></article>", "t\nu\nv"),
    ],
)
def test_structure(page, text):
    assert "\n".join(html_text.blocks_of(page)[0]) == text


def test_generated_pages(spark):
    """Pages built of parts that are known to be in or out, in any order and nesting."""
    rng = random.Random(2)
    outs = ["<nav><a>{}</a></nav>", "<aside>{}</aside>", '<div class="ad-slot">{}</div>', '<p class="sponsored">{}</p>', '<section id="comments"><article class="comment"><p>{}</p></article></section>', "<form><p>{}</p></form>", '<div role="navigation">{}</div>', '<ul><li class="share">{}</ul>']
    ins = ["<p>{}", "<p>{}</p>", "<h2>{}</h2>", "<div class=lead>{}</div>", "<ul><li>{}</ul>", "<blockquote><p>{}</p></blockquote>", "<p class=notice>{}</p>"]
    pages, want = [], []
    for i in range(120):
        n, said, body = 0, [], ""
        for _ in range(rng.randint(1, 12)):
            n += 1
            if rng.random() < 0.4:
                body += rng.choice(outs).format(f"out {i} {n}")
            else:
                said.append(f"in {i} {n}")
                body += rng.choice(ins).format(f"in  {i}\n{n}")
        core = rng.choice(["article", "main", 'div itemprop="articleBody"'])
        pages.append(f"<html><body><header>h</header><{core}>{body}</{core.split()[0]}><footer>f</footer></body></html>")
        want.append("\n".join(said))
    rows = spark.createDataFrame([(i, f"http://h/{i}", p, "clash") for i, p in enumerate(pages)], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(rows).collect()}
    assert got == {i: (w, len(w)) for i, w in enumerate(want)}


def words(text):
    return re.sub(r"[^\w\x20\x09-\x0D]+|_", "", text or "").lower().split()


def grams(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(texts, templates):
    """{(doc, license): containment} over windows of twice the template's words, beginning every template's length."""
    found = {}
    for name, t in templates.items():
        n, of = len(words(t)), set(grams(words(t)))
        for i, x in enumerate(texts):
            g = grams(words(x))
            for a in range(0, len(g), n) if of else ():
                c = len(of & set(g[a : a + 2 * n - 4])) / len(of)
                if c >= licences.CONTAINMENT:
                    found[i, name] = max(c, found.get((i, name), 0))
    return found


def test_licences(spark):
    rng, texts = random.Random(4), [None, "", "one two three", "x " * 20_000]
    for _ in range(60):
        filler = lambda: [f"w{rng.randint(0, 50)}" for _ in range(rng.randint(0, 200))]
        notice = words(licences.TEMPLATES[rng.choice(sorted(licences.TEMPLATES))])
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            notice[rng.randrange(len(notice))] = "changed"
        texts.append(" ".join([*filler(), *notice, *filler()]))
    texts += texts[-2:]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], DOCS)
    got = {(r.doc_id, r.license): r.containment for r in licences.scan(df).collect()}
    want = brute(texts, licences.TEMPLATES)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want) and len(want) > 50


def test_licence_cases(spark):
    df = spark.createDataFrame([(0, "may use this file freely for any purpose at all", "x"), (None, "may use this file freely for any purpose at all", "x")], DOCS)
    assert licences.scan(df, {}).count() == 0 and licences.scan(df, {"short": "use this file", "none": ""}).count() == 0
    both = licences.scan(df, {"short": "use this file", "five": "use this file freely for"})
    assert sorted((str(r.doc_id), r.license, r.containment) for r in both.collect()) == [("0", "five", 1.0), ("None", "five", 1.0)]
    assert licences.scan(df.where("false")).count() == 0 and licences.scan(df, {"short": "a b"}).columns == licences.scan(df).columns
