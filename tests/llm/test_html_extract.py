import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.llm import html_extract
from tallyforge.llm.html_extract import LEAST_PAGES, Template, deduced_classes, extract_main_text, host_of, main_text, parse, role_id, token_parts
from tests.llm.conftest import prose

RICH = (
    '<html><head><title>t</title><style>p{{}}</style></head><body><header><a>Site</a></header><nav><ul><li>Home<li>News</ul></nav>'
    '<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><main><article><h1>T{0} &amp; x</h1><p>One <b>two</b>{0}<br>three</p>'
    '<ul><li>a{0}</li><li>b</li></ul><form><input><label>mail</label></form><aside>rel</aside><table><tr><td>c1<td>c2</table>'
    '<section class="comments"><article>reader says</article></section></article></main><footer>f</footer><script>var t="</p>";x</script></body></html>'
)
PLAIN = "<body><div class=top><a>Home</a> <a>About</a></div><div class=x9><h2>Title {0}</h2><p>body text number {0} goes on and on</p></div><div class=z>Accept all</div></body>"
PLAIN_TEXT = "Title {0}\nbody text number {0} goes on and on"
SCHEMA = "page_id long, url string, html string"


def frame(spark, hosts):
    rows = [(i, f"https://{h}/{i}", html) for h, pages in hosts.items() for i, html in enumerate(pages)]
    return spark.createDataFrame(rows, SCHEMA)


def extract(spark, hosts):
    found = {(r.url, r.page_id): r.text for r in extract_main_text(frame(spark, hosts)).collect()}
    return {h: [found[f"https://{h}/{i}", i] for i in range(len(pages))] for h, pages in hosts.items()}


def alone(html):
    return main_text(parse(html), Template())


@pytest.fixture(scope="module")
def got(spark):
    """Hosts of several kinds, extracted together: they don't touch each other."""
    blog = "<body><div class=top>Home</div><div class=blog><h2>T{0}</h2>lead {0}<section><p>long text of the blog {0}</p></section></div></body>"
    docs = "<body><div class=top>Home</div><div class=docs><h2>D{0}</h2><p>docs {0}</p></div></body>"
    shared = "<body><div class=x><h2>T{0}</h2><section><p>long text {0}</p></section></div><div class=y><h3>More</h3><p>link {0}</p></div></body>"
    copies = [f"<body><div class=top>Home</div><p>shared by copies</p><p>own {i}</p></body>" for i in range(9)]
    odd = ["", "<p>broken", PLAIN.format(99).replace(" <a>About</a>", ""), None]
    notice = "<article><p>{0}</p><div class=k>Send it on to your friends</div><p>{1}</p></article>"
    return extract(spark, {
        "rich": [RICH.format(i) for i in range(9)], "one": [RICH.format(7)], "plain": [PLAIN.format(i) for i in range(12)] + odd,
        "same": ["<article><p>the same words</p><p>1</p></article>"] * 20, "near": [f"<article><p>{prose(1, 40)}</p><p>{i}</p></article>" for i in range(20)],
        "two": ["<div class=x><p>first one</p></div>", "<div class=x9><p>second</p></div>"], "layouts": [blog.format(i) for i in range(20)] + [docs.format(i) for i in range(12)],
        "branch": [shared.format(i) for i in range(20)], "mixed": [PLAIN.format(i) for i in range(24)] + copies,
        "notice": [notice.format(prose(i, 30), prose(50 + i, 30)) for i in range(20)], "body": [PLAIN.format(i).replace("<body>", "<body class='single post'>") for i in range(12)],
    })


def test_article(got):
    want = "T{0} & x\nOne two{0} three\na{0}\nb\nc1\nc2"
    assert got["rich"] == [want.format(i) for i in range(9)] and got["one"] == [want.format(7)]


def test_template_without_an_article_element(got):
    assert got["plain"] == [PLAIN_TEXT.format(i) for i in range(12)] + ["", "broken", PLAIN_TEXT.format(99), ""]
    assert got["body"] == [PLAIN_TEXT.format(i) for i in range(12)]  # an article word on the body marks no article
    assert got["two"] == ["first one", "second"]


def test_text_that_copies_share_stays_and_notices_go(got):
    assert set(got["same"]) == {"the same words\n1"}
    assert got["near"] == [f"{prose(1, 40)}\n{i}" for i in range(20)]
    assert got["notice"] == [f"{prose(i, 30)}\n{prose(50 + i, 30)}" for i in range(20)]
    assert got["mixed"][-1] == "shared by copies\nown 8" and got["mixed"][3] == PLAIN_TEXT.format(3)


def test_no_layout_and_no_part_of_the_article_is_lost(got):
    assert got["layouts"][3] == "T3\nlead 3\nlong text of the blog 3" and got["layouts"][25] == "D5\ndocs 5"
    assert got["branch"][4] == "T4\nlong text 4"


def test_it_is_the_template_that_decides(spark, monkeypatch):
    """The same pages without templates: their frame comes out as text."""
    hosts = {"p": [PLAIN.format(i) for i in range(12)]}
    with_it = extract(spark, hosts)["p"]
    monkeypatch.setattr(html_extract, "deduce_templates", lambda rows, named: rows.sparkSession.createDataFrame([], "host string, template string, votes string, weight long"))
    without = extract(spark, hosts)["p"]
    assert all("Accept all" in x for x in without) and not any("Accept all" in x for x in with_it)


SF = Path("/root/testdata/sf0.1/pages.parquet")


@pytest.mark.skipif(not SF.exists(), reason="no test data")
def test_slots_alone_find_the_article_on_the_given_pages(spark, monkeypatch):
    """Without anything that elements call themselves the texts stay, and without the template they don't."""
    pages = spark.read.parquet(str(SF))
    texts = lambda **how: {r.page_id: r.text for r in extract_main_text(pages, **how).collect()}
    whole, slots = texts(), texts(named=False)
    assert sum(whole[k] == slots[k] for k in whole) >= 0.99 * len(whole)
    monkeypatch.setattr(html_extract, "deduce_templates", lambda rows, named: rows.sparkSession.createDataFrame([], "host string, template string, votes string, weight long"))
    bare = texts(named=False)
    assert sum(whole[k] == bare[k] for k in whole) <= 0.01 * len(whole)


def corpus(n=60):
    """Three hosts whose pages have no article element and no telling class: (html, main text)."""
    r, out = random.Random(4), {}
    for h in range(3):
        menu = "".join(f"<li><a href=/{k}>{prose(h * 10 + k, 2)}</a></li>" for k in range(6))
        pages = []
        for i in range(n):
            body = [prose(1000 * h + 10 * i + k, r.randrange(5, 60)) for k in range(r.randrange(1, 6))]
            title, stamp = prose(77 * h + i + 5000, 6), f"{prose(i + 9000, 1)} wrote this"
            side = "".join(f"<li><a href=/x>{prose(r.randrange(10**6), 4)}</a></li>" for _ in range(5))
            html = [
                f"<body><div class=q1><ul>{menu}</ul></div><div class=q2><h2>{title}</h2>{''.join(f'<p>{b}</p>' for b in body)}</div><div class=q3>All rights {h} kept here</div></body>",
                f"<body><table><tr><td class=l><b>Choose</b><ul>{side}</ul></td><td class=r><h3>{title}</h3><div>{'</div><div>'.join(body)}</div></td></tr></table><p class=w>Prices with tax {h}</p></body>",
                f"<body><div class=a0><div class=a1><h1>{title}</h1><div class=a2>{''.join(f'<p>{b}</p>' for b in body)}</div></div><div class=a3><h4>See too</h4><ul>{side}</ul><p>{stamp}</p></div></div></body>",
            ][h]
            pages.append((html, "\n".join([title, *body])))
        out[f"corpus{h}"] = pages
    return out


def test_precision_and_recall_without_article_elements(spark):
    made = corpus()
    found = extract(spark, {h: [html for html, _ in pages] for h, pages in made.items()})
    right = said = true = 0
    for h, pages in made.items():
        for (_, want), text in zip(pages, found[h]):
            a, b = Counter(text.split()), Counter(want.split())
            right, said, true = right + (a & b).total(), said + a.total(), true + b.total()
    assert right / said >= 0.99 and right / true >= 0.99


def test_a_page_does_not_depend_on_how_rows_are_dealt_or_on_other_hosts(spark):
    few = {"p": [PLAIN.format(i) for i in range(12)]}
    many = few | {f"h{i}": [RICH.format(i)] * (i % 7) for i in range(60)}
    a = sorted((r.url, r.text) for r in extract_main_text(frame(spark, few).repartition(7)).collect())
    b = sorted((r.url, r.text) for r in extract_main_text(frame(spark, many).coalesce(1)).collect() if r.url.startswith("https://p/"))
    assert a == b


def test_classes_against_explicit_occurrence_vectors(spark):
    pages = [PLAIN.format(i) for i in range(9)] + [RICH.format(i) for i in range(6)] + [PLAIN.format(3) * 2, "", None]
    rows = frame(spark, {"v": pages}).select(host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("seed"), "html")
    parts = rows.repartition(5).mapInPandas(token_parts, "host string, role long, is_text boolean, pages long, a long, b long, most long")
    got = {frozenset([*r.roles, *r.texts]) for r in deduced_classes(parts).collect()}
    counts = [Counter((t.role, t.text is not None) for t in parse(h or "").tokens) for h in pages]
    vectors = defaultdict(list)
    for token in {k for c in counts for k in c}:
        vectors[tuple(c[token] for c in counts)].append(token)
    filled = sum(any(is_text for _, is_text in c) for c in counts)
    want = set()
    for vector, tokens in vectors.items():
        support = sum(n > 0 for n in vector)
        tags = [role for role, is_text in tokens if not is_text]
        texts = [role for role, is_text in tokens if is_text] if tags or support >= 0.8 * filled else []
        if support >= LEAST_PAGES and (tags or texts):
            want.add(frozenset(map(role_id, tags + texts)))
    assert got == want and len(got) >= 3


@pytest.mark.parametrize("html,want", [
    ("", ""), ("<<<>", "<<<>"), ("<p>a<p>b", "a\nb"), ("<article>x", "x"), ("<article><p>a &eacute;&#233;&nbsp; b</article>", "a éé b"), ("<!-- <p>no -->yes", "yes"),
    ("<article><p>a <script>if(a<b){}</script>b</article>", "a b"), ("<nav>no<article><p>q</article>", ""), ("</div></p>text", "text"), ("<article hidden>no</article>", ""),
    ("<p>a <a>link<p>b", "a link\nb"), ("<p>a<b>&#1;</b>b", "a b"),
])
def test_odd_markup(html, want):
    assert alone(html) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!- apdivhrtcle=\"'&;x\n", max_size=80))
def test_never_fails(html):
    alone(html)


def test_operator(spark, monkeypatch):
    rows = [(i, f"https://www.hot.example/{i}" if i % 3 else f"http://h{i}.example/", RICH.format(i)) for i in range(900)]
    rows += [(None, None, None), (None, "u", "<p>z"), (1, "https://a/", ""), (2**60 + 1, "x", "<p>big"), (5000, "https://long/", "<article>" + "<p>long " * 50_000)]
    df = spark.createDataFrame([(*r, "clash", "y") for r in rows], SCHEMA + ", host string, text string")
    for limit in (html_extract.BROADCAST_BYTES, 0):  # both ways to bring templates to pages
        monkeypatch.setattr(html_extract, "BROADCAST_BYTES", limit)
        got = extract_main_text(df).collect()
        assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
        by = {r.page_id: r.text for r in got if r.page_id is not None and r.page_id > 2}
        assert by[2**60 + 1] == "big" and all(by[i] == "T{0} & x\nOne two{0} three\na{0}\nb\nc1\nc2".format(i) for i in range(3, 900))
        assert by[5000].count("long") == 50_000
    assert extract_main_text(df.limit(0)).count() == 0
