import random
import time

from venuekit.llm import html as H


def text_of(page):
    return " ".join(t for t, _ in H.page_parts(page)[0])


def test_article_without_everything_else():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>x";</script></head>
    <body class="has-sidebar"><nav><ul><li><a>Home</a></li></ul></nav><header><h1>Site</h1></header><!-- ad <p>no</p> -->
    <div class="ad">Buy</div><article><h1>Title &amp; more</h1><p>One <b>bo</b>ld&nbsp;word<br>next
      line<p>Two &lt;b&gt; &#233;&#x41; &copy<ul><li>x<li>y</ul><aside>Also</aside><form><input value=1>Name</form>
    <div id="comments"><p>First!</p></div><figure><img alt="z"><figcaption>Cap</figcaption></figure></article>
    <div class="cookie-notice">We use</div><footer>&copy; us</footer></body></html>"""
    assert text_of(page) == "Title & more One bold word next line Two <b> éA © x y Cap"


def test_odd_markup():
    assert text_of("") == "" and text_of("plain &amp; simple") == "plain & simple"
    assert text_of("<article>a<article>b</article>c</article><article>d") == "a b c d"
    assert text_of("<main><p>m</p></main><p>out</p>") == "m"
    assert text_of('<p a="x>y" b=\'<\'>in</p></div></p><p>1 < 2 and <3') == "in 1 < 2 and <3"
    assert text_of("<p>cut <b") == "cut" and text_of("<script>never ends <p>x") == ""
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text_of("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>") == "yes"
    assert text_of("<article><table><tr><td>1<td>2<tr><td>3</table></article>") == "1 2 3"


def test_wrappers_with_telling_names_keep_their_article():
    for page in (
        '<div class="content-sidebar-wrap"><main><article><p>kept</p></article></main></div>',
        '<div class="page no-sidebar"><article><p>kept</p></article></div>',
        '<div class="widget"><article><p>kept</p></article></div>',
        '<form id="form1"><div class="sidebar">x</div><p>kept</p></form>',
        '<div class="modal"><p>kept</p></div><div>.</div>'.replace("<div>.</div>", ""),
        '<header><article><p>kept</p></article></header>',
    ):
        assert text_of(page) == "kept", page
    inside = '<article><section id="related-work"><p>one</p></section><p class="ad-hoc">two</p><h2 id="search">three</h2></article>'
    assert text_of(inside) == "one two three"
    assert text_of('<article>a<div class="site-footer">x</div><div class="cookieNotice">y</div><p>b</p></article>') == "a b"
    assert text_of('<div class="related"><article>teaser</article></div><article>story</article>') == "story"
    assert text_of('<div id="comments"><article class="comment">first!</article></div><main>story</main>') == "story"
    assert text_of('<article hidden>no</article><p>yes</p>') == "yes"


def test_broken_pages_take_no_longer():
    for page in ("<a " * 300_000 + '"', '<a ">" ' * 150_000, "<p>x" * 100_000, "<" * 500_000, "<!-- " * 200_000, "</b " * 200_000, "<b '" * 200_001):
        start = time.perf_counter()
        H.parse(page)
        assert time.perf_counter() - start < 3, page[:20]
    assert text_of('<p>before</p><a href="x>link</a> <b title="y">after</b>') == "before link after"
    assert text_of('<p title="a>b">in</p>') == "in"


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'y' as text").repartition(3)


def test_host_template_goes(spark):
    site = "<html><body><div><ul><li>Home<li>News</ul></div><div>{}</div><div>All rights {}</div></body></html>"
    rows = [(i, f"https://User@Ex.org:80/{i}", site.format(f"<p>story {i} " + "word " * 30 + "</p><p>same end</p>", "kept")) for i in range(10)]
    rows += [(20, "https://other.org/1", site.format("<p>lone page</p>", "kept")), (21, None, site.format("<p>no host</p>", "kept")), (22, "https://ex.org/x", None)]
    got = {r.page_id: r.text for r in H.main_text(pages_of(spark, rows)).collect()}
    for i in range(10):
        assert got[i] == f"story {i} " + " ".join(["word"] * 30)
    assert got[20] == "Home News lone page All rights kept" and got[21] == "Home News no host All rights kept" and got[22] == ""


def test_article_paragraphs_stay_though_they_recur(spark):
    page = "<article><p>shared line</p><p>own {}</p><div>Subscribe now</div></article>"
    rows = [(i, "http://a.b/", page.format(i)) for i in range(6)]
    assert {r.text for r in H.main_text(pages_of(spark, rows)).collect()} == {f"shared line own {i}" for i in range(6)}


def test_copies_repeats_and_no_pages(spark):
    page = "<body><div><p>the whole story in one place</p></div></body>"
    rows = [(i // 2, "http://a.b/same", page) for i in range(12)]
    got = H.main_text(pages_of(spark, rows)).collect()
    assert len(got) == 12 and {r.text for r in got} == {"the whole story in one place"}
    assert H.main_text(pages_of(spark, rows).limit(0)).count() == 0


def test_rotating_notices_go_whatever_the_size_of_the_host(spark):
    page = "<body><div>notice number {}</div><div><p>story {} of its own</p></div></body>"
    rows = [(i, f"http://a.b/{i}", page.format(i % 15, i)) for i in range(60)]
    got = {r.page_id: r.text for r in H.main_text(pages_of(spark, rows)).collect()}
    assert got == {i: f"story {i} of its own" for i in range(60)}


def test_copies_under_other_urls_count_once(spark):
    page = "<body><script>track({})</script><div>short note</div><div><p>the whole story in one place</p></div></body>"
    rows = [(i, f"http://a.b/{i}", page.format(i)) for i in range(8)]
    assert {r.text for r in H.main_text(pages_of(spark, rows)).collect()} == {"short note the whole story in one place"}


def test_template_goes_from_short_pages_too(spark):
    legal = "<div>All rights belong to their owners and to nobody else on this earth</div>"
    long = "<div><p>story {} " + "word " * 40 + "</p></div>"
    rows = [(i, f"http://a.b/{i}", f"<body>{long.format(i)}{legal}</body>") for i in range(6)]
    rows += [(10, "http://a.b/s", f"<body><div>brief</div>{legal}</body>"), (11, "http://a.b/a", f"<article><p>tiny</p>{legal}</article>")]
    got = {r.page_id: r.text for r in H.main_text(pages_of(spark, rows)).collect()}
    assert got[10] == "brief" and got[11] == "tiny" and all("rights" not in t for t in got.values())


def test_lines_that_recur_here_and_there_stay(spark):
    rows = []
    for i in range(12):
        told = "".join(f"<p>line {i} {j}</p>" for j in range(i + 1))
        rows.append((i, f"http://a.b/{i}", f"<body><div>{told}<h2>Conclusion</h2><p>the same short line</p><p>end {i}</p></div></body>"))
    got = {r.page_id: r.text for r in H.main_text(pages_of(spark, rows)).collect()}
    for i in range(12):
        assert got[i] == " ".join([f"line {i} {j}" for j in range(i + 1)] + ["Conclusion the same short line", f"end {i}"])


def plain_main(pages, least=4):
    """Blocks of each page less those in an element that is on enough pages with different text, counted one by one."""
    parts = {i: H.page_parts(h) for i, _, h in pages}
    host = {i: u.split("/")[2] for i, u, _ in pages}
    on = {}
    for i, (blocks, subtrees) in parts.items():
        for s in subtrees:
            on.setdefault((host[i], s), set()).add(tuple(t for t, _ in blocks))
    return {
        i: " ".join(t for t, around in blocks if not any(len(on.get((host[i], s), ())) >= least for s in around))
        for i, (blocks, _) in parts.items()
    }


def test_template_removal_equals_counting_page_by_page(spark):
    rng = random.Random(10)
    menus = [f"<ul>{''.join(f'<li>item {m} {k}' for k in range(4))}</ul>" for m in range(5)]
    rows = []
    for i in range(90):
        site = rng.randrange(3)
        told = "".join(f"<p>story {i if rng.random() < 0.9 else 'shared'} {j}</p>" for j in range(rng.randint(1, 4)))
        legal = f"<div>legal {site}</div>" if rng.random() < 0.5 else ""
        rows.append((i, f"http://h{site}.org/{i}", f"<body>{rng.choice(menus)}<div><h1>{i}</h1>{told}</div>{legal}</body>"))
    got = {r.page_id: r.text for r in H.main_text(pages_of(spark, rows)).collect()}
    assert got == plain_main(rows) and any("legal" not in t and "item" not in t for t in got.values())


def test_blocks_of_short_articles_are_counted(spark):
    page = "<article><p>n {}</p><div>Subscribe to our letter and never miss a story of ours again</div></article>"
    rows = [(i, f"http://a.b/{i}", page.format(i)) for i in range(5)]
    assert {r.text for r in H.main_text(pages_of(spark, rows)).collect()} == {f"n {i}" for i in range(5)}
