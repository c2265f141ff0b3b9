import html
import re

from llm_rows import SF

from quarry.llm import wrappers

SCHEMA = "page_id long, url string, html string, text string, host string, nodes string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", "h", "n") for i, u, h in rows], SCHEMA).repartition(3)


def texts(spark, rows):
    return {r.page_id: r.text for r in wrappers.extract(pages(spark, rows)).collect()}


def article(page):
    """The article of the generated pages, read off their fixed layout."""
    body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    body = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n", body)))
    lines = (" ".join(html.unescape(x).split()) for x in body.split("\n"))
    return "\n".join(x for x in lines if x)


def test_generated_pages(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    rows = wrappers.extract(df).join(df.select("page_id", "html"), "page_id").collect()
    assert len(rows) == df.count()
    assert all(r.text == article(r.html) and r.n_chars == len(r.text) for r in rows)


def layout(i, body, notice="We use cookies to improve this site"):
    return (f'<html><head><title>T{i}</title><script>var a="<p>no</p>";</script></head><body><header><h2>Site</h2></header>'
            f'<div class="cookie-notice">{notice}</div><ul class="menu"><li><a href=/a{i}>Menu {i}</a></li></ul>'
            f'<div id=wrap><div class="col">{body}</div><p>Always the same line under the text</p></div>'
            f'<div id="comments"><p>Reader {i} says no</p></div><aside>Side {i}</aside><form><p>Mail {i}</p></form>'
            f'<!-- <p>hidden</p> --><footer>Foot {i}</footer></body></html>')


def test_container_without_an_article_and_constant_text(spark):
    rows = [(i, f"http://a.example/{i}", layout(i, f"<h1>Head {i}</h1><p>First &amp; &#233; {i} " + "word " * (20 + i) + "</p>"
             + f"<p>Second <i>part</i>\n {i}<br>end</p>" * (1 + i % 3))) for i in range(8)]
    found = texts(spark, rows)
    for i in range(8):
        expected = [f"Head {i}", " ".join(f"First & é {i} {'word ' * (20 + i)}".split()), *[f"Second part {i} end"] * (1 + i % 3)]
        assert found[i] == "\n".join(expected)


def test_edge_pages(spark):
    long = "<article>" + "".join(f"<p>line {i}</p>" for i in range(4000)) + "</article>"
    rows = [(1, None, None), (2, "nohost", ""), (3, "http://x/", "plain text"), (4, "http://x/", "<p>open <b>bold"),
            (5, "http://y/", long), (6, "http://x/", "<<>> a < b &am &lt;p&gt;"), (7, "http://z/", "<script>unclosed"),
            (7, "http://z/", "<!-- unclosed"), (8, "http://z/", "<article><p>a&nbsp;&nbsp;b</p></article><article class=comment>c</article>")]
    found = texts(spark, rows)
    assert len(wrappers.extract(pages(spark, rows)).collect()) == len(rows)
    assert found[1] == found[2] == found[7] == ""
    assert found[3] == "plain text" and found[4] == "open bold"
    assert found[5] == "\n".join(f"line {i}" for i in range(4000))
    assert found[8] == "a b"
    assert wrappers.extract(pages(spark, [])).count() == 0


def test_wrapper_of_two_pages():
    one, two = (wrappers.folded(wrappers.tokens(x)) for x in (
        "<body><h1>A</h1><ul><li>1</li><li>2</li><li>3</li></ul><p>same</p></body>",
        "<body><h1>B</h1><img><ul><li>4</li><li>5</li></ul><p>same</p></body>"))
    assert wrappers.pattern(wrappers.align(one, two)) == (
        "<body> <h1> #TEXT </h1> (<img>)? <ul> (<li> #TEXT </li>)+ </ul> <p> same </p> </body>")


def test_words_in_a_class_are_no_veto(spark):
    def site(open_, close, inner="", side="<div class=sidebar><p>Side {i}</p></div>"):
        return [(i, "http://{h}.example/%d" % i, f"<html><body><div class=\"site-header\"><p>Site {i}</p></div>{open_}<article>"
                 f"<div class=\"article-header\"><h1>Head {i}</h1></div><p>First {i} {'word ' * (9 + i)}</p>{inner}</article>"
                 f"{side.format(i=i)}{close}<div id=comments><p>Reader {i} {'says ' * 99}</p></div></body></html>") for i in range(4)]

    inner = ("<section id=related-work><h2 id=notice>Related</h2><p>Others</p></section><section id=social-history><p>Past</p></section>"
             "<div class=share-buttons>Share</div><div class=notice>Notice</div><div class=header><h3>Part</h3></div>")
    rows, expected = [], {}
    for h, (open_, close) in enumerate([("", ""), ("<div class='page has-sidebar'>", "</div>"), ("<div id=login>", "</div>"),
                                        ("<div class=content-with-sidebar><div class=hasNav>", "</div></div>")]):
        for i, url, page in site(open_, close, inner):
            rows.append((10 * h + i, url.replace("{h}", f"h{h}"), page))
            expected[10 * h + i] = "\n".join([f"Head {i}", " ".join(f"First {i} {'word ' * (9 + i)}".split()), "Related", "Others", "Past", "Part"])
    assert texts(spark, rows) == expected


def test_comments_and_adverts_inside_the_article_go(spark):
    blocks = ["<section id=comments>{x}</section>", "<div class=user-comment>{x}</div>", "<div class='post-comments'>{x}</div>",
              "<div class=comment-thread>{x}</div>", "<div id=disqus_thread>{x}</div>", "<div class=ad-top>{x}</div>",
              "<div class=google-ad>{x}</div>", "<div class=ad__inner>{x}</div>", "<div class=inline-newsletter>{x}</div>",
              "<div class=commentThread>{x}</div>", "<section class='sponsored story'>{x}</section>"]
    rows, expected = [], {}
    for h, block in enumerate(blocks):
        for i in range(5):
            other = "".join(f"<p>Other {i} {k} {'says ' * 30}</p>" for k in range(3 if "ad" not in block and "letter" not in block else 1))
            other = other if "omment" in block or "disqus" in block else f"<p>Buy {i}</p>"
            rows.append((10 * h + i, f"http://h{h}.example/{i}", f"<body><article><h1>Head {i}</h1><p>First {i} {'word ' * (9 + i)}</p>"
                         f"{block.format(x=other)}<p>Last {i}</p></article></body>"))
            expected[10 * h + i] = "\n".join([f"Head {i}", f"First {i} {'word ' * (9 + i)}".strip(), f"Last {i}"])
    # words that say how a page deals with comments and adverts mark no text
    for h, wrapper in enumerate(["post has-comments", "ad-free", "comments-open content", "page-with-ads"], len(blocks)):
        for i in range(5):
            rows.append((10 * h + i, f"http://h{h}.example/{i}", f"<body><article><h1>Head {i}</h1><div class='{wrapper}'><p>First {i} "
                         f"{'word ' * (9 + i)}</p><h2 id=ads>Part</h2><p>Last {i}</p></div></article></body>"))
            expected[10 * h + i] = "\n".join([f"Head {i}", f"First {i} {'word ' * (9 + i)}".strip(), "Part", f"Last {i}"])
    assert texts(spark, rows) == expected


def test_a_marked_element_with_most_of_the_text(spark):
    rows = [(i, f"http://a.example/{i}", f"<body><p>Top {i}</p><div class=notice><h1>Head {i}</h1><p>Text {i} {'word ' * (20 + i)}</p></div>"
             f"<div class=sidebar><p>Side {i}</p></div></body>") for i in range(5)]
    rows += [(10 + i, f"http://b.example/{i}", f"<body><div class=text><p>Text {i} {'word ' * 9}</p></div><div class=related-posts>"
              f"<article>Other {i} {'thing ' * 5}</article></div><div class=comments><p>Reader {i} {'says ' * 99}</p></div></body>") for i in range(5)]
    rows += [(20 + i, f"http://c.example/{i}", f"<body>{'<div class=with-sidebar>' if i == 4 else ''}<article>Text {i}</article></body>")
             for i in range(5)]
    found = texts(spark, rows)
    for i in range(5):
        assert found[i] == " ".join(f"Head {i}\tText {i} {'word ' * (20 + i)}".split()).replace(f" Text {i}", f"\nText {i}")
        assert found[10 + i] == " ".join(f"Text {i} {'word ' * 9}".split())
        assert found[20 + i] == f"Text {i}"


def test_text_after_elements_that_are_never_closed(spark):
    cases = ["<p>One <svg class=\"icon\"/> two</p><p>Three</p><svg><path d=m/><text>no</text></svg><p>Four</p>",
             "<p>One two</p><div><object data=x>no</div><p>Three</p><p>Four</p>",
             "<p>One two</p><canvas><p>Three</p><p>Four</p>",
             "<p>One two</p><div><select><option>no<option>no</div><p>Three</p><select><option>no</option></select><p>Four</p>",
             "<p>One two</p><svg><path><p>Three <svg><title>no</title><foreignObject><p>no</p></foreignObject></svg></p><math/><p>Four</p>",
             "<p>One two</p><noscript><p>no</p><object><div>no</div></object></noscript><iframe src=x /><p>Three</p><template/><p>Four</p>",
             "<p>One two</p><p>Three</p><p>Four</p><textarea><p>no"]
    rows = [(i, f"http://h{i}.example/", f"<body><article>{x}</article><footer>Foot</footer></body>") for i, x in enumerate(cases)]
    assert texts(spark, rows) == dict.fromkeys(range(len(cases)), "One two\nThree\nFour")


def test_many_elements_that_are_never_closed_take_linear_time():
    page = "<article>" + "<p>text <svg class=icon> <object>" * 20000
    assert sum(t.label == "#" for t in wrappers.tokens(page)) == 20000
