import html as codec
import itertools
import re

from aeris.llm import html_extract as H

SF = "/root/testdata/sf0.001"
LABELLED = ("<html><head><title>T</title></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav><div>loose words here</div>"
            "<article><h1>Head</h1><p>one two <b>three</b></p><p>four</p></article><footer>foot</footer></body></html>")


def weights():
    return H.RegionWeights.from_counts(H.labelled_counts(LABELLED))


def text_of(page):
    return H.extract(page, weights())[0]


def test_region_equals_the_best_of_all_regions():
    found = list(H.tokens(LABELLED))
    w = weights()

    def score(part):
        return sum(w.words.get(c, w.word) * len(t.split()) if k == "word" else w.tags.get(c, w.tag) if k == "tag" else 0
                   for k, c, t in part)

    best = max(score(found[a:b]) for a, b in itertools.combinations(range(len(found) + 1), 2))
    start, end, top = H.main_region(found, w)
    assert abs(top - best) < 1e-9 and abs(score(found[start:end]) - best) < 1e-9


def test_article_without_the_rest():
    assert text_of(LABELLED) == "Head\n\none two three\n\nfour"
    page = ("<body><header><p>Site</p></header><div class='cookie-notice'><p>We use cookies on this site</p></div><article>"
            "<h1>A &amp; B&nbsp;&#33;</h1><p>x <i>y</i>z<br>w<script>var t='</p><p>no';</script></p><div class=\"ad\">buy <div>now</div>"
            "</div><aside>side</aside><form><p>sign up</p></form><p>l\na\tst &lt;p&gt;</p><section id=comments><article class=comment>"
            "<p>first!</p></article></section></article><footer><p>foot</p></footer>")
    assert text_of(page) == "A & B !\n\nx yz w\n\nl a st <p>"


def test_pages_without_an_article_element():
    page = ("<div class=sidebar><p>a b c d e f g h i j</p></div><div id=content><h2>Title</h2><p>Some words.<p>More words."
            "<ul><li>p1<li>p2</ul></div><div id='footer'><p>c</p></div>")
    assert text_of(page) == "Title\n\nSome words.\n\nMore words.\n\np1\n\np2"


def article(inner):
    return LABELLED.replace("<p>four</p>", inner)


def test_words_in_values_and_other_attributes_name_no_part():
    for inner, want in (('<p title="the hidden valley">kept one</p>', "kept one"), ('<p>see <a href="/hidden-gems">these gems</a></p>', "see these gems"),
                        ('<p>see <a href="/x?class=ad">this</a></p>', "see this"), ('<p>a <span data-role="share">share</span> b</p>', "a share b"),
                        ("<p data-hidden=1 data-class=ad>kept</p>", "kept"), ("<p class=x class=ad>kept</p>", "kept"),
                        ("<p id='a' href=/role=menu>kept</p>", "kept")):
        assert text_of(article(inner)) == "Head\n\none two three\n\n" + want, inner
    for inner in ("<p HIDDEN>no</p>", "<p hidden=''>no</p>", "<div aria-hidden = 'true'>no</div>", "<div\nclass\n=\nad>no</div>", "<p style='display: none'>no</p>"):
        assert text_of(article(inner)) == "Head\n\none two three", inner


def test_adverts_and_comments_in_an_article_whatever_holds_them():
    for label in ("ad-slot", "newsletter-box", "comment-list", "related-posts", "social-links", "ad_container_2", "shareButtons", "cookie-notice-bar"):
        assert text_of(article(f"<div class='{label}'><p>buy now</p></div>")) == "Head\n\none two three", label
    for kept in ("<h2 id='related-work'>Related work</h2>", "<section id='how-search-works'><p>kept</p></section>", "<section id='social-history'><p>kept</p></section>",
                 "<div class='post-content'><p>kept</p></div>", "<div class='list-item'><p>kept</p></div>", "<p id='reply-to-referees'>kept</p>",
                 "<section class='article-section box'><p>kept</p></section>"):
        assert len(text_of(article(kept)).split("\n\n")) == 3, kept


def test_odd_markup():
    assert text_of("") == text_of(None) == text_of("<p></p><!-- x") == text_of("<script>a") == ""
    assert text_of("a < b <3 & c &lt") == "a < b <3 & c <"
    assert text_of("<p title='a>b'>x</p><p title=\"un>y") == "x\n\ny"
    assert text_of("<p>" + "word " * 300_000) == ("word " * 300_000).strip()
    assert text_of("<p class=ad>advert<p>text</p>") == "text"
    assert text_of("<nav><nav>a</nav>b</nav><p>c") == "c"
    assert text_of("<![CDATA[x]]><p hidden>no<p>y") == "x\n\ny"
    assert len(text_of("<b>" * 50_000 + "deep")) == 4


def test_parts_end_where_their_end_tag_is_left_out():
    body = "<h1>Head</h1><p>one two</p>"
    want = "Head\n\none two"
    assert text_of(f"<html><head><title>T</title><body><article>{body}</article>") == want
    assert text_of(f"<head><meta charset=utf-8><script>'</head><p>x'</script><article>{body}</article>") == want
    assert text_of("<head><title>T</title>\nplain words") == "plain words"
    for page in ("<article><ul><li class=share>tell<li>one</ul><p>two</p></article>",
                 "<article><ul><li class=share>tell<b>a</b></ul><p>one</p><p>two</p></article>",
                 "<article><ul><li>one<div class=ad>buy<li>two</ul></article>",
                 "<article><dl><dt class=ad>buy<dd>one<dd class=ad>buy<dt>two</dl></article>",
                 "<article><table><tr><td class=ad>buy<td>one<tr class=ad><td>buy<th>now<tr><th class=ad>buy</table><p>two</article>",
                 "<article><table><tbody class=ad><tr><td>buy<tbody><tr><td>one</table>two</article>",
                 "<main><article><p>one<div class=ad>buy<p>now</article><p>two</p></main>",
                 "<main><article><p>one</p><table class=ad><tr><td>buy</article><p>two</p></main>",
                 "<div><form><p>sign</div><p>one</p><p>two</p>", "<div><svg><path d=1></div><p>one</p><p>two</p>",
                 "<p>one<span class=ad>buy</p><p>two</p>", "<p><b>one</b><select><option>x<option>y</select><p>two</p>",
                 "<ul><li class=ad><ul><li>buy</li><li>now</ul><li>one</ul><p>two"):
        kept = [t.strip() for k, _, t in H.tokens(page) if k == "word" and t.strip()]
        assert kept == ["one", "two"], page
    assert text_of("<div class=ad><b>buy<table><tr><td>a</div>now</table></div><p>c") == "c"


def test_articles_are_whole_whatever_stands_outside():
    """Wrapper divs, lists and tables stand mostly outside of articles; an article that has some keeps all of its text."""
    loose = "<ul>" + "<li>out side" * 20 + "</ul><table><tr><td>cell</table>"
    train = [f"<div id=page><div>top</div>{loose}<article><h1>Head</h1><p>{'one two ' * 30}</p></article>{loose}</div>"] * 20
    train.append(f"<div>{loose}<article><p>one<ul><li>a</ul><div>figure</div><table><tr><td>x</table></article></div>")
    counts = sum((H.labelled_counts(p) for p in train), start=H.Counter())
    w = H.RegionWeights.from_counts(counts)
    inner = ("<h1>Head</h1><p>one two three</p><ul><li>a b<li>c</ul><p>four</p><div><div>figure</div></div><table><tr><td>x<td>y z"
             "</table><p>five six</p><div class=ad>buy</div><p>end</p>")
    want = "Head\n\none two three\n\na b\n\nc\n\nfour\n\nfigure\n\nx y z\n\nfive six\n\nend"
    for page in (f"<div id=page><div>some loose words</div>{loose}<article>{inner}</article>{loose}</div>",
                 f"<div><div><div><main>{inner}</main></div></div>{loose}</div>",
                 f"<body><div><div>top</div>{loose}<div id=content>{inner.replace('three', 'three' + ' more' * 40)}</div>{loose}</div>"):
        assert H.extract(page, w)[0].replace(" more", "") == want
    two = "<main><article><p>" + "a " * 30 + "</article><article><p>" + "b " * 20 + "</article></main>"
    assert text_of(two).split() == ["a"] * 30 + ["b"] * 20
    assert H.extract("<div>" * 20_000 + "deep", w)[0] == "deep"


def test_slugs_and_wrappers_are_no_parts():
    for name, label in (("h2", "id=related-work"), ("h2", "id=how-search-works"), ("section", "id=discussion"), ("h3", "class=related"),
                        ("section", "id=social-history"), ("p", "id=reply-to-referees"), ("div", "class=search-engines")):
        assert text_of(f"<article><p>one</p><{name} {label}>two</{name}><p>three</article>") == "one\n\ntwo\n\nthree", label
    for label in ("class=ad", "class='cookie-notice x'", "id=comments", "role=search"):
        assert text_of(f"<article><p>one</p><div {label}>two</div><p>three</article>") == "one\n\nthree", label
    for label in ("class='layout sidebar-left'", "id=page-with-ads-sidebar", "class=header"):
        for name in ("article", "main"):
            page = (f"<body><div class=sidebar><article class=card>card</article>side</div><div {label}><div {label}><div class=ad>buy</div>"
                    f"<{name}><p>one two</p></{name}><div class=related><article>other</article></div></div></div>")
            assert text_of(page) == "one two", page
    assert text_of("<article id=how-search-works class=post>one</article>") == "one"
    assert text_of("<div id=a><h2 id=related-work>One</h2><p id=reply-to-referees>two</p><ul id=site-nav><li>x</ul></div>") == "One\n\ntwo"
    assert text_of("<main><section id=discussion>one</section><section class=discussion>x</section></main>") == "one"
    assert text_of("<div class=sidebar>" * 5000 + "<article>deep" + "</div>" * 5000) == "deep"


def test_table_edge_rows(spark):
    rows = [(1, "u", LABELLED), (1, "u", LABELLED), (2, None, None), (None, "v", ""), (3, "w", "<p>q</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text", "1 AS n_chars")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in H.extract_pages(df, H.fit(df)).collect()]
    body = "Head\n\none two three\n\nfour"
    assert sorted(got, key=str) == sorted([(1, "u", body, len(body))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "q", 1)], key=str)
    assert H.extract_pages(df.limit(0), H.fit(df.limit(0))).count() == 0


def test_query_against_the_labelled_articles(spark):
    for r in H.op10_html_extract(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet"), "page_id").collect():
        inner = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        parts = (codec.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))) for p in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(x for x in (" ".join(p.split()) for p in parts) if x) and r.n_chars == len(r.text)
