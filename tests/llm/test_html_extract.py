import html
import re
import time

import pytest

from rillwork.llm.common import table
from rillwork.llm.html_extract import blocks, host_of, main_text

SF = "/root/testdata/sf0.01"


def text_of(page):
    return [t for z, t in blocks(page) if z in ("article", "main")]


def test_zones_and_blocks():
    page = (
        '<article><header><h1>A  title</h1></header><p>x<b>y</b> z<br>w &nbsp; &lt;b&gt; <p class="ad">buy<p>rest<ul><li>one<li>two</ul>'
        '<table><tr><td>a<td>b</table><div class=comments><p>first!</div><script>var a="</p>"</script><form>f</form></article><p>after<!-- c --></p>'
    )
    assert text_of(page) == ["A title", "xy z w <b>", "rest", "one", "two", "a b"]
    assert ("open", "after") in blocks(page)


def test_chrome_by_element_and_by_hint():
    page = "<body class='has-sidebar'><nav>n</nav><header>h</header><main><p>m</p><aside>a</aside><div id=cookie-notice>c</div><p hidden>x</p><div class=relatedPosts>r</div></main><footer>f</footer></body>"
    assert text_of(page) == ["m"]
    assert all(z == "chrome" for z, t in blocks(page) if t != "m")


def test_broken_markup_is_read_to_its_end():
    assert text_of("<article><p>a < b & c &amp d") == ["a < b & c & d"]
    assert text_of("<article><p title='>'>a</p></div></span>b<script>x") == ["a", "b"]
    assert text_of("<article>a<!-- never closed") == ["a"]
    assert blocks(None) == blocks("") == blocks("<p></p> \n") == []


def test_content_with_a_telling_word_in_a_longer_name_is_in_doubt_only():
    page = '<article><div class="post-header"><h1>T</h1></div><p>b</p><div class="related-work"><p>c</p></div><p class="notice-period">d</p><p class=comment-list>e</p></article>'
    assert blocks(page) == [("article", "T"), ("article", "b"), ("article?", "c"), ("article?", "d"), ("chrome", "e")]


@pytest.mark.parametrize("piece", ["<a ", "<a '\">", '<a ">', "<", "<i>", "</b>", "<!", "<!-", "&", "<p title='", "<b><article>", "</"])
def test_broken_pages_of_a_megabyte_are_read_in_linear_time(piece):
    for tail in ("", ">", "'>"):
        page = "<article><b>x" + "<i>" * 20_000 + piece * (1_000_000 // len(piece)) + tail
        began = time.process_time()
        blocks(page)
        assert time.process_time() - began < 6


def test_hosts():
    assert [host_of(u) for u in ("http://A.com/x", "//u@b.org:80?q", "c.net/x", None, "https://d.e#f")] == ["a.com", "b.org", "", "", "d.e"]


def test_repeated_runs_go_from_pages_without_a_main_zone(spark):
    notice = " ".join(f"join{k}" for k in range(12))
    page = "<div><p>own words of page %s</p><p>" + notice + "</p><p>p%s shared but short</p></div>"
    rows = [(i, f"http://h.com/{i}", page % (i, i)) for i in range(3)] + [(9, "http://other.org/", page % (9, 9)), (10, None, None), (None, "http://h.com/n", page % (5, 5)), (2, "http://h.com/2", page % (2, 2))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as spans")
    got = {(r["page_id"], r["url"]): r["text"] for r in main_text(df).collect()}
    for i in range(3):
        assert got[i, f"http://h.com/{i}"] == f"own words of page {i}\n\np{i} shared but short"
    assert notice in got[9, "http://other.org/"] and notice in got[None, "http://h.com/n"]
    assert got[10, None] == ""
    assert main_text(df).count() == len(rows) and main_text(df.limit(0)).count() == 0


def test_the_suffix_array_decides_on_blocks_in_doubt(spark):
    notice = " ".join(f"join{k}" for k in range(12))
    page = '<article><p>own %s ' + notice + '</p><div class="related-work">' + notice + '</div><p class="notice-period">p%s only here</p></article>'
    rows = [(i, f"http://h.com/{i}", page % (i, i)) for i in range(3)] + [(9, "http://other.org/", page % (9, 9))]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i] == f"own {i} {notice}\n\np{i} only here"
    assert got[9] == f"own 9 {notice}\n\n{notice}\n\np9 only here"
    alone = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), run_tokens=16).collect()}
    assert alone[0] == got[9].replace("own 9", "own 0").replace("p9", "p0")  # without the suffix array's runs


def test_pages_against_a_plain_reading(spark):
    want = {}
    for r in table(spark, SF, "pages").collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        want[r["page_id"]] = "\n\n".join(p for p in parts if p)
    got = main_text(table(spark, SF, "pages")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
