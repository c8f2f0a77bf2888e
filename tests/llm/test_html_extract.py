import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daymark.llm.html_extract import blocks_of, covered_words, extract_text, text_of

CASES = {
    "": "",
    "plain": "plain",
    "<p>a <b>b</b>c&amp;&#233;</p>\n<p> d\n\te<br>f</p>": "a bc&é\nd e f",
    "<nav>menu</nav><article><h1>T</h1><p>x<p>y</article><footer>f</footer>": "T\nx\ny",
    "<article><header><h1>T</h1></header><div class='ad'>buy</div><p>x</p><section id='comments'><article>c</article></section></article>": "T\nx",
    "<script>var a='</p><p>no'</script><style>p{}</style><main>m<!-- <p>no</p> --></main>": "m",
    "<div class=\"sidebar\">s<div>t</div></div><p>text</p>": "text",
    "<nav><ul><li>never closed<article><p>kept</p></article>": "kept",
    "<article>1 < 2 &lt;b&gt; &copy; &nosuch; &#x4e2d;</article>": "1 < 2 <b> © &nosuch; 中",
    "<title>no</title><p hidden>no</p><p title=\"a > b\">yes</p><form>f<input></form>": "yes",
    "<table><tr><td>a</td><td>b</td></tr></table><ul><li>1<li>2</ul>": "a\nb\n1\n2",
    "<p>   x y </p><p> </p>": "x y",
}


@pytest.mark.parametrize("page", list(CASES))
def test_text(page):
    assert text_of(page) == CASES[page]


def test_blocks_are_whole_on_any_cut():
    page = "<article><p>one <b>two</b></p><!-- c --><p>three</p></article>"
    for n in range(len(page)):
        blocks_of(page[:n])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=14), min_size=1, max_size=5), st.integers(1, 4))
def test_covered_words(streams, run):
    places = {}
    for page, words in enumerate(streams):
        for i in range(len(words) - run + 1):
            places.setdefault(tuple(words[i : i + run]), set()).add(page)
    expected = []
    for words in streams:
        held = [False] * len(words)
        for i in range(len(words) - run + 1):
            if len(places[tuple(words[i : i + run])]) > 1:
                held[i : i + run] = [True] * run
        expected.append(held)
    assert [h.tolist() for h in covered_words([np.array(s, np.uint64) for s in streams], run)] == expected


def test_repeated_runs_go_where_no_article_is(spark):
    menu, foot = "Home About Contact Products Services Blog Careers Press", "Copyright all rights reserved by the example company of the world"
    pages = [(i, f"http://h.org/{i}", f"<div>{menu}</div><p>Unique text number {i} about {'abcdefgh'[i] * 5}</p><div>{foot}</div>") for i in range(5)]
    copies = [(i, f"http://c.org/{i}", f"<article><p>{foot}</p></article>") for i in range(10, 13)]
    edges = [(20, None, None), (21, "x", ""), (22, "http://h.org/0", pages[0][2]), (None, "http://h.org/0", pages[0][2])]
    rows = [(*r, "old") for r in pages + copies + edges]
    found = extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, covered string")).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows)
    assert [text[i] for i in range(5)] == [f"Unique text number {i} about {'abcdefgh'[i] * 5}" for i in range(5)]
    assert {text[i] for i in (10, 11, 12)} == {foot} and text[20] == text[21] == ""
    assert text[22] == text[None] == text[0]
    assert all(r.n_chars == len(r.text) for r in found)
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extract_text(empty).count() == 0


def test_groups_of_a_host_meet(spark):
    """A notice on two pages of a large host goes wherever they are dealt, also if one has an article."""
    menu, notice = "Home About Contact Products Services Blog Careers Press", "This page was moved here from the old site in the spring"
    foot = "Our office is closed on all days of the first week of May"
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(20))
    rows = []
    for i in range(40):
        more = f"<p>{notice}</p>" if i in (3, 31) else f"<p>{foot}</p>" if i == 7 else ""
        rows.append((i, f"http://h.org/{i}", f"<div>{menu}</div><p>{own(i)}</p>{more}"))
    rows.append((40, "http://h.org/40", f"<article><p>{own(40)}</p></article><p>{foot}</p>"))
    rows.append((41, "http://other.org/1", f"<p>{own(5)}</p><p>{menu}</p>"))
    rows += [(42, "http://h.org/42", ""), (43, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for size in (2, 256):
        text = {r.page_id: r.text for r in extract_text(pages, size).collect()}
        assert [text[i] for i in range(41)] == [own(i) for i in range(41)], size
        assert text[41] == f"{own(5)}\n{menu}" and text[42] == text[43] == ""


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=14), min_size=1, max_size=6), st.integers(1, 4), st.integers(1, 4))
def test_covered_words_of_pages_with_several_streams(streams, run, least):
    owners, places = [i // 2 for i in range(len(streams))], {}
    for page, words in zip(owners, streams, strict=True):
        for i in range(len(words) - run + 1):
            places.setdefault(tuple(words[i : i + run]), set()).add(page)
    expected = []
    for words in streams:
        held = [False] * len(words)
        for i in range(len(words) - run + 1):
            if len(places[tuple(words[i : i + run])]) >= least:
                held[i : i + run] = [True] * run
        expected.append(held)
    found = covered_words([np.array(s, np.uint64) for s in streams], run, least, owners)
    assert [h.tolist() for h in found] == expected


def test_notices_inside_articles_go(spark):
    """What half of a host's distinct articles hold goes, wherever they are dealt; quotes, copies and edited copies stay whole."""
    notice, quote = "Please note that we use small files on this site to count all visits", "It was the best of times it was the worst of times"
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    page = lambda *blocks: "<nav>menu</nav><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    blocks, kept = {}, {}
    for i in range(40):
        kept[i] = [f"Title {i}", own(i), *[quote] * (i % 3 == 0), own(i + 100)]
        blocks[i] = [*kept[i][:-1], *[notice] * (i % 2), kept[i][-1]]
    rows = [(i, f"http://h.org/{i}", page(*blocks[i])) for i in range(40)]
    rows += [(100 + i, f"http://h.org/copy{i}", page(*blocks[0])) for i in range(60)]  # one distinct article, not 60
    rows += [(200 + i, f"http://e.org/{i}", page(own(7), own(8), f"edited {own(50 + i)}")) for i in range(5)]
    rows += [(300 + i, f"http://two.org/{i}", page(own(300 + i), notice)) for i in range(2)]
    rows.append((400, "http://other.org/", page(own(9), notice)))
    for i in range(40):
        kept[i] = "\n".join(kept[i])
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for size in (3, 256):
        text = {r.page_id: r.text for r in extract_text(pages, size).collect()}
        assert {i: text[i] for i in range(40)} == kept, size
        assert {text[100 + i] for i in range(60)} == {kept[0]}
        assert [text[200 + i] for i in range(5)] == [f"{own(7)}\n{own(8)}\nedited {own(50 + i)}" for i in range(5)]
        assert [text[300 + i] for i in range(2)] == [f"{own(300 + i)}\n{notice}" for i in range(2)]
        assert text[400] == f"{own(9)}\n{notice}"
