from __future__ import annotations

import random

import pytest

from tidemark.llm import pages


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@pytest.mark.parametrize("limit", [400_000_000, 10])
def test_alignment_is_a_longest_common_subsequence(limit):
    for seed in range(300):
        rng = random.Random(seed)
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(15))] for _ in range(2))
        found, rest = sorted(pages.common_lines(a, b, limit)), iter(b)
        assert len(found) == lcs_length(a, b)
        assert all(any(x == a[i] for x in rest) for i in found)


def test_markup_becomes_lines_with_regions():
    html = (
        "<head><title>no</title><style>p{x}</style></head><body><script>var t='</p>';</script><nav>menu</nav><!-- no -->"
        "<div class='ad'>buy</div><article><header><h1>Title</h1></header><p><b>One &amp;&nbsp; two\n three.<br><p>Four<ul><li>a<li>b</ul>"
        "<aside>side</aside><form>mail <input></form><p class=\"ad-box\">advert<p>Five<div id='comments'><p>reader</p></div></article>"
        "<p>outside</p><footer>&copy; foot</footer>"
    )
    lines, regions = pages.text_lines(html)
    assert [x for x, r in zip(lines, regions) if r == pages.MAIN] == ["Title", "One & two three.", "Four", "a", "b", "Five"]
    assert [x for x, r in zip(lines, regions) if r == pages.UNMARKED] == ["outside"]
    assert pages.text_lines(None) == ([], []) and pages.text_lines("a < b <3 <p") == (["a < b <3 <p"], [pages.UNMARKED])


def test_a_missing_end_tag_cuts_nothing_off():
    def main(html):
        return [x for x, r in zip(*pages.text_lines(html)) if r == pages.MAIN]

    for tag in ("video", "audio", "svg", "canvas", "object", "select", "noscript", "template"):
        assert main(f"<article><p>one<{tag} a=b><p>two</p><{tag}><i>in</i><p>no</p></{tag}><p>three</article>") == ["one", "two", "three"]
        assert main(f"<article><p>one <{tag}>in</p><p>two</p></article></{tag}><article>three</article>") == ["one", "two", "three"]
        assert main(f"<article><p>one <{tag}><b>in</b><{tag}><p>in</p></{tag}></{tag}>two</article>") == ["one two"]
        assert main(f"<article><p><span>one <{tag}><b>in</b></span> two</article>") == ["one", "two"]
    assert main("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</article>") == ["so x=1 holds"]
    assert main("<article><p>one<script>var x<p>two</article>") == ["one"]


def test_chrome_inside_a_block_leaves_one_line():
    def main(html):
        return [x for x, r in zip(*pages.text_lines(f"<article>{html}</article>")) if r == pages.MAIN]

    assert main('<p>k <span class="ad">x</span> l</p>') == ["k l"]
    assert main('<p>k<span class="ad">x <b>y</b> <span>z</span></span>l &amp;<button>b</button>m</p>') == ["k l & m"]
    assert main("<button>b</button> end") == ["end"] and main("<label>c</label>") == []
    assert main('<a class="promo"><div>buy</div><p>now</p></a><p>story</p>') == ["story"]
    assert main('<p>k <b>a <span class="ad">x</b> l</p><p>next</p>') == ["k a", "next"]  # no end tag: to the end of its block
    assert main('<p>k <span class="ad">x</p><p>next</p>') == ["k", "next"]
    lines, regions = pages.text_lines('<nav><p>menu</p></nav><p>one <i class="ad">x</p>two')
    assert sorted(zip(lines, regions)) == [("menu", pages.CHROME), ("one", pages.UNMARKED), ("two", pages.UNMARKED), ("x", pages.CHROME)]


SCHEMA = "page_id bigint, url string, html string, text string"


def page(body):
    return f"<html><body>{body}</body></html>"


def test_shared_lines_go_where_no_article_is_marked(spark):
    rows = [
        (1, "http://a.org/x/1", page("<p>site name</p><p>own one</p><p>contact</p>"), "clash"),
        (2, "http://a.org/x/2", page("<p>site name</p><p>own two</p><p>contact</p>"), None),
        (3, "http://a.org/x/2", page("<p>site name</p><p>own two</p><p>contact</p>"), None),  # a copy is no partner: both meet page 1
        (4, "http://b.org/x/3", page("<p>site name</p><p>lone</p>"), None),
        (5, "http://c.org/1", page("<article><p>same</p></article><p>foot</p>"), None),
        (6, "http://c.org/2", page("<article><p>same</p></article><p>foot!</p>"), None),
        (7, None, None, None), (8, "", "", None), (None, "http://d.org/", page("<p>x  y</p>"), None),
    ]
    got = {r["page_id"]: r for r in pages.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    want = {1: "own one", 2: "own two", 3: "own two", 4: "site name\nlone", 5: "same", 6: "same", 7: "", 8: "", None: "x y"}
    assert {k: r["text"] for k, r in got.items() if k not in (2, 3)} == {k: v for k, v in want.items() if k not in (2, 3)}
    assert sorted([got[2]["text"], got[3]["text"]]) == sorted([want[2], want[3]])
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_partners_do_not_depend_on_blocks(spark, monkeypatch):
    rows = [(i, f"http://h{i % 2}.org/{i % 5}/{i:03d}", page(f"<p>name {i % 2}</p><p>own {i}</p><p>end</p>"), None) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    texts = []
    for n in (1000, 30, 5):
        monkeypatch.setattr(pages, "BLOCK_PAGES", n)
        texts.append({r["page_id"]: r["text"] for r in pages.extract_main_text(df).collect()})
    assert texts[0] == texts[1] == texts[2] == {i: f"own {i}" for i in range(200)}


def test_copies_meet_the_pages_around_their_run(spark, monkeypatch):
    rows = [(i, f"http://a.org/a?x={i}", page("<p>site name</p><p>same story here</p><p>contact</p>"), None) for i in range(60)]
    rows += [(100, "http://a.org/b", page("<p>site name</p><p>another story</p><p>contact</p>"), None)]
    rows += [(200 + i, f"http://b.org/{i:02d}", page("<p>lone</p>"), None) for i in range(20)]  # nothing but copies
    df = spark.createDataFrame(rows, SCHEMA)
    want = {i: "same story here" for i in range(60)} | {100: "another story"} | {200 + i: "lone" for i in range(20)}
    for n, held in ((1000, 16_000_000), (4, 100)):
        monkeypatch.setattr(pages, "BLOCK_PAGES", n)
        monkeypatch.setattr(pages, "HELD_CHARS", held)
        assert {r["page_id"]: r["text"] for r in pages.extract_main_text(df).collect()} == want


def test_near_copies_keep_their_story(spark, monkeypatch):
    story = "".join(f"<p>paragraph {i} of the story</p>" for i in range(12))
    rows = [(i, f"http://a.org/a/{i}", page(f"<p>site name</p>{story}<p>printed on day {i}</p><p>contact</p>"), None) for i in range(30)]
    rows += [(100, "http://a.org/b", page("<p>site name</p><p>another story</p><p>contact</p>"), None)]
    rows += [(200 + i, f"http://b.org/{i}", page(f"{story}<p>version {i}</p>"), None) for i in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    told = "\n".join(f"paragraph {i} of the story" for i in range(12))
    want = {i: f"{told}\nprinted on day {i}" for i in range(30)} | {100: "another story"} | {200 + i: f"{told}\nversion {i}" for i in range(2)}
    for n in (1000, 3):
        monkeypatch.setattr(pages, "BLOCK_PAGES", n)
        assert {r["page_id"]: r["text"] for r in pages.extract_main_text(df).collect()} == want


def test_shared_lines_go_from_main_but_not_from_articles(spark):
    rows = [
        (1, "http://a.org/1", page("<main><p>join us today</p><p>the first story of all</p></main><p>out</p>"), None),
        (2, "http://a.org/2", page("<main><p>join us today</p><p>quite another story</p></main>"), None),
        (3, "http://b.org/1", page("<main><p>notice</p><article><p>a quotation</p><p>and what follows</p></article></main>"), None),
        (4, "http://b.org/2", page("<main><p>notice</p><article><p>a quotation</p><p>then something else</p></article></main>"), None),
    ]
    got = {r["page_id"]: r["text"] for r in pages.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "the first story of all", 2: "quite another story", 3: "a quotation\nand what follows", 4: "a quotation\nthen something else"}


def test_no_pages(spark):
    assert pages.extract_main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_page_keeps_its_article(spark, sf_dir):
    import html
    import re

    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in rows.collect()}
    for row in pages.extract_main_text(rows).collect():
        inner = re.search(r"<article>(.*)</article>", source[row["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", inner)]
        assert row["text"] == "\n".join(b for b in blocks if b)
