"""HTML extraction: blocks against a slow reading of the same rules, what the cut decides, broken and very large pages."""

import itertools
import random
import time

import pytest

pytest.importorskip("public_tokenizers")
from stokesweave.llm import html_mincut as m  # noqa: E402


def texts(html):
    return [b.text for b in m.blocks_of(html)]


def test_what_gives_no_text_does_not_part_a_block():
    assert texts("<p>One <script>x</script>two and three</p>") == ["One two and three"]
    for name in ("button", "noscript", "svg", "object", "select", "video"):
        assert texts(f"<p>One <{name}><b>gone</b></{name}>two</p><p>next") == ["One two", "next"], name
    assert texts("<p>One <noscript><div><p>gone</p></div></noscript>two</p>") == ["One two"]
    assert texts("<p>One <iframe><p>gone</iframe>two<link rel=x><meta itemprop=y> three<hr>four") == ["One two three", "four"]
    assert texts("<p>One <button>gone</p><p>two</p>") == ["One", "two"]
    assert texts("<p>a <select><option>1<option>2</select>b <svg><path d='M'/><circle/></svg>c") == ["a b c"]


def test_inline_elements_that_are_hidden_or_adverts():
    assert texts('<p>One <span style="display:none">hidden</span>two <span class="advert">buy now <b>here</b></span>three <i hidden>x</i>four <span aria-hidden="true">y</span>five</p>') == ["One two three four five"]
    assert texts('<p>A <b><span class="ad">x</b>b</span> c</p><p><em class="lead">d</em></p>') == ["A b c", "d"]


def test_items_cells_and_paragraphs_end_each_other():
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul><p>e<p>f<div>g</div>h") == ["a", "b", "c", "d", "e", "f", "g", "h"]
    blocks = m.blocks_of("<table><tr><td>a<td>b<tr><td>c</table><dl><dt>x<dd>y<dt>z</dl>")
    assert [b.text for b in blocks] == ["a", "b", "c", "x", "y", "z"]
    assert blocks[0].parent == blocks[1].parent != blocks[2].parent and len({b.parent for b in blocks[3:]}) == 1


def test_shared_ancestors_are_those_of_the_paths():
    """``shared`` and ``depth`` against whole paths, on random trees of divisions."""
    rng = random.Random(2)
    for _ in range(200):
        html, path, want, number = [], [], [], 0
        for _ in range(rng.randint(1, 40)):
            what = rng.random()
            if what < 0.4:
                number += 1
                path.append(number)
                html.append("<div>")
            elif what < 0.7 and path:
                path.pop()
                html.append("</div>")
            else:
                if html and html[-1] == "w":
                    continue
                html.append("w")
                want.append(tuple(path))
        got = m.blocks_of("".join(html))
        assert [b.depth for b in got] == [len(p) for p in want]
        for a, b, block in zip(want, want[1:], got[1:]):
            assert block.shared == sum(1 for x in itertools.takewhile(lambda t: t[0] == t[1], zip(a, b)))


@pytest.mark.parametrize(
    "page",
    ["<a" * 500_000, '<a "><b" ' * 100_000 + '"', "<" * 1_000_000, "<div>" * 100_000 + "x" + "</x>" * 100_000, "<div>" * 100_000 + "x" + "</div>" * 100_000, "<ul>" + "<div>" * 70_000 + "<li></li>" * 50_000, "<div>a" * 50_000, "<p>a" * 50_000, "<b><i>" * 100_000 + "x" + "</b>" * 100_000],
)
def test_broken_and_deep_pages_take_linear_time(page):
    start = time.process_time()
    m.main_text(page)
    assert time.process_time() - start < 20  # the former scanner took hours on the first


ITEM = "<p>This is a sentence of the article that has words enough to be taken for one, and more of them.</p>"


def test_the_cut_decides_where_names_do_not():
    # no element says what it is: two words among sentences are text, links in a list are not
    page = f"<div><ul><li><a href=x>Home</a><li><a href=y>About us</a></ul></div><div>{ITEM}<p>In short</p>{ITEM}</div>"
    text, changed = m.labelled(page)
    assert changed >= 1 and text.split("\n")[1] == "In short" and "Home" not in text and len(text.split("\n")) == 3
    # a division without a name between what is named as beside the text goes with it
    page = f"<article>{ITEM}</article><footer>About</footer><div>Some words that end like a sentence and are long enough to look like it.</div><footer>Imprint</footer>"
    text, changed = m.labelled(page)
    assert changed == 1 and text.count("\n") == 0 and text.startswith("This is")


def test_pages_without_names_are_better_with_the_cut(spark):
    """The pages of the smallest table, class names and telling elements taken away: the cut changes labels, and for the better."""
    import re
    from collections import Counter

    pages = [r["html"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    right = {"cut": 0, "alone": 0}
    changed = 0
    for html in pages:
        truth = Counter(m.main_text(html).split("\n"))
        bare = re.sub(r"\s(class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", html)
        bare = re.sub(r"<(/?)(nav|aside|footer|header|article|main|form|section)\b", r"<\1div", bare)
        blocks = m.blocks_of(bare)
        odds = [m.log_odds(b) for b in blocks]
        labels = m.minimum_cut(odds, m.smoothness(blocks))
        changed += sum((o > 0) != k for o, k in zip(odds, labels))
        right["cut"] += sum(k == (b.text in truth) for b, k in zip(blocks, labels))
        right["alone"] += sum((o > 0) == (b.text in truth) for b, o in zip(blocks, odds))
    assert changed > 0 and right["cut"] > right["alone"]


def test_extract_tables(spark):
    schema = "page_id long, url string, html string, text string, key string"
    rows = [(1, "u", f"<article>{ITEM}</article>", "clash", "k"), (1, "u", f"<article>{ITEM}</article>", "clash", "k"), (None, None, "&lt;p&gt;", None, None), (2**60 + 1, "v", None, "", ""), (3, "w", "", "", "")]
    out = m.extract(spark.createDataFrame(rows, schema)).collect()
    sentence = ITEM[3:-4]
    found = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in out), key=str)
    assert found == sorted([(1, "u", sentence, len(sentence))] * 2 + [(None, None, "", 0), (2**60 + 1, "v", "", 0), (3, "w", "", 0)], key=str)
    assert m.extract(spark.createDataFrame([], schema)).count() == 0
