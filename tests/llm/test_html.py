"""The scanner by the HTML standard's rules, in linear time, and the text of pages labelled by hand."""

import time

import pytest

from tilescan.llm import op2_html


def blocks(page):
    return [text for _, text in op2_html.parse(page).blocks]


def test_no_text_is_lost():
    page = "<article><h1>T t</h1><p title=it's>First one.</p><p>Second isn't it.</p><p>Third don't.</p></article>"
    assert blocks(page) == ["T t", "First one.", "Second isn't it.", "Third don't."]
    assert blocks("<p>Mass is <math><mi>E</mi></math> known</p>") == ["Mass is E known"]
    assert blocks("<p>An <object data=x>object's words</object> and <svg><title>no</title><text>drawn</text></svg>") == ["An object's words and drawn"]
    assert blocks("<html><head><title>no</title><meta charset=x><p>no body tag<p>two") == ["no body tag", "two"]
    assert blocks("<head>words before") == ["words before"]
    assert blocks("a</br>b < c <3 d &lt;e&gt; &amp;amp; &nbsp; f") == ["a b < c <3 d <e> &amp; f"]


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p a=\"x>y\" b='<p>' c=d/e>one</p>", ["one"]),
        ('<p class = "a" id=b"c>one<p / >two', ["one", "two"]),
        ("<!-->one<!--->two<!-- -- > x --!>three<!-- rest", ["onetwothree"]),
        ("<!doctype html><?xml x?>one</ bogus >two</>three<![CDATA[x]]>", ["onetwothree"]),
        ("one<p title='unfinished>two</p>", ["one"]),
        ("one</", ["one</"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("<dl><dt>a<dd>b<dt>c</dl><ul><li>d<li>e<ul><li>f</ul>g</ul>", ["a", "b", "c", "d", "e", "f", "g"]),
        ("<p>a<textarea><p>x</p></textarea>b<iframe><p></iframe>c", ["abc"]),
        ("<form><select><option>x<option>y</select><button>z</button></form>w", ["w"]),
        ("<P>One<BR/>two<Hr>three", ["One two", "three"]),
    ],
)
def test_markup(page, want):
    assert blocks(page) == want


@pytest.mark.parametrize("page", ["<a" * 5_000_000, "<a b=\"" * 500_000, "<" * 1_000_000, "<!--" * 1_000_000, "<div>" * 100_000 + "x" + "</div>" * 100_000, "<div>" * 100_000 + "</i>" * 100_000, "<ul><li>" + "<div>" * 50_000 + "<li>" * 50_000, "<b>" * 50_000 + "<p>x" * 50_000])
def test_long_pages_take_linear_time(page):
    began = time.time()
    op2_html.parse(page)
    assert time.time() - began < 20


# pages labelled by hand: blocks of content, blocks of other text
PAGES = [
    (
        """<!DOCTYPE html><html lang=en><head><meta charset="utf-8"><title>Harbour news</title><link rel=stylesheet href=a.css></head><body>
        <div id="topbar"><a href="/">The Harbour Post</a> <a href="/login">Log in</a></div>
        <div class="container"><div class="row"><main class="col-8"><article class="post-421 entry">
        <h1 class="entry-title">New pier opens after two years of work</h1>
        <p class="lead">The pier, closed since the storm, was opened by the mayor on Monday.</p>
        <p>About three hundred people came. "It was worth the wait," said one of them, who had come by <a href="/ferry">ferry</a>.</p>
        <figure><img src=p.jpg alt="pier"><figcaption>The pier in the morning light.</figcaption></figure>
        <h2>What it cost</h2><p>The work took 26 months and cost 4.1 million.</p></article></main>
        <aside class="col-4 sidebar"><h3>Most read</h3><ol><li><a href=1>Storm warning for the weekend</a></li><li><a href=2>Library hours change</a></li></ol></aside></div></div>
        <footer class="site-footer"><p>&copy; The Harbour Post. All rights reserved.</p></footer></body></html>""",
        ["New pier opens after two years of work", "The pier, closed since the storm, was opened by the mayor on Monday.", 'About three hundred people came. "It was worth the wait," said one of them, who had come by ferry.', "The pier in the morning light.", "What it cost", "The work took 26 months and cost 4.1 million."],
        ["The Harbour Post Log in", "Most read", "Storm warning for the weekend", "Library hours change", "© The Harbour Post. All rights reserved."],
    ),
    (
        """<html><body><nav class=menu><ul><li><a href=/a>Recipes</a><li><a href=/b>Tools</a><li><a href=/c>About</a></ul></nav>
        <div class="cookie-banner">We use cookies to improve this site. <button>Accept</button></div>
        <div id=content><h1>Rye bread without kneading</h1><p>Mix the flour with water and salt and let it rest overnight.</p>
        <ul><li>500 g of rye flour, as coarse as you like it.</li><li>400 g of water, lukewarm.</li><li>10 g of salt.</li></ul>
        <p>Bake it for an hour. It keeps for a week.</p></div>
        <section id=comments><h3>3 comments</h3><div class=comment><p>I tried it and liked it!</p></div><div class=comment><p>Too sour for me.</p></div></section>
        <footer>Imprint | Privacy</footer></body></html>""",
        ["Rye bread without kneading", "Mix the flour with water and salt and let it rest overnight.", "500 g of rye flour, as coarse as you like it.", "400 g of water, lukewarm.", "10 g of salt.", "Bake it for an hour. It keeps for a week."],
        ["Recipes", "Tools", "About", "We use cookies to improve this site.", "3 comments", "I tried it and liked it!", "Too sour for me.", "Imprint | Privacy"],
    ),
    (
        """<body><header><h2><a href=/>Field notes</a></h2></header><main><article><header><h1>Counting swifts</h1></header>
        <p>Swifts are hard to count, because they fly in and out of view all evening.</p><blockquote><p>One counts the nests, not the birds.</p></blockquote>
        <table><tr><th>Year<th>Nests<tr><td>2019<td>14<tr><td>2020<td>17</table><pre>mean = 15.5</pre>
        <p>There were more in the second year.</p><div class="ad-slot">Buy binoculars now! <a href=x>Shop</a></div><p>We will count again.</p></article></main>
        <div class=newsletter-signup><p>Get our letter once a month.</p><form><input name=mail><button>Sign up</button></form></div></body>""",
        ["Counting swifts", "Swifts are hard to count, because they fly in and out of view all evening.", "One counts the nests, not the birds.", "Year", "Nests", "2019", "14", "2020", "17", "mean = 15.5", "There were more in the second year.", "We will count again."],
        ["Field notes", "Buy binoculars now! Shop", "Get our letter once a month."],
    ),
    (
        """<html><body><div class="wrapper"><div class="header"><a href="/">Home</a> | <a href="/faq">Questions</a></div><div class="post-body">
        <h2>Why the old clock runs slow</h2>The clock in the hall has run slow for years.<br>Its pendulum hangs on a worn spring.<p>A new spring was cut from steel, and since then it has kept time to a minute a week.</div>
        <div class="related"><h4>Related</h4><a href=1>Clocks of the town hall</a></div><div class="footer">Contact us</div></div></body></html>""",
        ["Why the old clock runs slow", "The clock in the hall has run slow for years. Its pendulum hangs on a worn spring.", "A new spring was cut from steel, and since then it has kept time to a minute a week."],
        ["Home | Questions", "Related", "Clocks of the town hall", "Contact us"],
    ),
]


def test_pages_labelled_by_hand():
    """The weights and the threshold of 0.5 come from generated pages alone; these pages were written after they were fixed."""
    model = op2_html.default_model()
    right = total = 0
    for page, good, bad in PAGES:
        assert sorted(blocks(page)) == sorted(good + bad)
        kept = model.text(page).split("\n")
        assert [b for b in kept if b in good] == [b for b in good if b in kept]  # page order
        right += sum((b in kept) == (b in good) for b in good + bad)
        total += len(good + bad)
    assert right / total >= 0.95, (right, total)
