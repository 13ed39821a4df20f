import itertools
import random
import time

import pytest

from docpipe.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var t="</p><p>no";</script></head><body class="has-sidebar">
<header><a href=/>Home</a> <h1>Site</h1></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div id="cookie-notice">We use cookies. Please accept them all now.</div><div class="main-content">
<h1>A &eacute;t&eacute; &amp; more</h1><p>First   <b>bold</b> paragraph,\nwith <a href=z>a link</a> and more words in it.<p>Second one, unclosed.
<div class="ad">Buy now! A great product for you.</div><!-- <p>comment</p> --><p>Third paragraph goes on a bit longer, as they do.</p>
<ul><li>item one of a list</li><li>item two of the list</li></ul><p>Short&nbsp;end.</p></div>
<aside><p>Read more of our many fine stories here.</p></aside><section id="comments"><h2>Comments</h2><p>I liked this story, it was very good.</p></section>
<form><p>Sign up for the letter</p><button>Go</button></form><footer>&copy; 2020 us. All rights reserved.</footer></body></html>"""
TEXT = "A été & more\n\nFirst bold paragraph, with a link and more words in it.\n\nSecond one, unclosed.\n\nThird paragraph goes on a bit longer, as they do.\n\nitem one of a list\n\nitem two of the list\n\nShort end."


LONG = ["The council voted on Tuesday to extend the tram line to the harbour, after two years of debate about its cost.","Construction will begin in March, and the first trains are expected to run in the summer of next year.","Residents near the depot had asked for a wall against the noise; the plan now includes one, said the mayor.","A second vote on fares follows in May."]


def body():
    return ''.join(f'<p>{x}</p>' for x in LONG)


WANT = '\n\n'.join(['New tram line',*LONG])
NAV = "<div class='top'><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a> <a href=/w>Weather</a></div>"
FOOT = "<div class='btm'><a href=/i>Imprint</a> <a href=/p>Privacy</a> © 2021 The Paper</div>"
C = "<div class='{c}'><div class='{i}'><b>Tom</b> 3 May<p>I like this plan a lot, well done.</p></div><div class='{i}'><b>Ann</b> 4 May<p>Far too expensive for us all.</p></div><div class='{i}'><b>Kim</b> 4 May<p>When will it open? I can't wait.</p></div></div>"
PAGES = {
'with-sidebar':f"<body>{NAV}<div class='content with-sidebar'><h1>New tram line</h1>{body()}</div>{FOOT}",
'share-enabled':f"<body>{NAV}<article class='post share-enabled'><h1>New tram line</h1>{body()}</article>{FOOT}",
'legal story':f"<body>{NAV}<article class='legal story'><h1>New tram line</h1>{body()}</article>{FOOT}",
'page-header-small':f"<body>{NAV}<main id='page-header-small'><h1>New tram line</h1>{body()}</main>{FOOT}",
'plain divs':f"<body><div>{NAV}</div><div><div><h1>New tram line</h1><div>{LONG[0]}</div><div>{LONG[1]}</div><div>{LONG[2]}</div><div>{LONG[3]}</div></div></div><div>{FOOT}</div>",
'ugc after':f"<body>{NAV}<div class='x1'><h1>New tram line</h1>{body()}</div>{C.format(c='ugc',i='u')}{FOOT}",
'ugc inside':f"<body>{NAV}<div class='x1'><h1>New tram line</h1>{body()}{C.format(c='c-list',i='c-item')}</div>{FOOT}",
'c-list p':f"<body>{NAV}<article><h1>New tram line</h1>{body()}</article><div class='c-list'><p>I like this plan a lot, well done.</p><p>Far too expensive for us all.</p></div>{FOOT}",
'ugc p nosem':f"<body>{NAV}<div class='story'><h1>New tram line</h1>{body()}</div><div class='ugc'><p>I like this plan a lot, well done.</p><p>Far too expensive for us all.</p></div>{FOOT}",
'sections':f"<body>{NAV}<div class='page'><h1>New tram line</h1><section>{''.join(f'<p>{x}</p>' for x in LONG[:2])}</section><section>{''.join(f'<p>{x}</p>' for x in LONG[2:])}</section></div>{FOOT}",
'wrapped':f"<body><div id='header-wrap'>{NAV}</div><div class='no-sidebar'><div class='entry'><h1>New tram line</h1>{body()}</div></div><div class='left-sidebar'><p>Most read stories of the day.</p><ul><li><a href=a>One thing happened</a></li><li><a href=b>Another did not happen.</a></li></ul></div>{FOOT}",
'comment articles':f"<body>{NAV}<article class='p'><h1>New tram line</h1>{body()}</article><article class='c'>Tom: I like this plan a lot.</article><article class='c'>Ann: Far too expensive for us all.</article>{FOOT}",
'table':f"<body>{NAV}<table><tr><td><h1>New tram line</h1>{body()}</td></tr></table>{FOOT}",
'cookie':f"<body><div id='cookie-box'><p>We use cookies to make this site better. Please accept them.</p></div>{NAV}<div class='text'><h1>New tram line</h1>{body()}<div class='ad'>Buy our shoes now, they are great.</div></div><div class='newsletter-signup'><p>Get our letter every morning, it is free.</p></div>{FOOT}",
}


@pytest.mark.parametrize("name", PAGES)
def test_templates(name):
    """The article is whole, and menus, footers, notices, adverts and comments are gone, whatever they are called."""
    assert H.extract(PAGES[name]) == WANT
    assert H.extract(PAGES[name], H.fit([PAGE, *PAGES.values()])) == WANT


def test_cut_corrects_single_blocks():
    """A block alone would be judged wrongly; its neighbours decide."""
    page = f"<body>{NAV}<div class='text'><p>{LONG[0]}</p><p>Yes</p><p>{LONG[1]}</p></div><div><a href=a>One</a><br>at last, a story.<p><a href=b>Two</a></p><p><a href=c>Three</a></p></div>{FOOT}"
    found, gain, keep = H.label(page)
    of = {b.text: (g > 0, k) for b, g, k in zip(found, gain, keep)}
    assert of["Yes"] == (False, True) and of[LONG[0]] == of[LONG[1]] == (True, True)
    assert [b.text for b, k in zip(found, keep) if k] == [LONG[0], "Yes", LONG[1]]


def test_names():
    assert [H.name_says(x) for x in ("ad", "main sidebar", "comment-list", "cookieNotice", "content with-sidebar", "share-enabled", "story", "no-ads")] == [1, 1, 0.8, 0.8, 0, 0, 0, 0]


@pytest.mark.parametrize("unit", ["<div>x", "<p>x<b>", "</p></i><li>x", "<li><ul><div>", "<div class=a><p>x</p></div>", "<a><b>", "</div>x "])
def test_odd_pages_take_linear_time(unit):
    took = []
    for n in (4_000, 40_000):
        start = time.process_time()
        H.extract(unit * n)
        took.append(time.process_time() - start)
    assert took[1] < 30 * max(took[0], 0.02)


def test_page():
    assert H.extract(PAGE) == TEXT
    assert H.extract(PAGE, H.fit([PAGE] * 3)) == TEXT


@pytest.mark.parametrize("seed", range(30))
def test_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    gain = [rng.choice([-2.0, -1.0, 0.0, 0.5, 1.0, 3.0]) + rng.random() for _ in range(n)]
    links = [(i, j, rng.random() * 2) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5]
    cost = lambda keep: sum(abs(g) for g, k in zip(gain, keep) if (g > 0) != k) + sum(c for i, j, c in links if keep[i] != keep[j])
    best = min(cost(k) for k in itertools.product([False, True], repeat=n))
    assert cost(H.minimum_cut(gain, links)) == pytest.approx(best)


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>", "</p></div>", "<a href='", "&amp", "\x00<p>\x00</p>", "<p>" * 3000, "<div>" * 2000 + "x"])
def test_odd_pages_do_not_crash(page):
    assert isinstance(H.extract(page), str)


def test_long_page():
    page = "<article>" + "".join(f"<p>Paragraph number {i}, which has some words in it.</p><div class=ad>Buy {i}</div>" for i in range(4000)) + "</article>"
    text = H.extract(page)
    assert text.count("\n\n") == 3999 and "Buy" not in text


def test_rows(spark):
    rows = [(1, "u", PAGE, "own", 3), (1, "u", PAGE, "own", 3), (None, None, None, None, None), (2, "v", "", "t", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = sorted(map(tuple, H.extract_pages(pages).collect()), key=str)
    assert found == sorted([(1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert H.extract_pages(pages.limit(0)).count() == 0
