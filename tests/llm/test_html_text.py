from __future__ import annotations

import pytest

from harvestry.llm.html_text import CHUNK, extract, page_report, smooth, threshold

P = "This is a paragraph of running text with enough words to look like the main content of a page. "


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("plain", "plain"),
        ("<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>a &amp; b&nbsp;c<br>d</p></article><footer>f</footer>", "Title a & b c d"),
        (f"<div class='side-bar sidebar'>{P}</div><main><p>{P}</p><p>short</p><p>{P}</p></main>", f"{P}short {P}".strip()),
        (f"<article><p>{P}</p><div class='ad'>buy</div><form><p>{P}</p></form><script>var t='</p>';</script><style>p{{}}</style><section id=comments><p>{P}</p></section></article>", P.strip()),
        (f"<article><p><b>One.<br><p>{P}</p><p><i>two</p></article><aside>x</aside>", f"One. {P}two"),
        (f"<body><div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div><p>{P}<p>{P}</div><div class=cookie-notice>{P}</div></body>", f"{P}{P}".strip()),
        (f"<article><header><p>by me</p></header><p>{P}</p><p hidden>{P}</p><p style='display: none'>{P}</p></article>", P.strip()),
        ("<p>&#65;&#x42;&eacute;&lt;b&gt;</p>", "ABé<b>"),
        (f"<html><body><article>{'<p>' + P + '</p>'}<!-- {P} --></article></body></html>", P.strip()),
        (f"<div class='page has-sidebar'><div class=post-header><h1>T</h1></div><p>{P}</p><div class='comments-wrapper-x comments'>{P}</div></div>", f"T {P}".strip()),
        ("<p>unclosed <b>tag", "unclosed tag"),
    ],
)
def test_extract(html, text):
    assert extract(html) == text


def test_chunks_do_not_matter():
    page = "<article>" + "".join(f"<p>{P}{k} &amp; &eacute; end.</p>" for k in range(3000)) + "</article>"
    assert len(page) > 4 * CHUNK
    assert extract(page) == " ".join(f"{P}{k} & é end." for k in range(3000))


def test_report(spark):
    df = spark.createDataFrame([(1, "u", f"<article><p>{P}</p></article>"), (2, None, None), (None, "v", "<p>é</p>"), (1, "u", "")], "page_id long, url string, html string")
    got = sorted((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in page_report(df).collect())
    assert got == [(0, "v", "é", 1), (1, "u", "", 0), (1, "u", P.strip(), len(P.strip())), (2, "", "", 0)]
    assert page_report(df.limit(0)).collect() == []


def test_smoothing_and_threshold():
    import numpy as np

    assert np.allclose(smooth(np.ones(7)), 1) and abs(threshold(np.array([0, 0, 10, 10.0])) - 5) < 1e-9 and threshold(np.array([3.0, 3.0])) == 3


MANY = f"<p>{P}</p>" * 30


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<body><article><h1>T</h1><p>The lead.</p><div class=body>{MANY}</div></article><p>{P}</p></body>", f"T The lead. {P * 30}"),
        (f"<main><h1>T</h1><article><div><div>{MANY}</div></div><p>The end.</p></article><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></main>", f"T {P * 30}The end."),
        (f"<article><section>{MANY}</section><section><p>A small part.</p></section></article>", f"{P * 30}A small part."),
        (f"<body><div><h1>T</h1><div>{MANY}</div><div><p>A small part.</p></div></div><div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div></body>", f"T {P * 30}A small part."),
        (f"<article>{MANY}<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul><p><a href=3>Source</a></p></article>", f"{P * 30}One Two Source"),
    ],
)
def test_no_part_of_an_article_is_lost(html, text):
    assert extract(html) == text.strip()


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<article><h2 id='share-prices'>Share prices</h2><p class='social-policy'>{P}</p><p>{P}</p></article>", f"Share prices {P}{P}"),
        (f"<article><p>{P}</p><p><a href=x>A whole paragraph that is one link.</a></p><p>{P}</p></article>", f"{P}A whole paragraph that is one link. {P}"),
        (f"<body><div><p>{P}</p><p><a href=x>One link.</a></p><p><a href=x>Another one.</a></p><p>{P}</p></div></body>", f"{P}One link. Another one. {P}"),
        (f"<main><h1>T</h1><p>Lead.</p><div>We use cookies on this page.</div><article><p>{P}</p><p>{P}</p></article></main>", f"T Lead. {P}{P}"),
        (f"<article><header><h1>T</h1><p>by me, 3 minutes</p></header><p>{P}</p><div class='ad-box-2'>buy</div><ul class=share-buttons><li>x</ul></article>", f"T {P}"),
        (f"<header><h1>Site</h1></header><article><p>{P}</p></article>", P),
    ],
)
def test_names_and_links_do_not_take_from_an_article(html, text):
    assert extract(html) == text.strip()


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 100_000 + "x" + "</div>" * 100_000,
        "<div>x" * 60_000,
        "<b>" * 50_000 + "</i>" * 50_000 + "x",
        "<div>" * 30_000 + "</section>" * 60_000 + "x",
        "<i>" + "<div><b>" * 30_000 + "</i>" * 30_000 + "x",
        "<b>" * 50_000 + "<div></div>" * 30_000 + "x",
        "<section><p>x" * 40_000,
    ],
)
def test_time_is_linear(html):
    import time

    began = time.process_time()
    assert "x" in extract(html)
    assert time.process_time() - began < 5


def test_generated_pages_equal_their_article():
    """Pages put together from parts whose text is known."""
    import random
    from html import escape

    rng = random.Random(6)
    word = lambda: rng.choice(["text", "a<b", "R&D", "über", "ответ", "x", "long-word", "“so”"])
    prose = lambda n: " ".join(word() for _ in range(n)) + "."

    def marked(text: str) -> str:
        return " ".join(rng.choice([lambda w: w, lambda w: f"<b>{w}</b>", lambda w: f"<a href='#'>{w}</a>" if rng.random() < 0.1 else w, lambda w: f"<i>{w}</i>"])(escape(w)) for w in text.split(" "))

    for _ in range(200):
        parts, blocks = [f"<h1>{escape('Title ' + word())}</h1>"], []
        blocks.append(parts[0][4:-5])
        for _ in range(rng.randint(2, 12)):
            text = prose(rng.randint(8, 60))
            blocks.append(text)
            parts.append(rng.choice(["<p>{}</p>", "<p>{}", "<section><p>{}</p></section>", "<div class=body><p>{}</p></div>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>"]).format(marked(text).replace(" ", rng.choice([" ", "\n  "]))))
            if rng.random() < 0.3:
                parts.append(rng.choice(["<div class=ad>buy now</div>", "<aside>more</aside>", "<script>if (a < b) {}</script>", "<form><input></form>", "<div id='comments'><p>" + prose(20) + "</p></div>", "<figure></figure>", "<!-- no -->"]))
        blocks[0] = blocks[0].replace("&lt;", "<").replace("&amp;", "&")
        noise = "<nav><ul>" + "".join(f"<li><a href=/{k}>{escape(word())}</a>" for k in range(6)) + "</ul></nav>"
        page = f"<html><head><title>t</title><style>p{{}}</style></head><body><header>{noise}</header>{noise if rng.random() < 0.5 else ''}<article>{''.join(parts)}</article><footer><p>{prose(12)}</p></footer></body></html>"
        assert extract(page) == " ".join(blocks), page
