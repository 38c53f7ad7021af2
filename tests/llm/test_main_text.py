"""Main text: articles in odd frames, and time that grows with the page."""

import time

import pytest

from lakestrata.llm.html_text import main_text

LONG = "".join(f"<p>Paragraph {i} of the article, with several words, commas, and a full stop at its end. "
               "Some more text follows here.</p>" for i in range(8))
SHORT = "".join(f"<p>Short {i}, yes.</p>" for i in range(8))
SIDE = "<ul><li><a href=#>One link</a><li><a href=#>Another link</a></ul>"


@pytest.mark.parametrize("frame", [
    '<div class="site with-sidebar">%s</div>', '<div id=page class="has-header no-comments">%s</div>',
    '<section class="social-science">%s</section>', "<svg/>%s", "<svg />%s", '<div class="share-price"><h1>T</h1>%s</div>',
    '<div><svg><path d="M0"/></div>%s', "<div class=widget><main>%s</main></div>", "<script>var a = 1</p>%s"])
def test_the_whole_article_stays(frame):
    assert main_text(f"<html><body>{frame % LONG}</body></html>").count("Paragraph") == 8


def test_what_stands_in_the_frame_goes():
    page = (f'<body><div class="site with-sidebar"><div class="site-header">Name of the site</div><div class=sidebar>{SIDE}</div>'
            f'<div class="post">{LONG}</div><div class="comments-area"><p>I say, so.</p><article class="comment"><p>A reply.</p></article>'
            '</div><div class="cookie-banner">We use cookies, of course.</div></div></body>')
    text = main_text(page)
    assert text.count("Paragraph") == 8
    assert not any(x in text for x in ("Name of", "link", "I say", "A reply", "cookies"))


def test_an_article_of_short_paragraphs_is_not_lost():
    text = main_text(f'<html><body><article>{SHORT}</article><div class="discussion">{"long talk, and more. " * 60}</div></body></html>')
    assert text.count("Short") == 8


def test_comments_longer_than_the_article_go():
    page = f'<body><article><h1>T</h1>{SHORT}</article><div class="comments">{"<p>Well, I think so, too, and more of it.</p>" * 50}</div></body>'
    assert main_text(page).count("Short") == 8 and "I think" not in main_text(page)


def test_text_behind_the_last_tag_and_open_comments():
    assert main_text("<p>One.<p>Two, a < b") == "One.\nTwo, a < b"
    assert main_text("<p>One.</p><!-- never closed <p>Two.</p>") == "One."


@pytest.mark.parametrize("bad", ["<p " * 330_000, "<p " * 330_000 + ">", "<svg>" * 200_000, "<!-- " * 200_000, "<a \"'" * 160_000,
                                 "</b>" * 250_000, "<div>" * 20_000 + "</x>" * 100_000, "<script>" * 100_000 + "</div>" * 50_000])
def test_a_megabyte_of_bad_markup_takes_seconds(bad):
    t = time.perf_counter()
    main_text(bad)
    assert time.perf_counter() - t < 5
