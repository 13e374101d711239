"""Classes inside an article: names of text parts stay, names of boxes go."""

from __future__ import annotations

import pytest

from granary.llm.html_text import main_text

PAGE = "<html><body><nav>menu</nav><article><p>First paragraph of the text.</p>{}<p>Last paragraph of the text.</p></article></body></html>"


@pytest.mark.parametrize(
    "part",
    [
        '<p class="share-price">X</p>',
        '<div class="social-science">X</div>',
        '<p id="notice-period">X</p>',
        '<p class="ad-hoc">X</p>',
        '<p class="follow-up">X</p>',
        '<div class="search-results">X</div>',
        '<section class="chapter adReform lead">X</section>',
        '<ul class="comment-period"><li>X</li></ul>',
    ],
)
def test_text_parts_stay(part):
    assert main_text(PAGE.format(part)) == "First paragraph of the text.\nX\nLast paragraph of the text."


@pytest.mark.parametrize(
    "part",
    [
        '<div class="ad">X</div>',
        '<div class="text ad">X</div>',
        '<div class="share-buttons">X</div>',
        '<div id="related-posts">X</div>',
        '<div class="newsletterSignup">X</div>',
        '<ol class="comment-list"><li>X</li></ol>',
        "<aside>X</aside>",
        '<div role="navigation">X</div>',
    ],
)
def test_boxes_go(part):
    assert main_text(PAGE.format(part)) == "First paragraph of the text.\nLast paragraph of the text."


def test_outside_an_article_any_word_of_a_name_marks():
    page = '<body><div class="site-search-results">menu entry</div><div><p>' + "The text of the page. " * 20 + "</p></div></body>"
    assert main_text(page) == ("The text of the page. " * 20).strip()
