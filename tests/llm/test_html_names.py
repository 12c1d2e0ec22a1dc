"""Operator 10: names of furniture on elements that hold the article."""

import pytest
from test_warc_html import JUNK, P1, P2

from hourglass.llm import html_extract

WANT = f"The title\n{P1}\n{P2.replace('&amp;', '&')}"
BODY = f"<h1>The title</h1><p>{P1}</p><p>{P2}</p>"


@pytest.mark.parametrize("wrap", [
    "<article class='post comments-open'>{}</article>", "<div class='content has-sidebar'>{}</div>",
    "<div id='content-sidebar-wrap'><div>{}</div></div>", "<section class='social-science'>{}</section>",
    "<article class='widget'>{}</article>", "<div class='widget'><div class='sidebar'>{}</div></div>"])
def test_named_holders_keep_the_article(wrap):
    assert html_extract.main_text(f"<html><body>{wrap.format(BODY)}</body></html>") == WANT


@pytest.mark.parametrize("junk", JUNK)
def test_named_holders_with_furniture_beside(junk):
    for wrap in ("<article class='post comments-open'>{}</article>", "<div class='content has-sidebar'>{}</div>"):
        assert html_extract.main_text(f"<html><body>{junk}{wrap.format(BODY)}{junk}</body></html>") == WANT


def test_a_section_of_an_article_with_a_like_name():
    part = "Of social science, and of its methods, this part of the article says what there is to say."
    page = f"<article>{BODY}<section class='social-science'><p>{part}</p></section><div class='ad'><p>Buy this, and that.</p></div></article>"
    assert html_extract.main_text(page) == f"{WANT}\n{part}"


def test_comments_longer_than_the_article_are_left_out():
    many = "<p>I liked it, and I will read it again, as everybody should, for sure and more than once.</p>" * 3
    for names in ("class='comments'", "id='comment-list'", "class='sidebar-left'"):
        assert html_extract.main_text(f"<body><div class=content>{BODY}</div><div {names}>{many}</div></body>") == WANT
