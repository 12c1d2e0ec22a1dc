"""Operator 10: forms around a page, fieldsets and formulas."""

import pytest
from test_html_names import BODY, WANT
from test_warc_html import JUNK

from hourglass.llm.html_extract import main_text

FIELDS = "<input type=hidden name=state value=x><fieldset><legend>Your vote, please, for one of these</legend><input type=radio></fieldset>"


@pytest.mark.parametrize("body", [f"<article>{BODY}</article>", f"<div class=content>{BODY}</div>", BODY])
@pytest.mark.parametrize("form", ["<form>{}</form>", "<form id='aspnetForm' method=post><div>{}</div></form>"])
def test_a_form_around_the_page(form, body):
    assert main_text(f"<html><body>{form.format(body)}</body></html>") == WANT
    assert main_text(f"<html><body>{form.format(FIELDS + body + FIELDS)}</body></html>") == WANT


@pytest.mark.parametrize("junk", [j for j in JUNK if "<form" not in j])
def test_a_form_around_the_page_with_furniture(junk):
    assert main_text(f"<html><body><form>{junk}<article>{BODY}</article>{junk}</form></body></html>") == WANT


def test_small_forms_go():
    sign_up = "<form><p>Sign up, please, for our letter, with your name and address here.</p><input></form>"
    assert main_text(f"<body>{sign_up}<article>{BODY}{sign_up}</article></body>") == WANT
    assert main_text(f"<body>{sign_up}</body>") == ""


def test_fieldsets_and_formulas_of_an_article():
    box = "<fieldset><p>A box of the article, drawn as a set, with words that belong to it.</p></fieldset>"
    formula = "<p>Let <math><mi>x</mi><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup><annotation>x = y^2</annotation></math> hold.</p>"
    page = f"<article>{BODY}{box}{FIELDS}{formula}</article>"
    assert main_text(page) == f"{WANT}\nA box of the article, drawn as a set, with words that belong to it.\nLet x=y2 hold."
