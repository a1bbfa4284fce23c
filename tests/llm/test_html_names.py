"""What op8 drops by class or id."""

import pytest

from streamfold.llm.html_extract import main_text

BODY = "<p>A paragraph <span class=share>Share</span>of the article.</p><p>Another one.</p>"
WANT = "T\n\nA paragraph of the article.\n\nAnother one."


@pytest.mark.parametrize("page", [
    f"<article><header class='entry-header'><h1>T</h1></header>{BODY}</article>",
    f"<article><div class=header><h1>T</h1></div>{BODY}</article>",
    f"<article><h1 class='header'>T</h1>{BODY}</article>",
    f"<article><div class=header><h2>T</h2></div>{BODY}</article>",
    f"<div class='content-sidebar-wrap'><article><h1>T</h1>{BODY}</article></div>",
    f"<div class='layout has-sidebar'><article><h1>T</h1>{BODY}</article></div>",
    f"<div class='widget'><p>w</p><article class='promo comments-open'><h1>T</h1>{BODY}</article></div>",
    f"<article><div class=share><b>Share</b></div><h1>T</h1>{BODY}<div class=comments><h2>Comments</h2>x</div></article>",
    f"<div class=sidebar><h1>Site</h1>text</div><article><h1>T</h1>{BODY}<p id=cookie-notice>c</p>"
    "<article class=comment-body>me</article></article>"])
def test_names(page):
    assert main_text(page) == WANT
