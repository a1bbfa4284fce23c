"""op8: names are suspicions, comments are comments, and any markup costs
linear time."""

import time

import pytest

from streamfold.llm.html_extract import main_text

PARA = "A paragraph with a good number of words that make it long enough to surge."


@pytest.mark.parametrize("page,want", [
    ("<article><p class='social'>One text.</p><p class='header'>Another.</p></article>", "One text.\n\nAnother."),
    (f"<article><p>{PARA}</p><p class='notice'>Note this.</p><li class=related>An item</li></article>", f"{PARA}\n\nNote this.\n\nAn item"),
    (f"<article><div class='social'><p>{PARA}</p><p>{PARA}</p></div><p>Short.</p></article>", f"{PARA}\n\n{PARA}\n\nShort."),
    (f"<article><p>{PARA}</p><div class='related'><a href=x>{PARA} {PARA} {PARA}</a></div></article>", PARA),
    (f"<article><p>{PARA}</p><div class='notice'>Cookies!</div></article>", PARA),
    (f"<body class='has-sidebar'><div class='header'><p>{PARA}</p><p>{PARA}</p></div></body>", f"{PARA}\n\n{PARA}"),
])
def test_evidence(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("comments", ["<div id='disqus_thread'>{}</div>", "<div class='user-comments'>{}</div>", "<ol class='commentlist'><li>{}</ol>",
                                      "<section class='post-comments-area'>{}</section>", "<div id=respond>{}</div>",
                                      "<div style='color:red; display:none'>{}</div>", "<p style='visibility:hidden'>{}</p>"])
def test_comments_and_hidden_text(comments):
    said = " ".join([PARA.replace("A paragraph", "My view")] * 9)
    for page in (f"<article><p>{PARA}</p>{comments.format(said)}</article>", f"<div><p>{PARA}</p><p>{PARA}</p></div>{comments.format(said)}"):
        assert "My view" not in main_text(page) and PARA in main_text(page)
    assert main_text(f"<article class='no-comments'><div class='no-comments'><p>{PARA}</p></div></article>") == PARA


@pytest.mark.parametrize("page", [
    lambda n: "<article>" + "<b>" * n + "<p>x " * n, lambda n: "<div>" * n + "</i>" * n, lambda n: "<div class=widget>" * n + "text",
    lambda n: "<div class=widget>x" * n, lambda n: "<article>" * n + "x", lambda n: "<p class=ad>x<div class=ad><article>" * (n // 3),
    lambda n: "<a " * n, lambda n: "<h1>x" * n, lambda n: "</p>" * n + "<li>x" * n], ids=range(9))
def test_time_is_linear(page):
    text = page(200_000)
    began = time.process_time()
    main_text(text)
    assert time.process_time() - began < 8           # under two seconds on an idle machine
    small, least = page(20_000), []
    for t in (small, text):
        spent = []
        for _ in range(2):
            began = time.process_time()
            main_text(t)
            spent.append(time.process_time() - began)
        least.append(min(spent))
    assert least[1] < 40 * max(least[0], 0.01)
