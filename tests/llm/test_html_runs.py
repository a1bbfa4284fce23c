"""What op8 takes from pages whose article is not marked, or not all of it."""

from streamfold.llm.html_extract import main_text

NAV = "<div><a href=x>Home</a> <a href=y>News</a></div>"
PARA = "A paragraph with a good number of words that make it long enough to surge."


def test_short_article():
    assert main_text(f"<body>{NAV}<p>Shop closed today.</p>{NAV}</body>") == "Shop closed today."


def test_linked_paragraph_inside():
    page = f"<body>{NAV}<p>{PARA}</p><p><a href=z>{PARA} Linked.</a></p><p>{PARA}</p>{NAV}</body>"
    assert main_text(page) == "\n\n".join([PARA, f"{PARA} Linked.", PARA])
    assert main_text(f"{NAV}<p><a href=z>{PARA} And linked whole.</a></p>") == f"{PARA} And linked whole."


def test_teaser_marked():
    body = "\n\n".join([PARA] * 5)
    page = "<div>" + "".join(f"<p>{p}</p>" for p in body.split("\n\n")) + f"</div>{NAV}{NAV}{NAV}<article><a href=t>Teaser</a></article>"
    assert main_text(page) == body


def test_marked_article_with_more_text():
    assert main_text(f"<div>{PARA}</div><main><p>x</p><p>{PARA}</p></main><div>{PARA}</div>") == f"x\n\n{PARA}"
