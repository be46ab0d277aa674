"""Pages whose text is spread over several containers."""

import time

import pytest

from fieldloom.llm import html_text
from fieldloom.llm.html_text import main_text

LONG = [f"Part {i} of the text goes on for a while, " + "and then for some more, " * 6 + "until it ends." for i in range(6)]
P = [f"<p>{x}</p>" for x in LONG]
MENU = "".join(f"<div><a href=/{i}>go {i}</a></div>" for i in range(12))


@pytest.mark.parametrize(
    "html, text",
    [
        # The heading and the lead are beside the body.
        (f"<div class=post><h1>T</h1><p>{LONG[0]}</p><div class=body>{''.join(P[1:])}</div></div>", ["T", *LONG]),
        (f"<div>{MENU}</div><div class=post><h1>T</h1><div class=body>{''.join(P)}</div></div>", None),
        # Siblings of unequal size.
        (f"<body><div>{''.join(P[:4])}</div><div>{''.join(P[4:])}</div></body>", LONG),
        (f"<body><section>{''.join(P[:2])}</section><section>{''.join(P[2:])}</section></body>", LONG),
        # A quotation or a table that is most of the page.
        (f"<div>{P[0]}<blockquote>{''.join(P[1:5])}</blockquote>{P[5]}</div>", LONG),
        (f"<div>{P[0]}<table><tr><td>{''.join(P[1:5])}</td></tr></table>{P[5]}</div>", LONG),
        (f"<div><p>He said:</p><blockquote>{''.join(P)}</blockquote></div>", ["He said:", *LONG]),
        # Several articles, those of comments left out.
        (f"<article>{''.join(P[:4])}</article><article>{''.join(P[4:])}</article>"
         f"<article class=comment><p>{LONG[0]} No!</p></article>", LONG),
    ],
)
def test_no_block_of_the_text_is_lost(html, text):
    found = main_text(html).split("\n")
    if text is None:  # at least all of it, in order
        assert found[-7:] == ["T", *LONG]
    else:
        assert found == text


def test_menus_beside_the_text_stay_out():
    html = f"<body><div>{MENU}</div><div><h1>T</h1>{''.join(P)}</div><div>{MENU}</div></body>"
    nav = html.replace("<div><div><a", "<div class=menu><div><a")
    assert main_text(nav).split("\n") == ["T", *LONG]


ALL = "".join(P)


@pytest.mark.parametrize(
    "html",
    [
        f'<body><form id="aspnetForm"><article><h1>T</h1>{ALL}</article></form></body>',
        f'<body><form id="aspnetForm"><div><h1>T</h1>{ALL}</div></form></body>',
        "<body><h1>T</h1>" + "".join(f'<div class="elementor-widget elementor-widget-text">{p}</div>' for p in P) + "</body>",
        f'<body><div class="no-sidebar"><h1>T</h1>{ALL}</div></body>',
        f'<body><div class="layout-sidebar-right"><nav><a>menu</a></nav><article><h1>T</h1>{ALL}</article></div></body>',
        f'<body><div class="site-header"><h1>Site</h1></div><div class=post><div class="entry-header"><h1>T</h1></div>'
        f"<div class=body>{ALL}</div></div></body>",
        f"<body><div><a href=/>Home</a></div><div><h1>T</h1>{ALL}</div><div>(c) the owners</div></body>",
        f"<body><div><a href=/>Home</a></div><div><h1>T</h1>{''.join(P[:3])}</div><div>{''.join(P[3:])}</div>"
        "<div>(c) the owners</div></body>",
        # Comments of readers, more than the text itself.
        f"<body><div><h1>T</h1>{ALL}</div><div id=comments>" + "".join(f"<p>{x} No!</p>" for x in LONG * 9) + "</div></body>",
    ],
)
def test_names_of_layouts_do_not_empty_a_page(html):
    assert main_text(html).split("\n") == ["T", *LONG]


def test_ratios_choose_the_region(monkeypatch):
    menu = "".join(f"<p><a href=/{i}><b><i>go</i></b></a></p>" for i in range(12))
    html = f"<body><div>{menu}</div><div>{ALL}</div><div>{menu}</div></body>"
    assert main_text(html).split("\n") == LONG
    monkeypatch.setattr(html_text, "smoothed", lambda values: 1 / values)
    other = main_text(html).split("\n")
    assert other != LONG and "go" in other


def test_end_tags_that_match_nothing():
    began = time.monotonic()
    assert main_text("<i>" * 20_000 + "</b>" * 20_000 + "x") == "x"
    assert time.monotonic() - began < 1
