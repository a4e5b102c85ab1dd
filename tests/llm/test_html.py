"""Main texts of pages whose article lies in all kinds of wrappers, and of articles of any length."""

import random

import pytest

from careerlake.llm.html_extract import PROSE, against, extract

BODY = f"<h1>Title here</h1><p>{PROSE}</p><p>{PROSE}</p>"
TEXT = f"Title here\n{PROSE}\n{PROSE}"
COMMENT = "I liked this very much. Thank you for it."
WRAPPERS = {
    "state": '<div class="site has-sidebar"><nav><a href=/>Home</a></nav><main><article>{}</article></main></div>',
    "layout": '<div id="page" class="layout-right-sidebar">{}</div>',
    "copy": '<article><div class="body-copy">{}</div></article>',
    "share": '<div class="article-share-wrap">{}</div>',
    "free": '<div class="ad-free-content">{}</div>',
    "modal": '<div class="modal-enabled"><div class="content">{}</div></div>',
    "form": '<form id="aspnetForm">{}<input><label>Name</label></form>',
    "form around an article": '<form><nav><a href=/>x</a></nav><article>{}</article></form>',
    "builder": '<div class="elementor-widget"><div class="elementor-widget-container">{}</div></div>',
    "banner": '<div class="banner">{}</div>',
    "main in a clear name": '<div class="overlay"><main>{}</main></div>',
}


@pytest.mark.parametrize("kind", WRAPPERS)
@pytest.mark.parametrize("title", ["h1", "h2"])
def test_no_article_is_lost_to_a_wrapper(kind, title):
    page = WRAPPERS[kind].format(BODY).replace("h1>", f"{title}>")
    assert extract(f"<body><header><a href=/>Site</a></header>{page}<footer><p>{PROSE}</p></footer></body>") == TEXT


@pytest.mark.parametrize("n", [1, 3, 6, 20, 100, 500])
def test_length_does_not_decide(n):
    lines = [f"Rain fell on day {k}" for k in range(n)]
    around = lambda page: extract(f"<body><nav><a href=/>Home</a></nav>{page}<footer>All rights reserved</footer></body>")
    for start, each, end in (
        ("<article><h1>Days</h1>", "<p>{}</p>", "</article>"),
        ("<article><h1>Days</h1><ul>", "<li>{}</li>", "</ul></article>"),
        ("<article><h1>Days</h1><ul>", "<li>{} <button>Save</button></li>", "</ul></article>"),
        ("<main><h1>Days</h1><table>", "<tr><td>{}</td></tr>", "</table></main>"),
        ("<article><h1>Days</h1>", "<div>{}</div>", "</article>"),
        ("<h1>Days</h1>", "<p>{}</p>", ""),
    ):
        assert around(start + "".join(each.format(x) for x in lines) + end) == "\n".join(["Days", *lines])


def test_short_lines_after_a_title():
    assert extract("<h1>Notes</h1><p>Rain fell</p><p>Snow too</p>") == "Notes\nRain fell\nSnow too"


@pytest.mark.parametrize(
    "around",
    [
        "{}<section class=comments>" + f"<article class=comment><p>{COMMENT}</p></article>" * 30 + "</section>",
        "{}<div id=comments-area>" + f"<div class=comment-body><p>{COMMENT}</p></div>" * 30 + "</div>",
        f"<div class=sidebar><article><h3>Other</h3><p>{PROSE}</p></article></div>{{}}",
        f"<div class=cookie-banner><p>{COMMENT}</p></div><div class=main-nav><p>News</p></div>{{}}<div class=related-articles><p>{COMMENT}</p></div><div class=newsletter-signup><p>{COMMENT}</p></div><div class=site-footer><p>{COMMENT}</p></div>",
    ],
)
def test_what_is_marked_against_still_goes(around):
    assert extract(around.format(f"<article>{BODY}</article>")) == TEXT
    inner = BODY + "<div class=post-comments>" + f"<p>{COMMENT}</p>" * 30 + f"</div><div class=advert-slot><p>{COMMENT}</p></div>"
    assert extract(around.format(f"<article><header class=entry-header>{inner}</header></article>")) == TEXT


def test_names():
    said = {n: against(n, False)[0] for n in "sidebar site-sidebar has-sidebar layout-right-sidebar body-copy article-share-wrap ad-free-content modal-enabled content post-comments SiteFooter page entry-header".split()}
    assert said == {"sidebar": 2, "site-sidebar": 2, "has-sidebar": 0, "layout-right-sidebar": 0, "body-copy": 0, "article-share-wrap": 1, "ad-free-content": 0, "modal-enabled": 0, "content": 0, "post-comments": 2, "SiteFooter": 2, "page": 0, "entry-header": 0}


def made_page(rng):
    """A page and its main text: an article in one of many wrappers, between boilerplate of many kinds."""
    sentence = lambda: " ".join(rng.choices("rain river town plan vote bridge field mill wind stone over under near and the a of".split(), k=rng.randrange(5, 18))).capitalize() + "."
    short = lambda: " ".join(rng.choices("rain river town plan vote".split(), k=rng.randrange(1, 5))).capitalize()
    text, body = [], []

    def add(tag, x):
        text.append(x)
        body.append(f"<{tag}>{x}</{tag}>")

    add("h1", short())
    for _ in range(rng.choice([2, 5, 30])):
        add(rng.choice(["p", "p", "p", "h2", "li", "blockquote"]), " ".join(sentence() for _ in range(rng.randrange(1, 5))) if rng.random() < 0.8 else short())
    core = "".join(body)
    core = rng.choice(["<article>{}</article>", "<main>{}</main>", "<div class=post-content>{}</div>", "<main><article>{}</article></main>", "<div id=content>{}</div>", "{}"]).format(core)
    for _ in range(rng.randrange(3)):
        core = rng.choice(["<div class='site has-sidebar'>{}</div>", "<div class='wrap layout-left-sidebar'>{}</div>", "<form>{}</form>", "<div class='no-comments'>{}</div>", "<div>{}</div>", "<section>{}</section>"]).format(core)
    junk = ["<nav><ul>" + "".join(f"<li><a href=/{k}>{short()}</a></li>" for k in range(6)) + "</ul></nav>", f"<div class=ad>{sentence()}</div>", f"<aside><h3>{short()}</h3><p>{sentence()}</p></aside>", f"<div class='cookie-notice'>{sentence()}<button>OK</button></div>", f"<div class='sidebar widget-area'><p>{sentence()}</p></div>", f"<div class=related-posts><p>{sentence()}</p></div>", f"<form><label>Mail</label><p>{sentence()}</p></form>", f"<section id=comments><p>{sentence()}</p><p>{sentence()}</p></section>"]
    before, after = rng.sample(junk, 3), rng.sample(junk, 3)
    return f"<body><header><a href=/>{short()}</a></header>{''.join(before)}{core}{''.join(after)}<footer><p>{sentence()}</p></footer></body>", text


def test_labelled_pages():
    rng = random.Random(7)
    right = got = wanted = whole = 0
    for _ in range(400):
        page, text = made_page(rng)
        found = extract(page).split("\n")
        right += len(set(found) & set(text))
        got += len(set(found))
        wanted += len(set(text))
        whole += found == text
    f1 = 2 * right / (got + wanted)
    assert f1 > 0.99, f1
    assert whole > 380, whole
