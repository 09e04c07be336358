"""HTML extraction over sites whose article and boilerplate are known."""

import random

import pytest

from skygrid.llm import template


def one(html):
    return template.extract([html])[0]


@pytest.mark.parametrize(
    "html, text",
    [
        ('<article class="post with-sidebar"><p>Real text here.</p></article>', "Real text here."),
        ('<div class="page has-banner"><article><p>Real text here.</p></article></div>', "Real text here."),
        ('<article><header class="entry-header"><h1>Headline</h1></header><p>Text.</p></article>', "Headline Text."),
        ('<article><header class="header"><h1>Headline</h1></header><p>Text.</p></article>', "Headline Text."),
        ('<body class="page sidebar"><main class="sidebar-left"><p>Text.</p></main></body>', "Text."),
        ('<form id="aspnet"><div class="site-header">Site</div><article><p>Text.</p><form>Ask</form></article></form>', "Text."),
        ('<article><p>Text.</p><div class="comments"><article><p>A reader says</p></article></div></article>', "Text."),
        ('<article><p>Text.</p><ul class="share-buttons"><li>Post</li></ul><div class="cookie-notice">Cookies</div><div id="newsletter_form">Join</div></article>', "Text."),
        ('<article><p>Text.</p><div class="shared-values">Kept</div><div class="commentary">Also kept</div></article>', "Text. Kept Also kept"),
        ('<div class="widget"><p>All there is.</p></div>', "All there is."),
    ],
)
def test_names_lose_no_article_text(html, text):
    assert one(html) == text


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9])
def test_repeated_headings_and_paragraphs_stay(n):
    page = "<article><h1>Title {i}</h1><h2>Introduction</h2><p>Text {i}.</p><p>See also part two.</p><ul><li>Yes</li></ul></article>"
    assert template.extract([page.format(i=i) for i in range(n)]) == [f"Title {i} Introduction Text {i}. See also part two. Yes" for i in range(n)]


def site(r, with_article):
    """Pages of one site and their article texts. Names tell nothing; boxes that
    are alike on all pages stand around the article and, with one, inside it."""
    n, name = r.randint(4, 12), iter(f"c{k}" for k in r.sample(range(1000), 60))
    words = lambda k: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(k))
    box = lambda: f'<div class="{next(name)}">{words(6)}</div>'
    links = f'<ul class="{next(name)}">' + "".join(f"<li><a href=/{k}>{words(2)}</a></li>" for k in range(5)) + "</ul>"
    head = [links, *(box() for _ in range(r.randint(0, 2)))]
    foot = [box() for _ in range(r.randint(1, 3))]
    r.shuffle(head)
    inner = [box() for _ in range(r.randint(1, 2))] if with_article else []
    outer, held = next(name), next(name)
    opened, closed = ("<article>", "</article>") if with_article else (f'<div class="{held}">', "</div>")
    h2 = [words(2) for _ in range(2)]
    pages, texts = [], []
    for _ in range(n):
        title, parts, kept = words(3), [], []
        for k in range(2):
            parts.append(f"<h2>{h2[k]}</h2>")
            kept.append(h2[k])
            for _ in range(r.randint(1, 4)):
                p = words(r.randint(8, 30))
                parts.append(f"<p>{p}</p>" if r.random() < 0.8 else f"<blockquote>{p}</blockquote>")
                kept.append(p)
            parts += inner[k : k + 1]
        pages.append(f'<html><body><div class="{outer}">' + "".join(head) + f"{opened}<h1>{title}</h1>" + "".join(parts) + closed + "".join(foot) + "</div></body></html>")
        texts.append(" ".join([title, *kept]))
    return pages, texts


@pytest.mark.parametrize("with_article", [True, False])
def test_sites_without_telling_names(with_article):
    r = random.Random(5)
    for _ in range(60):
        pages, texts = site(r, with_article)
        assert template.extract(pages) == texts


def test_plain_tag_rule_fails_where_classes_decide():
    """All text of article elements, which is what tags tell, is too much."""
    r, differ = random.Random(6), 0
    for _ in range(20):
        pages, texts = site(r, True)
        plain = [template.clean([t for t, never, main, _, _ in template.Page(p).texts if main and not never]) for p in pages]
        differ += sum(a != b for a, b in zip(plain, texts))
        assert template.extract(pages) == texts
    assert differ > 100
