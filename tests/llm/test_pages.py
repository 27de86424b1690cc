"""Pages made from a known article and furniture around it: the article comes out exactly."""

import random
import time

import pytest

from freightmill.llm.html_text import main_text

WORDS = (
    "harbour winter ledger copper meadow signal orchard vessel quarry lantern river market "
    "timber canal bridge engine window garden letter corner"
).split()


def sentence(draw, least=8, most=30):
    words = [draw.choice(WORDS) for _ in range(draw.randint(least, most))]
    for k in range(4, len(words) - 1, draw.randint(4, 7)):
        words[k] += ","
    return " ".join(words).capitalize() + "."


def article_blocks(draw):
    """(blocks as text, their html): paragraphs, lists, quotes, headings, inline markup."""
    texts, parts = [], []
    for k in range(draw.randint(4, 12)):
        text = " ".join(sentence(draw) for _ in range(draw.randint(1, 4)))
        kind = draw.choice(["p", "p", "p", "p", "ul", "blockquote", "h2", "inline", "open"])
        if kind == "ul" and k:
            items = [sentence(draw, 6, 12) for _ in range(3)]
            texts += items
            parts.append("<ul>" + "".join(f"<li>{i}" for i in items) + "</ul>")
        elif kind == "h2" and k:
            text = sentence(draw, 3, 6)
            texts.append(text)
            parts.append(f"<h2>{text}</h2>")
        elif kind == "blockquote" and k:
            texts.append(text)
            parts.append(f"<blockquote><p>{text}</p></blockquote>")
        elif kind == "inline":
            first, rest = text.split(" ", 1)
            texts.append(f"{first} {rest} A&B “so” ©")
            parts.append(f"<p><b>{first}</b>\n   <em>{rest}</em> A&amp;B &ldquo;so&rdquo; &#169;</p>")
        else:
            texts.append(text)
            parts.append(f"<p>{text}" + ("" if kind == "open" else "</p>"))
    return texts, "\n".join(parts)


def comments(draw):
    name = draw.choice([
        'class="entry-comments comment-content"', 'class="comments-area post-comments"',
        'class="commentlist"', 'id="comments"', 'class="post-comments main"', 'id="disqus"',
    ])
    said = "".join(
        f'<li class="comment"><div class="comment-body"><p>{sentence(draw)}</p></div></li>'
        for _ in range(draw.randint(1, 3))
    )
    return f"<div {name}><h3>Comments</h3><ol>{said}</ol></div>"


FURNITURE = [
    lambda d: "<nav><ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[:8]) + "</ul></nav>",
    lambda d: f'<header><div class="logo"><a href="/">{d.choice(WORDS)}</a></div></header>',
    lambda d: f"<aside><p>{sentence(d)}</p></aside>",
    lambda d: f'<div class="sidebar widget"><p>{sentence(d)}</p></div>',
    lambda d: f'<div class="cookie-notice popup"><p>{sentence(d)}</p></div>',
    lambda d: f'<div class="ad">{sentence(d)}</div>',
    lambda d: "<script>var t = '<p>not text, not text</p>';</script><style>p{margin:0}</style>",
    lambda d: f'<form action="/s"><label>{sentence(d, 3, 5)}</label><input></form>',
    lambda d: f"<footer><p>&copy; {sentence(d)}</p></footer>",
    lambda d: '<div class="related">' + "".join(
        f'<a href="/{k}">{sentence(d, 3, 6)}</a> ' for k in range(4)) + "</div>",
    comments,
]
SHELLS = [
    "<article><h1>{title}</h1><div class=\"body\">{body}</div>{inside}</article>",
    "<article><h1>{title}</h1>{body}{inside}</article>",
    "<article class=\"has-comments\"><header><h1>{title}</h1></header><div>{body}</div>{inside}</article>",
    "<main><h1>{title}</h1><div class=\"entry-content\">{body}</div>{inside}</main>",
    "<main><div class=\"wrap\"><h1><a href=\"/x\">{title}</a></h1><section><div class=\"text\">{body}</div>"
    "</section></div>{inside}</main>",
    "<div class=\"post\"><h1>{title}</h1><div class=\"content\">{body}</div>{inside}</div>",
    "<article><hgroup><h1>{title}</h1></hgroup><div class=\"inner\"><div class=\"body\">{body}</div></div>"
    "{inside}</article>",
]


def page(seed):
    draw = random.Random(seed)
    texts, body = article_blocks(draw)
    title = sentence(draw, 4, 8)
    inside = comments(draw) if draw.random() < 0.5 else ""
    shell = draw.choice(SHELLS).format(title=title, body=body, inside=inside)
    around = [f(draw) for f in draw.sample(FURNITURE, draw.randint(3, len(FURNITURE)))]
    cut = draw.randint(0, len(around))
    source = (
        f"<!DOCTYPE html><html><head><title>{title}</title></head><body>"
        + "".join(around[:cut]) + shell + "".join(around[cut:]) + "</body></html>"
    )
    return source, "\n".join([title, *texts])


@pytest.mark.parametrize("block", range(4))
def test_generated_pages_come_out_exactly(block):
    for seed in range(50 * block, 50 * block + 50):
        source, wanted = page(seed)
        assert main_text(source) == wanted, (seed, source)


def test_lead_paragraphs_beside_the_container():
    text = "A long enough paragraph, with commas, that tells the story in full, to the end."
    source = (
        f"<main><h1>Title</h1><p class=lead>{text}</p>"
        f'<div class="entry-content"><p>{text}</p><p>{text}</p></div></main>'
    )
    assert main_text(source) == "\n".join(["Title", text, text, text])


def test_headings_of_other_things_stay_out():
    text = "A long enough paragraph, with commas, that tells the story in full, to the end."
    body = f"<p>{text}</p>" * 3
    source = (
        "<body><h3><a href=/a>Site</a></h3><article><h3><a href=/b>More of this</a></h3>"
        f'<h1>Title</h1><div class="body">{body}</div><h2>Behind it</h2></article></body>'
    )
    assert main_text(source) == "\n".join(["Title", *[text] * 3])


def test_comments_longer_than_their_article():
    text = "A long enough paragraph, with commas, that tells the story in full, to the end."
    said = "".join(f"<article class=comment><p>Reader {k}, {text}</p></article>" for k in range(30))
    source = f'<article><h1>Title</h1><p>{text}</p><div class="comment-list">{said}</div></article>'
    assert main_text(source) == f"Title\n{text}"
    # A page that is nothing but comments still has a text.
    assert main_text(f'<body><div class="comments"><p>{text}</p></div></body>') == text


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 100_000 + "<p>Deep, but there.</p>",
        "<div>" * 50_000 + "<p>One.</p></x>" * 50_000,
        "<div>" * 50_000 + "<ul>" + "<li>Item" * 50_000,
        "<div>" * 50_000 + "<p>Some.<li>Item" * 30_000,
        "<p>" + "<i>deep " * 100_000,
        "<table>" + "<tr><td>cell" * 50_000,
        "<p>word, " * 100_000,
        "<p>" + "long text, " * 500_000 + "</p>",
    ],
    ids=["deep", "unknown-ends", "open-items", "mixed", "inline", "cells", "paragraphs", "long"],
)
def test_deep_and_long_pages_take_linear_time(source):
    began = time.process_time()
    assert main_text(source)
    assert time.process_time() - began < 5
