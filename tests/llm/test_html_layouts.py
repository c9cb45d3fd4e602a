"""Block precision and recall of the page model on layouts that its training does not make."""

import html

import pyarrow.parquet as pq
import pytest

from subtide.llm import html_crf

MARK = "⁣"  # invisible; stands for main text while the labels are read
MENU = ["Home", "About us", "Contact", "Products", "Archive", "Help"]


def _page(kind: int, texts: list[str], named: bool) -> str:
    say = lambda name: f' class="{name}"' if named else ""
    body = lambda tag, part: "".join(f"<{tag}>{MARK}{html.escape(t, quote=False)}</{tag}>" for t in part)
    links = "".join(f'<a href="/{n}">{w}</a> ' for n, w in enumerate(MENU))
    items = "<ul>" + "".join(f'<li><a href="/{n}">{w}</a></li>' for n, w in enumerate(MENU)) + "</ul>"
    rows = "".join(f'<div><a href="/{n}">{w}</a></div>' for n, w in enumerate(MENU))
    advert = f'<div{say("sponsored")}><a href="/buy">Buy two and get one free today</a></div>'
    replies = f'<div{say("comments")}><p>anna wrote</p><p>Great read, thanks!</p><p>bob wrote</p><p>I do not agree at all.</p></div>'
    rights = "<p>© 2024 Some Company</p>"
    first, second = texts[: len(texts) // 2], texts[len(texts) // 2 :]
    return [
        f"<div>{items}</div><div>{body('p', texts)}</div><div>{rights}</div>",
        f"<table><tr><td>{rows}</td><td>{body('p', first)}{advert}{body('p', second)}</td></tr></table><div{say('footer')}>{rights}</div>",
        f"<header>{links}</header><article><div>{body('p', texts)}</div>{replies}</article><footer>{rights}</footer>",
        f"<div{say('menu')}>{links}</div><section><section>{body('div', first)}{advert}{body('div', second)}</section></section>{replies}",
        f"<main><h2>{MARK}{html.escape(texts[0], quote=False)}</h2>{body('p', texts[1:])}<form><label>Your mail</label><input>"
        f"<button>Subscribe</button></form></main><aside>{items}</aside>",
    ][kind]


@pytest.fixture(scope="module")
def split():
    pages = [p for p in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist() if p]
    return html_crf.fit(html_crf.training_pages(sorted(pages[:150]))), pages[-100:]


@pytest.mark.parametrize("named, least", [(True, 0.95), (False, 0.9)])
def test_precision_and_recall_on_unseen_layouts(split, named, least):
    model, pages = split
    hit = false = missed = 0
    for n, page in enumerate(pages):
        blocks = html_crf.blocks_of(page)
        texts = [b.text for b, label in zip(blocks, html_crf.markup_labels(blocks)) if label]
        if not texts:
            continue
        built = f"<html><head><title>x</title></head><body>{_page(n % 5, texts, named)}</body></html>"
        truth = [MARK in b.text for b in html_crf.blocks_of(built)]
        found = model.label(html_crf.blocks_of(built.replace(MARK, "")))
        hit += sum(f and t for f, t in zip(found, truth))
        false += sum(f and not t for f, t in zip(found, truth))
        missed += sum(t and not f for f, t in zip(found, truth))
    assert hit > 300
    assert hit / (hit + false) >= least
    assert hit / (hit + missed) >= least
    print(named, hit / (hit + false), hit / (hit + missed))


def test_given_pages_keep_their_own_main_text(split):
    model, pages = split
    for page in pages:
        blocks = html_crf.blocks_of(page)
        assert model.label(blocks) == html_crf.markup_labels(blocks)
