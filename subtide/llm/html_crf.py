"""Main text of web pages with a linear-chain conditional random field.

A page is cut into leaf blocks: stretches of text between block-level tags.
Each block is main text or not; the labels of neighbours depend on each other.
Features are the tags and class names above a block and measures of its text.
Weights are learned from labelled pages and blocks are labelled by Viterbi.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.frames import append_columns

#: Pages that training pages are made of.
SAMPLE_PAGES = 300
STEPS, RATE, DECAY = 80, 0.2, 2e-3

# HTML tags that begin and end a block, that hold no text, and that have no end.
BLOCK_TAGS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol "
    "option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
SILENT_TAGS = "script style template svg math noframes xmp".split()
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
#: A tag that closes an open tag of the same kind when it begins.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = BLOCK_TAGS - {"body", "button", "head", "html", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "title", "legend", "li", "dd", "dt"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(SILENT_TAGS)})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    # A quote opens a value only behind an equals sign; quoted values may hold any character.
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    link_chars: int
    above: tuple[str, ...]  # features of the tags above, outermost first


def _tag_features(tag: str, attributes: str) -> tuple[str, ...]:
    names = []
    if attributes:
        for match in _NAMES.finditer(attributes):
            names += _PARTS.findall((match[1] or match[2] or match[3] or "").lower())
    return (f"in {tag}", *(f"name {name}" for name in names))


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks with text, in page order; white space is single and character references are decoded."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = 0
    in_link = False

    def flush():
        nonlocal links, in_link
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                blocks.append(Block(text, links, stack[-1][1] if stack else ()))
            parts.clear()
        links = 0

    def add(piece: str):
        nonlocal links
        if piece:
            parts.append(piece)
            if in_link:
                links += len(piece.strip())

    def close(kinds: set[str], barrier: set[str]):
        for n in range(len(stack) - 1, -1, -1):
            if stack[n][0] in kinds:
                del stack[n:]
                return
            if stack[n][0] in barrier:
                return

    at = 0
    for match in _MARKUP.finditer(page):
        add(page[at : match.start()])
        at = match.end()
        tag = match[3]
        if tag is None:
            if match[1]:
                flush()
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = not match[2]
            continue
        if tag == "br" or tag == "wbr":
            add(" " if tag == "br" else "")
            continue
        if tag not in BLOCK_TAGS:
            continue
        flush()
        in_link = False
        if match[2]:
            close({tag}, {"article", "main", "body"} - {tag})
            continue
        if tag in CLOSES:
            close(CLOSES[tag], {"ul", "ol", "dl", "table", "div", "section", "article", "select", "blockquote", "menu"})
        if tag in CLOSES_P and tag != "p":
            close({"p"}, BLOCK_TAGS - {"p"})
        if tag not in VOID_TAGS:
            above = stack[-1][1] if stack else ()
            stack.append((tag, above + _tag_features(tag, match[4])))
    add(page[at:])
    flush()
    return blocks


_SENTENCE = re.compile(r"[.!?](?:\s|$)")


def features(blocks: list[Block]) -> list[list[str]]:
    """Feature names of each block."""
    out = []
    known: dict[tuple[str, ...], list[str]] = {}
    for n, block in enumerate(blocks):
        tags = known.get(block.above)
        if tags is None:
            tags = known[block.above] = [*dict.fromkeys(block.above), f"own {next((a for a in reversed(block.above) if a.startswith('in ')), '')}"]
        text = block.text
        size, words = len(text), text.count(" ") + 1
        out.append(
            [
                *tags,
                "always",
                f"words {min(words, 100).bit_length()}",
                f"links {min(4, 4 * block.link_chars // max(size, 1))}",
                f"sentences {min(3, len(_SENTENCE.findall(text)))}",
                f"commas {min(3, text.count(','))}",
                f"copyright {'©' in text}",
                "first" if n == 0 else "last" if n == len(blocks) - 1 else "middle",
            ]
        )
    return out


@dataclass
class Field:
    """Weights of the label main text against other text, and of pairs of labels."""

    weights: dict[str, float] = field(default_factory=dict)
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def label(self, blocks: list[Block]) -> list[int]:
        """Most likely labels of all blocks together (Viterbi)."""
        get = self.weights.get
        scores = [sum(get(name, 0.0) for name in names) for names in features(blocks)]
        (stay0, to1), (to0, stay1) = self.pairs.tolist()
        best0, best1, back = 0.0, scores[0] if scores else 0.0, []
        for score in scores[1:]:
            from0, from1 = best0 + stay0 >= best1 + to0, best0 + to1 > best1 + stay1
            back.append((0 if from0 else 1, 0 if from1 else 1))
            best0, best1 = (best0 + stay0 if from0 else best1 + to0), (best0 + to1 if from1 else best1 + stay1) + score
        labels = [1 if best1 > best0 else 0] if scores else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def text(self, page: str) -> str:
        blocks = blocks_of(page)
        return "\n".join(block.text for block, label in zip(blocks, self.label(blocks)) if label)


def fit(pages: list[tuple[list[Block], list[int]]]) -> Field:
    """Maximise the likelihood of the labels (forward-backward, all pages at once)."""
    pages = [page for page in pages if page[0]]
    if not pages:
        return Field()
    names: dict[str, int] = {}
    rows, columns, lengths = [], [], [len(blocks) for blocks, _ in pages]
    place = 0
    for blocks, _ in pages:
        for own in features(blocks):
            rows += [place] * len(own)
            columns += [names.setdefault(name, len(names)) for name in own]
            place += 1
    rows, columns = np.array(rows), np.array(columns)
    y = np.concatenate([labels for _, labels in pages]).astype(int)
    steps, n = max(lengths), len(pages)
    starts = np.cumsum([0, *lengths[:-1]])
    mask = np.arange(steps)[None] < np.array(lengths)[:, None]
    index = np.where(mask, starts[:, None] + np.arange(steps)[None], 0)
    gold = np.zeros((2, 2))
    for (_, labels), _ in zip(pages, lengths):
        for a, b in zip(labels, labels[1:]):
            gold[a, b] += 1
    values = np.zeros(len(names) + 4)
    first, second = np.zeros_like(values), np.zeros_like(values)
    add = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    for step in range(1, STEPS + 1):
        weights, pairs = values[:-4], values[-4:].reshape(2, 2)
        score = np.bincount(rows, weights[columns], place)
        emit = np.stack([np.zeros_like(score), score], axis=-1)[index]
        forward, backward = np.zeros((steps, n, 2)), np.zeros((steps, n, 2))
        forward[0] = emit[:, 0]
        for t in range(1, steps):
            moved = add(forward[t - 1][:, :, None] + pairs[None], 1) + emit[:, t]
            forward[t] = np.where(mask[:, t, None], moved, forward[t - 1])
        for t in range(steps - 2, -1, -1):
            moved = add(pairs[None] + (emit[:, t + 1] + backward[t + 1])[:, None, :], 2)
            backward[t] = np.where(mask[:, t + 1, None], moved, 0)
        whole = add(forward[-1], 1)
        chance = np.exp(forward[:, :, 1] + backward[:, :, 1] - whole[None]).T
        per_block = np.zeros(place)
        per_block[index[mask]] = chance[mask]
        expected = np.zeros((2, 2))
        for t in range(1, steps):
            both = forward[t - 1][:, :, None] + pairs[None] + (emit[:, t] + backward[t])[:, None, :]
            expected += (np.exp(both - whole[:, None, None]) * mask[:, t, None, None]).sum(axis=0)
        gradient = np.concatenate([np.bincount(columns, (per_block - y)[rows], len(names)), (expected - gold).ravel()]) / n
        gradient += DECAY * values
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        values = values - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field(dict(zip(names, values[:-4].tolist())), values[-4:].reshape(2, 2))


# --- labelled pages ----------------------------------------------------------

# Usual names of what surrounds a text, and of the text itself.
OTHER_NAMES = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav links",
    "header": "header masthead banner top site-header branding logo",
    "footer": "footer bottom site-footer copyright colophon legal",
    "aside": "sidebar aside related widget popular more recommended trending",
    "notice": "cookie notice consent gdpr banner alert popup modal overlay",
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion",
    "form": "form newsletter subscribe signup search login contact",
    "comments": "comments comment reply replies discussion disqus responses",
    "share": "share social sharing tags meta toolbar",
}
MAIN_NAMES = "content article post entry story main body text article-body post-content entry-content main-content article-text"
_OTHER_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}


def markup_labels(blocks: list[Block]) -> list[int]:
    """Labels that the markup itself gives: below article or main, and below nothing that surrounds a text."""
    other = {f"in {tag}" for tag in _OTHER_TAGS.values()} | {"in head", "in title"}
    other |= {f"name {name}" for names in OTHER_NAMES.values() for name in names.split() if "-" not in name}
    main = {"in article", "in main"}
    return [int(bool(main & set(b.above)) and not other & set(b.above)) for b in blocks]


def _element(rng, tag: str, name: str, inner: str) -> str:
    style = rng.integers(4)
    attribute = "" if not name else f' class="{name}"' if style < 2 else f' id="{name}"' if style < 3 else f' class="x-{name} y{rng.integers(9)}"'
    return f"<{tag}{attribute}>{inner}</{tag}>"


def rearranged(rng, main: list[str], other: list[str], foreign: list[str]) -> tuple[str, list[int]]:
    """A page of another layout with the given main texts; other texts stand around them."""
    pick = lambda items: items[rng.integers(len(items))] if len(items) else "more"
    escaped = lambda text: html.escape(text, quote=False)
    page, labels = [], []

    def surround(kind: str) -> tuple[str, int]:
        name = pick(OTHER_NAMES[kind].split())
        tag = _OTHER_TAGS.get(kind, "div")
        if rng.random() < 0.4:
            tag = ["div", "section"][rng.integers(2)]
        elif rng.random() < 0.5 and tag != "div":
            name = ""
        n = int(rng.integers(1, 5))
        texts = [pick(foreign if kind in ("comments", "aside") and rng.random() < 0.8 else other) for _ in range(n)]
        if kind in ("nav", "share") or kind == "aside" and rng.random() < 0.4:
            words = [pick(t.split()) for t in texts]
            inner = "<ul>" + "".join(f'<li><a href="/x">{escaped(w)}</a></li>' for w in words) + "</ul>"
        elif kind == "form":
            inner = "".join(f"<label>{escaped(t)}</label><input><p>{escaped(t)}</p>" for t in texts)
            n *= 1
        else:
            inner = "".join(f"<{q}>{escaped(t)}</{q}>" for t, q in zip(texts, [pick(["p", "div", "p"])] * n))
        return _element(rng, tag, name, inner), 0

    def put(element: str):
        page.append(element)

    kinds = list(OTHER_NAMES)
    before = [k for k in ("notice", "header", "nav", "ad", "form", "aside") if rng.random() < 0.5]
    after = [k for k in ("share", "ad", "aside", "comments", "form", "notice", "footer") if rng.random() < 0.5]
    inside = pick([*kinds, "comments", "comments", "ad"]) if rng.random() < 0.6 else ""
    for kind in before:
        put(surround(kind)[0])
    body, cut = [], int(rng.integers(1, len(main) + 1)) if main else 0
    for n, text in enumerate(main):
        tag = "h1" if n == 0 and rng.random() < 0.6 else ["p", "p", "p", "div", "li", "blockquote", "h2"][rng.integers(7)]
        body.append(f'<{tag} data-main="1">{escaped(text)}</{tag}>')
        if inside and n + 1 == cut:
            body.append(surround(inside)[0])
    shell = rng.integers(4)
    if shell == 0:
        put(f"<article>{''.join(body)}</article>")
    elif shell == 1:
        put(f"<main>{''.join(body)}</main>")
    else:
        put(_element(rng, ["div", "section"][rng.integers(2)], pick(MAIN_NAMES.split()), "".join(body)))
    for kind in after:
        put(surround(kind)[0])
    whole = f"<html><head><title>{escaped(pick(main or other))}</title></head><body>{''.join(page)}</body></html>"
    marked = blocks_of(re.sub(r' data-main="1"', ' class="zzmain"', whole))
    labels = [int("name zzmain" in b.above) for b in marked]
    return whole.replace(' data-main="1"', ""), labels


def without_names(rng, main: list[str], other: list[str], foreign: list[str]) -> tuple[str, list[int]]:
    """A page without class names or telling tags; what surrounds the text is told apart by links and by its wording."""
    pick = lambda items: items[rng.integers(len(items))] if len(items) else "more"
    escaped = lambda text: html.escape(text, quote=False)
    short = lambda text: " ".join(text.split()[: int(rng.integers(1, 9))])
    n_links = lambda: int(rng.integers(1, 8))

    def wrapped(tag: str, inner: str) -> str:
        return f"<table><tr><td>{inner}</td></tr></table>" if tag == "td" else f"<{tag}>{inner}</{tag}>" if tag else inner

    def surround(kind: str) -> str:
        if kind == "links":
            item = ["<li>{}</li>", "<div>{}</div>", "{} ", "<p>{}</p>"][rng.integers(4)]
            inner = "".join(item.format(f'<a href="/x">{escaped(short(pick(other + foreign)))}</a>') for _ in range(n_links()))
            inner = f"<ul>{inner}</ul>" if item.startswith("<li") else inner
        elif kind == "advert":
            inner = f'<a href="/x">{escaped(pick(other))}</a>'
        elif kind == "rights":
            inner = f"<p>© {rng.integers(1990, 2030)} {escaped(short(pick(other)))}</p>"
        elif kind == "form":
            inner = f"<form><label>{escaped(short(pick(other)))}</label><input><button>{escaped(short(pick(other)))}</button></form>"
        else:
            inner = "".join(f"<p>{escaped(short(pick(other + foreign)))}</p>" for _ in range(n_links()))
        return wrapped(["div", "div", "section", "td"][rng.integers(4)], inner)

    tags = ["p", "p", "div"][rng.integers(3)]
    body = []
    for n, text in enumerate(main):
        tag = "h1" if n == 0 and rng.random() < 0.4 else tags
        body.append(f'<{tag} data-main="1">{escaped(text)}</{tag}>')
    if rng.random() < 0.5:
        body.insert(int(rng.integers(0, len(body) + 1)), surround(pick(["advert", "links"])))
    kinds = ["links", "advert", "rights", "form", "replies"]
    before = [surround(k) for k in ("links", "advert", "form") if rng.random() < 0.6]
    after = [surround(k) for k in kinds if rng.random() < 0.4]
    inner = wrapped(["div", "section", "td", ""][rng.integers(4)], "".join(body))
    inner = wrapped(["div", "section", "", ""][rng.integers(4)], inner)
    whole = f"<html><head><title>{escaped(pick(main or other))}</title></head><body>{''.join([*before, inner, *after])}</body></html>"
    marked = blocks_of(whole.replace(' data-main="1"', ' class="zzmain"'))
    return whole.replace(' data-main="1"', ""), [int("name zzmain" in b.above) for b in marked]


def training_pages(sample: list[str], seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: the sampled ones as their markup labels them, and three made of the texts of each.

    Two have other layouts, one has neither class names nor telling tags.
    """
    rng = np.random.default_rng(seed)
    given = []
    for page in sample:
        blocks = blocks_of(page)
        given.append((blocks, markup_labels(blocks)))
    labelled = [(b, y) for b, y in given if any(y)]
    mains = [[x.text for x, label in zip(b, y) if label] for b, y in labelled]
    foreign = [text for texts in mains for text in texts]
    out = list(labelled)
    for n, (blocks, y) in enumerate(labelled):
        other = [x.text for x, label in zip(blocks, y) if not label] or ["more"]
        for make in (rearranged, rearranged, without_names):
            page, labels = make(rng, mains[n], other, foreign)
            out.append((blocks_of(page), labels))
    return out


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, html_column: str = "html") -> Field:
    """Fit on pages made of at most ``sample_pages`` distinct pages, those with the smallest hash."""
    whole = pages.where(F.length(html_column) > 0).select(F.xxhash64(html_column).alias("_hash"), F.col(html_column).alias("_html"))
    # Hashes alone are shuffled to choose the sample; of the chosen pages one copy a task goes on.
    last = whole.select("_hash").distinct().orderBy("_hash").limit(sample_pages).agg(F.max("_hash")).first()[0]
    if last is None:
        return fit([])
    rows = whole.where(F.col("_hash") <= last).groupBy("_hash").agg(F.min("_html").alias("_html")).collect()
    return fit(training_pages(sorted(row["_html"] for row in rows)))


TEXT = [T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)]


def extract(pages: DataFrame, model: Field, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Append ``text`` (blocks of main text, one per line; empty if none) and ``n_chars``.

    Null html counts as empty; broken markup is read as far as it goes. Input
    columns with these names give way.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value

        def compute(batch):
            texts = [model.text(page or "") for page in batch.column(html_column).to_pylist()]
            return [pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]

        return compute

    return append_columns(pages, html_column, TEXT, start, keep)
