"""Main text of web pages by a linear-chain CRF over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between the tags of block
elements.  A block's features are its ancestors' tags and class words and
shapes of its text.  The chain labels every block as article or not; weights
are fitted by the exact likelihood (forward-backward) on labelled pages, and
pages are decoded by Viterbi.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ------------------------------------------------------------------ leaf blocks

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
                  r"([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*|[^>]*)>", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
                    re.I)
_WORD = re.compile(r"[a-z]+")
# fixed values of HTML: elements whose content is no part of the text, that never close, that begin a block
_RAW = {"script", "style", "template", "textarea", "iframe", "noframes", "xmp"}
_APART = {"text", "desc"}     # parts of svg that are words of their own
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol "
             "optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
#: An open element of the second kind ends when one of the first kind begins.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
_SCOPE = {"ul", "ol", "dl", "table", "select", "div", "section", "article", "main", "body", "html", "form", "nav",
          "aside", "header", "footer", "blockquote"}


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]
    words: frozenset[str]        # of the ancestors' class, id and role
    linked: float                # share of the text inside links


def _own_words(attributes: str) -> frozenset[str]:
    out = set()
    for name, a, b, c in _NAMED.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() in ("class", "id", "role"):
            out.update(_WORD.findall(value))
        elif name.lower() == "hidden" or name.lower() == "aria-hidden" and value == "true" \
                or name.lower() == "style" and "none" in value and "display" in value:
            out.add("hidden")
    return frozenset(out)


def leaf_blocks(page: str | None) -> list[Block]:
    """The page's text blocks in order: character references decoded, white
    space as one blank, empty blocks left out."""
    page, at, out = page or "", 0, []
    tags, words, run, linked, size = [], [frozenset()], [], 0, 0
    loose = False                # no template closes from here on

    def flush():
        nonlocal run, linked, size
        text = " ".join("".join(run).split())
        if text:
            out.append(Block(text, tuple(tags), words[-1], linked / max(1, size)))
        run, linked, size = [], 0, 0

    def close(down_to: int):
        del tags[down_to:], words[down_to + 1:]

    def add(chunk: str):
        nonlocal linked, size
        if "&" in chunk:
            chunk = entities.unescape(chunk)
        run.append(chunk)
        size += len(chunk)
        if "a" in tags:
            linked += len(chunk)

    while m := _TAG.search(page, at):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in _APART:
            run.append(" ")
        empty = (m[3] or "").rstrip().endswith("/")
        end = None
        if name in _RAW and not m[1] and not (empty and ("svg" in tags or "math" in tags)) \
                and not (loose and name == "template"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if not end and name != "template":           # these hold the rest of the page as raw text
                at = len(page)
                continue
            loose = loose or not end
        if m[1]:
            if name in _BLOCK:
                flush()
            if name in tags:
                close(len(tags) - 1 - tags[::-1].index(name))
        elif end:
            at = end.end()
        elif name in _VOID:
            if name == "hr":
                flush()
            else:
                run.append(" " if name == "br" else "")
        else:
            if name in _BLOCK:
                flush()
                if "p" in tags and name not in ("label", "button", "option", "optgroup", "select", "title"):
                    close(len(tags) - 1 - tags[::-1].index("p"))
                for up in range(len(tags) - 1, -1, -1):
                    if tags[up] in _ENDS.get(name, ()):
                        close(up)
                        break
                    if tags[up] in _SCOPE:
                        break
            if not empty:
                tags.append(name)
                words.append(words[-1] | _own_words(m[3]) if m[3] else words[-1])
    if at < len(page):
        add(page[at:])
    flush()
    return out


# --------------------------------------------------------------------- features

#: Class and id words that hint at a block's role.
_HINTS = {
    "ad": "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored adsbygoogle",
    "nav": "nav navbar navigation menu menus breadcrumb breadcrumbs toc pagination pager tabs links",
    "side": "sidebar side aside widget widgets related recommended trending rail complementary more popular",
    "foot": "footer foot copyright legal colophon bottom contentinfo",
    "head": "header masthead topbar logo brand top toolbar",
    "talk": "comment comments reply replies respond disqus discussion commentlist feedback reviews",
    "form": "form login signin signup search subscribe subscription newsletter contact register",
    "note": "notice cookie cookies consent gdpr alert popup modal overlay toast privacy warning message hidden",
    "share": "share social sharing follow tags tag author byline meta",
    "text": "article content post entry story main text body page paragraph prose",
}
_ROLE = {w: role for role, words in _HINTS.items() for w in words.split()}


def block_features(blocks: list[Block]) -> list[list[str]]:
    out = []
    for n, b in enumerate(blocks):
        size = b.text.count(" ") + 1
        last = b.text[-1]
        own = [f"own={next((t for t in reversed(b.tags) if t in _BLOCK), '')}",
               f"size={min(7, size.bit_length())}", f"links={int(b.linked * 3.99)}",
               f"stop={last in '.!?…:;'}", f"first={n == 0}", f"last={n == len(blocks) - 1}",
               f"sign={b.text[0] in '©|»•<' or '©' in b.text}", f"commas={min(3, b.text.count(','))}"]
        own += {f"in={t}" for t in b.tags if t in _BLOCK or t == "a"}
        own += {f"role={_ROLE[w]}" for w in b.words if w in _ROLE}
        out.append(own)
    return out


# ------------------------------------------------------------------------- CRF

@dataclass(frozen=True)
class Crf:
    """Two labels (0 other, 1 article): a weight a feature and label, one for
    each pair of neighbours, and one for the first label."""

    names: dict[str, int]
    emit: np.ndarray         # (features, 2)
    pair: np.ndarray         # (2, 2)
    first: np.ndarray        # (2,)

    def scores(self, features: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(features), 2))
        for n, own in enumerate(features):
            known = [self.names[f] for f in own if f in self.names]
            if known:
                out[n] = self.emit[known].sum(axis=0)
        return out

    def decode(self, features: list[list[str]]) -> list[int]:
        """Viterbi: the most probable labels of the whole chain."""
        if not features:
            return []
        (p00, p01), (p10, p11) = self.pair.tolist()
        rows = self.scores(features).tolist()
        a, b, back = self.first[0] + rows[0][0], self.first[1] + rows[0][1], []
        for e0, e1 in rows[1:]:
            from0, from1 = b + p10 > a + p00, b + p11 > a + p01
            back.append((from0, from1))
            a, b = max(a + p00, b + p10) + e0, max(a + p01, b + p11) + e1
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(pages: list[tuple[list[list[str]], list[int]]], steps: int = 120, ridge: float = 2e-3) -> Crf:
    """Maximum likelihood with a ridge, by full-batch gradient steps (Adam)."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: -len(p[0]))
    names = {f: i for i, f in enumerate(sorted({f for page, _ in pages for own in page for f in own}))}
    if not pages:
        return Crf({}, np.zeros((0, 2)), np.zeros((2, 2)), np.zeros(2))
    n, longest, width = len(pages), len(pages[0][0]), len(names)
    x = np.zeros((n, longest, width))
    y = np.zeros((n, longest), np.int64)
    there = np.zeros((n, longest), bool)
    for i, (page, labels) in enumerate(pages):
        there[i, :len(page)], y[i, :len(page)] = True, labels
        for t, own in enumerate(page):
            x[i, t, [names[f] for f in own]] = 1
    seen, gold = x[there], np.eye(2)[y] * there[..., None]
    goal_emit = seen.T @ np.eye(2)[y[there]]
    both = there[:, 1:] & there[:, :-1]
    goal_pair = np.zeros((2, 2))
    np.add.at(goal_pair, (y[:, :-1][both], y[:, 1:][both]), 1)
    goal_first = gold[:, 0].sum(axis=0)
    theta = [np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2)]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        emit, pair, first = theta
        e = np.zeros((n, longest, 2))
        e[there] = seen @ emit
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = first + e[:, 0]
        for t in range(1, longest):
            new = _log_sum(alpha[:, t - 1, :, None] + pair, 1) + e[:, t]
            alpha[:, t] = np.where(there[:, t, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _log_sum(pair + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(there[:, t + 1, None], new, 0.0)
        z = _log_sum(alpha[:, 0] + beta[:, 0], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * there[..., None]
        edge = np.exp(alpha[:, :-1, :, None] + pair + (e[:, 1:] + beta[:, 1:])[:, :, None, :]
                      - z[:, None, None, None]) * both[..., None, None]
        grads = [(goal_emit - seen.T @ p[there]) / n - ridge * emit,
                 (goal_pair - edge.sum(axis=(0, 1))) / n - ridge * pair,
                 (goal_first - p[:, 0].sum(axis=0)) / n - ridge * first]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            theta[k] = theta[k] + 0.1 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return Crf(names, *theta)


# -------------------------------------------------------------- labelled pages

#: Parts of pages that are not the article; T is a title, S a sentence, P a paragraph.
_OTHER = [
    "<nav><ul><li><a href='/a'>T</a></li><li><a href='/b'>T</a></li><li><a href='/c'>T</a></li></ul></nav>",
    "<div class='menu'><a href='/a'>T</a> <a href='/b'>T</a></div>",
    "<header><a href='/'>T</a><p>S</p></header>", "<div id='header'><h1>T</h1><p>S</p></div>",
    "<div class='ad'>S</div>", "<div class='advert-banner'><p>S</p></div>", "<div class='sponsored'><a href='/x'>S</a></div>",
    "<aside><h3>T</h3><p>S</p></aside>", "<div class='sidebar'><h3>T</h3><ul><li><a href='/a'>T</a></li></ul><p>P</p></div>",
    "<div class='related'><h4>T</h4><ul><li><a href='/a'>S</a></li><li><a href='/b'>S</a></li></ul></div>",
    "<div class='cookie-notice'><p>S</p><button>T</button></div>", "<div role='alert' class='notice'>S</div>",
    "<form action='/s'><label>T</label><input name='q'><button>T</button></form>",
    "<form class='newsletter'><p>S</p><input><button>T</button></form>",
    "<section class='comments'><h3>T</h3><div class='comment'><p>P</p></div><div class='comment'><p>S</p></div></section>",
    "<div id='comments'><ul><li>P</li><li>S</li></ul></div>", "<div class='share'><a href='/f'>T</a> <a href='/g'>T</a></div>",
    "<footer><p>&copy; T</p><p>S</p></footer>", "<footer>&copy; T &middot; S</footer>", "<div class='footer'><a href='/p'>T</a> S</div>",
    "<ul class='breadcrumbs'><li><a href='/'>T</a></li><li>T</li></ul>",
]
_FRAMES = ["<article>X</article>", "<main>X</main>", "<main><article>X</article></main>", "<div class='content'>X</div>",
           "<div id='article-body'>X</div>", "<section class='post'>X</section>", "<div class='entry'><div>X</div></div>",
           "<div>X</div>", "<table><tr><td class='story'>X</td></tr></table>"]
_INNER = ["<p>P</p>", "<p>P</p>", "<p>P</p>", "<p>P S", "<p><b>S</b> P</p>", "<h2>T</h2>", "<h3>T</h3>", "<p>S</p>", "<ul><li>S</li><li>T</li></ul>",
          "<ol><li>S</li><li>S</li></ol>", "<blockquote><p>S</p></blockquote>", "<pre>S</pre>", "<div>P</div>",
          "<figure><img src='i'><figcaption>T</figcaption></figure>", "<table><tr><th>T</th><td>S</td></tr></table>",
          "<p><a href='/x'>T</a> P</p>", "<section><h2>T</h2><p>P</p></section>"]
_FILLER = "Some words of a page stand here, one after another, until the sentence ends."


def labelled_pages(sentences: list[str], n: int = 300, seed: int = 5) -> list[tuple[list[list[str]], list[int]]]:
    """Pages put together from the parts above and given sentences, with labels."""
    rng, sentences = random.Random(seed), sentences or [_FILLER]

    def text(kind: str) -> str:
        one = rng.choice(sentences)
        if kind == "T":
            return " ".join(one.split()[:rng.randint(1, 6)])
        return one if kind == "S" else " ".join(rng.choice(sentences) for _ in range(rng.randint(2, 6)))

    def filled(part: str) -> str:
        return re.sub(r"\b[TSP]\b(?=[^>]*(?:<|\Z))", lambda m: entities.escape(text(m[0])), part)

    out = []
    for _ in range(n):
        mark, parts = "\x00", [filled(p) for p in rng.sample(_OTHER, rng.randint(1, 4))]
        inner = ["<h1>T</h1>"] * (rng.random() < 0.8) + [rng.choice(_INNER) for _ in range(rng.randint(2, 9))]
        inner = [filled(p) for p in inner]
        for p in rng.sample(_OTHER, rng.choice((0, 0, 1, 2))):
            inner.insert(rng.randint(1, len(inner)), f"{mark}{filled(p)}{mark}")
        frame = rng.choice(_FRAMES).replace("X", f"{mark}{''.join(inner)}{mark}", 1)
        after = [filled(p) for p in rng.sample(_OTHER, rng.randint(1, 4))]
        title = f"<html><head><title>{filled('T')}</title></head><body>"
        page = title + "".join(parts) + frame + "".join(after) + "</body></html>"
        labels, blocks, inside = [], [], 0       # marks toggle: outside, article, part within it
        for b in leaf_blocks(page.replace(mark, f"<p>{mark}</p>")):
            if b.text == mark:
                inside += 1
                continue
            blocks.append(b)
            labels.append(inside % 2)
        out.append((block_features(blocks), labels))
    return out


def own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article itself (an article or main
    element); None for others.  Parts in it that the page names as something
    else are not the article."""
    if not any(t in ("article", "main") for b in blocks for t in b.tags):
        return None
    other = {"nav", "aside", "form", "footer", "header", "button", "select", "title"}
    return [int(any(t in ("article", "main") for t in b.tags) and not other & set(b.tags)
                and not any(_ROLE.get(w, "text") != "text" for w in b.words)) for b in blocks]


def train(pages: DataFrame, html_col: str = "html", max_pages: int = 300, max_chars: int = 200_000) -> Crf:
    """Fit on labelled pages: max_pages made of known parts with sentences of
    the table's pages, and at most max_pages of the table's own (those of the
    least hashes among pages of up to max_chars) that mark their article."""
    some = pages.select(F.col(html_col).alias("html")).where(F.length("html").between(1, max_chars))
    some = some.withColumn("h", F.xxhash64("html"))
    least = some.select("h").distinct().orderBy("h").limit(max_pages).agg(F.max("h")).first()[0]
    got = some.where(F.col("h") <= F.lit(least)).groupBy("h").agg(F.first("html").alias("html")).collect()
    own = [leaf_blocks(r["html"]) for r in sorted(got, key=lambda r: r["h"])]
    sentences = [s.strip() + "." for blocks in own for b in blocks for s in b.text.split(". ") if 2 < s.count(" ") < 40]
    marked = [(block_features(b), y) for b in own if (y := own_labels(b)) is not None]
    return fit(labelled_pages(sentences[:20_000], max_pages) + [m for m in marked if len(m[0]) <= 400])


def main_text(model: Crf, page: str | None) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, model.decode(block_features(blocks)), strict=True) if y)


def extract_text(pages: DataFrame, model: Crf, html_col: str = "html") -> DataFrame:
    """pages without the html, with `text` and `n_chars` (code points) behind
    the other columns; columns of these names are replaced.  Null and empty
    pages, and pages without an article, give an empty text."""
    names = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]

    def run(batches):
        for b in batches:
            text = [main_text(model, p) for p in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                names=[*names, "text", "n_chars"])

    kept = pages.select(*names)
    schema = kept.select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return pages.select(*names, html_col).mapInArrow(run, schema)
