"""Main text of web pages by a recurrent block labeller (numpy bidirectional LSTM)."""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_DIM, WORD_DIM, PLAIN_DIM = 96, 48, 8
INPUT = PATH_DIM + WORD_DIM + PLAIN_DIM
HIDDEN = 20
#: Pages of the given table that the labeller may learn from, at most; and made-up layouts.
TRAIN_PAGES, TRAIN_PAGE_BYTES, MADE_PAGES = 300, 1 << 16, 700
EPOCHS, BATCH, RATE = 8, 32, 0.02
#: Padded cells (pages times blocks) that are classified at once.
CELLS = 1 << 14

# Fixed values of HTML: elements whose content is no text (markup of its own, or characters up to the end tag), elements
# without content, and block elements. A head is left to its elements, as its end tag, and even a start, may be missing.
NESTED = set("template object svg math select".split())
OPAQUE = set("script style noscript iframe textarea title".split())
VOID = set("area base br col embed head hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup "
             "option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSED_BY = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
             "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
NOT_IN_P = BLOCKS - {"button", "label", "option"}

COMMENT = r"<!--.*?(?:-->|\Z)"
RAW_TAG = (r"<(?P<close>/?)(?P<raw>" + "|".join(sorted(NESTED | OPAQUE))
           + r")(?=[\s/>])(?>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)")
RAW = re.compile(COMMENT + "|" + RAW_TAG, re.S | re.I)
TOKEN = re.compile(
    COMMENT + "|" + RAW_TAG
    + r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I)
#: What ends an opaque element, or tells that it has no end: a script may name its own start tag, the others may not.
ENDS = {t: re.compile(rf"<(/?){t}(?=[\s/>])[^>]*>" if t not in ("script", "style") else rf"<(/){t}(?=[\s/>])[^>]*>", re.I) for t in OPAQUE}
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def raw_ends(page: str) -> dict[int, int]:
    """Start and end of every element whose content is no text. Elements that nothing closes are left out."""
    ends, at, gone = {}, 0, set()
    open_: dict[str, list[int]] = {t: [] for t in NESTED}
    while m := RAW.search(page, at):
        at = m.end()
        if m["raw"] is None:
            continue
        tag, empty = m["raw"].lower(), m[0].endswith("/>")
        if tag in NESTED:
            if m["close"]:
                if open_[tag]:
                    ends[open_[tag].pop()] = at
            elif not (empty and tag in ("svg", "math")):
                open_[tag].append(m.start())
        elif not m["close"] and tag not in gone and not (empty and (open_["svg"] or open_["math"])):
            end = ENDS[tag].search(page, at)
            if end is None:
                gone.add(tag)
            elif end[1]:
                ends[m.start()] = at = end.end()
    return ends


def blocks(page: str) -> list[tuple[tuple, str, float]]:
    """(path, text, share of its characters in links) of every block with text, in page order.

    A block is text between starts and ends of block elements; inline elements and line breaks don't
    end it. The path holds, from the root, tag names and the parts of their class, id and role. Of scripts, images and
    other elements without text the whole content is left out; of one that nothing closes, the tag alone.
    """
    out, stack, text, linked, size, start = [], [], [], 0, 0, 0

    def flush():
        nonlocal linked, size
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                path = tuple(p for _, own in stack for p in own)
                out.append((path, joined, linked / max(size, 1)))
            text.clear()
        linked = size = 0

    def add(s):
        nonlocal linked, size
        if s:
            text.append(s)
            n = len(s) - s.count(" ")
            size += n
            if any(t == "a" for t, _ in stack):
                linked += n

    def close(tag, until=()):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == tag:
                if any(t in BLOCKS for t, _ in stack[k:]):
                    flush()
                del stack[k:]
                return
            if stack[k][0] in until:
                return

    raw = raw_ends(page)
    while m := TOKEN.search(page, start):
        add(page[start:m.start()])
        start = raw.get(m.start(), m.end())
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag in BLOCKS:
                flush()
            close(tag)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            flush()
            if tag in NOT_IN_P:
                close("p", {"td", "th", "div", "article", "section", "body", "button"})
            if tag in CLOSED_BY:
                for same in ({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}):
                    close(same, CLOSED_BY[tag])
        if tag in VOID:
            continue
        own = [tag]
        for found in NAMES.finditer(m["attrs"] or ""):
            own += ["." + p.lower() for p in PART.findall(found[1] or found[2] or found[3] or "")][:12]
        stack.append((tag, own))
    add(page[start:])
    flush()
    return out


def _hash(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


def features(page: list) -> np.ndarray:
    """A row a block: hashed tag path, hashed words, and plain measures."""
    x = np.zeros((len(page), INPUT), np.float32)
    spots: dict[str, int] = {}
    for i, (path, text, links) in enumerate(page):
        for p in dict.fromkeys([*path, "/".join(path[-2:]), "leaf:" + (path[-1] if path else "")]):
            spot = spots.get(p)
            if spot is None:
                spot = spots[p] = _hash(p, PATH_DIM)
            x[i, spot] = 1
        words = text.split()
        for w in words:
            x[i, PATH_DIM + _hash(w.lower(), WORD_DIM)] += 1
        x[i, PATH_DIM:PATH_DIM + WORD_DIM] /= np.sqrt(len(words))
        n = len(text)
        x[i, -PLAIN_DIM:] = (np.log1p(n) / 6, np.log1p(len(words)) / 4, links, links > 0.6, text[-1] in ".!?:\"'",
                             sum(c in ",.;" for c in text) / n * 10, i / len(page), 1)
    return x


class Labeller:
    """A bidirectional LSTM over the blocks of a page, and a logistic unit a block."""

    def __init__(self, rng):
        def matrix(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.p = {}
        for d in "fb":
            self.p["x" + d], self.p["h" + d] = matrix(INPUT, 4 * HIDDEN) * 0.5, matrix(HIDDEN, 4 * HIDDEN)
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN:2 * HIDDEN] = 1
            self.p["c" + d] = bias
        self.p["o"], self.p["z"] = matrix(2 * HIDDEN, 1)[:, 0], np.zeros(1)

    def forward(self, x, mask, keep=False):
        """Probabilities (pages, blocks) of padded features; ``mask`` tells the blocks from the padding."""
        n, steps, _ = x.shape
        hidden, trace = np.zeros((n, steps, 2 * HIDDEN)), {}
        for k, d in enumerate("fb"):
            pre = x.reshape(n * steps, -1) @ self.p["x" + d] + self.p["c" + d]
            pre = pre.reshape(n, steps, -1)
            h, c, saved = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), []
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                g = pre[:, t] + h @ self.p["h" + d]
                gates = 1 / (1 + np.exp(-np.clip(g[:, :3 * HIDDEN], -30, 30)))
                i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
                u = np.tanh(g[:, 3 * HIDDEN:])
                on = mask[:, t, None]
                c2 = np.where(on, f * c + i * u, c)
                tc = np.tanh(c2)
                h2 = np.where(on, o * tc, h)
                if keep:
                    saved.append((t, h, c, i, f, o, u, tc))
                h, c = h2, c2
                hidden[:, t, k * HIDDEN:(k + 1) * HIDDEN] = h
            trace[d] = saved
        prob = 1 / (1 + np.exp(-np.clip(hidden @ self.p["o"] + self.p["z"][0], -30, 30)))
        return (prob, hidden, trace) if keep else prob

    def gradients(self, x, mask, y):
        prob, hidden, trace = self.forward(x, mask, True)
        err = np.where(mask, prob - y, 0) / mask.sum()
        g = {"o": np.einsum("nt,nth->h", err, hidden), "z": np.array([err.sum()])}
        for k, d in enumerate("fb"):
            dhid = err[:, :, None] * self.p["o"][k * HIDDEN:(k + 1) * HIDDEN]
            dpre = np.zeros((*mask.shape, 4 * HIDDEN))
            gh = np.zeros_like(self.p["h" + d])
            dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
            for t, h, c, i, f, o, u, tc in reversed(trace[d]):
                on = mask[:, t, None]
                dh = dh + dhid[:, t]
                dcell = np.where(on, dc + dh * o * (1 - tc * tc), 0)
                dg = np.concatenate([dcell * u * i * (1 - i), dcell * c * f * (1 - f),
                                     np.where(on, dh * tc, 0) * o * (1 - o), dcell * i * (1 - u * u)], axis=1)
                dpre[:, t] = dg
                gh += h.T @ dg
                dh = np.where(on, dg @ self.p["h" + d].T, dh)
                dc = np.where(on, dcell * f, dc)
            flat = dpre.reshape(-1, 4 * HIDDEN)
            g["x" + d], g["h" + d], g["c" + d] = x.reshape(len(flat), -1).T @ flat, gh, flat.sum(0)
        return g

    def fit(self, pages, labels, rng):
        """Adam over batches of pages of like length."""
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        by_size = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        groups = [by_size[i:i + BATCH] for i in range(0, len(by_size), BATCH)]
        for _ in range(EPOCHS):
            for k in rng.permutation(len(groups)):
                x, mask = padded([pages[i] for i in groups[k]])
                y = np.zeros(mask.shape)
                for r, i in enumerate(groups[k]):
                    y[r, :len(labels[i])] = labels[i]
                step += 1
                for name, g in self.gradients(x, mask, y).items():
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.01 * (g * g - second[name])
                    self.p[name] -= RATE * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)


def padded(pages):
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), steps, INPUT)), np.zeros((len(pages), steps), bool)
    for i, p in enumerate(pages):
        x[i, :len(p)], mask[i, :len(p)] = p, True
    return x, mask


# Names that page makers give to the parts of a page.
CONTENT_NAMES = "post content entry-content article-body story post-body main-content text body-text article__content".split()
MENU_NAMES = "menu navbar nav-menu top-bar breadcrumb breadcrumbs site-nav pagination tabs toolbar".split()
ASIDE_NAMES = "sidebar side-bar widget related related-posts recommended trending promo tags archive".split()
NOTICE_NAMES = "notice cookie cookie-banner consent alert banner popup modal newsletter subscribe disclaimer".split()
AD_NAMES = "ad ads advert advertisement sponsored sponsor ad-slot adsbox promo-box".split()
COMMENT_NAMES = "comments comment comment-list reply replies discussion respond reader-comments user-comment".split()
FOOT_NAMES = "footer site-footer copyright legal bottom credits social share share-buttons".split()
HEAD_NAMES = "header site-header masthead logo branding top page-header".split()


def _words(rng, n):
    parts = "an be ci de el fo ga he in jo ka le mo nu or pa re se ti un va wo xi za sch tion que ing en er".split()
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))


def _sentences(rng, n):
    return " ".join(_words(rng, int(rng.integers(4, 16))).capitalize() + rng.choice([".", ".", ".", "!", "?"]) for _ in range(n))


def made_page(rng) -> tuple[str, list[int]]:
    """A made-up page and, by block, whether it belongs to the article."""
    html, y = ["<html><head><title>", _words(rng, 4), "</title></head><body>"], []

    def put(s, label):
        html.append(s)
        y.append(label)

    def attr(names):
        return rng.choice(["", f' id="{rng.choice(names)}"', *[f' class="{rng.choice(names)}"'] * 3])

    def named(names, tags):
        tag = rng.choice(tags)
        return tag, f'<{tag} {rng.choice(["class", "class", "id"])}="{rng.choice(names)}">'

    def links(tag, head):
        html.append(head)
        html.append("<ul>")
        for _ in range(rng.integers(2, 9)):
            put(f'<li><a href="/x">{_words(rng, int(rng.integers(1, 4)))}</a></li>', 0)
        html.append(f"</ul></{tag}>")

    def menu():
        links(*(("nav", "<nav>") if rng.random() < 0.6 else named(MENU_NAMES, ["div", "nav", "section"])))

    def short(names, tags, sentences=(1, 4)):
        tag, head = named(names, tags) if rng.random() < 0.7 or tags[0] == "div" else (tags[0], f"<{tags[0]}>")
        html.append(head)
        if rng.random() < 0.4:
            put(f"<h3>{_words(rng, 2)}</h3>", 0)
        for _ in range(rng.integers(1, 3)):
            inner = rng.choice(["p", "p", "div", "span-less"])
            body = _sentences(rng, int(rng.integers(*sentences)))
            put(f"<{inner}>{body}</{inner}>" if inner != "span-less" else f"<p>{body}</p>", 0)
        html.append(f"</{tag}>")

    def form():
        html.append("<form>")
        put(f"<label>{_words(rng, 2)}</label><input>", 0)
        put(f"<button>{_words(rng, 1)}</button></form>", 0)

    def comments():
        tag, head = named(COMMENT_NAMES, ["div", "section", "ol", "aside"])
        html.append(head)
        for _ in range(rng.integers(1, 5)):
            put(f'<div class="comment"><p>{_sentences(rng, int(rng.integers(1, 4)))}</p></div>', 0)
        html.append(f"</{tag}>")

    def article():
        tag, head = ("article", f"<article{attr(CONTENT_NAMES)}>") if rng.random() < 0.65 else (
            ("main", f"<main{attr(CONTENT_NAMES)}>") if rng.random() < 0.4 else named(CONTENT_NAMES, ["div", "section", "div"]))
        html.append(head)
        if rng.random() < 0.85:
            put(f"<h1>{_words(rng, int(rng.integers(3, 9)))}</h1>", 1)
        for _ in range(rng.integers(1, 14)):
            kind = rng.random()
            body = _sentences(rng, int(rng.integers(1, 12)))
            if kind < 0.7:
                put(rng.choice([f"<p>{body}</p>", f"<p>{body}", f"<p><b>{body}</b></p>", f"<p>{body} <a href='/y'>{_words(rng, 2)}</a></p>",
                                f"<p>{_words(rng, 2)}.</p>"]), 1)
            elif kind < 0.78:
                put(f"<h2>{_words(rng, 3)}</h2>", 1)
            elif kind < 0.86:
                html.append("<ul>")
                for _ in range(rng.integers(1, 5)):
                    put(f"<li>{_sentences(rng, 1)}</li>", 1)
                html.append("</ul>")
            elif kind < 0.92:
                put(f"<blockquote>{body}</blockquote>", 1)
            elif rng.random() < 0.6:
                short(AD_NAMES + ASIDE_NAMES, ["div", "aside"], (1, 3))
            else:
                put(f"<div>{body}</div>", 1)
        if rng.random() < 0.2:
            comments()
        html.append(f"</{tag}>")

    pre = [menu, lambda: short(HEAD_NAMES, ["header", "div"], (1, 2)), lambda: short(AD_NAMES, ["div", "div", "aside"]),
           lambda: short(NOTICE_NAMES, ["div", "section"]), form, lambda: short(ASIDE_NAMES, ["aside", "div"])]
    post = [lambda: short(FOOT_NAMES, ["footer", "footer", "div"]), menu, comments, form, lambda: short(ASIDE_NAMES, ["aside", "div"]),
            lambda: short(AD_NAMES, ["div", "div"]), lambda: short(NOTICE_NAMES, ["div", "section"])]
    for k in rng.permutation(len(pre))[:rng.integers(0, 5)]:
        pre[k]()
    if rng.random() < 0.96:
        article()
    for k in rng.permutation(len(post))[:rng.integers(0, 5)]:
        post[k]()
    html.append("</body></html>")
    return "".join(html), y


BOILERPLATE = {"nav", "footer", "header", "aside", "form", *(f".{p}" for n in MENU_NAMES + ASIDE_NAMES + NOTICE_NAMES + AD_NAMES
                                                            + COMMENT_NAMES + FOOT_NAMES for p in n.split("-"))} - {".page", ".top", ".box", ".user", ".side", ".site", ".list"}


def marked(page: list) -> list[int] | None:
    """Labels of a real page that marks its article by an element; None for one that doesn't."""
    if not any("article" in path for path, _, _ in page):
        return None
    return [int("article" in path and not BOILERPLATE.intersection(path)) for path, _, _ in page]


def train(pages: DataFrame, html_col: str) -> dict:
    """The labeller's weights, from made-up layouts and at most ``TRAIN_PAGES`` pages of the table
    (lowest hash first, of at most ``TRAIN_PAGE_BYTES``) that mark their article by an element."""
    rng = np.random.default_rng(11)
    x, y = [], []
    while len(x) < MADE_PAGES:
        page, labels = made_page(rng)
        found = blocks(page)
        if len(found) == len(labels) and found:
            x.append(features(found))
            y.append(labels)
    sample = (pages.select(F.col(html_col).cast("string").alias("h")).filter(F.octet_length("h") <= TRAIN_PAGE_BYTES)
              .orderBy(F.xxhash64("h"), "h").limit(TRAIN_PAGES).collect())
    for r in sample:
        found = blocks(r.h)
        labels = marked(found) if found else None
        if labels is not None:
            x.append(features(found))
            y.append(labels)
    net = Labeller(rng)
    net.fit(x, y, rng)
    return net.p


def label_pages(net: Labeller, pages: list[list]) -> list[np.ndarray]:
    """For each page's blocks, whether they belong to the article."""
    out = [np.zeros(len(p), bool) for p in pages]
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and len(pages[order[to]]) * (to + 1 - at) <= CELLS:
            to += 1
        x, mask = padded([features(pages[i]) for i in order[at:to]])
        prob = net.forward(x, mask)
        for r, i in enumerate(order[at:to]):
            out[i] = prob[r, :len(pages[i])] >= 0.5
        at = to
    return out


def _extracted(weights):
    def run(batches):
        import pyarrow as pa

        net = Labeller(np.random.default_rng(0))
        net.p = weights.value
        for b in batches:
            raw = b.column("html").to_pylist()
            texts, counts = [], []
            for i in range(0, len(raw), 256):
                found = [blocks(h or "") for h in raw[i:i + 256]]
                for page, keep in zip(found, label_pages(net, found)):
                    texts.append("\n".join(t for (_, t, _), k in zip(page, keep) if k))
                    counts.append((len(page), int(keep.sum())))
            names = [n for n in b.schema.names if n != "html"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64())],
                names=[*names, "text", "n_chars", "n_blocks", "n_kept"])
    return run


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The article of every page, from its whole html.

    A page becomes a sequence of text blocks, with hashed tag-path and word vectors; a bidirectional LSTM,
    trained here in numpy, labels each block from the whole sequence. A tag-path vector hashes every element's name and the
    first twelve words of each class, id or role attribute; the text itself is never cut. Kept blocks are joined
    in page order by a line feed; character references are decoded, white space inside a block is one space.

    Returns id, url, ``text``, ``n_chars`` (code points), ``n_blocks`` and ``n_kept``. Null and empty html give an
    empty text. Repeated rows are extracted each; null ids and urls are kept; an empty table gives no rows; further columns
    are not read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    weights = spark.sparkContext.broadcast(train(rows, "html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = rows.mapInArrow(_extracted(weights), f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long, n_blocks long, n_kept long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
