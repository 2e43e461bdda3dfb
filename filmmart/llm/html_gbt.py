"""Main-text extraction by gradient-boosted trees over DOM nodes, decoded as a tree.

Every block element and text run of a page is a node with features: text and link density of its
subtree, tag and attribute tokens (its own and its ancestors'), depth, place, and statistics of
its siblings. Boosted regression trees give each node the odds of holding main text. Decoding takes
the likeliest labelling in which a node without main text has no descendant with any, so an
ancestor and a descendant never contradict each other; the runs labelled as main text are the
blocks of the result.

The trees are fitted on at most ``SAMPLE`` pages (smallest seeded hashes). Labelled are the sampled
pages that mark their article (``article`` or ``main``), and ``REBUILT`` pages put together from
paragraphs of the sample in random layouts, with and without telling element names, in which the
main text is known.

Edge cases: null or empty html and pages without main text give an empty string; cut-off markup is
read as far as it goes; very deep or long pages are read whole; repeated rows are treated
alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, prepare, read_table
from .dom import attribute_tokens, parse, walk

SAMPLE = 200
REBUILT = 500
TREES = 60
DEPTH = 4
RATE = 0.25
BINS = 32
SEED = 10

# Words that sites use in class, id and role for parts that are not the article, and for the article.
ASIDE = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments reply replies respond discussion
    disqus consent cookie cookies gdpr privacy copyright legal disclaimer colophon dialog modal popup overlay footer bottom form login signin signup
    register header masthead topbar top brand logo menu nav navbar navigation toolbar tabs pager pagination paging newsletter
    subscribe notice alert message announcement promo promoted promotion sponsor sponsored related recommended more popular
    trending share sharing social follow search sidebar side rail aside widget widgets skip tags tag hidden print""".split())
STORY = frozenset("article articlebody body content main post entry story text page single prose paragraph lede copy hentry".split())
GROUPS = (("nav", "menu", "ul", "ol", "li"), ("header", "hgroup"), ("footer", "address"), ("aside", "dialog", "details"), ("article", "main"),
          ("p", "blockquote", "pre", "dd"), ("h1", "h2", "h3", "h4", "h5", "h6", "dt", "caption", "figcaption"),
          ("form", "fieldset", "button", "select", "option"), ("div", "section", "center", "figure"),
          ("table", "thead", "tbody", "tfoot", "tr", "td", "th"), ("#text",), ("html", "body", "#root"))
_GROUP = {t: i for i, g in enumerate(GROUPS) for t in g}


def features(nodes: list) -> np.ndarray:
    """One row per node; nodes of one or more pages in ``walk`` order, so that a subtree is a stretch of rows."""
    n = len(nodes)
    for i, x in enumerate(nodes):
        x.at = i
    parent = [x.parent.at if x.parent else x.at for x in nodes]
    size, first = [1] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if parent[i] != i:
            size[parent[i]] += size[i]
    own, labelled, place, brothers, alike = [], [], [0.0] * n, [1.0] * n, [1.0] * n
    for i, x in enumerate(nodes):
        t = x.text
        first[i] = first[parent[i]] if parent[i] != i else i
        # chars, words, link chars, links, runs, marks, controls, nodes
        own.append((len(t), t.count(" ") + 1, x.links, x.n_links, 1, t.count(".") + t.count(",") + t.count("!") + t.count("?"), x.controls, 1)
                   if t else (0, 0, 0, 0, 0, 0, x.controls, 1))
        if x.attrs:
            words = attribute_tokens(x.attrs)
            style = x.attrs.get("style", "").replace(" ", "")
            hit = (sum([w in ASIDE for w in words]), sum([w in STORY for w in words]),
                   int("hidden" in x.attrs or x.attrs.get("aria-hidden") == "true" or "display:none" in style))
            if any(hit):
                labelled.append((i, *hit))
        kids = x.children
        if len(kids) > 1:
            same: dict = {}
            for k in kids:
                same[k.tag] = same.get(k.tag, 0) + 1
            share = 1 / len(kids)
            for j, k in enumerate(kids):
                place[k.at], brothers[k.at], alike[k.at] = j * share, len(kids), same[k.tag] * share
    own, parent, first = np.array(own, dtype=np.float64), np.array(parent), np.array(first)
    start = np.arange(n)
    end = start + np.array(size)
    hits = np.zeros((n, 3))
    if labelled:
        found = np.array(labelled)
        hits[found[:, 0]] = found[:, 1:]
    sums = np.zeros((n + 1, 8))
    np.cumsum(own, axis=0, out=sums[1:])
    total = sums[end] - sums[:-1]
    tag = np.array([_GROUP.get(x.tag, len(GROUPS)) for x in nodes])
    steps = np.zeros((n + 1, 3 + len(GROUPS) + 1))  # of the node and its ancestors, by entering and leaving subtrees
    steps[:n, :3] = hits
    steps[start, 3 + tag] += 1
    np.subtract.at(steps, (end, 3 + tag), 1)
    marked = np.flatnonzero(hits.any(axis=1))
    np.subtract.at(steps[:, :3], end[marked], hits[marked])
    above = np.cumsum(steps[:n], axis=0)
    chars, words = total[:, 0], total[:, 1]
    page = np.maximum(chars[first], 1)
    return np.column_stack([
        tag, np.array([x.depth for x in nodes]), np.log1p(chars), np.log1p(words), chars / total[:, 7], total[:, 2] / np.maximum(chars, 1),
        total[:, 3] / np.maximum(words, 1), words / np.maximum(total[:, 4], 1), total[:, 5] / np.maximum(words, 1), total[:, 6], np.log1p(total[:, 4]),
        chars / page, (sums[:-1, 0] - sums[first, 0]) / page, chars / np.maximum(chars[parent], 1), total[parent, 2] / np.maximum(chars[parent], 1),
        np.log1p(chars[parent]), words[parent] / np.maximum(total[parent, 4], 1), np.array(place), np.array(brothers), np.array(alike), tag[parent], hits, hits[parent], above])


class Trees:
    """Boosted regression trees of fixed depth on the logistic loss, splits at quantile bins."""

    def __init__(self, bias: float, trees: list) -> None:
        self.bias, self.trees = bias, trees  # a tree: (feature, threshold) per inner node, value per leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - (2 ** DEPTH - 1)]
        return out

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
        share = min(max(float((weight * y).sum() / weight.sum()), 1e-3), 1 - 1e-3)
        model = cls(float(np.log(share / (1 - share))), [])
        score, inner = np.full(len(y), model.bias), 2 ** DEPTH - 1
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            grad, hess = weight * (y - p), weight * p * (1 - p)
            feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
            at = np.zeros(len(y), dtype=np.int64)
            for level in range(DEPTH):
                first, width = 2 ** level - 1, 2 ** level
                local = at - first
                best = np.full(width, 1e-6)
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    key = local * (BINS + 1) + binned[:, j]
                    g = np.bincount(key, grad, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                    h = np.bincount(key, hess, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                    gl, hl, gs, hs = g[:, :len(c)], h[:, :len(c)], g[:, -1:], h[:, -1:]
                    gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
                    k = gain.argmax(axis=1)
                    top = gain[np.arange(width), k]
                    better = top > best
                    best[better] = top[better]
                    feature[first:first + width][better] = j
                    threshold[first:first + width][better] = c[k[better]]
                at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
            leaf = at - inner
            value = RATE * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + 1)
            model.trees.append((feature, threshold, value))
            score += value[leaf]
        return model

    def pack(self) -> bytes:
        parts = [np.array([self.bias]), *[a.astype(np.float64) for t in self.trees for a in t]]
        return np.concatenate(parts).tobytes()

    @classmethod
    def unpack(cls, blob: bytes) -> Trees:
        flat, inner = np.frombuffer(blob), 2 ** DEPTH - 1
        step, trees = 3 * inner + 1, []
        for a in range(1, len(flat), step):
            trees.append((flat[a:a + inner].astype(np.int64), flat[a + inner:a + 2 * inner], flat[a + 2 * inner:a + step]))
        return cls(float(flat[0]), trees)


def decode(nodes: list, odds: np.ndarray) -> list[bool]:
    """The labelling with the largest sum of log odds in which no node with main text has an ancestor without."""
    base = nodes[0].at
    parent = [x.parent.at - base if x.parent else 0 for x in nodes]
    gain = odds.tolist()
    gain[0] = 0.0  # the root of every page is open
    for i in range(len(nodes) - 1, 0, -1):
        if gain[i] > 0:
            gain[parent[i]] += gain[i]
    keep = [True] * len(nodes)
    for i in range(1, len(nodes)):
        keep[i] = keep[parent[i]] and gain[i] > 0
    return keep


def extract(pages: list, model: Trees) -> list[str]:
    """The main text of each page: its blocks in page order, joined by two line breaks."""
    trees = [walk(parse(p or "")) for p in pages]
    if not trees:
        return []
    odds = model.log_odds(features([x for t in trees for x in t]))
    out, at = [], 0
    for nodes in trees:
        keep = decode(nodes, odds[at:at + len(nodes)])
        at += len(nodes)
        out.append("\n\n".join(x.text for x, k in zip(nodes, keep, strict=True) if k and x.text))
    return out


# Training pages.

def _sentences(rng, bank: list, lo: int, hi: int) -> str:
    words = bank[rng.integers(len(bank))].split()
    n = int(rng.integers(lo, hi + 1))
    a = int(rng.integers(0, max(1, len(words) - n)))
    return " ".join(words[a:a + n])


def rebuilt_page(rng, bank: list) -> str:
    """A page in a random layout; ``data-truth`` marks where main text begins (1) and where it does not go on (0)."""
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    chance = lambda p: rng.random() < p
    say = lambda lo, hi: _sentences(rng, bank, lo, hi)
    semantic = chance(0.5)

    def part(names: tuple, tags: tuple, inner: str, truth: str = "") -> str:
        tag = pick(*tags) if semantic or chance(0.2) else "div"
        label = f' {pick("class", "id", "class")}="{pick(*names)}"' if not semantic or chance(0.5) or tag == "div" else ""
        return f"<{tag}{label}{truth}>{inner}</{tag}>"

    no, yes = ' data-truth="0"', ' data-truth="1"'
    links = lambda k: "<ul>" + "".join(f'<li><a href="/{i}">{say(1, 3)}</a></li>' for i in range(k)) + "</ul>"
    paras = lambda k, lo=3, hi=60: "".join(f"<p>{say(lo, hi)}</p>" for _ in range(k))
    nav = lambda: part(("nav", "menu", "main-nav", "navbar", "breadcrumbs"), ("nav",), links(int(rng.integers(3, 9))), no)
    ad = lambda: part(("ad", "ads", "advert", "sponsored", "promo", "ad-slot"), ("div", "aside"), pick(say(3, 25), paras(1, 3, 30)), no)
    notice = lambda: part(("cookie-notice", "notice", "alert", "consent", "banner", "gdpr"), ("div", "aside", "section"),
                          paras(1, 4, 40) + pick("<button>OK</button>", ""), no)
    side = lambda: part(("sidebar", "widget", "related", "recommended", "side"), ("aside",),
                        f"<h3>{say(1, 4)}</h3>" + pick(links(5), paras(2, 5, 50), links(3) + paras(1, 5, 50)), no)
    form = lambda: part(("signup", "newsletter", "subscribe-form", "search", "login"), ("form", "div"),
                        f'<form><label>{say(1, 4)}</label><input name="a">{paras(1, 3, 20)}<button>{say(1, 2)}</button></form>', no)
    comment = lambda: pick("<li>{}</li>", "<div>{}</div>", '<div class="comment">{}</div>').format(
        pick(f"<b>{say(1, 2)}</b>", f"<h4>{say(1, 2)}</h4>", "") + pick(f"<p>{say(4, 60)}</p>", say(4, 60)))
    comments = lambda: part(("comments", "comment-list", "discussion", "replies", "respond"), ("section", "div", "aside"),
                            pick(f"<h3>{say(1, 3)}</h3>", "") + "".join(comment() for _ in range(int(rng.integers(1, 6)))), no)
    header = lambda: part(("header", "masthead", "site-header", "top", "branding"), ("header",),
                          pick(f"<h2>{say(1, 3)}</h2>", f'<a href="/">{say(1, 3)}</a>', say(1, 6)) + pick("", nav(), f"<p>{say(2, 10)}</p>"), no)
    footer = lambda: part(("footer", "site-footer", "bottom", "colophon", "copyright"), ("footer",),
                          pick("&copy; " + say(2, 25), paras(2, 2, 30), links(4) + "<p>&copy; " + say(2, 20) + "</p>"), no)

    def block() -> str:
        kind = rng.random()
        if kind < 0.72:
            return f"<p>{say(3, 120)}</p>"
        if kind < 0.8:
            return f"<h2>{say(2, 8)}</h2><p>{say(10, 90)}</p>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{say(3, 25)}</li>" for _ in range(int(rng.integers(2, 6)))) + "</ul>"
        if kind < 0.9:
            return f"<blockquote>{pick(say(8, 40), paras(1, 8, 40))}</blockquote>"
        if kind < 0.94:
            return f"<p>{say(8, 40)} <a href='/x'>{say(1, 4)}</a> {say(8, 40)}<br>{say(4, 20)}</p>"
        if kind < 0.97:
            return "<table>" + "".join(f"<tr><td>{say(1, 4)}</td><td>{say(1, 8)}</td></tr>" for _ in range(3)) + "</table>"
        return f"<div>{say(10, 80)}</div>"

    inner = pick(f"<h1>{say(3, 10)}</h1>", f"<h1>{say(3, 10)}</h1>", "")
    for _ in range(int(rng.integers(1, 10))):
        inner += block()
        if chance(0.06):
            inner += pick(ad, side, form, notice)()
    if chance(0.15):
        inner += part(("share", "social", "tags"), ("div", "footer"), links(3), no)
    if chance(0.12):
        inner += comments()
    story = part(("article", "post", "content", "entry-content", "story", "main-content", "article-body"), ("article", "main", "section"), inner, yes)
    if not semantic and chance(0.25):
        story = f"<div{yes}>{inner}</div>"
    for _ in range(int(rng.integers(0, 3))):
        story = pick("<div>{}</div>", '<div class="{n}">{}</div>', "<main>{}</main>", "<section>{}</section>").replace(
            "{n}", pick("wrap", "container", "row", "page", "layout")).replace("{}", pick(story, story, story + pick(side, comments, ad)(), ad() + story))
    head = "".join(f() for f, p in ((notice, 0.3), (header, 0.6), (nav, 0.6), (ad, 0.4), (form, 0.1)) if chance(p))
    tail = "".join(f() for f, p in ((comments, 0.4), (side, 0.45), (ad, 0.2), (form, 0.25), (notice, 0.15), (footer, 0.75)) if chance(p))
    return f"<!DOCTYPE html><html><head><title>{say(2, 8)}</title></head><body>{head}{story}{tail}</body></html>"


def _labels(nodes: list, marked: bool) -> np.ndarray:
    """1 for nodes that hold main text: by ``data-truth``, or on a real page by its article element."""
    truth: dict = {}
    label = np.zeros(len(nodes))
    index = {id(x): i for i, x in enumerate(nodes)}
    for i, x in enumerate(nodes):
        up = truth.get(id(x.parent), False)
        if marked:
            truth[id(x)] = x.attrs["data-truth"] == "1" if "data-truth" in x.attrs else up
        else:
            off = x.tag in ("nav", "aside", "footer", "form") or any(w in ASIDE for w in attribute_tokens(x.attrs))
            truth[id(x)] = (up or x.tag in ("article", "main")) and not off
        if x.text and truth[id(x)]:
            label[i] = 1
            while x.parent is not None and not label[index[id(x.parent)]]:
                x = x.parent
                label[index[id(x)]] = 1
    return label


def train(pages: list[str], seed: int = SEED) -> Trees:
    rng = np.random.default_rng(seed)
    rows, labels, bank = [], [], []
    for page in pages:
        nodes = walk(parse(page))
        bank.extend(x.text for x in nodes if len(x.text) >= 40)
        if any(x.tag in ("article", "main") for x in nodes):
            rows.append(features(nodes))
            labels.append(_labels(nodes, marked=False))
    for _ in range(REBUILT if bank else 0):
        nodes = walk(parse(rebuilt_page(rng, bank)))
        rows.append(features(nodes))
        labels.append(_labels(nodes, marked=True))
    if not rows:
        return Trees(0.0, [])
    weight = np.concatenate([np.full(len(r), 1 / np.sqrt(len(r))) for r in rows])
    return Trees.fit(np.concatenate(rows), np.concatenate(labels), weight * len(weight) / weight.sum())


def fit(pages: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fits the trees in one task on at most ``sample`` pages."""
    hashed = pages.filter("html is not null").select("html", F.xxhash64("page_id", "url", "html", F.lit(SEED)).alias("h"))
    cut = hashed.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if cut is None:
        return Trees(0.0, [])
    picked = hashed.filter(F.col("h") <= cut).orderBy("h").limit(sample).withColumn("one", F.lit(1))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [train(pdf.sort_values(["h", "html"])["html"].tolist()).pack()]})

    return Trees.unpack(bytes(picked.groupBy("one").applyInPandas(learn, "model binary").first()[0]))


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_pages(pages: DataFrame, model: Trees) -> DataFrame:
    """page_id, url, text, n_chars."""
    prepare(pages.sparkSession)
    blob = model.pack()

    def run(batches):
        trees = Trees.unpack(blob)
        for b in batches:
            html_of = b.column("html").to_pylist()
            for lo, hi in by_bytes(html_of, 1 << 20):
                texts = extract(html_of[lo:hi], trees)
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id").slice(lo, hi - lo).cast(pa.int64()), b.column("url").slice(lo, hi - lo).cast(pa.string()),
                     pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=_TEXTS)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_html_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pages = read_table(spark, sf_dir, "pages")
    return extract_pages(pages, fit(pages))
