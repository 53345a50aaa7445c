"""Operator 2: main-text extraction by a recurrent block labeller.

A page is cut into leaf blocks (text between block-level tags) with their tag path. Every leaf becomes a vector: hashed
tag-path tokens (tags, classes, ids, roles), hashed words, and a few shape features. A bidirectional LSTM in numpy reads
the leaves of the whole page in both directions and labels each one as main text or not.

The labeller is trained on the driver from a bounded sample of ``TRAIN_PAGES`` distinct pages, drawn by hash of their html
and parsed in tasks; of a long page one run of blocks with at most ``TRAIN_CHARS`` characters is drawn, from anywhere in it.
Its labels come from mark-up that says so itself (article or main, against navigation, footers, asides, forms, notices,
adverts and comments by tag or name); hint features are masked at random and blocks of other kinds are inserted while
training, so that words, shape and neighbourhood carry weight too. Pages are then labelled where they are read, in
batches of similar length and bounded size; every page is read whole, a very long one by itself with running states.

Defined results: null, empty and tag-only pages give an empty text; repeated rows and null page_ids are kept as they
are; unclosed tags end with their parent; an unclosed svg ends where a block begins or ends; only an unclosed script,
style, textarea or title runs to the end of the page; a < that begins no tag is text; a truncated last tag is text of
nobody; the text of math, object and noscript elements belongs to the block they stand in; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import read

TRAIN_PAGES = 160
TRAIN_CHARS = 200_000  # characters of one page in the training sample
TRAIN_BLOCKS = 96  # training sequences are cut into pieces of so many blocks
EPOCHS = 24
MIN_STEPS = 240  # small samples are read more often
PATH_SLOTS, WORD_SLOTS, HIDDEN = 64, 32, 16
BATCH_BLOCKS = 16_384  # padded blocks labelled at a time: pages x longest page; a longer page is a batch by itself
BATCH_CHARS = 16_000_000  # mark-up whose features are held at a time; a longer page alone
CHUNK = 1024  # positions whose input products are held at a time while labelling

# Elements by how they take part in text
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr math noscript object param picture source ruby rt rp "
                   "rb rtc meter progress output slot "
                   "mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub "
                   "msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction "
                   "semantics annotation".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template svg iframe select textarea title".split())
TO_THE_END = frozenset("script style textarea title".split())  # where the end tag is missing
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
MAIN = frozenset("article main articlebody entry-content post-content post-body story".split())
ASIDE = frozenset("nav footer header aside form button menu dialog fieldset advert advertisement ad ads promo "
                  "sponsor sponsored banner cookie cookies consent notice popup modal newsletter subscribe subscription "
                  "sidebar widget related recommended share social breadcrumb breadcrumbs pagination pager comment "
                  "comments comment-list reply disqus login signup search masthead copyright navigation navbar "
                  "toolbar".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+)>|<[!?/][^>]*>",
                 re.S)
OPENS = re.compile(r"<[a-zA-Z/!?]")
# tags of blocks, which a drawing cannot hold
LEAVES_SVG = re.compile(r"</svg\s*>|</?(?:p|div|article|section|main|aside|nav|header|footer|body|html|h[1-6]|ul|ol|li|dl|dt|dd|"
                        r"table|tr|td|th|tbody|thead|blockquote|pre|figure|figcaption|form|address|hr)\b", re.I)
NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def leaves(page: str) -> list[tuple[str, tuple[str, ...], float]]:
    """(text, tag-path tokens, share of link characters) of every block of a page, in order."""
    import html

    found, text, linked = [], [], 0
    stack: list[tuple[str, tuple[str, ...]]] = []
    cut = page.rfind(">") + 1
    at, in_link = 0, 0
    never_ends = set()  # silent elements without a further end tag

    def flush():
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                path = tuple(t for _, tokens in stack for t in tokens)
                found.append((joined, path, min(1.0, linked / len(joined))))
            text.clear()
        linked = 0

    def add(piece):
        nonlocal linked
        if piece:
            text.append(piece)
            if in_link:
                linked += len(piece.strip())

    def after_silent(name, tag):
        """Where the page goes on after an element whose text does not count."""
        if name == "svg":
            if tag[0].endswith("/>"):
                return tag.end()
            end = LEAVES_SVG.search(page, tag.end())
            return tag.end() if end is None else end.end() if end[0][:5].lower() == "</svg" else end.start()
        end = None if name in never_ends else re.compile(rf"</{name}\s*>", re.I).search(page, tag.end())
        if end:
            return end.end()
        never_ends.add(name)
        return len(page) if name in TO_THE_END else tag.end()

    while at < cut:
        m = TAG.search(page, at, cut)
        if m is None:
            break
        add(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if m[1] else 1
            elif name == "br":
                text.append(" ")
            continue
        if name in SILENT and not m[1] and name != "title":
            at = after_silent(name, m)
            continue
        flush()
        in_link = 0
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in SILENT:
            at = after_silent(name, m)
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        if name in CLOSES:
            while stack and stack[-1][0] in CLOSES[name]:
                stack.pop()
        if name not in VOID:
            tokens = [name]
            if m[3]:
                for groups in NAMES.findall(m[3]):
                    for word in "".join(groups).lower().split():
                        tokens += [word, *(x for x in re.split(r"[^a-z0-9]+", word) if x and x != word)]
            stack.append((name, tuple(tokens)))
    last = OPENS.search(page, at)
    add(page[at:last.start()] if last else page[at:])
    flush()
    return found


def hints(path) -> tuple[int, int]:
    return sum(t in MAIN for t in path), sum(t in ASIDE for t in path)


def vectors(blocks):
    """Feature matrix of a page's leaves; the last two columns are the hint features."""
    import zlib

    import numpy as np

    n = len(blocks)
    x = np.zeros((n, PATH_SLOTS + WORD_SLOTS + 9), np.float32)
    crc = zlib.crc32
    for i, (text, path, links) in enumerate(blocks):
        for t in path:
            x[i, crc(t.encode()) % PATH_SLOTS] = 1
        words = text.encode().split()
        slots = np.bincount(np.fromiter(map(crc, words), np.uint32, len(words)) % WORD_SLOTS, minlength=WORD_SLOTS)
        x[i, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = slots / len(words)
        main, aside = hints(path)
        x[i, -9:] = (np.log1p(len(text)) / 8, np.log1p(len(words)) / 6, links, i / n, (n - 1 - i) / n,
                     min(text.count(".") + text.count(","), 20) / 20, min(len(path), 12) / 12, 2.0 * (main > 0), min(aside, 2))
    return x


def sigmoid(z):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def lstm_run(xw, wh, mask):
    """States of one direction: xw (T, B, 4H) input products, mask (T, B, 1)."""
    import numpy as np

    steps, batch, width = xw.shape
    h = np.zeros((batch, width // 4), np.float32)
    c = np.zeros_like(h)
    trace = []
    for t in range(steps):
        z = xw[t] + h @ wh
        i, f, o, g = sigmoid(z[:, :HIDDEN]), sigmoid(z[:, HIDDEN:2 * HIDDEN] + 1), sigmoid(z[:, 2 * HIDDEN:3 * HIDDEN]), \
            np.tanh(z[:, 3 * HIDDEN:])
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        m = mask[t]
        trace.append((h, c, i, f, o, g, tc))
        h, c = m * (o * tc) + (1 - m) * h, m * c_new + (1 - m) * c
        trace[-1] += (h,)
    return trace


def lstm_back(trace, dh_out, wh, mask):
    """Gradients (dxw, dwh) from the gradients of the states."""
    import numpy as np

    steps = len(trace)
    dwh = np.zeros_like(wh)
    dxw = np.zeros((steps, dh_out.shape[1], 4 * HIDDEN), np.float32)
    dh = np.zeros_like(dh_out[0])
    dc = np.zeros_like(dh)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, tc, _ = trace[t]
        m = mask[t]
        dh = dh + dh_out[t]
        do = m * dh * tc
        dcn = m * (dh * o * (1 - tc * tc) + dc)
        dz = np.concatenate([dcn * g * i * (1 - i), dcn * c * f * (1 - f), do * o * (1 - o), dcn * i * (1 - g * g)], axis=1)
        dxw[t] = dz
        dwh += h.T @ dz
        dh = dz @ wh.T + (1 - m) * dh
        dc = dcn * f + (1 - m) * dc
    return dxw, dwh


def padded(pages):
    """(T, B, I) features and (T, B, 1) mask of a list of feature matrices."""
    import numpy as np

    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(pages), 1), np.float32)
    for b, p in enumerate(pages):
        x[:len(p), b] = p
        mask[:len(p), b] = 1
    return x, mask


def states(params, x, mask):
    """Forward and backward traces, and the logits (T, B)."""
    import numpy as np

    fwd = lstm_run(x @ params["wx_f"] + params["b_f"], params["wh_f"], mask)
    bwd = lstm_run((x @ params["wx_b"] + params["b_b"])[::-1], params["wh_b"], mask[::-1])
    hf, hb = np.stack([s[-1] for s in fwd]), np.stack([s[-1] for s in bwd])[::-1]
    return fwd, bwd, hf, hb, hf @ params["vf"] + hb @ params["vb"] + x @ params["vx"] + params["b"]


def running_logits(params, x, mask, way: str):
    """One direction's share of the logits (T, B), from running states only: nothing is kept for back-propagation."""
    import numpy as np

    steps, batch, _ = x.shape
    out = np.empty((steps, batch), np.float32)
    h = np.zeros((batch, HIDDEN), np.float32)
    c = np.zeros_like(h)
    wx, bias, wh, v = (params[k + way] for k in ("wx_", "b_", "wh_", "v"))
    parts = [(a, min(a + CHUNK, steps)) for a in range(0, steps, CHUNK)]
    for a, b in parts if way == "f" else parts[::-1]:
        xw = x[a:b] @ wx + bias
        for t in range(a, b) if way == "f" else range(b - 1, a - 1, -1):
            z = xw[t - a] + h @ wh
            i, f, o, g = sigmoid(z[:, :HIDDEN]), sigmoid(z[:, HIDDEN:2 * HIDDEN] + 1), \
                sigmoid(z[:, 2 * HIDDEN:3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t]
            c_new = f * c + i * g
            h, c = m * (o * np.tanh(c_new)) + (1 - m) * h, m * c_new + (1 - m) * c
            out[t] = h @ v
    return out


def batches_of(lengths, blocks: int):
    """Lists of pages in order of length, each of at most ``blocks`` padded blocks or a single page; empty pages in none."""
    part: list[int] = []
    for i in sorted((i for i, n in enumerate(lengths) if n), key=lambda i: lengths[i]):
        if part and (len(part) + 1) * lengths[i] > blocks:
            yield part
            part = []
        part.append(i)
    if part:
        yield part


def slices_of(pages, chars: int):
    """Runs of pages with at most ``chars`` characters in all, or a single page."""
    part, held = [], 0
    for page in pages:
        n = len(page or "")
        if part and (held + n > chars or len(part) == 512):
            yield part
            part, held = [], 0
        part.append(page)
        held += n
    if part:
        yield part


def label(params, pages, threshold: float = 0.0):
    """Boolean labels of every leaf of the pages (feature matrices), batched by length."""
    out: list = [None] * len(pages)
    for part in batches_of([len(p) for p in pages], BATCH_BLOCKS):
        x, mask = padded([pages[i] for i in part])
        logits = running_logits(params, x, mask, "f") + running_logits(params, x, mask, "b") + x @ params["vx"] + params["b"]
        for b, i in enumerate(part):
            out[i] = logits[:len(pages[i]), b] > threshold
    return out


def weak_labels(blocks) -> list[int]:
    """1: main text by its mark-up. Pages without an article or main element take long blocks with few links."""
    marks = [hints(path) for _, path, _ in blocks]
    if any(m for m, _ in marks):
        return [int(m > 0 and a == 0) for m, a in marks]
    return [int(a == 0 and links < 0.3 and len(text) > 80) for (text, _, links), (_, a) in zip(blocks, marks)]


def augmented(blocks, labels, rng):
    """The page with some foreign blocks inserted (comments, notices, forms, sidebars), labelled 0, and every second
    page with its telling names exchanged for others of their kind."""
    kinds = (("section", "comments"), ("div", "comment"), ("aside",), ("div", "sidebar"), ("form",), ("div", "cookie", "notice"),
             ("div", "related"), ("header",), ("div", "ad"), ("ul", "menu"))
    pairs = list(zip(blocks, labels))
    texts = [b[0] for b in blocks]
    for _ in range(int(rng.integers(0, 3))):
        kind = kinds[int(rng.integers(len(kinds)))]
        at = int(rng.choice([0, len(pairs), int(rng.integers(len(pairs) + 1))]))
        base = ("html", "body") + (("article",) if rng.random() < 0.3 else ())
        extra = [((texts[int(rng.integers(len(texts)))], (*base, *kind, "p"), float(rng.random() < 0.2)), 0)
                 for _ in range(int(rng.integers(1, 5)))]
        pairs[at:at] = extra
    if rng.random() < 0.25:  # a long page: its main blocks several times over
        times = int(rng.integers(2, 12))
        pairs = [p for p in pairs for _ in range(times if p[1] else 1)]
    if rng.random() < 0.5:  # the same structure under other names
        names = {t: str(rng.choice(group)) for group in (sorted(MAIN), sorted(ASIDE)) for t in group}
        pairs = [((text, tuple(names.get(t, t) for t in path), links), y) for (text, path, links), y in pairs]
    return [b for b, _ in pairs], [y for _, y in pairs]


def train(pages: list[str], seed: int = 3):
    """Parameters of the labeller from whole sample pages."""
    return train_blocks([(b, weak_labels(b)) for b in map(leaves, pages) if b], seed)


def train_blocks(parsed, seed: int = 3):
    """Parameters of the labeller from (blocks, labels) of sample pages."""
    import numpy as np

    rng = np.random.default_rng(seed)
    width = PATH_SLOTS + WORD_SLOTS + 9
    params = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in {
        "wx_f": (width, 4 * HIDDEN), "wh_f": (HIDDEN, 4 * HIDDEN), "wx_b": (width, 4 * HIDDEN), "wh_b": (HIDDEN, 4 * HIDDEN),
        "vf": (HIDDEN,), "vb": (HIDDEN,), "vx": (width,)}.items()}
    params |= {"b_f": np.zeros(4 * HIDDEN, np.float32), "b_b": np.zeros(4 * HIDDEN, np.float32), "b": np.zeros(1, np.float32)}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    epoch = 0
    while parsed and (epoch < EPOCHS or step < MIN_STEPS):
        epoch += 1
        pieces = []
        for blocks, labels in parsed:
            b, y = augmented(blocks, labels, rng)
            x = vectors(b)
            if rng.random() < 0.1:  # hide the hints of a whole page
                x[:, -2:] = 0
            y = np.array(y, np.float32)
            pieces += [(x[a:a + TRAIN_BLOCKS], y[a:a + TRAIN_BLOCKS]) for a in range(0, len(x), TRAIN_BLOCKS)]
        order = rng.permutation(len(pieces))
        for a in range(0, len(order), 16):
            part = [pieces[i] for i in order[a:a + 16]]
            x, mask = padded([p[0] for p in part])
            y = np.zeros(mask.shape[:2], np.float32)
            for b, p in enumerate(part):
                y[:len(p[1]), b] = p[1]
            fwd, bwd, hf, hb, logits = states(params, x, mask)
            d = (sigmoid(logits) - y) * mask[:, :, 0] / mask.sum()
            dxf, dwf = lstm_back(fwd, d[:, :, None] * params["vf"], params["wh_f"], mask)
            dxb, dwb = lstm_back(bwd, (d[:, :, None] * params["vb"])[::-1], params["wh_b"], mask[::-1])
            dxb = dxb[::-1]
            flat = x.reshape(-1, width)
            grads = {"wx_f": flat.T @ dxf.reshape(-1, 4 * HIDDEN), "wx_b": flat.T @ dxb.reshape(-1, 4 * HIDDEN),
                     "wh_f": dwf, "wh_b": dwb, "b_f": dxf.sum((0, 1)), "b_b": dxb.sum((0, 1)),
                     "vf": np.einsum("tb,tbh->h", d, hf), "vb": np.einsum("tb,tbh->h", d, hb),
                     "vx": np.einsum("tb,tbi->i", d, x), "b": np.array([d.sum()], np.float32)}
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = params[k] - (0.02 * first[k] / (1 - 0.9 ** step)
                                         / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return params


def run_of_blocks(blocks, labels, chars: int, at: float):
    """A run of blocks with at most ``chars`` characters (at least one block, cut to them) from the place ``at`` in [0, 1)."""
    start = 0 if sum(len(b[0]) for b in blocks) <= chars else int(at * len(blocks))
    end, held = start, 0
    while end < len(blocks) and (end == start or held + len(blocks[end][0]) <= chars):
        held += len(blocks[end][0])
        end += 1
    return [(text[:chars], path, links) for text, path, links in blocks[start:end]], labels[start:end]


def training_sample(pages: DataFrame, train_pages: int = TRAIN_PAGES):
    """(blocks, labels) of at most ``train_pages`` distinct pages with blocks, from a table with a column html.

    Pages are drawn by hash of their html, so copies count once whatever their ids; the draw widens until it holds enough
    pages or all of them.
    """
    def run(batches):
        import json

        import pyarrow as pa

        for batch in batches:
            hashes, found = [], []
            for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blocks = leaves(html)
                if blocks:
                    hashes.append(h)
                    found.append(json.dumps(run_of_blocks(blocks, weak_labels(blocks), TRAIN_CHARS, (h & 0xFFFF) / 65536)))
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(found, pa.string())], ["h", "found"])

    h = F.xxhash64("html")
    real = pages.select(h.alias("h"), "html").where(F.col("html").isNotNull() & (F.col("html") != ""))
    every = max(1, real.agg(F.approx_count_distinct("h").alias("n")).first().n // (2 * train_pages))
    while True:
        drawn = real.where(F.pmod(F.col("h"), F.lit(every)) == 0)
        some = drawn.mapInArrow(run, "h bigint, found string").dropDuplicates(["h"])
        rows = some.orderBy("h").limit(train_pages).collect()  # top-k per task, then of the tasks
        if len(rows) == train_pages or every == 1:
            break
        every = max(1, every // 8)
    import json

    return [([(t, tuple(path), links) for t, path, links in blocks], labels)
            for blocks, labels in (json.loads(r.found) for r in rows)]


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    spark = pages.sparkSession
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    shipped = spark.sparkContext.broadcast(train_blocks(training_sample(p, train_pages)))
    kind = dict(p.dtypes)["page_id"]

    def run(batches):
        import pyarrow as pa

        params = shipped.value
        for batch in batches:
            texts = []
            for part in slices_of(batch.column(2).to_pylist(), BATCH_CHARS):
                parsed = [leaves(h) if h else [] for h in part]
                labels = label(params, [vectors(b) for b in parsed])
                texts += ["\n".join(t for (t, _, _), keep in zip(b, y) if keep) if b else ""
                          for b, y in zip(parsed, labels)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return p.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))
