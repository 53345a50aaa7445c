"""Operator 1: document scores of a log-bilinear language model trained with noise-contrastive estimation.

Symbols. The model's vocabulary follows the counts: every word with ``MIN_COUNT`` training tokens (and in any case the
``LEAST_WORDS`` most frequent ones) is a symbol of its own, up to the ``TOP_WORDS`` for which the normaliser of every
context pair is tabled, and so is the end token; every other word belongs to the symbol of its last ``SUFFIX`` bytes (the most frequent endings,
and one for the rest). P(word | context) = P(symbol | context) * P(word | symbol), where the second factor is the
smoothed share (c + 0.5) / (N_s + 0.5 (V_s + 1)) of the word within its symbol, one slot being left for unseen words.
Both factors are normalised, so scores are log probabilities of whole texts over an open vocabulary.

Model. P(symbol | u, v) is log-bilinear in the two symbols before: exp((C1[v] + C2[u]) . R[symbol] + b[symbol]) / Z(u, v).
It is trained by noise-contrastive estimation on every training document: each task takes one pass over its documents
with noise drawn from the symbol shares (shared per batch, so gradients are matrix products) from a common start, and
steps touch only the rows of the batch's symbols, so their cost does not grow with the vocabulary; the tasks' parameters are averaged by token counts; ``ROUNDS`` rounds repeat this from the average (two gain a third
more over the base score than one). Z for all pairs of
context symbols comes from one matrix product on the driver; scoring then only looks up tables.

Scale: word counts are pre-aggregated per task. Counts of the ``LOOKUP_WORDS`` most frequent words are broadcast (bounded);
documents carry only their other words to a join with the full counts, so frequent words never move. Parameters are
bounded by the vocabulary (about 400 kB, and 38 MB for the normalisers); what a task reports does not grow with its input.

Defined results: null and empty texts are scored as the end token alone; a null doc_id counts as training (its crc32 is
null); repeated rows count and score on their own; an empty training set scores every token as unseen; extra columns
are ignored; texts are read whole. Sums over words are in double precision; the trained part varies in the last digits
with the partitioning, since tasks average.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import bytes_list, heaviest, read, stored, with_row_id

TOP_WORDS = 2047
LEAST_WORDS = 255
MIN_COUNT = 100  # training tokens from which a word has vectors of its own
SUFFIXES = 128
SUFFIX = 3
DIM = 16
NOISE = 48
BATCH = 1024
ROUNDS = 2
RATE = 0.3
LOOKUP_WORDS = 100_000
MAX_LOOKUP_BYTES = 48  # longer words are left to the join
END = b"\n"  # the end token; no word holds white space
FOLDS, HELD_OUT = 5, 1


SLICE_ROWS = 1000  # texts of a batch that a task holds as Python objects at a time


def slices(batches):
    """The rows of Arrow batches, a few at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(a, SLICE_ROWS)


def is_held_out(id_col):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over the training texts, with one end token per document."""
    def count(batches):
        from collections import Counter

        import pyarrow as pa

        def table(seen):
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              ["word", "n"])

        seen: Counter = Counter()
        for batch in slices(batches):
            texts = bytes_list(batch.column(0))
            for raw in texts:
                seen.update(raw.lower().split())
            seen[END] += len(texts)
            if len(seen) > 500_000:
                yield table(seen)
                seen = Counter()
        if seen:
            yield table(seen)

    return (train.select("text").mapInArrow(count, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("c")))


class Vocabulary:
    """Symbols, exact counts of the frequent words, and the share of a word within its symbol."""

    def __init__(self, words, endings, lookup, masses, total, distinct):
        self.total, self.distinct = total, distinct
        self.word_symbol = {w: i for i, w in enumerate(words)}
        first = len(words)
        self.ending_symbol = {e: first + i for i, e in enumerate(endings)}
        self.rest = first + len(endings)
        self.size = self.rest + 1
        self.lookup = dict(lookup)
        self.plain = (words, endings, lookup, masses, total, distinct)  # what a broadcast carries: no class of ours
        self.masses = masses  # symbol -> (tokens, distinct words) of its words

    def symbol(self, word: bytes) -> int:
        s = self.word_symbol.get(word)
        return self.ending_symbol.get(word[-SUFFIX:], self.rest) if s is None else s

    def weights(self):
        """Training tokens per symbol, one added to each."""
        import numpy as np

        return np.array([self.masses.get(s, (0, 0))[0] + 1.0 for s in range(self.size)])

    def inner(self):
        """log10 of each symbol's denominator N_s + 0.5 (V_s + 1); a symbol of one word has the share 1."""
        import numpy as np

        out = np.zeros(self.size)
        for s in range(len(self.word_symbol), self.size):
            n, v = self.masses.get(s, (0, 0))
            out[s] = np.log10(n + 0.5 * (v + 1))
        return out


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    """Vocabulary from the stored counts; only bounded tables reach the driver."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    is_end = F.col("word") == F.lit(END)
    top = heaviest(counts.where(~is_end & (F.length("word") <= MAX_LOOKUP_BYTES)), "c", LOOKUP_WORDS).collect()
    top += counts.where(is_end).collect()  # whatever the cutoff: the end token never goes to the join
    lookup = sorted(((bytes(r.word), r.c) for r in top), key=lambda x: (-x[1], x[0]))
    ranked = [(w, c) for w, c in lookup if w != END][:TOP_WORDS]
    words = [w for i, (w, c) in enumerate(ranked) if i < LEAST_WORDS or c >= MIN_COUNT] + [END]
    own = F.col("word").isin([bytearray(w) for w in words])
    by_ending = counts.where(~own).groupBy(F.substring("word", -SUFFIX, SUFFIX).alias("e")).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    by_ending = stored(by_ending, "endings")
    best = by_ending.orderBy(F.desc("n"), "e").limit(SUFFIXES).collect()
    endings = [bytes(r.e) for r in best]
    vocabulary = Vocabulary(words, endings, lookup, {}, total, distinct)
    known = dict(lookup)
    masses = {i: (known.get(w, 0), 1) for i, w in enumerate(words)}
    masses |= {vocabulary.ending_symbol[bytes(r.e)]: (r.n, r.v) for r in best}
    n, v = by_ending.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    masses[vocabulary.rest] = (n - sum(r.n for r in best), v - sum(r.v for r in best))
    return Vocabulary(words, endings, lookup, masses, total, distinct)


def start_parameters(vocabulary: Vocabulary):
    import numpy as np

    rng = np.random.default_rng(1)
    shares = vocabulary.weights() / vocabulary.weights().sum()
    size = vocabulary.size
    r = rng.standard_normal((size, DIM)) * 0.1
    return {"c1": (r + rng.standard_normal((size, DIM)) * 0.02).astype(np.float32),
            "c2": (r * 0.5 + rng.standard_normal((size, DIM)) * 0.02).astype(np.float32),
            "r": r.astype(np.float32), "b": np.log(shares).astype(np.float32)}


class NceTrainer:
    """One task's pass of noise-contrastive estimation with AdaGrad steps.

    Both context tables stand one above the other, and a symbol's bias stands beside its vector, so that a batch is
    sorted by symbol once for the contexts and once for the observed and noise symbols; ``p`` names the parts.
    """

    def __init__(self, params, shares, seed: int):
        import numpy as np

        self.np = np
        self.size = len(params["b"])
        self.contexts = np.concatenate([params["c1"], params["c2"]])
        self.outputs = np.concatenate([params["r"], params["b"][:, None]], axis=1)
        self.p = {"c1": self.contexts[:self.size], "c2": self.contexts[self.size:],
                  "r": self.outputs[:, :-1], "b": self.outputs[:, -1]}
        self.squares = {"contexts": np.full(self.contexts.shape, 1e-2, np.float32),
                        "outputs": np.full(self.outputs.shape, 1e-2, np.float32)}
        self.rng = np.random.default_rng(seed)
        self.cumulative = np.cumsum(shares)
        self.log_noise = np.log(NOISE * shares).astype(np.float32)
        self.seen = 0

    def descend(self, k, at, rows, size):
        """AdaGrad step of the table ``k`` by the sums of ``rows`` per index ``at``; other rows stay as they are."""
        np, table, squares = self.np, getattr(self, k), self.squares[k]
        order = np.argsort(at.astype(np.int16) if len(table) <= 1 << 15 else at, kind="stable")  # short ints: radix sort
        sorted_at = at[order]
        heads = np.flatnonzero(sorted_at[1:] != sorted_at[:-1])
        heads += 1
        heads = np.concatenate([[0], heads])
        g = np.add.reduceat(rows[order], heads, axis=0)
        g /= np.float32(size)
        ids = sorted_at[heads]
        total = squares[ids]
        total += g * g
        squares[ids] = total
        g *= np.float32(RATE)
        g /= np.sqrt(total, out=total)
        table[ids] -= g

    def step(self, u, v, w):
        """One batch: context symbols u (two before), v (one before), and the observed symbols w."""
        np, n, d = self.np, len(w), self.contexts.shape[1]
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(self.cumulative) - 1)
        both, context = np.concatenate([w, noise]), np.concatenate([v, u + self.size])
        q = np.ones((n, d + 1), np.float32)  # the one meets the bias
        pairs = self.contexts[context]
        np.add(pairs[:n], pairs[n:], out=q[:, :d])
        out = self.outputs[both]
        out[:, d] -= self.log_noise[both]
        gp = np.einsum("ij,ij->i", q, out[:n])
        gn = q @ out[n:].T
        for x in (gp, gn):  # x becomes 1 / (1 + exp(-x))
            np.negative(x, out=x)
            np.exp(x, out=x)
            x += 1
            np.reciprocal(x, out=x)
        gp -= 1  # d loss / d score of the observed symbols; gn: of the noise symbols
        gq = gn @ out[n:, :d]
        gq += gp[:, None] * out[:n, :d]
        targets = np.empty((n + NOISE, d + 1), np.float32)
        np.multiply(gp[:, None], q, out=targets[:n])
        np.matmul(gn.T, q, out=targets[n:])
        self.descend("contexts", context, np.concatenate([gq, gq]), n)
        self.descend("outputs", both, targets, n)
        self.seen += n


def train_round(train: DataFrame, vocabulary, params, seed: int):
    """Parameters averaged over the tasks, weighted by their tokens."""
    import numpy as np

    shares = vocabulary.weights() / vocabulary.weights().sum()
    words, endings, _, _, total, distinct = vocabulary.plain  # training needs no counts
    shipped = train.sparkSession.sparkContext.broadcast(((words, endings, [], {}, total, distinct), params, shares))
    names = sorted(params)

    def run(batches):
        import pyarrow as pa

        plain, start, noise = shipped.value
        vocab = Vocabulary(*plain)
        trainer = NceTrainer(start, noise, seed)
        cache, rest, endings = dict(vocab.word_symbol), vocab.rest, vocab.ending_symbol
        end = cache[END]
        held: list[int] = []

        # two end tokens stand before a document: -end - 1 marks positions that are context only
        for batch in slices(batches):
            for raw in bytes_list(batch.column(0)):
                words = raw.lower().split()
                got = list(map(cache.get, words))
                if None in got:
                    got = [endings.get(x[-SUFFIX:], rest) if g is None else g for x, g in zip(words, got)]
                held += [-end - 1, -end - 1]
                held += got
                held.append(end)
                if len(held) > 64 * BATCH:
                    learn_marked(trainer, held, np)
                    held = []
        if held:
            learn_marked(trainer, held, np)
        if trainer.seen:
            flat = np.concatenate([trainer.p[k].ravel() for k in names]).astype(np.float64) * trainer.seen
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat),
                                              pa.array(np.full(len(flat), float(trainer.seen)))], ["i", "x", "w"])

    rows = (train.select("text").mapInArrow(run, "i bigint, x double, w double").groupBy("i")
            .agg((F.sum("x") / F.sum("w")).alias("x")).collect())  # one number per parameter
    if not rows:
        return params
    flat = np.zeros(len(rows))
    flat[[r.i for r in rows]] = [r.x for r in rows]
    out, at = {}, 0
    for k in names:
        n = params[k].size
        out[k] = flat[at:at + n].reshape(params[k].shape).astype(np.float32)
        at += n
    return out


def learn_marked(trainer, symbols, np):
    """Train on a run of symbols in which negative entries -s - 1 are context only."""
    s = np.array(symbols, np.int32)
    real = np.flatnonzero(s >= 0)
    s = np.where(s < 0, -s - 1, s)
    for a in range(0, len(real), BATCH):
        k = real[a:a + BATCH]
        trainer.step(s[k - 2], s[k - 1], s[k])


class Scorer:
    """log10 P(symbol | u, v): inner products, and the tabled normaliser of every context. A task holds one table of all
    pairs, not three."""

    def __init__(self, params, z=None):
        import numpy as np

        self.p = {k: v.astype(np.float64) for k, v in params.items()}
        self.size = len(self.p["b"])
        if z is not None:
            self.z = z
            return
        p = self.p
        one, two = p["c1"] @ p["r"].T + p["b"], p["c2"] @ p["r"].T  # (v, w), (u, w)
        top, high = one.max(axis=1), two.max(axis=1)
        e1, e2 = np.exp(one - top[:, None]), np.exp(two - high[:, None])
        self.z = np.log(e2 @ e1.T) + high[:, None] + top[None, :]  # (u, v): sum over w of exp(two + one)

    def log10(self, u, v, w):
        import numpy as np

        p = self.p
        return (np.einsum("...j,...j->...", p["c1"][v] + p["c2"][u], p["r"][w]) + p["b"][w] - self.z[u, v]) / np.log(10)


SCORED = ("rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
          "rare array<binary>")


def score_texts(docs: DataFrame, vocabulary: Vocabulary, params) -> DataFrame:
    """SCORED rows of (rid, doc_id, held_out, text): sums without the words that the lookup table does not hold."""
    shipped = docs.sparkSession.sparkContext.broadcast((vocabulary.plain, params, Scorer(params).z))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        plain, p, z = shipped.value
        vocab, scorer = Vocabulary(*plain), Scorer(p, z)
        inner = vocab.inner()
        words_of = list(vocab.lookup)
        index = {w: i for i, w in enumerate(words_of)}
        index.setdefault(END, len(words_of))
        counts = np.array([vocab.lookup[w] for w in words_of] + [0] * (len(index) - len(words_of)), np.int64)
        symbols = np.array([vocab.symbol(w) for w in index], np.int32)
        n_words = len(vocab.word_symbol)
        log_share = np.where(symbols < n_words, 0.0, np.log10(counts + 0.5) - inner[symbols])
        floor = np.log10(vocab.total + 0.5 * (vocab.distinct + 1))
        log_base = np.log10(counts + 0.5) - floor
        known = counts > 0
        end_at, end = index[END], vocab.symbol(END)
        endings, rest = vocab.ending_symbol, vocab.rest
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary())]
        for batch in slices(batches):
            rows = []
            for raw in bytes_list(batch.column(3)):
                words = raw.lower().split()
                got = list(map(index.get, words))
                rare = [w for w, g in zip(words, got) if g is None]
                at = np.array([-1 if g is None else g for g in got] if rare else got, np.int64)
                at = np.append(at, end_at)
                hit = at >= 0
                found = at[hit]
                s = np.empty(len(at) + 2, np.int32)
                s[:2] = end
                s[2:][hit] = symbols[found]
                base, score = log_base[found].sum(), log_share[found].sum()
                if rare:
                    own = np.array([endings.get(w[-SUFFIX:], rest) for w in rare], np.int32)
                    s[2:][~hit] = own
                    base -= floor * len(rare)
                    score -= inner[own].sum()
                score += scorer.log10(s[:-2], s[1:-1], s[2:]).sum()
                rows.append((len(at), int(known[found].sum()), float(base), float(score), rare))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(batch.columns[:3] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["rid", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    return docs.select("rid", "doc_id", "held_out", "text").mapInArrow(run, SCORED)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = with_row_id(d.withColumn("held_out", is_held_out("doc_id")))
    train = d.where(~F.col("held_out"))
    counts = stored(word_counts(train), "counts")
    vocabulary = build_vocabulary(counts)
    params = start_parameters(vocabulary)
    for k in range(rounds):
        params = train_round(train, vocabulary, params, seed=k + 1)
    scored = stored(score_texts(d, vocabulary, params), "scored")
    # log10(c + 0.5) of the words outside the lookup table; unseen words have c = 0
    rare = (scored.select("rid", F.explode("rare").alias("word")).groupBy("rid", "word").agg(F.count(F.lit(1)).alias("n"))
            .join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
            .groupBy("rid").agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("more"),
                                F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("seen")))
    more, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    return scored.drop("rare").join(rare, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + seen).alias("n_known"),
        F.lit(vocabulary.total).cast("bigint").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents"))
