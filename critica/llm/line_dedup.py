"""Operator 3: line dedup by a log-template tree of fixed depth.

A line's tokens are its words, lower-cased (A-Z), with every token that holds a digit replaced by a wildcard. The tree
has fixed depth: token count, then the first ``DEPTH`` tokens; a leaf holds templates. Lines of a leaf that agree with
a template in at least ``SIMILARITY`` of their positions generalise it: positions that differ become wildcards.

Recurrence is counted over passages. A passage is a run of lines (blank ones between them do not matter) whose distinct
templates hold at least ``PASSAGE_TOKENS`` literal tokens; a line that holds as many is a passage by itself. A passage
that two documents share recurs, however its lines are cut, and with it all its lines, short ones too. It is found by
the shortest passages that start or end at each line: they cover every line of any longer one. Outside of recurring
passages, lines of ``MIN_TOKENS`` tokens and more recur from ``min_docs(tokens)`` documents on, since a few tokens
repeat by chance. All occurrences of a recurring passage or line but the first one are dropped, so the corpus keeps one
copy of each. Blank lines stay.

Scale: exact copies of a line collapse with counts before any leaf is gathered, so a line that fills a third of the
corpus is one row; leaves are read as a stream of sorted rows; counts of documents and first occurrences are grouped
narrow rows. Passages are hashes over lines that recur, two a line at most, so their number is linear in the lines. Documents
carry only the numbers of their dropped lines back to the texts.

Defined results: null and empty texts have no lines to drop and pass unchanged; rows with the same doc_id and the same
text count as one document and get the same result; null doc_ids sort last; ties go to the smaller line number; an empty
table gives an empty result; extra columns pass through; texts and lines of any length are parsed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import bytes_list, free_name, let, read, slices, stored

DEPTH = 3
SIMILARITY = 0.8
PASSAGE_TOKENS = 10  # literal tokens from which two documents do not share a passage by chance
CHANCE_TOKENS = 60  # a lone line of n tokens needs ceil(CHANCE_TOKENS / n) documents, at least two
MIN_TOKENS = 3  # shorter lines repeat by chance at any size and go only with their passage
SCAN_TEMPLATES = 256  # leaves with more templates look candidates up instead of comparing all

WILDCARD = b"<*>"


def parse_line(line: bytes, depth: int = DEPTH):
    """(token count, leaf hash, line hash, masked line, literal tokens) of a lower-cased line; None if it is blank."""
    import re

    import xxhash

    tokens = line.split()
    if not tokens:
        return None
    if re.search(rb"[0-9]", line):
        tokens = [WILDCARD if re.search(rb"[0-9]", t) else t for t in tokens]
    masked = b" ".join(tokens)
    leaf = xxhash.xxh64_intdigest(b"%d " % len(tokens) + b" ".join(tokens[:depth]), 1) - (1 << 63)
    return len(tokens), leaf, xxhash.xxh64_intdigest(masked, 2) - (1 << 63), masked, len(tokens) - tokens.count(WILDCARD)


def line_rows(docs: DataFrame, texts: bool, depth: int = DEPTH) -> DataFrame:
    """Lines of (doc_id, digest, text): with their masked text once per document, or all of them by number."""

    def run(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole, 2)):
            rows = []
            for doc_id, digest, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           bytes_list(batch.column(2))):
                seen = set()
                seq = 0  # line number without the blank lines
                for pos, line in enumerate(raw.lower().split(b"\n")):
                    parsed = parse_line(line, depth)
                    if parsed is None:
                        continue
                    n, leaf, key, masked, literal = parsed
                    if not texts:
                        rows.append((doc_id, digest, pos, seq, n, literal, leaf, key))
                        seq += 1
                    elif key not in seen:
                        seen.add(key)
                        rows.append((n, leaf, key, masked))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    import pyarrow as pa

    if texts:
        names, kinds = ["n", "leaf", "line", "masked"], [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        schema = "n int, leaf bigint, line bigint, masked binary"
    else:
        names = ["doc_id", "digest", "pos", "seq", "n", "literal", "leaf", "line"]
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64()]
        schema = "doc_id bigint, digest bigint, pos int, seq int, n int, literal int, leaf bigint, line bigint"
    return docs.mapInArrow(run, schema)


class Leaf:
    """Templates of one leaf: token ids per position, 0 for a wildcard.

    A line may differ from its template in ``slack`` positions, so among any slack + 1 positions at least one agrees.
    Once a leaf holds many templates, a line is compared only with those that agree in one of its last slack + 1
    positions (by token or wildcard), which finds the same template as comparing all.
    """

    def __init__(self, n: int, similarity: float):
        import math

        import numpy as np

        self.np, self.n, self.similarity = np, n, similarity
        self.slack = n - math.ceil(similarity * n)
        self.probe = range(max(0, n - self.slack - 1), n)
        self.words: dict[bytes, int] = {WILDCARD: 0}
        self.rows = np.zeros((8, n), np.int32)
        self.names: list[int] = []
        self.holders: dict[tuple[int, int], list[int]] = {}  # (position, token) -> templates, token 0: wildcard

    def add(self, key: int, masked: bytes) -> int:
        """The template (named by the hash of its first line) that the line joins."""
        if not self.slack:
            return key  # only equal lines agree, and those are one row already
        np, words = self.np, self.words
        ids = np.array([words.setdefault(t, len(words)) for t in masked.split(b" ")], np.int32)
        k = len(self.names)
        if k <= SCAN_TEMPLATES:
            near = slice(0, k)
        else:
            near = np.array(sorted({t for p in self.probe for token in (0, int(ids[p]))
                                    for t in self.holders.get((p, token), ())}), np.int64)
        rows = self.rows[near]
        if len(rows):
            same = ((rows == ids) | (rows == 0)).sum(axis=1)
            best = int(same.argmax())
            if same[best] >= self.similarity * self.n:
                at = best if k <= SCAN_TEMPLATES else int(near[best])
                differs = (self.rows[at] != ids) & (self.rows[at] != 0)
                self.rows[at][differs] = 0
                for p in self.probe:
                    if differs[p]:
                        self.holders.setdefault((p, 0), []).append(at)
                return self.names[at]
        if k == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[k] = ids
        self.names.append(key)
        for p in self.probe:
            self.holders.setdefault((p, int(ids[p])), []).append(k)
        return key


def templates(lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(leaf, line, template) for the lines of every leaf that more than one document line reaches."""
    distinct = lines.groupBy("leaf", "line", "n").agg(F.count(F.lit(1)).alias("docs"), F.first("masked").alias("masked"))

    def grow(batches):
        import pyarrow as pa

        leaf, tree, held = None, None, None
        for batch in (part for whole in batches for part in slices(whole, 4)):
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for at, key, n, docs, masked in zip(*columns):
                if at != leaf:  # wait for a second line: most leaves hold a single one
                    leaf, tree, held = at, None, (key, n, masked)
                    if docs > 1:
                        rows.append((at, key, key))
                        held = (*held, True)
                    continue
                if tree is None:
                    tree = Leaf(n, similarity)
                    first = tree.add(held[0], held[2])
                    if len(held) == 3:
                        rows.append((at, held[0], first))
                rows.append((at, key, tree.add(key, masked)))
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["leaf", "line", "template"])

    return (distinct.select("leaf", "line", "n", "docs", "masked").repartition("leaf")
            .sortWithinPartitions("leaf", F.desc("docs"), "line")
            .mapInArrow(grow, "leaf bigint, line bigint, template bigint"))


def min_docs(n, chance_tokens: int = CHANCE_TOKENS):
    return F.greatest(F.lit(2), F.ceil(F.lit(chance_tokens) / n))


def shortest_passages(lines, least: int = PASSAGE_TOKENS):
    """(start, end, hash) of the shortest passages from and to every line of one document.

    ``lines`` are (pos, seq, weight, template hash) of the recurring lines in order; a gap in ``seq`` ends a run. The
    weight of a passage counts each of its templates once. Passages of one line are left out: they are lines.
    """
    prime, base = (1 << 61) - 1, 1_000_003
    sums, powers = [0], [1]
    for *_, t in lines:
        sums.append((sums[-1] * base + t + (1 << 63)) % prime)
        powers.append(powers[-1] * base % prime)
    found = set()
    run, start, weight = 0, 0, 0
    held: dict[int, int] = {}  # template -> occurrences from start to end
    for end, (_, seq, w, t) in enumerate(lines):
        if end and seq != lines[end - 1][1] + 1:
            run, start, weight, held = end, end, 0, {}
        held[t] = held.get(t, 0) + 1
        weight += w if held[t] == 1 else 0
        while weight >= least:
            found.add((start, end))  # the shortest passage from start
            _, _, v, u = lines[start]
            held[u] -= 1
            weight -= v if held[u] == 0 else 0
            start += 1
        if start > run:
            found.add((start - 1, end))  # the shortest passage to end
    return [(lines[a][0], lines[b][0], (sums[b + 1] - sums[a] * powers[b + 1 - a]) % prime)
            for a, b in sorted(found) if a < b]


def list_rows(column, *fields):
    """Lists of tuples of the named fields of an Arrow column of lists of structs, read from the child arrays."""
    offsets = column.offsets.to_pylist()  # of a slice: into the whole child array
    children = [column.values.field(f).slice(offsets[0], offsets[-1] - offsets[0]).to_pylist() for f in fields]
    rows = list(zip(*children))
    return (rows[a - offsets[0]:b - offsets[0]] for a, b in zip(offsets, offsets[1:]))


LINES = "array<struct<pos:int,seq:int,weight:int,template:bigint,lone:boolean>>"


def passage_rows(runs: DataFrame) -> DataFrame:
    """(doc_id, digest, start, end, passage) of the recurring lines of every document."""
    def run(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for doc_id, digest, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                             list_rows(batch.column(2), "pos", "seq", "weight", "template")):
                rows += [(doc_id, digest, *p) for p in shortest_passages(found)]
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "digest", "start", "end", "passage"])

    many = runs.where(F.size("lines") > 1).select("doc_id", "digest", "lines")
    return many.mapInArrow(run, "doc_id bigint, digest bigint, start int, end int, passage bigint")


def covered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, dropped) of (doc_id, digest, lines, spans): lone lines and all lines within a span."""
    def run(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for doc_id, digest, lines, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                    list_rows(batch.column(2), "pos", "lone"),
                                                    list_rows(batch.column(3), "start", "end")):
                gone, at, until = [], 0, -1
                spans.sort()
                for pos, lone in lines:
                    while at < len(spans) and spans[at][0] <= pos:
                        until = max(until, spans[at][1])
                        at += 1
                    if lone or pos <= until:
                        gone.append(pos)
                if gone:
                    rows.append((doc_id, digest, gone))
            columns = list(zip(*rows)) if rows else [[]] * 3
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "digest", "dropped"])

    return docs.mapInArrow(run, "doc_id bigint, digest bigint, dropped array<int>")


def shared(rows: DataFrame, group: list[str], at: str, *more) -> DataFrame:
    """(group, docs, first, more) of the groups of rows (doc_id, digest, ``at``) that two documents hold."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", at)).alias("first")
    per_doc = rows.groupBy(*group, "doc_id", "digest").agg(F.min(at).alias(at), *[F.min(c).alias(c) for c in more])
    return (per_doc.groupBy(*group).agg(F.count(F.lit(1)).alias("docs"), first, *[F.min(c).alias(c) for c in more])
            .where(F.col("docs") > 1))


def is_first(at: str):
    f = F.col("first")
    return F.col("doc_id").eqNullSafe(f["doc_id"]) & (F.col("digest") == f["digest"]) & (F.col(at) == f[at])


def dropped_lines(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY,
                  chance_tokens: int = CHANCE_TOKENS) -> DataFrame:
    """(doc_id, digest, dropped: sorted line numbers) of documents (doc_id, digest, text) that lose lines."""
    found = stored(templates(line_rows(docs, True, depth), similarity), "templates")
    hits = stored(line_rows(docs, False, depth).join(found, ["leaf", "line"])
                  .select("doc_id", "digest", "pos", "seq", "n", "literal", "leaf", "template"), "hits")
    group = ["leaf", "template", "n"]
    # plain join sides: adaptive execution can split hot templates and passages
    recurring = stored(shared(hits, group, "pos", "literal").withColumnRenamed("literal", "weight"), "recurring")
    enough = (F.col("weight") >= PASSAGE_TOKENS) | ((F.col("n") >= MIN_TOKENS)
                                                   & (F.col("docs") >= min_docs(F.col("n"), chance_tokens)))
    line = F.struct("pos", "seq", "weight", F.xxhash64(*group).alias("template"), (enough & ~is_first("pos")).alias("lone"))
    runs = stored(hits.join(recurring, group).groupBy("doc_id", "digest")
                  .agg(F.array_sort(F.collect_set(line)).cast(LINES).alias("lines")), "runs")
    passages = stored(passage_rows(runs), "passages")
    again = stored(shared(passages, ["passage"], "start"), "recurring-passages")
    spans = passages.join(again, "passage").where(~is_first("start")).select("doc_id", "digest", F.struct("start", "end").alias("span"))
    both = runs.withColumn("span", F.lit(None).cast("struct<start:int,end:int>")).unionByName(
        spans.withColumn("lines", F.lit(None).cast(LINES)))
    return covered_lines(both.groupBy("doc_id", "digest").agg(F.first("lines", ignorenulls=True).alias("lines"),
                                                              F.collect_list("span").alias("spans")))


def _deduped(docs: DataFrame, id_col: str, text_col: str, depth: int, similarity: float, chance_tokens: int):
    """(docs with three columns added, their names): number of lines, number of dropped lines, text without them."""
    names = {c: free_name(docs, c) for c in ("n_lines", "n_dropped", "kept_text", "k_id", "k_digest", "k_gone")}
    digest = F.xxhash64(F.col(text_col))
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), digest.alias("digest"),
                         F.col(text_col).cast("string").alias("text"))
    dropped = dropped_lines(narrow, depth, similarity, chance_tokens).select(
        F.col("doc_id").alias(names["k_id"]), F.col("digest").alias(names["k_digest"]), F.col("dropped").alias(names["k_gone"]))
    joined = docs.join(dropped, F.col(id_col).cast("bigint").eqNullSafe(F.col(names["k_id"]))
                       & (digest == F.col(names["k_digest"])), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    gone = F.col(names["k_gone"])

    def without(all_lines):
        kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: all_lines[i]), "\n")

    kept = F.when(gone.isNull(), F.col(text_col)).otherwise(let(lines, without))
    return joined.select(*docs.columns,
                         F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias(names["n_lines"]),
                         F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias(names["n_dropped"]),
                         kept.alias(names["kept_text"])), names


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
               similarity: float = SIMILARITY, chance_tokens: int = CHANCE_TOKENS) -> DataFrame:
    """``docs`` with (n_lines, n_dropped, kept_text) added: the text without its dropped lines. A name that ``docs``
    has already gets underscores."""
    return _deduped(docs, id_col, text_col, depth, similarity, chance_tokens)[0]


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
                         depth: int = DEPTH, similarity: float = SIMILARITY, chance_tokens: int = CHANCE_TOKENS) -> DataFrame:
    """``docs`` with its own columns, the text without its dropped lines; ``chars_col``, if there, follows a changed text."""
    out, names = _deduped(docs, id_col, text_col, depth, similarity, chance_tokens)
    kept = F.col(names["kept_text"])
    chars = F.when(F.col(names["n_dropped"]) > 0, F.length(kept))
    return out.select(*[kept.alias(c) if c == text_col
                        else F.coalesce(chars.cast(docs.schema[c].dataType), F.col(c)).alias(c) if c == chars_col
                        else F.col(c) for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.col("kept_text").alias("text"))
