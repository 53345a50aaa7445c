"""Operator 12: chat formatting with Spark expressions only.

A conversation's rows are collected as structs and sorted by turn; runs of adjacent rows with the same role become one
block; blocks are concatenated under a template. Control strings inside texts and roles are escaped, so a mark in the
output is always the template's own and the output reads back to the rows it was made from:

    <|turn|>role<|text|>first text<|next|>second text of the same role<|end|><|turn|>...<|end|>

The loss mask is run-length encoded over the code points of the output: runs without and with loss in turn, beginning
without. Every text of a loss role is one run with loss; marks, roles and other texts are not. All steps are linear in
the length of the conversation: positions come from array indexes and run lengths, nothing is appended element by element.

Defined results: null texts and null roles are empty strings; rows with equal turns (null turns first) are ordered by
role, then text; repeated rows are rows of their own; a null conv_id is a conversation of its own; an empty table gives an
empty result; extra columns are ignored. A conversation is one row of the result, so it must fit into a row, as its
formatted text does; nothing else is gathered.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import let, read

# Control strings of common chat formats, which no text may bring into the output
COMMON_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
                   "<|system|>", "<|user|>", "<|assistant|>")


@dataclass(frozen=True)
class Template:
    """Marks of a chat format and the strings to escape besides them.

    A control string inside a text gets a backslash behind its first character; every backslash is doubled.
    """

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    next: str = "<|next|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = COMMON_CONTROLS
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        marks = (self.turn, self.text, self.next, self.end)
        if len(set(marks)) < 4 or any(len(m) < 2 or "\\" in m for m in self.all_controls()):
            raise ValueError("marks must differ; control strings need two characters and no backslash")
        for c in self.all_controls():
            # a mark beside a text must not make another control string with it
            if any(m.startswith(c[k:]) or c[k:].startswith(m) or m.endswith(c[:k]) for k in range(1, len(c)) for m in marks):
                raise ValueError(f"a mark could complete the control string {c!r}")

    def all_controls(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.turn, self.text, self.next, self.end, *self.controls)))

    def escape(self, text: Column) -> Column:
        heads: dict[str, list[str]] = {}
        for c in self.all_controls():
            heads.setdefault(c[0], []).append(re.escape(c[1:]))
        found = "|".join([r"\\", *(f"{re.escape(h)}(?={'|'.join(rest)})" for h, rest in heads.items())])
        return F.regexp_replace(text, found, r"$0\\")

    def unescape(self, text: Column) -> Column:
        firsts = "".join(re.escape(c) for c in dict.fromkeys(["\\", *(c[0] for c in self.all_controls())]))
        return F.regexp_replace(text, rf"([{firsts}])\\", "$1")


def conversation_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text", *more: str) -> DataFrame:
    """(conv_id, more, turns): the rows of each conversation as an array of (turn, role, text) in order."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                   F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.groupBy(F.col(conv_id).alias("conv_id"), *more).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def blocks_of(turns: Column) -> Column:
    """Runs of adjacent turns of one role: array of (role, texts)."""
    def merged(t):
        starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1),
                          lambda i: ~t[i]["role"].eqNullSafe(F.get(t, i - 1)["role"]))
        return let(starts, lambda s: F.transform(s, lambda at, k: F.struct(
            t[at]["role"].alias("role"),
            F.slice(t, at + 1, F.coalesce(F.get(s, k + 1), F.size(t)) - at)["text"].alias("texts"))))

    return F.when(F.size(turns) > 0, let(turns, merged))


def chat_format(rows: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(conv_id, more, formatted, mask) of every conversation; ``mask`` is an array of run lengths, without loss first.

    ``more`` names columns that, with the conversation's id, tell conversations apart.
    """
    turns = conversation_turns(rows, conv_id, turn, role, text, *more)

    def pieces(blocks):
        """(string, loss) in output order; strings with loss are texts of a loss role."""
        def of(b, k):
            opening = F.concat(F.when(k > 0, F.lit(template.end)).otherwise(F.lit("")), F.lit(template.turn),
                               template.escape(b["role"]), F.lit(template.text))
            loss = b["role"].isin(*template.loss_roles)
            return F.flatten(F.transform(b["texts"], lambda x, i: F.array(
                F.struct(F.when(i == 0, opening).otherwise(F.lit(template.next)).alias("s"), F.lit(False).alias("loss")),
                F.struct(template.escape(x).alias("s"), loss.alias("loss")))))

        return F.flatten(F.transform(blocks, of))

    def total(sizes, start, end):
        """Sum of sizes[start:end]."""
        return F.aggregate(F.slice(sizes, start + 1, end - start), F.lit(0).cast("bigint"), lambda a, x: a + x)

    def runs(sizes, at):
        """Run lengths from the sizes of all pieces and the places of those with loss."""
        def pair(i, k):
            return F.array(total(sizes, F.coalesce(F.get(at, k - 1) + 1, F.lit(0)), i), sizes[i].cast("bigint"))

        rest = total(sizes, F.coalesce(F.get(at, F.size(at) - 1) + 1, F.lit(0)), F.size(sizes)) + len(template.end)
        return F.concat(F.flatten(F.transform(at, pair)), F.array(rest))

    def output(parts):
        places = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: parts[i]["loss"])
        sizes = F.transform(parts, lambda p: F.char_length(p["s"]))
        return F.struct(F.concat(F.array_join(parts["s"], ""), F.lit(template.end)).alias("formatted"),
                        let(sizes, lambda n: let(places, lambda at: runs(n, at))).alias("mask"))

    done = F.transform(F.array(let(blocks_of(F.col("turns")), pieces)), output)[0]
    return (turns.select("conv_id", *more, done.alias("done"))
            .select("conv_id", *more, "done.formatted", "done.mask"))


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted conversation: array of (role, text, size), ``size`` in output code points."""
    def quoted(mark):
        return re.escape(mark)

    def block(b):
        def body(parts):
            role = template.unescape(F.substring(parts[0], len(template.turn) + 1, 2 ** 31 - 1))
            return let(role, lambda r: F.transform(F.split(parts[1], quoted(template.next), -1), lambda x: F.struct(
                r.alias("role"), template.unescape(x).alias("text"), F.char_length(x).cast("bigint").alias("size"))))

        return let(F.split(b, quoted(template.text), -1), body)

    blocks = F.split(formatted, quoted(template.end), -1)
    return let(blocks, lambda bs: F.flatten(F.transform(F.slice(bs, 1, F.size(bs) - 1), block)))


def loss_texts(turns: Column, mask: Column, template: Template = Template()) -> Column:
    """The texts under the mask, read from the turns of an output (see ``read_back``); null if mask and output disagree.

    The runs with loss must have the sizes of the texts of the loss roles, in order.
    """
    runs = F.transform(F.filter(mask, lambda x, i: i % 2 == 1), lambda x: x)
    texts = F.filter(turns, lambda t: t["role"].isin(*template.loss_roles))
    return let(texts, lambda t: F.when(runs == F.transform(t, lambda x: x["size"]), t["text"]))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lit(False).alias("added"))
    probe = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", probe, True), (-1, 1, "assistant", probe, True)],
                                  "conv_id bigint, turn bigint, role string, text string, added boolean")
    template = Template()
    made = chat_format(table.unionByName(added), template, more=("added",))
    result = F.transform(F.array(read_back(F.col("formatted"), template)), lambda t: F.struct(
        F.size(t).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform(t, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        let(F.array_join(loss_texts(t, F.col("mask"), template), ""), lambda s: F.struct(
            F.char_length(s).cast("bigint").alias("loss_chars"), F.sha2(s, 256).alias("loss_sha256"))).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars")))[0]
    return (made.select("conv_id", result.alias("r"))
            .select("conv_id", "r.n_turns", "r.turns_sha256", "r.loss.loss_chars", "r.loss.loss_sha256", "r.formatted_chars"))


def _sql() -> str:
    t = Template()
    marks = "|".join(re.escape(c).replace("'", "''") for c in t.all_controls())

    def size(x):  # escaped length: a backslash more for every backslash and every control string
        return f"(length({x}) + length({x}) - length(replace({x}, '\\', '')) + len(regexp_extract_all({x}, '{marks}')))"

    return f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, false as added from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]', true
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]', true),
steps as (
  select *, lag(role) over w is distinct from role as opens, row_number() over w as k
  from rows window w as (partition by conv_id, added order by turn nulls first, role, text))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
  sum({size('text')} + case when opens then {len(t.turn) + len(t.text) + len(t.end)} + {size('role')}
      else {len(t.next)} end)::bigint as formatted_chars
from steps group by conv_id, added
"""


OP12_SQL = _sql()
