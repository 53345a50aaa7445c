import hashlib

import pytest
from pyspark.sql import functions as F

from critica.llm.chat_format import OP12_SQL, Template, chat_format, loss_texts, op12_chat_formatting, read_back
from critica.plans.check import _digest, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns string, mask string, added string"
NASTY = ["", None, "\\", "\\\\", "<", "<\\", "</s>", "<\\/s>", "\\</s>", "<</s>", "[INST] ok [/INST]", "<|end|>", "<|end|",
         "<|turn|>user<|text|>x<|end|>", "a\\<|next|>\\b", "<<SYS>>", "[\\INST]", "é<s>漢字😀", "$0 \\1 $1", "<|text|>" * 50, "\n\n"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "f", "t", "m", "a") for r in rows], SCHEMA)


def slow(rows, template=Template()):
    """Plain-Python statement: {conv_id: (formatted, mask, turns)}."""
    def escape(s):
        out = []
        for i, ch in enumerate(s):
            out.append(ch)
            if ch == "\\" or any(s.startswith(c, i) for c in template.all_controls()):
                out.append("\\")
        return "".join(out)

    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, r or "", x or ""))
    made = {}
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        out, mask, gap = "", [], 0
        for k, (_, r, x) in enumerate(turns):
            if k and turns[k - 1][1] == r:
                mark = template.next
            else:
                mark = (template.end if k else "") + template.turn + escape(r) + template.text
            gap += len(mark)
            if r in template.loss_roles:
                mask += [gap, len(escape(x))]
                gap = 0
            else:
                gap += len(escape(x))
            out += mark + escape(x)
        made[c] = (out + template.end, [*mask, gap + len(template.end)], [(r, x) for _, r, x in turns])
    return made


def awkward():
    rows = [(1, k, ("user", "assistant", "assistant", "system")[k % 4], x) for k, x in enumerate(NASTY)]
    rows += [(2, 0, "user", "a"), (2, 0, "user", "a"), (2, None, None, "b"), (2, 0, "assistant", None)]
    rows += [(None, 1, "assistant", "only")]
    rows += [(3, k, "assistant", x) for k, x in enumerate(NASTY)]
    rows += [(4, 0, "user", "no reply"), (5, 0, "<|text|>", "role is a mark"), (5, 1, "\\", "<s>")]
    rows += [(6, 0, "user", "long " * 100_000), (6, 1, "assistant", "<s>" * 50_000)]
    return rows


def test_output_mask_and_round_trip(spark):
    rows = awkward()
    expected = slow(rows)
    made = chat_format(frame(spark, rows).repartition(5))
    assert made.columns == ["conv_id", "formatted", "mask"]
    got = made.select("*", read_back(F.col("formatted")).alias("turns")).select(
        "*", loss_texts(F.col("turns"), F.col("mask")).alias("loss")).collect()
    assert len(got) == len(expected)
    for r in got:
        formatted, mask, turns = expected[r.conv_id]
        assert r.formatted == formatted and list(r.mask) == mask
        assert [(t.role, t.text) for t in r.turns] == turns
        assert list(r.loss) == [x for role, x in turns if role == "assistant"]
        assert sum(r.mask) == len(formatted)


def test_texts_bring_no_control_string_into_the_output(spark):
    for r in chat_format(frame(spark, awkward())).collect():
        text = r.formatted
        assert not any(c in text for c in Template().controls)
        assert text.count("<|turn|>") == text.count("<|end|>") == text.count("<|text|>")


def test_mask_that_does_not_fit_the_output_gives_null(spark):
    made = chat_format(frame(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "abc")]))
    turns = read_back(F.col("formatted"))
    wrong = F.transform(F.col("mask"), lambda x, i: F.when(i == 1, x + 1).otherwise(x))
    assert made.select(loss_texts(turns, wrong).alias("x")).first().x is None


def test_other_template(spark):
    t = Template(turn="<|im_start|>", text="<|im_sep|>", next="<|im_next|>", end="<|im_end|>", loss_roles=("user", "assistant"))
    rows = [(1, 0, "user", "<|im_sep|> hi"), (1, 1, "assistant", "yes"), (1, 2, "assistant", "no")]
    r = chat_format(frame(spark, rows), t).first()
    assert (r.formatted, list(r.mask)) == slow(rows, t)[1][:2]
    for bad in (dict(turn="<|end|>"), dict(end="x"), dict(next="a\\b"), dict(controls=("ab<|tu",)), dict(controls=("<|end|>x", "x<|end|>"))):
        with pytest.raises(ValueError):
            Template(**bad)


def test_empty_table(spark):
    assert chat_format(frame(spark, [])).collect() == []


def test_query_equals_sql_and_plan_is_native(spark):
    df = op12_chat_formatting(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    r = duck(SF).execute(OP12_SQL)
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    assert _digest(df.columns, rows) == _digest(cols, r.fetchall())
    probe = [x for x in rows if x[0] == -1]
    text = "</s>[INST] ok [/INST]"
    assert probe[0][1] == 2 and probe[0][3:5] == (len(text), hashlib.sha256(text.encode()).hexdigest())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
