from critica.llm import line_dedup as L
from tests.llm.data import SCHEMA, empty, frame, prose, rows


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0, *["x"] * 6) for i, t in enumerate(texts)], SCHEMA)


def kept(df):
    return {r.doc_id: (r.kept_text, r.n_dropped) for r in df.collect()}


def test_recurring_templates_leave_one_copy(spark):
    passage = prose(50, 60)
    edited = passage.replace(passage.split()[30], "other").replace(passage.split()[45], "77")
    texts = [prose(i, 30) + "\n" + (edited if i == 4 else passage) + "\n\n" + prose(100 + i, 25) for i in range(6)]
    texts += [f"{prose(60, 9)}\n" + prose(200 + i, 40) for i in range(3)]  # nine tokens in three documents: by chance
    out = kept(L.line_dedup(docs_of(spark, texts)))
    assert out[0] == (texts[0], 0)
    for i in range(1, 6):
        lines = texts[i].split("\n")
        assert out[i] == ("\n".join([lines[0], "", lines[3]]), 1)
    for i in range(6, 9):
        assert out[i] == (texts[i], 0)


def test_two_documents_share_a_passage_however_its_lines_are_cut(spark):
    words = prose(70, 56).split()
    short = "\n".join(" ".join(words[a:a + 2]) + "\n" * (a % 3) for a in range(0, 14, 2))  # two tokens a line, some blank lines
    texts = [prose(300, 12) + "\n" + prose(301, 40), prose(300, 12) + "\n" + prose(302, 40),  # one line of 12 tokens
             prose(303, 20) + "\n" + short + "\n" + prose(304, 20), short + "\n" + prose(305, 20),
             prose(306, 4) + "\n" + prose(307, 30), prose(306, 4) + "\n" + prose(308, 30),  # a few tokens: by chance
             "\n".join(["10", "7 8 9", "11", "12 1"] * 4) + "\n" + prose(309, 30), "\n".join(["1", "2 3 4", "5", "6 7"] * 4)]
    out = kept(L.line_dedup(docs_of(spark, texts)))
    assert [out[i][1] for i in range(8)] == [0, 1, 0, 7, 0, 0, 0, 0]
    assert out[1][0] == prose(302, 40) and out[3][0].strip() == prose(305, 20) and out[2][0] == texts[2]


def test_shortest_passages_cover_every_line_of_a_shared_run():
    import random
    rnd = random.Random(8)
    for _ in range(300):
        lines = [(2 * k, k + (k > 9), rnd.randint(0, 6), rnd.randint(1, 9)) for k in range(rnd.randint(1, 14))]
        of = {t: w for _, _, w, t in lines}  # one weight a template
        lines = [(p, s, of[t], t) for p, s, _, t in lines]
        found = L.shortest_passages(lines, 10)
        assert len(found) <= 2 * len(lines)
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if lines[b][1] - lines[a][1] == b - a and sum(of[t] for t in {x[3] for x in lines[a:b + 1]}) >= 10:
                    inside = {k for s, e, _ in found if a <= s // 2 and e // 2 <= b for k in range(s // 2, e // 2 + 1)}
                    assert set(range(a, b + 1)) == inside | {k for k in range(a, b + 1) if lines[k][2] >= 10}


def test_digits_are_variable_fields(spark):
    line = "visitor number {} of {} on this page since we began to count all of them in a book of names by hand"
    out = kept(L.line_dedup(docs_of(spark, [line.format(i, 7 * i) + "\n" + prose(i, 20) for i in range(1, 5)])))
    assert [n for _, n in out.values()] == [0, 1, 1, 1]


def test_repeats_inside_one_document_stay(spark):
    line = prose(9, 40)
    assert kept(L.line_dedup(docs_of(spark, ["\n".join([line] * 5), prose(8, 40)])))[0] == ("\n".join([line] * 5), 0)


def test_leaf_generalises_like_the_sequential_rule():
    leaf = L.Leaf(10, 0.8)
    first = prose(1, 10).encode()
    words = first.split()
    near = b" ".join([*words[:8], b"x", b"y"])
    far = b" ".join([*words[:5], b"a", b"b", b"c", b"d", b"e"])
    assert [leaf.add(1, first), leaf.add(2, near), leaf.add(3, far), leaf.add(4, b" ".join([*words[:8], b"p", b"q"]))] == [1, 1, 3, 1]


def test_large_leaves_find_the_same_templates(monkeypatch):
    import random
    rnd = random.Random(4)
    lines = []
    for i in range(300):
        base = prose(i, 12).split()
        for _ in range(4):
            w = list(base)
            for p in rnd.sample(range(3, 12), rnd.randint(0, 3)):
                w[p] = rnd.choice(["x", "y", w[p], "<*>"])
            lines.append(" ".join(w).encode())
    rnd.shuffle(lines)

    def run():
        leaf = L.Leaf(12, 0.8)
        return [leaf.add(i, line) for i, line in enumerate(lines)]

    monkeypatch.setattr(L, "SCAN_TEMPLATES", 10 ** 9)
    want = run()
    monkeypatch.setattr(L, "SCAN_TEMPLATES", 5)
    assert run() == want and len(set(want)) < 900


def test_awkward_rows_and_columns(spark):
    out = L.line_dedup(frame(spark))
    assert out.columns == [*SCHEMA.names, "n_lines", "n_dropped", "kept_text"]
    got = out.collect()
    assert len(got) == len(rows())
    shared = prose(4, 60)
    assert sorted(r.n_dropped for r in got if r.text and r.text.endswith("\n" + shared)) == [0, 1]
    assert all(r.kept_text == r.text for r in got if not r.n_dropped)
    assert [r.kept_text for r in got if r.text is None] == [None, None]


def test_empty_table(spark):
    assert L.line_dedup(empty(spark)).count() == 0
