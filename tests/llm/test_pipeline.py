import pytest

import corpus_pipeline as C
from tests.llm.data import SCHEMA, empty, frame

DIR = "/root/testdata/sf0.001"


def test_stages_on_a_small_table(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = docs.columns
    sizes = [docs.count()]
    for name, stage in C.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, DIR), f"test-{name}")
        assert docs.columns == names
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[4] > 0
    pieces = C.STAGES[-1][1](spark, docs, DIR)
    assert pieces.select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("make", [empty, frame])
def test_awkward_tables_pass_every_stage(spark, make):
    for name, stage in C.STAGES:
        out = stage(spark, make(spark), DIR)
        if name != "best_fit_packing":
            assert out.columns == SCHEMA.names
        assert out.count() <= max(make(spark).count(), 0) or name == "best_fit_packing"


def test_extra_columns_with_the_names_of_inner_columns_pass_through(spark):
    from pyspark.sql import functions as F

    names = ["n_lines", "n_dropped", "kept_text", "rid__", "k_id", "k_digest", "k_gone", "fp", "shard", "leaf", "m", "g_lang", "words"]
    docs = spark.read.parquet(f"{DIR}/documents.parquet").withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    for name, stage in C.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, DIR), f"names-{name}")
        assert docs.columns[-len(names):] == names
        wrong = " or ".join(f"{n} is distinct from concat('{n}', doc_id)" for n in names)
        assert docs.count() > 0 and docs.where(wrong).count() == 0
    assert C.STAGES[-1][1](spark, docs, DIR).count() > 0


def test_every_stage_decides_as_its_operator(spark):
    """Contents, not only counts: each stage against its operator's own rows on that stage's input."""
    from critica.llm.decontaminate import contained_items
    from critica.llm.line_dedup import line_dedup
    from critica.llm.quality import quality_rules
    from critica.llm.simhash_dedup import near_duplicates

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = lambda df: sorted(map(repr, map(tuple, df.collect())))
    kept = C.stored(C.quality(spark, docs, DIR), "t-quality")
    good = quality_rules(docs).where("kept").select("doc_id")
    assert rows(kept) == rows(docs.join(good, "doc_id", "left_semi").select(docs.columns))
    lined = C.stored(C.lines(spark, kept, DIR), "t-lines")
    texts = {r.doc_id: r.kept_text for r in line_dedup(kept).collect()}
    assert {r.doc_id: r.text for r in lined.collect()} == texts
    assert all(r.n_chars == len(r.text) for r in lined.collect() if r.text != "")
    single = C.stored(C.near_dedup(spark, lined, DIR), "t-near")
    firsts = {r.component_id for r in near_duplicates(lined).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(firsts)
    clean = C.stored(C.decontaminate(spark, single, DIR), "t-clean")
    leaked = {r.doc_id for r in contained_items(single, spark.read.parquet(f"{DIR}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - leaked
