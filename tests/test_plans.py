"""What the plans look like: no Python workers, pruned scans, early cuts, no cross joins."""

import pytest

import __spark_entry__ as entry

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonUDF")
# Operators whose subject is a passed Python function or a parser, or that work on arrays of numbers.
WITH_PYTHON = ("x4", "x5", "x6", "x7", "t20_extract_terms_tokenizer", "p10_extract_nested_fields", "p11_page_window",
               "t9_cluster", "t12_cluster_members", "b7_cluster_corpus", "op11", "op12", "op13")
LAZY = [n for n in entry.oracle_sql() if not n.startswith(WITH_PYTHON)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_jvm_only_and_no_cross_join(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    assert not any(p in text for p in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(entry.queries()["f4_keep_values"](spark, sf))
    assert "In(o_orderpriority" in text and "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text
    text = plan(entry.queries()["a18_word_counts_by"](spark, sf))
    assert "ReadSchema: struct<text:string,lang:string>" in text


def test_groups_are_cut_before_the_shuffle(spark, sf):
    text = plan(entry.queries()["a18_word_counts_by"](spark, sf))
    assert text.count("WindowGroupLimit") == 4 and text.count("Exchange hashpartitioning") == 3
    assert "TakeOrderedAndProject" in plan(entry.queries()["l3_top_n"](spark, sf))


def test_texts_are_cleaned_once(spark, sf):
    for name in ("b5_sentiment_words", "t3_term_counts", "a22_answer_stability"):
        text = plan(entry.queries()[name](spark, sf))
        assert "Filter ((size(" not in text
    assert plan(entry.queries()["b5_sentiment_words"](spark, sf)).count("lower(text") == 1
