"""Terms are counted in the row of their document: only texts are shuffled."""

import pytest
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import analytics


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_counts_of_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "b a b"), (1, "a c"), (None, "x"), (None, "x y"), (2, None), (3, ""), (4, "--")], "doc_id long, text string")
    assert rows(analytics.term_counts(docs)) == sorted([(1, "a", 2), (1, "b", 2), (1, "c", 1), (None, "x", 2), (None, "y", 1)], key=str)
    assert {r.total for r in analytics.term_counts(docs, total=True).where("doc_id = 1").collect()} == {5}
    assert analytics.full_counts(docs.limit(0)).count() == 0


def test_strongest_keeps_the_largest_count(spark):
    one = spark.range(1).select(T.strongest(F.expr("array(named_struct('term','b','count',1L), named_struct('term','a','count',2L), named_struct('term','b','count',3L), named_struct('term','','count',9L))")).alias("c"))
    assert [tuple(x) for x in one.first().c] == [("a", 2), ("b", 3)]


@pytest.mark.parametrize("counts", [lambda d: analytics.term_counts(d, stop_words=True, clean=True), analytics.full_counts])
def test_words_are_not_shuffled(spark, counts):
    docs = spark.createDataFrame([(1, "new york is new york")], "doc_id long, text string")
    plan = counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and "hashpartitioning(doc_id#" in plan and ", term#" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_weights_of_common_and_rare_terms(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"all w{k % 3} u{k}") for k in range(9)], "doc_id long, text string")
    want = rows(analytics.tfidf(analytics.term_counts(docs)))
    monkeypatch.setattr(analytics, "COMMON", 2)
    counts = analytics.term_counts(docs, total=True)
    assert rows(analytics.tfidf(counts)) == want and len(want) == 27


def test_words_are_counted_and_characters_sorted_without_lambdas(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, "--"), (3, "é z a é")], "doc_id long, text string")
    assert rows(analytics.term_counts(docs)) == sorted([(1, "a", 1), (1, "b", 2), (3, "a", 1), (3, "z", 1), (3, "é", 2)], key=str)
    counted = analytics.term_counts(docs)._jdf.queryExecution().executedPlan().toString()
    hashed = docs.select(T.sorted_char_hash(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in counted and "ArrowEvalPython" in hashed and "sort_array" not in counted + hashed


def test_hash_of_any_characters(spark):
    import hashlib

    texts = ["banana\n", "zé€\U0001f600a", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(T.sorted_char_hash(F.col("text"))).collect()]
    assert got == [None if t is None else hashlib.sha256("".join(sorted(t)).encode()).hexdigest() for t in texts]
    broken = spark.sql("select cast(x'61ff62' as string) text union all select cast(x'62ff61' as string)").select(T.sorted_char_hash(F.col("text")).alias("h"))
    assert broken.distinct().count() == 1


def test_summaries_are_made_in_the_row_of_the_document(spark):
    docs = spark.createDataFrame([(1, "a b a b a c b c b"), (2, "x y"), (3, "--"), (4, "é é é")], "doc_id long, text string")
    for limit in (None, 4, 1):
        want = rows(analytics.pseudo_text(analytics.term_counts(docs), limit=limit))
        made = analytics.pseudo_text_of(docs, limit=limit)
        assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert rows(made) == want and len(want) == 3
    assert rows(analytics.pseudo_text_of(docs, limit=None)) == [(1, "b\nb\na\n", None), (2, None, "no terms left"), (4, "é\n", None)]


def test_runs_are_counted_and_cleaned_in_arrow_batches(spark, monkeypatch):
    texts = [(1, "it's good gold, it's good gold. 1999 1234 x don't"), (1, "new york\nnew york, new 'york'"), (2, "gold\U00010428after all"), (3, None), (4, "'"), (None, "New York")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    made = analytics.full_counts(docs)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan and plan.count("Exchange hashpartitioning(doc_id") == 1
    want = [(1, "it's gold", 2), (1, "new 'york'", 1), (1, "1999", 1), (1, "don", 1), (1, "gold", 2), (1, "good", 2), (1, "new york", 3), (1, "new", 3), (1, "york", 3)]
    want += [(2, "gold\U00010428after", 1), (None, "new york", 1), (None, "new", 1), (None, "york", 1)]
    assert rows(made) == sorted(want, key=str)
    monkeypatch.setattr(T, "SLICE", 1)
    assert rows(analytics.full_counts(docs)) == sorted(want, key=str)
    long = spark.createDataFrame([(1, "one' two three four. gold price now")], "doc_id long, text string")
    assert rows(analytics.phrase_counts(long, 2)) == [] and rows(analytics.phrase_counts(long)) == [(1, "gold price now", 1)]
