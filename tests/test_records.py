from pyspark.sql import functions as F

from loomline.functions.tokenizers import BYTES
from loomline.operators import records

TURNS = "conv_id long, turn long, role string, text string"


def test_dedup_exact_keeps_the_smallest_id_and_one_missing_text(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, None), (4, None), (6, "")], "doc_id long, text string")
    assert sorted(r.doc_id for r in records.dedup_exact(df).collect()) == [1, 2, 4, 6]


def test_chat_pieces_join_to_the_prompt(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 0, "system", "x")]
    got = records.chat_template(spark.createDataFrame(rows, TURNS)).orderBy("conv_id", "turn").collect()
    text = "".join(r.piece for r in got if r.conv_id == 1)
    assert text == ("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n<|im_start|>assistant\n")


def test_sft_labels_cover_the_answer_only(spark):
    rows = [(1, 0, "user", "ab"), (1, 1, "assistant", "c"), (1, 2, "user", "left open"), (2, 5, "assistant", "alone")]
    got = records.sft_examples(spark.createDataFrame(rows, TURNS), BYTES).collect()
    assert [(r.tokens, r.labels) for r in got] == [([97, 98, 99], [-1, -1, 99])]


def test_best_worst_pairs_skips_ties(spark):
    rows = [("p", 1, 2.0), ("p", 2, 2.0), ("p", 3, 1.0), ("p", 4, 1.0), ("q", 5, 1.0), ("q", 6, 1.0), ("r", 7, None)]
    got = records.best_worst_pairs(spark.createDataFrame(rows, "p string, i long, s double"), "p", "i", "s").collect()
    assert [(r.p, r.chosen, r.rejected) for r in got] == [("p", 1, 3)]


def test_holdout_has_the_wanted_size_in_each_stratum(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 480, "hot").otherwise("few").alias("lang"))
    got = records.stratified_holdout(df, ["lang"], 30).groupBy("lang", "holdout").count().collect()
    assert {(r["lang"], r.holdout): r["count"] for r in got} == {("hot", True): 30, ("hot", False): 450, ("few", True): 20}


def test_chunks_cover_all_tokens(spark):
    df = spark.createDataFrame([(1, list(range(11))), (2, []), (3, [7])], "doc_id long, tokens array<int>")
    got = records.chunk_sliding(df, 4, 2).orderBy("doc_id", "start").collect()
    assert [r.chunk for r in got if r.doc_id == 1] == [list(range(s, min(s + 4, 11))) for s in range(0, 11, 2)]
    assert [r.doc_id for r in got if r.doc_id != 1] == [3]


def test_context_budget_ends_at_the_first_that_does_not_fit(spark):
    rows = [("q", 1, 500), ("q", 2, 300), ("q", 3, 10)]
    df = spark.createDataFrame(rows, "q string, rank int, n long")
    assert [r["rank"] for r in records.context_budget(df, "q", "n").collect()] == [1]


def test_index_changes(spark):
    index = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], "doc_id long, text string, version int")
    new = spark.createDataFrame([(2, "B", 1), (4, None, 1), (3, "C", 1)], "doc_id long, text string, version int")
    got = records.index_upsert_delete(index, new, spark.createDataFrame([(3,)], "doc_id long")).collect()
    assert {(r.doc_id, r.text) for r in got} == {(1, "a"), (2, "B"), (4, None)}


def test_behaviour_and_errors(spark):
    rows = [("t", 1, "x", "a"), ("t", 1, "y", "b"), ("t", 2, "y", "b"), ("t", 2, "x", "a"), ("t", 3, "x", "b"), ("t", 3, "y", "a")]
    got = records.behavior_clusters(spark.createDataFrame(rows, "t string, s long, k string, o string"), "t", "s", "k", "o")
    assert {(r.s, r.cluster, r.size) for r in got.collect()} == {(1, 1, 2), (2, 1, 2), (3, 3, 1)}
    said = spark.createDataFrame([("T\nValueError: x",), ("a.b.MyError",), ("Killed",), (None,)], "m string")
    assert {(r.kind, r.n) for r in records.error_histogram(said, "m").collect()} == {
        ("ValueError", 1), ("a.b.MyError", 1), ("other", 1)}
