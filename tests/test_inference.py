from pyspark.sql import functions as F

from segqa import attach_responses, call_report, chat_requests, dedup_prompts, infer_batch, materialize
from segqa.functions.prompts import OPEN_BOOK, SYNTHESIS
from segqa.schemas import RESPONSE


def requests(spark, prompts, model="m"):
    df = spark.createDataFrame([(p, model) for p in prompts], "p string, model string")
    return chat_requests(df, "model", F.col("p"), OPEN_BOOK)


def test_requests_carry_settings(spark):
    row = requests(spark, ["x", None]).collect()
    assert len(row) == 1  # no prompt, no request
    assert (row[0].temperature, row[0].max_tokens, row[0].system) == (0.3, 150, OPEN_BOOK.system)


def test_dedup(spark):
    df = dedup_prompts(requests(spark, ["same"] * 1000 + ["other"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2  # copies meet before the shuffle
    assert sorted(r.prompt for r in df.collect()) == ["other", "same"]


def test_failures_stay_single(spark):
    def provider(batch):
        if any(r.prompt == "bad" for r in batch):
            raise RuntimeError("refused")
        return [None if r.prompt == "empty" else r.prompt.upper() for r in batch]

    df = infer_batch(dedup_prompts(requests(spark, ["a", "b", "bad", "empty"])), provider)
    assert df.schema == RESPONSE
    rows = df.collect()
    assert sorted((r.response or "", r.error or "") for r in rows) == [
        ("", "RuntimeError: refused"),
        ("", "no response"),
        ("A", ""),
        ("B", ""),
    ]


def test_wrong_answers_are_errors(spark):
    def short(batch):
        return []

    def number(batch):
        return [1 for _ in batch]

    for provider in (short, number):
        rows = infer_batch(dedup_prompts(requests(spark, ["a", "b"])), provider).collect()
        assert [r.response for r in rows] == [None, None] and all(r.error for r in rows)


def test_batches(spark):
    def size(batch):
        return [str(len(batch))] * len(batch)

    df = dedup_prompts(requests(spark, [str(i) for i in range(25)]))
    got = infer_batch(df, size, batch_size=10, parallelism=1).collect()
    assert sorted(int(r.response) for r in got) == [5] * 5 + [10] * 20


def test_one_prompt_with_two_settings(spark):
    rows = spark.createDataFrame([("same", "m")] * 3, "p string, model string")
    asked = [chat_requests(rows, "model", F.col("p"), s) for s in (OPEN_BOOK, SYNTHESIS)]
    requests_ = dedup_prompts(asked[0].union(asked[1]))
    stored = materialize(infer_batch(requests_, lambda b: [str(r.max_tokens) for r in b]), "t")
    got = attach_responses(rows, stored, "model", F.col("p"), OPEN_BOOK, "open")
    got = attach_responses(got, stored, "model", F.col("p"), SYNTHESIS, "made").collect()
    assert [(r.open, r.made) for r in got] == [("150", "300")] * 3


def test_report_of_failures(spark):
    def provider(batch):
        if any(r.prompt == "bad" for r in batch):
            raise RuntimeError("refused")
        return ["fine" for _ in batch]

    stored = infer_batch(dedup_prompts(requests(spark, ["a", "b", "bad"])), provider)
    assert [tuple(r) for r in call_report(stored).collect()] == [
        ("open_book", "m", 3, 1, "RuntimeError: refused")
    ]


def test_lookup(spark):
    asked = dedup_prompts(requests(spark, ["a"] * 50 + ["b"]))
    stored = materialize(infer_batch(asked, lambda batch: [r.prompt * 2 for r in batch]), "t")
    rows = spark.createDataFrame(
        [("a", "m"), ("a", "m"), ("b", "m"), ("b", "other"), ("c", "m"), (None, "m")],
        "p string, model string",
    )
    got = attach_responses(rows, stored, "model", F.col("p"), OPEN_BOOK, "reply")
    assert got.columns == ["p", "model", "reply"]
    assert sorted((r.p or "", r.model, r.reply) for r in got.collect() if r.reply) == [
        ("a", "m", "aa"),
        ("a", "m", "aa"),
        ("b", "m", "bb"),
    ]
    assert got.count() == 6
