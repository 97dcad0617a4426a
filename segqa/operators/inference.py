"""Batch calls to a caller-supplied model and the lookup of their responses."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import ChatSettings
from .responses import ResponseLog


class ChatRequest(NamedTuple):
    model: str
    system: str
    prompt: str
    temperature: float
    max_tokens: int


class Outage(Exception):
    """Raised by a provider that cannot go on: the task fails, and nothing is taken for an answer."""


# Answers a list of requests in order; None stands for a failed call.
Provider = Callable[[list[ChatRequest]], list[str | None]]

_REQUEST = ["request_id", "call", "model", "system", "prompt", "temperature", "max_tokens"]


def prompt_hash(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def request_id(model: Column, prompt: Column, settings: ChatSettings) -> Column:
    """Identity of a request: model, prompt and all settings. Null without a prompt."""
    parts = F.struct(
        model.alias("model"),
        F.lit(settings.system).alias("system"),
        prompt.alias("prompt"),
        F.lit(settings.temperature).alias("temperature"),
        F.lit(settings.max_tokens).alias("max_tokens"),
        F.lit(settings.call).alias("call"),
    )
    return F.when(prompt.isNotNull(), F.sha2(F.to_json(parts), 256))


def chat_requests(
    df: DataFrame, model_col: str, prompt: Column, settings: ChatSettings
) -> DataFrame:
    """One request per row of ``df`` that has a prompt."""
    return df.select(
        F.lit(settings.call).alias("call"),
        F.col(model_col).alias("model"),
        F.lit(settings.system).alias("system"),
        prompt.alias("prompt"),
        F.lit(settings.temperature).alias("temperature"),
        F.lit(settings.max_tokens).alias("max_tokens"),
        request_id(F.col(model_col), prompt, settings).alias("request_id"),
    ).filter(F.col("prompt").isNotNull())


def dedup_prompts(requests: DataFrame) -> DataFrame:
    """Each distinct request once.

    All columns are grouping keys: a hash aggregation, so equal requests already collapse before the
    shuffle, however many copies there are. (By ``request_id`` alone with any value of the text, the
    plan would sort all prompts.)
    """
    return requests.select(*_REQUEST).distinct()


def infer_batch(
    requests: DataFrame,
    provider: Provider,
    batch_size: int = 64,
    parallelism: int | None = None,
    log: ResponseLog | None = None,
) -> DataFrame:
    """``(request_id, call, model, response, error)`` for every request.

    A failing batch is repeated request by request; a request that still fails gets a null response
    and the error. ``parallelism`` sets how many tasks share the calls, by default the session's
    shuffle partitions; left alone, small requests would be merged into few tasks although each is a
    slow call.

    The result is lazy: without a ``log``, store it (``materialize``) before more than one consumer
    reads it. With one, every request is looked up there first and every batch of answers is kept
    there at once, so that repeated tasks, readers and runs ask only what is missing; ``requests``
    must then hold each request once (``dedup_prompts``).
    """
    tasks = parallelism or int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked, schema = requests.select(*_REQUEST), "request_id string, call string, model string, "
    schema += "response string, error string"
    if log is None:
        return asked.repartition(tasks).mapInArrow(_caller(provider, batch_size), schema)
    bucket = log.bucket("request_id")
    dealt = asked.withColumn("bucket", bucket).repartition(min(tasks, log.buckets), "bucket")
    return dealt.sortWithinPartitions("bucket").mapInArrow(
        _logged(_caller(provider, batch_size), batch_size, log), schema
    )


def _logged(call, batch_size: int, log: ResponseLog):
    """``call`` for what the log does not know."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            for bucket in dict.fromkeys(buckets.tolist()):
                rows = batch.filter(pa.array(buckets == bucket))
                known = log.known(bucket, rows.column("request_id").to_pylist())
                ids = rows.column("request_id").to_pylist()
                found = [i for i in ids if i in known]
                if found:
                    kept = rows.filter(pa.array([i in known for i in ids]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(kept.column(name) for name in _REQUEST[:3]),
                            pa.array([known[i][0] for i in found], pa.string()),
                            pa.array([known[i][1] for i in found], pa.string()),
                        ],
                        ["request_id", "call", "model", "response", "error"],
                    )
                missing = rows.filter(pa.array([i not in known for i in ids]))
                # a batch at a time, so that what is answered is kept whatever comes next
                for begin in range(0, missing.num_rows, batch_size):
                    for answered in call(iter([missing.slice(begin, batch_size)])):
                        log.append(bucket, pa.Table.from_batches([answered]))
                        yield answered

    return look_up


def _caller(provider: Provider, batch_size: int):
    def ask(requests: list[ChatRequest]) -> list[tuple[str | None, str | None]]:
        try:
            answers = list(provider(requests))
            if len(answers) != len(requests):
                raise ValueError(f"{len(answers)} answers to {len(requests)} requests")
            if not all(a is None or isinstance(a, str) for a in answers):
                raise TypeError("an answer is neither text nor None")
            return [(a, None if a is not None else "no response") for a in answers]
        except Outage:
            raise
        except Exception as problem:
            if len(requests) == 1:
                return [(None, f"{type(problem).__name__}: {problem}")]
            return [ask([request])[0] for request in requests]

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(name).to_pylist() for name in _REQUEST))
            while part := list(islice(rows, batch_size)):
                answers = ask([ChatRequest(*row[2:]) for row in part])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([row[k] for row in part], pa.string()) for k in range(3)),
                        pa.array([answer for answer, _ in answers], pa.string()),
                        pa.array([error for _, error in answers], pa.string()),
                    ],
                    ["request_id", "call", "model", "response", "error"],
                )

    return call


def call_report(*responses: DataFrame) -> DataFrame:
    """``(call, model, requests, failed, example)`` of stored responses; ``example`` is an error."""
    stored = responses[0]
    for more in responses[1:]:
        stored = stored.unionByName(more)
    return stored.groupBy("call", "model").agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.min("error").alias("example"),
    )


def attach_responses(
    df: DataFrame,
    responses: DataFrame,
    model_col: str,
    prompt: Column,
    settings: ChatSettings,
    name: str = "response",
) -> DataFrame:
    """Add the response to each row's request as column ``name``, null if there is none.

    Every row comes back once. A left join without a forced strategy: stored responses have a known
    size and are broadcast when small, else the adaptive planner splits the side that holds a
    frequent request.
    """
    found = responses.select(F.col("request_id").alias("_found"), F.col("response").alias(name))
    keyed = df.withColumn("_request", request_id(F.col(model_col), prompt, settings))
    return keyed.join(found, F.col("_request") == F.col("_found"), "left").drop("_request", "_found")
