"""Chat requests, the pluggable extraction step, and what it costs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.functions.text import strip
from pactframe.operators.documents import MAX_CHARS, avenant_texts, concat_contents
from pactframe.schemas import (
    BLOCK_GAP,
    CADRE_HEADER,
    CONTENT_LABEL,
    EXTRAPOLATED_DOCUMENTS,
    INPUT_EUR_PER_1M,
    OUTPUT_EUR_PER_1M,
    RESPONSES,
    SOUSCRIPTION_HEADER,
    TASK_LABEL,
)
from pactframe.session import checkpoint_dir

#: Requests of one task between two writes of answers.
PER_TASK = 16


def messages(content: Column, question: str, prompt: str) -> Column:
    user = F.concat(F.lit(CONTENT_LABEL), content, F.lit(TASK_LABEL), F.lit(question))

    def one(role: str, text: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), text.alias("content"))

    return F.array(one("system", F.lit(prompt)), one("user", user))


def cgcp_requests(classified: DataFrame, question: str, prompt: str, max_chars: int = MAX_CHARS) -> DataFrame:
    """One request per affair (one per part for an oversized affair) over its CG and CP texts."""
    texts = concat_contents(classified, max_chars)
    content = F.concat(
        F.lit(CADRE_HEADER), strip(F.col("cg_content")), F.lit(BLOCK_GAP),
        F.lit(SOUSCRIPTION_HEADER), strip(F.col("cp_content")),
    )
    suffix = F.when(F.col("n_parts") > 1, F.concat(F.lit("|"), F.col("part").cast("string"))).otherwise(F.lit(""))
    return texts.select(
        F.concat(F.col("affair_id"), F.lit("|CGCP"), suffix).alias("request_id"),
        "affair_id",
        F.lit("CGCP").alias("doc_class"),
        messages(content, question, prompt).alias("messages"),
    )


def avenant_requests(classified: DataFrame, question: str, prompt: str) -> DataFrame:
    """One request per amendment document."""
    return avenant_texts(classified).select(
        F.concat(F.col("affair_id"), F.lit("|AV|"), F.col("id")).alias("request_id"),
        "affair_id",
        F.lit("AV").alias("doc_class"),
        messages(F.col("content"), question, prompt).alias("messages"),
    )


def apply_extractor(
    requests: DataFrame, connect: Callable[[], Callable[[list[dict]], dict]], parallelism: int
) -> DataFrame:
    """Answer each request. `connect()` runs once per task and returns `answer(messages)`.

    The answer is a dict with `arguments`, `finish_reason`, `prompt_tokens`,
    `completion_tokens`. A failing request yields a row without arguments.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        answer = connect()
        for batch in batches:
            rows = []
            for request_id, chat in zip(batch["request_id"], batch["messages"]):
                try:
                    got = answer([dict(m) for m in chat])
                    pt, ct = int(got.get("prompt_tokens", 0)), int(got.get("completion_tokens", 0))
                    rows.append((request_id, got.get("arguments"), got.get("finish_reason"), pt, ct, pt + ct))
                except Exception as err:  # isolate the request, keep the batch
                    rows.append((request_id, None, f"error: {type(err).__name__}: {err}", 0, 0, 0))
            yield pd.DataFrame(rows, columns=RESPONSES.fieldNames())

    return requests.select("request_id", "messages").repartition(parallelism).mapInPandas(run, RESPONSES)


def is_error() -> Column:
    """Whether an answer only says that the request failed."""
    return F.startswith(F.coalesce("finish_reason", F.lit("")), F.lit("error: "))


def logged_answers(spark: SparkSession, log: str) -> DataFrame:
    """The answer of each request in a log: one row each, a real answer before an error. An absent log is empty."""
    try:
        rows = spark.read.schema(RESPONSES).parquet(log)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], RESPONSES)
    best = F.max_by(F.struct(*RESPONSES.fieldNames()), F.struct((~is_error()).alias("real"), "total_tokens", "arguments"))
    return rows.groupBy("request_id").agg(best.alias("best")).select("best.*")


def answer_requests(
    requests: DataFrame, connect: Callable[[], Callable[[list[dict]], dict]], parallelism: int, log: str, per_task: int = PER_TASK
) -> DataFrame:
    """Answers to all requests, written to `log` as they come in: a run that was broken off goes on where it stopped.

    Requests whose answer is in the log are not sent again; those that failed are. The others are sent in waves of
    `per_task` requests for each of `parallelism` tasks, and each wave is added to the log before the next begins, so that
    a lost task or driver costs the answers of one wave at most, whatever the number of requests.
    """
    spark = requests.sparkSession
    known = logged_answers(spark, log).filter(~is_error()).select("request_id")
    waiting = requests.select("request_id", "messages").join(known, "request_id", "left_anti")
    waves = -(-waiting.select("request_id").count() // (parallelism * per_task))
    if waves:
        staged = f"{checkpoint_dir(spark).rstrip('/')}/requests-{uuid.uuid4().hex}"
        wave = F.pmod(F.xxhash64("request_id"), F.lit(waves)).cast("int")
        waiting.withColumn("wave", wave).write.partitionBy("wave").parquet(staged)
        for k in range(waves):
            asked = spark.read.parquet(staged).filter(F.col("wave") == k)
            apply_extractor(asked, connect, parallelism).write.mode("append").parquet(log)
    return logged_answers(spark, log).join(requests.select("request_id").distinct(), "request_id", "left_semi")


def attach_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Every request with its answer, if any."""
    return requests.join(responses, "request_id", "left")


def token_cost(
    responses: DataFrame,
    by: list[str],
    input_per_1m: float = INPUT_EUR_PER_1M,
    output_per_1m: float = OUTPUT_EUR_PER_1M,
    n_docs: int = EXTRAPOLATED_DOCUMENTS,
) -> DataFrame:
    """Tokens, cost, its extrapolation and truncated answers per group."""
    sums = responses.groupBy(*by).agg(
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.count_if(F.col("finish_reason") == "length").alias("n_truncated"),
    )
    cost = F.col("prompt_tokens") / 1e6 * input_per_1m + F.col("completion_tokens") / 1e6 * output_per_1m
    return sums.withColumn("cost_eur", cost).withColumn("cost_all_eur", F.lit(n_docs) * F.col("cost_eur"))
