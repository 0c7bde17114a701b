"""Prompts and calls to a text model behind an injected client."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.text import fuse_text
from surveyloom.operators import replies as kept
from surveyloom.session import materialise
from surveyloom.settings import CATEGORY_LABELS, ModelOptions

# A client maps a list of prompts to a list of replies. It is built on the worker by a
# factory, once per task, so connections are never pickled.
Client = Callable[[Sequence[str], ModelOptions], Sequence[str]]
ClientFactory = Callable[[], Client]

RESULT = "ml_generate_text_llm_result"
STATUS = "ml_generate_text_status"

TRANSLATE_PROMPT = (
    "Put the text below into English. Answer with one JSON object and nothing else, "
    'in the form {"translation": "<English text>"}. Text: '
)


def category_prompt(labels: Sequence[str] = CATEGORY_LABELS) -> str:
    listed = "; ".join(labels)
    return (
        f"Choose the one category the customer writes about, out of: {listed}. "
        'Answer with one JSON object and nothing else, in the form '
        '{"Comment Category": "<category>"}. Text: '
    )


def classify_prompt(labels: Sequence[str] = CATEGORY_LABELS) -> str:
    listed = "; ".join(labels)
    return (
        f"Read the customer's text below. Choose the one category that it is about, out of: {listed}. Say how sure you are and how "
        "serious the matter is, each from 0 to 1, and put the text into English. Answer with one JSON object and nothing else, in the "
        'form {"category": "<category>", "confidence": 0.0, "severity": 0.0, "translation": "<English text>"}. Text: '
    )


def with_prompt(df: DataFrame, instruction: str, text_col: str = "comment") -> DataFrame:
    """Add `prompt`; an empty text gives a null prompt, which is never sent."""
    text = F.nullif(F.col(text_col), F.lit(""))
    return df.withColumn("prompt", F.concat(F.lit(instruction), text))


def generate_text(
    df: DataFrame,
    client: ClientFactory,
    options: ModelOptions = ModelOptions(),
    prompt_col: str = "prompt",
    batch_size: int = 64,
    retries: int = 2,
    pause: float = 0.5,
    tasks: int | None = None,
    store: str | None = None,
    per_file: int = 16,
) -> DataFrame:
    """Pass all columns through and add the model's reply and a status.

    Equal prompts are sent once; replies come back by the prompt's digest, so the prompts
    themselves are not shuffled again. Calls are slow and small, which is why the number
    of tasks that make them is fixed (one per core by default) and not left to the size
    of the data. Prompts that keep failing give a null reply and the error in the status;
    the rows stay, and the other prompts of their batch get their replies. Spark may run a task again, so write or checkpoint the result before
    using it twice, or name a `store`: a shared folder that keeps every reply by the digest of
    prompt and options. With it the calls are made at once, only for prompts that it has no
    reply for, and written every `per_file` batches, so a lost task or run pays again for
    that many at most; one store may serve any number of jobs, one after another.
    """
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism
    if store:
        return _from_store(df, client, options, prompt_col, batch_size, retries, pause, tasks, store.rstrip("/"), per_file)
    keyed = df.withColumn("_key", F.sha2(F.col(prompt_col), 256))
    prompts = keyed.select("_key", F.col(prompt_col).alias("_prompt")).filter("_key IS NOT NULL")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                replies, status = _call(call, part["_prompt"].tolist(), options, retries, pause)
                yield pd.DataFrame({"_asked": part["_key"].tolist(), RESULT: replies, STATUS: status})

    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("_asked", RESULT, STATUS)])
    answered = prompts.distinct().repartition(tasks, "_key").mapInPandas(ask, schema)
    return keyed.join(answered, F.col("_key") == F.col("_asked"), "left").drop("_key", "_asked")


def _from_store(df, client, options, prompt_col, batch_size, retries, pause, tasks, store, per_file) -> DataFrame:
    spark, run = df.sparkSession, uuid.uuid4().hex[:12]
    key = F.sha2(F.concat(F.lit(f"{json.dumps(vars(options), sort_keys=True)}\n"), F.col(prompt_col)), 256)
    keyed = df.withColumn("_key", key)
    prompts = keyed.select("_key", F.col(prompt_col).alias("_prompt")).filter("_key IS NOT NULL").distinct()
    missing = prompts.join(kept.stored(spark, store), "_key", "left_anti").repartition(tasks, "_key")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()
        part = f"{store}/run={run}/part={TaskContext.get().partitionId()}"
        yield from kept.asked_once(batches, part, lambda p: _call(call, p, options, retries, pause), batch_size, per_file)

    failures = materialise(missing.mapInPandas(ask, "_key string, _status string"), "failed_calls")
    kept.finish(spark, store, run)
    answers = kept.stored(spark, store).select(F.col("_key").alias("_asked"), F.col("_reply").alias(RESULT), F.lit("").alias(STATUS))
    failed = failures.select(F.col("_key").alias("_asked"), F.lit(None).cast("string").alias(RESULT), F.col("_status").alias(STATUS))
    return keyed.join(answers.unionByName(failed), F.col("_key") == F.col("_asked"), "left").drop("_key", "_asked")


def _call(call: Client, prompts: list[str], options: ModelOptions, retries: int, pause: float):
    """Replies and statuses for one batch, with a bounded number of tries.

    A batch that keeps failing is halved, down to single prompts, so that a refused prompt
    costs the others no reply. Only the whole batch and single prompts are tried again.
    """
    return _tried(call, prompts, options, retries, pause) or _halved(call, prompts, options, retries, pause)


def _tried(call: Client, prompts: list[str], options: ModelOptions, retries: int, pause: float):
    """Replies and statuses, or None for several prompts that fail together."""
    for attempt in range(retries + 1):
        try:
            replies = list(call(prompts, options))
            if len(replies) != len(prompts):
                raise ValueError("the client returned another number of replies")
            return replies, ["" if r is not None else "no reply" for r in replies]
        except Exception as error:
            if attempt == retries:
                return ([None], [f"{type(error).__name__}: {error}"]) if len(prompts) == 1 else None
            time.sleep(pause * 2**attempt)


def _halved(call: Client, prompts: list[str], options: ModelOptions, retries: int, pause: float):
    middle, replies, status = len(prompts) // 2, [], []
    for half in (prompts[:middle], prompts[middle:]):
        tries = retries if len(half) == 1 else 0
        found = _tried(call, half, options, tries, pause) or _halved(call, half, options, retries, pause)
        replies += found[0]
        status += found[1]
    return replies, status


# --- an offline client for tests: a pure function of the prompt's text ---


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:7], 16)


def _reply(key: str, value: str, style: int) -> str:
    """A JSON object: bare, fenced on one line, or fenced and spread over lines."""
    member = f"{json.dumps(key)}: {json.dumps(value, ensure_ascii=False)}"
    return (f"{{{member}}}", f"```json {{{member}}} ```", f"```json\n{{\n{member}\n}}\n```")[style]


def offline_translator(instruction: str = TRANSLATE_PROMPT) -> ClientFactory:
    """Replies with the text itself behind a marker, in one of three fence styles."""

    def build() -> Client:
        def call(prompts: Sequence[str], options: ModelOptions) -> list[str]:
            texts = [p.removeprefix(instruction) for p in prompts]
            return [_reply("translation", f"[en] {t}", _digest(t) % 3) for t in texts]

        return call

    return build


def offline_categoriser(labels: Sequence[str] = CATEGORY_LABELS, instruction: str | None = None) -> ClientFactory:
    """Replies with a category that depends on the text's digest only."""
    head = category_prompt(labels) if instruction is None else instruction

    def build() -> Client:
        def call(prompts: Sequence[str], options: ModelOptions) -> list[str]:
            digests = [_digest(p.removeprefix(head)) for p in prompts]
            return [_reply("Comment Category", labels[d % len(labels)], d % 3) for d in digests]

        return call

    return build


def offline_classifier(labels: Sequence[str] = CATEGORY_LABELS) -> ClientFactory:
    """Replies with fields that depend on the text's digest only; some replies can't be used."""
    head = classify_prompt(labels)

    def reply(text: str) -> str:
        d = _digest(text)
        if d % 11 == 0:
            return "I can't say."
        fields = {
            "category": "something else" if d % 13 == 0 else labels[d % len(labels)],
            "confidence": 1.5 if d % 17 == 0 else d % 1000 / 1000,
            "severity": None if d % 19 == 0 else d % 100 / 100,
            "translation": f"[en] {text}",
        }
        body = json.dumps(fields, ensure_ascii=False)
        return (body, f"```json {body} ```", f"```json\n{body}\n```")[d % 3]

    def build() -> Client:
        return lambda prompts, options: [reply(p.removeprefix(head)) for p in prompts]

    return build


def fused_comment(df: DataFrame, parts: Sequence[str], keep: Sequence[str | Column], trim: bool = False) -> DataFrame:
    """Fuse the comment parts and keep rows that have a comment."""
    from surveyloom.functions.text import has_text

    fused = df.select(*keep, fuse_text(*[F.col(p) for p in parts]).alias("comment"))
    return fused.filter(has_text(F.col("comment"), trim))
