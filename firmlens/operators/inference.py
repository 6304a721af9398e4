"""The seam to models: prompts in columns, answers from a cache table, only misses to a provider."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.text import fenced_json
from firmlens.operators.pressure import OVERLOAD, Pressure
from firmlens.operators.pressure import call as call_provider
from firmlens.shared import find_package

CALLS = "task string, prompt_sha256 string, prompt string, response_text string, status string, tokens long"


class Provider(Protocol):
    """Answers one prompt: (text, tokens). It is made once a task, so it may hold a connection."""

    def __call__(self, prompt: str) -> tuple[str, int]: ...


def fill(template: str, values: dict[str, Column]) -> Column:
    """A prompt: {name} replaced by the column, N/A where it is null."""
    out = F.lit(template)
    for name, c in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("N/A")))
    return out


def ask(prompts: DataFrame, cache: DataFrame, task: str, make: Callable[[], Provider], *, workers: int | None = None, ceiling: int = 0, pressure: Pressure | None = None, tries: int = 1) -> DataFrame:
    """Calls (CALLS) for prompts(prompt): each distinct prompt once, cached answers first, the provider for the rest.

    A failing prompt gives status error and its text; it doesn't fail the task. workers: how many tasks call at a time, up to
    ceiling (0: none). With pressure, tasks share what they know of an overloaded provider and leave it alone while it
    cools down; an overloaded call is tried `tries` times.
    """
    find_package(prompts.sparkSession)
    p = prompts.select("prompt").where(F.col("prompt").isNotNull()).distinct().withColumn("prompt_sha256", F.sha2(F.concat_ws("\n", F.lit(task), "prompt"), 256))
    hits = p.join(cache.where(F.col("task") == task).select("prompt_sha256", "response_text", "status", "tokens"), "prompt_sha256")
    misses = p.join(cache.where(F.col("task") == task).select("prompt_sha256").distinct(), "prompt_sha256", "left_anti")
    if workers:
        misses = misses.repartition(callers(workers, ceiling))

    def call(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        provider = make()
        for frame in frames:
            rows = []
            for prompt, digest in zip(frame.column("prompt").to_pylist(), frame.column("prompt_sha256").to_pylist(), strict=True):
                try:
                    text, tokens = call_provider(provider, prompt, pressure, tries)
                    rows.append((task, digest, prompt, text, "ok", tokens))
                except Exception as e:  # a provider may fail in any way; the row says how
                    rows.append((task, digest, prompt, str(e)[:500], "error", 0))
            kinds = pa.schema([("task", pa.string()), ("prompt_sha256", pa.string()), ("prompt", pa.string()), ("response_text", pa.string()), ("status", pa.string()), ("tokens", pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], f.type) for f in kinds], schema=kinds)

    new = misses.select("prompt", "prompt_sha256").mapInArrow(call, CALLS)
    old = hits.select(F.lit(task).alias("task"), "prompt_sha256", "prompt", "response_text", "status", "tokens")
    return old.unionByName(new)


def answers(calls: DataFrame, schema: str) -> DataFrame:
    """calls with the parsed answer; a single object where a list is due counts as a list of one."""
    text = fenced_json(F.col("response_text"))
    if schema.lower().startswith("array<"):
        one = F.from_json(text, schema[6:-1])
        return calls.withColumn("answer", F.when(text.rlike(r"^\s*\["), F.from_json(text, schema)).when(one.isNotNull(), F.array(one)))
    return calls.withColumn("answer", F.from_json(text, schema))


def rule_provider() -> Provider:
    """A provider without a model, for tests and dry runs: it counts words and looks for a few of them."""

    def answer(prompt: str) -> tuple[str, int]:
        words = prompt.split()
        yes = "Yes" if len(words) % 2 == 0 else "No"
        return f'Sure.\n```json\n{{"is_b2b": "{yes}", "words": {len(words)}}}\n```', len(words)

    return answer


def callers(wanted: int, ceiling: int) -> int:
    """How many tasks may call a provider at a time."""
    return max(1, min(wanted, ceiling)) if ceiling > 0 else max(1, wanted)


def is_overload(message: Column) -> Column:
    """Whether an error says that the provider is overloaded."""
    return F.lower(message).rlike(OVERLOAD)
