"""Training records from units and texts: instruction, pair, corpus and fill-in-the-middle records, generation hooks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltloom.common import map_rows
from siltloom.functions import code
from siltloom.functions.text import fim_normal


def sft_records(pairs: DataFrame, instruction: str) -> DataFrame:
    """(instruction, input, output) of folders that have code and text; rows with an empty part go."""
    out = pairs.select(F.lit(instruction).alias("instruction"), F.concat_ws("\n", "prompt", "ets").alias("input"), F.col("txt").alias("output"))
    return out.where("instruction <> '' and input <> ''")


def corpus_text(df: DataFrame, *columns: str, to: str = "content") -> DataFrame:
    """The columns one behind the other, nulls as nothing."""
    return df.withColumn(to, F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def generate(df: DataFrame, prompt: Column, client: Callable[[list[str]], list[str | None]], key: str, batch: int = 16, keep_null: bool = False) -> DataFrame:
    """(key, output) of an injected text generator, called on batches inside the tasks; it does its own retries.

    A null output means failure: dropped, or kept with ``keep_null``.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []

        def flush() -> Iterator[tuple]:
            for (k, _), out in zip(held, client([p for _, p in held])):
                if out is not None or keep_null:
                    yield k, out
            held.clear()

        for row in rows:
            held.append(row)
            if len(held) >= batch:
                yield from flush()
        yield from flush()

    return map_rows(df.select(F.col(key).cast("string"), prompt), run, "key string, output string")


def with_retries(call: Callable[[str, str], str], keys: list[str], attempts: int = 3, wait: Callable[[float], None] | None = None) -> Callable[[list[str]], list[str | None]]:
    """A client that turns through the keys and tries each prompt up to ``attempts`` times, waiting longer each time."""
    import time

    pause = wait or time.sleep
    turn = [0]

    def client(prompts: list[str]) -> list[str | None]:
        out: list[str | None] = []
        for p in prompts:
            answer = None
            for n in range(attempts):
                key = keys[turn[0] % len(keys)]
                turn[0] += 1
                try:
                    answer = call(p, key)
                    break
                except Exception:  # noqa: BLE001 - any failure of the service is tried again
                    if n + 1 < attempts:
                        pause(min(10.0, 4.0 * 2**n))
            out.append(answer)
        return out

    return client


def embed(df: DataFrame, key: str, text: str, client: Callable[[list[str]], list[list[float]]], batch: int = 64) -> DataFrame:
    """(key, embedding) of an injected embedding client, by batches."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        for row in rows:
            held.append(row)
            if len(held) >= batch:
                yield from zip([k for k, _ in held], client([t or "" for _, t in held]))
                held.clear()
        if held:
            yield from zip([k for k, _ in held], client([t or "" for _, t in held]))

    return map_rows(df.select(key, text), run, f"{key} {dict(df.dtypes)[key]}, embedding array<float>")


def fim_split(units: DataFrame, key: str = "unit_id", text: str = "content", seed: int = 0) -> DataFrame:
    """(key, five parts, function_type) of units with a build() or an arrow function; the same seed gives the same split."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, body in rows:
            r = code.fim_random(body, str(k), seed) if body else None
            if r:
                yield k, r["above"], r["start"], r["target"], r["end"], r["follow"], r["function_type"]

    return map_rows(units.select(key, text), run, f"{key} {dict(units.dtypes)[key]}, above_context_without_fim_start string, fim_task_sector_start string, fim_target string, fim_task_sector_end string, follow_context_without_fim_end string, function_type string")


def fim_check(records: DataFrame, original: str = "original_code") -> DataFrame:
    """Adds ``whole``: whether the five parts give the original, blanks and quotes aside; null parts count as empty."""
    parts = F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in ("above_context_without_fim_start", "fim_task_sector_start", "fim_target", "fim_task_sector_end", "follow_context_without_fim_end")])
    return records.withColumn("whole", fim_normal(parts) == fim_normal(F.col(original)))


def fim_prioritised(units: DataFrame, key: str = "unit_id", text: str = "content") -> DataFrame:
    """(key, above, target, follow, split): the first split in the order of priority; every unit gets one."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, body in rows:
            r = code.fim_prioritised(body or "")
            yield k, r["above"], r["target"], r["follow"], r["split"]

    return map_rows(units.select(key, text), run, f"{key} {dict(units.dtypes)[key]}, above string, target string, follow string, split string")


def fim_candidates(units: DataFrame, key: str = "unit_id", text: str = "content") -> DataFrame:
    """(key, pos, above, target, follow, kind): all splits of each unit."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, body in rows:
            for i, r in enumerate(code.fim_candidates(body or "")):
                yield k, i, r["above"], r["target"], r["follow"], r["kind"]

    return map_rows(units.select(key, text), run, f"{key} {dict(units.dtypes)[key]}, pos int, above string, target string, follow string, kind string")


def fim_records(splits: DataFrame, context: DataFrame, key: str = "unit_id") -> DataFrame:
    """Splits with the cross-file context of their unit, in path order."""
    gathered = context.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("path", "content"))), lambda c: c["content"]).alias("xl_context"))
    return splits.join(gathered, key, "left").withColumn("xl_context", F.coalesce("xl_context", F.array().cast("array<string>")))
