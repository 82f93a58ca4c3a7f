"""Annotators: three prompts per text in, three checked records out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions.annotations import TASKS, annotation, build_prompt
from foliosift.operators.joins import attach_annotations
from foliosift.session import materialise

_ANSWERS = "_answers"


def with_prompts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``<task>_prompt`` columns."""
    return df.withColumns(
        {f"{name}_prompt": build_prompt(F.col(text_col), task) for name, task in TASKS.items()}
    )


@dataclass(frozen=True)
class TableAnnotator:
    """Recorded answers: rows of ``(keys…, task, response)``."""

    responses: DataFrame
    keys: Sequence[str] = ("doc_id",)

    def annotate(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        return attach_annotations(df, self.responses, self.keys)


@dataclass(frozen=True)
class CallableAnnotator:
    """A client built once per task by ``make_client``.

    The client is called as ``client(prompt, schema, **options)`` and returns JSON text or
    None. A call is tried ``attempts`` times; after that, or for an empty answer, the
    field holds the placeholder and the run goes on. Before the second try it waits ``pause``
    seconds, doubled for every further one. Only the prompts travel to Python, in Arrow
    batches; parallelism is the number of partitions.
    """

    make_client: Callable
    attempts: int = 1
    pause: float = 0.0
    options: dict = field(default_factory=lambda: dict(values.SAMPLING_DEFAULTS))

    def __post_init__(self):
        if not callable(self.make_client) or self.attempts < 1:
            raise ValueError("CallableAnnotator needs a make_client function and attempts >= 1")

    def asker(self) -> Callable:
        """``ask(client, prompt, schema)``: the answer, or None once all attempts have failed."""
        attempts, options, pause = self.attempts, dict(self.options), self.pause

        def ask(client, prompt, schema):
            for attempt in range(attempts):
                if attempt and pause:
                    time.sleep(pause * 2 ** (attempt - 1))
                try:
                    answer = client(prompt, schema, **options)
                except Exception:  # a failed call must not end the run
                    continue
                if answer:
                    return answer
            return None

        return ask

    def annotate(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        make_client, ask = self.make_client, self.asker()
        schemas = {name: task.json_schema() for name, task in TASKS.items()}

        @F.pandas_udf(", ".join(f"`{name}` string" for name in TASKS))
        def answers(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            client = make_client()
            for prompts in batches:
                yield pd.DataFrame(
                    {
                        name: [ask(client, prompt, schema) for prompt in column]
                        for (name, schema), column in zip(schemas.items(), prompts)
                    }
                )

        prompts = [build_prompt(F.col(text_col), task) for task in TASKS.values()]
        # Calls may cost money and answer anew: never run twice for a row by the optimiser.
        answered = df.select("*", answers.asNondeterministic()(*prompts).alias(_ANSWERS))
        records = [annotation(F.col(_ANSWERS)[name], task).alias(task.output) for name, task in TASKS.items()]
        return answered.select(*df.columns, *records)


_STORE = "digest string, task string, response string"
_JOBS = 16
_COMMIT = "mapreduce.fileoutputcommitter.algorithm.version"


@dataclass(frozen=True)
class StoredAnnotator:
    """A :class:`CallableAnnotator` that keeps every answer below ``store`` and asks only for what
    is missing there, so a run that ended half way, or a second one, goes on where it stopped.

    Prompts are known by their digest: equal prompts are asked once. What is missing is asked in
    waves of about ``wave`` prompts, dealt by digest. A wave is one task, and its answers are
    appended as it ends; a job asks a sixteenth of the waves, one at least. So a lost run loses the
    waves that were under way, one per core, and the number of jobs does not grow with the
    prompts. In a task up to ``concurrency`` calls run at a time. Calls without an answer
    give the placeholder and are not stored: the next run asks again.
    """

    client: CallableAnnotator
    store: str
    wave: int = 10_000
    concurrency: int = 8

    def __post_init__(self):
        if self.wave < 1 or self.concurrency < 1:
            raise ValueError("wave and concurrency must be positive")

    def _answers(self, spark) -> DataFrame:
        """One answer per digest; an empty store gives none."""
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(self.store)
        if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            return spark.createDataFrame([], _STORE)
        stored = spark.read.schema(_STORE).parquet(self.store)
        return stored.groupBy("digest").agg(F.min("response").alias("response"))

    def _ask(self, missing: DataFrame) -> DataFrame:
        make_client, ask, concurrency = self.client.make_client, self.client.asker(), self.concurrency
        schemas = {name: task.json_schema() for name, task in TASKS.items()}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            client = make_client()
            with ThreadPoolExecutor(concurrency) as pool:
                for batch in batches:
                    batch["response"] = list(pool.map(lambda row: ask(client, row[1], schemas[row[0]]), zip(batch["task"], batch["prompt"])))
                    yield batch[["digest", "task", "response"]]

        return missing.mapInPandas(run, _STORE).where(F.col("response").isNotNull())

    def annotate(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        spark = df.sparkSession
        prompts = {name: build_prompt(F.col(text_col), task) for name, task in TASKS.items()}
        digest = {name: F.sha2(F.concat(F.lit(name + ":"), prompt), 256) for name, prompt in prompts.items()}
        wanted = [F.struct(digest[n].alias("digest"), F.lit(n).alias("task"), prompts[n].alias("prompt")) for n in TASKS]
        asked = df.select(F.inline(F.array(*wanted))).where(F.col("prompt").isNotNull()).dropDuplicates(["digest"])
        missing = asked.join(self._answers(spark).select("digest"), "digest", "left_anti")
        job = F.pmod(F.xxhash64("digest"), F.lit(_JOBS)).cast("int")
        missing = materialise(missing.withColumn("_job", job), "prompts", "_job")
        waves = -(-missing.count() // self.wave)
        jobs = min(waves, _JOBS)
        for k in range(jobs):
            # The first ``waves % jobs`` jobs have one wave more; each reads its own folders only.
            own = missing.where(F.pmod(F.col("_job"), F.lit(jobs)) == k).drop("_job")
            tasks = waves // jobs + (k < waves % jobs)
            # With this version a task's answers are in the store as soon as it ends.
            self._ask(own.repartition(tasks, "digest")).write.mode("append").option(_COMMIT, "2").parquet(self.store)
        answers = self._answers(spark)
        found = df.select("*", *[digest[n].alias(f"_{n}_digest") for n in TASKS])
        for n in TASKS:
            own = answers.select(F.col("digest").alias(f"_{n}_digest"), F.col("response").alias(f"_{n}_answer"))
            found = found.join(own, f"_{n}_digest", "left")
        records = [annotation(F.col(f"_{name}_answer"), task).alias(task.output) for name, task in TASKS.items()]
        return found.select(*df.columns, *records)


def assemble_result(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The six fields of the final record."""
    return df.select(
        F.col(text_col).alias("text"),
        "is_educational",
        "score",
        *[task.output for task in TASKS.values()],
    )
