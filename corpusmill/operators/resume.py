"""Batch generation that goes on where it stopped.

A model run is the dearest part of a job, and one failed task ends a Spark job. Here
the prompts are written once, in input order, as files of ``rows_per_task`` rows, and
read from there as a stream: each micro-batch takes ``tasks_per_commit`` files and
commits their predictions. The stream's checkpoint is the ledger of what is done, and
the file sink shows only what was committed. Called again after a failure, with the
same ``work`` folder, only prompts without a committed prediction are generated: at most
one micro-batch is repeated, and no prompt has two predictions.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.generate import GenerationConfig, first_words_generator, generate
from corpusmill.sources.json_corpus import order_cols

ROWS_PER_TASK = 2048


def _begun(df: DataFrame, path: str) -> str | None:
    """What was noted when the prompts had been written, if they have."""
    try:
        noted = df.sparkSession.read.schema("said string").json(path).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return noted and noted["said"]


def generate_resumable(
    df: DataFrame,
    work: str,
    factory: Callable[[GenerationConfig], Callable[[list[str]], list[str]]] = first_words_generator,
    config: GenerationConfig | dict | str | None = None,
    prompt_type: str = "chatml",
    rows_per_task: int = ROWS_PER_TASK,
    tasks_per_commit: int | None = None,
    **how,
) -> DataFrame:
    """``generate``'s rows, read back from what was committed under ``work`` (a folder
    that all executors reach and that this generation alone uses).

    Returns when every prompt has its prediction. If the generator fails, the exception
    is raised and what was committed stays; call it again to go on. The prompts are those
    of the first call: later ones read them from ``work``, and raise if the generation
    settings, the columns or the prompt type are others. ``tasks_per_commit`` is the
    number of model tasks of a micro-batch (as many as shuffle partitions if not given);
    ``how`` goes to ``generate``."""
    spark = df.sparkSession
    cfg = config if isinstance(config, GenerationConfig) else GenerationConfig.parse(config)
    work = work.rstrip("/")
    prompts, state = f"{work}/prompts", f"{work}/state"
    said = json.dumps({"config": cfg.to_dict(), "prompt_type": prompt_type, "columns": df.schema.simpleString()}, sort_keys=True)
    noted = _begun(df, state)
    if noted is None:
        tasks = max(1, -(-df.count() // rows_per_task))
        oc = order_cols(df)
        placed = df.repartitionByRange(tasks, *oc).sortWithinPartitions(*oc) if oc else df.repartition(tasks)
        placed.write.mode("overwrite").parquet(prompts)
        spark.createDataFrame([(said,)], "said string").coalesce(1).write.mode("overwrite").json(state)
    elif noted != said:
        raise ValueError(f"{work} holds a generation with other settings or prompts: {noted}")
    files = tasks_per_commit or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(prompts)
    # a file's rows are few: dealt out, or Spark would pack the files into one task
    predicted = generate(stream.repartition(files), factory, cfg, prompt_type, **how)
    done = f"{work}/predictions"
    query = (
        predicted.writeStream.format("parquet")
        .option("path", done)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(predicted.schema).parquet(done)


def in_tasks(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Predicted rows in stretches of the input, so that files in name order are its order."""
    oc = order_cols(df)
    tasks = max(1, -(-df.count() // rows_per_task))
    return df.repartitionByRange(tasks, *[F.col(c) for c in oc]) if oc else df.repartition(tasks)
