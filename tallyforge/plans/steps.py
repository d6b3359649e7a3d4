"""Run a flow of named steps: streams that append, and views that are recomputed.

A step function takes the session and a function `read(name, stream=False)`
that reads the output of an earlier step, so it has the shape of a decorated
function of a declarative flow.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from tallyforge.sources.ingest import stream_parquet
from tallyforge.streaming.runners import append_to_files, finish

STREAM, VIEW = "stream", "view"


@dataclass(frozen=True)
class Step:
    name: str
    kind: str
    build: Callable[[SparkSession, Callable[..., DataFrame]], DataFrame]


def reader(spark: SparkSession, base: str, schemas: Mapping[str, T.StructType] | None = None) -> Callable[..., DataFrame]:
    """Read a step's output: as a table, or as a stream of its new files.

    `schemas` has the columns of steps that may not have written a file yet, as there was nothing to write.
    """

    def read(name: str, stream: bool = False) -> DataFrame:
        path = f"{base}/{name}"
        schema = (schemas or {}).get(name) or spark.read.parquet(path).schema
        return stream_parquet(spark, path, schema) if stream else spark.read.schema(schema).parquet(path)

    return read


def refresh(spark: SparkSession, base: str, steps: Sequence[Step]) -> Callable[..., DataFrame]:
    """Run all steps once, in order: streams take in what is new, views are replaced.

    Returns the reader for the outputs below `base`.
    """
    schemas: dict[str, T.StructType] = {}
    read = reader(spark, base, schemas)
    for step in steps:
        df = step.build(spark, read)
        schemas[step.name] = df.schema
        if step.kind == STREAM:
            finish(append_to_files(df, f"{base}/{step.name}", f"{base}/_checkpoints/{step.name}"))
        elif step.kind == VIEW:
            df.write.mode("overwrite").parquet(f"{base}/{step.name}")
        else:
            raise ValueError(f"step {step.name} has kind {step.kind}")
    return read
