"""Tables, shared scratch space and Arrow mapping for the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema) -> DataFrame:
    """``mapInArrow`` whose workers find this package even where the session began elsewhere.

    Executors on other machines need the package installed, as with any library."""
    env = df.sparkSession.sparkContext.environment
    if PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH"), PACKAGE_ROOT]))
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; any other
    master raises, as its executors would not see one another's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    path = f"file://{tempfile.mkdtemp(prefix='checkpoints-')}"
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Batches hold at most so many bytes (or one row): what a task keeps in memory follows the longest row. A numpy
#: step holds some 100 bytes per byte of text, and workers keep what they once took.
BATCH_BYTES = 1 << 19


def parts(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows and about ``BATCH_BYTES`` bytes."""
    at = 0
    while at < batch.num_rows:
        part = batch.slice(at, rows)
        while part.num_rows > 1 and part.nbytes > BATCH_BYTES:
            part = part.slice(0, part.num_rows // 2)
        at += part.num_rows
        yield part


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
                rows: int = 1000, state: Callable[[], object] | None = None) -> DataFrame:
    """Apply ``fn`` to slices of Arrow batches; with ``state``, ``fn(slice, state())`` shares one state
    object per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = state() if state else None
        for batch in batches:
            for part in parts(batch, rows):
                out = fn(part, held) if state else fn(part)
                if out is not None and out.num_rows:
                    yield out

    return map_arrow(df, run, schema)


def map_counts(df: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], name: str, held: int = 1 << 20) -> DataFrame:
    """(``name``, n): how often ``fn`` gives each number, summed within the task while at most about
    ``held`` numbers are kept, and not yet over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting = [], [], 0
        for batch in batches:
            for part in parts(batch, 1000):
                key, n = np.unique(fn(part), return_counts=True)
                keys.append(key)
                counts.append(n)
                waiting += len(key)
                if waiting > 2 * held:
                    keys, counts = _summed(keys, counts)
                    waiting = len(keys[0])
                    if waiting > held:
                        yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(counts[0])], [name, "n"])
                        keys, counts, waiting = [], [], 0
        if keys:
            keys, counts = _summed(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(counts[0])], [name, "n"])

    return map_arrow(df, run, f"{name} long, n long")


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    return [key[first]], [np.add.reduceat(n, first) if len(first) else n]
