"""Choosing labelled rows for training and for holding out, and running a fitted scorer over a table."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.llm.rows import map_texts


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, held: Callable[[Column], Column], max_rows: int) -> DataFrame:
    """text and label of at most ``max_rows`` labelled rows that are not held out.

    With more rows than that, those of the smallest hashed ids are taken, the same in every run. Rows without id or
    label are left out; of repeated labels of an id the smallest counts; a null text counts as empty.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")  # max_rows small rows
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(max_rows).select("text", "label")


def fit_in_task(rows: DataFrame, fit: Callable):
    """``fit(texts, labels)`` of a bounded sample, in one task, so that the driver holds the fitted model alone."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            labels += batch.column("label").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, np.array(labels, np.int64)))], pa.binary())], names=["model"])

    # A sort by the rows' order would be lost in a shuffle; the limit above has left one partition.
    found = rows.coalesce(1).mapInArrow(train, "model binary").first()
    return pickle.loads(found.model) if found else fit([], np.array([], np.int64))


def score_rows(docs: DataFrame, model, threshold: float, keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) to the columns of ``docs``. ``model`` is sent
    to the tasks once; its size is fixed by its parameters."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = sent.value

        def run(part: pa.RecordBatch) -> list:
            scores = scorer.scores(part.column("text"))
            return [scores, (scores >= threshold).astype(np.int32)]

        return run

    return map_texts(docs, [("score", T.DoubleType()), ("predicted", T.IntegerType())], make, keep=keep)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))
