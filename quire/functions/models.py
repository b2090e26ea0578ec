"""Plug a user model into any re-aimed operator.

The reference calls hosted models (OCR, classifier, NER, embeddings, LLM). A user with a local model passes a
batch function; Spark ships it to the executors and feeds it Arrow batches (``mapInPandas``), so the model is
loaded once per task, never per row. Output must follow the library's column contracts (``schemas``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def with_model(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], out_schema: StructType | str,
               load: Callable[[], object] | None = None) -> DataFrame:
    """Apply ``fn(batch)`` (or ``fn(model, batch)`` when ``load`` is given) to every Arrow batch of ``df``.

    ``load`` runs once per task on the executor (lazy import of heavy libraries stays on the executor).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load() if load is not None else None
        for b in batches:
            yield fn(model, b) if load is not None else fn(b)

    return df.mapInPandas(run, schema=out_schema)
