"""Batch prediction: a label and one probability column per class."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.probabilities import class_array, predicted_label, predicted_label_set
from .scoring import slices

Predictor = Callable[[pd.Series], pd.Series]


def with_predictions(
    df: DataFrame,
    probs: str,
    classes: Sequence,
    multi_label: bool = False,
    threshold: float = 0.5,
    prob_columns: bool = True,
) -> DataFrame:
    """Predicted label (a list if ``multi_label``) and class columns from a probability array."""
    label = (
        predicted_label_set(probs, classes, threshold) if multi_label else predicted_label(probs, classes)
    )
    columns = [F.col(probs)[i].alias(str(c)) for i, c in enumerate(classes)] if prob_columns else []
    return df.select(
        *[c for c in df.columns if c != probs], label.alias("predicted_label"), *columns
    )


def predict_batch(
    df: DataFrame,
    model: Model | Predictor,
    classes: Sequence,
    input_col: str | None = None,
    id_col: str | None = None,
    multi_label: bool = False,
    threshold: float = 0.5,
    prob_columns: bool = True,
) -> DataFrame:
    """Predict with a fitted Spark ML model, or with a callable over batches of ``input_col``.

    A callable takes a pandas Series and returns a Series of probability lists in the order of
    ``classes``. The id column is kept.
    """
    if isinstance(model, Model):
        scored = model.transform(df).withColumn("__probs", vector_to_array("probability"))
    else:

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                # A batch of long texts becomes rows of Python part by part.
                for (values,) in slices([batch]):
                    found = model(values.to_pandas()).map(lambda p: [float(x) for x in p])
                    yield pa.array(found, pa.list_(pa.float64()), from_pandas=True)

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        call = F.arrow_udf(run, returnType="array<double>")
        scored = df.withColumn("__probs", call(F.col(input_col)))
    kept = [id_col] if id_col else df.columns
    return with_predictions(
        scored.select(*kept, "__probs"), "__probs", classes, multi_label, threshold, prob_columns
    )
