"""Expressions over a probability array aligned with a class list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def class_array(classes: Sequence | Column) -> Column:
    return classes if isinstance(classes, Column) else F.array(*[F.lit(c) for c in classes])


def predicted_label(probs: Column | str, classes: Sequence | Column) -> Column:
    """Class with the highest probability; the first one among equals."""
    p = _as_column(probs)
    return F.try_element_at(class_array(classes), F.array_position(p, F.array_max(p)).cast("int"))


def predicted_label_set(probs: Column | str, classes: Sequence | Column, threshold: float = 0.5) -> Column:
    """Classes whose probability reaches the threshold, in class order."""
    p = _as_column(probs)
    pairs = F.arrays_zip(p.alias("p"), class_array(classes).alias("c"))
    return F.transform(F.filter(pairs, lambda x: x["p"] >= threshold), lambda x: x["c"])


def p_of_label(probs: Column | str, classes: Sequence | Column, label: Column | str) -> Column:
    """Probability given to ``label``; null for a label outside the class list."""
    place = F.array_position(class_array(classes), _as_column(label)).cast("int")
    return F.when(place > 0, F.try_element_at(_as_column(probs), place))


def ranked_classes(probs: Column | str, classes: Sequence | Column, k: int) -> Column:
    """The k best classes as structs ``(p, label)``, best first, ties in class order."""
    p = _as_column(probs)
    places = F.sequence(F.lit(1), F.size(p))
    keyed = F.zip_with(p, places, lambda v, i: F.struct((-v).alias("low"), i.alias("place"), v.alias("p")))
    best = F.slice(F.array_sort(keyed), 1, k)
    listed = class_array(classes)
    return F.transform(
        best, lambda b: F.struct(b["p"].alias("p"), F.element_at(listed, b["place"]).alias("label"))
    )


def top_labels(probs: Column | str, classes: Sequence | Column, k: int) -> Column:
    return F.transform(ranked_classes(probs, classes, k), lambda b: b["label"])


def top_probs(probs: Column | str, classes: Sequence | Column, k: int) -> Column:
    return F.transform(ranked_classes(probs, classes, k), lambda b: b["p"])


def normalized_entropy(probs: Column | str) -> Column:
    """Entropy of the probabilities over its maximum: 0 for certainty, 1 for a uniform spread."""
    p = _as_column(probs)
    total = F.aggregate(
        p, F.lit(0.0), lambda acc, v: acc + F.when(v > 0, -v * F.log(v)).otherwise(F.lit(0.0))
    )
    return F.when(F.size(p) > 1, total / F.log(F.size(p).cast("double"))).otherwise(F.lit(0.0))
