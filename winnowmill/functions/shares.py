"""Expressions over class shares: arrays of ``(p, label)`` in class order that hold only the classes seen.

They agree with the expressions over full probability arrays; classes that are not in the array have
probability 0. An array is as long as its row needs, however many classes there are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def share_of_label(shares: Column | str, label: Column | str) -> Column:
    """Share of ``label``, 0 for a class not seen; null without shares or label."""
    entries, own = _as_column(shares), _as_column(label)
    found = F.try_element_at(F.filter(entries, lambda e: e["label"] == own), F.lit(1))["p"]
    return F.when(entries.isNotNull() & own.isNotNull(), F.coalesce(found, F.lit(0.0)))


def ranked_shares(shares: Column | str, unseen: Column, k: int) -> Column:
    """The k best classes as ``(p, label)``, best first, ties in class order.

    ``unseen`` are the first classes of all, at least ``k`` more than any row has; of these come those that a
    row has not, with probability 0.
    """
    entries = F.filter(_as_column(shares), lambda e: e["p"] > 0)
    keyed = F.array_sort(F.transform(entries, lambda e: F.struct((-e["p"]).alias("low"), e["label"].alias("label"))))
    seen = F.transform(keyed, lambda e: F.struct((-e["low"]).alias("p"), e["label"].alias("label")))
    labels = F.transform(entries, lambda e: e["label"])
    rest = F.filter(unseen, lambda c: ~F.array_contains(labels, c))
    return F.slice(F.concat(seen, F.transform(rest, lambda c: F.struct(F.lit(0.0).alias("p"), c.alias("label")))), 1, k)


def shares_entropy(shares: Column | str, classes: Column) -> Column:
    """Entropy over its maximum for ``classes`` classes: 0 for certainty, 1 for a uniform spread."""
    total = F.aggregate(
        _as_column(shares), F.lit(0.0), lambda acc, e: acc + F.when(e["p"] > 0, -e["p"] * F.log(e["p"])).otherwise(F.lit(0.0))
    )
    return F.when(classes > 1, total / F.log(classes.cast("double"))).otherwise(F.when(total.isNotNull(), F.lit(0.0)))
