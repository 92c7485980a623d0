"""Weighted acyclic automata over words: sorted n-grams of up to three words in, their counts out."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import MIX, scrambled

FIELDS = ("labels", "first", "fan1", "final1", "second", "target", "final2", "fan2", "third", "final3")
_KINDS = dict.fromkeys(FIELDS, np.uint32) | {"labels": np.uint64} | dict.fromkeys(("final1", "final2", "final3"), np.int64)


def _starts(fan: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(fan, dtype=np.int64)])


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions ``start .. start + count - 1`` of all ranges, one after the other."""
    ends = np.cumsum(counts, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


@dataclass
class Transducer:
    """Arcs from the start by first word, from there by second word, and from shared states by third word.

    Arcs carry places in ``labels``, the sorted hashes of words. ``final`` weights are the counts of the
    n-grams that end there. ``fan`` tells how many arcs go on from a state. Second arcs lead to states
    ``target``; states with the same count and the same arcs are one.
    """

    labels: np.ndarray
    first: np.ndarray
    fan1: np.ndarray
    final1: np.ndarray
    second: np.ndarray
    target: np.ndarray
    final2: np.ndarray
    fan2: np.ndarray
    third: np.ndarray
    final3: np.ndarray

    @classmethod
    def of_sorted(cls, labels: np.ndarray, one: np.ndarray, two: np.ndarray, three: np.ndarray, weight: np.ndarray) -> Transducer:
        """From sorted rows of places in ``labels``, -1 for no word; the beginnings of an n-gram are there before it.

        Common beginnings are shared as they come; a finished state is replaced by an equal one before it.
        """
        singles, pairs, triples = two < 0, (two >= 0) & (three < 0), three >= 0
        fan1 = np.bincount(np.cumsum(singles)[pairs] - 1, minlength=int(singles.sum()))
        fan2 = np.bincount(np.cumsum(pairs)[triples] - 1, minlength=int(pairs.sum()))
        third, final3, final2 = three[triples], weight[triples], weight[pairs]
        arcs = scrambled(third.astype(np.uint64) * MIX + final3.astype(np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(arcs, dtype=np.uint64)])
        starts = _starts(fan2)
        signature = scrambled(final2.astype(np.uint64)) + sums[starts[1:]] - sums[starts[:-1]]
        _, kept, inverse = np.unique(signature, return_index=True, return_inverse=True)
        model = kept[inverse]
        # Equal signatures of unequal states: such a state stays by itself.
        differ = (final2 != final2[model]) | (fan2 != fan2[model])
        alike = np.flatnonzero(~differ & (model != np.arange(len(model))))
        own, other = _ranges(starts[alike], fan2[alike]), _ranges(starts[model[alike]], fan2[alike])
        wrong = (third[own] != third[other]) | (final3[own] != final3[other])
        differ[alike[np.repeat(np.arange(len(alike)), fan2[alike])[wrong]]] = True
        model = np.where(differ, np.arange(len(model)), model)
        kept, target = np.unique(model, return_inverse=True)
        arcs = _ranges(starts[kept], fan2[kept])
        values = (labels, one[singles], fan1, weight[singles], two[pairs], target, final2[kept], fan2[kept], third[arcs], final3[arcs])
        return cls(*[np.ascontiguousarray(v, _KINDS[f]) for f, v in zip(FIELDS, values)])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All n-grams, single words first, then pairs, then triples: places of the words (-1 for none) and count."""
        none = lambda n: np.full(n, -1, np.int64)
        one = self.first.astype(np.int64)
        start, target = np.repeat(one, self.fan1), self.target.astype(np.int64)
        fan = self.fan2[target].astype(np.int64)
        arcs, n1, n2 = _ranges(_starts(self.fan2)[target], fan), len(one), len(start)
        second = self.second.astype(np.int64)
        return (
            np.concatenate([one, start, np.repeat(start, fan)]),
            np.concatenate([none(n1), second, np.repeat(second, fan)]),
            np.concatenate([none(n1 + n2), self.third[arcs].astype(np.int64)]),
            np.concatenate([self.final1, self.final2[target], self.final3[arcs]]),
        )

    def blobs(self) -> list[bytes]:
        return [getattr(self, f).tobytes() for f in FIELDS]

    @classmethod
    def of_blobs(cls, blobs) -> Transducer:
        return cls(*[np.frombuffer(b, _KINDS[f]) for f, b in zip(FIELDS, blobs)])


def in_order(one: np.ndarray, two: np.ndarray, three: np.ndarray, labels: int) -> np.ndarray:
    """The order of rows by their places, a beginning before what goes on from it."""
    if labels < (1 << 21) - 1:
        return np.argsort((one << 42) | ((two + 1) << 21) | (three + 1), kind="stable")
    return np.lexsort((three, two, one))


def union(parts: list[Transducer], least: int = 1) -> Transducer:
    """The n-grams of all parts with the sums of their counts, of those that occur ``least`` times or more.

    A beginning occurs as often as what goes on from it or more. Only a single word whose pairs fill several
    ranges has no count in the later ones, where it stays for its pairs.
    """
    labels = np.unique(np.concatenate([p.labels for p in parts]))
    place = [np.append(np.searchsorted(labels, p.labels), -1) for p in parts]
    rows = [p.rows() for p in parts]
    one, two, three = (np.concatenate([at[r[k]] for at, r in zip(place, rows)]) for k in range(3))
    weight = np.concatenate([r[3] for r in rows])
    del rows
    order = in_order(one, two, three, len(labels))
    one, two, three, weight = one[order], two[order], three[order], weight[order]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (three[1:] != three[:-1])
    at = np.flatnonzero(new)
    weight = np.add.reduceat(weight, at) if len(at) else weight
    often = weight >= least
    often |= (two[at] < 0) & np.isin(one[at], one[at[often & (two[at] >= 0)]])
    at, weight = at[often], weight[often]
    used, inverse = np.unique(np.concatenate([one[at], two[at], three[at]]), return_inverse=True)
    base = int(np.searchsorted(used, 0))  # -1, if it is there, stays -1
    one, two, three = np.split(inverse - base, 3)
    return Transducer.of_sorted(labels[used[base:]], one, two, three, weight)


def composed(queries: tuple[np.ndarray, np.ndarray], counts: Transducer) -> np.ndarray:
    """Counts of the queried single words and pairs, as hashes (0 for no second word); 0 for what is not in ``counts``.

    Both are read along the same arcs: the first words that both have, then the second words after these.
    """
    first, second = queries
    find = lambda h: np.minimum(np.searchsorted(counts.labels, h), max(len(counts.labels) - 1, 0))
    if not len(counts.first):
        return np.zeros(len(first), np.int64)
    one, two = find(first), find(second)
    arc = np.minimum(np.searchsorted(counts.first, one), len(counts.first) - 1)
    there = (counts.labels[one] == first) & (counts.first[arc] == one)
    out = np.where(there & (second == 0), counts.final1[arc], 0)
    if len(counts.second):
        width = np.int64(len(counts.labels))
        arcs = np.repeat(counts.first, counts.fan1).astype(np.int64) * width + counts.second
        at = np.minimum(np.searchsorted(arcs, one * width + two), len(arcs) - 1)
        pair = there & (second != 0) & (counts.labels[two] == second) & (arcs[at] == one * width + two)
        out = np.where(pair, counts.final2[counts.target[at]], out)
    return out
