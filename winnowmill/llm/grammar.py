"""Min-plus matrices of repair steps over a Re-Pair grammar of role and fault symbols."""

from __future__ import annotations

import heapq
from collections import defaultdict

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a. From each, the role that may follow.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES, ACCEPTED = range(4), (START, AFTER_A)
NEXT_ROLE = ("u", "u", "a", "u")
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}

#: Symbols of rows. Rows that must go are all alike; of the others, the role's initial and whether truncated.
GONE = 0
KEPT = [(role, truncated) for role in "sua?" for truncated in (False, True)]
TERMINALS = 1 + len(KEPT)


def symbol(initial: str, fault: str) -> int:
    if fault in ("blank", "duplicate"):
        return GONE
    return 1 + KEPT.index((initial if initial in ("s", "u", "a") else "?", fault == "truncated"))


class Rope:
    """A string as a tree whose parts are shared; equal trees are found out by identity."""

    __slots__ = ("left", "right", "length")

    def __init__(self, left, right) -> None:
        self.left, self.right, self.length = left, right, len(left) + len(right)

    def __len__(self) -> int:
        return self.length


def joined(x, y):
    """``x`` then ``y``; short ones are kept as plain strings."""
    if not len(x) or not len(y):
        return x if len(x) else y
    return x + y if len(x) + len(y) <= 32 and isinstance(x, str) and isinstance(y, str) else Rope(x, y)


def leaves(rope):
    """The plain strings of a rope, from left to right."""
    open_ = [rope]
    while open_:
        part = open_.pop()
        if isinstance(part, str):
            yield part
        else:
            open_ += [part.right, part.left]


def before(x, y) -> bool:
    """Whether ``x`` sorts before ``y``. Subtrees that both share are stepped over, no whole string is made."""
    left, right = [x], [y]
    while left and right:
        if left[-1] is right[-1]:
            left.pop(), right.pop()
            continue
        a, b = left.pop(), right.pop()
        if isinstance(a, str) and isinstance(b, str):
            size = min(len(a), len(b))
            if a[:size] != b[:size]:
                return a < b
            if len(a) > size:
                left.append(a[size:])
            if len(b) > size:
                right.append(b[size:])
            continue
        # Open the longer of the two, so that equal halves come to stand side by side.
        if isinstance(b, str) or (not isinstance(a, str) and len(a) >= len(b)):
            left += [a.right, a.left]
            right.append(b)
        else:
            left.append(a)
            right += [b.right, b.left]
    return bool(right)


def better(x, y):
    """The cheaper of two ``(cost, audit)``, or the one that sorts first; None is no way at all."""
    if x is None or y is None:
        return x or y
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return y if before(y[1], x[1]) else x


def times(one, two):
    """Product of matrices (rows of ``one`` may be a single vector) over (better, then)."""
    out = []
    for row in one:
        found = [None] * len(STATES)
        for middle, first in enumerate(row):
            if first is not None:
                for end, second in enumerate(two[middle]):
                    if second is not None and (found[end] is None or first[0] + second[0] <= found[end][0]):
                        found[end] = better(found[end], (first[0] + second[0], joined(first[1], second[1])))
        out.append(found)
    return out


def inserts():
    """Ways from state to state by inserting rows only; more than two rows come back to a state reached before."""
    out = []
    for start in STATES:
        row, state = [None] * len(STATES), start
        row[start] = (0, "")
        for count in (1, 2):
            state = STEP[state, NEXT_ROLE[state]]
            row[state] = better(row[state], (count * COST[INSERT], INSERT * count))
        out.append(row)
    return out


def terminal(which: int):
    """Ways past one row, rows inserted before it included."""
    own = [[None] * len(STATES) for _ in STATES]
    for state in STATES:
        own[state][state] = (COST[DELETE], DELETE)
        if which != GONE:
            role, truncated = KEPT[which - 1]
            extra = TRUNCATED_COST * truncated
            for edit, as_role in ((KEEP, role), (REROLE, NEXT_ROLE[state])):
                end = STEP.get((state, as_role))
                if end is not None:
                    own[state][end] = better(own[state][end], (COST[edit] + extra, edit))
    return times(inserts(), own)


def re_pair(sequences: list[bytes]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules ``(left, right)``, of the symbols TERMINALS, TERMINALS + 1, ..., and the sequences written in them.

    The pair that occurs most often is replaced by a new symbol, until none occurs twice.
    """
    flat, after, back = [], [], []
    for sequence in sequences:
        flat.append(-1)  # no pair reaches over the start of a sequence
        flat += sequence
    flat.append(-1)
    after, back = list(range(1, len(flat) + 1)), list(range(-1, len(flat) - 1))
    places = defaultdict(set)
    for i in range(len(flat) - 1):
        if flat[i] >= 0 and flat[i + 1] >= 0:
            places[flat[i], flat[i + 1]].add(i)
    heap = [(-len(p), pair) for pair, p in places.items() if len(p) > 1]
    heapq.heapify(heap)
    rules = []
    while heap:
        count, pair = heapq.heappop(heap)
        here = places.get(pair, ())
        if len(here) != -count:
            if len(here) > 1:
                heapq.heappush(heap, (-len(here), pair))
            continue
        new, replaced, touched = TERMINALS + len(rules), 0, set()
        for i in sorted(here):
            if i not in places[pair]:
                continue  # overlaps the one before
            j = after[i]
            k, h = after[j], back[i]
            if flat[h] >= 0:
                places[flat[h], flat[i]].discard(h)
            if flat[k] >= 0:
                places[flat[j], flat[k]].discard(j)
            places[pair].discard(i)
            flat[i], flat[j], after[i], back[k] = new, -2, k, i
            if flat[h] >= 0:
                places[flat[h], new].add(h)
                touched.add((flat[h], new))
            if flat[k] >= 0:
                places[new, flat[k]].add(i)
                touched.add((new, flat[k]))
            replaced += 1
        rules.append(pair)
        del places[pair]
        for other in touched:
            if len(places.get(other, ())) > 1:
                heapq.heappush(heap, (-len(places[other]), other))
    out, i = [], 0
    while i < len(flat) - 1:
        if flat[i] == -1:
            out.append([])
        else:
            out[-1].append(flat[i])
        i = after[i]
    return rules, out


def cheapest(sequences: list[bytes]) -> list[tuple[int, str]]:
    """Cost and audit of the cheapest repair of each sequence of symbols; of several, the audit that sorts first.

    Among ways past the same rows at the same cost no audit begins another, as the longer one would have
    inserted more and cost more. So the order holds under joining, and the best of the parts is in the whole.
    """
    rules, short = re_pair(sequences)
    matrices = [terminal(which) for which in range(TERMINALS)]
    for left, right in rules:
        matrices.append(times(matrices[left], matrices[right]))
    out, last = [], inserts()
    for sequence in short:
        vector = [[(0, ""), None, None, None]]
        for which in sequence:
            vector = times(vector, matrices[which])
        ends = times(vector, last)[0]
        best = None
        for state in ACCEPTED:
            best = better(best, ends[state])
        out.append((best[0], "".join(leaves(best[1]))))
    return out
