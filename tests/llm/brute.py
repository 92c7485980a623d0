"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w for w in SPACES.split(text or "") if w]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def quality(text):
    text, ws = text or "", words(text)
    wins = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    inside = {p for i in range(len(ws) - 7) if wins[tuple(ws[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
    }


def windows(items, size=10):
    out = defaultdict(set)
    for name, text in items:
        ws = plain_words(text)
        for i in range(max(1, len(ws) - size + 1) if ws else 0):
            out[tuple(ws[i : i + size])].add("" if name is None else str(name))
    return out


def hits(text, wins):
    ws, hit, owners = plain_words(text), set(), set()
    for win, names in wins.items():
        for i in range(len(ws) - len(win) + 1):
            if tuple(ws[i : i + len(win)]) == win:
                hit.update(range(i, i + len(win)))
                owners |= names
    return len(ws), len(hit), sorted(owners)


def shingles(text, size):
    ws = words(lower(text))
    return {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def components(rows, size, percent=80):
    """rows (id, text) with distinct ids -> {id: smallest id reachable}."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in rows}


def targets(sizes, weights=(3, 1, 2), share=1.5):
    """sizes {source: words}; excess over twice the size is dealt again by weight until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, left = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / total for s in free}
        for s in over:
            fixed[s] = 2.0 * sizes[s]
            left -= fixed[s]


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path, rules):
    best = (None, None)
    for verdict, rule in rules:
        name, slash, start = rule.partition("/")
        fits = (host == name or host.endswith("." + name)) and path.startswith(slash + start)
        if fits and (best[0] is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


def templates(pages, prior_pages=10.0, similar=2.58, least=4, repeats=5, steps=64):
    """pages [(host, path, bad)] -> {(host, path): (template, purity)}; the rules of llm.urls as loops over pages."""

    def known(group):
        marks = [bad for *_, bad in group if bad is not None]
        return len(marks), sum(marks)

    def smoothed(group, parent):
        n, bad = known(group)
        return (bad + parent * prior_pages) / (n + prior_pages)

    def differ(x, y):
        (n, a), (m, b) = x, y
        p = (a + b) / (n + m)
        return abs(a / n - b / m) > (p * (1 - p) * (1 / n + 1 / m)) ** 0.5 * similar

    n, bad = known(pages)
    overall, out, rows = bad / n if n else 0.0, {}, []
    for host, path, mark in pages:
        segs = [] if path == "" else path.split("/")[1:] if path[0] == "/" else path.split("/")
        rows.append((host, path, segs, mark))

    def descend(group, level, name, purity):
        if len({tuple(r[2][level:]) for r in group}) < 2:
            for r in group:
                out[r[0], r[1]] = (name, purity)
            return
        below = defaultdict(list)
        for r in group:
            if len(r[2]) > level:
                below[r[2][level]].append(r)
            else:
                out[r[0], r[1]] = (name, purity)
        ids = 2 * sum(len(part) == 1 for part in below.values()) > len(below)
        branches = defaultdict(list)
        for seg, part in below.items():
            branches[seg if len(part) >= repeats or (len(part) > 1 and not ids) else None] += part
        safe = lambda s: "*" if s is None else s.replace("%", "%25").replace("*", "%2A").replace("|", "%7C")
        by_step = defaultdict(list)
        for seg, part in branches.items():
            n, bad = known(part)
            if n < least:
                descend(part, level + 1, f"{name}/{safe(seg)}", purity)
            else:
                by_step[int(bad / n * steps + 0.5)].append((seg, part))
        runs = []
        for step in sorted(by_step):
            own = known([r for _, part in by_step[step] for r in part])
            if runs:
                start, total, members = runs[-1]
                whole = (total[0] + own[0], total[1] + own[1])
                if not differ(own, whole) and not differ(start, whole):
                    runs[-1] = (start, whole, members + by_step[step])
                    continue
            runs.append((own, own, list(by_step[step])))
        for _, _, members in runs:
            label = min(safe(seg) for seg, _ in members) + (f"|%+{len(members) - 1}" if len(members) > 1 else "")
            part = [r for _, own in members for r in own]
            descend(part, level + 1, f"{name}/{label}", smoothed(part, purity))

    for host in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == host]
        descend(group, 0, "", smoothed(group, overall))
    return out
