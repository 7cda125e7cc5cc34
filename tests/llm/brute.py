"""Plain versions of the operators, one text or one pair of texts at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def walked(forest, row):
    """A forest's probability for one row, node by node."""
    total = forest.base
    for at in forest.roots:
        while forest.left[at] != at:
            at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
        total += forest.value[at]
    return 1 / (1 + math.exp(-total))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def quality_counts(text):
    text = text or ""
    words = SPACED.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
    )


def benchmark_hits(text, items, size=10):
    words = ALNUM.findall(lower(text))
    hit, found = set(), set()
    for item, own in items:
        own = ALNUM.findall(lower(own))
        length = min(size, len(own))
        if not length:
            continue
        windows = {tuple(own[i : i + length]) for i in range(len(own) - length + 1)}
        for i in range(len(words) - length + 1):
            if tuple(words[i : i + length]) in windows:
                found.update(() if item is None else (item,))
                hit.update(range(i, i + length))
    ids = ",".join(sorted(map(str, found)))
    return len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def shingles(text, size=5):
    words = SPACED.findall(lower(text))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def components(sets, percent=75):
    """Component of every id by comparing all pairs."""
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a1, b1 = root(a), root(b)
                parent[max(a1, b1)] = min(a1, b1)
    return {i: root(i) for i in ids}


def repeated_spans(texts, size):
    """Kept bytes, removed count and number of removed runs of every id."""
    data = {i: (t or "").encode() for i, t in texts}
    at = defaultdict(int)
    for b in data.values():
        for p in range(len(b) - size + 1):
            at[b[p : p + size]] += 1
    out = {}
    for i, b in data.items():
        gone = [False] * len(b)
        for p in range(len(b) - size + 1):
            if at[b[p : p + size]] > 1:
                gone[p : p + size] = [True] * size
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def pieces(ids, capacity):
    ids = [*ids, 2]
    stop, start, out = (len(ids) - 1) % capacity + 1, 0, []
    while start < len(ids):
        raw = b"".join(i.to_bytes(4, "little") for i in ids[start:stop])
        out.append((start, stop - start, zlib.crc32(raw)))
        start, stop = stop, stop + capacity
    return out


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def damaged_words(rows):
    """Counts of the runs of (id, text) rows after one in 97 lost a code point."""
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def spelling_variants(words):
    """Rows (word, form, root, n, n_near, form_n) by comparing all pairs."""
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def repaired(rows):
    """(cost, audit, turns) of (role, text, fault) rows, over all edits from the last row back."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    memo = {}

    def best(i, last, inserted):
        """The least (cost, edits) from row i on, and the turns; ``last`` is the initial before."""
        key = (i, last, inserted)
        if key not in memo:
            ways = []
            if i == len(rows) and last in ("", "a"):
                ways.append((0, "", ()))
            if inserted < 2:
                for c in set(step[last]) - {"s"}:
                    cost, audit, turns = best(i, c, inserted + 1)
                    ways.append((cost + 5, "I" + audit, ((names[c], ""), *turns)))
            if i < len(rows):
                role, text, fault = rows[i]
                cost, audit, turns = best(i + 1, last, 0)
                ways.append((cost + 2, "D" + audit, turns))
                if fault not in ("blank", "duplicate"):
                    extra = 5 if fault == "truncated" else 0
                    if role[:1] and role[:1] in step[last]:
                        cost, audit, turns = best(i + 1, role[:1], 0)
                        ways.append((cost + extra, "K" + audit, ((role, text), *turns)))
                    for c in set(step[last]) - {"s"}:
                        cost, audit, turns = best(i + 1, c, 0)
                        ways.append((cost + extra + 1, "R" + audit, ((names[c], text), *turns)))
            memo[key] = min(ways, key=lambda w: w[:2], default=(10**9, "", ()))
        return memo[key]

    return best(0, "", 0)


def faults(rows):
    """Fault of each (role, text) row, in order."""
    seen, out = set(), []
    for role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def damaged_conversations(rows):
    """(turn, role, text) rows after damage, by conversation, from (conv, turn, role, text)."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out[conv] += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def conversation_row(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of one conversation."""
    known = [t for t, _, _ in rows if t is not None]
    found = faults([(r, t) for _, r, t in rows])
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, turns = repaired([(r, t, f) for (_, r, t), f in zip(rows, found)])
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        *(found.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
    )
