"""A small corpus with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import random
from collections import Counter

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, mark string, copy int, kept string, n_lines int,"
    " mask string, _m int, _d int, _below int, node string, `key` string"
)
MORE = ("x", 1, 2, 3, "n", "k")


def documents(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in", "is"]
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word():
        if rng.random() < 0.4:
            return rng.choice(common)
        return "".join(rng.choice(letters) for _ in range(rng.randint(4, 9)))

    def text(n):
        out, line = [], []
        for _ in range(n):
            line.append(word())
            if len(line) > 14:
                out.append(" ".join(line))
                line = []
        return "\n".join([*out, " ".join(line)])

    base = [text(rng.randint(60, 160)) for _ in range(16)]
    passage = " ".join(word() for _ in range(70))
    texts = list(base)
    for t in base[:5]:  # near copies: one word changed
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    texts += [base[0], base[1]]  # exact copies
    texts += [f"{text(30)} {passage} {text(20)}" for _ in range(4)]
    texts += [f"Read more\n{text(25)}\nok" for _ in range(3)]
    texts += [None, "", " \n\t ", "one two three", "one two three", "ÉCOLE école É 漢字 漢字"]
    texts += [text(6000), "a" * 3000, "x" * 40 + " " + "y" * 2000]
    texts += ["good | junk | " * 30, "same eight words come again in every window " * 12]
    rows = [
        (i, t, ["en", "fr", None][i % 3], ["s0", "s0", "s1", None][i % 4], len(t or ""), "m", 9, "k", 1, *MORE)
        for i, t in enumerate(texts)
    ]
    rows.append(rows[2])  # a repeated row
    rows.append((None, base[3], "en", "s1", 5, "m", 9, "k", 1, *MORE))  # no id, text of document 3
    rng.shuffle(rows)
    return rows


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def near_components(rows, width, percent=80):
    """(shingle counts by row, smallest doc_id by row)."""
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    union = Union()
    for i, a in enumerate(sets):
        union.find(i)
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                union.join(i, j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            root = union.find(i)
            least[root] = min(least.get(root, r[0]), r[0])
    return [len(s) for s in sets], [least.get(union.find(i)) for i in range(len(rows))]


def repeats_removed(rows, width=50):
    first = {}
    for r in rows:
        w = words(r[1])
        if r[0] is not None:
            for i in range(len(w) - width + 1):
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r in rows:
        w, gone = words(r[1]), set()
        for i in range(len(w) - width + 1):
            if r[0] is not None and first[tuple(w[i : i + width])] < r[0]:
                gone.update(range(i, i + width))
        out.append((r[0], len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def lines_kept(rows, chars=8, alike=0.8):
    """Texts without the near-copies of earlier lines, in the order (doc_id with NULL first, line)."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    found = {}
    for i in order:
        for no, line in enumerate((rows[i][1] or "").split("\n")):
            if line.encode().split():
                found.setdefault(line, []).append((rows[i][0], rows[i][1], no))
    held = list(found)
    sets = [{x[i : i + chars] for i in range(max(1, len(x) - chars + 1))} for x in held]
    union = Union()
    for i in range(len(held)):
        union.find(i)
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / (len(sets[i]) + len(sets[j]) - both) >= alike:
                union.join(i, j)
    groups = {}
    for i, line in enumerate(held):
        groups.setdefault(union.find(i), []).extend(found[line])
    gone = set()
    for places in groups.values():
        least_one = min(places, key=lambda p: (p[0] is not None, p[0] or 0, p[2]))
        gone |= {p for p in places if p != least_one}
    out = []
    for r in rows:
        if r[1] is None:
            out.append((r[0], None))
            continue
        lines = r[1].split("\n")
        out.append((r[0], "\n".join(x for no, x in enumerate(lines) if (r[0], r[1], no) not in gone)))
    return out


def base_counts(text: str | None) -> tuple:
    w = words(text)
    n, seen, again, covered = len(w), set(), 0, set()
    for line in (text or "").encode().split(b"\n"):
        if line.split():
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(n - 7))
    for i in range(n - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return n, sum(len(x.decode()) for x in w), symbols, again, len(covered), n < 20 or 100 * len(covered) > 30 * n


def key(row):
    return tuple((x is not None, str(x)) for x in row)
