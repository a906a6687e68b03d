"""Small document tables with the awkward cases, and plain Python versions of what operators compute."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, rep string, n string, maybe string, text_sha256 string"


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(["ka", "lo", "mi", "ru", "se", "to", "vé", "ß"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def texts(seed: int = 3) -> list[tuple[int | None, str | None]]:
    """(doc_id, text): nulls, empty and blank texts, short texts, ties, copies, near copies in groups around the bucket
    limit, a shared passage, one long text, a repeated row, a key with two texts, rows without a key."""
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One "), (6, "one two three"), (7, "one two  three")]
    passage = prose(rng, 40)
    at = 10
    for _ in range(25):
        rows.append((at, " ".join(prose(rng, rng.randint(5, 120)))))
        at += 1
    for _ in range(12):
        rows.append((at, " ".join([*prose(rng, 60), *passage, *prose(rng, 20)])))
        at += 1
    for size in (2, 5, 14, 40):
        base = prose(rng, 150)
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 9)):
                words[rng.randrange(len(words))] = "".join(prose(rng, 2))
            rows.append((at, " ".join(words)))
            at += 1
    for _ in range(6):
        rows.append((at, rows[20][1].replace(" ", "\n ")))
        at += 1
    rows.append((at, " ".join(prose(rng, 30_000))))
    rows += [rows[25], (rows[30][0], rows[45][1]), (None, rows[22][1]), (None, "nobody knows this one"), (None, None)]
    rng.shuffle(rows)
    return rows


def table(spark, rows=None):
    """The texts with columns whose names operators use inside."""
    rows = texts() if rows is None else rows
    filled = [(i, t, "en", f"s{(i or 0) % 3}" if i != 11 else None, len(t or ""), "x", "y", "z", "m", "h") for i, t in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(4)


def shingles(text: str | None, size: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def components(rows) -> dict[int, int]:
    """Smallest key reached by links of Jaccard similarity 3/4 or more, all pairs compared; rows of one key are one."""
    sets: dict[int, list[frozenset]] = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                high, low = sorted((top(a), top(b)), reverse=True)
                up[high] = low
    return {i: top(i) for i in sets}
