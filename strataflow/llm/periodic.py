"""Runs of words that repeat with a period, by string synchronising sets.

Periods below `DIRECT` are found by comparing each word with the one so many places on. For longer ones the scales
tau = 6, 12, 24, ... each serve the periods from 3 tau to 6 tau. At a scale every stretch of tau words has a hash, and a
position is selected if the least hash among the next tau + 1 stretches is that of the first or the last of them. Whether
a position is selected depends on the 2 tau words behind it alone (its context), so a run of such a period holds two
selected positions one period apart, with equal contexts. Each pair of positions with equal contexts at such a distance
proposes a run, which is extended as far as words agree.

Stretches with a period of at most tau / 3 have no hash; else a highly periodic region would be selected everywhere. Those
regions are runs that smaller scales found already, and their small periods come from there. What such a region can
hide is a run whose period is itself highly periodic: it lies across two regions of one small period that touch
or overlap. Their pairs propose the periods that fit the phase of both.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.text import U64, _power_tables, mix, release

#: The first scale, the periods below which words are compared directly, and the words of texts handled at once.
TAU = 6
DIRECT = 3 * TAU
GROUP_WORDS = 1 << 17
LEAST_LENGTH = 12
NO_HASH = U64(2**64 - 1)
RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each stretch of True."""
    edges = np.diff(np.concatenate(([False], same, [False])).astype(np.int8))
    first = np.flatnonzero(edges == 1)
    return first, np.flatnonzero(edges == -1) - first


def _direct(t: np.ndarray, periods: range) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(starts, ends, period) of the stretches of at least two periods, of six words at least, for some small periods."""
    out = []
    for q in periods:
        if q >= len(t):
            break
        first, length = _stretches(t[:-q] == t[q:])
        long = length + q >= max(2 * q, TAU)
        out.append((first[long], first[long] + length[long] + q, q))
    return out


def _least_ahead(h: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every n values in a row."""
    width, low = 1, h
    while width * 2 <= n:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[: len(h) - n + 1], low[n - width : n - width + len(h) - n + 1])


class _Matcher:
    """Sums over all words, from which the hash of any stretch follows."""

    def __init__(self, t: np.ndarray):
        self.t = t
        power, self.inverse = _power_tables(len(t) + 1)
        self.sums = np.zeros(len(t) + 1, dtype=U64)
        np.cumsum(mix(t.astype(U64) + U64(1)) * power[: len(t)], out=self.sums[1:])

    def hashes(self, first: np.ndarray, size) -> np.ndarray:
        return (self.sums[first + size] - self.sums[first]) * self.inverse[first]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on agree with those from j on (i < j)."""
        low, high = np.zeros(len(i), dtype=np.int64), len(self.t) - j
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            fits = self.hashes(i, middle) == self.hashes(j, middle)
            low, high = np.where(open_ & fits, middle, low), np.where(open_ & ~fits, middle - 1, high)
        return low

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i agree with those before j (i < j)."""
        low, high = np.zeros(len(i), dtype=np.int64), i.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            fits = self.hashes(i - middle, middle) == self.hashes(j - middle, middle)
            low, high = np.where(open_ & fits, middle, low), np.where(open_ & ~fits, middle - 1, high)
        return low

    def runs(self, i: np.ndarray, d: np.ndarray) -> set[tuple[int, int, int]]:
        """(start, end, period) of the runs that hold position i and the one a period d behind it."""
        pairs = np.unique(np.stack((d, i)), axis=1)
        d, i = pairs[0], pairs[1]
        start, end = i - self.behind(i, i + d), i + d + self.ahead(i, i + d)
        long = end - start >= 2 * d
        sure = set()
        for s, e, q in set(zip(start[long].tolist(), end[long].tolist(), d[long].tolist())):
            if np.array_equal(self.t[s : e - q], self.t[s + q : e]):
                sure.add((s, e, q))
            else:
                # Equal hashes of different words: compare the words themselves around the proposals.
                first, length = _stretches(self.t[s : e - q] == self.t[s + q : e])
                sure.update((s + a, s + a + n + q, q) for a, n in zip(first.tolist(), length.tolist()) if n >= q)
        return sure


def _pairs(keys: np.ndarray, places: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of all pairs of places with equal keys, apart by `least` to `most` - 1."""
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    at, step, found = np.arange(len(keys) - 1), 1, ([], [])
    while len(at):
        gap = places[at + step] - places[at]
        near = (keys[at + step] == keys[at]) & (gap < most)
        at, gap = at[near], gap[near]
        fits = gap >= least
        found[0].append(places[at[fits]])
        found[1].append(gap[fits])
        step += 1
        at = at[at + step < len(keys)]
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate((empty, *found[0])), np.concatenate((empty, *found[1]))


def _across(t: np.ndarray, regions: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """(place, distance): periods that fit the phase of two touching regions of one small period. The place is one period
    before the first region's end."""
    places, gaps = [], []
    regions = sorted((p, s, e) for s, e, p in regions if e - s >= 9 * p)
    for (p, s1, e1), (p2, s2, e2) in zip(regions, regions[1:]):
        if p != p2 or s2 > e1:
            continue
        # The second region's first period, looked for in the first region's.
        once, again = np.concatenate((t[s1 : s1 + p], t[s1 : s1 + p - 1])), t[s2 : s2 + p]
        turns = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(once, p) == again).all(axis=1))
        if not len(turns):
            continue
        phase = (s2 - s1 - int(turns[0])) % p
        lowest = max(DIRECT, 9 * p)
        q = np.arange(lowest + (phase - lowest) % p, min(e1 - s1, e2 - s2) + 1, p)
        places += (e1 - q).tolist()
        gaps += q.tolist()
    return places, gaps


def find_runs(t: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of every maximal stretch of `t` that repeats with a period at least twice and has six
    words or more, sorted. `t` holds numbers of words; values that occur once separate texts, which begin at `bounds`
    (one more entry: the length), separator included."""
    best: dict[tuple[int, int], int] = {}

    def enter(s: int, e: int, q: int) -> None:
        best[s, e] = min(q, best.get((s, e), q))

    for first, end, q in _direct(t, range(1, DIRECT)):
        for s, e in zip(first.tolist(), end.tolist()):
            enter(s, e, q)
    lengths, tau = np.diff(bounds), TAU
    while (lengths > 6 * tau).any():
        # Only texts that hold two of the least periods, closed up; places are turned back afterwards.
        stay = lengths > 6 * tau
        starts, sizes = bounds[:-1][stay], lengths[stay]
        closed = np.concatenate(([0], np.cumsum(sizes)))
        back = starts - closed[:-1]
        part = t if stay.all() else np.concatenate([t[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist())])
        match = _Matcher(part)
        n = len(part) - 2 * tau + 1
        names = mix(match.hashes(np.arange(len(part) - tau + 1), tau))
        names[names == NO_HASH] = U64(0)
        forward = dict(zip(starts.tolist(), closed[:-1].tolist()))
        for (s, e), q in best.items():
            if 3 * q <= tau <= e - s:
                text = int(np.searchsorted(bounds, s, side="right")) - 1
                if (at := forward.get(int(bounds[text]))) is not None:
                    at += s - int(bounds[text])
                    names[at : at + e - s - tau + 1] = NO_HASH
        least = _least_ahead(names, tau + 1)[:n]
        chosen = np.flatnonzero((least != NO_HASH) & ((least == names[:n]) | (least == names[tau : tau + n])))
        i, d = _pairs(match.hashes(chosen, 2 * tau), chosen, 3 * tau, 6 * tau)
        if len(i):
            for s, e, q in match.runs(i, d):
                turn = int(back[np.searchsorted(closed, s, side="right") - 1])
                enter(s + turn, e + turn, q)
        tau *= 2
    i, d = _across(t, [(s, e, q) for (s, e), q in best.items()])
    if i:
        for s, e, q in _Matcher(t).runs(np.array(i, dtype=np.int64), np.array(d, dtype=np.int64)):
            enter(s, e, q)
    return sorted((s, e, q) for (s, e), q in best.items())


def rewritten(n: int, doc: int) -> np.ndarray | None:
    """Which word stands at each of n places where a document's number calls for a planted run, else None. With
    h = crc32 of the number's digits and g = h div 10: if 10 divides h, words from a = g mod n on repeat the
    p = 1 + (n - a) div (3 + g mod 8) words there."""
    h = zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def _told(doc, words: list[bytes], runs: list[tuple[int, int, int]], full: bool) -> tuple:
    """The result row of one text from its runs (start, end, period)."""
    listed = [(s, e - s, q) for s, e, q in runs]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
    kept = words
    if listed:
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for s, e, q in runs:
            change[s + q] += 1
            change[e] -= 1
        kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        s, n, q = min(listed, key=lambda r: (-r[1], r[0], r[2]))
        top = (s, n, q, 1000 * n // q)
    else:
        top = (None,) * 4
    joined = b" ".join(kept)
    shown = ([{"start": s, "length": n, "period": q} for s, n, q in listed], joined.decode()) if full else (None, None)
    return (doc, len(listed), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(joined).hexdigest(), *shown)


def _detector(least: int, planted: bool, full: bool):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [run_type, pa.string()]

    def group(held: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        sizes = [len(words) + 1 for _, words in held]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        number: dict[bytes, int] = {}
        t = np.empty(bounds[-1], dtype=np.int64)
        for at, (_, words) in zip(bounds.tolist(), held):
            t[at : at + len(words)] = [number.setdefault(w, len(number)) for w in words]
        t[bounds[1:] - 1] = len(number) + np.arange(len(held))
        per: list[list] = [[] for _ in held]
        runs = [r for r in find_runs(t, bounds) if r[1] - r[0] >= max(least, 2 * r[2])]
        owners = (np.searchsorted(bounds, [s for s, _, _ in runs], side="right") - 1).tolist()
        for owner, (s, e, q) in zip(owners, runs):
            at = int(bounds[owner])
            per[owner].append((s - at, e - at, q))
        rows = [_told(doc, words, sorted(found, key=lambda r: (r[0], r[2])), full) for (doc, words), found in zip(held, per)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                doc = batch.column(0)[row].as_py()
                # Splitting bytes without an argument splits at exactly the bytes 0x20 and 0x09-0x0D.
                words = (batch.column(1)[row].as_py() or "").encode().split()
                if planted and doc is not None and (order := rewritten(len(words), doc)) is not None:
                    words = [words[i] for i in order.tolist()]
                held.append((doc, words))
                size += len(words) + 1
                if size >= GROUP_WORDS:
                    yield group(held)
                    held, size = [], 0
        if held:
            yield group(held)
        release()

    return run


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH, planted: bool = False, full: bool = True) -> DataFrame:
    """One row per input row: key (an integer), n_runs; start, length, period and exponent_milli of the longest run (ties:
    smallest start, then period; null without a run); the hashes of the list of runs and of the text without repeats;
    runs and the collapsed text themselves (null unless `full`).

    Words are what stands between white space [\\x20\\x09-\\x0D]. A run is a stretch of words with smallest period q and at
    least `least` and 2 q words, which no neighbouring word extends. A word goes if it lies in a run behind its first q
    words; kept words are joined by single spaces. Null and empty texts have no words and no runs; repeated rows and rows
    without a key are told each; an empty table gives an empty result; other columns are not looked at. With `planted`,
    texts of some keys are first rewritten to hold a run (see `rewritten`); a row without a key never is. A text is
    worked on by one task, whose memory grows with its longest text."""
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return texts.mapInArrow(_detector(least, planted, full), RESULT).withColumnRenamed("doc_id", key)
