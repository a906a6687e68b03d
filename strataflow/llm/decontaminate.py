"""Benchmark decontamination by a hash set of normalised word n-grams.

Every item gives the n-grams of its words (an item of fewer words its whole sequence). Tasks hash the windows of the
texts and look them up in a broadcast set; each hit is verified by comparing its words. A benchmark of more n-grams than
the set may hold is not broadcast: a bit table lets through windows that may occur, and those are joined with the
n-grams and verified there.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm import bits
from strataflow.llm.shared import stash
from strataflow.llm.text import _LOWER, NO_LETTER, U64, buffers, release, rolled, slices, span_hashes, word_spans

#: Words of a window, and the most distinct n-grams of a broadcast set (some 100 bytes each in a Python worker).
SIZE, MOST_GRAMS = 10, 1 << 18
#: Bits per n-gram of the bit table of larger benchmarks, probes, and its most bits (64 MB).
BITS_PER_GRAM, PROBES, MOST_BITS = 16, 4, 1 << 29
#: Shares into which the windows of a frequent passage are dealt in the join.
SALTS = 16
FOUND = "struct<n_words: bigint, hits: array<struct<first: bigint, size: bigint>>, items: array<string>, clean: string>"


def _normal(lower: np.ndarray, start: np.ndarray, stop: np.ndarray, first: int, size: int) -> bytes:
    """Some words in a row, joined by single spaces."""
    return b" ".join([lower[a:b].tobytes() for a, b in zip(start[first : first + size].tolist(), stop[first : first + size].tolist())])


def grams(items: DataFrame, key: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(h, size, gram, items): each distinct n-gram of the items' words as bytes, its hash, and the sorted distinct keys
    of the items that hold it, as strings. Items without words have none; n-grams of items without a key are kept, with
    no key in their list."""

    def cut(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                data, offsets = buffers(batch.column(1).slice(row, 1))
                start, stop = word_spans(data, offsets, NO_LETTER) if len(data) else (np.zeros(0, dtype=np.int64),) * 2
                if not len(start):
                    continue
                n = min(size, len(start))
                lower, found = _LOWER[data], rolled(span_hashes(data, start, stop), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.view(np.int64)),
                        pa.array(np.full(len(found), n, dtype=np.int32)),
                        pa.array([_normal(lower, start, stop, i, n) for i in range(len(found))], pa.binary()),
                        pa.array([batch.column(0)[row].as_py()] * len(found), pa.string()),
                    ],
                    names=["h", "size", "gram", "item"],
                )

    rows = items.select(F.col(key).cast("string"), F.col(text)).mapInArrow(cut, "h long, size int, gram binary, item string")
    return rows.groupBy("h", "size", "gram").agg(F.array_sort(F.collect_set("item")).alias("items"))


class GramSet:
    """N-grams with a byte table in front: most windows are told apart by one look-up."""

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, grams: list[bytes], items: list[list[str]]):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.sizes = hashes[order], sorted(set(sizes.tolist()))
        self.grams, self.items = [grams[i] for i in order], [items[i] for i in order]
        width = 1 << max(16, int(len(hashes) * 16).bit_length())
        self.mask = U64(width - 1)
        self.front = np.zeros(width, dtype=bool)
        self.front[(hashes & self.mask).astype(np.int64)] = True

    def maybe(self, windows: np.ndarray) -> np.ndarray:
        """Windows whose hash is in the set."""
        spots = np.flatnonzero(self.front[(windows & self.mask).astype(np.int64)])
        at = np.searchsorted(self.hashes, windows[spots])
        at[at == len(self.hashes)] = 0
        return spots[self.hashes[at] == windows[spots]] if len(self.hashes) else spots[:0]

    def verified(self, window: np.uint64, words: bytes) -> int | None:
        """The n-gram with this hash and these words."""
        at = int(np.searchsorted(self.hashes, window))
        while at < len(self.hashes) and self.hashes[at] == window:
            if self.grams[at] == words:
                return at
            at += 1
        return None


def _windows(data: np.ndarray, offsets: np.ndarray, sizes: list[int]):
    """Spans of the words, first word of each text, and per window size the hash of every window within one text with
    its first word."""
    start, stop = word_spans(data, offsets, NO_LETTER) if len(data) else (np.zeros(0, dtype=np.int64),) * 2
    firsts = np.searchsorted(start, offsets)
    hashes = span_hashes(data, start, stop) if len(start) else np.zeros(0, dtype=U64)
    ends = np.repeat(firsts[1:], np.diff(firsts))
    cut = []
    for n in sizes:
        windows = rolled(hashes, n)
        inside = np.arange(len(windows)) + n <= ends[: len(windows)]
        cut.append((n, np.flatnonzero(inside), windows[inside]))
    return start, stop, firsts, cut


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Hit windows (first, size), sorted, as disjoint stretches of words (first, behind)."""
    out: list[tuple[int, int]] = []
    for first, size in hits:
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], first + size))
        else:
            out.append((first, first + size))
    return out


def _cleaned(raw: bytes, stretches: list[tuple[int, int]]) -> str:
    """The text without the stretches of words. Of what surrounded them, one separator byte stays between the parts."""
    data = np.frombuffer(raw, dtype=np.uint8)
    start, stop = word_spans(data, np.array([0, len(data)]), NO_LETTER)
    parts, at = [], 0
    for first, behind in stretches:
        parts.append(raw[at : start[first]])
        at = int(stop[behind - 1])
    parts.append(raw[at:])
    kept = [p for p in (parts[0].rstrip(), *(p.strip() for p in parts[1:-1]), parts[-1].lstrip()) if p]
    return b" ".join(kept).decode()


def _scanner(table, clean: bool):
    """An Arrow function from texts to what was found in them."""

    def look(texts: pa.Array) -> pa.Array:
        known = table()
        data, offsets = buffers(texts)
        words_of, hits_of, items_of, clean_of = [], [], [], []
        for a, b in slices(offsets):
            part = data[offsets[a] : offsets[b]]
            start, stop, firsts, cut = _windows(part, offsets[a : b + 1] - offsets[a], known.sizes)
            lower = _LOWER[part]
            found: dict[int, tuple[list, set]] = {}
            for n, place, windows in cut:
                spots = known.maybe(windows)
                owners = np.searchsorted(firsts, place[spots], side="right") - 1
                for i, h, owner in zip(place[spots].tolist(), windows[spots], owners.tolist()):
                    at = known.verified(h, _normal(lower, start, stop, i, n))
                    if at is not None:
                        spans, items = found.setdefault(owner, ([], set()))
                        spans.append((i - int(firsts[owner]), n))
                        items.update(known.items[at])
            words_of += np.diff(firsts).tolist()
            for row in range(b - a):
                spans, items = found.get(row, ((), ()))
                merged = _merged(sorted(spans))
                hits_of.append([{"first": x, "size": y - x} for x, y in merged])
                items_of.append(sorted(items))
                clean_of.append(_cleaned(data[offsets[a + row] : offsets[a + row + 1]].tobytes(), merged) if clean and merged else None)
        release()
        spans_type = pa.list_(pa.struct([("first", pa.int64()), ("size", pa.int64())]))
        return pa.StructArray.from_arrays(
            [pa.array(words_of, pa.int64()), pa.array(hits_of, spans_type), pa.array(items_of, pa.list_(pa.string())), pa.array(clean_of, pa.string())],
            names=["n_words", "hits", "items", "clean"],
        )

    return F.arrow_udf(look, FOUND)


def _broadcast_set(spark, rows: list):
    """The rows of `grams` as a set that each Python worker builds once."""
    sent = spark.sparkContext.broadcast([(r["h"], r["size"], bytes(r["gram"]), r["items"]) for r in rows])
    built: list[GramSet] = []

    def table() -> GramSet:
        if not built:
            held = sent.value
            hashes = np.array([r[0] for r in held], dtype=np.int64).view(np.uint64)
            built.append(GramSet(hashes, np.array([r[1] for r in held], dtype=np.int32), [r[2] for r in held], [r[3] for r in held]))
        return built[0]

    return table


def _windows_that_may_occur(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(row, first, size, h, gram): windows of the texts of `docs` (row, text) that the bit table of all n-grams lets
    through."""
    spark = docs.sparkSession
    n_bits = bits.bits_for(known.count(), BITS_PER_GRAM, MOST_BITS)
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())
    table = spark.sparkContext.broadcast(bits.fill(known.select("h"), n_bits, PROBES, 1)[0])

    def scan(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for a, b in slices(offsets):
                part = data[offsets[a] : offsets[b]]
                start, stop, firsts, cut = _windows(part, offsets[a : b + 1] - offsets[a], sizes)
                lower = _LOWER[part]
                for n, place, windows in cut:
                    spots = np.flatnonzero(bits.holds(table.value, windows, PROBES))
                    at = place[spots]
                    owners = np.searchsorted(firsts, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(a, b - a).take(pa.array(owners)),
                            pa.array(at - firsts[owners]),
                            pa.array(np.full(len(at), n, dtype=np.int32)),
                            pa.array(windows[spots].view(np.int64)),
                            pa.array([_normal(lower, start, stop, i, n) for i in at.tolist()], pa.binary()),
                        ],
                        names=["row", "first", "size", "h", "gram"],
                    )
            release()

    return docs.mapInArrow(scan, "row binary, first long, size int, h long, gram binary")


def _joined(docs: DataFrame, known: DataFrame, text: str, found: str) -> DataFrame:
    """The rows with a struct of what was found, by a join. Texts are named by their hash, and equal texts give their
    windows once. Windows are dealt by salt, so a passage that a third of all texts share spreads over the tasks."""
    sha = f"{found}_sha"
    named = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    met = _windows_that_may_occur(docs.select(named.alias("row"), F.col(text).alias("text")), known)
    met = met.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    sure = met.join(spread, ["h", "size", "gram", "salt"]).select("row", "first", "size", "items").dropDuplicates(["row", "first", "size"])
    per = sure.groupBy("row").agg(
        F.collect_list(F.struct("first", F.col("size").cast("long").alias("size"))).alias(f"{found}_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias(f"{found}_items"),
    )
    per = stash(per.withColumnRenamed("row", sha), "hits")
    plain = F.arrow_udf(_counter, "struct<n_words: bigint, hits: array<struct<first: bigint, size: bigint>>, clean: string>")
    rows = docs.withColumn(sha, named).join(per, sha, "left").withColumn(found, plain(F.col(text), F.col(f"{found}_spans")))
    items = F.coalesce(F.col(f"{found}_items"), F.array().cast("array<string>"))
    return rows.select(*docs.columns, F.struct(f"{found}.n_words", f"{found}.hits", items.alias("items"), f"{found}.clean").alias(found))


def _counter(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Words, merged stretches and cleaned text of each row whose hit windows are known."""
    words_of, hits_of, clean_of = [], [], []
    for i in range(len(texts)):
        raw = (texts[i].as_py() or "").encode()
        data = np.frombuffer(raw, dtype=np.uint8)
        words_of.append(len(word_spans(data, np.array([0, len(data)]), NO_LETTER)[0]) if raw else 0)
        merged = _merged(sorted((s["first"], s["size"]) for s in spans[i].as_py() or ()))
        hits_of.append([{"first": x, "size": y - x} for x, y in merged])
        clean_of.append(_cleaned(raw, merged) if merged else None)
    spans_type = pa.list_(pa.struct([("first", pa.int64()), ("size", pa.int64())]))
    return pa.StructArray.from_arrays([pa.array(words_of, pa.int64()), pa.array(hits_of, spans_type), pa.array(clean_of, pa.string())], names=["n_words", "hits", "clean"])


def with_hits(docs: DataFrame, items: DataFrame, found: str, text: str = "text", item_key: str = "item_id", item_text: str = "text", size: int = SIZE, clean: bool = False, most: int = MOST_GRAMS) -> DataFrame:
    """All rows and columns of `docs` and a column `found`: n_words; hits, the disjoint stretches (first word, number of
    words) inside some occurrence of an item's n-gram, touching ones joined; items, the keys of the items whose n-grams
    occur, as sorted strings; clean, the text without the hit words where there are any (if asked for).

    Words are runs of letters, digits and all bytes above 127, A-Z lower-cased. Null and empty texts have no words. Items
    without words occur nowhere; n-grams of items without a key hit without naming an item; items that share a key are
    one. Repeated rows get the same result each; empty tables on either side give no hits. Up to `most` distinct n-grams
    are broadcast; beyond that windows and n-grams are joined."""
    known = stash(grams(items, item_key, item_text, size), "grams")
    if known.count() > most:
        return _joined(docs, known, text, found)
    look = _scanner(_broadcast_set(docs.sparkSession, known.collect()), clean)
    return docs.withColumn(found, look(F.col(text)))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per input row: key, n_words, n_hit (words inside a hit), n_items (items whose n-grams occur), items_sha256
    (their sorted keys, comma-joined), contaminated. The rules are those of `with_hits`; other columns are not looked
    at."""
    rows = with_hits(docs.select(F.col(key).alias("doc"), F.col(text).alias("text")), items, "found", **options)
    n_hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda total, hit: total + hit["size"])
    rows = rows.select("doc", "found.n_words", n_hit.alias("n_hit"), "found.items")
    return rows.select(
        F.col("doc").alias(key),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", whole: bool = False, **options) -> DataFrame:
    """The rows of `docs`, same columns, without what the benchmark holds: with `whole` rows with a hit go, otherwise
    their hit words do, and a row whose words are all hit keeps what stands around them. The rules are those of
    `with_hits`."""
    found = f"found_{uuid.uuid4().hex}"
    rows = with_hits(docs, items, found, text, clean=not whole, **options)
    if whole:
        return rows.where(F.size(f"{found}.hits") == 0).select(*docs.columns)
    return rows.withColumn(text, F.coalesce(F.col(f"{found}.clean"), F.col(text))).select(*docs.columns)
