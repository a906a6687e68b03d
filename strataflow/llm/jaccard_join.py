"""N-gram Jaccard join by parity sketches.

A document's shingles are hashed to 64-bit tokens. Its sketch has cells; a token is XORed into the cell that its top
bits name, so a cell in which two sketches differ holds at least one token of the symmetric difference: the number of
differing cells is a lower bound of it. Two sets of a and b tokens with Jaccard similarity 3/4 or more have a symmetric
difference of at most d = (a + b) // 7. Hence, of any d + 1 occupied cells of one sketch, one at least is found
unchanged in the other. Each document sends the first d + 1 of its occupied cells, in an order that all documents
share (cells known to be frequent last), and documents that send an equal cell become candidates. A node of the
join is a token set, and not a key, which may come with several texts. It is named by 64 bits (its sum of tokens); sets
that a second such name tells apart get names made of both. Cells per
sketch depend on the size band of the smaller document; a document just above a band's end also sends cells as the larger
partner of that band.

Candidates are checked by size, then by the Hamming distance of bit sketches (token parity per bit), then exactly.
In large buckets a candidate is formed with the most central member only. Buckets that hold several components after
that are compared in pairs of blocks inside tasks: members outside the main component meet all others there, and only
pairs that the bit sketches allow leave the task. So no component is missed, and no bucket emits its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm import bits
from strataflow.llm.components import components
from strataflow.llm.shared import stash
from strataflow.llm.text import U64, buffers, mix, release, shingles, slices, words

SHINGLE = 5
#: Sizes of the first band end here; every next band is four times as wide.
FIRST_BAND = 64
#: Frequent cells that are ordered last; a bound on what is broadcast (16 bytes each), without influence on results.
FREQUENT_CELLS = 50_000
#: Buckets up to this size form all their pairs; larger ones go by representatives.
SMALL_BUCKET = 8
#: Members per block where a large bucket is compared in full; a task holds two blocks at a time.
BLOCK = 1024
#: Shares into which the members of a large bucket are dealt where they meet what is known of the bucket.
SALTS = 16
#: Bits of a node's first name.
NAME_BITS = 64
PROBES = 2


def band(n: int) -> int:
    """The size band of n tokens: 0 below 64, then 64-255, 256-1023, ..."""
    b, end = 0, FIRST_BAND
    while n >= end:
        b, end = b + 1, end * 4
    return b


def _cell_shift(b: int) -> int:
    """How many low bits of a token do not name its cell: 2**32 cells in the first band (practically one per token), in
    others four for each token of the smallest document, so far more than d + 1 cells are occupied."""
    return 32 if b == 0 else 64 - (FIRST_BAND * 4 ** (b - 1) * 4).bit_length() + 1


def cells(tokens: np.ndarray, b: int) -> np.ndarray:
    """The occupied cells of a sorted token set in band b, as keys of place and content."""
    at = tokens >> U64(_cell_shift(b))
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    content = np.bitwise_xor.reduceat(tokens, first)
    return mix(content ^ mix(at[first] + (U64(b) << U64(40))))


def sent(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The cells a document sends: the first d + 1 in the shared order, in its own band and, near the lower end of that,
    in the band before."""
    n, out = len(tokens), []
    own = band(n)
    before = band(-(-3 * n // 4))
    for b in (own, before) if before < own else (own,):
        end = FIRST_BAND * 4**b
        most = (n + (4 * n // 3 if b == own else end - 1)) // 7
        keys = cells(tokens, b)
        if len(keys) > most + 1:
            rank = np.zeros(len(keys), dtype=np.int64)
            if len(frequent):
                at = np.searchsorted(frequent, keys)
                at[at == len(frequent)] = 0
                rank = np.where(frequent[at] == keys, counts[at], 0)
            keys = keys[np.lexsort((keys, rank))[: most + 1]] if rank.any() else np.partition(keys, most)[: most + 1]
        out.append(keys)
    return np.concatenate(out)


def bit_sketch(tokens: np.ndarray, bits_each: int = 1) -> bytes:
    """Token parity per bit; a power of two of at least `bits_each` bits a token, 1024 at least. With one bit each, unlike
    sets differ in about half of the bits while similar ones differ in at most 2/7 of the tokens. Low token bits name
    the bit, so a larger sketch folds to a smaller one by XOR of its halves."""
    n_bits = max(1024, 1 << (bits_each * len(tokens) - 1).bit_length())
    parity = np.bincount((tokens & U64(n_bits - 1)).astype(np.int64), minlength=n_bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def _folded(sketch: bytes, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(sketch, dtype=np.uint8).reshape(-1, size), axis=0)


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two bit sketches: never above the symmetric difference of the sets."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum())


def _sets(batch: pa.RecordBatch, size: int):
    """(row, sorted token set) of every row of a batch of (key, text)."""
    data, offsets = buffers(batch.column(1))
    for first, last in slices(offsets):
        part = offsets[first : last + 1]
        hashes, firsts = words(data[part[0] : part[-1]], part - part[0])
        for i, tokens in enumerate(shingles(hashes, firsts, size)):
            yield first + i, tokens


def _names(tokens: np.ndarray, name_bits: int) -> tuple[int, int]:
    """Two names of a token set, the first of `name_bits` bits, the second of 64."""
    twin = mix(tokens ^ U64(0xA5A5A5A55A5A5A5A))
    first = tokens.sum(dtype=U64) >> U64(64 - name_bits)
    return tuple(np.array([first, twin.sum(dtype=U64)], dtype=U64).view(np.int64).tolist())


def _node(tokens: np.ndarray, name_bits: int, doubled: frozenset[int]) -> int:
    """The name of a token set as a node: its first name, or both in one where unlike sets share the first."""
    one, two = _names(tokens, name_bits)
    return one ^ two if one in doubled else one


def _summaries(size: int, name_bits: int):
    """Per document its set's size, names and bit sketch; besides, cells that repeat among some 16 MB of texts."""

    def run(batches):
        gathered: list[np.ndarray] = []
        seen: set[int] = set()
        held = 0

        def repeated():
            keys, n = np.unique(np.concatenate(gathered), return_counts=True) if gathered else (np.zeros(0, U64), np.zeros(0, int))
            keep = n > 1
            return rows([None] * int(keep.sum()), n[keep].tolist(), keys[keep].view(np.int64).tolist(), None, None)

        def rows(ids, n, one, two, sketch):
            empty = [None] * len(ids)
            columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two or empty, pa.int64()), pa.array(sketch or empty, pa.binary()), pa.array([sketch is None] * len(ids), pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=["doc", "n", "one", "two", "sketch", "cell"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: tuple[list, ...] = ([], [], [], [], [])
            for row, tokens in _sets(batch, size):
                one, two = _names(tokens, name_bits)
                for column, value in zip(out, (ids[row], len(tokens), one, two, bit_sketch(tokens))):
                    column.append(value)
                if len(tokens) and one not in seen:
                    seen.add(one)
                    gathered.append(cells(tokens, band(len(tokens))))
                    held += len(tokens)
                if held > 2_000_000:
                    yield repeated()
                    gathered, held = [], 0
                    seen = set()
            yield rows(*out)
        yield repeated()
        release()

    return run


def _sender(size: int, name_bits: int, frequent: np.ndarray, counts: np.ndarray, doubled: frozenset[int]):
    """(cell, doc) rows, doc being the node of the set. A task sends an equal set once; the copies share its fate."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            keys, docs, held = [], [], 0
            for row, tokens in _sets(batch, size):
                if ids[row] is None or not len(tokens):
                    continue
                name = _node(tokens, name_bits, doubled)
                if name in seen:
                    continue
                seen.add(name)
                found = sent(tokens, frequent, counts)
                keys.append(found)
                docs.append(np.full(len(found), name, dtype=np.int64))
                held += len(found)
                if held > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(docs))], names=["cell", "doc"])
                    keys, docs, held = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(docs))], names=["cell", "doc"])

    return run


def _buckets(batches):
    """From rows sorted by cell and doc: all pairs (u > v) of small buckets, and the members of large buckets, which
    carry their cell. Documents that meet in several cells of a batch are paired once."""

    def out(cell, u, v):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (cell, u, v)], names=["cell", "u", "v"])

    def work(cell, doc):
        keep = np.ones(len(cell), dtype=bool)
        keep[1:] = (cell[1:] != cell[:-1]) | (doc[1:] != doc[:-1])
        cell, doc = cell[keep], doc[keep]
        start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        size = np.diff(np.append(start, len(cell)))
        pairs = []
        for step in range(1, SMALL_BUCKET):
            reach = start[(size > step) & (size <= SMALL_BUCKET)]
            sizes = size[(size > step) & (size <= SMALL_BUCKET)]
            for place in range(SMALL_BUCKET - step):
                at = reach[sizes > place + step] + place
                if len(at):
                    pairs.append(np.stack((doc[at + step], doc[at]), axis=1))
        if pairs:
            pairs = np.unique(np.concatenate(pairs), axis=0)
            yield out([None] * len(pairs), pairs[:, 0], pairs[:, 1])
        large = np.repeat(size > SMALL_BUCKET, size)
        if large.any():
            yield out(cell[large], doc[large], [None] * int(large.sum()))

    held_cell, held_doc = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        cell = np.concatenate((held_cell, batch.column(0).to_numpy(zero_copy_only=False)))
        doc = np.concatenate((held_doc, batch.column(1).to_numpy(zero_copy_only=False)))
        if not len(cell):
            continue
        # The last bucket may go on in the next batch.
        whole = int(np.searchsorted(cell, cell[-1], side="left"))
        if whole:
            yield from work(cell[:whole], doc[:whole])
        held_cell, held_doc = cell[whole:].copy(), doc[whole:].copy()
    if len(held_cell):
        yield from work(held_cell, held_doc)


def _far(batches):
    """Pairs that size and bit sketches allow."""
    for batch in batches:
        a, b, x, y = (batch.column(i).to_pylist() for i in range(2, 6))
        keep = [4 * min(m, n) >= 3 * max(m, n) and distance(s, t) <= (m + n) // 7 for m, n, s, t in zip(a, b, x, y)]
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["u", "v"])


def _token_sets(size: int, name_bits: int, table: np.ndarray, doubled: frozenset[int]):
    """Token sets of the documents that a bit table may hold."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            known = bits.holds(table, ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64), PROBES)
            batch = batch.filter(pa.array(known & ids.is_valid().to_numpy(zero_copy_only=False)))
            ids = batch.column(0).to_pylist()
            rows: tuple[list, ...] = ([], [], [])
            for row, tokens in _sets(batch, size):
                for column, value in zip(rows, (ids[row], _node(tokens, name_bits, doubled), tokens.tobytes())):
                    column.append(value)
                if len(rows[0]) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], names=["doc", "rep", "tokens"])
                    rows = ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], names=["doc", "rep", "tokens"])
        release()

    return run


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted token sets have a Jaccard similarity of 3/4 or more."""
    both = np.sort(np.concatenate((x, y)))
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= 75 * (len(x) + len(y) - shared)


def _linked(batches):
    """Pairs whose token sets are similar."""
    for batch in batches:
        keep = [_similar(*(np.frombuffer(s.as_buffer(), dtype=U64) for s in pair)) for pair in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["u", "v"])


def _sets_of(near: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, name_bits: int, doubled: frozenset[int]) -> DataFrame:
    """(doc, tokens) of the nodes in some pairs: the texts are read once more, and only those that a bit table of the wanted
    keys may hold are cut into shingles."""
    ends = near.select(F.col("u").alias("rep")).unionByName(near.select(F.col("v").alias("rep"))).distinct()
    ends = stash(ends.join(nodes.select("rep", "doc"), "rep"), "ends")
    n_bits = bits.bits_for(ends.count(), 16, 1 << 26)
    table = near.sparkSession.sparkContext.broadcast(bits.fill(ends.select("doc"), n_bits, PROBES, 1)[0])

    def read(batches):
        yield from _token_sets(size, name_bits, table.value, doubled)(batches)

    sets = texts.mapInArrow(read, "doc long, rep long, tokens binary")
    # A row that repeats its key and set would only repeat its pairs.
    return stash(sets.join(ends, ["doc", "rep"]).select(F.col("rep").alias("doc"), "tokens"), "sets")


def _fine(batches):
    """(doc, n, sketch) of token sets, with eight bits a token or more."""
    for batch in batches:
        sets = [np.frombuffer(t.as_buffer(), dtype=U64) for t in batch.column(1)]
        sketches = [bit_sketch(t, 8) for t in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in sets], pa.int64()), pa.array(sketches, pa.binary())], names=["doc", "n", "sketch"])


def _ends(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns of either end: n_u, n_v, ..."""
    for x in "uv":
        pairs = pairs.join(table.select(F.col("doc").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns]), x)
    return pairs.select("u", "v", *[f"{c}_{x}" for c in columns for x in "uv"])


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that size, then bit sketches, allow."""
    table = nodes.select(F.col("rep").alias("doc"), "n", "sketch")
    sized = stash(_ends(pairs, table, "n").where("4 * least(n_u, n_v) >= 3 * greatest(n_u, n_v)").select("u", "v"), "sized")
    return stash(_ends(sized, table, "n", "sketch").mapInArrow(_far, "u long, v long"), "near")


def _verified(near: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, name_bits: int, doubled: frozenset[int]) -> DataFrame:
    """The pairs that are links: those that finer sketches of their sets allow too, compared in full."""
    sets = _sets_of(near, nodes, texts, size, name_bits, doubled)
    fine = sets.mapInArrow(_fine, "doc long, n long, sketch binary")
    near = stash(_ends(near, fine, "n", "sketch").mapInArrow(_far, "u long, v long"), "near")
    return stash(_ends(near, sets, "tokens").mapInArrow(_linked, "u long, v long"), "links")


def _with_bucket(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """Members joined with one row per bucket. They are dealt by salt, so a hot bucket spreads over several tasks."""
    salted = members.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    spread = buckets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, ["cell", "salt"]).drop("salt")


def _central_pairs(members: DataFrame) -> DataFrame:
    """Each member of a large bucket with the bucket's most central one: the member of most large buckets, which is the
    least changed of a group of near copies."""
    central = members.groupBy("doc").agg(F.count("*").alias("met"))
    chosen = members.join(central, "doc").groupBy("cell").agg(F.max(F.struct("met", "doc")).alias("rep"))
    met = _with_bucket(members, chosen).where("doc != rep.doc")
    return met.select(F.greatest("doc", "rep.doc").alias("u"), F.least("doc", "rep.doc").alias("v")).distinct()


def _mixed(members: DataFrame, links: DataFrame) -> DataFrame:
    """(cell, doc, component, main, members, inside) of the large buckets that hold several components; main is the largest
    of them and has `inside` of all `members`."""
    known = components(links).select(F.col("node").alias("doc"), "component")
    now = members.join(known, "doc", "left").select("cell", "doc", F.coalesce("component", "doc").alias("component"))
    sizes = now.groupBy("cell", "component").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "component"))
    several = sizes.groupBy("cell").agg(largest.alias("main"), F.sum("n").alias("members"), F.count("*").alias("parts")).where("parts > 1")
    several = several.select("cell", F.col("main.component").alias("main"), "members", F.col("main.n").alias("inside"))
    return _with_bucket(now, several).select("cell", "doc", "component", "main", "members", "inside")


def _compare(left: int, docs, parts, block, n, sketches) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unlike components that size and bit sketches allow: the members of block `left` against those of the other
    block, or against each other where there is no other."""
    u, v = [], []
    mine = block == left
    for i in np.flatnonzero(mine).tolist():
        fits = (docs > docs[i]) if mine.all() else ~mine
        fits &= (parts != parts[i]) & (4 * np.minimum(n, n[i]) >= 3 * np.maximum(n, n[i]))
        j = np.flatnonzero(fits)
        if len(j):
            j = j[np.bitwise_count(sketches[j] ^ sketches[i]).sum(axis=1, dtype=np.int64) <= (n[j] + n[i]) // 7]
            u.append(np.maximum(docs[j], docs[i]))
            v.append(np.minimum(docs[j], docs[i]))
    if not u:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(u), np.concatenate(v)


def _allowed(batches):
    """`_compare` for every pair of blocks, in rows that are sorted by cell and pair."""
    held: pa.Table | None = None

    def work(table: pa.Table):
        columns = {c: table[c].to_numpy() for c in ("cell", "at", "left", "doc", "component", "block", "n")}
        cell, at = columns["cell"], columns["at"]
        ends = np.flatnonzero(np.concatenate(((cell[1:] != cell[:-1]) | (at[1:] != at[:-1]), [True]))) + 1
        sketch = table["sketch"].combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(sketch.buffers()[1], dtype=np.int64)[sketch.offset : sketch.offset + len(sketch) + 1]
        data, width = np.frombuffer(sketch.buffers()[2], dtype=np.uint8), np.diff(offsets)
        found, start = [], 0
        for end in ends.tolist():
            part = slice(start, end)
            least = int(width[part].min())
            if width[part].max() == least:
                made = data[offsets[start] : offsets[end]].reshape(-1, least)
            else:
                made = np.stack([np.bitwise_xor.reduce(data[offsets[i] : offsets[i + 1]].reshape(-1, least), axis=0) for i in range(start, end)])
            found.append(_compare(columns["left"][start], *(columns[c][part] for c in ("doc", "component", "block", "n")), made.view(np.uint64)))
            start = end
        u, v = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        pairs = np.unique(np.stack((u, v), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not len(table):
            continue
        cell, at = table["cell"].to_numpy(), table["at"].to_numpy()
        # The last pair may go on in the next batch.
        last = np.flatnonzero((cell != cell[-1]) | (at != at[-1]))
        whole = int(last[-1]) + 1 if len(last) else 0
        if whole:
            yield work(table.slice(0, whole))
        held = table.slice(whole)
    if held is not None and len(held):
        yield work(held)


def _dealt(mixed: DataFrame) -> DataFrame:
    """(cell, doc, component, block, left, at) of mixed buckets. Members outside the main component are dealt to blocks of
    about BLOCK members, the others to blocks numbered after those. Each pair of blocks of which one is outside, a
    block with itself included, is a group `at`, whose lower block is `left`; so no group holds more than two blocks."""
    outside = F.col("component") != F.col("main")
    outer = F.floor((F.col("members") - F.col("inside")) / BLOCK).cast("int") + 1
    inner = F.floor(F.col("inside") / BLOCK).cast("int") + 1
    placed = mixed.withColumns({"outside": outside, "outer": outer, "inner": inner})
    spot = F.pmod(F.xxhash64("doc", F.lit(1)), F.when(F.col("outside"), F.col("outer")).otherwise(F.col("inner"))).cast("int")
    placed = placed.withColumn("block", F.when(F.col("outside"), spot).otherwise(spot + F.col("outer")))
    others = F.sequence(F.lit(0), F.when(F.col("outside"), F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1)
    met = placed.select("cell", "doc", "component", "block", "outer", "inner", F.explode(others).alias("other"))
    left, right = F.least("block", "other"), F.greatest("block", "other")
    at = left.cast("long") * (F.col("outer") + F.col("inner")) + right
    return met.select("cell", "doc", "component", "block", left.alias("left"), at.alias("at"))


def _block_pairs(mixed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidates between the components of mixed buckets."""
    dealt = _dealt(mixed).join(nodes.select(F.col("rep").alias("doc"), "n", "sketch"), "doc")
    dealt = dealt.repartition("cell", "at").sortWithinPartitions("cell", "at")
    return stash(dealt.mapInArrow(_allowed, "u long, v long").distinct(), "near")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, name_bits: int = NAME_BITS) -> DataFrame:
    """(key, n_shingles, component_id) of every row: A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`, sets of distinct shingles
    of `size` words, links at a Jaccard similarity of 3/4 or more, component_id the smallest key reached by links.

    The key is an integer. Null or empty texts and texts without words have no shingles and link with nothing; a text
    of fewer words than a shingle is one shingle. Equal sets always link. Rows that repeat a key count as one document
    (their links are joined); every row is returned. Rows without a key get their n_shingles, and component_id null.
    An empty table gives an empty result. Other columns are not looked at."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    schema = "doc long, n long, one long, two long, sketch binary, cell boolean"
    first = stash(texts.mapInArrow(_summaries(size, name_bits), schema), "summaries")
    rows = first.where("not cell").select("doc", "n", "one", "two", "sketch")
    least = F.greatest(F.lit(32), F.lit(rows.count() // 5000))
    top = first.where("cell").groupBy("one").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    top = top.orderBy(F.desc("n"), "one").limit(FREQUENT_CELLS).collect()
    frequent = np.array([r["one"] for r in top], dtype=np.int64).view(U64)
    order = np.argsort(frequent)

    usable = rows.where("doc is not null and n > 0")
    # One row of each set; its key is where the set is read again.
    sets = stash(usable.dropDuplicates(["one", "two"]), "sets")
    # Unlike sets of one first name: of 2**32 sets one pair on average.
    twice = sets.groupBy("one").agg(F.count("*").alias("sets")).where("sets > 1")
    doubled = frozenset(r["one"] for r in twice.select("one").collect())
    node = F.col("one")
    if doubled:
        node = F.when(F.col("one").isin(list(doubled)), F.col("one").bitwiseXOR(F.col("two"))).otherwise(F.col("one"))
    nodes = sets.select(node.alias("rep"), "doc", "n", "sketch")
    named = stash(usable.select("doc", node.alias("rep")).distinct(), "named")

    shared = spark.sparkContext.broadcast((frequent[order], np.array([r["n"] for r in top], dtype=np.int64)[order], doubled))

    def send(batches):
        yield from _sender(size, name_bits, *shared.value)(batches)

    met = texts.mapInArrow(send, "cell long, doc long").repartition("cell").sortWithinPartitions("cell", "doc")
    met = stash(met.mapInArrow(_buckets, "cell long, u long, v long"), "met")
    pairs = met.where("cell is null").select("u", "v").distinct()
    members = stash(met.where("cell is not null").select("cell", F.col("u").alias("doc")), "members")

    # Keys that came with several texts join the sets of those texts.
    least = named.groupBy("doc").agg(F.min("rep").alias("v"), F.max("rep").alias("most")).where("v != most")
    links = named.join(least, "doc").select(F.col("rep").alias("u"), "v").where("u != v")
    asked = pairs.unionByName(_central_pairs(members)).distinct()
    links = links.unionByName(_verified(_near(asked, nodes), nodes, texts, size, name_bits, doubled))
    mixed = stash(_mixed(members, links), "mixed")
    if not mixed.isEmpty():
        near = _block_pairs(mixed, nodes)
        if not near.isEmpty():
            links = links.unionByName(_verified(near, nodes, texts, size, name_bits, doubled))

    found = components(links).toDF("rep", "component")
    keyed = named.groupBy("rep").agg(F.min("doc").alias("doc")).join(found, "rep", "left")
    keyed = stash(keyed.select("rep", "doc", F.coalesce("component", "rep").alias("component")), "keyed")
    labels = keyed.select("rep", "component").join(keyed.groupBy("component").agg(F.min("doc").alias("id")), "component")
    # All sets of a key are in one component.
    labels = named.join(labels, "rep").groupBy("doc").agg(F.min("id").alias("component"))
    whole = rows.join(labels, "doc", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return whole.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
