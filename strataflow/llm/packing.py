"""Best-fit packing of documents into bins of equal capacity under conflicts.

Documents are cut into pieces of at most the capacity. Pieces are dealt to shards of bounded size by a hash, and each
shard packs its own, longest first. Its open bins are ordered by residual room; each bin carries bitmaps of the sources
and of the clusters of copies in it. A piece goes to the tightest bin that can take it: the search starts at the first
bin with enough room and moves to the successor until no bitmap conflicts; if none is left, it opens a bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.exact_dedup import normalised
from strataflow.llm.shared import stash

#: Words per bin, documents of one source per bin, pieces per shard.
CAPACITY, PER_SOURCE, SHARD = 2048, 2, 4096
RESULT = "doc_id long, piece int, n_words long, bin_id long, position int, start long"


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`; null has none."""
    plain = F.trim(normalised(text))
    gaps = F.length(plain) - F.length(F.translate(plain, " ", ""))
    # No branch, so that Spark evaluates the normalised text once for all that is made of it.
    return (gaps + (plain != "").cast("int")).cast("long")


def best_fit(pieces: list[tuple], capacity: int, per_source: int) -> list[tuple[int, int, int]]:
    """(bin, position, start) of each piece (length, source, cluster), longest first. None as source or cluster
    conflicts with nothing."""
    source_bit: dict = {}
    cluster_bit: dict = {}
    bins: list[tuple[int, int]] = []  # (residual room, bin), ordered
    rooms: list[list] = []  # of each bin: one source bitmap per document allowed, then the cluster bitmap
    held: list[int] = []
    out: list = [None] * len(pieces)
    for at in sorted(range(len(pieces)), key=lambda i: (-pieces[i][0], i)):
        length, source, cluster = pieces[at]
        s = 0 if source is None else 1 << source_bit.setdefault(source, len(source_bit))
        c = 0 if cluster is None else 1 << cluster_bit.setdefault(cluster, len(cluster_bit))
        spot = bisect_left(bins, (length, -1))
        while spot < len(bins):
            maps = rooms[bins[spot][1]]
            if not (maps[per_source - 1] & s or maps[-1] & c):
                break
            spot += 1
        if spot < len(bins):
            room, which = bins.pop(spot)
        else:
            room, which = capacity, len(rooms)
            rooms.append([0] * (per_source + 1))
            held.append(0)
        maps = rooms[which]
        out[at] = (which, held[which], capacity - room)
        held[which] += 1
        for i in range(per_source):  # the first bitmap that lacks the source takes it
            if not maps[i] & s:
                maps[i] |= s
                break
        maps[-1] |= c
        insort(bins, (room - length, which))
    return out


def pack(docs: DataFrame, length: Column, cluster: Column, key: str = "doc_id", source: str = "source", capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD) -> DataFrame:
    """One row per piece: key, piece (0, 1, ...), n_words (its length), bin_id, position in the bin, start (room used
    before it). A bin holds at most `capacity`, at most `per_source` documents of a source and one of a cluster.

    A document longer than the capacity is cut into full pieces and a rest, so pieces of one document never share a
    bin. Documents of length 0 make one piece that takes no room. A null source or cluster conflicts with nothing; a
    null key is kept as it is. Repeated rows are packed each. Longest first, ties in order of key and piece. An empty
    table gives an empty result; other columns are not looked at."""
    sized = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), cluster.alias("cluster"), F.coalesce(length, F.lit(0)).cast("long").alias("n"))
    sized = stash(sized, "sized")
    last = F.greatest(F.floor((F.col("n") - 1) / capacity), F.lit(0)).cast("int")
    cut = sized.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    cut = cut.withColumn("n_words", F.least(F.lit(capacity), F.col("n") - F.col("piece").cast("long") * capacity))
    shards = -(-(sized.agg(F.sum(last + 1)).first()[0] or 1) // shard)
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "source", "n"), F.lit(shards)))

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        found = best_fit(list(zip(table["n_words"].to_pylist(), table["source"].to_pylist(), table["cluster"].to_pylist())), capacity, per_source)
        base = table["shard"][0].as_py() << 32
        return pa.table({
            "doc_id": table["doc_id"],
            "piece": table["piece"],
            "n_words": table["n_words"],
            "bin_id": pa.array([base + f[0] for f in found], pa.int64()),
            "position": pa.array([f[1] for f in found], pa.int32()),
            "start": pa.array([f[2] for f in found], pa.int64()),
        })

    done = cut.select("doc_id", "source", "cluster", "piece", "n_words", "shard").groupBy("shard").applyInArrow(packed, RESULT)
    return done.withColumnRenamed("doc_id", key)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """Documents packed by their words; texts equal but for white space are a cluster of copies."""
    copies = F.nullif(F.xxhash64(F.trim(normalised(F.col("text")))), F.xxhash64(F.lit("")))
    return pack(docs, word_count(F.col("text")), copies, capacity=capacity, per_source=per_source)
