"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a bag of words `[^\\x20\\x09-\\x0D]+`, weighted by how often they occur. Every word gets gamma-based random values
from its hash and the number of the sample: r and c from Gamma(2, 1), b uniform. Spark's logarithms would take most of
the time, so r and ln c come from 20 bits of the hash by quantile tables: 1,023 linear pieces, and 1,024 steps in the end
without bound. With weight w, t = floor(ln w / r + b),
ln y = r (t - b) and ln a = ln c - ln y - r; the word of the whole text with the smallest a is sampled together with t.
Two texts then draw the same (word, t) with a probability equal to their generalised Jaccard similarity, sum of min / sum
of max weights, in each of SAMPLES independent samples.

A fingerprint lists its samples in order, six hexadecimal digits each: the number of the sample, then 16 bits of what was
drawn. Likeness is the share of equal samples; two texts without words are alike (1.0).
"""

from __future__ import annotations

import hashlib
import struct
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.shared import stash

SAMPLES = 64
#: Samples that are drawn side by side in one row; a word has SAMPLES / ABREAST rows.
ABREAST = 2
#: Cells of the quantile tables: a power of two. Plans hold the tables, and so do the driver's texts of plans.
CELL_BITS = 10
CELLS = 1 << CELL_BITS
#: Characters of text per partition while words are counted.
PARTITION_CHARS = 6_000_000


def _gamma_quantile(p: np.ndarray) -> np.ndarray:
    """The x below which Gamma(2, 1) lies with probability p, so 1 - (1 + x) exp(-x) = p, by bisection."""
    low, high = np.zeros_like(p), np.full_like(p, 60.0)
    for _ in range(80):
        middle = (low + high) / 2
        under = -np.expm1(-middle) - middle * np.exp(-middle) < p
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return (low + high) / 2


class _Quantiles:
    """A function of Gamma(2, 1) drawn from 20 bits of a hash without a logarithm: its values at CELLS quantiles, linear
    between them; the cell at the end where it has no bound holds CELLS values more."""

    def __init__(self, function, end: int):
        edges = function(_gamma_quantile(np.clip(np.arange(CELLS + 1) / CELLS, 1e-12, 1 - 1e-12)))
        fine = (np.arange(CELLS) + 0.5) / CELLS / CELLS
        tail = function(_gamma_quantile(end / CELLS + fine))
        self.end = end
        self.base, self.slope, self.tail = (self._literal(v) for v in (edges[:-1], np.diff(edges) / CELLS, tail))

    @staticmethod
    def _literal(values: np.ndarray) -> str:
        return ",".join(f"{v:.7g}" for v in values)

    def draw(self, hashed: Column, at: int) -> Column:
        # Spark folds each text of numbers to one constant array.
        base, slope, tail = (F.split(F.lit(v), ",").cast("array<double>") for v in (self.base, self.slope, self.tail))
        cell, rest = _bits(hashed, at, CELL_BITS).cast("int"), _bits(hashed, at + CELL_BITS, CELL_BITS).cast("int")
        return F.when(cell == self.end, F.get(tail, rest)).otherwise(F.get(base, cell) + rest * F.get(slope, cell))


@cache
def _gammas() -> tuple[_Quantiles, _Quantiles]:
    """Draws of r, and of ln c."""
    return _Quantiles(lambda x: x, CELLS - 1), _Quantiles(np.log, 0)


def _bits(hashed: Column, at: int, n: int) -> Column:
    return F.shiftrightunsigned(hashed, at).bitwiseAND(F.lit((1 << n) - 1))


def _salts(sample: int) -> tuple[int, int]:
    """Two 64-bit numbers that name a sample."""
    digest = hashlib.blake2b(f"sample {sample}".encode(), digest_size=16).digest()
    return struct.unpack("<qq", digest)


def _draws(term: Column, salts: tuple[Column, Column], log_weights: list[Column]) -> list[Column]:
    """What a word, named by its hash, offers to a sample under each of some weights (null where the word is missing): the
    smallest value of a text holds its sample in the low 16 bits; the high bits order by a."""
    one, two = F.xxhash64(term.bitwiseXOR(salts[0])), F.xxhash64(term.bitwiseXOR(salts[1]))
    gamma, log_gamma = _gammas()
    r, log_c = gamma.draw(one, 0), log_gamma.draw(one, 2 * CELL_BITS)
    b, drawn = (_bits(two, 0, 32) + 1) / float(1 << 32), []
    # 16 bits of the word that nothing above uses; t tells its own samples apart.
    name = F.shiftrightunsigned(two, 48)
    for log_weight in log_weights:
        # Nothing here is conditional, so that Spark finds r, b and ln c once for all weights. A null weight gives null.
        t = F.floor(log_weight / r + b)
        # ln a lies between -100 and 30 for weights up to 2**31.
        order = ((log_c - r * (t - b + 1) + 128) * float(1 << 36)).cast("long")
        drawn.append(F.shiftleft(order, 16).bitwiseOR(name.bitwiseXOR(t).bitwiseAND(F.lit(0xFFFF))))
    return drawn


def signatures(texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, a signature for each text column, by its name) of rows that are dealt by one or more of the keys already; the
    keys name a row. A text without words has a null or no row. signature: ascending ints, sample << 16 | what it drew."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("version"), F.col(c).alias("text")) for i, c in enumerate(columns)]))
    made = texts.select(*keys, each.alias("v")).select(*keys, "v.version", F.explode(F.split("v.text", r"[\x20\x09-\x0D]+")).alias("word"))
    made = made.where("word != ''").select(*keys, F.xxhash64("word").alias("term"), "version")
    counted = made.groupBy(*keys, "term").agg(*[F.count(F.when(F.col("version") == i, 1)).alias(f"n{i}") for i in range(len(columns))])
    # The logarithm of no occurrence is null.
    weighed = counted.select(*keys, "term", *[F.log(F.col(f"n{i}").cast("double")).alias(f"w{i}") for i in range(len(columns))])
    groups = [[F.lit(k).alias("first"), *[F.lit(v).alias(f"salt{j}_{at}") for j in range(ABREAST) for at, v in enumerate(_salts(k + j))]] for k in range(0, SAMPLES, ABREAST)]
    dealt = weighed.select("*", F.inline(F.array(*[F.struct(*g) for g in groups])))
    drawn = []
    for j in range(ABREAST):
        values = _draws(F.col("term"), (F.col(f"salt{j}_0"), F.col(f"salt{j}_1")), [F.col(f"w{i}") for i in range(len(columns))])
        drawn += [F.min(v).alias(f"s{i}_{j}") for i, v in enumerate(values)]
    least = dealt.groupBy(*keys, "first").agg(*drawn)

    def kept(i: int) -> Column:
        values = [F.shiftleft(F.col("first") + j, 16).bitwiseOR(F.col(f"s{i}_{j}").bitwiseAND(F.lit(0xFFFF)).cast("int")) for j in range(ABREAST)]
        return F.when(F.col(f"s{i}_0").isNotNull(), F.array(*values))

    # Rows of a text without words are null, which is not collected.
    gathered = least.groupBy(*keys).agg(*[F.sort_array(F.flatten(F.collect_list(kept(i)))).alias(c) for i, c in enumerate(columns)])
    return gathered.select(*keys, *[F.when(F.size(c) > 0, F.col(c)).alias(c) for c in columns])


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples of two signatures; null counts as a text without words."""
    a, b = (F.coalesce(x, F.array().cast("array<int>")) for x in (a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.size(F.array_intersect(a, b)) / float(SAMPLES))


def shown(signature: Column) -> Column:
    parts = F.transform(F.coalesce(signature, F.array().cast("array<int>")), lambda x: F.lpad(F.lower(F.hex(x)), 6, "0"))
    return F.array_join(parts, "")


def _order(names: DataFrame) -> DataFrame:
    """Names of documents (doc, twin, n_chars) with the document before and after, in ascending order, ends joined. Ranges
    of the order are numbered on their own; their ends meet in a table of one row per range."""
    ranged = stash(names.repartitionByRange("doc", "twin").withColumn("range", F.spark_partition_id()), "order")
    me = F.struct("doc", "twin", "n_chars")
    inside = Window.partitionBy("range").orderBy("doc", "twin")
    across = Window.orderBy("range")
    ends = ranged.groupBy("range").agg(F.min(me).alias("first"), F.max(me).alias("last"))
    whole = ends.agg(F.min("first").alias("lowest"), F.max("last").alias("highest")).first()
    if whole is None or whole["lowest"] is None:
        lowest = highest = F.lit(None).cast("struct<doc: bigint, twin: bigint, n_chars: int>")
    else:
        lowest, highest = (F.struct(*[F.lit(v).cast(t).alias(k) for (k, v), t in zip(whole[x].asDict().items(), ("long", "long", "int"))]) for x in ("lowest", "highest"))
    ends = ends.select("range", F.coalesce(F.lag("last").over(across), highest).alias("before_range"), F.coalesce(F.lead("first").over(across), lowest).alias("after_range"))
    placed = ranged.select("*", F.lag(me).over(inside).alias("before"), F.lead(me).over(inside).alias("after"))
    return placed.join(ends, "range").select(
        "doc", "twin", "n_chars", F.coalesce("before", "before_range").alias("before"), F.coalesce("after", "after_range").alias("after")
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row. The edited text
    replaces the last n_chars // 2 code points by the first as many (or all) of the next document's text, in ascending
    order of the key; the first follows the last.

    Null texts count as empty. Rows without a key come first in the order. Rows that repeat a key are ordered by a hash of
    their texts; rows that repeat key and text are one document in the order and are returned each. A single document
    follows itself. An empty table gives an empty result; other columns are not looked at."""
    plain = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    plain = plain.withColumn("twin", F.xxhash64("text"))
    names = plain.select("doc", "twin", F.length("text").alias("n_chars")).distinct()
    order = stash(_order(names), "order")
    chars = order.agg(F.sum(F.col("n_chars").cast("long"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), chars // PARTITION_CHARS)

    # One exchange brings each text to its key, one more the part of it that the document before needs.
    named = F.coalesce(F.col("doc"), F.lit(0)).alias("at")
    dealt = plain.select(named, F.col("doc").isNull().alias("no_key"), "twin", "text").repartition(parts, "at", "no_key", "twin")
    held = dealt.groupBy("at", "no_key", "twin").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    places = order.select(named, F.col("doc").isNull().alias("no_key"), "twin", "n_chars", "before", "after").repartition(parts, "at", "no_key", "twin")
    held = held.join(places, ["at", "no_key", "twin"])
    gift = held.select(
        F.coalesce("before.doc", F.lit(0)).alias("at"), F.col("before.doc").isNull().alias("no_key"), F.col("before.twin").alias("twin"),
        F.substring("text", F.lit(1), F.floor(F.col("before.n_chars") / 2).cast("int")).alias("tail"),
    ).repartition(parts, "at", "no_key", "twin")
    kept = F.substring("text", F.lit(1), F.col("n_chars") - F.floor(F.col("n_chars") / 2).cast("int"))
    both = held.join(gift, ["at", "no_key", "twin"]).withColumn("edited", F.concat(kept, "tail"))

    keys = ["at", "no_key", "twin"]
    signed = signatures(both.select(*keys, F.col("text").alias("own"), F.col("edited").alias("other")), keys, ["own", "other"])
    facts = both.select(*keys, "n_chars", "copies", "after", F.sha2("edited", 256).alias("edited_sha256"))
    whole = stash(facts.join(signed, keys, "left"), "signatures")
    following = whole.select(F.col("at").alias("at_"), F.col("no_key").alias("no_key_"), F.col("twin").alias("twin_"), F.col("own").alias("next_own"))
    met = whole.join(
        following,
        (F.coalesce("after.doc", F.lit(0)) == F.col("at_")) & (F.col("after.doc").isNull() == F.col("no_key_")) & (F.col("after.twin") == F.col("twin_")),
        "left",
    )
    each = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        F.when(~F.col("no_key"), F.col("at")).alias(key),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        shown(F.col("own")).alias("fingerprint"),
        shown(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
