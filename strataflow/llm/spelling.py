"""Spelling variants by asymmetric q-chunks.

Of two words that differ by one edit, the shorter one (of equal lengths, the first in code-point order) is cut into two
disjoint chunks. One edit touches at most one chunk, so the other word holds the other chunk as a positional gram, within
shift one of its place: at the same place where the edit lies behind it, one further where a code point was inserted
before it. What is left of both words beside the chunk is again at most one edit apart and is cut once more in the same
way. Words that share such a key agree in three quarters of their code points, so a frequent chunk makes no large group.
Pairs that meet are verified by their edit distance.

All tables here grow with the vocabulary, and Spark sizes them too low: keys, of which a word has up to twenty, by the rows
before they are exploded, and tables that were stored by their compressed files. So joins ask for sorting and merging, and
nothing is sent to the driver to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.shared import stash

#: A word is a maximal run of these.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def without(word: Column, place: Column) -> Column:
    """The word without the code point at a place, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.char_length(word)))


def corpus_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, garbled: int | None = None) -> DataFrame:
    """(word, n): every distinct word of at least `least_length` code points with its occurrences in all texts, if those
    are at least `least_count`. Words are maximal runs of letters, A-Z lower-cased. With `garbled`, an occurrence loses
    a code point where its checksum, the unsigned crc32 of `<key>:<word>`, is divisible by that number: the one at
    checksum modulo length. It then counts as what is left of it. Null and empty texts have no words; a null key counts
    as an empty one; repeated rows count each; an empty table gives an empty result; other columns are not looked at."""
    found = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("owner"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))).alias("run"),
    ).select("owner", lowered(F.col("run")).alias("run"))
    if garbled is None:
        said = found.select(F.col("run").alias("word"))
    else:
        marked = found.withColumn("h", F.crc32(F.concat_ws(":", "owner", "run").cast("binary")))
        cut = without(F.col("run"), (F.col("h") % F.char_length("run")).cast("int"))
        said = marked.select(F.when(F.col("h") % garbled == 0, cut).otherwise(F.col("run")).alias("word"))
        said = said.where(F.char_length("word") >= least_length)
    return said.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _cut(rows: DataFrame, level: int, roles: str) -> DataFrame:
    """Each row once per chunk, with the chunk, and what remains of `rest` beside it. `size` is the length of what the
    chunk word is cut from; words in the role of grams have also the shift at which their gram starts."""
    half = F.floor(F.col("size") / 2).cast("int")
    rows = rows.withColumn("which", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("half", half)
    shift = F.lit(0)
    if roles == "grams":
        # The gram word is as long as the chunk word (no shift) or longer by one (no shift, or one).
        rows = rows.withColumn("shift", F.explode(F.sequence(F.lit(0), F.col("longer"))))
        shift = F.col("shift")
    begin = F.when(F.col("which") == 0, F.lit(0)).otherwise(F.col("half")) + shift
    length = F.when(F.col("which") == 0, F.col("half")).otherwise(F.col("size") - F.col("half"))
    rows = rows.withColumn("begin", begin).withColumn("length", length)
    kept = F.concat(F.substring("rest", F.lit(1), F.col("begin")), F.substring(F.col("rest"), F.col("begin") + F.col("length") + 1, F.char_length("rest")))
    return rows.select(
        *[c for c in rows.columns if c not in ("rest", "size", "which", "half", "shift", "begin", "length")],
        F.col("which").alias(f"which{level}"),
        F.substring(F.col("rest"), F.col("begin") + 1, F.col("length")).alias(f"chunk{level}"),
        kept.alias("rest"),
        (F.col("size") - F.col("length")).alias("size"),
    )


def _keyed(rows: DataFrame, roles: str) -> DataFrame:
    """(k, word, n) of each word and key: two levels of chunks, hashed to 64 bits."""
    start = rows.withColumn("rest", F.col("word")).withColumn("of", F.col("size"))
    cut = _cut(_cut(start, 1, roles), 2, roles)
    return cut.select(F.xxhash64("of", "which1", "chunk1", "which2", "chunk2").alias("k"), "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every pair of words of `words` (word, n; distinct words) that differ by exactly one inserted,
    deleted or replaced code point, once, the shorter first, of equal lengths the first in code-point order. Null words
    are near to nothing."""
    sized = words.where("word is not null").select("word", "n", F.char_length("word").alias("size"))
    chunks = _keyed(sized, "chunks").select("k", F.col("word").alias("a"), F.col("n").alias("n_a"))
    # A word gives grams for chunk words of its own length and for those shorter by one.
    grams = sized.withColumn("longer", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("size", F.col("size") - F.col("longer"))
    grams = _keyed(grams.where("size > 0"), "grams").select("k", F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = chunks.join(grams.hint("merge"), (chunks["k"] == grams["k"]) & ((F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: the last that is reached by following forms. Forms are much more
    frequent than their words, so chains are short; each round doubles the steps taken."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next")).hint("merge")
        if now.join(ahead, "root", "left_semi").isEmpty():
            return now
        now = stash(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `words` (word, n; distinct words). A word's form is its near
    word with the largest n (ties: the smallest in code-point order) if that is at least `ratio` times the word's own n,
    else null; root is the last word reached by following forms, the word itself without a form; n_near counts near
    words. An empty table gives an empty result."""
    words = stash(words.select("word", "n"), "words")
    pairs = stash(near_words(words), "near")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n"))
    )
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other").alias("other"))).alias("best"))
    told = words.join(best.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.col1")).alias("other_n"))
    fits = F.col("other_n") >= ratio * F.col("n")
    told = stash(told.select("word", "n", "n_near", F.when(fits, F.col("other")).alias("form"), F.when(fits, F.col("other_n")).alias("form_n")), "forms")
    roots = _roots(told.where("form is not null"))
    return told.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
