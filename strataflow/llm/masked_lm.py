"""Documents scored by masked pseudo-likelihood.

A small network predicts every token from the two tokens on either side: each offset has its own embeddings, their sum
goes through tanh, and a two-step softmax gives the class of the token and the token within its class. A document's
score is the sum of the conditional log-probabilities of all its tokens.

Tokens are words: the most frequent words of the corpus have ids of their own, all others share hashed ids. The
probability of such a word is that of its id times the word's share of all occurrences under the id. Word counts cover all
documents and stay in a Spark table; the shares of the KNOWN next most frequent words are sent to tasks, those of all
others are joined to the documents' words. Training is data-parallel numpy: in each round every task trains on its documents from the current
weights, and the weights of all tasks are averaged by the number of positions they trained on.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.shared import stash
from strataflow.llm.text import NO_LETTER, U64, buffers, slices, words

CLASSES, PER_CLASS, HIDDEN, WINDOW = 32, 32, 32, 2
TOKENS = CLASSES * PER_CLASS
#: Ids for words outside the vocabulary.
HASHED = 256
OFFSETS = tuple(o for o in range(-WINDOW, WINDOW + 1) if o)
#: Words under hashed ids whose shares are broadcast (16 bytes each); a bound without influence on results.
KNOWN = 50_000
#: Every position of every document is a training target in one of the rounds.
ROUNDS, BATCH, RATE = 2, 4096, 0.12
#: Rows that are worked on at once.
ROWS = 1024
#: Weights are averaged in slices of this many numbers.
SLICE = 16_384
SHAPES = {
    "embedding": (len(OFFSETS), TOKENS + 1, HIDDEN),
    "bias": (HIDDEN,),
    "to_class": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "to_token": (CLASSES, HIDDEN, PER_CLASS),
    "token_bias": (CLASSES, PER_CLASS),
}


class Lookup:
    """Places in sorted hashes: the leading bits tell where to begin, a few steps lead on. Hashes are spread evenly, so few
    share their leading bits."""

    def __init__(self, hashes: np.ndarray):
        bits = max(len(hashes), 1).bit_length() + 2
        self.hashes, self.shift = hashes, U64(64 - bits)
        heads = (hashes >> self.shift).astype(np.int64)
        self.begins = np.searchsorted(heads, np.arange(1 << bits)).astype(np.int32)
        self.steps = int(np.bincount(heads, minlength=1).max()) - 1

    def find(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a hash is held, its place or any other)."""
        last = len(self.hashes) - 1
        at = np.minimum(np.take(self.begins, (found >> self.shift).astype(np.int64)), last)
        for _ in range(self.steps):
            at += np.take(self.hashes, at) < found
            np.minimum(at, last, out=at)
        return np.take(self.hashes, at) == found, at


@dataclass(frozen=True)
class Vocabulary:
    hashes: np.ndarray  # sorted word hashes
    ids: np.ndarray  # their ids, by falling frequency

    @cached_property
    def lookup(self) -> Lookup:
        return Lookup(self.hashes)

    def encode(self, found: np.ndarray) -> np.ndarray:
        other = (TOKENS - HASHED + (found >> U64(20)) % U64(HASHED)).astype(np.int32)
        if not len(self.hashes):
            return other
        held, at = self.lookup.find(found)
        return np.where(held, self.ids[at], other)


def first_weights() -> dict[str, np.ndarray]:
    random = np.random.default_rng(11)
    return {name: (random.standard_normal(shape) * (0 if "bias" in name else 0.08)).astype(np.float32) for name, shape in SHAPES.items()}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in SHAPES])


def unflat(numbers: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = numbers[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def _hidden(w: dict, context: np.ndarray) -> np.ndarray:
    # Ids are in range; told so, numpy takes rows without a copy of its own.
    total = np.take(w["embedding"][0], context[:, 0], axis=0, mode="clip")
    part = np.empty_like(total)
    for o in range(1, len(OFFSETS)):
        total += np.take(w["embedding"][o], context[:, o], axis=0, mode="clip", out=part)
    total += w["bias"]
    return np.tanh(total, out=total)


def _bounded(to: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no logit can be too large or too small for its exponential: what is hidden lies between -1 and 1."""
    return bool((np.abs(to).sum(axis=-2) + np.abs(bias)).max() < 40)


def _lowered(logits: np.ndarray, bounded: bool) -> np.ndarray:
    """The logits, brought down by the largest of each row where they may be large."""
    if not bounded:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _exponentials(logits: np.ndarray) -> np.ndarray:
    """The sum of the exponentials of each row; these take the place of the logits."""
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], dtype=logits.dtype)


def _token_logits(w: dict, h: np.ndarray, spans: list[tuple[int, slice]]) -> np.ndarray:
    """The logits of the tokens in the class of each row; rows are sorted by class."""
    logits = np.empty((len(h), PER_CLASS), dtype=h.dtype)
    for k, s in spans:
        np.matmul(h[s], w["to_token"][k], out=logits[s])
        logits[s] += w["token_bias"][k]
    return logits


def _class_spans(group: np.ndarray) -> list[tuple[int, slice]]:
    """(class, its rows) of rows that are sorted by class."""
    cuts = np.searchsorted(group, np.arange(CLASSES + 1)).tolist()
    return [(k, slice(cuts[k], cuts[k + 1])) for k in range(CLASSES) if cuts[k] < cuts[k + 1]]


def log_probabilities(w: dict, target: np.ndarray, context: np.ndarray) -> np.ndarray:
    """The log-probability of each target token given its context."""
    out = np.empty(len(target), dtype=np.float64)
    order = np.argsort((target // PER_CLASS).astype(np.int16), kind="stable")
    bounded = _bounded(w["to_class"], w["class_bias"]), _bounded(w["to_token"], w["token_bias"])
    for a in range(0, len(order), ROWS):
        rows = order[a : a + ROWS]
        t, h = target[rows], _hidden(w, context[rows])
        group, i = t // PER_CLASS, np.arange(len(t))
        logits = _lowered(h @ w["to_class"] + w["class_bias"], bounded[0])
        result = logits[i, group]
        result -= np.log(_exponentials(logits))
        logits = _lowered(_token_logits(w, h, _class_spans(group)), bounded[1])
        result += logits[i, t % PER_CLASS]
        result -= np.log(_exponentials(logits))
        out[rows] = result
    return out


def train_step(w: dict, state: dict, target: np.ndarray, context: np.ndarray) -> None:
    """One Adagrad step on the mean negative log-probability, in place."""
    order = np.argsort((target // PER_CLASS).astype(np.int16), kind="stable")
    target, context = target[order], context[order]
    n = len(target)
    change = {k: np.zeros_like(v) for k, v in w.items() if k != "embedding"}
    back = np.empty((n, HIDDEN), dtype=w["bias"].dtype)
    bounded = _bounded(w["to_class"], w["class_bias"]), _bounded(w["to_token"], w["token_bias"])
    # In parts that stay in the cache of a core.
    for a in range(0, n, ROWS):
        part = slice(a, min(a + ROWS, n))
        t, h, behind = target[part], _hidden(w, context[part]), back[part]
        group, i = t // PER_CLASS, np.arange(len(t))
        error = h @ w["to_class"]
        error += w["class_bias"]
        error /= _exponentials(_lowered(error, bounded[0]))[:, None]
        error[i, group] -= 1
        np.matmul(error, w["to_class"].T, out=behind)
        change["to_class"] += h.T @ error
        change["class_bias"] += error.sum(axis=0)
        spans = _class_spans(group)
        error = _lowered(_token_logits(w, h, spans), bounded[1])
        error /= _exponentials(error)[:, None]
        error[i, t % PER_CLASS] -= 1
        for k, s in spans:
            behind[s] += error[s] @ w["to_token"][k].T
            change["to_token"][k] += h[s].T @ error[s]
            change["token_bias"][k] += error[s].sum(axis=0)
        h *= h
        behind *= np.subtract(1, h, out=h)
    back /= n
    change["bias"] = back.sum(axis=0)
    for name, gradient in change.items():
        if name != "bias":
            gradient /= n
        state[name] += gradient * gradient
        w[name] -= RATE * gradient / (np.sqrt(state[name]) + 1e-6)
    pairs = back.view(np.result_type(back, np.complex64))
    for o in range(len(OFFSETS)):
        # Numbers of 16 bits are sorted by radix.
        ids = context[:, o].astype(np.int16)
        by = np.argsort(ids, kind="stable")
        ids = ids[by]
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        # Two numbers are added at once, as one complex number.
        sums = np.add.reduceat(np.take(pairs, by, axis=0, mode="clip"), starts, axis=0)
        gradient, touched = sums.view(back.dtype), ids[starts]
        held = np.take(state["embedding"][o], touched, axis=0)
        held += gradient * gradient
        state["embedding"][o][touched] = held
        np.sqrt(held, out=held)
        held += 1e-6
        gradient *= RATE
        gradient /= held
        w["embedding"][o][touched] -= gradient


def _token_slices(texts: pa.Array, vocabulary: Vocabulary):
    """(first text, text of each token, place in the text, token, context) of slices of a column of texts."""
    for first, of, place, token, context, _ in _word_slices(texts, vocabulary):
        yield first, of, place, token, context


def _word_slices(texts: pa.Array, vocabulary: Vocabulary):
    """_token_slices with the hash of each word."""
    data, offsets = buffers(texts)
    for first, last in slices(offsets):
        part = offsets[first : last + 1]
        found, at = words(data[part[0] : part[-1]], part - part[0], NO_LETTER)
        counts = np.diff(at)
        of = np.repeat(np.arange(last - first), counts)
        # Every text is padded on both sides, so no context reaches into another text.
        spot = np.arange(len(found)) + WINDOW * (2 * of + 1)
        padded = np.full(len(found) + 2 * WINDOW * (last - first), TOKENS, dtype=np.int32)
        padded[spot] = vocabulary.encode(found)
        context = np.stack([padded[spot + o] for o in OFFSETS], axis=1)
        yield first, of, np.arange(len(found)) - at[:-1][of], padded[spot], context, found


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n): the hash of every word of all documents and how often it occurs. Tasks count their own words first."""

    def local(batches):
        held, size = [], 0

        def counts():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for first, last in slices(offsets):
                part = offsets[first : last + 1]
                held.append(words(data[part[0] : part[-1]], part - part[0], NO_LETTER)[0])
                size += len(held[-1])
                if size > 3_000_000:
                    yield counts()
                    held, size = [], 0
        if size:
            yield counts()

    return docs.select(F.col(text).alias("text")).mapInArrow(local, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_of(docs: DataFrame, text: str) -> Vocabulary:
    """The most frequent words over all documents."""
    return _most_frequent(word_counts(docs, text))


def _most_frequent(counted: DataFrame) -> Vocabulary:
    """The driver receives TOKENS - HASHED rows."""
    top = counted.orderBy(F.desc("n"), "word").limit(TOKENS - HASHED).collect()
    hashes = np.array([r["word"] for r in top], dtype=np.int64).view(U64)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], order.astype(np.int32))


@dataclass(frozen=True)
class Shares:
    hashes: np.ndarray  # sorted hashes of the words that are sent to tasks
    logs: np.ndarray  # the logarithms of their shares

    @cached_property
    def lookup(self) -> Lookup:
        return Lookup(self.hashes)

    def find(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a word is held, the logarithm of its share)."""
        if not len(self.hashes):
            return np.zeros(len(found), dtype=bool), np.zeros(len(found))
        held, at = self.lookup.find(found)
        return held, self.logs[at]


def word_shares(counted: DataFrame, vocabulary: Vocabulary) -> tuple[DataFrame, Shares]:
    """(word, share) of all words under hashed ids, share being the logarithm of the word's part of the occurrences under
    its id; and the shares of the most frequent of them."""
    spark = counted.sparkSession
    own = spark.createDataFrame([(int(h),) for h in vocabulary.hashes.view(np.int64)], "word long")
    # As in Vocabulary.encode.
    bucket = F.shiftrightunsigned("word", 20).bitwiseAND(F.lit(HASHED - 1)).alias("bucket")
    others = stash(counted.join(own, "word", "left_anti").select("word", "n", bucket), "words")
    sums = others.groupBy("bucket").agg(F.sum("n").alias("whole"))
    shares = stash(others.join(sums, "bucket").select("word", "n", F.log(F.col("n") / F.col("whole")).alias("share")), "shares")
    top = shares.orderBy(F.desc("n"), "word").limit(KNOWN).select("word", "share").toArrow()
    hashes = top["word"].to_numpy().view(U64)
    order = np.argsort(hashes)
    return shares.select("word", "share"), Shares(hashes[order], top["share"].to_numpy()[order])


def targeted(place: np.ndarray, of: np.ndarray, turn: int) -> np.ndarray:
    """Whether a position is a target in a round: all are over all rounds, once each. The first target differs from text to
    text."""
    return (place + of + turn) % ROUNDS == 0


def trained(docs: DataFrame, text: str, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """The weights after all rounds over all documents. The driver holds one set of weights (0.7 MB)."""
    spark, weights = docs.sparkSession, first_weights()
    size = len(flat(weights))

    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vocabulary, weights))

        def local(batches, turn=turn, shared=shared):
            vocab, start = shared.value
            w = {k: v.copy() for k, v in start.items()}
            state = {k: np.full_like(v, 1e-4) for k, v in w.items()}
            targets, contexts, held, done = [], [], 0, 0
            for batch in batches:
                for _, of, place, token, context in _token_slices(batch.column(0), vocab):
                    chosen = targeted(place, of, turn)
                    targets.append(token[chosen])
                    contexts.append(context[chosen])
                    held += int(chosen.sum())
                    if held >= 4 * BATCH:
                        t, c = np.concatenate(targets), np.concatenate(contexts)
                        for a in range(0, held - BATCH + 1, BATCH):
                            train_step(w, state, t[a : a + BATCH], c[a : a + BATCH])
                            done += BATCH
                        rest = held - held % BATCH
                        targets, contexts, held = [t[rest:]], [c[rest:]], held - rest
            if held:
                t, c = np.concatenate(targets), np.concatenate(contexts)
                for a in range(0, held, BATCH):
                    train_step(w, state, t[a : a + BATCH], c[a : a + BATCH])
                done += held
            if done:
                numbers = flat(w).astype(np.float32)
                parts = [numbers[a : a + SLICE].tobytes() for a in range(0, size, SLICE)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([done] * len(parts), pa.int64()), pa.array(parts, pa.binary())], names=["slice", "n", "numbers"])

        def averaged(table: pa.Table) -> pa.Table:
            total, n = 0.0, 0
            for count, raw in sorted(zip(table["n"].to_pylist(), table["numbers"].to_pylist())):
                total = total + np.frombuffer(raw, dtype=np.float32).astype(np.float64) * count
                n += count
            return pa.table({"slice": table["slice"][:1].cast(pa.int32()), "n": pa.array([n], pa.int64()), "numbers": pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())})

        schema = "slice int, n long, numbers binary"
        parts = docs.select(F.col(text).alias("text")).mapInArrow(local, schema)
        # Two levels, so that no group holds a slice of every task.
        met = parts.groupBy("slice", F.spark_partition_id() % 64).applyInArrow(averaged, schema)
        rows = sorted(met.groupBy("slice").applyInArrow(averaged, schema).collect(), key=lambda r: r["slice"])
        if not rows:
            break
        weights = unflat(np.concatenate([np.frombuffer(r["numbers"], dtype=np.float32) for r in rows]))
    return weights


def pseudo_likelihood(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, log_likelihood (the sum over all tokens), mean_log_likelihood and pseudo_perplexity of every row.
    Words are runs of letters and digits, A-Z lower-cased. Null texts, empty texts and texts without words have 0 tokens,
    a sum of 0, and null for the mean and the perplexity. Repeated rows are scored each; an empty table gives an empty
    result; other columns are not looked at."""
    counted = stash(word_counts(docs, text), "counts")
    vocabulary = _most_frequent(counted)
    shares, known = word_shares(counted, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, trained(docs, text, vocabulary), known))
    kind = "struct<n: bigint, total: double, words: array<bigint>, counts: array<int>>"

    @F.arrow_udf(kind)
    def score(texts: pa.Array) -> pa.Array:
        vocab, weights, near = shared.value
        n, total = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
        ends, far, often = np.zeros(len(texts) + 1, dtype=np.int32), [], []
        for first, of, _, token, context, found in _word_slices(texts, vocab):
            if not len(token):
                continue
            logs = log_probabilities(weights, token, context)
            hashed = np.flatnonzero(token >= TOKENS - HASHED)
            held, share = near.find(found[hashed])
            logs[hashed[held]] += share[held]
            sums = np.bincount(of, weights=logs)
            total[first : first + len(sums)] += sums
            n[first : first + len(sums)] += np.bincount(of)
            # The other words of each text, once each.
            rest = hashed[~held]
            order = np.lexsort((found[rest], of[rest]))
            text_of, word = of[rest][order], found[rest][order]
            begins = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (text_of[1:] != text_of[:-1])))[: len(word)])
            far.append(word[begins].view(np.int64))
            often.append(np.diff(np.append(begins, len(word))).astype(np.int32))
            met = np.bincount(text_of[begins])
            ends[1 + first : 1 + first + len(met)] += met.astype(np.int32)
        ends = pa.array(np.cumsum(ends, dtype=np.int32))
        far = np.concatenate(far) if far else np.zeros(0, np.int64)
        often = np.concatenate(often) if often else np.zeros(0, np.int32)
        lists = [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (far, often)]
        return pa.StructArray.from_arrays([pa.array(n), pa.array(total), *lists], names=["n", "total", "words", "counts"])

    # Rows are numbered in the table that is written, so the numbers hold.
    scored = stash(docs.select(F.col(key), F.monotonically_increasing_id().alias("row"), score(F.col(text)).alias("s")), "scored")
    each = scored.select("row", F.explode(F.arrays_zip("s.words", "s.counts")).alias("e")).select("row", F.col("e.words").alias("word"), F.col("e.counts").alias("n"))
    rare = each.join(shares, "word").groupBy("row").agg(F.sum(F.col("n") * F.col("share")).alias("rare"))
    scored = scored.select(key, "row", "s.n", "s.total").join(rare, "row", "left")
    scored = scored.select(key, F.struct("n", (F.col("total") + F.coalesce("rare", F.lit(0.0))).alias("total")).alias("s"))
    mean = F.when(F.col("s.n") > 0, F.col("s.total") / F.col("s.n"))
    return scored.select(key, F.col("s.n").alias("n_tokens"), F.col("s.total").alias("log_likelihood"), mean.alias("mean_log_likelihood"), F.exp(-mean).alias("pseudo_perplexity"))
