"""The masked model: its gradient, proper distributions, learning, and awkward rows."""

import math

import numpy as np
import pyarrow as pa

from strataflow.llm import masked_lm as M
from tests.llm import fixtures


def batch(n=200, seed=5):
    random = np.random.default_rng(seed)
    context = random.integers(0, M.TOKENS + 1, (n, len(M.OFFSETS))).astype(np.int32)
    return ((context[:, 1] * 7 + 3) % 40).astype(np.int32), context


def test_probabilities_of_all_tokens_sum_to_one():
    w = {k: v.astype(np.float64) * 5 for k, v in M.first_weights().items()}
    _, context = batch(3)
    for row in context:
        all_tokens = np.arange(M.TOKENS, dtype=np.int32)
        logs = M.log_probabilities(w, all_tokens, np.repeat(row[None], M.TOKENS, axis=0))
        assert abs(np.exp(logs).sum() - 1) < 1e-6


def test_a_step_follows_the_gradient(monkeypatch):
    """With a fresh, huge state the step is the gradient scaled; compare with finite differences."""
    target, context = batch()
    start = {k: v.astype(np.float64) for k, v in M.first_weights().items()}
    w = {k: v.copy() for k, v in start.items()}
    state = {k: np.full(v.shape, 1e12) for k, v in w.items()}
    M.train_step(w, state, target, context)
    for name, spot in (("bias", (3,)), ("to_class", (2, 0)), ("class_bias", (1,)), ("to_token", (0, 4, 5)), ("token_bias", (0, 7)), ("embedding", (1, int(context[0, 1]), 2))):
        step = 1e-5
        ends = []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in start.items()}
            moved[name][spot] += sign * step
            ends.append(-M.log_probabilities(moved, target, context).mean())
        gradient = (ends[0] - ends[1]) / (2 * step)
        assert abs((start[name][spot] - w[name][spot]) * 1e6 / M.RATE - gradient) < 1e-6 + 1e-3 * abs(gradient)


def test_a_step_holds_little_memory():
    """Rows are worked on in parts that stay in a core's cache: beside the gradients, a step holds few numbers a row."""
    import tracemalloc

    target, context = batch(65_536)
    w = M.first_weights()
    state = {k: np.full_like(v, 1e-4) for k, v in w.items()}
    tracemalloc.start()
    M.train_step(w, state, target, context)
    step = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    M.log_probabilities(w, target, context)
    score = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    row = M.HIDDEN * 4
    assert step < 4 * row * len(target) and score < row * len(target)


def test_large_logits():
    """Weights whose exponentials would overflow give proper distributions and finite steps, as small ones do."""
    target, context = batch(3000)
    w = {k: (v * 3000).astype(np.float32) if k != "embedding" else v for k, v in M.first_weights().items()}
    assert not M._bounded(w["to_class"], w["class_bias"]) and M._bounded(M.first_weights()["to_class"], w["class_bias"])
    exact = M.log_probabilities({k: v.astype(np.float64) for k, v in w.items()}, target, context)
    logs = M.log_probabilities(w, target, context)
    assert np.isfinite(logs).all() and np.allclose(logs, exact, rtol=1e-4, atol=1e-2)
    state = {k: np.full_like(v, 1e-4) for k, v in w.items()}
    M.train_step(w, state, target, context)
    assert all(np.isfinite(v).all() for v in w.values())


def test_lookup_of_hashes():
    """As a search among sorted hashes, also where many share their leading bits."""
    random = np.random.default_rng(3)
    some = random.integers(0, 2**64 - 1, 700, dtype=np.uint64)
    for hashes in (some, some[:1], some >> np.uint64(50), np.array([0, 5, 2**64 - 1], dtype=np.uint64)):
        hashes = np.unique(hashes)
        asked = np.concatenate([hashes, hashes + np.uint64(1), some, np.array([0, 2**64 - 1], dtype=np.uint64)])
        held, at = M.Lookup(hashes).find(asked)
        assert (held == np.isin(asked, hashes)).all() and (hashes[at[held]] == asked[held]).all()


def test_it_learns_both_sides():
    target, context = batch(4000)
    w = M.first_weights()
    before = M.log_probabilities(w, target, context).mean()
    state = {k: np.full_like(v, 1e-4) for k, v in w.items()}
    for _ in range(150):
        M.train_step(w, state, target, context)
    assert M.log_probabilities(w, target, context).mean() > before / 3


def test_context_stays_in_its_text():
    vocabulary = M.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int32))
    _, of, place, token, context = next(M._token_slices(pa.array(["a b c", None, "d", "e f"]), vocabulary))
    assert of.tolist() == [0, 0, 0, 2, 3, 3] and place.tolist() == [0, 1, 2, 0, 0, 1]
    pad = M.TOKENS
    a, b, c, d, e, f = token.tolist()
    assert context.tolist() == [[pad, pad, b, c], [pad, a, c, pad], [a, b, pad, pad], [pad] * 4, [pad, pad, f, pad], [pad, e, pad, pad]]


def test_scores(spark):
    rows = fixtures.texts()
    docs = fixtures.table(spark, rows)
    got = M.pseudo_likelihood(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.n_tokens:
            assert r.log_likelihood < 0 and math.isclose(r.mean_log_likelihood, r.log_likelihood / r.n_tokens) and r.pseudo_perplexity > 1
        else:
            assert r.log_likelihood == 0 and r.mean_log_likelihood is None and r.pseudo_perplexity is None
    assert M.pseudo_likelihood(docs.limit(0)).collect() == []


def test_training_helps_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in docs.limit(50).collect()]
    vocabulary = M.vocabulary_of(docs, "text")
    assert len(vocabulary.hashes) == M.TOKENS - M.HASHED and sorted(vocabulary.ids.tolist()) == list(range(M.TOKENS - M.HASHED))
    _, _, _, token, context = next(M._token_slices(pa.array(texts), vocabulary))
    trained, fresh = (M.log_probabilities(w, token, context).mean() for w in (M.trained(docs, "text", vocabulary), M.first_weights()))
    counts = np.bincount(token, minlength=M.TOKENS)
    uniform = -math.log(M.TOKENS)
    assert abs(fresh - uniform) < 0.1 and trained > uniform + 0.5 and counts.sum() == len(token)


def test_every_position_is_a_target_once():
    """Also in texts of few words."""
    lengths = [1, 2, 3, 5, 6, 40]
    of = np.repeat(np.arange(len(lengths)), lengths)
    place = np.concatenate([np.arange(n) for n in lengths])
    met = sum(M.targeted(place, of, turn).astype(int) for turn in range(M.ROUNDS))
    assert met.tolist() == [1] * len(place)


def test_words_under_a_hashed_id_have_their_shares(spark, monkeypatch):
    """Probabilities of all words under an id sum to that of the id, and scores hold the shares, sent or joined."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300)
    docs = spark.createDataFrame(docs.select("doc_id", "text").collect(), "doc_id long, text string").repartition(4)
    counted = M.word_counts(docs, "text")
    vocabulary = M._most_frequent(counted)
    weights = M.trained(docs, "text", vocabulary)
    monkeypatch.setattr(M, "trained", lambda *_: weights)
    counts = {r.word: r.n for r in counted.collect()}
    own = set(vocabulary.hashes.view(np.int64).tolist())
    ids = dict(zip(counts, vocabulary.encode(np.array(list(counts), dtype=np.int64).view(np.uint64)).tolist()))
    whole = np.bincount([ids[w] for w in counts], weights=list(counts.values()), minlength=M.TOKENS)
    want = {}
    for r in docs.collect():
        for _, _, _, token, context, found in M._word_slices(pa.array([r.text]), vocabulary):
            shares = [math.log(counts[w] / whole[t]) if w not in own else 0 for w, t in zip(found.view(np.int64).tolist(), token.tolist())]
            want[r.doc_id] = want.get(r.doc_id, 0) + float(M.log_probabilities(weights, token, context).sum()) + sum(shares)
    for known in (50, 50_000):
        monkeypatch.setattr(M, "KNOWN", known)
        shares, near = M.word_shares(counted, vocabulary)
        sums = np.zeros(M.TOKENS)
        for r in shares.collect():
            sums[ids[r.word]] += math.exp(r.share)
        assert np.allclose(sums[sums > 0], 1) and len(near.hashes) == min(known, len(counts) - len(own))
        got = {r.doc_id: r.log_likelihood for r in M.pseudo_likelihood(docs).collect()}
        assert all(math.isclose(got[i], want.get(i, 0), rel_tol=1e-3, abs_tol=0.01) for i in got)
