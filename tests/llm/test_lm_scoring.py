import numpy as np
import pytest

from tidewatch.llm import lm_scoring as lm


def corpus(n, seed):
    """Sentences in which every second word follows from its neighbours."""
    rng = np.random.default_rng(seed)
    return [" ".join(f"a{k} b{k} c{k}" for k in rng.integers(20, size=12)) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [*enumerate(corpus(1500, 1)), (9000, None), (9001, ""), (9002, "!?"), (9003, "a1"), (9004, "a1 b1 c1 " * 30000), (1, "dup dup"), (1, "dup dup")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, _codes string").drop("_codes").repartition(4)


@pytest.fixture(scope="module")
def trained(docs):
    vocabulary, first = lm.learn_vocabulary(docs, words=128, buckets=32)
    return vocabulary, first, lm.train(lm.encode(docs, vocabulary), vocabulary, first, rounds=3, stride=2)


def mean(net, vocabulary, texts):
    codes, starts = vocabulary.encode(texts)
    return net.log_probability(lm.contexts(codes, starts, vocabulary.size), codes).mean()


def test_training_learns_from_both_sides(trained):
    vocabulary, first, net = trained
    unseen = corpus(100, 7)
    rng = np.random.default_rng(1)
    mixed = [" ".join(rng.permutation(t.split())) for t in unseen]
    assert mean(net, vocabulary, unseen) > mean(first, vocabulary, unseen) + 0.5
    assert mean(net, vocabulary, unseen) > mean(net, vocabulary, mixed) + 0.3


def test_scores_are_sums_of_conditional_log_probabilities(docs, trained):
    vocabulary, _, net = trained
    found = {r.doc_id: (r._n_tokens, r._log_likelihood) for r in lm.score(lm.encode(docs, vocabulary), vocabulary, net).collect()}
    assert found[9000] == found[9001] == found[9002] == (0, 0.0)
    text = corpus(1500, 1)[3]
    words = [vocabulary.words.index(w) if w in vocabulary.words else None for w in text.split()]
    assert None not in words
    total = 0.0
    for i, w in enumerate(words):
        around = [words[j] if 0 <= j < len(words) else vocabulary.size for j in (i - 2, i - 1, i + 1, i + 2)]
        h = np.tanh(sum(net.into[k][c] for k, c in enumerate(around)) + net.bias)
        block, place = divmod(w, lm.BLOCK_WORDS)
        for z, at in ((h @ net.to_block + net.block_bias, block), (h @ net.to_word[block] + net.word_bias[block], place)):
            total += z[at] - np.log(np.exp(z).sum())
    assert found[3][0] == len(words) and abs(found[3][1] - total) < 1e-2
    assert found[9004][0] == 90000 and found[9003][0] == 1


def test_the_probabilities_of_all_words_sum_to_one(trained):
    vocabulary, _, net = trained
    around = np.tile([[3, vocabulary.size, 5, 0]], (vocabulary.size, 1))
    assert abs(np.exp(net.log_probability(around, np.arange(vocabulary.size))).sum() - 1) < 1e-4


def test_the_vocabulary_is_counted_over_all_documents(docs):
    counts = {r.word: r.n for r in lm.word_counts(docs).collect()}
    assert counts["dup"] == 4 and sum(counts.values()) == 1500 * 36 + 1 + 90000 + 4


def test_texts_do_not_see_each_other(trained):
    vocabulary, _, net = trained
    texts = ["a1 b1", "", "c1", "a2"]
    codes, starts = vocabulary.encode(texts)
    around = lm.contexts(codes, starts, vocabulary.size)
    end = vocabulary.size
    assert around[2].tolist() == [end] * 4 and around[0].tolist() == [end, end, codes[1], end]


def test_small_and_empty_corpora(spark):
    one = spark.createDataFrame([(1, "single")], "doc_id long, text string")
    assert [r._n_tokens for r in lm.fit_and_score(one, words=128, buckets=32).collect()] == [1]
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [(r._n_tokens, r._log_likelihood) for r in lm.fit_and_score(blank).collect()] == [(0, 0.0)] * 2
    assert lm.fit_and_score(blank.limit(0)).collect() == []


def test_every_position_is_a_target(spark, monkeypatch):
    docs = spark.createDataFrame([*enumerate(corpus(40, 5))], "doc_id long, text string").repartition(1)
    vocabulary, first = lm.learn_vocabulary(docs, words=128, buckets=32)
    weights = []
    averaged = lm._averaged
    monkeypatch.setattr(lm, "_averaged", lambda copies, chunks: weights.append(copies.where("chunk = 0").agg({"weight": "sum"}).first()[0]) or averaged(copies, chunks))
    lm.train(lm.encode(docs, vocabulary), vocabulary, first)
    assert sum(weights) == 40 * 36
    with pytest.raises(ValueError):
        lm.train(lm.encode(docs, vocabulary), vocabulary, first, rounds=2, stride=3)


def plain(net, around, target):
    """Hidden units and the two softmaxes of each position, by the formula."""
    h = np.tanh(sum(net.into[k, around[:, k]].astype(float) for k in range(around.shape[1])) + net.bias)
    share = lambda z: (e := np.exp(z - z.max(axis=1, keepdims=True))) / e.sum(axis=1, keepdims=True)
    block = target // lm.BLOCK_WORDS
    return h, share(h @ net.to_block + net.block_bias), share(np.einsum("ij,ijk->ik", h, net.to_word[block]) + net.word_bias[block])


@pytest.mark.parametrize("scale", [1, 400])  # the larger logits are shifted before exp
def test_a_step_follows_the_formula_in_memory_that_is_taken_once(scale):
    rng = np.random.default_rng(4)
    net = lm.first_network(rng.integers(1, 50, 256).astype(float))
    net.to_word[:], net.to_block[:] = net.to_word * scale, net.to_block * scale
    around, target = rng.integers(0, 257, (500, 4)).astype(np.int32), rng.integers(0, 200, 500)  # a block without positions
    h, p, q = plain(net, around, target)
    at, block, word = np.arange(500), target // lm.BLOCK_WORDS, target % lm.BLOCK_WORDS
    assert np.allclose(net.log_probability(around, target), np.log(p[at, block]) + np.log(q[at, word]), atol=1e-3 * scale**0.5)
    p[at, block] -= 1
    q[at, word] -= 1
    dh = (p @ net.to_block.T + np.einsum("ik,ijk->ij", q, net.to_word[block])) * (1 - h * h)
    grad = np.zeros(net.into[1].shape)
    np.add.at(grad, around[:, 1], dh / 500)
    wanted = net.into[1] - 0.1 * grad / np.sqrt(1e-2 + (grad**2).mean(axis=1))[:, None]
    of_word = np.zeros(net.to_word.shape)
    np.add.at(of_word, block, h[:, :, None] * q[:, None, :] / 500)
    trainer = lm.Trainer(net)
    trainer.step(around, target)
    room = trainer.room
    assert np.allclose(trainer.net.into[1], wanted, atol=1e-4)
    assert np.allclose(trainer.net.to_word, net.to_word - 0.1 * of_word / np.sqrt(1e-2 + of_word**2), atol=1e-4)
    trainer.step(around[:300], target[:300])
    assert trainer.room is room and room.size == 500 * lm.BLOCK_WORDS
