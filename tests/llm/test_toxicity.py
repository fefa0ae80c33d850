"""The toxicity network against numeric gradients, a plain recurrence and held-out rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from shopgrain.llm import toxicity_gru as gru

WORDS = [b"the", b"idiot", b"a", b"caf\xc3\xa9", b"x" * 9]
BAD = ["dolt", "oaf", "nitwit"]


@pytest.fixture(scope="module")
def net():
    made = gru.Network.new({b"idiot": 1, b"a": 2}, np.random.default_rng(0))
    made.p = {k: v.astype(np.float64) for k, v in made.p.items()}
    return made


def test_trigrams_of_words_together_are_those_of_each():
    codes, starts = gru.trigrams(WORDS)
    for word, start in zip(WORDS, starts, strict=True):
        alone, _ = gru.trigrams([word])
        assert len(alone) == len(word) and (codes[start : start + len(word)] == alone).all()


def plain_score(net, vectors):
    """The score of one window, step by step."""
    states = {}
    for way in ("f", "b"):
        h, out = np.zeros(gru.STATE), {}
        for t in range(len(vectors)) if way == "f" else reversed(range(len(vectors))):
            x, u = vectors[t] @ net.p["in_" + way] + net.p["bias_" + way], h @ net.p["state_" + way]
            z, r = (1 / (1 + np.exp(-(x[i : i + gru.STATE] + u[i : i + gru.STATE]))) for i in (0, gru.STATE))
            new = np.tanh(x[2 * gru.STATE :] + r * u[2 * gru.STATE :])
            h = out[t] = (1 - z) * new + z * h
        states[way] = out
    rows = np.array([np.concatenate([states["f"][t], states["b"][t]]) for t in range(len(vectors))])
    weight = np.exp(np.tanh(rows @ net.p["attend"]) @ net.p["look"])
    return (weight / weight.sum()) @ rows @ net.p["out"] + net.p["out_bias"][0]


def test_forward_and_gradients(net):
    rng = np.random.default_rng(1)
    vectors = net.entries(WORDS)[0].astype(np.float64)
    index = rng.integers(0, len(WORDS), (3, gru.WINDOW))
    lengths, target = [gru.WINDOW, 5, 20], np.array([1.0, 0, 1])
    there = np.arange(gru.WINDOW) < np.array(lengths)[:, None]
    score, made = gru.forward(net, gru.given(net, vectors), index, there, keep=True)
    for row, n, found in zip(index, lengths, score, strict=True):
        assert found == pytest.approx(plain_score(net, vectors[row[:n]]), abs=1e-5)

    def loss():
        s = gru.forward(net, gru.given(net, vectors), index, there)
        return (np.log1p(np.exp(s)) - target * s).sum()

    gradients, d_vectors = gru.backward(net, vectors, index, there, made, 1 / (1 + np.exp(-score)) - target)
    for values, found in [*((net.p[k], g) for k, g in gradients.items()), (vectors, d_vectors)]:
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in values.shape)
            kept, ends = values[at], []
            for change in (1e-3, -1e-3):
                values[at] = kept + change
                ends.append(loss())
            values[at] = kept
            assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(float(found[at]), abs=1e-3)


def test_all_windows_of_long_texts(net, monkeypatch):
    for n in range(1, 200):
        starts = gru.windows(n)
        assert starts[-1] + gru.WINDOW >= n and (n <= gru.WINDOW or starts[-1] + gru.WINDOW - gru.STRIDE < n)
    rng = np.random.default_rng(2)
    texts = [[WORDS[i] for i in rng.integers(0, 5, n)] for n in (0, 1, 31, 32, 33, 700, 0, 56, 57)]
    whole = gru.text_scores(net, texts)
    assert whole[0] == whole[6] == 0.0 and ((whole[[1, 2, 3, 4, 5, 7, 8]] > 0) & (whole[[1, 2, 3, 4, 5, 7, 8]] < 1)).all()
    monkeypatch.setattr(gru, "SOME_WORDS", 100)
    monkeypatch.setattr(gru, "SOME_WINDOWS", 3)
    assert gru.text_scores(net, texts) == pytest.approx(whole, abs=1e-6)
    every = [max(plain_score(net, net.entries(t[s : s + 32])[0]) for s in gru.windows(len(t))) for t in texts if t]
    assert whole[whole > 0] == pytest.approx(1 / (1 + np.exp(-np.array(every))), abs=1e-5)


def made_rows(n):
    """Texts of invented words; toxic ones hold a few listed words."""
    rng, rows = np.random.default_rng(3), []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = ["".join(rng.choice([*"aeiourstlnm"], rng.integers(2, 8))) for _ in range(rng.integers(10, 120))]
        for _ in range(toxic * (1 + len(words) // 30)):
            words.insert(int(rng.integers(len(words))), str(rng.choice(BAD)) + str(rng.choice(["", ".", ","])))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = made_rows(500)
    docs = [(i, text, "en", i, 0.5) for i, text, _ in rows] + [(None, "dolt", "en", 1, 0.1), (901, None, "en", 1, 0.1), (902, " ", None, 1, 0.1)]
    docs += [(903, "oaf " * 20_000, "en", 1, 0.1), (904, "rat " * 20_000, "en", 1, 0.1), (3, rows[3][1], "en", 1, 0.1)]
    labels = [(i, toxic, 1) for i, _, toxic in rows] + [(None, 1, 1), (4, None, 1), (901, 1, 0), (7, rows[7][2], 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, id long, score double"),
        spark.createDataFrame(labels, "doc_id long, toxic int, held_out int"),
        {i: toxic for i, _, toxic in rows},
    )


def test_held_out_rows_are_recognised(labelled):
    docs, labels, toxic = labelled
    net = gru.train(docs, labels)
    rows = gru.scored(docs, net).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    right = [r.predicted == toxic[r.doc_id] for r in held]
    assert len(held) > 90 and np.mean(right) >= 0.9
    by_id = {r.doc_id: r for r in rows}
    assert by_id[901].score == by_id[902].score == 0.0
    assert by_id[903].predicted == 1 and by_id[904].predicted == 0 and by_id[None].predicted == 1
    # Only the text counts, and only labels of rows that are not held out.
    other = docs.selectExpr("text", "doc_id + 10000 as doc_id", "'fr' as lang")
    assert sorted(r.score for r in gru.scored(other, net).collect()) == sorted(r.score for r in rows)
    turned = labels.withColumn("toxic", gru.F.when(gru.held_out("doc_id"), 1 - gru.F.col("toxic")).otherwise(gru.F.col("toxic")))
    assert gru.sample(docs, turned) == gru.sample(docs, labels)


def test_nothing_to_learn(labelled):
    docs, labels, _ = labelled
    assert gru.train(docs, labels.where("toxic = 0")) is None and gru.train(docs.limit(0), labels) is None
    assert {(r.score, r.predicted) for r in gru.scored(docs, None).collect()} == {(0.0, 0)}
    assert gru.scored(docs.limit(0), None).count() == 0
