"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word goes in twice: as an entry of a vocabulary of words, and as the mean of the
entries of its character trigrams, so unknown words and other spellings are read too. A
network of gated recurrent units reads a window of WINDOW words in both directions, its
states are pooled by attention, and a logistic unit scores the window. All windows of the
whole text are scored, each overlapping the next; the score of a text is that of its
worst window.

The network is trained in numpy, on the driver, from a bounded sample of labelled rows:
at most TOXIC_ROWS and CLEAN_ROWS documents, of at most SAMPLE_CHARACTERS characters
each, chosen by hash of the id and fixed for given tables. A label is known for the text,
not for the window: after a start on random windows, each round learns from the windows
that the network itself finds worst. Scoring runs over all rows and whole texts.

Defined cases: null text, empty text and text without words have no window and score 0;
a null id counts as the empty text in the fold rule and has no label; a document that is
labelled twice is toxic if one label says so; of repeated ids one text is learned from;
repeated rows are scored alike; if the sample lacks one of the classes, or tables are
empty, every score is 0; columns besides id and text, and id and label, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window, and from one window to the next.
WINDOW, STRIDE = 32, 24
#: Sizes of word entries, trigram entries and states; tables of words and trigrams.
WORD, TRIGRAM, STATE = 16, 16, 16
VOCABULARY, TRIGRAMS = 8192, 1 << 13
#: Bounds of the sample.
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_CHARACTERS = 800, 1600, 8_000
#: Rounds on random windows, then on the worst ones; windows of a step; step size.
WARM_ROUNDS, ROUNDS, STEP_WINDOWS, RATE = 6, 14, 64, 6e-3
#: Scores from here on count as toxic.
TOXIC = 0.3
#: Words and windows that are scored together.
SOME_WORDS, SOME_WINDOWS = 1 << 15, 1024

UNKNOWN = 0


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()  # at [\x20\x09-\x0D]


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the trigrams of all words, one after the other, and where each word begins.

    A word stands between two blanks, so that it has as many trigrams as bytes.
    """
    text = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = (text[:-2] * 0x9E3779B1 ^ text[1:-1] * 0x85EBCA77 ^ text[2:] * 0xC2B2AE3D) * np.uint32(0x27D4EB2F)
    lengths = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(lengths + 2)[:-1]])
    inside = np.ones(len(code) + 2, bool)
    inside[starts[1:] - 2] = inside[starts[1:] - 1] = False  # trigrams over two words
    return (code >> 19)[inside[: len(code)]].astype(np.int32), np.concatenate([[0], np.cumsum(lengths)[:-1]])


@dataclass
class Network:
    """Parameters by name, and the vocabulary."""

    vocabulary: dict[bytes, int]
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def new(vocabulary: dict[bytes, int], rng: np.random.Generator) -> Network:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {"words": normal(len(vocabulary) + 1, WORD, scale=0.1), "trigrams": normal(TRIGRAMS, TRIGRAM, scale=0.3)}
        for way in ("f", "b"):
            p["in_" + way] = normal(WORD + TRIGRAM, 3 * STATE, scale=0.2)
            p["state_" + way] = normal(STATE, 3 * STATE, scale=0.2)
            p["bias_" + way] = np.zeros(3 * STATE, np.float32)
        p["attend"], p["look"] = normal(2 * STATE, STATE, scale=0.2), normal(STATE, scale=0.2)
        p["out"], p["out_bias"] = normal(2 * STATE, scale=0.2), np.full(1, -1.0, np.float32)
        return Network(vocabulary, p)

    def entries(self, words: list[bytes], known: np.ndarray | None = None) -> tuple:
        """Input vectors of words, and what the way back needs; known: vocabulary numbers."""
        codes, starts = trigrams(words)
        counts = np.diff(np.append(starts, len(codes))).astype(np.float32)
        if known is None:
            known = np.array([self.vocabulary.get(w.strip(b".,;:!?\"'()"), UNKNOWN) for w in words])
        means = np.add.reduceat(self.p["trigrams"][codes], starts, axis=0) / counts[:, None]
        return np.concatenate([self.p["words"][known], means], axis=1), (known, codes, counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def given(net: Network, vectors: np.ndarray) -> dict[str, np.ndarray]:
    """What words give to the gates, in either direction; the same in all windows."""
    return {way: vectors @ net.p["in_" + way] + net.p["bias_" + way] for way in ("f", "b")}


def forward(net: Network, inputs: dict[str, np.ndarray], index: np.ndarray, there: np.ndarray, keep: bool = False):
    """Scores before the logistic function of windows: index[window, place] into the inputs,
    there[window, place] false behind the end of the text."""
    p, (n, width) = net.p, index.shape
    states = np.zeros((width, n, 2 * STATE), np.float32)
    kept: dict[str, list] = {"f": [], "b": []}
    whole = there.all(axis=0)
    places = np.ascontiguousarray(index.T)
    for side, way in enumerate(("f", "b")):
        h = np.zeros((n, STATE), np.float32)
        for t in range(width) if way == "f" else range(width - 1, -1, -1):
            x, u = inputs[way].take(places[t], axis=0), h @ p["state_" + way]
            gates = _sigmoid(x[:, : 2 * STATE] + u[:, : 2 * STATE])
            z, r = gates[:, :STATE], gates[:, STATE:]
            new = np.tanh(x[:, 2 * STATE :] + r * u[:, 2 * STATE :])
            now = new + z * (h - new)
            if not whole[t]:
                now = np.where(there[:, t, None], now, h)
            if keep:
                kept[way].append((t, h, z, r, new, u[:, 2 * STATE :]))
            h = now
            states[t, :, side * STATE : (side + 1) * STATE] = h
    looked = np.tanh(states @ p["attend"])
    weight = looked @ p["look"]
    weight = np.where(there.T, weight, -1e9)
    weight = np.exp(weight - weight.max(axis=0))
    weight *= there.T
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnk->nk", weight, states)
    score = pooled @ p["out"] + p["out_bias"][0]
    return (score, (states, looked, weight, pooled, kept)) if keep else score


def backward(net: Network, vectors, index, there, made, error: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters and of the input vectors, from those of the scores."""
    p, (states, looked, weight, pooled, kept) = net.p, made
    g = {"out": pooled.T @ error, "out_bias": np.array([error.sum()], np.float32)}
    d_pooled = error[:, None] * p["out"]
    d_states = weight[:, :, None] * d_pooled
    d_weight = (states * d_pooled).sum(axis=2)
    d_weight = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["look"] = np.einsum("tnk,tn->k", looked, d_weight)
    d_looked = d_weight[:, :, None] * p["look"] * (1 - looked**2)
    g["attend"] = np.einsum("tnk,tnj->kj", states, d_looked)
    d_states += d_looked @ p["attend"].T
    d_vectors = np.zeros_like(vectors)
    for side, way in enumerate(("f", "b")):
        d_in = np.zeros((len(vectors), 3 * STATE), np.float32)
        d_h = np.zeros((len(index), STATE), np.float32)
        d_u_all = np.zeros_like(p["state_" + way])
        for t, h, z, r, new, u_new in reversed(kept[way]):
            d_now = d_states[t, :, side * STATE : (side + 1) * STATE] + d_h
            live = np.where(there[:, t, None], d_now, 0)
            d_new = live * (1 - z) * (1 - new**2)
            d_gates = np.concatenate(
                [live * (h - new) * z * (1 - z), d_new * u_new * r * (1 - r), d_new], axis=1
            ).astype(np.float32)
            d_u = d_gates.copy()
            d_u[:, 2 * STATE :] *= r
            np.add.at(d_in, index[:, t], d_gates)
            d_u_all += h.T @ d_u
            d_h = d_u @ p["state_" + way].T + live * z + (d_now - live)
        g["state_" + way] = d_u_all
        g["bias_" + way] = d_in.sum(axis=0)
        g["in_" + way] = vectors.T @ d_in
        d_vectors += d_in @ p["in_" + way].T
    return g, d_vectors


def windows(n_words: int) -> np.ndarray:
    """Starts of the windows that cover so many words."""
    return np.arange(0, max(n_words - WINDOW, 0) + STRIDE, STRIDE) if n_words else np.empty(0, np.int64)


def _places(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of windows, and which of them lie before the end of the text."""
    at = starts[:, None] + np.arange(WINDOW)
    there = at < ends[:, None]
    return np.where(there, at, starts[:, None]), there


def _worst(net: Network, words: list[bytes], index: np.ndarray, lengths: list[int]) -> list[tuple[int, float]]:
    """(start, score) of the worst window of each text; index numbers the words of the texts,
    which lie one after the other."""
    vectors, _ = net.entries(words)
    inputs = given(net, vectors)
    begins = np.cumsum([0, *lengths])
    own = [windows(n) for n in lengths]
    counts = [len(s) for s in own]
    starts = np.concatenate(own) + np.repeat(begins[:-1], counts)
    ends = np.repeat(begins[1:], counts)
    scores = np.empty(len(starts), np.float32)
    by_length = np.argsort(np.minimum(ends - starts, WINDOW), kind="stable")  # whole windows together
    for at in range(0, len(starts), SOME_WINDOWS):
        part = by_length[at : at + SOME_WINDOWS]
        places, there = _places(starts[part], ends[part])
        scores[part] = forward(net, inputs, index[places], there)
    split = np.split(scores, np.cumsum(counts)[:-1])
    return [(int(s[found.argmax()]), float(found.max())) for s, found in zip(own, split, strict=True)]


def _parts(texts: list[list[bytes]]) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(number of the text, words) of some SOME_WORDS words; texts without words are left out.

    A long text is cut at the start of a window, which its next part begins with.
    """
    some: list[tuple[int, list[bytes]]] = []
    size, step = 0, SOME_WORDS // STRIDE * STRIDE
    for text, words in enumerate(texts):
        for first in range(0, max(len(words) - (WINDOW - STRIDE), min(len(words), 1)), step):
            part = words[first : first + step + WINDOW - STRIDE]
            some.append((text, part))
            size += len(part)
            if size >= SOME_WORDS:
                yield some
                some, size = [], 0
    if some:
        yield some


def _numbered(texts: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The different words of texts, and the number of each word of all texts."""
    numbers: dict[bytes, int] = {}
    index = np.array([numbers.setdefault(w, len(numbers)) for words in texts for w in words])
    return list(numbers), index


def text_scores(net: Network | None, texts: list[list[bytes]]) -> np.ndarray:
    """The score of the worst window of each text, 0 for texts without words."""
    worst = np.full(len(texts), -np.inf)
    for part in _parts(texts) if net else ():
        pieces = [words for _, words in part]
        found = _worst(net, *_numbered(pieces), [len(words) for words in pieces])
        for (text, _), (_, score) in zip(part, found, strict=True):
            worst[text] = max(worst[text], score)
    return np.where(np.isfinite(worst), _sigmoid(worst), 0.0)


def fit(texts: list[str], labels: list[int], seed: int = 1) -> Network | None:
    """A network trained on whole texts; none without texts of both classes."""
    split = [words_of(t) for t in texts]
    pairs = [(w, float(label)) for w, label in zip(split, labels, strict=True) if w]
    if len({label for _, label in pairs}) < 2:
        return None
    split, target = [w for w, _ in pairs], np.array([label for _, label in pairs], np.float32)
    in_texts: Counter = Counter()
    for words in split:
        in_texts.update({w.strip(b".,;:!?\"'()") for w in words})
    common = sorted((w for w, n in in_texts.items() if n > 1 and w), key=lambda w: (-in_texts[w], w))[:VOCABULARY]
    rng = np.random.default_rng(seed)
    net = Network.new({w: i + 1 for i, w in enumerate(common)}, rng)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    weight = np.where(target > 0, np.clip((target == 0).sum() / max((target > 0).sum(), 1), 1, 3), 1).astype(np.float32)
    step = 0

    def learn(chosen: list[tuple[int, int]], rate: float) -> None:
        nonlocal step
        numbers: dict[bytes, int] = {}
        flat, lengths = [], []
        for text, start in chosen:
            part = split[text][start : start + WINDOW]
            flat += [numbers.setdefault(w, len(numbers)) for w in part]
            lengths.append(len(part))
        begins = np.concatenate([[0], np.cumsum(lengths)])
        places, there = _places(begins[:-1], begins[1:])
        index = np.array(flat)[places]
        words = list(numbers)
        known = np.array([net.vocabulary.get(w.strip(b".,;:!?\"'()"), UNKNOWN) for w in words])
        known[rng.random(len(known)) < 0.3] = UNKNOWN  # so that trigrams are learned too
        vectors, (known, codes, counts) = net.entries(words, known)
        score, made = forward(net, given(net, vectors), index, there, keep=True)
        rows = np.array([text for text, _ in chosen])
        error = (_sigmoid(score) - target[rows]) * weight[rows] / len(rows)
        g, d_vectors = backward(net, vectors, index, there, made, error.astype(np.float32))
        g["words"] = np.zeros_like(net.p["words"])
        np.add.at(g["words"], known, d_vectors[:, :WORD])
        g["trigrams"] = np.zeros_like(net.p["trigrams"])
        np.add.at(g["trigrams"], codes, np.repeat(d_vectors[:, WORD:] / counts[:, None], counts.astype(int), axis=0))
        step += 1
        for k, grad in g.items():
            first, second = moments[k]
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            net.p[k] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)

    starts = [windows(len(w)) for w in split]
    mined = []
    for at in range(0, len(split), 200):
        some = split[at : at + 200]
        mined.append((range(at, at + len(some)), *_numbered(some), [len(w) for w in some]))
    for round_ in range(WARM_ROUNDS + ROUNDS):
        rate = RATE * (1 if round_ < WARM_ROUNDS + ROUNDS // 2 else 0.3)
        if round_ < WARM_ROUNDS:
            chosen = [(i, int(rng.choice(s))) for i, s in enumerate(starts)]
        else:
            chosen = []
            for part in mined:
                found = _worst(net, *part[1:])
                chosen += [(text, start) for text, (start, _) in zip(part[0], found, strict=True)]
            clean = [i for i in range(len(split)) if not target[i]]
            chosen += [(int(i), int(rng.choice(starts[i]))) for i in rng.choice(clean, len(clean) // 4)]
        order = rng.permutation(len(chosen))
        for at in range(0, len(order), STEP_WINDOWS):
            learn([chosen[i] for i in order[at : at + STEP_WINDOWS]], rate)
    return net


def held_out(id_column: str | Column) -> Column:
    """Rows that are never learned from: a quarter, by checksum of the id."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic"
) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from, bounded by the constants above."""
    known = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .where(~held_out("id"))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")).where(
        F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARACTERS)
    )
    place = F.xxhash64(F.lit("toxic"), "id")
    # Twice the quota of ids: some have no text within the bound. A few thousand rows.
    some = [known.where(F.col("label") == c).orderBy(place, "id").limit(2 * n) for c, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    chosen = F.broadcast(some[0].unionByName(some[1]))
    rows = texts.join(chosen, "id").groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    left = {1: TOXIC_ROWS, 0: CLEAN_ROWS}
    out: list[tuple[str, int]] = []
    for row in sorted(rows.withColumn("place", place).collect(), key=lambda r: (r["place"], str(r["id"]))):
        if left[row["label"]]:
            left[row["label"]] -= 1
            out.append((row["text"], row["label"]))
    return [t for t, _ in out], [label for _, label in out]


def train(docs: DataFrame, labels: DataFrame, **columns: str) -> Network | None:
    """A network from a bounded sample of the labelled rows that are not held out."""
    return fit(*sample(docs, labels, **columns))


def _scored(net: Network | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = text_scores(net, [words_of(t.as_py() or "") for t in part.column("text")])
                yield part.drop_columns(["text"]).append_column("score", pa.array(found))

    return score


def scored(docs: DataFrame, net: Network | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        held_out(F.col(f"`{id_column}`")).alias("held_out"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_scored(net), f"id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= TOXIC).cast("int")).withColumnRenamed("id", id_column)
