"""Language identification with string kernels.

The kernel of two texts is the blended spectrum of n-gram presence: the number of
different 1-, 2- and 3-grams both have, over the root of the product of how many each
has. Texts are lower-cased; a run of letters is what it is, every other character is one
boundary sign. Nyström landmarks, some training texts of each language, turn the kernel
into features, on which one ridge regression per language is fitted against the rest.

As a kernel value is a product of presence vectors, landmarks and coefficients fold into
one matrix of n-grams by languages, and a batch of texts is scored by one product with
the matrix of their presence vectors. Each whole text is read.

The classifier is fitted on a bounded sample, at most TRAIN_ROWS texts of at most
TRAIN_CHARACTERS characters, the same number of each language, chosen by hash of id and
text. n-grams outside the sample's are unknown to
the kernel.

Defined cases: null text and text without a letter are `und` with score 0; ties go to the
language first in order; rows with null language are predicted but not learned from; a
null id counts as the empty text in the fold rule; repeated rows are predicted alike and
learned from once; a language that has only longer texts than the bound is not learned; if
nothing can be learned, every row is `und`; columns besides id, text and language are not
read, `known` passes all columns through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the sample that the classifier is fitted on, and of the landmarks.
TRAIN_ROWS = 1600
TRAIN_CHARACTERS = 50_000
LANDMARKS = 200
#: Signs: boundary, unknown letter, and the most frequent letters of the sample.
SIGNS = 128
RIDGE = 0.01
UNKNOWN = "und"
BATCH = 64


def signs_of(text: str, table: np.ndarray) -> np.ndarray:
    """One sign per character of the lower-cased text, a boundary at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    out = np.zeros(len(points) + 2, np.int32)
    out[1:-1] = table[points]
    return out


def grams(signs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Codes of the 1-, 2- and 3-grams; lengths do not share codes, boundaries alone are none."""
    one = signs
    two = (one[:-1] + 1) * SIGNS + one[1:]
    three = (two[:-1]) * SIGNS + one[2:] + SIGNS * SIGNS
    return one[one > 0], two[(one[:-1] > 0) | (one[1:] > 0)], three[one[1:-1] > 0]


#: Codes are below this.
CODES = SIGNS * (SIGNS + 1) * SIGNS + SIGNS * SIGNS


def sign_table(letters: str) -> np.ndarray:
    """Sign of each code point: 0 for what is no letter, 1 for letters not in `letters`."""
    table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.uint8, 0x110000)
    for sign, letter in enumerate(letters, start=2):
        table[ord(letter)] = sign
    return table


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    letters: str  # from the most frequent one on
    codes: np.ndarray  # known n-grams, sorted
    weights: np.ndarray  # n-grams x languages


def fit(texts: list[str], languages: list[str]) -> Model:
    """Kernel ridge regression on Nyström features, one language against the rest."""
    names = tuple(sorted(set(languages)))
    if not names:
        return Model((), "", np.empty(0, np.int32), np.empty((0, 0), np.float32))
    frequent = Counter(c for text in texts for c in text.lower() if c.isalpha())
    letters = "".join(c for c, _ in sorted(frequent.items(), key=lambda x: (-x[1], x[0]))[: SIGNS - 2])
    table = sign_table(letters)
    found = [np.unique(np.concatenate(grams(signs_of(t, table)))) for t in texts]
    codes, n_texts = np.unique(np.concatenate(found), return_counts=True)
    codes = codes[n_texts > 1] if (n_texts > 1).any() else codes
    presence = np.zeros((len(texts), len(codes)), np.float32)
    for i, f in enumerate(found):
        at = np.searchsorted(codes, f)
        at = at[(at < len(codes))]
        presence[i, np.intersect1d(codes, f, assume_unique=True, return_indices=True)[1]] = 1
    presence /= np.sqrt(np.maximum(presence.sum(axis=1, keepdims=True), 1))
    by_language = {n: [i for i, l in enumerate(languages) if l == n] for n in names}
    each = max(1, LANDMARKS // len(names))
    marks = sorted(i for own in by_language.values() for i in own[:each])
    landmarks = presence[marks]
    values, vectors = np.linalg.eigh(landmarks @ landmarks.T)
    good = values > 1e-6 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = presence @ landmarks.T @ whiten
    target = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = 1.0 / np.array([len(by_language[l]) for l in languages])[:, None]  # languages count alike
    gram = features.T @ (features * weight) + RIDGE * np.eye(features.shape[1])
    coefficients = np.linalg.solve(gram, features.T @ (target * weight))
    weights = (landmarks.T @ (whiten @ coefficients)).astype(np.float32)
    return Model(names, letters, codes.astype(np.int32), weights)


def _scored(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sign_table(model.letters)
        column = np.full(CODES, -1, np.int32)
        column[model.codes] = np.arange(len(model.codes), dtype=np.int32)
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            texts = batch.column("text")
            best = np.full(batch.num_rows, len(model.languages))
            value = np.zeros(batch.num_rows)
            for start in range(0, batch.num_rows if model.languages else 0, BATCH):
                part = texts.slice(start, BATCH)
                presence = np.zeros((len(part), len(model.codes)), np.float32)
                lettered = np.zeros(len(part), bool)
                for i, text in enumerate(part):
                    signs = signs_of(text.as_py() or "", table)
                    lettered[i] = signs.any()
                    if lettered[i]:
                        for codes in grams(signs):
                            at = column[codes]
                            presence[i, at[at >= 0]] = 1
                scores = presence @ model.weights
                scores /= np.sqrt(np.maximum(presence.sum(axis=1, keepdims=True), 1))
                top = scores.argmax(axis=1)
                rows = slice(start, start + len(part))
                best[rows] = np.where(lettered, top, len(model.languages))
                high = scores[np.arange(len(part)), top].astype(np.float64)
                value[rows] = np.where(lettered, np.clip((high + 1) / 2, 0, 1), 0.0)
            out = batch.drop_columns(["text"])
            yield out.append_column("lang_pred", pa.array(names[best], pa.string())).append_column(
                "score", pa.array(value)
            )

    return score


def held_out(id_column: str | Column) -> Column:
    """Rows that are never learned from: a quarter, by checksum of the id."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame, id_column: str, text_column: str, lang_column: str) -> tuple[list[str], list[str]]:
    """Texts and languages to learn from: of each language the rows with the least hashes.

    Rows are hashed by id and text and count once if both are equal, so neither repeated
    rows nor rows that share an id, or have none, push others out.
    """
    text, lang = F.col(f"`{text_column}`").cast("string"), F.col(f"`{lang_column}`").cast("string")
    rows = docs.where(
        F.col(f"`{lang_column}`").isNotNull()
        & F.col(f"`{text_column}`").rlike(r"\p{L}")
        & (F.length(text) <= TRAIN_CHARACTERS)
        & ~held_out(F.col(f"`{id_column}`"))
    ).select(lang.alias("lang"), F.xxhash64(F.lit("train"), F.col(f"`{id_column}`"), text).alias("place"), text.alias("text"))
    counted = rows.groupBy("lang").agg(F.approx_count_distinct("place", 0.02).alias("n")).collect()  # one per language
    if not counted:
        return [], []
    each = max(1, TRAIN_ROWS // len(counted))
    # Twice the quota is expected below the bound of a language, then cut.
    low, span = -(1 << 63), 1 << 64
    bound = {r["lang"]: low + int(span * min(1.0, 2 * each / r["n"])) if r["n"] > 2 * each else (1 << 63) - 1 for r in counted}
    chosen = reduce(Column.__or__, ((F.col("lang") == lang) & (F.col("place") <= F.lit(b)) for lang, b in bound.items()))
    some = rows.where(chosen).groupBy("lang", "place").agg(F.min("text").alias("text"))
    kept: Counter = Counter()
    texts, languages = [], []
    for row in sorted(some.collect(), key=lambda r: (r["place"], r["lang"], r["text"])):
        if kept[row["lang"]] < each:
            kept[row["lang"]] += 1
            texts.append(row["text"])
            languages.append(row["lang"])
    return texts, languages


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """A model from at most TRAIN_ROWS rows that have a language and are not held out."""
    return fit(*sample(docs, id_column, text_column, lang_column))


def predicted(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score."""
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        held_out(F.col(f"`{id_column}`")).alias("held_out"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_scored(model), f"id {kind}, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_column)


def known(docs: DataFrame, model: Model, text_column: str = "text", least: float = 0.0) -> DataFrame:
    """The documents in a learned language with at least this score, with all columns."""
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(_scored(model), f"row {kind}, lang_pred string, score double")
    return out.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
