"""Documents packed into training sequences of fixed capacity.

Each document becomes token ids and an end id; only longer ones are cut, into pieces of
the capacity. Which pieces share a sequence depends on their lengths alone, so the
lengths are counted (one row per length), bin completion packs the counts, and each
piece finds its place by its rank among those of its length. Ranks are exact and need no
window over pieces: a task numbers its pieces by length, and tasks are added up.

Defined cases: null and empty text are the end id alone; repeated rows, and rows with
null ids, are documents of their own; an empty table gives no rows; columns besides id
and text are not read. A text is tokenized word by word, as the vocabulary drops white
space and never joins words across it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bin_completion import pack
from .common import settled

CAPACITY = 2048
END = 0
#: Words that a worker keeps encoded, for all its tasks: so many new ones, and as many
#: of those before that are met again.
REMEMBERED = 400_000
#: Bytes of text whose words are looked up together.
TOGETHER = 1 << 22
RANK_BITS = 44
#: Words apart by blanks, as bytes of the vocabulary's alphabet.
PLAIN_WORDS = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "WhitespaceSplit"},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class _Words:
    """Encoded words as bytes of little-endian unsigned 32-bit ids.

    The vocabulary is case-blind, so texts are looked up in lower case, unless they may
    hold a special token. Arrow splits many texts and numbers their different words;
    only those are looked up, and the ids of all texts are taken by number. New words
    are encoded in one call; a comma or full stop after a letter is a word of its own. When `new` is full it becomes `old`, and what is met
    again goes back to `new`: frequent words are never learned twice.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.suffix = spec["model"]["end_of_word_suffix"]
        spec |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": PLAIN_WORDS}
        self.plain = Tokenizer.from_str(json.dumps(spec))
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.plain.get_vocab().items():
            self.closes[number] = token.endswith(self.suffix)

    @staticmethod
    def _encode(tokenizer, text: str) -> np.ndarray:
        (encoding,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoding.ids, "<u4")

    def _learn(self, words: set[bytes]) -> None:
        """Words of lower-case letters below U+0250 are one word to the vocabulary as they
        are; their last token closes a word. Others go through the whole tokenizer."""
        plain, others = [], []
        for word in words:
            text = word.decode("utf-8", "replace")
            fits = text.isalpha() and max(text) < "\u0250" and text == text.lower()
            (plain if fits else others).append((word, text))
        if plain:
            ids = self._encode(self.plain, " ".join(text for _, text in plain))
            ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            raw, at = ids.tobytes(), 0
            for (word, _), end in zip(plain, ends, strict=True):
                self.new[word] = raw[at:end]
                at = end
        if others:
            found = self.tokenizer.encode_batch_fast([text for _, text in others], add_special_tokens=False)
            for (word, _), encoding in zip(others, found, strict=True):
                self.new[word] = np.array(encoding.ids, "<u4").tobytes()

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of different words."""
        if len(self.new) >= REMEMBERED:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        known = list(map(new.get, words))
        missing = []
        for i in [i for i, found in enumerate(known) if found is None]:
            word = words[i]
            if (found := old.get(word)) is not None:
                known[i] = new[word] = found
            else:
                after = word[-1:] if word[-1:] in (b".", b",") and word[-2:-1].isalpha() else b""
                missing.append((i, word, word[:-1] if after else word, after))
        if missing:
            self._learn({stem for _, _, stem, _ in missing if stem not in new})
            end_of = {b"": b""} | {end: self._encode(self.tokenizer, end.decode()).tobytes() for end in (b".", b",")}
            for i, word, stem, after in missing:
                known[i] = new[word] = new[stem] + end_of[after]
        return known

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text ends."""
        special = pc.match_substring(texts, "<|")
        lower = pc.if_else(special, texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lower)
        ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        different = split.flatten().cast(pa.large_binary()).dictionary_encode()
        known = self._ids(different.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        number = different.indices.to_numpy()
        size = sizes[number]
        after = np.cumsum(size)
        place = np.repeat(starts[number] - after + size, size) + np.arange(after[-1] if len(after) else 0)
        return ids[place], np.append(0, after)[ends]


@lru_cache(maxsize=1)
def _words(path: str) -> _Words:
    return _Words(path)


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of some TOGETHER bytes, at least one text each."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + TOGETHER, side="right")))
        yield start, end
        start = end


def _pieces(path: str, capacity: int, end: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, source = _words(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        closing = np.array([end], "<u4").tobytes()
        for batch in batches:
            whole = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            for first, last in _parts(whole):
                ids, ends = words.encoded(whole.slice(first, last - first))
                raw, at = memoryview(ids).cast("B"), 0
                row, piece, length, crc = [], [], [], []
                for i, stop in enumerate(ends.tolist(), start=first):
                    full = 0
                    while stop - at >= capacity:
                        row.append(i)
                        piece.append(full)
                        length.append(capacity)
                        crc.append(zlib.crc32(raw[4 * at : 4 * (at + capacity)]))
                        at, full = at + capacity, full + 1
                    row.append(i)
                    piece.append(full)
                    length.append(stop - at + 1)
                    crc.append(zlib.crc32(closing, zlib.crc32(raw[4 * at : 4 * stop])))
                    at = stop
                lengths, numbers = np.array(length, np.int64), np.array(piece, np.int64)
                order = np.argsort(lengths, kind="stable")
                ordered = lengths[order]
                starts = np.searchsorted(ordered, ordered)
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order)) - starts + seen[ordered]
                seen += np.bincount(lengths, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(row, pa.int64())),
                        pa.array(numbers.astype(np.int32)),
                        pa.array(numbers * capacity),
                        pa.array(lengths),
                        pa.array(crc, pa.int64()),
                        pa.array(np.full(len(order), source, np.int64)),
                        pa.array(place),
                    ],
                    names=["id", "piece", "start", "length", "ids_crc32", "source", "place"],
                )

    return cut


def _slots(patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ranks from each key (length and first rank) on: first sequence, and offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for times, lengths in patterns:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            used[length] = rank + times
            rows.append(((length << RANK_BITS) + rank, base - rank, offset))
            offset += length
        base += times
    keys, sequences, offsets = np.array(sorted(rows), np.int64).reshape(-1, 3).T
    return keys, sequences, offsets


def _placed(patterns):
    keys, sequences, offsets = _slots(patterns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << RANK_BITS) + rank, side="right") - 1
            yield batch.drop_columns(["rank"]).append_column(
                "sequence_id", pa.array(sequences[at] + rank)
            ).append_column("offset", pa.array(offsets[at]))

    return place


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end: int = END,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()
    pieces = settled(
        rows.mapInArrow(
            _pieces(tokenizer_path, capacity, end),
            f"id {id_type}, piece int, start long, length long, ids_crc32 long, source long, place long",
        )
    )
    by_source = settled(pieces.groupBy("source", "length").agg(F.count(F.lit(1)).alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_source.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one per length
        counts[row["length"]] = row["n"]
    patterns = pack(counts, capacity)
    # A window over tasks, not pieces.
    before = Window.partitionBy("length").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_source.select(
        "source", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    out = f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return (
        pieces.join(firsts, ["source", "length"])
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank"))
        .mapInArrow(_placed(patterns), out)
        .withColumnRenamed("id", id_column)
    )
