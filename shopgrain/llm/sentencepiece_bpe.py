"""Encoding with a SentencePiece BPE vocabulary by backtracking, and decoding.

The merges of byte-pair encoding end in the one sequence of pieces in which every two
neighbours stay apart when the merges are run again on just these two. So the encoder
never runs merges over the text. From each position it takes the longest piece that
matches there (all matches come from one Aho-Corasick pass), checks it against the piece
before it by re-merging the two, and falls back to the next shorter piece, or to the
piece before, when they do not stand. A bitfield remembers positions from which no
sequence goes on. Checks of pairs are remembered, as are the ids of words.

A text splits into parts that no piece crosses: before a run of spaces, and around line
breaks. The parts are encoded one by one. Characters without a piece become byte pieces.

Defined cases: null and empty text have no pieces, so only begin and end id; repeated
rows and null ids are rows like others; an empty table gives no rows; columns besides id
and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"  # stands for a blank in pieces; a fixed value
PARTS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: Parts and pairs that a worker remembers, for all its tasks; beyond that it starts anew.
REMEMBERED = 600_000


class Vocabulary:
    """Pieces of a model file, their merge order, and what the encoder derives from them.

    Only models that keep text as it is (no normalisation but blanks for spaces and one
    blank in front), merge by score and have byte pieces are taken.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        probe = "Aé éﬁ  x "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model normalises text; this encoder does not")
        size = model.vocab_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        kinds = [(model.is_control(i) or model.is_unknown(i), model.is_byte(i)) for i in range(size)]
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if kinds[i][1]}
        self.ids = {p: i for i, p in enumerate(self.pieces) if not any(kinds[i])}
        self.rank = {p: -model.get_score(i) for p, i in self.ids.items()}
        if len(self.byte_ids) != 256 or any(not SPACE * len(p) == p and SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces cross words, or bytes are missing")
        self.raw = [
            b"" if kinds[i][0] else bytes([int(p[3:5], 16)]) if kinds[i][1] else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.is_byte = [k[1] for k in kinds]
        self.matches = ahocorasick.Automaton()
        for p in self.ids:
            self.matches.add_word(p, p)
        self.matches.make_automaton()
        self.shorter = {p: self._longest_start(p) for p in self.ids}  # next shorter piece that it starts with
        self.pairs: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, bytes] = {}

    def _longest_start(self, piece: str) -> str | None:
        return next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), None)

    def merged(self, text: str) -> list[str]:
        """The merges themselves: best rank first, then leftmost. For two pieces at a time."""
        out = list(text)
        rank = self.rank
        while len(out) > 1:
            best = min(
                ((rank[out[i] + out[i + 1]], i) for i in range(len(out) - 1) if out[i] + out[i + 1] in rank),
                default=None,
            )
            if best is None:
                break
            i = best[1]
            out[i : i + 2] = [out[i] + out[i + 1]]
        return out

    def stand(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces come out as they are when merged again."""
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(left + right) == [left, right]
        return found

    def split(self, part: str) -> list[str]:
        """The pieces of a part; characters without a piece stand alone."""
        if part in self.ids and self.merged(part) == [part]:
            return [part]
        longest: list[str | None] = [None] * len(part)
        for last, piece in self.matches.iter(part):
            start = last + 1 - len(piece)
            if longest[start] is None or len(piece) > len(longest[start]):
                longest[start] = piece
        failed = 0  # bit i: nothing from position i ends well
        out: list[str] = []
        at = 0
        piece = longest[0] or part[0]
        while True:
            known = piece in self.ids
            after = at + len(piece)
            if not failed >> after & 1 and (
                not out or not known or out[-1] not in self.ids or self.stand(out[-1], piece)
            ):
                out.append(piece)
                if after == len(part):
                    return out
                at, piece = after, longest[after] or part[after]
                continue
            shorter = self.shorter[piece] if known else None
            while shorter is None:  # back to the piece before, and make it shorter
                failed |= 1 << at
                piece = out.pop()
                at -= len(piece)
                shorter = self.shorter.get(piece)
            piece = shorter

    def part_ids(self, part: str) -> bytes:
        ids: list[int] = []
        for piece in self.split(part):
            known = self.ids.get(piece)
            if known is None:
                ids += [self.byte_ids[b] for b in piece.encode("utf-8")]
            else:
                ids.append(known)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, begin and end id included, as little-endian unsigned 32-bit."""
        found = []
        if text:
            parts = self.parts
            for part in PARTS.findall(SPACE + text.replace(" ", SPACE)):
                ids = parts.get(part)
                if ids is None:
                    if len(parts) >= REMEMBERED:
                        parts.clear()
                    ids = parts[part] = self.part_ids(part)
                found.append(ids)
        ends = np.array([self.begin, self.end], "<u4").tobytes()
        return ends[:4] + b"".join(found) + ends[4:]

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces in order, bytes as UTF-8, the blank in front left out."""
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _coded(path: str):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column("text"):
                ids = vocabulary.encode(text.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(vocabulary.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return code


def _rows(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, str]:
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    return rows, rows.schema["id"].dataType.simpleString()


def encoded(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and `ids`: the whole text's token ids, begin and end id included."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            ids = [np.frombuffer(vocabulary.encode(t.as_py() or ""), "<u4") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))], names=["id", "ids"]
            )

    rows, kind = _rows(docs, id_column, text_column)
    return rows.mapInArrow(code, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decoded(ids: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """id and `text` of token ids; null ids give an empty text."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            texts = [vocabulary.decode(np.array(i.as_py() or [], "<u4").tobytes()) for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    rows = ids.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{ids_column}`").alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(code, f"id {kind}, text string").withColumnRenamed("id", id_column)


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256."""
    rows, kind = _rows(docs, id_column, text_column)
    out = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(_coded(path), out).withColumnRenamed("id", id_column)
