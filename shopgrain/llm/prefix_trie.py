"""The trie of conversation prefixes, as intervals of sorted conversations.

1. A turn becomes a token (128 bits of a digest of role and text) and its word count. A
   pass over sorted turns writes each conversation as segments of at most BLOCK tokens,
   with a digest of all tokens before the segment: a prefix is a digest and a run of
   tokens, however long the conversation is.
2. Spark sorts the segments by (block, digest, tokens), in ranges that cut even groups
   of equal conversations, and numbers them; PIECE_BITS of the number make a piece.
3. In a piece, the longest common prefixes (LCPs) of neighbours and a sparse table of
   their range minima are arrays. A candidate is a prefix that a segment does not share
   with the one before it. For each candidate two binary searches over the table, one to
   the left and one to the right, find the interval of its members. Counts are
   differences of running sums over the interval.
4. Prefixes that a neighbouring piece or a later block shares come out in parts, with
   the digest of the prefix, and are added up by it: at most two paths per piece.

Of the nodes of a subtree, each is counted at the first of its members. The sums of
blocks behind a segment are added to it from a first pass over those blocks, which only
runs where some conversation is longer than a block.

Defined cases: null role and text are empty; rows without conversation id are no
conversation; turns follow by number (nulls first), rows of one turn by token; repeated
rows are turns of their own; a conversation of nulls and empty texts is one of empty
turns; an empty table has no node, not even a root; columns besides the four named ones
are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, settled

#: Bytes of a token and tokens of a segment.
TOKEN, BLOCK = 16, 64
#: Segments of a piece, as bits of their number.
PIECE_BITS = 14
LAST = (1 << 63) - 1

SEGMENT = "conv long, block long, before binary, tokens binary, words array<long>, goes_on boolean"
NODE = (
    "key binary, piece long, parent_key binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
)
KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    arrays = [pa.array(c, KINDS.get(k, pa.list_(pa.int64()))) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def _digest(before: bytes, tokens: bytes) -> bytes:
    return hashlib.blake2b(before + tokens, digest_size=TOKEN).digest()


def _segments(block: int):
    """Segments of conversations, from their turns in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, skip, number, before, tokens, words = None, 0, 0, b"", [], []
        out: list[tuple] = []

        def done(goes_on: bool) -> None:
            out.append((conv, number, before, b"".join(tokens), words, goes_on))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv", "own", "token", "words", "skip"))
            for c, own, token, n_words, to_skip in zip(*columns, strict=True):
                if c != conv:
                    if conv is not None:
                        done(False)
                    conv, skip, number, before, tokens, words = c, to_skip, 0, b"", [], []
                if own and skip:
                    skip -= 1
                    continue
                if len(tokens) == block:
                    done(True)
                    before, number = _digest(before, b"".join(tokens)), number + 1
                    tokens, words = [], []
                tokens.append(token)
                words.append(n_words)
            if out:
                yield _batch(SEGMENT, list(zip(*out, strict=True)))
                out = []
        if conv is not None:
            done(False)
            yield _batch(SEGMENT, list(zip(*out, strict=True)))

    return cut


def _common(a: bytes, b: bytes) -> int:
    """Tokens that two runs of tokens begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TOKEN
    differ = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(differ.argmax()) // TOKEN


class RangeMinima:
    """Minima of runs of an array, from a table of the runs whose lengths are powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half, low = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minimum from start to end, both included."""
        level = np.frexp((end - start + 1).astype(np.float64))[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for k, row in enumerate(self.levels):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(row[start[at]], row[end[at] - (1 << k) + 1])
        return out

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Last place to which the values after `at` stay at or above the bound."""
        place, size = at + 1, len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            row = self.levels[k]
            fits = place + (1 << k) <= size
            fits &= row[np.minimum(place, len(row) - 1)] >= bound
            place = place + (fits << k)
        return place - 1

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """First place from which the values behind it, up to `at`, stay at or above the bound."""
        place = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            row, start = self.levels[k], place - (1 << k) + 1
            fits = (start >= 1) & (row[np.maximum(start, 0)] >= bound)
            place = place - (fits << k)
        return place


class _Piece:
    """Sorted segments that are neighbours, with the LCPs to the segments on either side."""

    def __init__(self, rows: dict[str, list], before: tuple | None, behind: tuple | None, block: int):
        self.block, self.rows = block, rows
        self.conv, self.number = (np.array(rows[c], np.int64) for c in ("conv", "block"))
        self.goes_on = np.array(rows["goes_on"], bool)
        self.size = np.array([len(t) // TOKEN for t in rows["tokens"]], np.int64)
        n = len(self.conv)
        own = list(zip(rows["block"], rows["before"], rows["tokens"], strict=True))
        shared = lambda a, b: _common(a[2], b[2]) if a and b and a[:2] == b[:2] else -1
        self.lcp = np.array([shared(a, b) for a, b in zip([before, *own], own)], np.int64)  # noqa: B905
        self.lcp_behind = shared(own[-1], behind)
        #: Running sums of words in a segment; place `at` is no token.
        self.at = np.concatenate([[0], np.cumsum(self.size + 1)])[:-1]
        flat = np.zeros(int((self.size + 1).sum()), np.int64)
        flat[np.delete(np.arange(len(flat)), self.at)] = [w for words in rows["words"] for w in words]
        total = np.cumsum(flat)
        self.words = total - np.repeat(total[self.at], self.size + 1)
        #: Words of the segment, those of prefixes that begin here, and leaves.
        self.all_words = self.words_to(np.arange(n), self.size)
        self.new_words = self.all_words - self.words_to(np.arange(n), np.maximum(self.lcp, 0))
        next_lcp = np.append(self.lcp[1:], self.lcp_behind)
        self.leaf = (~self.goes_on & (next_lcp < self.size)).astype(np.int64)

    def words_to(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.words[self.at[row] + depth]

    def key(self, row: int, depth: int) -> bytes:
        before, tokens = self.rows["before"][row], self.rows["tokens"][row]
        return _digest(before, tokens[: depth * TOKEN]) if depth else before

    def tails(self) -> list:
        return [self.conv, self.number, self.all_words - self.new_words, self.leaf]

    def nodes(self, piece: int) -> Iterator[list]:
        n = len(self.conv)
        base = np.where(self.number == 0, 0, 1)
        from_depth = np.maximum(self.lcp + 1, base)
        from_depth[0] = base[0]  # also what the piece before has begun
        per_row = np.maximum(self.size - from_depth + 1, 0)
        offset = np.concatenate([[0], np.cumsum(per_row)])
        row = np.repeat(np.arange(n), per_row)
        depth = np.arange(len(row)) - offset[row] + from_depth[row]
        minima = RangeMinima(self.lcp)
        left, right = minima.left(row, depth), minima.right(row, depth)
        running = lambda x: np.concatenate([[0], np.cumsum(x)])
        over = lambda sums: sums[right + 1] - sums[left]
        n_convs = right - left + 1
        conv_id = RangeMinima(self.conv).least(left, right)
        tail_saved, tail_leaves = (np.array(self.rows[c], np.int64) for c in ("tail_saved", "tail_leaves"))
        n_leaves = over(running(self.leaf + tail_leaves))
        above = np.maximum(depth - 1, 0)
        begun = over(running(self.new_words)) - self.new_words[left]
        begun += self.all_words[left] - self.words_to(left, np.maximum(np.maximum(self.lcp[left], above), 0))
        saved = over(running(self.all_words + tail_saved)) - n_convs * self.words_to(left, above) - begun

        # The parent of a prefix is the one shorter prefix whose interval holds its row.
        inner = np.flatnonzero(depth > base[row])
        parent_row = minima.left(row[inner], depth[inner] - 1)
        parent = offset[parent_row] + depth[inner] - 1 - from_depth[parent_row]
        n_children = np.zeros(len(row), np.int64)
        begins = depth[inner] > self.lcp[row[inner]]  # else the piece before has counted it
        np.add.at(n_children, parent[begins], 1)

        opened = (left == 0) & (depth <= self.lcp[0]) | (right == n - 1) & (depth <= self.lcp_behind)
        opened |= (depth == self.block) & (over(running(self.goes_on)) > 0)
        parent_conv = np.full(len(row), -1, np.int64)
        parent_conv[inner] = conv_id[parent]
        unknown = np.zeros(len(row), bool)
        unknown[inner] = opened[parent]
        across = (depth == 1) & (self.number[row] > 0)  # the parent ends the block before
        unknown |= across
        known = np.zeros(len(row), bool)
        known[inner] = ~opened[parent]

        same_end = np.zeros(n, bool)  # ends the same conversation as the row before
        same_end[1:] = (self.lcp[1:] == self.size[1:]) & (self.size[:-1] == self.size[1:]) & ~self.goes_on[1:]
        starts = np.flatnonzero(~same_end)
        run_end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
        ending = (self.size[row] == depth) & ~self.goes_on[row] & (row == left)
        names = [str(c) for c in self.conv.tolist()]
        empty = hashlib.sha256().hexdigest()

        for start in range(0, len(row), 1 << 16):
            part = range(start, min(start + (1 << 16), len(row)))
            keys, parents, ends = [], [], []
            for i in part:
                r, d = int(row[i]), int(depth[i])
                text = ",".join(names[r : int(run_end[r])]) if ending[i] else ""
                keys.append(self.key(r, d) if opened[i] else None)
                parents.append(self.key(r, d - 1) if unknown[i] or opened[i] and d > base[r] else None)
                ends.append(text if opened[i] else hashlib.sha256(text.encode()).hexdigest() if text else empty)
            cut = slice(start, part.stop)
            yield [
                keys,
                np.full(len(part), piece),
                parents,
                conv_id[cut],
                depth[cut] + self.block * self.number[row[cut]],
                pa.array(parent_conv[cut], mask=~known[cut]),
                n_convs[cut],
                n_children[cut],
                n_leaves[cut],
                saved[cut],
                ends,
            ]
        first = np.flatnonzero(across & (depth > self.lcp[row]))
        if len(first):  # children of prefixes that end the block before
            none, zero = [None] * len(first), np.zeros(len(first), np.int64)
            keys = [self.key(int(row[i]), 0) for i in first]
            above = self.block * self.number[row[first]]
            yield [keys, zero + piece, none, none, above, none, zero, zero + 1, zero, zero, [""] * len(first)]


def _pieces(block: int, tails: bool):
    """Nodes, or sums of segments, of pieces; rows come in order of (piece, at)."""
    names = ("conv", "block", "before", "tokens", "words", "goes_on", "tail_saved", "tail_leaves")
    schema = "conv long, block long, saved long, leaves long" if tails else NODE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, before, behind = None, None, None
        rows: dict[str, list] = {c: [] for c in names}

        def done() -> Iterator[pa.RecordBatch]:
            if rows["conv"]:
                found = _Piece(rows, before, behind, block)
                for columns in [found.tails()] if tails else found.nodes(current):
                    yield _batch(schema, columns)

        for batch in batches:
            pieces, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("piece", "at"))
            cuts = [0, *(np.flatnonzero(pieces[1:] != pieces[:-1]) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                if pieces[start] != current:
                    yield from done()
                    current, before, behind, rows = int(pieces[start]), None, None, {c: [] for c in names}
                part = batch.slice(start, end - start)
                sides = [part.column(c) for c in ("block", "before", "tokens")]
                if at[start] == -1:
                    before = tuple(c[0].as_py() for c in sides)
                    part = part.slice(1)
                if at[end - 1] == LAST:
                    behind = tuple(c[-1].as_py() for c in sides)
                    part = part.slice(0, part.num_rows - 1)
                for c in names:
                    rows[c].extend(part.column(c).to_pylist())
        yield from done()

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes from their parts, in order of (key, piece)."""
    out, now, sha = [], None, None

    def done() -> None:
        now["ends"] = sha.hexdigest()
        out.append([now[f.split()[0]] for f in NODE.split(", ")])

    for batch in batches:
        for part in batch.to_pylist():
            if now is None or part["key"] != now["key"]:
                if now:
                    done()
                now, sha, empty = part, hashlib.sha256(), True
            else:
                for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    now[c] += part[c]
                ids = [x for x in (now["conv_id"], part["conv_id"]) if x is not None]
                now["conv_id"] = min(ids, default=None)
                for c in ("parent_key", "parent_conv_id"):
                    now[c] = part[c] if now[c] is None else now[c]
            if part["ends"]:
                sha.update(part["ends"].encode() if empty else b"," + part["ends"].encode())
                empty = False
        if out:
            yield _batch(NODE, list(zip(*out, strict=True)))
            out = []
    if now:
        done()
        yield _batch(NODE, list(zip(*out, strict=True)))


def _neighbours(rows: DataFrame) -> DataFrame:
    """For each piece, the segments before and behind it, at -1 and at LAST."""
    side = F.struct("block", "before", "tokens")
    ends = settled(rows.groupBy("piece").agg(F.min_by(side, "at").alias("first"), F.max_by(side, "at").alias("last")))
    order = Window.orderBy("piece")  # over pieces, not rows
    beside = ends.select("piece", F.lag("last").over(order).alias("l"), F.lead("first").over(order).alias("r"))
    marks = F.array(F.struct(F.lit(-1).cast("long").alias("at"), F.col("l").alias("s")), F.struct(F.lit(LAST).alias("at"), F.col("r").alias("s")))
    return beside.select("piece", F.inline(marks)).where("s is not null").select("piece", "at", "s.*")


def trie(turns: DataFrame, block: int = BLOCK, piece_bits: int = PIECE_BITS) -> DataFrame:
    """The nodes of rows (conv, own, turn, token, words, skip): the first `skip` rows with
    `own` of a conversation are left out, those without `own` come first."""
    order = ("conv", "own", F.col("turn").asc_nulls_first(), "token")
    dealt = turns.repartition("conv").sortWithinPartitions(*order)
    segments = settled(dealt.mapInArrow(_segments(block), SEGMENT))
    key = ("block", "before", "tokens", "goes_on", "conv")
    rows = settled(
        segments.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("at", F.monotonically_increasing_id())
    ).withColumn("piece", F.shiftright("at", piece_bits))
    beside = settled(_neighbours(rows))
    none = F.lit(0).cast("long")
    plain = rows.withColumns({"tail_saved": none, "tail_leaves": none})

    def over_pieces(rows: DataFrame, tails: bool, schema: str) -> DataFrame:
        both = rows.unionByName(beside, allowMissingColumns=True)
        return both.repartition("piece").sortWithinPartitions("piece", "at").mapInArrow(_pieces(block, tails), schema)

    deep = plain.where("block > 0")
    if not deep.isEmpty():
        sums = over_pieces(deep, True, "conv long, block long, saved long, leaves long")
        behind = Window.partitionBy("conv").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, 0)
        tail = sums.select(
            "conv",
            (F.col("block") - 1).alias("block"),
            F.sum("saved").over(behind).alias("tail_saved"),
            F.sum("leaves").over(behind).alias("tail_leaves"),
        )
        plain = plain.where("not goes_on").unionByName(rows.where("goes_on").join(tail, ["conv", "block"]))
    nodes = settled(over_pieces(plain, False, NODE))
    parts = nodes.where("key is not null").repartition("key").sortWithinPartitions("key", "piece")
    merged = settled(parts.mapInArrow(_merged, NODE))
    every = nodes.where("key is null").unionByName(merged)
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("joined"))
    linked = every.where("parent_key is not null").join(parents, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "joined"))
    out = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))
    return every.where("parent_key is null").select(*out).unionByName(linked.select(*out))


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        plain(role).alias("role"),
        plain(text).alias("text"),
    )
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    token = F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * TOKEN))
    words = F.regexp_count("text", F.lit(SPACE.replace("[", "[^") + "+")).cast("long")
    return rows.select("conv", "turn", token.alias("token"), words.alias("words"))


def prefixes(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row per prefix of the conversations as they are."""
    turns = _turns(conversations, id_column, turn_column, role_column, text_column)
    return trie(turns.withColumns({"own": F.lit(True), "skip": F.lit(0)}))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Turns of conversations whose first h turns are those of conversation c - c % 20, with
    h the checksum of c modulo 4; own turns are left out by `skip`."""
    turns = _turns(conversations, "conv_id", "turn", "role", "text")
    head: Column = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    base = F.col("conv") - F.pmod("conv", F.lit(20))
    places = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "token")
    first = (
        turns.where(F.pmod("conv", F.lit(20)) == 0)
        .withColumn("k", F.row_number().over(places))
        .where("k <= 3")
        .withColumnRenamed("conv", "base")
    )
    wanted = turns.select("conv").distinct().select("conv", base.alias("base"), head.alias("h"))
    given = wanted.where("h > 0").join(first, "base").where("k <= h")
    columns = lambda df, own: df.select("conv", F.lit(own).alias("own"), "turn", "token", "words", head.alias("skip"))
    return columns(turns, True).unionByName(columns(given, False))
