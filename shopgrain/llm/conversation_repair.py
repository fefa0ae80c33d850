"""Conversations repaired to `(system? (user assistant)+)?` by the cheapest edits.

Each row is kept, gets another role, or is deleted; empty turns may be inserted. The
edits are the edges of a directed acyclic graph over (rows read, last role), and every
edge has one scalar weight: the cost in the high digits, and in the low digits the
letter of the edit at its place in the audit. The digits of the audit have fixed width
and are filled with zeros at the end, so the smallest integer is the cheapest repair
and, of equally cheap ones, the one whose audit comes first in ASCII order. Two
different prefixes that read the same rows and end with an edit of a row are never
prefixes of each other, so one integer per role is enough.

Spark deals whole conversations and sorts their rows; a pass streams them. A long
conversation is decided in chunks of CHUNK rows: what is carried on is, per role, the
cost, the rank of the audit so far (the first digit of the next chunk), the audit and
the state of its hash. So no conversation is held in memory as a whole; its audit is, as
it is one value of the result. Equal rows are found by digests within the pass; those
of conversations of more than LONG rows are found by an aggregation before it.

Defined cases: null role and null text are one space; rows without conversation id are
one conversation; rows follow by turn (nulls first), rows of one turn by role and text;
repeated rows are duplicates and must go; a role stands for its first character, so
`s…`, `u…` and `a…` can be kept; an empty table gives no rows; columns besides the four
named ones are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARACTERS, settled

#: Costs of the edits. A truncated row that stays costs one more.
RETITLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Digits of the audit, in ASCII order of the letters; zero fills the end.
D, I, K, R = 1, 2, 3, 4
LETTERS = str.maketrans("1234", "DIKR")
WIDTH = 3  # bits of a digit
#: Rows of a conversation that are decided at once.
CHUNK = 128
#: Rows from which equal rows are found by an aggregation.
LONG = 1 << 17

#: Roles after which a role may stand; the empty state is the start.
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
#: Role of an inserted or retitled turn after each state.
GIVEN = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
ENDS = ("", "a")


def _inserts(state: str) -> list[tuple[str, int]]:
    """(state, number of inserted turns) before a row; more than two never pay."""
    one = GIVEN[state]
    return [(state, 0), (one, 1), (GIVEN[one], 2)]


BEFORE = {state: _inserts(state) for state in NEXT}


def cheapest(
    rows: list[tuple[str, bool, bool]], starts: dict[str, tuple[int, int]], last: bool
) -> dict[str, tuple[int, int, str]]:
    """For each role that the chunk can end with: cost, rank of the start and audit.

    rows: (first character of the role, must be deleted, truncated); starts: for each
    role before the chunk, the cost and the rank of its audit, from 1 on; last: turns may
    be inserted after the last row, and only complete conversations are returned.
    """
    places = 3 * len(rows) + 3  # the rank, at most three edits for a row, two at the end
    cost_one = 1 << (WIDTH * places)
    at = [1 << (WIDTH * (places - 1 - k)) for k in range(places)]
    nodes = {s: (cost * cost_one + rank * at[0], 1) for s, (cost, rank) in starts.items()}
    for initial, must_go, cut in rows:
        found: dict[str, tuple[int, int]] = {}
        for state, (value, k) in nodes.items():
            for here, inserted in BEFORE[state]:
                if inserted:
                    value += INSERT * cost_one + I * at[k]
                    k += 1
                options = [(here, DELETE * cost_one + D * at[k])]
                if not must_go:
                    stays = TRUNCATED * cost_one if cut else 0
                    if initial and initial in NEXT[here]:
                        options.append((initial, stays + K * at[k]))
                    options.append((GIVEN[here], stays + RETITLE * cost_one + R * at[k]))
                for to, weight in options:
                    if to not in found or value + weight < found[to][0]:
                        found[to] = (value + weight, k + 1)
        nodes = found
    if last:
        found = {}
        for state, (value, k) in nodes.items():
            for here, inserted in BEFORE[state]:
                if inserted:
                    value += INSERT * cost_one + I * at[k]
                    k += 1
                if here in ENDS and ("" not in found or value < found[""][0]):
                    found[""] = (value, k)
        nodes = found
    out = {}
    for state, (value, _) in nodes.items():
        cost, audit = divmod(value, cost_one)
        digits = format(audit, "o").zfill(places)
        out[state] = (cost, int(digits[0]), digits[1:].rstrip("0").translate(LETTERS))
    return out


class _Prefix:
    """What is carried from chunk to chunk for one role: cost, audit and hash so far."""

    __slots__ = ("cost", "state", "audit", "before", "sha", "empty")

    def __init__(self, cost, state, audit="", before=None, sha=None, empty=True):
        self.cost, self.state, self.audit, self.before = cost, state, audit, before
        self.sha, self.empty = sha or hashlib.sha256(), empty

    def order(self) -> str:
        parts, node = [], self
        while node:
            parts.append(node.audit)
            node = node.before
        return "".join(reversed(parts))

    def extended(self, cost: int, audit: str, rows: list[tuple[str, str]]) -> _Prefix:
        """After the edits of a chunk, whose repaired turns go into the hash."""
        state, sha, empty, at = self.state, self.sha.copy(), self.empty, 0
        for letter in audit:
            if letter == "D":
                at += 1
                continue
            if letter == "K":
                role, text = rows[at]
                state = role[:1]
            else:
                state = GIVEN[state]
                role, text = NAMES[state], rows[at][1] if letter == "R" else ""
            at += letter != "I"
            sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            empty = False
        return _Prefix(cost, state, audit, self, sha, empty)


class _Conversation:
    """One conversation, row after row."""

    def __init__(self, conv_id):
        self.id = conv_id
        self.low = self.high = self.previous = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.seen: set[bytes] = set()
        self.last = None
        self.facts: list[tuple[str, bool, bool]] = []
        self.rows: list[tuple[str, str]] = []
        self.prefixes = [_Prefix(0, "")]

    def add(self, turn, role: str, text: str, later: bool | None) -> None:
        if turn is not None and (self.high is None or turn != self.high):
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        initial = role[:1]
        if self.previous is not None and self.previous + initial not in LEGAL:
            self.illegal += 1
        self.previous = initial
        if later is not None:  # a long conversation
            repeated = later or (turn, role, text) == self.last
            self.last = (turn, role, text)
        else:
            key = hashlib.blake2b(
                f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16
            ).digest()
            repeated = key in self.seen
            self.seen.add(key)
        body = text.rstrip(SPACE_CHARACTERS)
        must_go = not body or repeated
        cut = not must_go and body[-1] not in ".!?"
        self.blank += not body
        self.duplicate += bool(body) and repeated
        self.truncated += cut
        if len(self.rows) >= CHUNK:
            self.decide(last=False)
        self.facts.append((initial, must_go, cut))
        self.rows.append((role, text))

    def decide(self, last: bool) -> None:
        ranked = sorted(self.prefixes, key=_Prefix.order) if len(self.prefixes) > 1 else self.prefixes
        starts = {p.state: (p.cost, rank) for rank, p in enumerate(ranked, start=1)}
        found = cheapest(self.facts, starts, last)
        self.prefixes = [ranked[rank - 1].extended(cost, audit, self.rows) for cost, rank, audit in found.values()]
        self.facts, self.rows = [], []

    def result(self) -> tuple:
        self.decide(last=True)
        (best,) = self.prefixes
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (
            self.id,
            gaps,
            self.blank,
            self.duplicate,
            self.truncated,
            self.illegal,
            best.cost,
            best.order(),
            best.sha.hexdigest(),
        )


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from rows in order of (id, turn, role, text)."""
    current: _Conversation | None = None

    def out(results: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*results, strict=True))
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", *RESULT]
        )

    kind = None
    for batch in batches:
        kind = batch.column("id").type
        columns = (batch.column(c).to_pylist() for c in ("id", "turn", "role", "text", "there", "later"))
        done = []
        for conv_id, turn, role, text, there, later in zip(*columns, strict=True):
            if current is None or current.id != conv_id:
                if current is not None:
                    done.append(current.result())
                current = _Conversation(conv_id)
            if there:
                current.add(turn, role, text, later)
        if done:
            yield out(done, kind)
    if current is not None:
        yield out([current.result()], kind)


def _marked(rows: DataFrame, long: int) -> DataFrame:
    """rows with `later`: null, but in long conversations whether an equal row has an earlier turn.

    Equal rows of one turn are neighbours when the rows are sorted.
    """
    counts = rows.where("there").groupBy("id").count()
    long_ids = settled(counts.where(F.col("count") > long).select(F.col("id").alias("of")))
    if long_ids.isEmpty():
        return rows.withColumn("later", F.lit(None).cast("boolean"))
    # At most one id in `long` rows.
    is_long = F.col("id").eqNullSafe(F.col("of"))
    others = rows.join(F.broadcast(long_ids), is_long, "left_anti").withColumn("later", F.lit(None).cast("boolean"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    longs = rows.join(F.broadcast(long_ids), is_long, "left_semi").withColumns({"digest": digest, "at": turn})
    firsts = longs.where("there").groupBy(F.col("id").alias("of"), F.col("digest").alias("like")).agg(F.min("at").alias("first"))
    same = is_long & (F.col("digest") == F.col("like"))
    later = longs.join(firsts, same, "left").withColumn("later", F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
    return others.unionByName(later.select(*others.columns))


def repaired(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    there: Column | None = None,
    long: int = LONG,
) -> DataFrame:
    """One row per conversation: its faults, the cost and letters of its repair, the hash
    of the repaired conversation.

    Rows where `there` is not true only say that their conversation exists.
    """
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{turn_column}`").cast("long").alias("turn"),
        space(role_column).alias("role"),
        space(text_column).alias("text"),
        (F.lit(True) if there is None else F.coalesce(there, F.lit(False))).alias("there"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    out = f"id {kind}, {', '.join(c + ' long' for c in RESULT[:6])}, audit string, repaired_sha256 string"
    order = ("id", F.col("turn").asc_nulls_first(), "role", "text")
    sorted_rows = _marked(rows, long).repartition("id").sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(_repair, out).withColumnRenamed("id", id_column)


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations with planted faults, by checksum of `conv_id:turn`, and `there`: false
    for a row that is dropped. Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") != 0).alias("there"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
