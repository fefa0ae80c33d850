"""Near-duplicates by HyperMinHash registers in bands, confirmed on full sets.

1. Each text becomes its set of five-word shingles, a digest of the set, and 256
   registers (hyperminhash_sketch). Texts with equal sets form one class.
2. A class has 64 bands of six registers. Band keys are dealt into sorted
   ranges, so that a very frequent key spreads over many ranges; classes of equal key
   are neighbours. Of pairs of just 75 % similarity, four in a million share no band.
3. Within a key each class is compared with the first one: the collision-corrected
   estimate drops pairs that cannot link, the others are confirmed on full sets.
4. Links give components. Keys whose classes are then in one component are done. In the
   others, all pairs between different components are estimated, in blocks of bounded
   size, and those left are confirmed too. So no link found by a band is lost, while a
   large group of near copies costs one comparison per member and key.
5. Components of all links; the smallest id of each names it.

Defined cases: null text and text without words have an empty set, link with nothing and
stay; repeated rows and equal sets are in one component; sets whose smallest id is the
same are taken as linked; a row without id links nothing, its component is that of an
equal set or null, and it stays only where it has no words; empty tables give no rows;
only the id and text columns are read, `deduplicated` passes all columns through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hyperminhash_sketch as sketch
from .common import settled, sieve, through
from .components import components

PERCENT = 75
#: Members of a block in which all pairs are estimated: a member of m travels m / BLOCK times.
BLOCK = 1024
#: Texts of a group that is confirmed against one text.
PART = 256
#: Tasks among which the pairs of one text are dealt.
SALTS = 32
CHUNK_PAIRS = 100_000


def _binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _binary(batch.column("text"))
        for at in range(0, batch.num_rows, 1024):
            sizes, keys, registers = [], [], []
            for text in texts.slice(at, 1024):
                found = sketch.shingles(text.as_py() or b"")
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                registers.append(sketch.registers(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(at, 1024) for c in ("id", "row_a", "row_b")),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(registers, pa.binary()),
                ],
                names=["id", "row_a", "row_b", "n", "key", "registers"],
            )


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            row, number, band = sketch.band_keys(
                _matrix(part.column("registers"), np.uint16, sketch.BUCKETS)
            )
            n = part.column("n").to_numpy()[row] * sketch.BANDS + number
            yield pa.RecordBatch.from_arrays(
                [pa.array(band), part.column("cls").take(pa.array(row)), pa.array(n)],
                names=["band", "cls", "n"],
            )


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut = sketch.small(_matrix(batch.column("registers"), np.uint16, sketch.BUCKETS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("cls"), batch.column("n"), pa.array([r.tobytes() for r in cut], pa.binary())],
            names=["cls", "n", "small"],
        )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes that share a band key, from rows in order of (band, cls).

    The first and the last key of a range can go on in another one: their rows come out
    with `edge` set, also where they are alone here.
    """
    names = ["band", "cls", "n", "first", "first_n", "edge"]
    held: list[np.ndarray] = []
    is_first = True

    def out(rows: np.ndarray, starts: np.ndarray, lengths: np.ndarray, edge: bool) -> pa.RecordBatch:
        heads = np.repeat(starts, lengths)
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array(rows[:, i]) for i in range(3)),
                pa.array(rows[heads, 1]),
                pa.array(rows[heads, 2]),
                pa.array(np.full(len(rows), edge)),
            ],
            names=names,
        )

    def whole_run(edge: bool) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        if edge or len(rows) > 1:
            yield out(rows, np.array([0]), np.array([len(rows)]), edge)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
        cuts = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
        if held and held[-1][-1, 0] != rows[0, 0]:
            cuts = np.concatenate([[0], cuts])
        if not len(cuts):
            held.append(rows)
            continue
        if cuts[0]:
            held.append(rows[: cuts[0]])
        yield from whole_run(is_first)
        is_first = False
        inner, lengths = cuts[:-1], np.diff(cuts)
        keep = lengths > 1
        if keep.any():
            rows_kept = np.repeat(keep, lengths)
            middle = rows[cuts[0] : cuts[-1]][rows_kept]
            kept = lengths[keep]
            yield out(middle, np.concatenate([[0], np.cumsum(kept)[:-1]]), kept, False)
        held = [rows[cuts[-1] :]]
    if held:
        yield from whole_run(True)


def _shared_bands(classes: DataFrame) -> DataFrame:
    """(band, cls, n, first, first_n): classes with a band key that another one has too.

    The numbers n are the set's size times BANDS plus the number of the band.
    """
    bands = classes.mapInArrow(_bands, "band long, cls long, n long")
    runs = settled(
        bands.repartitionByRange("band", "cls")
        .sortWithinPartitions("band", "cls")
        .mapInArrow(_runs, "band long, cls long, n long, first long, first_n long, edge boolean")
    )
    # At most two keys of each range are edges: small however large the input is.
    edges = F.broadcast(
        runs.where("edge")
        .groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.min(F.struct("first", "first_n")).alias("whole"),
        )
    )
    return (
        runs.join(edges, "band", "left")
        .where(~F.col("edge") | (F.col("members") > 1))
        .select(
            "band",
            "cls",
            "n",
            F.when(F.col("edge"), F.col("whole.first")).otherwise(F.col("first")).alias("first"),
            F.when(F.col("edge"), F.col("whole.first_n")).otherwise(F.col("first_n")).alias("first_n"),
        )
    )


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a = _matrix(batch.column("small_a"), np.uint8, sketch.BUCKETS)
        b = _matrix(batch.column("small_b"), np.uint8, sketch.BUCKETS)
        n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
        may = pa.array(sketch.may_link(a, b, n_a, n_b, PERCENT))
        yield batch.select(["a", "b"]).filter(may)


def _first_pairs(shared: DataFrame, smalls: DataFrame) -> DataFrame:
    """Pairs (a, b) of a class and the first one of a band key, that may link."""
    sizes = [F.floor(F.col(n) / sketch.BANDS) for n in ("n", "first_n")]
    low, high = F.least(*sizes), F.greatest(*sizes)
    pairs = (
        shared.where((F.col("cls") != F.col("first")) & (100 * low >= PERCENT * high))
        .select(F.col("cls").alias("a"), F.col("first").alias("b"))
        .distinct()
    )
    of = lambda side: smalls.select(
        F.col("cls").alias(side), F.col("n").alias(f"n_{side}"), F.col("small").alias(f"small_{side}")
    )
    return pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(_estimate, "a long, b long")


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs between components within blocks, from rows in order of (band, low, high).

    A pair comes out only in the first band that both sketches share, in whole registers
    as in the band's key: it is sure to meet there.
    """
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    n_waiting = 0
    held: pa.Table | None = None
    columns = ["cls", "component", "n", "block", "number"]

    def decided(table: pa.Table, registers: np.ndarray, small: np.ndarray) -> Iterator[pa.RecordBatch]:
        nonlocal n_waiting, waiting
        i, j = (np.concatenate(x) for x in zip(*waiting, strict=True))
        waiting, n_waiting = [], 0
        n, cls = (table.column(c).to_numpy() for c in ("n", "cls"))
        may = sketch.may_link(small[i], small[j], n[i], n[j], PERCENT)
        i, j = i[may], j[may]
        if len(i):
            a, b = registers[i], registers[j]
            alike = (a == b)[:, sketch.IN_BAND].all(axis=2) & (a != sketch.EMPTY)[:, sketch.IN_BAND].any(axis=2)
            first = alike.argmax(axis=1) >= table.column("number").to_numpy()[i]
            i, j = i[first], j[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.maximum(cls[i], cls[j])), pa.array(np.minimum(cls[i], cls[j]))], names=["a", "b"]
        )

    def groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal n_waiting
        keys = np.stack([table.column(c).to_numpy() for c in ("band", "low", "high")], axis=1)
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        cls, component, n, block, _ = (table.column(c).to_numpy() for c in columns)
        registers = _matrix(table.column("registers").combine_chunks(), np.uint16, sketch.BUCKETS)
        whole = (table, registers, sketch.small(registers))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
            _, low, high = keys[start]
            rows = np.arange(start, end)
            if low == high:
                i, j = (rows[x] for x in np.triu_indices(len(rows), 1))
            else:
                x, y = rows[block[rows] == low], rows[block[rows] == high]
                i, j = np.repeat(x, len(y)), np.tile(y, len(x))
            differ = (component[i] != component[j]) & (
                100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
            )
            i, j = i[differ], j[differ]
            for at in range(0, len(i), CHUNK_PAIRS):
                waiting.append((i[at : at + CHUNK_PAIRS], j[at : at + CHUNK_PAIRS]))
                n_waiting += len(waiting[-1][0])
                if n_waiting >= CHUNK_PAIRS:
                    yield from decided(*whole)
        if waiting:
            yield from decided(*whole)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < 4096:
            continue
        keys = [held.column(c).to_numpy() for c in ("band", "low", "high")]
        ends = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if len(ends):
            yield from groups(held.slice(0, int(ends[-1])).combine_chunks())
            held = held.slice(int(ends[-1]))
    if held is not None and held.num_rows:
        yield from groups(held.combine_chunks())


def _other_pairs(shared: DataFrame, sketches: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that share a band key, are in different components of
    `found` and may link."""
    component = F.coalesce("component", "cls")
    members = settled(
        shared.join(found.withColumnRenamed("node", "cls"), "cls", "left").select(
            "band", "cls", component.alias("component"), F.col("n").alias("packed")
        )
    )
    split = (
        members.groupBy("band")
        .agg(F.min("component").alias("one"), F.max("component").alias("other"), F.count(F.lit(1)).alias("m"))
        .where("one != other")
        .select("band", F.ceil(F.col("m") / BLOCK).cast("long").alias("blocks"))
    )
    rows = (
        members.join(split, "band")
        .join(sketches, "cls")
        .withColumn("number", F.pmod("packed", F.lit(sketch.BANDS)))
        .drop("packed")
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "with"), "high": F.greatest("block", "with")})
        .drop("with", "blocks")
        .repartition("band", "low", "high")
        .sortWithinPartitions("band", "low", "high")
    )
    return rows.mapInArrow(_block_pairs, "a long, b long")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows in order of (b, part, a), the text of b itself first (a null)."""
    last, sets = None, []
    for batch in batches:
        b, part, a = (batch.column(c).to_pylist() for c in ("b", "part", "a"))
        texts = _binary(batch.column("text"))
        links = []
        for i in range(batch.num_rows):
            if (b[i], part[i]) != last:
                last, sets = (b[i], part[i]), []
            found = sketch.shingles(texts[i].as_py() or b"")
            if a[i] is None:
                sets.append(found)
            elif any(sketch.linked(found, one, PERCENT) for one in sets):
                links.append((a[i], b[i]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
        )


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that link, on full sets. Texts meet the text of b in parts of PART."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy("b").agg(
        F.ceil(F.count(F.lit(1)) / PART).cast("long").alias("parts"), F.collect_set("salt").alias("salts")
    )
    one = (
        parts.join(texts.select(F.col("id").alias("b"), "text"), "b")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("b", "part", F.lit(None).cast("long").alias("a"), "text")
    )
    # A text may have a link to a third of all others: its pairs meet their parts in SALTS tasks.
    other = (
        salted.join(parts.select("b", "parts", F.explode("salts").alias("salt")), ["b", "salt"])
        .withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")))
        .join(texts.select(F.col("id").alias("a"), "text"), "a")
        .select("b", "part", "a", "text")
    )
    return (
        one.unionByName(other)
        .repartition("b", "part")
        .sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
        .mapInArrow(_confirm, "a long, b long")
        .distinct()
    )


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of these ids; the sieve keeps most others out of the shuffle."""
    ids = settled(ids)
    likely = through(texts, sieve(ids, "id"), "id").where("_sieve_hit").drop("_sieve_hit")
    return settled(likely.join(ids, "id", "left_semi"))


def _row_keys(id_column: str, text_column: str) -> tuple[Column, Column]:
    """128 bits that name the id and the whole text of a row; null ids have their own."""
    id_, text = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`").cast("string")
    parts = (id_.isNull(), id_, text.isNull(), text)
    return F.xxhash64(F.lit("a"), *parts).alias("row_a"), F.xxhash64(F.lit("b"), *parts).alias("row_b")


def _members(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per document: id, row_a, row_b, n, component, kept."""
    keyed = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
        *_row_keys(id_column, text_column),
    )
    texts = keyed.select("id", "text")
    rows = settled(keyed.mapInArrow(_sketches, "id long, row_a long, row_b long, n long, key binary, registers binary"))
    classes = settled(
        rows.where("key is not null and id is not null")
        .groupBy("key")
        .agg(
            F.min("id").alias("cls"),
            F.any_value("n").alias("n"),
            F.any_value("registers").alias("registers"),
        )
    )
    sketches = classes.select("cls", "n", "registers")
    shared = _shared_bands(sketches)
    smalls = sketches.mapInArrow(_small, "cls long, n long, small binary")
    side = lambda pairs, name: pairs.select(F.col(name).alias("id")).distinct()
    sides = lambda pairs: side(pairs, "a").unionByName(side(pairs, "b")).distinct()

    first = settled(_first_pairs(shared, smalls))
    links = settled(_confirmed(first, _texts_of(texts, sides(first))))
    found = components(links)
    others = settled(_other_pairs(shared, sketches, found).join(first, ["a", "b"], "left_anti"))
    more = _confirmed(others, _texts_of(texts, sides(others)))
    whole = components(links.unionByName(more))

    named = (
        classes.select("key", "cls")
        .join(whole.withColumnRenamed("node", "cls"), "cls", "left")
        .select("key", F.coalesce("component", "cls").alias("component"))
    )
    with_words = rows.where("key is not null").select("id", "row_a", "row_b", "n", "key").join(named, "key", "left")
    without = rows.where("key is null").select("id", "row_a", "row_b", "n", F.col("id").alias("component"))
    kept = (F.col("n") == 0) | F.coalesce(F.col("id") == F.col("component"), F.lit(False))
    return with_words.drop("key").unionByName(without).withColumn("kept", kept)


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    return _members(docs, id_column, text_column).select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        "kept",
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that `groups` keeps, with all columns. Only rows that may go are shuffled.

    Rows go by their id and whole text, so of rows that share an id those stay that are
    kept; rows with equal id and text stay or go together.
    """
    gone = settled(_members(docs, id_column, text_column).where(~F.col("kept")).select("row_a", "row_b").distinct())
    row = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_near_row"), *_row_keys(id_column, text_column)
    )
    marked = through(row, sieve(gone, "row_a"), "row_a")
    suspects = marked.where("_sieve_hit").join(gone, ["row_a", "row_b"], "left_anti")
    return (
        marked.where(~F.col("_sieve_hit"))
        .select("_near_row.*")
        .unionByName(suspects.select("_near_row.*"))
    )
