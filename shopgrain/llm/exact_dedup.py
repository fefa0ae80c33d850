"""Exact duplicates by sorting content.

Texts are equal if they are the same after all characters of [\\x20\\x09-\\x0D] are
deleted. Spark samples splitters, deals rows into ranges and sorts each range
externally; equal normalised bytes are then neighbours, and one pass compares each text
in full with the one before it. Within a run of equals the best row comes first: most
code points of the original text, then smallest id.

The splitters are bounded: the first characters of the normalised text, its digest,
then the order within equals. So long texts do not travel to the driver with the
sample, and a run of equal texts, however long, is cut over many ranges. Only the
first and the last run of a range can go on in another one; these are settled by
comparing their texts in a table of at most two rows per range.

Defined cases: null and empty text are the same (empty) text; null ids sort last, and a
run of null ids keeps one row; repeated rows are separate rows of which one stays; an
empty table gives no rows; all columns of the input, whatever their names, pass through
`deduplicated`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, settled, whole

#: Characters of the normalised text in the splitters.
HEAD = 24


class _Runs:
    """Runs of equal neighbours in one sorted range, as record batches come."""

    def __init__(self, range_number: int, schema: pa.Schema):
        self.edge = 2 * range_number  # the first run of the range; the last one is edge + 1
        self.schema = schema
        self.held: list[pa.RecordBatch] = []  # rows of the run that is not over, without texts
        self.text = None  # its text
        self.first = True

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        norm = batch.column("norm").cast(pa.large_string())
        rest = batch.drop_columns(["norm"])
        n = batch.num_rows
        new = np.ones(n, dtype=bool)
        new[0] = self.text is None or norm[0].as_py() != self.text
        if n > 1:
            same = pc.equal(norm.slice(1), norm.slice(0, n - 1))
            new[1:] = ~same.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        if len(starts) == 0:
            self.held.append(rest)
            return
        if self.text is not None:
            if starts[0]:
                self.held.append(rest.slice(0, starts[0]))
            yield from self.flush(last=False)
        inner = starts[:-1]
        if self.first and len(inner):  # the very first run of the range
            self.held, self.text = [rest.slice(0, starts[1])], norm[0].as_py()
            yield from self.flush(last=False)
            inner = inner[1:]
        if len(inner):
            lengths = np.diff(starts[-len(inner) - 1 :])
            yield self.rows(rest.slice(inner[0], starts[-1] - inner[0]), lengths, None, None)
        self.held, self.text = [rest.slice(starts[-1])], norm[int(starts[-1])].as_py()

    def flush(self, last: bool) -> Iterator[pa.RecordBatch]:
        """The held run is over; the first and the last one of a range are open edges."""
        if self.text is None:
            return
        edge = self.edge if self.first else self.edge + 1 if last else None
        table = pa.Table.from_batches(self.held).combine_chunks()
        held = table.to_batches()[0]
        yield self.rows(held, np.array([held.num_rows]), edge, self.text)
        self.first, self.held = False, []

    def rows(self, rest, lengths, edge, text) -> pa.RecordBatch:
        n = rest.num_rows
        heads = np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        is_head = np.arange(n) == heads
        ids = rest.column("id")
        columns = {
            "id": ids,
            "keep": ids.take(pa.array(heads)),
            "size": pa.array(np.repeat(lengths, lengths), pa.int64()),
            "head": pa.array(is_head),
            "edge": pa.array(np.full(n, -1 if edge is None else edge), pa.int64(), mask=np.full(n, edge is None)),
            "edge_points": rest.column("points"),
            "edge_norm": pa.array([text if edge is not None and i == 0 else None for i in range(n)], self.schema.field("edge_norm").type)
            if edge is not None
            else pa.nulls(n, self.schema.field("edge_norm").type),
        }
        if "sha" in self.schema.names:
            columns["sha"] = rest.column("sha")
        if "row" in self.schema.names:  # only rows that may stay need their columns
            columns["row"] = pc.if_else(pa.array(is_head), rest.column("row"), pa.scalar(None, rest.schema.field("row").type))
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if columns[f.name].type != f.type else columns[f.name] for f in self.schema], schema=self.schema)


def _neighbours(schema: pa.Schema):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(TaskContext.get().partitionId(), schema)
        for batch in batches:
            if batch.num_rows:
                yield from runs.take(batch)
        yield from runs.flush(last=True)

    return compare


def _runs(docs: DataFrame, id_column: str, text_column: str, carry: bool) -> DataFrame:
    """One row per document with its group; with carry, `row` holds the columns of kept ones."""
    from pyspark.sql.pandas.types import to_arrow_schema

    text = whole(f"`{text_column}`")
    norm = F.regexp_replace(text, SPACE + "+", "")
    payload = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    df = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.length(text).alias("points"),
        norm.alias("norm"),
        *payload,
    )
    df = df.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256)).withColumn(
        "start", F.substring("norm", 1, HEAD)
    )
    best = (F.col("points").desc(), F.col("id").asc_nulls_last())
    if carry:  # the text travels once, in the row
        df = df.drop("norm")
    df = df.repartitionByRange("start", "sha", *best)
    if carry:
        inner = whole(F.col("row").getField(text_column))
        df = df.withColumn("norm", F.regexp_replace(inner, SPACE + "+", ""))
    df = df.sortWithinPartitions("start", "sha", "norm", *best)

    columns = [f for f in df.schema if f.name in ("id", "points", "norm", "sha", "row")]
    df = df.select(*(f.name for f in columns))
    kinds = {f.name: f.dataType for f in columns}
    out = T.StructType(
        [
            T.StructField("id", kinds["id"]),
            T.StructField("keep", kinds["id"]),
            T.StructField("size", T.LongType()),
            T.StructField("head", T.BooleanType()),
            T.StructField("edge", T.LongType()),
            T.StructField("edge_points", T.IntegerType()),
            T.StructField("edge_norm", T.StringType()),
            T.StructField("row", kinds["row"]) if carry else T.StructField("sha", T.StringType()),
        ]
    )
    runs = settled(df.mapInArrow(_neighbours(to_arrow_schema(out)), out))
    heads = runs.where(F.col("edge_norm").isNotNull())
    order = F.struct(-F.col("edge_points"), F.col("keep").isNull(), F.col("keep"), F.col("edge"))
    groups = heads.groupBy("edge_norm").agg(
        F.sum("size").alias("whole_size"),
        F.min_by("keep", order).alias("whole_keep"),
        F.min_by("edge", order).alias("whole_edge"),
    )
    edges = heads.select("edge", "edge_norm").join(groups, "edge_norm").drop("edge_norm")
    # Two rows of four numbers per range at most: small however large the input is.
    return runs.join(F.broadcast(edges), "edge", "left").select(
        "id",
        F.when(F.col("edge").isNull(), F.col("keep")).otherwise(F.col("whole_keep")).alias("keep_id"),
        F.coalesce("whole_size", "size").alias("group_size"),
        (F.col("head") & (F.col("edge").isNull() | (F.col("edge") == F.col("whole_edge")))).alias("kept"),
        *(["row"] if carry else ["sha"]),
    )


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    return _runs(docs, id_column, text_column, carry=False).select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        "kept",
        F.col("sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each group of equal texts, with all its columns."""
    return _runs(docs, id_column, text_column, carry=True).where("kept").select("row.*")
