"""What changed between two snapshots of a table, with rows found again under another key.

Rows of equal keys are a pair. Among the rows left over, the i-th smallest earlier key and the
i-th smallest later key of one content are a pair: the row was rekeyed. What is left then was
deleted or inserted.

Both steps need the rank of a row within its key, or within its content, and a third of all rows may
share one. So ranks don't come from a window per group. All rows are range-sorted by (group, side, order),
so that a large group lies in as many partitions as it fills. A partition counts its own runs. Only
its first run can go on from the partition before, so the prefix sums over partitions need two rows of each
partition, whatever it holds. Group and exact rank are then a unique key on either side, and the join on them
has no hot key. Rows travel as 16-byte digests of their columns. To the driver goes a sample of fixed size
(``SAMPLE``), for the bounds of the partitions; the offsets are a table, which Spark broadcasts only below its own threshold.

Defined results: nulls equal only nulls, in keys, contents and columns. Repeated keys: the rows of a key
are ordered by the digest of their columns on either side and paired in that order; the rest of the longer
side is left over. Repeated rows are separate rows. Leftovers of one content and one key are in the order of the same
digest. Empty tables give inserts, deletes or nothing; other columns are ignored
but for ``carry``. Equality of digests (md5) stands for equality of values.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from . import stage

COLUMNS = ("text", "lang", "source")

#: Rows that a range sort samples in all, times three: the bounds of its partitions come of them. Beyond so many partitions it is three for each.
SAMPLE = 2000
_SAMPLE_SETTING = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def digest(value: Column) -> Column:
    """16 bytes that are equal for equal values; null has its own."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("+"), value.cast("string")), F.lit("-"))))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's place in the partition, its place in its run of (_g, _side), and whether that run is the first."""
    last, run, at, first = None, 0, 0, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        g, side = batch.column("_g"), batch.column("_side").to_numpy()
        begins = np.ones(n, bool)
        begins[1:] = pc.not_equal(g.slice(1), g.slice(0, n - 1)).to_numpy(zero_copy_only=False) | (side[1:] != side[:-1])
        begins[0] = last != (g[0].as_py(), side[0])
        if begins[0] and last is not None:
            first = False
        starts = np.where(begins, np.arange(n), -1)
        starts[0] = 0 if begins[0] else -run
        local = np.arange(n) - np.maximum.accumulate(np.where(begins, starts, starts[0]))
        firsts = np.full(n, first) & (np.cumsum(begins) - begins[0] == 0)
        out = {"_at": pa.array(np.arange(at, at + n)), "_local": pa.array(local.astype(np.int64)), "_first": pa.array(firsts)}
        yield pa.RecordBatch.from_arrays([*batch.columns, *out.values()], [*batch.schema.names, *out])
        last, run, at, first = (g[n - 1].as_py(), side[n - 1]), int(local[-1]) + 1, at + n, bool(firsts[-1])


def ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (with _g: binary, _side: int, neither null) and ``_rank``, from 0 within (_g, _side) by ``order``."""
    spark = rows.sparkSession
    spread = rows.repartitionByRange("_g", "_side", *order).sortWithinPartitions("_g", "_side", *order).withColumn("_part", F.spark_partition_id())
    fields = [*spread.schema.fields, *StructType.fromDDL("_at long, _local long, _first boolean").fields]
    before = spark.conf.get(_SAMPLE_SETTING)
    spark.conf.set(_SAMPLE_SETTING, str(max(1, min(int(before), SAMPLE // int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    try:
        table = stage.written(spread.mapInArrow(_numbered, StructType([StructField(f.name, f.dataType) for f in fields])), name)
    finally:
        spark.conf.set(_SAMPLE_SETTING, before)
    edges = table.groupBy("_part").agg(F.min_by(F.struct("_g", "_side"), "_at").alias("head"), F.max_by(F.struct("_g", "_side", "_local"), "_at").alias("tail"))
    ends = edges.select(F.col("_part").alias("_p"), "head._g", "head._side", F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")).unionByName(
        edges.select(F.col("_part").alias("_p"), "tail._g", "tail._side", F.lit(1).alias("end"), (F.col("tail._local") + 1).alias("n"))
    )
    earlier = F.sum("n").over(Window.partitionBy("_g", "_side").orderBy("_p", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = stage.written(ends.withColumn("_offset", earlier).where("end = 0 and _offset > 0").select("_p", "_offset"), f"{name}-offsets")
    placed = table.join(offsets, (F.col("_part") == F.col("_p")) & F.col("_first"), "left")
    return placed.withColumn("_rank", F.col("_local") + F.coalesce("_offset", F.lit(0))).drop("_part", "_at", "_local", "_first", "_p", "_offset")


def _paired(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of side 0 (_e: struct) and side 1 (_l: struct) with equal _g and _rank; null where there is none."""
    one = lambda side, name: rows.where(F.col("_side") == side).select("_g", "_rank", F.struct(*columns).alias(name))
    return one(0, "_e").join(one(1, "_l"), ["_g", "_rank"], "full").select("_e", "_l")


def compare(earlier: DataFrame, later: DataFrame, key: str = "doc_id", columns: Sequence[str] = COLUMNS, content: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """A row per pair or unpaired row: key, old_key, op, changed, and what ``carry`` takes from the later row.

    ``op`` is same or update for equal keys, rekey for equal contents, else insert or delete; ``changed`` names the
    ``columns`` in which a pair differs. ``carry`` maps names to expressions over ``later``, whole columns
    if need be; they are null for deletes.
    """
    mark = stage.tables_made()
    carry = carry or {}
    hashes = {c: f"_h{i}" for i, c in enumerate(dict.fromkeys([*columns, content]))}
    kinds = later.select(*(x.alias(f"_c{i}") for i, x in enumerate(carry.values()))).schema if carry else []
    kept = [f.name for f in kinds]

    def narrow(rows: DataFrame, side: int) -> DataFrame:
        more = [x.alias(n) if side else F.lit(None).cast(f.dataType).alias(n) for n, x, f in zip(kept, carry.values(), kinds, strict=True)]
        return rows.select(digest(F.col(f"`{key}`")).alias("_g"), F.lit(side).alias("_side"), F.col(f"`{key}`").alias("_key"), *(digest(F.col(f"`{c}`")).alias(h) for c, h in hashes.items()), *more)

    every = ["_key", *hashes.values(), "_all", *kept]
    both = narrow(earlier, 0).unionByName(narrow(later, 1)).withColumn("_all", F.unhex(F.md5(F.concat(*hashes.values()))))
    by_key = ranked(both, ["_all"], "snapshot-keys")
    joined = stage.written(_paired(by_key, every), "snapshot-pairs")
    stage.discard_since(mark, joined)
    left = joined.where("_l is null").select(F.lit(0).alias("_side"), "_e.*").unionByName(joined.where("_e is null").select(F.lit(1).alias("_side"), "_l.*"))
    by_content = ranked(left.withColumn("_g", F.col(hashes[content])), ["_key", "_all"], "snapshot-contents")
    differs = F.array_join(F.array_compact(F.array(*(F.when(F.col(f"_e.{hashes[c]}") != F.col(f"_l.{hashes[c]}"), F.lit(c)) for c in columns))), ",")

    def told(pairs: DataFrame, op: Column) -> DataFrame:
        both = F.col("_e").isNotNull() & F.col("_l").isNotNull()
        return pairs.withColumn("changed", F.when(both, differs).otherwise("")).select(
            F.when(F.col("_l").isNotNull(), F.col("_l._key")).otherwise(F.col("_e._key")).alias("key"), F.col("_e._key").alias("old_key"), op.alias("op"), "changed", *(F.col(f"_l.{n}").alias(name) for n, name in zip(kept, carry, strict=True))
        )

    same = told(joined.where("_e is not null and _l is not null"), F.when(F.col("changed") == "", "same").otherwise("update"))
    return same.unionByName(told(_paired(by_content, every), F.when(F.col("_e").isNull(), "insert").when(F.col("_l").isNull(), "delete").otherwise("rekey")))


def later_snapshot(docs: DataFrame) -> DataFrame:
    """The later snapshot that the query compares with: what happens to a row hangs on the crc32 of its doc_id modulo 16 (null: nothing)."""
    turn = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 16, F.lit(6))
    moved = (F.lit(-1) - F.col("doc_id")).cast("long")
    keys = F.when(turn == 0, F.array().cast("array<bigint>")).when(turn.isin(3, 4), F.array(moved)).when(turn == 5, F.array(F.col("doc_id"), moved)).otherwise(F.array(F.col("doc_id")))
    swapped = lambda a, b: F.when(turn == 2, F.col(b)).otherwise(F.col(a))
    return docs.select(
        F.explode(keys).alias("doc_id"), F.when(turn == 1, F.concat(F.coalesce("text", F.lit("")), F.lit("+"))).otherwise(F.col("text")).alias("text"),
        swapped("lang", "source").alias("lang"), F.when(turn == 4, F.lit(None)).otherwise(swapped("source", "lang")).alias("source"),
    )


def row_digest(columns: Sequence[str] = COLUMNS) -> Column:
    """sha256 of the columns, joined by line feeds, null as ``~``."""
    return F.unhex(F.sha2(F.concat_ws("\n", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns)), 256))


def differences(docs: DataFrame) -> DataFrame:
    """``docs`` against ``later_snapshot(docs)``: key, old_key, op, changed, row_sha256."""
    found = compare(docs, later_snapshot(docs), carry={"row_sha256": row_digest()})
    return found.withColumn("row_sha256", F.lower(F.hex("row_sha256")))
