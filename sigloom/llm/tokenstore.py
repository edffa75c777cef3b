"""Token ids in a content-addressed store: chunks, recipes and a manifest, written and read back.

Every document's ids, with the end id, are cut into chunks where a gear hash over the
last ``WINDOW`` ids has its top bits zero, so equal passages of ids are cut alike
wherever they stand. A chunk is addressed by the BLAKE2b-128 digest of its bytes.

File format, all Parquet, below one folder:

* ``raw/kind=0``  the chunk store: key (digest), n (ids), data (ids, little-endian, 2 bytes
  each if the vocabulary fits, else 4). Each distinct chunk stands there once.
* ``raw/kind=1``  recipes as they were made: doc_id, n, data (of its chunks in order the digest and, in
  4 bytes, the number of ids), root.
* ``manifest``    recipes in ascending doc_id order (null first, repeated ids by root), with
  ``start``, the ids of all rows before it; ``root`` is the Merkle root over the chunk digests.

One shuffle moves the chunk bytes: by digest, with copies inside a task dropped before it,
so a chunk that a third of all documents share crosses it once per task. Recipes ride along
under keys of their own. Reading checks every chunk against its digest and every recipe
against its root. A document's crc32 is the exclusive or of the crc32 of its chunks, each
moved past the ids that follow, so chunk bytes are read once and not shuffled again, and no
document's chunks are gathered in a row. ``read_documents`` joins the bytes themselves.

Defined results: a null or empty text has the end id alone; repeated rows are separate
documents; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bpe, stage, words

END_ID = 2
WINDOW, MASK_BITS, MIN_CHUNK, MAX_CHUNK = 16, 7, 32, 1024
_GEAR = np.random.default_rng(7).integers(0, 2**64, 1 << 20, dtype=np.uint64)
_SEEN = 1 << 18
_ID_BITS = 20  # for a chunk's number of ids, where it travels with the number of ids behind it
_STEP = 20  # bytes of a recipe for each chunk: its digest and its number of ids
_RAW = "kind int, key binary, doc_id {doc_id}, n int, data binary, root binary"


def cut_points(ids: np.ndarray, bounds: np.ndarray | None = None) -> list[int]:
    """Ends of the chunks of some id streams in a row; ``bounds`` are 0 and the ends of the streams (one stream: None)."""
    h = _GEAR[ids & np.uint32(len(_GEAR) - 1)]
    for shift in (1, 2, 4, 8):  # sum of gear[id] << age over the last 16 ids
        older = np.zeros_like(h)
        older[shift:] = h[:-shift] << np.uint64(shift)
        h += older
    found = np.flatnonzero(h >> np.uint64(64 - MASK_BITS) == 0) + 1
    ends = [len(ids)] if bounds is None else bounds[1:].tolist()
    split = np.searchsorted(found, ends, side="left").tolist()
    found = found.tolist()
    cuts: list[int] = []
    last = at = 0
    for end, upto in zip(ends, split, strict=True):
        first = last
        for c in [*found[at:upto], end]:
            if c < end and (c - last < MIN_CHUNK or c - first < WINDOW):
                continue
            while c - last > MAX_CHUNK:
                last += MAX_CHUNK
                cuts.append(last)
            if c > last:
                cuts.append(c)
                last = c
        at = upto
    return cuts


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root over the leaves; an odd one at the end of a level moves up as it is."""
    level = leaves or [digest(b"")]
    while len(level) > 1:
        level = [digest(b"".join(level[i : i + 2])) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return digest(b"root" + level[0])


def width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def write_store(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> None:
    """Encodes ``docs`` (doc_id, text) and writes the store below ``path``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(vocabulary)
        size = width(encoder.vocabulary)
        task = TaskContext.get().partitionId()
        seen = np.zeros((_SEEN, 2), np.uint64)  # the last chunk of each slot; a copy that is missed here goes at the shuffle
        row = 0
        for batch in batches:
            for part in words.slices(batch):
                texts = encoder.encode(part.column("text"))
                bounds = np.cumsum([0, *(len(ids) + 1 for ids in texts)])
                flat = np.full(bounds[-1], end_id, np.uint32)
                for at, ids in zip(bounds.tolist(), texts, strict=False):
                    flat[at : at + len(ids)] = ids
                cuts = np.array(cut_points(flat, bounds), np.int64)
                data = memoryview(flat.astype(f"<u{size}").tobytes())
                sizes = np.diff(cuts, prepend=0)
                ends = (cuts * size).tolist()
                digests = [digest(data[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
                pairs = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
                slot = pairs[:, 0] % np.uint64(_SEEN)
                _, once = np.unique(pairs, axis=0, return_index=True)
                new = np.sort(once[(seen[slot[once]] != pairs[once]).any(axis=1)])
                seen[slot[new]] = pairs[new]
                n, some, doc_ids = part.num_rows, len(new), part.column("doc_id")
                keys = [digests[i] for i in new.tolist()]
                chunks = [data[ends[i - 1] if i else 0 : ends[i]].tobytes() for i in new.tolist()]
                yield _batch([pa.array(np.zeros(some, np.int32)), pa.array(keys, pa.binary()), pa.nulls(some, doc_ids.type), pa.array(sizes[new].astype(np.int32)), pa.array(chunks, pa.binary()), pa.nulls(some, pa.binary())])
                first = np.searchsorted(cuts, bounds, side="right")
                first[0] = 0
                steps = np.empty((len(digests), _STEP), np.uint8)
                steps[:, :16] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 16)
                steps[:, 16:] = sizes.astype("<u4").view(np.uint8).reshape(-1, 4)
                recipes = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((first * _STEP).astype(np.int32)), pa.py_buffer(steps.tobytes())])
                roots = [merkle(digests[a:b]) for a, b in zip(first.tolist(), first[1:].tolist(), strict=False)]
                named = [digest(b"%d/%d" % (task, row + i)) for i in range(n)]
                row += n
                yield _batch([pa.array(np.ones(n, np.int32)), pa.array(named, pa.binary()), doc_ids, pa.array(np.diff(bounds).astype(np.int32)), recipes, pa.array(roots, pa.binary())])

    raw = docs.mapInArrow(encode, _RAW.format(doc_id=dict(docs.dtypes)["doc_id"]))
    n = _partitions(spark)
    # recipes have keys of their own, so the key alone tells rows apart, and rows are sorted by its first bytes
    once = raw.repartition(n, "key").withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("kind"))).where("nth = 1").drop("nth")
    once.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/raw")
    del raw, once  # and with them their shuffle files
    stage.release(spark)
    recipes = _raw(spark, path, 1, dict(docs.dtypes)["doc_id"])
    ranged = stage.written(recipes.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "root").withColumn("part", F.spark_partition_id()), "store-order")
    per = ranged.groupBy("part").agg(F.sum(F.col("n").cast("long")).alias("ids"))  # a row per partition
    offsets = per.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "root", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("upto", F.sum(F.col("n").cast("long")).over(inside)).join(F.broadcast(offsets), "part")
    manifest = placed.select("doc_id", (F.col("before") + F.col("upto") - F.col("n")).alias("start"), F.col("n").cast("long").alias("n_tokens"), "data", "root")
    manifest.write.option("compression", "zstd").parquet(f"{path}/manifest")
    stage.discard(ranged)


def _batch(columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "doc_id", "n", "data", "root"])


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _raw(spark: SparkSession, path: str, kind: int, doc_type: str = "bigint") -> DataFrame:
    return spark.read.schema(_RAW.format(doc_id=doc_type)).parquet(f"{path}/raw").where(F.col("kind") == kind).drop("kind")


def read_chunks(spark: SparkSession, path: str, id_width: int) -> DataFrame:
    """The chunk store, every chunk checked against its digest: key, n, crc (crc32 of its ids as 4 bytes each)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for key, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if digest(data) != key or len(data) != n * id_width:
                    raise ValueError(f"chunk {key.hex()} doesn't match its digest")
                crcs.append(zlib.crc32(np.frombuffer(data, f"<u{id_width}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(crcs, pa.int64())], names=["key", "n", "crc"])

    return _raw(spark, path, 0).select("key", "n", "data").mapInArrow(check, "key binary, n int, crc long")


_shifts: list[np.ndarray] = []


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def _shift_table(power: int) -> np.ndarray:
    """What 4 * 2**power zero bytes do to a crc32, by each of its bytes (the map is linear over bits)."""
    while len(_shifts) <= power:
        if _shifts:
            bits = _apply(_shifts[-1], _apply(_shifts[-1], np.uint32(1) << np.arange(32, dtype=np.uint32)))
        else:
            bits = np.array([zlib.crc32(bytes(4), 1 << b) ^ zlib.crc32(bytes(4), 0) for b in range(32)], np.uint32)
        table = np.zeros((4, 256), np.uint32)
        for v in range(1, 256):
            low = v & -v
            table[:, v] = table[:, v ^ low] ^ bits[low.bit_length() - 1 :: 8]
        _shifts.append(table)
    return _shifts[power]


def moved(crc: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The part that strings with these crc32 have in the crc32 of a longer string, ``after`` ids of 4 bytes before its end."""
    out = crc.astype(np.uint32)
    for power in range(int(after.max(initial=0)).bit_length()):
        at = np.flatnonzero(after >> power & 1)
        out[at] = _apply(_shift_table(power), out[at])
    return out


def documents(spark: SparkSession, path: str, id_width: int = 2) -> DataFrame:
    """Read back from the files: doc_id, start, n_tokens, ids_crc32, n_chunks. Fails if anything doesn't match."""
    manifest = spark.read.parquet(f"{path}/manifest")
    doc_type = dict(manifest.dtypes)["doc_id"]

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recipes = batch.column("data").to_pylist()
            steps = np.frombuffer(b"".join(recipes), np.uint8).reshape(-1, _STEP)
            first = np.cumsum([0, *(len(r) // _STEP for r in recipes)])
            digests = steps[:, :16].tobytes()
            for a, b, start, root in zip(first.tolist(), first[1:].tolist(), batch.column("start").to_pylist(), batch.column("root").to_pylist(), strict=False):
                if merkle([digests[i : i + 16] for i in range(16 * a, 16 * b, 16)]) != root:
                    raise ValueError(f"the recipe at {start} doesn't match its Merkle root")
            sizes = np.ascontiguousarray(steps[:, 16:]).view("<u4").ravel().astype(np.int64)
            upto = np.concatenate(([0], np.cumsum(sizes)))
            totals = batch.column("n_tokens").to_numpy()
            if (upto[first[1:]] - upto[first[:-1]] != totals).any():
                raise ValueError("a recipe doesn't have as many ids as its document")
            of = np.repeat(np.arange(batch.num_rows), np.diff(first))
            head = np.zeros(len(sizes), bool)
            head[first[:-1]] = True  # every document has a chunk; its first row carries the document's columns
            take = pa.array(of, mask=~head)
            keys = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.arange(0, 16 * len(sizes) + 1, 16, dtype=np.int32)), pa.py_buffer(digests)])
            after = upto[first[1:]][of] - upto[1:]
            yield pa.RecordBatch.from_arrays([batch.column("start").take(pa.array(of)), keys, pa.array(after << _ID_BITS | sizes), batch.column("doc_id").take(take), batch.column("n_tokens").take(take)], names=["start", "key", "ids", "doc_id", "n_tokens"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").to_numpy()
            if not batch.column("n").equals(pa.array(ids & ((1 << _ID_BITS) - 1))):
                raise ValueError("a chunk of a recipe is missing or has another length")
            part = moved(batch.column("crc").to_numpy(), ids >> _ID_BITS)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("start", "doc_id", "n_tokens")), pa.array(part.astype(np.int64))], names=["start", "doc_id", "n_tokens", "part"])

    recipe = manifest.select("doc_id", "start", "n_tokens", "data", "root").mapInArrow(leaves, f"start long, key binary, ids long, doc_id {doc_type}, n_tokens long")
    found = recipe.join(read_chunks(spark, path, id_width).withColumn("n", F.col("n").cast("long")), "key", "left")
    shares = found.select("start", "ids", "doc_id", "n_tokens", "n", "crc").mapInArrow(parts, f"start long, doc_id {doc_type}, n_tokens long, part long")
    return shares.groupBy("start").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.bit_xor("part").alias("ids_crc32"), F.count("*").alias("n_chunks")).select("doc_id", "start", "n_tokens", "ids_crc32", "n_chunks")


def read_documents(spark: SparkSession, path: str, id_width: int = 2) -> DataFrame:
    """The documents themselves, rebuilt from recipes and chunks: doc_id, start, data (all ids as stored)."""
    manifest = spark.read.parquet(f"{path}/manifest")
    keys = manifest.select("doc_id", "start", F.posexplode(F.expr("transform(sequence(0, cast(length(data) / 20 as int) - 1), i -> substring(data, 20 * i + 1, 16))")).alias("at", "key"))
    found = keys.join(_raw(spark, path, 0).select("key", F.col("data").alias("ids")), "key")
    parts = found.groupBy("doc_id", "start").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    return parts.select("doc_id", "start", F.expr("aggregate(parts, cast('' as binary), (acc, p) -> concat(acc, p.ids))").alias("data"))


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Writes a store in the shared folder and returns what its files say of each document."""
    spark = docs.sparkSession
    path = stage.new_path(spark, "tokens")
    write_store(docs, vocabulary, path)
    stage.release(spark)
    return documents(spark, path, width(Tokenizer.from_file(vocabulary).get_vocab_size()))
