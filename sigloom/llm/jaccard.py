"""Exact Jaccard self-join of documents on word shingles, with adaptive multi-match prefixes.

A document's set is its distinct ``k``-word shingles (64-bit hashes); with fewer words,
the whole sequence as one. Documents with equal sets form a class, and classes are joined.

Prefixes. Shingles have one global order: rare first, by a count sketch over all documents
(a fixed number of counters, summed without collecting anything per document), then by
hash. Two sets that reach the threshold t share l shingles in their first n - ceil(t n) + l
for every l. Each document picks its l by the estimated cost of its prefix: the more
candidates its shingles would bring, the longer the prefix and the more shared shingles
a pair needs before it is verified: as many as the smaller l of the two.

Crowded shingles. A shingle that more than ``SMALL`` classes have in their prefixes is
expanded into pairs only as long as all such pairs are no more than the rows (``_crowds``).
The classes of the others are first verified against one pivot, a number of pairs
linear in the rows. Those within a Jaccard distance of 0.6 are the pivot's family; they are
joined on the few tokens in which they differ from it (``_family_links``). The distance is a
metric, so a class of the family and one outside can only link if their distances to the
pivot differ by 1 - t at most; those pairs, at the rim, are formed. The classes outside go
on to the next round with another pivot, or are few enough by then. No link between
different components is lost, and a group of near copies costs as much as it has members.

Disk. A class has a parity sketch: a bit for each slot of its shingles' hashes, set if an odd
number of them falls there. Sketches of two sets differ in no more bits than the sets differ
in shingles, so pairs too far apart go before any text is read for them, and no link does; so
do classes too far from their pivot to be of its family.
The other pairs move whole sets, so they are compared in parts, one after the other, that
move about one in ``PARTS`` of the corpus's shingles each. If even that is much, every class
is first compared with one other, and then pairs within one component needn't be compared.

Links are verified on the whole sets with integers; components follow from the links.

Defined results: null and empty texts have an empty set and link with nothing, and so do
rows with a null doc_id (their component_id is null); equal sets link, also under one
doc_id; repeated rows give repeated results; an empty table gives an empty result; other
columns are ignored by ``components`` and kept by ``deduplicate``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import components as graph
from . import stage, words
from .semijoin import maybe_in, split_join

SMALL = 16
#: Times SMALL up to which a crowd may be expanded, so that no task forms very many pairs of one shingle.
_MOST_CROWD = 16
#: Parts of the corpus's shingles: as much as one in PARTS, and LEAST_PART at least, moves in one comparison.
PARTS, LEAST_PART = 4, 4_000_000
SKETCH_BITS, _BLOCK_BITS = 22, 16
MOST_MATCHES = 4
FEW_IDS = 500_000
ROUNDS = 8
#: Jaccard distance up to which a class belongs to its pivot's family: 3 / 5.
_FAMILY = (3, 5)
_SALT = np.uint64(0xA0761D6478BD642F)
_SEEN = 1 << 16


def shingles(found: words.Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, at = found.windows(k)
    cuts = np.searchsorted(at, found.first)
    for doc, (a, b) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)):
        if b - a >= k:
            yield np.unique(h[cuts[doc] : cuts[doc + 1]])
        elif b > a:
            yield np.array([words.sequence_hash(found.hash[a:b])], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit digest of a set."""
    total = np.sum(words.mix(tokens ^ _SALT), dtype=np.uint64)
    return int(words.mix(np.array([total ^ (np.uint64(len(tokens)) << np.uint64(40))], np.uint64)).view(np.int64)[0])


def least_overlap(n: np.ndarray | int, num: int, den: int):  # noqa: ANN201
    """ceil(n * num / den)"""
    return -(-n * num // den)


def parity(tokens: np.ndarray) -> bytes:
    """A bit for each of the slots, a power of two of them and four to eight times as many as tokens: whether an odd number of tokens falls there."""
    slots = 1 << max(6, (4 * len(tokens)).bit_length())
    return np.packbits((np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1).astype(np.uint8)).tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """The number of tokens that only one of two sets has is no less than this, by their parities."""
    x, y = (a, b) if len(a) <= len(b) else (b, a)
    u, v, size = int.from_bytes(x, "big"), int.from_bytes(y, "big"), len(y)
    while size > len(x):  # the slots of a half as many are sums of two
        size //= 2
        v = (v >> 8 * size) ^ (v & ((1 << 8 * size) - 1))
    return (u ^ v).bit_count()


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """Rows of documents (blk -1: doc_id, n, cls, and in data the parity) and of partial sketches (blk 0..: data)."""
    doc_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint16)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for part in words.slices(batch):
                n, cls, own, tokens = [], [], [], []
                for doc, s in zip(part.column(0).to_pylist(), shingles(words.scan(part.column("text"), words.SPACED), k), strict=True):
                    n.append(len(s))
                    cls.append(class_of(s) if len(s) and doc is not None else None)
                    own.append(parity(s) if cls[-1] is not None else None)
                    tokens.append(s)
                slots, times = np.unique((np.concatenate(tokens) >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32), return_counts=True)
                counts[slots] = np.minimum(counts[slots] + times.astype(np.uint32), 65535)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array([-1] * len(n), pa.int32()), pa.array(own, pa.binary())], names=["doc_id", "n", "cls", "blk", "data"])
        if kind is not None:
            blocks = counts.astype("<u2", copy=False).reshape(-1, 1 << _BLOCK_BITS)
            used = [b for b in range(len(blocks)) if blocks[b].any()]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(used), kind), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()), pa.array(used, pa.int32()), pa.array([zlib.compress(blocks[b].tobytes(), 1) for b in used], pa.binary())], names=["doc_id", "n", "cls", "blk", "data"])

    return docs.mapInArrow(run, f"doc_id {doc_type}, n long, cls long, blk int, data binary")


def _ranks(rows: DataFrame) -> np.ndarray:
    """Per counter the bit length of its count; 4 MB whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = -1, np.zeros(0, np.int64)

        def done() -> pa.RecordBatch:
            lengths = [] if at < 0 else [zlib.compress(np.ceil(np.log2(total + 1)).astype(np.uint8).tobytes(), 1)]
            return pa.RecordBatch.from_arrays([pa.array([at][: len(lengths)], pa.int32()), pa.array(lengths, pa.binary())], names=["blk", "data"])

        for batch in batches:  # sorted, so one block is held at a time
            for blk, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(zlib.decompress(data.as_py()), "<u2")
                if blk != at:
                    yield done()
                    at, total = blk, np.zeros(len(part), np.int64)
                total += part
        yield done()

    out = np.zeros(1 << SKETCH_BITS, np.uint8).reshape(-1, 1 << _BLOCK_BITS)
    for r in rows.where("blk >= 0").select("blk", "data").repartition(len(out), "blk").sortWithinPartitions("blk").mapInArrow(add, "blk int, data binary").collect():  # a row per block
        out[r.blk] = np.frombuffer(zlib.decompress(r.data), np.uint8)
    return out.ravel()


def prefix(tokens: np.ndarray, ranks: np.ndarray, background: int, num: int, den: int) -> tuple[np.ndarray, int]:
    """The adaptive prefix of a set, and the matches it asks for."""
    n = len(tokens)
    rank = ranks[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    order = np.argsort((rank << np.uint64(58)) | (tokens >> np.uint64(6)), kind="stable")
    need = least_overlap(n, num, den)
    base = n - need + 1
    excess = np.maximum(2.0 ** rank[order[:base]] - 2.0**background, 0.0)
    matches = min(MOST_MATCHES, need, 2 + int(np.log2(1.0 + excess.sum() / base)))
    return tokens[order[: base + matches - 1]], matches


def _postings(docs: DataFrame, ranks: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """(token, cls, n, matches) of the prefixes; of equal sets in a task one is enough."""
    background = int(np.median(ranks[ranks > 0])) if (ranks > 0).any() else 0
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_SEEN, np.int64)  # the last class of each slot; a copy that is missed here goes at the shuffle
        for batch in batches:
            for part in words.slices(batch):
                tokens, cls, n, matches, sizes = [], [], [], [], []
                for doc, s in zip(part.column(0).to_pylist(), shingles(words.scan(part.column("text"), words.SPACED), k), strict=True):
                    if not len(s) or doc is None or seen[(c := class_of(s)) % _SEEN] == c:
                        continue
                    seen[c % _SEEN] = c
                    t, m = prefix(s, sent.value, background, num, den)
                    tokens.append(t)
                    sizes.append(len(t))
                    cls.append(c)
                    n.append(len(s))
                    matches.append(m)
                if tokens:
                    spread = lambda x, t: pa.array(np.repeat(np.array(x, t), sizes))  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), spread(cls, np.int64), spread(n, np.int32), spread(matches, np.int32)], names=["token", "cls", "n", "matches"])

    return docs.mapInArrow(run, "token long, cls long, n int, matches int")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cls, tokens) of the classes in ``wanted`` (cls), from one document of each."""
    ids = stage.written(classes.join(wanted, "cls", "left_semi").select(F.col("least").alias("doc_id"), F.col("cls").alias("want")), "wanted")
    few = ids.count() <= FEW_IDS  # 16 bytes each; then texts needn't be moved
    chosen = docs.join(F.broadcast(ids), "doc_id") if few else maybe_in(docs, ids, "doc_id").join(ids, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch):
                cls, data = [], []
                for want, s in zip(part.column("want").to_pylist(), shingles(words.scan(part.column("text"), words.SPACED), k), strict=True):
                    if class_of(s) == want:  # else another text under the same doc_id
                        cls.append(want)
                        data.append(s.astype("<u8").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(data, pa.binary())], names=["cls", "tokens"])

    return chosen.select("want", "text").mapInArrow(run, "cls long, tokens binary").dropDuplicates(["cls"])


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """``pairs`` (x, y) with the sizes of x, their intersection and union, and the tokens that only one has, if near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in words.slices(whole, "tx")):
            size, shared, union, delta = [], [], [], []
            for a, b in zip(batch.column("tx").to_pylist(), batch.column("ty").to_pylist(), strict=True):
                a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                both = np.concatenate((a, b))
                both.sort()
                same = both[1:] == both[:-1]
                common = int(same.sum())
                size.append(len(a))
                shared.append(common)
                union.append(len(both) - common)
                near = _FAMILY[0] * (len(both) - common) >= _FAMILY[1] * (len(both) - 2 * common)
                single = np.ones(len(both), bool)
                single[1:] &= ~same
                single[:-1] &= ~same
                delta.append(both[single].tobytes() if near else None)
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), *(pa.array(v, pa.int64()) for v in (size, shared, union)), pa.array(delta, pa.binary())], names=["x", "y", "nx", "shared", "both", "delta"])

    with_x = pairs.join(tokens.select(F.col("cls").alias("x"), F.col("tokens").alias("tx")), "x")
    with_both = with_x.join(tokens.select(F.col("cls").alias("y"), F.col("tokens").alias("ty")), "y")
    return with_both.select("x", "y", "tx", "ty").mapInArrow(run, "x long, y long, nx long, shared long, both long, delta binary")


def _alike(a: str, b: str, num: int, den: int) -> str:
    return f"{den} * least({a}, {b}) >= {num} * greatest({a}, {b})"


def _family_links(stars: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) that link, of classes near one pivot, but for pairs that both link to it.

    With D(x) the tokens that only one of x and the pivot has, |x ^ y| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|,
    and x and y link if that is at most c (|x| + |y|) with c = (1 - t) / (1 + t). One of the two doesn't
    link to the pivot, say x, so |D(x)| > c (|x| + |pivot|), and D(y) has to share more than
    (|D(y)| + c (|pivot| - |y|)) / 2 of its tokens; D(x) at least |D(x)| - (1 / t - 1) |x|. Prefixes of these
    sets, rare tokens first, find all such pairs. Independent edits share nothing, so a family of any size
    whose members differ by edits of their own brings no candidates at all.
    """
    near = stars.where("delta is not null").selectExpr(
        "x as pivot", "y as cls", "nx as np", "shared + both - nx as n", "delta", "cast(length(delta) / 8 as int) as size",
        f"{den} * shared >= {num} * both as linked",
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(d, "<i8") for d in batch.column("delta").to_pylist()]
            rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            for at in range(0, len(rows), 200_000):
                some = pa.array(rows[at : at + 200_000])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(some) for c in ("pivot", "cls")), pa.array(np.concatenate(parts)[at : at + 200_000])], names=["pivot", "cls", "token"])

    tokens = stage.written(near.select("pivot", "cls", "delta").mapInArrow(spread, "pivot long, cls long, token long"), "deltas")
    counts = tokens.groupBy("pivot", "token").agg(F.count("*").alias("f"))
    ranked = tokens.join(counts, ["pivot", "token"]).groupBy("pivot", "cls").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("ordered"))
    asked_y = f"greatest(1, cast(floor((size * {den + num} + {den - num} * (np - n)) / {2 * (den + num)}) as int) + 1)"
    asked_x = f"greatest(1, size - cast(floor({den - num} * n / {num}) as int))"
    placed = ranked.join(near.drop("delta"), ["pivot", "cls"]).select("pivot", "cls", "linked", F.expr(f"size - {asked_y} + 1").alias("ly"), F.expr(f"if(linked, 0, size - {asked_x} + 1)").alias("lx"), F.posexplode("ordered").alias("pos", "t"))
    posted = stage.written(placed.where("t.f > 1 and (pos < lx or pos < ly)").select("pivot", "cls", "t.token", F.expr("pos < lx").alias("as_x"), F.expr("pos < ly").alias("as_y")), "deltas")
    xs = posted.where("as_x").select("pivot", "token", F.col("cls").alias("x"))
    ys = posted.where("as_y").select("pivot", "token", F.col("cls").alias("y"))
    pairs = xs.join(ys, ["pivot", "token"]).where("x <> y").select("pivot", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    sides = lambda c: near.select("pivot", F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("delta").alias(f"d{c}"))
    both = pairs.join(sides("x"), ["pivot", "x"]).join(sides("y"), ["pivot", "y"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in words.slices(whole, "dx")):
            keep = []
            for nx, ny, a, b in zip(*(batch.column(c).to_pylist() for c in ("nx", "ny", "dx", "dy")), strict=True):
                apart = len(a) // 8 + len(b) // 8 - 2 * len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), assume_unique=True))
                shared = (nx + ny - apart) // 2
                keep.append(den * shared >= num * (nx + ny - shared))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_())).rename_columns(["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (x, y) with the sizes nx and ny, and in least how many tokens at least only one of the two has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("nx", "ny", "px", "py"))
            least = [max(least_apart(a, b), abs(nx - ny)) for nx, ny, a, b in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("x", "y", "nx", "ny")), pa.array(least, pa.int64())], names=["x", "y", "nx", "ny", "least"])

    return _sized(pairs, classes, "parity").select("x", "y", "nx", "ny", "px", "py").mapInArrow(run, "x long, y long, nx long, ny long, least long")


def _sized(pairs: DataFrame, classes: DataFrame, *more: str) -> DataFrame:
    """``pairs`` (x, y) with the sizes nx and ny, and other columns of ``classes`` by their first letter."""
    for side in ("x", "y"):
        pairs = pairs.join(classes.select(F.col("cls").alias(side), *(F.col(c).alias(c[0] + side) for c in ("n", *more))), side)
    return pairs


def _moved(pairs: DataFrame) -> int:
    """The shingles that a comparison of ``pairs`` (x, y, nx, ny) moves."""
    return pairs.agg(F.coalesce(F.sum(F.col("nx") + F.col("ny")), F.lit(0))).first()[0]


def _compared(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, limit: int, of: Callable[[DataFrame], DataFrame] = lambda v: v) -> DataFrame:
    """``of`` what ``_verified`` finds for ``pairs`` (x, y, nx, ny), in parts of about ``limit`` shingles one after the other."""
    parts, out = max(1, -(-_moved(pairs) // limit)), None
    for part in range(parts):
        some = pairs.where(F.pmod(F.xxhash64("y"), F.lit(parts)) == part).select("x", "y")
        ends = some.select(F.col("x").alias("cls")).unionByName(some.select(F.col("y").alias("cls"))).distinct()
        tokens = stage.written(_texts(docs, classes, ends, k), "tokens", codec="none")
        stage.release(docs.sparkSession)
        found = stage.written(of(_verified(some, tokens)), "verified")
        stage.discard(tokens)
        stage.release(docs.sparkSession)
        out = found if out is None else out.unionByName(found)
    return out


def _between(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """``pairs`` (x, y, ..) whose ends the links ``found`` don't connect."""
    known = stage.written(graph.connected(found), "known")
    for side in ("x", "y"):
        pairs = pairs.join(known.select(F.col("node").alias(side), F.col("component").alias(f"_{side}")), side, "left")
    return pairs.where(F.coalesce("_x", "x") != F.coalesce("_y", "y")).drop("_x", "_y")


def _crowds(members: DataFrame, room: int) -> tuple[DataFrame, DataFrame, int]:
    """``members`` (token, cls, n, matches) of tokens with few, those of the others with the pivot: the class most often in crowds, and what is left of ``room``.

    At most SMALL are few, and so are larger crowds, the smallest first, while they bring no more than ``room`` pairs in all.
    """
    total = members.count()
    crowd = members.groupBy("token").agg(F.count("*").alias("crowd")).where(F.col("crowd") > SMALL)
    crowd = stage.written(crowd.withColumn("step", F.floor(F.log2(F.col("crowd") / F.lit(SMALL))).cast("int")), "crowd")
    few = 0
    for r in crowd.where(F.expr(f"crowd <= {_MOST_CROWD * SMALL}")).groupBy("step").agg(F.sum(F.expr("crowd * (crowd - 1) div 2")).alias("pairs")).orderBy("step").collect():
        if r.pairs > room:
            break
        few, room = r.step + 1, room - r.pairs
    crowd = crowd.where(F.expr(f"step >= {few} or crowd > {_MOST_CROWD * SMALL}")).drop("step")
    crowded = stage.written(split_join(members, crowd, "token", "crowd", total, F.xxhash64("cls")), "crowded")
    often = crowded.groupBy("cls").agg(F.count("*").alias("often"))
    ranked = crowded.join(often, "cls")
    pivots = stage.written(ranked.groupBy("token").agg(F.max(F.struct("often", "cls")).alias("top"), F.count("*").alias("rows")).select("token", F.col("top.cls").alias("pivot"), "rows"), "pivots")
    quiet = stage.written(members.join(crowd.select("token"), "token", "left_anti"), "quiet")
    return quiet, stage.written(split_join(crowded, pivots, "token", "rows", total, F.xxhash64("cls")), "crowds"), room


def _pairs_within(members: DataFrame, num: int, den: int) -> DataFrame:
    """(x, y, asked) of every two members of a token whose sizes allow a link, a row for each token."""
    left = members.select("token", F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("matches").alias("mx"))
    right = members.select("token", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("matches").alias("my"))
    return left.join(right, "token").where(f"x < y and {_alike('nx', 'ny', num, den)}").select("x", "y", F.least("mx", "my").alias("asked"))


def links(docs: DataFrame, classes: DataFrame, ranks: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """(a, b) classes that link; all links but some between classes that others connect already."""
    spark = docs.sparkSession
    postings = stage.written(_postings(docs, ranks, k, num, den), "postings")
    buckets = stage.written(postings.groupBy("token").agg(F.min("cls").alias("least"), F.max("cls").alias("last"), F.count("*").alias("rows")).where("least <> last").select("token", "rows"), "buckets")
    members = stage.written(split_join(postings, buckets, "token", "rows", postings.count(), F.xxhash64("cls")).dropDuplicates(["token", "cls"]), "shared")
    stage.discard(postings, buckets)
    stage.release(spark)
    room = members.count()
    limit = max(LEAST_PART, (classes.agg(F.sum("n")).first()[0] or 0) // PARTS)
    reached = lambda v: v.where(f"{den} * shared >= {num} * both").select(F.col("x").alias("a"), F.col("y").alias("b"))
    found: list[DataFrame] = []
    direct: list[DataFrame] = []
    for _ in range(ROUNDS):
        if direct and not members.limit(1).count():
            members = None
            break
        quiet, crowded, room = _crowds(members, room)
        direct.append(_pairs_within(quiet, num, den))
        others = crowded.where("cls <> pivot")
        stars = stage.written(others.select(F.col("pivot").alias("x"), F.col("cls").alias("y")).distinct(), "stars")
        if not stars.limit(1).count():
            members = None
            break
        bounded = stage.written(_bounded(stars, classes), "bounded")
        far = F.expr(f"{2 * _FAMILY[1]} * least > {_FAMILY[0]} * (nx + ny + least)")  # certainly outside the family
        verified = _compared(docs, classes, bounded.where(~far).drop("least"), k, limit)
        stage.discard(stars)
        found += [reached(verified), stage.written(_family_links(verified, num, den), "family")]
        stage.release(spark)
        # the distance to the pivot in steps of 1 - t; linked classes lie in the same step or the next, and one outside in a step from low + 1 to high
        ring = F.expr(f"cast(({den} * (both - shared) - 1) div ({den - num} * both) as int)")
        first = F.expr(f"cast((2 * {den} * least - 2) div ({den - num} * (nx + ny + least)) as int)")
        last = -(-_FAMILY[0] * den // (_FAMILY[1] * (den - num)))  # no class of the family lies in a later step
        pair = [F.col("x").alias("pivot"), F.col("y").alias("cls")]
        placed = verified.select(*pair, (ring - 1).alias("low"), ring.alias("high"), F.col("delta").isNotNull().alias("near"))
        placed = placed.unionByName(bounded.where(far).select(*pair, (first - 1).alias("low"), F.lit(last).alias("high"), F.lit(False).alias("near")))
        ringed = stage.written(others.join(placed, ["pivot", "cls"]).select("token", "cls", "n", "matches", "low", "high", "near"), "rings")
        rim = ringed.where("near").select("token", F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("matches").alias("mx"), F.col("high").alias("ring"))
        out = ringed.where(f"not near and low <= {last}").select("token", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("matches").alias("my"), F.explode(F.expr(f"sequence(low, least(high, {last}))")).alias("ring"))
        crossing = rim.join(out, ["token", "ring"]).where(_alike("nx", "ny", num, den)).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), F.least("mx", "my").alias("asked"))
        direct.append(crossing)
        members = ringed.where("not near").select("token", "cls", "n", "matches")
    if members is not None:  # what so many rounds leave over is formed in full
        direct.append(_pairs_within(members, num, den))
    every = direct[0]
    for more in direct[1:]:
        every = every.unionByName(more)
    pairs = stage.written(every.groupBy("x", "y").agg(F.count("*").alias("found"), F.first("asked").alias("asked")).where("found >= asked").select("x", "y"), "pairs")
    stage.release(spark)
    near = stage.written(_bounded(pairs, classes).where(f"{num + den} * least <= {den - num} * (nx + ny)").drop("least"), "near")
    stage.discard(pairs)
    stage.release(spark)
    together = lambda: reduce(DataFrame.unionByName, found)
    if _moved(near) > PARTS * limit // 2:
        first = stage.written(near.groupBy("y").agg(F.min(F.struct("x", "nx", "ny")).alias("one")).select("one.x", "y", "one.nx", "one.ny"), "first")
        found.append(_compared(docs, classes, first, k, limit, reached))
        near = stage.written(_between(near.join(first, ["x", "y"], "left_anti"), together()), "near")
    if near.limit(1).count():
        found.append(_compared(docs, classes, near, k, limit, reached))
    return stage.written(together() if found else spark.createDataFrame([], "a long, b long"), "links")


def _rooted(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Per row: doc_id, n, cls, component_id, and rep, the smallest class of the component that has a row of that doc_id; the last two are null without a class."""
    mark = stage.tables_made()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stage.written(_sets(docs, k), "sets")
    ranks = _ranks(rows)
    sets = rows.where("blk = -1").select("doc_id", "n", "cls")
    classes = stage.written(rows.where("blk = -1 and cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("data").alias("parity")), "classes")
    found = graph.connected(links(docs, classes, ranks, k, num, den))
    stage.release(docs.sparkSession)
    rooted = stage.written(classes.drop("n", "parity").join(found.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls")), "rooted")
    smallest = stage.written(rooted.groupBy("component").agg(F.min(F.struct("least", "cls")).alias("first"), F.count("*").alias("classes")), "smallest")
    dealt = split_join(rooted, smallest, "component", "classes", rooted.count(), F.xxhash64("cls"))
    by_class = stage.written(dealt.select("cls", "rows", F.col("first.least").alias("component_id"), F.col("first.cls").alias("rep")), "by-class")
    stage.discard_since(mark, rows, by_class)
    total = by_class.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    placed = split_join(sets.where("cls is not null"), by_class, "cls", "rows", total, F.xxhash64("doc_id")).select("doc_id", "n", "cls", "component_id", "rep")
    alone = sets.where("cls is null").select("doc_id", "n", "cls", F.lit(None).cast(sets.schema["doc_id"].dataType).alias("component_id"), F.lit(None).cast("long").alias("rep"))
    return placed.unionByName(alone)


def components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links of Jaccard >= num / den)."""
    return _rooted(docs, k, num, den).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _with_class(docs: DataFrame, k: int, name: str) -> DataFrame:
    """``docs`` with the class of each row in the column ``name``."""
    (text,) = stage.fresh([*docs.columns, name], "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text):
                own = [class_of(s) if len(s) else None for s in shingles(words.scan(part.column(text), words.SPACED), k)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(own, pa.int64())], names=[*part.schema.names[:-1], name])

    return docs.withColumn(text, F.col("text").cast("string")).mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def deduplicate(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component: that of the smallest doc_id; columns as they were. Rows with a null doc_id stay.

    Different texts under one doc_id are told apart by their class: each stays or goes with its own component.
    """
    doc, own_class, clash, own = stage.fresh(docs.columns, "_kept", "_class", "_clash", "_own")
    named = docs.where("doc_id is not null")
    mark = stage.tables_made()
    found = stage.written(_rooted(docs, k, num, den).where("doc_id is not null"), "rooted")
    kept = stage.written(found.where("cls is null or doc_id = component_id and cls = rep").select(F.col("doc_id").alias(doc), F.col("cls").alias(own_class)).distinct(), "kept")
    clashing = stage.written(found.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("doc_id").alias(clash)), "clashing")
    stage.discard_since(mark, kept, clashing)
    out = named.join(kept, F.col("doc_id") == F.col(doc), "left_semi")
    if clashing.limit(1).count():
        twice = _with_class(named.join(clashing, F.col("doc_id") == F.col(clash), "left_semi"), k, own)
        twice = twice.join(kept, (F.col("doc_id") == F.col(doc)) & F.col(own).eqNullSafe(F.col(own_class)), "left_semi").dropDuplicates(["doc_id", own]).drop(own)
        out = out.join(clashing, F.col("doc_id") == F.col(clash), "left_anti").unionByName(twice)
    return out.unionByName(docs.where("doc_id is null"))
