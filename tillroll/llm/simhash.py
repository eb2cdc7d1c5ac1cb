"""SimHash near-duplicates: fingerprints joined on shared blocks, then checked bit by bit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import aside, back, chunked, row_order, text_key
from tillroll.llm.components import components
from tillroll.operators.settle import settled

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
PAIR_GROUP = 64  # a block with more distinct fingerprints is linked without forming pairs

# Lane sums: each byte value as eight 8-bit lanes, one per bit.
LANES = np.zeros(256, np.uint64)
for _bit in range(8):
    LANES += ((np.arange(256) >> _bit) & 1).astype(np.uint64) << np.uint64(8 * _bit)
LANE_LIMIT = 255


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of every run of ``size`` words, joined by one space; of all words if there are fewer."""
    found = text.lower().split()
    if not found:
        return []
    line = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= size:
        return [digest(line, SEED)]
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    low, high = starts[: len(found) - size + 1].tolist(), ends[size - 1 :].tolist()
    return [digest(line[i:j], SEED) for i, j in zip(low, high)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For runs of ``counts`` hashes, the 64 bits that are set in over half of each run."""
    result = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return result
    sizes = counts[full]
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    pieces = -(-sizes // LANE_LIMIT)  # lanes are eight bits wide, so runs are summed in pieces
    first_piece = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    inner = np.arange(pieces.sum()) - np.repeat(first_piece, pieces)
    cuts = np.repeat(firsts, pieces) + inner * LANE_LIMIT
    octets = hashes.view(np.uint8).reshape(-1, 8)
    lanes = np.stack([np.add.reduceat(LANES[octets[:, j]], cuts) for j in range(8)], axis=1)
    per_piece = lanes.view(np.uint8).reshape(len(cuts), 64).astype(np.int64)
    totals = np.add.reduceat(per_piece, first_piece, axis=0)
    bits = (2 * totals > sizes[:, None]).astype(np.uint8)
    result[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return result


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_key and the fingerprint (long) of every row; a missing or empty text has 0."""

    def run(batches):
        for batch in chunked(batches):
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = [shingle_hashes(t or b"", size) for t in texts]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            hashes = np.fromiter((h for f in found for h in f), np.uint64, int(counts.sum()))
            marks = pa.array(majority(hashes, counts).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), marks], ["doc_id", "text_key", "mark"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, mark long")


def block_keys(max_bits: int) -> list[int]:
    """Bit masks of which two fingerprints within ``max_bits`` share at least one whole.

    The 64 bits are cut into max_bits + 2 blocks. At most max_bits blocks differ, so at least two
    agree: each pair of blocks is a key, far rarer than one block alone.
    """
    n = max_bits + 2
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]
    masks = [blocks[i] | blocks[j] for i in range(n) for j in range(i)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(marks: DataFrame, max_bits: int = MAX_BITS, pair_group: int = PAIR_GROUP) -> DataFrame:
    """Links (a, b) among distinct fingerprints that connect all within ``max_bits`` (even) bits.

    Candidates share two of the blocks; the join's pairs are then checked bit by bit. A key with
    more than ``pair_group`` fingerprints is not expanded into pairs: its members are written with
    every set of up to max_bits / 2 bits flipped. Two members within max_bits bits share such a
    variant, and any two that share one are within max_bits, so each variant links its members to
    the smallest: the same components, from a number of rows in proportion to the members.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    keyed = marks.select(
        "mark",
        F.posexplode(F.array(*[F.col("mark").bitwiseAND(F.lit(m)) for m in block_keys(max_bits)])).alias("kind", "key"),
    )
    sizes = keyed.groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = settled(keyed.join(sizes, ["kind", "key"]))
    few = shared.where(F.col("n") <= pair_group).select("kind", "key", "mark")
    pairs = (
        few.alias("x")
        .join(few.alias("y"), ["kind", "key"])
        .where("x.mark < y.mark")
        .where(F.bit_count(F.col("x.mark").bitwiseXOR(F.col("y.mark"))) <= max_bits)
        .select(F.col("x.mark").alias("a"), F.col("y.mark").alias("b"))
    )
    masks = [0]
    for _ in range(max_bits // 2):
        masks = sorted({m ^ (1 << bit) for m in masks for bit in range(64)} | set(masks))
    variants = [F.col("mark").bitwiseXOR(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks]
    many = shared.where(F.col("n") > pair_group).select("mark").distinct()
    spread = many.select("mark", F.explode(F.array(*variants)).alias("variant"))
    smallest = spread.groupBy("variant").agg(F.min("mark").alias("a"), F.max("mark").alias("z")).where("a < z")
    starred = spread.join(smallest, "variant").where("mark <> a").select("a", F.col("mark").alias("b"))
    return pairs.unionByName(starred)


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, text_key, fingerprint (16 hex digits), component_id, group_mark.

    Texts are lower-cased (A-Z) and split at ASCII white space; each shingle of ``size`` words is
    hashed by XXH64, and a fingerprint bit is set if more than half of the hashes have it. Documents
    within ``max_bits`` bits are linked; component_id is the smallest doc_id reached. A missing or
    empty text has fingerprint zero and is linked like any other. Repeated rows stay repeated;
    missing ids take no part in a minimum, and a component without ids has a missing component_id (group_mark, its smallest fingerprint, still
    names it). An empty table gives an empty result.
    Equal fingerprints meet as one row before any join, so a large group of copies costs one row.
    """
    rows = settled(fingerprints(docs, size))
    marks = settled(rows.groupBy("mark").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(marks.select("mark"), max_bits)).withColumnRenamed("node", "mark")
    placed = marks.join(roots, "mark", "left").withColumn("root", F.coalesce("root", "mark"))
    placed = settled(placed)
    firsts = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = placed.join(firsts, "root").select("mark", "component_id", F.col("root").alias("group_mark"))
    return rows.join(known, "mark").select(
        "doc_id",
        "text_key",
        F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"),
        "component_id",
        "group_mark",
    )


def one_per_group(docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: in each group, one row of the smallest doc_id.

    Rows that repeat that id within the group give way to the one of the smallest text hash, and rows that
    repeat id and text to the one of the smallest hash of all its columns. A group without ids keeps the row of the
    smallest text hash. The columns of ``docs`` stay as they are, whatever their names.
    """
    found = near_duplicates(docs.select("doc_id", "text"), size, max_bits)
    kept = (
        found.where("doc_id <=> component_id")
        .groupBy("group_mark")
        .agg(F.first("doc_id").alias("first_id"), F.min("text_key").alias("first_text"))
    )
    rows = docs.select(
        aside(docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), text_key().alias("text_key"),
        row_order(docs).alias("order"),
    )
    # equal keys meet before the shuffle
    rows = rows.groupBy("id", "text_key").agg(F.min_by("row", "order").alias("row"))
    same = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_text"))
    return rows.join(kept, same, "left_semi").select(*back("row", docs.columns))
