"""Mixing sources to target weights: Pfair windows, earliest deadline first."""

from __future__ import annotations

from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import column, row_order
from tillroll.operators.settle import settled

BLOCK_DOCS = 8  # documents of one source that are placed together
BUCKETS = 4096  # of each source, so that numbering its documents is no single task
MAX_PERIOD = 20_000  # most that the shares of named sources and the share of all others may add up to
SHARES = {"src0": 4, "src1": 3, "src2": 2}  # target weights of the registered query and the pipeline
OTHER_SHARE = 1  # of a source that is not named

ADDED = ("block", "place", "release", "deadline", "slot", "on_target")


def share_of(source: Column, shares: dict[str, int], other: int) -> Column:
    result = F.lit(other)
    for name, share in shares.items():
        result = F.when(source == name, share).otherwise(result)
    return result.cast("long")


def edf_runs(jobs: list[tuple]):
    """Runs of slots, earliest deadline first, as (tag, offset within the job, first slot, length).

    A job is (release, deadline, order, length, tag); ties go to the lower order.
    """
    waiting, ready, now = sorted(jobs, reverse=True), [], 0
    while waiting or ready:
        if not ready:
            now = max(now, waiting[-1][0])
        while waiting and waiting[-1][0] <= now:
            _, due, order, length, tag = waiting.pop()
            heappush(ready, (due, order, tag, 0, length))
        due, order, tag, done, length = heappop(ready)
        run = min(length - done, waiting[-1][0] - now) if waiting else length - done
        yield tag, done, now, run
        now += run
        if done + run < length:
            heappush(ready, (due, order, tag, done + run, length))


def periodic_slots(sources: DataFrame, shares: dict[str, int], other: int) -> tuple[DataFrame, int]:
    """One row for each block of a source in a period: _source, _turn, at; and the period.
    ``sources``: source, n.

    A source of share a has its block number n released at slot floor(n * period / a), due before
    slot ceil((n + 1) * period / a). Each slot goes to the released block of the earliest deadline, ties to
    the first source. Shares add up to the period, so every block meets its deadline.

    Sources that are not named have equal windows, so all of them between two names are one job a turn,
    whose slots they take in order. What is planned here does not grow with their number.
    """
    names = sorted(shares)
    named = F.col("source").isin(names)
    behind = sum((F.when(F.col("source") > name, 1).otherwise(0) for name in names), F.lit(0))  # names before it
    rank = F.row_number().over(Window.partitionBy("behind").orderBy("source")) - 1
    others = sources.where(~named).withColumn("behind", behind)
    present = [r.source for r in sources.where(named).collect()]
    sizes = [(r.behind, r.n) for r in others.groupBy("behind").agg(F.count("*").alias("n")).collect()]
    planned = sum(shares[s] for s in present) + (other if sizes else 0)
    if planned > MAX_PERIOD:
        raise ValueError(f"the shares of named sources and the share of all others add up to more than {MAX_PERIOD}")
    period = sum(shares[s] for s in present) + other * sum(n for _, n in sizes)

    def jobs(share, order, length, tag):
        return [(t * period // share, -(-(t + 1) * period // share), order, length, (tag, t)) for t in range(share)]

    todo = [job for s in present for job in jobs(shares[s], 2 * names.index(s) + 1, 1, 2 * names.index(s) + 1)]
    todo += [job for behind, n in sizes for job in jobs(other, 2 * behind, n, 2 * behind)]
    runs = [(tag, turn, offset, offset + length, slot) for (tag, turn), offset, slot, length in edf_runs(todo)]
    spark = sources.sparkSession
    single = spark.createDataFrame(
        [(names[tag // 2], turn, slot) for tag, turn, _, _, slot in runs if tag % 2], "_source string, _turn long, at long")
    shared = spark.createDataFrame(
        [(tag // 2, turn, low, high, slot) for tag, turn, low, high, slot in runs if tag % 2 == 0],
        "behind int, _turn long, low long, high long, slot long")
    ranked = others.select(F.col("source").alias("_source"), "behind", rank.alias("rank"))
    inside = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    taken = (
        ranked.join(F.broadcast(shared), "behind").where(inside)  # at most a few runs for each planned block
        .select("_source", "_turn", (F.col("slot") + F.col("rank") - F.col("low")).alias("at"))
    )
    return settled(single.unionByName(taken)), period


def mixed(
    docs: DataFrame, shares: dict[str, int] = SHARES, other: int = OTHER_SHARE, block_docs: int = BLOCK_DOCS
) -> DataFrame:
    """Every row of ``docs`` with its place in the mix; the mix is the rows in order of slot, place.

    Each source has a whole-number share; its weight is the share over the sum of the shares of the
    sources that occur. Its documents, in the order of a hash of doc_id, form blocks of ``block_docs``. Block n
    has the Pfair window from release to deadline, and earliest deadline first gives it one
    slot. Up to any slot a source has less than one block more or less than its weight asks for, as
    long as all sources last: there on_target is true. Then the slots of a source that has run out stay
    empty, and no row is dropped or repeated.

    The schedule repeats every sum-of-shares slots, so one period is planned and joined to all blocks.
    There may be any number of sources; shares of the named ones may add up to ``MAX_PERIOD`` less
    ``other``, and an error says if they are more. Sources are counted and the period is stored when this is called. Documents are numbered within buckets of a source and counts of buckets carried on, so a
    source with most of the rows is spread over many tasks.

    A missing source counts as the empty name, a missing doc_id as the empty id; equal ids are ordered by
    their texts, then by a hash of the row. Columns named block, place, release, deadline, slot or on_target are
    replaced, all others stay as they are; an empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ADDED]
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        # under other names, not in a struct, so that columns nobody asks for are not shuffled
        *[column(n).alias(f"user_{i}") for i, n in enumerate(names)],
        F.coalesce("source", F.lit("")).alias("_source"),
        F.conv(F.substring(key, 1, 3), 16, 10).cast("int").alias("_bucket"),
        key.alias("_key"),
        F.xxhash64("text").alias("_text"),
        row_order(docs.select(*map(column, names))).alias("_order"),
    )
    counts = rows.groupBy("_source", "_bucket").agg(F.count("*").alias("_n"))
    sources = settled(counts.groupBy(F.col("_source").alias("source")).agg(F.sum("_n").alias("n")))
    before = F.sum("_n").over(Window.partitionBy("_source").orderBy("_bucket")) - F.col("_n")
    offsets = counts.select("_source", "_bucket", before.alias("_before"))
    order = Window.partitionBy("_source", "_bucket").orderBy("_key", "_text", "_order")
    numbered = (
        rows.withColumn("_row", F.row_number().over(order))
        .join(offsets, ["_source", "_bucket"])
        .withColumn("_index", F.col("_before") + F.col("_row") - 1)
        .withColumn("block", F.floor(F.col("_index") / block_docs))
        .withColumn("place", (F.col("_index") % block_docs).cast("int"))
        .withColumn("_share", share_of(F.col("_source"), shares, other))
        .withColumn("_turn", F.col("block") % F.col("_share"))
    )
    plan, length = periodic_slots(sources, shares, other)
    placed = numbered.join(plan, ["_source", "_turn"])
    period, share, block = F.lit(length).cast("long"), F.col("_share"), F.col("block")
    lasting = F.floor(F.floor(F.col("n") / block_docs) * period / share_of(F.col("source"), shares, other))
    runs_out = sources.agg(F.min(lasting).alias("n")).first()["n"] or 0
    slot = F.floor(block / share) * period + F.col("at")
    return placed.select(
        *[F.col(f"user_{i}").alias(n) for i, n in enumerate(names)],
        "block",
        "place",
        F.floor(block * period / share).alias("release"),
        F.floor(((block + 1) * period + share - 1) / share).alias("deadline"),
        slot.alias("slot"),
        (slot < F.lit(runs_out)).alias("on_target"),
    )
