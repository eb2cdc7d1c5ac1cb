"""Audit of how quality filters interact: which documents each filter takes in every order of them."""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.settle import settled

WORD = "[^\\x20\\x09-\\x0D]+"
LETTERS = "ABCDE"  # A to D look at one text, E at all texts
REPEATED = 1 << LETTERS.index("E")
MIN_WORDS = 200
SALT_ROWS = 10_000  # rows of one text that one part of the join compares
SLOT_BITS = 16  # bits of the table that tells which hashes occur more than once, for each of these
BUCKET = 1 << 15  # bits of one of its rows, as Spark's bitmaps have
MOST_SLOTS = 1 << 28


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: too few words, too few different ones, too many
    capitals, odd signs."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = [n < MIN_WORDS, 100 * different < 50 * n, 100 * capitals > 2 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(tests)), F.lit(0)).cast("long")


def in_slots(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows (with a column hash) whose hash may be among ``hashes``: all that are, and few others.

    Spark sums the hashes up in a table of bits, ``SLOT_BITS`` for each of them, that every task gets. It has at most
    ``MOST_SLOTS`` bits (32 MB); beyond, more rows pass that a later join has to take out.
    """
    wanted = SLOT_BITS * max(1, hashes.count())
    slots = min(MOST_SLOTS, max(BUCKET, 1 << (wanted - 1).bit_length()))
    slot = F.col("hash").bitwiseAND(F.lit(slots - 1))
    at = slot.bitwiseAND(F.lit(BUCKET - 1)).cast("int")
    bits = hashes.groupBy(F.shiftright(slot, 15).alias("bucket")).agg(F.bitmap_construct_agg(at).alias("bitmap"))
    octet = F.conv(F.hex(F.substring("bitmap", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return (
        rows.withColumn("bucket", F.shiftright(slot, 15)).join(F.broadcast(bits), "bucket")
        .where(F.getbit(octet, at.bitwiseAND(F.lit(7))) == 1)
        .drop("bucket", "bitmap")
    )


def repeats(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (doc_id, part, text) whose text a smaller doc_id also has.

    Rows whose hash occurs once stay where they are. Each text's smallest doc_id is found
    before it is joined, so of a group of copies every row meets one row; a left-semi join on hash, exact text
    and smaller doc_id keeps those that have an earlier one. The rows of a very frequent text are dealt to as
    many parts as its count asks for, and its smallest doc_id is given to each of them.
    """
    known = texts.where(F.col("doc_id").isNotNull()).withColumn("hash", F.xxhash64("text"))
    counts = settled(known.groupBy("hash").agg(F.count("*").alias("copies")).where("copies > 1"))
    shared = (
        in_slots(known, counts).join(counts, "hash")
        .withColumn("parts", F.ceil(F.col("copies") / SALT_ROWS).cast("int")).drop("copies")
    )
    first = (
        shared.groupBy("hash", "text", "parts").agg(F.min("doc_id").alias("earlier"))
        .withColumn("part_no", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    dealt = shared.withColumn("part_no", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    same = (
        (F.col("l.hash") == F.col("r.hash")) & (F.col("l.part_no") == F.col("r.part_no"))
        & (F.col("l.text") == F.col("r.text")) & (F.col("l.doc_id") > F.col("r.earlier"))
    )
    return dealt.alias("l").join(first.alias("r"), same, "left_semi").select(*texts.columns)


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and by the set of filters they fail: part, bits, n, good, toxic.

    The ids that fail E, from ``repeats``, are put under those that fail the other filters, and the bits
    of each id are summed. An id is a doc_id with its text's hash and its part; rows alike in all
    three count as often as they occur.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"), text.alias("text")
    )
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    own = rows.select("doc_id", "part", digest, F.lit(1).cast("long").alias("n"), own_failures(F.col("text")).alias("bits"))
    # equal rows meet before the shuffle
    own = own.groupBy("doc_id", "part", "digest").agg(F.sum("n").alias("n"), F.max("bits").alias("bits"))
    late = repeats(rows).select("doc_id", "part", digest).distinct().select("doc_id", "part", "digest", F.lit(0).cast("long").alias("n"), F.lit(REPEATED).cast("long").alias("bits"))
    failing = own.unionByName(late).groupBy("doc_id", "part", "digest").agg(F.sum("n").alias("n"), F.sum("bits").alias("bits"))
    per_id = failing.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("bad")
    )
    told = per_id.where(F.col("doc_id").isNotNull()).join(said, "doc_id", "left").select("part", "bits", "n", "good", "bad")
    untold = per_id.where(F.col("doc_id").isNull()).select("part", "bits", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad"))
    return told.unionByName(untold).groupBy("part", "bits").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("bad", F.lit(0))).alias("toxic"),
    )


def total(values: str, takes) -> Column:
    """Sum of an array with one entry per set of failing filters, over the sets that ``takes`` allows."""
    each = F.transform(F.col(values), lambda v, bits: F.when(takes(bits), v).otherwise(F.lit(0).cast("long")))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, v: a + v)


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter takes in every order of the five: one row per part, filter_order and step.

    ``docs`` has doc_id, text and source, whose values are the parts (missing: the empty name); ``labels`` has
    doc_id, quality and toxic. kept: documents left after the step; removed: taken by it; redundant: failing its
    filter but taken earlier; unique_fails: failing no other filter; good_lost and toxic_lost: of the removed, those
    labelled quality 1 and toxic 1; shapley: what the filter removes, summed over all orders. Filters look
    at the input, so E fails a document whose first copy another filter takes.

    All of this follows from the documents per set of failing filters, at most 32 numbers a part, so
    the orders are worked out from those. A missing text counts as empty. A missing doc_id is neither earlier nor later
    than any other and has no label; rows of one doc_id are no copies of each other; of several labels of a doc_id, one
    that says 1 is enough. Other columns are left out; an empty table gives an empty result.
    """
    sets = range(1 << len(LETTERS))
    counts = ("n", "good", "toxic")
    found = combinations(docs, labels).groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("bits") == b, F.col(c))), F.lit(0)) for b in sets]).alias(c) for c in counts
    ])
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    steps = found.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))
    )
    places = [F.instr("filter_order", letter) for letter in LETTERS]
    own = reduce(lambda a, b: a + b, [F.when(p == F.col("step"), 1 << i).otherwise(0) for i, p in enumerate(places)])
    before = reduce(lambda a, b: a + b, [F.when(p < F.col("step"), 1 << i).otherwise(0) for i, p in enumerate(places)])
    steps = steps.withColumns({"own": own, "before": before})
    fails = lambda bits: bits.bitwiseAND(F.col("own")) != 0
    gone = lambda bits: bits.bitwiseAND(F.col("before")) != 0
    per_order = len(list(permutations(LETTERS)))
    shapley = reduce(lambda a, b: a + b, [
        F.when(F.col("own").bitwiseAND(F.lit(b)) != 0, F.get("n", F.lit(b)) * (per_order // b.bit_count())).otherwise(0) for b in sets if b
    ])
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda b: ~fails(b) & ~gone(b)).alias("kept"),
        total("n", lambda b: fails(b) & ~gone(b)).alias("removed"),
        total("n", lambda b: fails(b) & gone(b)).alias("redundant"),
        total("n", lambda b: b == F.col("own")).alias("unique_fails"),
        total("good", lambda b: fails(b) & ~gone(b)).alias("good_lost"),
        total("toxic", lambda b: fails(b) & ~gone(b)).alias("toxic_lost"),
        shapley.cast("long").alias("shapley"),
    )
