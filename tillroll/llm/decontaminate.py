"""Benchmark decontamination: exact hits of pieces, verified by bit-parallel edit distance."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import chunked
from tillroll.operators.settle import settled

ERROR_RATE = 0.08  # edits allowed, as a share of an item's characters
MIN_CHARS = 20  # a shorter item stands in too many texts by chance: it must be a whole line or text
BLOCK_BYTES = 4_000_000  # items that one automaton holds
STEP_BYTES = 64_000_000  # items that one pass over the texts holds, block after block
BUFFER_BYTES = 64_000_000  # texts that wait in a task while the blocks take turns
NOT_WORD = re.compile(r"\W+")
HITS = "array<struct<item_id:bigint,distance:int>>"


def normal(text: str | None) -> str:
    """Lower-cased words with one space between them; case, punctuation and layout do not count."""
    return NOT_WORD.sub(" ", (text or "").lower()).strip()


def plain(text: str) -> str:
    """The normal form, or the text itself without outer spaces where it is made of symbols alone."""
    return normal(text) or text.strip()


@dataclass(frozen=True)
class Item:
    item_id: int | None
    text: str
    budget: int

    def cut(self, piece: int) -> int:
        """Where a piece starts: budget + 1 of them, so that many edits leave at least one whole."""
        return len(self.text) * piece // (self.budget + 1)

    def pieces(self) -> Iterator[tuple[int, str]]:
        return ((j, self.text[self.cut(j) : self.cut(j + 1)]) for j in range(self.budget + 1))

    def around(self, piece: int) -> list[tuple[int, int]]:
        """Ever larger runs of pieces around one, as first piece and the one behind the last; the whole comes last.

        n pieces with fewer than n edits halve into a part of m pieces with fewer than m edits, and so on
        down to one piece without any. So on the way up from that piece no run exceeds its own budget."""
        low, high, runs = 0, self.budget + 1, []
        while high - low > 1:
            runs.append((low, high))
            middle = (low + high + 1) // 2
            low, high = (low, middle) if piece < middle else (middle, high)
        return runs[::-1] or [(0, 1)]


def least_distance(pattern: str, text: str) -> int:
    """Least edit distance between the pattern and any stretch of the text (Myers' bit vectors)."""
    mask, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | (1 << i)
    plus, minus, score = mask, 0, len(pattern)
    best = score
    for c in text:
        equal = places.get(c, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (mask & ~(across | plus))
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            best = min(best, score)
        up, down = (up << 1) & mask, (down << 1) & mask
        plus = down | (mask & ~(vertical | up))
        minus = up & vertical
    return best


class Matcher:
    """Finds a block of items in texts. Items shorter than ``min_chars`` count as whole lines or texts only."""

    def __init__(self, items: list[Item], min_chars: int = 0):
        self.items = items
        self.trie = ahocorasick.Automaton()
        self.short: dict[str, list[int]] = {}
        owners: dict[str, list] = {}
        for i, item in enumerate(items):
            if len(item.text) < min_chars or not normal(item.text):
                self.short.setdefault(item.text, []).append(i)
                continue
            for j, piece in item.pieces():
                owners.setdefault(piece, []).append((i, j))
        for piece, owned in owners.items():
            self.trie.add_word(piece, owned)
        if owners:
            self.trie.make_automaton()
        self.searched = bool(owners)

    def hits(self, text: str) -> list[tuple[int | None, int]]:
        """item_id and distance of every item that stands in the text within its budget."""
        found = self.searches(normal(text)) if self.searched else {}
        if self.short:
            for line in {plain(text), *map(plain, text.split("\n"))}:
                found.update((i, 0) for i in self.short.get(line, ()))
        return sorted(((self.items[i].item_id, d) for i, d in found.items()), key=lambda h: (h[0] is None, *h))

    def searches(self, line: str) -> dict[int, int]:
        judged = set()  # runs of pieces already measured there: the runs around them are, too
        found: dict[int, int] = {}
        for last, owned in self.trie.iter(line):
            for i, piece in owned:
                item = self.items[i]
                start = last + 1 - item.cut(piece + 1)  # of the item, were there no edits
                if found.get(i) == 0:
                    continue
                for low, high in item.around(piece):
                    if (i, low, high, start) in judged:
                        break
                    judged.add((i, low, high, start))
                    a, b, budget = item.cut(low), item.cut(high), high - low - 1
                    part, window = item.text[a:b], line[max(0, start + a - budget) : max(0, start + b + budget)]
                    if len(window) < len(part) - budget:
                        break
                    distance = 0 if part in window else least_distance(part, window)
                    if distance > budget:
                        break
                else:
                    found[i] = min(distance, found.get(i, distance))
        return found


def item_steps(benchmark: DataFrame, error_rate: float) -> Iterator[list[list[Item]]]:
    """The items as blocks filled by bytes, as many blocks at a time as one pass takes; repeats once.

    An item of more than ``BLOCK_BYTES`` is a block of its own."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL").distinct()
    blocks: list[list[Item]] = []
    room = total = 0
    for item_id, raw in rows.toLocalIterator():  # a partition at a time
        text = plain(raw)
        if not text:
            continue
        size = len(text.encode("utf-8", "surrogatepass"))
        if blocks and total + size > STEP_BYTES:
            yield blocks
            blocks, room, total = [], 0, 0
        if size > room:
            blocks.append([])
            room = BLOCK_BYTES
        blocks[-1].append(Item(item_id, text, int(error_rate * len(text))))
        room, total = room - size, total + size
    if blocks:
        yield blocks


def matched(batches, blocks: list[list[Item]], min_chars: int):
    """Every batch with the hits of each of its texts. A single block keeps its automaton; several take turns
    over ``BUFFER_BYTES`` of texts, so that one automaton exists at a time."""
    if len(blocks) == 1:
        matcher = Matcher(blocks[0], min_chars)
        for batch in batches:
            yield batch, [matcher.hits(t) if t else [] for t in texts_of(batch)]
        return
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size >= BUFFER_BYTES:
            yield from in_turn(waiting, blocks, min_chars)
            waiting, size = [], 0
    yield from in_turn(waiting, blocks, min_chars)


def in_turn(batches: list, blocks: list[list[Item]], min_chars: int):
    hits = [[[] for _ in range(batch.num_rows)] for batch in batches]
    for block in blocks if batches else []:
        matcher = Matcher(block, min_chars)
        for batch, rows in zip(batches, hits):
            for row, text in zip(rows, texts_of(batch)):
                row += matcher.hits(text) if text else []
    yield from zip(batches, hits)


def texts_of(batch):
    return batch.column(batch.schema.get_field_index("text")).to_pylist()


def passes(docs: DataFrame, benchmark: DataFrame, error_rate: float, run) -> DataFrame:
    """``run(batches, blocks)`` over the rows for the items of each step. Steps beyond the first read what the
    step before wrote, so a task has one Python worker whatever the size of the benchmark."""
    result = docs
    for n, blocks in enumerate(item_steps(benchmark, error_rate)):
        shared = docs.sparkSession.sparkContext.broadcast(blocks)  # STEP_BYTES of text, or one item
        result = (settled(result) if n else result).mapInArrow(
            lambda batches, shared=shared: run(chunked(batches), shared.value), result.schema
        )
    return result


def with_hits(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS
) -> DataFrame:
    """Every row of ``docs`` with a column hits: the items it holds, each with its least distance found.

    An item stands in a document if some stretch of the text is within error_rate times the
    item's length in single-character edits, both lower-cased and without punctuation. Of an item cut into
    one piece more than its budget at least one survives any allowed edits, so only stretches
    around exact piece hits are measured. An item shorter than ``min_chars`` stands in a document that
    has it as a whole line or is it altogether, without edits; so does one of symbols alone, compared as
    it is. A text that is missing or empty has no hits, nor has any item that is missing or
    blank. Items come in blocks filled by bytes, without a shuffle of the texts. Other columns and
    repeated rows stay as they are; a column named hits is replaced; an empty table gives an empty result.
    """
    names = [c for c in docs.columns if c != "hits"]

    def run(batches, blocks):
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))
        for batch, hits in matched(batches, blocks, min_chars):
            at = batch.schema.get_field_index("hits")
            rows = [
                sorted((before or []) + [{"item_id": i, "distance": d} for i, d in now], key=hit_order)
                for now, before in zip(hits, batch.column(at).to_pylist())
            ]
            columns = [pa.array(rows, kind) if j == at else c for j, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return passes(docs.select(*names).withColumn("hits", F.array().cast(HITS)), benchmark, error_rate, run)


def hit_order(hit: dict):
    return hit["item_id"] is None, hit["item_id"], hit["distance"]


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""

    def run(batches, blocks):
        for batch, hits in matched(batches, blocks, min_chars):
            yield batch.filter(pa.array([not h for h in hits], pa.bool_()))

    return passes(docs, benchmark, error_rate, run)
