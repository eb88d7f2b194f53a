"""Packing of documents into training sequences: shortest-pack-first over the length histogram.

Texts are encoded once; each is cut into full sequences and one rest. Only the histogram of lengths (at
most `capacity` bins, whatever the corpus) reaches the driver, where lengths are placed longest first,
each into the open pack that is filled least, whole counts at a time, giving packing patterns with
counts. Patterns are joined back to the pieces by rank within their length. Each task numbers its
pieces of a length as it cuts them, and a count by (length, task) gives where its numbers begin, so no
length is ever ranked by one task.
"""

from __future__ import annotations

from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import settle
from eventloom.llm.tokens import crc32, encoder, slices

def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, task and its number among the
    pieces of that length in the task."""

    def run(batches):
        enc, task, seen = encoder(path), TaskContext.get().partitionId(), {}
        end = np.uint32(end_id).astype("<u4").tobytes()
        for batch in batches:
            ids_of = batch.column("doc_id").cast(pa.int64())
            for first, texts in slices(batch, "text"):
                rows, starts, lengths, crcs, totals, numbers = [], [], [], [], [], []
                for k, ids in enumerate(enc.encode(texts)):
                    ids += end
                    total = len(ids) // 4
                    for s in range(0, total, capacity):
                        part = ids[4 * s : 4 * (s + capacity)]
                        length = len(part) // 4
                        rows.append(first + k)
                        starts.append(s)
                        lengths.append(length)
                        crcs.append(crc32(part))
                        totals.append(total)
                        numbers.append(seen.get(length, 0))
                        seen[length] = numbers[-1] + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_of.take(pa.array(rows, pa.int32())),
                        *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)],
                        pa.array([task] * len(rows), pa.int32()),
                        pa.array(numbers, pa.int64()),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "number"],
                )
        enc.forget()

    narrow = docs.select("doc_id", "text")
    return narrow.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, number long")


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Patterns (count, lengths in order), placing lengths longest first.

    A length goes to the open pattern that is filled least, as often as that pattern occurs. Where it
    does not fit there it fits nowhere, and a new pack is opened, which takes it until it is full: so
    whole counts open patterns of as many copies as fit.
    """
    open_packs: dict[int, list[list]] = {}  # room left -> [[count, lengths]]
    rooms: list[int] = []
    done: list[tuple[int, list[int]]] = []

    def put(count: int, lengths: list[int], room: int) -> None:
        if room == 0:
            done.append((count, lengths))
            return
        if room not in open_packs:
            open_packs[room] = []
            insort(rooms, room)
        open_packs[room].append([count, lengths])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                fit = capacity // length
                whole, rest = divmod(left, fit)
                if whole:
                    put(whole, [length] * fit, capacity - fit * length)
                if rest:
                    put(1, [length] * rest, capacity - rest * length)
                break
            room = rooms[-1]
            pack = open_packs[room][-1]
            n = min(left, pack[0])
            if n == pack[0]:
                open_packs[room].pop()
                if not open_packs[room]:
                    del open_packs[room]
                    rooms.pop()
            else:
                pack[0] -= n
            put(n, [*pack[1], length], room - length)
            left -= n
    for packs in open_packs.values():
        done.extend((c, lengths) for c, lengths in packs)
    return done


def slots(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset): which ranks of a length go where."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            out.append((length, rank, count, sequence, offset))
            used[length] = rank + count
            offset += length
        sequence += count
    return out


def pack(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of `docs` is encoded with the vocabulary at `path`, without special tokens, and ends
    with `end_id`; a null text is empty and so has one token. Every id lies in exactly one piece.
    Repeated rows are packed as often as they occur; pieces of equal length are placed in the order of
    tasks and of rows within them, so ties can fall otherwise where the table is read in other parts.
    A very long text is cut into as many sequences as it fills. An empty table gives an empty result;
    further columns are ignored.
    """
    spark = docs.sparkSession
    cut = settle(pieces(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), path, capacity, end_id), "pieces")
    counts = settle(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length: dict[int, list[tuple]] = {}
    for length, *place in slots(pack_histogram(histogram, capacity)):
        by_length.setdefault(length, []).append(tuple(place))
    # As large as the patterns are, which the capacity bounds and not the corpus.
    places = spark.createDataFrame(list(by_length.items()), "length long, slots array<struct<rank:long,n:long,sequence:long,offset:long>>")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("base"), "n")
    reach = F.filter("slots", lambda s: (s["rank"] < F.col("base") + F.col("n")) & (F.col("base") < s["rank"] + s["n"]))
    table = bases.join(F.broadcast(places), "length").select("length", "task", "base", reach.alias("slots"))
    rank = F.col("base") + F.col("number")
    place = F.element_at(F.filter("slots", lambda s: (s["rank"] <= rank) & (rank < s["rank"] + s["n"])), 1)
    return (
        cut.join(table, ["length", "task"])
        .withColumn("at", place)
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("at.sequence") + rank - F.col("at.rank")).alias("sequence_id"), F.col("at.offset").alias("offset"),
        )
    )
