"""N-gram Jaccard join with several global token orders.

Links are pairs of shingle sets whose Jaccard similarity reaches 0.8. In any total order of all
tokens, the first n - ceil(0.8 n) + 1 tokens of two linked sets share one, so candidates must share
such a prefix token under every one of several orders: the first by rarity, which forms candidates,
and three more by classes of rarity and other hashes, whose prefixes each set carries as bitmaps that
are intersected, with the length and positional bounds, before any set is fetched.

Rarity is exact for all but the most frequent tokens. Each task sends the tokens of its sets in blocks
by range of hash; a range is counted and only tokens that several sets hold are sent back, as those of
one set come first in every order and link nothing. Tokens that a fixed-size sketch of the corpus shows
to be very frequent are not counted; they come last in every order, by classes of the sketch.

Equal sets are one node. In a bucket of more than a few sets each is compared with the most central
set of its length, which takes work in proportion to the bucket; the sets that stay in different
components after that are compared with all others of their bucket that they meet in as many buckets
as a link needs, so no link between components is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import discard, settle, spare
from eventloom.llm.components import components
from eventloom.llm.shingles import mix, set_id, shingle_set
from eventloom.llm.tokens import slices

#: Counters of the frequency sketch, in parts of so many.
SKETCH, PART = 1 << 20, 1 << 16
#: A token is very frequent where its counter holds so many times the mean.
HOT = 16
#: Tokens and sets of a block at most, and ranges of hashes for each shuffle partition.
BLOCK, BLOCK_SETS, RANGES = 500_000, 65_535, 4
#: Buckets up to this size emit all their pairs at once.
SMALL = 8
#: Multipliers of the token hash in the three further orders.
ORDERS = {"x": 0x9FB21C651E98DF25, "y": 0xD6E8FEB86659FD93, "z": 0xA0761D6478BD642F}
#: Rows and texts are picked by broadcast up to so many ids (16 bytes each).
BROADCAST_IDS = 500_000


def prefix(n, percent):
    """Prefix length for a similarity of at least percent / 100."""
    return n + (-percent * n) // 100 + 1


def scan(docs: DataFrame) -> DataFrame:
    """A row (doc_id, n, e, k) for each row: set size, id of the set (null for an empty one) and hash of
    the text; and from each task the parts (part, c) of a sketch that counts the tokens of its sets."""

    def run(batches):
        total, seen = np.zeros(SKETCH, np.int64), set()
        for batch in batches:
            for start, part in slices(batch, "text"):
                sets = [shingle_set(t) for t in part]
                ids = [set_id(s) if len(s) else None for s in sets]
                new = []
                for e, s in zip(ids, sets, strict=True):
                    if e is not None and e not in seen:
                        seen.add(e)
                        new.append((s & np.uint64(SKETCH - 1)).astype(np.int32))
                if len(seen) > 500_000:
                    seen.clear()
                if new:
                    total += np.bincount(np.concatenate(new), minlength=SKETCH)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(part)).cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids, pa.int64()),
                        batch.column("k").slice(start, len(part)),
                        pa.nulls(len(part), pa.int32()),
                        pa.nulls(len(part), pa.binary()),
                    ],
                    names=["doc_id", "n", "e", "k", "part", "c"],
                )
        if total.any():
            for k in range(0, SKETCH, PART):
                c = zlib.compress(total[k : k + PART].tobytes(), 1)
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([k], pa.int32()), pa.array([c], pa.binary())], names=["doc_id", "n", "e", "k", "part", "c"])

    named = docs.select("doc_id", "text", F.xxhash64("text").alias("k"))
    return named.mapInArrow(run, "doc_id long, n long, e long, k long, part int, c binary")


def frequent_classes(parts: DataFrame) -> np.ndarray:
    """For each counter of the sketch 0, or where it is that of a very frequent token a class of at
    least 1, eight for each doubling. The size is fixed, and any classes give a right join."""

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in zip(batch.column("part").to_pylist(), batch.column("c").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(c), np.int64)
        for k, c in sums.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "c": pa.array([zlib.compress(c.tobytes(), 1)], pa.binary())})

    rows = parts.repartition(SKETCH // PART, "part").mapInArrow(merge, "part int, c binary").collect()
    total = np.zeros(SKETCH, np.int64)
    for r in rows:
        total[r["part"] : r["part"] + PART] = np.frombuffer(zlib.decompress(r["c"]), np.int64)
    times = total / max(HOT * total.mean(), HOT)
    return np.where(times > 1, 1 + 8 * np.log2(np.maximum(times, 1)), 0).clip(0, 255).astype(np.uint8)


def first_rows(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The texts of `docs` without those of which another row has the same set and a smaller (doc_id, k);
    equal rows stay."""
    mine = F.struct("doc_id", "k")
    least = sets.groupBy("e").agg(F.min(mine).alias("first"), F.max(mine).alias("last")).filter("first <> last")
    again = sets.join(least, "e").filter(mine != F.col("first")).select(F.col("doc_id").alias("id"), F.col("k").alias("of")).distinct()
    again = settle(again, "again")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("k"))
    same = rows.doc_id.eqNullSafe(F.col("id")) & (rows.k == F.col("of"))
    if again.count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(again), same, "left_anti")
    # In a fixed order, as a task that runs again must form the same blocks.
    return rows.join(again.hint("shuffle_hash"), same, "left_anti").sortWithinPartitions("doc_id", "k")


BLOB = "r int, block long, a binary, b binary, c binary"


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=["r", "block", "a", "b", "c"])


def token_blocks(texts: DataFrame, classes: Broadcast, bits: int, percent: int) -> DataFrame:
    """The sets of `texts` in blocks. Of each block a row for each of the 2**bits ranges of hashes: 4
    bytes of its tokens by set and how many each set has; and a head, with r < 0: the sets' ids and
    sizes and (set, token, class) of very frequent tokens. A worker skips sets it has just seen."""

    def run(batches):
        seen: set[int] = set()
        base, turn = TaskContext.get().partitionId() << 32, 0
        held: list[np.ndarray] = []
        ids: list[int] = []
        size = 0

        def flush():
            nonlocal held, ids, size, turn
            block, turn = base + turn, turn + 1
            flat, ns = np.concatenate(held), np.array([len(s) for s in held])
            of = np.repeat(np.arange(len(held), dtype=np.uint16), ns)
            cls = classes.value[(flat & np.uint64(SKETCH - 1)).astype(np.int64)]
            rs, tail = (flat >> np.uint64(64 - bits)).astype(np.uint16), flat.astype(np.uint32)
            hot = np.flatnonzero(cls)
            known = np.stack([of[hot].astype(np.uint64), rs[hot].astype(np.uint64) << np.uint64(32) | tail[hot], cls[hot].astype(np.uint64)])
            out = [(-1 - block % (1 << bits), block, np.array(ids, np.int64).tobytes(), ns.astype(np.uint32).tobytes(), known.tobytes())]
            cold = np.flatnonzero(cls == 0)
            rs, tail, of = rs[cold], tail[cold], of[cold]
            order = np.argsort(rs, kind="stable")
            rs, tail, of = rs[order], tail[order], of[order]
            edges = np.searchsorted(rs, np.arange((1 << bits) + 1))
            for r in range(1 << bits):
                a, b = int(edges[r]), int(edges[r + 1])
                if a < b:
                    per_set = np.bincount(of[a:b], minlength=len(held)).astype("<u4")
                    width = 1 if per_set.max() < 256 else 4
                    out.append((r, block, tail[a:b].tobytes(), per_set.astype(f"<u{width}").tobytes(), bytes([width])))
            held, ids, size = [], [], 0
            return _blobs(out)

        for batch in batches:
            for _, part in slices(batch, "text"):
                for t in part:
                    s = shingle_set(t)
                    if not len(s) or (e := set_id(s)) in seen:
                        continue
                    seen.add(e)
                    held.append(s)
                    ids.append(e)
                    size += len(s)
                    if size >= BLOCK or len(held) >= BLOCK_SETS:
                        yield flush()
                if len(seen) > 500_000:
                    seen.clear()
        if held:
            yield flush()

    return texts.select("text").mapInArrow(run, BLOB)


def shared_tokens(blocks: DataFrame) -> DataFrame:
    """The heads as they are, and for each block and range the tokens that several sets hold: (set,
    4 bytes of the token, in how many sets). A task holds the tokens of one range."""

    def run(batches):
        r, group = None, []

        def count():
            parts = [(block, np.frombuffer(a, "<u4"), np.frombuffer(b, f"<u{c[0]}")) for block, a, b, c in group]
            flat = np.concatenate([p[1] for p in parts])
            _, at, many = np.unique(flat, return_inverse=True, return_counts=True)
            df = np.minimum(many, 65_535).astype(np.uint16)[at]
            out, start = [], 0
            for block, tokens, per_set in parts:
                own = df[start : start + len(tokens)]
                start += len(tokens)
                keep = np.flatnonzero(own > 1)
                if len(keep):
                    of = np.repeat(np.arange(len(per_set), dtype=np.uint16), per_set)
                    out.append((r, block, of[keep].tobytes(), tokens[keep].tobytes(), own[keep].tobytes()))
            return _blobs(out) if out else None

        for batch in batches:
            cols = [batch.column(c) for c in ("r", "block", "a", "b", "c")]
            heads = np.flatnonzero(cols[0].to_numpy() < 0)
            if len(heads):
                yield batch.take(pa.array(heads))
            for k in range(len(heads), batch.num_rows):
                row = [c[k].as_py() for c in cols]
                if row[0] != r:
                    if group and (found := count()) is not None:
                        yield found
                    r, group = row[0], []
                group.append(row[1:])
        if group and (found := count()) is not None:
            yield found

    return blocks.repartition("r").sortWithinPartitions("r").mapInArrow(run, BLOB)


def order_block(head: tuple, parts: list[tuple], percent: int) -> pa.RecordBatch | None:
    """The prefix rows of a block's sets. Tokens of one set only come first in every order, so of a
    prefix only its length less their number is of tokens that others hold."""
    es, ns, known = np.frombuffer(head[1], np.int64), np.frombuffer(head[2], np.uint32).astype(np.int64), np.frombuffer(head[3], np.uint64).reshape(3, -1)
    of = np.concatenate([known[0].astype(np.int64), *(np.frombuffer(p[1], np.uint16).astype(np.int64) for p in parts)])
    ids = np.concatenate([known[1], *(np.uint64(p[0] << 32) | np.frombuffer(p[2], "<u4").astype(np.uint64) for p in parts)])
    df = np.concatenate([known[2] + np.uint64(65_536), *(np.frombuffer(p[3], np.uint16).astype(np.uint64) for p in parts)])
    alone = ns - np.bincount(of, minlength=len(ns))
    left = prefix(ns, percent) - alone
    keep = np.flatnonzero(left[of] > 0)
    if not len(keep):
        return None
    of, ids, df = of[keep], ids[keep], df[keep]
    size = np.bincount(of, minlength=len(ns))
    begin = np.cumsum(size) - size

    def ranks(key):
        order = np.lexsort((ids, key, of))
        out = np.empty(len(of), np.int64)
        out[order] = np.arange(len(of)) - begin[of[order]]
        return out

    spread = mix(ids)
    bit = np.uint64(1) << (spread >> np.uint64(58))
    kind = np.ceil(np.log2(df.astype(np.float64))).astype(np.uint64) << np.uint64(56)
    bitmaps = []
    for times in ORDERS.values():
        first = ranks(kind | mix(ids * np.uint64(times)) >> np.uint64(8)) < left[of]
        bitmap = np.zeros(len(ns), np.uint64)
        np.bitwise_or.at(bitmap, of[first], bit[first])
        bitmaps.append(bitmap)
    rank = ranks(df << np.uint64(40) | spread >> np.uint64(24))
    first = np.flatnonzero(rank < left[of])
    of, rank = of[first], rank[first]
    cols = [ids[first].view(np.int64), (alone[of] + rank).astype(np.int32), ns[of].astype(np.int32), es[of], *(b[of].view(np.int64) for b in bitmaps)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["tok", "pos", "n", "e", *ORDERS])


def prefix_rows(blobs: DataFrame, percent: int) -> DataFrame:
    """(tok, pos, n, e, x, y, z): the tokens in the prefixes under the rarity order that several sets hold,
    and bitmaps of the set's prefixes under the further orders. A task holds one block."""

    def run(batches):
        block, rows = None, []

        def finish():
            rows.sort(key=lambda x: x[0])
            return order_block(rows[0], rows[1:], percent)

        for batch in batches:
            cols = [batch.column(c) for c in ("block", "r", "a", "b", "c")]
            for k in range(batch.num_rows):
                row = [c[k].as_py() for c in cols]
                if row[0] != block:
                    if rows and (found := finish()) is not None:
                        yield found
                    block, rows = row[0], []
                rows.append(row[1:])
        if rows and (found := finish()) is not None:
            yield found

    ordered = blobs.repartition("block").sortWithinPartitions("block")
    return ordered.mapInArrow(run, "tok long, pos int, n int, e long, x long, y long, z long")


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether two rows of one bucket may link: length and positional bounds, and a common token in the
    prefixes under every further order."""
    n1, n2, p1, p2 = (F.col(k).cast("long") for k in (f"{a}.n", f"{b}.n", f"{a}.pos", f"{b}.pos"))
    most = F.least(p1, p2) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    bound = (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (most >= needed(n1, n2, percent))
    for k in ORDERS:
        bound = bound & (F.col(f"{a}.{k}").bitwiseAND(F.col(f"{b}.{k}")) != 0)
    return bound


def needed(n1: Column, n2: Column, percent: int) -> Column:
    """The least number of common tokens of linked sets of these sizes."""
    return -F.floor(-percent * (n1 + n2) / (100 + percent))


def bucket_rows(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of buckets of several sets, with how often the set has the token's id (w), the bucket's
    size m and the length class l."""
    rows = rows.groupBy("tok", "e", "n", *ORDERS).agg(F.min("pos").alias("pos"), F.count("*").alias("w")).withColumn("l", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int"))
    sizes = rows.groupBy("tok").agg(F.count("*").alias("m")).filter("m > 1")
    return rows.join(sizes, "tok")


def first_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): candidates of small buckets, and in others of each set with the set of least position in
    its bucket and length class, and in the class below; ties go by a hash, the same in all buckets."""
    small = rows.filter(F.col("m") <= SMALL)
    x, y = small.alias("x"), small.alias("y")
    some = x.join(y, (F.col("x.tok") == F.col("y.tok")) & (F.col("x.e") < F.col("y.e")) & may_link("x", "y", percent)).select(F.col("x.e").alias("a"), F.col("y.e").alias("b"))
    large = rows.filter(F.col("m") > SMALL)
    centre = F.min(F.struct("pos", F.xxhash64("e").alias("h"), "e", "n", *ORDERS)).alias("c")
    centres = large.groupBy("tok", "l").agg(centre).select("tok", "l", "c.*")
    keyed = large.withColumn("l", F.explode(F.array("l", F.col("l") - 1)))
    u, v = keyed.alias("u"), centres.alias("v")
    many = u.join(v, (F.col("u.tok") == F.col("v.tok")) & (F.col("u.l") == F.col("v.l")) & (F.col("u.e") != F.col("v.e")) & may_link("u", "v", percent))
    many = many.select(F.least("u.e", "v.e").alias("a"), F.greatest("u.e", "v.e").alias("b"))
    return some.union(many).distinct()


def open_pairs(rows: DataFrame, comps: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """(a, b): what is left to compare in buckets that hold several components."""
    large = rows.filter(F.col("m") > SMALL).drop("m", "l")
    named = large.join(comps.select("node", "comp"), large.e == F.col("node"), "left").withColumn("c", F.coalesce("comp", "e")).drop("node", "comp")
    named = settle(named, "open")
    sizes = named.groupBy("tok", "c").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("tok").agg(F.max(F.struct("m", "c")).alias("top"), F.count("*").alias("k")).filter("k > 1")
    several = settle(named.join(largest.select("tok", F.col("top.c").alias("top")), "tok"), "several")
    discard(named)
    # Each row with all such tokens of its set, in the order of rarity, and its place j among them.
    places = F.sort_array(F.collect_list(F.struct("pos", "tok", "top"))).alias("at")
    whole = several.groupBy("e", "n", "c", *ORDERS).agg(places, (F.sum("w") - F.count("*")).alias("extra"))
    rows = whole.select("e", "n", "c", *ORDERS, "extra", F.col("at.tok").alias("toks"), F.posexplode("at").alias("j", "row")).select("*", "row.*").drop("row", "at")
    rows = settle(rows, "open-rows")
    discard(several)
    x, y = rows.filter("c <> top").alias("x"), rows.alias("y")
    once = (F.col("y.c") == F.col("y.top")) | (F.col("x.e") < F.col("y.e"))
    # The i-th common token of linked sets is at most at i + n - need in each, so `need` less the sure
    # part of the larger set's rest lie in both prefixes. A pair that meets in a small bucket was
    # tried; any other meets in buckets of `several` only, in so many, and in the first of them that
    # many less one of each set's tokens still follow.
    n1, n2 = F.col("x.n").cast("long"), F.col("y.n").cast("long")
    meetings = needed(n1, n2, percent) + F.floor(-percent * F.greatest(n1, n2) / 100) + 1 - F.least("x.extra", "y.extra")
    early = (F.col("x.j") + meetings <= F.size("x.toks")) & (F.col("y.j") + meetings <= F.size("y.toks"))
    often = F.size(F.array_intersect("x.toks", "y.toks")) >= meetings
    near = (F.col("x.tok") == F.col("y.tok")) & (F.col("x.c") != F.col("y.c")) & once & may_link("x", "y", percent) & early & often
    pairs = x.join(y, near).select(F.least("x.e", "y.e").alias("a"), F.greatest("x.e", "y.e").alias("b")).distinct()
    pairs = settle(pairs.join(tried, ["a", "b"], "left_anti"), "cross")
    discard(rows)
    return pairs


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def bucket_counts(s: np.ndarray) -> np.ndarray:
    """How many tokens of a set fall in each of a power of two of buckets, about four in each."""
    bits = max(0, (len(s) // 4).bit_length())
    return np.bincount((mix(s) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(s), np.int64), minlength=1 << bits).astype(np.uint16)


def may_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the bucket counts of two sets allow a link: no bucket shares more than its lesser count."""
    n1, n2 = int(a.sum(dtype=np.int64)), int(b.sum(dtype=np.int64))
    while len(a) > len(b):
        a = a.reshape(-1, 2).sum(axis=1)
    while len(b) > len(a):
        b = b.reshape(-1, 2).sum(axis=1)
    both = int(np.minimum(a, b).sum(dtype=np.int64))
    return 100 * both >= percent * (n1 + n2 - both)


def verify(docs: DataFrame, sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids that link. Only texts that stand for a set in `pairs` are read into sets."""
    wanted = pairs.select(F.col("a").alias("e")).union(pairs.select("b")).distinct()
    stand = sets.join(wanted, "e", "left_semi").groupBy("e").agg(F.min(F.struct("doc_id", "k")).alias("at"))
    stand = settle(stand.select(F.col("e").alias("set"), F.col("at.doc_id").alias("id"), F.col("at.k").alias("of")), "stand")
    # Three numbers a row: broadcast while few, else the texts are shuffled.
    few = F.broadcast(stand) if stand.count() <= BROADCAST_IDS else stand.hint("shuffle_hash")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("k"))
    texts = rows.join(few, rows.doc_id.eqNullSafe(F.col("id")) & (rows.k == F.col("of"))).select("set", "text")

    def read(batches):
        for batch in batches:
            want = batch.column("set").to_pylist()
            for start, part in slices(batch, "text"):
                ids, raw, few = [], [], []
                for k, t in enumerate(part):
                    s = shingle_set(t)
                    ids.append(want[start + k])
                    raw.append(s.tobytes())
                    few.append(bucket_counts(s).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raw, pa.binary()), pa.array(few, pa.binary())], names=["e", "s", "c"])

    held = settle(texts.mapInArrow(read, "e long, s binary, c binary"), "held-sets")  # twice where a row is; links are made distinct
    discard(stand)

    def meet(pairs, column, ids):
        side = held.select("e", column).join(ids, "e", "left_semi") if ids is not None else held.select("e", column)
        right = pairs.join(side.select(F.col("e").alias("b"), F.col(column).alias("sb")), "b")
        return right.join(side.select(F.col("e").alias("a"), F.col(column).alias("sa")), "a").select("a", "b", "sa", "sb")

    def near(batches):
        for batch in batches:
            sa, sb = batch.column("sa"), batch.column("sb")
            keep = [may_overlap(np.frombuffer(x.as_py(), np.uint16), np.frombuffer(y.as_py(), np.uint16), percent) for x, y in zip(sa, sb, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Counts, a sixteenth of a set, meet first; whole sets only for the pairs that they leave.
    close = settle(meet(pairs, "c", None).mapInArrow(near, "a long, b long").distinct(), "close")
    ids = settle(close.select(F.col("a").alias("e")).union(close.select("b")).distinct(), "close-ids")
    whole = meet(close, "s", F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids)

    def check(batches):
        for batch in batches:
            sa, sb = batch.column("sa"), batch.column("sb")
            keep = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(sa, sb, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = settle(whole.mapInArrow(check, "a long, b long"), "links")
    discard(held, close, ids)
    return links


def set_components(spark: SparkSession, docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows (doc_id, n, e, k) and the components (node, comp) of the sets that link."""
    docs = docs.select("doc_id", "text")
    found = settle(scan(docs), "sets")
    sets = found.filter("part IS NULL").select("doc_id", "n", "e", "k")
    classes = spark.sparkContext.broadcast(frequent_classes(found.filter("part IS NOT NULL").select("part", "c")))  # 1 MB, whatever the corpus
    bits = min(16, (RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    named = sets.filter("e IS NOT NULL")
    blobs = shared_tokens(token_blocks(first_rows(docs, named), classes, bits, percent))
    prefixes = settle(prefix_rows(blobs, percent), "prefixes")
    rows = settle(bucket_rows(prefixes, percent), "buckets")
    discard(prefixes)
    pairs = settle(first_pairs(rows, percent), "pairs")
    links = verify(docs, named, pairs, percent)
    comps = components(links)
    more = open_pairs(rows, comps, pairs, percent)
    discard(rows, pairs)
    if not more.isEmpty():
        again = verify(docs, named, more, percent)
        discard(comps)
        comps = components(links.union(again))
        discard(again)
    discard(links, more)
    return sets, comps


def jaccard_components(spark: SparkSession, docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of `docs` (doc_id, text).

    A null or empty text has an empty set and is its own component. Rows with equal sets are linked;
    repeated rows each get a row. The component of a row is the smallest id that is reachable; a pair
    exactly at the threshold links. Sets are told apart by a 64-bit hash, as are shingles. Very long
    texts count whole, an empty table gives an empty result, and further columns are ignored.
    """
    sets, comps = set_components(spark, docs, percent)
    first = sets.filter("e IS NOT NULL").groupBy("e").agg(F.min("doc_id").alias("first"))
    joined = first.join(comps, first.e == comps.node).groupBy("comp").agg(F.min("first").alias("low"))
    lows = comps.join(joined, "comp").select("node", "low")
    ids = first.join(lows, first.e == lows.node, "left").select(F.col("e").alias("set"), F.coalesce("low", "first").alias("component_id"))
    return sets.join(ids, sets.e == ids.set, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(spark: SparkSession, docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, that stand for their component of sets: one row of the smallest
    id of each, one without an id only where no row has any. Rows are told apart by id and a 64-bit
    hash of the text, so rows that share an id but do not link all stay, as do empty and null texts. Of
    equal rows one stays. Very long texts are compared whole; an empty table stays empty."""
    sets, comps = set_components(spark, docs, percent)
    rows = sets.filter("e IS NOT NULL").groupBy("doc_id", "k", "e").agg(F.count("*").alias("copies"))
    named = rows.join(comps, rows.e == comps.node, "left").select("doc_id", "k", "copies", F.coalesce("comp", "e").alias("c"))
    named = settle(named, "named")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("lead")
    leads = named.groupBy("c").agg(lead).select("c", F.col("lead.doc_id").alias("lead_id"), F.col("lead.k").alias("lead_k"))
    stands = F.col("doc_id").eqNullSafe(F.col("lead_id")) & (F.col("k") == F.col("lead_k"))
    mine, of, goes = (spare(docs, x) for x in ("__id", "__k", "__goes"))
    judged = named.join(leads, "c").select(F.col("doc_id").alias(mine), F.col("k").alias(of), (~stands).alias(goes), "copies")
    judged = settle(judged.filter(F.col(goes) | (F.col("copies") > 1)).drop("copies"), "judged")
    discard(named, comps)
    key = docs.doc_id.eqNullSafe(F.col(mine)) & (F.xxhash64(docs.text) == F.col(of))
    kept = docs.join(judged.filter(F.col(goes)).hint("shuffle_hash"), key, "left_anti")
    repeated = judged.filter(~F.col(goes))
    if repeated.isEmpty():
        return kept
    again = repeated.select(mine, of).hint("shuffle_hash")
    once = kept.join(again, key, "left_semi").withColumn(of, F.xxhash64("text")).dropDuplicates(["doc_id", of]).drop(of)
    return kept.join(again, key, "left_anti").unionByName(once)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT r, array_to_string(w[s:s + 4], ' ') AS k
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
links AS (SELECT a.r AS x, b.r AS y FROM g a JOIN g b ON a.k = b.k AND a.r <> b.r JOIN n na ON na.r = a.r JOIN n nb ON nb.r = b.r
          GROUP BY a.r, b.r, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(e.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN reach ON reach.x = d.r JOIN d e ON e.r = reach.y GROUP BY d.r, d.doc_id, n.n
"""
