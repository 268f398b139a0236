"""Jaccard join of word shingle sets with signature trees (operator 10).

A text's set is its distinct five-word shingles, as 64-bit hashes. Equal sets
are one class. Two sets that reach the threshold have several of their smallest
hashes in common (prefix filtering with a longer prefix), so each set may leave
out some of these hashes, and leaves out those that most sets have: a passage
that many texts share joins none of them by itself. Classes that share a hash
left in form a block; every block is searched by a signature tree of its own. The
leaves are sets, as a bitmap of their hashes and their size; a node holds the OR of its
bitmaps and the range of its sizes. A dual traversal starts at the pair (root,
root) and goes down only into pairs of nodes whose largest possible overlap
reaches what the threshold asks for.

Blocks of the smallest hash come first, with texts, and give links at once; a
block returns a spanning forest. What these links connect needs no more
comparison, so the exact search over all shared prefix hashes goes only through
blocks where several components still meet. Blocks are dealt in parts of bounded
size, and pairs of parts, so that no hash makes a large task; parts of a block's
largest component don't meet one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.llm import textops
from timeloom.llm.components import connected_components
from timeloom.llm.runtime import Scratch, returning

SHINGLE = 5
PERCENT = 80
BITS = 1024
FANOUT = 4
PART = 256
PART_BYTES = 8 << 20
#: A pair is left to the block that it met in before, if this is among so many before the present one for both.
EARLIER = 8
#: One hash in so many may be left out of a set's prefix.
SPARE = 10


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, borders, hashes): the sorted distinct hashes of each row's set."""
    for block in textops.word_blocks(column, fold=True):
        sizes = np.diff(block.bounds)
        counts = np.where(sizes >= k, sizes - k + 1, (sizes > 0).astype(np.int64))
        borders = np.concatenate(([0], np.cumsum(counts)))
        hashes = np.empty(borders[-1], np.uint64)
        long_row = np.repeat(sizes >= k, counts)
        whole = textops.whole_windows(block.bounds, k, len(block.hashes))
        hashes[long_row] = textops.window_hashes(block.hashes, k)[whole]
        short = np.flatnonzero((sizes > 0) & (sizes < k))
        hashes[borders[short]] = textops.range_hashes(block.hashes, block.bounds[short], block.bounds[short + 1])
        for lo, hi in zip(borders[:-1], borders[1:], strict=True):
            hashes[lo:hi].sort()
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        new[borders[:-1][counts > 0]] = True
        kept = np.concatenate(([0], np.cumsum(new)))[borders]
        yield block.first_row, kept, hashes[new]


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[borders[1:]] - total[borders[:-1]]


def _least_shared(n: np.ndarray, percent: int) -> np.ndarray:
    """The fewest hashes that a set of n shares with one that it is linked to; also the smallest size of that one."""
    return -((-percent * n) // 100)


def spare_hashes(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """By how many hashes the prefix of a set of n is longer than one shared hash needs."""
    return np.maximum(np.minimum(n // SPARE, _least_shared(n, percent) - 1), 0)


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Prefixes of this length of two linked sets share more hashes than the spare ones of either.

    Say that the prefix of the set of n ends first. At most n - prefix_length(n) shared hashes lie
    behind its end, so at least _least_shared(n) - n + prefix_length(n) = spare_hashes(n) + 1 are in both prefixes.
    """
    return np.where(n > 0, n + 1 - _least_shared(n, percent) + spare_hashes(n, percent), 0)


def set_table(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, bits: int = BITS) -> DataFrame:
    """doc_id, n, hi, lo (a 128-bit name of the set), prefix (its smallest hashes), spare (how many of them it may leave out), bitmap, fine (a bitmap of two bits and more per hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, borders, hashes in shingle_sets(batch.column(1), k):
                n = np.diff(borders)
                size = prefix_length(n, percent)
                rows = np.repeat(np.arange(len(n)), n)
                within = np.arange(len(hashes)) - borders[rows]
                prefix = hashes[within < size[rows]]
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                maps = np.zeros((len(n), bits), bool)
                maps[rows, (hashes & np.uint64(bits - 1)).astype(np.int64)] = True
                packed = np.packbits(maps, axis=1)
                fine = [_fine_bitmap(hashes[lo:hi]) for lo, hi in zip(borders[:-1], borders[1:], strict=True)]
                names = [textops.signed(_sums(textops.mix(hashes ^ np.uint64(salt)), borders)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                yield pa.record_batch(
                    [
                        batch.column(0)[first : first + len(n)], pa.array(n, pa.int64()), pa.array(names[0]), pa.array(names[1]),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(textops.signed(prefix))), pa.array(spare_hashes(_least_shared(n, percent), percent), pa.int64()), pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(fine, pa.binary()),
                    ],
                    names=["doc_id", "n", "hi", "lo", "prefix", "spare", "bitmap", "fine"],
                )

    return docs.mapInArrow(returning(run), "doc_id long, n long, hi long, lo long, prefix array<long>, spare long, bitmap binary, fine binary")


def _fine_bitmap(hashes: np.ndarray) -> bytes:
    """The high bits of each hash as a place among a power of two: neighbouring bits fold into one when that is halved."""
    bits = max(256, 1 << int(2 * len(hashes)).bit_length())
    out = np.zeros(bits, bool)
    out[(hashes >> np.uint64(65 - bits.bit_length())).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    return bits.reshape(size, -1).any(axis=1)


def may_reach(a: bytes, n_a: int, b: bytes, n_b: int, percent: int) -> bool:
    """Can two sets of these fine bitmaps and sizes reach percent of Jaccard similarity?"""
    x, y = (np.unpackbits(np.frombuffer(v, np.uint8)).view(bool) for v in (a, b))
    size = min(len(x), len(y))
    x, y = _folded(x, size), _folded(y, size)
    both = int((x & y).sum()) + min(n_a - int(x.sum()), n_b - int(y.sum()))
    return (100 + percent) * both >= percent * (n_a + n_b)


class SignatureForest:
    """A signature tree for each of many blocks, level by level side by side.

    Leaves are sets, ordered by size in their block; a node holds the OR of its
    bitmaps, its size range, the largest excess of size over bits and its
    component range. Blocks of two and of thousands go the same way: a small
    tree's root just stands on every level above its own height.
    """

    def __init__(self, blocks: np.ndarray, sizes: np.ndarray, bitmaps: np.ndarray, groups: np.ndarray):
        self.order = np.lexsort((groups, sizes, blocks))
        owner, s, b, g = (x[self.order] for x in (blocks, sizes, bitmaps, groups))
        self.levels = [(b, s, s, s - np.bitwise_count(b).sum(axis=1, dtype=np.int64), g, g)]
        self.children: list[tuple[np.ndarray, np.ndarray]] = []  # of each level above the leaves: first child and number of children
        while (owner[1:] == owner[:-1]).any():
            head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            within = np.arange(len(owner)) - np.repeat(head, np.diff(np.append(head, len(owner))))
            at = np.flatnonzero(within % FANOUT == 0)
            b, low, high, excess, glow, ghigh = self.levels[-1]
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at), np.minimum.reduceat(glow, at), np.maximum.reduceat(ghigh, at)))
            self.children.append((at, np.diff(np.append(at, len(owner)))))
            owner = owner[at]

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of sets of one block and different groups that may reach percent of Jaccard similarity."""
        if not self.children:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a = b = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            keep = self._may_reach(depth, a, b, percent)
            a, b = a[keep], b[keep]
            if not depth:
                break
            first, count = self.children[depth - 1]
            i, j = (v.ravel() for v in np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij"))
            x, y = first[a][:, None] + i, first[b][:, None] + j
            inside = (i < count[a][:, None]) & (j < count[b][:, None]) & ((x <= y) if depth > 1 else (x < y))
            a, b = x[inside], y[inside]
        return self.order[a], self.order[b]

    def _may_reach(self, depth: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        bitmap, low, high, excess, glow, ghigh = self.levels[depth]
        keep = np.empty(len(a), bool)
        for at in range(0, len(a), 1 << 15):
            x, y = a[at : at + (1 << 15)], b[at : at + (1 << 15)]
            near = percent * np.maximum(low[x], low[y]) <= 100 * np.minimum(high[x], high[y])
            near &= (glow[x] != glow[y]) | (ghigh[x] != ghigh[y]) | (glow[x] != ghigh[x])
            u, v = x[near], y[near]
            both = np.bitwise_count(bitmap[u] & bitmap[v]).sum(axis=1, dtype=np.int64) + np.minimum(excess[u], excess[v])
            both = np.minimum(both, np.minimum(high[u], high[v]))
            near[near] = (100 + percent) * both >= percent * (low[u] + low[v])
            keep[at : at + (1 << 15)] = near
        return keep


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Do two sorted arrays of distinct values reach percent of Jaccard similarity?"""
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)) or not len(a):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _bitmaps(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def link_blocks(blocks: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links inside each block of (block, part, doc_id, n, bitmap, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, heads in textops.whole_groups(batches, ["block", "part"]):
            ids, sizes = rows.column("doc_id").to_numpy(), rows.column("n").to_numpy()
            maps, texts = rows.column("bitmap").combine_chunks(), rows.column("text").combine_chunks()
            out = ([], [])
            owner = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
            a, b = SignatureForest(owner, sizes, _bitmaps(maps), ids).pairs(percent)
            by_block = np.argsort(owner[a], kind="stable")
            a, b = a[by_block], b[by_block]
            cuts = np.searchsorted(owner[a], np.unique(owner[a]))
            for lo, hi in zip(cuts, [*cuts[1:], len(a)], strict=False):
                need, at = np.unique(np.concatenate((a[lo:hi], b[lo:hi])), return_inverse=True)
                sets: list[np.ndarray] = []
                for _, borders, hashes in shingle_sets(texts.take(pa.array(need))):
                    sets += [hashes[i:j] for i, j in zip(borders[:-1], borders[1:], strict=True)]
                parent = np.arange(len(need))
                for i, j in at.reshape(2, -1).T.tolist():
                    x, y = _find(parent, i), _find(parent, j)
                    if x != y and similar(sets[i], sets[j], percent):
                        parent[max(x, y)] = min(x, y)
                        out[0].append(int(ids[need[i]]))
                        out[1].append(int(ids[need[j]]))
            if out[0]:
                yield pa.record_batch([pa.array(out[0]), pa.array(out[1])], names=["a", "b"])

    return blocks.mapInArrow(returning(run), "a long, b long")


def _met_before(earlier: pa.ListArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of rows: have their lists a value in common?"""
    starts = earlier.offsets.to_numpy()
    size, values = np.diff(starts), earlier.values.to_numpy()
    table = np.zeros((len(size), EARLIER), np.int64)
    filled = np.arange(EARLIER) < size[:, None]
    table[filled] = values[starts[0] : starts[-1]]
    out = np.zeros(len(a), bool)
    for k in range(0, len(a), 1 << 15):
        x, y = a[k : k + (1 << 15)], b[k : k + (1 << 15)]
        for i in range(EARLIER):
            out[k : k + (1 << 15)] |= ((table[x, i][:, None] == table[y]) & filled[x, i][:, None] & filled[y]).any(axis=1)
    return out


def candidate_blocks(blocks: DataFrame, percent: int) -> DataFrame:
    """(a, b) that may be linked, of different components, from (block, lo, hi, side, earlier, doc_id, component, n, bitmap).

    A pair that shares a block of ``earlier`` was found there, as what is asked of a pair doesn't depend on the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, heads in textops.whole_groups(batches, ["block", "lo", "hi"]):
            ids, groups, sizes, sides, lo_part, hi_part = (rows.column(c).to_numpy() for c in ("doc_id", "component", "n", "side", "lo", "hi"))
            maps = _bitmaps(rows.column("bitmap").combine_chunks())
            a, b = SignatureForest(np.repeat(np.arange(len(heads) - 1), np.diff(heads)), sizes, maps, groups).pairs(percent)
            keep = (groups[a] != groups[b]) & ((lo_part[a] == hi_part[a]) | (sides[a] != sides[b]))
            a, b = a[keep], b[keep]
            new = ~_met_before(rows.column("earlier").combine_chunks(), a, b)
            a, b = ids[a[new]], ids[b[new]]
            both = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1)
            if both.size:
                yield pa.record_batch([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    return blocks.mapInArrow(returning(run), "a long, b long")


def finer(pairs: DataFrame, percent: int) -> DataFrame:
    """Those of (a, b, fine_a, n_a, fine_b, n_b) that finer bitmaps leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n_a, b, n_b = (batch.column(i).to_pylist() for i in range(2, 6))
            keep = pa.array([may_reach(*x, percent) for x in zip(a, n_a, b, n_b, strict=True)], pa.bool_())
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return pairs.select("a", "b", "fine_a", "n_a", "fine_b", "n_b").mapInArrow(returning(run), "a long, b long")


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """The linked ones of (a, b, text_a, text_b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for i in (2, 3):
                own: list[np.ndarray] = []
                for _, borders, hashes in shingle_sets(batch.column(i)):
                    own += [hashes[x:y] for x, y in zip(borders[:-1], borders[1:], strict=True)]
                sets.append(own)
            keep = pa.array([similar(x, y, percent) for x, y in zip(*sets, strict=True)], pa.bool_())
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(returning(run), "a long, b long")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def jaccard_components(docs: DataFrame, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs.

    Texts link when their sets of lower-case five-word shingles have a Jaccard
    similarity of at least percent / 100; component_id is the smallest doc_id
    reachable by links. A text with fewer words has its whole sequence as one
    shingle; null and empty texts have none and link with nothing. A row without
    doc_id links with nothing. Equal rows share a component.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sets = scratch.save(set_table(docs, percent=percent), "sets")
    names = scratch.save(sets.select("doc_id", "n", "hi", "lo"), "names")
    linkable = names.filter("n > 0 and doc_id is not null")
    classes = scratch.save(linkable.groupBy("hi", "lo", "n").agg(F.min("doc_id").alias("leader")), "classes")
    leaders = sets.join(classes.select("hi", "lo", "n", F.col("leader").alias("doc_id")), ["hi", "lo", "n", "doc_id"])
    leaders = scratch.save(leaders.dropDuplicates(["doc_id"]).select("doc_id", "n", "prefix", "spare", "bitmap", "fine"), "leaders")
    scratch.drop("sets")

    # Prefix hashes of several classes; each class leaves out its most common ones, in one order for all.
    spread = leaders.select(F.explode("prefix").alias("block"), "doc_id")
    shared = scratch.save(spread.groupBy("block").agg(F.count("*").alias("members")).filter("members > 1"), "shared")
    own = spread.join(shared, "block").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("members", "block"))).alias("own"))
    kept = F.slice("own", 1, F.greatest(F.size("own") - F.col("spare"), F.lit(0)).cast("int"))["block"]
    rows = own.join(leaders.select("doc_id", "spare"), "doc_id").select("doc_id", F.explode(kept).alias("block"))
    rows = scratch.save(rows, "rows")
    scratch.drop("shared")

    # The smallest hash first, with texts; what a block of several parts links is searched again without the linked ones.
    parts_now = _partitions(docs)
    first = leaders.select("doc_id", "n", F.col("prefix")[0].alias("block"), "bitmap")
    common = scratch.save(first.groupBy("block").agg(F.count("*").alias("m")).filter("m > 1").select("block"), "common")
    roots = scratch.save(docs.join(first.join(common, "block"), "doc_id").dropDuplicates(["doc_id"]), "near")
    edges, again = None, None
    for step in range(4):
        counts = roots.groupBy("block").agg(F.count("*").alias("m"), F.sum(F.length("text")).alias("size")).filter("m > 1")
        counts = counts.withColumn("parts", F.greatest(F.ceil(F.col("m") / PART), F.ceil(F.col("size") / PART_BYTES)))
        counts = scratch.save(counts if again is None else counts.join(again, "block", "left_semi"), f"counts{step}")
        dealt = roots.join(counts, "block").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(step)), F.col("parts")))
        dealt = dealt.select("block", "part", "doc_id", "n", "bitmap", "text").repartition(parts_now, "block", "part").sortWithinPartitions("block", "part")
        found = scratch.save(link_blocks(dealt, percent), f"edges{step}")
        edges = found if edges is None else edges.unionByName(found)
        again = counts.filter("parts > 1").select("block")
        if not again.limit(1).count() or not found.limit(1).count():
            break
        roots = roots.join(found.select(F.greatest("a", "b").alias("doc_id")).distinct(), "doc_id", "left_anti")
    components = connected_components(edges, scratch, "early")

    # Every shared prefix hash, where several components still meet.
    known = leaders.select("doc_id", "n", "bitmap").join(components, F.col("doc_id") == F.col("node"), "left")
    known = known.select("doc_id", "n", "bitmap", F.coalesce("component", "doc_id").alias("component"))
    known = scratch.save(known, "known")
    open_rows = rows.join(known.select("doc_id", "component"), "doc_id")
    # The hashes of one shared passage make blocks of the same members: one of these blocks is searched, the others would find the same.
    members = [F.bit_xor(F.xxhash64("doc_id", F.lit(i))).alias(f"h{i}") for i in (1, 2)]
    meet = open_rows.groupBy("block", "component").agg(F.count("*").alias("k"), *members)
    meet = meet.groupBy("block").agg(F.sum("k").alias("members"), F.max(F.struct("k", "component")).alias("top"), F.count("*").alias("components"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    meet = meet.filter("components > 1").groupBy("members", "h1", "h2").agg(F.min("block").alias("block"), F.min("top").alias("top"))
    one = F.col("members") <= PART
    meet = meet.select("block", F.when(~one, F.col("top.component")).alias("top"), F.when(one, 1).otherwise(F.ceil((F.col("members") - F.col("top.k")) / PART)).cast("int").alias("others"), F.when(one, 0).otherwise(F.ceil(F.col("top.k") / PART)).cast("int").alias("tops"))
    meet = scratch.save(meet, "meet")
    # The parts of other components come first; a row of the largest one meets these, any other row meets all.
    in_top, deal = F.col("component").eqNullSafe(F.col("top")), F.xxhash64("doc_id", F.lit(1))
    before = Window.partitionBy("doc_id").orderBy("block").rowsBetween(-EARLIER, -1)
    dealt = open_rows.join(meet, "block").withColumn("earlier", F.collect_list("block").over(before))
    part = F.when(in_top, F.col("others") + F.pmod(deal, F.greatest("tops", F.lit(1)))).otherwise(F.pmod(deal, F.col("others"))).cast("int")
    dealt = dealt.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(in_top, F.col("others") - 1).otherwise(F.col("others") + F.col("tops") - 1))))
    dealt = dealt.select("block", "doc_id", "earlier", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), (F.col("part") > F.col("other")).cast("int").alias("side"))
    dealt = dealt.join(known, "doc_id").repartition(parts_now, "block", "lo", "hi").sortWithinPartitions("block", "lo", "hi")
    pairs = scratch.save(candidate_blocks(dealt, percent).distinct(), "pairs")
    fine = leaders.select("doc_id", "n", "fine")
    pairs = pairs.join(fine.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("fine").alias("fine_a")), "a").join(fine.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("fine").alias("fine_b")), "b")
    pairs = scratch.save(finer(pairs, percent), "finer")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = scratch.save(docs.join(ends, "doc_id", "left_semi").select("doc_id", "text").dropDuplicates(["doc_id"]), "texts")
    pairs = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    late = scratch.save(verified(pairs, percent), "late")
    if late.limit(1).count():
        components = connected_components(edges.unionByName(late), scratch, "all")

    answers = classes.join(components, F.col("leader") == F.col("node"), "left").select("hi", "lo", "n", F.coalesce("component", "leader").alias("component_id"))
    answers = scratch.save(answers, "answers")
    out = names.join(answers, ["hi", "lo", "n"], "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
