"""Best-fit packing of token sequences (operator 1).

Items larger than a third of the capacity go at most two to a sequence, matched
greedily from the largest down with the largest partner that fits; smaller items
go, largest first, into the fullest sequence that still has room (best fit).

Only the number of items of each length matters to that algorithm, so it runs
over a histogram with at most ``capacity`` entries, whatever the number of
items, and yields *patterns*: a list of lengths and how many sequences look like
it. Items then find their place by their rank among the items of their length,
which is counted in salted groups: no length, however common, meets in one task.
"""

from __future__ import annotations

import bisect
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.llm.runtime import returning

#: Chunks whose ids a worker keeps; the cache is emptied when it is full.
CACHED_CHUNKS = 400_000
ITEMS_PER_SALT = 10_000


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(sequences, [(length, items of it in each), ...]), ...] holding exactly counts.

    Every step uses up one length or one group of equal gaps, so there are at
    most about 3 * capacity patterns.
    """
    left = {s: c for s, c in counts.items() if c > 0}
    done: list[tuple[int, list[tuple[int, int]]]] = []
    third = capacity / 3
    large = sorted(s for s in left if s > third)
    open_at: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps: list[int] = []

    def put(gap: int, n: int, items: list[tuple[int, int]]) -> None:
        if n <= 0:
            return
        if gap == 0:
            done.append((n, items))
            return
        if gap not in open_at:
            open_at[gap] = []
            bisect.insort(gaps, gap)
        open_at[gap].append((n, items))

    while large:
        s = large[-1]
        if not left[s]:
            large.pop()
            continue
        k = bisect.bisect_right(large, capacity - s)
        while k and not left[large[k - 1]]:
            del large[k - 1]
            k -= 1
        t = large[k - 1] if k else None
        if t == s:
            pairs = left[s] // 2
            put(capacity - 2 * s, pairs, [(s, 2)])
            left[s] -= 2 * pairs
            if left[s]:
                large.pop()
                below = [x for x in large if left[x]]
                t = below[-1] if below else None
                if t is not None:
                    put(capacity - s - t, 1, [(s, 1), (t, 1)])
                    left[t] -= 1
                else:
                    put(capacity - s, 1, [(s, 1)])
                left[s] = 0
            continue
        if t is None:
            put(capacity - s, left[s], [(s, 1)])
            left[s] = 0
        else:
            pairs = min(left[s], left[t])
            put(capacity - s - t, pairs, [(s, 1), (t, 1)])
            left[s] -= pairs
            left[t] -= pairs

    for s in sorted((s for s in left if s <= third), reverse=True):
        n = left[s]
        while n:
            k = bisect.bisect_left(gaps, s)
            if k == len(gaps):
                each = capacity // s
                put(capacity - each * s, n // each, [(s, each)])
                if n % each:
                    put(capacity - n % each * s, 1, [(s, n % each)])
                break
            gap = gaps[k]
            m, items = open_at[gap].pop()
            if not open_at[gap]:
                del open_at[gap], gaps[k]
            each = gap // s
            full = min(m, n // each)
            put(gap - each * s, full, [*items, (s, each)])
            n -= full * each
            rest = m - full
            if rest and n and n < each:
                put(gap - n * s, 1, [*items, (s, n)])
                rest, n = rest - 1, 0
            put(gap, rest, items)
    for gap in gaps:
        done += open_at[gap]
    return done


def pack_best_fit(items: DataFrame, length: str, capacity: int, order: list[str]) -> DataFrame:
    """Adds sequence_id and offset (long) to items, whose ``length`` is 1 to capacity.

    items: read several times, so it should be a written table. order: columns
    that tell items apart; rows equal in all of them are interchangeable. An
    empty table gives an empty result. A length outside 1..capacity, or null,
    raises. Columns of items may have any names; those called sequence_id and
    offset are replaced.
    """
    spark = items.sparkSession
    n = F.col("_length")
    rows = items.select(F.struct(*[F.col(c) for c in items.columns if c not in ("sequence_id", "offset")]).alias("_row"), F.col(length).cast("int").alias("_length"), F.struct(*order).alias("_order"))
    # At most `capacity` rows, unless lengths are wrong.
    wrong = rows.filter(n.isNull() | (n < 1) | (n > capacity)).limit(1).count()
    if wrong:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    counts = {r[0]: r[1] for r in rows.groupBy("_length").count().collect()}
    salts = max(64, sum(counts.values()) // ITEMS_PER_SALT)
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_order"), F.lit(salts)))
    groups = rows.groupBy("_length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))

    places, first = [], 0
    used: dict[int, int] = {}
    for sequences, pattern in plan_patterns(counts, capacity):
        at = 0
        for size, each in pattern:
            places.append((size, used.get(size, 0), used.get(size, 0) + sequences * each, each, first, at))
            used[size] = used.get(size, 0) + sequences * each
            at += size * each
        first += sequences
    # The places are a few for each length (see plan_patterns): a proven bound.
    places_df = spark.createDataFrame(places, "_p_length int, _from long, _to long, _each int, _first long, _at long")

    within = Window.partitionBy("_length", "_salt").orderBy("_order")
    ranked = rows.withColumn("_in", F.row_number().over(within) - 1).join(groups, ["_length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_in"))
    placed = ranked.join(F.broadcast(places_df), (n == F.col("_p_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    nth = F.col("_rank") - F.col("_from")
    return placed.select(
        "_row.*", (F.col("_first") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_at") + F.pmod(nth, F.col("_each")) * n).cast("long").alias("offset"),
    )


class ChunkEncoder:
    """Ids of whole texts under a byte-level BPE, by way of a cache of chunks.

    No token of this vocabulary's pre-tokenizer crosses from a non-space to a
    following space, so a text can be cut before each single space. Where white
    space stands before a space, that is left to the tokenizer as a whole text.
    added_tokens: so is a text that contains an added token, which then has its own id.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        import json
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        with open(path, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f)["added_tokens"]] if added_tokens else []
        self.double = re.compile("[\\s\u180e\u200b\ufeff] ")
        self.fast = self._fast_encoder(path)
        encode, size = self.encode_bytes, CACHED_CHUNKS

        class Cache(dict):
            def __missing__(self, piece):
                if len(self) >= size:
                    self.clear()
                ids = self[piece] = encode(" " + piece)
                return ids

        self.cache = Cache()

    @staticmethod
    def _fast_encoder(path: str):
        """The same vocabulary and merges in tiktoken, which is faster on short texts.

        Built from the tokenizer file itself; used for plain Latin text only,
        where both libraries' character classes agree.
        """
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, added = model["model"]["vocab"], {t["content"] for t in model["added_tokens"]}
        # The byte alphabet of byte-level BPE: printable bytes stand for themselves, others for 256 and up.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {chr(b): b for b in plain}
        chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(chars[c] for c in token): i for token, i in vocab.items() if token not in added}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_bytes(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if text.isascii() or max(text) < "ɐ":
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.double.search(text):
            return self.encode_bytes(text)
        head, *rest = text.split(" ")
        cache = self.cache
        return (self.encode_bytes(head) if head else b"") + b"".join([cache[x] for x in rest])


def encoder(path: str, added_tokens: bool = False) -> ChunkEncoder:
    """One for each worker process, kept between tasks."""
    kept = sys.__dict__.setdefault("_timeloom_encoders", {})
    if (path, added_tokens) not in kept:
        kept[path, added_tokens] = ChunkEncoder(path, added_tokens)
    return kept[path, added_tokens]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0, added_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit).

    A document is the ids of its text (null: empty) and end_id. One that is
    longer than capacity is cut into pieces of that length; the first takes what
    is over. added_tokens: the tokenizer's added tokens have their own ids where
    they stand in a text; otherwise they are ordinary text. tokenizer_path: a file
    that every executor has.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer_path, added_tokens), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            out, held = ([], [], [], [], []), 0
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                doc = doc.as_py()
                ids = ids_of(text.as_py() or "") + end
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n - at) % capacity or capacity
                    for column, x in zip(out, (doc, piece, at, size, ids[4 * at : 4 * (at + size)]), strict=True):
                        column.append(x)
                    at, piece = at + size, piece + 1
                held += len(ids)
                if held > 4 << 20:
                    yield table(out)
                    out, held = ([], [], [], [], []), 0
            yield table(out)

    def table(out) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(returning(cut), "doc_id long, piece int, start long, length long, ids binary")


