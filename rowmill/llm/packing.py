"""Best-fit-decreasing packing of documents into sequences of a fixed number of tokens.

A document is its token ids and one id that ends it. One longer than a sequence is cut into full pieces;
its first piece takes what is left over. Packing is global, not per partition, and nothing but 2048 counts
leaves the executors:

1. Pieces are made and written once. Each knows its task and how many pieces of its length that task made
   before it, so (length, task, number) names it for good.
2. The counts by length go to the driver: as many numbers as a sequence has tokens.
3. `best_fit` packs them in decreasing order. A segment tree over remaining capacities finds the tightest
   open bin in logarithmic time; pieces of one length and bins of one capacity are interchangeable, so a
   run of equal placements is one step. The steps place all pieces exactly as one by one would.
4. Offsets of the tasks turn the number of a piece into its rank within its length, and the step that
   holds this rank gives its sequence and place. No group is ever gathered, hot lengths included.

Ids are those of the byte-level vocabulary byte_bpe_50k; its rank file is read with tiktoken, which gives
the ids of the `tokenizers` file (tested) in a quarter of the time. Strings of special tokens in a text are
ordinary text.

Defined cases: NULL text is empty and has one token, the ending id; equal rows are packed each on their
own; an empty table has no sequences; only id and text columns are read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.plans.storage import materialise

SEQUENCE_TOKENS = 2048
END_ID = 0

PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(vocabulary: str):
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n % size or min(n, size)
    return [(0, first), *[(s, size) for s in range(first, n, size)]]


def tokenised(
    docs: DataFrame, doc_id: str, text: str, size: int, vocabulary: str, with_ids: bool
) -> DataFrame:
    """One row per piece, and its token ids if asked for."""
    columns = PIECE + (", ids array<int>" if with_ids else "")
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), *T._parse_datatype_string(columns).fields])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary).encode_to_numpy
        part = TaskContext.get().partitionId()
        made = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            rows, out, ids = [], [], []
            for row, value in enumerate(batch.column(1)):
                tokens = encode(value.as_py() or "", disallowed_special=())
                tokens = np.append(tokens, END_ID).astype("<u4")
                for k, (start, length) in enumerate(cuts(len(tokens), size)):
                    piece = tokens[start : start + length]
                    rows.append(row)
                    out.append((k, start, length, zlib.crc32(piece.tobytes()), part, made[length]))
                    made[length] += 1
                    if with_ids:
                        ids.append(piece.astype(np.int32))
            values = np.array(out, dtype=np.int64).reshape(-1, 6).T
            arrays = [batch.column(0).take(pa.array(rows, pa.int64()))]
            arrays += [pa.array(v.astype(np.int32) if k in (0, 4) else v) for k, v in enumerate(values)]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(pieces, schema)


class CapacityTree:
    """Numbers of open bins by remaining capacity, in a segment tree of sums."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, capacity: int, bins: int) -> None:
        node = capacity + self.leaves
        while node:
            self.sums[node] += bins
            node //= 2

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least length that has a bin."""
        node = length + self.leaves
        if not self.sums[node]:
            # Up to the first right neighbour with bins, then down to its leftmost leaf with bins.
            while node > 1 and (node % 2 or not self.sums[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.sums[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(counts: dict[int, int], size: int) -> np.ndarray:
    """Steps (length, first rank, pieces, first bin, pieces per bin, place in the bin), by length and rank.

    After a piece, its bin is the tightest for the next piece of the same length while it has room, so a
    bin of capacity c takes c // length of them in a row.
    """
    tree, groups, steps, opened = CapacityTree(size), [[] for _ in range(size + 1)], [], 0

    def keep(capacity: int, first: int, bins: int) -> None:
        if capacity and bins:
            tree.add(capacity, bins)
            groups[capacity].append((first, bins))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = size
                first, bins = opened, -(-left // (size // length))
                opened += bins
            else:
                first, bins = groups[capacity].pop()
                tree.add(capacity, -bins)
            each = capacity // length
            full = min(bins, left // each)
            if full:
                steps.append((length, rank, full * each, first, each, size - capacity))
                keep(capacity - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            first, bins = first + full, bins - full
            if left and bins:
                steps.append((length, rank, left, first, left, size - capacity))
                keep(capacity - left * length, first, 1)
                first, bins, left = first + 1, bins - 1, 0
            keep(capacity, first, bins)
    return np.array(sorted(steps), dtype=np.int64).reshape(-1, 6)


def placed(pieces: DataFrame, size: int) -> DataFrame:
    """Written pieces with sequence_id and offset."""
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = best_fit(totals, size)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("earlier"))
    ranked = ranked.drop("earlier", "nth", "part")
    names = [c for c in ranked.columns if c != "rank"]
    schema = T.StructType(
        [*[ranked.schema[c] for c in names], *T._parse_datatype_string("sequence_id bigint, offset bigint").fields]
    )
    # Lengths and ranks in one number, so that one search finds a piece's step.
    begins = (steps[:, 0] << 48) + steps[:, 1]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            step = steps[np.searchsorted(begins, (length << 48) + rank, side="right") - 1]
            nth = rank - step[:, 1]
            sequence = step[:, 3] + nth // step[:, 4]
            offset = step[:, 5] + nth % step[:, 4] * length
            own = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(look_up, schema)


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE_TOKENS,
    vocabulary: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked."""
    made = tokenised(docs, doc_id, text, size, vocabulary or default_vocabulary(), with_ids)
    return placed(materialise(made), size)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from pack(..., with_ids=True); a sequence bounds each group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
