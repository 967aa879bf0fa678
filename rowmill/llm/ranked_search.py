"""Ranked lexical search by the Best Position Algorithm over impact lists.

Every item is a bag of terms; a document's score is the sum over the item's terms, repeats included, of
weight * ((1000000000 * tf) div (1000 * tf + 8 * m)), where weight = floor(1000 * ln((2N + 2) / (2df + 1)))
and m = 25 + ((75 * n * N) div L). N counts the documents with terms, L their terms, n those of one document.

1. One scan of the documents writes, per document, its number of terms and the counts of those terms that
   items ask for. N, L and the document frequencies are sums over that table; no text is read again.
2. A task reads the table in chunks of at most CHUNK_DOCS documents. A chunk's entries, sorted by impact
   within each term, are its impact lists; sorted by document they give direct access from a document to
   its impacts and to its positions in all lists.
3. Per item and chunk, each list is accessed directly at its first positions not seen yet. A document met
   there is scored at once through direct access, which marks its positions in all lists of the item. The
   best position of a list is the end of its run of seen positions from the top; no document that was not
   met can score more than the sum of the impacts at the best positions (0 for a list seen whole). An item
   stops when that sum lies strictly below its kth score, so that equal scores are never lost. The kth score
   of a task's earlier chunks counts as well.
4. The few rows that chunks return are ranked per item.

Items are taken in blocks of bounded size, one pass over the documents each, so neither the driver nor a
task holds more than one block's terms; the frequencies of a block's terms are as many numbers.

Defined cases: NULL texts and texts without terms are in no list and not counted in N; items without terms
have no rows; rows of one doc_id, and items of one item_id, are ranked each on their own; equal scores go by
ascending doc_id, a NULL id last; documents that score 0 are not returned; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.plans.storage import materialise

TOP = 10
CHUNK_DOCS, CHUNK_ENTRIES = 1 << 14, 1 << 22
BLOCK_ITEMS, BLOCK_TERMS = 1 << 14, 1 << 18
# Positions read from a list in the first round of direct accesses, and at most in a later one.
STEP, LONGEST_STEP = 16, 2048

# ASCII letters (lower-cased), digits and all bytes of characters that are not ASCII are kept.
TO_TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode(errors="surrogatepass").translate(TO_TERMS).split()


@dataclass(frozen=True)
class Block:
    """Items by number: their term numbers and how often each is asked for."""

    known: dict[bytes, int]
    asked: list[tuple[np.ndarray, np.ndarray]]


def blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, Block]]:
    """Blocks of items with terms, and their ids."""
    ids, known, asked = [], {}, []
    for row in items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).toLocalIterator():
        bag = Counter(terms(row.text))
        if not bag:
            continue
        if ids and (len(ids) >= BLOCK_ITEMS or len(known) + len(bag) > BLOCK_TERMS):
            yield ids, Block(known, asked)
            ids, known, asked = [], {}, []
        numbers = [known.setdefault(t, len(known)) for t in bag]
        ids.append(row.item_id)
        asked.append((np.array(numbers, dtype=np.int64), np.array(list(bag.values()), dtype=np.int64)))
    if ids:
        yield ids, Block(known, asked)


def postings(docs: DataFrame, doc_id: str, text: str, block: Block) -> DataFrame:
    """doc_id, n and the numbers and counts of the terms asked for, of documents with terms."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    added = T._parse_datatype_string("n bigint, terms array<int>, tfs array<int>").fields
    schema = T.StructType([rows.schema["doc_id"], *added])
    shared = docs.sparkSession.sparkContext.broadcast(block.known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            kept, sizes, ends, found, tfs = [], [], [0], [], []
            for row, value in enumerate(batch.column(1)):
                own = terms(value.as_py())
                if not own:
                    continue
                kept.append(row)
                sizes.append(len(own))
                bag = Counter(map(number, own))
                bag.pop(None, None)
                found.extend(bag.keys())
                tfs.extend(bag.values())
                ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (found, tfs)]
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), *lists], names=schema.names)

    return rows.mapInArrow(scan, schema)


def frequencies(written: DataFrame, size: int) -> np.ndarray:
    """The number of documents that hold each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    parts = written.select("terms").mapInArrow(count, "term bigint, df bigint")
    out = np.zeros(size, dtype=np.int64)
    for row in parts.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row.term] = row.df
    return out


@dataclass(frozen=True)
class Corpus:
    """What the scores of all documents depend on: document and term totals, weights by term number."""

    n: int
    length: int
    weights: np.ndarray

    def impacts(self, sizes: np.ndarray, owner: np.ndarray, numbers: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        # Python numbers, as 75 * n * N can pass 64 bits.
        distinct, at = np.unique(sizes, return_inverse=True)
        m = np.array([25 + 75 * int(s) * self.n // self.length for s in distinct], dtype=np.int64)[at]
        return self.weights[numbers] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[owner]))


class Chunk:
    """Impact lists of some documents, and direct access from documents to impacts and positions."""

    def __init__(self, corpus: Corpus, sizes: np.ndarray, lengths: np.ndarray, numbers: np.ndarray, tfs: np.ndarray):
        self.docs, self.lengths = len(sizes), lengths
        self.begins = np.cumsum(lengths) - lengths
        self.terms = numbers
        owner = np.repeat(np.arange(self.docs), lengths)
        self.impacts = corpus.impacts(sizes, owner, numbers, tfs)
        order = np.lexsort((owner, -self.impacts, numbers))
        self.list_docs, self.list_impacts = owner[order], self.impacts[order]
        counts = np.bincount(numbers, minlength=len(corpus.weights))
        self.list_lengths, self.list_begins = counts, np.cumsum(counts) - counts
        self.positions = np.empty(len(order), dtype=np.int64)
        self.positions[order] = np.arange(len(order)) - self.list_begins[numbers[order]]

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of some documents, and where each document's begin among them."""
        lengths = self.lengths[docs]
        starts = np.cumsum(lengths) - lengths
        return np.repeat(self.begins[docs] - starts, lengths) + np.arange(lengths.sum()), starts

    def best(self, numbers: np.ndarray, times: np.ndarray, k: int, floor: int, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents of an item that score at least `floor`, and their scores, best first.

        `slots` maps every term number to -1; it is returned so.
        """
        held = self.list_lengths[numbers] > 0
        numbers, times = numbers[held], times[held]
        size, begin = self.list_lengths[numbers], self.list_begins[numbers]
        offset = np.cumsum(size) - size
        slots[numbers] = np.arange(len(numbers))
        seen = np.zeros(int(size.sum()), dtype=bool)
        best = np.zeros(len(numbers), dtype=np.int64)
        scored = np.zeros(self.docs, dtype=bool)
        docs, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        step = STEP
        while (best < size).any():
            met = []
            for t in np.flatnonzero(best < size):
                low = best[t]
                high = min(low + step, size[t])
                fresh = ~seen[offset[t] + low : offset[t] + high]
                met.append(self.list_docs[begin[t] + low : begin[t] + high][fresh])
            found = np.unique(np.concatenate(met))
            found = found[~scored[found]]
            scored[found] = True
            entries, starts = self.entries(found)
            slot = slots[self.terms[entries]]
            asked = slot >= 0
            gain = np.where(asked, self.impacts[entries] * times[slot], 0)
            seen[offset[slot[asked]] + self.positions[entries[asked]]] = True
            total = np.add.reduceat(gain, starts) if len(found) else gain
            docs, scores = np.concatenate([docs, found]), np.concatenate([scores, total])
            if len(scores) >= k:
                floor = max(floor, int(np.partition(scores, -k)[-k]))
            near = scores >= floor
            docs, scores = docs[near], scores[near]
            for t in np.flatnonzero(best < size):
                run = seen[offset[t] + best[t] : offset[t] + size[t]]
                best[t] = size[t] if run.all() else best[t] + run.argmin()
            open_ = np.flatnonzero(best < size)
            last = self.list_impacts[begin[open_] + np.maximum(best[open_] - 1, 0)]
            if (last * times[open_]).sum() < floor:
                break
            step = min(2 * step, LONGEST_STEP)
        slots[numbers] = -1
        order = np.lexsort((docs, -scores))
        order = order[scores[order] > 0][:k]
        return docs[order], scores[order]


def searched(written: DataFrame, block: Block, corpus: Corpus, k: int) -> DataFrame:
    """(item number, doc_id, score): the best rows of every chunk."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), written.schema["doc_id"], T.StructField("score", T.LongType())])
    shared = written.sparkSession.sparkContext.broadcast((block.asked, corpus))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, corpus = shared.value
        slots = np.full(len(corpus.weights), -1, dtype=np.int64)
        tops = np.zeros((len(asked), k), dtype=np.int64)  # the best scores so far, lowest first
        for table in chunks(batches):
            # In the order of ids, so that ties of scores go by row number.
            table = table.take(pc.sort_indices(table["doc_id"], null_placement="at_end")).combine_chunks()
            lists = [table[c].combine_chunks() for c in ("terms", "tfs")]
            lengths = np.diff(lists[0].offsets.to_numpy())
            numbers, tfs = (v.flatten().to_numpy().astype(np.int64) for v in lists)
            chunk = Chunk(corpus, table["n"].to_numpy(), lengths.astype(np.int64), numbers, tfs)
            rows, items, scores = [], [], []
            for item, (own, times) in enumerate(asked):
                docs, found = chunk.best(own, times, k, int(tops[item, 0]), slots)
                tops[item] = np.sort(np.concatenate([tops[item], found]))[-k:]
                rows.append(docs)
                items.append(np.full(len(docs), item, dtype=np.int32))
                scores.append(found)
            ids = table["doc_id"].combine_chunks().take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(items)), ids, pa.array(np.concatenate(scores))], names=schema.names
            )

    return written.mapInArrow(search, schema)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Documents in chunks of bounded numbers of rows and entries."""
    held, rows, entries = [], 0, 0
    for batch in batches:
        for at in range(0, len(batch), 1024):
            part = batch.slice(at, 1024)
            more = len(part.column(2).flatten())
            if held and (rows + len(part) > CHUNK_DOCS or entries + more > CHUNK_ENTRIES):
                yield pa.Table.from_batches(held)
                held, rows, entries = [], 0, 0
            held.append(part)
            rows, entries = rows + len(part), entries + more
    if held:
        yield pa.Table.from_batches(held)


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", k: int = TOP,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    of_item = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema[item_id].dataType)])
    out = None
    for ids, block in blocks(items, item_id, item_text):
        written = materialise(postings(docs, doc_id, text, block))
        n, length = written.agg(F.count("*"), F.sum("n")).first()
        held = frequencies(written, len(block.known))
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in held]
        corpus = Corpus(n, length or 1, np.array(weights, dtype=np.int64))
        best = searched(written, block, corpus, k)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), of_item))
        found = ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.union(found)
    if out is None:
        kinds = [of_item["item_id"], T.StructField("rank", T.IntegerType())]
        kinds += [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.LongType())]
        out = spark.createDataFrame([], T.StructType(kinds))
    return out
