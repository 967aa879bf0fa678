"""Alignment of two tokenizers' tokens over whole texts, and corpus-wide counts of the token pairs that end together.

A text is encoded by a byte-level vocabulary (A, with a blank put before the text) and by a piece vocabulary
(B, which adds that blank itself). Both are lossless unless B normalises something, so their tokens cut the
same bytes; a text for which the joined bytes of either differ from blank + text is left out.

1. Ends of tokens are running sums of their lengths, over the texts of a slice of 256 kB. The shorter
   list of ends drives a galloping search in the longer one: doubling steps from where a run of shared ends would
   go on behind the last place found, then bisection, so a slice costs as many steps as its shorter list has ends,
   times the logarithm of the gaps. The search runs on arrays: the first ends of all blocks are placed (in the same
   way), then all other ends at once.
2. Common ends slice both token lists into groups; the ranks of two successive common ends give the range
   of tokens of each group. The two tokens at a common end are linked.
3. Of two tokens that end together the shorter is a suffix of the longer. So the pairs that can occur at all
   are known from the vocabularies alone: at most one for every suffix of a token, about half a million. They
   are numbered once, and a link is one number of that list.
4. One pass writes, per document, its figures and its links as such numbers. Counts of the numbers are summed
   in tasks, then over tasks; that table, bounded by the vocabularies and not by the corpus, is broadcast back
   over the written links.

Defined cases: NULL and empty texts, and texts whose bytes differ, have no tokens and figures of zero; the
strings of special tokens in a text are plain text; equal rows count each; a link counts once however long its
tokens; an empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.packing import default_vocabulary, encoding
from rowmill.plans.storage import materialise

FIGURES = "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, groups array<struct<a:array<int>,b:array<int>>>, links array<int>"
BLANK = "▁"  # how pieces write a blank
BLOCK = 8  # ends that gallop from one place found before
SLICE_BYTES = 1 << 18  # of text whose ids are held at once, beside one text of any length


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabularies:
    """Two encoders, the bytes of their tokens, and the numbered pairs of tokens that can end together."""

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.a, self.b = encoding(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a_bytes = [self.a.decode_single_token_bytes(k) for k in range(self.a.max_token_value + 1)]
        # A control piece never comes from a text and has no bytes of its own.
        self.b_bytes = [
            b"" if self.b.is_control(k) else bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace(BLANK, " ").encode()
            for k, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))
        ]
        self.sizes = [np.array(list(map(len, v)), dtype=np.int64) for v in (self.a_bytes, self.b_bytes)]
        self.joined = [(np.frombuffer(b"".join(v), dtype=np.uint8), s.cumsum() - s) for v, s in zip((self.a_bytes, self.b_bytes), self.sizes)]
        marks = (self.a_bytes, ","), (self.a_bytes, "|"), (self.b_bytes, ","), (self.b_bytes, ";")
        self.texts = np.array([f"{k}{mark}" for tokens, mark in marks for k in range(len(tokens))], dtype="S8")
        self.pairs = self.possible()
        self.firsts = np.split(np.concatenate(self.sizes).cumsum() - np.concatenate(self.sizes), [len(self.a_bytes)])
        self.of_suffix = np.zeros(sum(map(np.sum, self.sizes)), dtype=np.int32)
        self.of_suffix[self.suffix(*divmod(self.pairs, len(self.b_bytes)))] = np.arange(len(self.pairs))

    def possible(self) -> np.ndarray:
        """All (A id, B id) of which one token is a suffix of the other, as sorted numbers a * |B| + b.

        Every one belongs to a suffix of the longer token, so there are no more than the tokens have bytes.
        """
        def ends(tokens: list[bytes]) -> dict[bytes, list[int]]:
            out: dict[bytes, list[int]] = {}
            for k, t in enumerate(tokens):
                if t:
                    out.setdefault(t, []).append(k)
            return out

        of_a, of_b, width = ends(self.a_bytes), ends(self.b_bytes), len(self.b_bytes)
        found = set()
        for t, owners in of_a.items():
            for at in range(len(t)):
                found.update(x * width + y for y in of_b.get(t[at:], ()) for x in owners)
        for t, owners in of_b.items():
            for at in range(1, len(t)):
                found.update(x * width + y for x in of_a.get(t[at:], ()) for y in owners)
        return np.array(sorted(found), dtype=np.int64)

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both, or none where the joined bytes of either are not blank + text."""
        none = np.empty(0, dtype=np.int64)
        if not text:
            return none, none
        try:
            whole = (" " + text).encode()
        except UnicodeEncodeError:
            return none, none
        a = np.array(self.a.encode_ordinary(" " + text), dtype=np.int64)
        b = self.b.encode_as_numpy(text).astype(np.int64)
        return (a, b) if self.bytes_of(0, a) == whole == self.bytes_of(1, b) else (none, none)

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """ids() as lists."""
        a, b = self.ids(text)
        return a.tolist(), b.tolist()

    def bytes_of(self, side: int, ids: np.ndarray) -> bytes:
        """The joined bytes of tokens of A (side 0) or B (side 1)."""
        stored, starts = self.joined[side]
        sizes = self.sizes[side][ids]
        at = np.repeat(starts[ids] - sizes.cumsum() + sizes, sizes)
        at += np.arange(len(at))
        return stored[at].tobytes()

    def written(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The groups `a1,a2|b1;a3|b2,b3;`, as one text for every id with the mark that follows it.

        Ids of B lie behind all ids of A up to their group's end.
        """
        out = np.empty(len(a) + len(b), dtype=np.int64)
        a, b = a.copy(), b + 2 * len(self.a_bytes)
        a[i] += len(self.a_bytes)
        b[j] += len(self.b_bytes)
        before = np.concatenate([[0], j + 1])[: len(i)]
        out[np.arange(len(a)) + np.repeat(before, np.diff(i, prepend=-1))] = a
        out[np.arange(len(b)) + np.repeat(i + 1, np.diff(j, prepend=-1))] = b
        return self.texts[out]

    def suffix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The places, among all suffixes of all tokens, of the shorter token in the longer one of each pair."""
        x, y = self.sizes[0][a], self.sizes[1][b]
        return np.where(x >= y, self.firsts[0][a] + y, self.firsts[1][b] + x) - 1

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of linked pairs."""
        wanted, out = a * len(self.b_bytes) + b, self.of_suffix[self.suffix(a, b)]
        # Tokens of the same bytes, as a byte piece and its character, share their suffixes.
        others = np.flatnonzero(self.pairs[out] != wanted)
        out[others] = np.searchsorted(self.pairs, wanted[others])
        return out


def digest(written: np.ndarray) -> str:
    """SHA-256 of a document's written groups, without the mark behind the last; empty without tokens."""
    return hashlib.sha256(written.tobytes().translate(None, b"\0")[:-1]).hexdigest() if len(written) else ""


@lru_cache(maxsize=1)
def vocabularies(a: str, b: str) -> Vocabularies:
    return Vocabularies(a, b)


def gallop(keys: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many of the sorted values are below each key, by doubling steps from a start of its own, then bisection."""
    low, high = start.copy(), start.copy()
    # Back: all from `high` on is known not to be below the key.
    step, open_ = 1, np.flatnonzero(low > 0)
    while len(open_ := open_[values[low[open_] - 1] >= keys[open_]]):
        high[open_] = low[open_] - 1
        low[open_] = np.maximum(low[open_] - step, 0)
        step, open_ = 2 * step, open_[low[open_] > 0]
    # Forth: all before `low` is known to be below the key.
    step, open_ = 1, np.flatnonzero((low == high) & (high < len(values)))
    while len(open_ := open_[values[high[open_]] < keys[open_]]):
        low[open_] = high[open_] + 1
        high[open_] = np.minimum(high[open_] + step, len(values))
        step, open_ = 2 * step, open_[high[open_] < len(values)]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        below = values[middle] < keys[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def places(keys: np.ndarray, values: np.ndarray, apart: int = 1) -> np.ndarray:
    """How many of the sorted values are below each of the sorted keys, which are `apart` ranks apart.

    The first key of every block is placed before the others; they start as if both lists went on alike.
    """
    if len(keys) <= 1:
        start = np.zeros(len(keys), dtype=np.int64)
    else:
        firsts = places(keys[::BLOCK], values, apart * BLOCK)
        rank = np.arange(len(keys))
        start = np.minimum(firsts[rank // BLOCK] + rank % BLOCK * apart, len(values))
    return gallop(keys, values, start)


def common(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices in both sorted lists of the values they share."""
    short, long = (np.asarray(k, dtype=np.int64) for k in (short, long))
    at = places(short, long)
    i = np.flatnonzero(at < len(long))
    i = i[long[at[i]] == short[i]]
    return i, at[i]


def aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranks of the tokens that end together, from the ends of both lists of tokens."""
    if len(a) <= len(b):
        return common(a, b)
    j, i = common(b, a)
    return i, j


def groups_of(a: list[int], b: list[int], i: list[int], j: list[int]) -> list[dict]:
    """The token ids of both sides of every group."""
    return [
        {"a": a[x + 1 : p + 1], "b": b[y + 1 : q + 1]}
        for x, y, p, q in zip([-1, *i], [-1, *j], i, j)
    ]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Successive rows whose texts, in the second column, have at most SLICE_BYTES in all but for the last one."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
    cuts = np.flatnonzero(np.diff(sizes.cumsum() // SLICE_BYTES, prepend=0)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
        if low < high:
            yield batch.slice(low, high - low)


def align(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    a: str | None = None, b: str | None = None, with_groups: bool = False,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, groups (if asked for) and links of every document."""
    a, b = a or default_vocabulary(), b or default_pieces()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(FIGURES).fields])
    of_groups = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(a, b)
        for part in (part for batch in batches for part in slices(batch)):
            ids = list(zip(*(both.ids(value.as_py()) for value in part.column(1))))
            x, y = map(np.concatenate, ids)
            # Both lists of a text end at the same byte, so running sums over the slice never match across texts.
            i, j = aligned(both.sizes[0][x].cumsum(), both.sizes[1][y].cumsum())
            n_x, n_y = (np.fromiter(map(len, k), np.int64) for k in ids)
            ends_x, ends_y = (np.append(0, k.cumsum()) for k in (n_x, n_y))
            ends = np.searchsorted(i, ends_x)
            written = both.written(x, y, i, j)
            digests = [digest(written[low:high]) for low, high in pairwise((ends_x + ends_y).tolist())]
            groups = [None] * len(part)
            if with_groups:
                own = ((k, slice(*r)) for k, r in enumerate(pairwise(ends.tolist())))
                groups = [groups_of(*(v[k].tolist() for v in ids), (i[r] - ends_x[k]).tolist(), (j[r] - ends_y[k]).tolist()) for k, r in own]
            columns = [*map(pa.array, (n_x, n_y, np.diff(ends))), pa.array(digests, pa.string()), pa.array(groups, of_groups)]
            links = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(both.numbers(x[i], y[j])))
            yield pa.RecordBatch.from_arrays([part.column(0), *columns, links], names=schema.names)

    return rows.mapInArrow(scan, schema)


def pair_counts(written: DataFrame, size: int) -> np.ndarray:
    """How many links of the corpus hold each numbered pair."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["pair", "n"])

    parts = written.select("links").mapInArrow(count, "pair int, n bigint")
    found = parts.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out


def best_of_b(counts: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Whether each pair's count is the highest of its B id."""
    highest = np.zeros(size, dtype=np.int64)
    np.maximum.at(highest, b, counts)
    return counts == highest[b]


def with_counts(written: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Written alignments with n_links, n_best and count_sum of each document."""
    both = vocabularies(a or default_vocabulary(), b or default_pieces())
    counts = pair_counts(written, len(both.pairs))
    best = best_of_b(counts, both.pairs % len(both.b_bytes), len(both.b_bytes))
    shared = written.sparkSession.sparkContext.broadcast((counts, best))
    kept = [c for c in written.columns if c != "links"]
    added = T._parse_datatype_string("n_links bigint, n_best bigint, count_sum bigint").fields
    schema = T.StructType([*[written.schema[c] for c in kept], *added])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            links = batch.column(len(kept))
            ends = links.offsets.to_numpy()
            numbers = links.values.to_numpy()[ends[0] : ends[-1]]
            sums = [np.append(0, np.cumsum(v[numbers], dtype=np.int64))[ends - ends[0]] for v in (best, counts)]
            new = [np.diff(ends).astype(np.int64), *map(np.diff, sums)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, new)], names=schema.names)

    return written.select(*kept, "links").mapInArrow(look_up, schema)


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """align(), with the figures of its links by corpus-wide counts."""
    vocabulary = {k: v for k, v in options.items() if k in ("a", "b")}
    return with_counts(materialise(align(docs, doc_id, text, **options)), **vocabulary)
