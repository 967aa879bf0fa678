"""Benchmark decontamination with a broadcast set of n-grams of the test items.

Every window of `n` consecutive words of an item (one window for an item of fewer words) becomes a 64-bit
hash. The distinct windows are broadcast after a check of their size; more than `broadcast_bytes` are
shuffled instead. Documents are scanned once: window hashes of all positions come from doubling, hashes
of 2w words from two hashes of w words, so that their cost does not grow with n. A hit is verified by
comparing the words themselves, when the hits are joined to the documents for the result.

Defined cases: NULL text has no words; an item without words has no window; equal rows give equal
results; an item without id still marks words but is not listed; empty tables leave every document
clean. Input columns are carried; those named as a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import WORD_GAP, lower_ascii, row_key, with_columns, words

WINDOW_WORDS = 10
BROADCAST_BYTES = 64_000_000

RESULTS = ("n_words", "hit_words", "items")


def pair_hashes(left: Column, right: Column, shift: int) -> Column:
    """hash(left[i], right[i + shift]) for every i; past the end the values mean nothing."""
    late = F.slice(right, shift + 1, F.size(right))
    return F.zip_with(left, late, lambda a, b: F.xxhash64(a, b))


def window_hashes(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add h<L>, the hashes of all windows of L words, for each length; df has the words as `_w`."""
    df = df.withColumn("h1", F.transform("_w", lambda w: F.xxhash64(w)))
    size = 1
    while 2 * size <= max(lengths, default=1):
        df = df.withColumn(f"h{2 * size}", pair_hashes(F.col(f"h{size}"), F.col(f"h{size}"), size))
        size *= 2
    for n in lengths:
        parts = [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]
        done, hashes = parts[0], F.col(f"h{parts[0]}")
        for p in parts[1:]:
            hashes = pair_hashes(hashes, F.col(f"h{p}"), done)
            done += p
        df = df.withColumn(f"g{n}", F.slice(hashes, 1, F.greatest(F.size("_w") - (n - 1), F.lit(0))))
    return df


def item_windows(items: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """One row per distinct window: its words and the items (as text) that hold it."""
    listed = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("_w"))
    last = F.greatest(F.size("_w") - n, F.lit(0))
    starts = F.when(F.size("_w") > 0, F.sequence(F.lit(0), last))
    return (
        listed.withColumn("start", F.explode(starts))
        .select("item", F.slice("_w", F.col("start") + 1, n).alias("gram"))
        .groupBy("gram")
        .agg(F.collect_set("item").alias("gram_items"))
    )


def find_hits(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", n: int = WINDOW_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The columns of docs with n_words, hit_words (sorted word positions) and items (sorted ids)."""
    grams = item_windows(benchmark, item_id, item_text, n)
    size = F.sum(40 + F.char_length(F.array_join("gram", " ")) + 16 * F.size("gram_items"))
    lengths, held = grams.agg(F.collect_set(F.size("gram")), size).first()
    lengths = sorted(lengths)
    grams = window_hashes(grams.withColumnRenamed("gram", "_w"), lengths).select(
        F.col("_w").alias("gram"),
        "gram_items",
        F.coalesce(*[F.when(F.size("_w") == k, F.col(f"g{k}")[0]) for k in lengths] or [F.lit(0)]).alias("hash"),
        F.size("_w").alias("gram_size"),
    )
    if (held or 0) <= broadcast_bytes:
        grams = F.broadcast(grams)

    found = None
    if lengths:
        scanned = window_hashes(
            docs.select(*row_key(doc_id, text), words(F.col(text)).alias("_w")), lengths
        )
        # One generator over all lengths: the windows of each length follow those of the one before.
        ends, at = [], F.lit(0)
        for k in lengths:
            ends.append((k, at))
            at = at + F.greatest(F.size("_w") - (k - 1), F.lit(0))
        places = [begin.cast("int").alias(f"b{k}") for k, begin in ends if k != lengths[0]]
        rows = scanned.select(
            "_k1", "_k2", *places, F.posexplode(F.concat(*[F.col(f"g{k}") for k in lengths])).alias("i", "hash")
        )
        length, begin = F.lit(lengths[0]), F.lit(0)
        for k in lengths[1:]:
            length = F.when(F.col("i") >= F.col(f"b{k}"), k).otherwise(length)
            begin = F.when(F.col("i") >= F.col(f"b{k}"), F.col(f"b{k}")).otherwise(begin)
        found = (
            rows.join(grams, "hash")
            .where(F.col("gram_size") == length)
            .groupBy("_k1", "_k2")
            .agg(F.collect_set(F.struct((F.col("i") - begin).alias("at"), "gram", "gram_items")).alias("_hits"))
        )
    own = docs.select(F.struct("*").alias("row"), *row_key(doc_id, text))
    if found is None:
        kind = "array<struct<at:int,gram:array<string>,gram_items:array<string>>>"
        own = own.withColumn("_hits", F.lit(None).cast(kind))
    else:
        own = own.join(found, ["_k1", "_k2"], "left")
    own = own.withColumn("_w", words(F.col("row").getField(text)))
    same = F.filter("_hits", lambda h: F.slice("_w", h["at"] + 1, F.size(h["gram"])) == h["gram"])
    none = F.array().cast("array<int>")
    own = own.withColumn("_hits", F.when(F.size("_hits") > 0, same))
    spread = F.transform("_hits", lambda h: F.sequence(h["at"], h["at"] + F.size(h["gram"]) - 1))
    return with_columns(
        own,
        "row",
        {
            "n_words": F.size("_w").cast("long"),
            "hit_words": F.coalesce(F.array_sort(F.array_distinct(F.flatten(spread))), none),
            "items": F.coalesce(
                F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["gram_items"])))),
                F.array().cast("array<string>"),
            ),
        },
    )


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """The text without its hit words and the gaps before them; other texts stay as they are."""
    gaps = F.split(text, "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", -1)
    own = F.array_remove(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1), "")
    kept = F.zip_with(
        F.slice(gaps, 1, F.size(own)),
        F.transform(own, lambda w, i: F.struct(w.alias("word"), i.alias("i"))),
        lambda g, w: F.when(F.array_contains("hit_words", w["i"]), "").otherwise(F.concat(g, w["word"])),
    )
    cut = F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))
    return found.withColumn(text, F.when(F.size("hit_words") > 0, cut).otherwise(F.col(text)))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options
) -> DataFrame:
    """docs, with its own columns, without contaminated documents or without the hit spans."""
    found = find_hits(docs, benchmark, **options)
    text = options.get("text", "text")
    found = found.where(F.size("hit_words") == 0) if remove == "documents" else remove_spans(found, text)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c in found.columns])


def report(found: DataFrame) -> DataFrame:
    """Digest of find_hits per document."""
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )
