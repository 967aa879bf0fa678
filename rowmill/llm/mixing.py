"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Sources, in the order of their names, weigh 5, 2 and 1 in turn and share SHARE times the words of all. A
target stops at REPEATS times its source's words; what is above is shared again by weight, which ends at the
level at which every target is the lesser of its stop and weight * level.

1. One scan counts words; everything after it works on (id, source, words, hash) alone. The documents of a
   source, in the order of a seeded hash, are one stream of words. Streams are laid out by range partitions:
   the words of each (range, source) give offsets, so no source is ever in one task, however large.
2. A stream is cut into blocks of BLOCK_WORDS words and its blocks into shards of SHARD_BLOCKS.
3. The blocks of the mix go to the sources by the highest quotients target / (2k + 1), and a source's blocks
   to its shards by the highest quotients blocks / (2k + 1): every shard gets a whole number of blocks. The
   divisor that ends the contest lies in a known bracket, so only about two quotients per party are compared.
4. A shard with q of n blocks takes each q div n times, and q mod n more, chosen by a seeded hash; a block cut
   short by the end of its stream is chosen last.
5. A document takes what its span of the stream shares with the chosen blocks.

A source misses its target by less than a block and the rounding of its quota; one whose target has stopped
takes all its words REPEATS times. No document is taken more often than that.

Defined cases: NULL texts and texts without words have size 0 and take nothing; a NULL source is a source of
its own, the last in order; equal rows are documents of their own, and which of them takes more is not fixed;
an empty table gives an empty mix. Only the id, text and source columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.plans.storage import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 64
SHARD_BLOCKS = 64  # a shard's choice is one 64-bit mask
SEED = 1

WORD = r"[^\x20\x09-\x0D]+"


def running(df: DataFrame, group: str, order: list[Column], weight: str, before: str) -> tuple[DataFrame, DataFrame]:
    """df with range, and `before`: the weights of the rows of its group that come earlier in the order.

    Also one row per range and group: its weight, and `before` of its first row. No window sorts more than a range.
    """
    keys = [F.col(group).asc_nulls_last(), *order]
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = materialise(laid.withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftright("at", 33)))
    sums = materialise(laid.groupBy("range", group).agg(F.sum(weight).alias("held")))
    earlier = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spans = materialise(sums.withColumn("offset", F.coalesce(F.sum("held").over(earlier), F.lit(0))))
    inside = Window.partitionBy("range", group).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    laid = laid.withColumn("inside", F.coalesce(F.sum(weight).over(inside), F.lit(0))).alias("laid")
    own = spans.select("range", group, "offset").alias("own")
    same = (F.col("laid.range") == F.col("own.range")) & F.col(f"laid.{group}").eqNullSafe(F.col(f"own.{group}"))
    out = laid.join(own, same).select("laid.*", (F.col("inside") + F.col("offset")).alias(before))
    return out.drop("at", "inside"), spans


def apportioned(parties: DataFrame, keys: list[str]) -> DataFrame:
    """keys and quota. parties: keys (the first is the group), weight, and the group's total, parties and seats.

    A divisor d gives a party floor(weight / d + 1/2) seats, so all of them total / d seats, half a seat per
    party more or less. That brackets the divisor that gives `seats`: what parties have at its upper end is
    settled, and the quotients inside the bracket are ranked, ties by a hash of the party.
    """
    half, seats, total = F.col("parties") / 2, F.col("seats"), F.col("total").cast("double")
    high = F.when(seats > half, F.try_divide(total, seats - half) * (1 + 1e-9))
    low = F.try_divide(total, seats + half) * (1 - 1e-9)
    given = lambda d: F.floor(F.col("weight") / d + 0.5)
    sized = parties.withColumn("settled", F.coalesce(given(high), F.lit(0))).withColumn("most", given(low))
    first = F.array(F.struct(F.lit(float("inf")).alias("quotient"), F.col("settled").alias("seats_of")))
    contested = F.transform(
        F.sequence("settled", F.col("most") - 1),
        lambda k: F.struct((F.col("weight") / (2 * k + 1)).alias("quotient"), F.lit(1).cast("long").alias("seats_of")),
    )
    entries = F.when(F.col("most") > F.col("settled"), F.concat(first, contested)).otherwise(first)
    rows = sized.where("seats > 0 AND weight > 0").select(*keys, "seats", F.inline(entries))
    order = [F.col("quotient").desc(), F.xxhash64(F.lit(SEED), *keys), *[F.col(k) for k in keys[1:]]]
    ranked, _ = running(rows, keys[0], order, "seats_of", "before")
    won = F.when(F.col("before") < F.col("seats"), F.col("seats_of")).otherwise(0)
    return ranked.groupBy(*keys).agg(F.sum(won).alias("quota"))


def level(sources: DataFrame) -> float:
    """The words per weight at which targets, each stopped at REPEATS times its source, add up to the mix."""
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0.0
    now, stopped = SHARE * total / weights, -1
    stop = REPEATS * F.col("source_size")
    while True:
        above = F.col("weight") * F.lit(now) >= stop
        n, held, left = sources.agg(F.count_if(above), F.sum(F.when(above, stop)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == stopped or not left:
            return now
        now, stopped = (SHARE * total - (held or 0)) / left, n


def quotas(spans: DataFrame) -> DataFrame:
    """source, number, source_size, target, blocks, quota of every source. spans: words by range and source."""
    sizes = materialise(spans.groupBy("source").agg(F.sum("held").alias("source_size")))
    one = sizes.withColumn("all", F.lit(0)).withColumn("one", F.lit(1).cast("long"))
    numbered, _ = running(one, "all", [F.col("source").asc_nulls_last()], "one", "number")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("number") % len(WEIGHTS)).cast("int") + 1)
    sources = materialise(numbered.select("source", "number", "source_size", weight.alias("weight")))
    reached = level(sources)
    stop = (REPEATS * F.col("source_size")).cast("double")
    sources = sources.withColumn("target", F.least(stop, F.col("weight") * F.lit(reached)))
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / BLOCK_WORDS))
    # Sources whose target has stopped take all they have; the others share the rest.
    open_ = sources.where(F.col("target") < stop)
    n, words = open_.agg(F.count("*"), F.sum("target")).first()
    parties = open_.select(
        F.lit(0).alias("all"), "number", F.col("target").alias("weight"), F.lit(float(words or 0)).alias("total"),
        F.lit(n).alias("parties"), F.lit(round((words or 0) / BLOCK_WORDS)).cast("long").alias("seats"),
    )
    won = apportioned(parties, ["all", "number"]).drop("all")
    full = REPEATS * F.col("blocks")
    quota = F.when(F.col("target") < stop, F.least(F.coalesce("quota", F.lit(0)), full)).otherwise(full)
    return materialise(sources.join(won, "number", "left").withColumn("quota", quota))


def shards(spans: DataFrame) -> DataFrame:
    """number, shard, each (times all its blocks are taken), mask (the blocks taken once more)."""
    words = BLOCK_WORDS * SHARD_BLOCKS
    first, last = F.ceil(F.col("offset") / words), F.ceil((F.col("offset") + F.col("held")) / words) - 1
    begun = spans.where(last >= first).select("*", F.explode(F.sequence(first, last)).alias("shard"))
    sized = begun.withColumn("weight", F.least(F.lit(SHARD_BLOCKS), F.col("blocks") - SHARD_BLOCKS * F.col("shard")))
    parties = sized.select(
        "number", "shard", "weight", F.col("blocks").alias("total"),
        F.ceil(F.col("blocks") / SHARD_BLOCKS).alias("parties"), F.col("quota").alias("seats"),
        # The stream's last block, if it is cut short.
        F.when(F.col("source_size") % BLOCK_WORDS > 0, F.col("blocks") - 1 - SHARD_BLOCKS * F.col("shard")).alias("short"),
    )
    won = apportioned(parties.drop("short"), ["number", "shard"])
    known = parties.select("number", "shard", "weight", "short").join(won, ["number", "shard"])
    order = F.transform(
        F.sequence(F.lit(0), F.col("weight").cast("int") - 1),
        lambda b: F.struct(
            F.coalesce(b == F.col("short"), F.lit(False)).alias("late"),
            F.xxhash64(F.lit(SEED), F.col("number"), F.col("shard"), b).alias("order"), b.alias("b"),
        ),
    )
    more = F.slice(F.array_sort(order), F.lit(1), (F.col("quota") % F.col("weight")).cast("int"))
    mask = F.aggregate(
        more, F.lit(0).cast("long"),
        lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["b"])),
    )
    each = F.floor(F.col("quota") / F.col("weight"))
    return materialise(known.select("number", "shard", each.alias("each"), mask.alias("mask")))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, spans, key.

    `spans` are the word ranges that are taken (start, end exclusive, times); `key` names the row by content.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"),
            F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text)).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    # The row number decides among equal rows alone.
    placed, spans = running(rows, "source", [F.col("key"), F.col("doc_id"), F.col("row")], "size", "start")
    sources = quotas(spans).withColumnRenamed("source", "name")
    spans = materialise(spans.join(sources, F.col("source").eqNullSafe(F.col("name"))).drop("name"))
    chosen = shards(spans)
    about = spans.select(F.col("range").alias("r"), F.col("source").alias("s"), "number", "source_size", "target")
    same = (F.col("range") == F.col("r")) & F.col("source").eqNullSafe(F.col("s"))
    words = BLOCK_WORDS * SHARD_BLOCKS
    end = F.col("start") + F.col("size")
    touched = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / words), F.floor((end - 1) / words)))
    parts = placed.join(about, same).withColumn("shard", F.explode_outer(touched)).join(chosen, ["number", "shard"], "left")
    begin = F.col("shard") * words
    low, high = F.greatest("start", begin) - begin, F.least(end, begin + words) - begin
    pieces = F.transform(
        F.sequence(F.floor(low / BLOCK_WORDS), F.floor((high - 1) / BLOCK_WORDS)),
        lambda b: F.struct(
            (F.greatest(low, b * BLOCK_WORDS) + begin - F.col("start")).alias("start"),
            (F.least(high, (b + 1) * BLOCK_WORDS) + begin - F.col("start")).alias("end"),
            (F.col("each") + F.call_function("shiftright", F.col("mask"), b.cast("int")).bitwiseAND(F.lit(1))).alias("times"),
        ),
    )
    parts = parts.withColumn("spans", F.filter(pieces, lambda p: p["times"] > 0))
    found = parts.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target", "key")],
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda n, p: n + (p["end"] - p["start"]) * p["times"])
    return found.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "spans", "key")


def passages(
    docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The mix itself: doc_id, start, times and text of every span that is taken; words are parted by blanks."""
    key = F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text))
    texts = docs.select(F.col(doc_id).alias("own"), F.col(text).alias("whole"), key.alias("key"))
    spans = mixed.select("doc_id", "key", F.inline("spans")).alias("m")
    same = (F.col("m.key") == F.col("t.key")) & F.col("m.doc_id").eqNullSafe(F.col("t.own"))
    words = F.regexp_extract_all("whole", F.lit(WORD), F.lit(0))
    part = F.slice(words, F.col("start") + 1, F.col("end") - F.col("start"))
    return spans.join(texts.dropDuplicates(["own", "whole"]).alias("t"), same).select(
        "doc_id", "start", "times", F.array_join(part, " ").alias("text")
    )
