"""Near-duplicate documents: MinHash bands, odd sketches, exact verification, components.

Words are lower-cased runs of characters that are not blank. A document's set holds its distinct shingles
of `shingle` consecutive words, as 64-bit hashes. Two documents are linked if 100 * intersection is at
least `percent` * union.

1. Equal sets are one class, named by two hashes of the set; it stands for all its documents, so copies
   are never compared. A class has MinHash samples for the keys of `BANDS` bands of `ROWS` samples, and its
   odd sketch: one permutation is cut into 2^`BINS_LOG2` bins, the minimum of every bin that is not empty is a
   sample, and every sample flips one bit of a bitmap. The number of bits in which two bitmaps differ
   estimates how many samples differ, most precisely where few do.
2. Classes that share a bucket with another get their whole sets, made once. An element that only one of these
   sets holds is in no intersection, so the elements that are left bound the similarity of a class to any
   other and of every pair. Classes whose bound is below the threshold leave all buckets, without loss.
3. In each band's bucket every class meets one pivot, chosen by a hash of class and band, so that twenty
   bands give different pivots and a bucket of m classes m pairs. The likeliest few of each class go on.
4. In a bucket whose classes are still in several components, every class outside the bucket's largest
   component meets every class of another component. Each brings its differences from the bucket's pivot P:
   m, the elements of P that it lacks, and x, those it has beyond P. As |A and B| = |P| - |mA or mB| +
   |xA and xB|, pairs are compared exactly where they meet, and a block returns a spanning forest of the links
   it confirms, at most one row per class. Buckets are cut into blocks of bounded size, so that they spread.
5. A candidate pair is dropped if its bitmaps differ by `DEVIATIONS` standard deviations more than those of
   a pair at the threshold do. All others are compared on their whole sets, or on their differences.
6. Links give components by alternating stars.

A linked pair shares no band with probability (1 - 0.85^4)^20 < 3e-6.

Defined cases: a document with fewer words than a shingle has its whole sequence as the one element;
NULL or blank texts have an empty set and are linked with nothing; rows of equal ids and texts are
copies of each other; a NULL id is larger than all others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.components import components
from rowmill.llm.vectors import spanning
from rowmill.plans.storage import materialise

SHINGLE = 3
PERCENT = 85
BANDS, ROWS = 20, 4
BINS_LOG2 = 13
SKETCH_WORDS = 16  # 64 bits each
DEVIATIONS = 5.0
TRIED = 3
# Elements in the differences of a block's classes, a class counting ROW_WEIGHT more.
BLOCK_WEIGHT, ROW_WEIGHT = 1 << 18, 256
PART = 2048
KNOWN_WORDS = 1 << 20

SEED = 77


class WordHashes(dict):
    """Hashes of words, remembered for up to KNOWN_WORDS of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    found = (text or "").encode(errors="surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(size, len(found))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = mixed(out + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def samples(elements: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minima of the set under independent orders."""
    n = BANDS * ROWS
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
    masks = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    # Blocks bound the memory of very long texts.
    for at in range(0, len(elements), 1 << 12):
        block = elements[at : at + (1 << 12)]
        values = (block[:, None] ^ masks) * factors
        out = np.minimum(out, (values ^ (values >> np.uint64(32))).min(axis=0))
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = mixed(keys + minima.reshape(BANDS, ROWS)[:, r])
    return keys.view(np.int64)


def odd_sketch(elements: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of samples of a sorted set, and the bitmap in which every sample flips the bit it chooses.

    The samples are the minima of the bins into which the leading bits of a hash cut the elements.
    """
    bins = elements >> np.uint64(64 - BINS_LOG2)
    minima = elements[np.flatnonzero(np.diff(bins, prepend=~bins[:1]))]
    places = mixed(minima) % np.uint64(64 * SKETCH_WORDS)
    flips = np.bincount(places.astype(np.int64), minlength=64 * SKETCH_WORDS)
    return len(minima), np.packbits((flips & 1).astype(np.uint8)).view(np.int64)


class Numbers:
    """The functions of `deviations` for numpy arrays, under the names that Spark gives them."""

    log, exp, sqrt, greatest, least, lit = np.log, np.exp, np.sqrt, np.maximum, np.minimum, float


def deviations(differ, sizes, filled, percent: int, f):
    """Standard deviations by which bitmaps differ more than at the threshold: columns (f: functions) or arrays.

    At the threshold s, a union of t elements fills u bins, s * u of them with the same sample, so the
    samples of the two differ by d = filled(l) + filled(r) - 2 * s * u. The filled bins of both scale u, as
    their numbers vary together. Which elements are minima and which samples meet in one bit make the
    variance; one more keeps tiny sets safe.
    """
    bits, bins, s = 64.0 * SKETCH_WORDS, float(1 << BINS_LOG2), percent / 100
    seen = -bits / 2 * f.log(f.greatest(1 - 2 * differ / f.lit(bits), f.lit(1e-3)))
    t = (sizes[0] + sizes[1]) / f.lit(1 + s)
    samples_of = filled[0] + filled[1]
    expected = [1 - f.exp(-x / bins) for x in (t, *sizes)]
    u = samples_of * expected[0] / (expected[1] + expected[2])
    # A bound on d keeps the exponential finite; beyond it a bitmap is full and drops no pair.
    d = f.least(f.greatest(samples_of - 2 * s * u, f.lit(0.0)), f.lit(4 * bits))
    variance = 4 * s * (1 - s) * u * f.greatest(1 - u / t, f.lit(0.0)) + bits / 4 * (f.exp(4 * d / bits) - 1) - d + 1
    return (seen - d) / f.sqrt(variance)


def excess(l: Column, r: Column, percent: int) -> Column:
    """The deviations of two described classes."""
    differ = sum(
        (F.bit_count(l["sketch"][f"w{i}"].bitwiseXOR(r["sketch"][f"w{i}"])) for i in range(SKETCH_WORDS)),
        F.lit(0),
    )
    return deviations(differ, *[[l[c], r[c]] for c in ("n_shingles", "filled")], percent, F)


FEATURES = "n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>, filled int, sketch array<bigint>"


def features(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, set size, two hashes of the set (NULL if empty), band keys, samples and bitmap of the sketch.

    Columns after doc_id and text are carried.
    """
    carried = docs.schema.fields[2:]
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(FEATURES).fields, *carried])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            rows = []
            for value in batch.column(1):
                own = shingles(value.as_py(), shingle, known)
                if len(own):
                    minima, data = samples(own), own.tobytes()
                    digest = np.frombuffer(xxhash.xxh3_128_digest(data), dtype=np.int64)
                    rows.append((len(own), *digest.tolist(), band_keys(minima), *odd_sketch(own)))
                else:
                    rows.append((0, None, None, None, 0, None))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)], *batch.columns[2:]],
                names=schema.names,
            )

    return docs.mapInArrow(describe, schema)


def whole_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """s1, s2, elements of each document's set."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = []
                for value in batch.column(0).slice(at, 256):
                    own = shingles(value.as_py(), shingle, known)
                    digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), dtype=np.int64)
                    rows.append((*digest.tolist(), own.view(np.int64)))
                a, b, c = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.list_(pa.int64()))],
                    names=["s1", "s2", "elements"],
                )

    return docs.select("text").mapInArrow(collect, "s1 bigint, s2 bigint, elements array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    # Only the sets of these pairs go through the joins.
    ends = materialise(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct())
    sets = sets.join(ends, "class", "left_semi")
    left = sets.select(F.col("class").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("elements").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .where(100 * both >= percent * (F.size("x") + F.size("y") - both))
        .select("a", "b")
    )


CLASS = "class", "n_shingles", "shared", "filled", "sketch"


def described_classes(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Size, shared elements and sketch of the classes with sets, without those that nothing can be linked with."""
    holders = sets.select("class", F.explode("elements").alias("element")).groupBy("element")
    single = holders.agg(F.count("*").alias("k"), F.min("class").alias("class")).where("k = 1")
    single = materialise(single.groupBy("class").agg(F.count("*").alias("own")))
    words = [F.col("sketch")[i].alias(f"w{i}") for i in range(SKETCH_WORDS)]
    return (
        classes.join(sets.select("class"), "class", "left_semi")
        .join(single, "class", "left")
        .withColumn("shared", F.col("n_shingles") - F.coalesce("own", F.lit(0)))
        .where(100 * F.col("shared") >= percent * F.col("n_shingles"))
        .select("class", "n_shingles", "shared", "filled", F.struct(*words).alias("sketch"), "bands")
    )


def busy(rows: DataFrame, column: str) -> DataFrame:
    """The rows of the buckets in which the column has several values."""
    spans = rows.groupBy("band").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    # Written, so that both sides of the join are plain shuffles and a hot bucket can be split.
    return materialise(rows.join(materialise(spans.where("low <> high").select("band")), "band"))


def possible(l: Column, r: Column, percent: int) -> Column:
    """Whether sizes and shared elements of two described classes allow a link."""
    low, high = (f(l["n_shingles"], r["n_shingles"]) for f in (F.least, F.greatest))
    both = F.least(l["shared"], r["shared"])
    return (100 * low >= percent * high) & (100 * both >= percent * (low + high - both))


def pivot_pairs(rows: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """Pairs of a class and a pivot of one of its buckets: the TRIED likeliest of each class."""
    order = F.xxhash64("class", "band")
    chosen = rows.groupBy("band").agg(F.min(F.struct(order.alias("order"), "class"))["class"].alias("pivot"))
    pairs = rows.join(materialise(chosen), "band").where("class <> pivot").select("class", "pivot").distinct()
    own = F.struct(*CLASS)
    met = (
        materialise(pairs)
        .join(about.select("class", own.alias("r")), "class")
        .join(about.select(F.col("class").alias("pivot"), own.alias("l")), "pivot")
        .where(possible(F.col("l"), F.col("r"), percent))
        .withColumn("excess", excess(F.col("l"), F.col("r"), percent))
        .where(F.col("excess") <= DEVIATIONS)
    )
    # A class has one pivot a band at most, so this list is short.
    listed = F.slice(F.array_sort(F.collect_list(F.struct("excess", "pivot"))), 1, TRIED)
    likeliest = met.groupBy("class").agg(F.explode(listed).alias("p"))
    return likeliest.select(
        F.least("class", "p.pivot").alias("a"), F.greatest("class", "p.pivot").alias("b")
    ).distinct()


def differences(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """class, pivot, pivot_size, missing, extra: the set of every class of `rows` beside that of its pivots."""
    pairs = materialise(rows.select("class", "pivot").distinct())
    ends = materialise(pairs.select("class").union(pairs.select("pivot")).distinct())
    sets = materialise(sets.join(ends, "class", "left_semi"))
    pivots = sets.select(F.col("class").alias("pivot"), F.col("elements").alias("whole"))
    # The pivot of one bucket is that of most others its classes are in, so this is little more than one row each.
    met = pairs.join(sets, "class").join(pivots, "pivot")
    return materialise(
        met.select(
            "class", "pivot", F.size("whole").alias("pivot_size"),
            F.array_except("whole", "elements").alias("missing"), F.array_except("elements", "whole").alias("extra"),
        )
    )


def ragged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each value of a list column, and the values."""
    lists = column.combine_chunks()
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()


def overlaps(rows: tuple, values: tuple, shape: tuple[int, int]) -> np.ndarray:
    """How many values the lists of the left rows share with those of the right rows."""
    out = np.zeros(shape, dtype=np.float32)
    common = np.intersect1d(*values)
    for at in range(0, len(common), PART):
        part, sides = common[at : at + PART], []
        for r, v, n in zip(rows, values, shape):
            place = np.minimum(np.searchsorted(part, v), len(part) - 1)
            held = part[place] == v
            side = np.zeros((n, len(part)), dtype=np.float32)
            side[r[held], place[held]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def rest_links(rows: DataFrame, about: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join the components of classes which share a bucket. rows: band, class, component."""
    sizes = rows.groupBy("band", "component").agg(F.count("*").alias("k"))
    mains = sizes.groupBy("band").agg(F.max(F.struct("k", "component"))["component"].alias("main"))
    # One order of classes for all bands, so that a class has few pivots.
    order = F.struct(F.xxhash64("class").alias("order"), "class")
    pivots = rows.groupBy("band").agg(F.min(order)["class"].alias("pivot"))
    rows = materialise(rows.join(materialise(mains.join(pivots, "band")), "band"))
    apart = differences(rows, sets)
    minor = F.col("component") != F.col("main")
    rows = rows.join(apart.withColumn("weight", ROW_WEIGHT + F.size("missing") + F.size("extra")), ["class", "pivot"])
    rows = materialise(rows)
    weights = rows.groupBy("band").agg(
        F.ceil(F.sum("weight") / BLOCK_WEIGHT).cast("int").alias("chunks"),
        F.ceil(F.sum(F.when(minor, F.col("weight"))) / BLOCK_WEIGHT).cast("int").alias("parts"),
    )
    # All classes are cut into chunks and those outside the main component into parts; all chunks meet all parts.
    chunk, part = (F.pmod(F.xxhash64("class"), F.col(n)).cast("int") for n in ("chunks", "parts"))
    as_left = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.lit(False).alias("right"), chunk.alias("chunk"), p.alias("part")),
    )
    as_right = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda c: F.struct(F.lit(True).alias("right"), c.alias("chunk"), part.alias("part")),
    )
    sketch = F.array(*[F.col("sketch")[f"w{i}"] for i in range(SKETCH_WORDS)])
    placed = (
        rows.join(about, "class")
        .join(materialise(weights), "band")
        .withColumn("at", F.explode(F.when(minor, F.concat(as_left, as_right)).otherwise(as_left)))
        .select(
            "band", "at.*", "class", "component", minor.alias("minor"), "n_shingles", "shared", "filled",
            sketch.alias("sketch"), "bands", "pivot_size", "missing", "extra",
        )
    )

    def meet(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        of = {c: group[c].to_numpy() for c in ("class", "component", "minor", "n_shingles", "shared", "filled")}
        lists = {c: group[c].combine_chunks().flatten().to_numpy().reshape(len(group), -1) for c in ("sketch", "bands")}
        right = group["right"].to_numpy()
        l, r = np.flatnonzero(~right), np.flatnonzero(right)
        x, y = {c: v[l][:, None] for c, v in of.items()}, {c: v[r][None, :] for c, v in of.items()}
        # Two minor classes meet twice; once is enough.
        ok = (x["component"] != y["component"]) & (~x["minor"] | (x["class"] < y["class"]))
        low, high = (f(x["n_shingles"], y["n_shingles"]) for f in (np.minimum, np.maximum))
        both = np.minimum(x["shared"], y["shared"])
        ok &= (100 * low >= percent * high) & (100 * both >= percent * (low + high - both))
        keys = lists["bands"]
        for t in range(int(np.flatnonzero(keys[:1] == group["band"][0].as_py())[0]) if len(group) else 0):
            ok &= keys[l, t][:, None] != keys[r, t][None, :]
        i, j = np.nonzero(ok)
        differ = np.zeros(len(i))
        # Unsigned, as numpy counts the bits of absolute values.
        for w in lists["sketch"].view(np.uint64).T:
            differ += np.bitwise_count(w[l[i]] ^ w[r[j]])
        numbers = [[of[c][l[i]].astype(float), of[c][r[j]].astype(float)] for c in ("n_shingles", "filled")]
        near = deviations(differ, *numbers, percent, Numbers) <= DEVIATIONS
        i, j = i[near], j[near]
        # Only the classes of these pairs need their differences compared.
        sides = [np.unique(k) for k in (i, j)]
        shape = len(sides[0]), len(sides[1])
        shared = {}
        for name in ("missing", "extra"):
            owner, values = ragged(group[name])
            place = []
            for side, own in zip((l, r), sides):
                at = np.full(len(group), -1)
                at[side[own]] = np.arange(len(own))
                place.append(at[owner])
            rows_in = [p[p >= 0] for p in place]
            shared[name] = overlaps(rows_in, [values[p >= 0] for p in place], shape)
            shared[name, "sizes"] = [np.bincount(p, minlength=n) for p, n in zip(rows_in, shape)]
        either = shared["missing", "sizes"][0][:, None] + shared["missing", "sizes"][1] - shared["missing"]
        both = (group["pivot_size"][0].as_py() if len(group) else 0) - either + shared["extra"]
        size = [of["n_shingles"][side[own]] for side, own in zip((l, r), sides)]
        asked = np.zeros(shape, dtype=bool)
        asked[np.searchsorted(sides[0], i), np.searchsorted(sides[1], j)] = True
        links = asked & (100 * both >= percent * (size[0][:, None] + size[1] - both))
        tree = np.array(spanning(links), dtype=np.int64).reshape(-1, 2)
        a, b = (of["class"][side[own[tree[:, k]]]] for k, (side, own) in enumerate(zip((l, r), sides)))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return placed.groupBy("band", "chunk", "part").applyInArrow(meet, "a bigint, b bigint")


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    carried: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (its smallest id), component, carried columns.

    `component` tells components apart whose smallest ids are equal or NULL; it is NULL for empty sets.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *[F.col(c) for c in carried])
    described = materialise(features(docs, shingle))
    sets_by = ["s1", "s2"]
    found = described.where("n_shingles > 0").groupBy(*sets_by).agg(
        F.min("doc_id").alias("least"),
        *[F.first(c).alias(c) for c in ("n_shingles", "bands", "filled", "sketch")],
    )
    # A number of its own for each pair of hashes: no two sets share one.
    classes = materialise(found.withColumn("class", F.monotonically_increasing_id()))
    rows = busy(classes.select("class", F.explode("bands").alias("band")), "class")
    met = classes.join(rows.select("class").distinct(), "class", "left_semi")
    sets = sets_of(docs.select("doc_id", "text"), met, shingle)
    about = materialise(described_classes(classes, sets, percent))
    rows = busy(rows.join(about.select("class"), "class", "left_semi"), "class")
    pairs = materialise(pivot_pairs(rows, about, percent))
    links = materialise(confirmed(pairs, sets, percent))
    labels = materialise(components(links)).withColumnRenamed("u", "class")
    labelled = rows.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    links = links.union(materialise(rest_links(busy(labelled, "component"), about, sets, percent)))
    labels = components(links).withColumnRenamed("u", "class")
    named = classes.select("class", *sets_by, "least").join(materialise(labels), "class", "left")
    named = materialise(named.withColumn("component", F.coalesce("component", "class")))
    first = materialise(named.groupBy("component").agg(F.min("least").alias("component_id")))
    named = materialise(named.join(first, "component").select(*sets_by, "component", "component_id"))
    out = described.select("doc_id", "n_shingles", *sets_by, *carried).join(named, sets_by, "left")
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), "component", *carried)


def near_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (its smallest id), kept (has this id)."""
    return near_groups(docs, doc_id, text, shingle, percent).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def sets_of(docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """class, elements: the sets of classes, each from its first document.

    Several documents can have that document's id; the sets of the others do no harm beside it.
    """
    wanted = materialise(classes.select(F.col("least").alias("doc_id")).distinct())
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    made = whole_sets(texts, shingle).dropDuplicates(["s1", "s2"])
    return materialise(made.join(classes.select("s1", "s2", "class"), ["s1", "s2"]).select("class", "elements"))
