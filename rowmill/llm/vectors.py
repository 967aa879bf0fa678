"""Near-duplicate vectors by random-hyperplane signs in several tables.

A vector's key in a table is the sign pattern of its products with the table's hyperplanes. Vectors that
share a key in any table are compared exactly, by cosine in double precision. The number of hyperplanes
follows the number of vectors, so that a bucket holds a bounded number of unrelated vectors; the number of
tables follows from it and `miss`, the largest probability that a pair just at the threshold shares none.

Equal vectors are one class with a count, so copies are never compared. A bucket of more than `BLOCK`
classes is cut into blocks, and every pair of blocks is a group of its own: no group is larger than about
two blocks, however many near copies there are. A pair that shares keys in several tables counts in the
first of them only, which the keys themselves tell. A group returns each class's number of links and a
spanning forest of its links, never its pairs.

Defined cases: vectors that are NULL, empty, all zero, or hold NULL, NaN or infinite components link with
nothing and are their own component; vectors of different dimensions are not linked; rows of one id are
each a row of the result, and a copy of a row is another vector; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.components import components
from rowmill.plans.storage import materialise

THRESHOLD = 0.9
MISS = 1e-3
BUCKET = 256  # unrelated vectors in a bucket, about
BLOCK = 1024
SEED = 20240607


def tables_for(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """(hyperplanes of a table, tables) for n vectors."""
    bits = min(60, max(8, math.ceil(math.log2(max(n, 1) / BUCKET))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-same))


def keys_of(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Rows x tables of 64-bit keys, for vectors of one dimension."""
    rng = np.random.default_rng([SEED, vectors.shape[1]])
    weights = 1 << np.arange(bits, dtype=np.int64)
    keys = np.empty((len(vectors), tables), dtype=np.int64)
    for t in range(tables):
        planes = rng.standard_normal((vectors.shape[1], bits))
        keys[:, t] = ((vectors @ planes) > 0) @ weights
    return keys


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two, exactly, so that squares of its components neither vanish nor overflow."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def with_keys(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """class, vector -> with keys, an array of a key per table."""

    kind = classes.schema["vector"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.array(v, dtype=float) for v in batch.column(1).to_pylist()]
            keys: list = [None] * len(vectors)
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(i)
            for rows in by_size.values():
                for i, k in zip(rows, keys_of(scaled(np.stack([vectors[i] for i in rows])), bits, tables)):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=["class", "vector", "n", "keys"]
            )

    return classes.select("class", "vector", "n").mapInArrow(
        sign, f"class bigint, vector {kind}, n bigint, keys array<bigint>"
    )


def spanning(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a link matrix (rows x columns, of two sets of vertices), as index pairs.

    Columns that share a row are one tree; the forest is found by visiting rows and columns in turn.
    """
    out, free_rows, free_columns = [], links.any(axis=1), links.any(axis=0)
    for start in np.flatnonzero(free_rows):
        if not free_rows[start]:
            continue
        rows, free_rows[start] = [int(start)], False
        while rows:
            r = rows.pop()
            for c in np.flatnonzero(links[r] & free_columns):
                free_columns[c] = False
                out.append((r, int(c)))
                for other in np.flatnonzero(links[:, c] & free_rows):
                    free_rows[other] = False
                    out.append((int(other), int(c)))
                    rows.append(int(other))
    return out


def compared(keyed: DataFrame, threshold: float, bits: int, tables: int) -> DataFrame:
    """(class, linked, peer): link counts of classes in their buckets, and spanning links to peers."""
    # Keys are not sent along: those of earlier tables follow from the vector and the seed.
    spread = keyed.select("class", "n", "vector", F.posexplode("keys").alias("table", "key"))
    size = F.size("vector").alias("dim")
    buckets = (
        keyed.select(size, F.posexplode("keys").alias("table", "key"))
        .groupBy("dim", "table", "key")
        .agg(F.count("*").alias("m"))
        .where("m > 1")
        .select("dim", "table", "key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    )
    rows = (
        spread.withColumn("dim", F.size("vector"))
        .join(materialise(buckets), ["dim", "table", "key"])
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        table, i, j = (int(frame[c].iloc[0]) for c in ("table", "i", "j"))
        frame = frame.sort_values("class")
        left, right = frame[frame["block"] == i], frame[frame["block"] == j]
        vectors = [scaled(np.stack(x["vector"]).astype(float)) if len(x) else None for x in (left, right)]
        if vectors[0] is None or vectors[1] is None:
            return pd.DataFrame({"class": [], "linked": [], "peer": []}).astype("int64")
        unit = [v / np.linalg.norm(v, axis=1, keepdims=True) for v in vectors]
        links = unit[0] @ unit[1].T >= threshold
        before = [keys_of(v, bits, table) for v in vectors]
        for t in range(table):
            links &= before[0][:, t][:, None] != before[1][:, t][None, :]
        if i == j:
            links = np.triu(links, 1)
        ids = [x["class"].to_numpy() for x in (left, right)]
        weights = [x["n"].to_numpy() for x in (left, right)]
        counts = [(ids[0], links @ weights[1]), (ids[1], weights[0] @ links)]
        tree = spanning(links)
        out = [pd.DataFrame({"class": k, "linked": c, "peer": k}) for k, c in counts]
        out.append(
            pd.DataFrame(
                {
                    "class": ids[0][[r for r, _ in tree]],
                    "linked": np.zeros(len(tree), dtype=np.int64),
                    "peer": ids[1][[c for _, c in tree]],
                }
            )
        )
        out = pd.concat(out)
        return out[(out["linked"] > 0) | (out["class"] != out["peer"])].astype("int64")

    return rows.groupBy("dim", "table", "key", "i", "j").applyInPandas(
        compare, "class bigint, linked bigint, peer bigint"
    )


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
    threshold: float = THRESHOLD, miss: float = MISS,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (the first of its component).

    A NULL vec_id counts as larger than any other; a component of NULL ids alone has component NULL.
    """
    # Floats stay floats on their way; every product is one of doubles.
    given = vectors.schema[embedding].dataType
    element = "float" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "double"
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast(f"array<{element}>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("vector", lambda x: x != 0)
    sound = F.col("vector").isNotNull() & ~bad & ~zero
    # Zeros of either sign are equal, so that their vectors are one class.
    plain = F.transform("vector", lambda x: (x + F.lit(0.0)).cast(element))
    named = rows.withColumn("vector", F.when(F.coalesce(sound, F.lit(False)), plain))
    there = F.col("vector").isNotNull()
    hashes = {"h1": F.when(there, F.xxhash64("vector")), "h2": F.when(there, F.xxhash64(F.lit(1), "vector"))}
    named = named.withColumns(hashes)
    found = named.where("h1 IS NOT NULL").groupBy(*hashes).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("n"), F.max("vector").alias("vector")
    )
    # A number of its own for each pair of hashes: no two vectors share one.
    classes = materialise(found.withColumn("class", F.monotonically_increasing_id()))
    n = classes.count()
    bits, tables = tables_for(n, threshold, miss)
    keyed = materialise(with_keys(classes, bits, tables))
    found = materialise(compared(keyed, threshold, bits, tables))
    labels = components(found.where(F.col("class") != F.col("peer")), "class", "peer")
    linked = found.where("linked > 0").groupBy("class").agg(F.sum("linked").alias("linked"))
    of_class = (
        classes.select("class", *hashes, "least", "n")
        .join(labels.withColumnRenamed("u", "class"), "class", "left")
        .join(linked, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    of_class = materialise(of_class)
    first = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = materialise(
        of_class.join(materialise(first), "component").select(
            *hashes, "component_id", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links")
        )
    )
    out = named.select("vec_id", *hashes).join(of_class, list(hashes), "left")
    component = F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
