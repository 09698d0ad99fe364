"""Near duplicates among embeddings: spherical k-means cells, blocked cosine products, one kept per group.

Equal directions are one class first, so copies never meet in pairs. The classes of a label go to cells around
centroids, which a task per label fits on a bounded sample of its own; every class is in its nearest cells. A cell of any size is cut into
blocks, and pairs of blocks are compared by one matrix product each: a hot cell means more products, no larger ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabsift.llm.common import nullable, staged
from tabsift.llm.components import components, local_roots

#: Rows of a cell that the number of centroids aims at, and rows of the sample of one label at most.
CELL_ROWS, SAMPLE_ROWS = 2_000, 40_000
#: Sample rows per centroid: wanted, and needed at least.
SAMPLE_PER_CELL, SAMPLE_LEAST = 256, 32
#: Cells each class is put in, and classes of one block of a product.
CELLS, BLOCK = 3, 2_048
#: Classes that are put in cells by one group.
PART_ROWS = 50_000


def unit_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, dim, class, unit): vectors of length 1 as double bytes; class numbers label and direction.

    class and unit are null for vectors that take no part: null, empty or zero, with null or non-finite components,
    or with a null label.
    """
    source = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"),
                            F.transform(vector, lambda x: x.cast("double")).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, keys, dims = [], [], []
            for tag, v in zip(batch.column("label").to_pylist(), batch.column("v")):
                x = None
                if tag is not None and v.is_valid and v.values.null_count == 0 and len(v.values):
                    x = v.values.to_numpy(zero_copy_only=False)
                    top = np.abs(x).max()
                    x = x / top if np.isfinite(x).all() and top > 0 else None
                if x is None:
                    units.append(None), keys.append(None), dims.append(None)
                    continue
                raw = (x / np.sqrt(x @ x) + 0.0).tobytes()
                units.append(raw), dims.append(len(x))
                digest = hashlib.blake2b(raw, digest_size=8, salt=repr(tag).encode()[:16]).digest()
                keys.append(int.from_bytes(digest, "little", signed=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(keys, pa.int64()),
                 pa.array(units, pa.binary())], names=["id", "label", "dim", "class", "unit"])

    schema = source.select("id", "label", F.lit(0).alias("dim"), F.lit(0).cast("long").alias("class"),
                           F.lit(b"").alias("unit")).schema
    return source.mapInArrow(run, nullable(schema))


def spherical_kmeans(rows: np.ndarray, k: int, seed: int = 11, rounds: int = 12) -> np.ndarray:
    """``k`` centroids of length 1 for rows of length 1."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(rows[at:at + BLOCK] @ centres.T).argmax(1) for at in range(0, len(rows), BLOCK)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def fit_cells(classes: DataFrame, *, cell_rows: int, sample_rows: int) -> DataFrame:
    """(label, dim, count, centres) of every (label, dim) with more than ``cell_rows`` classes; centres as double bytes.

    Each is fitted in a task of its own, on about SAMPLE_PER_CELL of its classes per centroid and ``sample_rows`` at
    most, so the samples of other labels take none of it away.
    """
    sizes = classes.groupBy("label", "dim").count().where(F.col("count") > cell_rows)
    wanted = F.least(F.lit(sample_rows), F.ceil(F.col("count") / cell_rows) * SAMPLE_PER_CELL)
    place = F.pmod(F.xxhash64(F.lit(7), "class"), F.lit(1 << 40)) / float(1 << 40)
    sample = classes.join(sizes, ["label", "dim"]).where(place < wanted / F.col("count")).select("label", "dim", "count", "class", "unit")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("class")  # the same centroids in every run
        k = max(1, min(-(-int(part["count"].iloc[0]) // cell_rows), len(part) // SAMPLE_LEAST))
        rows = np.frombuffer(b"".join(part["unit"]), float).reshape(len(part), -1)
        return part[["label", "dim", "count"]].head(1).assign(centres=[spherical_kmeans(rows, k).tobytes()])

    schema = nullable(sample.select("label", "dim", "count", F.col("unit").alias("centres")).schema)
    return sample.groupBy("label", "dim").applyInPandas(run, schema)


def to_cells(classes: DataFrame, centres: DataFrame, nearest: int, part_rows: int = PART_ROWS) -> DataFrame:
    """The classes with cells, the ``nearest`` cells of their label in order of number; [0] where there is but one.

    The classes of a label are dealt into parts, and each part meets a copy of the label's centroids.
    """
    key, names = ["label", "dim"], classes.columns
    sizes = centres.select(*key, F.ceil(F.col("count") / part_rows).cast("int").alias("parts"))
    dealt = classes.join(sizes, key, "left")
    alone = dealt.where("parts is null").select(*names, F.array(F.lit(0)).alias("cells"))
    dealt = dealt.where("parts is not null").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    copies = centres.join(sizes, key).select(
        *key, "centres", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def run(part: pd.DataFrame, centre: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return pd.DataFrame(columns=[*names, "cells"])
        dim, found = int(part["dim"].iloc[0]), []
        mine = np.frombuffer(centre["centres"].iloc[0], float).reshape(-1, dim)
        take = min(nearest, len(mine))
        for at in range(0, len(part), BLOCK):
            rows = np.frombuffer(b"".join(part["unit"].iloc[at:at + BLOCK]), float).reshape(-1, dim)
            found += np.sort(np.argpartition(-(rows @ mine.T), take - 1, axis=1)[:, :take], axis=1).tolist()
        return part[names].assign(cells=found)

    cells = dealt.groupBy(*key, "part").cogroup(copies.groupBy(*key, "part")).applyInPandas(run, nullable(alone.schema))
    return alone.unionByName(cells)


def _compare(part: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between the classes of two blocks (or inside one): per class the vectors linked and a class reached."""
    part = part.drop_duplicates("class")
    first, second = part["b1"].iloc[0], part["b2"].iloc[0]
    a = np.flatnonzero(part["block"].to_numpy() == first)
    b = np.flatnonzero(part["block"].to_numpy() == second)
    none = pd.DataFrame({"class": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"),
                         "reached": pd.Series(dtype="int64")})
    if not len(a) or not len(b):
        return none
    rows = np.frombuffer(b"".join(part["unit"]), float).reshape(len(part), -1)
    i, j = np.nonzero(rows[a] @ rows[b].T >= threshold)
    i, j = a[i], b[j]
    once = i < j if first == second else slice(None)
    i, j = i[once], j[once]
    if not len(i):
        return none
    # A pair that shares several cells counts in the first of them only.
    width = max(map(len, part["cells"]))
    cells = np.array([[*c, *[-1] * (width - len(c))] for c in part["cells"]])
    here = int(part["cell"].iloc[0])
    shared = np.zeros(len(i), bool)
    for x in range(width):
        for y in range(width):
            same = (cells[i, x] == cells[j, y]) & (cells[i, x] >= 0) & (cells[i, x] < here)
            shared |= same
    i, j = i[~shared], j[~shared]
    many = part["n"].to_numpy()
    links = np.zeros(len(part), np.int64)
    np.add.at(links, i, many[j])
    np.add.at(links, j, many[i])
    root = local_roots(i, j, len(part))
    ids = part["class"].to_numpy()
    linked = links > 0
    return pd.DataFrame({"class": ids[linked], "links": links[linked], "reached": ids[root[linked]]})


def near_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
    threshold: float = 0.93, cell_rows: int = CELL_ROWS, nearest: int = CELLS, block: int = BLOCK,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per vector: id_col, n_links, component_id, kept.

    Vectors of the same label and length link when their cosine in double precision is ``threshold`` or more and
    they share one of their ``nearest`` cells; no pair below links. n_links counts the other rows linked directly,
    component_id is the smallest id that links reach, kept marks it. Vectors that take no part (see
    ``unit_vectors``) link with nothing. Repeated rows are vectors of their own; an empty table gives no rows.
    """
    rows = staged(unit_vectors(vectors, id_col=id_col, vector=vector, label=label), "unit-vectors")
    taking = rows.where("class is not null")
    classes = staged(
        taking.groupBy("label", "dim", "class").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.min("unit").alias("unit")), "vector-classes")
    centres = staged(fit_cells(classes, cell_rows=cell_rows, sample_rows=sample_rows), "vector-centres")
    placed = to_cells(classes.select("label", "dim", "class", "n", "unit"), centres, nearest)
    placed = placed.select("*", F.explode("cells").alias("cell"))
    placed = staged(placed, "vector-cells")
    key = ["label", "dim", "cell"]
    blocks = placed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = placed.join(blocks, key).select(
        *key, "class", "n", "unit", "cells", "blocks", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"))
    pairs = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        *key, "class", "n", "unit", "cells", "block", F.least("block", "other").alias("b1"),
        F.greatest("block", "other").alias("b2"))
    found = staged(
        pairs.groupBy(*key, "b1", "b2").applyInPandas(
            lambda part: _compare(part, threshold), "class long, links long, reached long"), "vector-links")
    roots = components(found.select(F.col("class").alias("a"), F.col("reached").alias("b")))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    known = classes.select("class", "least", "n").join(links, "class", "left").join(
        roots.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "class").alias("root"))
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "root").select("class", "n_links", "component_id")
    out = rows.select("id", "class").join(known, "class", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
