"""Near-duplicate vectors by sorted projection passes.

In each pass a vector's key is the concatenated signs of random projections. The vectors of one label are ordered
lexicographically by key, each is compared with the neighbours in a bounded window before it, and pairs of cosine
>= the threshold are united across passes. Windows are short where vectors are dense and end with their range partition, so
a few passes (PASSES) unite most vectors early. What is left is decided in cells, the runs of the order that share the first bits
of a key: all pairs of a cell that are not in one component yet are compared, in salted blocks. The number of cell passes
follows from these bits alone, so that a pair at the threshold is missed with probability MISS at most whatever
the density; a label of at most 2 * CELL vectors is one cell, compared whole.

Components then get exact link counts without listing pairs. Vectors within half the threshold's angle of their
component's pivot (its least id) are all linked with one another, by the triangle inequality on angles: they are
counted (a large component's merge joins are split where Spark finds them skewed). Only vectors farther out are compared with the rest of their component, block by block, each pair of blocks a task of
its own. Vectors travel as they are stored (floats as four bytes); cosines are computed in double precision.

Defined results: vectors that are null, empty or zero, or hold a null or non-finite component, and those without a
label, link with nothing; vectors of unlike length do not link; rows that repeat a vec_id are one vector, the sound one of
least label and components, and get one result row each; a null vec_id links with nothing and has a null component_id; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialize, partitions, read, small_batches
from tessera.llm.components import components

THRESHOLD = 0.93
#: Neighbours before a vector with which it is compared in each pass.
WIDTH = 32
#: Passes of sorted windows, sign bits in a key, and the chance to miss a pair at the threshold.
PASSES = 6
BITS = 48
MISS = 1e-4
#: Vectors in a block of the exact comparison.
BLOCK = 1024
#: Vectors in a cell if keys are evenly spread, the most in a block of a cell, and the rows compared at once.
CELL, CELL_BLOCK, STRIPE = 4096, 4096, 512


def cells_for(vectors: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Key bits of a cell, and the passes in which a pair at the threshold shares a cell once but for the chance to miss."""
    bits = int(math.log2(max(1.0, vectors / CELL)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, 1 if bits == 0 else math.ceil(math.log(miss) / math.log(1 - meet))


def sound_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the bytes of the vector, of vectors that can link."""
    fine = (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).where(fine)
    kind = stored_kind(vectors)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<float>" if kind == "f4" else "array<double>").alias("embedding")).alias("row"))

    def apply(batches):
        for batch in batches:
            label, lists = batch.column(1), batch.column(2)
            ends = lists.offsets.to_numpy() * int(kind[1])
            raw = lists.values.to_numpy(zero_copy_only=False).astype(kind).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), label, pa.array([raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())], ["vec_id", "label", "unit"])

    one = rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.embedding")
    return one.mapInArrow(apply, "vec_id long, label string, unit binary")


def stored_kind(vectors: DataFrame) -> str:
    return "f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "f8"


def unit_rows(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors of double precision from stored ones of one length."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def projection(number: int, dim: int, bits: int = BITS) -> np.ndarray:
    return np.random.default_rng([number, dim]).standard_normal((dim, bits))


def keyed(units: DataFrame, passes: int, kind: str, first: int = 0, carry: bool = True) -> DataFrame:
    """A row for each vector and pass from the first on: pass, label (with the dimension), key, vec_id and, to carry, the vector."""

    def apply(batches):
        planes: dict[int, np.ndarray] = {}
        weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        for batch in batches:
            raw = batch.column(2).to_pylist()
            sizes = np.array([len(x) // int(kind[1]) for x in raw])
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                if dim not in planes:
                    planes[dim] = np.concatenate([projection(k, int(dim)) for k in range(first, first + passes)], axis=1)
                x = unit_rows([raw[i] for i in rows], kind)
                keys = ((x @ planes[dim]) > 0).reshape(len(rows), passes, BITS) @ weights
                part = batch.take(pa.array(rows))
                label = pa.array([f"{name}/{dim}" for name in part.column(1).to_pylist()])
                for k in range(passes):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), first + k, np.int32)), label, pa.array(keys[:, k]), part.column(0), *([part.column(2)] if carry else [])], ["pass", "label", "key", "vec_id", *(["unit"] if carry else [])])

    return units.mapInArrow(apply, "pass int, label string, key long, vec_id long" + (", unit binary" if carry else ""))


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least index that each of n items reaches by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def neighbour_links(sorted_rows: DataFrame, kind: str, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """Verified links among window neighbours, as a spanning forest of each batch: a and b."""

    def apply(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([kept, batch] if kept is not None else [batch]).combine_chunks()
            kept = table.slice(max(0, table.num_rows - width)).combine_chunks().to_batches()[0]
            number, label = table.column("pass").to_numpy(), table.column("label").to_pylist()
            ids, raw = table.column("vec_id").to_numpy(), table.column("unit").to_pylist()
            group = np.unique([f"{p}/{name}" for p, name in zip(number, label)], return_inverse=True)[1]
            sizes = np.array([len(x) // int(kind[1]) for x in raw])
            lefts, rights = [], []
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x = unit_rows([raw[i] for i in rows], kind)
                for d in range(1, min(width, len(rows) - 1) + 1):
                    close = np.flatnonzero((np.einsum("ij,ij->i", x[d:], x[:-d]) >= threshold) & (group[rows[d:]] == group[rows[:-d]]))
                    lefts.append(rows[close])
                    rights.append(rows[close + d])
            if not lefts:
                continue
            left, right = np.concatenate(lefts), np.concatenate(rights)
            root = local_roots(len(ids), left, right)
            child = np.flatnonzero(root != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[child]), pa.array(ids[root[child]])], ["a", "b"])

    return sorted_rows.mapInArrow(apply, "a long, b long")


def cell_links(units: DataFrame, found: DataFrame, largest: int, kind: str, threshold: float = THRESHOLD) -> DataFrame:
    """Links a, b among all pairs of a cell that are of unlike components: rows outside a cell's largest component meet all others."""
    bits, passes = cells_for(largest, threshold)
    rows = keyed(units, passes, kind, carry=False).select("pass", "label", F.shiftrightunsigned("key", BITS - bits).alias("cell"), "vec_id")
    rows = rows.join(found.withColumnRenamed("vertex", "vec_id"), "vec_id", "left").withColumn("component", F.coalesce("component", "vec_id"))
    rows = materialize(rows, compact=True)
    cell = ["pass", "label", "cell"]
    parts = rows.groupBy(*cell, "component").agg(F.count("*").alias("n")).groupBy(*cell).agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"))
    placed = rows.join(parts.where("n > main.n").select(*cell, F.col("main.component").alias("main")), cell).withColumn("rest", F.col("component") != F.col("main")).drop("main")
    sizes = placed.groupBy(*cell, "rest").agg(F.ceil(F.count("*") / CELL_BLOCK).alias("blocks"))
    placed = placed.join(sizes, [*cell, "rest"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks")).drop("blocks")
    blocks = sizes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    one = blocks.where("rest").select(*cell, F.col("block").alias("b1"))
    met = one.join(blocks.select(*cell, F.col("block").alias("b2"), F.col("rest").alias("r2")), cell).where("NOT r2 OR b1 <= b2")
    met = met.withColumn("pair", F.xxhash64(*cell, "b1", "b2", "r2"))
    same = F.expr("r2 AND b1 = b2")
    lefts = met.select(*cell, F.lit(True).alias("rest"), F.col("b1").alias("block"), "pair", F.when(same, 2).otherwise(0).alias("side"))
    rights = met.where(~same).select(*cell, F.col("r2").alias("rest"), F.col("b2").alias("block"), "pair", F.lit(1).alias("side"))
    rows = placed.join(lefts.union(rights), [*cell, "rest", "block"]).select("pair", "side", "vec_id", "component").join(units.select("vec_id", "unit"), "vec_id")

    def compare(table: pa.Table) -> pa.Table:
        side, ids, component = (table.column(c).to_numpy() for c in ("side", "vec_id", "component"))
        x = unit_rows(table.column("unit").to_pylist(), kind)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        root, every = np.arange(len(ids)), np.arange(len(ids))
        for start in range(0, len(left), STRIPE):
            part = left[start : start + STRIPE]
            i, j = np.nonzero((x[part] @ x[right].T >= threshold) & (component[part][:, None] != component[right]))
            if len(i):  # the forest so far and the new links
                root = local_roots(len(ids), np.r_[every, part[i]], np.r_[root, right[j]])
        child = np.flatnonzero(root != every)
        return pa.table({"a": ids[child], "b": ids[root[child]]})

    return rows.groupBy("pair").applyInArrow(compare, "a long, b long")


def far_counts(members: DataFrame, sizes: DataFrame, kind: str, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id and its links with or as a vector far from its pivot; sizes has n_core and n_far of each component.

    Vectors meet by the pair of their blocks, so no component is gathered; a far block meets every block of its component.
    """
    place = ["component", "core", "block"]
    some = sizes.where("n_far > 0").select("component", F.ceil(F.col("n_core") / BLOCK).alias("core_blocks"), F.ceil(F.col("n_far") / BLOCK).alias("far_blocks"))
    placed = members.join(some.hint("merge"), "component").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.when(F.col("core"), F.col("core_blocks")).otherwise(F.col("far_blocks")))).drop("core_blocks", "far_blocks")
    numbers = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    far = some.select("component", "core_blocks", "far_blocks", F.explode(numbers("far_blocks")).alias("b1"))
    met = far.select("component", "b1", F.lit(True).alias("c2"), F.explode(numbers("core_blocks")).alias("b2")).union(far.select("component", "b1", F.lit(False), F.explode(F.sequence(F.col("b1"), F.col("far_blocks") - 1))))
    met = met.withColumn("pair", F.xxhash64("component", "b1", "c2", "b2"))
    same = F.expr("NOT c2 AND b1 = b2")
    lefts = met.select("component", F.lit(False).alias("core"), F.col("b1").alias("block"), "pair", F.when(same, 2).otherwise(0).alias("side"))
    rights = met.where(~same).select("component", F.col("c2").alias("core"), F.col("b2").alias("block"), "pair", F.lit(1).alias("side"))
    rows = placed.join(lefts.union(rights), place).select("pair", "side", "vec_id", "unit")

    def compare(table: pa.Table) -> pa.Table:
        side, ids = table.column("side").to_numpy(), table.column("vec_id").to_numpy()
        x = unit_rows(table.column("unit").to_pylist(), kind)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        close = (x[left] @ x[right].T >= threshold) & (ids[left][:, None] != ids[right])
        if len(side) and side[0] == 2:
            return pa.table({"vec_id": ids[left], "n": close.sum(1)})
        return pa.table({"vec_id": np.r_[ids[left], ids[right]], "n": np.r_[close.sum(1), close.sum(0)]})

    counted = rows.groupBy("pair").applyInArrow(compare, "vec_id long, n long")
    return counted.groupBy("vec_id").agg(F.sum("n").alias("far_links"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector."""
    spark = vectors.sparkSession
    small_batches(spark)
    kind = stored_kind(vectors)
    units = materialize(sound_vectors(vectors))
    largest = units.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    rows = keyed(units, PASSES, kind)
    order = ["pass", "label", "key", F.xxhash64("vec_id")]  # the last deals equal keys out
    ranged = rows.repartitionByRange(max(2, partitions(spark)), *order).sortWithinPartitions(*order)
    found = components(neighbour_links(ranged, kind, threshold))
    more = cell_links(units, found, largest, kind, threshold)
    found = components(found.select(F.col("vertex").alias("a"), F.col("component").alias("b")).union(more))

    members = found.join(units, F.col("vertex") == F.col("vec_id")).select("vec_id", "component", "unit")
    pivots = members.where("vec_id = component").select("component", F.col("unit").alias("pivot"))
    half = math.cos(math.acos(threshold) / 2) + 1e-9

    def angles(batches):
        for batch in batches:
            raw, pivot = batch.column("unit").to_pylist(), batch.column("pivot").to_pylist()
            sizes = np.array([len(x) for x in raw])
            core = np.zeros(len(raw), bool)
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                core[some] = np.einsum("ij,ij->i", unit_rows([raw[i] for i in some], kind), unit_rows([pivot[i] for i in some], kind)) >= half
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("component"), batch.column("unit"), pa.array(core)], ["vec_id", "component", "unit", "core"])

    members = materialize(members.join(pivots.hint("merge"), "component").select("vec_id", "component", "unit", "pivot").mapInArrow(angles, "vec_id long, component long, unit binary, core boolean"), compact=True)
    sizes = members.groupBy("component").agg(F.count_if("core").alias("n_core"), F.count_if(~F.col("core")).alias("n_far"))
    far = far_counts(members, sizes, kind, threshold)
    counts = members.select("vec_id", "component", "core").join(sizes.hint("merge"), "component").join(far, "vec_id", "left")
    links = F.when(F.col("core"), F.col("n_core") - 1).otherwise(0) + F.coalesce("far_links", F.lit(0))
    counts = counts.select("vec_id", "component", links.alias("links"))

    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(counts, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), n AS (
  SELECT a, count(*) AS n_links FROM p GROUP BY a
), r AS (
  WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM p UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a) SELECT a, min(b) AS c FROM reach GROUP BY a
)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c, e.vec_id)) AS component_id, e.vec_id <= coalesce(c, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN r ON r.a = e.vec_id
"""
