"""Near-duplicate embeddings by lattice hashing on E8.

A table projects the unit vectors to a few groups of eight random dimensions
and decodes each group to its nearest point of the E8 lattice; the points are
the vector's cell. A vector also probes the neighbouring cells whose
lattice points come next. Tables whose cells two vectors share, directly or by
a probe, propose the pair, and the exact cosine in double precision decides.

A cell never emits its pairs: its task links its vectors with a union-find and
emits a spanning forest, so a cell of m vectors gives m - 1 rows. Components
follow from these links, and the direct links of each vector are counted inside
its component, block by block. Equal vectors are one member with a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import connected_components, materialize
from tripdemand.llm.ngram_join import BLOCK_PAIRS, UnionFind, _runs
from tripdemand.llm.text_hash import mix64


def decode_d8(y: np.ndarray) -> np.ndarray:
    """Nearest point of D8 (integers of even sum): the coordinate rounded worst goes the other way."""
    x = np.rint(y)
    odd = np.flatnonzero(x.sum(axis=1) % 2 != 0)
    if len(odd):
        d = y[odd] - x[odd]
        worst = np.abs(d).argmax(axis=1)
        x[odd, worst] += np.where(d[np.arange(len(odd)), worst] >= 0, 1, -1)
    return x


def decode_e8(y: np.ndarray) -> np.ndarray:
    """Nearest point of E8 = D8 united with D8 + (1/2, ..., 1/2)."""
    a, b = decode_d8(y), decode_d8(y - 0.5) + 0.5
    near = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(near[:, None], a, b)


def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        s = np.array([1 - 2 * (bits >> k & 1) for k in range(8)])
        if (s < 0).sum() % 2 == 0:
            out.append(s / 2)
    return np.array(out)


class LatticeTable:
    """One hash table: ``groups`` random projections to eight dimensions, scaled by ``scale``."""

    def __init__(self, dim: int, groups: int, scale: float, seed: int):
        rng = np.random.default_rng(seed)
        self.groups = groups
        self.planes = rng.normal(0, scale, (dim, 8 * groups))
        self.shift = rng.uniform(0, 2, 8 * groups)
        self.coef = rng.integers(1, 1 << 62, 8 * groups, dtype=np.uint64) | np.uint64(1)

    def cells(self, unit: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each vector's cell, hashes of its ``probes`` nearest neighbouring cells)."""
        y = unit @ self.planes + self.shift
        home = np.zeros(len(y), np.uint64)
        costs, keys = [], []
        steps = e8_neighbours()
        parts = []
        for g in range(self.groups):
            at = slice(8 * g, 8 * g + 8)
            point = decode_e8(y[:, at])
            part = (2 * point).astype(np.int64).view(np.uint64) * self.coef[at]
            parts.append(part.sum(axis=1, dtype=np.uint64))
            home = home + parts[-1]
            rest = y[:, at] - point
            # a step to the neighbour point + v changes the squared distance by |v|^2 - 2 <rest, v>
            costs.append(2.0 - 2.0 * rest @ steps.T)
            keys.append(((2 * steps).astype(np.int64).view(np.uint64) * self.coef[at]).sum(axis=1, dtype=np.uint64))
        cost = np.concatenate(costs, axis=1)
        best = np.argpartition(cost, probes, axis=1)[:, :probes] if probes else np.empty((len(y), 0), np.int64)
        moved = home[:, None] + np.concatenate(keys)[best]
        return mix64(home), mix64(moved)


def _unit(rows) -> np.ndarray:
    """Unit vectors in double precision; shorter ones are padded with zeros (vectors that are
    compared with each other have one length: a cell's hash depends on it)."""
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    x = np.zeros((len(rows), size.max()))
    x[np.arange(x.shape[1]) < size[:, None]] = np.concatenate([np.asarray(r, np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _linked(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    return x @ y.T >= cosine


def lattice_near_dedup(vectors: DataFrame, cosine: float = 0.9, tables: int = 10, groups: int = 4,
                       scale: float = 0.35, probes: int = 20, block: int = 2048) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Null, empty, all-zero vectors and those with null or non-finite components link with
    nothing: 0 links, their own component, kept. Vectors of different length
    never link. Repeated rows (the same vec_id and vector) give a row each and
    link with each other. Null vec_ids are never a component's smallest id; if all
    are null the component_id is null and kept is false. Other columns are ignored; an empty table
    gives an empty result.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("v"))
    # components travel as given and are compared in double precision
    fine = F.coalesce((F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                      & F.exists("v", lambda x: x != 0.0), F.lit(False))
    rows = rows.withColumn("key", F.when(fine, F.xxhash64("v"))).withColumn("key2", F.when(fine, F.hash("v")))
    rows = materialize(rows, "lattice-rows")
    classes = materialize(rows.where("key is not null").groupBy("key", "key2", "v").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("node", F.xxhash64("key", "key2")).drop("key", "key2"), "lattice-classes")

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, list[LatticeTable]] = {}
        for pdf in batches:
            size = pdf["v"].map(len).to_numpy()
            for dim in np.unique(size):
                part = pdf[size == dim]
                unit, node = _unit(part["v"]), part["node"].to_numpy()
                if dim not in made:
                    made[dim] = [LatticeTable(int(dim), groups, scale, 1000 + t) for t in range(tables)]
                for t, table in enumerate(made[dim]):
                    home, near = table.cells(unit, probes)
                    salt = mix64(np.array([int(dim) * 64 + t], np.uint64))
                    yield pd.DataFrame({"cell": np.concatenate([home, near.ravel()]).view(np.int64) ^ salt.view(np.int64),
                                        "node": np.concatenate([node, np.repeat(node, near.shape[1])]),
                                        "home": np.arange(len(node) * (1 + near.shape[1])) < len(node)})

    at = materialize(classes.select("node", "v").mapInPandas(cells, "cell long, node long, home boolean"), "lattice-cells")
    # only cells where a vector at home meets another one; the vectors travel to those alone
    met = at.groupBy("cell").agg(F.count("*").alias("m"), F.max("home").alias("home")).where("home and m > 1") \
        .select("cell", F.ceil(F.col("m") / block).cast("int").alias("nb"))
    members = at.join(met, "cell").join(classes.select("node", "v"), "node") \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")) \
        .withColumn("t", F.explode(F.expr(BLOCK_PAIRS))) \
        .select("cell", "t.i", "t.j", "block", "home", "node", "v") \
        .repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "node")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["cell", "i", "j"], 4096):
            cell = run[["cell", "i", "j"]].to_numpy()
            unit = _unit(run["v"])
            node, block_of, home = (run[c].to_numpy() for c in ("node", "block", "home"))
            start = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]).any(axis=1)]))
            out: list[tuple[int, int]] = []
            for s, e in zip(start, np.append(start[1:], len(run))):
                near = _linked(unit[s:e], unit[s:e], cosine)
                near &= home[s:e, None] | home[None, s:e]
                if cell[s, 1] != cell[s, 2]:
                    near &= block_of[s:e, None] != block_of[None, s:e]
                a, b = np.nonzero(np.triu(near, 1))
                union = UnionFind(range(e - s))
                out += [(node[s + x], node[s + y]) for x, y in zip(a.tolist(), b.tolist())
                        if node[s + x] != node[s + y] and union.apart(x, y, True)]
            if out:
                yield pd.DataFrame(out, columns=["a", "b"]).drop_duplicates()

    links = members.mapInPandas(link, "a long, b long")
    component = materialize(connected_components(links), "lattice-components")
    sizes = component.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("nb"))
    # small components share a task's group; large ones are cut into pairs of blocks
    inside = component.join(sizes, "component").join(classes.select("node", "v", "copies"), "node") \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")) \
        .withColumn("t", F.explode(F.expr(BLOCK_PAIRS))) \
        .select("component", "t.i", "t.j", "block", "node", "copies", "v") \
        .repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["component", "i", "j"], 4096):
            group = run[["component", "i", "j"]].to_numpy()
            unit = _unit(run["v"])
            copies, block_of = run["copies"].to_numpy(), run["block"].to_numpy()
            start = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)]))
            n = np.zeros(len(run), np.int64)
            for s, e in zip(start, np.append(start[1:], len(run))):
                near = _linked(unit[s:e], unit[s:e], cosine)
                np.fill_diagonal(near, False)
                if group[s, 1] != group[s, 2]:
                    near &= block_of[s:e, None] != block_of[None, s:e]
                n[s:e] = near @ copies[s:e]
            yield pd.DataFrame({"node": run["node"].to_numpy(), "n": n})

    counted = inside.mapInPandas(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    known = materialize(classes.select("node", "first", "copies", "v").join(component, "node", "left").join(counted, "node", "left")
                        .select("v", "first", "copies", F.coalesce("component", "node").alias("component"),
                                F.coalesce("n", F.lit(0)).alias("n")), "lattice-known")
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = known.join(smallest, "component").select("v", "copies", "n", "component_id", F.lit(True).alias("found"))
    out = rows.join(known.withColumnRenamed("v", "w"), F.when(F.col("key").isNotNull(), F.col("v")) == F.col("w"), "left")
    own = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
