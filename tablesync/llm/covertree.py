"""Near-duplicate embeddings by dual traversal of cover trees.

Vectors with equal labels link if their cosine reaches a threshold. In angles, a metric, a node
covers its vectors within a radius of its centre; children's radii halve from level to level.
A pair of nodes is dropped if its centres are further apart than the threshold and both
radii, and taken whole if the threshold covers all of them; else their children are paired.
What is left at the leaves is compared exactly, in double precision.

The upper levels of the tree are tables. A cell of more than CELL vectors is split around centres
that a sample of it yields, but every vector is assigned, in chunks of bounded size. Pairs of
cells descend level by level in equi-joins on their parents. The vectors of each pair of
last cells meet in one task, which builds and traverses the lower levels; a cell has at most
CELL vectors there. Equal vectors are one weighted vector, and pairs of vectors never leave a
task: it returns counts and, as links, a forest.

A pair links vectors of equal label and length. A null, zero or empty vector, one with a null
or non-finite component, and a row without label or id link with nothing. Rows that share
an id are one vertex of the links.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column, components, runs

CELL = 2048
SAMPLE = 512  # vectors of a cell among which its children's centres are chosen
MOST_CHILDREN = 128
LEVELS = 10
LEAF = 32
SLACK = 1e-6  # radians by which bounds give way to rounding


def _unit_rows(batch_column) -> list[bytes | None]:
    out = []
    for value in batch_column.to_pylist():
        unit = None
        if value is not None and len(value) and None not in value:
            x = np.array(value, dtype=np.float64)
            most = np.abs(x).max()
            if np.isfinite(most) and most > 0:
                x /= most
                unit = (x / math.sqrt(float(x @ x)) + 0.0).tobytes()
        out.append(unit)
    return out


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, vec): vec is the unit vector's doubles, null where the row links with nothing."""
    rows = vectors.select(column(id_col).alias("id"), column(label_col).cast("string").alias("label"),
                          column(vec_col).cast("array<double>").alias("vec"))

    def run(batches):
        for batch in batches:
            units = pa.array(_unit_rows(batch.column(2)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), units], ["id", "label", "vec"])

    schema = T.StructType([rows.schema["id"], T.StructField("label", T.StringType()), T.StructField("vec", T.BinaryType())])
    found = rows.mapInArrow(run, schema)
    usable = F.col("id").isNotNull() & F.col("label").isNotNull()
    return found.withColumn("vec", F.when(usable, F.col("vec")))


def _matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.float64).reshape(len(values), -1)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


# The lower levels: a tree in memory


class Tree:
    """A cover tree of the rows of x. Node k has members[k], centre[k] and radius[k]."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.members = [np.arange(len(x))]
        self.centre, self.radius = [0], [float(angles(x @ x[0]).max())]
        self.children: list[np.ndarray | None] = [None]
        level = [0]
        reach = math.pi / 2
        while level and reach > 1e-3:
            level = [child for node in level for child in self._split(node, reach)]
            reach /= 2

    def _split(self, node: int, reach: float) -> list[int]:
        """Children whose radius is at most reach: each takes what is left within it of its centre."""
        if len(self.members[node]) <= LEAF:
            return []
        if self.radius[node] <= reach:
            return [node]
        left, made = self.members[node], []
        while len(left):
            apart = angles(self.x[left] @ self.x[left[0]])
            apart[0] = 0.0
            near = apart <= reach
            made.append(len(self.members))
            self.members.append(left[near])
            self.centre.append(int(left[0]))
            self.radius.append(float(apart[near].max()))
            self.children.append(None)
            left = left[~near]
        self.children[node] = np.array(made)
        return made

    def below(self, node: int) -> np.ndarray:
        return np.array([node]) if self.children[node] is None else self.children[node]

    def of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centres, radii and sizes."""
        return (self.x[[self.centre[k] for k in nodes]], np.array([self.radius[k] for k in nodes]),
                np.array([len(self.members[k]) for k in nodes]))


class Links:
    """Links between two sets of weighted vectors: how much each is linked to, and who is joined."""

    def __init__(self, sizes: tuple[int, int], weights: tuple[np.ndarray, np.ndarray], same: bool):
        self.weights, self.same = weights, same
        self.counts = (np.zeros(sizes[0], np.int64), np.zeros(sizes[1], np.int64))
        self.shift = 0 if same else sizes[0]
        self.ends: list[np.ndarray] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Vectors a[i] of the first set link with b[i] of the second."""
        np.add.at(self.counts[0], a, self.weights[1][b])
        np.add.at(self.counts[1], b, self.weights[0][a])
        self.ends.append(np.stack([a, b + self.shift]))

    def join_all(self, a: np.ndarray, b: np.ndarray, own: bool) -> None:
        """All of a link with all of b; own: a and b are the same vectors, none links with itself."""
        if own:
            self.counts[0][a] += self.weights[0][a].sum() - self.weights[0][a]
        else:
            self.counts[0][a] += self.weights[1][b].sum()
            self.counts[1][b] += self.weights[0][a].sum()
        b = b + self.shift
        self.ends.append(np.stack([np.concatenate([a, np.full(len(b), a[0])]), np.concatenate([np.full(len(a), b[0]), b])]))

    def roots(self, n: int) -> np.ndarray:
        """For each vector the least one it is joined to."""
        root = np.arange(n)
        if not self.ends:
            return root
        a, b = np.concatenate(self.ends, axis=1)
        while True:
            least = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, root[a], least)
            np.minimum.at(root, root[b], least)
            while (root[root] != root).any():
                root = root[root]
            if (root == before).all():
                return root


def traverse(first: Tree, second: Tree, links: Links, threshold: float) -> None:
    """Find all links between two trees; between a tree and itself each pair is met once."""
    limit, same = math.acos(threshold), first is second
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        ma, mb, own = first.members[a], second.members[b], same and a == b
        if (first.children[a] is None and second.children[b] is None) or len(ma) * len(mb) <= LEAF * LEAF:
            i, j = np.nonzero(first.x[ma] @ second.x[mb].T >= threshold)
            if own:
                i, j = i[i < j], j[i < j]
            links.join(ma[i], mb[j])
            continue
        ka, kb = first.below(a), second.below(b)
        (ca, ra, na), (cb, rb, nb) = first.of(ka), second.of(kb)
        for at in range(0, len(ka), 512):
            rows = slice(at, at + 512)
            cosines = ca[rows] @ cb.T
            apart, radii = angles(cosines), ra[rows, None] + rb[None, :]
            if own:  # a node's distance to itself
                k = np.arange(at, min(at + 512, len(ka)))
                apart[k - at, k] = 0.0
            close = apart - radii <= limit + SLACK
            if own:
                close &= np.arange(len(kb))[None, :] >= np.arange(at, at + len(apart))[:, None]
            single = close & ((na[rows, None] == 1) & (nb[None, :] == 1))
            i, j = np.nonzero(single & (cosines >= threshold))
            if own:
                i, j = i[i + at != j], j[i + at != j]
            if len(i):
                links.join(np.array([first.centre[k] for k in ka[i + at]]), np.array([second.centre[k] for k in kb[j]]))
            whole = close & ~single & (apart + radii <= limit - SLACK)
            for i, j in zip(*np.nonzero(whole), strict=True):
                links.join_all(first.members[ka[i + at]], second.members[kb[j]], own and i + at == j)
            for i, j in zip(*np.nonzero(close & ~single & ~whole), strict=True):
                todo.append((int(ka[i + at]), int(kb[j])))


def linked(x: np.ndarray, wx: np.ndarray, y: np.ndarray | None, wy: np.ndarray | None, threshold: float) -> tuple:
    """Counts for the rows of x and of y, and the least row each is joined to, y's after x's.

    Without y, x is compared with itself.
    """
    first = Tree(x)
    second = first if y is None else Tree(y)
    links = Links((len(x), len(second.x)), (wx, wx if y is None else wy), y is None)
    traverse(first, second, links, threshold)
    if y is None:
        return links.counts[0] + links.counts[1], None, links.roots(len(x))
    return links.counts[0], links.counts[1], links.roots(len(x) + len(y))


# The upper levels: tables


POINT = "cell string, rep long, print long, n long, vec binary"


def _centres(reach: float):
    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        """Centres of a cell's children among a sample: the farthest vector next, until all are within reach."""
        frame = frame.sort_values(["rep", "print"])
        x, most = _matrix(frame["vec"].tolist()), int(frame["children"].iloc[0])
        chosen, apart = [0], angles(x @ x[0])
        while len(chosen) < most and apart.max() > reach:
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, angles(x @ x[chosen[-1]]))
        centres = [frame["vec"].iloc[i] for i in chosen]
        return pd.DataFrame({"cell": frame["cell"].iloc[0], "k": range(len(chosen)), "centre": centres})

    return choose


def _assigned(points: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
    centres = centres.sort_values("k")
    cosines = _matrix(points["vec"].tolist()) @ _matrix(centres["centre"].tolist()).T
    nearest = cosines.argmax(axis=1)
    out = points[["rep", "print", "n", "vec"]].copy()
    out["cell"] = points["cell"] + "/" + pd.Series(centres["k"].to_numpy()[nearest], index=points.index).astype(str)
    out["apart"] = angles(cosines.max(axis=1))
    return out[["cell", "rep", "print", "n", "vec", "apart"]]


def _levels(points: DataFrame, scratch: Scratch, limit: float) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Points in cells of at most CELL, the (parent, cell, centre, radius) of each level, and the roots."""
    roots, _ = scratch.save(points.select("cell").distinct(), "roots")
    levels: list[DataFrame] = []
    info = roots.withColumns({"centre": F.lit(None).cast("binary"), "radius": F.lit(math.pi)})
    reach = math.pi / 2
    for _ in range(LEVELS):
        sizes = points.groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > CELL)
        # A cell within half the threshold is taken whole, whatever its size.
        big = sizes.join(info.where(F.col("radius") > limit / 2 - SLACK).select("cell"), "cell")
        big, _ = scratch.save(big, "big")
        if big.isEmpty():
            break
        children = F.least(F.lit(MOST_CHILDREN), F.ceil(F.col("size") / CELL * 2)).cast("int")
        rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("print"), "rep"))
        sample = points.join(big, "cell").withColumn("rank", rank).where(F.col("rank") <= SAMPLE)
        sample = sample.select("cell", "rep", "print", "vec", children.alias("children"))
        centres = sample.groupBy("cell").applyInPandas(_centres(reach), "cell string, k int, centre binary")
        centres, _ = scratch.save(centres, "centres")
        chunks = F.ceil(F.col("size") / (4 * CELL)).cast("int")
        split = points.join(big, "cell").withColumn("chunk", F.pmod(F.xxhash64("print"), chunks).cast("int"))
        copies = centres.join(big, "cell").select(
            F.col("cell").alias("of"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("part"), "k", "centre")
        moved = split.groupBy("cell", "chunk").cogroup(copies.groupBy("of", "part")).applyInPandas(
            _assigned, POINT + ", apart double")
        rest = points.join(big, "cell", "left_anti").withColumn("apart", F.lit(None).cast("double"))
        points, _ = scratch.save(moved.unionByName(rest), "points")
        radius = points.where("apart is not null").groupBy("cell").agg(F.max("apart").alias("radius"))
        named = centres.select(F.col("cell").alias("parent"), F.concat_ws("/", "cell", "k").alias("cell"), "centre")
        level, _ = scratch.save(named.join(radius, "cell").select("parent", "cell", "centre", "radius"), "level")
        levels.append(level)
        info, _ = scratch.save(info.join(big, "cell", "left_anti").unionByName(level.drop("parent")), "info")
        points = points.drop("apart")
        reach /= 2
    sizes = points.groupBy("cell").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts")).where("parts > 1")
    sizes, _ = scratch.save(sizes, "large")
    if not sizes.isEmpty():
        # Too dense to split further by distance: by a hash, with the same centre and radius.
        part = F.concat_ws("#", "cell", F.pmod(F.xxhash64("print"), F.col("parts")).cast("string"))
        points = points.join(sizes, "cell", "left").withColumn("cell", F.when(F.col("parts").isNull(), F.col("cell")).otherwise(part)).drop("parts")
        points, _ = scratch.save(points, "points")
        parts = info.join(sizes, "cell").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        levels.append(parts.select(F.col("cell").alias("parent"), F.concat_ws("#", "cell", F.col("k").cast("string")).alias("cell"), "centre", "radius"))
    return points, levels, roots


def _apart(a: pd.Series, b: pd.Series) -> pd.Series:
    """The angle between two centres; 0 if one is unknown."""
    known = a.notna() & b.notna()
    out = pd.Series(0.0, index=a.index)
    if known.any():
        out[known] = [float(angles(np.frombuffer(p) @ np.frombuffer(q))) for p, q in zip(a[known], b[known], strict=True)]
    return out


def _cell_pairs(levels: list[DataFrame], roots: DataFrame, scratch: Scratch, limit: float) -> DataFrame:
    """Pairs (a, b, whole) of last cells that may hold links; whole: all of both link."""
    apart_of = F.pandas_udf(_apart, T.DoubleType())
    pairs = roots.select(F.col("cell").alias("a"), F.col("cell").alias("b"), F.lit(False).alias("whole"))
    for level in levels:
        sides = []
        for side in ("a", "b"):
            sides.append(level.select(F.col("parent").alias(f"p{side}"), F.col("cell").alias(f"c{side}"),
                                      F.col("centre").alias(f"z{side}"), F.col("radius").alias(f"r{side}")))
        down = pairs.join(sides[0], F.col("a") == F.col("pa"), "left").join(sides[1], F.col("b") == F.col("pb"), "left")
        a, b = F.coalesce("ca", "a"), F.coalesce("cb", "b")
        once = (F.col("a") != F.col("b")) | (a <= b)
        apart = F.when(a == b, F.lit(0.0)).otherwise(apart_of("za", "zb"))
        down = down.where(once).select(a.alias("x"), b.alias("y"), apart.alias("apart"), "ra", "rb", "whole",
                                       (F.col("ra").isNull() & F.col("rb").isNull()).alias("still"))
        known = F.col("ra").isNotNull() & F.col("rb").isNotNull()
        radii = F.col("ra") + F.col("rb")
        far = known & (F.col("apart") - radii > limit + SLACK)
        whole = F.when(F.col("still"), F.col("whole")).otherwise(known & (F.col("apart") + radii <= limit - SLACK))
        pairs, _ = scratch.save(down.where(~far).select(F.col("x").alias("a"), F.col("y").alias("b"), whole.alias("whole")), "pairs")
    return pairs


def _compared(points: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(rep, print, n_links, root) from every pair of cells: what it adds to a vector's links, and
    the rep that the vector is joined to."""
    pairs = pairs.where(~F.col("whole")).withColumn("pair", F.xxhash64("a", "b")).select("a", "b", "pair")
    one = points.join(pairs, points["cell"] == pairs["a"]).withColumn("side", F.lit(0))
    two = points.join(pairs.where("a <> b"), points["cell"] == pairs["b"]).withColumn("side", F.lit(1))
    rows = one.unionByName(two).select("pair", F.xxhash64("a").alias("ha"), F.xxhash64("b").alias("hb"), "side", "rep", "print", "n", "vec")
    keys = ["pair", "ha", "hb"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "side", "rep", "print")

    def run(batches):
        for group in runs(batches, keys):
            side = group.column("side").to_numpy()
            rep, mark, weight = (group.column(c).to_numpy() for c in ("rep", "print", "n"))
            x = _matrix(group.column("vec").to_pylist())
            m = int((side == 0).sum())
            if m == len(side):
                counts, _, root = linked(x, weight, None, None, threshold)
            else:
                first, second, root = linked(x[:m], weight[:m], x[m:], weight[m:], threshold)
                counts = np.concatenate([first, second])
            rows = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[rows]), pa.array(mark[rows]), pa.array(counts[rows]), pa.array(rep[root[rows]])],
                ["rep", "print", "n_links", "root"])

    return rows.mapInArrow(run, "rep long, print long, n_links long, root long")


def _whole(points: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same from the pairs of cells that link whole."""
    cells = points.groupBy("cell").agg(F.sum("n").alias("w"), F.min("rep").alias("least"))
    whole = pairs.where("whole").select("a", "b")
    ends = whole.select(F.col("a").alias("cell"), F.col("b").alias("other")).union(whole.where("a <> b").select("b", "a"))
    others = cells.select(F.col("cell").alias("other"), F.col("w").alias("ow"), F.col("least").alias("oleast"))
    gains = ends.join(others, "other").groupBy("cell").agg(
        F.sum("ow").alias("gain"), F.min("oleast").alias("root"), F.max(F.col("cell") == F.col("other")).alias("own"))
    rows = points.join(gains, "cell")
    n = F.col("gain") - F.when(F.col("own"), F.col("n")).otherwise(0)
    own = rows.select("rep", "print", n.alias("n_links"), "root")
    # Cells of a pair are joined to each other through their least reps.
    least = cells.select(F.col("cell").alias("c"), "least")
    bridges = ends.join(least, ends["cell"] == least["c"]).join(others, "other").select(
        F.col("least").alias("rep"), F.lit(None).cast("long").alias("print"), F.lit(0).cast("long").alias("n_links"), F.col("oleast").alias("root"))
    return own.union(bridges)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept).

    n_links counts the other rows that a row links with directly, component_id is the smallest
    id that links reach, the row's own included, and kept says whether the two ids are equal.
    Equal and parallel vectors link. A null id has no component and isn't kept. Other columns
    are neither read nor returned. An empty table gives no rows. Ids are whole numbers.
    """
    scratch = Scratch(vectors.sparkSession, "covertree")
    limit = math.acos(threshold)
    rows = unit_vectors(vectors, id_col, vec_col, label_col)
    rows, _ = scratch.save(rows.withColumn("print", F.xxhash64("label", "vec")), "rows")
    # Labels and lengths that differ are never compared: each is a root cell.
    root = F.concat_ws("|", F.octet_length("vec").cast("string"), F.sha2(F.col("label").cast("binary"), 256))
    points = rows.where("vec is not null").groupBy(root.alias("cell"), "print", "vec").agg(
        F.min("id").cast("long").alias("rep"), F.count("*").alias("n"))
    points, _ = scratch.save(points.select("cell", "rep", "print", "n", "vec"), "points")
    cells, levels, roots = _levels(points, scratch, limit)
    pairs = _cell_pairs(levels, roots, scratch, limit)
    found, _ = scratch.save(_compared(cells, pairs, threshold).union(_whole(cells, pairs)), "found")
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    groups, _ = scratch.save(groups, "groups")

    counts = found.where("print is not null").groupBy("rep", "print").agg(F.sum("n_links").alias("linked"))
    classes = points.drop("cell").join(counts, ["rep", "print"], "left").join(groups, points["rep"] == groups["node"], "left")
    classes = classes.select(F.col("vec").alias("v"), F.col("print").alias("p"), (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                             F.coalesce("component", "rep").alias("component"))
    out = rows.join(classes, (F.col("print") == F.col("p")) & (F.col("vec") == F.col("v")), "left")
    component = F.coalesce(F.col("component").cast(rows.schema["id"].dataType), F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
