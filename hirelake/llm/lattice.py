"""Operator 13, embedding near-dedup: E8 lattice hashing with multi-probe tables.

A table turns vectors by a random rotation, scales them and decodes four blocks
of eight coordinates to the nearest points of the E8 lattice; the four points
name a cell.  A vector is kept in its own cell and also asks the cells whose
boundary it almost touches.  Vectors that meet in a cell are compared whole, in
tiles, by their cosine.

Cells only have to connect near copies: the links of a vector are counted
afterwards by comparing its whole component with itself, tile by tile, so a
link inside a component counts even where no table found that pair.  Equal
vectors are one class throughout, and no pair of vectors is ever a row.
"""
from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, functions as F

from hirelake.llm.common import read, written
from hirelake.llm.components import components
from hirelake.llm.simhash import _union

BLOCKS = 4
#: Of 20,000 random pairs of 64 components at cosine 0.98 exactly, 9 meet in no cell of these tables; at 0.985, none.
TABLES, CELL, MARGIN = 5, 0.35, 0.05
TILE = 1024


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors of E8, which are also the normals of its cells."""
    pairs = [(i, j, a, b) for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    whole = np.zeros((len(pairs), 8))
    for row, (i, j, a, b) in zip(whole, pairs):
        row[i], row[j] = a, b
    signs = np.array(list(itertools.product((0.5, -0.5), repeat=8)))
    return np.concatenate((whole, signs[(signs < 0).sum(axis=1) % 2 == 0]))


def e8_second(roots: np.ndarray) -> np.ndarray:
    """The 2160 vectors of norm four: sums of two roots at right angles."""
    i, j = np.nonzero(np.triu(np.isclose(roots @ roots.T, 0)))
    return np.unique(roots[i] + roots[j], axis=0)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def e8_decode(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8 (the even-sum integers, and the same moved by a half)."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


class Hasher:
    """Cell keys of vectors of one length, for all tables."""

    def __init__(self, dim: int, tables: int, cell: float, margin: float, seed: int = 42):
        self.wide = max(dim, 8 * BLOCKS)
        rng = np.random.default_rng([seed, dim])
        self.turns = [np.linalg.qr(rng.normal(size=(self.wide, 8 * BLOCKS)))[0] for _ in range(tables)]
        self.shifts = rng.random((tables, 8 * BLOCKS))
        self.factors = rng.integers(0, 1 << 63, size=(tables, BLOCKS, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.size = cell * 8 / self.wide ** 0.5  # cells follow the usual length of a projection
        self.margin = margin
        self.roots = e8_roots()
        self.second = e8_second(self.roots)

    def keys(self, points: np.ndarray, factors: np.ndarray) -> np.ndarray:
        return ((2 * points).astype(np.int64).astype(np.uint64) * factors).sum(axis=1, dtype=np.uint64)

    def _around(self, x: np.ndarray, factors: np.ndarray):
        """Own keys; then (row, key, squared distance) of the other cells within the margin."""
        own = e8_decode(x)
        off = x - own
        row, k = np.nonzero(off @ self.roots.T >= 1 - self.margin * 2 ** 0.5)
        steps = self.roots[k]
        far = np.flatnonzero((off ** 2).sum(axis=1) >= (1 - self.margin) ** 2)
        r2, k2 = np.nonzero(off[far] @ self.second.T >= 2 - 2 * self.margin)
        row, steps = np.concatenate((row, far[r2])), np.concatenate((steps, self.second[k2]))
        gap = np.maximum(((off[row] - steps) @ self.roots.T).max(axis=1, initial=1) - 1, 0) / 2 ** 0.5
        near = gap <= self.margin
        row, steps, gap = row[near], steps[near], gap[near]
        return self.keys(own, factors), row, self.keys(own[row] + steps, factors), gap ** 2

    def cells(self, unit: np.ndarray, table: int):
        """(own keys; row and key of every cell to ask) in one table."""
        n = len(unit)
        turn = self.turns[table][:unit.shape[1]]
        x = unit @ turn / self.size + self.shifts[table]
        own, rows, keys, gaps = np.zeros(n, np.uint64), np.arange(n), np.zeros(n, np.uint64), np.zeros(n)
        for b in range(BLOCKS):
            home, r, k, g = self._around(x[:, 8 * b:8 * b + 8], self.factors[table, b])
            own += home
            r, k, g = np.concatenate((np.arange(n), r)), np.concatenate((home, k)), np.concatenate((np.zeros(n), g))
            order = np.argsort(r, kind="stable")
            k, g, many = k[order], g[order], np.bincount(r, minlength=n)
            first, each = np.cumsum(many) - many, many[rows]
            left = np.repeat(np.arange(len(rows)), each)
            right = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first[rows], each)
            total = gaps[left] + g[right]
            fits = total <= self.margin ** 2
            left, right = left[fits], right[fits]
            rows, keys, gaps = rows[left], keys[left] + k[right], total[fits]
        other = keys != own[rows]
        return own, rows[other], keys[other]


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times a power of two each (which changes no cosine), and their lengths."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x, np.sqrt((x * x).sum(axis=1))


def linked(x, nx, y, ny, least: float) -> np.ndarray:
    return x @ y.T >= least * (nx[:, None] * ny[None, :])


def _vectors(column) -> np.ndarray:
    """A list column without nulls, all of one length, as rows of doubles."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _tile(cell) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    items = cell.values
    x, nx = scaled(_vectors(items.field("v")))
    return items.field("cls").to_numpy(zero_copy_only=False), items.field("m").to_numpy(zero_copy_only=False), x, nx


def _tiled_pairs(members: DataFrame, cells: list[str], classes: DataFrame, name: str) -> DataFrame:
    """(left, right) tiles to compare: every home tile of a cell with itself (right null) and the later home
    tiles, every asking tile with every home tile.  ``members``: cells, ``asks``, ``cls``."""
    sizes = written(members.groupBy(*cells).agg(F.count_if(~F.col("asks")).alias("n"), F.count_if("asks").alias("q"))
                    .where("n > 1 or (n > 0 and q > 0)"), name + "_sizes")
    tile = lambda n: F.pmod(F.xxhash64("cls"), F.ceil(F.col(n) / TILE)).cast("int")
    dealt = (members.join(sizes, cells).withColumn("tile", F.when(F.col("asks"), tile("q")).otherwise(tile("n")))
             .select(*cells, "n", "asks", "tile", "cls"))
    tiles = written(dealt.join(classes.select("cls", "m", "v"), "cls").groupBy(*cells, "n", "asks", "tile")
                    .agg(F.collect_list(F.struct("cls", "m", "v")).alias("items")), name + "_tiles")
    last = (F.ceil(F.col("n") / TILE) - 1).cast("int")
    left = (tiles.select(*cells, "asks", F.col("tile").alias("tile1"), F.col("items").alias("left"),
                         F.explode(F.sequence(F.when(F.col("asks"), 0).otherwise(F.col("tile")), last)).alias("tile2")))
    right = tiles.where("not asks").select(*cells, F.col("tile").alias("tile2"), F.col("items").alias("right"))
    same = ~F.col("asks") & (F.col("tile1") == F.col("tile2"))
    pairs = left.join(right, [*cells, "tile2"]).withColumn("right", F.when(~same, F.col("right")))
    wide = max(12, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return pairs.repartition(wide, *cells, "asks", "tile1", "tile2").select("left", "right")


def _compared(pairs: DataFrame, least: float, forest: bool) -> DataFrame:
    """(a, b): a spanning forest of the links between two tiles, or else class ``a`` and the number ``b`` of rows linked to it."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = _tile(batch.column(0)[i])
                two = _tile(batch.column(1)[i]) if batch.column(1)[i].is_valid else None
                cls, m, x, nx = one
                other = two or one
                hits = linked(x, nx, other[2], other[3], least)
                if two is None:
                    np.fill_diagonal(hits, False)
                if forest:
                    both = cls if two is None else np.concatenate((cls, other[0]))
                    a, b = np.nonzero(hits)
                    label = _union(np.arange(len(both)), a, b + (0 if two is None else len(cls))) if len(a) else np.arange(len(both))
                    moved = np.flatnonzero(label != np.arange(len(both)))
                    out = both[moved], both[label[moved]]
                else:
                    n = hits @ other[1]
                    out = (cls, n) if two is None else (np.concatenate((cls, other[0])), np.concatenate((n, m @ hits)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def near_vectors(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", tables: int = TABLES, cell: float = CELL, margin: float = MARGIN) -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id``, ``kept``.

    Rows link when their labels are equal and not null, their vectors have the
    same length and a cosine of at least ``least`` (double precision).  Vectors
    that are null, empty or zero, or hold a null or a non-finite component, and
    rows without a label, link with nothing and keep their own id.  Repeated
    rows and equal vectors link with each other and each counts; a null id never
    names a component that has another id.  Other columns are ignored.
    """
    i, v = F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("v")
    rows = vectors.select(i, F.col(f"`{label_col}`").alias("label"), v)
    finite = F.coalesce(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(finite & F.col("label").isNotNull(), F.col("v")))
    classes = rows.where("v is not null").groupBy("label", "v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("m"))
    group = F.to_json(F.struct(F.col("label").alias("label"), F.size("v").alias("n")))
    classes = written(classes.select("*", group.alias("grp"), F.monotonically_increasing_id().alias("cls")), "vector_classes")

    def keys(batches):
        import pyarrow as pa

        hashers = {}
        for batch in batches:
            grp, size = batch.column(1), batch.column(3).to_numpy(zero_copy_only=False)
            for dim in np.unique(size).tolist():
                for at in np.array_split(np.flatnonzero(size == dim), -(-batch.num_rows // 4096)):
                    if not len(at):
                        continue
                    if dim not in hashers:
                        hashers[dim] = Hasher(dim, tables, cell, margin)
                    x, nx = scaled(_vectors(batch.column(2).take(pa.array(at))))
                    for t in range(tables):
                        own, row, asked = hashers[dim].cells(x / nx[:, None], t)
                        pick = pa.array(np.concatenate((at, at[row])))
                        yield pa.RecordBatch.from_arrays(
                            [grp.take(pick), pa.array(np.full(len(pick), t, np.int32)), pa.array(np.concatenate((own, asked)).view(np.int64)),
                             pa.array(np.arange(len(pick)) >= len(at)), batch.column(0).take(pick)], names=["grp", "t", "cell", "asks", "cls"])

    cells = written(classes.select("cls", "grp", "v", F.size("v").alias("n"))
                    .mapInArrow(keys, "grp string, t int, cell bigint, asks boolean, cls bigint"), "cells")
    found = _compared(_tiled_pairs(cells, ["grp", "t", "cell"], classes, "cell"), least, True)
    roots = written(components(written(found.distinct(), "vector_links")), "vector_roots")
    inside = roots.select("root", F.lit(False).alias("asks"), F.col("node").alias("cls"))
    counts = _compared(_tiled_pairs(inside, ["root"], classes, "component"), least, False).groupBy("a").agg(F.sum("b").alias("linked"))
    heads = (roots.join(classes, F.col("node") == F.col("cls")).groupBy("root").agg(F.min("least").alias("head")))
    named = (roots.join(heads, "root").join(counts, F.col("node") == F.col("a"), "left")
             .select(F.col("node").alias("cls"), "head", "linked"))
    full = written(classes.join(named, "cls", "left")
                   .select(F.col("label").alias("l"), F.col("v").alias("w"), F.coalesce("head", "least").alias("head"),
                           (F.col("m") - 1 + F.coalesce("linked", F.lit(0))).alias("linked")), "vector_groups")
    out = rows.join(full, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")), "left")
    component = F.when(F.col("w").isNull(), F.col("id")).otherwise(F.col("head"))
    return out.select(F.col("id").alias(id_col), F.coalesce("linked", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op13_lattice(spark, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH RECURSIVE rows_ AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
  SELECT * FROM rows_ WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, x -> x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, x -> x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) >= 0.98 * (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)))),
reach AS (SELECT r, r AS other FROM rows_ UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.other = links.a),
heads AS (SELECT reach.r, min(o.vec_id) AS component_id FROM reach JOIN rows_ o ON o.r = reach.other GROUP BY reach.r)
SELECT x.vec_id, (SELECT count(*) FROM links WHERE links.a = x.r) AS n_links, heads.component_id,
       x.vec_id IS NOT DISTINCT FROM heads.component_id AS kept
FROM rows_ x JOIN heads ON heads.r = x.r
"""
