"""Near-duplicate vectors by collision counting on sorted one-dimensional projections.

Every vector, scaled to length one, is projected on ``m`` random directions. Two vectors collide on
a projection if each lies in the window of half width ``w`` centred at the other. A pair is a
candidate if it collides on at least ``m - GROUPS + 1`` projections; the count is calibrated: for
pairs at the threshold itself the chance of reaching it is at least ``recall``, for closer pairs it
is higher. Candidates are linked if their cosine, in double precision, reaches the threshold.

Counting does not enumerate all pairs. The projections form ``GROUPS`` groups, and a pair that
misses fewer than ``GROUPS`` windows misses none in some group (pigeonhole), so per group only the
pairs in all of its windows are counted, and a pair belongs to the first such group. Rows are
dealt by label, group and cell: a cell halves a label at the medians of the group's first
projections, as often as the label's size asks, and a vector is also sent to the cells that its
windows reach. What a cell does not split far enough (many near copies) meets in chunks, each pair
of chunks a group by itself. In a cell the first projection is sorted and swept, the others thin
the pairs out. No pair is ever emitted: a cell returns one row per vector with its number of
links and the root of its local component. The cells, and so the chunks, never change the result.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, comb, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .jaccard import components
from .spelling import spread

GROUPS = 3
CELL = 8192            # vectors of a cell or chunk
CELL_BYTES = 32 << 20  # and their bytes
PAIRS = 1 << 20        # pairs looked at together
SEED = 20_011


@dataclass(frozen=True)
class Windows:
    """Projections per group, and half width of the windows for vectors of length one."""

    k: int
    width: float
    threshold: float

    @property
    def m(self) -> int:
        return GROUPS * self.k

    @property
    def need(self) -> int:
        return self.m - GROUPS + 1

    def directions(self, dim: int) -> np.ndarray:
        return np.random.default_rng([SEED, dim]).standard_normal((dim, self.m))


def hit(width: float, distance: float) -> float:
    """Chance that two vectors at this distance collide on one projection."""
    return erf(width / (distance * sqrt(2)))


def passes(k: int, p: float) -> float:
    """Chance of fewer than ``GROUPS`` misses among all projections."""
    m = GROUPS * k
    return sum(comb(m, i) * (1 - p) ** i * p ** (m - i) for i in range(GROUPS))


def calibrated(rows: int, threshold: float, recall: float) -> Windows:
    """The narrowest windows that keep ``recall`` of the pairs at the threshold, with so many
    projections per group that among ``rows`` unrelated vectors about one shares all windows."""
    near = sqrt(max(2 - 2 * threshold, 1e-12))
    for k in range(4, 25):
        low, high = 0.0, 10 * near
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if passes(k, hit(middle, near)) >= recall else (middle, high)
        if rows * hit(high, sqrt(2)) ** k <= 1:
            break
    return Windows(k, high, threshold)


def scaled(binary: pa.Array, kind: str, dim: int) -> np.ndarray:
    """Vectors of length one in double precision."""
    raw = np.frombuffer(b"".join(binary.to_pylist()), np.dtype(kind)).reshape(-1, dim).astype(float)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]


def packed(vectors: DataFrame, kind: str) -> DataFrame:
    """``vectors`` with the array column ``vec`` as bytes."""
    schema = ", ".join(f"`{f.name}` {'binary' if f.name == 'vec' else f.dataType.simpleString()}" for f in vectors.schema)
    at = vectors.columns.index("vec")

    def run(batches):
        for batch in batches:
            lists = batch.column(at)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).tolist()
            data = [flat[a:b].tobytes() for a, b in zip(ends, ends[1:])]
            cols = list(batch.columns)
            cols[at] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return vectors.mapInArrow(run, schema)


def celled(classes: DataFrame, windows: Windows, kind: str, with_vectors: bool) -> DataFrame:
    """(grp, label, dim, cell, home[, cls, copies, vec]): every vector once per group in its own
    cell (home), and in the cells that its windows reach."""
    label_type = classes.schema["label"].dataType.simpleString()
    schema = f"grp int, label {label_type}, dim int, cell long, home boolean"
    carried = ["cls", "copies", "vec"] if with_vectors else []
    schema += ", cls long, copies long, vec binary" if with_vectors else ""

    def run(batches):
        for batch in batches:
            dims, depth = batch.column("dim").to_numpy(), batch.column("depth").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(rows))
                deep = depth[rows]
                most = int(deep.max())
                if most:
                    directions = windows.directions(dim)
                    at = scaled(part.column("vec"), kind, dim) @ directions
                    cuts = np.zeros((len(rows), windows.m))
                    for i, c in enumerate(part.column("cuts").to_pylist()):
                        if c:
                            cuts[i, :len(c)] = c
                for g in range(GROUPS):
                    own = np.zeros(len(rows), np.int64)
                    row, cell = np.arange(len(rows)), own.copy()
                    for j in range(most):
                        gap = at[:, g * windows.k + j] - cuts[:, g * windows.k + j]
                        on = deep > j
                        bit = ((gap > 0) & on).astype(np.int64) << j
                        own |= bit
                        both = row[on[row] & (np.abs(gap[row]) <= windows.width)]
                        more = cell[on[row] & (np.abs(gap[row]) <= windows.width)] | (bit[both] ^ (1 << j))
                        cell = np.concatenate([cell | bit[row], more])
                        row = np.concatenate([row, both])
                    take = pa.array(row)
                    out = [pa.array(np.full(len(row), g, np.int32)), part.column("label").take(take),
                           part.column("dim").take(take), pa.array(cell), pa.array(cell == own[row])]
                    yield pa.RecordBatch.from_arrays(out + [part.column(c).take(take) for c in carried],
                                                     names=["grp", "label", "dim", "cell", "home", *carried])

    return classes.mapInArrow(run, schema)


def planned(classes: DataFrame, windows: Windows, kind: str) -> DataFrame:
    """``classes`` with ``depth``, how often their label is halved, and ``cuts``, the medians."""
    slab = 0.5 + hit(windows.width, 1.0) / 2  # share of a label that a half with its margin sees
    limit = F.greatest(F.lit(256), F.least(F.lit(CELL), F.floor(F.lit(CELL_BYTES) / (F.col("dim") * 8))))
    depth = F.greatest(F.lit(0), F.ceil(F.log(F.col("rows") / limit) / F.lit(-log(slab)))).cast("int")
    sizes = written(classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("rows"))
                    .withColumn("depth", F.least(depth, F.lit(windows.k))), "vector-labels")
    split = sizes.filter("depth > 0").select("label", "dim")
    if split.isEmpty():
        return classes.join(sizes.select("label", "dim", "depth"), ["label", "dim"]).withColumn("cuts", F.lit(None).cast("array<double>"))
    label_type = classes.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                at = scaled(part.column("vec"), kind, dim) @ windows.directions(dim)
                n = part.num_rows
                row = pa.array(np.repeat(np.arange(n), windows.m))
                yield pa.RecordBatch.from_arrays(
                    [part.column("label").take(row), part.column("dim").take(row),
                     pa.array(np.tile(np.arange(windows.m, dtype=np.int32), n)), pa.array(at.ravel())],
                    names=["label", "dim", "j", "at"])

    placed = classes.join(split, ["label", "dim"]).select("label", "dim", "vec").mapInArrow(
        run, f"label {label_type}, dim int, j int, at double")
    medians = (placed.groupBy("label", "dim", "j").agg(F.percentile_approx("at", 0.5, 200).alias("at"))
               .groupBy("label", "dim").agg(F.array_sort(F.collect_list(F.struct("j", "at"))).alias("by_j"))
               .select("label", "dim", F.col("by_j.at").alias("cuts")))
    plan = written(sizes.select("label", "dim", "depth").join(medians, ["label", "dim"], "left"), "vector-cells")
    return classes.join(plan, ["label", "dim"])


def dealt(classes: DataFrame, windows: Windows, kind: str) -> DataFrame:
    """Copies of the vectors in groups (grp, label, dim, cell, i, j) with ``asks`` and ``answers``:
    vectors of chunk i of a cell look for partners in its chunk j."""
    where = ["grp", "label", "dim", "cell"]
    limit = F.greatest(F.lit(256), F.least(F.lit(CELL), F.floor(F.lit(CELL_BYTES) / (F.col("dim") * 8))))
    full = (celled(classes, windows, kind, False).groupBy(*where).count().filter(F.col("count") > 2 * limit)
            .select(*where, F.ceil(F.col("count") / limit).cast("int").alias("chunks")))
    full = written(full, "vector-full-cells")
    copies = celled(classes, windows, kind, True)
    if full.isEmpty():
        return copies.withColumns({"i": F.lit(0), "j": F.lit(0), "asks": F.col("home"), "answers": F.lit(True)})
    full = F.broadcast(full) if full.count() <= 50_000 else full
    own = F.pmod(F.xxhash64("cls"), F.coalesce("chunks", F.lit(1))).cast("int")
    every = F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)
    asking = F.when(F.col("home"), F.transform(every, lambda x: F.struct(F.col("own").alias("i"), x.alias("j"))))
    answering = F.transform(every, lambda x: F.struct(x.alias("i"), F.col("own").alias("j")))
    none = F.array().cast("array<struct<i:int,j:int>>")
    return (copies.join(full, where, "left").withColumn("own", own)
            .withColumn("at", F.explode(F.array_distinct(F.concat(F.coalesce(asking, none), answering))))
            .select(*where, F.col("at.i").alias("i"), F.col("at.j").alias("j"), "cls", "copies", "vec",
                    (F.col("home") & (F.col("at.i") == F.col("own"))).alias("asks"), (F.col("at.j") == F.col("own")).alias("answers")))


class Roots:
    """Smallest member of each component of the edges so far."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.up[a], self.up[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))
            while True:
                onward = self.up[self.up]
                if np.array_equal(onward, self.up):
                    break
                self.up = onward


def candidates(at: np.ndarray, asks: np.ndarray, answers: np.ndarray, grp: int, windows: Windows):
    """Yields (asking, answering) pairs, by row of ``at``, that belong to this group and pass the count."""
    own = range(grp * windows.k, (grp + 1) * windows.k)
    first = at[:, own[0]]
    asks, answers = asks[np.argsort(first[asks], kind="stable")], answers[np.argsort(first[answers], kind="stable")]
    lo = np.searchsorted(first[answers], first[asks] - windows.width, side="left")
    hi = np.searchsorted(first[answers], first[asks] + windows.width, side="right")
    total = np.concatenate([[0], np.cumsum(hi - lo)])
    start = 0
    while start < len(asks):
        end = max(start + 1, int(np.searchsorted(total, total[start] + PAIRS, side="right")) - 1)
        who, place = spread(lo[start:end], hi[start:end])
        a, b = asks[start:end][who], answers[place]
        start = end
        for c in own[1:]:
            keep = np.abs(at[a, c] - at[b, c]) <= windows.width
            a, b = a[keep], b[keep]
        keep = a != b
        a, b = a[keep], b[keep]
        count = np.full(len(a), windows.k)
        for g in range(GROUPS):
            if g != grp:
                here = sum((np.abs(at[a, c] - at[b, c]) <= windows.width).astype(np.int64)
                           for c in range(g * windows.k, (g + 1) * windows.k))
                if g < grp:  # in all windows of an earlier group: the pair is counted there
                    count[here == windows.k] = -windows.m
                count = count + here
        yield a[count >= windows.need], b[count >= windows.need]


def meet(table: pa.Table, windows: Windows, kind: str) -> pa.RecordBatch:
    """(cls, links, root) for the vectors of one group."""
    dim, grp = table["dim"][0].as_py(), table["grp"][0].as_py()
    cls, copies = table["cls"].to_numpy(), table["copies"].to_numpy()
    unit = scaled(table["vec"].combine_chunks(), kind, dim)
    at = unit @ windows.directions(dim)
    asks, answers = np.flatnonzero(table["asks"].to_numpy()), np.flatnonzero(table["answers"].to_numpy())
    links, roots = np.zeros(len(cls), np.int64), Roots(len(cls))
    for a, b in candidates(at, asks, answers, grp, windows):
        near = np.concatenate([np.einsum("ij,ij->i", unit[a[s:s + 65_536]], unit[b[s:s + 65_536]]) for s in range(0, len(a), 65_536)]
                              or [np.empty(0)]) >= windows.threshold
        a, b = a[near], b[near]
        np.add.at(links, a, copies[b])
        roots.add(a, b)
    root = cls[roots.up]
    told = (links > 0) | (root != cls)
    return pa.RecordBatch.from_arrays([pa.array(cls[told]), pa.array(links[told]), pa.array(root[told])],
                                      names=["cls", "links", "root"])


def near_vectors(vectors: DataFrame, threshold: float = 0.98, recall: float = 0.995, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component, kept) for every row.

    Rows with the same label, not NULL, and vectors of the same length are linked if their cosine
    is at least ``threshold``; every link returned is checked, and links at the threshold are found
    with the chance ``recall``, closer ones more surely (equal vectors always). ``n_links`` counts
    the other rows linked directly, ``component`` is the smallest id reachable by links, ``kept``
    tells that it is the row's own. Vectors that are NULL, empty or zero, or hold NULL, infinite or
    NaN components link with nothing. Repeated rows, and rows that share an id, are rows of their
    own. NULL ids take part; a component is NULL only if it has no other id.
    """
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = "f4" if element == "float" else "f8"
    vec = F.col(vector_col) if kind == "f4" else F.col(vector_col).cast("array<double>")
    # row numbers have to be the same whenever they are read
    rows = written(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                                  F.col(label_col).alias("label"), vec.alias("vec")), "vector-rows")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    equal = (rows.filter(usable).groupBy("label", "vec")
             .agg(F.min("row").alias("cls"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
             .withColumn("dim", F.size("vec")))
    classes = written(packed(equal.select("cls", "copies", "least", "label", "dim", "vec"), kind), "vector-classes")
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 1
    windows = calibrated(largest, threshold, recall)
    groups = dealt(planned(classes, windows, kind), windows, kind)

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([meet(table, windows, kind)])

    found = written(groups.groupBy("grp", "label", "dim", "cell", "i", "j").applyInArrow(run, "cls long, links long, root long"),
                    "vector-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    tree = components(found.filter("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")).distinct(), "vector-cc")
    reached = tree.join(classes.select(F.col("cls").alias("v"), "least"), "v")
    smallest = reached.groupBy("c").agg(F.min("least").alias("component"))
    linked = written(reached.join(smallest, "c").select(F.col("v").alias("cls"), "component")
                     .join(links, "cls"), "vector-linked")
    copies = (equal.filter("copies > 1").select("label", "vec", F.col("cls").alias("shared"), "copies", "least"))
    named = rows.join(copies, ["label", "vec"], "left").select(
        "row", "id", F.coalesce("shared", "row").alias("cls"), F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce("least", "id").alias("least"))
    component = F.coalesce("component", "least")
    return (named.join(linked, "cls", "left")
            .select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
                    component.alias("component"), component.eqNullSafe(F.col("id")).alias("kept")))
