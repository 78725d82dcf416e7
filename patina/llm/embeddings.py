"""Near-duplicate vectors by an exact metric range join.

On unit vectors cosine >= c means distance <= r = sqrt(2 - 2c). Pivots cut the space into
cells, each vector living in the cell of its nearest pivot. By the triangle inequality a
vector can only link into a cell whose pivot is at most r farther than the cell's radius,
and lies at most 2r farther from it than its own pivot; only such vectors are compared.

Cells are cut into chunks, a row each, which are stored once. A chunk meets those chunks that
the inequalities leave as Spark's nested loop reads them again, so no vector is copied for the
vectors it is compared with, and what is written grows as the table does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.llm.blocks import HOME, SLICE, key_runs
from patina.llm.components import connected_components
from patina.llm.shared import ship, stored

COSINE = 0.95
CELL_ROWS = 16_384  # vectors that a cell should hold
PIVOTS = 1024  # vectors drawn as pivots, at most; larger cells are cut into chunks
SLACK = 1e-6  # added to distances, far above rounding
VISITS = HOME * SLICE  # vectors of a chunk, at most
CHUNK_BYTES = 1 << 24  # of a chunk's vectors in double precision, at most
SPREAD = 24  # chunks that a table is cut into at least, of HOME vectors or more
TILE = 512  # visitors that HOME vectors are compared with at a time
AWAY = 1 << 20  # distances to pivots that a task holds at a time


def usable(vector: str) -> F.Column:
    """Whether a vector can link: not null, all components finite, not all zero."""
    least, most, far = F.array_min(vector).cast("double"), F.array_max(vector).cast("double"), F.lit(float("inf"))
    finite = (most < far) & (least > -far)  # NaN is above all
    return F.coalesce(finite & ((most != 0.0) | (least != 0.0)) & F.forall(vector, lambda x: x.isNotNull()), F.lit(False))


def digests(vector: str) -> list[F.Column]:
    """128 bits that stand for a vector, h1 and h2; 0.0 and -0.0 are one value."""
    return [F.xxhash64(F.lit(seed), vector).alias(f"h{seed}") for seed in (1, 2)]


def _unit(values: np.ndarray) -> np.ndarray:
    """Vectors scaled to length one, in double precision."""
    values = values.astype(float)
    # Scaling by the largest component first keeps squares of tiny and huge values in range.
    out = values / np.abs(values).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _values(table, name: str = "vector") -> np.ndarray:
    """Vectors of one dimension as they are; in double precision unless they are in single."""
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float32 if flat.dtype == np.float32 else float).reshape(len(column), -1)


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """Rows of each dimension: (dimension, row numbers, rows)."""
    sizes = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield int(dim), rows, batch.take(pa.array(rows))


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (vectors @ pivots.T)))


def draw_pivots(vectors: DataFrame, rows: int) -> dict[int, np.ndarray]:
    """Unit pivots of each dimension, drawn by a hash of the vector; at most ``PIVOTS`` in all."""
    wanted = int(np.clip(np.ceil(rows / CELL_ROWS), 1, PIVOTS))
    slots = 1 << 30
    place = F.pmod(F.xxhash64(F.lit(3), "vector"), F.lit(slots))
    # Rows below the cut are a few times as many as wanted, as copies may be among them.
    cut = min(slots, int(slots * (4 * wanted + 64) / max(rows, 1)))
    some = vectors.where(place < cut).where(usable("vector")).select("dim", "vector").distinct()
    drawn = some.orderBy(place, "vector").limit(wanted).toArrow()
    if not drawn.num_rows:
        return {}
    batch = drawn.combine_chunks().to_batches()[0]
    return {dim: _unit(_values(part)) for dim, _, part in _by_dimension(batch)}


def _merged(table: pa.Table) -> pa.Table:
    """One row per distinct vector: its least rep, its copies added up."""
    first = table.column("h1").to_numpy()
    if len(np.unique(first)) == len(first):
        return table
    table = table.take(pc.sort_indices(table, sort_keys=[(name, "ascending") for name in ("h1", "h2", "rep")]))
    first, second = table.column("h1").to_numpy(), table.column("h2").to_numpy()
    starts = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
    copies = np.add.reduceat(table.column("copies").to_numpy(), starts)
    at = table.schema.get_field_index("copies")
    return table.take(pa.array(starts)).set_column(at, table.schema.field(at), pa.array(copies))


def _chunk_rows(rows: int, dim: int) -> int:
    """Vectors of one dimension that a chunk should hold."""
    return max(1, min(int(np.clip(-(-rows // SPREAD), HOME, VISITS)), CHUNK_BYTES // (8 * dim)))


def assign_cells(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Put each vector (rep, vector, copies, dim) into the cell of its nearest pivot; one row per chunk of a cell.

    Equal vectors become one, with the least rep and all copies. A chunk holds its vectors, their reps,
    copies and digests, its cell's pivot and how far from it they reach; and for every pivot the least
    distance of its vectors (``least``) and by how much that pivot is farther than their own at least (``gap``).
    """
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)
    rows = vectors.select("dim", "rep", "copies", "vector", *digests("vector"))
    schema = T.StructType([*rows.schema, *T.StructType.fromDDL("cell int, chunk int")])

    def away(unit: np.ndarray, dim: int) -> Iterator[np.ndarray]:
        """Distances to all pivots, of some vectors after the other."""
        near = sent.value.get(dim)
        step = AWAY // len(near) if near is not None else len(unit)
        for s in range(0, len(unit), step):
            part = unit[s : s + step]
            yield _distances(part, near) if near is not None else np.zeros((len(part), 1))

    def place(chunks: dict[tuple[int, int], int]) -> DataFrame:
        """Distinct vectors of a batch with their cells, each of which is cut into so many chunks by the digest."""

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, _, part in _by_dimension(batch):
                    part = _merged(pa.Table.from_batches([part])).combine_chunks().to_batches()[0]
                    far = away(_unit(_values(part)), dim)
                    cells = np.concatenate([x.argmin(axis=1) for x in far]).astype(np.int32)
                    cuts = np.array([chunks.get((dim, c), 1) for c in range(cells.max() + 1)])
                    chunk = (part.column("h1").to_numpy() % cuts[cells]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells), pa.array(chunk)], names=schema.names)

        return rows.mapInArrow(assign, schema)

    sizes = place({}).groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per pivot
    total = sum(r.n for r in sizes)
    chunks = {(r.dim, r.cell): -(-r.n // _chunk_rows(total, r.dim)) for r in sizes}
    keys = ["dim", "cell", "chunk"]
    kind = vectors.schema["rep"].dataType
    packed = T.StructType(
        [
            *T.StructType.fromDDL("dim int, cell int, chunk int, vectors binary"),
            T.StructField("reps", T.ArrayType(kind)),
            *T.StructType.fromDDL("copies array<bigint>, h1 array<bigint>, h2 array<bigint>"),
            *T.StructType.fromDDL("pivot array<double>, reach double, least array<double>, gap array<double>"),
        ]
    )

    def pack(key: tuple, parts: list[pa.Table]) -> pa.RecordBatch:
        table, (dim, cell, _) = _merged(pa.concat_tables(parts)).combine_chunks(), key
        values, near = _values(table), sent.value.get(dim)
        far = [(x[:, cell].max(), x.min(axis=0), (x - x[:, [cell]]).min(axis=0)) for x in away(_unit(values), dim)]
        reach, least, gap = max(x[0] for x in far), np.min([x[1] for x in far], axis=0), np.min([x[2] for x in far], axis=0)
        held = [table.column(c).chunk(0) for c in ("rep", "copies", "h1", "h2")]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in held]
        rest = [near[cell] if near is not None else np.empty(0), reach, least, gap]
        start = [pa.array([x], pa.int32()) for x in key]
        return pa.RecordBatch.from_arrays(
            [*start, pa.array([values.tobytes()], pa.binary()), *lists, *(pa.array([x]) for x in rest)], names=packed.names
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, []
        for batch in batches:
            for key, a, b in key_runs(batch, keys):
                if waiting and key != now:
                    yield pack(now, waiting)
                    waiting = []
                now = key
                waiting.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if waiting:
            yield pack(now, waiting)

    dealt = place(chunks).repartition(max(1, sum(chunks.values())), *keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(gather, packed)


def cell_blocks(placed: DataFrame, radius: float) -> DataFrame:
    """The pairs of chunks that are compared: a chunk with itself (side 0) or with a visitor (side 1).

    A chunk visits the earlier chunks of its own cell, and chunks of every earlier cell that
    the triangle inequality doesn't rule out for all its vectors, so each pair of vectors meets in one row.
    """
    kept = ["dim", "cell", "chunk", "vectors", "reps", "copies", "pivot", "reach"]
    home = placed.select(*(F.col(c).alias(f"home_{c}") for c in kept))
    visitor = placed.select(*(F.col(c).alias(f"visitor_{c}") for c in kept), "least", "gap")
    at = F.col("home_cell")
    near = (F.get("least", at) <= F.col("home_reach") + radius) & (F.get("gap", at) <= 2 * radius)
    earlier = F.when(at == F.col("visitor_cell"), F.col("home_chunk") <= F.col("visitor_chunk")).otherwise(
        (at < F.col("visitor_cell")) & near
    )
    # An equality would bring all chunks of a dimension into one task.
    meet = (F.abs(F.col("home_dim") - F.col("visitor_dim")) < 1) & earlier
    alone = (at == F.col("visitor_cell")) & (F.col("home_chunk") == F.col("visitor_chunk"))
    pairs = home.join(visitor.hint("shuffle_replicate_nl"), meet).drop("least", "gap", "visitor_dim")
    return pairs.withColumn("side", F.when(alone, 0).otherwise(1)).withColumn(
        "visitor_vectors", F.when(~alone, F.col("visitor_vectors"))
    )


LINKS = "n_links bigint"


def leading_directions(pivots: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Orthonormal columns, of each dimension, along which vectors are compared first.

    The directions of the pivots come first. Few are taken as they cost less than whole vectors;
    dimensions with little to save have none.
    """
    out = {}
    for dim, near in pivots.items():
        k = 19 + dim // 16
        if k < 0.7 * dim:
            along = np.linalg.svd(near, full_matrices=False)[2][:k]
            more = np.random.default_rng(dim).normal(size=(dim, k))
            out[dim] = np.linalg.qr(np.hstack([along.T, more]))[0][:, :k]
    return out


def _shortened(unit: np.ndarray, along: np.ndarray | None) -> np.ndarray:
    """Vectors whose products bound the cosines from above: coordinates along some directions, and the length of the rest."""
    if along is None:
        return unit.astype(np.float32)
    lead = unit @ along
    rest = np.sqrt(np.maximum(0, 1 - (lead * lead).sum(axis=1)))
    return np.column_stack([lead, rest]).astype(np.float32)


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of ``a`` and ``b``, pair by pair; every row points to the least of its tree, before and after."""
    root = root.copy()
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


class _Rows:
    """Vectors of a chunk, sorted by their distance to a pivot."""

    def __init__(self, unit: np.ndarray, along: np.ndarray | None, away: np.ndarray, copies: np.ndarray, rows: np.ndarray):
        order = rows[np.argsort(away[rows], kind="stable")]
        self.rows, self.away, self.copies = order, away[order], copies[order].astype(float)
        self.unit = unit[order]
        self.single = self.unit.astype(np.float32)
        self.short = _shortened(self.unit, along)


def _links(home: _Rows, visitors: _Rows, alone: bool, cosine: float, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of home rows and then visitors, weighted by copies, and the least row that these connect each to.

    Where ``alone`` holds, both are the same rows and numbered once. Single precision only
    decides where it is beyond its rounding; doubles decide the rest.
    """
    start = 0 if alone else len(home.rows)
    n = start + len(visitors.rows)
    counts, root = np.zeros(n), np.arange(n)
    rounding = max(1e-4, (home.unit.shape[1] + 4) * 2.0**-22)
    low, high = cosine - rounding, cosine + rounding
    across = np.ascontiguousarray(visitors.short.T)
    space = np.empty(HOME * TILE, np.float32)
    for s in range(0, len(home.rows), HOME):
        e = min(s + HOME, len(home.rows))
        first = np.searchsorted(visitors.away, home.away[s] - radius)
        last = np.searchsorted(visitors.away, home.away[e - 1] + radius, "right")
        for f in range(max(first, s) if alone else first, last, TILE):
            t = min(f + TILE, last)
            bound = np.matmul(home.short[s:e], across[:, f:t], out=space[: (e - s) * (t - f)].reshape(e - s, t - f))
            if bound.max() < low:
                continue
            a = np.flatnonzero(bound.max(axis=1) >= low)
            b = f + np.flatnonzero(bound[a].max(axis=0) >= low)
            a += s
            score = home.single[a] @ visitors.single[b].T
            hit = score >= low
            if alone:
                hit &= a[:, None] < b
            r, c = np.nonzero(hit & (score < high))
            for k in range(0, len(r), 65_536):
                i, j = r[k : k + 65_536], c[k : k + 65_536]
                hit[i, j] = (home.unit[a[i]] * visitors.unit[b[j]]).sum(axis=1) >= cosine
            if not hit.any():
                continue
            weights = hit.astype(float)
            counts[a] += weights @ visitors.copies[b]
            b += start
            counts[b] += home.copies[a] @ weights
            # A first link of every row and column joins most trees; what is left apart takes further turns.
            while (apart := hit & (root[a][:, None] != root[b])).any():
                r, c = np.flatnonzero(apart.any(axis=1)), np.flatnonzero(apart.any(axis=0))
                ends = np.append(a[r], a[apart[:, c].argmax(axis=0)]), np.append(b[apart[r].argmax(axis=1)], b[c])
                root = unite(root, *ends)
    return counts.astype(np.int64), root


def _compare(cells: DataFrame, kind: T.DataType, cosine: float, radius: float, along: dict[int, np.ndarray]) -> DataFrame:
    """What each pair of chunks finds: (u, n_links, v): links of u, and a vector that u hangs together with.

    A pair gives one row per linked vector, not one per link: its links weighted by copies,
    and the first vector that links within the pair connect it to.
    """
    sent = cells.sparkSession.sparkContext.broadcast(along)
    schema = T.StructType([T.StructField("u", kind), *T.StructType.fromDDL(LINKS), T.StructField("v", kind)])

    def vectors(held, dim: int, n: int) -> np.ndarray:
        data = held.as_buffer()
        return _unit(np.frombuffer(data, np.float32 if data.size == 4 * n * dim else float).reshape(n, dim))

    def away(unit: np.ndarray, pivot: np.ndarray) -> np.ndarray:
        return _distances(unit, pivot[None])[:, 0] if len(pivot) else np.zeros(len(unit))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = whole = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                dim, cell, there = (row[x].as_py() for x in ("home_dim", "home_cell", "visitor_cell"))
                held = [row[f"{x}_reps"].values for x in ("home", "visitor")]
                copies = [row[f"{x}_copies"].values.to_numpy() for x in ("home", "visitor")]
                pivots = [row[f"{x}_pivot"].values.to_numpy() for x in ("home", "visitor")]
                directions, alone = sent.value.get(dim), row["side"].as_py() == 0
                if key != (dim, cell, row["home_chunk"].as_py()):
                    key, unit = (dim, cell, row["home_chunk"].as_py()), vectors(row["home_vectors"], dim, len(held[0]))
                    own = away(unit, pivots[0])
                    whole = _Rows(unit, directions, own, copies[0], np.arange(len(unit)))
                home = whole
                if alone:
                    visitors = home
                else:
                    other = vectors(row["visitor_vectors"], dim, len(held[1]))
                    to_home, some = away(other, pivots[0]), np.arange(len(other))
                    if cell != there:
                        reach = [row[f"{x}_reach"].as_py() for x in ("home", "visitor")]
                        some = np.flatnonzero(to_home <= np.minimum(away(other, pivots[1]) + radius, reach[0]) + radius)
                        near = np.flatnonzero(away(unit, pivots[1]) <= np.minimum(own + radius, reach[1]) + radius)
                        if len(near) < len(unit):
                            home = _Rows(unit, directions, own, copies[0], near)
                    visitors = _Rows(other, directions, to_home, copies[1], some)
                counts, root = _links(home, visitors, alone, cosine, radius)
                linked = np.flatnonzero(counts)
                if len(linked):
                    names = held[0].take(pa.array(home.rows))
                    names = names if alone else pa.concat_arrays([names, held[1].take(pa.array(visitors.rows))])
                    found = [names.take(pa.array(linked)), pa.array(counts[linked]), names.take(pa.array(root[linked]))]
                    yield pa.RecordBatch.from_arrays(found, names=schema.names)

    return cells.mapInArrow(compare, schema)


def near_duplicates(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", cosine: float = COSINE
) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept.

    Two rows link when the cosine of their vectors, in double precision, is at least
    ``cosine``; ``n_links`` counts the other rows that a row links with, ``component_id``
    is the least key that links reach, and that row is kept.

    Null vectors, zero vectors and vectors with null or non-finite components link with
    nothing; neither do vectors of different dimensions. Rows with a null key link with
    nothing: their n_links is 0, their component null, and they are kept. Equal vectors are
    compared once, however many rows share them; 128 bits of hash tell them apart. Rows that share a key are one point of the
    graph. Unlike vectors whose least key is the same one each report the links of all of
    them, so keys should be unique where n_links matters. Other columns are not read. An empty table
    gives no rows.
    """
    ship(vectors.sparkSession)
    radius = float(np.sqrt(2 - 2 * cosine)) + SLACK
    kind = vectors.schema[key].dataType
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    linkable = F.col("id").isNotNull() & F.col("vector").isNotNull()
    some = rows.where(linkable).select(
        F.col("id").alias("rep"), "vector", F.lit(1).cast("bigint").alias("copies"), F.size("vector").alias("dim")
    )
    pivots = draw_pivots(some, rows.count())
    placed = stored(assign_cells(some.where(usable("vector")), pivots))
    found = stored(_compare(cell_blocks(placed, radius), kind, cosine, radius, leading_directions(pivots)))
    links = found.groupBy(F.col("u").alias("rep")).agg(F.sum("n_links").alias("others"))
    tied = connected_components(found.select("u", "v")).select(F.col("u").alias("rep"), "component")
    # Rows find their vector's class by its digest, so vectors are not moved again.
    classes = (
        placed.select(F.explode(F.arrays_zip(F.col("reps").alias("rep"), "copies", "h1", "h2")).alias("x"))
        .select("x.*")
        .join(links, "rep", "left")
        .join(tied, "rep", "left")
        .select(
            "h1",
            "h2",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    own = F.col("id").alias(key)
    linked = (
        rows.where(linkable)
        .select("id", *digests("vector"))
        .join(classes, ["h1", "h2"], "left")
        .select(own, F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    alone = rows.where(~linkable).select(own, F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    kept = F.col(key).isNull() | (F.col(key) == F.col("component_id"))
    return linked.unionByName(alone).withColumn("kept", kept)
