"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

Each document is a set of weighted word shingles. Every shingle is the source of a Poisson
process of arrivals, at a rate that is its weight and with random numbers that depend on
the shingle alone; each arrival falls on a random register, and a register keeps the
shingle of its earliest arrival. Two documents agree in a register with the probability
Jaccard of their weights. A shingle's process stops as soon as it can improve no register.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.llm.blocks import block_events, by_block, into_blocks
from patina.llm.components import connected_components
from patina.llm.shared import broadcast_below, ship, stored, text_slices
from patina.llm.words import find_words, hash_shingles, hash_words, mixed, text_bytes

WIDTH = 5  # words of a shingle
THRESHOLD = 0.8
BANDS, ROWS = 25, 5  # a pair at the threshold shares some band with probability 0.99995
REGISTERS = BANDS * ROWS
SPREAD = 5.0  # standard errors below the threshold at which an estimate rules a pair out
BROADCAST_IDS = 1_000_000
TIE_HOME, CHUNK = 512, 128  # documents of a block that is compared once more, and at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(texts: pa.Array, width: int = WIDTH):
    """Distinct shingles of each text with weights 1 + ln(count): (hash, weight, text number).

    Also the number of words and two hashes of the sequence of words of each text.
    """
    raw, at = text_bytes(texts)
    n = len(texts)
    starts, ends, doc = find_words(raw, at)
    words = hash_words(raw, starts, ends)
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    place = (np.arange(len(words)) - first[doc]).astype(np.uint64)
    sums = np.zeros((2, len(words) + 1), np.uint64)
    for k in range(2):
        np.cumsum(mixed(mixed(words + np.uint64(k)) + place * _STEP), out=sums[k, 1:])
    sequence = sums[:, first + count] - sums[:, first]
    shingles, owner = hash_shingles(words, doc, n, width)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    at_new = np.flatnonzero(new)
    repeats = np.diff(np.append(at_new, len(shingles)))
    return shingles[new], 1 + np.log(repeats), owner[new], count, sequence


def prob_min_hash(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Signatures: the shingle that holds each of ``m`` registers, for ``n`` texts at once.

    All processes advance together; those whose next arrival is later than the latest
    register of their text have ended.
    """
    early = np.full(n * m, np.inf)
    held = np.zeros(n * m, np.uint64)
    element, rate, text = shingles, 1 / weights, owner
    clock, done = np.zeros(len(element)), 0
    while len(element):
        steps = int(np.clip(8192 // len(element), 1, 64))
        draws = mixed(mixed(element)[:, None] + np.arange(done + 1, done + steps + 1, dtype=np.uint64) * _STEP)
        gaps = -np.log(((draws >> np.uint64(12)) + np.uint64(1)).astype(float) * 2.0**-52) * rate[:, None]
        arrivals = clock[:, None] + np.cumsum(gaps, axis=1)
        register = text[:, None] * m + (mixed(draws) % np.uint64(m)).astype(np.int64)
        flat, when = register.ravel(), arrivals.ravel()
        better = when < early[flat]
        flat, when = flat[better], when[better]
        np.minimum.at(early, flat, when)
        won = when == early[flat]
        held[flat[won]] = np.broadcast_to(element[:, None], draws.shape).ravel()[better][won]
        clock, done = arrivals[:, -1], done + steps
        latest = early.reshape(n, m).max(axis=1)
        go_on = clock < latest[text]
        element, rate, text, clock = element[go_on], rate[go_on], text[go_on], clock[go_on]
    return held.reshape(n, m)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets given as sorted hashes and weights.

    The sum over common elements d of 1 / sum over e of max(x_e / x_d, y_e / y_d). For a
    given d the maximum is the first term exactly where x_e / y_e >= x_d / y_d, so sorting
    by that ratio turns the inner sums into running sums.
    """
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[at] == a
    xs, ys = x[both], y[at[both]]
    if not len(xs):
        return 0.0
    only_x, only_y = x.sum() - xs.sum(), y.sum() - ys.sum()
    ratio = xs / ys
    order = np.argsort(ratio)
    ratio, xs, ys = ratio[order], xs[order], ys[order]
    from_here = np.searchsorted(ratio, ratio, "left")
    rest_x = np.append(np.cumsum(xs[::-1])[::-1], 0)[from_here] + only_x
    before_y = np.append(0, np.cumsum(ys))[from_here] + only_y
    return float((1 / (rest_x / xs + before_y / ys)).sum())


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


SIGNED = "a bigint, b bigint, n_words bigint, bands array<bigint>, registers binary"


def signatures(docs: DataFrame, text: str, key: str) -> DataFrame:
    """id, the two hashes of its words, n_words, a hash of each band and a byte of each register."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(SIGNED)])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                n = batch.num_rows
                shingles, weights, owner, count, (a, b) = weighted_shingles(batch.column("text"))
                found = prob_min_hash(shingles, weights, owner, n)
                band = np.zeros((n, BANDS), np.uint64)
                for k in range(ROWS):
                    band = mixed(band * _STEP + found[:, k::ROWS])
                band = mixed(band + np.arange(BANDS, dtype=np.uint64))
                offsets = pa.array(np.arange(n + 1) * BANDS, pa.int32())
                low = np.ascontiguousarray((found & np.uint64(0xFF)).astype(np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        _signed(a),
                        _signed(b),
                        pa.array(count.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, _signed(band.ravel())),
                        pa.array([r.tobytes() for r in low], pa.binary()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(sign, schema)


def least_estimate(threshold: float) -> int:
    """Equal registers that a pair must have not to be ruled out."""
    return int(np.floor(REGISTERS * threshold - SPREAD * np.sqrt(REGISTERS * threshold * (1 - threshold))))


def _agreements(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many registers each row of one shares with each row of two."""
    out = np.zeros((len(one), len(two)), np.uint8)
    for k in range(one.shape[1]):
        out += one[:, k][:, None] == two[:, k][None, :]
    return out


def spanning_pairs(agree: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of rows that agree in ``least`` registers, closest first (Prim)."""
    n = len(agree)
    best, tied = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    out = np.ones(n, bool)
    edges = []
    for _ in range(n):
        scores = np.where(out, best, -2)
        now = int(scores.argmax())
        if scores[now] >= least:
            edges.append((int(tied[now]), now))
        out[now] = False
        nearer = agree[now] > best
        best[nearer], tied[nearer] = agree[now][nearer], now
    return edges


def _pairs_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("u", kind), T.StructField("v", kind)])


def candidate_pairs(places: DataFrame, least: int, kind: T.DataType) -> DataFrame:
    """Pairs (u < v) of one bucket whose registers agree often enough, from its blocks.

    They are not all such pairs, but enough to tie together all rows of a bucket that such
    pairs connect: a spanning forest of each chunk, and for each visitor its closest row
    of every chunk it visits.
    """
    keys = ["bucket", "block_i", "block_s"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = ids = None
        for what, table in block_events(batches, [*keys, "side"]):
            new, names = _registers(table), table.column("v").to_pylist()
            if what == "home":
                home, ids = new, names
                own = table.column("own")[0].as_py()
                found = [(ids[i], ids[j]) for i, j in spanning_pairs(_agreements(home, home), least)] if own else []
            else:
                agree = _agreements(home, new)
                found = [(ids[i], names[j]) for j, i in enumerate(agree.argmax(axis=0)) if agree[i, j] >= least]
            for start in range(0, len(found), 10_000):
                yield _pair_batch(found[start : start + 10_000], table.schema.field("v").type)

    return by_block(places, *keys).mapInArrow(compare, _pairs_schema(kind)).distinct()


def _registers(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint8).reshape(-1, REGISTERS)


def _pair_batch(pairs: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    some = [(min(p), max(p)) for p in pairs if p[0] != p[1]]
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in some], kind) for k in (0, 1)], names=["u", "v"])


def shingle_sets(docs: DataFrame, text: str, key: str, ids: DataFrame) -> DataFrame:
    """(v, hashes, weights) of the documents that ``ids`` (v) names, one row for each of theirs."""
    rows = docs.select(F.col(key).alias("v"), F.col(text).alias("text"))
    rows = rows.join(broadcast_below(ids, BROADCAST_IDS), "v", "left_semi")
    schema = T.StructType([rows.schema["v"], *T.StructType.fromDDL("hashes array<bigint>, weights array<float>")])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                shingles, weights, owner, _, _ = weighted_shingles(batch.column("text"))
                cuts = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32())
                # Weights are 1 but for repeats; an empty array stands for all of them being 1.
                plain = np.bincount(owner, weights != 1, minlength=batch.num_rows) == 0
                sizes = np.where(plain, 0, np.diff(cuts.to_numpy()))
                kept = weights[~plain[owner]].astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("v"),
                        pa.ListArray.from_arrays(cuts, _signed(shingles)),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(kept)
                        ),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(collect, schema)


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose exact probability Jaccard reaches ``threshold``."""
    both = (
        pairs.join(sets.select(F.col("v"), F.col("hashes").alias("hv"), F.col("weights").alias("wv")), "v")
        .join(sets.select(F.col("v").alias("u"), F.col("hashes").alias("hu"), F.col("weights").alias("wu")), "u")
        .select("u", "v", "hu", "wu", "hv", "wv")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            columns = [batch.column(c) for c in ("hu", "wu", "hv", "wv")]
            for k in range(batch.num_rows):
                a, x, b, y = (c[k].values.to_numpy(zero_copy_only=False) for c in columns)
                x = x.astype(float) if len(x) else np.ones(len(a))
                y = y.astype(float) if len(y) else np.ones(len(b))
                a, b = a.view(np.uint64), b.view(np.uint64)
                keep[k] = probability_jaccard(a, x, b, y) >= threshold - 1e-9
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return both.mapInArrow(check, pairs.select("u", "v").schema)


class _Sets:
    """The weighted sets of some rows; ``plain`` rows have all weights 1."""

    def __init__(self, table: pa.Table):
        self.rows = []
        for column in zip(*(table.column(c).to_pylist() for c in ("hashes", "weights")), strict=True):
            hashes = np.array(column[0], np.int64).view(np.uint64)
            self.rows.append((hashes, np.array(column[1], float) if column[1] else np.ones(len(hashes))))
        self.plain = np.array([not w for w in table.column("weights").to_pylist()])
        self.sizes = np.array([len(h) for h, _ in self.rows])


def _common(one: _Sets, two: _Sets) -> np.ndarray:
    """How many shingles each row of one shares with each row of two, by parts of the vocabulary."""
    left, right = (np.concatenate([h for h, _ in x.rows]) for x in (one, two))
    shared = np.intersect1d(left, right)
    out = np.zeros((len(one.rows), len(two.rows)), np.float32)
    for start in range(0, len(shared), 8_192):
        part = shared[start : start + 8_192]
        sides = []
        for x in (one, two):
            dense = np.zeros((len(x.rows), len(part)), np.float32)
            for k, (h, _) in enumerate(x.rows):
                lo, hi = np.searchsorted(h, part[[0, -1]])
                own = h[lo : hi + 1]
                at = np.minimum(np.searchsorted(part, own), len(part) - 1)
                dense[k, at[part[at] == own]] = 1
            sides.append(dense)
        out += sides[0] @ sides[1].T
    return out


def _links_across(one: _Sets, two: _Sets, maybe: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs marked in ``maybe`` reach the threshold exactly."""
    if not maybe.any():
        return maybe
    common = _common(one, two)
    jaccard = common / np.maximum(one.sizes[:, None] + two.sizes[None, :] - common, 1)
    plain = one.plain[:, None] & two.plain[None, :]
    found = maybe & plain & (jaccard >= threshold - 1e-6)
    for i, j in zip(*np.nonzero(maybe & ~plain & (common > 0)), strict=True):
        found[i, j] = probability_jaccard(*one.rows[i], *two.rows[j]) >= threshold - 1e-9
    return found


def remaining_links(places: DataFrame, least: int, kind: T.DataType, threshold: float) -> DataFrame:
    """Links (u < v) between components of one tie, verified where the rows meet.

    No pairs leave a block but links, and of those only as many as tie its rows together.
    """
    keys = ["tie", "block_i", "block_s"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = None
        for what, table in block_events(batches, [*keys, "side"]):
            for start in range(0, table.num_rows, CHUNK):
                part = table.slice(start, CHUNK)
                now = (_registers(part), part.column("v").to_pylist(), part.column("component").to_pylist(), _Sets(part))
                if what == "home" and not start:
                    home = []
                if what == "home":
                    home.append(now)
                against = home if what == "visit" else home if table.column("own")[0].as_py() else []
                for other in against:
                    parts = np.array(other[2], object)[:, None] != np.array(now[2], object)[None, :]
                    maybe = parts & (_agreements(other[0], now[0]) >= least)
                    root: dict = {}

                    def find(x, root=root):
                        while root.get(x, x) != x:
                            x = root[x]
                        return x

                    found = []
                    for i, j in zip(*np.nonzero(_links_across(other[3], now[3], maybe, threshold)), strict=True):
                        a, b = find(other[2][i]), find(now[2][j])
                        if a != b:
                            root[max(a, b)] = min(a, b)
                            found.append((other[1][i], now[1][j]))
                    yield _pair_batch(found, table.schema.field("v").type)

    return by_block(places, *keys).mapInArrow(compare, _pairs_schema(kind)).distinct()


def _labelled(rows: DataFrame, components: DataFrame | None, name: str) -> DataFrame:
    """``rows`` with the component of v, which is v itself where it has no link."""
    if components is None:
        return rows.withColumn(name, F.col("v"))
    found = components.select(F.col("u").alias("v"), F.col("component").alias(name))
    return rows.join(found, "v", "left").withColumn(name, F.coalesce(name, "v"))


def _components(links: DataFrame) -> DataFrame | None:
    return stored(connected_components(links)) if links.limit(1).count() else None


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: key, component (least id of its class), n_words, kept.

    Documents link when the probability Jaccard of their shingles of five words, weighted
    by 1 + ln(count), is at least ``threshold``; classes are what links connect, and the
    document with the least id of a class is kept. Texts with the same words, lower-cased,
    are one class from the start and their copies are never compared.

    Candidates are pairs that share a band and whose registers agree in no fewer places
    than five standard errors below the threshold. First a spanning forest of each
    bucket's candidates is verified, which ties most classes together. What candidates
    connect but links don't is then compared once more, in blocks, between the parts.
    Nothing is capped, and no group's pairs are listed.

    Null text and text without words have no shingles, link with nothing and are kept.
    Rows with a null id link with nothing, have a null component and are kept. Rows that
    share an id are one document to the graph. Other columns are not read. An empty table
    gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType
    signed = stored(signatures(docs, text, key))
    known = signed.where((F.col("n_words") > 0) & F.col("id").isNotNull())
    classes = known.groupBy("a", "b", "n_words").agg(F.min(F.struct("id", "bands", "registers")).alias("least"))
    classes = stored(classes.select("a", "b", "n_words", F.col("least.id").alias("v"), "least.bands", "least.registers"))
    banded = classes.select("v", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    buckets = banded.join(sizes, "bucket").join(classes.select("v", "registers"), "v")
    least = least_estimate(threshold)
    pairs = stored(candidate_pairs(into_blocks(buckets, "bucket", "v", "size"), least, kind))
    ids = pairs.select("v").unionByName(pairs.select(F.col("u").alias("v"))).distinct()
    sets = shingle_sets(docs, text, key, ids)
    if known.groupBy("id").count().where(F.col("count") > 1).limit(1).count():
        sets = sets.dropDuplicates(["v"])
    sets = stored(sets)
    links = stored(verified(pairs, sets, threshold))
    tied = _components(links)

    ties = _labelled(_labelled(ids, _components(pairs), "tie"), tied, "component")
    ties = stored(ties)
    spread = ties.groupBy("tie").agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    spread = stored(spread.where("size > 2 AND low <> high").select("tie", "size"))
    if spread.limit(1).count():
        left = ties.join(spread, "tie").join(classes.select("v", "registers"), "v").join(sets, "v")
        more = remaining_links(into_blocks(left, "tie", "v", "size", home=TIE_HOME), least, kind, threshold)
        known = more if tied is None else more.unionByName(tied.select("u", F.col("component").alias("v")))
        tied = _components(stored(known))
    members = _labelled(classes.select("a", "b", "n_words", "v"), tied, "component").drop("v")
    found = signed.select("id", "a", "b", "n_words").join(members, ["a", "b", "n_words"], "left")
    alone = F.col("id").isNull() | (F.col("n_words") == 0)
    component = F.when(alone, F.col("id")).otherwise(F.col("component"))
    return found.select(
        F.col("id").alias(key),
        component.alias("component"),
        "n_words",
        (F.col("id").isNull() | (component == F.col("id"))).alias("kept"),
    )
