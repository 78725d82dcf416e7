"""Document quality by hierarchical empirical Bayes.

A classifier turns the shape of one text into a log likelihood ratio. Sites differ too:
the share of good documents of a host, and of a path within it, is estimated from the
classifier's evidence over all documents by grouped aggregation, and shrunk toward the
level above by as much as the spread between groups warrants. A document's posterior odds
are its own likelihood ratio times the prior odds of its path, without its own part in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patina.llm.shared import broadcast_below, ship, stored, text_slices
from patina.llm.words import find_words, hash_shingles, hash_words, text_bytes

SAMPLE = 8_000  # labelled rows that the classifier is fitted on, at most
RIDGE = 1.0
SHAPES = 135  # numbers that describe a text
BROADCAST_GROUPS = 100_000  # hosts or paths, a few numbers each
RESULT = ("evidence", "host_share", "path_share", "score", "keep")
TINY = 1e-4  # probabilities stay this far from 0 and 1


def shapes(texts: pa.Array) -> np.ndarray:
    """What each text looks like: shares of bytes, lengths, and how much it repeats itself."""
    raw, at = text_bytes(texts)
    n = len(at) - 1
    sizes = np.maximum(np.diff(at), 1)
    doc = np.repeat(np.arange(n), np.diff(at))
    bins = np.bincount(doc * 129 + np.minimum(raw, 128), minlength=n * 129).reshape(n, 129)
    starts, ends, owner = find_words(raw, at)
    words = hash_words(raw, starts, ends)
    count = np.bincount(owner, minlength=n)

    def distinct(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        total = np.bincount(of, minlength=n)
        order = np.lexsort((hashes, of))
        h, o = hashes[order], of[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        return np.bincount(o[first], minlength=n) / np.maximum(total, 1)

    length = np.bincount(owner, ends - starts, minlength=n) / np.maximum(count, 1)
    more = [
        np.log1p(np.diff(at)),
        np.log1p(count),
        length,
        distinct(words, owner),
        distinct(*hash_shingles(words, owner, n, 3)),
        count / sizes,
    ]
    return np.column_stack([np.sqrt(bins / sizes[:, None]), *more])


@dataclass
class QualityModel:
    """A logistic model over standardised shapes; ``base`` is the share of good labels."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    base: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        z = np.clip((shapes(texts) - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), TINY, 1 - TINY)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> QualityModel:
    """Ridge logistic regression by Newton steps."""
    base = (y.sum() + 0.5) / (len(y) + 1)
    if not len(y):
        return QualityModel(np.zeros(SHAPES), np.ones(SHAPES), np.zeros(SHAPES), 0.0, float(base))
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    w = np.zeros(z.shape[1])
    w[-1] = math.log(base / (1 - base))
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return QualityModel(mean, scale, w[:-1], float(w[-1]), float(base))


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    learn_from=None,
    sample: int = SAMPLE,
) -> QualityModel:
    """Fit the classifier on at most ``sample`` labelled rows, drawn by a hash of the key.

    Null keys and labels are left out, and a key that several rows share gives one text.
    Without labels every text has even odds.
    """
    ship(docs.sparkSession)
    allowed = (lambda c: F.lit(True)) if learn_from is None else learn_from
    known = labels.groupBy(F.col(key).alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isNotNull() & allowed(F.col("id")))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "label").agg(F.max("text").alias("text")).select("label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                found = pa.array(shapes(batch.column("text")).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("label"), found], names=["label", "shape"])

    got = rows.mapInArrow(extract, "label int, shape array<double>").toArrow()
    x = np.array(got.column("shape").to_pylist(), float).reshape(got.num_rows, SHAPES)
    return fit(x, np.array(got.column("label").to_pylist(), float))


def strength(groups: DataFrame) -> float:
    """How many documents the level above counts for, from the spread between groups.

    ``groups`` has n and good (the sum of probabilities) of each group. Moments of the beta
    binomial give the correlation within groups; without spread a group counts for little.
    """
    share = F.col("good") / F.col("n")
    k, total, squares, good, spread = groups.agg(
        F.count(F.lit(1)),
        F.sum("n"),
        F.sum(F.col("n").cast("double") * F.col("n")),
        F.sum("good"),
        F.sum(F.col("n") * share * share),
    ).first()
    if not k or k < 2:
        return 100.0
    mean = good / total
    noise = max(mean * (1 - mean), 1e-9)
    between = spread - total * mean * mean
    room = total - squares / total - (k - 1)
    correlation = (between - noise * (k - 1)) / (noise * room) if room > 0 else 0.0
    return 1 / min(max(correlation, 1e-4), 0.5) - 1


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def score(
    docs: DataFrame,
    model: QualityModel,
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add evidence, host_share, path_share, score and keep to columns ``keep`` of every row.

    ``evidence`` is the log likelihood ratio of the text, ``host_share`` and ``path_share``
    the shrunk shares of good documents among the others of its host and of its path
    within the host, ``score`` the posterior probability that the document is good, and
    ``keep`` whether that is at least one half. Columns of these names are replaced.

    Null and empty texts are judged by their shape, all zeros; a null host or path is a
    group of its own; a site with one document takes the prior of the level above.
    Repeated rows count each time. An empty table gives no rows. The kept columns and the
    text's probability are written to shared storage once, for both levels are sums over
    all documents; keep long texts out of ``keep`` and join them by key.
    """
    spark = docs.sparkSession
    ship(spark)
    held = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    rows = docs.select(
        F.struct(*held).alias("row"), F.col(host).alias("host"), F.col(path).alias("path"), F.col(text).alias("text")
    )
    schema = T.StructType([rows.schema[c] for c in ("row", "host", "path")]).add("p", "double")
    sent = spark.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                p = pa.array(sent.value.probabilities(batch.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "host", "path")), p], names=schema.names
                )

    judged = stored(rows.mapInArrow(apply, schema))
    sums = (F.count(F.lit(1)).alias("n"), F.sum("p").alias("good"))
    paths = judged.groupBy("host", "path").agg(*sums)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    n, good = hosts.agg(F.sum("n"), F.sum("good")).first()
    overall = min(max(good / n if n else 0.5, TINY), 1 - TINY)
    of_host, of_path = strength(hosts), strength(paths)
    both = (
        paths.alias("p")
        .join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host")))
        .select("p.host", "path", "p.n", "p.good", F.col("h.n").alias("host_n"), F.col("h.good").alias("host_good"))
    )
    joined = judged.alias("j").join(
        broadcast_below(both, BROADCAST_GROUPS).alias("g"),
        F.col("j.host").eqNullSafe(F.col("g.host")) & F.col("j.path").eqNullSafe(F.col("g.path")),
    )
    near = lambda p: F.least(F.lit(1 - TINY), F.greatest(F.lit(TINY), p))
    host_share = near((of_host * overall + F.col("host_good") - F.col("p")) / (of_host + F.col("host_n") - 1))
    path_share = near((of_path * F.col("host_share") + F.col("good") - F.col("p")) / (of_path + F.col("n") - 1))
    evidence = log_odds(F.col("p")) - math.log(model.base / (1 - model.base))
    return (
        joined.withColumn("host_share", host_share)
        .withColumn("path_share", path_share)
        .withColumn("evidence", evidence)
        .withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + log_odds(F.col("path_share"))))))
        .select("row.*", *RESULT[:-1], (F.col("score") >= 0.5).alias("keep"))
    )
