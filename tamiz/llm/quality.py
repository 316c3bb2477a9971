"""Quality classification by hierarchical empirical Bayes.

1. Evidence: two logistic models (low quality, toxic) over the words of a document, as hashed presence, and its shape (shares of
   capitals, punctuation, digits, repeated words and lines, ...). They are fitted on at most ``SAMPLE`` labelled documents,
   chosen by a hash of doc_id.
2. Sites: the evidence of all documents is summed up by path and by host. A host's posterior rate shrinks toward the global rate,
   a path's toward its host's, with strengths estimated by the method of moments from the spread between hosts and
   between the paths of a host: a site of few documents says little, a site like all others says nothing. The path's
   posterior that a document meets leaves its own evidence out.
3. Decision: a document's log-odds are its evidence, with the global rate taken out, plus its path's posterior log-odds. It is kept if
   neither being of low quality nor being toxic is more likely than ``threshold``.

* a null or empty text has no words and the shape of an empty text; null hosts and paths are sites of their own;
* no usable label (an empty table, nulls, one class only): that model says nothing, and its rate is 0 if no bad label was seen;
* repeated labels of a document count once, the worst of them; rows with equal doc_id are judged each by their own text;
* an empty table of documents gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import bounded_broadcast, lean, same_row, text_mark
from .words import LETTERS, Words, pieces

#: Labelled documents that the models are fitted on, at most.
SAMPLE = 20_000
#: Hash buckets of words; after them the bins of the shape measures.
BUCKETS = 1 << 18
#: A word is used if it is in so many sampled documents and its share differs between the classes by so many deviations.
SEEN, APART = 4, 4.0
TARGETS = ("low", "toxic")

_BINS = np.array([0.002, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97])
_SHAPES = 9
WIDTH = BUCKETS + _SHAPES * (len(_BINS) + 1) + 24


def _class(*ranges: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    for r in ranges:
        out[list(r)] = 1
    return out


_KINDS = [
    _class(range(0x41, 0x5B)),  # capitals
    _class(range(0x30, 0x3A)),  # digits
    _class(range(0x21, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x7F)),  # ASCII punctuation
    _class(b"#$%&*|~^<>=+@\\_"),  # signs that prose has few of
    _class(b"!?"),
    _class(range(0x80, 0xC0)),  # characters beyond ASCII (their second and later bytes)
]


def features(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """For runs of texts of a column, the distinct feature numbers of each text."""
    for _, _, data, offsets in pieces(column):
        words = Words(data, offsets, LETTERS, by_bytes=True)
        sizes = np.diff(offsets)
        n = np.diff(words.bounds)
        upto = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
        shares = [upto(kind[data]) / np.maximum(sizes, 1) for kind in _KINDS]
        shares[0] = upto(_KINDS[0][data]) / np.maximum(upto(LETTERS[data].astype(np.int64)), 1)
        again = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        if len(words.hashes) > 1:
            again[2:] = np.cumsum(words.hashes[1:] == words.hashes[:-1])
        out = []
        for r in range(len(sizes)):
            a, b = int(words.bounds[r]), int(words.bounds[r + 1])
            distinct = np.unique(words.hashes[a:b])
            lines = data[offsets[r] : offsets[r + 1]].tobytes().split(b"\n")
            shape = [s[r] for s in shares]
            shape.append(len(distinct) / max(n[r], 1))
            shape.append((again[b] - again[a + 1]) / max(n[r], 1) if b > a else 0.0)
            shape.append(len(set(lines)) / len(lines))
            bins = np.searchsorted(_BINS, shape) + np.arange(_SHAPES) * (len(_BINS) + 1)
            length = _SHAPES * (len(_BINS) + 1) + min(int(n[r]).bit_length(), 23)
            words_in = np.unique(distinct & np.uint64(BUCKETS - 1)).astype(np.int64)
            out.append(np.concatenate([words_in, BUCKETS + bins, [BUCKETS + length]]))
        yield out


class Model(NamedTuple):
    """Log-odds of a document: ``base`` plus the weights of its features. ``rate``: the share of the sample that is bad."""

    base: float
    rate: float
    used: np.ndarray
    weights: np.ndarray

    def score(self, lists: list[np.ndarray]) -> np.ndarray:
        table = np.zeros(WIDTH)
        table[self.used] = self.weights
        flat = table[np.concatenate(lists)]
        return self.base + np.add.reduceat(flat, np.cumsum([0, *map(len, lists[:-1])]))


def fit(lists: list[np.ndarray], bad: np.ndarray, rounds: int = 150, ridge: float = 1.0) -> Model:
    """Logistic regression on the features that tell the classes apart, by gradient steps scaled per feature."""
    none = np.zeros(0, dtype=np.int64)
    if not len(bad) or bad.all() or not bad.any():
        rate = float(bad.mean()) if len(bad) else 0.0
        return Model(float(np.log((rate + 1e-6) / (1 - rate + 1e-6))), rate, none, np.zeros(0))
    flat = np.concatenate(lists)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    in_all = np.bincount(flat, minlength=WIDTH)
    in_bad = np.bincount(flat, weights=bad[row], minlength=WIDTH)
    rate, n = bad.mean(), len(bad)
    spread = np.sqrt(np.maximum(in_all * rate * (1 - rate) * (1 - in_all / (n + 1)), 1e-9))
    used = np.flatnonzero((in_all >= SEEN) & ((np.abs(in_bad - in_all * rate) / spread >= APART) | (np.arange(WIDTH) >= BUCKETS)))
    place = np.full(WIDTH, -1, dtype=np.int64)
    place[used] = np.arange(len(used))
    column = place[flat]
    row, column = row[column >= 0], column[column >= 0]
    weights, base = np.zeros(len(used)), float(np.log(rate / (1 - rate)))
    seen_w, seen_b = np.zeros(len(used)), 0.0
    pull = np.zeros(len(used))
    for _ in range(rounds):
        odds = base + np.bincount(row, weights=weights[column], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - bad
        slope = np.bincount(column, weights=error[row], minlength=len(used)) + ridge * weights
        seen_w += slope**2
        seen_b += error.sum() ** 2
        pull = 0.8 * pull + slope / (np.sqrt(seen_w) + 1e-9)
        weights -= 0.3 * pull
        base -= 0.1 * error.sum() / (np.sqrt(seen_b) + 1e-9)
    return Model(float(base), float(rate), used, weights)


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [x.astype("<i4").tobytes() for run in features(batch.column(2)) for x in run]
        arrays = [batch.column(0), batch.column(1), pa.array(lists, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["low", "toxic", "features"])


def _fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both models; the input is the bounded sample."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    lists = [np.frombuffer(x, dtype="<i4").astype(np.int64) for x in table.column("features").to_pylist()]
    models = [fit(lists, np.asarray(table.column(t), dtype=np.float64)) for t in TARGETS]
    arrays = [
        pa.array(TARGETS),
        pa.array([m.base for m in models], pa.float64()),
        pa.array([m.rate for m in models], pa.float64()),
        pa.array([m.used for m in models], pa.list_(pa.int64())),
        pa.array([m.weights for m in models], pa.list_(pa.float64())),
    ]
    yield pa.RecordBatch.from_arrays(arrays, names=["target", "base", "rate", "used", "weights"])


def train(docs: DataFrame, labels: DataFrame) -> dict[str, Model]:
    """The two models, fitted in one task on SAMPLE rows at most, of the documents whose ids hash lowest.

    Of rows with one doc_id the first by text hash stands for the document, so a repeated id takes no more of the sample.
    """
    usable = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy("doc_id")
        .agg((F.min("quality") < 1).cast("int").alias("low"), (F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), text_mark().alias("mark")).join(F.broadcast(chosen), "doc_id")
    # Spark keeps one row of an id in each task before the rows move; an id has one place in the sample.
    texts = texts.withColumn("nth", F.expr("row_number() over (partition by doc_id order by mark)")).where("nth = 1")
    rows = texts.select("low", "toxic", "text").mapInArrow(lean(_sampled), "low int, toxic int, features binary")
    schema = "target string, base double, rate double, used array<long>, weights array<double>"
    found = rows.repartition(1).mapInArrow(_fitted, schema).collect()
    return {r.target: Model(r.base, r.rate, np.array(r.used, dtype=np.int64), np.array(r.weights)) for r in found}


def _scored(batches: Iterable[pa.RecordBatch], models: list[Model]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [[m.score(lists) for m in models] for lists in features(batch.column(3))]
        scores = [pa.array(np.concatenate([r[k] for r in runs]) if runs else [], pa.float64()) for k in range(len(models))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(4), *scores], names=["doc_id", "host", "path", "mark", *TARGETS])


def _odds(p: Column) -> Column:
    inside = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(inside / (1 - inside))


def _rate(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _strength(df: DataFrame, t: str, centre: Column) -> Column:
    """How many documents the level above counts for: from the spread of the groups' rates beyond what chance gives."""
    p = F.col(f"{t}_sum") / F.col("n")
    chance = centre * (1 - centre)
    excess = F.sum(F.col("n") * ((p - centre) ** 2) - chance) / F.sum("n")
    return F.when(excess > 1e-9, F.least(F.lit(1e6), F.avg(chance) / excess)).otherwise(1e6)


def posteriors(scored: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """For each (host, path) its documents and their summed evidence, its host's rate and what a path's strength is, and the global rates.

    What a document itself adds to its path is taken out again by ``own_site``, so that its evidence counts once.
    """
    sums = [F.sum(_rate(F.col(t))).alias(f"{t}_sum") for t in TARGETS]
    paths = written_once(scored.groupBy("host", "path").agg(F.count("*").alias("n"), *sums), "paths")
    add = [F.sum("n").alias("n"), *[F.sum(f"{t}_sum").alias(f"{t}_sum") for t in TARGETS]]
    hosts = written_once(paths.groupBy("host").agg(*add), "hosts")
    total = hosts.agg(*add).first()
    rates = {t: (total[f"{t}_sum"] / total["n"] if total["n"] else 0.0) for t in TARGETS}
    if not total["n"]:
        nothing = [F.lit(0.0).alias(f"{t}_{x}") for t in TARGETS for x in ("sum", "host", "strength")]
        return paths.select("host", "path", "n", *nothing), rates
    strong = hosts.agg(*[_strength(hosts, t, F.lit(rates[t])).alias(t) for t in TARGETS]).first()
    hosts = hosts.select(
        F.col("host").alias("own_host"),
        *[((strong[t] * rates[t] + F.col(f"{t}_sum")) / (strong[t] + F.col("n"))).alias(f"{t}_host") for t in TARGETS],
    )
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["own_host"]))
    within = both.agg(*[_strength(both, t, F.col(f"{t}_host")).alias(t) for t in TARGETS]).first()
    known = [c for t in TARGETS for c in (F.col(f"{t}_sum"), F.col(f"{t}_host"), F.lit(float(within[t] or 0.0)).alias(f"{t}_strength"))]
    return both.select("host", "path", "n", *known), rates


def own_site(t: str) -> Column:
    """The shrunken rate of a document's path without the document itself; a path of one document has its host's rate."""
    others, n = F.col(f"{t}_sum") - _rate(F.col(t)), F.col("n") - 1
    weight = F.col(f"{t}_strength") + n
    return F.when(weight > 0, (F.col(f"{t}_strength") * F.col(f"{t}_host") + F.greatest(others, F.lit(0.0))) / weight).otherwise(F.col(f"{t}_host"))


def classify(
    docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, threshold: float = 0.5
) -> DataFrame:
    """doc_id, host, path, low_evidence, toxic_evidence (log-odds), low_rate, toxic_rate (posterior), kept, and the text's mark.

    ``host`` and ``path`` default to a document's source, and its language within the source.
    """
    host = F.col("source") if host is None else host
    path = F.concat_ws("/", F.col("source"), F.col("lang")) if path is None else path
    models = train(docs, labels)
    empty = Model(-20.0, 0.0, np.zeros(0, dtype=np.int64), np.zeros(0))
    both = [models.get(t, empty) for t in TARGETS]
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        F.col("text").cast("string").alias("text"),
        text_mark().alias("mark"),
    )
    schema = "doc_id long, host string, path string, mark long, low double, toxic double"
    scored = written_once(narrow.mapInArrow(lean(lambda b: _scored(b, both)), schema), "evidence")
    sites, rates = posteriors(scored)
    sites = written_once(sites.withColumnsRenamed({"host": "h", "path": "p"}), "sites")
    on = scored["host"].eqNullSafe(F.col("h")) & scored["path"].eqNullSafe(F.col("p"))
    joined = scored.join(bounded_broadcast(sites), on)
    posterior = {t: _rate(F.col(t) - _odds(F.lit(rates[t])) + _odds(own_site(t))) for t in TARGETS}
    return joined.select(
        "doc_id",
        "host",
        "path",
        *[F.col(t).alias(f"{t}_evidence") for t in TARGETS],
        *[p.alias(f"{t}_rate") for t, p in posterior.items()],
        ((posterior["low"] <= threshold) & (posterior["toxic"] <= threshold)).alias("kept"),
        "mark",
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``classify`` keeps. Rows with equal doc_id, or without one, are judged each for itself."""
    judged = classify(docs, labels).where("not kept").select("doc_id", "mark", "host", "path").distinct()
    told = written_once(judged.withColumnsRenamed({c: f"_told_{c}" for c in judged.columns}), "rejected")
    site = docs["source"].cast("string").eqNullSafe(F.col("_told_host"))
    site = site & F.concat_ws("/", docs["source"], docs["lang"]).eqNullSafe(F.col("_told_path"))
    return docs.join(bounded_broadcast(told), same_row(docs, "_told_doc_id", "_told_mark") & site, "left_anti").select(docs.columns)


def labels_of(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")
