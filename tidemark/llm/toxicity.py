"""Toxicity by class-conditional Kneser-Ney models of pairs.

A unit is a word cut to its first ``UNIT`` letters, as forms of an expression share these. Each class has a model that
backs off from pairs to single units, and both classes share what lies below:

    p(w | v, class) = max(c(v w) - D, 0) / c(v) + l(v) * p(w | class)        counts of the class
    p(w | class)    = max(N(. w) - E, 0) / N(. .) + m * q(w)                 different units before w in the class
    q(w)            = max(M(. w) - S, 0) / M(. .) + k / (units + 1)          different units before w in either class

where l, m and k hand on what the discounts take; a context that the class has not seen goes on to the next line. Rare
expressions thus say little: what both classes back off to is the same. The score compares the log-likelihoods of the
two classes, normalised by length: the mean over the units of what the toxic one is higher beyond ``MARGIN`` nats, put
through a logistic curve. The margin cuts off the noise of ordinary units. It and the discounts were chosen on fold 4 of
the table of scale 0.1; the README has the figures, also without a margin.

Learned from labelled rows whose crc32(key) mod 5 is not 0, at most ``SAMPLE`` of each label in a fixed pseudo-random
order: mod 1 to 3 give the counts, mod 4 the curve. Scoring reads whole texts. The model that goes to the tasks holds
what can pass the margin and the contexts of pairs above the discount, so it is bounded by the sample, not by the corpus.

Defined cases: a text without words (null, empty) has no evidence and gets the curve's value there; rows are scored one
by one, equal rows equally; keys that are labelled twice count twice; null labels and labels of unknown keys are ignored;
without labels of both classes every score is the share of toxic labels (0 without any); an empty table gives no rows;
other columns travel with their row where asked for, those named like a result column are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import crc_bucket, slices, texts, written

WORD = re.compile(r"[^\W\d_]+")
#: Letters of a unit.
UNIT = 4
#: Discounts of pairs, of units before a unit in one class, and in either; nats of a unit that do not count.
PAIR_DISCOUNT, UNIT_DISCOUNT, SHARED_DISCOUNT, MARGIN = 3.0, 1.0, 0.75, 2.0
SAMPLE = 20_000
FLOOR = 1e-3
#: Pairs that a task counts before it hands them on.
HELD_PAIRS = 100_000
#: Stands before the first unit.
START = ""


def units(text: str) -> list[str]:
    return [word[:UNIT] for word in WORD.findall(text.lower())]


class Model(NamedTuple):
    """Differences of the log-likelihoods, toxic less ordinary; ``slope`` and ``shift`` of the curve.

    The difference of a pair that is not in ``pairs`` is that of its unit plus that of its context (0 where there is none).
    ``rest`` is that of all units that are not in ``words``; ``most`` the largest of the contexts.
    """

    words: dict[str, float]
    contexts: dict[str, float]
    pairs: dict[tuple[str, str], float]
    rest: float
    most: float
    slope: float
    shift: float

    def evidence(self, text: str) -> float:
        found = units(text)
        if not found:
            return 0.0
        words, contexts, pairs, total, before = self.words, self.contexts, self.pairs, 0.0, START
        none = self.rest if self.rest + self.most > MARGIN else None
        for word in found:
            value = words.get(word, none)
            if value is not None:
                pair = pairs.get((before, word))
                if pair is None:
                    pair = value + contexts.get(before, 0.0)
                if pair > MARGIN:
                    total += pair - MARGIN
            before = word
        return total / len(found)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(evidence + FLOOR) + self.shift, -500, 500)))


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``text``, ``toxic`` and ``fold`` of a bounded number of labelled rows of the learning folds."""
    known = labels.select(labels[key].alias("k"), labels[label].cast("int").alias("toxic")).where("toxic IN (0, 1)") \
        .where(crc_bucket(F.col("k"), 5) != 0)
    picked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("k"), "k").limit(SAMPLE) for c in (0, 1)]
    ids = F.broadcast(picked[0].union(picked[1]))  # 2 * SAMPLE keys at most
    source = docs.select(docs[key].alias("k"), docs[text].alias("text"))
    return written(source.join(ids, "k").select("text", "toxic", crc_bucket(F.col("k"), 5).alias("fold")), "labelled")


def _counts(sample: DataFrame) -> DataFrame:
    """``v``, ``w``, ``t`` and ``o``: how often unit w follows unit v in toxic and ordinary rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            pairs = list(by[0].keys() | by[1].keys())
            found = pa.RecordBatch.from_pydict({
                "v": pa.array([p[0] for p in pairs], pa.string()), "w": pa.array([p[1] for p in pairs], pa.string()),
                "t": pa.array([by[1][p] for p in pairs], pa.int64()), "o": pa.array([by[0][p] for p in pairs], pa.int64())})
            by[0].clear()
            by[1].clear()
            return found

        for batch in batches:
            for value, toxic in zip(texts(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                found = units(value)
                by[toxic].update(zip([START, *found], found))  # the first unit follows the start
                if len(by[0]) + len(by[1]) > HELD_PAIRS:
                    yield out()
        if by[0] or by[1]:
            yield out()

    rows = sample.select("text", "toxic").mapInArrow(run, "v string, w string, t bigint, o bigint")
    return written(rows.groupBy("v", "w").agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "pair-counts")


def _tables(counts: DataFrame) -> Model:
    """The model without its curve."""
    above = lambda c, d: F.greatest(F.col(c) - d, F.lit(0.0))
    below = lambda c, d: F.sum(F.least(F.col(c), F.lit(d)))
    words = written(counts.groupBy("w").agg(
        F.count_if(F.col("t") > 0).alias("t"), F.count_if(F.col("o") > 0).alias("o"), F.count(F.lit(1)).alias("both")), "word-counts")
    n_t, n_o, n_both, kinds, m_t, m_o = words.agg(
        F.sum("t"), F.sum("o"), F.sum("both"), F.count(F.lit(1)), below("t", UNIT_DISCOUNT), below("o", UNIT_DISCOUNT)).first()
    if not n_t or not n_o:
        return Model({}, {}, {}, 0.0, 0.0, 1.0, 0.0)
    shared = above("both", SHARED_DISCOUNT) / n_both + SHARED_DISCOUNT * kinds / n_both / (kinds + 1)
    words = words.withColumn("q", shared).select(
        "w", (above("t", UNIT_DISCOUNT) / n_t + m_t / n_t * F.col("q")).alias("pt"), (above("o", UNIT_DISCOUNT) / n_o + m_o / n_o * F.col("q")).alias("po"))
    contexts = counts.groupBy("v").agg(
        F.sum("t").alias("nt"), F.sum("o").alias("no"), below("t", PAIR_DISCOUNT).alias("lt"), below("o", PAIR_DISCOUNT).alias("lo"))
    share = lambda c: F.when(F.col(f"n{c}") > 0, F.col(f"l{c}") / F.col(f"n{c}")).otherwise(1.0)
    contexts = written(contexts.select("v", "nt", "no", share("t").alias("lt"), share("o").alias("lo")), "contexts")
    known = {r["v"]: r["d"] for r in contexts.select("v", F.log(F.col("lt") / F.col("lo")).alias("d")).where("d <> 0").collect()}
    most = max([0.0, *known.values()])
    apart = F.log(F.col("pt") / F.col("po"))
    pair = lambda c: above(c, PAIR_DISCOUNT) / F.greatest(F.col(f"n{c}"), F.lit(1)) + F.col(f"l{c}") * F.col(f"p{c}")
    often = counts.where(F.greatest("t", "o") > PAIR_DISCOUNT).join(contexts, "v").join(words, "w").select(
        "v", "w", F.log(pair("t") / pair("o")).alias("d"), (apart + F.log(F.col("lt") / F.col("lo"))).alias("without"), apart.alias("word"))
    pairs = often.where((F.col("d") > MARGIN) | (F.col("without") > MARGIN)).collect()
    single = {r["w"]: r["d"] for r in words.select("w", apart.alias("d")).where(F.col("d") + most > MARGIN).collect()}
    return Model(single | {r["w"]: r["word"] for r in pairs}, known, {(r["v"], r["w"]): r["d"] for r in pairs},
                 float(np.log((m_t / n_t) / (m_o / n_o))), most, 1.0, 0.0)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve by Newton steps, held a little towards none."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    a = np.stack([np.log(x + FLOOR), np.ones(len(x))], axis=1)
    w, hold = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + hold, a.T @ (y - p) - hold @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    sample = _sample(docs, labels, key, text, label)
    model = _tables(_counts(sample.where("fold < 4")))
    held = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                pa.array([held.value.evidence(v) for v in texts(batch.column("text"))], pa.float64()), batch.column("toxic")], names=["x", "y"])

    rows = sample.where("fold = 4").select("text", "toxic").mapInArrow(run, "x double, y int").collect()
    slope, shift = _curve(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float))
    return model._replace(slope=slope, shift=shift)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The kept columns with ``score`` (0 to 1) and ``predicted``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    source = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text].alias("text"))
    return _scored(source, model, len(keep), lambda batch: batch.column("text")).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _scored(source: DataFrame, model: Model, kept: int, text_of: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """The first ``kept`` columns, which come back as they are, and ``score``."""
    held = source.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([held.value.evidence(v) for v in texts(text_of(batch))], float)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(held.value.score(x))], names=[*batch.schema.names[:kept], "score"])

    return source.mapInArrow(run, T.StructType([*source.schema.fields[:kept], T.StructField("score", T.DoubleType())]))


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, columns unchanged, that are not predicted to be toxic."""
    model = fit(docs, labels, key, text)
    at = [c.lower() for c in docs.columns].index(text.lower())
    rows = docs.select(F.struct("*").alias("row"))  # the text goes to the task once, inside its row
    return _scored(rows, model, 1, lambda batch: batch.column("row").field(at)).where("score < 0.5").select("row.*")
