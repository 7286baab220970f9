"""Trained models: held-out figures and plain versions."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import LINE, TEXTS, documents, nothing
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ctw, licences, quality, toxicity
from tidemark.llm.common import slices
from tidemark.llm.queries import QUERIES

LABELS = "doc_id bigint, toxic int, score string"


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op6_toxicity"](spark, folder).join(read(spark, folder, "labels"), "doc_id").where("held_out").collect()
    y, s = np.array([r["toxic"] for r in rows]), np.array([r["score"] for r in rows])
    better = (s[y == 1][:, None] > s[y == 0]).mean() + (s[y == 1][:, None] == s[y == 0]).mean() / 2
    assert better > 0.9 and all(0 <= v <= 1 for v in s)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_learns_from_the_folds_only(spark):
    docs = documents(spark, [(i, f"{LINE} {'vile' if i % 2 else 'kind'} {i}") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(200)] + [(3, None, "x"), (9999, 1, "x"), (None, 1, "x")], LABELS)
    model = toxicity.fit(docs, labels)
    assert model.evidence(f"{LINE} vile") > 0 and model.evidence(f"{LINE} kind") == model.evidence("kind") == 0
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, flipped) == model
    out = toxicity.score(documents(spark), model, keep=["doc_id", "score", "text"])
    assert out.columns == ["doc_id", "text", "score", "predicted"] and out.count() == len(TEXTS)
    kept = toxicity.without_toxic(docs.union(documents(spark, [(None, f"{LINE} vile")])), labels)
    assert kept.columns == docs.columns and {r["doc_id"] % 2 for r in kept.collect()} == {0}


def plain_pairs(rows, d2=3.0, d1=1.0, d0=0.75):
    """Kneser-Ney models of two classes, word by word; returns the difference of their logarithms for a pair."""
    pairs, before, after = [Counter(), Counter()], [Counter(), Counter()], [Counter(), Counter()]
    for text, toxic in rows:
        words = toxicity.units(text or "")
        pairs[toxic].update(zip(["", *words], words))
    shared = Counter(w for _, w in pairs[0].keys() | pairs[1].keys())
    for c in (0, 1):
        for (v, w), n in pairs[c].items():
            before[c][w] += 1
            after[c][v] += n
    total = sum(shared.values())

    def p(c, v, w):
        q = max(shared[w] - d0, 0) / total + d0 * len(shared) / total / (len(shared) + 1)
        size = sum(before[c].values())
        one = max(before[c][w] - d1, 0) / size + sum(min(n, d1) for n in before[c].values()) / size * q
        if not after[c][v]:
            return one
        freed = sum(min(n, d2) for (x, _), n in pairs[c].items() if x == v) / after[c][v]
        return max(pairs[c][v, w] - d2, 0) / after[c][v] + freed * one

    return lambda v, w: np.log(p(1, v, w) / p(0, v, w))


def test_toxicity_equals_plain_kneser_ney(spark):
    rng = np.random.default_rng(3)
    common, bad = [f"w{chr(97 + i)}" for i in range(12)], ["vile", "awful", "nasty"]
    rows = []
    for i in range(60):
        toxic = int(i % 3 == 0)
        words = [str(rng.choice(common)) for _ in range(int(rng.integers(0, 30)))]
        for _ in range(4 * toxic):
            words.insert(int(rng.integers(0, len(words) + 1)), "so " + str(rng.choice(bad)))
        rows.append((" ".join(words) or None, toxic))
    learned = spark.createDataFrame(rows, "text string, toxic int")
    model, apart = toxicity._tables(toxicity._counts(learned)), plain_pairs(rows)
    seen = [t or "" for t, _ in rows] + ["", "so vile unseen", "unseen vile", "wa wb so so so", "nasty nasty nasty"]
    for text in seen:
        words = toxicity.units(text)
        want = sum(max(apart(v, w) - toxicity.MARGIN, 0.0) for v, w in zip(["", *words], words)) / max(len(words), 1)
        assert model.evidence(text) == pytest.approx(want, abs=1e-9), text
    assert model.pairs and model.words and max(model.evidence(t) for t in seen) > 0


def test_toxicity_without_labels(spark):
    model = toxicity.fit(documents(spark), spark.createDataFrame([], LABELS))
    assert {r["predicted"] for r in toxicity.score(documents(spark), model).collect()} == {0}
    assert toxicity.score(nothing(spark), model).count() == 0


class PlainTree:
    """Context-tree weighting by recursion over counts in dictionaries."""

    def __init__(self, texts, depth=ctw.DEPTH):
        self.depth, self.counts, self.seen = depth, Counter(), {}
        for t in texts:
            for context, node, bit in self.walk(t):
                for d in range(depth + 1):
                    self.counts[context[len(context) - d:], node, bit] += 1
        self.children = {}
        for context, node, _ in self.counts:
            if context:
                self.children.setdefault((context[1:], node), set()).add(context)

    def walk(self, data):
        data = bytes(self.depth) + data + bytes([255])
        for i in range(self.depth, len(data)):
            for k in range(8):
                yield data[i - self.depth:i], (1 << k) | data[i] >> (8 - k), data[i] >> (7 - k) & 1

    def kt(self, context, node):
        a, b = self.counts[context, node, 0], self.counts[context, node, 1]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi), (b + .5) / (a + b + 1)

    def weighted(self, context, node):
        if (context, node) not in self.seen:
            own = self.kt(context, node)[0]
            if len(context) < self.depth:
                below = sum(self.weighted(c, node) for c in self.children.get((context, node), ()))
                own, kt = math.log(.5) + np.logaddexp(own, below), own
                self.seen[context, node] = (own, math.exp(math.log(.5) + kt - own))
            else:
                self.seen[context, node] = (own, 1.0)
        return self.seen[context, node][0]

    def chance(self, context, node, d=0):
        here = context[len(context) - d:]
        if not self.counts[here, node, 0] + self.counts[here, node, 1]:
            return .5 if d == 0 else None
        self.weighted(here, node)
        p, w = self.kt(here, node)[1], self.seen[here, node][1]
        deeper = self.chance(context, node, d + 1) if d < self.depth else None
        return p if deeper is None else w * p + (1 - w) * deeper

    def score(self, data):
        return sum(math.log10(p if bit else 1 - p) for c, n, bit in self.walk(data) for p in [self.chance(c, n)])


@pytest.mark.parametrize("fast", [0, 20, 1 << 20])
def test_code_lengths_equal_the_plain_tree(spark, monkeypatch, fast):
    monkeypatch.setattr(ctw, "FAST", fast)
    monkeypatch.setattr(ctw, "FAST_WORDS", fast)
    rows = [r for r in TEXTS if len(r[1] or "") < 2000] + [(i, f"{LINE[i % 30:]} Word{i} {i}") for i in range(20, 40)]
    train = [(k, t) for k, t in rows if zlib.crc32(("" if k is None else str(k)).encode()) % 7 != 2]
    low = lambda t: (t or "").encode().translate(ctw._LOWER)
    plain = PlainTree([low(t) for _, t in train])
    words = Counter(w for _, t in train for w in low(t).split())
    n, v = sum(words.values()) + len(train), len(words) + 1
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"], r["n_bytes"])
                 for r in ctw.score_texts(documents(spark, rows), ~ctw.held_out(F.col("doc_id"))).collect())
    want = []
    for k, t in rows:
        own = low(t).split()
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own) + math.log10((len(train) + 1) / (n + v + 1))
        want.append((k or 0, len(own) + 1, sum(words[w] > 0 for w in own) + 1, n, base, plain.score(low(t)), len(low(t)) + 1))
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want), strict=True):
        assert a == pytest.approx(b, rel=1e-9)


def test_scores_without_training_rows(spark):
    out = ctw.score_texts(documents(spark, [(1, "ab"), (1, None)]), F.lit(False)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in out) == [(1, 0, 0), (2, 0, 0)]
    assert sorted(round(r["score"] / math.log10(.5), 6) for r in out) == [8, 24]
    assert ctw.score_texts(nothing(spark), F.lit(True)).count() == 0


def test_held_out_bits(spark):
    """The tree beats the word counts on texts that it has not seen."""
    rows = QUERIES["op7_context_tree"](spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert rows[1] > rows[0]


def test_chances_sum_to_one(spark):
    docs = documents(spark, [(1, "abracadabra"), (3, "abrakadabra")])
    levels, seen = ctw.tree(ctw.gram_counts(docs))
    for context in (b"abrac", b"zzzzz", b"zabra"):
        base = int.from_bytes(context) << 8
        keys = spark.range(256).select((F.col("id") + base).alias("key"))
        total = ctw.unseen_lengths(keys, levels).agg(F.sum(F.pow(F.lit(10.0), "lp"))).first()[0]
        assert total == pytest.approx(1, rel=1e-9)
    both = seen.join(ctw.unseen_lengths(seen.select("key"), levels).withColumnRenamed("lp", "other"), "key")
    assert both.count() == seen.count() and all(r["lp"] == pytest.approx(r["other"], rel=1e-9) for r in both.collect())


def test_licences(spark):
    notice = "This work is licensed under the GNU General Public License, version 3."
    texts = [(100 + i, f"{LINE} number {i}\nanother line about license plates and the free software that the public may use {i}") for i in range(60)]
    texts += [(1, f"{LINE}\n{notice}\nmore"), (2, "Released under the MIT License."), (3, None), (4, ""), (5, "MIT License"), (None, notice), (6, notice), (6, notice)]
    rows = licences.scan(documents(spark, texts)).collect()
    assert sorted((r["doc_id"] or 0, r["paragraph"], r["family"]) for r in rows if r["confirmed"]) == [
        (0, 0, "GPL"), (1, 1, "GPL"), (2, 0, "MIT"), (6, 0, "GPL"), (6, 0, "GPL")]
    assert licences.scan(nothing(spark)).count() == 0


def test_licences_learn_from_all_paragraphs(spark, monkeypatch):
    """The fit and the least probability are those of all paragraphs of the corpus, one by one."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    monkeypatch.setattr(licences, "LEAST", 0.01)
    rng = random.Random(8)
    some = sorted({w for _, notice in licences.TEMPLATES for w in notice.lower().replace(",", "").replace(".", "").split()})
    docs = documents(spark, [(i, "\n".join(" ".join(rng.choices(some, k=rng.randint(3, 6))) for _ in range(3))) for i in range(2500)])
    model, least = licences.train(docs)
    lines = licences._features(licences.paragraphs(docs, "doc_id", "text").where(licences._likeness(F.col("w")) < 0.3))
    held = F.pmod(F.xxhash64("w"), F.lit(4)) == 0
    families = [*licences.FAMILIES, "unknown"]
    rows = []
    for family, notice in licences.TEMPLATES:
        w = "".join(c if c.isalnum() else " " for c in notice.lower()).split()
        rows += [(float(families.index(family)), w[a:b]) for a in range(len(w)) for b in range(a + 3, len(w) + 1) if b - a >= math.ceil(len(w) * licences.STRETCH)]
    known = licences._features(spark.createDataFrame(rows, "label double, w array<string>")).select("label", "features")
    every = known.union(lines.where(~held).select(F.lit(float(len(licences.FAMILIES))), "features")).cache()
    share = {r["label"]: 1000 / r["count"] for r in every.groupBy("label").count().collect()}
    weight = F.element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.col("label"))
    plain = LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-3, elasticNetParam=0.5, maxIter=50).fit(every.withColumn("weight", weight))
    assert model.summary.objectiveHistory[-1] == pytest.approx(plain.summary.objectiveHistory[-1], rel=2e-2)
    best = F.array_max(F.slice(vector_to_array("probability"), 1, len(licences.FAMILIES)))
    top = model.transform(lines.where(held)).agg(F.max(best)).first()[0]
    assert top > licences.LEAST and least == pytest.approx(min(0.99, top), rel=1e-9)


def test_licences_read_every_paragraph(spark, monkeypatch):
    seen, write = {}, licences.written
    monkeypatch.setattr(licences, "written", lambda df, name: seen.setdefault(name, write(df, name)))
    licences.train(documents(spark, [(i, f"some words of line {i}") for i in range(1100)]))
    unknown = next(rows for name, rows in seen.items() if name.startswith("unknown"))
    assert unknown.agg(F.sum("n") if "n" in unknown.columns else F.count(F.lit(1))).first()[0] == 1100


def test_toxicity_hands_on_what_it_holds(spark, monkeypatch):
    """Pair counts leave a task in bounded parts, and a text goes to the task once, inside its row."""
    rows = [(i, " ".join(f"{a}{b}" for a in "abcdefgh" for b in "stuvwxyz"[i % 8:]), i % 2) for i in range(40)]
    sample = spark.createDataFrame(rows, "k int, text string, toxic int").coalesce(1)
    whole = sorted(map(tuple, toxicity._counts(sample).collect()))
    monkeypatch.setattr(toxicity, "HELD_PAIRS", 10)
    assert sorted(map(tuple, toxicity._counts(sample).collect())) == whole
    want = Counter((v, w, t) for _, text, t in rows for v, w in zip(["", *toxicity.units(text)], toxicity.units(text)))
    assert whole == sorted((v, w, want[v, w, 1], want[v, w, 0]) for v, w in {k[:2] for k in want})
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "text#" not in plan.split("MapInArrow")[1].split("\n")[0]


def test_batches_of_a_task_are_bounded():
    batch = pa.RecordBatch.from_pydict({"x": list(range(2500))})
    parts = list(slices([batch, batch.slice(0, 0)]))
    assert [p.num_rows for p in parts] == [1000, 1000, 500] and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


def test_pipeline_equals_its_parts(spark, small):
    """Each stage's decision, worked out by plain rules on what the stage before it kept."""
    docs = read(spark, small, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "ngram_jaccard", "decontamination", "byte_bpe"]
    from tidemark.llm.common import written
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(written(stage(spark, kept[-1], small), "test-stage"))
        assert kept[-1].columns == docs.columns
    ids = [sorted(r["doc_id"] for r in k.collect()) for k in kept]
    model = toxicity.fit(docs, read(spark, small, "labels"))
    toxic = {r["doc_id"] for r in docs.collect() if model.score(np.array([model.evidence(r["text"] or "")]))[0] >= 0.5}
    assert ids[1] == [i for i in ids[0] if i not in toxic]
    good = {r["doc_id"] for r in quality.judge(kept[1], keep=["doc_id"]).where("kept").collect()}
    assert ids[2] == sorted(good)
    from test_pairs import brute
    assert ids[3] == sorted(i for _, i, n, c in brute([(r["doc_id"], r["text"]) for r in kept[2].collect()]) if i == c or not n)
    items = [r["text"] for r in read(spark, small, "benchmark").collect()]
    held = {r["doc_id"] for r in kept[3].collect() if any(t in r["text"] for t in items)}
    assert ids[4] == [i for i in ids[3] if i not in held]
    out = corpus_pipeline.run(spark, small)
    assert sorted(r["doc_id"] for r in out.collect()) == ids[4]
