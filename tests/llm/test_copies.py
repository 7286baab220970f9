"""Exact duplicates, phrases and token alignment against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import DOCS, TEXTS, documents, nothing
from pyspark.sql import functions as F

from tidemark.llm import align, exact, phrases
from tidemark.llm.queries import QUERIES
from tidemark.session import scratch_path

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- exact duplicates --------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 100_000])
def test_filter_knows_all_its_keys(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2 ** 63, n).astype(np.uint64)
    seed, segment, segments, prints = exact.build_filter(np.concatenate([keys, keys[:3]]))
    held = (seed, segment, segments, np.frombuffer(prints, np.uint8))
    assert exact.known(keys, *held).all()
    others = rng.integers(0, 2 ** 63, 50_000).astype(np.uint64)
    assert exact.known(others, *held).mean() < 0.01
    assert n < 100_000 or len(prints) < 1.2 * n


def plain_copies(rows):
    same = defaultdict(list)
    for key, text in rows:
        same[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    out = []
    for body, keys in same.items():
        keep = min((k for k in keys if k is not None), default=None)
        out += [(k, keep, len(keys), hashlib.sha256(body.encode()).hexdigest()) for k in keys]
    return sorted(out, key=str), {b: 1 for b in same}


def shown(df):
    rows = df.select("key", "keep", "copies", F.lower(F.hex("digest")).alias("d"), "kept").collect()
    return sorted(((r["key"], r["keep"], r["copies"], r["d"]) for r in rows), key=str), rows


@pytest.mark.parametrize("rows", [TEXTS, [], [(None, "a"), (None, "a"), (None, None)], [(1, "x  y"), (1, "x\ny"), (0, "x\t \ny"), (5, "xy")]])
def test_every_row_knows_which_one_stays(spark, rows):
    docs = spark.createDataFrame([(i, t, None, "s", "s", "n") for i, t in rows], DOCS)
    got, raw = shown(exact.exact_duplicates(docs, scratch_path(spark, "exact-test")))
    want, bodies = plain_copies(rows)
    assert got == want
    assert Counter(r["d"] for r in raw if r["kept"]) == {hashlib.sha256(b.encode()).hexdigest(): 1 for b in bodies}


def test_deliveries_are_screened_and_repeatable(spark, monkeypatch):
    monkeypatch.setattr(exact, "BUCKET_KEYS", 64)
    rng = random.Random(5)
    loads = [[(n * 1000 + i, f"text {rng.randrange(700)}") for i in range(500)] for n in range(3)]
    index = scratch_path(spark, "exact-test")
    for number, load in enumerate(loads):
        docs = spark.createDataFrame(load, "doc_id long, text string")
        for _ in range(2 if number == 1 else 1):  # a delivery that is worked off twice
            classes = exact.add_delivery(docs, index, number)
        older = {t for before in loads[:number] for _, t in before}
        homes = {r["digest"]: r["home"] for r in classes.collect()}
        first = {}
        for at, before in enumerate(loads[:number + 1]):
            for _, t in before:
                first.setdefault(hashlib.sha256(t.encode()).digest(), at)
        assert {bytes(d): h for d, h in homes.items()} == {hashlib.sha256(t.encode()).digest(): first[hashlib.sha256(t.encode()).digest()] for _, t in load}
        if number:
            asked = spark.read.parquet(exact._path(index, number, "positives"))
            assert asked.filter(F.col("snapshot") == 0).count() < len({t for _, t in load} & older) + 60
    got, raw = shown(exact.keepers(spark, index, 3))
    assert got == plain_copies([r for load in loads for r in load])[0]
    assert sum(r["kept"] for r in raw) == len({t for load in loads for _, t in load})


def test_a_false_positive_falls_out_at_the_bytes(spark, monkeypatch):
    index = scratch_path(spark, "exact-test")
    monkeypatch.setattr(exact, "digest", lambda body: F.unhex(F.sha2(F.substring(body, 1, 1), 256)))  # equal digests, other bytes
    exact.add_delivery(spark.createDataFrame([(1, "ab"), (2, "cd")], "doc_id long, text string"), index, 0)
    classes = exact.add_delivery(spark.createDataFrame([(3, "ax"), (4, "cd")], "doc_id long, text string"), index, 1)
    assert sorted(r["home"] for r in classes.collect()) == [0, 1]


# ---- phrases -----------------------------------------------------------------------------

def plain_phrases(rows, top=2000, least=30):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        listed = {p: n for p, n in found.items() if len(p) > 1 and n >= least}
        dropped = {p[i:j] for p, n in listed.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and 100 * n >= 80 * found[p[i:j]]}
        scored = []
        for p, a in listed.items():
            if p not in dropped:
                score, _, left, right = min((2_000_000 * a // (found[p[:k]] + found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, totals[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def mined(spark, rows, **how):
    docs = spark.createDataFrame([(t, la, "x", "y") for la, t in rows], "text string, lang string, rank string, n string")
    got = phrases.collocations(docs, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(map(tuple, got))


def phrase_rows():
    rng = random.Random(3)
    words = ["the", "of", "New", "york", "city", "é", "a", "a\x01", "a\x00b", "ﬁn", "日本", "x" * 300, "\xa0", "s\x1cs"]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", " "]) for _ in range(rng.randrange(120)))
        rows.append((rng.choice(["en", "de", None, "und", "en"]), text))
    return rows + [(None, None), ("en", ""), ("de", " \n\t"), ("fr", "new york"), ("en", "new york city " * 400), ("en", "of the " * 3000 + "end")] * 2


@pytest.mark.parametrize("least,top,ranges,portion", [(30, 2000, 1_000_000, 8 << 20), (3, 7, 40, 300), (1, 2000, 25, 5000)])
def test_phrases_equal_a_plain_count(spark, monkeypatch, least, top, ranges, portion):
    monkeypatch.setattr(phrases, "RANGE_ROWS", ranges)
    monkeypatch.setattr(phrases, "PORTION", portion)
    rows = phrase_rows()
    assert mined(spark, rows, least=least, top=top) == plain_phrases(rows, top, least)


def test_no_phrases(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None), ("en", "one two three")]) == []
    assert phrases.collocations(documents(spark)).filter("phrase = 'the quick'").count() == 0  # inside a longer one
    assert phrases.collocations(nothing(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_quicksort_counts(seed):
    rng = np.random.default_rng(seed)
    n, words = int(rng.integers(1, 400)), int(rng.integers(1, 6))
    columns = [rng.integers(0 if d else 1, words + 1, n) for d in range(4)]
    for d in range(1, 4):
        columns[d] = np.where(columns[d - 1] > 0, columns[d], 0)
    weight = rng.integers(1, 4, n)
    want = Counter()
    for *row, w in zip(*(c.tolist() for c in columns), weight.tolist(), strict=True):
        for size in range(2, 5):
            if row[size - 1]:
                want[tuple(row[:size])] += w
    for least in (1, 5, 30):
        got = [(tuple(int(c[at]) for c in columns[:deep]), total) for at, deep, total in phrases.sorted_counts(columns, weight, least)]
        assert len(got) == len(dict(got)) and dict(got) == {p: c for p, c in want.items() if c >= least}


# ---- alignment ---------------------------------------------------------------------------

def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    bytes_a, bytes_b = align.vocabulary_bytes(A, B)
    found, counts = [], Counter()
    for text in texts:
        data = (" " + text).encode() if text else b""
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode([text], num_threads=1)[0] if text else []
        if b"".join(bytes_a[i] for i in a) != data or b"".join(bytes_b[i] for i in b) != data:
            a, b = [], []
        spans = []
        for ids, size in ((a, bytes_a), (b, bytes_b)):
            ends = np.cumsum([len(size[i]) for i in ids]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends, ids, strict=False)) if ids else [])
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        cut = {e: k for k, e in enumerate(both)}  # the group that ends there
        sides = [[[] for _ in both] for _ in spans]
        for side, tokens in zip(sides, spans, strict=True):
            at = 0
            for _, e, i in tokens:
                side[at].append(str(i))
                at += e in cut
        groups = ["|".join(map(",".join, pair)) for pair in zip(*sides, strict=True)]
        at, links = 0, []
        for s, e, i in spans[0]:
            while at and spans[1][at - 1][1] > s:
                at -= 1
            while at < len(spans[1]) and spans[1][at][0] < e:
                if spans[1][at][1] > s:
                    links.append((i, spans[1][at][2]))
                at += 1
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(a, b, len(g), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for a, b, g, x in found]


HARD = ["  two  spaces ", " lead", "tail ", "a▁b", "▁", "<s> </s> <unk>", "<|endoftext|> x<|endoftext|>", "\x00\x01", "tab\tand\nline\r\n", "don't we'll",
        "日本語 テスト🙂🙂", "ﬁ é é ü", "\xa0　x", "x" * 3000, "１２３ 4567 8.9", "aaaaaaaaaa bbb" * 20, " ", "\n", "a\n", "one.\nTwo\n\nthree\n four", "a\tb\nc d\x1c\ne", "\nx\ny z\n", "l1\nl2\nl3 l1\nl2", "a\n\xa0b c\x85\nd", "ß" * 200, "a  b" * 50]


def test_alignment_equals_plain_version(spark, small, monkeypatch):
    real = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()]
    texts = [t for _, t in TEXTS] + HARD + real
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, n_a int")
    want = {i: x for i, x in enumerate(plain_alignment(texts))}
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for hot in (align.HOT, 5):
        monkeypatch.setattr(align, "HOT", hot)  # with few, nearly all pairs are joined
        got = align.cross_alignment(docs, A, B, public_tokenizers.PATTERN).collect()
        assert {r["doc_id"]: tuple(r[c] for c in columns) for r in got} == want
        assert len(got) == len(texts)


def test_groups_and_map(spark):
    docs = spark.createDataFrame([("k", "hello world"), ("k", "hello world"), (None, None)], "id string, text string")
    rows = align.align(docs, A, B, public_tokenizers.PATTERN, key="id")
    pairs = align.pair_counts(rows, A, B)
    links = align.best_links(rows, pairs, A, B).collect()
    assert len(links) == 3 and sorted(r["n_links"] for r in links) == sorted([0, links[0]["n_links"], links[0]["n_links"]] if links[0]["n_links"] else [0, links[1]["n_links"], links[1]["n_links"]])
    text = next(r["groups"] for r in links if r["n_links"])
    assert hashlib.sha256(text.encode()).hexdigest() == next(r["groups_sha256"] for r in links if r["n_links"])
    for row in align.id_map(spark, pairs, B).collect():
        assert 0 < row["share"] <= 1 and row["n"] > 0


def test_alignment_of_nothing(spark, tmp_path):
    assert align.cross_alignment(nothing(spark), A, B, public_tokenizers.PATTERN).count() == 0
    nothing(spark).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("op11_exact_dedup", "op12_collocations", "op13_cross_tokenizer"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0
