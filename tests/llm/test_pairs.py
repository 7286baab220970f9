"""Near copies and test items, against brute force."""

import random
from collections import Counter

import pytest
from cases import LINE, TEXTS, documents, nothing

from tidemark.llm import decontaminate, jaccard, shingles
from tidemark.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = (text or "").translate(LOWER).encode().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Sorted (id, set size, component id); null ids are kept but never name a component."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted((k is None, k or 0, len(s), least.get(root(i)) or 0) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def found(spark, rows):
    out = jaccard.near_duplicates(documents(spark, rows)).collect()
    return sorted((r[0] is None, r[0] or 0, r[1], r[2] or 0) for r in out)


def corpus(seed, count=150):
    """Copies, near copies around the threshold, chains of near copies, and passages that many share."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(count):
        kind = rng.random()
        if texts and kind < 0.55:
            t = rng.choice(texts).split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
                at = rng.randrange(len(t))
                t[at:at + rng.choice([0, 1])] = [word()]
        else:
            t = [word() for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 80, 200]))]
            if rng.random() < 0.4:
                t = passage + t if rng.random() < 0.5 else t + passage
        texts.append(" ".join(t))
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_group_of_near_copies(spark):
    """A chain in which few pairs are similar, and a star of copies with one word changed."""
    base = [f"b{i}" for i in range(300)]
    chain = [(i, " ".join(base[:100 + 0] + [f"x{k}" for k in range(i)] + base[100 + i:])) for i in range(0, 60, 3)]
    star = [(1000 + i, " ".join(base[::-1][:i + 20] + ["y"] + base[::-1][i + 21:])) for i in range(80)]
    assert found(spark, chain + star) == brute(chain + star)


def test_awkward_rows(spark):
    assert found(spark, TEXTS) == brute(TEXTS)
    assert jaccard.near_duplicates(nothing(spark)).count() == 0


def test_one_of_each(spark):
    kept = jaccard.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    by = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert by[1, LINE] == 1 and by[2, LINE] == 0 and by[7, "one two"] == 0 and by[6, "one two"] == 1
    assert by[3, None] == by[4, ""] == 1


def test_wordless_and_repeated_rows(spark):
    """Rows without words all stay, repeated and null keys among them; equal rows with words leave one."""
    rows = [(3, None), (3, None), (3, ""), (None, " "), (None, " "), (4, LINE), (4, LINE), (None, "a b"), (None, "a b")]
    by = Counter((r["doc_id"], r["text"]) for r in jaccard.one_of_each(documents(spark, rows)).collect())
    assert by == {(3, None): 2, (3, ""): 1, (None, " "): 2, (4, LINE): 1, (None, "a b"): 1}


@pytest.mark.parametrize("kind,made", [("double", "id / 2"), ("date", "date_add(DATE'2024-01-01', CAST(id AS INT))"), ("smallint", "CAST(id AS SMALLINT)")])
def test_keys_of_any_type(spark, kind, made):
    rows = spark.range(4).selectExpr(f"{made} AS k", "CASE WHEN id < 3 THEN 'one two three four five six' ELSE '' END AS text")
    got = jaccard.near_duplicates(rows, "k").collect()
    ids = [r["k"] for r in rows.orderBy("k").collect()]
    assert sorted(tuple(r) for r in got) == [(ids[0], 2, ids[0]), (ids[1], 2, ids[0]), (ids[2], 2, ids[0]), (ids[3], 0, ids[3])]


def test_threshold_is_exact():
    for x in range(1, 60):
        for y in range(1, 60):
            least = jaccard.least_overlap(x, y)
            for o in range(min(x, y) + 1):
                assert (100 * o >= 80 * (x + y - o)) == (o >= least)


def test_shingles(monkeypatch):
    monkeypatch.setattr(shingles, "CHUNK", 40)  # long texts go in parts
    texts = [t or "" for _, t in corpus(4, 40)] + ["", "a b c d e f", "A B C D E F", "a\x0bb\x0cc\rd e"]
    sets = list(shingles.shingle_sets(texts))
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            assert len(set(sets[i].tolist()) & set(sets[j].tolist())) == len(shingle_set(texts[i]) & shingle_set(texts[j]))


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


ITEM = "what colour has the sky over the old harbour on a clear day in early spring"
TESTS = [(1, f"{ITEM}\nit is mostly blue said the keeper of the light"), (2, ITEM), (3, None), (4, ""), (5, "too short"),
         (6, " ".join(f"long{i}" for i in range(130))), (7, "short question of several words here\nyes")]


def items_of(spark, rows=TESTS):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def pad(seed, n=200):
    rng = random.Random(seed)
    return " ".join(f"p{rng.randrange(500)}" for _ in range(n))


def test_items_are_found(spark):
    docs = [(i, t) for i, t in TEXTS] + [
        (50, f"{pad(1)} {TESTS[0][1]} {pad(2)}"), (51, f"{pad(3, 47)} {ITEM} {pad(4)}"), (52, f"{pad(5)} {TESTS[5][1].upper()} {pad(6)}"),
        (53, f"{pad(7)}\nShort question of several words here:\nyes\n{pad(8)}"), (54, f"{pad(9)} what colour has the sky {pad(10)}"),
        (55, f"{pad(1)} too short {pad(2)}"), (56, pad(11)), (None, ITEM), (57, " ".join(TESTS[5][1].split()[:60]) + pad(3))]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(documents(spark, docs), items_of(spark), parts=False).collect()}
    assert got == {(50, 1), (50, 2), (51, 2), (52, 6), (53, 7), (None, 2)}
    clean = decontaminate.clean(documents(spark, docs), items_of(spark), parts=False)
    assert clean.columns == documents(spark).columns
    assert sorted(r["doc_id"] for r in clean.collect() if (r["doc_id"] or 0) >= 50) == [54, 55, 56, 57]
    assert decontaminate.contaminated(nothing(spark), items_of(spark)).count() == 0
    assert decontaminate.contaminated(documents(spark, docs), items_of(spark, [])).count() == 0


def test_parts_of_items_are_found(spark):
    """60 of 130 words, a run of 13 in a longer item, a copy without its last line, half of a chunk with changed words, short items."""
    rng = random.Random(12)
    long = [w for w in TESTS[5][1].split()]
    plain = [f"q{i}" for i in range(40)]
    items = [*TESTS, (8, " ".join(plain) + "\n" + " ".join(f"last{i}" for i in range(9))), (9, "what is it?\nblue it is"), (10, "a b c d\ne f g")]
    changed = [f"z{i}" if i % 10 == 9 else w for i, w in enumerate(plain)]
    docs = [(57, " ".join(long[:60]) + pad(3)), (58, f"{pad(1)} {' '.join(long[70:83])} {pad(2)}"), (59, f"{pad(1)} {' '.join(long[70:82])} {pad(2)}"),
            (60, f"{pad(4)} {' '.join(plain)} {pad(5)}"), (61, f"{pad(6)} {' '.join(changed)} {pad(7)}"), (62, f"{pad(8)}\nToo short!\n{pad(9)}"),
            (67, f"{pad(8)} too short {pad(9)}"), (68, f"{pad(1)} short question of several words here yes {pad(2)}"),
            (63, f"{pad(8)} too very short {pad(9)}"), (64, pad(rng.randrange(100))), (65, "too shorter"), (66, " ".join(plain[:9]))]
    found = decontaminate.contaminated(documents(spark, docs), items_of(spark, items), parts=True).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(57, 6), (58, 6), (60, 8), (61, 8), (62, 5)]
    assert all(0 < r["bm25_share"] <= 1 + 1e-9 for r in found)
    clean = decontaminate.clean(documents(spark, docs), items_of(spark, items), parts=True)
    assert sorted(r["doc_id"] for r in clean.collect()) == [59, 63, 64, 65, 66, 67, 68]
    assert [r["item_id"] for r in decontaminate.contaminated(documents(spark, docs), items_of(spark, [(5, "too short")]), parts=True).collect()] == [5]
    assert decontaminate.contaminated(documents(spark, docs), items_of(spark, []), parts=True).count() == 0


def test_short_items_are_whole_lines():
    assert decontaminate.stands_alone("x\nThe\ny", ["the"]) and decontaminate.stands_alone("of the", ["of", "the"])
    assert decontaminate.stands_alone("a b\n\nc!\nd", ["a", "b", "c"]) and not decontaminate.stands_alone("a b\nc d", ["b", "c"])
    assert not decontaminate.stands_alone("the sun\nin the", ["the"]) and not decontaminate.stands_alone("", ["the"])


def test_text_item_ids(spark):
    items = spark.createDataFrame([("q-1", ITEM), (None, ITEM), ("q-2", "other words of a question that nobody has asked")], "item_id string, text string")
    found = decontaminate.contaminated(documents(spark, [(1, f"{pad(1)} {ITEM}"), (2, "the")]), items)
    assert found.schema["item_id"].dataType.simpleString() == "string"
    assert sorted((r["doc_id"], r["item_id"] or "") for r in found.collect()) == [(1, ""), (1, "q-1")]


def test_slices_give_the_same(spark, small, monkeypatch):
    read = lambda name: spark.read.parquet(f"{small}/{name}.parquet")
    once = sorted(map(tuple, decontaminate.contaminated(read("documents"), read("benchmark")).collect()))
    texts, items = ([tuple(r) for r in read(n).select(k, "text").collect()] for n, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert {(d, i) for i, t in items for d, x in texts if t in x} <= {r[:2] for r in once}
    monkeypatch.setattr(decontaminate, "SLICE", 9)
    assert sorted(map(tuple, decontaminate.contaminated(read("documents"), read("benchmark")).collect())) == once


def test_slices_are_bounded_by_chunks(spark, monkeypatch):
    """Few long items: no slice gets all their chunks, and what is found stays."""
    items = [(i, " ".join(f"i{i}w{k}" for k in range(480))) for i in range(12)]
    docs = [(i, f"{pad(i)} {t} {pad(i + 20)}") for i, t in items]
    made, build = [], decontaminate.build
    monkeypatch.setattr(decontaminate, "SLICE", 24)
    monkeypatch.setattr(decontaminate, "build", lambda *a: made.append(build(*a)) or made[-1])
    for parts in (False, True):
        made.clear()
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(documents(spark, docs), items_of(spark, items), parts=parts).collect()}
        assert got == {(i, i) for i, _ in items}
        assert len(made) == 5 and max(len(index.owner) for index in made) < 120 and sum(len(index.owner) for index in made) == 120


def test_wand_retrieves_all_above_the_threshold():
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("xyz") for _ in range(rng.randint(5, 60)))) for i in range(60)]
    chunks = [c for _, t in rows for c in decontaminate.chunks_of(decontaminate.words_of(t))]
    frequency = Counter(w for c in chunks for w in set(c))
    index = decontaminate.build(rows, len(chunks), sum(map(len, chunks)) / len(chunks), frequency)
    hits = 0
    for _ in range(40):
        words = decontaminate.words_of(" ".join(rng.choice(rows)[1] for _ in range(3)))
        half = [words[i:i + 48] for i in range(0, len(words), 48)]
        got = {start: decontaminate.search(index, q, b) for start, q, b in decontaminate.passages(index, words)}
        for k in range(len(half)):
            terms = {index.terms[w] for w in half[k] + (half[k + 1] if k + 1 < len(half) else []) if w in index.terms}
            want = {c: sum(index.impacts[t][index.chunks[t].index(c)] for t in terms if c in index.chunks[t]) for c in range(len(chunks))}
            want = {c: v * decontaminate.SHARE for c, v in want.items() if v >= 1}
            assert got.get(48 * k, {}) == pytest.approx(want)
            hits += len(want)
    assert hits > 40
