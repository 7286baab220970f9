"""Operators that work row by row, against plain Python on awkward rows and on the small tables."""

import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from cases import LINE, TEXTS, documents, nothing
from oracle_check import compare, connect

from tidemark.llm import bpe, quality
from tidemark.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(spark):
    rows = quality.judge(documents(spark), keep=["doc_id", "text", "n_words", "score"]).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        want = plain_measures(r["text"])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality.judge(nothing(spark)).count() == 0


def test_quality_keeps_rows_whole(spark):
    kept = quality.good_ones(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(r["text"] for r in kept.collect() if r["doc_id"] == 2) == [LINE, LINE]


def test_quality_matches_sql(spark, small):
    assert compare(QUERIES["op1_quality_rules"](spark, small), connect(small), ORACLES["op1_quality_rules"]) is None


def test_tokens_equal_the_library(spark, library):
    rows = bpe.tokenize(documents(spark), RANKS, public_tokenizers.PATTERN).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], list(r["ids"])) for r in rows)
    want = []
    for key, text in TEXTS:
        ids = library.encode_ordinary(text or "")
        want.append((key is None, key or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest(), ids))
    assert got == sorted(want)
    assert bpe.tokenize(nothing(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_gives_the_texts(spark):
    tokens = bpe.tokenize(documents(spark), RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(tokens, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == sorted((k or 0, t or "") for k, t in TEXTS)


@pytest.mark.parametrize("letters", ["ab", "aaaaab", " etaoin", "é日a🙂", "0123456789", "thehertion", " \n\t"])
def test_tree_equals_the_library(library, letters):
    enc, rng = bpe.Encoder(bpe.load_ranks(RANKS), public_tokenizers.PATTERN), random.Random(letters)
    for size in (1, 2, 31, 32, 33, 64, 65, 500, 3000):
        text = "".join(rng.choice(letters) for _ in range(size))
        assert enc.encode_text(text) == library.encode_ordinary(text)
        whole = library._encode_single_piece(text.encode())
        assert enc.encode(text.encode()) == whole == enc.merge(text.encode())


def test_join_is_a_monoid():
    enc, rng = bpe.Encoder(bpe.load_ranks(RANKS), public_tokenizers.PATTERN), random.Random(5)
    assert enc.join([], [5]) == [5] == enc.join([5], [])
    for _ in range(200):
        a, b, c = (enc.encode("".join(rng.choice("aebthn") for _ in range(rng.randint(1, 40))).encode()) for _ in range(3))
        assert enc.join(enc.join(a, b), c) == enc.join(a, enc.join(b, c))


def test_every_token_encodes_to_itself():
    ranks = bpe.load_ranks(RANKS)
    enc = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    without = {t: r for t, r in ranks.items()}
    for token in random.Random(1).sample(sorted(without), 5000):
        if len(token) < 2:
            continue
        held = enc.ranks.pop(token)
        parts = enc.merge(token)
        enc.ranks[token] = held
        assert len(parts) == 2  # its last merge joins two tokens, so it is reached by merges


def test_ranks_are_read_as_written(tmp_path):
    file = tmp_path / "ranks"
    file.write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b"ab") + b" 1\n\n")
    assert bpe.load_ranks(str(file)) == {b"a": 0, b"ab": 1}
