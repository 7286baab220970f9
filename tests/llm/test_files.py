"""Archives, token files and shards: exact round trips and plain versions."""

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import TEXTS, documents, nothing
from tokenizers import Tokenizer

from tidemark.llm import dac, sharding, warc
from tidemark.llm.common import open_store, settled, written
from tidemark.llm.queries import QUERIES
from tidemark.session import scratch_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
PAGES = "page_id bigint, url string, html string, lang string, record_type string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, None, "x") for i, u, h in rows], PAGES)


def noise(size, seed=0):
    return random.Random(seed).randbytes(size).decode("latin-1")


@pytest.mark.parametrize("range_bytes,read_bytes", [(1 << 24, 1 << 20), (37, 11), (1000, 64)])
def test_archives_come_back(spark, range_bytes, read_bytes):
    inner = gzip.compress(warc.record(77, "inner", b"inside", None), 0).decode("latin-1")  # a member inside a payload
    rows = [(1, "u", "same"), (5, None, "same"), (3, "u\r\nX: y", "same"), (2, "v", None), (4, "v", ""), (6, "w", noise(40_000)),
            (7, "w", "\x1f\x8b\x08" * 50 + inner), (None, "n", "same"), (8, "é", "日本 🙂")]
    out = scratch_path(spark, "warc-test")
    files = written(warc.write_archives(pages(spark, rows), out), "files")
    assert files.agg({"records": "sum"}).first()[0] == len(rows)
    if range_bytes < 100:
        files = files.limit(2)
    got = warc.read_archives(spark, out, True, range_bytes, read_bytes).collect()
    by = sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got)
    last = {h or "": max(i for i, _, x in rows if i and (x or "") == (h or "")) for _, _, h in rows}
    want = []
    for i, _, h in rows:
        data, to = (h or "").encode(), last[h or ""]
        want.append((i or 0, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == to else "revisit", None if i == to else to))
    assert by == sorted(want)
    assert {r["page_id"]: r["html"] for r in got if r["record_type"] == "response"} == {i: h or "" for i, _, h in rows if i and last[h or ""] == i}


def test_small_payloads_are_never_revisited(spark):
    rows = warc.with_revisits(pages(spark, [(1, "", "ab"), (2, "", "ab"), (3, "", "abcd"), (4, "", "abcd")]), least_bytes=3).collect()
    assert {r["page_id"]: r["refers_to"] for r in rows} == {1: None, 2: None, 3: 4, 4: None}


def test_no_page_no_archive(spark, tmp_path):
    pages(spark, []).write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES["op5_warc"](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("widths", [(8, 8), (10, 3, 4), (16,)])
def test_codes_address_every_token(widths):
    rng = np.random.default_rng(1)
    ids = (rng.integers(0, 50257, 5000) >> rng.integers(0, 16, 5000)).astype(np.uint32)
    data = b"".join(dac.encode_file(ids, np.array([0, 10, 10, 5000]), [1, None, 3], widths))
    import tempfile
    with tempfile.NamedTemporaryFile() as file:
        file.write(data)
        file.flush()
        opened = dac.DacFile(file.name)
        assert opened.keys == [1, None, 3] and opened.starts.tolist() == [0, 10, 10, 5000]
        assert [opened[i] for i in range(0, 5000, 7)] == ids[::7].tolist()
        for a, b in ((0, 5000), (511, 513), (512, 1024), (4999, 5000), (7, 7)):
            assert opened.read(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(ValueError):
        dac.encode_file(np.array([1 << 17], np.uint32), np.array([0, 1]), [1])


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(dac.WordIds, "LIMIT", 3)  # the tables turn over all the time
    files = written(dac.write_ids(documents(spark), scratch_path(spark, "dac-test"), JSON, 2), "files")
    got = sorted(tuple(r)[1:] for r in dac.read_ids(files).collect())
    library = Tokenizer.from_file(JSON)
    want, start = [], 0
    for key, text in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    empty = written(dac.write_ids(nothing(spark), scratch_path(spark, "dac-test"), JSON, 2), "files")
    assert dac.read_ids(empty).count() == 0


def test_added_tokens_are_the_librarys(spark):
    """Texts that hold an added token: ids as the library gives them as loaded, and the starts after them."""
    library = Tokenizer.from_file(JSON)
    mark = library.get_added_tokens_decoder()[50256].content
    rows = [(1, f"one {mark} two"), (2, mark), (3, f"a{mark}{mark}b c"), (4, f"x {mark[:-1]} {mark} "), (5, "after all of them")]
    files = written(dac.write_ids(documents(spark, rows), scratch_path(spark, "dac-test"), JSON, 2), "files")
    want, start = [], 0
    for key, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in dac.read_ids(files).collect()) == want
    assert dac.WordIds(JSON).ids(rows[0][1], 2).tolist() == [505, 220, 50256, 734, 2]


def test_keys_of_any_type(spark):
    for kind, made in (("string", "concat('k', id)"), ("date", "date_add(DATE'2024-01-30', CAST(id AS INT))"), ("double", "id / 3")):
        rows = spark.range(6).selectExpr(f"{made} AS k", "concat('a b ', id) AS text")
        files = written(dac.write_ids(rows, scratch_path(spark, "dac-test"), JSON, 2, key="k"), "files")
        got = dac.read_ids(files, "k", kind)
        assert got.schema["k"].dataType == rows.schema["k"].dataType
        assert [r["k"] for r in got.orderBy("start").collect()] == [r["k"] for r in rows.orderBy("k").collect()]


def test_wide_ids_have_more_levels():
    ids = np.array([0, 255, 256, 65_535, 65_536, 100_255, 1 << 24], np.uint32)
    assert [dac.chunk_widths(n) for n in (0, 255, 256, 65_535, 65_536, 1 << 24)] == [(8,), (8,), (8, 8), (8, 8), (8, 8, 8), (8,) * 4]
    import tempfile
    with tempfile.NamedTemporaryFile() as file:
        file.write(b"".join(dac.encode_file(ids, np.array([0, 7]), [1], dac.chunk_widths(1 << 24))))
        file.flush()
        opened = dac.DacFile(file.name)
        assert opened.read(0, 7).tolist() == ids.tolist() and opened[5] == 100_255


def test_paths_lead_where_spark_leads(spark, tmp_path):
    """A path without scheme under another default file system; stores that nobody knows."""
    assert settled(spark, f"{tmp_path}/a b/c") == f"file://{tmp_path}/a b/c"
    assert settled(spark, "s3a://b/c") == "s3a://b/c"
    store, root = open_store(f"file:{tmp_path}/a b")
    assert root == f"{tmp_path}/a b" and open_store(f"file://{tmp_path}/x")[1] == f"{tmp_path}/x"
    with pytest.raises(ValueError):
        open_store("dbfs:/x")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = {name: hadoop.get(name) for name in ("fs.defaultFS",)}
    hadoop.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    hadoop.set("fs.defaultFS", "viewfs://store/")
    try:
        assert settled(spark, "/in/d") == "viewfs://store/in/d"
    finally:
        hadoop.set("fs.defaultFS", before["fs.defaultFS"])


def test_archives_on_disks_of_their_own_are_an_error(spark):
    out = scratch_path(spark, "warc-test")
    files = written(warc.write_archives(pages(spark, [(1, "u", "a"), (2, "u", "b")]).repartition(2), out), "files")
    warc.require_shared(files, out)
    with pytest.raises(RuntimeError):
        warc.require_shared(files.unionByName(files.selectExpr("concat(path, 'x') AS path", "records")), out)


def test_words_equal_whole_texts():
    words, rng = dac.WordIds(JSON), random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", " ", " ", "\n", ".", ",", "é", "'s", "12", " ", "\x1c", "日"]) for _ in range(rng.randint(0, 40)))
        assert words.ids(text, 2).tobytes()[:-4] == words.whole(text)


def test_marks_do_not_go_to_the_library():
    """Letters with marks after or between them are put together from pieces; only the marks themselves are encoded as texts."""
    words, whole = dac.WordIds(JSON), []
    plain = words.whole
    words.whole = lambda text: whole.append(text) or plain(text)
    rng = random.Random(4)
    letters = ["".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(200)]
    text = " ".join(f"{w}{rng.choice(['***', '&&&', '_', '$', '.,'])}{rng.choice(['', rng.choice(letters)])}" for w in letters)
    text = "\n".join(text[i:i + 100].strip() for i in range(0, len(text), 100))
    assert words.ids(text, 2).tobytes()[:-4] == plain(text)
    assert len(whole) < 40 and not any(part.isalpha() and len(part) > 1 for part in whole)


def test_tables_are_asked_once_for_each_distinct_word(monkeypatch):
    asked = []

    class Counted(dac._Young):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(dac, "_Young", Counted)
    words, text = dac.WordIds(JSON), " ".join(["first", *["once", "more", "and", "again"] * 500])
    assert words.ids(text, 2).tobytes()[:-4] == words.whole(text)
    assert sorted(asked) == ["again", "and", "more", "once"]


def test_many_texts_at_once_equal_each_by_itself():
    """Empty texts, texts that go to the library whole, words that only begin a text, marks at the end of a word."""
    words = dac.WordIds(JSON)
    mark = words.tokenizer.get_added_tokens_decoder()[50256].content
    rows = ["", "alone", "alone again", " led by a space", "ends in one ", "", f"x {mark} y", "two  spaces", "a\tb c", "line\nend line\nend",
            "Wort, größer. größer... größer.' it's (so)", "12 and 3.5, ok", "", "日本 語. 日本", mark, "a \x1c b"]
    rng = random.Random(5)
    rows += ["".join(rng.choice(["a", "B", " ", " ", "\n", ".", "!?", "é", "'s", "12"]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    ids, counts = words.ids_of(rows, 2)
    want = [[*words.tokenizer.encode(row, add_special_tokens=False).ids, 2] for row in rows]
    assert counts.tolist() == [*map(len, want)] and ids.tolist() == sum(want, [])
    assert "größer" in words.young and "größer." not in words.young  # the letters are kept, not what ends in marks


def test_portions_hold_all_rows():
    made = [None, "", "abc", "x" * 50, None, "é" * 3, "y" * 25, ""]
    batch = pa.RecordBatch.from_pydict({"key": [*range(len(made))], "text": pa.array(made, pa.string())})
    for size in (1, 7, 10, 1000):
        parts = [*dac.portions(iter([batch, batch.slice(0, 0), batch.slice(2, 3)]), size)]
        assert [row for part in parts for row in part.column("key").to_pylist()] == [*range(len(made)), 2, 3, 4]
        assert all(part.num_rows for part in parts)
    assert [part.num_rows for part in dac.portions(iter([batch]), 10)] == [3, 3, 2]


def test_matrix_has_its_margins():
    sources, targets = [0, 5, 17, 1000, 3], sharding.shard_sizes(1025, 8)
    matrix = sharding.communication_matrix(sources, targets, 4)
    assert [sum(r) for r in matrix] == sources and [sum(c) for c in zip(*matrix, strict=True)] == targets
    assert max(targets) - min(targets) == 1


def test_hypergeometric_law():
    rng = random.Random(2)
    seen = Counter(sharding.hypergeometric(rng, 6, 4, 5) for _ in range(20_000))
    from math import comb
    for k in range(1, 6):
        assert abs(seen[k] / 20_000 - comb(6, k) * comb(4, 5 - k) / comb(10, 5)) < 0.015


def test_shards_are_exact_and_uniform(spark):
    rows = spark.range(4003).selectExpr("id AS doc_id", "'same text' AS text", "'old' AS shard")
    got = sharding.shuffle_to_shards(rows, ["doc_id", "text"], 8, seed=3)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    out = got.collect()
    assert sorted(r["doc_id"] for r in out) == list(range(4003))
    sizes = Counter(r["shard"] for r in out)
    assert sorted(sizes.values()) == [500] * 5 + [501] * 3
    for k in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == k) == list(range(sizes[k]))
    low = Counter(r["shard"] for r in out if r["doc_id"] < 2000)
    assert all(180 < n < 320 for n in low.values())
    first = [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(abs(a - b) == 1 for a, b in zip(first[:-1], first[1:], strict=True)) < 20
    assert sorted(map(tuple, out)) == sorted(map(tuple, sharding.shuffle_to_shards(rows.repartition(7), ["doc_id", "text"], 8, seed=3).collect()))


def test_awkward_rows_get_places(spark):
    out = sharding.shuffle_to_shards(documents(spark), ["doc_id", "text"], 8).collect()
    assert len(out) == len(TEXTS) and max(Counter(r["shard"] for r in out).values()) == 3
    assert sharding.shuffle_to_shards(nothing(spark), ["doc_id", "text"], 8).count() == 0


def test_written_shards(spark, tmp_path):
    sharding.write_shards(documents(spark).select("doc_id", "text"), ["doc_id", "text"], 4, f"{tmp_path}/s")
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == len(TEXTS) and back.select("shard").distinct().count() == 4
