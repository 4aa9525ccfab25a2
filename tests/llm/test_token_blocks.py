import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_wordspans import twins
from tokenizers import Tokenizer

from lodestrata.llm import bytewords, queries
from lodestrata.llm import token_blocks as tb
from lodestrata.llm.wordspans import utf8


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tb.default_path())


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 255, 256, 257, 5000):
        for values in (rng.integers(0, 50257, n), rng.zipf(1.3, n) % 50257, np.full(n, 7), rng.integers(0, 1 << 32, n)):
            values = values.astype(np.uint32)
            for percentile in (0.01, 0.5, 0.95, 1.0):
                data = tb.segment_bytes(np.array([4]), np.array([False]), np.array([n]), values, percentile)
                assert (tb.read_segment(data)[3] == values).all()
                for b in range(-(-n // tb.BLOCK)):
                    assert (tb.read_block(data, b) == values[b * tb.BLOCK : (b + 1) * tb.BLOCK]).all()


def test_outliers_go_to_exceptions():
    values = np.full(256, 10, np.uint32)
    values[[3, 200]] = 50_000
    parts = tb.pack_blocks(values)
    assert parts["width"][0] == 0 and parts["exceptions"][0] == 2 and parts["positions"].tolist() == [3, 200]


def test_words_equal_the_library(library):
    code = bytewords.ByteEncoder(tb.default_path(), cached_words=500)
    plain = [c for c in map(chr, range(0x2100)) if (bytewords.classes(np.frombuffer(c.encode(), np.uint8)) != bytewords._BAD).all()]
    parts = ["a", "b", "'s", "'t", "'ll", "'re ", " 've", "'", "''", "l", "9", "12", "\n", "  ", "\n ", "\t", "é", "!", "’", "x", "日", "<|endoftext|>", "<"]
    for seed in range(600):
        rng = random.Random(seed)
        texts = ["".join(rng.choice(plain) if rng.random() < 0.3 else rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 6))]
        ids, counts = code.encode(*utf8(pa.array([*texts, None])))
        found = [x.tolist() for x in np.split(ids, np.cumsum(counts))]
        assert found == [*(library.encode(t, add_special_tokens=False).ids for t in texts), [], []]


def test_words_with_equal_hashes(library, monkeypatch):
    monkeypatch.setattr(bytewords, "hashed", lambda data, starts, ends: (ends - starts).astype(np.uint64))  # as bad as can be
    code = bytewords.ByteEncoder(tb.default_path())
    for _ in range(2):  # against words of the same texts, and against the table
        texts = ["the cat sat on mats", "cat", "dog", "the dog ran", None, "a b"]
        ids, counts = code.encode(*utf8(pa.array(texts)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_with_equal_sums_of_powers(library, n):
    a, b = twins(n)
    code = bytewords.ByteEncoder(tb.default_path())
    for text in (f"{a} {b}", b, a):
        assert code.encode(*utf8(pa.array([text])))[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_very_long_text(library):
    text = "lorem's ipsum \n" * 200_000
    ids, counts = bytewords.encoder(tb.default_path()).encode(*utf8(pa.array(["a", text, "b"])))
    assert ids[1:-1].tolist() == library.encode(text, add_special_tokens=False).ids and counts.sum() == len(ids)


def test_query(spark, make_docs, odd_texts, tmp_path, library):
    texts = [*odd_texts, "x\x1cy\x85z\xa0w  v \n\n  q", "½²³ªº ٣ Ⅷ 🙂", "a<|endoftext|>b <", "don't  'S"]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    make_docs([(i, texts[i]) for i in order]).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, queries.op4_token_blocks(spark, str(tmp_path)).collect()))
    start, expected = 0, []
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == expected


def test_small_segments_repeats_nulls_and_empty(spark, make_docs, tmp_path):
    rows = [(2, "b b b"), (None, "a"), (2, "b b b"), (1, None), (2, "c")]
    tb.write_tokens(make_docs(rows), f"{tmp_path}/t", segment_ids=1)
    found = tb.read_tokens(spark, f"{tmp_path}/t").collect()
    assert sorted(r["start"] for r in found) == sorted(np.cumsum([0, *[r["n_tokens"] for r in sorted(found, key=lambda r: r["start"])]])[:-1].tolist())
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])] == [None, 1, 2, 2, 2]
    tb.write_tokens(make_docs([]), f"{tmp_path}/e")
    assert tb.read_tokens(spark, f"{tmp_path}/e").count() == 0
