import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodestrata.llm import bpe, queries


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def test_round_trip_matches_library(spark, make_docs, odd_texts, library):
    texts = [*odd_texts, "It's WE'LL don't 'S", "á ÅÅ KK ẞ", "x\x1cy\x85z\xa0w v", "½²³ªºµ٣٤ Ⅷ", "<|endoftext|><|ENDOFTEXT|>", "İI ΑΣ Σ", "éè", "🙂🙂 ok"]
    for size in (bpe.BLOCK_BYTES, 500):
        found = {r["doc_id"]: r for r in bpe.decode(bpe.encode(make_docs(texts), block_bytes=size)).collect()}
        both = {r["doc_id"]: r for r in bpe.encode(make_docs(texts), block_bytes=size, decoded=True).collect()}
        assert len(found) == len(texts) and both == found
        for i, text in enumerate(texts):
            ids = library.encode(text or "", add_special_tokens=False).ids
            assert found[i]["ids"] == ids, text[:80] if text else text
            assert found[i]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_splitting_equals_the_library_on_checked_characters(library):
    plain = [c for c in map(chr, range(0x2100)) if bpe.splitter(bpe.default_path())._plain.fullmatch(c)]
    rng = random.Random(0)
    words = bpe.splitter(bpe.default_path())
    for _ in range(400):
        text = "".join(rng.choice(plain) if rng.random() < 0.5 else rng.choice("ab's 't9 \n") for _ in range(80))
        ids = [i for x in words.encode_words(words._split(text)) for i in x]
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_squeezed_values():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        for top in (1, 256, 70_000, 1 << 32):
            values = rng.integers(0, top, n).astype(np.uint32)
            assert (bpe._expand(bpe._squeeze(values)) == values).all()


def test_query_digests(spark, make_docs, tmp_path, library):
    texts = ["the cat 9", None, ""]
    make_docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op6_bpe(spark, str(tmp_path)).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(r)[1:] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_empty_table_and_null_ids(make_docs):
    assert bpe.decode(bpe.encode(make_docs([]))).count() == 0
    assert sorted(map(str, bpe.encode(make_docs([(None, "a"), (None, "a"), (1, "a")])).collect())) == ["Row(doc_id=1, ids=[320])", "Row(doc_id=None, ids=[320])", "Row(doc_id=None, ids=[320])"]
