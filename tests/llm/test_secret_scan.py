import hashlib
import random
import re

from lodestrata.llm import queries, secret_scan as s

ASSIGN, ACCESS, HEX = re.compile(s.ASSIGN, re.I | re.A), re.compile(s.ACCESS), re.compile(s.HEX)


def brute(text):
    """The base spans by whole-text patterns."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in ACCESS.finditer(text or "") if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text or "") if len(m[0]) >= 32]
    return sorted(found, key=lambda x: (x[1], s.KINDS.index(x[0])))


def base(text):
    return [x[:3] for x in s.find_spans(text) if x[0] in s.BASE_KINDS]


def test_random_texts_match_the_patterns():
    parts = ["a", "f", "0", "g", "token", "=", ":", " ", '"', "AKIA", "A", "Z9", "password", "SECRET", "İ", "ſecret", "abcdef01", "12345678", "api_key", "APIKEY", "Kelvin"]
    for seed in range(4000):
        rng = random.Random(seed)
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert base(text) == brute(text), text


def test_checksums_decide():
    body = "abcdefghijABCDEFGHIJ0123456789"
    good = "ghp_" + body + s.base62_crc(body)
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert [x[0] for x in s.find_spans(f"x {good} y")] == ["github"]
    assert s.find_spans(f"x {bad} y") == [] and s.find_spans(f"x {good}9") == []


def test_query(spark, make_docs, odd_texts, tmp_path):
    texts = [*odd_texts, "token = abcdefgh12", "token = short", "é password:'hunter22222'", "f" * 31, "f" * 32, "AKIA" + "B" * 12]
    make_docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op1_secret_scan(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        spans = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert rows[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in s.BASE_KINDS] == [sum(x[0] == k for x in spans) for k in s.BASE_KINDS]


def test_empty_table(make_docs):
    assert s.scan_secrets(make_docs([])).count() == 0
