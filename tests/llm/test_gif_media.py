import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from lodestrata.llm import gif_media as g
from lodestrata.llm import queries


def plain_lzw(data, size, n):
    """Code by code, bit by bit."""
    bits = "".join(f"{b:08b}"[::-1] for b in data)
    clear, out, at = 1 << size, b"", 0
    table, width, prev = None, size + 1, None
    while len(out) < n:
        code = int(bits[at : at + width][::-1], 2)
        at += width
        if code == clear:
            table, width, prev = [bytes([i]) for i in range(clear)] + [b"", b""], size + 1, None
            continue
        if code == clear + 1:
            break
        entry = table[code] if code < len(table) else prev + prev[:1]
        if prev is not None and len(table) < 4096:
            table.append(prev + entry[:1])
            if len(table) == 1 << width and width < 12:
                width += 1
        out, prev = out + entry, entry
    return out


def literal_stream(indices, size):
    """Codes that never use the dictionary; a clear code before it grows."""
    codes, bits = [], ""
    for i, v in enumerate(indices):
        if i % ((1 << size) - 2) == 0:
            codes.append(1 << size)
        codes.append(v)
    for c in [*codes, (1 << size) + 1]:
        bits += f"{c:0{size + 1}b}"[::-1]
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8][::-1], 2) for i in range(0, len(bits), 8))


def image(left, top, rows, size=2, mark=0, local=b""):
    data = literal_stream([v for r in rows for v in r], size)
    return b"\x2c" + struct.pack("<HHHHB", left, top, len(rows[0]), len(rows), mark) + local + bytes([size]) + g._sub_blocks(data)


def control(disposal, delay, clear=None):
    return b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (clear is not None), delay, clear or 0) + b"\0"


HEAD = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x81, 0, 0) + bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 5000, 60_000])
def test_lzw_round_trip(n):
    for seed, letters in ((0, 3), (1, 256), (2, 1)):
        rng = random.Random(seed)
        data = bytes(rng.randrange(letters) for _ in range(n))
        stream = g.lzw_pack(data)
        assert g.lzw_unpack(stream, 8, n) == data
        if n <= 5000:
            assert plain_lzw(stream, 8, n) == data


def test_dictionary_may_stay_full():
    rng = random.Random(3)
    data = bytes(rng.randrange(4) for _ in range(40_000))
    codes, table, p = [4], {bytes([i]): i for i in range(4)}, b""
    for b in data:  # an encoder that never clears
        if p + bytes([b]) in table:
            p += bytes([b])
            continue
        codes.append(table[p])
        if len(table) + 2 < 4096:
            table[p + bytes([b])] = len(table) + 2
        p = bytes([b])
    codes += [table[p], 5]
    bits = []
    for i, c in enumerate(codes):
        width = 3 if i == 0 else min(12, (6 + max(i - 2, 0)).bit_length())
        bits.append(f"{c:0{width}b}"[::-1])
    bits = "".join(bits)
    bits += "0" * (-len(bits) % 8)
    stream = bytes(int(bits[i : i + 8][::-1], 2) for i in range(0, len(bits), 8))
    assert plain_lzw(stream, 2, len(data)) == data
    assert g.lzw_unpack(stream, 2, len(data)) == data


def frames(data):
    return [(f.delay_ms, f.disposal, f.shown.copy()) for f in g.decode(data)]


def test_disposal_and_transparency():
    data = HEAD + control(1, 5) + image(0, 0, [[1, 1], [1, 1]]) + control(2, 7, clear=0) + image(0, 0, [[0, 2]]) + control(3, 9) + image(1, 1, [[3]]) + control(0, 0) + image(0, 1, [[2]]) + b"\x3b"
    found = frames(data)
    red, green, blue, none = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (0, 0, 0, 0)
    assert [f[0] for f in found] == [50, 70, 90, 0]
    expected = [[[red, red], [red, red]], [[red, green], [red, red]], [[none, none], [red, blue]], [[none, none], [green, red]]]
    for f, e in zip(found, expected, strict=True):
        assert f[2].tolist() == [[list(p) for p in r] for r in e]


def test_local_palette_interlace_and_off_canvas():
    rows = [[i % 4, (i + 1) % 4] for i in range(11)]
    order = g._rows_of(11).tolist()
    local = bytes([9, 9, 9, 8, 8, 8, 7, 7, 7, 6, 6, 6])
    head = b"GIF87a" + struct.pack("<HHBBB", 2, 11, 0, 0, 0)
    found = frames(head + image(0, 0, [rows[i] for i in order], mark=0xC1, local=local) + image(1, 10, [[0, 1], [2, 3]], mark=0x81, local=local) + b"\x3b")
    assert found[0][2][:, :, 0].tolist() == [[9 - v for v in r] for r in rows]
    assert found[1][2][10].tolist() == [[9 - rows[10][0]] * 3 + [255], [9, 9, 9, 255]]


@pytest.mark.parametrize("data", [b"", b"GIF89a", b"PNG", HEAD, HEAD + b"\x2c", HEAD + image(0, 0, [[1, 1], [1, 1]])[:-3], HEAD + b"\x99"])
def test_damage_is_an_error(data):
    with pytest.raises(g.GifError):
        list(g.decode(data))


def test_query(spark, make_docs, odd_texts, tmp_path):
    make_docs(odd_texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op7_gif_media(spark, str(tmp_path)).collect()}
    assert len(rows) == len(odd_texts)
    for i, text in enumerate(odd_texts):
        raw = (text or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        media = g.encode_samples(payload)
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(raw), len(payload), len(media))
        assert (r["payload_sha256"], r["media_sha256"]) == (hashlib.sha256(payload).hexdigest(), hashlib.sha256(media).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(payload[-16:])
        if len(payload) <= 192 * 64:
            bins = np.bincount(np.frombuffer(payload, np.uint8) // 16, minlength=16)
            assert r["feature"] == "1:40:" + ",".join(map(str, bins))


def test_nulls_and_errors(spark, make_docs):
    media = spark.createDataFrame([(1, None), (2, bytearray(b"junk"))], "doc_id long, media binary")
    found = {r["doc_id"]: r for r in g.media_columns(media).collect()}
    assert found[1]["error"] is None and found[1]["frames"] is None and found[2]["error"] == "no GIF header"
    assert g.store_texts(make_docs([])).count() == 0


def test_hostile_canvas_is_an_error():
    for head in (struct.pack("<HH", 65_535, 65_535), struct.pack("<HH", 1, 1)):
        data = b"GIF89a" + head + b"\x80\x00\x00" + bytes(6) + b"\x2c" + struct.pack("<HHHHB", 0, 0, 65_535, 65_535, 0) + b"\x02\x01\x00\x00;"
        with pytest.raises(g.GifError):
            list(g.decode(data))
