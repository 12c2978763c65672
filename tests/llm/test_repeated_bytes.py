"""Repeated byte strings against a plain search, and suffix arrays against sorting."""

import hashlib
import random

import numpy as np
import pytest

from shiftline.llm import repeated_bytes, suffix_array
from shiftline.llm.repeated_bytes import remove_repeats

DOCS = "doc_id long, text string, k1 long, least string, bin long"


def plain(rows, length):
    least = {}
    data = [(i if i is not None else float("inf"), (t or "").encode()) for i, t in rows]
    for doc, text in data:
        for at in range(len(text) - length + 1):
            string = text[at : at + length]
            least[string] = min(least.get(string, doc), doc)
    found = []
    for (doc, _), (order, text) in zip(rows, data, strict=True):
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if least[text[at : at + length]] < order:
                gone[at : at + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        found.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def some_rows(rng, length):
    alphabet = ["ab", "c", "é", "日本", "\0", " the", "\n"]
    passages = ["".join(rng.choices(alphabet, k=rng.randint(length // 2, 3 * length))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 6)):
            own = "".join(rng.choices(alphabet + ["x", "y", "zz"], k=rng.randint(0, 2 * length)))
            parts.append(rng.choice(passages) if rng.random() < 0.4 else own)
        rows.append((i * 3 % 151, "".join(parts)))
    rows += [(200 + i, rows[7][1]) for i in range(5)] + [(300, "a" * 40 * length), (301, "a" * 30 * length)]
    rows += [(400, None), (401, ""), (402, "short"), (None, rows[3][1] + passages[0]), (None, passages[0] * 2)]
    rows += [(500, passages[1] + passages[2]), (500, passages[2] + passages[1] + "q" * length)]
    rows += [(-5, passages[3]), rows[10], (None, None)]
    return rows


@pytest.mark.parametrize("length, small", [(50, False), (50, True), (8, True), (3, True)])
def test_repeats(spark, monkeypatch, length, small):
    """Small chunks, bins and shards make long texts cut, frequent anchors and merged shards."""
    if small:
        for name, value in {"CHUNK": 700, "REGION_CHUNK": 2000, "PIECE": 300, "BUCKET": 4000, "BIN": 2500, "SHARD": 900, "HOT": 40}.items():
            monkeypatch.setattr(repeated_bytes, name, value)
    rows = some_rows(random.Random(length), length)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], DOCS).repartition(3)
    found = [tuple(r) for r in remove_repeats(df, length).collect()]
    assert sorted(map(str, found)) == sorted(map(str, plain(rows, length)))


def test_kept_texts(spark):
    passage = "".join(random.Random(1).choices("abcdefgh ", k=120))
    rows = [(1, "one " + passage), (2, passage + " two"), (3, "own words only"), (4, "one " + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in remove_repeats(df, texts=True).collect()}
    assert found[2]["kept"] == b" two" and found[2]["spans"] == [[0, 120]]
    assert found[3]["kept"] == b"own words only" and found[3]["spans"] == []
    assert found[4]["kept"] == b"" and found[4]["spans"] == [[0, 124]] and found[1]["n_removed"] == 0
    assert remove_repeats(df.limit(0), texts=True).count() == 0
    assert remove_repeats(df.limit(0)).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("lanes", [1, 5, 1 << 14])
def test_suffix_arrays(monkeypatch, lanes):
    monkeypatch.setattr(suffix_array, "LANES", lanes)
    rng = random.Random(lanes)
    for trial in range(40):
        text = bytes(rng.choices(b"\0\0ab", k=rng.randint(1, 300)))
        if trial % 2:
            text = bytes(rng.choices(range(256), k=rng.randint(1, 30))) * rng.randint(1, 9)
        data = np.frombuffer(text, np.uint8)
        order = suffix_array.suffix_order(data)
        suffixes = [text[i:] for i in order]
        assert suffixes == sorted(text[i:] for i in range(len(text)))
        limit = rng.choice([5, 8, 50])
        shared = suffix_array.common_prefixes(data, order, limit)
        for k in range(1, len(text)):
            pairs = zip(suffixes[k - 1][:limit], suffixes[k][:limit], strict=False)
            same = next((n for n, (a, b) in enumerate(pairs) if a != b), None)
            whole = min(limit, len(suffixes[k - 1]), len(suffixes[k]))
            assert shared[k] == (whole if same is None else same)
