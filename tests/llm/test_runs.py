"""Periodic runs against a plain version that tries every period."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslens.llm import catalog, runs
from presslens.llm import words as W
from tests.llm import data


def plain_runs(words: list[str], least: int = 24, periods: int = 3) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // periods + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(least, periods * q):
                found.setdefault((start, i), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_collapse(words: list[str], found) -> str:
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def in_buffer(texts: list[str], least: int, periods: int):
    out = []
    for _, _, buffer, offsets in W.slices(pa.array([t.encode() for t in texts], pa.binary()), 1 << 10):
        found, left = runs.of_buffer(buffer, offsets, W.Fingerprint(), least, periods)
        out += zip(found, left, strict=True)
    return out


def check(texts: list[str], least: int = 24, periods: int = 3):
    for text, (found, left) in zip(texts, in_buffer(texts, least, periods), strict=True):
        want = plain_runs(data.split(text), least, periods)
        assert found == want, text
        assert left.decode() == plain_collapse(data.split(text), want)


@given(st.lists(st.lists(st.sampled_from("ab"), max_size=90), max_size=4), st.sampled_from([(24, 3), (6, 3), (1, 3), (10, 4), (3, 5)]))
@settings(max_examples=120, deadline=None)
def test_two_words(texts, rule):
    check([" ".join(t) for t in texts], *rule)


@given(st.data())
@settings(max_examples=80, deadline=None)
def test_nested_periods(draw):
    """Powers of powers: every level is a run of its own, with context shared between levels."""
    word = st.sampled_from(["a", "b", "c"])
    block = draw.draw(st.lists(word, min_size=1, max_size=4))
    for _ in range(draw.draw(st.integers(1, 3))):
        block = block * draw.draw(st.integers(1, 9)) + draw.draw(st.lists(word, max_size=3))
    text = draw.draw(st.lists(word, max_size=5)) + block[:700] + draw.draw(st.lists(word, max_size=5))
    check([" ".join(text), " \n ".join(text) + "\n"])


def test_periods_of_every_size():
    """Runs of exactly three periods and one word less, for periods around every context."""
    draw = random.Random(4)
    texts = []
    for q in [*range(1, 35), 47, 63, 64, 65, 100, 127, 128, 129, 200]:
        base = [f"w{draw.randrange(10**9)}" for _ in range(q)]
        for length in (max(24, 3 * q), max(24, 3 * q) - 1, 3 * q + 7):
            texts.append(" ".join(["x", "y", *(base * 24)[:length], "z"]))
        mixed = ["u"] * (q - 1) + ["v"]
        texts.append(" ".join(mixed * 4))
    check(texts)


def test_a_frequent_word_is_no_square():
    """A text of one word, and blocks of one word with a sign between them, stay near linear."""
    block = ["x"] * 400 + ["y"]
    for words, want in (
        (["x"] * 300_000, [(0, 300_000, 1)]),
        (block * 500, sorted([(i * 401, 400, 1) for i in range(500)] + [(0, 401 * 500, 401)])),
    ):
        [(found, left)] = in_buffer([" ".join(words)], 24, 3)
        assert found == want
        assert len(left.split()) <= 402


ROWS = data.documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([*ROWS, (None, "a b " * 30, *[None] * 10), (None, None, *[None] * 10)], data.SCHEMA).repartition(3)


def test_whole_table(docs):
    rows = runs.periodic_runs(docs).collect()
    assert len(rows) == len(ROWS) + 2
    texts = {r[0]: r[1] for r in ROWS}
    for r in rows:
        if r.doc_id is not None:
            want = plain_runs(data.split(texts[r.doc_id])) if len(texts[r.doc_id] or "") < 50_000 else []
            assert [tuple(x) for x in r.runs] == want
            assert r.collapsed == plain_collapse(data.split(texts[r.doc_id]), want)
    assert sorted(r.collapsed for r in rows if r.doc_id is None) == ["", "a b"]


def test_empty_table_and_text_ids(spark):
    empty = spark.createDataFrame([], data.SCHEMA)
    assert runs.periodic_runs(empty).collect() == []
    named = spark.createDataFrame([("n", "a " * 30)], "name string, body string")
    [row] = runs.periodic_runs(named, id_col="name", text_col="body").collect()
    assert (row.doc_id, [tuple(r) for r in row.runs], row.collapsed) == ("n", [(0, 30, 1)], "a")
    with pytest.raises(ValueError):
        runs.periodic_runs(named, periods=2)


def planted(doc_id: int, text: str | None) -> list[str]:
    words = data.split(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


def test_query(spark, tmp_path):
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(draw.choice(["a", "b", "cé", "d"], int(draw.integers(0, 160))))) for i in range(300)]
    rows += [(1000 + i, data.words(150, i)) for i in range(60)] + [(3, None), (7, " "), (17, "one")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(tuple(r) for r in catalog.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect())
    want = []
    for doc_id, text in rows:
        words = planted(doc_id, text)
        own = plain_runs(words)
        best = min(own, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in own)
        milli = 1000 * best[1] // best[2] if own else None
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, plain_collapse(words, own))]
        want.append((doc_id, len(own), *best, milli, *sums))
    assert found == sorted(want, key=lambda r: r[0])
    assert sum(r[1] > 0 for r in found) > 20
