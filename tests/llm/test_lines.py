"""Line dedup against a plain version, and its filters."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslens.llm import catalog, lines
from presslens.llm import words as W
from presslens.llm.store import row_key
from tests.llm import data
from tests.oracle import compare, connect

SPACES = " \t\n\x0b\x0c\r"


def plain(rows: list[tuple], min_chars: int, min_docs: int) -> list[tuple]:
    """(doc_id, text, n_lines, n_dropped); None is the least id."""

    def key(line):
        return data.lower(line.strip(SPACES))

    bearers = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= max(min_chars, 1):
                bearers[key(line)].add(doc)
    keeper = {k: max(docs, key=lambda d: (d is not None, d)) for k, docs in bearers.items() if len(docs) >= min_docs}
    out = []
    for doc, text, *_ in rows:
        own = (text or "").split("\n")
        left = [line for line in own if keeper.get(key(line), doc) == doc]
        out.append((doc, None if text is None else "\n".join(left), len(own), len(own) - len(left)))
    return out


def rows_of(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def table() -> list[tuple]:
    draw = random.Random(5)
    pool = ["  Copyright of ALL of it, every right reserved \t", "copyright of all of it, every right reserved", "é" * 39 + "x", "é" * 39, "x" * 40, "Ünter den Linden " * 3, "", " ", "z" * 5000]
    # Two long lines that are each other's complement.
    pool += ["".join("ab"[(bin(i).count("1") + k) % 2] for i in range(2048)) for k in (0, 1)]
    rows = []
    for i in range(80):
        own = [draw.choice(pool) if draw.random() < 0.5 else data.words(9, i * 100 + k).replace("\n", " ") for k in range(draw.randint(0, 9))]
        rows.append((i if i % 9 else None, draw.choice(["\n", "\n", "\r\n", "\n\n"]).join(own)))
    rows += [(500, None), (501, ""), (502, "\n"), (503, "\n\n" + pool[0] + "\n"), rows[0], rows[1], rows[1], (3, pool[1]), (600, "x" * 40 + "\n" + "X" * 40)]
    return rows


@pytest.mark.parametrize(("chars", "docs"), [(40, 5), (1, 2), (40, 2), (10_000, 1)])
def test_against_plain(spark, chars, docs):
    rows = table()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert rows_of(lines.drop_repeated_lines(df, chars, docs)) == Counter(plain(rows, chars, docs))


def test_awkward_rows_and_clashing_columns(spark):
    rows = data.documents()
    df = spark.createDataFrame(rows, data.SCHEMA).withColumnsRenamed({"size": "numbers", "window": "n_lines", "place": "digest"}).repartition(3)
    found = rows_of(lines.drop_repeated_lines(df, 10, 2))
    assert found == Counter(plain(rows, 10, 2))
    assert lines.drop_repeated_lines(df.limit(0)).count() == 0
    named = spark.createDataFrame([("b", "one line\nx"), ("a", "One LINE "), (None, " one line")], "name string, body string")
    found = lines.drop_repeated_lines(named, 3, 3, "name", "body")
    assert rows_of(found) == Counter([("b", "one line\nx", 2, 0), ("a", "", 1, 1), (None, "", 1, 1)])


@given(st.lists(st.text(st.sampled_from("aB é\t\n\r"), max_size=20), max_size=6))
@settings(max_examples=80, deadline=None)
def test_lines_of_a_buffer(texts):
    found = []
    for i, j, buffer, offsets in W.slices(pa.array([t.encode() for t in texts], pa.binary()), 16):
        own = [[] for _ in range(j - i)]
        for a, b, r, lo, hi in zip(*lines.line_spans(buffer, offsets), strict=True):
            own[r].append((buffer[a:b].tobytes().decode(), buffer[lo:hi].tobytes().decode()))
        found += own
    assert found == [[(line, line.strip(SPACES)) for line in t.split("\n")] for t in texts]


def test_filters_never_lose_a_repeat():
    draw = np.random.default_rng(2)
    hashes = draw.integers(0, 2**63, 3000).astype(np.uint64)
    parts = [np.concatenate((hashes[:200], hashes[1000:1100], hashes[1000:1100])), hashes[100:1000], hashes[2000:]]
    pairs = []
    for part in parts:
        pair = lines.Filters(1 << 16)
        pair.add(part)
        pairs.append((pair.once, pair.twice))
    for order in ([0, 1, 2], [2, 1, 0], [1, 2, 0]):
        one = lines.Filters.merge(lines.Filters.merge(pairs[order[0]], pairs[order[1]]), pairs[order[2]])
        other = lines.Filters.merge(pairs[order[0]], lines.Filters.merge(pairs[order[1]], pairs[order[2]]))
        assert (one[0] == other[0]).all() and (one[1] == other[1]).all()
        assert lines.holds(one[1], hashes[100:200]).all() and lines.holds(one[1], hashes[1000:1100]).all()
        assert lines.holds(one[0], np.concatenate(parts)).all()
        assert lines.holds(one[1], hashes[2000:]).mean() < 0.2


def test_full_filters_change_nothing(spark, monkeypatch):
    """Filters far too small let every line through, and the result is the same."""
    for name in ("MIN_BITS", "MAX_BITS"):
        monkeypatch.setattr(lines, name, 1 << 6)
    rows = table()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(lines.drop_repeated_lines(df, 10, 3)) == Counter(plain(rows, 10, 3))


def test_only_suspects_are_shuffled(spark, tmp_path):
    """Lines that stand once stay where they are: the counted table holds repeated ones and few others."""
    rows = [(i, f"a line of its own with the number {i:07d} in it\n" + ("a line that every document has, word for word" if i % 2 else "")) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed = df.select("doc_id", row_key("doc_id", "text").alias("key"), df.text.cast("binary").alias("text"))
    hashes = lines.line_hashes(keyed, 40)
    assert hashes.count() == 6000
    twice = lines.filled(hashes, 2)
    found = lines.suspects(keyed, spark.sparkContext.broadcast(twice.tobytes()), 40)
    assert 2000 <= found.count() <= 2040


def test_twin(spark, sf):
    found = catalog.QUERIES["op12_bloom_line_dedup"](spark, sf).toPandas()
    assert compare(found, connect(sf).execute(catalog.SQL["op12_bloom_line_dedup"]).df()) == ""
    assert found.n_dropped.sum() > 0
