"""Repeated spans: runs of any number of sentences, and cuts that fall alike at every offset."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslens.llm import sentences, words
from tests.llm import data
from tests.llm.test_operators import ROWS, TEXTS


def cut(spark, texts, **kwargs):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: r.text for r in sentences.drop_repeated_spans(docs, **kwargs).collect()}


def draw(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abdeinorstu") for _ in range(rng.randint(3, 9))) for _ in range(n)]


def test_against_plain_loops(spark):
    docs = spark.createDataFrame(ROWS, data.SCHEMA).repartition(3)
    want = data.without_spans(TEXTS)
    assert Counter((r.doc_id, r.text) for r in sentences.drop_repeated_spans(docs).collect()) == Counter((r[0], want[r[0]]) for r in ROWS)


@pytest.mark.parametrize("form", ["{} ", "{}! ", "line"])
def test_short_sentences_are_hashed(spark, form):
    own = draw(100, 1)
    if form == "{}! ":
        text = "".join(form.format(w) for w in own)
    else:
        stop = "\n" if form == "line" else ". "
        text = "".join(" ".join(own[i : i + 4]) + stop for i in range(0, 100, 4))
    done = cut(spark, [text, text])
    assert done == {0: text, 1: ""}


def test_cuts_fall_alike_at_every_offset(spark):
    passage = draw(60, 2)
    for stops in ([], [29], [14, 29, 44]):
        own = [w + "." if i in stops else w for i, w in enumerate(passage)]
        texts = [" ".join(draw(40, 99) + own + draw(40, 98))]
        texts += [" ".join(draw(30 + k, 100 + k) + own + draw(45, 200 + k)) for k in range(20)]
        done, left = cut(spark, texts), []
        for k in range(1, 21):
            now, before = set(done[k].split()), texts[k].split()
            left.append([w for w in own if w in now])
            assert [w for w in before if w not in now and w not in own] == []
            assert len(left[-1]) <= 30
        # Near its edges, cuts also depend on the words around the passage.
        middle = set(own[16:44])
        assert all(not middle & set(x) for x in left), left


def test_every_window_of_fifty_words_loses_most(spark):
    """Of any 50 words that an earlier text holds at least 20 go; the others lie before the first or after the last cut."""
    source = draw(400, 3)
    texts = [" ".join(source)] + [" ".join(draw(7 + k, 300 + k) + source[5 * k : 5 * k + 50] + draw(9, 400 + k)) for k in range(60)]
    done = cut(spark, texts)
    kept = [len(set(done[k + 1].split()) & set(source[5 * k : 5 * k + 50])) for k in range(60)]
    assert max(kept) <= 30, kept


def test_scripts_without_spaces(spark):
    rng = random.Random(4)
    text = "".join("".join(chr(rng.randint(0x4E00, 0x9F00)) for _ in range(12)) + "。" for _ in range(20))
    thai = "".join(chr(rng.randint(0x0E01, 0x0E2E)) for _ in range(400))
    done = cut(spark, [text, text, "前" * 3 + text, thai, thai])
    assert done[0] == text and done[1] == "" and len(done[2]) < 40 and done[3] == thai and done[4] == ""


@given(st.lists(st.text(st.sampled_from("ab.!?»」'\")。،、，漢字かกข\U00020001é \n\t"), max_size=60), min_size=1, max_size=3))
@settings(max_examples=120, deadline=None)
def test_words_and_stops_against_plain(texts):
    """Words, weights, sentence ends and pieces of a buffer of several texts."""
    import pyarrow as pa

    for _, _, buffer, offsets in words.slices(pa.array([t.encode() for t in texts], pa.binary())):
        begin, after, row, first, _, weight, stops = sentences.sentences(buffer, offsets, words.Fingerprint())
        for r, text in enumerate(texts):
            want = data.span_pieces(text)
            mine = [(int(b), int(a)) for b, a, x in zip(begin, after, row, strict=True) if x == r]
            places = [len(text[: w[0]].encode()) + int(offsets[r]) for p in want for w in p]
            at = [i for b, a in mine for i in range(b, a)]
            assert [int(first[i]) for i in at] == places
            assert [(int(weight[i]), bool(stops[i])) for i in at] == [(w[2], w[4]) for p in want for w in p]
            assert [a - b for b, a in mine] == [len(p) for p in want]
