"""Tokenizer alignment against the libraries over whole texts and a plain merge of their ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslens.llm import alignment, catalog
from presslens.llm.catalog import tokenizer
from tests.llm import data

A, B = tokenizer(), tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    return alignment.Tokenizers(A, B)


def plain_groups(text: str | None):
    """Groups of (ids of A, ids of B) by the libraries over the whole text; none where the bytes differ."""
    import sentencepiece
    from tokenizers import Tokenizer

    if "a" not in _libraries:
        _libraries["a"], _libraries["b"] = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        _libraries["a"].encode_special_tokens = True
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in letters]
        _libraries["bytes"] = {chr(x): x for x in letters} | {chr(256 + k): x for k, x in enumerate(rest)}
    a, b = _libraries["a"], _libraries["b"]
    if not text:
        return []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    spelt_a = [bytes(_libraries["bytes"][c] for c in a.id_to_token(i)) for i in ids_a]
    spelt_b = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
        return []
    ends = []
    for spelt in (spelt_a, spelt_b):
        total, own = 0, []
        for x in spelt:
            total += len(x)
            own.append(total)
        ends.append(own)
    groups, before = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        groups.append(tuple([i for i, e in zip(ids, own, strict=True) if before < e <= cut] for ids, own in zip((ids_a, ids_b), ends, strict=True)))
        before = cut
    return groups


_libraries: dict = {}


def plain(texts: list[str | None]) -> list[tuple]:
    groups = [plain_groups(t) for t in texts]
    links = [Counter((x, y) for a, b in own for x in a for y in b) for own in groups]
    count, best = Counter(p for own in links for p in own), defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for own, pairs in zip(groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append((
            sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(pairs.values()),
            sum(n for p, n in pairs.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in pairs.items()),
            hashlib.sha256(text.encode()).hexdigest() if own else "",
        ))
    return out


def rows_of(df) -> list[tuple]:
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


TEXTS = [
    *[data.words(40, i) for i in range(20)], None, "", " ", "  ", "a", " a", "a ", "\n", "a  b \n\n c\tx", "x　y   z", "é ﬁ ① 漢字 漢字かな",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "under▁score ▁ x", "\U0001f600 \U0001f468‍\U0001f469‍\U0001f467 ok", "don't we'll I'M they've it's 12345 3.14 U.S.", "z" * 3000,
    "a\x00b \x1c c \x1f", "word" * 400 + " end", " ".join("Жди" for _ in range(50)), "!!! ??? ... --- ==>", "the the the the", "a" * 47 + " " + "b" * 49,
]


@given(st.text(st.sampled_from("aAeb \n\t.,'éЖ漢▁\U0001f600<>|s0 \x1c"), max_size=60))
@settings(max_examples=150, deadline=None)
def test_pieces_are_the_whole(text):
    pieces = _libraries.get("pieces") or _libraries.setdefault("pieces", alignment.Pieces(alignment.Tokenizers(A, B)))
    got = alignment.composed(pieces, [text])
    want = plain_groups(text)
    assert [x[0].as_py() for x in got[:3]] == [sum(len(a) for a, _ in want), sum(len(b) for _, b in want), len(want)]
    written = alignment.written([(list(a), list(b)) for a, b in want])
    assert got[4][0].as_py() == (hashlib.sha256(written).hexdigest() if want else "")


def test_no_piece_of_b_has_a_space_inside(tokens):
    """What lone spaces as cuts rest on."""
    assert not any(b" " in spelt.lstrip(b" ") for spelt in tokens.bytes_b)


def test_texts(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[1]), (5, "again the same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted([(r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]), strict=True)], key=str)
    assert rows_of(alignment.align(df, A, B)) == want
    # Groups of any size count their ids first.
    monkeypatch.setattr(alignment, "LARGE", 0)
    assert rows_of(alignment.align(df, A, B)) == want
    # Beyond the bound the table of counts is joined.
    assert rows_of(alignment.align(df, A, B, held=3)) == want


@pytest.fixture
def tiny(monkeypatch):
    for name, value in (("LONG", 120), ("CHUNK", 37), ("REACH", 30), ("FAN_IN", 3)):
        monkeypatch.setattr(alignment, name, value)


def test_long_texts(spark, tiny):
    """Ranges that begin and end anywhere, several rounds of the tree, and texts without a lone space."""
    draw = random.Random(8)
    texts = [*TEXTS, "x" * 2000 + " " + "y " * 100, "漢字" * 300, "\U0001f600" * 90 + " ok " * 40, data.words(900, 3), data.words(400, 4).replace(" ", "  ")]
    texts += [" ".join("".join(draw.choice("abé漢'.") for _ in range(draw.randint(1, 45))) for _ in range(60)) for _ in range(5)]
    rows = [*enumerate(texts), (None, texts[-1]), (3, texts[-1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted([(r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]), strict=True)], key=str)
    assert rows_of(alignment.align(df, A, B)) == want


def test_composition_is_associative(tokens, tiny):
    text = data.words(300, 6)
    parts = []
    for _, region, skip, take in alignment.ranges(text):
        [ids] = tokens.encode([region])
        parts.append(alignment.fragment(tokens, *ids, skip, take)[0])
    parts.insert(4, alignment.Fragment(False, ([1], [2, 3])))
    assert len(parts) > 10 and sum(bool(p.prefix[0]) for p in parts) > 3

    def fold(order):
        """Compose neighbours in the given order; the closed groups by place."""
        own, closed = [(p, k) for k, p in enumerate(parts)], {}
        for at in order:
            at %= len(own) - 1
            (left, lo), (right, hi) = own[at], own[at + 1]
            whole, group = left + right
            if group:
                closed[hi] = group
            own[at : at + 2] = [(whole, lo)]
        return own[0][0].row(), [closed[k] for k in sorted(closed)]

    want = fold([0] * (len(parts) - 1))
    for seed in range(30):
        draw = random.Random(seed)
        assert fold([draw.randrange(1000) for _ in parts[1:]]) == want


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], data.SCHEMA)
    assert alignment.align(empty, A, B).collect() == []
    rows = [(*r[:1], *r[1:]) for r in data.documents() if len(r[1] or "") < 10_000]
    df = spark.createDataFrame(rows, data.SCHEMA).withColumnsRenamed({"size": "codes", "window": "n_a", "place": "chunk"})
    want = sorted([(r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]), strict=True)], key=str)
    assert rows_of(alignment.align(df, A, B)) == want


def test_query(spark, tmp_path):
    rows = list(enumerate(TEXTS))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.QUERIES["op11_fragment_alignment"](spark, str(tmp_path))
    assert rows_of(found) == sorted([(r[0], *w) for r, w in zip(rows, plain(TEXTS), strict=True)], key=str)
