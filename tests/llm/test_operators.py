"""Each operator against a plain version on awkward rows, on empty tables, and with other parameters."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslens.llm import decontaminate, language, lines, nearcopy, packing, quality, sentences, sharding, suffix, tokens, toxicity, words
from presslens.llm.catalog import tokenizer
from presslens.llm.store import Scratch
from presslens.llm.store import texts as as_bytes
from tests.llm import data

ROWS = data.documents()
TEXTS = {r[0]: r[1] for r in ROWS}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, data.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], data.SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer())


def measured(docs):
    rows = docs.selectExpr("doc_id", "lang AS stratum", "CAST(coalesce(text, '') AS BINARY) AS text")
    return quality.measure(rows, "text")


def test_quality_counts(docs):
    rows = measured(docs).withColumn("base_failed", quality.base_failed()).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        want = data.quality_counts(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_quality_cutoffs_keep_good_rows(spark):
    """Junk goes where a stratum has labels enough; where it has too few, nothing but the base rule holds."""
    schema = "doc_id long, stratum string, " + quality.COUNTS
    good = [(i, None if i % 3 else "a", 100, 500, i % 2, 0, i % 5, 10, 20, 1) for i in range(6000)]
    junk = [(10_000 + i, None if i % 3 else "a", 100, 500, 90, 0, 0, 10, 20, 1) for i in range(900)]
    few = [(20_000 + i, "few", 100, 500, 90 * (i % 2), 0, 0, 10, 20, 1) for i in range(60)]
    rows = spark.createDataFrame(good + junk + few, schema)
    labels = spark.createDataFrame([(r[0], r[4] < 50) for r in good + junk + few] + [(0, None), (1, True)], "doc_id long, good boolean")
    found = {r.doc_id: r.kept for r in quality.verdicts(rows, labels, "stratum").collect()}
    assert len(found) == len(good + junk + few)
    assert sum(not found[r[0]] for r in good) <= 0.01 * len(good)
    assert not any(found[r[0]] for r in junk)
    assert all(found[r[0]] for r in few)


def test_quality_empty(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, good boolean")
    assert quality.verdicts(measured(empty), labels, "stratum").count() == 0
    some = spark.createDataFrame([(1, "a", 100, 500, 0, 0, 0, 10, 20, 1)], "doc_id long, stratum string, " + quality.COUNTS)
    assert [r.kept for r in quality.verdicts(some, labels, "stratum").collect()] == [True]


@given(st.integers(1, 400), st.floats(0.001, 0.5), st.data())
@settings(max_examples=60, deadline=None)
def test_binomial(n, p, draw):
    from math import comb

    k = draw.draw(st.integers(0, n))
    assert quality.binomial_at_most(k, n, p) == pytest.approx(min(1, sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))), rel=1e-6)


def test_severity(spark, docs, empty):
    mild = [(i, data.words(40, i) + " nasty", 1) for i in range(150)]
    strong = [(1000 + i, data.words(40, 500 + i) + " nasty vile", 2) for i in range(150)]
    clean = [(2000 + i, data.words(40, 900 + i), 0) for i in range(600)] + [(1, None, 0), (2, "x", None)]
    labelled = spark.createDataFrame(mild + strong + clean, "doc_id long, text string, grade int")
    fresh = [(1, data.words(60, 5000) + " Nasty"), (2, data.words(60, 5001) + " vile NASTY"), (3, data.words(60, 5002)), (4, None), (5, "")]
    grades = labelled.select("doc_id", "grade")
    found = {r.doc_id: r for r in toxicity.severity(spark.createDataFrame(fresh, "doc_id long, text string"), grades, labelled).collect()}
    assert [found[i].grade for i in (1, 2, 3)] == [1, 2, 0]
    assert found[3].severity < found[1].severity < found[2].severity <= 2
    assert not found[4].toxic and not found[5].toxic
    assert toxicity.severity(docs, grades, labelled).count() == len(ROWS)
    assert toxicity.severity(empty, grades, labelled).count() == 0
    assert {r.severity for r in toxicity.severity(docs, grades.limit(0)).collect()} == {0.0}


def test_token_counts_and_cache(spark, docs, empty, library, tmp_path):
    cache = str(tmp_path / "cache")
    spark.createDataFrame([], tokens.CACHE_SCHEMA).write.parquet(cache)

    def check():
        rows = tokens.token_counts(docs, tokenizer(), cache).collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            text = TEXTS[r.doc_id] or ""
            n = len(library.encode(text, add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024)
        return spark.read.parquet(cache).count()

    distinct = len({t or "" for t in TEXTS.values()})
    assert check() == distinct
    assert check() == distinct  # the second run finds every content in the cache
    assert tokens.token_counts(empty, tokenizer()).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(docs, name):
    path = tokenizer(name)
    rows = tokens.token_counts(docs, path).collect()
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        size = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    assert all(r.n_tokens == size(TEXTS[r.doc_id] or "") for r in rows)


@given(st.text(st.sampled_from("ab 'stné\n\t \x1c1½漢<|>.") | st.characters(), max_size=60))
@settings(max_examples=400, deadline=None)
def test_pieces_give_the_ids_of_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    encoder, library = ENCODERS()
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def ENCODERS(made=[]):  # noqa: B006
    if not made:
        from tokenizers import Tokenizer

        made += [tokens.Encoder(tokenizer(), memory=50), Tokenizer.from_file(tokenizer())]
    return made


def check_packing(rows, library, texts, size):
    per, ids = Counter(r[0] for r in texts), {}
    got, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        if r.doc_id not in ids:
            text = next(t for d, t in texts if d == r.doc_id)
            ids[r.doc_id] = library.encode(text or "", add_special_tokens=False).ids + [1]
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        for i in range(r.start, r.start + r.length):
            got[r.doc_id, i] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert all(got[d, i] == n for d, n in per.items() for i in range(len(ids[d])))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= size
    return sequences


def test_packing(docs, empty, library):
    texts = [(r[0], r[1]) for r in ROWS]
    for windows in (1, 4, 128):
        rows = packing.pack(docs, tokenizer(), windows=windows).collect()
        check_packing(rows, library, texts, 2048)
    assert packing.pack(empty, tokenizer()).count() == 0


def test_packing_merges_leftovers_in_rounds(spark, library):
    texts = [(i, data.words(5 + i % 90, i)) for i in range(400)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(70), tokenizer(), size=512, windows=8).collect()
    sequences = check_packing(rows, library, texts, 512)
    used = sum(n for pieces in sequences.values() for _, n in pieces)
    assert used / (512 * len(sequences)) > 0.8


def test_suffix(docs, empty):
    rows = suffix.drop_repeated_strings(docs, chunk_bytes=20_000).collect()
    order = [(r[0], r[1]) for r in ROWS]
    want = Counter()
    for (doc, text), flags in zip(order, data.repeated_bytes([t for _, t in order]), strict=True):
        raw = (text or "").encode()
        spans = sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))
        want[doc, len(raw), sum(flags), spans, bytes(b for b, f in zip(raw, flags, strict=True) if not f)] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows) == want
    assert suffix.drop_repeated_strings(empty).count() == 0


def test_difference_cover():
    assert {(a - b) % suffix.PERIOD for a in suffix.COVER for b in suffix.COVER} == set(range(suffix.PERIOD))


@pytest.mark.parametrize("seed", range(4))
def test_suffix_excerpts(spark, seed):
    """Excerpts of a few hundred bytes at any distance, some twice in one text, around the least length."""
    import random

    draw = random.Random(seed)
    pool = "".join(draw.choice("abcdefgh ") for _ in range(3000))
    rows = []
    for i in range(40):
        parts = []
        for _ in range(draw.randint(1, 4)):
            a = draw.randrange(2500)
            parts.append(pool[a : a + draw.choice([150, 199, 200, 201, 230, 280, 450])])
            parts.append("".join(draw.choice("ijklmnop ") for _ in range(draw.choice([0, 1, 30, 100]))))
        rows.append((i, "".join(parts)))
    found = suffix.drop_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), chunk_bytes=2000).collect()
    want = dict(zip([i for i, _ in rows], data.repeated_bytes([t for _, t in rows]), strict=True))
    assert {r.doc_id: r.n_removed for r in found} == {i: sum(f) for i, f in want.items()}


def test_language(spark, docs, empty):
    samples = {"aa": "lorem ipsum dolor sit amet ", "bb": "wenn fliegen hinter fliegen fliegen ", "cc": "où était ça éèê "}
    rows = [(i, samples[["aa", "bb", "cc"][i % 3]] * (1 + i % 7), ["aa", "bb", "cc"][i % 3]) for i in range(300)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !", "cc"), (1003, samples["bb"] * 20_000, None), (None, samples["aa"], "aa")]
    # Numbers, signs and marks that no letter is among.
    rows += [(2000 + i, text, "aa") for i, text in enumerate(["½ ² ③", "Ⅷ", "\u0301\u0302", "_ 7 ٣", "☃ ∑ €"])]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language.identify(table, table.doc_id % 5 != 0).collect()}
    assert len(found) == len(rows)
    assert all(found[i].lang_pred == ["aa", "bb", "cc"][i % 3] and found[i].held_out == (i % 5 == 0) for i in range(300))
    assert [found[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "bb", "aa"]
    assert all(0 <= r.score <= 1 for r in found.values())
    assert all((found[2000 + i].lang_pred, found[2000 + i].score) == ("und", 0.0) for i in range(5))
    assert language.identify(docs, docs.doc_id > 0).count() == len(ROWS)
    assert language.identify(empty, empty.doc_id > 0).count() == 0
    assert {r.lang_pred for r in language.identify(docs, docs.doc_id < 0).collect()} == {"und"}


def test_language_kernel_against_plain():
    """Kernel values from sets of places, features from the landmarks' kernel matrix, and ridge by its normal equations."""

    def places(text):
        raw = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
        b = f" {raw} ".encode() if raw else b""
        rest = language.SPACE - 256
        out = set(b) | {256 + ((x * 256 + y) * 2654435761 % 2**32 >> 8) % rest for x, y in zip(b, b[1:], strict=False)}
        return out | {256 + ((x * 65536 + y * 256 + z) * 2246822519 % 2**32 >> 7) % rest for x, y, z in zip(b, b[1:], b[2:], strict=False)}

    texts = [data.words(30, i) + extra for i, extra in enumerate(["", "été où ça", "12 3", "wenn fliegen", " - ", "x", "漢字"] * 3)] + ["", "7"]
    sets = [places(t) for t in texts]
    kernel = np.array([[len(a & b) / max(1, (len(a) * len(b)) ** 0.5) for b in sets] for a in sets])
    present = language.presence(texts)
    assert np.abs(present @ present.T - kernel).max() < 1e-5
    langs = ["aa" if i % 3 else "bb" for i in range(len(texts))]
    first = [i < 6 for i in range(len(texts))]
    model = language.Model(texts, langs, first, ridge=0.01)
    own, cross = kernel[:6, :6], kernel[:, :6]
    z = model.features(present).astype(float)
    # Nyström: the features' products are the kernel's projection on the landmarks.
    assert np.abs(z[:, :-1] @ z[:, :-1].T - cross @ np.linalg.pinv(own, rcond=1e-6) @ cross.T).max() < 1e-3
    target = np.array([[1.0 if lang == one else -1.0 for one in ("aa", "bb")] for lang in langs])
    want = np.linalg.solve(z.T @ z + 0.01 * len(texts) * np.eye(z.shape[1]), z.T @ target)
    assert np.abs(model.weights - want).max() < 1e-3


def test_null_ids(spark):
    """Rows without an id get what their texts get; only links between documents need one."""
    texts = [data.words(80, 1), data.words(80, 1), data.words(60, 2), None, ""]
    named = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bare = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    bench = spark.createDataFrame([("q", " ".join(data.bench_words(texts[2])[3:20]))], "item_id string, text string")

    def results(docs):
        packed = packing.pack(docs, tokenizer()).select("start", "length", "ids_crc32", "doc_tokens")
        parts = [
            tokens.token_counts(docs, tokenizer()).drop("doc_id"), packed,
            suffix.drop_repeated_strings(docs).drop("doc_id"),
            decontaminate.Index(docs, bench).contamination().select("n_words", "n_hit"),
        ]
        return [Counter(tuple(r) for r in p.collect()) for p in parts]

    assert results(named) == results(bare)


def test_blocks_of_a_hub_are_dealt_out(spark, tmp_path):
    """Pairs of blocks are shuffled by hub and both blocks, not kept where their hub's join left them."""
    schema = "hub long, node long, component long, n long, diff binary"
    members = spark.createDataFrame([(1, i, i, 5, b"") for i in range(9)], schema)
    members.write.parquet(f"{tmp_path}/members")
    found = nearcopy.across_components(spark.read.parquet(f"{tmp_path}/members"), 80, Scratch(spark, "test"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(hub" in plan and "i#" in plan.split("hashpartitioning(hub")[-1].split(")")[0]


def test_near_copies(spark, docs, empty):
    rows = nearcopy.near_duplicates(docs).collect()
    want = data.groups(TEXTS)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows) == Counter(
        (r[0], len(data.shingle_set(r[1])), want[r[0]], want[r[0]] == r[0]) for r in ROWS
    )
    assert nearcopy.near_duplicates(empty).count() == 0
    one = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (None, None)], "doc_id long, text string")
    assert Counter((r.doc_id, r.component_id, r.kept) for r in nearcopy.near_duplicates(one).collect()) == Counter([(None, 5, False), (5, 5, True), (None, None, False)])


@pytest.mark.parametrize("seed", range(3))
def test_near_copy_chains(spark, seed, monkeypatch):
    """Chains whose ends are not similar, copies, and pairs around the threshold; groups of several blocks."""
    import random

    monkeypatch.setattr(nearcopy, "BLOCK", 4 if seed else 2048)
    draw, rows = random.Random(seed), []
    for g in range(12):
        text = data.words(draw.randint(20, 200), 100 * seed + g)
        for k in range(draw.randint(1, 9)):
            rows.append((len(rows), text))
            if k % 3:
                text = data.near(text, k + g)
    draw.shuffle(rows)
    texts = dict(rows)
    found = nearcopy.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in found} == data.groups(texts)


@pytest.mark.parametrize("block", [3, 2048])
def test_siblings_of_a_missing_base(spark, block, monkeypatch):
    """Many copies of one text with edits of their own: pairs on both sides of the threshold, under one hub."""
    import random

    monkeypatch.setattr(nearcopy, "BLOCK", block)
    draw, base, rows = random.Random(9), data.words(90, 77), []
    for i in range(60):
        text = base
        for k in range(draw.randint(1, 4)):
            parts = text.split(" ")
            parts[draw.randrange(len(parts))] = f"w{i}x{k}" if draw.random() < 0.7 else f"same{draw.randrange(3)}"
            text = " ".join(parts)
        rows.append((i, text))
    found = nearcopy.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = data.groups(dict(rows))
    assert len(set(want.values())) > 1 and {r.doc_id: r.component_id for r in found} == want


def test_super_minhash_estimates_similarity():
    """The share of equal places is an unbiased estimate, with less spread than independent hashes give."""
    draw = np.random.default_rng(5)
    errors = []
    for n in (3, 30, 300, 3000):
        for _ in range(15):
            both, a, b = (draw.integers(0, 2**63, n, dtype=np.uint64) for _ in range(3))
            row = np.repeat([0, 1], 2 * n)
            signs = nearcopy.super_minhash(row, np.concatenate((both, a, both, b)), 2, 112)
            errors.append((signs[0] == signs[1]).mean() - 1 / 3)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.0455


def test_shards(spark, docs, empty):
    rows = sharding.proportional_shards(docs, 7).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in ROWS
    )
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert sharding.proportional_shards(empty, 7).count() == 0


def test_shards_hold_the_mixture(spark):
    rows = [(i, "t", "hot" if i % 3 == 0 else f"s{i % 5}" if i % 7 else None) for i in range(4000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sharding.proportional_shards(table, 10).join(table.select("doc_id", "source"), "doc_id").groupBy("source", "shard").count().collect()
    total = Counter(r[2] for r in rows)
    assert all(abs(r["count"] - total[r.source] / 10) <= 2 for r in found)


BENCH = [
    (1, " ".join(data.bench_words(data.words(70, 2))[5:45])),
    (2, "a b c"), (3, None), (4, ""), (5, "5 6 7 8 9"), (6, "one"), (6, "One!"), (7, "nowhere to be found in any of these texts, ever and ever and ever again"),
    (8, "x x x x x x x x x x x x x x"), (9, "- - -"), (10, "a b"), (11, data.COMPLEMENTS[0]),
]


def test_decontaminate(spark, docs, empty):
    bench = spark.createDataFrame(BENCH, "item_id int, text string")
    found = decontaminate.Index(docs, bench).contamination().select("*", decontaminate.items_digest().alias("digest"), decontaminate.contaminated().alias("flag"))
    rows = found.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        n, hit, names = data.hits(TEXTS[r.doc_id], BENCH)
        assert (r.n_words, r.n_hit, r.ids) == (n, hit, names)
        assert r.digest == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert r.flag == (hit > 0 and 20 * hit >= n)
    gone = found.filter("flag").select("doc_id", "key").distinct()
    left = lines.without_rows(docs, gone)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in rows if not r.flag)
    assert decontaminate.Index(empty, bench).contamination().count() == 0
    assert {r.n_hit for r in decontaminate.Index(docs, bench.limit(0)).contamination().collect()} == {0}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha beta very gamma delta"), (3, "gamma beta"), (4, "alpha")], "doc_id long, text string")
    index = decontaminate.Index(docs, spark.createDataFrame([("q", "beta gamma")], "item_id string, text string"))
    assert [(r.doc_id, r.item_id, r.gap) for r in index.proximity(1).collect()] == [(2, "q", 1)]


def test_sentences(docs, empty):
    done = sentences.drop_repeated_spans(docs)
    assert done.columns == docs.columns
    want = data.without_spans(TEXTS)
    assert Counter((r.doc_id, r.text, r.key, r.kept) for r in done.collect()) == Counter((r[0], want[r[0]], r[7], r[5]) for r in ROWS)
    assert sentences.drop_repeated_spans(empty).count() == 0


@given(st.lists(st.text(st.sampled_from("ab .\n\té漢!"), max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_word_spans(texts):
    import pyarrow as pa

    column = pa.array([t.encode() for t in texts], pa.binary())
    found = [[] for _ in texts]
    for i, _, buffer, offsets in words.slices(column, 16):
        for a, b, r in zip(*words.spans(words.NOT_SPACE[buffer], offsets), strict=True):
            found[i + r].append(buffer[a:b].tobytes().decode())
    assert found == [data.split(t) for t in texts]


def test_fingerprints_do_not_depend_on_the_place(monkeypatch):
    draw = np.random.default_rng(1)
    piece = draw.integers(0, 256, 700, dtype=np.uint8)
    monkeypatch.setattr(words, "BLOCK", 256)
    marks = words.Fingerprint()
    buffer = np.concatenate((draw.integers(0, 256, 911, dtype=np.uint8), piece, piece[:300], piece))
    first = np.array([911, 1611, 1911])
    found = marks.segments(buffer, first, first + 300)
    assert found[0] == found[1] == found[2] != marks.segments(buffer, first[:1] + 1, first[:1] + 301)[0]


def test_texts_are_bytes(docs):
    assert as_bytes(docs, "doc_id", "text").columns == ["doc_id", "text"]


def test_decontaminate_with_null_item_ids(spark):
    """An item without an id marks its words; it has no name to list."""
    one, two = (" ".join(f"{name}{i}" for i in range(15)) for name in ("left", "right"))
    bench = spark.createDataFrame([(None, one), ("q", two)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"{one} {two} end"), (2, one), (3, "other")], "doc_id long, text string")
    rows = decontaminate.Index(docs, bench).contamination().collect()
    assert {(r.doc_id, r.n_hit, tuple(r.ids)) for r in rows} == {(1, 30, ("q",)), (2, 15, ()), (3, 0, ())}


def test_complementary_strings_differ():
    """Alternating strings and their complements agree for any polynomial of an odd base modulo 2^64 from 1,024 bytes on."""
    for size in (512, 1024, 2048, 4096):
        one = np.array([97 + bin(i).count("1") % 2 for i in range(size)], np.uint8)
        both = np.concatenate((one, 195 - one, one))
        first = np.arange(3) * size
        for salt in (0, 1, 2):
            x, y, again = words.Fingerprint(salt).segments(both, first, first + size)
            assert x == again != y
