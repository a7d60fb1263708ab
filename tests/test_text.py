from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from presslens.functions import scalars as sc
from presslens.functions import text as tx
from presslens.functions.stemming import stem_portuguese, stem_tokens
from presslens.operators import counts as ct

# Word and stem pairs of the published algorithm's sample vocabulary, and of its rules.
STEM_PAIRS = {
    "boa": "boa", "boainain": "boainain", "boas": "boas", "bôas": "bôas", "boassu": "boassu",
    "boataria": "boat", "boate": "boat", "boates": "boat", "boatos": "boat", "bob": "bob", "boba": "bob",
    "bobagem": "bobag", "bobagens": "bobagens", "bobalhões": "bobalhõ", "quiabo": "quiab",
    "quicaram": "quic", "quieto": "quiet", "quietos": "quiet", "quilo": "quil", "quilombo": "quilomb",
    "quilométricas": "quilométr", "quilômetro": "quilômetr", "quilos": "quil", "quimera": "quim",
    "química": "químic", "quimioterapia": "quimioterap", "quinhão": "quinhã", "quintessência": "quintessent",
    "fracção": "fracçã", "notícias": "notíc", "rapidamente": "rapid", "felicidade": "felic",
}


def test_stems(spark):
    got = {w: stem_portuguese(w) for w in STEM_PAIRS}
    assert got == STEM_PAIRS


def test_stem_arrays_keep_shape(spark):
    rows = [(1, ["boatos", "quilos", "boatos"]), (2, []), (3, None), (4, ["química", None, ""])]
    df = spark.createDataFrame(rows, "id int, w array<string>").repartition(2)
    got = {r["id"]: r["s"] for r in df.select("id", stem_tokens("w").alias("s")).collect()}
    assert got == {1: ["boat", "quil", "boat"], 2: [], 3: None, 4: ["químic", None, ""]}


@pytest.mark.parametrize(
    "text, clean",
    [
        (None, None),
        ("", ""),
        ("a\nb", "ab"),
        (' "Olá", disse - ela\t', "Olá disse - ela"),
        ("ação: 19% covid-19", "ação 19 covid-19"),
    ],
)
def test_clean_delete(spark, text, clean):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tx.clean_delete(F.col("t"))).first()[0] == clean


def test_clean_space_drops_links_to_line_end(spark):
    df = spark.createDataFrame([("ver https://a.pt/b c\nfim!",)], "t string")
    assert df.select(tx.clean_space(F.col("t"))).first()[0] == "ver  \nfim"


def test_gate_and_truncation(spark):
    df = spark.createDataFrame([("x" * 80,), ("x" * 81,), (None,), ("x" * 5001,)], "t string")
    got = df.select(sc.score_gate(F.col("t")).isNotNull(), F.length(sc.truncate(F.col("t")))).collect()
    assert [tuple(r) for r in got] == [(False, 80), (True, 81), (False, None), (True, 5000)]


def test_lookback_of_every_hour(spark):
    got = [r[0] for r in spark.range(24).orderBy("id").select(sc.lookback_minutes(F.col("id"))).collect()]
    assert got == [240] * 7 + [100] * 14 + [120] * 3


def python_grams(words, low, high, sep="_"):
    return [sep.join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


TEXTS = [(1, "a b c d e f a b"), (2, "a"), (3, ""), (4, "x y x y x y"), (5, "b c")]


@pytest.mark.parametrize("low, high", [(1, 5), (2, 5), (1, 1), (3, 4)])
def test_ngrams_match_brute_force(spark, low, high):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    got = ct.term_counts(tx.ngram_rows(ct.tokens_of(docs), "words", low, high)).collect()
    want = Counter((i, g) for i, t in TEXTS for g in python_grams(t.split(), low, high))
    assert {(r["doc_id"], r["term"]): r["n"] for r in got} == dict(want)
    for n in range(low, high + 1):
        arrays = ct.tokens_of(docs).select("doc_id", tx.gram_array(F.col("words"), n).alias("g"))
        for row in arrays.filter("size(g) >= 0").collect():
            assert row["g"] == python_grams(dict(TEXTS)[row["doc_id"]].split(), n, n)


def test_research_grams_drop_stop_words_inside(spark):
    docs = spark.createDataFrame([(1, "o rato da cidade"), (2, "o da o da")], "doc_id long, text string")
    got = Counter(r["term"] for r in ct.research_grams(docs, ["o", "da"], n_min=2, n_max=3).collect())
    assert got == Counter({"rato": 3, "cidade": 1, "rato cidade": 1})


def test_stop_order_before_or_after_stemming(spark):
    docs = spark.createDataFrame([(1, "fomos amados")], "doc_id long, text string")
    before = ct.tokens_of(docs, stop=["fomos"], stem=True).first()["words"]
    after = ct.tokens_of(docs, stop=["fomos"], stem=True, stop_after_stem=True).first()["words"]
    assert before == ["amad"] or before == ["am"]
    assert len(after) == 2


def test_pruning(spark):
    vocab = spark.createDataFrame([("a", 30, 9), ("b", 19, 5), ("c", 25, 3)], "term string, term_count long, doc_count long")
    docs = spark.range(10)
    assert {r["term"] for r in ct.prune(vocab, 20).collect()} == {"a", "c"}
    assert {r["term"] for r in ct.prune(vocab, 10, 0.5, docs).collect()} == {"b", "c"}
    assert {r["term"] for r in ct.prune(vocab, 1, min_docs=5).collect()} == {"a", "b"}


def test_label_from_path_uses_the_base_name(spark):
    paths = ["x/labeled_data/labeled_data/no_covid_label-1.json", "x/labeled_data/pub-2.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(sc.label_from_path(F.col("p"))).collect()] == [False, True]


# Cases of the published word boundary rules: text, words.
BOUNDARIES = [
    ("The quick (\u201cbrown\u201d) fox can\u2019t jump 32.3 feet, right?", "the quick brown fox can\u2019t jump 32.3 feet right"),
    ("don't stop, 'quoted' words' end", "don't stop quoted words end"),
    ("3.14 1,234.5 3a A_B 1:2 a:b a.b. U.S. etc.", "3.14 1,234.5 3a a_b 1 2 a:b a.b u.s etc"),
    ("a,b 1.a a.1 ..a.. 'tis o''clock x;y 1;2", "a b 1 a a 1 a tis o clock x y 1;2"),
    ("caf\u00e9 cafe\u0301s l'\u00e9t\u00e9 e\u0301'e\u0301", "caf\u00e9 cafe\u0301s l'\u00e9t\u00e9 e\u0301'e\u0301"),
    ("\u6f22\u5b57 ab\u6f22cd \u3042\u3044", "\u6f22 \u5b57 ab \u6f22 cd \u3042 \u3044"),
    ("a\u00ad\u200db zero\u200dwidth", "a\u00ad\u200db zero\u200dwidth"),
    ("can't-stop e-mail x=y $5 50% #tag @me", "can't stop e mail x y 5 50 tag me"),
    ("", ""),
    ("... !!! -- '", ""),
]


def test_unicode_words(spark):
    rows = spark.createDataFrame(list(enumerate(t for t, _ in BOUNDARIES)), "i int, text string")
    got = {r.i: r.words for r in rows.select("i", F.array_join(tx.unicode_words(F.col("text")), " ").alias("words")).collect()}
    assert [got[i] for i in range(len(BOUNDARIES))] == [w for _, w in BOUNDARIES]
    long = spark.createDataFrame([("a.b" * 40_000 + " " + "1,2;" * 40_000 + "!?" * 50_000,)], "text string")
    assert long.select(F.size(tx.unicode_words(F.col("text")))).first()[0] == 2


def test_unicode_words_twin(spark):
    """The SQL, which matches words, agrees with the separators on the published cases."""
    import duckdb

    from presslens.catalog.registry import sql_unicode_words

    for given, words in BOUNDARIES:
        assert " ".join(duckdb.execute(f"SELECT {sql_unicode_words('?')}", [given]).fetchone()[0]) == words


def test_plain_texts_are_cut_as_by_the_whole_pattern(spark):
    """Shorter patterns for ASCII texts and for texts of scripts with spaces give the words of the whole one."""
    signs = [chr(c) for c in range(128)] + list(tx.JOIN_LETTERS + tx.JOIN_DIGITS + tx.JOIN_BOTH) + ["́", "‍", "漢", "あ", "é", "K", "İ"]
    frames = ["a{}b", "1{}2", "a{}1", "{}a", "A{}{}B", "é{}b", "é 1{}2", "漢{}a", "{}あ", "á{}b"]
    rows = spark.createDataFrame([(f.format(*[c] * f.count("{}")),) for c in signs for f in frames], "text string")
    whole = F.filter(F.split(F.lower("text"), tx.word_separators()), lambda w: w.rlike(r"[\p{L}\p{Nd}\p{Nl}\p{Pc}]"))
    words = tx.unicode_words(F.col("text"))
    assert rows.filter(~words.eqNullSafe(whole)).collect() == []
    assert tx.ASCII_SEPARATORS in rows.select(words)._jdf.queryExecution().analyzed().toString()
