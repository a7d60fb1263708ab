from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from presslens.functions import scalars as sc
from presslens.sinks import tables
from presslens.sources import archive, corpus, feed, pages
from presslens.streaming import flows


def test_failed_pull_is_an_empty_table_with_all_columns(spark):
    df = feed.read_feed(spark, "/tmp/no-such-feed", on_error="empty")
    assert df.count() == 0 and df.schema == feed.FEED_SCHEMA
    assert sc.drop_null(df, "urlArticle").count() == 0
    with pytest.raises(PySparkException):
        feed.read_feed(spark, "/tmp/no-such-feed")


def test_limit_comes_before_deduplication(spark):
    rows = [(i, "same" if i < 8 else f"u{i}", datetime(2024, 1, 1, 12, 59 - i)) for i in range(20)]
    df = spark.createDataFrame(rows, "titleArticle int, urlArticle string, datetimeArticle timestamp")
    got = feed.feed_pull(df, datetime(2024, 1, 1, 13), 60, cap=10).collect()
    assert sorted((r["urlArticle"], r["titleArticle"]) for r in got) == [("same", 0), ("u8", 8), ("u9", 9)]


def test_runs_cover_every_minute_of_the_day(spark):
    minutes = spark.range(1440).select(F.timestamp_seconds(F.col("id") * 60 + 1_704_067_200).alias("ts"))
    per_minute = minutes.select("ts", F.size(feed.pull_runs(F.col("ts"))).alias("n"))
    low, high = per_minute.agg(F.min("n"), F.max("n")).first()
    assert low >= 1 and high <= 10


CSV_FILES = {
    "a.csv": 'url,title,maintext\nu1,T1,"line 1\nline ""2"""\nu2,NA,x\n',
    "b.csv": 'title,url,date_publish,maintext\nT3,u1,2020-04-01,y\nT4,u3,NA,"a, b"\n',
    "c.csv": "url,maintext\nu4,z\n",
}


def test_drifting_headers(spark, tmp_path):
    for name, text in CSV_FILES.items():
        (tmp_path / name).write_text(text)
    rows = archive.read_snapshots(spark, f"{tmp_path}/*.csv")
    got = {(r["file_name"], r["url"], r["title"], r["maintext"], r["date_publish"]) for r in rows.collect()}
    assert got == {
        ("a.csv", "u1", "T1", 'line 1\nline "2"', None),
        ("a.csv", "u2", None, "x", None),
        ("b.csv", "u1", "T3", "y", "2020-04-01"),
        ("b.csv", "u3", "T4", "a, b", None),
        ("c.csv", "u4", None, "z", None),
    }
    first = {r["url"]: r["file_name"] for r in archive.archive(rows).collect()}
    assert first == {"u1": "a.csv", "u2": "a.csv", "u3": "b.csv", "u4": "c.csv"}


def test_labelled_json(spark, tmp_path):
    (tmp_path / "no_covid_label-1.json").write_text('[{"doc_id": "P1", "headlines": ["h"], "leading_paragraph": "l"}]')
    (tmp_path / "pub-2.json").write_text('[{"doc_id": "P2", "headlines": "h2", "has_corona_label": [false]}]')
    (tmp_path / "pub-3.json").write_text('[{"doc_id": "P3", "remaining_content": "r"}]')
    (tmp_path / "empty-4.json").write_text("[]")
    loaded = corpus.load_labelled(spark, str(tmp_path))
    got = {r["doc_id"]: (r["headlines"], r["is_covid"]) for r in loaded.rows.collect()}
    assert got == {"P1": ("h", False), "P2": ("h2", False), "P3": (None, True)}
    assert [os.path.basename(r["path"]) for r in loaded.rejects.collect()] == ["empty-4.json"]


PAGE = """<html><head><title>A &amp; B</title><meta name="author" content="Ana"><meta name="author" content="Rui">
<meta property="article:published_time" content="2020-04-07T05:45:00Z"><meta name="description" content="short"></head>
<body><nav><a href="/x">X</a></nav><script>var t="<p>no</p>";</script><article><h1>H</h1><p>One.<p>Two&quot;</article></body></html>"""


def test_page_fields_and_fallback(spark):
    bare = "<html><h1>Head</h1><p>First</p><p>Second<script>x</script></p></html>"
    df = spark.createDataFrame([(1, "u1", PAGE), (2, "u2", bare), (3, "u3", "")], "page_id int, url string, html string")
    got = {r["page_id"]: r for r in pages.extract_articles(df, "2020-04-08 00:00:00", fallback=True).collect()}
    assert got[1]["title"] == "A & B" and got[1]["maintext"] == 'H One. Two"'
    assert got[1]["authors"] == ["Ana", "Rui"] and got[1]["description"] == "short"
    assert got[1]["date_publish"] is not None and got[2]["date_publish"] is None
    assert (got[2]["title"], got[2]["maintext"], got[2]["description"]) == ("Head", "First Second", "First")
    dropped = pages.extract_articles(df, errors="drop")
    assert [r["page_id"] for r in dropped.collect()] == [1]
    authors = pages.explode_authors(pages.extract_articles(df)).collect()
    assert sorted((r["page_id"], r["author"] or "") for r in authors) == [(1, "Ana"), (1, "Rui"), (2, ""), (3, "")]
    kept, rejects = pages.split_rejects(pages.extract_articles(df))
    assert kept.count() == 1 and {r["reason"] for r in rejects.collect()} == {"no text"}


def test_snapshots_are_replaced_not_doubled(spark, tmp_path):
    df = spark.range(3).select(F.col("id").alias("doc_id"))
    for ts in ("2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-01 10:40:00"):
        tables.write_snapshot(df, str(tmp_path / "s"), ts)
    tables.write_snapshot(df.filter("doc_id < 0"), str(tmp_path / "s"), "2024-01-01 11:20:00")
    names = sorted(p.name for p in (tmp_path / "s").iterdir() if p.name.startswith("snapshot"))
    assert names == ["snapshot=2024-01-01-10-00", "snapshot=2024-01-01-10-40"]
    assert spark.read.parquet(str(tmp_path / "s")).count() == 6


@pytest.mark.parametrize("salts", [0, 4])
def test_stream_dedupe_across_files(spark, tmp_path, salts):
    src = str(tmp_path / "in")
    base = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url"),
        F.timestamp_seconds(F.col("id") + 1_704_067_200).alias("ts"),
    )
    base.repartition(3).write.parquet(src)
    base.repartition(2).write.mode("append").parquet(src)
    stream = flows.read_stream(spark, src, base.schema, per_trigger=1)
    once = flows.dedupe_stream(stream, ["url"], salts=salts)
    got = flows.run_to_table(once, "t", str(tmp_path / "out"), str(tmp_path / "log"))
    assert got.count() == got.select("url").distinct().count() == 201


def test_stream_windows_equal_batch_for_closed_windows(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.range(2000).select(F.timestamp_seconds(F.col("id") * 60 + 1_704_067_200).alias("ts"))
    for hour in range(0, 34, 8):  # files arrive in time order
        part = rows.filter((F.unix_seconds("ts") - 1_704_067_200).between(hour * 3600, hour * 3600 + 8 * 3600 - 1))
        part.coalesce(1).write.mode("append").parquet(src)
    stream = flows.window_counts(flows.read_stream(spark, src, rows.schema, per_trigger=1))
    got = {tuple(r) for r in flows.run_to_table(stream, "w", str(tmp_path / "out"), str(tmp_path / "log")).collect()}
    want = {tuple(r) for r in flows.window_counts(rows).collect()}
    assert got and got <= want


def test_flatten_names_and_front(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"]), (2, None, None)], "id int, p array<string>, q array<string>")
    got = {(r["id"], r["p"], r["q"]) for r in sc.flatten_lists(df).collect()}
    assert got == {(1, "a", "x"), (1, "b", None), (2, None, None)}
    assert sc.clean_names(df.toDF("@id", "@p", "q")).columns == ["id", "p", "q"]
    assert sc.front(df, "q", key="id").columns == ["q", "key", "p"]


def test_model_card_needs_one_row(spark):
    df = spark.range(3)
    card = spark.createDataFrame([(0.9,)], "model_f1 double")
    assert {r["model_f1"] for r in sc.with_model_card(df, card).collect()} == {0.9}
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        sc.with_model_card(df, card.union(card)).collect()


MARKED_PAGE = """<html><head><title>Situa&ccedil;&atilde;o &#231;&#xE3;o &amp;lt; &euro; &#128512; &nosuch;</title>
<meta content="Uma &quot;descri&ccedil;&atilde;o&quot;" name="description"/><meta name='author' content='Zé D&apos;Ávila'>
<meta property="article:published_time" content="2020-04-01T10:00:00Z"><meta content='B. C.' name="author"></head>
<body><article><p>Texto &#0; e &#55296;</p></article></body></html>"""


def test_references_and_attributes_in_any_order(spark):
    df = spark.createDataFrame([(1, "u", MARKED_PAGE)], "page_id long, url string, html string")
    row = pages.extract_articles(df).first()
    assert row["title"] == "Situação ção &lt; &euro; 😀 &nosuch;"
    assert row["description"] == 'Uma "descrição"' and row["authors"] == ["Zé D'Ávila", "B. C."]
    assert row["date_publish"] is not None and row["maintext"] == "Texto &#0; e &#55296;"


def test_bracketed_headline_is_kept(spark, tmp_path):
    (tmp_path / "covid-2.json").write_text('[{"doc_id": "P2", "headlines": "[VIDEO] h", "leading_paragraph": "[\\"a\\", \\"b\\"]"}]')
    row = corpus.load_labelled(spark, f"{tmp_path}/*.json").rows.first()
    assert (row["headlines"], row["leading_paragraph"]) == ("[VIDEO] h", "a b")


def test_backlog_out_of_order_loses_nothing(spark, tmp_path):
    """Files that wait are one batch, whatever their order."""
    for day in (9, 1, 5, 3):
        rows = spark.range(5).select(F.col("id"), F.lit(datetime(2024, 1, day)).alias("ts"))
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    once = flows.dedupe_stream(flows.read_stream(spark, str(tmp_path / "in"), schema), ["id", "ts"])
    assert flows.run_to_table(once, "backlog").count() == 20


def test_whole_numbers_of_the_history(spark, tmp_path):
    (tmp_path / "m.csv").write_text("model,mtry,n_tree,model_f1\na,8,500,0.5\n")
    assert dict(archive.read_metrics(spark, f"{tmp_path}/*.csv").dtypes)["n_tree"] == "bigint"


def test_archive_with_a_manifest(spark, tmp_path):
    """Drifting headers come back by name from one scan each; a repeated run replaces its files; awkward texts survive."""
    root = str(tmp_path / "archive")
    texts = ["one", 'a "quote", a comma', "two\nlines", "", None, "NA of", "x,y\n\"z\""]
    rows = [(str(i), t, f"u{i}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "id string, text string, url string").repartition(4)
    tables.append_snapshot(docs, root, "2024-01-31 12:00:00")
    tables.append_snapshot(docs, root, "2024-01-31 12:00:00")
    tables.append_snapshot(docs.select("url", "id"), root, "2024-01-31 12:40:00")
    tables.append_snapshot(docs.select("text", "url", "id"), root, "2024-02-01 00:00:00")
    got = archive.read_archive(spark, root)
    found = sorted(((r.snapshot, r.id, r.text, r.url) for r in got.collect()), key=str)
    rows = [(i, t or None, u) for i, t, u in rows]  # the dialect has no empty text
    want = [("2024-01-31-12-00", *r) for r in rows] + [("2024-01-31-12-40", r[0], None, r[2]) for r in rows] + [("2024-02-01-00-00", *r) for r in rows]
    assert found == sorted(want, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3 and "FileScan text" not in plan
    with pytest.raises(PySparkException):
        archive.read_archive(spark, str(tmp_path / "none"))


def test_an_archive_is_stored_compressed(spark, tmp_path):
    """What the runs write stays below their text; every row comes back."""
    root = tmp_path / "archive"
    docs = spark.range(400).select(F.col("id").cast("string").alias("id"), F.repeat(F.concat(F.lit('a "word"\n'), "id"), 60).alias("text"))
    tables.append_snapshot(docs.coalesce(2), str(root), "2024-01-31 12:00:00")
    size = docs.agg(F.sum(F.length("text"))).first()[0]
    assert sum(f.stat().st_size for f in root.rglob("part-*") if "csv" in f.name) < size / 2
    assert archive.read_archive(spark, str(root)).select("id", "text").exceptAll(docs).count() == 0
    assert archive.read_archive(spark, str(root)).count() == 400
