"""Registered queries, their SQL twins, and what both share."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.text import JOIN_BOTH, JOIN_DIGITS, JOIN_LETTERS
from presslens.operators.entities import ENTITY_TYPES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str | Callable[[], str]] = {}


def query(name: str, sql: str | Callable[[], str] | None = None):
    """Register a query; a twin given as a function is built only when the twins are asked for."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def twins() -> dict[str, str]:
    """Every SQL twin; one that cannot be built is left out and takes no other with it."""
    built = {}
    for name, sql in SQL.items():
        try:
            built[name] = sql() if callable(sql) else sql
        except (OSError, LookupError) as problem:
            warnings.warn(f"no SQL twin for {name}: {problem}", stacklevel=2)
    return built


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- shared inputs -------------------------------------------------------------------------------

STOP = "the of and de la el der die und le les des en in to a is que y un una ein eine".split()
SEED = 1234

# A gazetteer of frequent words of the test texts: surface, types, confidence.
GAZETTEER = [
    ("the", "DBpedia:Work,Schema:CreativeWork", 0.91),
    ("the of", "DBpedia:Organisation", 0.77),
    ("the the", "DBpedia:Work,DBpedia:Activity", 0.66),
    ("of the", "DBpedia:Person,Schema:Person", 0.82),
    ("and the", "DBpedia:Disease", 0.58),
    ("de la", "DBpedia:Drug,DBpedia:ChemicalSubstance", 0.95),
    ("de", "DBpedia:Place", 0.93),
    ("la", "DBpedia:Protein", 0.71),
    ("der der", "DBpedia:AnatomicalStructure", 0.62),
    ("der", "DBpedia:Person", 0.49),
    ("hehely hehely hehely", "DBpedia:Activity", 0.88),
    ("rewh rewh", "DBpedia:Disease,DBpedia:Work", 0.73),
    ("orre", "DBpedia:Drug", 0.50),
    ("inoran", "DBpedia:Organisation,Schema:Organization", 0.97),
    ("thatin", "Schema:Thing", 0.99),
    ("que", "DBpedia:ChemicalSubstance", 0.64),
    ("und", "DBpedia:Organisation", 0.35),
    ("with", "DBpedia:Person", 0.54),
    ("in the", "DBpedia:Activity,DBpedia:Person", 0.69),
    ("this", "DBpedia:AnatomicalStructure", 0.51),
    ("Anderwhedor-thorea", "DBpedia:Drug", 0.9),
    ("Of the inanin. Thonst aonthrein thedtiou", "DBpedia:Work", 0.9),
    ("with", "DBpedia:Organisation,DBpedia:Person", 0.8),
    ("The", "DBpedia:Place", 0.99),
]

LANGUAGES = {"en": "english", "fr": "french", "de": "german", "es": "spanish"}


def gazetteer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GAZETTEER, "surface string, types string, confidence double")


def raw_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a labelled corpus: outlet as headline, first line as lead, the rest as body."""
    docs = table(spark, sf, "documents")
    split = F.instr("text", "\n")
    rest = F.when(split > 0, F.substring(F.col("text"), split + 1, F.length("text")))
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.concat_ws(" ", "source", "lang").alias("headlines"),
        F.substring_index("text", "\n", 1).alias("leading_paragraph"),
        rest.alias("remaining_content"),
        F.col("quality").alias("is_covid"),
    )


# ---- shared SQL ----------------------------------------------------------------------------------


def sql_list(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def sql_tokens(col: str = "text") -> str:
    return rf"list_filter(regexp_split_to_array(lower({col}), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda x: x <> '')"


def sql_unicode_words(col: str = "text") -> str:
    """Words by the Unicode word boundary rules, matched instead of separated: letters and digits with what joins them."""
    letters, digits = (re.escape(a + JOIN_BOTH).replace("'", "''") for a in (JOIN_LETTERS, JOIN_DIGITS))
    letter, more = r"[^\P{L}\p{Han}\p{Hiragana}]", r"[\p{L}\p{M}\p{Cf}]"
    more = r"(?:[^\P{L}\p{Han}\p{Hiragana}]|[\p{M}\p{Cf}])"
    digit = r"\p{Nd}[\p{Nd}\p{M}\p{Cf}]*"
    spelt = rf"{letter}{more}*(?:[{letters}]{letter}{more}*)*"
    number = rf"{digit}(?:[{digits}]{digit})*"
    alone = r"[\p{Han}\p{Hiragana}][\p{M}\p{Cf}]*"
    return rf"regexp_extract_all(lower({col}), '(?:{spelt}|{number}|[\p{{Nl}}\p{{Pc}}][\p{{M}}\p{{Cf}}]*)+|{alone}')"


def sql_clean_delete(col: str = "text") -> str:
    edge = "' ' || chr(9) || chr(10) || chr(13)"
    return rf"trim(regexp_replace({col}, '\p{{Cc}}+|[^\p{{L}}\p{{M}}\p{{N}}\s\-]', '', 'g'), {edge})"


def sql_grams(source: str, low: int, high: int, sep: str, where: str = "") -> str:
    """`source` gives (doc_id, w); result (doc_id, n, term)."""
    ns = ", ".join(str(n) for n in range(low, high + 1))
    return f"""SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2),
        lambda i: array_to_string(list_slice(w, i, i + n - 1), '{sep}'))) AS term
        FROM {source}, (SELECT unnest([{ns}]) AS n) {where}"""


STOPPED = f"list_filter({sql_tokens()}, lambda x: x NOT IN {sql_list(STOP)})"


def known_surfaces() -> dict[str, str]:
    """What the gazetteer says once surfaces are words and rows of one surface are one."""
    known: dict[str, set] = {}
    for surface, types, confidence in GAZETTEER:
        if confidence >= 0.5 and any(t in types.replace("DBpedia:", "").split(",") for t in ENTITY_TYPES):
            words = " ".join(re.findall(r"[^\W_]+", surface.lower()))
            known.setdefault(words, set()).add(tuple(types.split(",")))
    return {s: ",".join(dict.fromkeys(t for types in sorted(many) for t in types)) for s, many in known.items()}


GAZETTEER_SQL = ", ".join(f"('{s}', '{t}')" for s, t in known_surfaces().items())
RAW_CORPUS_SQL = """SELECT d.doc_id, concat_ws(' ', source, lang) AS headlines,
    split_part(text, chr(10), 1) AS leading_paragraph,
    CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS remaining_content,
    quality AS is_covid
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@cache
def stopword_lists() -> dict[str, list[str]]:
    """Stop words by language, from the data file beside this module."""
    lines = (Path(__file__).parent / "stopwords.txt").read_text(encoding="utf-8").splitlines()
    named = (line.split(": ", 1) for line in lines if not line.startswith("#"))
    return {language: words.split() for language, words in named}
