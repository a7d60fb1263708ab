"""Text cleaning, tokens and n-grams as column expressions."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes of words, and the two cleaning patterns.
WORD_BREAK = r"[^\p{L}\p{M}\p{N}]+"
SPACE_PATTERN = r"[^\p{L}\p{M}\p{N}\s\-]|(f|ht)tps?://.*[.|/].*"
DELETE_PATTERN = r"\p{Cc}+|[^\p{L}\p{M}\p{N}\s\-]"
EDGE_SPACE = " \t\r\n"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(EDGE_SPACE))


def clean_space(text: Column) -> Column:
    """Links and characters other than letters, digits, space and hyphen become a space."""
    return strip(F.regexp_replace(text, SPACE_PATTERN, " "))


def clean_delete(text: Column) -> Column:
    """Control and special characters are deleted; words around a newline merge."""
    return strip(F.regexp_replace(text, DELETE_PATTERN, ""))


def tokenize(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


# Characters that join two letters, two digits, or either, by the Unicode word boundary rules.
JOIN_LETTERS, JOIN_DIGITS, JOIN_BOTH = ":\u00b7\u0387\u05f4\u2027\ufe13\ufe55\uff1a", ",;\u037e\u0589\u060c\u066c\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b", ".'\u2018\u2019\u2024\ufe52\uff07\uff0e"
# Scripts whose characters are words by themselves.
ALONE = r"\p{IsHan}\p{IsHiragana}"
_PART = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\p{Cf}"


def word_separators() -> str:
    """What stands between words by the Unicode word boundary rules, as a pattern of single separators.

    A joining character between two letters (or two digits, marks aside) is no separator; a run of
    other characters that no word has is one; characters of scripts without spaces are cut on both sides.
    """
    return rf"{spaced_separators()}|(?<=[{ALONE}])(?![\p{{M}}\p{{Cf}}])|(?=[{ALONE}])"


def spaced_separators() -> str:
    """`word_separators` of texts without characters that are words by themselves."""
    every = JOIN_LETTERS + JOIN_DIGITS + JOIN_BOTH
    letters, digits = JOIN_LETTERS + JOIN_BOTH, JOIN_DIGITS + JOIN_BOTH
    letter, digit = rf"[\p{{L}}&&[^{ALONE}]]", r"\p{Nd}"
    joined = rf"(?<={letter}[\p{{M}}\p{{Cf}}]{{0,4}})[{letters}](?={letter})|(?<={digit}[\p{{M}}\p{{Cf}}]{{0,4}})[{digits}](?={digit})"
    # A joining character that is not joined: no match of `joined` begins at it.
    return rf"[^{_PART}{every}]+|(?!{joined})[{every}]"


#: `word_separators` of lower-cased ASCII texts.
ASCII_SEPARATORS = r"[^a-z0-9_:,;.']+|(?!(?<=[a-z])[:.'](?=[a-z])|(?<=[0-9])[,;.'](?=[0-9]))[:,;.']"


def unicode_words(text: Column) -> Column:
    """Lower-cased words by the Unicode word boundary rules: `don't`, `3.14` and `u.s` are one word each.

    Runs of marks or joiners alone are no words.
    """
    lower, every = F.lower(text), word_separators()
    # Most texts have none of the characters that make the pattern slow, and are cut by what it says without them.
    plain = F.when(lower.rlike(r"\A\p{ASCII}*\z"), F.split(lower, ASCII_SEPARATORS))
    words = plain.when(~lower.rlike(f"[{ALONE}]"), F.split(lower, spaced_separators())).otherwise(F.split(lower, every))
    return F.filter(words, lambda w: w.rlike(r"[\p{L}\p{Nd}\p{Nl}\p{Pc}]"))


def stopwords(lang: str = "portuguese") -> list[str]:
    """Spark's stop-word list of a language (a few hundred words); needs a running session."""
    return sorted(set(StopWordsRemover.loadDefaultStopWords(lang)))


def drop_stopwords(tokens: Column, words: list[str]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(words)) if words else tokens


def blank_stopwords(tokens: Column, words: list[str]) -> Column:
    """Stop words become empty strings, so that word positions are kept."""
    return F.transform(tokens, lambda w: F.when(w.isin(words), F.lit("")).otherwise(w))


def bind(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row.

    A lambda that names an outer expression evaluates it again for every element as soon as the
    optimizer merges projections or pushes a filter down; a bound variable cannot be inlined.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def gram_array(tokens: Column, n: int, sep: str = "_") -> Column:
    """All grams of n words, in order, as one array.

    Neighbours are read by index: slicing inside the lambda would copy the array once per word.
    """
    if n == 1:
        return tokens
    none = F.array().cast("array<string>")

    def grams(words: Column) -> Column:
        joined = F.transform(
            words, lambda w, i: F.concat_ws(sep, w, *[F.get(words, i + k) for k in range(1, n)])
        )
        last = F.size(words) - (n - 1)
        return F.when(last > 0, F.slice(joined, 1, F.greatest(last, F.lit(1)))).otherwise(none)

    return bind(tokens, grams)


def compute_once(df: DataFrame, name: str, value: Column, keep: list[str]) -> DataFrame:
    """Keep columns and `name`, with the value computed once per row.

    A later filter on the column stays above the generator, so it is neither pushed to the scan nor
    evaluated a second time.
    """
    return df.select(*keep, F.explode_outer(F.array(value)).alias(name))


def token_rows(df: DataFrame, tokens: str = "words", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per word, as `term` (see `word_windows` on `explode_outer`)."""
    rows = df.select(*keep, F.explode_outer(tokens).alias("term"))
    return rows.filter("term IS NOT NULL")


def word_windows(df: DataFrame, tokens: str, width: int, keep: list[str], mask: str | None = None) -> DataFrame:
    """One row per word position with the next `width` words in columns w0, w1, ...

    `mask` names an array with a number per word, kept as column `mask`; words with 0 there are left out.

    `explode_outer` keeps Catalyst from adding a size filter that would be pushed below the
    token expression and evaluate it a second time.
    """
    col = F.col(tokens)
    shifted = [col.alias("w0")]
    for k in range(1, width):
        shifted.append(F.slice(col, k + 1, F.greatest(F.size(col), F.lit(1))).alias(f"w{k}"))
    if mask:
        shifted.append(F.col(mask).alias("mask"))
    rows = df.select(*keep, F.posexplode_outer(F.arrays_zip(*shifted)).alias("pos", "w"))
    words = [F.col(f"w.w{k}").alias(f"w{k}") for k in range(width)]
    if mask:
        return rows.select(*keep, "pos", *words, F.col("w.mask").alias("mask")).filter("mask <> 0")
    return rows.select(*keep, "pos", *words).filter("w0 IS NOT NULL")


def ngram_rows(
    df: DataFrame,
    tokens: str,
    n_min: int = 1,
    n_max: int = 5,
    sep: str = "_",
    keep: tuple[str, ...] = ("doc_id",),
    mask: str | None = None,
) -> DataFrame:
    """One row per gram of n_min..n_max words: keep columns and `term`.

    Blank words (see `blank_stopwords`) count for the window but not for the term, and a gram of
    blanks only vanishes. A document shorter than n words has no gram of n words. `mask` names an array
    with a number per word: only grams of n words whose bit n - 1 is set are formed.
    """
    rows = word_windows(df, tokens, n_max, list(keep), mask)
    grams = []
    for n in range(n_min, n_max + 1):
        words = [F.nullif(F.col(f"w{k}"), F.lit("")) for k in range(n)]
        there = F.col("mask").bitwiseAND(1 << (n - 1)) != 0 if mask else F.col(f"w{n - 1}").isNotNull()
        grams.append(F.when(there, F.concat_ws(sep, *words)))
    rows = rows.select(*keep, F.explode_outer(F.array(*grams)).alias("term"))
    return rows.filter("term <> ''")
