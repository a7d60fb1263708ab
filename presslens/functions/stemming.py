"""Portuguese Snowball stems, and stems of any known language, applied to token arrays in Arrow batches.

The rules are those of the published Snowball algorithm. Each batch is dictionary-encoded first, so
a word is stemmed once per batch however often it occurs, and the step needs no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.snowball import stem_english, stem_french, stem_german, stem_spanish

# Fixed values of the published algorithm: vowels and the suffixes of each step.
VOWELS = set("aeiouáéíóúâêô")
SUFFIX_DELETE = """
eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas
amento amentos imento imentos adora ador aça~o adoras adores aço~es ante antes ância
""".split()
SUFFIX_LOG = "logia logias".split()
SUFFIX_U = "ução uções".split()
SUFFIX_ENTE = "ência ências".split()
SUFFIX_VERB = """
ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei
am iam ariam eriam iriam aram eram iram avam em arem erem irem assem essem issem ado ido ando endo
indo ara~o era~o ira~o ar er ir as adas idas ias arias erias irias arás aras erás eras irás avas es
ardes erdes irdes ares eres ires asses esses isses astes estes istes is ais eis íeis aríeis eríeis
iríeis áreis areis éreis ereis íreis ireis ásseis ésseis ísseis áveis ados idos ámos amos íamos
aríamos eríamos iríamos áramos éramos íramos ávamos emos aremos eremos iremos ássemos êssemos
íssemos imos armos ermos irmos eu iu ou ira iras
""".split()
SUFFIX_RESIDUAL = "os a i o á í ó".split()
NASAL = (("ã", "a~"), ("õ", "o~"))


def _longest(word: str, suffixes: list[str]) -> str:
    return max((s for s in suffixes if word.endswith(s)), key=len, default="")


def _after_vowel_consonant(word: str, start: int) -> int:
    """Start of the region after the first non-vowel that follows a vowel."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _rv_start(word: str) -> int:
    if len(word) < 3:
        return len(word)
    if word[1] not in VOWELS:
        found = next((i for i in range(2, len(word)) if word[i] in VOWELS), None)
    elif word[0] in VOWELS:
        found = next((i for i in range(2, len(word)) if word[i] not in VOWELS), None)
    else:
        return 3
    return len(word) if found is None else found + 1


STANDARD_RULES = (
    [(s, "") for s in SUFFIX_DELETE]
    + [(s, "log") for s in SUFFIX_LOG]
    + [(s.replace("ã", "a~").replace("õ", "o~"), "u") for s in SUFFIX_U]
    + [(s, "ente") for s in SUFFIX_ENTE]
)
STANDARD = dict(STANDARD_RULES)
ADVERB = {"amente": ("iv", "os", "ic", "ad"), "mente": ("ante", "avel", "ível")}
IDADE = ("idade", "idades")
IVA = ("iva", "ivo", "ivas", "ivos")
IRA = ("ira", "iras")
STEP1 = list(STANDARD) + list(ADVERB) + list(IDADE) + list(IVA) + list(IRA)


def _cut(word: str, region: int, suffixes) -> str:
    """Drop the longest of the suffixes when it lies in the region."""
    found = _longest(word, list(suffixes))
    return word[: -len(found)] if found and len(word) - len(found) >= region else word


def _standard_suffix(word: str, rv: int, r1: int, r2: int) -> str:
    found = _longest(word, STEP1)
    if not found:
        return word
    at = len(word) - len(found)
    if found in IRA:
        return word[:at] + "ir" if at >= rv and word[:at].endswith("e") else word
    if at < (r1 if found == "amente" else r2):
        return word
    if found in STANDARD:
        return word[:at] + STANDARD[found]
    word = word[:at]
    if found == "amente":
        before = _longest(word, list(ADVERB["amente"]))
        if before and len(word) - len(before) >= r2:
            word = word[: -len(before)]
            if before == "iv":
                word = _cut(word, r2, ("at",))
        return word
    if found == "mente":
        return _cut(word, r2, ADVERB["mente"])
    if found in IDADE:
        return _cut(word, r2, ("abil", "ic", "iv"))
    return _cut(word, r2, ("at",))


def stem_portuguese(word: str) -> str:
    for letter, marked in NASAL:
        word = word.replace(letter, marked)
    rv = _rv_start(word)
    r1 = _after_vowel_consonant(word, 0)
    r2 = _after_vowel_consonant(word, r1)

    stem = _standard_suffix(word, rv, r1, r2)
    if stem == word:
        verb = _longest(word[rv:], SUFFIX_VERB)
        stem = word[: len(word) - len(verb)] if verb else word
    if stem != word:
        if stem.endswith("ci") and len(stem) - 1 >= rv:
            stem = stem[:-1]
    else:
        stem = _cut(stem, rv, SUFFIX_RESIDUAL)

    last = _longest(stem, ["e", "é", "ê"])
    if last and len(stem) - 1 >= rv:
        stem = stem[:-1]
        if stem.endswith(("gu", "ci")) and len(stem) - 1 >= rv:
            stem = stem[:-1]
    elif stem.endswith("ç"):
        stem = stem[:-1] + "c"
    for letter, marked in NASAL:
        stem = stem.replace(marked, letter)
    return stem


#: By code and by name; words of other languages stay as they are.
STEMMERS = {
    "pt": stem_portuguese, "en": stem_english, "de": stem_german, "es": stem_spanish, "fr": stem_french,
    "portuguese": stem_portuguese, "english": stem_english, "german": stem_german, "spanish": stem_spanish, "french": stem_french,
}


def _stemmed(words: pa.Array, stem) -> pa.Array:
    """Each distinct word is stemmed once."""
    words = words.dictionary_encode()
    return pa.array([stem(w) if w else w for w in words.dictionary.to_pylist()], pa.string()).take(words.indices)


def _like(tokens: pa.Array, stems: pa.Array) -> pa.Array:
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return pa.ListArray.from_arrays(pa.array([0, *sizes.cumsum().tolist()], pa.int32()), stems, mask=tokens.is_null())


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Portuguese stems of an array<string> column."""
    return _like(tokens, _stemmed(tokens.flatten(), stem_portuguese))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_by_language(tokens: pa.Array, language: pa.Array) -> pa.Array:
    """Stems of an array<string> column by each row's own language, a code or a name."""
    words = tokens.flatten()
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    codes = language.dictionary_encode()
    number = np.repeat(codes.indices.fill_null(-1).to_numpy(zero_copy_only=False), sizes)
    parts, order = [words.filter(pa.array(number < 0))], [np.flatnonzero(number < 0)]
    for k, name in enumerate(codes.dictionary.to_pylist()):
        own = np.flatnonzero(number == k)
        stem = STEMMERS.get((name or "").lower())
        part = words.take(pa.array(own))
        parts.append(_stemmed(part, stem) if stem else part)
        order.append(own)
    back = np.argsort(np.concatenate(order), kind="stable")
    return _like(tokens, pa.concat_arrays([p.cast(pa.string()) for p in parts]).take(pa.array(back)))
