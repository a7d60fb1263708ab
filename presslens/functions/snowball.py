"""Snowball stems of English, German, Spanish and French words, by the published rules.

Each stemmer takes one lower-case word. A rule finds the longest of its endings and acts if the ending
lies in a region: R1 after the first non-vowel behind a vowel, R2 the same inside R1, and RV by rules
of each language. Columns of words are stemmed by `stemming.stem_tokens`.
"""

from __future__ import annotations

from collections.abc import Iterable

# Fixed values of the published algorithms: vowels, endings by rule, and exceptions.
EN_VOWELS, DE_VOWELS, ES_VOWELS, FR_VOWELS = "aeiouy", "aeiouyäöü", "aeiouáéíóúü", "aeiouyâàëéêèïîôûù"
EN_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
EN_KEPT = set("inning outing canning herring earring proceed exceed succeed".split())
EN_STEP2 = dict(x.split(":") for x in """
tional:tion enci:ence anci:ance abli:able entli:ent izer:ize ization:ize ational:ate ation:ate ator:ate alism:al aliti:al alli:al
fulness:ful ousli:ous ousness:ous iveness:ive iviti:ive biliti:ble bli:ble ogi:og fulli:ful lessli:less li:
""".split())  # fmt: skip
EN_STEP3 = dict(x.split(":") for x in "tional:tion ational:ate alize:al icate:ic iciti:ic ical:ic ful: ness: ative:".split())
EN_STEP4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
ES_PRONOUNS = "me se sela selo selas selos la le lo las les los nos".split()
ES_DELETE = """
anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos
""".split()
ES_IC = "adora ador ación adoras adores aciones ante antes ancia ancias".split()
ES_REPLACE = {"logía": "log", "logías": "log", "ución": "u", "uciones": "u", "encia": "ente", "encias": "ente"}
ES_Y = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
ES_EN = "en es éis emos".split()
ES_VERB = """
arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré irían
irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran
asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais ierais aseis
ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos
""".split()
FR_DELETE = "ance iqUe isme able iste eux ances iqUes ismes ables istes".split()
FR_IC = "atrice ateur ation atrices ateurs ations".split()
FR_REPLACE = {"logie": "log", "logies": "log", "usion": "u", "ution": "u", "usions": "u", "utions": "u", "ence": "ent", "ences": "ent"}
FR_OTHER = """
ement ements ité ités if ive ifs ives eaux aux euse euses issement issements amment emment ment ments
""".split()
FR_I_VERB = """
îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent issais issait issant issante
issantes issants isse issent isses issez issiez issions issons it
""".split()
FR_E_VERB = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez".split()
FR_A_VERB = "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions".split()


def ending(word: str, endings: Iterable[str], start: int = 0) -> str:
    """The longest of the endings that `word` has from `start` on."""
    return max((e for e in endings if word.endswith(e) and len(word) - len(e) >= start), key=len, default="")


def region(word: str, vowels: str, start: int = 0) -> int:
    for i in range(start + 1, len(word)):
        if word[i] not in vowels and word[i - 1] in vowels:
            return i + 1
    return len(word)


def without(word: str, endings: Iterable[str], start: int) -> str:
    """`word` without the longest of the endings it has, if that lies from `start` on."""
    found = ending(word, endings)
    return word[: -len(found)] if found and len(word) - len(found) >= start else word


def marked(word: str, letters: str, vowels: str) -> str:
    """`word` with each of the letters that stands between vowels as a capital."""
    out = list(word)
    for i in range(1, len(word) - 1):
        if word[i] in letters and out[i - 1] in vowels and word[i + 1] in vowels:
            out[i] = word[i].upper()
    return "".join(out)


# ---- English -------------------------------------------------------------------------------------


def _short_end(word: str) -> bool:
    if len(word) == 2:
        return word[0] in EN_VOWELS and word[1] not in EN_VOWELS
    return len(word) > 2 and word[-3] not in EN_VOWELS and word[-2] in EN_VOWELS and word[-1] not in EN_VOWELS + "wxY"


def stem_english(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in EN_WORDS:
        return EN_WORDS[word]
    word = word.removeprefix("'")
    word = "".join("Y" if c == "y" and (i == 0 or word[i - 1] in EN_VOWELS) else c for i, c in enumerate(word))
    head = next((p for p in ("gener", "commun", "arsen") if word.startswith(p)), "")
    r1 = len(head) if head else region(word, EN_VOWELS)
    r2 = region(word, EN_VOWELS, r1)
    word = without(word, ("'", "'s", "'s'"), 0)

    found = ending(word, ("sses", "ied", "ies", "us", "ss", "s"))
    if found == "sses":
        word = word[:-2]
    elif found in ("ied", "ies"):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif found == "s" and any(c in EN_VOWELS for c in word[:-2]):
        word = word[:-1]
    if word in EN_KEPT:
        return word

    found = ending(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    before = word[: len(word) - len(found)]
    if found in ("eed", "eedly"):
        word = before + "ee" if len(before) >= r1 else word
    elif found and any(c in EN_VOWELS for c in before):
        word = before
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif word.endswith(("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")):
            word = word[:-1]
        elif r1 >= len(word) and _short_end(word):
            word += "e"
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in EN_VOWELS:
        word = word[:-1] + "i"

    found = ending(word, EN_STEP2)
    before = word[: len(word) - len(found)]
    if found and len(before) >= r1 and (found != "ogi" or before.endswith("l")) and (found != "li" or before[-1:] in tuple("cdeghkmnrt")):
        word = before + EN_STEP2[found]
    found = ending(word, EN_STEP3)
    before = word[: len(word) - len(found)]
    if found and len(before) >= (r2 if found == "ative" else r1):
        word = before + EN_STEP3[found]
    found = ending(word, EN_STEP4)
    before = word[: len(word) - len(found)]
    if found and len(before) >= r2 and (found != "ion" or before.endswith(("s", "t"))):
        word = before
    at = len(word) - 1
    if word.endswith("e") and (at >= r2 or at >= r1 and not _short_end(word[:-1])) or word.endswith("ll") and at >= r2:
        word = word[:-1]
    return word.replace("Y", "y")


# ---- German --------------------------------------------------------------------------------------


def stem_german(word: str) -> str:
    word = marked(word.replace("ß", "ss"), "uy", DE_VOWELS)
    r1 = region(word, DE_VOWELS)
    r2, r1 = region(word, DE_VOWELS, r1), max(r1, 3)

    found = ending(word, ("em", "ern", "er", "e", "en", "es", "s"))
    before = word[: len(word) - len(found)]
    if found and len(before) >= r1 and (found != "s" or before[-1:] in tuple("bdfghklmnrt")):
        word = before
        if found in ("e", "en", "es") and word.endswith("niss"):
            word = word[:-1]
    found = ending(word, ("en", "er", "est", "st"))
    before = word[: len(word) - len(found)]
    if found and len(before) >= r1 and (found != "st" or before[-1:] in tuple("bdfghklmnt") and len(before) > 3):
        word = before
    found = ending(word, ("end", "ung", "ig", "ik", "isch", "lich", "heit", "keit"))
    before = word[: len(word) - len(found)]
    if found and len(before) >= r2 and (found not in ("ig", "ik", "isch") or not before.endswith("e")):
        word = before
        if found in ("end", "ung") and word.endswith("ig") and not word.endswith("eig"):
            word = without(word, ("ig",), r2)
        elif found in ("lich", "heit"):
            word = without(word, ("er", "en"), r1)
        elif found == "keit":
            word = without(word, ("lich", "ig"), r2)
    return word.translate(str.maketrans("UYäöü", "uyaou"))


# ---- Spanish -------------------------------------------------------------------------------------


def _romance_rv(word: str, vowels: str) -> int:
    if len(word) < 3:
        return len(word)
    if word[1] not in vowels:
        return next((i + 1 for i in range(2, len(word)) if word[i] in vowels), len(word))
    if word[0] in vowels:
        return next((i + 1 for i in range(2, len(word)) if word[i] not in vowels), len(word))
    return 3


PLAIN = str.maketrans("áéíóú", "aeiou")


def _spanish_pronoun(word: str, rv: int) -> str:
    found = ending(word, ES_PRONOUNS)
    before = word[: len(word) - len(found)]
    verb = ending(before, "iéndo ándo ár ér ír ando iendo ar er ir yendo".split())
    if not found or not verb or len(before) - len(verb) < rv or verb == "yendo" and not before.endswith("uyendo"):
        return word
    return before[: len(before) - len(verb)] + verb.translate(PLAIN)


def _spanish_standard(word: str, r1: int, r2: int) -> str:
    endings = [*ES_DELETE, *ES_IC, *ES_REPLACE, "amente", "mente", "idad", "idades", "iva", "ivo", "ivas", "ivos"]
    found = ending(word, endings)
    before = word[: len(word) - len(found)]
    if not found or len(before) < (r1 if found == "amente" else r2):
        return word
    if found in ES_REPLACE:
        return before + ES_REPLACE[found]
    if found in ES_IC:
        return without(before, ("ic",), r2)
    if found == "amente":
        left = without(before, ("iv", "os", "ic", "ad"), r2)
        return without(left, ("at",), r2) if left != before and before.endswith("iv") else left
    if found == "mente":
        return without(before, ("ante", "able", "ible"), r2)
    if found in ("idad", "idades"):
        return without(before, ("abil", "ic", "iv"), r2)
    return without(before, ("at",), r2) if found.startswith("iv") else before


def stem_spanish(word: str) -> str:
    rv, r1 = _romance_rv(word, ES_VOWELS), region(word, ES_VOWELS)
    r2 = region(word, ES_VOWELS, r1)
    word = _spanish_pronoun(word, rv)
    stem = _spanish_standard(word, r1, r2)
    if stem == word:
        found = ending(word, ES_Y, rv)
        if found and word[: -len(found)].endswith("u"):
            stem = word[: -len(found)]
        else:
            found = ending(word, [*ES_EN, *ES_VERB], rv)
            stem = word[: len(word) - len(found)]
            if found in ES_EN and stem.endswith("gu"):
                stem = stem[:-1]
    found = ending(stem, ("os", "a", "o", "á", "í", "ó", "e", "é"), rv)
    if found:
        stem = stem[: -len(found)]
        if found in ("e", "é") and stem.endswith("gu") and len(stem) > rv:
            stem = stem[:-1]
    return stem.translate(PLAIN)


# ---- French --------------------------------------------------------------------------------------


def _french_marks(word: str) -> str:
    out = list(word)
    for i, c in enumerate(word):
        before = out[i - 1] in FR_VOWELS if i else False
        after = i + 1 < len(word) and word[i + 1] in FR_VOWELS
        if c in "ui" and before and after or c == "y" and (before or after) or c == "u" and i and word[i - 1] == "q":
            out[i] = c.upper()
    return "".join(out)


def _french_rv(word: str) -> int:
    if word.startswith(("par", "col", "tap")) or len(word) > 2 and word[0] in FR_VOWELS and word[1] in FR_VOWELS:
        return 3
    return next((i + 1 for i in range(1, len(word)) if word[i] in FR_VOWELS), len(word))


def _french_standard(word: str, rv: int, r1: int, r2: int) -> tuple[str, bool]:
    """(word, whether a verb ending may still follow)."""
    found = ending(word, [*FR_DELETE, *FR_IC, *FR_REPLACE, *FR_OTHER])
    at = len(word) - len(found)
    stem = word[:at]

    def cut(stem, end, other=None):
        if not stem.endswith(end):
            return stem
        short = stem[: -len(end)]
        return short if len(short) >= r2 else stem if other is None else short + other

    if found in FR_DELETE and at >= r2:
        return stem, False
    if found in FR_IC and at >= r2:
        return cut(stem, "ic", "iqU"), False
    if found in FR_REPLACE and at >= r2:
        return stem + FR_REPLACE[found], False
    if found in ("ement", "ements") and at >= rv:
        if stem.endswith("iv") and at - 2 >= r2:
            return cut(stem[:-2], "at"), False
        if stem.endswith("eus"):
            return (stem[:-3] if at - 3 >= r2 else stem[:-3] + "eux" if at - 3 >= r1 else stem), False
        if stem.endswith(("abl", "iqU")):
            return (stem[:-3] if at - 3 >= r2 else stem), False
        if stem.endswith(("ièr", "Ièr")) and at - 3 >= rv:
            return stem[:-3] + "i", False
        return stem, False
    if found in ("ité", "ités") and at >= r2:
        return (cut(stem, "abil", "abl") if stem.endswith("abil") else cut(stem, "ic", "iqU") if stem.endswith("ic") else cut(stem, "iv")), False
    if found in ("if", "ive", "ifs", "ives") and at >= r2:
        left = cut(stem, "at")
        return (cut(left, "ic", "iqU") if left != stem else left), False
    if found == "eaux":
        return stem + "eau", False
    if found == "aux" and at >= r1:
        return stem + "al", False
    if found in ("euse", "euses") and at >= r1:
        return (stem if at >= r2 else stem + "eux"), False
    if found in ("issement", "issements") and at >= r1 and stem[-1:] not in tuple(FR_VOWELS):
        return stem, False
    if found in ("amment", "emment") and at >= rv:
        return stem + found[0] + "nt", True
    if found in ("ment", "ments") and at - 1 >= rv and stem[-1:] in tuple(FR_VOWELS):
        return stem, True
    return word, True


def _french_verb(word: str, rv: int, r2: int, may_i: bool) -> str:
    found = ending(word, FR_I_VERB, rv) if may_i else ""
    at = len(word) - len(found)
    if found and at - 1 >= rv and word[at - 1] not in FR_VOWELS:
        return word[:at]
    found = ending(word, ["ions", *FR_E_VERB, *FR_A_VERB], rv)
    at = len(word) - len(found)
    if not found or found == "ions" and at < r2:
        return word
    stem = word[:at]
    return stem[:-1] if found in FR_A_VERB and stem.endswith("e") and at - 1 >= rv else stem


def stem_french(word: str) -> str:
    word = _french_marks(word)
    rv, r1 = _french_rv(word), region(word, FR_VOWELS)
    r2 = region(word, FR_VOWELS, r1)
    stem, verb = _french_standard(word, rv, r1, r2)
    if verb:
        stem = _french_verb(stem, rv, r2, True)
    if stem != word:
        stem = stem[:-1] + "i" if stem.endswith("Y") else stem[:-1] + "c" if stem.endswith("ç") else stem
    else:
        if stem.endswith("s") and len(stem) > 1 and stem[-2] not in "aiouès":
            stem = stem[:-1]
        found = ending(stem, ("ion", "ier", "ière", "Ier", "Ière", "e", "ë"), rv)
        before = stem[: len(stem) - len(found)]
        if found == "ion":
            stem = before if len(before) >= r2 and before.endswith(("s", "t")) and len(before) > rv else stem
        elif found in ("ier", "ière", "Ier", "Ière"):
            stem = before + "i"
        elif found == "e" or found == "ë" and before.endswith("gu"):
            stem = before
    if stem.endswith(("enn", "onn", "ett", "ell", "eill")):
        stem = stem[:-1]
    last = max((i for i, c in enumerate(stem) if c in FR_VOWELS), default=-1)
    if 0 <= last < len(stem) - 1 and stem[last] in "éè":
        stem = stem[:last] + "e" + stem[last + 1 :]
    return stem.translate(str.maketrans("IUY", "iuy"))
