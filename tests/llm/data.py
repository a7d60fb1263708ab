"""Small tables with every awkward case, and plain-Python versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from presslens.llm import words as words_module

SPACE = "\x20\x09-\x0d"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, `row` string, `key` int, "
    "place int, size string, n_words int, window string"
)
LONG_WORDS = 30_000
#: Two words that any polynomial of an odd base gives one value modulo 2^64.
COMPLEMENTS = ["".join("ab"[(bin(i).count("1") + k) % 2] for i in range(2048)) for k in (0, 1)]


def words(n: int, seed: int) -> str:
    """n words in sentences and lines."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        word = "".join(draw.choice("abdeinorstué") for _ in range(draw.randint(1, 9)))
        out.append(word.capitalize() + draw.choice([" ", " ", " ", ", ", ". ", ".\n", " - "]))
    return "".join(out)


def near(text: str, seed: int) -> str:
    """One word changed."""
    parts = text.split(" ")
    parts[random.Random(seed).randrange(len(parts))] = "changed"
    return " ".join(parts)


def documents() -> list[tuple]:
    base, passage, long = words(120, 1), words(70, 2), words(LONG_WORDS, 3)
    texts = [
        base, base, near(base, 1), near(near(base, 1), 2), near(near(near(base, 1), 2), 3), None, "", " \t\n ", "one", "one", "a b c", "A b  C",
        long, words(50, 5) + passage, passage + words(60, 6), words(40, 7) + passage + words(40, 8), "x " * 300, "same line here\n" * 40,
        "### $$$ %%% &&&" * 20, "<|endoftext|> in a text <|endoftext|>", "two  spaces \n and\ttabs ", "Ünïcode ß 漢字     é" * 10, "5 6 7 8 9",
        words(300, 9), words(200, 10) + "\n" + words(200, 10), 'say. "what?" (yes!) no.### and.**** it ' * 9, 'say. "what?" (yes!) no.### and.**** it ' * 9, "don't we'll I'm they've it's", "z" * 5000, "é" * 300 + "é" * 300,
        f"{COMPLEMENTS[0]} {long[:400]}\n{COMPLEMENTS[0]}\n{COMPLEMENTS[1]}", COMPLEMENTS[1], *COMPLEMENTS,
    ]
    rows = []
    for i, text in enumerate(texts):
        lang = [None, "en", "de", "fr"][i % 4]
        source = None if i == 4 else f"src{i % 3 if i % 2 else 0}"
        rows.append((i * 7 + 1, text, lang, source, None if i % 5 else 3, "x", None, i, None, "y", 1, "w"))
    rows += [rows[0], rows[5], rows[13]]  # repeated rows
    return rows


def split(text: str | None) -> list[str]:
    return re.findall(f"[^{SPACE}]+", text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def quality_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    own = split(text)
    grams, covered = Counter(zip(own, own[1:], own[2:], strict=False)), set()
    for i in range(len(own) - 2):
        if grams[tuple(own[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if split(line):
            dup += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered)


def shingle_set(text: str | None, width: int = 4) -> set[tuple]:
    own = split(lower(text))
    if len(own) < width:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}


def groups(texts: dict, percent: int = 80, width: int = 4) -> dict:
    """Least reachable id of each id."""
    sets, root = {k: shingle_set(t, width) for k, t in texts.items()}, {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


# Fixed values of the rule of repeated spans.
STOP_SIGNS = ".!?؟۔։。！？．｡।॥…።៕។"
CLOSING_SIGNS = "»」』）】》〉〕］｝”’›、，"


def script_weight(char: str) -> int | None:
    """What a character weighs that is a word by itself; a spaced word weighs 4."""
    if char in STOP_SIGNS or char in CLOSING_SIGNS:
        return None
    if "\u3000" <= char <= "\u9fff" or "\uf900" <= char <= "\ufaff" or char >= "\U00020000":
        return 2
    if "\u0e00" <= char <= "\u0eff" or "\u1000" <= char <= "\u10bf" or "\u1780" <= char <= "\u17ff":
        return 1
    return None


def span_words(text: str) -> list[tuple[int, str, int, bool, bool]]:
    """(place, word, weight, ends with a stop, a sentence ends) of each word."""
    out = []
    for m in re.finditer(f"[^{SPACE}]+", text):
        starts, own = [m.start()], m[0]
        for k in range(1, len(own)):
            big = len(own[k].encode()) == 3 and own[k] in STOP_SIGNS + CLOSING_SIGNS
            before = own[k - 1]
            after_sign = before in STOP_SIGNS + CLOSING_SIGNS and (before >= "\uf000" or "\u3000" <= before <= "\u3fff")
            if not big and (script_weight(own[k]) or script_weight(before) or after_sign):
                starts.append(m.start() + k)
        for a, b in zip(starts, [*starts[1:], m.end()], strict=True):
            word, stop = text[a:b], False
            for char in word[::-1][:4]:
                stop |= char in STOP_SIGNS
                if not (char in CLOSING_SIGNS or char.isascii() and not char.isalnum()):
                    break
            out.append((a, word, script_weight(word[0]) or 4, stop))
    ends = [i + 1 == len(out) or out[i][3] or "\n" in text[a + len(w) : out[i + 1][0]] for i, (a, w, _, _) in enumerate(out)]
    return [(*one, end) for one, end in zip(out, ends, strict=True)]


def span_pieces(text: str, window: int = 15) -> list[list[tuple]]:
    """The words of each piece: sentences, cut after the least of any `window` words in a row."""
    own, marks = span_words(text), words_module.Fingerprint()
    value, before = [], 0
    for _, word, _, stop, _ in own:
        raw = np.frombuffer(word.encode(), np.uint8)
        mark = int(marks.segments(raw, np.array([0]), np.array([len(raw)]))[0])
        mixed = int(words_module.mix(np.array([(before * 3 + mark) % 2**64], np.uint64))[0])
        value.append(1 if stop else mixed | 2)
        before = mark
    least = set()
    for a in range(len(own) - window + 1):
        low = min(value[a : a + window])
        least |= {i for i in range(a, a + window) if value[i] == low}
    pieces = [[]]
    for i, word in enumerate(own):
        pieces[-1].append(word)
        if word[4] or i in least:
            pieces.append([])
    return [p for p in pieces if p]


def without_spans(texts: dict, run: int = 2, least: int = 10, most: int = 20) -> dict:
    """Texts by id without the pieces of runs that stand earlier."""
    cuts = {k: span_pieces(texts[k] or "") for k in sorted(texts)}

    def enough(part):
        n = sum(w[2] for p in part for w in p)
        return n >= 4 * least and sum(w[4] for p in part for w in p) >= run or n >= 4 * most

    def grown(part):
        for i in range(len(part)):
            j = next((j for j in range(i + 1, len(part) + 1) if enough(part[i:j])), None)
            if j:
                yield i, j
        back = next((i for i in reversed(range(len(part))) if enough(part[i:])), None)
        if back is not None:
            yield back, len(part)

    spans = {k: sorted(set(grown(part))) for k, part in cuts.items()}
    words_of = {(k, at): tuple(w[1] for p in cuts[k][slice(*at)] for w in p) for k in spans for at in spans[k]}
    first, out = {}, {}
    for k in spans:
        for at in spans[k]:
            first.setdefault(words_of[k, at], (k, at))
    for k, text in texts.items():
        gone = {p for at in spans[k] if first[words_of[k, at]] != (k, at) for p in range(*at)}
        edges = [p[0][0] for p in cuts[k]] + [len(text or "")]
        out[k] = text and text[: edges[0]] + "".join(text[a:b] for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if p not in gone)
    return out


def repeated_bytes(texts: list[str | None], length: int = 200) -> list[list[bool]]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        flags = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                flags[i : i + length] = [True] * length
        out.append(flags)
    return out


def bench_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def hits(text: str | None, items: list[tuple], width: int = 13) -> tuple[int, int, list[str]]:
    own, hit, names = bench_words(text), set(), set()
    for name, item in items:
        parts = bench_words(item)
        for i in range(max(1, len(parts) - width + 1) if parts else 0):
            window = parts[i : i + width]
            for j in range(len(own) - len(window) + 1):
                if own[j : j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    names.add(str(name))
    return len(own), len(hit), sorted(names)
