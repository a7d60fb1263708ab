"""Alignment of two tokenizers over the same texts, as a monoid of fragments.

The bytes of a text are cut into groups at the places where tokens of both tokenizers end. A fragment
stands for a range of bytes: an open prefix (tokens up to the first common end), closed groups, and an
open suffix (tokens after the last common end), or, without a common end, open tokens only. Fragments
compose: the suffix of one and the prefix of the next close to one group, and open ranges are joined.
Composition is associative, and the start and end of a text are common ends.

Short texts are cut at lone spaces, where neither tokenizer can join the two sides: their fragments
have closed groups only, and the fragment of each distinct piece is made once per task. A text of more
than `LONG` bytes is dealt in byte ranges of `CHUNK` characters to Spark tasks. Each task encodes its
range from the last such space before it to the first one after it and keeps the tokens that end
inside, so ranges begin and end in the middle of tokens and groups. Their edges are composed by a tree,
`FAN_IN` neighbours at a time; the groups themselves stay where they are and are only read in order
once, for the digest. A range without a space to begin or end at is joined to its neighbour.

Each group links all its pairs of tokens. A pair counts in how many texts it is linked. Pairs of ids
travel as one number per text and pair, and are counted with partial sums; the table of counts goes to
every task up to `HELD` pairs, and beyond it is joined by (pair, salt).

Defined results: null and empty texts, and texts that the tokens of one side don't spell byte by byte,
have no tokens, groups or links and an empty digest; repeated rows count once each; an empty table
gives an empty result; null ids stay; only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch
from presslens.llm.tokens import byte_letters
from presslens.operators.joins import lookup_join

#: Longer texts, in bytes, are dealt in ranges of CHUNK characters; a range begins at most REACH after a lone space.
LONG, CHUNK, REACH = 1 << 16, 1 << 14, 1 << 12
FAN_IN = 16
#: Pairs whose counts are held in every task.
HELD = 1 << 22
#: Pieces remembered per task, and the longest that is, in characters; texts handled at once, in characters.
MEMORY, SHORT, AT_ONCE = 400_000, 48, 1 << 20

#: Links of a group beyond which its ids are counted before they are paired; pieces that one call encodes.
LARGE, JOINED = 256, 512

# Neither side is white space in any reading, so no token of either tokenizer has this space inside.
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")

Group = tuple[list[int], list[int]]


class Tokenizers:
    """A byte-level BPE (A) and a sentencepiece BPE with byte fallback (B), and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {chr(letter): byte for byte, letter in byte_letters().items()}
        self.bytes_a = {i: bytes(back.get(c, 0) for c in token) for token, i in self.a.get_vocab().items()}
        self.bytes_b = [self.piece(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = max(self.bytes_a) + 1, len(self.bytes_b)

    def piece(self, i: int) -> bytes:
        text = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(text[3:5], 16)])
        return text.replace("▁", " ").encode()

    def encode(self, pieces: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of space + piece by A and of piece by B, which adds the space; None where one side spells something else."""
        many = [x.ids for x in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)]
        found = list(zip(many, self.b.encode(pieces, num_threads=1), strict=True))
        want, table_a, table_b = [(" " + p).encode() for p in pieces], self.bytes_a, self.bytes_b
        spelt_a = [b"".join([table_a[i] for i in a]) for a, _ in found]
        spelt_b = [b"".join([table_b[i] for i in b]) for _, b in found]
        if spelt_a == want == spelt_b:
            return found
        return [ids if x == w == y else None for ids, x, w, y in zip(found, spelt_a, want, spelt_b, strict=True)]


    def encode_joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of A and B of pieces without white space at their ends, joined by lone spaces, `JOINED` a call.

        Neither side has a token across such a space, so they are the ids of the pieces in order; None
        where a side spells something else somewhere.
        """
        chunks = [" ".join(pieces[k : k + JOINED]) for k in range(0, len(pieces), JOINED)]
        want = "".join([" " + c for c in chunks]).encode()
        a = list(chain.from_iterable(x.ids for x in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)))
        b = list(chain.from_iterable(self.b.encode(chunks, num_threads=1)))
        if b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


def written(groups: list[Group]) -> bytes:
    """`a1,a2|b1;a3|b2,b3`."""
    return ";".join([",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups]).encode()


def linked(groups: list[Group], size_b: int) -> Counter:
    """How often each pair of ids, as one number, is linked."""
    out: Counter = Counter()
    for a, b in groups:
        if len(a) == len(b) == 1:
            out[a[0] * size_b + b[0]] += 1
            continue
        ids_b = Counter(b)
        for x, n in Counter(a).items():
            for y, m in ids_b.items():
                out[x * size_b + y] += n * m
    return out


def written_groups(ids: np.ndarray, ends: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """The groups of each piece as text; tokens in order of group and side, `ends` what follows each, `cuts` the pieces."""
    tokens = [f"{i}{e}" for i, e in zip(ids.tolist(), np.array([",", "|", ";", ""])[ends].tolist(), strict=True)]
    return ["".join(tokens[a:b]).encode() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


class Pieces:
    """Fragments of pieces, which have closed groups only; each is made once while it is remembered.

    They are kept as columns: counts (tokens of A and B, groups, links), the groups as text, and the
    links as pair and number from `begin` on. Slot 0 is a piece without tokens.
    """

    def __init__(self, tokens: Tokenizers):
        self.tokens = tokens
        self.lengths = [np.zeros(n, np.int64) for n in (tokens.size_a, tokens.size_b)]
        for i, spelt in tokens.bytes_a.items():
            self.lengths[0][i] = len(spelt)
        self.lengths[1][:] = [len(spelt) for spelt in tokens.bytes_b]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.texts, self.counts = [b""], np.zeros((1, 4), np.int64)
        self.begin, self.codes, self.links = np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of(self, pieces: list[str]) -> np.ndarray:
        """The slot of each piece, -1 for a piece that its tokens don't spell."""
        if len(self.texts) > MEMORY:
            self.forget()
        slots = [self.known.get(p) for p in pieces]
        new = [k for k, slot in enumerate(slots) if slot is None]
        if new:
            for k, slot in zip(new, self.add([pieces[k] for k in new]).tolist(), strict=True):
                slots[k] = slot
                if len(pieces[k]) <= SHORT:
                    self.known[pieces[k]] = slot
        return np.array(slots, np.int64)

    def add(self, pieces: list[str]) -> np.ndarray:
        """Slots for new pieces, all made at once: those with white space at an end, or not spelt, one by one."""
        loose = np.array([p[0].isspace() or p[-1].isspace() for p in pieces])
        plain = np.flatnonzero(~loose)
        whole = self.tokens.encode_joined([pieces[k] for k in plain]) if len(plain) else None
        rest = np.flatnonzero(loose) if whole else np.arange(len(pieces))
        ids = self.tokens.encode([pieces[k] for k in rest]) if len(rest) else []
        rest = rest[np.array([x is not None for x in ids], bool)]
        ids, n = [x for x in ids if x is not None], len(plain) if whole else 0
        slots = np.full(len(pieces), -1)
        slots[np.concatenate((plain[:n], rest))] = len(self.texts) + np.arange(n + len(rest))
        if not n + len(rest):
            return slots
        # Bytes up to the end of each joined piece, the space before it among them.
        bounds = np.cumsum([len(pieces[k].encode()) + 1 for k in plain[:n]])
        sides = []  # (piece, id, end in bytes) of each token, for A and B
        for side in (0, 1):
            sizes = np.array([len(x[side]) for x in ids], np.int64)
            flat = np.fromiter(chain.from_iterable(x[side] for x in ids), np.int64, int(sizes.sum()))
            flat = np.concatenate((whole[side], flat)) if whole else flat
            ends = np.cumsum(self.lengths[side][flat])
            row = np.repeat(n + np.arange(len(ids)), sizes)
            row = np.concatenate((np.searchsorted(bounds, ends[: len(whole[side])]), row)) if whole else row
            sides.append((row, flat, ends))
        (row_a, a, end_a), (row_b, b, end_b) = sides
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        n_a, n_b = np.bincount(group_a), np.bincount(group_b)
        row = np.empty(len(common), np.int64)
        row[group_a] = row_a
        # Text: the tokens of A, then those of B, of each group; what follows is a comma, a bar, a semicolon or, at the end of a piece, nothing.
        order = np.lexsort((np.repeat((0, 1), (len(a), len(b))), np.concatenate((group_a, group_b))))
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        final = np.append(row_b[1:] != row_b[:-1], True)
        follow = np.concatenate((np.where(last_a, 1, 0), np.where(final, 3, np.where(last_b, 2, 0))))
        size = np.bincount(row_a) + np.bincount(row_b)
        self.texts += written_groups(np.concatenate((a, b))[order], follow[order], np.concatenate(([0], np.cumsum(size))))
        # Links: each token of A with the tokens of B of its group; in large groups ids are counted first.
        large = n_a * n_b > LARGE
        first_b = np.cumsum(n_b) - n_b
        times = np.where(large[group_a], 0, n_b[group_a])
        at = np.repeat(first_b[group_a] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        code, holder = [np.repeat(a, times) * self.tokens.size_b + b[at]], [np.repeat(row_a, times)]
        number = [np.ones(len(at), np.int64)]
        for g in np.flatnonzero(large).tolist():
            pairs = linked([(a[group_a == g].tolist(), b[group_b == g].tolist())], self.tokens.size_b)
            code.append(np.fromiter(pairs, np.int64, len(pairs)))
            number.append(np.fromiter(pairs.values(), np.int64, len(pairs)))
            holder.append(np.full(len(pairs), row[g]))
        code, holder, number = np.concatenate(code), np.concatenate(holder), np.concatenate(number)
        order = np.lexsort((code, holder))
        code, holder = code[order], holder[order]
        fresh = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (holder[1:] != holder[:-1])))
        links = np.add.reduceat(number[order], fresh)
        held = np.bincount(holder[fresh], minlength=n + len(ids))
        counts = [np.bincount(row_a), np.bincount(row_b), np.bincount(row), np.bincount(row, n_a * n_b).astype(np.int64)]
        self.counts = np.concatenate((self.counts, np.stack(counts, axis=1)))
        self.codes, self.links = np.concatenate((self.codes, code[fresh])), np.concatenate((self.links, links))
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(held)))
        return slots


SHAPE = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values).cast(kind))


def composed(pieces: Pieces, texts: list[str]) -> list[pa.Array]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, codes, links) of each text: its pieces' fragments composed."""
    numbers: dict[str, int] = {}
    rows = [[numbers.setdefault(p, len(numbers)) for p in _LONE_SPACE.split(t)] if t else [] for t in texts]
    slots = pieces.of(list(numbers))
    sizes = np.array([len(r) for r in rows], np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    flat = slots[np.fromiter(chain.from_iterable(rows), np.int64, len(row))] if len(row) else row
    bad = np.unique(row[flat < 0])
    if len(bad):
        # Some pieces are not spelt; the whole text is asked as one, since that is what counts.
        whole = np.maximum(pieces.add([texts[r] for r in bad]), 0)
        keep = ~np.isin(row, bad)
        row, flat = np.concatenate((row[keep], bad)), np.concatenate((flat[keep], whole))
        order = np.argsort(row, kind="stable")
        row, flat = row[order], flat[order]
    cuts = np.searchsorted(row, np.arange(len(rows) + 1))
    sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(pieces.counts[flat], axis=0)))
    totals = sums[cuts[1:]] - sums[cuts[:-1]]
    known, held, digests = pieces.texts, flat.tolist(), []
    for r, n in enumerate(totals[:, 0].tolist()):
        digests.append(hashlib.sha256(b";".join([known[s] for s in held[cuts[r] : cuts[r + 1]]])).hexdigest() if n else "")

    # Links: each piece once per text, times how often it stands there; then equal pairs of a text together.
    spot = np.sort(row * len(known) + flat)
    first = np.flatnonzero(np.append(True, spot[1:] != spot[:-1])[: len(spot)])
    times = np.diff(np.append(first, len(spot)))
    at_row, at_slot = spot[first] // len(known), spot[first] % len(known)
    n = pieces.begin[at_slot + 1] - pieces.begin[at_slot]
    place = np.repeat(pieces.begin[at_slot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    code, link, at_row = pieces.codes[place], pieces.links[place] * np.repeat(times, n), np.repeat(at_row, n)
    span = pieces.tokens.size_a * pieces.tokens.size_b
    order = np.argsort(at_row * span + code)
    code, link, at_row = code[order], link[order], at_row[order]
    first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (at_row[1:] != at_row[:-1]))[: len(code)])
    link = np.add.reduceat(link, first) if len(first) else link
    code, at_row = code[first], at_row[first]
    ends = np.searchsorted(at_row, np.arange(len(rows) + 1))
    kind = pa.int32() if span < 2**31 else pa.int64()
    return [*[pa.array(totals[:, k]) for k in range(4)], pa.array(digests, pa.string()), _lists(code, ends, kind), _lists(link, ends, pa.int64())]


def short_texts(rows: DataFrame, paths: tuple[str, str], code: str) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(Tokenizers(*paths))
        for batch in batches:
            texts, ids, lo, load = batch.column("text").to_pylist(), batch.column("doc_id"), 0, 0
            for hi, text in enumerate(texts, 1):
                load += len(text)
                if load >= AT_ONCE or hi == len(texts):
                    yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *composed(pieces, texts[lo:hi])], names)
                    lo, load = hi, 0

    return rows.select("doc_id", "text").mapInArrow(W.tidy(run), f"doc_id {kind}, {SHAPE}, groups_sha256 string, codes array<{code}>, links array<bigint>")


# ---- long texts ------------------------------------------------------------------------------------


def ranges(text: str) -> Iterator[tuple[int, str, int, int]]:
    """(number, region, bytes before the range, bytes up to its end) of the ranges of a text; the space before a region belongs to it."""
    edges = [(0, 0, 0)]  # (the range begins at, its region before it begins at, the region of the range before ends at)
    at = CHUNK
    while at < len(text):
        before = [m.start() for m in _LONE_SPACE.finditer(text, max(0, at - REACH), at)]
        after = _LONE_SPACE.search(text, at, min(len(text), at + REACH))
        if before and after:
            edges.append((at, before[-1] + 1, after.start()))
        at += CHUNK
    edges.append((len(text), 0, len(text)))
    for number, (this, following) in enumerate(zip(edges, edges[1:], strict=False)):
        region = text[this[1] : following[2]]
        skip = len(text[this[1] : this[0]].encode()) + 1 if number else 0
        yield number, region, skip, 1 + len(text[this[1] : following[0]].encode())


def long_ranges(rows: DataFrame) -> DataFrame:
    """(doc_id, key, chunk, region, skip, take): the ranges of long texts; a key is given to every row."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "key", "chunk", "region", "skip", "take"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, text in enumerate(batch.column("text")):
                key, doc = uuid.uuid4().bytes, batch.column("doc_id").slice(r, 1)
                for number, region, skip, take in ranges(text.as_py()):
                    columns = [pa.array([key]), *[pa.array([x], pa.int64()) for x in (number,)], pa.array([region]), *[pa.array([x], pa.int64()) for x in (skip, take)]]
                    yield pa.RecordBatch.from_arrays([doc, *columns], names)

    return rows.select("doc_id", "text").mapInArrow(W.tidy(run), f"doc_id {kind}, key binary, chunk bigint, region string, skip bigint, take bigint")


EDGES = "cut boolean, prefix_a array<bigint>, prefix_b array<bigint>, suffix_a array<bigint>, suffix_b array<bigint>"
GROUPS = "chunk bigint, part bigint, text binary, n_groups bigint, codes array<bigint>, links array<bigint>"


class Fragment:
    """An open prefix and an open suffix around a cut, or open tokens without one (all in the prefix)."""

    def __init__(self, cut: bool, prefix: Group, suffix: Group = ((), ())):
        self.cut, self.prefix, self.suffix = cut, prefix, suffix

    def __add__(self, other: Fragment) -> tuple[Fragment, Group | None]:
        """The composition, and the group that it closes, if any."""

        def joined(x: Group, y: Group) -> Group:
            return [*x[0], *y[0]], [*x[1], *y[1]]

        if not self.cut:
            return Fragment(other.cut, joined(self.prefix, other.prefix), other.suffix), None
        middle = joined(self.suffix, other.prefix)
        if not other.cut:
            return Fragment(True, self.prefix, middle), None
        return Fragment(True, self.prefix, other.suffix), middle if middle[0] else None

    def row(self) -> dict:
        return {"cut": self.cut, "prefix_a": self.prefix[0], "prefix_b": self.prefix[1], "suffix_a": self.suffix[0], "suffix_b": self.suffix[1]}

    @classmethod
    def read(cls, row: dict) -> Fragment:
        return cls(row["cut"], (row["prefix_a"], row["prefix_b"]), (row["suffix_a"], row["suffix_b"]))


def fragment(tokens: Tokenizers, a: list[int], b: list[int], skip: int, take: int) -> tuple[Fragment, list[Group], int, int]:
    """(edges, closed groups, tokens of A, tokens of B) of the tokens that end after `skip` bytes and by `take`."""
    own = []
    for ids, spelt in ((a, tokens.bytes_a), (b, tokens.bytes_b)):
        ends = np.cumsum([len(spelt[i]) for i in ids])
        lo, hi = np.searchsorted(ends, (skip, take), "right")
        own.append((np.array(ids[lo:hi], np.int64), ends[lo:hi]))
    (ids_a, ends_a), (ids_b, ends_b) = own
    common = np.intersect1d(ends_a, ends_b)
    if skip == 0:
        common = np.append(0, common)
    if not len(common):
        return Fragment(False, (ids_a.tolist(), ids_b.tolist())), [], len(ids_a), len(ids_b)
    cut_a, cut_b = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")
    parts_a, parts_b = ([x.tolist() for x in np.split(ids, cuts)] for ids, cuts in ((ids_a, cut_a), (ids_b, cut_b)))
    edges = Fragment(True, (parts_a[0], parts_b[0]), (parts_a[-1], parts_b[-1]))
    return edges, list(zip(parts_a[1:-1], parts_b[1:-1], strict=True)), len(ids_a), len(ids_b)


def range_fragments(chunks: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Of each range: key, whether its tokens spell it, its tokens, edges and closed groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokenizers(*paths)
        for batch in batches:
            for row in batch.to_pylist():
                [ids] = tokens.encode([row["region"]])
                edges, groups, n_a, n_b = fragment(tokens, *(ids or ([], [])), row["skip"], row["take"])
                pairs = linked(groups, tokens.size_b)
                out = {"key": row["key"], "spelt": ids is not None, "n_a": n_a, "n_b": n_b, **edges.row()}
                out |= {"chunk": row["chunk"], "part": 1, "text": written(groups), "n_groups": len(groups), "codes": list(pairs), "links": list(pairs.values())}
                yield pa.RecordBatch.from_pylist([out], schema)

    columns = f"key binary, spelt boolean, n_a bigint, n_b bigint, {EDGES}, {GROUPS}"
    schema = _arrow(columns)
    return chunks.select("key", "chunk", "region", "skip", "take").mapInArrow(W.tidy(run), columns)


def _arrow(columns: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "boolean": pa.bool_(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")])


def tree(fragments: DataFrame, size_b: int, scratch: Scratch) -> DataFrame:
    """(key, chunk, part, text, n_groups, codes, links) of the groups that open edges close, composed in rounds."""
    columns = f"key binary, at bigint, {EDGES}, {GROUPS}"
    schema = _arrow(columns)

    def compose(rows: pa.Table) -> pa.Table:
        own = rows.sort_by("at").to_pylist()
        whole, out = Fragment.read(own[0]), []
        for row in own[1:]:
            whole, closed = whole + Fragment.read(row)
            if closed:
                pairs = linked([closed], size_b)
                out.append({"key": row["key"], "chunk": row["at"], "part": 0, "text": written([closed]), "n_groups": 1, "codes": list(pairs), "links": list(pairs.values())})
        out.append({"key": own[0]["key"], "at": own[0]["at"], **whole.row()})
        return pa.Table.from_pylist(out, schema)

    edges = fragments.select("key", F.col("chunk").alias("at"), *[c.split()[0] for c in EDGES.split(", ")])
    most, span, step, closed = fragments.agg(F.max("chunk")).first()[0] or 0, 1, 0, None
    names = [c.split()[0] for c in GROUPS.split(", ")]
    while span <= most:
        span, step = span * FAN_IN, step + 1
        dealt = edges.withColumn("task", F.expr(f"at div {span}"))
        done = scratch.put(dealt.groupBy("key", "task").applyInArrow(compose, columns), f"tree-{step}")
        edges = done.filter("at IS NOT NULL").select(*edges.columns)
        new = done.filter("at IS NULL").select("key", *names)
        closed = new if closed is None else closed.unionByName(new)
    own = fragments.select("key", *names)
    return own if closed is None else own.unionByName(closed)


def digests(groups: DataFrame) -> DataFrame:
    """(key, groups_sha256): the groups of each key are read in order, one part at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "groups_sha256"])

        key = state = None
        for batch in batches:
            for one, text in zip(batch.column("key"), batch.column("text"), strict=True):
                if one.as_py() != key:
                    if key is not None:
                        yield row()
                    key, state, begun = one.as_py(), hashlib.sha256(), False
                if len(text.as_buffer()):
                    state.update(b";" if begun else b"")
                    state.update(text.as_buffer())
                    begun = True
        if key is not None:
            yield row()

    dealt = groups.select("key", "chunk", "part", "text").repartition("key").sortWithinPartitions("key", "chunk", "part")
    return dealt.select("key", "text").mapInArrow(W.tidy(run), "key binary, groups_sha256 string")


def long_texts(rows: DataFrame, paths: tuple[str, str], code: str, size_b: int, scratch: Scratch) -> DataFrame:
    chunks = scratch.put(long_ranges(rows), "ranges", 64)
    dealt = chunks.repartition("key", "chunk")
    fragments = scratch.put(range_fragments(dealt, paths), "fragments", 64)
    groups = scratch.put(tree(fragments, size_b, scratch), "groups", 64)
    sums = fragments.groupBy("key").agg(F.min("spelt").alias("spelt"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    pairs = groups.select("key", F.explode(F.arrays_zip("codes", "links")).alias("x")).groupBy("key", F.col("x.codes").alias("code")).agg(F.sum("x.links").alias("link"))
    pairs = pairs.groupBy("key").agg(F.collect_list(F.struct("code", "link")).alias("pairs"), F.sum("link").alias("n_links"))
    counts = groups.groupBy("key").agg(F.sum("n_groups").alias("n_groups"))
    ids = chunks.filter("chunk = 0").select("key", "doc_id")
    found = ids.join(sums, "key").join(counts, "key").join(pairs, "key", "left").join(scratch.put(digests(groups), "digests", 64), "key")

    def if_spelt(column, other):
        return F.when(F.col("spelt") & (F.col("n_a") > 0), column).otherwise(other)

    numbers = [if_spelt(F.coalesce(c, F.lit(0)), F.lit(0)).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    lists = [if_spelt(F.transform("pairs", lambda x: x[f]), F.array()).cast(f"array<{kind}>").alias(c) for f, kind, c in (("code", code, "codes"), ("link", "bigint", "links"))]
    return found.select("doc_id", *numbers, if_spelt(F.col("groups_sha256"), F.lit("")).alias("groups_sha256"), *lists)


# ---- counts of pairs -------------------------------------------------------------------------------


def with_held(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Adds n_best and count_sum from a table of counts that every task holds."""
    held = pairs.select(F.col("code").cast("bigint"), "docs", "best").toPandas().sort_values("code")
    table = texts.sparkSession.sparkContext.broadcast((held["code"].to_numpy(), held["docs"].to_numpy(), held["best"].to_numpy()))
    kept = [c for c in texts.columns if c not in ("codes", "links")]
    kinds = [f"{c} {texts.schema[c].dataType.simpleString()}" for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, docs, best = table.value
        for batch in batches:
            lists = batch.column("codes")
            at = np.searchsorted(codes, lists.flatten().to_numpy())
            links = batch.column("links").flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))))
            sums = []
            for value in (links * best[at], links * docs[at]):
                total = np.concatenate(([0], np.cumsum(value, dtype=np.int64)))
                sums.append(pa.array(total[ends[1:]] - total[ends[:-1]]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *sums], [*kept, "n_best", "count_sum"])

    return texts.mapInArrow(W.tidy(run), ", ".join([*kinds, "n_best bigint", "count_sum bigint"]))


def with_joined(texts: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds n_best and count_sum by a join, for tables of counts of any size."""
    rows = scratch.put(texts.withColumn("key", F.expr("uuid()")), "keyed")
    each = rows.select("key", F.explode(F.arrays_zip("codes", "links")).alias("x")).select("key", F.col("x.codes").alias("code"), F.col("x.links").alias("link"))
    found = lookup_join(each, pairs, "code", "key").groupBy("key")
    sums = found.agg(F.sum(F.when(F.col("best"), F.col("link")).otherwise(0)).alias("n_best"), F.sum(F.col("link") * F.col("docs")).alias("count_sum"))
    done = rows.drop("codes", "links").join(sums, "key", "left").drop("key")
    return done.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})


def align(docs: DataFrame, path_a: str, path_b: str, held: int = HELD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per text.

    A is a byte-level BPE of the tokenizers library over space + text, B a sentencepiece BPE with byte
    fallback over the text, to which it adds the space. Both files must be at their paths on every machine.
    """
    scratch, paths = Scratch(docs.sparkSession, "alignment"), (path_a, path_b)
    tokens = Tokenizers(*paths)
    code = "int" if tokens.size_a * tokens.size_b < 2**31 else "bigint"
    size_b = tokens.size_b
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    long = F.octet_length("text") > LONG
    texts = short_texts(rows.filter(~long), paths, code).unionByName(long_texts(rows.filter(long), paths, code, size_b, scratch))
    texts = scratch.put(texts, "texts")
    scratch.drop("ranges", "fragments", "groups", "digests", *[s for s in scratch.paths if s.startswith("tree-")])

    counted = scratch.put(texts.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("docs")), "counted")
    highest = counted.groupBy(F.expr(f"code div {size_b}").alias("a")).agg(F.max("docs").alias("highest"))
    # One row per id of A.
    pairs = counted.withColumn("a", F.expr(f"code div {size_b}")).join(F.broadcast(highest), "a")
    pairs = scratch.put(pairs.select("code", "docs", (F.col("docs") == F.col("highest")).alias("best")), "pairs")
    found = with_held(texts, pairs) if pairs.count() <= held else with_joined(texts, pairs, scratch)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
