"""Language identification by string kernels.

The blended-spectrum presence kernel of two texts counts the letter n-grams of 1 to 3 characters
that both have, over the geometric mean of how many each has. Kernel values with a fixed number of
landmark texts, rotated by the inverse root of the landmarks' own kernel matrix (Nyström), are a
text's features; one ridge regression per language, one against the rest, gives the scores. Scoring
is two matrix products per block of texts.

Training takes at most `per_language` texts of each language, chosen by a digest of their id, of
which the first `landmarks` are landmarks; the model is a few matrices of bounded size. n-grams are
those of UTF-8 bytes of the lower-cased text in which every run of characters that are not letters
is one space, hashed to `SPACE` places; the whole text counts, whatever its length.

Defined results: a text that is null or has no letter is `und` with score 0; a null language is not
learned; repeated rows get the same prediction; with no training text everything is `und`; an empty
table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch

SPACE = 1 << 13
PER_LANGUAGE, LANDMARKS, RIDGE = 400, 32, 1e-3
BLOCK_ROWS = 256
_NOT_LETTERS = regex.compile(r"\P{L}+")


def presence(texts: list[str]) -> np.ndarray:
    """One row per text: which of the SPACE n-gram places its letters fill, scaled to length one; 0 without letters."""
    out = np.zeros((len(texts), SPACE), np.float32)
    for i, text in enumerate(texts):
        letters = _NOT_LETTERS.sub(" ", text.lower()).strip()
        if not letters:
            continue
        data = np.frombuffer(f" {letters} ".encode(), np.uint8).astype(np.uint32)
        for lo in range(0, len(data), W.BLOCK):
            a = data[lo : lo + W.BLOCK + 2]
            out[i, a] = 1
            pairs = a[:-1] * np.uint32(256) + a[1:]
            out[i, 256 + (pairs * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(SPACE - 256)] = 1
            triples = (pairs[:-1] * np.uint32(256) + a[2:]) * np.uint32(2246822519)
            out[i, 256 + (triples >> np.uint32(7)) % np.uint32(SPACE - 256)] = 1
    sizes = np.sqrt(out.sum(axis=1, keepdims=True))
    return out / np.maximum(sizes, 1)


class Model:
    """Landmarks, their rotation, and one weight column per language."""

    def __init__(self, texts: list[str], langs: list[str], first: list[bool], ridge: float = RIDGE):
        self.langs = sorted(set(langs))
        chosen = [t for t, f in zip(texts, first, strict=True) if f]
        self.landmarks = presence(chosen)
        own = (self.landmarks @ self.landmarks.T).astype(np.float64)
        values, vectors = np.linalg.eigh(own)
        keep = values > 1e-6 * max(values.max(initial=0), 1e-12)
        self.rotation = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
        gram = np.zeros((self.rotation.shape[1] + 1,) * 2)
        target = np.zeros((len(gram), len(self.langs)))
        for lo in range(0, len(texts), BLOCK_ROWS):
            z = self.features(presence(texts[lo : lo + BLOCK_ROWS])).astype(np.float64)
            y = np.array([[1.0 if lang == one else -1.0 for one in self.langs] for lang in langs[lo : lo + BLOCK_ROWS]])
            gram += z.T @ z
            target += z.T @ y
        self.weights = np.linalg.solve(gram + ridge * len(texts) * np.eye(len(gram)), target).astype(np.float32)

    def features(self, present: np.ndarray) -> np.ndarray:
        z = (present @ self.landmarks.T) @ self.rotation
        return np.hstack([z, np.ones((len(z), 1), np.float32)])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        present = presence(texts)
        margins = self.features(present) @ self.weights
        best = margins.argmax(axis=1)
        score = np.clip((margins[np.arange(len(best)), best] + 1) / 2, 0, 1)
        letters = present.any(axis=1)
        return (
            [self.langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)],
            [float(s) if ok else 0.0 for s, ok in zip(score, letters, strict=True)],
        )

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, langs=np.array(self.langs), landmarks=self.landmarks, rotation=self.rotation, weights=self.weights)
        return out.getvalue()

    @classmethod
    def unpacked(cls, packed: bytes) -> Model:
        self, parts = cls.__new__(cls), np.load(io.BytesIO(packed))
        self.langs = parts["langs"].tolist()
        self.landmarks, self.rotation, self.weights = parts["landmarks"], parts["rotation"], parts["weights"]
        return self


def learned(training: DataFrame, per_language: int, landmarks: int, ridge: float) -> bytes | None:
    """The model, fitted in one task on the bounded sample; `training` has doc_id, text and lang."""
    # Ids are drawn first, with the share of each language taken from its count; then only the drawn
    # rows' texts are read into the fit, so no text and no whole language is shuffled.
    scratch = Scratch(training.sparkSession, "language")
    sizes = scratch.put(training.groupBy("lang").agg(F.count("*").alias("n")), "sizes")
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = training.select("doc_id", "lang", draw.alias("draw")).join(sizes, "lang")
    drawn = drawn.filter(F.col("draw") * F.col("n") < 2 * per_language + 50)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    drawn = drawn.withColumn("rank", rank).filter(F.col("rank") <= per_language).groupBy("doc_id", "lang").agg(F.min("rank").alias("rank"))
    drawn = scratch.put(drawn, "drawn")
    same = F.col("t.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("t.lang") == F.col("d.lang"))
    drawn = training.alias("t").join(drawn.alias("d"), same).select("t.text", "t.lang", "d.rank")

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("rank", "ascending")])
        first = [r <= landmarks for r in table["rank"].to_pylist()]
        model = Model(table["text"].to_pylist(), table["lang"].to_pylist(), first, ridge)
        return pa.table({"model": pa.array([model.packed()], pa.binary())})

    found = drawn.select(F.lit(1).alias("one"), "text", "lang", "rank").groupBy("one").applyInArrow(fit, "model binary").collect()
    return found[0].model if found else None


def identify(
    docs: DataFrame, train: Column, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, ridge: float = RIDGE,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); rows for which `train` holds and lang is known may be learned from."""
    train = F.coalesce(train, F.lit(False))
    trained = train & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
    sample = docs.filter(trained).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    packed = docs.sparkSession.sparkContext.broadcast(learned(sample, per_language, landmarks, ridge))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.unpacked(packed.value) if packed.value else None
        for batch in batches:
            for lo in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                texts = part.column("text").to_pylist()
                langs, scores = model.predict(texts) if model else (["und"] * len(texts), [0.0] * len(texts))
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), (~train).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(W.tidy(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
