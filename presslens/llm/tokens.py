"""Token ids and counts by public tokenizers, with a digest cache of counts.

The cache is a table (tokenizer_digest, content_digest, n_tokens). Rows are joined to it by the
digest of their normalised content and of the tokenizer's file; only contents that it lacks are
encoded, each once, and appended. Documents that share a text, however many, are one content.

Defined results: a null text is the empty text and has 0 tokens; repeated rows share a count; an
empty table reads and adds nothing; only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch

CACHE_SCHEMA = "tokenizer_digest string, content_digest binary, n_tokens long"

#: Pieces remembered per task; beyond it the memory starts anew.
MEMORY = 700_000


class Encoder:
    """Ids of texts without begin, end or added special tokens.

    A byte-level BPE never merges across a single space between two other characters: texts are cut
    there, and the library encodes each distinct piece once. Where a text has other white space at a
    space, or could hold a special string, the library gets the whole text.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.pieces: dict[str, bytes] = {}
        self.memory, self.cuts = memory, False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda texts: model.encode(texts, num_threads=1)
            return
        import json

        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.library = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        split = made.get("pre_tokenizer") or {}
        self.cuts = made.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if self.cuts:
            self.specials = [t["content"] for t in made["added_tokens"]]
            self.model, self.letters = tokenizer.model, byte_letters()
            import regex

            # Fixed value: the published word pattern of byte-level BPE.
            self.word = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def piece(self, text: str) -> bytes:
        ids = []
        for word in self.word.findall(text):
            ids += [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        head, *rest = text.split(" ")
        if not self.cuts or head[-1:].isspace() or any(s in text for s in self.specials):
            return self.whole(text)
        found, out = self.pieces, [self.piece(head)]
        for part in rest:
            ids = found.get(part)
            if ids is None:
                # Pieces that are remembered have no white space at their ends.
                if not part or part[0].isspace() or part[-1].isspace():
                    return self.whole(text)
                if len(found) >= self.memory:
                    found.clear()
                ids = self.piece(" " + part)
                if len(part) < 64:
                    found[part] = ids
            out.append(ids)
        return b"".join(out)

    def whole(self, text: str) -> bytes:
        return np.array(self.library([text])[0], "<u4").tobytes()


def byte_letters() -> dict[int, int]:
    """The printable character that stands for each byte: itself where it is printable Latin-1, else one from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}


def file_digest(path: str) -> str:
    """The tokenizer's version: a digest of its file and of the library that reads it."""
    import importlib.metadata

    name = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"{name} {importlib.metadata.version(name)}".encode()).hexdigest()


def encoded_sizes(contents: DataFrame, path: str) -> DataFrame:
    """(content_digest, n_tokens) of (content_digest, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            sizes = [len(encoder.encode(text.as_py())) // 4 for text in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("content_digest"), pa.array(sizes, pa.int64())], ["content_digest", "n_tokens"])

    return contents.select("content_digest", "content").mapInArrow(W.tidy(run), "content_digest binary, n_tokens long")


def token_counts(
    docs: DataFrame, path: str, cache: str | None = None, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit); `cache` is the folder of the cache, by default one for this call.

    The tokenizer file must be at `path` on every machine.
    """
    spark, version = docs.sparkSession, file_digest(path)
    scratch = Scratch(spark, "tokens")
    content = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(content, 256)).alias("content_digest")
    rows = scratch.put(
        docs.select(F.col(id_col).alias("doc_id"), F.octet_length(content).cast("long").alias("n_bytes"), digest), "digests"
    )
    if cache is None:
        cache = scratch.put(spark.createDataFrame([], CACHE_SCHEMA), "cache") and scratch.paths["cache"]
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer_digest") == version)
    known = known.dropDuplicates(["content_digest"]).select("content_digest", "n_tokens")

    # One row stands for each content that the cache lacks: the first of its documents, by id.
    misses = rows.groupBy("content_digest").agg(F.min("doc_id").alias("doc_id")).join(known, "content_digest", "left_anti")
    found = docs.select(F.col(id_col).alias("doc_id"), content.alias("content"), digest)
    same = F.col("m.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("m.content_digest") == F.col("d.content_digest"))
    missing = found.alias("d").join(misses.alias("m"), same, "left_semi")
    # A row repeated in id and text comes twice.
    added = encoded_sizes(missing, path).dropDuplicates(["content_digest"]).select(F.lit(version).alias("tokenizer_digest"), "content_digest", "n_tokens")
    added.write.mode("append").parquet(cache)

    spark.catalog.refreshByPath(cache)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer_digest") == version)
    stored = stored.groupBy("content_digest").agg(F.first("n_tokens").alias("n_tokens"))
    counted = rows.join(stored, "content_digest", "left")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
