"""Nearest neighbours of named vectors by cosine: exact over all rows, or over the candidates of an index."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.operators.joins import lookup_join
from presslens.session import materialise

BLOCK_QUERIES = 1000
#: Tables of an index, the rows that one code of a table holds on average, and the codes asked per query and table.
TABLES, ROWS_PER_CODE, PROBES = 24, 32, 16


def nearest(
    df: DataFrame, queries: DataFrame, k: int = 12, id_col: str = "vec_id", vec_col: str = "embedding", digits=6
) -> DataFrame:
    """query_id, id, cosine, rank: the k best per query, ties by id.

    `queries` (query_id, vector) are taken in blocks of about BLOCK_QUERIES, each a pass over the rows.
    Every task multiplies its batches with the block and keeps k rows per query, so no pair table
    arises and at most tasks * queries * k rows are shuffled.
    """
    wanted = queries.select("query_id", "vector")
    blocks = -(-wanted.count() // BLOCK_QUERIES)
    if blocks <= 1:
        return _nearest(df, wanted.collect(), k, id_col, vec_col, digits)
    wanted = materialise(wanted, "queries")
    parts = (wanted.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).collect() for b in range(blocks))
    return reduce(DataFrame.unionByName, [_nearest(df, part, k, id_col, vec_col, digits) for part in parts if part])


def _nearest(df: DataFrame, wanted: list, k: int, id_col: str, vec_col: str, digits: int) -> DataFrame:
    names = np.array([q["query_id"] for q in wanted])
    matrix = np.array([q["vector"] for q in wanted], dtype=np.float64).reshape(len(wanted), -1 if wanted else 1)
    matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)

    def best(batches):
        ids = np.empty((len(names), 0), dtype=np.int64)
        scores = np.empty((len(names), 0))
        for batch in batches:
            if batch.num_rows == 0 or len(names) == 0:
                continue
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            vectors = vectors.reshape(batch.num_rows, -1)
            cosine = matrix @ (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).T
            new = np.broadcast_to(batch.column(0).to_numpy(), cosine.shape)
            ids = np.concatenate([ids, new], axis=1)
            scores = np.concatenate([scores, np.round(cosine, digits)], axis=1)
            order = np.lexsort((ids, -scores), axis=1)[:, :k]
            ids = np.take_along_axis(ids, order, axis=1)
            scores = np.take_along_axis(scores, order, axis=1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(names.astype(np.int64), ids.shape[1])),
                pa.array(ids.ravel()),
                pa.array(scores.ravel()),
            ],
            ["query_id", id_col, "cosine"],
        )

    rows = df.select(F.col(id_col).cast("bigint"), vec_col).filter(F.col(vec_col).isNotNull())
    local = rows.mapInArrow(best, f"query_id bigint, {id_col} bigint, cosine double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), id_col))
    return local.withColumn("rank", rank).filter(F.col("rank") <= k)


def centroids(df: DataFrame, by: str, vec_col: str = "embedding") -> DataFrame:
    """Mean vector per group, combined on the map side one dimension at a time."""
    parts = df.select(F.col(by).alias("query_id"), F.posexplode_outer(vec_col).alias("dim", "x"))
    means = parts.groupBy("query_id", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    vector = F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda e: e["x"])
    return means.groupBy("query_id").agg(vector.alias("vector"))


@dataclass
class ProjectionIndex:
    """An index of signed random projections, with exact re-ranking of what it finds.

    In each of its tables a vector has a code: the signs of its products with a few random directions.
    `codes` holds one row (table, code, id) per vector and table, written in the order of the codes;
    `vectors` the vectors by id. A query asks for its own code in every table and for the codes that
    differ in its least certain signs. The ids found are looked up in `vectors` and ranked by their exact
    cosine, so that a neighbour is missed only if no table offers it.
    """

    vectors: DataFrame
    codes: DataFrame
    directions: np.ndarray

    @classmethod
    def build(
        cls, df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = TABLES,
        rows_per_code: int = ROWS_PER_CODE, seed: int = 1234,
    ) -> ProjectionIndex:
        """All vectors are indexed; null vectors have no neighbours."""
        vectors = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<float>").alias("vector"))
        vectors = materialise(vectors.filter(F.col("vector").isNotNull()), "vectors")
        facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
        bits = min(24, max(2, round(math.log2(max(1, facts["n"] / rows_per_code)))))
        directions = np.random.default_rng(seed).normal(size=(tables, bits, facts["dim"] or 1))

        def run(batches):
            for batch in batches:
                rows = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
                codes = np.stack([((rows @ d.T) > 0) @ (1 << np.arange(bits)) for d in directions], axis=1)
                numbers = np.tile(np.arange(tables), batch.num_rows)
                ids = np.repeat(batch.column("id").to_numpy(), tables)
                columns = [pa.array(numbers, pa.int32()), pa.array(codes.ravel(), pa.int32()), pa.array(ids)]
                yield pa.RecordBatch.from_arrays(columns, ["table", "code", "id"])

        codes = vectors.mapInArrow(run, "table int, code int, id bigint")
        codes = codes.repartitionByRange("table", "code").sortWithinPartitions("table", "code")
        return cls(vectors, materialise(codes, "codes"), directions)

    def probes(self, query: np.ndarray, probes: int) -> list[tuple[int, int]]:
        """(table, code) of a query: its own code, then codes with the least certain signs turned, nearest first."""
        out, bits = [], self.directions.shape[1]
        for table, directions in enumerate(self.directions):
            products = directions @ query
            code = int(((products > 0) @ (1 << np.arange(bits))))
            doubtful = np.argsort(np.abs(products))[: max(1, (probes - 1).bit_length())]
            cost = np.abs(products)[doubtful] ** 2
            turns = sorted(range(1 << len(doubtful)), key=lambda t: sum(c for k, c in enumerate(cost) if t >> k & 1))
            for turn in turns[:probes]:
                out.append((table, code ^ sum(1 << int(b) for k, b in enumerate(doubtful) if turn >> k & 1)))
        return out

    def nearest(self, queries: DataFrame, k: int = 12, probes: int = PROBES, digits: int = 6) -> DataFrame:
        """query_id, id, cosine, rank of the k best candidates per query, ties by id; `queries` as for `nearest`, in blocks."""
        wanted = materialise(queries.select("query_id", "vector"), "queries")
        blocks = max(1, -(-wanted.count() // BLOCK_QUERIES))
        parts = (wanted.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).collect() for b in range(blocks))
        return reduce(DataFrame.unionByName, [self._nearest(part, k, probes, digits) for part in parts])

    def _nearest(self, wanted: list, k: int, probes: int, digits: int) -> DataFrame:
        spark = self.codes.sparkSession
        names = np.array([q["query_id"] for q in wanted], np.int64)
        matrix = np.array([q["vector"] for q in wanted], np.float64).reshape(len(wanted), self.directions.shape[2])
        asked = [(int(n), t, c) for n, q in zip(names, matrix, strict=True) for t, c in self.probes(q, probes)]
        # At most BLOCK_QUERIES * tables * probes rows.
        asked = spark.createDataFrame(asked, "query_id bigint, table int, code int")
        found = self.codes.join(F.broadcast(asked), ["table", "code"]).select("id", "query_id")
        found = materialise(found.groupBy("id").agg(F.collect_set("query_id").alias("queries")), "candidates")
        matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)

        at = np.argsort(names)

        def best(batches):
            query, ids, cosine = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            for batch in batches:
                rows = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
                lists = batch.column("queries")
                row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                asks = at[np.searchsorted(names, lists.flatten().to_numpy(), sorter=at)]
                own = np.einsum("ij,ij->i", rows[row], matrix[asks]) / np.linalg.norm(rows, axis=1)[row]
                query, ids = np.concatenate((query, asks)), np.concatenate((ids, batch.column("id").to_numpy()[row]))
                cosine = np.concatenate((cosine, np.round(own, digits)))
                order = np.lexsort((ids, -cosine, query))
                query, ids, cosine = query[order], ids[order], cosine[order]
                near = np.arange(len(query)) - np.searchsorted(query, query) < k
                query, ids, cosine = query[near], ids[near], cosine[near]
            columns = [pa.array(names[query]), pa.array(ids), pa.array(cosine)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "id", "cosine"])

        local = lookup_join(self.vectors, found, "id", "id").mapInArrow(best, "query_id bigint, id bigint, cosine double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "id"))
        return local.withColumn("rank", rank).filter(F.col("rank") <= k)
