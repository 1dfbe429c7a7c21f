"""Exact top-k search by inner product over norm buckets.

Candidates are dealt to buckets by length, longest first. A query's k-th best score over the longest bucket is a bound that holds
everywhere. With it, each slice of a bucket has a local threshold: the cosine that a candidate of that length needs. A
threshold over one prunes the slice by length alone; a high one prunes candidates by the query's largest coordinates; else all
are compared. What remains is verified by exact integer products. Before any vector moves, blocks of queries are held against the buckets'
greatest lengths: a block goes only to buckets that can hold a candidate for one of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clonespark.scratch import Scratch

#: Candidates of a bucket, of a slice of it, and queries of a block.
BUCKET_ROWS, SLICE_ROWS, BLOCK_QUERIES = 16_384, 1_024, 1_024
#: Blocks of queries that are held against a bucket in one task.
BLOCKS_A_TASK = 16
#: From this local cosine threshold on, coordinates prune enough to pay; so many of the largest are looked at.
COORDINATE_FROM, FOCUS = 0.8, 3
#: Relative slack for rounding in bounds; products themselves are exact.
SLACK = 1e-9
PACKED = "bucket int, piece int, top double, n int, dim int, ids binary, vectors binary"


def quantised(column: str, scale: float) -> Column:
    """floor(scale * x) of each component as bigint; null if the vector is null or holds null or non-finite components."""
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(x.isNotNull() & ~bad, F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double"))))


def _numbers(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; shorter vectors are padded with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(1))


def _pack(bucket: int, piece: int, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    small = rows.size == 0 or np.abs(rows).max() < 1 << 15
    kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    values = [bucket, piece, float(norms(rows).max(initial=0)), len(ids), rows.shape[1], ids.astype(np.int64).tobytes(), rows.astype(np.int16 if small else np.int64).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["bucket", "piece", "top", "n", "dim", "ids", "vectors"])


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    n, dim, raw = row["n"], row["dim"], row["vectors"]
    kind = np.int64 if n * dim and len(raw) == 8 * n * dim else np.int16
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(raw, kind).reshape(n, dim).astype(np.int64)


def _packed(limit: int):
    """Rows (bucket, vec_id, vector) of a partition as packed rows of at most `limit` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists, bucket, piece = [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, limit):
                part = batch.slice(at, limit)
                bucket = part.column(0)[0].as_py()
                ids.append(part.column(1).to_numpy())
                lists.append(part.column(2))
                while sum(map(len, ids)) >= limit:
                    i, rows = np.concatenate(ids), _numbers(pa.concat_arrays(lists))
                    yield _pack(bucket, piece, i[:limit], rows[:limit])
                    piece += 1
                    ids, lists = [i[limit:]], [pa.concat_arrays(lists).slice(limit)]
        if sum(map(len, ids)):
            yield _pack(bucket, piece, np.concatenate(ids), _numbers(pa.concat_arrays(lists)))

    return run


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; those out of a long's range saturate."""
    d = min(q.shape[1], c.shape[1])
    q, c = q[:, :d], c[:, :d]
    most = lambda x: int(np.abs(x).max(initial=0))
    if d * most(q) * most(c) < 1 << 53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    exact = q.astype(object) @ c.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def pairwise(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner product of each row of q with the same row of c."""
    d = min(q.shape[1], c.shape[1])
    if d * int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) < 1 << 62:
        return np.einsum("ij,ij->i", q[:, :d], c[:, :d])
    return np.array([max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b)))) for a, b in zip(q[:, :d].tolist(), c[:, :d].tolist())], np.int64)


class Best:
    """The k best of each query so far: score, then smaller id."""

    def __init__(self, n: int, k: int, bound: np.ndarray) -> None:
        self.k, self.n, self.bound = k, n, bound
        self.query, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        keep = score >= self.bound[query]
        if not keep.any():
            return
        query, ids, score = (np.concatenate(x) for x in zip((self.query, self.id, self.score), (query[keep], ids[keep], score[keep])))
        order = np.lexsort((ids, -score.astype(np.float64), query)) if np.abs(score).max() < 1 << 53 else np.array(sorted(range(len(score)), key=lambda i: (query[i], -int(score[i]), ids[i])))
        query, ids, score = query[order], ids[order], score[order]
        first = np.searchsorted(query, query)
        place = np.arange(len(query)) - first
        top = place < self.k
        self.query, self.id, self.score = query[top], ids[top], score[top]
        full = place[top] == self.k - 1
        np.maximum.at(self.bound, self.query[full], self.score[full])


def search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, bound: np.ndarray, k: int) -> Best:
    """The k best candidates (of a bucket, longest first) of each query, if their scores reach the query's bound."""
    best = Best(len(q), k, bound)
    q_len, c_len = norms(q), norms(c)
    q_unit = q / np.maximum(q_len, 1e-300)[:, None]
    focus = np.argsort(-np.abs(q_unit), axis=1, kind="stable")[:, :FOCUS]
    for at in range(0, len(c), SLICE_ROWS):
        part = slice(at, at + SLICE_ROWS)
        rows, ids, lengths = c[part], c_ids[part], c_len[part]
        with np.errstate(invalid="ignore", divide="ignore"):
            need = np.where(best.bound <= 0, -1.0, best.bound / (q_len * lengths.max(initial=0))) * (1 - SLACK)
        live = ~(need > 1)  # length pruning
        sharp = np.flatnonzero(live & (need >= COORDINATE_FROM))
        plain = np.flatnonzero(live & ~(need >= COORDINATE_FROM))
        if len(plain):
            scores = products(q[plain], rows)
            scores = np.where(ids[None, :] == q_ids[plain][:, None], np.iinfo(np.int64).min, scores)
            floor = best.bound[plain]
            if len(rows) > k:
                floor = np.maximum(floor, np.partition(scores, len(rows) - k, axis=1)[:, len(rows) - k])
            i, j = np.nonzero((scores >= floor[:, None]) & (ids[None, :] != q_ids[plain][:, None]))
            best.add(plain[i], ids[j], scores[i, j])
        if len(sharp):
            unit = rows / np.maximum(lengths, 1e-300)[:, None]
            if unit.shape[1] < q.shape[1]:
                unit = np.hstack((unit, np.zeros((len(unit), q.shape[1] - unit.shape[1]))))
            t = np.minimum(need[sharp], 1.0)
            keep = np.ones((len(sharp), len(rows)), bool)
            for f in range(focus.shape[1]):  # where a unit vector with that cosine can lie on this coordinate
                x = q_unit[sharp, focus[sharp, f]]
                spread = np.sqrt(np.maximum((1 - t * t) * (1 - x * x), 0)) + 1e-7
                value = unit[:, focus[sharp, f]].T
                keep &= (value >= np.where(x <= -t, -2, x * t - spread)[:, None]) & (value <= np.where(x >= t, 2, x * t + spread)[:, None])
            i, j = np.nonzero(keep & (ids[None, :] != q_ids[sharp][:, None]))
            best.add(sharp[i], ids[j], pairwise(q[sharp[i]], rows[j]))
    return best


NONE = np.iinfo(np.int64).min


def needed(bound: np.ndarray, lengths: np.ndarray) -> float:
    """The length that a candidate must have for one of the queries at least; zero if any would do."""
    if not len(bound) or (bound <= 0).any():
        return 0.0
    return float((bound / np.maximum(lengths, 1e-300)).min() * (1 - SLACK))


def _first(longest: dict | None, k: int):
    """Query blocks against the longest bucket: the blocks with each query's bound and the length that it needs, and its best as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (q_ids, q), (c_ids, c) = _unpack({x: row[f"q_{x}"] for x in ("n", "dim", "ids", "vectors")}), _unpack(longest)
                best = search(q_ids, q, c_ids, c, np.full(len(q), NONE), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["q_n"]], pa.int32()), pa.array([row["q_dim"]], pa.int32()), pa.array([needed(best.bound, norms(q))]), *(pa.array([x], pa.binary()) for x in (row["q_ids"], row["q_vectors"], best.bound.tobytes(), best.query.tobytes(), best.id.tobytes(), best.score.tobytes()))],
                    names=["q_n", "q_dim", "q_need", "q_ids", "q_vectors", "q_bound", "best_query", "best_id", "best_score"],
                )

    return run


def _rest(k: int):
    """Query blocks beside a further bucket: scores that reach the queries' bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (q_ids, q), (c_ids, c) = _unpack({x: row[f"q_{x}"] for x in ("n", "dim", "ids", "vectors")}), _unpack(row)
                best = search(q_ids, q, c_ids, c, np.frombuffer(row["q_bound"], np.int64).copy(), k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[best.query]), pa.array(best.id), pa.array(best.score)], names=["query_id", "vec_id", "score"])

    return run


def reached(first: DataFrame, buckets: DataFrame) -> DataFrame:
    """first with a row for each bucket that its block must still be held against. Greatest lengths fall with the bucket's number, so that is a range of them.

    The driver gets a number for each bucket, one of BUCKET_ROWS vectors.
    """
    tops = sorted((r["bucket"], r["top"]) for r in buckets.groupBy("bucket").agg(F.max("top").alias("top")).collect())
    if not tops:
        return first.withColumn("bucket", F.lit(0)).limit(0)
    numbers, lengths = np.array([b for b, _ in tops], np.int32), np.minimum.accumulate([t for _, t in tops])

    def run(needs: pa.Array) -> pa.Array:
        count = np.searchsorted(-lengths, -needs.to_numpy(zero_copy_only=False), side="right")
        ends = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers[np.arange(ends[-1]) - np.repeat(ends[:-1], count)]))

    run.__annotations__ = {"needs": pa.Array, "return": pa.Array}
    return first.withColumn("bucket", F.explode(F.arrow_udf(run, "array<int>")("q_need")))


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, (q, i, s) = np.frombuffer(row["q_ids"], np.int64), (np.frombuffer(row[x], np.int64) for x in ("best_query", "best_id", "best_score"))
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(i), pa.array(s)], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: float = 256.0) -> DataFrame:
    """Each query's k highest integer inner products with all other rows, exactly.

    Components x become floor(scale * x). Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id; fewer
    than k rows if there are fewer candidates. is_query chooses the queries, all rows are candidates but those of the query's own
    id. Rows with a null id, and vectors that are null or hold null or non-finite components, take no part. A shorter vector
    counts as padded with zeros. Repeated rows are candidates each; a query given twice with the same vector answers
    once. Components and scores out of a long's range saturate. Other columns are ignored; an empty table gives an
    empty result.
    """
    scratch = Scratch(vectors.sparkSession)
    clean = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), quantised(vector_col, scale).alias("v"), is_query.alias("q")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    counts = clean.agg(F.count("*").alias("n"), F.count(F.when(F.col("q"), 1)).alias("q")).first()
    n_buckets, n_blocks = -(-max(counts["n"], 1) // BUCKET_ROWS), -(-max(counts["q"], 1) // BLOCK_QUERIES)
    # Equal lengths may be split between buckets: the id decides.
    dealt = clean.select("vec_id", "v", norm.alias("norm")).repartitionByRange(n_buckets, F.col("norm").desc(), "vec_id").sortWithinPartitions(F.col("norm").desc(), "vec_id")
    buckets = scratch.save(dealt.select(F.spark_partition_id().alias("bucket"), "vec_id", "v").mapInArrow(_packed(2 * BUCKET_ROWS), PACKED))
    wanted = clean.filter("q").select("vec_id", "v").distinct().repartition(n_blocks, "vec_id")
    blocks = wanted.select(F.lit(0).alias("bucket"), "vec_id", "v").mapInArrow(_packed(BLOCK_QUERIES), PACKED).drop("bucket", "piece", "top")
    blocks = blocks.select(*(F.col(x).alias(f"q_{x}") for x in blocks.columns))
    low = buckets.agg(F.min("bucket")).first()[0] or 0
    longest = buckets.filter((F.col("bucket") == low) & (F.col("piece") == 0)).first()  # one row of at most 2 * BUCKET_ROWS vectors goes to all tasks
    first = scratch.save(blocks.mapInArrow(_first(longest and longest.asDict(), k), "q_n int, q_dim int, q_need double, q_ids binary, q_vectors binary, q_bound binary, best_query binary, best_id binary, best_score binary").withColumn("q_number", F.spark_partition_id()))
    pairs = "query_id bigint, vec_id bigint, score bigint"
    others = buckets.filter((F.col("bucket") != low) | (F.col("piece") != 0))
    spread = reached(first.select("q_n", "q_dim", "q_need", "q_ids", "q_vectors", "q_bound", "q_number"), others)
    # The first buckets get every block of queries: a bucket goes to as many tasks as hold BLOCKS_A_TASK of its blocks each.
    met = spread.groupBy("bucket").agg(F.max(F.ceil((F.col("q_number") + 1) / BLOCKS_A_TASK)).cast("int").alias("_salts"))
    dealt = others.drop("top").join(met, "bucket").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    salted = spread.withColumn("_salt", F.floor(F.col("q_number") / BLOCKS_A_TASK).cast("int"))
    rest = salted.join(dealt, ["bucket", "_salt"]).mapInArrow(_rest(k), pairs)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    every = first.select("q_ids", "best_query", "best_id", "best_score").mapInArrow(_unfold, pairs).unionAll(rest)
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
