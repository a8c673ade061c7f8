"""Exact top-k search by inner product over norm-sorted, rotated vectors.

1. Components become integers; all scores are exact integer inner products.
2. The second-moment matrix (``d * d`` numbers, summed by Spark) gives an orthogonal rotation that puts
   most of every inner product into the first coordinates.
3. Vectors are range-partitioned by descending length into parts of about ``part_rows``.
4. A seed of the ``seed_rows`` longest vectors (a fixed, small broadcast) gives each query a first threshold.
5. Each block of queries visits the parts whose longest vector can still reach its lowest threshold
   (Cauchy-Schwarz; lengths are compared on a grid of ``STEPS`` levels an octave, so what the driver knows of the parts
   does not grow with them).  At most ``VISITS`` blocks meet in a task; a part with more visitors is copied.  Inside a part,
   vectors come in blocks of descending length; a block whose length bound is below a query's threshold is skipped for it, a
   partial sum over the first rotated coordinates plus the bound on the rest prunes single vectors, and the remaining ones
   are scored exactly.
6. Each part returns at most k rows for each query; a window keeps the k best.

Bounds are widened by far more than rounding can move them, so pruning never loses a tie.

Very long vectors (a component of at least ``2**30`` or a length of at least ``2**30`` as integers) have scores that 64
bits cannot hold.  Every pair with one of them is searched in blocks beside the pruned search: scaled double products
with an error bound choose the candidates, unlimited integers score them, and the window orders both kinds by their
exact value.  A returned score beyond a long is the nearest long; its rank is that of the exact value.

Rows whose vector is null or holds a null or non-finite component, and rows with a null id, take no part.  A
missing component of a shorter vector counts as 0.  Rows that repeat are rows of their own: each is a candidate
for the other, and each asks its own query if its id is one.  An empty table gives no row.  Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklight.llm.common import pack, shuffle_partitions, tidied, unpack
from ranklight.sources.scratch import materialize

SCALE = 1024
PART_ROWS = 32_768
QUERY_BLOCK = 512
VECTOR_BLOCK = 2048
SEED_ROWS = 1024
STEPS = 64
VISITS = 64
LARGE = float(1 << 30)   # component or length of a very long vector
EXACT = float(1 << 52)   # sums beyond this are not exact in double precision
LONG = (1 << 63) - 1


def _matrix(column, dim: int) -> np.ndarray:
    """Lists as rows of a matrix, short ones filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dim), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``row, id, v, e, n2``: usable rows, their integer components and squared lengths; ``row`` is unique.  Very long vectors
    keep their own components ``e`` instead and have an infinite ``n2``."""
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("e"))
    own = own.filter(F.col("id").isNotNull() & F.col("e").isNotNull()).filter(~F.exists(
        "e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    big = F.col("n2") >= LARGE * LARGE
    own = own.select(F.monotonically_increasing_id().alias("row"), "id", "e", F.aggregate(
        "e", F.lit(0.0), lambda a, x: a + F.pow(F.greatest(F.abs(x) * F.lit(float(scale)), F.lit(0.0)), 2.0)).alias("n2"))
    v = F.transform("e", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    n2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    own = own.select("row", "id", F.when(~big, v).alias("v"), F.when(big, F.col("e")).alias("e"))
    return own.withColumn("n2", F.when(F.col("v").isNotNull(), n2).otherwise(F.lit(float("inf"))))


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal columns, the directions of the largest second moments first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            x = _matrix(b.column(0), dim).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], ["i", "v"])

    got = vectors.select("v").mapInArrow(tidied(run), "i long, v double").groupBy("i").agg(F.sum("v")).collect()
    flat = np.zeros(dim * dim)
    for i, v in got:
        flat[i] = v
    return np.linalg.svd(flat.reshape(dim, dim))[0]


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, -np.inf)
        self.query = self.score = self.id = np.zeros(0, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q = np.concatenate((self.query, query))
        s, i = np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, int)
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        keep = place < self.k
        self.query, self.score, self.id = q[keep], s[keep], i[keep]
        full = place[keep] == self.k - 1
        self.floor[self.query[full]] = np.maximum(self.floor[self.query[full]], self.score[full])


def search_part(q: dict, v: dict, turn: np.ndarray, lead: int, k: int) -> Best:
    """``q``/``v``: arrays ``row, id, v, length`` (``v`` by descending length); ``q`` has ``floor`` too."""
    best = Best(len(q["id"]), k)
    best.floor = q["floor"].astype(float).copy()
    qr = q["v"] @ turn
    q_lead, q_rest = qr[:, :lead], np.sqrt((qr[:, lead:] ** 2).sum(axis=1))
    exact = q["v"].astype(float)
    for at in range(0, len(v["id"]), VECTOR_BLOCK):
        to = slice(at, at + VECTOR_BLOCK)
        slack = 1.0 + 1e-6 * q["length"] * v["length"][at]
        live = np.flatnonzero(q["length"] * v["length"][at] + slack >= best.floor)
        if not len(live):
            break  # later vectors are shorter still
        block = v["v"][to].astype(float)
        vr = block @ turn
        rest = np.sqrt((vr[:, lead:] ** 2).sum(axis=1))
        bound = q_lead[live] @ vr[:, :lead].T + np.outer(q_rest[live], rest) + slack[live, None]
        hit, who = np.nonzero((bound >= best.floor[live, None]) & (q["row"][live, None] != v["row"][to][None, :]))
        if not len(hit):
            continue
        if len(hit) > 0.2 * bound.size and q["length"][live].max() * v["length"][at] < EXACT:
            score = (exact[live] @ block.T)[hit, who].astype(np.int64)  # whole numbers below 2**52: exact
        else:
            score = np.concatenate([np.einsum("ij,ij->i", q["v"][live[hit[i:i + 65536]]], v["v"][to][who[i:i + 65536]])
                                    for i in range(0, len(hit), 65536)])
        best.add(live[hit], score, v["id"][to][who])
    return best


def _arrays(blob: bytes, dim: int) -> dict:
    t = unpack([blob])
    out = {c: t.column(c).to_numpy() for c in t.column_names if c != "v"}
    return out | {"v": _matrix(t.column("v"), dim)}


RESULT = "query_id long, rank int, vec_id long, score long"
HITS = "query long, query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, lead: int | None = None, part_rows: int = PART_ROWS, seed_rows: int = SEED_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``: the k other rows with
    the highest integer inner products, ties to the smaller id."""
    spark = vectors.sparkSession
    own = materialize(integer_vectors(vectors, id_col, vec_col, scale), "topk-vectors")
    total, n, dim = own.agg(F.count(F.lit(1)), F.count("v"), F.max(F.when(F.col("v").isNotNull(), F.size("v")))).first()
    if not total:
        return spark.createDataFrame([], RESULT)
    small = own.filter("v is not null").drop("e")
    hits = _pruned(small, n, max(1, dim or 1), k, every, lead, part_rows, seed_rows) if n else spark.createDataFrame([], HITS)
    score = F.col("score").cast("string")
    if total > n:
        hits = hits.withColumn("place", _sortable(score)).unionAll(_wide(own, k, every, scale))
        order = [F.col("place").desc(), F.col("vec_id")]
    else:
        order = [F.col("score").desc(), F.col("vec_id")]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pruned(own: DataFrame, n: int, dim: int, k: int, every: int, lead: int | None, part_rows: int, seed_rows: int) -> DataFrame:
    """At least the k best hits of each query among vectors of ordinary length."""
    spark = own.sparkSession
    lead = lead or max(1, dim // 4)
    turn = rotation(own, dim)
    parts = max(1, -(-n // part_rows))
    order = [F.col("n2").desc(), F.col("row")]
    ranged = own.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def blocks(rows: int, columns: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seq = 0
            for b in batches:
                for at in range(0, b.num_rows, rows):
                    part = b.slice(at, rows)
                    n2 = part.column("n2").to_numpy()
                    data = {c: part.column(c) for c in columns} | {"length": pa.array(np.sqrt(n2))}
                    yield pa.RecordBatch.from_arrays(
                        [part.column("part").slice(0, 1), pa.array([seq]), pa.array([float(np.sqrt(n2.max()))]),
                         pa.array([pack(data)], pa.binary())], ["part", "seq", "length", "blob"])
                    seq += 1
        return run

    schema = "part int, seq long, length double, blob binary"
    held = materialize(ranged.mapInArrow(tidied(blocks(4 * VECTOR_BLOCK, ["row", "id", "v"])), schema), "topk-parts")
    reach = held.groupBy("part").agg(F.max("length").alias("reach"))
    level = F.floor(F.log2(F.greatest("reach", F.lit(1e-9))) * STEPS)
    levels = np.array(sorted(map(tuple, reach.groupBy(level.alias("level")).count().collect()), reverse=True), np.int64)
    known = -levels[:, 0], np.cumsum(levels[:, 1])  # how many parts reach a level: at most some thousand numbers
    seed_blob = own.orderBy(*order).limit(seed_rows).withColumn("part", F.lit(0)).coalesce(1).sortWithinPartitions(
        *order).mapInArrow(tidied(blocks(seed_rows, ["row", "id", "v"])), schema).select("blob").first()[0]
    shared = spark.sparkContext.broadcast((turn, seed_blob, known))

    def first_floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, seed, (falling, reached) = shared.value
        seed = _arrays(seed, dim)
        for b in batches:
            for at in range(0, b.num_rows, QUERY_BLOCK):
                part = b.slice(at, QUERY_BLOCK)
                q = {"row": part.column("row").to_numpy(), "id": part.column("id").to_numpy(),
                     "v": _matrix(part.column("v"), dim), "length": np.sqrt(part.column("n2").to_numpy())}
                q["floor"] = np.full(len(q["id"]), -np.inf)
                floor = search_part(q, seed, turn, lead, k).floor
                blob = pack({"row": part.column("row"), "id": part.column("id"), "v": part.column("v"),
                             "length": pa.array(q["length"]), "floor": pa.array(floor)})
                # a part can matter only if its longest vector reaches the floor of some query of the block
                need = np.where(q["length"] > 0, (floor - 2.0) / np.maximum(q["length"], 1e-9) * (1 - 1e-6), -np.inf)
                need = np.where((floor <= 2.0), -np.inf, need)
                least = math.floor(math.log2(max(float(need.min()), 1e-9)) * STEPS)
                at_least = int(np.searchsorted(falling, -least, side="right"))
                visits = int(reached[at_least - 1]) if at_least else 0
                yield pa.RecordBatch.from_arrays([pa.array([visits]), pa.array([blob], pa.binary())], ["visits", "blob"])

    asked = own.filter(F.col("id") % every == 0)
    queries = materialize(asked.mapInArrow(tidied(first_floor), "visits long, blob binary"), "topk-queries")
    # a block of queries goes to every part in its reach; the visitors of a part are dealt to copies of it
    groups = max(1, -(-queries.count() // VISITS))
    visits = queries.filter("visits > 0").select(
        F.explode(F.sequence(F.lit(0), F.col("visits").cast("int") - 1)).alias("part"),
        F.pmod(F.xxhash64("blob"), F.lit(groups)).alias("copy"), "blob")
    copies = visits.select("part", "copy").distinct()
    both = held.join(copies, "part").select("part", "copy", F.lit(1).alias("kind"), "seq", "blob").unionAll(
        visits.select("part", "copy", F.lit(2).alias("kind"), F.lit(0).cast("long").alias("seq"), "blob"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, at, v, loaded = shared.value[0], None, None, []
        for b in batches:
            for part, copy, kind, blob in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if (part, copy) != at:
                    at, v, loaded = (part, copy), None, []
                if kind == 1:
                    loaded.append(_arrays(blob, dim))
                    continue
                if v is None:
                    v = {c: np.concatenate([x[c] for x in loaded]) for c in loaded[0]}
                q = _arrays(blob, dim)
                best = search_part(q, v, turn, lead, k)
                yield pa.RecordBatch.from_arrays([pa.array(q["row"][best.query]), pa.array(q["id"][best.query]),
                                                  pa.array(best.id), pa.array(best.score)],
                                                 ["query", "query_id", "vec_id", "score"])

    return (both.repartition(max(parts, shuffle_partitions(spark)), "part", "copy").sortWithinPartitions("part", "copy", "kind", "seq")
            .mapInArrow(tidied(run), HITS))


# ---- very long vectors ----------------------------------------------------------------------------------------

def _sortable(digits):
    """Whole numbers as strings that sort like them: sign, number of digits, digits (complements below zero)."""
    body = F.ltrim(digits, F.lit("-"))
    size = F.length(body)
    return F.when(digits.startswith("-"), F.concat(F.lit("0"), F.lpad((9999 - size).cast("string"), 4, "0"), F.translate(
        body, "0123456789", "9876543210"))).otherwise(F.concat(F.lit("1"), F.lpad(size.cast("string"), 4, "0"), body))


def whole(x: float, scale: int) -> int:
    """``floor(scale * x)`` for a power of two, without overflow."""
    return math.floor(x * scale) if abs(x) < 2.0 ** 60 else int(x) * scale


class WideBlock:
    """Vectors of any length: exact integers, and scaled doubles ``w * 2**s``."""

    def __init__(self, rows: list[int], ids: list[int], small: list, large: list, scale: int):
        self.row, self.id = np.array(rows, np.int64), np.array(ids, np.int64)
        self.exact = [v if v is not None else [whole(x, scale) for x in e] for v, e in zip(small, large)]
        dim = max(map(len, self.exact), default=0)
        mantissa, power = np.zeros((len(rows), dim)), np.full((len(rows), dim), -1 << 20)
        for i, v in enumerate(self.exact):
            for j, x in enumerate(v):
                if x:
                    shift = max(0, x.bit_length() - 60)
                    m, e = math.frexp(x >> shift)
                    mantissa[i, j], power[i, j] = m, e + shift
        self.s = power.max(axis=1, initial=-1 << 20)
        self.w = np.ldexp(mantissa, np.maximum(power - self.s[:, None], -2000))
        self.norm = np.sqrt((self.w ** 2).sum(axis=1))

    def product(self, i: int, other: "WideBlock", j: int) -> int:
        return sum(a * b for a, b in zip(self.exact[i], other.exact[j]))


def wide_best(q: WideBlock, v: WideBlock, k: int) -> list[tuple[int, int, int]]:
    """For each query its k best of the block, ties to the smaller id: ``(query, vector, exact score)``."""
    dim = min(q.w.shape[1], v.w.shape[1])
    top = max(0, int(v.s.max(initial=0)))
    weight = np.ldexp(1.0, np.maximum(v.s - top, -1060))
    value = (q.w[:, :dim] @ v.w[:, :dim].T) * weight
    slack = np.outer(q.norm, v.norm * weight) * 1e-9 + 1e-300
    value[q.row[:, None] == v.row[None, :]] = -np.inf
    out = []
    for i in range(len(q.row)):
        low = np.sort(value[i] - slack[i])[::-1]
        floor = low[k - 1] if len(low) >= k else -np.inf
        near = [j for j in np.flatnonzero(value[i] + slack[i] >= floor).tolist() if q.row[i] != v.row[j]]
        exact = sorted((-q.product(i, v, j), int(v.id[j]), j) for j in near)[:k]
        out += [(i, j, -s) for s, _, j in exact]
    return out


def _wide(own: DataFrame, k: int, every: int, scale: int) -> DataFrame:
    """At least the k best hits of each query among the pairs that hold a very long vector: blocks of queries meet blocks of such
    vectors, and blocks of very long queries meet blocks of the others."""
    spark = own.sparkSession

    def blocks(rows: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, rows):
                    yield pa.RecordBatch.from_arrays([pa.array([pack({c: b.column(c).slice(at, rows) for c in b.schema.names})], pa.binary())], ["blob"])
        return run

    def dealt(df: DataFrame, name: str, rows: int) -> tuple[DataFrame, int]:
        """Packed blocks, dealt to groups of about ``VISITS``."""
        packed = materialize(df.select("row", "id", "v", "e").mapInArrow(tidied(blocks(rows)), "blob binary"), name)
        groups = max(1, -(-packed.count() // VISITS))
        return packed.withColumn("own", F.pmod(F.xxhash64("blob"), F.lit(groups)).cast("int")), groups

    def each(groups: int):
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    long, asked = F.col("v").isNull(), F.col("id") % every == 0
    found = None
    for name, left, right in (("all-queries", asked, long), ("long-queries", asked & long, ~long)):
        q, q_groups = dealt(own.filter(left), f"topk-wide-{name}", 256)
        v, v_groups = dealt(own.filter(right), f"topk-wide-{name}-vectors", 1024)
        both = q.select(F.col("own").alias("q"), each(v_groups).alias("v"), F.lit(0).alias("kind"), "blob").unionAll(
            v.select(each(q_groups).alias("q"), F.col("own").alias("v"), F.lit(1).alias("kind"), "blob"))
        # a task holds a group of query blocks, packed, while a group of vector blocks passes
        hits = both.repartition(shuffle_partitions(spark), "q", "v").sortWithinPartitions("q", "v", "kind").mapInArrow(
            tidied(_meet(k, scale)), HITS + ", digits string")
        found = hits if found is None else found.unionAll(hits)
    return found.withColumn("place", _sortable(F.col("digits"))).drop("digits")


def _meet(k: int, scale: int):
    def load(blob: bytes) -> WideBlock:
        t = unpack([blob])
        return WideBlock(*(t.column(c).to_pylist() for c in ("row", "id", "v", "e")), scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, queries = None, []
        for b in batches:
            for own, of, kind, blob in zip(*(c.to_pylist() for c in b.columns)):
                if (own, of) != at:
                    at, queries = (own, of), []
                if kind == 0:
                    queries.append(blob)
                    continue
                v = load(blob)
                for packed in queries:
                    q = load(packed)
                    best = wide_best(q, v, k)
                    i, j, s = zip(*best) if best else ((), (), ())
                    i, j = np.array(i, np.int64), np.array(j, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q.row[i]), pa.array(q.id[i]), pa.array(v.id[j]),
                         pa.array([max(-LONG - 1, min(LONG, x)) for x in s], pa.int64()), pa.array(map(str, s), pa.string())],
                        ["query", "query_id", "vec_id", "score", "digits"])
    return run


#: DuckDB twin of ``top_k(embeddings, 10, 100)``.
ORACLE = """
WITH own AS (SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
             WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
          FROM own q JOIN own c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
