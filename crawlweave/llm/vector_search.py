"""Operator 6: nearest vectors by inner product, with an adaptive dimension scan over probed lists.

Index: vectors are parted by norm (a part's norms differ by a factor of
``NORM_FACTOR`` at most) and divided by their part's largest norm; every
vector gets one more component, so that all have norm 1 and the largest inner
product within a part is the smallest distance.  It is turned by a
random rotation, assigned to the nearest centroid's list of its part, and scanned in
column blocks of ``COLUMN_BLOCK`` dimensions.  Centroids are fitted on a
bounded sample (about ``FIT_ROWS`` vectors, chosen by id hash);
every vector is indexed.

Search: a query probes the nearest ``PROBE_SHARE`` of every part's lists.  Within
them a candidate's distance is summed in double precision column block by column block; after
each, a hypothesis test compares the distance estimated from the dimensions
seen so far with the query's current worst hit and abandons the candidate
when it is significantly farther (the rotation makes every prefix of the
dimensions a random projection).  The nearest, and all that rounding cannot tell
from the last of them, are then scored in double precision on the original
vectors; these scores choose and merge the hits of blocks and parts.

Work is cut into blocks of bounded size: lists are packed into blocks of candidates of at
most ``MOST_ROWS`` rows and ``BLOCK_BYTES`` of doubles (a large list is split by hash), and every block is
written to a folder of its own once.  Only queries are shuffled, one copy to each block
that holds a list they probe; a block with many queries has several tasks.  A
task reads its block and scans it for its queries, chunk by chunk.  Equal
vectors are one class with its smallest distinct ids: no query can use more of them
than its number of hits and itself.

Hits are ids: repeated rows count once, and an id with several vectors counts
once with its best score, as query and as hit.  Of classes with the same ids only
the best is kept for a query, so that an id with any number of vectors of its own
takes one place; (as many times more classes are kept as an id is in different
sets of ids at most, so that they cannot crowd out other ids).

Null and zero vectors, vectors with null or non-finite components, and
vectors of another length than the most common one take no part.  Ties go to
the smaller id.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.llm.common import prepare
from crawlweave.session import filesystem_for, scratch_dir

HITS = 20
#: Vectors on which centroids are fitted (expected: their id hash lies below a share).
FIT_ROWS = 16_384
FIT_ROUNDS = 8
MAX_LISTS = 1024
#: Share of the lists that a query probes.  Vectors without clusters need a
#: large one: measured recall is in README.md.
PROBE_SHARE = 0.8
#: Dimensions of a column block.
COLUMN_BLOCK = 16
#: How far beyond the worst hit an estimate must lie: a distance estimated
#: from d dimensions counts as too far above (1 + SIGNIFICANCE / sqrt(d)) times it.
SIGNIFICANCE = 1.5
#: Blocks a table is cut into, and the bounds of a block's rows and of its vectors as doubles.
BLOCKS, LEAST_ROWS, MOST_ROWS = 16, 256, 65_536
BLOCK_BYTES = 64 << 20
#: The largest norm of a part is at most so many times its smallest.
NORM_FACTOR = 4.0
#: Queries scanned at once, and those a task has for its block.
CHUNK_QUERIES = 1024
TASK_QUERIES = 16_384
#: Hits kept per query and block beyond those asked for.
MARGIN = 12
#: Rounding of a distance between vectors of norm 1, a dimension (several times what doubles can err).
ROUNDING = 32 * 2.0 ** -52
SEED = 20


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_classes(df: DataFrame, id_col: str, vector_col: str, most_ids: int) -> DataFrame:
    """``vec``, ``rep`` (smallest id), ``ids`` (the ``most_ids`` smallest), ``log_norm`` of each distinct vector.

    The rank filter keeps ``most_ids`` rows of a vector per task before the shuffle.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    rows = rows.filter(usable(F.col("vec")) & F.col("id").isNotNull())
    sizes = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = sizes[0].dim if sizes else 0
    # a repeated row is one row
    rows = rows.filter(F.size("vec") == dim).distinct()
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    return (rows.withColumn("rank", rank).filter(F.col("rank") <= most_ids)
            .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .select(F.element_at("ids", 1).alias("rep"), "ids", "vec", log_norm(F.col("vec")).alias("log_norm")))


def fit_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Lloyd's rounds from a seeded start; an empty list keeps its centroid."""
    rng = np.random.default_rng(SEED)
    centroids = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(FIT_ROUNDS):
        near = nearest_lists(sample, centroids, 1)[:, 0]
        counts = np.bincount(near, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centroids


def nearest_lists(vectors: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    far = (centroids ** 2).sum(1)[None, :] - 2 * vectors @ centroids.T
    return np.argsort(far, axis=1, kind="stable")[:, :n]


def log_norm(vector: Column) -> Column:
    """The binary logarithm of the norm; the largest component is taken out, so that no square overflows."""
    big = F.array_max(F.transform(vector, F.abs))
    squares = F.zip_with(vector, F.array_repeat(big, F.size(vector)), lambda x, m: (x / m) * (x / m))
    return F.log2(big) + F.log2(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)) / 2


def _divided(vectors: np.ndarray, log_norms: np.ndarray) -> np.ndarray:
    """Rows divided by 2 to the power of ``log_norms``, in two steps that neither overflow nor vanish."""
    whole = np.floor(log_norms).astype(np.int64)
    return np.ldexp(vectors, -whole[:, None]) / np.exp2(log_norms - whole)[:, None]


class Turn:
    """Norm 1, then a seeded random rotation."""

    def __init__(self, dim: int):
        rng = np.random.default_rng(SEED)
        q, r = np.linalg.qr(rng.standard_normal((dim + 1, dim + 1)))
        self.matrix = q * np.sign(np.diag(r))

    def points(self, vectors: np.ndarray, largest: np.ndarray) -> np.ndarray:
        """``largest``: the logarithm of the largest norm in each vector's part."""
        vectors = _divided(vectors, largest)
        rest = np.sqrt(np.maximum(0, 1 - (vectors ** 2).sum(1)))
        return np.hstack([vectors, rest[:, None]]) @ self.matrix

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        """The same norm for queries, so that distances have one scale; the order is not changed."""
        vectors = _divided(vectors, np.frexp(np.abs(vectors).max(1))[1].astype(float))
        vectors = vectors / np.sqrt((vectors ** 2).sum(1))[:, None]
        return np.hstack([vectors, np.zeros((len(vectors), 1))]) @ self.matrix


def _stack(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def inner_products(a: np.ndarray, b: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """``f(i, j)``: double-precision inner products of rows of ``a`` and ``b``, summed in the order of the components."""
    def f(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i))
        for x, y in zip(a.T, b.T, strict=True):
            out += x[i].astype(np.float64) * y[j]
        return out

    return f


def adaptive_scan(queries: np.ndarray, points: np.ndarray, allowed: np.ndarray, hits: int, tile: int = 1024,
                  score: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
                  names: np.ndarray | None = None,
                  groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of each query's nearest points among those allowed.

    ``allowed[q, p]`` says whether the query probes the point's list.  With
    ``score`` the last value is the score, and the largest scores, then the
    smallest ``names``, choose among the nearest points and those that
    rounding cannot tell from the last of them.  Of points in one of ``groups``
    only a query's best counts.
    """
    if groups is not None and len(np.unique(groups)) == len(groups):
        groups = None
    dims = points.shape[1]
    names = np.arange(len(points)) if names is None else names
    edges = [*range(0, dims - COLUMN_BLOCK + 1, COLUMN_BLOCK), dims] if dims > COLUMN_BLOCK else [0, dims]
    # distances are made relative to their scale by the norms of what is compared
    scale = float((queries ** 2).sum(1).max() + (points ** 2).sum(1).max()) if len(queries) and len(points) else 0.0
    slack = ROUNDING * (dims + 2) * scale
    best_d = np.full((len(queries), hits), np.inf)
    kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    for begin in range(0, len(points), tile):
        part = points[begin:begin + tile]
        alive = allowed[:, begin:begin + tile].copy()
        sums = np.zeros(alive.shape)
        worst = best_d[:, -1]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            q, p = queries[:, a:b], part[:, a:b]
            n = int(alive.sum())
            if not n:
                break
            if n * 4 > alive.size:  # most are alive: one product over the block of columns
                sums += (q ** 2).sum(1)[:, None] + (p ** 2).sum(1)[None, :] - 2 * (q @ p.T)
            else:
                qi, pi = np.nonzero(alive)
                sums[qi, pi] += ((q[qi] - p[pi]) ** 2).sum(1)
            if b < dims:
                bound = worst * (b / dims) * (1 + SIGNIFICANCE / math.sqrt(b)) ** 2
                alive &= sums <= bound[:, None]
            else:
                alive &= sums <= (worst + slack)[:, None]
        rows = np.flatnonzero(alive.any(axis=1))
        if not len(rows):
            continue
        some = np.where(alive[rows], sums[rows], np.inf)
        if groups is None:
            least = np.partition(some, hits - 1, axis=1)[:, :hits] if some.shape[1] > hits else some
            best_d[rows] = np.sort(np.hstack([best_d[rows], least]), axis=1)[:, :hits]
        qi, pi = np.nonzero(alive[rows] & (some <= best_d[rows, -1:] + slack))
        qi, far = rows[qi], some[qi, pi]
        value = far if score is None else -score(qi, pi + begin)
        qi, pi, value, far = (np.concatenate(x) for x in zip(kept, (qi, pi + begin, value, far), strict=True))
        order = np.lexsort((names[pi], value, qi))
        if groups is not None:  # the best of each group
            pairs = np.stack([qi[order], groups[pi[order]]], axis=1)
            order = order[np.sort(np.unique(pairs, axis=0, return_index=True)[1])]
        first = np.searchsorted(qi[order], np.arange(len(queries)))
        order = order[np.arange(len(order)) - first[qi[order]] < hits]
        kept = qi[order], pi[order], value[order], far[order]
        if groups is not None:  # the farthest that is kept, where there are enough
            full = np.bincount(kept[0], minlength=len(queries)) == hits
            farthest = np.zeros(len(queries))
            np.maximum.at(farthest, kept[0], kept[3])
            best_d[full, -1] = farthest[full]
    return kept[:3] if score is None else (kept[0], kept[1], -kept[2])


def search(df: DataFrame, queries: Column, hits: int = HITS, id_col: str = "vec_id", vector_col: str = "embedding",
           probe_share: float = PROBE_SHARE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's nearest other ids.

    ``queries`` is a condition on ``df``'s rows.
    """
    spark = prepare(df.sparkSession)
    folder = scratch_dir(spark, "vectors")
    # rows of ids and vectors, read twice below: the queries and all candidates
    asked = df.filter(queries)
    # an id with several vectors can be the smallest of several classes: a class has a key of its own
    vector_classes(df, id_col, vector_col, hits + 1).withColumn("key", F.monotonically_increasing_id()).write.parquet(
        f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")
    facts = classes.agg(F.count("*").alias("n"), F.max("log_norm").alias("top"),
                        F.max(F.size("vec")).alias("dim")).first()
    same_ids = F.xxhash64("ids").alias("same")
    if not facts.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    # parts by norm: as many as the exponents of doubles allow, one where norms are alike
    part = F.floor((F.lit(facts.top) - F.col("log_norm")) / math.log2(NORM_FACTOR)).cast("int").alias("part")
    parts = classes.groupBy(part).agg(F.count("*").alias("n"), F.max("log_norm").alias("top")).orderBy("part").collect()
    place = {r.part: i for i, r in enumerate(parts)}
    tops = np.array([r.top for r in parts])
    turn = Turn(facts.dim)
    share = F.lit(int(min(1.0, FIT_ROWS / facts.n) * (1 << 30)))
    found = classes.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < share).orderBy("rep").select(part, "vec").toArrow()
    samples = np.array(found["vec"].combine_chunks().flatten()).reshape(-1, facts.dim)
    owner = np.array([place[x] for x in found["part"].to_pylist()], np.int64)
    centroids = []
    for i, r in enumerate(parts):
        sample = turn.points(samples[owner == i], tops[owner[owner == i]])
        if not len(sample):  # chance left a very small part out
            sample = np.zeros((1, facts.dim + 1))
        centroids.append(fit_centroids(sample, max(1, min(MAX_LISTS * r.n // facts.n, int(math.sqrt(r.n) / 2),
                                                          len(sample)))))
    first_list = np.cumsum([0, *map(len, centroids)])
    lists = int(first_list[-1])
    part_of_list = np.repeat(np.arange(len(parts)), [len(c) for c in centroids])
    # single-precision vectors travel as such: nothing is rounded
    element = df.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"

    def index(batches):
        for b in batches:
            vectors = np.array(b.column("vec").flatten()).reshape(len(b), -1)
            own = np.array([place[x] for x in b.column("part").to_pylist()], np.int64)
            points, at = turn.points(vectors, tops[own]), np.zeros(len(b), np.int64)
            for i in np.unique(own).tolist():
                at[own == i] = first_list[i] + nearest_lists(points[own == i], centroids[i], 1)[:, 0]
            yield pa.RecordBatch.from_arrays([
                b.column("key"), b.column("rep"), b.column("same"), pa.array(at, pa.int32()),
                pa.array([x.tobytes() for x in vectors.astype(kind)], pa.binary())],
                names=["key", "rep", "same", "list", "vector"])

    classes.select("key", "rep", same_ids, part, "vec").mapInArrow(
        index, "key long, rep long, same long, list int, vector binary").write.parquet(f"{folder}/index")
    indexed = spark.read.parquet(f"{folder}/index")

    # lists into blocks of one part each: about MAX_LISTS counts come to the driver
    counts = {r.list: r["count"] for r in indexed.groupBy("list").count().collect()}
    most = max(LEAST_ROWS, min(MOST_ROWS, BLOCK_BYTES // (8 * (facts.dim + 1)), -(-facts.n // BLOCKS)))
    first_block, split, block, held = np.zeros(lists, np.int32), np.ones(lists, np.int32), 0, 0
    for i in range(lists):
        n = counts.get(i, 0)
        if i and (held and held + n > most or held and part_of_list[i] != part_of_list[i - 1]):
            block, held = block + 1, 0
        first_block[i], split[i] = block, max(1, -(-n // most))
        held += n
        if split[i] > 1:
            block, held = block + int(split[i]), 0
    of_list = spark.createDataFrame([(i, int(first_block[i]), int(split[i])) for i in range(lists)],
                                    "list int, block int, split int")

    wanted = asked.select(F.col(id_col).cast("long").alias("query_id"),
                          F.col(vector_col).cast("array<double>").alias("vec")).filter(usable(F.col("vec")))
    classes_asked = wanted.select("vec").distinct().join(classes.select("vec", "key"), "vec")
    classes_asked.write.parquet(f"{folder}/asked")
    classes_asked = spark.read.parquet(f"{folder}/asked")
    # in how many different sets of ids an id is at most, and how many vectors it has
    places = classes.select(F.explode("ids").alias("id"), same_ids).groupBy("id", "same").count()
    most_of = (places.groupBy("id").agg(F.count("*").alias("sets"), F.sum("count").alias("vectors"))
               .agg(F.max("sets").alias("sets"), F.max("vectors").alias("vectors")).first())
    several = most_of.sets or 1
    keep = (hits + 1) * several + MARGIN
    chunk = max(1, CHUNK_QUERIES // several)

    def aim(batches, count_only):
        """A query once per block that holds a probed list, with the bit set of those lists; or the blocks' counts."""
        for b in batches:
            vectors = np.array(b.column("vec").flatten()).reshape(len(b), -1)
            points = turn.queries(vectors)
            near = np.hstack([start + nearest_lists(points, c, math.ceil(probe_share * len(c)))
                              for start, c in zip(first_list.tolist(), centroids, strict=False)])
            if count_only:
                hit = np.zeros((len(b), lists), bool)
                np.put_along_axis(hit, near, True, axis=1)
                probing = np.array([hit[:, of].any(axis=1).sum() for of in lists_of_block], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(probing)), pa.int32()), pa.array(probing)],
                                                 names=["block", "n"])
                continue
            rows = []
            for key, vector, own in zip(b.column("key").to_pylist(), vectors.astype(kind), near, strict=True):
                bits = np.zeros(lists, bool)
                bits[own] = True
                raw, mask = vector.tobytes(), np.packbits(bits).tobytes()
                rows += [(k, key, raw, mask) for k in sorted({x for i in own.tolist() for x in blocks_of_list[i]})]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, [pa.int32(), pa.int64(), pa.binary(), pa.binary()], strict=True)],
                names=["block", "key", "vector", "probed"])

    blocks_of_list = [range(int(f), int(f) + int(n)) for f, n in zip(first_block, split, strict=True)]
    lists_of_block: list[list[int]] = [[] for _ in range(max(r.stop for r in blocks_of_list))]
    for i, own in enumerate(blocks_of_list):
        for k in own:
            lists_of_block[k].append(i)
    # every block in a folder of its own, written once
    (indexed.join(F.broadcast(of_list), "list")
     .select((F.col("block") + F.pmod(F.xxhash64("rep", "vector"), F.col("split"))).cast("int").alias("block"), "key",
             "rep", "same", "list", "vector")
     .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
     .write.partitionBy("block").parquet(f"{folder}/blocks"))
    # tasks: a block's queries, TASK_QUERIES in each (a count per block comes to the driver)
    probing = (classes_asked.mapInArrow(lambda batches: aim(batches, True), "block int, n long")
               .groupBy("block").agg(F.sum("n").alias("n")).collect())
    tasks = {r.block: max(1, -(-r.n // TASK_QUERIES)) for r in probing if r.n}
    firsts = np.cumsum([0, *(tasks[k] for k in sorted(tasks))])
    of_block = spark.createDataFrame([(k, int(f), tasks[k]) for k, f in zip(sorted(tasks), firsts.tolist(), strict=False)],
                                     "block int, first int, tasks int")
    aimed = classes_asked.mapInArrow(lambda batches: aim(batches, False),
                                     "block int, key long, vector binary, probed binary")
    dealt = (aimed.join(F.broadcast(of_block), "block")
             .withColumn("task", (F.col("first") + F.pmod(F.xxhash64("vector"), F.col("tasks"))).cast("int"))
             .repartitionById(max(1, int(firsts[-1])), F.col("task")).select("block", "key", "vector", "probed")
             .sortWithinPartitions("block"))

    def scan(batches):
        """The hits of each query in the block, block after block and chunk after chunk."""
        block, held, candidates = None, [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "key", "vector", "probed")), strict=True):
                if row[0] != block or len(held) == chunk:
                    if held:
                        yield hits_of(held, candidates)
                    held = []
                    if row[0] != block:
                        block, candidates = row[0], load(row[0])
                held.append(row)
        if held:
            yield hits_of(held, candidates)

    def load(block: int):
        filesystem, inner = filesystem_for(f"{folder}/blocks/block={block}")
        if filesystem.get_file_info(inner).type == pafs.FileType.NotFound:
            return None
        found = pq.read_table(inner, filesystem=filesystem, partitioning=None)
        # lists in order: the rows of a list are neighbours, a tile holds few lists
        found = found.take(pa.array(np.argsort(np.array(found["list"]), kind="stable")))
        own, vectors = np.array(found["list"]), _stack(found["vector"], kind)
        return (np.array(found["key"]), np.array(found["rep"]), np.array(found["same"]), own, vectors,
                turn.points(vectors.astype(np.float64), tops[part_of_list[own]]))

    def hits_of(held, candidates) -> pa.RecordBatch:
        names = ["query", "near", "same", "name", "score"]
        if candidates is None:
            kinds = [pa.int64()] * 4 + [pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=names)
        keys, reps, same, own, vectors, points = candidates
        probed = np.unpackbits(np.frombuffer(b"".join(r[3] for r in held), np.uint8).reshape(len(held), -1),
                               axis=1).astype(bool)
        asking = np.frombuffer(b"".join(r[2] for r in held), kind).reshape(len(held), -1)
        q, p, score = adaptive_scan(turn.queries(asking.astype(np.float64)), points, probed[:, own], keep,
                                    score=inner_products(asking, vectors), names=reps, groups=same)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (
            np.array([r[1] for r in held], np.int64)[q], keys[p], same[p], reps[p], score)], names=names)

    pairs = dealt.mapInArrow(scan, "query long, near long, same long, name long, score double")
    # of classes with the same ids the best one, also over blocks
    least = F.min(F.struct((-F.col("score")).alias("down"), "name", "near")).alias("top")
    pairs = pairs.groupBy("query", "same").agg(least).select(
        "query", "top.near", "top.name", (-F.col("top.down")).alias("score"))
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "name", "near")
    short = pairs.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= keep)
    exact = short.join(classes.select(F.col("key").alias("near"), "ids"), "near").select("query", "ids", "score")
    mine = wanted.join(classes_asked, "vec").select("query_id", F.col("key").alias("query")).distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = (mine.join(exact, "query").select("query_id", F.explode("ids").alias("vec_id"), "score")
             .filter(F.col("vec_id") != F.col("query_id")))
    if (most_of.vectors or 1) > 1:
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= hits)
            .select("query_id", "rank", "vec_id", "score"))
