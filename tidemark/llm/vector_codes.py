"""Product codes of vectors, learnt in whole numbers, with LAESA pivots to spare evaluations.

Vectors become whole numbers and are cut into parts. Each part position has a codebook, learnt in rounds of
assigning every part to the nearest entry and moving each entry to the mean of its parts. A few pivots per
position stay as they are in all rounds, so every part's distances to them are computed once and kept with it.
The entries move, but there are few: their distances to the pivots are cheap in each round. By the triangle
inequality the difference of a part's and an entry's distance to a pivot is a lower bound of the distance
between them. A part tries the entries in the order of their bounds, and once a bound is above the best
distance found, it and all after it are passed over without an evaluation. Bounds are floating-point numbers and
carry a margin for it; evaluations, comparisons and sums are whole numbers, so codes are exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import materialise, read

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PIVOTS = 4
#: Rows that a task works on at a time.
ROWS = 4096
#: Scaled components stay below this, so that no error leaves 64 bits.
MOST = 2**27


def whole_vectors(vectors: DataFrame, keep: list[str], scale: int = SCALE) -> DataFrame:
    """The columns ``keep`` and ``__v``, the vector in whole numbers, of the rows that take part."""
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST / scale))
    return vectors.filter(F.coalesce(fits, F.lit(False))).select(
        *[F.col(f"`{c}`") for c in keep],
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("__v"))


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """For each part position, its parts of the rows with the smallest ids: at most ``entries`` rows reach the driver."""
    def smallest(some: DataFrame) -> list:
        return some.orderBy(F.col("vec_id").asc_nulls_last(), "__v").limit(entries).collect()

    first = smallest(rows)
    size = len(first[0]["__v"]) if first else 0
    if any(len(r["__v"]) != size for r in first):
        first = smallest(rows.filter(F.size("__v") == size))
    vectors = np.array([r["__v"] for r in first], np.int64).reshape(len(first), size)
    return np.array_split(vectors, parts, axis=1)


def pivots_of(book: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Entries far from each other: each next one has the largest sum of distances to those before."""
    chosen, far = [], np.zeros(len(book))
    left = np.ones(len(book), bool)
    while left.any() and len(chosen) < pivots:
        at = int(np.argmax(np.where(left, far, -1.0)))
        chosen.append(at)
        left[at] = False
        far = far + _distances(book, book[at:at + 1])[:, 0]
    return book[chosen]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all of a to all of b."""
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2).astype(np.float64))


def nearest(parts: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each part's nearest entry (the smaller index of equal ones), its squared distance, and how many
    distances were evaluated. ``to_pivots`` are the parts' distances to the pivots."""
    entry_pivots = _distances(book, pivots)
    bounds = np.zeros((len(parts), len(book)))
    for k in range(len(pivots)):
        np.maximum(bounds, np.abs(to_pivots[:, k:k + 1] - entry_pivots[:, k]), out=bounds)
    # Two roots and a difference of numbers below 2 ** 31 are off by far less than this; kept distances are
    # rounded to single precision.
    bounds -= 1e-3 + 1e-6 * (to_pivots.max(1, initial=0.0)[:, None] + entry_pivots.max(initial=0.0))
    np.maximum(bounds, 0, out=bounds)
    bounds *= bounds
    order = np.argsort(bounds, axis=1, kind="stable")
    best = np.full(len(parts), np.iinfo(np.int64).max)
    code = np.zeros(len(parts), np.int64)
    going = np.arange(len(parts))
    evaluated = 0
    for step in range(len(book)):
        entry = order[going, step]
        open_ = bounds[going, entry] <= best[going]
        going, entry = going[open_], entry[open_]
        if not len(going):
            break
        evaluated += len(going)
        distance = ((parts[going] - book[entry]) ** 2).sum(1)
        better = (distance < best[going]) | ((distance == best[going]) & (entry < code[going]))
        best[going[better]], code[going[better]] = distance[better], entry[better]
    return code, best, evaluated


def _blocks(batches, books, pivots):
    """Batches in blocks of rows: the block, its vectors cut into parts, and their distances to the pivots."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            block = batch.slice(at, ROWS)
            columns = dict(zip(block.schema.names, block.columns))
            size = sum(b.shape[1] for b in books)
            flat = np.asarray(columns["__v"].flatten()).astype(np.int64).reshape(len(block), size)
            cuts = np.cumsum([0, *[b.shape[1] for b in books]])
            parts = [flat[:, a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            if "__p" in columns:
                near = np.asarray(columns["__p"].flatten()).reshape(len(block), -1)
                ends = np.cumsum([0, *[len(p) for p in pivots]])
                yield block, parts, [near[:, a:b].astype(np.float64) for a, b in zip(ends[:-1], ends[1:])]
            else:
                yield block, parts, None


def with_pivots(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> DataFrame:
    """Adds ``__p``: every part's distances to the pivots of its position, part after part. Written to the
    shared folder, as all rounds read them. Vectors of another length than the codebooks' take no part."""
    size = sum(b.shape[1] for b in books)

    def run(batches):
        for block, parts, _ in _blocks(batches, books, pivots):
            near = np.concatenate([_distances(x, p) for x, p in zip(parts, pivots)], axis=1).astype(np.float32)
            offsets = pa.array(np.arange(len(block) + 1, dtype=np.int32) * near.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.ListArray.from_arrays(offsets, pa.array(near.ravel()))], [*block.schema.names, "__p"])

    shape = T.StructType([*rows.schema.fields, T.StructField("__p", T.ArrayType(T.FloatType()))])
    return materialise(rows.filter(F.size("__v") == size).mapInArrow(run, shape), "vector-parts")


def next_books(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> list[np.ndarray]:
    """One round: each entry becomes the floored mean of its parts; entries without any stay.

    A task sums its own rows, so it sends a row for each part position and entry at most.
    """
    def run(batches):
        sums = [np.zeros((len(b), b.shape[1]), object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for _, parts, near in _blocks(batches, books, pivots):
            for k, (x, n) in enumerate(zip(parts, near)):
                code = nearest(x, n, books[k], pivots[k])[0]
                here = np.zeros(sums[k].shape, np.int64)
                np.add.at(here, code, x)
                sums[k] += here
                counts[k] += np.bincount(code, minlength=len(counts[k]))
        out = [(k, e, int(counts[k][e]), [int(s) for s in sums[k][e]])
               for k in range(len(books)) for e in range(len(books[k])) if counts[k][e]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(zip(*out) if out else [[]] * 4, (
                pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["part", "entry", "n", "sums"])

    partial = rows.select("__v", "__p").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    width = max((b.shape[1] for b in books), default=0)
    means = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[
        F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
    out = [b.copy() for b in books]
    for row in means.collect():  # one row for each part position and entry
        out[row.part][row.entry] = [int(row[f"s{i}"]) // row.n for i in range(out[row.part].shape[1])]
    return out


def learn(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    for _ in range(rounds):
        books = next_books(rows, books, pivots)
    return books


def encode(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> DataFrame:
    """The rows' columns but for their vectors, with ``code`` (two hex digits for each part), ``error`` (squared
    distances summed over the parts) and ``evaluated`` (distances that were evaluated, of parts times entries,
    on average over the row's block)."""
    keep = [c for c in rows.columns if c not in ("__v", "__p")]

    def run(batches):
        for block, parts, near in _blocks(batches, books, pivots):
            codes = np.zeros((len(block), len(books)), np.uint8)
            error, evaluated = np.zeros(len(block), np.int64), 0
            for k, (x, n) in enumerate(zip(parts, near)):
                code, distance, tried = nearest(x, n, books[k], pivots[k])
                codes[:, k], error, evaluated = code, error + distance, evaluated + tried
            yield pa.RecordBatch.from_arrays(
                [*[block.column(block.schema.get_field_index(c)) for c in keep], pa.array([bytes(c).hex() for c in codes]),
                 pa.array(error), pa.array(np.full(len(block), evaluated / max(1, len(block))))],
                [*keep, "code", "error", "evaluated"])

    fields = [rows.schema[c] for c in keep] + [
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("evaluated", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType(fields))


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             pivots: int = PIVOTS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code, error, evaluated, label_error and codebooks_sha256 of each vector.

    ``vectors`` has vec_id, embedding and label; other columns are not read. Left out are vectors that are null or hold
    null or non-finite components, components from 32,768 on (their errors fit no long), and those of another
    length than that with the smallest vec_id. Codebooks start from the rows with the smallest vec_ids, rows of
    one id in the order of their vectors, rows without a vec_id last. With fewer rows than
    ``entries`` there are as few entries. Where ``parts`` doesn't divide the length, the first parts are longer
    by one. Repeated rows count and return each for itself. An empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index is two hex digits")
    rows = whole_vectors(vectors, ["vec_id", "label"], scale)
    books = first_books(rows, parts, entries)
    fixed = [pivots_of(book, pivots) for book in books]
    kept = with_pivots(rows, books, fixed)
    books = learn(kept, books, fixed, rounds)
    coded = materialise(encode(kept, books, fixed), "vector-codes")
    # One row for each label; a label with a third of the rows is summed in the tasks first.
    sums = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label") \
        .withColumn("codebooks_sha256", F.lit(books_sha256(books)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    def assigned(n: int) -> str:
        return f"""near{n} AS MATERIALIZED (SELECT row, part, v, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
          SELECT p.row, p.part, p.v, b.entry, list_sum(list_transform(list_zip(p.v, b.c),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM pieces p JOIN book{n} b USING (part))
          GROUP BY row, part, v)"""

    def moved(n: int) -> str:
        return f"""mean{n} AS (SELECT part, entry, list(m ORDER BY place) AS c FROM (
          SELECT part, entry, place, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m FROM (
            SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS place FROM near{n})
          GROUP BY part, entry, place) GROUP BY part, entry),
        book{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
          FROM book{n} b LEFT JOIN mean{n} m USING (part, entry))"""

    chain = ", ".join(f"{assigned(n)}, {moved(n)}" for n in range(rounds))
    return f"""WITH usable AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label,
        list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    pieces AS MATERIALIZED (SELECT row, k AS part, v[k * len(v) // {parts} + 1:(k + 1) * len(v) // {parts}] AS v
      FROM usable, range({parts}) r(k)),
    first AS (SELECT row, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM usable ORDER BY vec_id, v LIMIT {entries}),
    book0 AS MATERIALIZED (SELECT part, entry, v AS c FROM pieces JOIN first USING (row)),
    {chain}, {assigned(rounds)},
    coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
      FROM near{rounds} GROUP BY row),
    digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM usable JOIN coded USING (row), digest"""


SQL = _sql()
