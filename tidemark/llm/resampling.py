"""Importance resampling towards a target, with n-gram features from prefix CRCs.

Every document is scanned with its words joined by single spaces, and a running CRC is kept of what has been
read so far. CRCs (without their fixed start and end values) are linear over GF(2): what a prefix adds to the
CRC of a longer prefix is its own CRC, moved on by the bytes in between. So the CRC of any n-gram comes from
the two prefixes at its ends, by moving the first one on and cancelling it, and no n-gram is ever cut out.

An n-gram falls into the bucket of its CRC. How much more often the target has a bucket than the corpus is the
bucket's gain; a document's weight is the mean gain of its n-grams, and adding Gumbel noise, which a hash of
the document's id fixes, to the weights makes the documents with the highest scores a sample without
replacement. The two passes over the corpus (counting, weighing) each scan it once: writing the buckets of
all n-grams in between would take more space than the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.ranking import with_dense_id
from .common import materialise, read

NGRAM = 2
BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
PERCENT = 25
#: So many bytes are scanned at a time; longer documents go on from where the last scan stopped.
SCAN = 1 << 20

#: Fixed value: the polynomial of CRC-32, lowest power first.
POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
#: Bytes that are scanned side by side, and up to which a move has a table of its own.
_BLOCK = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return table


_CRC = _byte_table()
_NEXT = np.stack([_CRC, *(np.arange(256, dtype=np.uint32) << s >> 8 for s in (8, 16, 24))])


def _moved(by: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRCs moved on as the four tables of ``by`` say, one for each of their bytes."""
    return by[0][crc & 255] ^ by[1][crc >> 8 & 255] ^ by[2][crc >> 16 & 255] ^ by[3][crc >> 24]


class _Moves:
    """Moves over n zero bytes: a table for each n up to _BLOCK, and for _BLOCK times each power of two."""

    def __init__(self):
        units = np.arange(256, dtype=np.uint32)
        short = [np.stack([units << s for s in (0, 8, 16, 24)])]
        for _ in range(_BLOCK):
            short.append(_moved(_NEXT, short[-1]))
        self.short = np.stack(short)
        self.long = [self.short[_BLOCK]]

    def blocks(self, power: int) -> np.ndarray:
        """The tables of a move over _BLOCK * 2 ** power bytes."""
        while len(self.long) <= power:
            self.long.append(_moved(self.long[-1], self.long[-1]))
        return self.long[power]

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        whole, rest = n // _BLOCK, n % _BLOCK
        power = 0
        while (left := whole >> power).any():
            some = np.flatnonzero(left & 1)
            crc[some] = _moved(self.blocks(power), crc[some])
            power += 1
        s = self.short
        return s[rest, 0, crc & 255] ^ s[rest, 1, crc >> 8 & 255] ^ s[rest, 2, crc >> 16 & 255] ^ s[rest, 3, crc >> 24]


_moves = _Moves()


class Prefixes:
    """The running CRC (start and end values left out) of all prefixes of some bytes."""

    def __init__(self, data: np.ndarray):
        blocks = -(-len(data) // _BLOCK)
        rows = np.zeros(blocks * _BLOCK, np.uint8)
        rows[:len(data)] = data
        columns = np.ascontiguousarray(rows.reshape(blocks, _BLOCK).T)
        # Within blocks, all blocks at once ...
        self.inside = np.empty((_BLOCK + 1, blocks), np.uint32)
        self.inside[0] = 0
        for at in range(_BLOCK):
            last = self.inside[at]
            self.inside[at + 1] = _CRC[(last ^ columns[at]) & 255] ^ (last >> 8)
        # ... then what the blocks before add, by doubling distances.
        total, power = self.inside[_BLOCK].copy(), 0
        while 1 << power < blocks:
            total[1 << power:] ^= _moved(_moves.blocks(power), total[:-(1 << power)])
            power += 1
        self.before = np.concatenate([np.zeros(1, np.uint32), total])

    def __call__(self, stops: np.ndarray) -> np.ndarray:
        """Of the prefixes that stop there."""
        block = np.minimum(stops // _BLOCK, self.inside.shape[1] - 1)
        rest = stops - block * _BLOCK
        s, crc = _moves.short, self.before[block]
        return self.inside[rest, block] ^ s[rest, 0, crc & 255] ^ s[rest, 1, crc >> 8 & 255] \
            ^ s[rest, 2, crc >> 16 & 255] ^ s[rest, 3, crc >> 24]

    def between(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes from each start to its stop."""
        return _moves(self(starts) ^ _ONES, stops - starts) ^ self(stops) ^ _ONES


def _lowered() -> np.ndarray:
    """By byte of UTF-8: itself in lower case where it belongs to a word, else 0."""
    out = np.zeros(256, np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        out[first:last + 1] = np.arange(first, last + 1)
    out[0x41:0x5B] = np.arange(0x61, 0x7B)
    return out


_LOWERED = _lowered()


def _scan(data: np.ndarray, stops: np.ndarray, ngram: int, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The n-grams of documents that lie one after another, each closed by a byte that is no word's.

    ``stops``: where each one's closing byte lies. The first ``known`` words were counted before, as the last
    ones of the stretch before this: n-grams within them are left out. Returns the n-grams' CRCs, their
    documents' places, the number of new words of each document, and where the last ``ngram`` - 1 words begin.
    """
    low = _LOWERED[data]
    word = low != 0
    kept = word.copy()
    kept[1:] |= word[:-1]
    joined = low[kept]
    ends = np.flatnonzero(joined == 0)  # one blank after each word; it takes the place of all between two words
    # The scan reads the blank as a space.
    joined[ends] = 0x20
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1]) if len(ends) else ends
    places = np.flatnonzero(kept & ~word)
    of = np.searchsorted(stops, places)
    words = np.bincount(of[known:], minlength=len(stops))
    tail = 0
    if ngram > 1 and len(ends):
        first = max(0, len(ends) - ngram + 1)
        tail = int(places[first] - (ends[first] - starts[first]))
    if not len(ends):
        return np.zeros(0, np.uint32), of, words, tail
    prefixes = Prefixes(joined)
    crcs, owners = [], []
    for n in range(1, ngram + 1):
        first = max(0, known - n + 1)  # n-grams with a new word
        a, b = starts[first:len(starts) - n + 1], ends[first + n - 1:]
        same = of[first:len(of) - n + 1] == of[first + n - 1:]
        crcs.append(prefixes.between(a[same], b[same]))
        owners.append(of[first + n - 1:][same])
    return np.concatenate(crcs), np.concatenate(owners), words, tail


def ngrams(texts: pa.Array, ngram: int = NGRAM, scan: int = SCAN) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The n-grams of some texts, in bounded pieces: their CRC-32s, the places of the texts that each
    belongs to, and the new words by place."""
    blank, line = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
    closed = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), blank, line)
    offsets = np.frombuffer(closed.buffers()[1], np.int64)[closed.offset:closed.offset + len(closed) + 1]
    data = np.frombuffer(closed.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(closed):
        until = max(at + 1, int(np.searchsorted(offsets, offsets[at] + scan, side="right")) - 1)
        begin, end = int(offsets[at]), int(offsets[until])
        if end - begin <= scan:
            crcs, owners, words, _ = _scan(data[begin:end], offsets[at + 1:until + 1] - begin - 1, ngram, 0)
            yield crcs, owners + at, np.concatenate([np.zeros(at, np.int64), words])
        else:  # one long text, in stretches that begin with the last words of the one before
            known, size = 0, scan
            while begin < end:
                piece = data[begin:min(begin + size, end)]
                if begin + len(piece) < end:
                    gaps = np.flatnonzero(_LOWERED[piece] == 0)
                    piece = piece[:gaps[-1] + 1] if len(gaps) else piece[:0]
                    if _words(piece) <= known and size < end - begin:
                        size *= 2  # until it holds a new word's end
                        continue
                crcs, owners, words, tail = _scan(piece, np.array([len(piece) - 1]), ngram, known)
                yield crcs, owners + at, np.concatenate([np.zeros(at, np.int64), words])
                if begin + len(piece) == end:
                    break
                known, size = min(ngram - 1, known + int(words[0])), scan
                begin += tail if known else len(piece)
        at = until


def _words(piece: np.ndarray) -> int:
    """Words that end in the piece."""
    word = _LOWERED[piece] != 0
    return int(np.count_nonzero(word[:-1] & ~word[1:]))


def bucket_counts(docs: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """How many n-grams of all texts fall into each bucket: bucket, n. Buckets without any are left out."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for crcs, _, _ in ngrams(batch.column(0), ngram):
                total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    partial = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """By bucket, a thousand times the logarithm of how much likelier the target has it, floored.

    Two rows for each bucket reach the driver, whatever the input.
    """
    def counts(df):
        out = np.zeros(buckets, np.int64)
        for row in bucket_counts(df, ngram, buckets).collect():
            out[row.bucket] = row.n
        return out

    s, t = counts(docs).astype(np.float64), counts(target).astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, ngram: int = NGRAM) -> DataFrame:
    """Puts ``__words``, ``__features`` and ``__weight``, the floored mean gain, in the place of the last column,
    the text."""
    def run(batches):
        for batch in batches:
            words, features, sums = (np.zeros(len(batch), np.int64) for _ in range(3))
            for crcs, owners, new in ngrams(batch.column(batch.num_columns - 1), ngram):
                words[:len(new)] += new
                features += np.bincount(owners, minlength=len(batch))
                # Exact: far fewer than 2 ** 53.
                sums += np.bincount(owners, gain[crcs % np.uint32(len(gain))], len(batch)).astype(np.int64)
            weight = sums // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *map(pa.array, (words, features, weight))], schema=None,
                names=[*batch.schema.names[:-1], "__words", "__features", "__weight"])

    fields = [*docs.schema.fields[:-1], *[T.StructField(c, T.LongType()) for c in ("__words", "__features", "__weight")]]
    return docs.mapInArrow(run, T.StructType(fields))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, keep: list[str] | None = None,
             ngram: int = NGRAM, buckets: int = BUCKETS, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with n_features, weight, score and, if it is drawn, rank.

    ``percent`` of the documents with at least ``min_words`` words are drawn, floored; ranks count from 1 by
    falling score, then doc_id. ``docs`` has doc_id and text, ``target`` has text; ``keep`` names the columns
    of ``docs`` to return (doc_id alone by default; all of them sorts the texts as well).

    Null and blank texts have no features and weight 0. A null doc_id is hashed as an empty one, and comes
    before others where scores tie. Rows that repeat a doc_id are documents of their own with the same noise;
    those that agree in score and doc_id rank by the number of features, and among equal ones any order is the
    same. Columns of the names that this adds are replaced. With an empty target, buckets that the corpus
    seldom has gain; an empty corpus gives no rows.
    """
    own = ["n_features", "weight", "score", "rank"]
    keep = [c for c in (keep or ["doc_id"]) if c not in own]
    # By number: names may hold dots.
    carried = [F.col("doc_id").alias("__id"), *[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(keep)]]
    weighed = weights(docs.select(*carried, F.col("text").cast("string").alias("__text")),
                      gains(docs, target, ngram, buckets), ngram)
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((draw.cast("double") + 0.5) / 4294967296))).cast("long")
    scored = materialise(weighed.withColumns({
        "__score": F.col("__weight") + noise, "__row": F.monotonically_increasing_id()}), "scored")
    able = F.col("__words") >= min_words
    # Rows are told apart by their number, so repeats of one row spread over ranges like any others.
    ranked = with_dense_id(scored.filter(able).withColumn("__down", -F.col("__score")),
                           ["__down", "__id", "__features", "__row"], "__rank").drop("__down")
    drawn = scored.filter(able).count() * percent // 100
    rest = scored.filter(~able).withColumn("__rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(
        *[F.col(f"__{i}").alias(c) for i, c in enumerate(keep)], F.col("__features").alias("n_features"), F.col("__weight").alias("weight"),
        F.col("__score").alias("score"), F.when(F.col("__rank") <= drawn, F.col("__rank")).alias("rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _sql(ngram: int = NGRAM, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS,
         seed: int = SEED) -> str:
    """The same with the CRC of each distinct n-gram computed byte by byte."""
    grams = " UNION ALL ".join(
        f"SELECT kind, doc, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT kind, doc, w, "
        f"unnest(range(1, len(w) - {n - 2})) AS i FROM words)" for n in range(1, ngram + 1))
    halved = f"CASE WHEN c % 2 = 1 THEN xor(c // 2, {POLYNOMIAL}) ELSE c // 2 END"
    return f"""WITH numbered AS MATERIALIZED (SELECT row_number() OVER () AS doc, * FROM documents),
    texts AS (SELECT 'd' AS kind, doc, text FROM numbered UNION ALL SELECT 'b', 0, text FROM benchmark),
    words AS MATERIALIZED (SELECT kind, doc, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts WHERE text IS NOT NULL),
    grams AS MATERIALIZED ({grams}),
    crc_table AS (SELECT list(list_reduce(range(8), lambda c, k: {halved}, b) ORDER BY b) AS entries
      FROM range(256) r(b)),
    distinct_grams AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM grams)),
    hashed AS MATERIALIZED (SELECT g, xor(list_reduce(
        list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c // 256, entries[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295) % {buckets} AS bucket
      FROM distinct_grams, crc_table),
    counts AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
      FROM grams JOIN hashed USING (g) GROUP BY bucket),
    sizes AS (SELECT coalesce(sum(s), 0)::DOUBLE AS ss, coalesce(sum(t), 0)::DOUBLE AS tt FROM counts),
    gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ss + {buckets}) / ((s + 1)::DOUBLE * (tt + {buckets}))))::BIGINT AS gain
      FROM counts, sizes),
    weighed AS (SELECT doc, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM grams JOIN hashed USING (g) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc),
    scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score,
        coalesce(len(w), 0) >= {min_words} AS able
      FROM numbered LEFT JOIN weighed USING (doc) LEFT JOIN (SELECT doc, w FROM words WHERE kind = 'd') USING (doc)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place,
        count(*) FILTER (able) OVER () AS n FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= n * {percent} // 100 THEN place END AS rank
    FROM placed"""


SQL = _sql()
