"""Line dedup: repeated runs of lines, found by a suffix array over line ids.

The corpus is read as one sequence of line ids; a line that occurs once ends every run and is left out.
Distributed prefix doubling sorts the suffixes: after round k, ``rank_k`` orders them by their first 2^k
lines. Suffixes whose longest common prefix reaches ``min_words`` words form an interval of the suffix
array. Its members share the same shortest window of that many words, and that window is named by two
overlapping ranks, ``rank_k`` of its start and ``rank_k`` of 2^k lines before its end. In each interval the
first member (by document, then line) stays and the windows of the later ones go.

Windows are taken forward from each line and backward from each line. A repeated run of ``min_words`` words
or more is the union of the windows inside it, so all of a maximal run is deleted and nothing else is. As a
window has at most ``min_words`` lines, log2(min_words) rounds settle every rank, whatever the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.ranking import with_dense_id
from .common import SPACE, materialise, read, word_count

_KEY = ["doc_id", "version"]
#: Parts into which the windows of an interval are spread.
SALTS = 16


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _positions(docs: DataFrame) -> DataFrame:
    """One row per line that occurs twice or more: its number ``g`` in the sequence, its rank, its run.

    Lines that follow each other in a document have following numbers; ``run`` is the number of the first
    line of the stretch of repeated lines that it lies in.
    """
    listed = F.filter(F.transform(_lines(F.col("text")), lambda line, i: F.struct(
        i.alias("line"), _bare(line).alias("bare"))), lambda x: x["bare"] != "")
    lines = materialise(
        docs.select(*_KEY, F.posexplode(listed).alias("seq", "x")).select(
            *_KEY, "seq", "x.line", F.xxhash64("x.bare").alias("h1"),
            F.xxhash64(F.lit(1), F.col("x.bare")).alias("h2"), word_count(F.col("x.bare")).alias("words")
        ).dropDuplicates([*_KEY, "seq"]), "lines")
    classes = with_dense_id(
        lines.groupBy("h1", "h2").count().filter("count > 1").drop("count"), ["h1", "h2"], "rank")
    placed = with_dense_id(lines.join(classes, ["h1", "h2"]).drop("h1", "h2"), [*_KEY, "seq"], "g")
    # Neighbours in a document differ by one in seq and in g, so the difference names a stretch.
    stretch = Window.partitionBy(*_KEY, F.col("g") - F.col("seq"))
    ends = F.sum("words").over(stretch.orderBy("g").rowsBetween(Window.unboundedPreceding, 0))
    return materialise(placed.withColumn("run", F.col("g") - F.col("seq")).withColumn("end_words", ends), "positions")


def _windows(positions: DataFrame, min_words: int) -> DataFrame:
    """(start, lines) of the shortest windows of ``min_words`` words, forward and backward from each line."""
    stretch = Window.partitionBy(*_KEY, "run")
    begin = F.col("end_words") - F.col("words")
    return (
        positions.withColumn("begin_words", begin)
        .select(
            "g", "begin_words", "end_words", F.max("end_words").over(stretch).alias("all_words"),
            F.count("*").over(stretch.orderBy("begin_words").rangeBetween(0, min_words - 1)).alias("ahead"),
            F.count("*").over(stretch.orderBy("end_words").rangeBetween(1 - min_words, 0)).alias("behind"))
        .select(F.explode(F.array(
            F.when(F.col("all_words") - F.col("begin_words") >= min_words,
                   F.struct(F.col("g").alias("start"), F.col("ahead").alias("lines"))),
            F.when(F.col("end_words") >= min_words,
                   F.struct((F.col("g") - F.col("behind") + 1).alias("start"), F.col("behind").alias("lines"))),
        )).alias("w"))
        .filter("w is not null").select("w.start", "w.lines").distinct()
    )


def _doubled(ranks: DataFrame, width: int) -> DataFrame:
    """Ranks by 2 * width lines from ranks by width lines; only windows that repeat are kept."""
    pairs = materialise(
        ranks.alias("a").join(ranks.alias("b"), (F.col("a.g") + width == F.col("b.g"))
                              & F.col("a.run").eqNullSafe(F.col("b.run"))
                              & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
                              & (F.col("a.version") == F.col("b.version")))
        .select("a.*", F.col("b.rank").alias("next")), "pairs")
    classes = with_dense_id(
        pairs.groupBy("rank", "next").count().filter("count > 1").drop("count"), ["rank", "next"], "doubled")
    return materialise(
        pairs.join(classes, ["rank", "next"]).select("g", *_KEY, "run", F.col("doubled").alias("rank")), "ranks")


def later_copies(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """The lines to delete: doc_id, version (hash of the text), ``removed`` (sorted line numbers from 0)."""
    spark = docs.sparkSession
    keyed = docs.filter(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("version"), "text")
    positions = _positions(keyed)
    windows = materialise(
        _windows(positions, min_words).withColumn("level", F.floor(F.log2("lines")).cast("int")), "windows")
    ranks = positions.select("g", *_KEY, "run", "rank")
    found, level = [], 0
    while 2 ** level <= min_words:
        named = ranks.select("g", "rank")
        found.append(
            windows.filter(F.col("level") == level)
            .withColumn("tail", F.col("start") + F.col("lines") - 2 ** level)
            .join(named.select(F.col("g").alias("start"), F.col("rank").alias("head_rank")), "start")
            .join(named.select(F.col("g").alias("tail"), F.col("rank").alias("tail_rank")), "tail")
            .select("lines", "head_rank", "tail_rank", "start"))
        level += 1
        if 2 ** level > min_words:
            break
        ranks = _doubled(ranks, 2 ** (level - 1))
        if ranks.isEmpty():
            break
    named = materialise(reduce(DataFrame.unionByName, found), "named")
    interval = ["lines", "head_rank", "tail_rank"]
    firsts = named.groupBy(*interval).agg(F.min("start").alias("first"), F.count("*").alias("n")).filter("n > 1")
    # An interval may hold a third of all windows: its rows are spread, its first member is sent to each part.
    spread = named.withColumn("salt", F.pmod(F.col("start"), F.lit(SALTS)))
    firsts = firsts.drop("n").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    gone = (
        spread.join(firsts, [*interval, "salt"]).filter("start > first")
        .select(F.explode(F.sequence("start", F.col("start") + F.col("lines") - 1)).alias("g")).distinct())
    return (
        positions.join(gone, "g", "left_semi").groupBy(*_KEY)
        .agg(F.sort_array(F.collect_list("line")).alias("removed")))


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """The documents with later copies of repeated line runs deleted.

    ``docs`` has doc_id, text and any other columns; they come back with ``text`` cleaned, and with
    n_lines, ``removed`` (the deleted line numbers, from 0, ascending) and n_removed added; input columns
    of these names are replaced. Lines are what ``\\n`` separates; they count as equal when they agree
    up to outer blanks. Blank lines are skipped when runs are matched and always stay. A run counts with
    ``min_words`` words or more. Order: doc_id (null first), hash of the text, line.

    Null text stays null with zero lines; empty text has no line to match. Documents with a null doc_id
    take part. Rows that agree in doc_id and text count as one document and get the same result; rows of
    one doc_id with different texts are different documents. A document may lose all its lines.
    """
    rest = [c for c in docs.columns if c not in ("n_lines", "removed", "n_removed")]
    left = docs.select(*rest).withColumn("__version", F.xxhash64("text")).alias("l")
    right = later_copies(docs, min_words).alias("r")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.__version") == F.col("r.version"))
    lines, removed = _lines(F.col("l.text")), F.coalesce(F.col("r.removed"), F.array().cast("array<int>"))
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed), lambda i: F.get(lines, i))
    return left.join(right, same, "left").select(
        *[F.when(F.size(removed) > 0, F.array_join(kept, "\n")).otherwise(F.col("l.text")).alias("text")
          if c == "text" else F.col(f"l.{c}") for c in rest],
        F.when(F.col("l.text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        removed.alias("removed"), F.size(removed).alias("n_removed"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(read(spark, sf_dir, "documents"), min_words=50)
    return cleaned.select("doc_id", "text", "n_lines", "n_removed", F.array_join(
        F.transform("removed", lambda i: i.cast("string")), ",").alias("removed_lines"))


#: Windows as text: a line goes if a forward or backward window over it stands earlier in the corpus.
SQL = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
         unnest(range(len(string_split(text, chr(10))))) AS line FROM documents WHERE text IS NOT NULL),
bare AS (
  SELECT doc_id, line, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM split),
seqs AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS seq,
         len(regexp_extract_all(bare, '[^{SPACE}]+')) AS words FROM bare WHERE bare <> ''),
cums AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY seq) AS ends,
         sum(words) OVER (PARTITION BY doc_id) AS total FROM seqs),
wins AS (
  SELECT a.doc_id, min(b.seq) AS s, max(b.seq) AS e, string_agg(b.bare, chr(10) ORDER BY b.seq) AS body
  FROM cums a JOIN cums b ON a.doc_id = b.doc_id AND b.seq >= a.seq
       AND b.ends - b.words < a.ends - a.words + 50
  WHERE a.total - a.ends + a.words >= 50 GROUP BY a.doc_id, a.seq
  UNION
  SELECT a.doc_id, min(b.seq), max(b.seq), string_agg(b.bare, chr(10) ORDER BY b.seq)
  FROM cums a JOIN cums b ON a.doc_id = b.doc_id AND b.seq <= a.seq AND b.ends > a.ends - 50
  WHERE a.ends >= 50 GROUP BY a.doc_id, a.seq),
marked AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS nth FROM wins),
gone AS (
  SELECT DISTINCT c.doc_id, c.line FROM marked m JOIN cums c
  ON m.doc_id = c.doc_id AND c.seq BETWEEN m.s AND m.e WHERE m.nth > 1),
kept AS (
  SELECT s.doc_id, string_agg(s.raw, chr(10) ORDER BY s.line) FILTER (WHERE g.line IS NULL) AS text,
         count(*) AS n_lines, count(g.line) AS n_removed,
         coalesce(string_agg(g.line, ',' ORDER BY g.line), '') AS removed_lines
  FROM split s LEFT JOIN gone g USING (doc_id, line) GROUP BY s.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(k.n_removed, 0) AS INTEGER) AS n_removed,
       coalesce(k.removed_lines, '') AS removed_lines
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
