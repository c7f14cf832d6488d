"""SimHash near-dedup with a hierarchical index over fingerprints in Gray order.

Distinct fingerprints are sorted by Gray rank, where neighbours share many bits, and cut into blocks of
equal size. A node covers consecutive fingerprints and holds the bits on which all of them agree: a mask
and a pattern. Two nodes cannot hold a pair within the distance if their patterns already differ in more
bits than that under both masks. Pairs of nodes are taken from the top down: the differences found so far
are carried along, only bits that a child adds to its parent's mask are counted, and whole pairs of groups
are dropped. Above the blocks this runs as joins of the node tables, inside a pair of blocks as array code.

There is one such index for each of distance + 1 segments of the fingerprint, which is rotated so that the
segment comes first. Two fingerprints within the distance agree in one segment, so in each index only nodes
that share a value of its leading segment meet: a block meets itself and the few that its segments reach
into. So pairs of blocks grow with the input, not with its square.

Pairs of blocks give a spanning forest instead of pairs: nodes whose members are already connected are not
opened, so a group of many near copies costs no square of its size. A component search joins the forests.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ranking import with_dense_id
from .common import materialise, read
from .components import components

#: Fingerprints in a block: half a megabyte for a pair of blocks, at any input size.
BLOCK = 1 << 15
FAN_OUT = 16
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits; a bit is set if it is set in over half of the hashes of the word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    hashed = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, total, 1 << 16):
        begin, end = starts[at:min(at + (1 << 16), total)], starts[at + shingle:]
        codes = np.array([hashed(joined[a:b - 1], SEED) for a, b in zip(begin, end)], "<u8")
        counts += np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def coded(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], "u8").view("i8"))
    return coded(text)


def gray_rank(code: Column) -> Column:
    """The place of a code in Gray order, as a long whose signed order is that of the unsigned rank."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def segments(distance: int) -> list[tuple[int, int]]:
    """(bits before it, width) of distance + 1 segments of 64 bits: as many differing bits leave one untouched."""
    n = min(distance + 1, 64)
    ends = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(ends[:-1], ends[1:])]


def rotated(code: Column, bits: int) -> Column:
    return code if bits == 0 else F.shiftleft(code, bits).bitwiseOR(F.shiftrightunsigned(code, 64 - bits))


def _node_pairs(placed: DataFrame, blocks: int, distance: int) -> DataFrame:
    """(index, a, b), a <= b: the pairs of an index's blocks that may hold fingerprints which agree in its
    segment and lie within the distance."""
    summary = placed.groupBy("index", F.col("block").alias("node")).agg(
        F.bit_and("code").alias("all1"), F.bit_or("code").alias("any1"), F.min("lead").alias("low"), F.max("lead").alias("high"))
    levels = [materialise(summary, "nodes")]
    size = blocks
    while size > 1:
        size = -(-size // FAN_OUT)
        levels.append(levels[-1].groupBy("index", F.floor(F.col("node") / FAN_OUT).alias("node")).agg(
            F.bit_and("all1").alias("all1"), F.bit_or("any1").alias("any1"), F.min("low").alias("low"), F.max("high").alias("high")))
    none = F.lit(0).cast("long")
    pairs = levels[-1].select(
        "index", F.col("node").alias("a"), F.col("node").alias("b"), none.alias("seen"), none.alias("diff"))
    for nodes in reversed(levels[:-1]):
        def side(name: str) -> DataFrame:
            shared = F.bitwise_not(F.col("all1").bitwiseXOR(F.col("any1")))
            return nodes.select("index", F.floor(F.col("node") / FAN_OUT).alias(f"p{name}"), F.col("node").alias(name),
                                shared.alias(f"mask_{name}"), F.col("all1").alias(f"bits_{name}"),
                                F.col("low").alias(f"low_{name}"), F.col("high").alias(f"high_{name}"))
        both = pairs.withColumnsRenamed({"a": "pa", "b": "pb"}).join(side("a"), ["index", "pa"]).join(side("b"), ["index", "pb"]) \
            .filter("a <= b AND low_b <= high_a").withColumn("mask", F.col("mask_a").bitwiseAND(F.col("mask_b")))
        new = F.col("mask").bitwiseAND(F.bitwise_not(F.col("seen")))
        pairs = materialise(
            both.withColumn("diff", F.col("diff") + F.bit_count(
                F.col("bits_a").bitwiseXOR(F.col("bits_b")).bitwiseAND(new)))
            .filter(F.col("diff") <= distance)
            .select("index", "a", "b", F.col("mask").alias("seen"), "diff"), "node-pairs")
    return pairs.select("index", "a", "b")


class _Forest:
    """Least member of the component of each of n members."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root != (further := self.root[self.root])).any():
                self.root = further


class _Tree:
    """Nodes over consecutive codes, four children each; levels[0] are the codes."""

    FAN = 4

    def __init__(self, codes: np.ndarray, offset: int):
        self.offset = offset
        self.levels = [(codes, codes)]
        self.sizes = [len(codes)]
        while self.sizes[-1] > 1:
            low, high = self.levels[-1]
            cut = np.arange(0, len(low), self.FAN)
            self.levels.append((np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)))
            self.sizes.append(len(cut))

    def one_root(self, root: np.ndarray) -> list[np.ndarray]:
        """By level: the component if all members of the node are in one, else -1 - (something)."""
        low = high = root[self.offset:self.offset + self.sizes[0]]
        out = [low]
        for n in self.sizes[:-1]:
            cut = np.arange(0, n, self.FAN)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            out.append(np.where(low == high, low, -1 - self.offset))
        return out


def block_forest(a: np.ndarray, b: np.ndarray | None, distance: int, lead: int = 0, step: int = 1 << 16) -> np.ndarray:
    """For two blocks in Gray order (or one, with itself): the root of each code, codes of a before those of b.

    Only codes that agree in their ``lead`` highest bits are compared.
    """
    leading = np.uint64(((1 << lead) - 1) << (64 - lead))
    left = _Tree(a, 0)
    right = left if b is None else _Tree(b, len(a))
    forest = _Forest(len(a) + (0 if b is None else len(b)))
    top = max(len(left.levels), len(right.levels)) - 1
    for tree in (left, right):  # the same height for both
        while len(tree.levels) <= top:
            tree.levels.append(tree.levels[-1])
            tree.sizes.append(1)
    roots = (left.one_root(forest.root), right.one_root(forest.root))
    zero = np.zeros(1, np.int64)
    todo = [(top, zero, zero, np.zeros(1, np.uint64), np.zeros(1, np.uint8))]
    child = np.arange(_Tree.FAN)
    while todo:
        level, i, j, seen, diff = todo.pop()
        if len(i) > step:
            todo += [(level, *(x[at:at + step] for x in (i, j, seen, diff))) for at in range(0, len(i), step)]
            continue
        whole = (roots[0][level][i] == roots[1][level][j]) & (roots[0][level][i] >= 0)
        if whole.any():  # already connected: nothing to find below
            i, j, seen, diff = i[~whole], j[~whole], seen[~whole], diff[~whole]
        if level == 0 or not len(i):
            if len(i):
                i, j = left.offset + i, right.offset + j
                if (forest.root[i] != forest.root[j]).any():
                    forest.link(i, j)
                    roots = (left.one_root(forest.root), right.one_root(forest.root))
            continue
        at = level - 1
        shape = (len(i), _Tree.FAN, _Tree.FAN)
        ci = np.broadcast_to((i[:, None] * _Tree.FAN + child)[:, :, None], shape).reshape(-1)
        cj = np.broadcast_to((j[:, None] * _Tree.FAN + child)[:, None, :], shape).reshape(-1)
        ok = (ci < left.sizes[at]) & (cj < right.sizes[at])
        if b is None:
            ok &= ci <= cj if at else ci < cj
        kept = np.flatnonzero(ok)
        ci, cj, parent = ci[kept], cj[kept], kept // (_Tree.FAN * _Tree.FAN)
        (and_a, or_a), (and_b, or_b) = left.levels[at], right.levels[at]
        mask = ~((and_a[ci] ^ or_a[ci]) | (and_b[cj] ^ or_b[cj]))
        differing = (and_a[ci] ^ and_b[cj]) & mask
        found = diff[parent] + np.bitwise_count(differing & ~seen[parent])
        near = (found <= distance) & (differing & leading == 0)
        if near.any():
            todo.append((at, ci[near], cj[near], mask[near], found[near]))
    return forest.root


def _links(distance: int):
    """Links between the codes of pairs of blocks, turned back to where their bits were."""
    parts = segments(distance)

    def search(batches):
        for batch in batches:
            us, vs = [], []
            for index, a, b, x, y in zip(batch["index"], batch["a"], batch["b"], batch["x"], batch["y"]):
                bits, width = parts[index]
                one = np.frombuffer(x, "<u8")
                two = None if a == b else np.frombuffer(y, "<u8")
                codes = one if two is None else np.concatenate([one, two])
                root = block_forest(one, two, distance, width if len(parts) > 1 else 0)
                moved = np.flatnonzero(root != np.arange(len(root)))
                if bits:
                    codes = codes >> np.uint64(bits) | codes << np.uint64(64 - bits)
                us.append(codes[moved].view("i8"))
                vs.append(codes[root[moved]].view("i8"))
            yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)} if us else {"u": [], "v": []})
    return search


def _packed(rows):
    for batch in rows:
        yield pd.DataFrame({"index": batch["index"], "block": batch["block"], "codes": [
            np.asarray(c, "i8").astype("<i8").tobytes() for c in batch["codes"]]})


def linked(codes: DataFrame, distance: int) -> DataFrame:
    """(code, root) for each distinct long ``code`` that has another within ``distance`` differing bits."""
    spark, n = codes.sparkSession, codes.count()
    turned = F.array(*[F.struct(F.lit(k).alias("index"), rotated(F.col("code"), bits).alias("code"), F.lit(64 - width).alias("rest"))
                       for k, (bits, width) in enumerate(segments(distance))])
    ranked = codes.select(F.inline(turned)).withColumn("rank", gray_rank(F.col("code"))) \
        .withColumn("lead", F.expr("shiftright(rank, rest)")).drop("rest")
    # Each index has all n codes, one index after the other.
    block = F.floor((F.col("place") - 1) % max(n, 1) / BLOCK)
    placed = materialise(with_dense_id(ranked, ["index", "rank"], "place").select(
        "index", "code", "lead", "place", block.alias("block")), "gray")
    pairs = _node_pairs(placed, -(-n // BLOCK), distance)
    # A block is at most BLOCK codes, so these rows are of bounded size.
    filled = materialise(
        placed.groupBy("index", "block").agg(F.sort_array(F.collect_list(F.struct("place", "code")))["code"].alias("codes"))
        .mapInPandas(_packed, "index int, block long, codes binary"), "blocks")
    # Few pairs of blocks a task, so that what a Python worker holds at once stays bounded.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() // 16))
    joined = (
        pairs.join(filled.select("index", F.col("block").alias("a"), F.col("codes").alias("x")), ["index", "a"])
        .join(filled.select("index", F.col("block").alias("b"), F.col("codes").alias("y")), ["index", "b"])
        .withColumn("y", F.when(F.col("a") != F.col("b"), F.col("y"))))
    links = joined.repartition(tasks).mapInPandas(_links(distance), "u long, v long")
    return components(materialise(links, "links")).withColumnRenamed("node", "code")


def _grouped(docs: DataFrame, shingle: int, distance: int, least: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, version, code) of each row; (code, root) of each distinct code; the ``least`` of each root's rows."""
    coded = materialise(docs.select(
        "doc_id", F.xxhash64("text").alias("version"), fingerprints(F.col("text"), shingle).alias("code")), "codes")
    classes = materialise(coded.groupBy("code").agg(F.min(least).alias("least")), "classes")
    named = classes.join(linked(classes, distance), "code", "left").withColumn("root", F.coalesce("root", "code"))
    return coded, named.select("code", "root"), named.groupBy("root").agg(F.min("least").alias("least"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, code (long) and component_id, the least doc_id that is reachable.

    Null and blank texts have fingerprint zero and link like any other. Repeated rows come back repeated.
    Null doc_ids never become a component's id unless nothing else is in it (then the id is null).
    """
    coded, roots, least = _grouped(docs, shingle, distance, F.col("doc_id"))
    by_code = materialise(roots.join(least, "root").select("code", F.col("least").alias("component_id")), "components")
    return coded.join(by_code, "code").select("doc_id", "code", "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents without near copies: of each component the one with the least doc_id stays.

    Null doc_ids come last. If the kept doc_id stands for several texts of the component, the one of the
    least hash stays; texts that share a doc_id but are no near copies are different documents and all stay.
    Rows that agree in doc_id and text are one document: one of them stays.
    """
    _, _, first = _grouped(docs, shingle, distance, F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "version"))
    kept = first.select(F.col("least.doc_id").alias("__kept_id"), F.col("least.version").alias("__kept_version"))
    same = F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.col("__version") == F.col("__kept_version"))
    return docs.withColumn("__version", F.xxhash64("text")).join(kept, same) \
        .dropDuplicates(["doc_id", "__version"]).drop("__version", "__kept_id", "__kept_version")
