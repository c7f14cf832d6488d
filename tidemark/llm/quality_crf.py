"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's features are statistics of itself and of the lines before and after it;
transition weights tie neighbouring labels. The lines' labels are latent: all that a document's label says
is what share of its text, by length, is expected to be good. A good document is good throughout, a bad one has at
least LEAST_BAD of its text in bad lines, whichever these are. Weights are learned on a bounded sample of labelled
documents, emissions first and transitions after them. A document's quality is the mean of the lines'
forward-backward marginals, weighted by length, on a scale that is fitted to the labels of the same sample.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import materialise, read

#: At most so many labelled documents are learned from, picked by a hash of their id.
SAMPLE = 4000
#: And from at most so many of their lines in all, in the order of that hash; longer documents than MOST_LINES do not teach.
SAMPLE_LINES, MOST_LINES = 200_000, 20_000
#: So many different texts of one doc_id teach, those of the least hashes.
VERSIONS = 64
THRESHOLD = 0.7
#: The share of a bad document's text that its bad lines make up at least.
LEAST_BAD = 0.2
#: Steps without transitions, and with them; the pull of the weights and of the transitions to zero.
ROUNDS, CHAINED = 250, 40
PULL, MOVE_PULL = 1e-4, 1e-2
_SYMBOLS = re.compile(r"[#*$%&|<>~^_=+\\{}\[\]@]").findall
_N = 13


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n, 3 * _N) features and the lengths of the lines that have a word; no rows for an empty text."""
    lines = [x for line in (text or "").split("\n") if (x := line.strip())]
    own, seen = np.zeros((len(lines) + 2, _N)), set()
    for i, line in enumerate(lines, 1):
        words = line.split()
        n, chars = len(words), len(line)
        kinds = len(set(words))
        same = sum(map(str.__eq__, words, words[1:]))
        symbols = _SYMBOLS(line)
        letters = sum(map(len, words)) or 1
        own[i] = (
            1, np.log1p(n), min(letters / n, 40) / 10, len(symbols) / letters, min(len(symbols) / n, 4),
            kinds / n, same / n, sum(map(line.count, "0123456789")) / letters, line.count("|") / n,
            line[-1] in ".!?\"')", line in seen, (n < 4), min(np.log1p(max(map(len, words))), 8))
        seen.add(line)
    return np.hstack([own[1:-1], own[:-2], own[2:]]), np.array([len(x) for x in lines], float)


@dataclass
class Chain:
    """Weights of the field: ``emit`` of label good against bad, ``move`` between labels (bad 0, good 1)."""

    mean: np.ndarray
    scale: np.ndarray
    emit: np.ndarray
    move: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])

    def marginals(self, emissions: np.ndarray, sizes: np.ndarray):
        """P(good) of each line, the expected transitions, and the log-partition of each document.

        ``emissions``: log-odds of good, documents one after another, ``sizes`` lines each (none empty).
        Documents are worked off together, a line at a time, the longest first.
        """
        order = np.argsort(-sizes, kind="stable")
        first = (np.cumsum(sizes) - sizes)[order]
        size, n = sizes[order], len(sizes)
        potential = np.exp(np.clip(np.stack([-emissions, emissions], 1) / 2, -30, 30))
        step = np.exp(np.clip(self.move, -30, 30))
        ahead, behind = np.zeros((len(emissions), 2)), np.ones((len(emissions), 2))
        log_z = np.zeros(n)
        steps = int(size[0]) if n else 0
        alive = [int(np.searchsorted(-size, -t, "left")) for t in range(steps)]  # documents with more than t lines
        for t in range(steps):
            at = first[:alive[t]] + t
            now = potential[at] * (ahead[at - 1] @ step if t else 1.0)
            norm = now.sum(1, keepdims=True)
            ahead[at] = now / norm
            log_z[order[:alive[t]]] += np.log(norm[:, 0])
        for t in range(steps - 2, -1, -1):
            at = first[:alive[t + 1]] + t
            back = (potential[at + 1] * behind[at + 1]) @ step.T
            behind[at] = back / back.sum(1, keepdims=True)
        good = ahead * behind
        good /= good.sum(1, keepdims=True)
        inner = np.ones(len(emissions), bool)
        inner[first + size - 1] = False
        i = np.flatnonzero(inner)
        pair = ahead[i][:, :, None] * step[None] * (potential[i + 1] * behind[i + 1])[:, None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        return good[:, 1], pair.sum(0), log_z

    def raw(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Length-weighted mean P(good) by document; not a number for documents without lines."""
        out = np.full(len(documents), np.nan)
        full = [k for k, (x, _) in enumerate(documents) if len(x)]
        if full:
            sizes = np.array([len(documents[k][0]) for k in full])
            emissions = self.inputs(np.vstack([documents[k][0] for k in full])) @ self.emit
            lengths = np.concatenate([documents[k][1] for k in full])
            good = self.marginals(emissions, sizes)[0]
            starts = np.cumsum(sizes) - sizes
            out[full] = np.add.reduceat(good * lengths, starts) / np.add.reduceat(lengths, starts)
        return out

    def scores(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        raw = self.raw(documents)
        p = np.clip(raw, 1e-6, 1 - 1e-6)
        scaled = 1 / (1 + np.exp(-np.clip(self.slope * np.log(p / (1 - p)) + self.shift, -50, 50)))
        return np.where(np.isnan(raw), 0.5, scaled)


def _blame(share: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Derivative of the documents' mean log-likelihood by their shares of good text.

    A good document has log(share), a bad one log(bad share / LEAST_BAD) until that share is reached.
    """
    bad = 1 - share
    return np.where(labels == 1, 1 / np.maximum(share, 1e-3),
                    np.where(bad < LEAST_BAD, -1 / np.maximum(bad, 1e-3), 0.0)) / len(labels)


def _ascent(gradient, theta: np.ndarray, rounds: int, rate: float) -> np.ndarray:
    """Adam's steps up a gradient."""
    m, v = 0.0, 0.0
    for k in range(1, rounds + 1):
        g = gradient(theta)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g ** 2
        theta = theta + rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return theta


def fit(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Chain:
    """Weights from documents with lines; one kind of label only gives a field that follows that label."""
    sizes = np.array([len(x) for x, _ in documents], int)
    raw = np.vstack([x for x, _ in documents]) if documents else np.zeros((0, 3 * _N))
    mean, scale = (raw.mean(0), raw.std(0)) if len(raw) else (np.zeros(3 * _N), np.ones(3 * _N))
    chain = Chain(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(3 * _N + 1), np.zeros((2, 2)))
    if not len(raw):
        return chain
    x, starts = chain.inputs(raw), np.cumsum(sizes) - sizes
    part = np.concatenate([w / w.sum() for _, w in documents])  # of its document's text, by line

    def wanted(good: np.ndarray) -> np.ndarray:
        """What a line's marginal should gain, by line."""
        return np.repeat(_blame(np.add.reduceat(good * part, starts), labels), sizes) * part

    def alone(emit: np.ndarray) -> np.ndarray:
        good = 1 / (1 + np.exp(-np.clip(x @ emit, -30, 30)))
        return x.T @ (wanted(good) * good * (1 - good)) - PULL * emit

    def chained(theta: np.ndarray) -> np.ndarray:
        # The expected share's derivative by a weight is the derivative of that weight's expected feature
        # in the direction of the lines' parts, so two more passes, to either side, give all of them.
        chain.move = theta[-4:].reshape(2, 2)
        emissions = x @ theta[:-4]
        gain = wanted(chain.marginals(emissions, sizes)[0])
        reach = 1e-3 / max(np.abs(gain).max(), 1e-12)
        (up, moves_up, _), (down, moves_down, _) = (
            chain.marginals(emissions + side * reach * gain, sizes) for side in (1, -1))
        by_line, by_move = (up - down) / (2 * reach), (moves_up - moves_down).ravel() / (2 * reach)
        return np.concatenate([x.T @ by_line, by_move]) - np.r_[PULL * theta[:-4], MOVE_PULL * theta[-4:]]

    emit = _ascent(alone, chain.emit, ROUNDS, 0.1)
    theta = _ascent(chained, np.concatenate([emit, np.zeros(4)]), CHAINED, 0.02)
    chain.emit, chain.move = theta[:-4], theta[-4:].reshape(2, 2)
    p = np.clip(chain.raw(documents), 1e-6, 1 - 1e-6)
    z, slope, shift = np.log(p / (1 - p)), 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic scale with a slight pull to the raw score
        q = 1 / (1 + np.exp(-np.clip(slope * z + shift, -50, 50)))
        w = q * (1 - q)
        g = np.array([(z * (labels - q)).sum() - (slope - 1), (labels - q).sum() - shift])
        h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, shift = max(slope + move[0], 0.05), shift + move[1]
    chain.slope, chain.shift = float(slope), float(shift)
    return chain


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """The field, from at most ``sample`` labelled documents that are not held out, whole texts, SAMPLE_LINES
    lines in all, repeated rows once."""
    chosen = (
        labels.filter("doc_id is not null and quality is not null").filter(~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("__label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def featured(batches):
        for batch in batches:
            found = [line_features(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "label": batch["__label"],
                "x": [x.astype("<f8").tobytes() for x, _ in found], "n": [w.tobytes() for _, w in found]})

    # At most ``sample`` ids are broadcast. One short row of each text tells which fit; their line statistics come back.
    own = Window.partitionBy("doc_id").orderBy("hash")
    texts = materialise(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("hash", F.sha2("text", 256))
        .dropDuplicates(["doc_id", "hash"]).withColumn("n", F.row_number().over(own)).filter(F.col("n") <= VERSIONS).drop("n")
        .withColumn("lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")).filter(F.col("lines") <= MOST_LINES),
        "taught")
    in_order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "hash").rowsBetween(Window.unboundedPreceding, 0)
    fitting = texts.select("doc_id", "hash", F.sum("lines").over(in_order).alias("upto")) \
        .filter(F.col("upto") <= SAMPLE_LINES).select("doc_id", F.col("hash").alias("kept_hash"))
    rows = texts.join(F.broadcast(fitting.withColumnRenamed("doc_id", "kept_id")),
                      (F.col("doc_id") == F.col("kept_id")) & F.col("hash").eqNullSafe(F.col("kept_hash"))) \
        .select("doc_id", "text", "__label").mapInPandas(featured, "doc_id long, label int, x binary, n binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    documents = [(np.frombuffer(r["x"], "<f8").reshape(-1, 3 * _N), np.frombuffer(r["n"], "<f8")) for r in rows]
    full = [k for k, (x, _) in enumerate(documents) if len(x)]
    return fit([documents[k] for k in full], np.array([rows[k]["label"] for k in full], float))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    ``labels`` has doc_id and quality (1 good, 0 bad; null ones are left out, the lowest of several counts).
    Texts without a word, null ones included, score 0.5 (nothing speaks for them: predicted 0). Rows with a
    null doc_id are scored and not held out. Without any label every score is 0.5. A text's score depends on
    nothing but the text and the field.
    """
    chain = learn(docs, labels, sample)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = [chain.scores([line_features(t) for t in texts.iloc[at:at + 500]]) for at in range(0, len(texts), 500)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.select("doc_id", held_out().alias("held_out"), score("text").alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
