"""Token counts of whole texts, by overlap resynchronisation where a text is huge.

A text of up to ``chunk`` characters is encoded as it is. A longer one is encoded in chunks that overlap, with
the offsets of their tokens, and the chunks are spliced after a token that both have: same place, same id.

Why that is exact. Merging by rank, leftmost first among equals, depends on nothing but the symbols next to
each other, so (1) the tokens i..j of an encoding are the encoding of the text that they cover, and (2) tokens
of which any two neighbours are the encoding of their joint text are the encoding of the whole: the first
merge across one of their boundaries would also be made in the text of these two alone. Up to the common token
all neighbours are neighbours in the first chunk, from it on in the second. So one common token proves the
splice. Where an overlap holds none, it is widened, up to the whole of the chunk, and then the chunk grows.

This holds for BPE without rules on what a text's start or end looks like, apart from the blank that is put
before a text: later chunks are encoded without it. Tokenizers of other kinds encode each text as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf
from sentencepiece import sentencepiece_model_pb2 as model_format

from .common import read

CHUNK = 1 << 15
OVERLAP = 1 << 8
LIMIT = 4096
#: Texts are encoded so many characters at a time.
BATCH = 1 << 20


class Counter:
    """Counts the tokens that a SentencePiece model gives a text.

    ``spliced`` and ``widened`` count the splices and how often an overlap was too short.
    """

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        if not 0 < overlap < chunk:
            raise ValueError("an overlap is shorter than a chunk")
        self.chunk, self.overlap = chunk, overlap
        self.spliced = self.widened = 0
        with open(path, "rb") as f:
            model = model_format.ModelProto.FromString(f.read())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.splits = model.trainer_spec.model_type == model_format.TrainerSpec.BPE \
            and not model.normalizer_spec.precompiled_charsmap \
            and not model.normalizer_spec.remove_extra_whitespaces \
            and not any(p.type == model_format.ModelProto.SentencePiece.UNUSED for p in model.pieces)
        model.normalizer_spec.add_dummy_prefix = False
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())

    def counts(self, texts: list[str]) -> list[int]:
        out, some, size = [0] * len(texts), [], 0
        for at, text in enumerate(texts):
            if self.splits and len(text) > self.chunk:
                out[at] = self.spliced_count(text)
                continue
            some.append(at)
            size += len(text)
            if size > BATCH:
                self._plain(texts, some, out)
                some, size = [], 0
        self._plain(texts, some, out)
        return out

    def _plain(self, texts: list[str], some: list[int], out: list[int]) -> None:
        for at, ids in zip(some, self.whole.encode_as_numpy([texts[at] for at in some], num_threads=1)):
            out[at] = len(ids)

    def _tokens(self, text: str, begin: int, end: int) -> list[tuple[int, int, int]]:
        """Of a part of the text: begin and end in the text, and id. Bytes of one character but the last are empty."""
        found = (self.inner if begin else self.whole).encode_as_offset_mapping(text[begin:end])
        return [(a + begin, b + begin, i) for (a, b), i in zip(found["offsets"], found["ids"])]

    def spliced_count(self, text: str) -> int:
        begin, end, total = 0, min(self.chunk, len(text)), 0
        tokens, done = self._tokens(text, begin, end), 0  # done: tokens of the chunk that are counted already
        overlap = self.overlap
        while end < len(text):
            # The next chunk begins with a token of this one, so both see the same text from there on.
            later = next((a for a, b, _ in reversed(tokens) if a < b and a <= end - overlap), begin)
            if later <= begin:  # nothing left to widen: a longer chunk
                end = min(begin + 2 * (end - begin), len(text))
                tokens, overlap = self._tokens(text, begin, end), self.overlap
                continue
            stop = min(max(later + self.chunk, 2 * end - later), len(text))
            following = self._tokens(text, later, stop)
            common = self._common(tokens, done, following, later, end)
            if common is None:
                overlap *= 2
                self.widened += 1
                continue
            here, there = common
            total += here + 1 - done
            tokens, done, begin, end, overlap = following, there + 1, later, stop, self.overlap
            self.spliced += 1
        return total + len(tokens) - done

    def _common(self, tokens, done, following, later, end):
        """Places of the first token, counted in neither chunk, that both have; not the one at the second's start,
        nor an empty one."""
        first = {token: at for at, token in enumerate(following) if at and later < token[0] < token[1] <= end}
        for at in range(max(done - 1, 0), len(tokens)):
            if tokens[at] in first:
                return at, first[tokens[at]]
        return None


_counters: dict[tuple, Counter] = {}


def _counter(path: str, chunk: int, overlap: int) -> Counter:
    """One for each Python worker."""
    key = (path, chunk, overlap)
    if key not in _counters:
        _counters[key] = Counter(path, chunk, overlap)
    return _counters[key]


def token_count(text: Column | str, model: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """The number of tokens of a text column; null texts have as many as empty ones."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(model, chunk, overlap)
        for batch in batches:
            yield pd.Series(counter.counts(batch.fillna("").tolist()), dtype="int64")

    return pandas_udf(run, "long")(text)


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit to the documents.

    ``docs`` has text; other columns stay, but for those of the added names, which are replaced. A null text
    counts as an empty one, repeated rows each for themselves, and an empty table gives none. No text is cut:
    control strings inside texts are ordinary text, as the library's default has it, and nothing is put around them.
    """
    own = ["n_bytes", "n_tokens", "over_limit"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in own], F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(text, model, chunk, overlap).alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_model()).drop("text")
