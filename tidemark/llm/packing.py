"""Packing: order-preserving dynamic programming over document and sentence boundaries.

The documents of a partition form one stream of tokens, in the order in which they come. Windows of at most
``length`` tokens are cut from it, at the end of a document or, at a price, at the end of a sentence. The
cheapest way to end a window at a boundary is the least over all boundaries within reach before it; as the
price of padding falls evenly with the window's start, that least is the head of a monotone queue, and each
boundary enters and leaves it once. Windows whose size is a power of two need no padding and are tried too.

A partition is worked off in stretches of bounded size, whose last windows stay open for the next stretch,
so memory does not grow with the input and only the last window of a partition is padded for lack of text.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import read

LENGTH = 2048
END = 1
SENTENCE_CUT = 8
FORCED_CUT = 256
STRETCH = 1 << 19
CACHED_PARTS = 400_000
#: Texts are encoded so many at a time.
TEXTS = 512
_POWERS = [1 << k for k in range(11)]


class Encoder:
    """Token ids of texts by a tokenizer file, as ``encode(text, add_special_tokens=False)`` gives them.

    Tokenizers that lower-case, split by a pattern, drop white space and merge inside the parts give a part
    the same ids everywhere. For them, plain Latin texts are split column-wise, and the ids of each distinct
    part are remembered, up to CACHED_PARTS parts. All other tokenizers and texts go to the library as they are.
    """

    #: The split pattern of the tokenizers that this shortcut knows, and what of it is no letter.
    _KNOWN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _MARKS = r"('s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}]+)"
    _ODD = r"[^\t\n\r -~¡-¬®-įı-ɏ‐-‧]|<\|"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_part = steps == ["NFC", "Replace", "Lowercase"] and splits[:1] == [self._KNOWN] and len(splits) == 2 and bool(suffix)
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        if self.by_part:  # ids that close a part
            self.ends[[i for token, i in self.library.get_vocab().items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # part -> its number
        self.ids = np.zeros(1 << 16, "<u4")  # the ids of all parts, one after another
        self.stops = np.zeros(1 << 16, np.int64)  # where part number k - 1 ends, hence part k begins

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[str]) -> None:
        """Remember new parts: many are encoded as one text and told apart by the ids that close a part."""
        for at in range(0, len(parts), 512):
            some = parts[at:at + 512]
            raw = self._plain([" ".join(some)])[0]
            stops = np.flatnonzero(self.ends[raw]) + 1
            if len(stops) != len(some) or stops[-1] != len(raw):
                each = self._plain(some)
                raw, stops = np.concatenate(each), np.cumsum([len(x) for x in each])
            n, used = len(self.known), int(self.stops[len(self.known)])
            if used + len(raw) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(raw), "<u4")])
            if n + len(some) + 1 > len(self.stops):
                self.stops = np.concatenate([self.stops, np.zeros(len(self.stops) + len(some), np.int64)])
            self.ids[used:used + len(raw)] = raw
            self.stops[n + 1:n + 1 + len(some)] = used + stops
            self.known.update(zip(some, range(n, n + len(some))))

    def _by_part(self, texts: pa.Array) -> list[np.ndarray]:
        marked = pc.replace_substring_regex(pc.utf8_lower(texts), self._MARKS, r" \1 ")
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(marked))
        flat = pc.list_flatten(split)
        coded = flat.dictionary_encode()
        parts = coded.dictionary.to_pylist()
        if len(self.known) + len(parts) > CACHED_PARTS:
            self._forget()
        self._learn([p for p in parts if p and p not in self.known])
        self.known[""] = -1  # of an empty text: no ids
        number = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        del self.known[""]
        begin = self.stops[np.maximum(number, 0)]
        size = np.where(number < 0, 0, self.stops[number + 1] - begin)
        of = coded.indices.to_numpy()
        sizes = size[of]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(begin[of] - (ends - sizes), sizes)
        ids = self.ids[places]
        stops = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """For each text (no nulls) its ids, unsigned 32-bit numbers."""
        odd = pc.match_substring_regex(texts, self._ODD).to_numpy(zero_copy_only=False) if self.by_part else np.ones(len(texts), bool)
        out: list = [None] * len(texts)
        for places, coded in (
                (np.flatnonzero(~odd), self._by_part), (np.flatnonzero(odd), lambda x: self._plain(x.to_pylist()))):
            if len(places):
                for i, ids in zip(places.tolist(), coded(texts.take(pa.array(places)))):
                    out[i] = ids
        return out

    def sentence_ends(self) -> np.ndarray:
        """By id, whether the token ends a sentence."""
        out = np.zeros(self.library.get_vocab_size(), bool)
        for x in self._plain([".", "!", "?", "…"]):
            out[x[-1:]] = True
        return out


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One for each Python worker, whose words later tasks find again."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts(ends: np.ndarray, prices: np.ndarray, length: int, closed: bool) -> list[int]:
    """The cheapest window ends over a stream from 0, as places in ``ends``.

    ``ends``: boundaries, ascending from above 0, never more than ``length`` apart; ``prices``: of a cut at
    each. ``closed``: the last boundary must be a cut; else the cheapest one within reach of it may be last.
    """
    where = np.concatenate([[0], ends])
    n = len(where)
    jumps: list = [()] * n
    place = np.full(int(where[-1]) + 1, -1, np.int64)
    place[where] = np.arange(n)
    for power in _POWERS:
        if power < length:
            source = where - power
            hit = np.flatnonzero(source >= 0)
            hit = hit[place[source[hit]] >= 0]
            for j, i in zip(hit.tolist(), place[source[hit]].tolist()):
                jumps[j] = (*jumps[j], i)
    at, price = where.tolist(), [0, *prices.tolist()]
    cost, back = [0] * n, [0] * n
    queue, rank = deque([0]), [0] * n  # rank: cost so far plus position, what decides between window starts
    for j in range(1, n):
        here = at[j]
        while here - at[queue[0]] > length:
            queue.popleft()
        first = queue[0]
        best = rank[first] + length - here
        for i in jumps[j]:
            if cost[i] < best:
                best, first = cost[i], i
        best += price[j]
        cost[j], back[j], rank[j] = best, first, best + here
        while queue and rank[queue[-1]] >= best + here:
            queue.pop()
        queue.append(j)
    j = n - 1
    if not closed:
        tail = np.flatnonzero(where > where[-1] - length)
        j = int(tail[np.argmin(np.array(cost)[tail])])
    path = []
    while j:
        path.append(j - 1)
        j = back[j]
    return path[::-1]


class _Stream:
    """The open part of a partition's token stream."""

    def __init__(self, length: int, enders: np.ndarray, sentence_cut: int, forced_cut: int, first: int):
        self.length, self.enders, self.sentence_cut, self.forced_cut = length, enders, sentence_cut, forced_cut
        self.docs: list[tuple] = []  # doc_id, ids, tokens of it that are packed
        self.size, self.sequence = 0, first

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0))
        self.size += len(ids)

    def _boundaries(self) -> tuple[np.ndarray, np.ndarray]:
        ends, prices, at = [], [], 0
        for _, ids, packed in self.docs:
            rest = ids[packed:]
            inside = np.flatnonzero(self.enders[rest[:-1]]) + 1
            ends += [at + inside, [at + len(rest)]]
            prices += [np.full(len(inside), self.sentence_cut), [0]]
            at += len(rest)
        ends, prices = np.concatenate(ends).astype(np.int64), np.concatenate(prices).astype(np.int64)
        gaps = np.diff(ends, prepend=0)
        wide = np.flatnonzero(gaps > self.length // 2)
        if len(wide):  # sentences too long to leave whole: places to cut them, at a higher price
            forced = np.concatenate([np.arange(ends[k] - gaps[k] + self.length // 2, ends[k], self.length // 2) for k in wide])
            ends, prices = np.concatenate([ends, forced]), np.concatenate([prices, np.full(len(forced), self.forced_cut)])
            order = np.argsort(ends, kind="stable")
            ends, prices = ends[order], prices[order]
        return ends, prices

    def pack(self, closed: bool) -> list[tuple]:
        if not self.docs:
            return []
        ends, prices = self._boundaries()
        stops = ends[cuts(ends, prices, self.length, closed)].tolist()
        out, k, (doc_id, ids, packed) = [], 0, self.docs[0]
        begin = 0
        for stop in stops:
            offset, size = 0, stop - begin
            while offset < size:
                take = min(size - offset, len(ids) - packed)
                out.append((doc_id, packed, take, zlib.crc32(ids[packed:packed + take].tobytes()), len(ids),
                            self.sequence, offset, size if size & (size - 1) == 0 else self.length))
                offset, packed = offset + take, packed + take
                if packed == len(ids):
                    k += 1
                    doc_id, ids, packed = self.docs[k] if k < len(self.docs) else (None, (), 0)
            begin, self.sequence = stop, self.sequence + 1
        self.docs = [(doc_id, ids, packed), *self.docs[k + 1:]] if k < len(self.docs) else []
        self.size -= begin
        return out


_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, sentence_cut: int = SENTENCE_CUT,
         forced_cut: int = FORCED_CUT) -> DataFrame:
    """The pieces of the documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and
    sequence_length (the padded size of the sequence).

    ``docs`` has doc_id and text; other columns are not read. A document is its ids and the end id 1, so null
    and empty texts give one token. Every row is packed, repeated ones again; null doc_ids stay null. Order
    is that of the rows in their partitions, and sequence ids tell the partition (high bits) and the place in
    it, so a task that runs again gives the same rows. An empty table gives no rows. ``length`` is a power of two.
    """
    def run(batches):
        encoder = _encoder(tokenizer)
        stream = _Stream(length, encoder.sentence_ends(), sentence_cut, forced_cut, TaskContext.get().partitionId() << 32)
        def frame(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * len(_COLUMNS))], _COLUMNS)

        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                some = batch.slice(at, TEXTS)
                texts = pc.fill_null(some.column("text").cast(pa.large_string()), "")
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(texts)):
                    stream.add(doc_id, np.append(ids, np.uint32(END)))
                if stream.size >= STRETCH:
                    yield frame(stream.pack(closed=False))
        yield frame(stream.pack(closed=True))

    kinds = ", ".join(f"{c} long" for c in _COLUMNS)
    return docs.select("doc_id", "text").mapInArrow(run, kinds)


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizer())
