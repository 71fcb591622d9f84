"""Byte-level BPE encoding and decoding with a rank queue.

Text is cut by the vocabulary's pattern, and in each piece the neighbouring parts whose bytes together
have the lowest rank are joined, the leftmost first, until no neighbours have a rank. Instead of
searching all neighbours for the lowest rank again and again, positions wait in one bucket per rank,
and a two-level bitmap tells by find-first-set which bucket comes next. Parts form
a linked list, so a join touches two neighbours only; entries that a join has outdated stay in their
buckets and are skipped. A piece of n bytes takes O(n log n) steps, also when it is a megabyte long.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stage, text_of, trimmed

#: Pieces of at most so many characters are remembered, in two generations of so many.
REMEMBER_CHARS, REMEMBER = 48, 300_000
#: Ranks in one word of the bitmap's lower level, as a power of two.
WORD = 8


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """``known`` may be shared by encoders of the same ranks and pattern: ids of pieces seen, newer and older.

    When the newer ones are full they become the older ones; a piece found among those is new again,
    so that frequent pieces stay.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, known: list[dict[str, bytes]] | None = None):
        self._ranks = ranks
        self._longest = max(map(len, ranks), default=1)
        # Ranks of all pairs of bytes, at 256 times the first plus the second.
        self._two = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        # The lower level of the bitmap, all zero between pieces.
        self._words = [0] * ((max(ranks.values(), default=0) >> WORD) + 1)
        self._pieces = regex.compile(pattern).findall
        # In ASCII text the letters are A-Z and a-z, the digits 0-9, so the standard matcher will do.
        narrow = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self._ascii_pieces = self._pieces if r"\p" in narrow else re.compile(narrow, re.ASCII).findall
        self._known = [{}, {}] if known is None else known

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        rank_of, longest, words = self._ranks.get, self._longest, self._words
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n, two = len(piece), self._two
        waits = [two[a << 8 | b] for a, b in pairwise(piece)]  # the rank under which a position waits, -1: none
        if max(waits) < 0:
            return [rank_of(piece[i : i + 1]) for i in range(n)]
        waits.append(-1)
        after = list(range(1, n + 2))  # where the next part begins
        before = list(range(-1, n))
        # One position as a number, several as a heap, so that the leftmost comes first.
        buckets: dict[int, int | list[int]] = {}
        top = 0  # the upper level: a bit for every word that is not zero
        mask = (1 << WORD) - 1
        fresh = enumerate(waits)
        while True:
            for i, rank in fresh:
                if rank < 0:
                    continue
                held = buckets.get(rank)
                if held is None:
                    buckets[rank] = i
                    word = rank >> WORD
                    top |= 1 << word
                    words[word] |= 1 << (rank & mask)
                elif type(held) is int:
                    buckets[rank] = [held, i] if held < i else [i, held]
                else:
                    heapq.heappush(held, i)
            # The lowest rank with a position that still waits under it.
            while top:
                word = (top & -top).bit_length() - 1
                bits = words[word]
                rank = word << WORD | (bits & -bits).bit_length() - 1
                i = buckets[rank]
                if type(i) is not int:
                    held = i
                    i = heapq.heappop(held)
                    if len(held) == 1:
                        buckets[rank] = held[0]
                else:
                    del buckets[rank]
                    words[word] = bits = bits & (bits - 1)
                    if not bits:
                        top &= top - 1
                if waits[i] == rank:
                    break
            else:
                break
            gone = after[i]
            end = after[gone]
            after[i] = end
            waits[gone] = -1
            left = before[i]
            ranked = -1
            if end < n:
                before[end] = i
                stop = after[end]
                if stop - i <= longest:
                    ranked = rank_of(piece[i:stop], -1)
            waits[i] = ranked
            if left >= 0:
                before_it = rank_of(piece[left:end], -1) if end - left <= longest else -1
                waits[left] = before_it
                fresh = (i, ranked), (left, before_it)
            else:
                fresh = ((i, ranked),)
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(piece[i : after[i]]))
            i = after[i]
        return ids

    def _packed(self, piece: str) -> bytes:
        newer, older = self._known
        packed = older.get(piece) or array("I", self.merged(piece.encode())).tobytes()
        if len(piece) <= REMEMBER_CHARS and len(newer) < 2 * REMEMBER:
            newer[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit numbers."""
        pieces = self._ascii_pieces(text) if text.isascii() else self._pieces(text)
        if len(self._known[0]) >= REMEMBER:
            self._known[:] = {}, self._known[0]
        newer = self._known[0]
        try:
            return b"".join([newer[p] for p in pieces])
        except KeyError:
            return b"".join([newer.get(p) or self._packed(p) for p in pieces])


class Decoder:
    """Bytes of token ids, gathered for many texts at once."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self._tokens = pa.array(tokens, pa.large_binary())

    def decode(self, ids: list[bytes]) -> list[bytes]:
        taken = self._tokens.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        if not len(taken):
            return [b""] * len(ids)
        # The bytes of all tokens stand one after the other.
        ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :]
        data, out, at = memoryview(taken.buffers()[2]), [], 0
        for one in ids:
            stop = at + len(one) // 4
            out.append(bytes(data[ends[at] : ends[stop]]))
            at = stop
        return out


def _run(docs: DataFrame, ranks: dict[bytes, int], pattern: str, decoded: bool) -> DataFrame:
    stage(docs.sparkSession)
    # The second entry stays empty here; a worker process fills its own copy and uses it for all its tasks.
    shared = docs.sparkSession.sparkContext.broadcast((ranks, [{}, {}]))
    names = ["doc_id", "n_tokens", "ids", "decoded"][: 4 if decoded else 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value[0], pattern, shared.value[1])
        decoder = Decoder(shared.value[0]) if decoded else None
        for batch in batches:
            ids = [encoder.encode(t) if t else b"" for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoder:
                columns.append(pa.array(decoder.decode(ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    types = ", ".join(f"{n} {t}" for n, t in zip(names, (id_type, "long", "binary", "binary")))
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(trimmed(run), types)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per row ``doc_id, n_tokens, ids``; ``ids`` are little-endian unsigned 32-bit numbers.

    Null and empty texts have no ids. Texts are whole; no special tokens. The ranks are a vocabulary
    of fixed size, read by the driver and broadcast.
    """
    return _run(docs, ranks, pattern, decoded=False)


def decoder(spark, ranks: dict[bytes, int]):
    """A column function from ``ids`` to the bytes they stand for; null for null."""
    shared = spark.sparkContext.broadcast(ranks)

    @F.arrow_udf("binary")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = Decoder(shared.value)
        for column in columns:
            found = tokens.decode(column.fill_null(b"").to_pylist())
            yield pa.array([None if gone else x for gone, x in zip(column.is_null().to_pylist(), found, strict=True)], pa.binary())

    return run


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``encode`` with ``decoded``: the bytes of the ids, which equal the text's, from the same pass."""
    return _run(docs, ranks, pattern, decoded=True)
