"""Alignment of two tokenizers: which tokens cover the same bytes, and how usual each pair is.

Both tokenizers spell the same bytes. Where tokens of both end at the same byte the text is cut, and
the tokens between two cuts are a group; every token of one side is linked with every token of the
other side in its group. How many documents hold a pair of ids linked is counted over the whole
corpus by external spill counting:

* tasks collect (pair, document) records and, when ``SPILL`` of them wait, sort them by radix, then by
  the id of the first side, and write them as a run of zstd segments, one per radix. A segment's
  header lists its pairs with their number of documents, its body the documents themselves;
* the headers of a radix are merged with a heap, ``FAN`` runs at a time, until one is left. Pairs come
  out in order of the first side's id, so the highest count of an id is known when its last pair has
  passed, and counts and marks of the highest are streamed out together;
* the counts of a run's own pairs go back to the run, where they are summed by document.

A run has one header entry for a pair, however many documents hold it, so an id that is in every
document loads no task more than others; runs, headers and merges are of bounded size.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stage, text_of, trimmed
from casemill.llm.words import mix

#: Records and documents of a run at most (one document's records stay together).
SPILL, RUN_DOCS = 2_000_000, 60_000
RADIX, FAN = 64, 128
#: Groups with more links than this are reduced to distinct ids before they are linked.
WIDE = 64
_LEVEL = 1


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_level_tokens(vocabulary: str) -> dict[bytes, int]:
    """Bytes and ids of the tokens in the JSON text of a byte-level BPE vocabulary, without special tokens.

    The ids must grow in the order of the merges, as ids of such vocabularies do, so that they also
    serve as ranks.
    """
    content = json.loads(vocabulary)
    ids, letters = content["model"]["vocab"], byte_letters()
    special = {t["content"] for t in content["added_tokens"]}
    made = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in content["model"]["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])) or (made and made[0] < 256):
        raise ValueError("ids of the vocabulary do not follow the order of its merges")
    return {bytes(map(letters.__getitem__, token)): n for token, n in ids.items() if token not in special}


class Aligner:
    """Encodes texts with both tokenizers and aligns their tokens."""

    def __init__(self, byte_level: str, pieces: bytes, pattern: str):
        import sentencepiece
        import tiktoken

        ranks = byte_level_tokens(byte_level)
        self._a = tiktoken.Encoding("byte level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.n_a, self.n_b = max(ranks.values()) + 1, self._b.get_piece_size()
        bytes_a = [b""] * self.n_a
        for token, n in ranks.items():
            bytes_a[n] = token
        bytes_b = [self._bytes_b(n) for n in range(self.n_b)]
        self._bytes = [pa.array(x, pa.large_binary()) for x in (bytes_a, bytes_b)]
        self._sizes = [np.array([len(t) for t in x]) for x in (bytes_a, bytes_b)]
        # Ids as text, each with every sign that may follow it in a list of groups.
        self._signs = pa.array([f"{n}{sign}" for size in (self.n_a, self.n_b) for sign in ",|;" for n in range(size)], pa.large_string())

    def _bytes_b(self, n: int) -> bytes:
        piece = self._b.id_to_piece(n)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(n) else piece.replace("▁", " ").encode()

    def _spelt(self, side: int, ids: np.ndarray) -> bytes:
        taken = self._bytes[side].take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], np.int64)
        return taken.buffers()[2].to_pybytes()[ends[0] : ends[len(taken)]] if len(taken) else b""

    def encoded(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; None for a text without tokens."""
        if not text:
            return None
        a = np.array(self._a.encode_ordinary(f" {text}"), np.int64)
        b = np.array(self._b.encode(text, num_threads=1), np.int64)
        want = f" {text}".encode()
        return (a, b) if self._spelt(0, a) == want and self._spelt(1, b) == want else None

    def align(self, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
        """Columns by text, and the linked pairs: index of the text, pair, how often it is linked there.

        A pair is a number, the first side's id times the second side's vocabulary plus its id.
        """
        sides = [self.encoded(t) for t in texts]
        size = [[len(s[side]) if s else 0 for s in sides] for side in (0, 1)]
        none = [np.zeros(0, np.int64)]
        ids = [np.concatenate([s[side] for s in sides if s] or none) for side in (0, 1)]
        of = [np.repeat(np.arange(len(texts)), n) for n in size]
        ends = [np.cumsum(self._sizes[side][ids[side]]) for side in (0, 1)]
        cut = [np.isin(ends[side], ends[1 - side], assume_unique=True) for side in (0, 1)]
        group = [np.cumsum(c) - c for c in cut]
        groups = int(cut[0].sum())
        count = [np.bincount(g, minlength=groups) for g in group]
        owner = of[0][cut[0]]
        n_links = np.bincount(owner, weights=count[0] * count[1], minlength=len(texts)).astype(np.int64)
        columns = {
            "n_a": size[0], "n_b": size[1],
            "n_groups": np.bincount(owner, minlength=len(texts)).tolist(), "n_links": n_links.tolist(),
            "groups_sha256": self._digests(ids, group, cut, of, len(texts)),
        }
        return columns, *self._links(ids, group, count, owner)

    def _digests(self, ids: list, group: list, cut: list, of: list, n: int) -> list[str]:
        # Each token with the sign behind it: a comma inside a side, a bar or a semicolon at its end.
        a = ids[0] + np.where(cut[0], self.n_a, 0)
        b = ids[1] + 3 * self.n_a + np.where(cut[1], 2 * self.n_b, 0)
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        signs = self._signs.take(pa.array(np.concatenate([a, b])[order]))
        data = signs.buffers()[2]
        text = memoryview(data) if data is not None else memoryview(b"")
        ends = np.frombuffer(signs.buffers()[1], np.int64)[signs.offset : signs.offset + len(signs) + 1]
        stops = np.cumsum(np.bincount(np.concatenate(of), minlength=n)).tolist()
        out, start = [], 0
        for stop in stops:
            # Without the semicolon behind the last group.
            out.append(hashlib.sha256(text[ends[start] : ends[stop] - 1]).hexdigest() if stop > start else "")
            start = stop
        return out

    def _links(self, ids: list, group: list, count: list, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        times = [np.ones(len(x), np.int64) for x in ids]
        wide = count[0] * count[1] > WIDE
        if wide.any():
            for side in (0, 1):
                # In wide groups an id stands once, with its number of occurrences.
                key, n = np.unique(group[side][wide[group[side]]] << 32 | ids[side][wide[group[side]]], return_counts=True)
                narrow = ~wide[group[side]]
                g = np.concatenate([group[side][narrow], key >> 32])
                order = np.argsort(g, kind="stable")
                ids[side] = np.concatenate([ids[side][narrow], key & 0xFFFFFFFF])[order]
                times[side] = np.concatenate([times[side][narrow], n])[order]
                group[side] = g[order]
            count = [np.bincount(g, minlength=len(wide)) for g in group]
        per = count[1][group[0]]
        first = np.cumsum(count[1]) - count[1]
        at = np.repeat(np.arange(len(per)), per)
        other = np.arange(len(at)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(first[group[0]], per)
        pair = ids[0][at] * self.n_b + ids[1][other]
        pairs = self.n_a * self.n_b
        key = owner[group[0][at]] * pairs + pair
        weight = times[0][at] * times[1][other]
        order = np.argsort(key)
        key, weight = key[order], weight[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        return key[new] // pairs, key[new] % pairs, np.add.reduceat(weight, new) if len(new) else weight


def _zip(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=_LEVEL).compress(b"".join(a.tobytes() for a in arrays))


def _unzip(data: bytes, *types: str) -> list[np.ndarray]:
    """Arrays of equal length, one after the other."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = [np.dtype(t).itemsize for t in types]
    n, out, at = len(raw) // sum(sizes), [], 0
    for t, s in zip(types, sizes, strict=True):
        out.append(np.frombuffer(raw, t, n, at))
        at += n * s
    return out


def radix_of(pair: np.ndarray, n_b: int) -> np.ndarray:
    return (mix((pair // n_b).astype(np.uint64) + np.uint64(1)) % np.uint64(RADIX)).astype(np.int64)


class _Run:
    """Records of a task that wait to be written."""

    def __init__(self, n_b: int):
        self._n_b, self.records, self.docs = n_b, 0, 0
        self._parts: list[tuple] = []

    def add(self, doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        self._parts.append((doc.astype(np.int32), pair, times))
        self.records += len(doc)

    def segments(self) -> Iterator[tuple[int, bytes, bytes]]:
        """``radix, header, body``: pairs in order with their numbers of documents; documents and times linked."""
        if not self.records:
            return
        doc, pair, times = (np.concatenate(x) for x in zip(*self._parts, strict=True))
        self._parts.clear()
        order = np.lexsort((doc, pair, radix_of(pair, self._n_b)))
        doc, pair, times = doc[order], pair[order], times[order]
        radix = radix_of(pair, self._n_b)
        stops = np.flatnonzero(np.diff(radix, append=-1)) + 1
        start = 0
        for stop in stops.tolist():
            pairs, begin = np.unique(pair[start:stop], return_index=True)
            counts = np.diff(begin, append=stop - start)
            yield int(radix[start]), _zip(pairs, counts.astype(np.int64)), _zip(doc[start:stop], times[start:stop])
            start = stop


_DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_DOC_NAMES = [c.split()[0] for c in _DOC.split(", ")]


def _align_docs(shared, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = shared.value
        if not tools["made"]:  # once for each worker process
            tools["made"].append(Aligner(tools["byte_level"], tools["pieces"], pattern))
        aligner = tools["made"][0]
        number, waiting = TaskContext.get().partitionId() << 32, _Run(aligner.n_b)

        def written() -> Iterator[pa.RecordBatch]:
            for radix, header, body in waiting.segments():
                row = {"run": [number], "radix": pa.array([radix], pa.int32()), "header": pa.array([header], pa.binary()), "body": pa.array([body], pa.binary())}
                yield _filled(row, 1, kind)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            columns, doc, pair, times = aligner.align(batch.column("text").to_pylist())
            if waiting.records + len(doc) > SPILL or waiting.docs + batch.num_rows > RUN_DOCS:
                yield from written()
                number, waiting = number + 1, _Run(aligner.n_b)
            waiting.add(doc + waiting.docs, pair, times)
            no = pa.array(np.arange(waiting.docs, waiting.docs + batch.num_rows), pa.int32())
            waiting.docs += batch.num_rows
            row = {"run": [number] * batch.num_rows, "no": no, "doc_id": batch.column("doc_id")} | columns
            yield _filled(row, batch.num_rows, kind)
        if waiting.docs:
            yield from written()

    return run


def _filled(columns: dict, n: int, kind: pa.DataType) -> pa.RecordBatch:
    types = {"run": pa.int64(), "radix": pa.int32(), "no": pa.int32(), "doc_id": kind}
    types |= {c: pa.string() if c == "groups_sha256" else pa.int64() for c in _DOC_NAMES}
    types |= {"header": pa.binary(), "body": pa.binary()}
    arrays = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns.get(c, [None] * n), t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays(arrays, list(types))


def _merge(n_b: int):
    """One header from those of a group of runs, with marks of the first side's highest counts."""

    def entries(header: bytes) -> Iterator[tuple[int, int]]:
        pairs, counts = _unzip(header, "i8", "i8")
        return zip(pairs.tolist(), counts.tolist(), strict=True)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        merged = heapq.merge(*map(entries, table.column("header").to_pylist()))
        pairs, counts, best = [], [], []
        for _, own in groupby(merged, key=lambda entry: entry[0] // n_b):
            start = len(pairs)
            for pair, same in groupby(own, key=itemgetter(0)):
                pairs.append(pair)
                counts.append(sum(n for _, n in same))
            # All pairs of this id have passed.
            top = max(counts[start:])
            best += [n == top for n in counts[start:]]
        header = _zip(np.array(pairs, np.int64), np.array(counts, np.int64))
        marks = zstandard.ZstdCompressor(level=_LEVEL).compress(np.array(best, bool).tobytes())
        runs = pa.array([table.column("run").to_pylist()[0]], pa.int64())
        return pa.table({"run": runs, "radix": pa.array([key[0].as_py()], pa.int32()), "header": [header], "best": [marks]})

    return run


def merged_headers(headers: DataFrame, n_b: int, written) -> DataFrame:
    """``radix, header, best``: one row per radix, with the counts over all runs."""
    while True:
        most = headers.groupBy("radix").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        groups = max(1, -(-most // FAN))
        group = F.pmod(F.xxhash64("run"), F.lit(groups)).alias("part")
        cut = headers.select("radix", group, "run", "header").groupBy("radix", "part")
        headers = written.write(cut.applyInArrow(_merge(n_b), "run long, radix int, header binary, best binary"))
        if groups == 1:
            return headers.select("radix", F.col("header").alias("all"), "best")


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pair of a segment's header, in its order: the count over all runs and whether it is its id's highest."""
    last = None
    for batch in batches:
        out = []
        for radix, header, everything, best in zip(*(batch.column(c).to_pylist() for c in ("radix", "header", "all", "best")), strict=True):
            if last is None or last[0] != radix:
                last = radix, *_unzip(everything, "i8", "i8"), *_unzip(best, "?")
            at = np.searchsorted(last[1], _unzip(header, "i8", "i8")[0])
            out.append(_zip(last[2][at], last[3][at]))
        yield pa.RecordBatch.from_arrays([batch.column("run"), batch.column("radix"), pa.array(out, pa.binary())], ["run", "radix", "answer"])


def _contributions(key: tuple, docs: pa.Table, parts: pa.Table) -> pa.Table:
    """The rows of a run's documents with what its pairs add to them."""
    size = len(docs)
    n_best, count_sum = np.zeros(size, np.int64), np.zeros(size, np.int64)
    found: dict[int, dict] = {}
    for row in parts.to_pylist():
        found.setdefault(row["radix"], {}).update({k: v for k, v in row.items() if v is not None})
    for part in found.values():
        own = _unzip(part["header"], "i8", "i8")[1]
        doc, times = _unzip(part["body"], "i4", "i8")
        count, best = _unzip(part["answer"], "i8", "?")
        np.add.at(count_sum, doc, times * np.repeat(count, own))
        np.add.at(n_best, doc, times * np.repeat(best, own))
    no = docs.column("no").to_numpy()
    out = docs.select(["doc_id", *_DOC_NAMES])
    return out.append_column("n_best", pa.array(n_best[no])).append_column("count_sum", pa.array(count_sum[no]))


def aligned(docs: DataFrame, byte_level: str, pieces: str, pattern: str) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum``.

    ``byte_level`` is the path of a byte-level BPE vocabulary (JSON), which encodes a space and the
    text; ``pieces`` that of a sentencepiece model, which adds the space itself. Both are read by the
    driver; they are vocabularies of fixed size. A text that is null or empty, or whose bytes do not
    come back from both sides, has no tokens: zeros and an empty digest. Counts of a pair are rows
    that hold it, so a repeated row counts again. An empty table gives no rows; other columns play no part.
    """
    spark = docs.sparkSession
    written = stage(spark)
    with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
        tools = {"byte_level": a.read(), "pieces": b.read(), "made": []}
    n_b = _piece_count(tools["pieces"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"run long, radix int, no int, doc_id {id_type}, {_DOC}, header binary, body binary"
    shared = spark.sparkContext.broadcast(tools)
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = written.write(rows.mapInArrow(trimmed(_align_docs(shared, pattern)), schema))
    segments = rows.filter("radix is not null").select("run", "radix", "header", "body")
    totals = merged_headers(segments.select("run", "radix", "header"), n_b, written)
    asked = segments.select("run", "radix", "header").join(totals, "radix").sortWithinPartitions("radix")
    answers = asked.mapInArrow(trimmed(_answers), "run long, radix int, answer binary")
    none = F.lit(None).cast("binary")
    parts = segments.withColumn("answer", none).unionByName(answers.withColumns({"header": none, "body": none}))
    own = rows.filter("no is not null").select(F.col("run").alias("own"), "no", "doc_id", *_DOC_NAMES)
    out = f"doc_id {id_type}, {_DOC}, n_best long, count_sum long"
    return own.groupBy("own").cogroup(parts.groupBy("run")).applyInArrow(_contributions, out)


def _piece_count(pieces: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=pieces).get_piece_size()
