"""Substring dedup by sliding spans of sentences.

A sentence is a run of words up to one with ``.``, ``!`` or ``?`` after its last letter or digit, or one
that stands at the end of a line or of the text. A sentence of more than ``LONG`` words is cut again, where the hash of a word
and the word before it is the smallest of any ``WINDOW`` words in a row, so the same run of words is cut at the same places
wherever it stands; "sentence" below means such a part too.

At every sentence a span begins: the sentence and the ones after it, until there are ``MIN_SENTENCES`` of them and
``MIN_WORDS`` words. Another span ends at every sentence, with as many before it; it covers the last sentences of a passage,
from which the first kind reaches past its end. The length of a span follows from its own words alone, so a passage that
occurs in two places has the same spans in both. Spans are hashed to 128 bits and joined over the whole corpus. Of each
repeated span, the first occurrence (smallest id, then position) stays; sentences that any other occurrence covers are
removed, with the white space after them.

A sentence has ``LONG`` words at most, so of a repeated run of words, up to ``LONG`` - 1 words at either end can belong to
sentences that reach beyond it, and stay. A run of ``MIN_WORDS`` + 2 (``LONG`` - 1) = 50 words holds a span in any case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import reduced, stage, text_of
from casemill.llm.words import mix, numbers_at, odd_constants, text_bytes, word_places

#: A span has so many sentences and so many words at least.
MIN_SENTENCES, MIN_WORDS = 2, 20
#: A sentence of more words is cut, at one word of any ``WINDOW`` in a row at least.
LONG, WINDOW = 16, 15


def _sentences(data: np.ndarray, offsets: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first word of every sentence, and for each text its first sentence (one more entry at the end)."""
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    # A word ends a sentence if a stop comes after its last letter or digit: quotes and marks may follow.
    place = np.arange(1, len(data) + 1)
    letter = (data >= 128) | ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 48) & (data <= 57)
    stop_at = np.maximum.accumulate(np.where(np.isin(data, np.frombuffer(b".!?", np.uint8)), place, 0))[end - 1]
    letter_at = np.maximum.accumulate(np.where(letter, place, 0))[end - 1]
    stops = (stop_at > begin) & (stop_at > letter_at)
    stops[:-1] |= lines[begin[1:]] > lines[end[:-1]]
    starts = np.ones(len(begin), bool)
    starts[1:] = stops[:-1]
    of_text = np.searchsorted(begin, offsets)
    starts[of_text[of_text < len(begin)]] = True
    first = np.flatnonzero(starts)
    return first, np.searchsorted(begin[first], offsets)


def _running(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The ``best`` of every ``width`` values in a row."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


def _parts(
    data: np.ndarray, offsets: np.ndarray, begin: np.ndarray, end: np.ndarray, numbers: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """As ``_sentences``, with long sentences cut."""
    first, of_text = _sentences(data, offsets, begin, end)
    length = np.diff(np.append(first, len(begin)))
    inner = np.repeat(length > LONG, length)
    inner[first] = False
    inner = np.flatnonzero(inner)
    if not len(inner):
        return first, of_text
    sentence = np.repeat(np.arange(len(first)), length)[inner]
    value = mix(numbers[inner - 1] * odd_constants(1, 701)[0] + numbers[inner]) | np.uint64(1)
    low = _running(value, WINDOW, np.minimum)
    low[sentence[: len(low)] != sentence[WINDOW - 1 :]] = 0  # windows over two sentences
    none = np.zeros(WINDOW - 1, np.uint64)
    cuts = inner[_running(np.concatenate([none, low, none]), WINDOW, np.maximum) == value]
    first = np.sort(np.concatenate([first, cuts]))
    return first, np.searchsorted(begin[first], offsets)


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors = odd_constants(2, 601)
    inverses = [np.uint64(pow(int(f), -1, 1 << 64)) for f in factors]
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        begin, end = word_places(data, offsets)
        numbers = numbers_at(data, begin, end)
        first, of_text = _parts(data, offsets, begin, end, numbers)
        n = len(first)
        bounds = np.append(first, len(begin))
        text = np.repeat(np.arange(batch.num_rows), np.diff(of_text))
        last = of_text[text + 1]  # the sentence after the text's last
        # The sentence after the span: far enough for the sentences, and for the words.
        here = np.arange(n)
        stop = np.maximum(here + MIN_SENTENCES, np.searchsorted(bounds, first + MIN_WORDS))
        fits = stop <= last
        # The spans that end at each sentence; many of them are among the others.
        start = np.minimum(here + 1 - MIN_SENTENCES, np.searchsorted(bounds, bounds[1:] - MIN_WORDS, side="right") - 1)
        after = start >= of_text[text]
        both = np.unique(np.concatenate([here[fits] * (n + 1) + stop[fits], start[after] * (n + 1) + here[after] + 1]))
        here, stop = both // (n + 1), both % (n + 1)
        text = text[here]
        hashes = []
        for factor, inverse in zip(factors, inverses, strict=True):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers * _powers(factor, len(numbers)), dtype=np.uint64)])
            a, b = bounds[here], bounds[stop]
            back = _powers(inverse, len(numbers) + 1)
            hashes.append(mix((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64)).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(text)), batch.column("digest").take(pa.array(text)),
                pa.array((here - of_text[text]).astype(np.int32)), pa.array((stop - of_text[text]).astype(np.int32)),
                *map(pa.array, hashes),
            ],
            ["doc_id", "digest", "at", "stop", "h1", "h2"],
        )


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, at, stop, h1, h2`` for ``docs`` (doc_id, digest, text): sentences ``at`` to ``stop`` (exclusive)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_span_rows, f"doc_id {id_type}, digest long, at int, stop int, h1 long, h2 long")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        begin, end = word_places(data, offsets)
        first, of_text = _parts(data, offsets, begin, end, numbers_at(data, begin, end))
        at = begin[first]
        rows = []
        for k, gone in enumerate(batch.column("gone").to_pylist()):
            whole = data[offsets[k] : offsets[k + 1]].tobytes()
            edges = np.append(at[of_text[k] : of_text[k + 1]], offsets[k + 1]) - offsets[k]
            kept, removed, done = [], [], 0
            for s in sorted(gone or ()):
                kept.append(whole[done : edges[s]])
                removed.append(whole[edges[s] : edges[s + 1]].decode())
                done = edges[s + 1]
            kept.append(whole[done:])
            rows.append((b"".join(kept).decode(), len(edges) - 1, len(removed), sum(len(r.split()) for r in removed), removed))
        names = ["text", "n_sentences", "n_removed", "removed_words", "removed"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])


def repeated_sentences(docs: DataFrame, written) -> DataFrame:
    """``doc_id, digest, gone``: for each text with removals, the positions of the sentences that go.

    Spans are counted with partial sums before they are shuffled, and only repeated ones are joined
    back, so a passage in a third of all texts is one row in the list and many rows on the other side
    of a join, which Spark splits. Spans are made twice rather than kept, which costs less than storing them.
    """
    found = spans(docs)
    place = F.struct("doc_id", "digest", "at")
    several = written.write(found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"))
    members = written.write(reduced(found, several, "h1").join(several, ["h1", "h2"]))
    firsts = written.write(members.groupBy("h1", "h2").agg(F.min(place).alias("first")))
    again = members.join(firsts, ["h1", "h2"]).filter(~F.col("first").eqNullSafe(place))
    at = again.select("doc_id", "digest", F.explode(F.sequence("at", F.col("stop") - 1)).alias("p"))
    return written.write(at.groupBy("doc_id", "digest").agg(F.collect_set("p").alias("gone")))


def dedup(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, text, n_sentences, n_removed, removed_words, removed`` (texts of what went).

    ``text`` is what stays. Null texts count as empty and stay empty. A null id comes first. Rows that
    share id and text count as one document, each keeps what that document keeps.
    """
    written = stage(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text")).select("doc_id", F.xxhash64("text").alias("digest"), "text")
    gone = repeated_sentences(rows, written).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "gone")
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "gone").mapInArrow(
        _cut, f"doc_id {id_type}, text string, n_sentences long, n_removed long, removed_words long, removed array<string>"
    )
