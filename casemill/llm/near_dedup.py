"""Near-duplicate documents: MinHash signatures joined by a multi-index Hamming search.

A document is its set of distinct runs of five words. Documents of equal sets form one class, so
exact copies are never joined. A class has a signature of ``SYMBOLS`` symbols of ``BITS`` bits, each
the low bits of a minimum hash. Two sets of similarity s differ in a symbol with probability
(1 - s)(1 - 2^-BITS): at 0.85 in 9 of 60, and in more than ``MAX_DISTANCE`` = 23 about once in 10^5.

The join finds *all* pairs within ``MAX_DISTANCE``: the signature is split into ``CHUNKS`` = 12
chunks, and by the pigeonhole principle two signatures that differ in at most 23 symbols differ in at
most one symbol of some chunk. So every class lists, for each chunk, the chunk with each one of its
symbols left out; two classes within the distance share at least one such key.

Pairs within the distance pass a second, longer signature of ``MORE`` symbols of few bits, whose
threshold again spares all but one in 10^5 of the pairs at 0.85, and are confirmed on the full sets.
No step makes a row for every pair of a group of near copies:

* of a key, all classes are compared with one centre only, the one that shares most keys with others,
  as an original does with its edited copies. What is connected needs no further comparison, since only
  components are asked for;
* classes close to one centre are kept as their differences from it, a small part of their sets. Those
  that the centre does not link are compared with all others of that centre, exactly and block by
  block, since |A and B| follows from the differences; a block returns spanning links only;
* what is left are pairs of a key, one of them far from its centre, that are close to no common centre and
  still in different components. They are joined as above, each pair at the first key it shares. No link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import reduced, stage, text_of, trimmed, wrapped
from casemill.llm.words import mix, odd_constants, shingle_numbers, word_numbers

WIDTH = 5
BITS, CHUNKS, CHUNK = 12, 12, 5
SYMBOLS = CHUNKS * CHUNK
#: Symbols in one long of a signature.
LANES = 5
#: Chunks times (allowed errors in a chunk + 1), less one.
MAX_DISTANCE = CHUNKS * 2 - 1
#: The longer signature: symbols, their bits, symbols in a long, and the most that may differ in both.
MORE, MORE_BITS, MORE_LANES = 192, 4, 15
ALL_DISTANCE = 61
#: A class is close to a centre when so many symbols of both signatures differ at most, and sizes differ by so much.
#: This says only which way pairs are compared in.
CLOSE_DISTANCE, CLOSE_PERCENT = 84, 70
#: Classes in a block of a centre's classes, and differing shingles in a block of columns.
BLOCK, COLUMNS = 512, 4096
#: A link: 100 * common >= PERCENT * together.
PERCENT = 85


def _sets(column: pa.Array) -> list[np.ndarray]:
    return [np.unique(x) for x in shingle_numbers(*word_numbers(column), WIDTH)]


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=8).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors, shifts = odd_constants(SYMBOLS + MORE, 101), odd_constants(SYMBOLS + MORE, 211)
    for batch in batches:
        sets = _sets(batch.column("text"))
        sizes = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(sizes)
        symbols = np.zeros((len(sets), SYMBOLS + MORE), np.uint64)
        if len(full):
            values = np.concatenate([sets[i] for i in full])
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            for k in range(SYMBOLS + MORE):
                symbols[full, k] = np.minimum.reduceat(values * factors[k] + shifts[k], starts)
        cid = [int.from_bytes(_digest(s), "little", signed=True) if len(s) else None for s in sets]
        columns = [batch.column("doc_id"), pa.array(sizes), pa.array(cid, pa.int64())]
        columns += [_packed(symbols[:, :SYMBOLS], BITS, LANES), _packed(symbols[:, SYMBOLS:], MORE_BITS, MORE_LANES)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "cid", "signature", "more"])


def _packed(symbols: np.ndarray, bits: int, lanes: int) -> pa.Array:
    """The low bits of the symbols of each row, ``lanes`` of them in a long."""
    rows, n = symbols.shape
    longs = -(-n // lanes)
    padded = np.zeros((rows, longs * lanes), np.uint64)
    padded[:, :n] = symbols & np.uint64((1 << bits) - 1)
    places = np.arange(lanes, dtype=np.uint64) * np.uint64(bits)
    packed = (padded.reshape(rows, longs, lanes) << places).sum(axis=2, dtype=np.uint64).view(np.int64)
    return pa.FixedSizeListArray.from_arrays(pa.array(packed.ravel()), longs).cast(pa.list_(pa.int64()))


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_shingles, cid, signature, more``; without words, ``cid`` is null.

    ``cid`` is a 64-bit digest of the whole set: rows of equal sets share it. A signature is an array
    of longs; a long of the first one holds a chunk.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(trimmed(_sign), f"doc_id {id_type}, n_shingles long, cid long, signature array<long>, more array<long>")


def _list_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors, salt = odd_constants(SYMBOLS, 307), odd_constants(SYMBOLS, 401)
    places = np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)
    for batch in batches:
        n = batch.num_rows
        packed = batch.column("signature").flatten().to_numpy().view(np.uint64).reshape(n, SYMBOLS // LANES, 1)
        symbols = ((packed >> places) & np.uint64((1 << BITS) - 1)).reshape(n, SYMBOLS)
        parts = mix(symbols + factors)
        keys = np.empty((n, SYMBOLS), np.uint64)
        for c in range(CHUNKS):
            whole = parts[:, c * CHUNK : (c + 1) * CHUNK].sum(axis=1, dtype=np.uint64)
            for at in range(c * CHUNK, (c + 1) * CHUNK):
                keys[:, at] = mix(whole - parts[:, at] + salt[at])
        columns = [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column("cid").to_numpy(), SYMBOLS))]
        columns.append(pa.array(np.tile(np.arange(SYMBOLS, dtype=np.int8), n)))
        yield pa.RecordBatch.from_arrays(columns, ["key", "cid", "at"])


def shared_keys(classes: DataFrame, written) -> DataFrame:
    """``key, cid, at, centre``: keys of two classes or more, the symbol left out, and each key's centre.

    The centre is the class of the key whose keys have most classes in all. Keys are listed twice
    rather than kept: making them costs less than storing them.
    """
    keys = classes.select("cid", "signature").mapInArrow(trimmed(_list_keys), "key long, cid long, at byte")
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written.write(keys.join(written.write(several), "key"))
    weights = written.write(members.groupBy("cid").agg(F.sum("n").alias("weight")))
    placed = members.join(weights, "cid")
    centres = placed.groupBy("key").agg(F.max(F.struct("weight", "cid")).alias("c")).select("key", F.col("c.cid").alias("centre"))
    return members.drop("n").join(written.write(centres), "key")


def _lanes(symbols: int, bits: int, lanes: int, x: str, y: str) -> list:
    """For each long of two signatures, how many symbols differ."""
    low = sum(((1 << (bits - 1)) - 1) << (bits * k) for k in range(lanes))
    top = sum(1 << (bits * k + bits - 1) for k in range(lanes))
    out = []
    for k in range(-(-symbols // lanes)):
        odd = F.col(x)[k].bitwiseXOR(F.col(y)[k])
        # The top bit of every lane that is not zero.
        out.append(F.bit_count((odd.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(odd).bitwiseAND(F.lit(top))))
    return out


def _may_link(a: str, b: str):
    """Sets of sizes that allow the similarity, and signatures within the distances.

    ``a`` and ``b`` are the prefixes of the columns n, x (signature) and y (more) of either side.
    """
    lanes = _lanes(SYMBOLS, BITS, LANES, f"{a}x", f"{b}x")
    near, far = sum(lanes, F.lit(0)), _distance(a, b)
    # Most pairs of unlike texts exceed the distance in the first half of the symbols.
    first = sum(lanes[: len(lanes) // 2], F.lit(0)) <= MAX_DISTANCE
    return _sizes_allow(a, b, PERCENT) & first & (near <= MAX_DISTANCE) & (far <= ALL_DISTANCE)


def _distance(a: str, b: str):
    """Symbols of both signatures that differ."""
    near = sum(_lanes(SYMBOLS, BITS, LANES, f"{a}x", f"{b}x"), F.lit(0))
    return sum(_lanes(MORE, MORE_BITS, MORE_LANES, f"{a}y", f"{b}y"), near)


def _sizes_allow(a: str, b: str, percent: int):
    return 100 * F.least(f"{a}n", f"{b}n") >= percent * F.greatest(f"{a}n", f"{b}n")


def _first_shared(a: str, b: str):
    """Whether the key at hand (column ``at``) is the first one that the two signatures share."""
    chunk = F.lit(None).cast("int")
    for k, differ in reversed(list(enumerate(_lanes(SYMBOLS, BITS, LANES, f"{a}x", f"{b}x")))):
        chunk = F.when(differ <= 1, F.lit(k)).otherwise(chunk)
    own = F.floor(F.col("at") / CHUNK).cast("int")
    # A chunk without a difference is shared by all its keys, one with a single difference by one.
    return (chunk == own) & ((F.col("at") % CHUNK == 0) | (F.col(f"{a}x")[own] != F.col(f"{b}x")[own]))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair whether it is linked, the size of ``b``, and how ``a`` differs from ``b``.

    The difference lists the shingles that ``a`` lacks, so many as ``lacks`` says, then those it adds.
    """
    for batch in batches:
        linked, sizes, lacks, diffs = [], [], [], []
        for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            gone, more = np.setdiff1d(b, a, assume_unique=True), np.setdiff1d(a, b, assume_unique=True)
            common = len(b) - len(gone)
            linked.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            sizes.append(len(b))
            lacks.append(len(gone))
            diffs.append(np.concatenate([gone, more]).tobytes())
        columns = [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64())]
        columns += [pa.array(lacks, pa.int64()), pa.array(diffs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "linked", "size", "lacks", "diff"])


def _common_differences(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``left`` shares with each of ``right``; the values of one array are distinct."""
    values = np.concatenate([*left, *right])
    which, place = np.unique(values, return_inverse=True)
    # A value that only one array has is shared with none.
    often = np.bincount(place, minlength=len(which)) > 1
    place = np.where(often[place], (np.cumsum(often) - 1)[place], -1)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    out = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, int(often.sum()), COLUMNS):
        here = (place >= start) & (place < start + COLUMNS)
        marks = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        marks[owner[here], place[here] - start] = 1
        # Counts of at most COLUMNS are exact in this type.
        out += (marks[: len(left)] @ marks[len(left) :].T).astype(np.int64)
    return out


def _span(key: tuple, table: pa.Table) -> pa.Table:
    """Links that connect the components of one cell: its open classes against a block of all, by their differences."""
    rows = table.to_pylist()
    left, right = ([r for r in rows if r["open"] is side] for side in (True, False))
    links: list[tuple[int, int]] = []
    if left and right:
        diffs = [[np.frombuffer(r["diff"], np.uint64) for r in side] for side in (left, right)]
        lacks = [np.array([r["lacks"] for r in side]) for side in (left, right)]
        size = rows[0]["size"]
        n = [size - 2 * k + np.array([len(d) for d in ds]) for k, ds in zip(lacks, diffs, strict=True)]
        common = size - lacks[0][:, None] - lacks[1] + _common_differences(*diffs)
        tops: dict[int, int] = {}

        def top(x: int) -> int:
            while x in tops:
                x = tops[x]
            return x

        for i, j in np.argwhere(100 * common >= PERCENT * (n[0][:, None] + n[1] - common)).tolist():
            one, other = top(left[i]["component"]), top(right[j]["component"])
            if one != other:
                tops[one] = other
                links.append((left[i]["a"], right[j]["a"]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def links_near_centres(near: DataFrame, found: DataFrame, written) -> DataFrame:
    """``a, b``: links between classes close to one centre and in different components, enough to connect them.

    ``near`` is from ``compared`` (``b`` is the centre), ``found`` has the components so far. Open classes of a
    centre, those not in its own component, are cut into blocks, and so are all its classes; a cell is
    a block of each. A class goes to as many cells as there are blocks on the other side.
    """
    of = found.select(F.col("cid").alias("a"), "component")
    placed = near.join(of, "a", "left").withColumn("component", F.coalesce("component", "a"))
    centre = found.select(F.col("cid").alias("b"), F.col("component").alias("own"))
    placed = placed.join(centre, "b", "left").withColumn("own", F.coalesce("own", "b"))
    placed = written.write(placed.withColumn("open", F.col("component") != F.col("own")).drop("own"))
    counts = placed.groupBy("b").agg(F.count_if("open").alias("n_open"), F.count(F.lit(1)).alias("n_all"))
    blocks = written.write(
        counts.filter("n_open > 0 and n_all > 1").select("b", *[F.ceil(F.col(n) / BLOCK).alias(n) for n in ("n_open", "n_all")])
    )
    rows = placed.join(blocks, "b")
    mixed = F.abs(F.xxhash64("a"))
    own_open, own_all = (mixed % F.col("n_open")).alias("row"), (mixed % F.col("n_all")).alias("column")
    columns = ["b", "a", "component", "size", "lacks", "diff"]
    left = rows.filter("open").select(*columns, F.lit(True).alias("open"), own_open, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_all") - 1)).alias("column"))
    right = rows.select(*columns, F.lit(False).alias("open"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_open") - 1)).alias("row"), own_all)
    cells = left.unionByName(right).groupBy("b", "row", "column")
    return written.write(cells.applyInArrow(_span, "a long, b long"))


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _sets(batch.column("text"))
        same = [bool(len(s)) and int.from_bytes(_digest(s), "little", signed=True) == c for s, c in zip(sets, batch.column("cid").to_pylist(), strict=True)]
        rows = pa.RecordBatch.from_arrays([batch.column("cid"), pa.array([s.tobytes() for s in sets], pa.binary())], ["cid", "members"])
        yield rows.filter(pa.array(same, pa.bool_()))


def compared(pairs: DataFrame, docs: DataFrame, classes: DataFrame, written) -> DataFrame:
    """``a, b, linked, size, lacks, diff`` of ``pairs`` (a, b: class ids), written, from their full sets.

    Only the texts of one document of each class in ``pairs`` are read again and moved. A pair brings
    the set of ``a`` to that of ``b``; a class in many pairs is split over tasks by the join.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    holders = written.write(nodes.join(classes.select("cid", "holder"), "cid"))
    texts = reduced(docs.select(F.col("doc_id").alias("holder"), text_of().alias("text")), holders, "holder")
    found = texts.join(holders, texts["holder"].eqNullSafe(holders["holder"]))
    sets = found.select("cid", "text").mapInArrow(trimmed(_set_rows), "cid long, members binary")
    sets = written.write(sets.dropDuplicates(["cid"]))
    left = sets.select(F.col("cid").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("cid").alias("b"), F.col("members").alias("set_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return written.write(both.mapInArrow(trimmed(_compare), "a long, b long, linked boolean, size long, lacks long, diff binary"))


def components(links: DataFrame, written) -> DataFrame:
    """``cid, component``: the smallest class reachable over ``links`` (a, b), for classes with a link.

    Alternates two steps until every class is tied to one other, and that one to none: every larger
    neighbour of a class is tied to its smallest neighbour, then every class and its smaller
    neighbours to the smallest of them.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written.write(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        larger = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written.write(larger.filter("u > v"))
        low = written.write(edges.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")))
        many = not low.filter("m < most").isEmpty()
        if many:
            tied = edges.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            edges = written.write(tied.union(low.select("u", F.col("m").alias("v"))).distinct())
        else:
            edges = low.select("u", F.col("m").alias("v"))
        if not many and edges.join(low.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").isEmpty():
            break
    tops = edges.select(F.col("v").alias("cid")).distinct().select("cid", F.col("cid").alias("component"))
    return written.write(edges.select(F.col("u").alias("cid"), F.col("v").alias("component")).union(tops))


def class_components(docs: DataFrame, rows: DataFrame, written) -> DataFrame:
    """``cid, component`` of the classes of ``rows`` (from ``signatures``) that have a link."""
    grouped = rows.filter("cid is not null").groupBy("cid", "n_shingles", "signature", "more").agg(F.min("doc_id").alias("holder"))
    classes = written.write(grouped)
    members = written.write(shared_keys(classes, written))

    def side(p: str) -> DataFrame:
        names = {"cid": "", "n_shingles": "n", "signature": "x", "more": "y"}
        return classes.select(*[F.col(c).alias(f"{p}{short}") for c, short in names.items()])

    # At most one partner for each key of a class, so the lists are short.
    partners = members.filter("cid != centre").groupBy("cid").agg(F.collect_set("centre").alias("centres"))
    stars = side("a").join(partners, F.col("a") == F.col("cid")).select("a", "an", "ax", "ay", F.explode("centres").alias("centre"))
    close = _sizes_allow("a", "b", CLOSE_PERCENT) & (_distance("a", "b") <= CLOSE_DISTANCE)
    stars = stars.join(side("b"), (F.col("centre") == F.col("b")) & close).select("a", "b")
    near = compared(written.write(stars), docs, classes, written)
    links = near.filter("linked").select("a", "b")

    def connected(links: DataFrame) -> DataFrame:
        if links.isEmpty():
            return links.select(F.col("a").alias("cid"), F.col("b").alias("component"))
        return components(links, written)

    found = connected(links)
    inner = links_near_centres(near, found, written)
    if not inner.isEmpty():
        links = links.union(inner)
        found = connected(links)

    # Keys whose classes are still in different components, without pairs that were compared at a centre.
    own_component = F.coalesce("component", "cid").alias("component")
    placed = written.write(members.join(found, "cid", "left").select("key", "cid", "at", "centre", own_component))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    mixed = placed.filter("cid != centre").join(written.write(mixed.select("key")), "key", "left_semi")
    # Each class with the centres it is close to, one for each of its keys at most, and itself.
    close_to = near.groupBy(F.col("a").alias("close")).agg(F.collect_set("b").alias("centres"))
    a_side = side("a").join(close_to, F.col("a") == F.col("close"), "left")
    a_side = a_side.withColumn("ac_to", F.array_append(F.coalesce("centres", F.array().cast("array<long>")), F.col("a")))
    # Two classes close to the centre of a key were compared there, so one of a pair is far from it.
    far = (~F.array_contains("ac_to", F.col("centre"))).alias("a_far")
    own = mixed.join(a_side, F.col("cid") == F.col("a"))
    own = written.write(own.select("key", "at", "a", "an", "ax", "ay", F.col("component").alias("ac"), "ac_to", far))
    other = own.select(F.col("key").alias("key_b"), *[F.col(f"a{c}").alias(f"b{c}") for c in ("", "n", "x", "y", "c", "c_to", "_far")])
    apart = (F.col("key") == F.col("key_b")) & (F.col("ac") != F.col("bc")) & (~F.col("b_far") | (F.col("a") > F.col("b")))
    once_only = _may_link("a", "b") & ~F.arrays_overlap("ac_to", "bc_to") & _first_shared("a", "b")
    pairs = own.filter("a_far").join(other, apart & once_only).select("a", "b")
    more = compared(written.write(pairs), docs, classes, written).filter("linked").select("a", "b")
    if more.isEmpty():
        return found
    return components(links.union(more), written)


def near_groups(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id reachable over links, its own included; null ids are never
    smallest. Null, empty and blank texts have no shingles and are linked with nothing, a text of
    fewer than five words is one shingle. Rows of equal id and text share a component; all rows that
    hold its smallest id are ``kept``.
    """
    written = stage(docs.sparkSession)
    rows = written.write(signatures(docs))
    found = class_components(docs, rows, written)
    classes = rows.filter("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("holder"), F.count(F.lit(1)).alias("n"))
    placed = written.write(classes.join(found, "cid", "left"))
    whole = placed.filter("component is not null").groupBy("component").agg(F.min("holder").alias("smallest"), F.count(F.lit(1)).alias("parts"))
    whole = written.write(whole)
    # Rows alone in their class and component keep their own id, and need no join partner.
    several = placed.join(whole, "component", "left").select("cid", "n", F.coalesce("smallest", "holder").alias("smallest"), "component")
    several = written.write(several.filter("n > 1 or component is not null").select("cid", "smallest"))
    component = F.coalesce("smallest", "doc_id")
    return rows.join(several, "cid", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: those of the smallest id of each component.

    Of rows that share that id, all stay; run exact dedup first where ids repeat.
    """
    written = stage(docs.sparkSession)
    lost = written.write(near_groups(docs).filter("not kept").select(F.col("doc_id").alias("_lost")).distinct())
    return wrapped(docs).join(lost, F.col("_row.doc_id").eqNullSafe(F.col("_lost")), "left_anti").select("_row.*")
