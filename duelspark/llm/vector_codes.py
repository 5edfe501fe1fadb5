"""Codes of vectors by a codebook per part, in whole numbers.

A vector is cut into equal parts, and every part is replaced by the nearest
entry of the codebook of its position. The parts of a position are sorted along
a Hilbert curve and cut into flat blocks, which keep their box (smallest and
largest component) and their sums. In each round the distances from an entry to
a block's box, the least and the greatest possible, tell which entries can be
nearest to any of its parts. Only this shortlist is compared with the parts, by
products of whole numbers that are exact; where one entry is left, the block
goes to it by its sums and no part is looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelspark.llm.arrow import arrow_schema, map_batches, rows_of
from duelspark.session import stage

#: Numbers in a block; it has 64 parts at least.
BLOCK_VALUES = 1 << 14

#: Bits of a Hilbert key at most.
KEY_BITS = 256

#: Whole numbers below this are exact in double precision, and so are sums and products that stay below.
EXACT = 1 << 53
LARGEST = (1 << 63) - 1

#: Sums of wider numbers travel as digits of so many bits.
DIGIT, DIGITS = 40, 4

BLOCKS = "part int, ats binary, points binary, low binary, high binary, sums array<bigint>"


class Shape:
    """What all tasks need to know of the vectors: parts, numbers in a part, and the largest number."""

    def __init__(self, parts: int, width: int, largest: float):
        self.parts, self.width, self.largest = parts, width, int(largest)
        #: Distances are exact in double precision; else they are computed in unbounded whole numbers.
        self.plain = 4 * max(1, width) * self.largest**2 < EXACT
        self.stored = "<i4" if self.largest < 1 << 31 else "<f8"
        self.digits = 1 if self.plain else DIGITS

    def numbers(self, stored: bytes) -> np.ndarray:
        found = np.frombuffer(stored, self.stored).reshape(-1, self.width)
        return found.astype(np.float64) if self.plain else self.whole(found)

    def whole(self, found) -> np.ndarray:
        out = np.empty((len(found), self.width), object)
        for n, row in enumerate(found):
            out[n] = [int(x) for x in row]
        return out

    def entries(self, book: list[list[int]]) -> np.ndarray:
        return np.array(book, np.float64).reshape(len(book), self.width) if self.plain else self.whole(book)

    def split(self, total) -> list[int]:
        """The digits of every sum, the last with its sign."""
        out = []
        for x in map(int, total):
            for _ in range(self.digits - 1):
                out.append(x & ((1 << DIGIT) - 1))
                x >>= DIGIT
            out.append(x)
        return out

    def joined(self, digits: list[int]) -> list[int]:
        step = self.digits
        return [sum(int(d) << (DIGIT * k) for k, d in enumerate(digits[i : i + step])) for i in range(0, len(digits), step)]


def hilbert_keys(points: np.ndarray, bits: int) -> list[bytes]:
    """The place of every row of whole numbers below 2 ** bits on the Hilbert curve, as bytes that sort like it.

    Skilling's transposed form: rotations undone from the highest bit on, then a Gray code.
    """
    n, dims = points.shape
    if not n or not dims:
        return [b""] * n
    x = points.T.astype(np.int64).copy()
    for b in range(bits - 1, 0, -1):
        bit, rest = 1 << b, (1 << b) - 1
        for i in range(dims):
            set_ = (x[i] & bit) != 0
            swapped = np.where(set_, 0, (x[0] ^ x[i]) & rest)
            x[0] ^= np.where(set_, rest, swapped)
            if i:
                x[i] ^= swapped
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turned = np.zeros(n, np.int64)
    for b in range(bits - 1, 0, -1):
        turned ^= np.where((x[dims - 1] >> b) & 1, (1 << b) - 1, 0)
    x ^= turned
    columns = (x[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    packed = np.packbits(columns.transpose(2, 1, 0).reshape(n, bits * dims).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The entries that can be nearest to a point of the box: their least distance is no more than some entry's greatest."""
    below, above = low - book, book - high
    outside = np.maximum(np.maximum(below, above), 0 * below)
    widest = np.maximum(abs(below), abs(above))
    least, greatest = (outside * outside).sum(axis=1), (widest * widest).sum(axis=1)
    return np.flatnonzero(least <= greatest.min())


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of every point and its squared distance."""
    away = (points * points).sum(axis=1)[:, None] - 2 * points.dot(book.T) + (book * book).sum(axis=1)[None, :]
    at = np.argmin(away, axis=1).astype(np.int64)
    return at, away[np.arange(len(points)), at]


def whole_vectors(rows: DataFrame, key: str, vector: str, label: str, scale: float) -> DataFrame:
    """at, vec_id, label, v: floor(scale * x) of every component as double, of vectors without null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    small = F.lit(float(EXACT))
    floor = lambda c: F.when(F.abs(c) < small, F.floor(F.when(F.abs(c) < small, c)).cast("double")).otherwise(c)
    return (
        rows.select(
            F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"),
            F.transform(vector, lambda c: c.cast("double")).alias("v"),
        )
        .filter(F.col("v").isNotNull() & F.forall("v", finite))
        .withColumn("v", F.transform("v", lambda c: floor(c * F.lit(scale))))
        .filter(F.forall("v", finite))
        .select(F.monotonically_increasing_id().alias("at"), "vec_id", "label", "v")
    )


def _padded(column, width: int) -> np.ndarray:
    vectors = column.to_pylist()
    out = np.zeros((len(vectors), width))
    for n, v in enumerate(vectors):
        out[n, : len(v)] = v
    return out


def sorted_blocks(vectors: DataFrame, shape: Shape) -> DataFrame:
    """All parts of ``vectors`` (at, v) as rows of BLOCKS, along the Hilbert curve of their position, stored.

    Equal parts are dealt by ``at``, so that many copies fill many partitions.
    """
    bits = max(1, min(8, KEY_BITS // max(1, shape.width)))
    span = 2.0 * shape.largest + 1

    def parted(batch):
        all_ = _padded(batch.column("v"), shape.parts * shape.width)
        ats, out = batch.column("at").to_pylist(), {"at": [], "part": [], "key": [], "point": []}
        for part in range(shape.parts):
            points = all_[:, part * shape.width : (part + 1) * shape.width]
            grid = np.clip(np.floor((points + shape.largest) / span * (1 << bits)), 0, (1 << bits) - 1)
            out["at"] += ats
            out["part"] += [part] * len(ats)
            out["key"] += hilbert_keys(grid, bits)
            out["point"] += [row.tobytes() for row in points.astype(shape.stored)]
        return out

    keyed = map_batches(vectors.select("at", "v"), "at bigint, part int, key binary, point binary", parted)
    placed = keyed.repartitionByRange("part", "key", "at").sortWithinPartitions("part", "key", "at")
    most, schema = max(64, BLOCK_VALUES // max(1, shape.width)), arrow_schema(BLOCKS)

    def block(part, ats, stored):
        joined = b"".join(stored)
        found = np.frombuffer(joined, shape.stored).reshape(len(ats), shape.width)
        sums = found.sum(axis=0, dtype=np.int64) if shape.plain else shape.whole(found).sum(axis=0)
        return [
            part, np.array(ats, "<i8").tobytes(), joined, found.min(axis=0).tobytes(), found.max(axis=0).tobytes(),
            shape.split(sums),
        ]

    def cut(batches):
        part, ats, stored = None, [], []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("part", "at", "point")]
            done = []
            for p, at, point in zip(*columns):
                if ats and (p != part or len(ats) == most):
                    done.append(block(part, ats, stored))
                    ats, stored = [], []
                part = p
                ats.append(at)
                stored.append(point)
            if done:
                yield rows_of([list(c) for c in zip(*done)], schema)
        if ats:
            yield rows_of([[x] for x in block(part, ats, stored)], schema)

    return stage(placed.select("part", "at", "point").mapInArrow(cut, BLOCKS), "codes-blocks")


def first_books(vectors: DataFrame, shape: Shape, entries: int) -> list[list[list[int]]]:
    """For every position the parts of the ``entries`` smallest vec_ids; a null id comes last, equal ids by their vectors."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    whole = [[int(x) for x in row.v] + [0] * (shape.parts * shape.width - len(row.v)) for row in first]
    return [[v[p * shape.width : (p + 1) * shape.width] for v in whole] for p in range(shape.parts)]


def next_books(blocks: DataFrame, shape: Shape, books: list) -> list[list[list[int]]]:
    """Every entry as the floored mean of its parts; one without parts stays. Only counts and sums per entry reach the driver."""
    made = "part int, entry int, n bigint, sums array<bigint>"
    schema = arrow_schema(made)

    def summed(batches):
        known = [shape.entries(book) for book in books]
        zero = lambda: np.zeros((len(books[0]), shape.width), np.int64 if shape.plain else object)
        counts, sums = np.zeros((shape.parts, len(books[0])), np.int64), [zero() for _ in books]
        for batch in batches:
            for row in batch.to_pylist():
                part, book = row["part"], known[row["part"]]
                picked = shortlist(shape.numbers(row["low"])[0], shape.numbers(row["high"])[0], book)
                if len(picked) == 1:
                    counts[part, picked[0]] += len(row["ats"]) // 8
                    sums[part][picked[0]] += np.array(shape.joined(row["sums"]), sums[part].dtype)
                    continue
                points = shape.numbers(row["points"])
                at = picked[nearest(points, book[picked])[0]]
                counts[part] += np.bincount(at, minlength=len(book))
                np.add.at(sums[part], at, points.astype(sums[part].dtype))
        full = [(p, e) for p in range(shape.parts) for e in np.flatnonzero(counts[p])]
        yield rows_of(
            [[p for p, _ in full], [e for _, e in full], [counts[p, e] for p, e in full], [shape.split(sums[p][e]) for p, e in full]], schema
        )

    wide = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(shape.width * shape.digits)]
    rows = blocks.mapInArrow(summed, made).groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect()
    out = [list(book) for book in books]
    for row in rows:
        out[row.part][row.entry] = [s // row.n for s in shape.joined(list(row)[3:])]
    return out


def assigned(blocks: DataFrame, shape: Shape, books: list) -> DataFrame:
    """at, part, entry, error of every part: its nearest entry and the squared distance to it."""
    made = "at bigint, part int, entry int, error bigint"
    schema = arrow_schema(made)

    def each(batches):
        known = [shape.entries(book) for book in books]
        for batch in batches:
            for row in batch.to_pylist():
                book = known[row["part"]]
                picked = shortlist(shape.numbers(row["low"])[0], shape.numbers(row["high"])[0], book)
                at, away = nearest(shape.numbers(row["points"]), book[picked])
                errors = away.astype(np.int64) if shape.plain else [min(LARGEST, int(d)) for d in away]
                yield rows_of([np.frombuffer(row["ats"], "<i8"), [row["part"]] * len(at), picked[at], errors], schema)

    return blocks.mapInArrow(each, made)


def digest(books: list) -> str:
    """SHA-256 of all components of all entries as decimal numbers, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def compress(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0,
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row whose vector has neither null nor non-finite components.

    Components are floor(scale * x). Codebooks start with the parts of the
    ``entries`` smallest ids (a null id comes last, rows that repeat an id in the
    order of their vectors) and are replaced ``rounds`` times by floored means.
    ``code``: two hex digits per part; ties go to the smaller entry. ``error``: the
    squared distances of all parts; ``label_error``: its sum over rows of the same
    label, where nulls are one label. Both stop at the largest 64-bit number.
    Shorter vectors end in zeros, and so do all where the longest can't be cut into
    equal parts. Repeated rows are coded one by one; an empty table gives no rows.
    Other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number must fit two hex digits")
    vectors = stage(whole_vectors(rows, key, vector, label, scale), "codes-vectors")
    known = vectors.agg(F.max(F.size("v")).alias("dims"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).first()
    shape = Shape(parts, -(-(known.dims or 0) // parts), known.largest or 0)
    books = first_books(vectors, shape, entries)
    if not books[0] or not shape.width:
        # No rows, or vectors without components: nothing to place, every distance is 0.
        found = vectors.select("at", F.lit("00" * parts).alias("code"), F.lit(0).cast("decimal(38,0)").alias("error"))
    else:
        blocks = sorted_blocks(vectors, shape)
        for _ in range(rounds):
            books = next_books(blocks, shape, books)
        place = lambda c: F.when(F.col("part") == c, F.lpad(F.lower(F.hex(F.col("entry"))), 2, "0"))
        found = assigned(blocks, shape, books).groupBy("at").agg(
            F.concat(*[F.max(place(p)) for p in range(parts)]).alias("code"),
            F.sum(F.col("error").cast("decimal(38,0)")).alias("error"),
        )
    most = lambda c: F.least(c, F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    coded = stage(
        vectors.select("at", "vec_id", "label").join(found, "at").select("vec_id", "label", "code", "error"), "codes-found"
    )
    of_label = coded.groupBy("label").agg(most(F.sum("error")).alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", most(F.col("error")).alias("error"), "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
