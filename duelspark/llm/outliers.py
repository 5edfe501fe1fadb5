"""Quality rules: fixed limits, then robust outliers among a group's documents.

A document's counts become a vector of transformed shares. Every group, a
language and source, has a centre and a scatter of these vectors by minimum
covariance determinant: the part of its documents, three quarters by default,
whose scatter has the least determinant. Concentration steps lead to it from
two starts, the medians with spreads by quartiles and the plain moments: keep
the documents nearest to the centre, take their moments, and again until the
determinant no longer falls. The better start is rescaled by the median distance, refitted
once to all documents that are not far, and rejects those at a Mahalanobis
distance beyond the limit.

Vectors are whole numbers, so that sums of them and of their products are exact
and don't depend on the order of rows. A step is two aggregates: distances by
bin, which give the bin that holds enough documents, and moments up to it.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelspark.llm.arrow import map_batches, utf8
from duelspark.session import stage

WINDOW = 8

_BLANK = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_DIGITS, _CAPITALS = bytes(range(0x30, 0x3A)), bytes(range(0x41, 0x5B))
_SIGNS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c not in _SYMBOLS)
_INNER = bytes(range(0x80, 0xC0))  # bytes of a code point after its first

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_same_words", "n_signs", "n_capitals", "n_digits",
]

#: One number of a vector each: a count, what it is a share of, how much of that the group's median share is worth,
#: the transform, and the least spread that counts as one.
SHARES = [
    ("word_chars", "n_words", 50, F.ln, 0.04),
    ("n_symbols", "n_words", 50, F.sqrt, 0.06),
    ("n_dup_lines", "n_lines", 5, F.sqrt, 0.1),
    ("n_repeat_words", "n_words", 50, F.sqrt, 0.1),
    ("n_same_words", "n_words", 50, F.sqrt, 0.1),
    ("n_signs", "word_chars", 250, F.sqrt, 0.04),
    ("n_capitals", "word_chars", 250, F.sqrt, 0.04),
    ("n_digits", "word_chars", 250, F.sqrt, 0.08),
]
D = len(SHARES)
X = [f"x{n}" for n in range(D)]

#: Vectors are kept in whole steps of 1 / SCALE, a group's median shares in steps of 1 / MILLE.
SCALE, MILLE = 256, 1000

#: The part of a group that the determinant is of.
PART = 0.75

#: Groups of fewer documents share their language's; a language's rest of fewer has no estimate.
ENOUGH = 100

#: Concentration steps at most; they end when no determinant falls by more than about this part.
STEPS, STILL = 12, 1e-3

#: Distances that a normal distribution exceeds by this probability are outliers.
BEYOND = 1e-6

#: Bins of squared distances per e-fold, and the last bin.
FINE, LAST = 64, 1 << 12


def far(p: float, dims: int = D) -> float:
    """The squared distance that a normal vector exceeds with probability ``p`` (Wilson and Hilferty)."""
    z, s = NormalDist().inv_cdf(1 - p), 2 / (9 * dims)
    return dims * (1 - s + z * math.sqrt(s)) ** 3


def stuttered(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per text the words that equal the word before; ``words``: numbers of all texts' words in a row."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    same = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    return np.bincount(text[1:][same], minlength=len(lengths)).astype(np.int64)


def repeated(words: np.ndarray, lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text the words inside windows of ``window`` (a power of two) words that its text has twice or more.

    ``words``: numbers of all texts' words in a row. Windows are named by doubling,
    as pairs of the names of their halves, so that equal names are equal words.
    """
    n = len(words)
    ends = np.cumsum(lengths)
    text = np.repeat(np.arange(len(lengths)), lengths)
    names, size = words, 1
    while size < window and len(names) > size:
        pair = names[:-size] * (int(names.max()) + 1) + names[size:]
        names = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        size *= 2
    if size < window or not n:
        return np.zeros(len(lengths), np.int64)
    starts = np.flatnonzero(np.arange(len(names)) + window <= ends[text[: len(names)]])
    _, inverse, times = np.unique(
        names[starts] * len(lengths) + text[starts], return_inverse=True, return_counts=True
    )
    twice = starts[times[inverse] > 1]
    edges = np.zeros(n + 1, np.int64)
    edges[twice] += 1
    edges -= np.bincount(twice + window, minlength=n + 1)
    return np.bincount(text[np.cumsum(edges)[:n] > 0], minlength=len(lengths)).astype(np.int64)


class _Numbers(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def statistics(texts: list[bytes]) -> dict[str, list[int] | np.ndarray]:
    """COUNTS of every text."""
    out: dict = {name: [] for name in COUNTS}
    number, all_ = _Numbers(), []
    for text in texts:
        words = text.split()
        all_.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        lines = [line for line in text.split(b"\n") if line.strip()]
        has = lambda chars: len(text) - len(text.translate(None, chars))
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text) - has(_BLANK + _INNER))
        out["n_symbols"].append(has(_SYMBOLS))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_lines"].append(len(lines))
        out["n_signs"].append(has(_SIGNS))
        out["n_capitals"].append(has(_CAPITALS))
        out["n_digits"].append(has(_DIGITS))
    words, lengths = np.concatenate(all_ or [np.zeros(0, np.int64)]), np.array(out["n_words"], np.int64)
    out["n_repeat_words"], out["n_same_words"] = repeated(words, lengths), stuttered(words, lengths)
    return out


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and COUNTS of every row; a null text has no words."""
    narrow = docs.select(*[F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("lang", "string"), ("source", "string"), ("text", "string"))])
    made = "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS)

    def each(batch):
        return {c: batch.column(c) for c in ("doc_id", "lang", "source")} | statistics(utf8(batch.column("text")))

    return map_batches(narrow, made, each)


def failed() -> Column:
    """The fixed limits: too few words, or too many of them repeated."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _quartiles(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """For every group the three quartiles of each of ``columns`` (whole numbers) as array ``q`` of (i, q1, q2, q3), in order."""
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("x")) for i, x in enumerate(columns)])
    each = rows.select(*keys, F.explode(listed).alias("v")).groupBy(*keys, F.col("v.i").alias("i"), F.col("v.x").alias("x"))
    counts, ordered = each.agg(F.count(F.lit(1)).alias("n")), Window.partitionBy(*keys, "i")
    ranked = counts.select("*", F.sum("n").over(ordered.orderBy("x")).alias("upto"), F.sum("n").over(ordered).alias("rows"))
    quarter = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("rows"), F.col("x"))).alias(f"q{k}")
    found = ranked.groupBy(*keys, "i").agg(quarter(1), quarter(2), quarter(3))
    return found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "q1", "q2", "q3"))).alias("q"))


def vectors(counts: DataFrame) -> DataFrame:
    """The rows of ``counts`` within the fixed limits with ``of``, ``from`` (their group) and their vector, stored.

    A count of a short text says little: every share is drawn towards the group's
    median share, as if the text had some more words like that.
    """
    named = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    rows = counts.filter(~failed()).withColumns({"of": named("lang"), "from": named("source")})
    totals = rows.groupBy("of", "from").agg(F.count(F.lit(1)).alias("n"))
    sizes = totals.withColumn("own", F.col("n") >= ENOUGH)
    sizes = sizes.withColumn("n", F.when(F.col("own"), F.col("n")).otherwise(F.sum("n").over(Window.partitionBy("of", "own"))))
    sizes = sizes.filter(F.col("n") >= ENOUGH).select(
        F.col("of").alias("_of"), F.col("from").alias("_from"), F.when(F.col("own"), F.col("from")).otherwise(F.lit("*")).alias("to")
    )
    # One row per group: once stored, Spark knows how small it is and the rows need no shuffle to meet it.
    sizes = stage(sizes, "outliers-groups")
    grouped = rows.join(sizes, (F.col("of") == F.col("_of")) & (F.col("from") == F.col("_from"))).withColumn("from", F.col("to"))

    share = lambda count, of: F.when(F.col(of) > 0, F.floor(F.col(count) * MILLE / F.col(of))).otherwise(0).cast("long")
    shares = grouped.select("of", "from", *[share(*s[:2]).alias(x) for s, x in zip(SHARES, X)])
    middle = _quartiles(shares, ["of", "from"], X).select(
        F.col("of").alias("_of"), F.col("from").alias("_from"), F.transform("q", lambda v: v["q2"] / MILLE).alias("middle")
    )
    middle = stage(middle, "outliers-middles")

    def number(at, count, of, weight, transform, _):
        raised = (F.col(count) + weight * F.col("middle")[at]) / (F.col(of) + weight)
        return F.floor(SCALE * transform(raised) + 0.5).cast("long")

    known = grouped.drop("_of", "_from").join(middle, (F.col("of") == F.col("_of")) & (F.col("from") == F.col("_from")))
    numbers = [number(n, *share).alias(x) for n, (share, x) in enumerate(zip(SHARES, X))]
    return stage(known.select("row", "of", "from", *numbers), "outliers-vectors")


MOMENTS = ["n"] + [f"s{i}" for i in range(D)] + [f"p{i}_{j}" for i in range(D) for j in range(i + 1)]
FIT = "of string, from string, start int, n bigint, mean array<double>, white array<double>, det double"


def moments() -> list[Column]:
    """Sums of rows, of their numbers and of products of two of them."""
    return (
        [F.count(F.lit(1)).alias("n")]
        + [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)]
        + [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}_{j}") for i in range(D) for j in range(i + 1)]
    )


def spread(mean: np.ndarray, scatter: np.ndarray) -> tuple[list[float], list[float], float]:
    """The centre, the rows of the lower triangle that whitens around it, and the determinant's logarithm.

    A scatter has at least the spreads of SHARES, so it can be inverted where a
    group does not vary.
    """
    scatter = scatter + np.diag([(least * SCALE) ** 2 for *_, least in SHARES])
    root = np.linalg.cholesky(scatter)
    white = np.linalg.inv(root)
    return mean.tolist(), white[np.tril_indices(D)].tolist(), float(2 * np.log(np.diag(root)).sum())


def of_moments(n: int, s: list[int], p: list[int]) -> tuple[list[float], list[float], float]:
    """``spread`` of exact sums."""
    scatter = np.zeros((D, D))
    for (i, j), both in zip([(i, j) for i in range(D) for j in range(i + 1)], p):
        scatter[i, j] = scatter[j, i] = (both * n - s[i] * s[j]) / (n * n)
    return spread(np.array([x / n for x in s]), scatter)


def _fitted(sums: DataFrame) -> DataFrame:
    """FIT of every row of moments; one small row per group and start."""

    def each(batch):
        rows = batch.to_pylist()
        found = [of_moments(r["n"], [r[f"s{i}"] for i in range(D)], [r[m] for m in MOMENTS[D + 1 :]]) for r in rows]
        return {c: batch.column(c) for c in ("of", "from", "start", "n")} | {
            "mean": [f[0] for f in found], "white": [f[1] for f in found], "det": [f[2] for f in found]
        }

    return map_batches(sums.select("of", "from", "start", *MOMENTS), FIT, each)


def distance() -> Column:
    """The squared Mahalanobis distance of a row's vector from its fit."""
    total, at = None, 0
    for i in range(D):
        part = None
        for j in range(i + 1):
            term = F.col("white")[at] * (F.col(X[j]) - F.col("mean")[j])
            part, at = term if part is None else part + term, at + 1
        total = part * part if total is None else total + part * part
    return total


def binned(squared: Column) -> Column:
    return F.least(F.floor(F.log1p(squared) * FINE), F.lit(LAST)).cast("int")


def _medians(rows: DataFrame) -> DataFrame:
    """The first start: medians, and spreads by quartiles without correlation."""

    def each(batch):
        made = [start_of(*[[v[q] for v in row] for q in ("q1", "q2", "q3")]) for row in batch.column("q").to_pylist()]
        return {"of": batch.column("of"), "from": batch.column("from"), "start": [0] * len(made), "n": [0] * len(made)} | {
            "mean": [f[0] for f in made], "white": [f[1] for f in made], "det": [f[2] for f in made]
        }

    return map_batches(_quartiles(rows, ["of", "from"], X), FIT, each)


def start_of(q1: list[int], q2: list[int], q3: list[int]) -> tuple[list[float], list[float], float]:
    wide = (np.array(q3) - np.array(q1)) / (2 * NormalDist().inv_cdf(0.75))
    return spread(np.array(q2, float), np.diag(wide**2))


def _first_bin(rows: DataFrame, fits: DataFrame, keys: list[str], part: float, name: str) -> DataFrame:
    """For every fit the first bin of its group's distances that, with all bins before, holds ``part`` of the rows."""
    placed = rows.join(fits, ["of", "from"]).withColumn("bin", binned(distance()))
    counts, of = placed.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n")), Window.partitionBy(*keys)
    ranked = counts.select("*", F.sum("n").over(of.orderBy("bin")).alias("upto"), F.sum("n").over(of).alias("rows"))
    return ranked.filter(F.col("upto") >= F.ceil(F.col("rows") * part)).groupBy(*keys).agg(F.min("bin").alias(name))


def _scaled(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """``fits`` with ``wide``: the factor by which squared distances are too large, by their median; 1 at least."""
    middle = _first_bin(rows, fits, ["of", "from"], 0.5, "_middle")
    wide = F.greatest(F.lit(1.0), F.expm1((F.col("_middle") + 0.5) / FINE) / F.lit(far(0.5)))
    return stage(fits.join(middle, ["of", "from"]).withColumn("wide", wide).drop("_middle"), "outliers-scaled")


def estimates(rows: DataFrame, part: float = PART, steps: int = STEPS) -> DataFrame:
    """of, from, mean, white, wide of every group of ``rows`` (``vectors``): a row of bounded size each."""
    keys = ["of", "from", "start"]
    plain = _fitted(rows.groupBy("of", "from").agg(*moments()).withColumn("start", F.lit(1)))
    fits = stage(_medians(rows).union(plain), "outliers-fits")
    before = None
    for _ in range(steps):
        limit = _first_bin(rows, fits, keys, part, "_limit")
        limited = stage(fits.join(limit, keys), "outliers-limits")
        near = rows.join(limited, ["of", "from"]).filter(binned(distance()) <= F.col("_limit"))
        fits = stage(_fitted(near.groupBy(*keys).agg(*moments())), "outliers-fits")
        if before is not None:
            # A start whose determinant no longer falls stays as it is.
            now = fits.join(before, keys)
            if now.filter(F.col("det") < F.col("_det") - STILL).isEmpty():
                break
        before = fits.select(*keys, F.col("det").alias("_det"))
    first = F.row_number().over(Window.partitionBy("of", "from").orderBy("det", "start"))
    best = _scaled(rows, fits.withColumn("_r", first).filter("_r = 1").select("of", "from", "mean", "white"))
    near = rows.join(best, ["of", "from"]).filter(distance() <= F.col("wide") * F.lit(far(0.025)))
    refit = _fitted(near.groupBy("of", "from").agg(*moments()).withColumn("start", F.lit(0)))
    return _scaled(rows, refit.select("of", "from", "mean", "white"))


def quality(docs: DataFrame, beyond: float = BEYOND, part: float = PART) -> DataFrame:
    """doc_id, COUNTS, base_failed, distance, kept of every row of ``docs`` (doc_id, text, lang, source, ...).

    ``base_failed``: fewer than 20 words, or more than 30 in 100 words in repeated
    windows. ``distance``: the Mahalanobis distance from the estimate of the row's
    language and source, over all rows that pass these limits; null languages
    and sources are groups like others. Groups of fewer than ENOUGH rows are
    taken together per language; where these are too few as well, there is no
    distance and nothing is rejected by it. ``kept``: not failed, and no farther than
    a normal vector would be with probability ``beyond``. Null and empty texts have
    no words and fail. Repeated rows count one by one; an empty table gives no
    rows. Other columns are ignored.
    """
    counts = stage(counted(docs).withColumn("row", F.monotonically_increasing_id()), "outliers-counts")
    rows = vectors(counts)
    fits = estimates(rows, part)
    placed = rows.join(fits, ["of", "from"]).select("row", F.sqrt(distance() / F.col("wide")).alias("distance"))
    limit = math.sqrt(far(beyond))
    return counts.join(placed, "row", "left").select(
        "doc_id", *COUNTS, failed().alias("base_failed"), "distance",
        (~failed() & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"),
    )
