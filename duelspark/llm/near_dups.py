"""MinHash near-duplicates with tensored banding.

Two collections of ``half`` short keys are made of a document's minhash values,
``rows`` values each. A table key is a pair of one key of either collection:
half * half tables of 2 * rows values for 2 * half * rows minhash values, where
plain banding would need half * half * 2 * rows. Documents that share a table
key are candidates; every link is confirmed on the full shingle sets.

A pair of similarity s is missed if it agrees in no key of one collection:
about 2 * (1 - s ** rows) ** half, with 10 keys of 2 rows 7 in 100,000 at 0.8
and 2 in ten million at 0.9.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelspark.llm.arrow import KEY_BYTES, kept_in_worker, map_batches, utf8
from duelspark.session import stage

HALF, ROWS = 10, 2

#: Up to so many ids in a key all pairs of them are looked at.
FEW = 32

#: A shingle of at most so many candidates is rare: all pairs that share it are looked at.
RARE = 64

#: Classes whose table keys one task makes.
TASK_CLASSES = 1 << 13

#: A reserved name beside the columns of a caller's table.
_ROW = "__near_row"

#: Distinct words whose hashes a task keeps.
KEPT_WORDS = 200_000


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Sets of hashed word shingles. Words are cut at blanks, A-Z in lower case."""

    def __init__(self, words: int):
        self.words, self.hashes = words, {}
        self.factors = _odd(words, 7)

    @classmethod
    def of(cls, words: int) -> Shingler:
        """One per worker process; what an operator before it kept there is freed."""
        return kept_in_worker((cls.__name__, words), lambda: cls(words))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct hashes per text; fewer words than a shingle has are one shingle, none are an empty set."""
        if len(self.hashes) > KEPT_WORDS:
            self.hashes.clear()
        get, out = self.hashes.get, []
        for text in texts:
            words = text.lower().split()
            codes = []
            for word in words:
                code = get(word)
                if code is None:
                    code = xxhash.xxh64_intdigest(word)
                    if len(word) <= KEY_BYTES:
                        self.hashes[word] = code
                codes.append(code)
            codes = np.array(codes, np.uint64)
            if len(codes) < self.words:
                # The number of words is hashed too: a short sequence equals no shingle.
                whole = _mixed((codes * _odd(len(codes), 11)).sum(keepdims=True) + np.uint64(len(codes)))
                out.append(whole if len(codes) else codes)
                continue
            n = len(codes) - self.words + 1
            total = np.zeros(n, np.uint64)
            for k, factor in enumerate(self.factors):
                total += _mixed(codes[k : k + n] * factor)
            out.append(np.unique(_mixed(total)))
        return out


SIGNED = "doc_id bigint, row binary, n_shingles bigint, set_1 bigint, set_2 bigint, left array<bigint>, right array<bigint>"


def signatures(docs: DataFrame, words: int, half: int = HALF, rows: int = ROWS) -> DataFrame:
    """doc_id, row key, size and hash of the shingle set, and both collections of keys (null for an empty set)."""
    ready: list[Shingler] = []

    def each(batch):
        if not ready:
            ready.append(Shingler.of(words))
        sets = ready[0].sets(utf8(batch.column("text")))
        sizes = np.array([len(s) for s in sets])
        full = np.flatnonzero(sizes)
        keys = np.zeros((2 * half, len(full)), np.uint64)
        if len(full):
            flat = np.concatenate([sets[i] for i in full])
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            factors = _odd(2 * half * rows, 3).reshape(2 * half, rows)
            for n in range(2 * half):
                for factor in factors[n]:
                    keys[n] = _mixed(keys[n] * factor + np.minimum.reduceat(flat * factor, starts))
        left, right = [None] * len(sets), [None] * len(sets)
        for column, i in enumerate(full):
            left[i], right[i] = keys[:half, column].view(np.int64), keys[half:, column].view(np.int64)
        digests = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets]
        return {
            "doc_id": batch.column("doc_id"), "row": batch.column("row"), "n_shingles": sizes, "left": left, "right": right,
            "set_1": [int(d[0]) for d in digests], "set_2": [int(d[1]) for d in digests],
        }

    return map_batches(_narrow(docs), SIGNED, each)


def row_key() -> Column:
    """A hash of doc_id and text: the same for rows equal in both, where a null equals a null only."""
    doc, text = F.col("doc_id").cast("long").cast("string"), F.col("text").cast("string")
    mark = F.when(text.isNull(), F.lit(" ")).otherwise(F.lit(":"))
    return F.unhex(F.md5(F.concat(F.coalesce(doc, F.lit("")), mark, F.coalesce(text, F.lit("")))))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row")
    )


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """id and the full shingle set of texts (id, text)."""
    ready: list[Shingler] = []

    def each(batch):
        if not ready:
            ready.append(Shingler.of(words))
        sets = ready[0].sets(utf8(batch.column("text")))
        return {"id": batch.column("id"), "set": [s.view(np.int64) for s in sets]}

    return map_batches(docs, "id bigint, set array<bigint>", each)


def table_keys(left: Column, right: Column) -> Column:
    """All pairs of a key of either collection, hashed with their places."""
    return F.flatten(
        F.transform(left, lambda a, i: F.transform(right, lambda b, j: F.xxhash64(a, i.cast("long"), b, j.cast("long"))))
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets (id, set) have 100 * intersection >= percent * union."""
    of = lambda c: sets.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}"))
    both, all_ = F.size(F.array_intersect("set_a", "set_b")), F.size("set_a") + F.size("set_b")
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(100 * both >= percent * (all_ - both)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of every id in ``links`` (a, b), which is stored.

    Labels go to neighbours as minimum, which is aggregated before it is shuffled,
    and every label then takes the label of its label. Each round is written.
    """
    both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l"))
    edges = stage(both.select(F.col("l.a").alias("from"), F.col("l.b").alias("to")), "near-edges")
    labels = stage(
        edges.groupBy(F.col("from").alias("id")).agg(F.least(F.min("from"), F.min("to")).alias("component")), "near-labels"
    )
    while True:
        heard = (
            edges.join(labels, F.col("from") == F.col("id")).groupBy(F.col("to").alias("id")).agg(F.min("component").alias("_heard"))
        )
        moved = labels.join(heard, "id").select(
            "id", F.least("component", "_heard").alias("_next"), F.col("component").alias("_was")
        )
        roots = labels.select(F.col("id").alias("_next"), F.col("component").alias("_root"))
        after = stage(
            moved.join(roots, "_next").select("id", F.least("_next", "_root").alias("component"), "_was"), "near-labels"
        )
        labels = after.select("id", "component")
        if after.filter("component != _was").isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, component) after ``links`` (a, b) between them, of which one per pair of components is followed."""
    of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
    ends = links.join(of("a"), "a").join(of("b"), "b").filter("of_a != of_b")
    pairs = stage(ends.select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")).distinct(), "near-pairs")
    if pairs.isEmpty():
        return labels
    roots = components(pairs).select(F.col("id").alias("component"), F.col("component").alias("_root"))
    after = labels.join(roots, "component", "left").select("id", F.coalesce("_root", "component").alias("component"))
    return stage(after, "near-labels")


def _open(placed: DataFrame, labels: DataFrame, on: str = "key") -> DataFrame:
    """The rows of ``placed`` (key, id, ...) whose key still holds more than one component, with ``component``, stored.

    ``in_key``: ids in the key; ``major``: the component that has most of them.
    """
    rows = placed.join(labels, "id")
    counts = rows.groupBy(on, "component").agg(F.count("id").alias("_ids"))
    ends = counts.groupBy(on).agg(
        F.count("component").alias("_several"), F.sum("_ids").alias("in_key"), F.max(F.struct("_ids", "component")).alias("_most")
    )
    ends = stage(ends.filter("_several > 1").select(on, "in_key", F.col("_most.component").alias("major")), "near-keys")
    return stage(rows.join(ends, on), "near-open")


def _stars(rows: DataFrame, order: Column) -> DataFrame:
    """Pairs (a, b) of every id in ``rows`` (key, id, ...) with the first and the last of its keys' smallest rows in ``order``, which ends in id."""
    heads = stage(rows.groupBy("key").agg(F.min(order).alias("head")), "near-heads")
    ends = rows.join(heads, "key").groupBy("id").agg(F.min("head").alias("_low"), F.max("head").alias("_high"))
    both = ends.select(F.explode(F.array("_low", "_high")).alias("head"), F.col("id").alias("b"))
    return both.select(F.col("head.id").alias("a"), "b").filter("a != b").distinct()


def _pairs(rows: DataFrame, condition: Column, on: str = "key") -> DataFrame:
    """Distinct pairs of different components that share ``on`` and meet ``condition`` on their columns, with a_ and b_ before.

    ``rows`` has id, component and major. Ids of a key's major component are met by
    the others only, never by each other.
    """
    side = lambda mark: rows.select(*[F.col(c).alias(c if c == on else f"{mark}_{c}") for c in rows.columns])
    once = (F.col("b_component") == F.col("b_major")) | (F.col("a_id") < F.col("b_id"))
    met = side("a").filter("a_component != a_major").join(side("b"), on).filter((F.col("a_component") != F.col("b_component")) & once & condition)
    return met.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def _rare(ids: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rare shingles of ``ids`` (those that at most RARE of them have) as two tables of id, shingle: of one id alone, and of several.

    A shingle of one id alone links nothing and its id stands in the count's row,
    so only those of several ids are joined back.
    """
    has = sets.join(ids, "id").select("id", F.explode("set").alias("shingle"))
    few = has.groupBy("shingle").agg(F.count("id").alias("_ids"), F.min("id").alias("id")).filter(F.col("_ids") <= RARE)
    few = stage(few, "near-few")
    several = has.join(few.filter("_ids > 1").select("shingle"), "shingle").select("id", "shingle")
    return few.filter("_ids = 1").select("id", "shingle"), stage(several, "near-rare")


def across(placed: DataFrame, labels: DataFrame, sets: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """``labels`` after all links between components of a key; ``placed``: key, place, id, n; ``keys``: id, left, right.

    In a key of few ids all pairs of like sizes of different components are
    compared. In larger ones a shingle is rare if few of their ids have it; what is
    left of a set is its core. Most ids of a hot key are close to what its ids
    share, so every id is first compared with those whose sets are nearest to their
    cores. Then, for what is still apart:

    A pair with a rare shingle in common is found by that shingle. Without one, a
    pair can have no more in common than the cores, and few reach the percentage
    so. Of all sets of one core the smallest is as near to any other core as
    they get: what is linked to one of the others is linked to it. So those that
    are linked to the smallest are left to it; those that are not are linked to
    none of their core. Only the others of different cores are paired, once, inside
    a key. No link between components is lost.
    """
    like = lambda x, y: F.lit(100) * F.least(x, y) >= F.lit(percent) * F.greatest(x, y)
    enough = lambda common, x, y: 100 * common >= percent * (x + y - common)
    sized = like(F.col("a_n"), F.col("b_n"))
    follow = lambda pairs: merged(labels, stage(confirmed(pairs, sets, percent), "near-links"))

    still = _open(placed, labels)
    small = _pairs(still.filter(F.col("in_key") <= FEW), sized)
    labels = follow(small)
    large = still.filter(F.col("in_key") > FEW).select("key", "place", "id", "n")
    if large.isEmpty():
        return labels

    ids = stage(large.select("id").distinct(), "near-ids")
    single, several = _rare(ids, sets)
    rare = single.union(several)
    counts = rare.groupBy("id").agg(F.count("shingle").alias("_rare"))
    counts = stage(ids.join(counts, "id", "left").select("id", F.coalesce("_rare", F.lit(0)).alias("rare")), "near-counts")
    # Read by every step that follows, so made once.
    placed = stage(large.join(counts, "id"), "near-large")
    still = _open(placed, labels)
    labels = follow(_stars(still, F.struct("rare", -F.col("n"), "id")))

    still = _open(placed, labels)
    of_rare = _open(several.join(still.select("id", "n").distinct(), "id"), labels, "shingle")
    labels = follow(_pairs(of_rare, sized, "shingle"))

    still = _open(placed, labels)
    least = stage(still.groupBy("key").agg(F.min("n").alias("least")), "near-least")
    often = F.col("n") - F.col("rare")
    hopeful = still.join(least, "key").filter(enough(often, F.col("n"), F.greatest("least", often))).select("key", "place", "id", "n", "rare")
    hopeful = stage(hopeful, "near-hopeful")
    ids = hopeful.select("id", "n", "rare").distinct()
    listed = rare.join(ids.select("id"), "id").groupBy("id").agg(F.collect_list("shingle").alias("_rare"))
    cores = ids.join(sets, "id").join(listed, "id", "left").select(
        "id", "n", F.array_except("set", F.coalesce("_rare", F.array().cast("array<bigint>"))).alias("core")
    )
    cores = stage(cores.select("id", "n", F.xxhash64("core").alias("core_1"), F.hash("core").alias("core_2")), "near-cores")
    smallest = stage(cores.groupBy("core_1", "core_2").agg(F.min(F.struct("n", "id")).alias("s")), "near-smallest")
    own = cores.join(smallest, ["core_1", "core_2"]).select("id", F.col("s.id").alias("for"), F.col("s.n").alias("for_n"))
    found = stage(confirmed(own.filter("id != for").select(F.col("for").alias("a"), F.col("id").alias("b")), sets, percent), "near-links")
    labels = merged(labels, found)
    left = own.join(found.select(F.col("b").alias("id"), F.lit(True).alias("_linked")), "id", "left")
    speakers = left.filter("_linked IS NULL").select("id").join(cores.select("id", "core_1", "core_2"), "id")
    short = lambda c: F.transform(c, lambda x: F.pmod(x, F.lit((1 << 31) - 1)).cast("int")).alias(c)
    speakers = speakers.join(keys.select("id", short("left"), short("right")), "id")
    apart = _open(hopeful.join(speakers, "id"), labels).withColumn("often", often)
    other = (F.col("a_core_1") != F.col("b_core_1")) | (F.col("a_core_2") != F.col("b_core_2"))
    # Two ids may share many table keys; they meet in the first keys of either collection that they share.
    half = F.size("a_right")
    none = lambda c, n: F.forall(F.zip_with(F.slice(f"a_{c}", 1, n), F.slice(f"b_{c}", 1, n), lambda x, y: x != y), lambda x: x)
    once = none("left", F.floor(F.col("a_place") / half).cast("int")) & none("right", F.col("a_place") % half)
    return follow(_pairs(apart, other & sized & enough(F.least("a_often", "b_often"), F.col("a_n"), F.col("b_n")) & once))


def verdicts(docs: DataFrame, words: int = 5, percent: int = 80, half: int = HALF, rows: int = ROWS) -> DataFrame:
    """As ``near_duplicates``, with the row key and the hash of the shingle set (set_1, set_2) of every row."""
    # Stored with their places, so that each class is named by one of its rows, with or without doc_id.
    signed = stage(signatures(docs, words, half, rows).withColumn("at", F.monotonically_increasing_id()), "near-signatures")
    named = signed.filter("n_shingles > 0")
    classes = stage(
        named.groupBy("set_1", "set_2").agg(F.min("at").alias("id"), F.min("doc_id").alias("doc"), F.min("n_shingles").alias("n")),
        "near-classes",
    )
    # One row becomes a hundred: more tasks than the rows alone would get.
    tasks = classes.count() // TASK_CLASSES + 1
    firsts = named.join(classes.select(F.col("id").alias("at")), "at").repartition(tasks, "at")
    members = firsts.select(
        F.col("at").alias("id"), F.posexplode(table_keys(F.col("left"), F.col("right"))).alias("place", "key")
    )
    keys = members.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("_last")).filter("first < _last")
    shared = stage(members.join(stage(keys.select("key", "first"), "near-keys"), "key"), "near-shared")
    # Every id against two of the smallest ids in its keys: enough to make most groups one component.
    ends = shared.filter("id != first").groupBy("id").agg(F.min("first").alias("_low"), F.max("first").alias("_high"))
    stars = ends.select(F.explode(F.array_distinct(F.array("_low", "_high"))).alias("a"), F.col("id").alias("b"))
    # The texts of candidates alone are shingled again, one row of each class.
    ids = shared.select("id").distinct()
    texts = _narrow(docs).join(signed.select(F.col("at").alias("id"), "row").join(ids, "id"), "row").select("id", "text")
    sets = stage(_sets(texts, words).dropDuplicates(["id"]), "near-sets")
    alone = stage(sets.select("id", F.col("id").alias("component")), "near-labels")
    labels = merged(alone, stage(confirmed(stars, sets, percent), "near-links"))
    placed = shared.select("key", "place", "id").join(classes.select("id", "n"), "id")
    labels = across(placed, labels, sets, signed.select(F.col("at").alias("id"), "left", "right"), percent)

    # A component takes its smallest doc_id, and the class that has it is kept; classes without doc_id come last.
    rank = F.struct(F.col("doc").isNull().alias("none"), "doc", "set_1", "set_2")
    best = classes.join(labels, "id").groupBy("component").agg(F.min(rank).alias("best"))
    all_ = classes.join(labels.join(best, "component").select("id", "best"), "id", "left").select(
        "set_1", "set_2",
        F.when(F.col("best").isNull(), F.col("doc")).otherwise(F.col("best.doc")).alias("component_id"),
        (F.col("best").isNull() | ((F.col("best.set_1") == F.col("set_1")) & (F.col("best.set_2") == F.col("set_2")))).alias("speaks"),
    )
    found = (
        signed.select("doc_id", "n_shingles", "set_1", "set_2", "row")
        .join(all_, ["set_1", "set_2"], "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    )
    speaks = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.coalesce("speaks", F.lit(True))
    kept = F.when(F.col("doc_id").isNull(), speaks).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), speaks.alias("speaks"), "row", "set_1", "set_2")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, half: int = HALF, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text, ...).

    Rows of equal sets are one class, so that copies are never paired. The
    classes are compared with the smallest ones of their table keys; where more
    than one component is left in a key, ``across`` finds the links between them
    that remain, none of them missed.

    Null and empty texts have no set and are linked with nothing; they are kept.
    A component has the smallest doc_id of its rows, null if none has one. ``kept``
    is doc_id = component_id; rows that repeat the id are kept together. Of rows
    without doc_id in a component without one those of one class are kept. Texts
    of one doc_id that are not alike are told apart. An empty table gives no rows;
    other columns are ignored.
    """
    found = verdicts(docs, words, percent, half, rows)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs`` with all its columns.

    It is a row of the class that has the component's smallest doc_id, the one whose
    row key is smallest. Rows without a set all go on, but those equal in doc_id
    and text as one row. Of rows that differ in other columns only, any one may go on.
    """
    spoken = verdicts(docs, words, percent).filter("speaks")
    alone = spoken.filter("n_shingles = 0").select(F.col("row").alias(_ROW))
    chosen = spoken.filter("n_shingles > 0").groupBy("set_1", "set_2").agg(F.min("row").alias(_ROW)).select(_ROW)
    rows = docs.withColumn(_ROW, row_key()).join(chosen.union(alone), _ROW, "left_semi")
    return rows.dropDuplicates([_ROW]).select(*[F.col(f"`{c}`") for c in docs.columns])
