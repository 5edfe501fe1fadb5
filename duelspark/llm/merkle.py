"""Document fingerprints: Merkle trees over sections, paragraphs, sentences and pieces.

A paragraph is a line with the line ends behind it. Its sentences end at stops
or after ``SENTENCE_CHARS``; their leaves are pieces of a few words. A section is a run of paragraphs that ends
at a blank line or where a paragraph's hash says so, which is the same place in
any text that has this paragraph. Each node's hash covers its children; equal
roots mean equal texts. Two trees are compared from the root down: equal nodes
are settled whole, wherever they stand, and only different ones are opened, down
to the pieces that were edited.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelspark.llm.arrow import arrow_schema, map_batches, rows_of, slices

SENTENCE_CHARS, WORD_CHARS, PIECE_WORDS = 240, 32, 3
PARAGRAPH = re.compile(r"[^\n]*\n+|[^\n]+")
SENTENCE = re.compile(rf"[^.!?]{{1,{SENTENCE_CHARS}}}(?:[.!?]+\s*)?|[.!?]+\s*")
PIECE = re.compile(rf"\s*(?:\S{{1,{WORD_CHARS}}}\s*){{1,{PIECE_WORDS}}}|\s+")

#: A section has so many paragraphs on average where there are no blank lines.
SECTION_PARAGRAPHS = 8


#: A node is a tuple: hash, first code point, code points, nodes below it.
Node = tuple
HASH, START, CHARS, BELOW = range(4)
EMPTY: Node = (hashlib.blake2b(digest_size=16, person=b"empty").digest(), 0, 0, ())


def _leaf(piece: str) -> bytes:
    return hashlib.blake2b(piece.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _over(nodes: list[Node]) -> Node:
    content = hashlib.blake2b(b"".join([n[HASH] for n in nodes]), digest_size=16, person=b"node")
    return content.digest(), nodes[0][START], sum([n[CHARS] for n in nodes]), tuple(nodes)


def paragraphs(text: str, at: int, known: dict[str, bytes]) -> list[Node]:
    """The nodes of the paragraphs of ``text`` from ``at`` on. ``known``: hashes of pieces, looked up and added to."""
    out = []
    for paragraph in PARAGRAPH.findall(text, at):
        sentences = []
        for sentence in SENTENCE.findall(paragraph):
            leaves = []
            for piece in PIECE.findall(sentence):
                hashed = known.get(piece)
                if hashed is None:
                    hashed = known[piece] = _leaf(piece)
                leaves.append((hashed, at, len(piece), ()))
                at += len(piece)
            sentences.append(_over(leaves))
        out.append(_over(sentences))
    return out


def rooted(text: str, nodes: list[Node]) -> Node:
    """The root over the paragraphs ``nodes`` of ``text``."""
    sections, open_ = [], []
    for node in nodes:
        open_.append(node)
        end = node[START] + node[CHARS]
        if text[end - 2 : end] == "\n\n" or node[HASH][0] % SECTION_PARAGRAPHS == 0:
            sections.append(_over(open_))
            open_ = []
    if open_:
        sections.append(_over(open_))
    return _over(sections) if sections else EMPTY


def tree(text: str, known: dict[str, bytes] | None = None) -> Node:
    """The root over the sections of a text."""
    return rooted(text, paragraphs(text, 0, {} if known is None else known))


def changed(root: Node, text: str, since: int, known: dict[str, bytes]) -> Node:
    """The tree of ``text``, which is the text of ``root`` up to ``since``; paragraphs that end before are taken over."""
    same = [p for section in root[BELOW] for p in section[BELOW] if p[START] + p[CHARS] < since]
    at = same[-1][START] + same[-1][CHARS] if same else 0
    return rooted(text, same + paragraphs(text, at, known))


def compare(one: Node, other: Node) -> tuple[float, list[tuple[int, int]]]:
    """Likeness from 0 to 1, and the spans of ``one`` (code points) that ``other`` doesn't have.

    Likeness is twice the code points in common over those of both; 1 for two
    empty texts. A repeated node is in common as often as both have it.
    """
    if one[HASH] == other[HASH]:
        return 1.0, []
    common, mine, theirs = 0, [one], [other]
    while mine and theirs:
        left = Counter(n[HASH] for n in theirs)
        rest = []
        for node in mine:
            if left[node[HASH]] > 0:
                left[node[HASH]] -= 1
                common += node[CHARS]
            else:
                rest.append(node)
        still = []
        for node in reversed(theirs):
            if left[node[HASH]] > 0:
                left[node[HASH]] -= 1
                still.append(node)
        if not rest or not any(n[BELOW] for n in rest):
            mine = rest
            break
        mine = [below for node in rest for below in node[BELOW]]
        theirs = [below for node in reversed(still) for below in node[BELOW]]
    edits: list[tuple[int, int]] = []
    for node in mine:
        if edits and edits[-1][1] == node[START]:
            edits[-1] = (edits[-1][0], node[START] + node[CHARS])
        else:
            edits.append((node[START], node[START] + node[CHARS]))
    return 2 * common / (one[CHARS] + other[CHARS]), edits


TREE = (
    "array<struct<hash:binary,chars:bigint,paragraphs:array<struct<hash:binary,chars:bigint,"
    "sentences:array<struct<hash:binary,chars:bigint,pieces:array<binary>>>>>>>"
)


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint (root, hex) and sections (the tree) of every row of ``docs`` (doc_id, text, ...).

    Null text is empty: no sections, and the fixed root of empty texts. Repeated
    rows have equal fingerprints; other columns are ignored.
    """

    def each(batch):
        roots = [tree(text or "") for text in batch.column("text").to_pylist()]
        names = ("paragraphs", "sentences", "pieces")

        def opened(node, depth=0):
            inner = [n[HASH] if depth == 2 else opened(n, depth + 1) for n in node[BELOW]]
            return {"hash": node[HASH], "chars": node[CHARS], names[depth]: inner}

        return {
            "doc_id": batch.column("doc_id"),
            "n_chars": [r[CHARS] for r in roots],
            "fingerprint": [r[HASH].hex() for r in roots],
            "sections": [[opened(s) for s in r[BELOW]] for r in roots],
        }

    return map_batches(_narrow(docs), f"doc_id bigint, n_chars bigint, fingerprint string, sections {TREE}", each)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _range_of(key: Column, bounds: list[int], first: int = 0) -> Column:
    """The number of bounds below ``key``, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(key <= bounds[middle], _range_of(key, bounds[:middle], first)).otherwise(
        _range_of(key, bounds[middle + 1 :], first + middle + 1)
    )


def in_order(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) ranged into partitions by doc_id and sorted, each row once with ``tail`` false.

    The row that follows a partition's last one stands behind it with ``tail``
    true; the first row of all follows the last. Equal ids (null is the smallest)
    are ordered by text. Bounds come from the ids alone; one id per partition
    reaches the driver.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [n / parts for n in range(1, parts)]
    bounds = docs.select(key.alias("k")).agg(F.percentile_approx("k", shares, F.lit(10_000))).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    part = _range_of(key, bounds)
    firsts = {r.part: r.k for r in docs.select(part.alias("part"), key.alias("k")).groupBy("part").agg(F.min("k").alias("k")).collect()}
    filled = sorted(firsts)
    before = {p: filled[n - 1] for n, p in enumerate(filled)}
    rows = range(len(bounds) + 1)
    longs = F.array(*[F.lit(firsts.get(n)).cast("long") for n in rows])
    ints = F.array(*[F.lit(before.get(n, 0)) for n in rows])
    to = F.array(F.struct(F.col("_part").alias("part"), F.lit(False).alias("tail")))
    copy = F.array(F.struct(F.get(ints, F.col("_part")).alias("part"), F.lit(True).alias("tail")))
    return (
        docs.select("doc_id", "text", key.alias("_key"), part.alias("_part"))
        .select("doc_id", "text", "_key", F.explode(F.when(F.col("_key") == F.get(longs, F.col("_part")), F.concat(to, copy)).otherwise(to)).alias("_to"))
        .select("doc_id", "text", "_key", F.col("_to.part").alias("part"), F.col("_to.tail").alias("tail"))
        .repartitionById(len(bounds) + 1, F.col("part"))
        .sortWithinPartitions("part", "tail", "_key", "text")
        .drop("_key")
    )


EDITED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edits array<struct<start:bigint,end:bigint>>"
)


def edited_by_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of the text with its last quarter replaced by the start of the next document.

    The last floor(n_chars / 4) code points give way to the first as many (or
    all) of the next document by ascending doc_id, after the last the first.
    ``near_edited`` and ``near_next`` compare the text's tree with the edited and
    the next one; ``edits`` are the spans of the text that the edited one lacks.
    Null text is empty, a null doc_id is the smallest, rows of one doc_id follow
    each other by text; other columns are ignored.
    """
    schema = arrow_schema(EDITED)

    def run(batches):
        held = None
        for batch in slices(batches):
            out = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "tail")]
            for doc, text, part, tail in zip(*columns):
                text = text or ""
                if held is not None and held[0] == part and held[1]:
                    out.append(one_of(held, text))
                    root, known = out[-1][1], out[-1][2]
                    out[-1] = out[-1][0]
                else:
                    known = {}
                    root = tree(text, known)
                held = (part, not tail, doc, text, root, known)
            yield rows_of([list(c) for c in zip(*out)] or [[]] * len(schema), schema)

    def one_of(held, following):
        _, _, doc, text, root, known = held
        fresh: dict[str, bytes] = {}
        after = tree(following, fresh)
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        edited_root = changed(root, edited, len(text) - cut, known)
        near, edits = compare(root, edited_root)
        row = (
            doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), root[HASH].hex(),
            edited_root[HASH].hex(), near, compare(root, after)[0], [{"start": a, "end": b} for a, b in edits],
        )
        return row, after, fresh

    return in_order(_narrow(docs)).mapInArrow(run, EDITED)
