"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled into three parts that are composed with each input:
the normaliser (blanks become the blank sign, one stands before the text), the
pieces as a trie of weighted arcs, and arcs that spell a character without a
piece in bytes. The encoding is the path of least weight in the tropical
semiring.

A merge-ranked (BPE) model does not choose the path of least summed score. What
it chooses is local, though: pieces next to each other in an encoding are what
the merges make of these two alone, and a sequence whose neighbours are all
such is the encoding, since the first merge across a border would also happen
in the pair. The transducer of such a model therefore remembers its last piece
in its state, and an arc to a piece that this one can't precede has infinite
weight. One path is left, and it is the encoding. A unigram model has no such
condition, and scores alone decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelspark.llm.arrow import MEMO_BYTES, Memo, kept_in_worker, map_batches, utf8

#: Fixed values of the model format: the blank sign, piece types and model types.
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: Words, word parts and piece pairs whose result a worker keeps.
KEPT = 400_000

#: The weight of a spelled byte; larger than any piece's in a model file.
BYTE_WEIGHT = 1e10


def trie(pieces: Iterable[str]) -> list:
    """Nodes of (next nodes by character, piece that ends here)."""
    root = [{}, None]
    for piece in pieces:
        node = root
        for c in piece:
            node = node[0].setdefault(c, [{}, None])
        node[1] = piece
    return root


class Transducer:
    """A compiled model.

    Models with a character map of their own, with user-defined pieces or
    without byte pieces are refused.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep characters and blanks as they are can be compiled")
        if USER_DEFINED in kinds or UNUSED in kinds or BYTE not in kinds:
            raise ValueError("only models with normal and byte pieces can be compiled")
        if model.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models can be compiled")
        self.merges = model.trainer_spec.model_type == BPE
        self.prefix = BLANK if rules.add_dummy_prefix else ""
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.ids = {p.piece: n for n, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:-1], 16): n for n, p in enumerate(model.pieces) if p.type == BYTE}
        #: Characters side by side in some piece; no merge or piece crosses another border.
        self.inside = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.trie = trie(self.ids)
        self.longest = max(map(len, self.ids))
        self.singles = {piece for piece in self.ids if len(piece) == 1}
        #: Words: from a blank, or a sign behind a letter or digit that no piece spans, up to the next such place.
        letter, sign = b"A-Za-z0-9", re.escape(self._signs()).encode()
        fill = {b"L": letter, b"S": sign}
        word = rb"[ <S>][^ <L>]*+(?:[<L>]++(?:[^ <L><S>][^ <L>]*+)?+)*+"
        self.split = re.compile(re.sub(b"<([LS])>", lambda m: fill[m[1]], word)).findall
        #: Ids of pieces as they are stored.
        self.codes = {piece: n.to_bytes(4, "little") for piece, n in self.ids.items()}
        self.text = [
            bytes([int(p.piece[3:-1], 16)]) if p.type == BYTE
            else b"" if p.type == CONTROL
            else " ⁇ ".encode() if p.type == UNKNOWN
            else p.piece.replace(BLANK, " ").encode()
            for p in model.pieces
        ]
        # Most memory goes to the words, of which few are cut any further.
        self.words = Memo(self._word, KEPT, 2 * MEMO_BYTES)
        self.parts = Memo(self._part, KEPT, MEMO_BYTES // 2)
        self.edges = Memo(self._edges, KEPT, MEMO_BYTES // 4)
        self.pairs = Memo(self._met, KEPT, MEMO_BYTES * 3 // 2)

    @classmethod
    def of(cls, path: str) -> Transducer:
        """One per worker process, which Spark uses for many tasks."""
        return kept_in_worker((cls.__name__, path), lambda: cls(path))

    def _signs(self) -> str:
        """ASCII signs that stand behind an ASCII letter or digit in no piece."""
        ascii_ = [chr(c) for c in range(0x80)]
        bound = {y for x in ascii_ if x.isalnum() for y in ascii_ if x + y in self.inside}
        return "".join(c for c in ascii_ if not c.isalnum() and c != " " and c not in bound)

    def merged(self, text: str, done: list[tuple[float, int]] | None = None) -> list[str]:
        """What the merges make of ``text``: best score first, then from the left. ``done`` gets score and place of each."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            if done is not None:
                done.append((best, at - len(parts)))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _edges(self, piece: str) -> tuple[list, list] | None:
        """First and last symbols that a piece has while it is merged, each as (symbol, from, until).

        The bounds are scores: merges come in falling order of score, so a symbol
        is there from the merge that makes it until the one that takes it up.
        None if the merges don't make this piece or not in falling order.
        """
        done: list[tuple[float, int]] = []
        if self.merged(piece, done) != [piece] or any(x[0] <= y[0] for x, y in zip(done, done[1:])):
            return None
        parts = list(piece)
        first, last = [[parts[0], np.inf, -np.inf]], [[parts[-1], np.inf, -np.inf]]
        for score, back in done:
            at = len(parts) + back
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            for symbols, symbol in ((first, parts[0]), (last, parts[-1])):
                if symbols[-1][0] != symbol:
                    symbols[-1][2] = score
                    symbols.append([symbol, score, -np.inf])
        return first, last

    def _met(self, pair: tuple[str, str]) -> bool:
        """Whether the merges leave the border between two pieces alone.

        They cross it if a last symbol of the left and a first symbol of the right
        piece are there together and make a piece before a merge takes either up;
        of equal scores the place further left goes first.
        """
        if pair[0] not in self.ids:  # the start or spelled bytes: any piece may follow that merges can make
            return self.merged(pair[1]) == [pair[1]]
        left, right = self.edges[pair[0]], self.edges[pair[1]]
        if left is None or right is None:
            return self.merged("".join(pair)) == list(pair)
        scores = self.scores
        for x, x_from, x_until in left[1]:
            for y, y_from, y_until in right[0]:
                score = scores.get(x + y)
                if score is not None and score > x_until and score >= y_until and x_until < y_from and y_until <= x_from:
                    return False
        return True

    def path(self, text: str) -> list[str]:
        """The pieces on the path of least weight through ``text``; a character without a piece stands for its bytes.

        A position needs one state: without merges the one of least weight, with
        them the only last piece that all neighbours before allow.
        """
        size, trie, scores, pairs, merges = len(text), self.trie, self.scores, self.pairs, self.merges
        weights, lasts = [0.0] * (size + 1), [None] * (size + 1)
        lasts[0] = ""
        for start in range(size):
            last = lasts[start]
            if last is None:
                continue
            weight, node = weights[start], trie
            for end in range(start, size):
                node = node[0].get(text[end])
                if node is None:
                    break
                piece = node[1]
                if piece is None or merges and not pairs[last, piece]:
                    continue
                total = weight - scores[piece]
                if lasts[end + 1] is None or total < weights[end + 1]:
                    weights[end + 1], lasts[end + 1] = total, piece
            char = text[start]
            if char not in scores:
                total = weight + BYTE_WEIGHT * len(char.encode("utf-8", "replace"))
                if lasts[start + 1] is None or total < weights[start + 1]:
                    weights[start + 1], lasts[start + 1] = total, char
        at, out = size, []
        while at > 0:
            out.append(lasts[at])
            at -= len(lasts[at])
        return out[::-1]

    def longest_path(self, text: str) -> list[str] | None:
        """``path`` of a merge model through text whose characters all are pieces; None if there is none.

        Of the pieces that may follow the longest is taken, and a shorter one where
        no way leads on from its end. What is found is what ``path`` finds, as only
        one sequence has neighbours that all may stand together; far fewer pairs
        are looked at.
        """
        size, trie, pairs = len(text), self.trie, self.pairs
        out, open_, dead = [], [], set()
        at, last = 0, ""
        while at < size:
            node, fit = trie, []
            for char in text[at : at + self.longest]:
                node = node[0].get(char)
                if node is None:
                    break
                if node[1] is not None:
                    fit.append(node[1])
            piece = fit.pop()  # its first character is one, at least
            while not pairs[last, piece] or dead and at + len(piece) in dead:
                while not fit:
                    if not out:
                        return None
                    dead.add(at)
                    at, fit = at - len(out.pop()), open_.pop()
                    last = out[-1] if out else ""
                piece = fit.pop()
            out.append(piece)
            open_.append(fit)
            at, last = at + len(piece), piece
        return out

    def _part(self, text: str) -> bytes:
        found = None
        if self.merges and self.singles.issuperset(text):
            found = self.longest_path(text)
        if found is None:
            found = self.path(text)
        codes = self.codes
        return b"".join([codes[p] if p in codes else self._spelled(p) for p in found])

    def _spelled(self, char: str) -> bytes:
        return b"".join([self.bytes[b].to_bytes(4, "little") for b in char.encode("utf-8", "replace")])

    def _cut(self, text: str) -> bytes:
        """Ids of normalised text, part by part between the borders that nothing crosses."""
        start, out = 0, []
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in self.inside:
                out.append(self.parts[text[start:i]])
                start = i
        if not start:  # kept as a word, or not at all
            return self._part(text)
        out.append(self.parts[text[start:]])
        return b"".join(out)

    def _word(self, word: bytes) -> bytes:
        return self._cut(word.decode("utf-8", "replace").replace(" ", BLANK))

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.prefix or text[0] == 0x20 or b"  " in text or BLANK.encode() in text:
            return self._cut(self.prefix + text.decode("utf-8", "replace").replace(" ", BLANK))
        # No piece has a blank sign behind another character.
        return b"".join(map(self.words.__getitem__, self.split(b" " + text)))

    def decode(self, ids: np.ndarray) -> bytes:
        text = b"".join(map(self.text.__getitem__, ids.tolist()))
        return text[1:] if self.prefix and text[:1] == b" " else text


def encode(docs: DataFrame, model: str, keep: dict[str, str] | None = None) -> DataFrame:
    """The columns of ``docs`` but for ``text``, with n_ids and ids (array of int).

    Null and empty text have no ids. Rows of any columns pass; repeated ones are
    encoded alike. Columns of the new names in ``docs`` are replaced; ``keep`` gives
    such a column, whose values are wanted, another name first.
    """
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

    docs = docs.withColumnsRenamed(keep or {}).drop("n_ids", "ids")
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = StructType(list(rest)).add("n_ids", LongType()).add("ids", ArrayType(IntegerType()))

    def each(batch):
        coder = Transducer.of(model)
        ids = [np.frombuffer(coder.encode(t), "<u4").astype(np.int32) for t in utf8(batch.column("text"))]
        kept = {f.name: batch.column(f.name) for f in rest}
        return kept | {"n_ids": [len(x) for x in ids], "ids": ids}

    return map_batches(docs.withColumn("text", F.col("text").cast("string")), schema, each)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """The columns of ``rows`` but for ``ids``, with ``text``; ids null or empty give an empty text."""
    from pyspark.sql.types import StringType, StructType

    rest = [f for f in rows.schema.fields if f.name not in ("ids", "text")]
    schema = StructType(list(rest)).add("text", StringType())

    def each(batch):
        coder = Transducer.of(model)
        column = batch.column("ids")
        texts = [coder.decode(np.asarray(x or [], np.int64)).decode("utf-8", "replace") for x in column.to_pylist()]
        return {f.name: batch.column(f.name) for f in rest} | {"text": texts}

    return map_batches(rows, schema, each)


def encoded_digest(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_ids, n_bytes (ids that spell a byte), ids_crc32, decoded_sha256, exact (decoded text equals the text).

    Null text is empty and has no ids; repeated rows get equal results, an empty
    table none; other columns are ignored.
    """
    import hashlib
    import zlib

    def each(batch):
        coder = Transducer.of(model)
        spelled = np.zeros(len(coder.text), bool)
        spelled[list(coder.bytes.values())] = True
        out = {k: [] for k in ("n_ids", "n_bytes", "ids_crc32", "decoded_sha256", "exact")}
        for text in utf8(batch.column("text")):
            raw = coder.encode(text)
            ids = np.frombuffer(raw, "<u4")
            back = coder.decode(ids)
            out["n_ids"].append(len(ids))
            out["n_bytes"].append(int(spelled[ids].sum()))
            out["ids_crc32"].append(zlib.crc32(raw))
            out["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
            out["exact"].append(back == text)
        return {"doc_id": batch.column("doc_id")} | out

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = "doc_id bigint, n_ids bigint, n_bytes bigint, ids_crc32 bigint, decoded_sha256 string, exact boolean"
    return map_batches(narrow, made, each)
