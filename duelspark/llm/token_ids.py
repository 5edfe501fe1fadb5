"""Token ids of documents in a compressed binary format.

A store is a folder of two Parquet tables. ``dictionary`` has one row: the
zstandard dictionary and its hash. ``blocks`` has one row per block of
consecutive documents: ``payload`` is the concatenation of one zstandard frame
per document, each compressed alone with the shared dictionary, and ``offsets``
says where each frame starts, so that one short document is read by slicing the
payload of one block. Parquet is the container because Spark commits its files
as a whole: a lost executor leaves no half-written block.

Documents stand in ascending doc_id order: ``part`` and ``block`` number the
blocks in that order.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelspark.llm.arrow import Memo, arrow_schema, kept_in_worker, map_batches, rows_of, slices, utf8

BLOCKS = (
    "part int, block int, first_doc bigint, last_doc bigint, docs array<bigint>, n_tokens array<bigint>, "
    "offsets array<bigint>, width int, dictionary string, payload binary"
)

#: A block is closed at so many documents or bytes.
BLOCK_DOCS, BLOCK_BYTES = 256, 1 << 20

#: The dictionary is trained on at most so many documents, on a window of so many ids of each; it changes sizes, never ids.
TRAIN_DOCS, TRAIN_IDS, DICTIONARY_BYTES = 1000, 4096, 1 << 16

#: Distinct pieces whose ids a Python worker keeps, and the memory they may take: asking the library costs 100 times a look at the memo.
KEPT_PIECES, PIECES_BYTES = 1_000_000, 192 << 20

#: The letter by which the vocabulary names each byte: itself where it is printable, else one beyond Latin-1.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LETTERS = dict(zip((b for b in range(256) if b not in _PRINTABLE), range(0x100, 0x200)))


class Encoder:
    """Ids of whole texts by the tokenizers library, asked once per distinct piece.

    The vocabulary splits texts at white space and between letters, digits and
    other signs before any merge, so a text's ids are those of its pieces in
    order. Where that split is not plain in the bytes (letters beyond Latin-1,
    combining marks, special tokens), the library gets everything between two
    white spaces as it stands.
    """

    #: The split of the vocabulary file, for lower-case Latin-1 letters in UTF-8.
    PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\xff]+|[0-9]|[^\x09-\x0d\x20a-z0-9\x80-\xff]+")
    PLAIN = bytes(range(0xC0)) + b"\xc3"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.pieces = Memo(self._ids, KEPT_PIECES, PIECES_BYTES)

    def _ids(self, piece: bytes) -> bytes:
        """Ids of one piece. Plain ones go straight to the library's merges: splitting and normalizing them again costs as much."""
        if self.plain(piece):
            lower = piece if piece.isascii() else piece.decode().lower().encode()
            found = self.model.tokenize(lower.decode("latin-1").translate(BYTE_LETTERS))
            ids = [token.id for token in found]
        else:
            ids = self.tokenizer.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One per worker process, which Spark uses for many tasks."""
        return kept_in_worker((cls.__name__, path), lambda: cls(path))

    def plain(self, text: bytes) -> bool:
        if any(token in text for token in self.special):
            return False
        return text.isascii() or not (
            text.translate(None, self.PLAIN) or b"\xc3\x97" in text or b"\xc3\xb7" in text
        )

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.plain(text):
            return b"".join(map(self.pieces.__getitem__, self.PIECES.findall(text.lower())))
        out = []
        for chunk in text.split():
            if self.plain(chunk):
                out.extend(map(self.pieces.__getitem__, self.PIECES.findall(chunk.lower())))
            else:
                out.append(self.pieces[chunk])
        return b"".join(out)


def train(docs: DataFrame, tokenizer: str, sample: int = TRAIN_DOCS) -> bytes:
    """A dictionary from serialized ids of at most ``sample`` documents, those whose ids hash lowest.

    Of a long document a window of its ids counts, which starts where its hash says.
    Empty where there is too little text to train on; frames then stand alone.
    """
    rows = docs.count()
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    chosen = (
        docs.select("text", hashed.alias("_h"))
        .filter((F.col("_h") < F.lit(int((1 << 32) * min(1.0, 2 * sample / max(1, rows))))) & F.col("text").isNotNull())
        .orderBy("_h")
        .limit(sample)
        .select("text", "_h")
    )

    def serialized(batch):
        coder = Encoder.of(tokenizer)
        kind, out = f"<u{coder.width}", []
        for text, at in zip(utf8(batch.column("text")), batch.column("_h").to_pylist()):
            ids = np.frombuffer(coder.encode(text), "<u4")
            start = at % max(1, len(ids) - TRAIN_IDS + 1)
            out.append(ids[start : start + TRAIN_IDS].astype(kind).tobytes())
        return {"ids": out}

    samples = [row.ids for row in map_batches(chosen, "ids binary", serialized).collect() if row.ids]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if len(samples) < 8 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _settings(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encodes ``docs`` (doc_id, text) whole, with ``end_id`` behind each document.

    Null text is empty; such a document has the end id alone. A null doc_id comes
    first; rows of one doc_id stand side by side, ordered by text. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train(docs, tokenizer)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.range(1).select(
        F.lit(name).alias("dictionary"), F.lit(bytearray(dictionary)).alias("content")
    ).coalesce(1).write.parquet(f"{path}/dictionary")

    schema = arrow_schema(BLOCKS)

    def pack(batches):
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        coder = Encoder.of(tokenizer)
        compressor = zstandard.ZstdCompressor(level=3, **_settings(dictionary))
        width = 4 if end_id >> 16 else coder.width
        docs, tokens, frames, kind = [], [], [], f"<u{width}"
        end = np.asarray([end_id], "<u4").tobytes()

        def close():
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
            row = [part, block, docs[0], docs[-1], docs, tokens, offsets.tolist(), width, name, b"".join(frames)]
            return rows_of([[x] for x in row], schema)

        size = 0
        for batch in slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                ids = np.frombuffer(coder.encode(text) + end, "<u4").astype(kind)
                frames.append(compressor.compress(ids.tobytes()))
                docs.append(doc)
                tokens.append(len(ids))
                size += len(frames[-1])
                if len(docs) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield close()
                    docs, tokens, frames, size, block = [], [], [], 0, block + 1
        if docs:
            yield close()

    # Rows of one doc_id are ranged by the start of their texts, so that they fill more than one task.
    ordered = docs.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(pack, BLOCKS).write.parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> dict[str, bytes]:
    return {row.dictionary: bytes(row.content) for row in spark.read.parquet(f"{path}/dictionary").collect()}


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``: ids in all blocks before."""
    stored = spark.read.parquet(f"{path}/blocks")
    counts = stored.select(
        F.col("part").alias("_part"), F.col("block").alias("_block"),
        F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("_n"),
    )
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # One row per written part.
    parts = counts.groupBy(F.col("_part").alias("_at")).agg(F.sum("_n").alias("_all")).select(
        "_at", F.coalesce(F.sum("_all").over(before(Window.orderBy("_at"))), F.lit(0)).alias("_parts")
    )
    starts = counts.withColumn(
        "_inside", F.coalesce(F.sum("_n").over(before(Window.partitionBy("_part").orderBy("_block"))), F.lit(0))
    ).join(parts, F.col("_part") == F.col("_at"))
    return (
        stored.join(starts, (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block")))
        .withColumn("start", F.col("_inside") + F.col("_parts"))
        .drop("_part", "_block", "_n", "_at", "_parts", "_inside")
    )


def read(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit integers) of each stored document.

    ``only``: these documents; blocks that hold none of them are skipped, and no
    other frame is decompressed.
    """
    dictionaries = _dictionary(spark, path)
    found = blocks(spark, path)
    if only is not None:
        wanted = [F.col("first_doc").isNull() | ((F.col("first_doc") <= x) & (F.col("last_doc") >= x)) for x in only]
        hit = F.lit(False)
        for one in wanted:
            hit = hit | one
        found = found.filter(hit)
    keep = None if only is None else set(only)

    made = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    schema = arrow_schema(made)

    def unpack(batches):
        open_ = {k: zstandard.ZstdDecompressor(**_settings(v)) for k, v in dictionaries.items()}
        for batch in slices(batches):
            for row in batch.to_pylist():
                starts = row["start"] + np.concatenate([[0], np.cumsum(row["n_tokens"])])
                out = []
                for n, doc in enumerate(row["docs"]):
                    if keep is not None and doc not in keep:
                        continue
                    frame = row["payload"][row["offsets"][n] : row["offsets"][n + 1]]
                    raw = np.frombuffer(open_[row["dictionary"]].decompress(frame), f"<u{row['width']}")
                    out.append((doc, int(starts[n]), len(raw), raw.astype("<u4").tobytes()))
                yield rows_of(list(zip(*out)) or [[]] * 4, schema)

    columns = ["docs", "n_tokens", "offsets", "width", "dictionary", "payload", "start"]
    return found.select(*columns).mapInArrow(unpack, made)
