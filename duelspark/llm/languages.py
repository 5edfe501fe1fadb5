"""Language identification of mixed-language texts.

A model holds, for every learned language, how often its words contain which
character trigrams and with which scripts they are written. A word is scored
for the languages that its script leaves; a Viterbi pass with a penalty for
each switch then labels the words of a text, so that a few doubtful words
don't break a span. The language of a text is the one with most letters.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelspark.llm.arrow import KEY_BYTES, Memo, arrow_schema, kept_in_worker, map_batches, rows_of, slices, utf8

#: First and last code points of scripts; all other letters are one more.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF), ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
NAMES = sorted({name for name, _, _ in SCRIPTS} | {"other"})

_LATIN = NAMES.index("latin")

#: Trigrams are counted in so many buckets by their hash: the size of a model is languages times buckets.
BUCKETS = 1 << 15

#: Words of one batch or worker whose scores are kept.
KEPT_WORDS = 200_000

#: Longer stretches of letters are cut.
WORD_LETTERS = 32

#: What a change of language between two words costs, in units of a word's score.
PENALTY = 8.0

#: Fewer letters of a script than this share of a language's letters don't make it a candidate for that script.
SCRIPT_SHARE = 0.001

_SPACED = bytes(
    c if 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def _script(letter: str) -> int:
    point = ord(letter)
    for name, first, last in SCRIPTS:
        if first <= point <= last:
            return NAMES.index(name)
    return NAMES.index("other")


#: The script of a letter, and the bucket of a trigram.
script = Memo(_script, KEPT_WORDS)
bucket = Memo(lambda gram: zlib.crc32(gram.encode()) % BUCKETS, KEPT_WORDS)


def stretches(rough: bytes) -> list[bytes]:
    """The words of a stretch: letters of one script, at most WORD_LETTERS of them."""
    if rough.isascii():
        return [rough[at : at + WORD_LETTERS] for at in range(0, len(rough), WORD_LETTERS)]
    out, word, kind = [], [], None
    for c in rough.decode("utf-8", "replace").lower():
        now = script[c] if c.isalpha() else None
        if word and (now != kind or len(word) == WORD_LETTERS):
            out.append("".join(word).encode())
            word = []
        kind = now
        if now is not None:
            word.append(c)
    if word:
        out.append("".join(word).encode())
    return out


def rough_words(text: bytes) -> list[bytes]:
    """Lower-cased stretches of letters, of at most KEY_BYTES; beyond ASCII, signs and several scripts stay in them until ``stretches``."""
    words = text.translate(_SPACED).split()
    if words and max(map(len, words)) > KEY_BYTES:
        words = [w for word in words for w in (stretches(word) if len(word) > KEY_BYTES else (word,))]
    return words


def is_word(rough: bytes) -> bool:
    """Whether a rough word is one word as it stands."""
    return len(rough) <= WORD_LETTERS if rough.isascii() else stretches(rough) == [rough]


def words_of(text: bytes) -> list[bytes]:
    """The words of a text: stretches of letters of one script."""
    return [w for rough in rough_words(text) for w in ((rough,) if is_word(rough) else stretches(rough))]


def script_of(word: str) -> int:
    return _LATIN if word.isascii() else script[word[0]]


def features(word: str) -> list[int]:
    """Buckets of the trigrams of a word and its edges, and of the word itself."""
    coded = f"^{word}$"
    return [bucket[coded[i : i + 3]] for i in range(len(coded) - 2)] + [zlib.crc32(coded.encode()) % BUCKETS]


def learn(docs: DataFrame) -> dict:
    """A model from all rows of ``docs`` (text, lang) with text and lang.

    Every word of every text counts. Only sums per language and bucket reach the
    driver. A language's name is its lang value as it stands.
    """
    schema = arrow_schema("lang string, kind int, bucket int, n bigint")

    def count(batches):
        words: dict[str, Counter] = {}
        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
                words.setdefault(lang, Counter()).update(rough_words(text))
            if sum(map(len, words.values())) > KEPT_WORDS:
                yield from counted(words)
                words = {}
        yield from counted(words)

    def counted(words):
        for lang, seen in words.items():
            grams, lengths, scripts = [], [], np.zeros(len(NAMES), np.int64)
            counts = []
            for rough, n in seen.items():
                for word in (rough,) if is_word(rough) else stretches(rough):
                    plain = word.decode()
                    found = features(plain)
                    grams += found
                    lengths.append(len(found))
                    counts.append(n)
                    scripts[script_of(plain)] += n * len(plain)
            times = np.repeat(np.array(counts, np.int64), lengths)
            grams = np.bincount(np.array(grams, np.int64), weights=times, minlength=BUCKETS).astype(np.int64)
            for kind, found in ((0, grams), (1, scripts)):
                at = np.flatnonzero(found)
                yield rows_of([[lang] * len(at), [kind] * len(at), at.tolist(), found[at].tolist()], schema)

    known = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).dropna()
    sums = known.mapInArrow(count, "lang string, kind int, bucket int, n bigint").groupBy("lang", "kind", "bucket").agg(
        F.sum("n").alias("n")
    )
    rows = sums.groupBy("lang", "kind").agg(
        F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("counts")
    ).collect()
    names = sorted({row.lang for row in rows})
    grams, scripts = np.zeros((BUCKETS, len(names))), np.zeros((len(NAMES), len(names)))
    for row in rows:
        (grams if row.kind == 0 else scripts)[row.buckets, names.index(row.lang)] = row.counts
    # Add-half smoothing over the buckets that any language fills.
    filled = max(1, int((grams.sum(axis=1) > 0).sum()))
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * filled))
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    return {"names": names, "logs": logs.astype(np.float32), "written": share >= SCRIPT_SHARE}


class Labeller:
    """Scores words by a model and labels the words of a batch of texts."""

    @classmethod
    def of(cls, model: dict, penalty: float) -> Labeller:
        """The worker process's labeller of this model, which Spark uses for many tasks; another model replaces it."""
        name = hashlib.blake2b(repr((model["names"], penalty)).encode() + model["logs"].tobytes()).digest()
        return kept_in_worker((cls.__name__, name), lambda: cls(model, penalty))

    #: What a word of a script that a language isn't written in costs it.
    FOREIGN = -30.0

    def __init__(self, model: dict, penalty: float):
        self.names, self.logs, self.penalty = model["names"], model["logs"], penalty
        # A script that no language is written in narrows nothing.
        self.written = model["written"].any(axis=1)
        self.candidates = model["written"] | ~model["written"].any(axis=1, keepdims=True)
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.parts: dict[bytes, list[bytes]] = {}
        self.scores: list[np.ndarray] = [np.zeros((0, len(self.names)), np.float32)]
        self.sizes: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.known: list[np.ndarray] = [np.zeros(0, np.int64)]

    def add(self, words: list[bytes]) -> None:
        """Scores words that are new: the sum of their features' logarithms over the root of their number, best is 0."""
        plain = [word.decode() for word in words]
        grams, lengths = [], []
        for word in plain:
            found = features(word)
            grams += found
            lengths.append(len(found))
        self.rows.update(zip(words, range(len(self.rows), len(self.rows) + len(words))))
        sizes, kinds = np.array([len(word) for word in plain], np.int64), [script_of(word) for word in plain]
        self.sizes.append(sizes)
        self.known.append(np.where(self.written[kinds], sizes, 0) if words else sizes)
        if words:
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            got = np.add.reduceat(self.logs[np.array(grams)], starts, axis=0) / np.sqrt(lengths)[:, None].astype(np.float32)
            allowed = self.candidates[kinds]
            got = np.where(allowed, got, got + np.float32(self.FOREIGN))
            self.scores.append((got - got.max(axis=1, keepdims=True, initial=-np.inf)).astype(np.float32))

    def split(self, texts: list[bytes]) -> list[list[bytes]]:
        """The words of each text. Rough words that are none are remembered with their words."""
        rough = [rough_words(text) for text in texts]
        new = set().union(*rough).difference(self.rows, self.parts)
        self.parts.update((word, stretches(word)) for word in new if not is_word(word))
        out = []
        for words in rough:
            if not self.parts.keys().isdisjoint(words):
                words = [w for word in words for w in self.parts.get(word, (word,))]
            out.append(words)
        return out

    def label(self, texts: list[bytes]) -> list[tuple[list[bytes], np.ndarray, np.ndarray, int]]:
        """Per text: its words, the language number of each, the letters of each, and all letters of scripts that some language has."""
        if len(self.rows) + len(self.parts) > KEPT_WORDS:
            self.clear()
        split = self.split(texts)
        self.add(list(set().union(*split).difference(self.rows)))
        scores, sizes, known = (np.concatenate(x) for x in (self.scores, self.sizes, self.known))
        self.scores, self.sizes, self.known = [scores], [sizes], [known]
        ids = [np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words)) for words in split]
        paths = viterbi([scores[i] for i in ids], self.penalty) if self.names else [np.zeros(len(i), np.int64) for i in ids]
        return [(w, path, sizes[i], int(known[i].sum())) for w, path, i in zip(split, paths, ids)]


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best label of each row of each matrix (words x labels), where every change of label costs ``penalty``.

    All texts take their n-th word in one step. Equal sums keep the label, and
    the smaller label at the end.
    """
    order = sorted(range(len(scores)), key=lambda k: -len(scores[k]))
    lengths = np.array([len(scores[k]) for k in order], np.int64)
    longest = int(lengths.max(initial=0))
    if not longest:
        return [np.zeros(0, np.int64) for _ in scores]
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than n
    starts = np.concatenate([[0], np.cumsum(active)])
    n_labels = scores[order[0]].shape[1]
    by_step = np.empty((int(starts[-1]), n_labels), np.float32)
    for rank, k in enumerate(order):
        by_step[starts[: lengths[rank]] + rank] = scores[k]
    came = np.empty((int(starts[-1]), n_labels), np.int16)
    best = by_step[: active[0]].copy()
    keep = np.arange(n_labels, dtype=np.int16)
    ends = np.zeros(len(order), np.int64)
    done = len(order)
    for n in range(1, longest + 1):
        now = int(active[n]) if n < longest else 0
        for rank in range(now, min(done, len(best))):
            ends[rank] = int(best[rank].argmax())
        done = now
        if not now:
            break
        best = best[:now]
        top = best.argmax(axis=1)
        jump = best[np.arange(now), top][:, None] - penalty
        switch = jump > best
        came[starts[n] : starts[n] + now] = np.where(switch, top[:, None].astype(np.int16), keep)
        best = np.where(switch, jump, best) + by_step[starts[n] : starts[n] + now]
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(order)
    labels = np.zeros(int(starts[-1]), np.int64)
    current = ends
    for n in range(longest - 1, -1, -1):
        now = int(active[n])
        labels[starts[n] : starts[n] + now] = current[:now]
        if n:
            current[:now] = came[starts[n] + np.arange(now), current[:now]]
    for rank, k in enumerate(order):
        out[k] = labels[starts[: lengths[rank]] + rank]
    return out


UNKNOWN = "und"
SPANS = "array<struct<lang:string,first:bigint,words:bigint,letters:bigint>>"


def _verdicts(labeller: Labeller, texts: list[bytes]) -> dict[str, list]:
    names, out = labeller.names, {"lang_pred": [], "score": [], "lang_spans": [], "known": []}
    for words, path, sizes, known in labeller.label(texts):
        total, spans, lang, score = int(sizes.sum()), [], UNKNOWN, 0.0
        out["known"].append(known / total if total else 0.0)
        if total and names:
            share = np.bincount(path, weights=sizes, minlength=len(names))
            lang, score = names[int(share.argmax())], float(share.max() / total)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
            sums = np.add.reduceat(sizes, edges[:-1])
            spans = [
                {"lang": names[path[a]], "first": int(a), "words": int(b - a), "letters": int(n)}
                for a, b, n in zip(edges, edges[1:], sums)
            ]
        out["lang_pred"].append(lang)
        out["score"].append(score)
        out["lang_spans"].append(spans)
    return out


def identify(docs: DataFrame, model: dict, penalty: float = PENALTY) -> DataFrame:
    """doc_id, lang_pred, score, lang_spans of every row of ``docs`` (doc_id, text, ...).

    A word is a stretch of letters of one script, of at most WORD_LETTERS.
    ``lang_spans``: runs of words of one language, with its first word (from 0),
    words and letters. ``lang_pred`` is the language with most letters (ties: the
    first by name), ``score`` its share of all letters. A text that is null or has
    no letter is ``und`` with score 0 and no span; so is every text if nothing
    was learned. Equal texts get equal results; only the text is looked at.
    """
    ready: list[Labeller] = []

    def each(batch):
        if not ready:
            ready.append(Labeller.of(model, penalty))
        return {"doc_id": batch.column("doc_id")} | _verdicts(ready[0], utf8(batch.column("text")))

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(narrow, f"doc_id bigint, lang_pred string, score double, lang_spans {SPANS}", each)


def identified(docs: DataFrame, model: dict, penalty: float = PENALTY, known: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language can be told; a null ``lang`` is filled with it, all else stays as it is.

    Rejected are texts that are null or without a letter, and those with less than
    ``known`` of their letters in scripts that some learned language is written in:
    whatever the model says of the others is no language it has seen.
    """
    import pyarrow as pa

    ready: list[Labeller] = []
    lang, text = docs.columns.index("lang"), docs.columns.index("text")

    def run(batches):
        for batch in slices(batches):
            if not ready:
                ready.append(Labeller.of(model, penalty))
            found = _verdicts(ready[0], utf8(batch.column(text)))
            told = [x if x is not None else y for x, y in zip(batch.column(lang).to_pylist(), found["lang_pred"])]
            good = [p != UNKNOWN and k >= known for p, k in zip(found["lang_pred"], found["known"])]
            field = batch.schema.field(lang)
            yield batch.set_column(lang, field, pa.array(told, field.type)).filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out() -> Column:
    """Rows whose language is never learned; a row without doc_id is not one of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
