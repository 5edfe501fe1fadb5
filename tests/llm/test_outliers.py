"""Quality rules against plain counts and a plain estimate in one process."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelspark.llm import outliers
from duelspark.llm.queries import QUERIES

from .test_texts import DOCS, ODD_TEXTS

WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    words = re.findall(WORD, text or "")
    lines = [line for line in (text or "").split("\n") if re.search(WORD, line)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": sum(line in lines[:n] for n, line in enumerate(lines)), "n_repeat_words": len(inside),
        "n_lines": len(lines), "n_same_words": sum(a == b for a, b in zip(words, words[1:])),
        "n_signs": len(re.findall(r"[!-/:-@\[-`{-~]", re.sub(r"[#*$%&|<>]", "", text or ""))),
        "n_capitals": len(re.findall("[A-Z]", text or "")), "n_digits": len(re.findall("[0-9]", text or "")),
    }


def plain_quartiles(values):
    values = sorted(values)
    return [values[max(0, -(-k * len(values) // 4) - 1)] for k in (1, 2, 3)]


def plain_steps(fits, step):
    """Both starts of all groups go on until none of them falls."""
    det = lambda f: np.linalg.slogdet(f[1])[1]
    for n in range(outliers.STEPS):
        after = [[step(x, f) for f in starts] for x, starts in fits]
        still = n and all(det(a) >= det(b) - outliers.STILL for (_, was), now in zip(fits, after) for a, b in zip(now, was))
        fits = [(x, now) for (x, _), now in zip(fits, after)]
        if still:
            break
    return [min(starts, key=det) for _, starts in fits]


def plain_distances(rows, part=outliers.PART):
    """rows (counts, lang, source) -> distance or None, by the rules of the docstrings."""
    ok = [n for n, (c, _, _) in enumerate(rows) if c["n_words"] >= 20 and 100 * c["n_repeat_words"] <= 30 * c["n_words"]]
    groups = defaultdict(list)
    for n in ok:
        groups[rows[n][1], rows[n][2]].append(n)
    pooled = defaultdict(list)
    for key in [k for k, members in groups.items() if len(members) < outliers.ENOUGH]:
        pooled[key[0]] += groups.pop(key)
    groups |= {(lang, "*", 0): members for lang, members in pooled.items() if len(members) >= outliers.ENOUGH}
    floor = np.diag([(256 * s[-1]) ** 2 for s in outliers.SHARES])
    fit = lambda near: (near.mean(axis=0), np.cov(near.T, bias=True) + floor)
    squared = lambda x, f: np.einsum("ij,jk,ik->i", x - f[0], np.linalg.inv(f[1]), x - f[0])
    bins = lambda x, f: np.minimum(np.floor(np.log1p(squared(x, f)) * outliers.FINE), outliers.LAST)
    nth = lambda b, share: np.sort(b)[math.ceil(len(b) * share) - 1]
    wide = lambda x, f: max(1.0, math.expm1((nth(bins(x, f), 0.5) + 0.5) / outliers.FINE) / outliers.far(0.5))
    out, fits = [None] * len(rows), []
    for members in groups.values():
        x = np.zeros((len(members), outliers.D))
        for i, (count, of, weight, _, _) in enumerate(outliers.SHARES):
            c = [rows[n][0][count] for n in members]
            b = [rows[n][0][of] for n in members]
            middle = plain_quartiles([math.floor(p * 1000 / q) if q else 0 for p, q in zip(c, b)])[1] / 1000
            transform = math.log if count == "word_chars" else math.sqrt
            x[:, i] = [math.floor(256 * transform((p + weight * middle) / (q + weight)) + 0.5) for p, q in zip(c, b)]
        q = np.array([plain_quartiles(x[:, i]) for i in range(outliers.D)])
        fits.append((x, [(q[:, 1], np.diag(((q[:, 2] - q[:, 0]) / 1.3489795003921634) ** 2) + floor), fit(x)]))
    best = plain_steps(fits, lambda x, f: fit(x[bins(x, f) <= nth(bins(x, f), part)]))
    for members, (x, _), f in zip(groups.values(), fits, best):
        last = fit(x[squared(x, f) <= wide(x, f) * outliers.far(0.025)])
        for n, d in zip(members, np.sqrt(squared(x, last) / wide(x, last))):
            out[n] = d
    return out


def corpus(seed=1, n=700):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    rows = []
    for k in range(n):
        text = ". ".join(" ".join(rng.choice(words) for _ in range(rng.randrange(5, 15))).capitalize() for _ in range(rng.randrange(2, 25)))
        kind = rng.random()
        if kind < 0.04:
            text = text.upper().replace(" ", "!! ")
        elif kind < 0.08:
            text = text.replace(" ", "*** ")
        elif kind < 0.1:
            text = "\n".join([text] * 3)
        rows.append((text, "xy"[k % 4 == 0], f"s{k % 5 if k % 3 else 0}" if k % 11 else None))
    return rows


def test_counts_against_plain_ones(spark):
    rng = random.Random(2)
    texts = ODD_TEXTS + ["", None, "a b c d e f g h " * 3, "x\ny\nx \nx\n\n\n y"] + [t for t, _, _ in corpus(5, 60)]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = spark.createDataFrame([(n, t, None, "s", 0) for n, t in enumerate(texts)], DOCS).withColumn("n_words", F.lit("clash"))
    got = {r.doc_id: r.asDict() for r in outliers.counted(rows).collect()}
    for n, text in enumerate(texts):
        assert {c: got[n][c] for c in outliers.COUNTS} == plain_counts(text), text


@pytest.mark.parametrize("enough", [100, 30])
def test_distances_against_a_plain_estimate(spark, monkeypatch, enough):
    monkeypatch.setattr(outliers, "ENOUGH", enough)
    rows = corpus()
    df = spark.createDataFrame([(n, t, lang, s, 0) for n, (t, lang, s) in enumerate(rows)], DOCS)
    df = df.withColumn("row", F.lit(1)).withColumn("from", F.lit("clash")).withColumn("x0", F.lit(2))
    got = {r.doc_id: r for r in outliers.quality(df).collect()}
    want = plain_distances([(plain_counts(t), lang, s) for t, lang, s in rows])
    limit, seen = math.sqrt(outliers.far(outliers.BEYOND)), Counter()
    for n, (text, _, _) in enumerate(rows):
        r, d = got[n], want[n]
        assert (r.distance is None) == (d is None) and (d is None or r.distance == pytest.approx(d, rel=1e-6))
        assert r.kept == (not r.base_failed and (d is None or d <= limit))
        junk = "!! " in text or "*** " in text
        if d is not None:
            seen[junk, r.kept] += 1
    assert seen[True, True] == 0 and seen[False, False] == 0 and seen[True, False] > 20


def test_junk_is_found_and_the_rest_kept(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op11_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    n = Counter((r.quality, r.kept) for r in found.filter("not base_failed").collect())
    assert n[1, True] >= 0.99 * (n[1, True] + n[1, False]) and n[0, False] >= 0.8 * (n[0, True] + n[0, False])


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "word " * 50_000), (2, "a b"), (2, "a b"), (3, " ".join(f"w{n}" for n in range(40)))]
    df = spark.createDataFrame([(n, t, None, None, 0) for n, t in rows], DOCS)
    got = sorted(((r.doc_id or 0, r.n_words, r.n_repeat_words, r.base_failed, r.kept, r.distance) for r in outliers.quality(df).collect()))
    assert got == [
        (0, 50_000, 50_000, True, False, None), (1, 0, 0, True, False, None), (1, 0, 0, True, False, None),
        (2, 2, 0, True, False, None), (2, 2, 0, True, False, None), (3, 40, 0, False, True, None),
    ]
    assert outliers.quality(df.limit(0)).count() == 0
    # A group of equal texts has no spread of its own.
    same = spark.createDataFrame([(n, " ".join(f"w{k}" for k in range(40)), "x", "s", 0) for n in range(150)], DOCS)
    assert {(r.kept, r.distance) for r in outliers.quality(same).collect()} == {(True, 0.0)}


def test_far_is_near_the_table():
    # 0.5, 0.975 and 0.999 points of the chi-square distribution of 7 degrees.
    for p, value in ((0.5, 6.346), (0.025, 16.013), (0.001, 24.322)):
        assert outliers.far(p, 7) == pytest.approx(value, rel=0.01)
