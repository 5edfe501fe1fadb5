"""The queries of this package as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

# Multipliers of the 64-bit xxHash.
P1, P2, P3, P4, P5 = (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
)


def _wide(number: str) -> str:
    return f"({number})::UHUGEINT"


def _mod(expression: str) -> str:
    return f"(({expression}) % {_wide(str(1 << 64))})"


def _turned(h: str, bits: int) -> str:
    return f"({_mod(f'{h} * {_wide(str(1 << bits))}')} + {h} // {_wide(str(1 << (64 - bits)))})"


def hashed(relation: str, key: str, seed: str = "42", name: str = "h") -> str:
    """SELECT of all columns of ``relation`` and the xxHash of one bigint ``key``; a null key leaves the seed."""
    steps = [
        f"CASE WHEN {key} IS NULL THEN NULL ELSE (({key})::HUGEINT + (CASE WHEN {key} < 0 THEN {1 << 64}::HUGEINT ELSE 0 END))::UHUGEINT END AS _v, "
        f"{_wide(seed)} AS _s",
        f"* REPLACE ({_mod(f'_v * {_wide(str(P2))}')} AS _v)",
        f"* REPLACE ({_mod(f'{_turned('_v', 31)} * {_wide(str(P1))}')} AS _v)",
        f"*, xor({_mod(f'_s + {_wide(str(P5 + 8))}')}, _v) AS _h",
        f"* REPLACE ({_mod(f'{_turned('_h', 27)} * {_wide(str(P1))} + {_wide(str(P4))}')} AS _h)",
        f"* REPLACE ({_mod(f'xor(_h, _h // {_wide(str(1 << 33))}) * {_wide(str(P2))}')} AS _h)",
        f"* REPLACE ({_mod(f'xor(_h, _h // {_wide(str(1 << 29))}) * {_wide(str(P3))}')} AS _h)",
        f"* EXCLUDE (_h, _v, _s), coalesce(xor(_h, _h // {_wide(str(1 << 32))}), _s) AS {name}",
    ]
    out = f"SELECT *, {steps[0]} FROM {relation}"
    for step in steps[1:]:
        out = f"SELECT {step} FROM ({out})"
    return out


def hashes(relation: str, keys: list[str], name: str = "h") -> str:
    """As Spark's xxhash64 of several bigints, as unsigned number."""
    out = hashed(relation, keys[0], name=f"{name}0")
    for n, key in enumerate(keys[1:], 1):
        out = hashed(f"({out})", key, f"{name}{n - 1}", f"{name}{n}")
    return f"SELECT * RENAME ({name}{len(keys) - 1} AS {name}) FROM ({out})"


_UNIFORM = f"((h // {_wide('2048')})::DOUBLE + 0.5) / {1 << 53}::DOUBLE"
_SIGNED = f"CASE WHEN h >= {_wide(str(1 << 63))} THEN (h::HUGEINT - {1 << 64}::HUGEINT)::BIGINT ELSE h::BIGINT END"

_BITS = "lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
#: Byte by byte checksum of the text of ``documents``, by the rule of its polynomial.
_CRC = f"""
crc_table AS (SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(0, 8), {_BITS}, i::BIGINT) AS c FROM range(0, 256) r(i))),
crc AS (
    SELECT doc_id, list_reduce(
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295) AS c
    FROM documents, crc_table)"""

OP2 = f"""
WITH {_CRC.strip()},
bids AS ({hashes("(SELECT doc_id, s.shard FROM documents, range(0, 25) s(shard))", ["doc_id", "shard"])}),
won AS (
    SELECT doc_id, arg_max(shard, ({_UNIFORM}, -shard)) FILTER (shard < 24) AS shard,
        arg_max(shard, ({_UNIFORM}, -shard)) AS grown_shard
    FROM bids GROUP BY doc_id),
placed AS (
    SELECT d.doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, xor(c, 4294967295) AS text_crc32, shard, grown_shard
    FROM documents d JOIN won USING (doc_id) JOIN crc USING (doc_id))
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard::INT AS grown_shard
FROM placed
"""

OP3 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
    FROM vectors q JOIN vectors d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_ESCAPED = "regexp_replace({0}, '([<\\[])(\\\\*(?:\\||/?s>|/?INST\\]|</?SYS>>))', '\\1\\\\\\2', 'g')"

OP6 = f"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
    SELECT *, lag(role) OVER w IS DISTINCT FROM role AS fresh, row_number() OVER w AS n,
        length({_ESCAPED.format('role')}) AS role_chars, length({_ESCAPED.format('text')}) AS text_chars
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(text_chars) + sum(CASE WHEN fresh THEN 23 + role_chars ELSE 8 END))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP9 = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w
    FROM documents),
shingles AS (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common >= 80 * (p.n + q.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
    SELECT doc_id, doc_id AS to_id FROM documents
    UNION SELECT r.doc_id, b FROM reached r JOIN edges ON a = r.to_id)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(to_id) AS component_id, d.doc_id = min(to_id) AS kept
FROM documents d JOIN reached r USING (doc_id) LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""

OP10 = f"""
WITH sizes AS (
    SELECT source AS s, coalesce(sum(octet_length(encode(text))), 0)::BIGINT AS size FROM documents GROUP BY source),
rated AS (
    SELECT s, CASE WHEN size = 0 THEN 1.0::DOUBLE
        ELSE 1.0::DOUBLE / count(*) FILTER (size > 0) OVER () * (sum(size) OVER ())::DOUBLE / size::DOUBLE END AS rate
    FROM sizes),
drawn AS ({hashes("(SELECT * FROM documents JOIN rated ON source IS NOT DISTINCT FROM s)", ["doc_id", "1::BIGINT", "1::BIGINT"])}),
sums AS (
    SELECT s, k, sum(p) OVER (PARTITION BY s ORDER BY k) AS upto FROM (
        SELECT s, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM rated, range(0, 500) r(k))),
counted AS (
    SELECT doc_id, any_value(d.source) AS source, any_value(text) AS text, any_value(lang) AS lang, any_value(n_chars) AS n_chars,
        any_value(rate) AS rate, count(*) FILTER (upto <= {_UNIFORM})::INT AS copies
    FROM drawn d JOIN sums ON d.s IS NOT DISTINCT FROM sums.s GROUP BY doc_id),
copied AS (SELECT *, unnest(range(1, copies + 1))::INT AS copy FROM counted WHERE copies > 0),
keyed AS ({hashes("copied", ["doc_id", "1::BIGINT", "0::BIGINT", "copy::BIGINT"])})
SELECT doc_id, text, lang, source, n_chars, rate, copies, copy, {_SIGNED} AS shuffle_key FROM keyed
"""

OP12 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (
    SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 30),
langs AS (
    SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS n
    FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
priced AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.n + 5 * l.v) AS p,
        1 + 1000000000::HUGEINT * (k.n + 5) // (l.n + 5 * l.v) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
apart AS (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM priced x JOIN priced y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
parts AS (
    SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
        LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
    UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM priced WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 50
"""


def _op13(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """All distances from all parts to all entries, as inner products of whole numbers, in every round."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
near{n} AS MATERIALIZED (
    SELECT p.row_no, p.part, arg_min(b.entry, (p.sq - 2 * list_dot_product(p.x, b.x) + b.sq, b.entry)) AS entry,
        min(p.sq - 2 * list_dot_product(p.x, b.x) + b.sq)::BIGINT AS error
    FROM parts p JOIN book{n} b USING (part) GROUP BY ALL)""")
        if n < rounds:
            steps.append(f"""
means{n} AS (
    SELECT part, entry, list((s - (((s % c) + c) % c)) // c ORDER BY i)::DOUBLE[] AS x FROM (
        SELECT part, entry, i, sum(v)::BIGINT AS s, count(*) AS c
        FROM (SELECT part, entry, unnest(p.x)::BIGINT AS v, unnest(range(len(p.x))) AS i FROM near{n} JOIN parts p USING (row_no, part))
        GROUP BY ALL) GROUP BY ALL),
book{n + 1} AS MATERIALIZED (
    SELECT *, list_dot_product(x, x) AS sq FROM (
        SELECT part, entry, coalesce(m.x, b.x) AS x FROM book{n} b LEFT JOIN means{n} m USING (part, entry)))""")
    return f"""
WITH vectors AS (
    SELECT row_number() OVER () AS row_no, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
    SELECT *, list_dot_product(x, x) AS sq FROM (
        SELECT row_no, vec_id, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}]::DOUBLE[] AS x
        FROM vectors, range({parts}) r(part))),
book0 AS MATERIALIZED (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x, sq FROM parts
    QUALIFY entry < {entries}),{",".join(steps)},
coded AS (
    SELECT row_no, string_agg(lower(lpad(hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(error)::BIGINT AS error
    FROM near{rounds} GROUP BY row_no),
book AS (SELECT sha256(string_agg(number::VARCHAR, ',' ORDER BY part, entry, i)) AS sha FROM (
    SELECT part, entry, unnest(x)::BIGINT AS number, unnest(range(len(x))) AS i FROM book{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, sha AS codebooks_sha256
FROM vectors JOIN coded USING (row_no), book
"""


ORACLE = {
    "op2_rendezvous_shards": OP2, "op3_cover_tree_topk": OP3, "op6_chat_format": OP6, "op9_minhash_dedup": OP9,
    "op10_mix_sources": OP10, "op12_source_divergence": OP12, "op13_vector_codes": _op13(),
}
