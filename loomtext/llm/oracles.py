"""DuckDB SQL with the rows of those queries of this package that SQL can express on whole tables."""

from __future__ import annotations

from .licenses import CONTAINED, TEMPLATES, _template_rows
from .media import BLOCK, DECLARED, SAMPLE_RATE
from .sharding import GROUP_DIGITS
from .urlfilter import _LOWER, _SYMBOLS, _UPPER, ACCEPT_LOSS, HELD_OUT, LEAST, ORDER, RULES

_WORD = r"[\p{L}\p{N}\p{M}_]+"

LICENSES = rf"""
WITH t AS (SELECT * FROM (VALUES {", ".join(f"({n}, '{name}', {size}, '{words}')" for n, name, size, words in _template_rows(TEMPLATES))}) AS v(template, license, size, words)),
tw AS (SELECT template, license, size, string_split(words, ' ') AS w FROM t),
ts AS (SELECT DISTINCT template, license, size, array_to_string(w[i+1:i+5], ' ') AS s FROM (SELECT template, license, size, w, unnest(range(len(w) - 4)) AS i FROM tw)),
n AS (SELECT template, count(*) AS total FROM ts GROUP BY 1),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '{_WORD}') AS w FROM documents),
ds AS (SELECT doc_id, i, array_to_string(w[i+1:i+5], ' ') AS s FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
hit AS (SELECT DISTINCT doc_id, template, license, unnest([i // size, i // size - 1]) AS win, ts.s FROM ds JOIN ts USING (s)),
h AS (SELECT doc_id, template, license, win, count(*) / any_value(total) AS c FROM hit JOIN n USING (template) WHERE win >= 0 GROUP BY 1, 2, 3, 4)
SELECT doc_id, license, template, max(c) AS containment, count(*) AS windows FROM h WHERE c >= {CONTAINED} GROUP BY 1, 2, 3"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, text, regexp_extract_all(lower(text), '{_WORD}') AS w FROM documents),
c AS (SELECT doc_id, s, count(*) AS k FROM (SELECT doc_id, array_to_string(w[i+1:i+5], ' ') AS s FROM (SELECT doc_id, w, unnest(range(greatest(1, len(w) - 4))) AS i FROM w WHERE len(w) > 0)) GROUP BY 1, 2),
n AS (SELECT doc_id, sum(k) AS n FROM c GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.k, b.k)) AS m FROM c a JOIN c b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE m >= 0.8 * (x.n + y.n - m)),
same AS (SELECT doc_id AS a, min(doc_id) OVER (PARTITION BY text) AS b FROM documents),
e AS (SELECT a, b FROM near UNION SELECT b, a FROM near UNION SELECT a, b FROM same UNION SELECT b, a FROM same),
g AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.b, g.root FROM g JOIN e ON e.a = g.id WHERE g.root < e.b),
r AS (SELECT id AS doc_id, min(root) AS class_id FROM g GROUP BY 1)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM r"""


def _le(n: str, width: int) -> str:
    """The little-endian bytes of a number, as a blob."""
    return "unhex(" + " || ".join(f"printf('%02x', (({n})::BIGINT >> {8 * b}) & 255)" for b in range(width)) + ")"


# magic bytes that can stand in a text; the SQL counts them, but confirms no format, so it holds for texts without whole media
_MAGICS = ("'GIF87a'", "'GIF89a'", "'RIFF'", "'BM'", "'%PDF-'", "'PK' || chr(3) || chr(4)")

MEDIA = f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS t),
d AS (SELECT doc_id, coalesce(text, '') AS plain, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT doc_id, plain, octet_length(b) AS n, b || repeat('\\x00'::BLOB, (greatest(1, ceil(octet_length(b) / {BLOCK})) * {BLOCK} - octet_length(b))::BIGINT) AS b FROM d),
q AS (SELECT *, octet_length(b) AS size, hex(b) AS h FROM p),
m AS (SELECT *, encode('RIFF') || {_le("size + 36", 4)} || encode('WAVEfmt ') || {_le("16", 4)} || {_le("1", 2)} || {_le("1", 2)} || {_le(str(SAMPLE_RATE), 4)} || {_le(str(SAMPLE_RATE), 4)} || {_le("1", 2)} || {_le("8", 2)} || encode('data') || {_le("size", 4)} || b AS media,
  list_transform(range({BLOCK}), lambda i: ('0x' || substr(h, length(h) - {2 * BLOCK} + 2 * i::INT + 1, 2))::BIGINT) AS tail FROM q)
SELECT doc_id, n AS n_bytes, size AS payload_bytes, sha256(b) AS payload_sha256,
  xor(list_reduce(list_prepend(4294967295::BIGINT, tail), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS tail_crc32,
  octet_length(media) AS media_bytes, sha256(media) AS media_sha256,
  '{DECLARED}>{DECLARED};corrected=0;carved=-;hits=' || {" + ".join(f"(length(plain) - length(replace(plain, {x}, ''))) // length({x})" for x in _MAGICS)} || ';samples=' || size AS feature FROM m, crc"""

_NEXT = "substr(text, i::INT + 2, 1)"
_ESCAPES = f"""len(list_filter(range(length(text)), lambda i: CASE substr(text, i::INT + 1, 1) WHEN '\\' THEN true WHEN '<' THEN {_NEXT} IN ('<', 's', '/') WHEN '[' THEN {_NEXT} IN ('I', '/') WHEN '>' THEN {_NEXT} = '>' ELSE false END))"""

CHAT = f"""
WITH r AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, length(text) + {_ESCAPES} + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 WHEN 'system' THEN 15 ELSE length(role) + 9 END AS n FROM r),
a AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM s)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS formatted_chars, (count(*) FILTER (role = 'assistant'))::BIGINT AS n_examples FROM a GROUP BY conv_id"""

SHARDS = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS t),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS name, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, name, (length(h) // 2 + 1)::BIGINT AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i::INT + 1, 2))::BIGINT)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM d, crc),
j AS (SELECT name, n, ('0x' || substr(md5(name), 1, 16))::UBIGINT::HUGEINT AS k, -1::BIGINT AS shard, 0::BIGINT AS jump FROM (SELECT DISTINCT name FROM c), (VALUES (8), (9)) AS s(n)
  UNION ALL SELECT name, n, k2, jump, floor((jump + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM j WHERE jump < n)),
s AS (SELECT name, max(shard) FILTER (n = 8) AS shard, max(shard) FILTER (n = 9) AS grown_shard FROM j GROUP BY 1)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY substr(md5(name || ':' || text_crc32), 1, {GROUP_DIGITS}), doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard::INT AS grown_shard FROM c JOIN s USING (name)"""


# turns of equal number by the digest that the operator orders them by; prefixes are told apart by a digest of their turns' digests
TRIE = f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS t),
r AS (SELECT conv_id::BIGINT AS c, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k, length(coalesce(text, '')) AS n FROM conversations WHERE conv_id IS NOT NULL),
w AS (SELECT c, list(k ORDER BY turn NULLS FIRST, k) AS k, list(n ORDER BY turn NULLS FIRST, k) AS n, any_value(c)::VARCHAR AS name FROM r GROUP BY c),
h AS (SELECT c, k, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(name)), lambda i: unicode(substr(name, i::INT + 1, 1))::BIGINT)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) % 6 AS h FROM w, crc),
b AS (SELECT h.c, list_concat(coalesce(o.k[1:h.h], []), h.k[h.h + 1:]) AS k, list_concat(coalesce(o.n[1:h.h], []), h.n[h.h + 1:]) AS n FROM h LEFT JOIN w o ON o.c = h.c - ((h.c % 100) + 100) % 100),
p AS MATERIALIZED (SELECT c, d, len(k) = d AS ends, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS n, md5(array_to_string(k[1:d], ',')) AS node, CASE WHEN d > 0 THEN md5(array_to_string(k[1:d - 1], ',')) END AS up FROM (SELECT *, unnest(range(len(k) + 1)) AS d FROM b)),
v AS MATERIALIZED (SELECT node, any_value(up) AS up, any_value(d) AS depth, min(c) AS c, count(*) AS n_convs, any_value(n) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY node),
f AS MATERIALIZED (SELECT v.*, coalesce(x.n_children, 0) AS n_children FROM v LEFT JOIN (SELECT up, count(*) AS n_children FROM v GROUP BY up) x ON x.up = v.node),
s AS (SELECT p.node, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.n)::BIGINT AS saved_tokens FROM f JOIN p ON p.c = f.c AND p.d <= f.depth GROUP BY 1)
SELECT f.c AS conv_id, f.depth, o.c AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256 FROM f JOIN s USING (node) LEFT JOIN v o ON o.node = f.up"""


def _urls() -> str:
    """The URL filter: rules, n-gram counts, Witten-Bell models level by level, scores, threshold, verdicts."""
    ranked = sorted(RULES, key=lambda r: (len(r[1]), r[1]), reverse=True)
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')", v, r) for v, r in ranked for h, _, p in [r.partition("/")]]
    pick = lambda k: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[k]}'" for f in fits) + " END"
    share = lambda side, less: f"CASE WHEN {side}_n > 0 THEN ({side} + {side}_t * {less}) / ({side}_n + {side}_t) ELSE {less} END"
    levels = []
    for n in range(1, ORDER + 2):
        less = (f"{1 / _SYMBOLS!r}::DOUBLE",) * 2 if n == 1 else (f"q.y{n - 1}", f"q.z{n - 1}")
        source = f"kept k JOIN ctx c ON c.context = left(k.gram, {n - 1})" + ("" if n == 1 else f" JOIN l{n - 1} q ON q.gram = substr(k.gram, 2)")
        levels.append(f"""l{n} AS (SELECT k.gram, {share("yes", less[0])} AS y{n}, {share("no", less[1])} AS z{n}, ln(y{n}) - ln({less[0]}) - yes_b - (ln(z{n}) - ln({less[1]}) - no_b) AS gain FROM {source} WHERE k.n = {n})""")
    back = lambda side: f"CASE WHEN {side}_n > 0 THEN ln({side}_t / ({side}_n + {side}_t)) ELSE 0 END AS {side}_b"
    gains = " UNION ALL ".join(f"SELECT gram, gain FROM l{n}" for n in range(1, ORDER + 2))
    return rf"""
WITH a AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
p AS (SELECT *, {pick(2)} AS rule, {pick(1)} AS verdict, ('0x' || substr(md5(url), 1, 8))::BIGINT % {HELD_OUT} = 0 AS held, chr(2) || regexp_replace(translate(url, '{_UPPER}', '{_LOWER}'), '[^\x21-\x7d]', '~', 'g') || chr(3) AS s FROM b),
g AS MATERIALIZED (SELECT page_id, verdict, held, substr(s, i, n) AS gram, n FROM (SELECT *, unnest(range(1, length(s) - n + 2)) AS i FROM (SELECT *, unnest(range(1, {ORDER + 2})) AS n FROM p))),
counted AS (SELECT gram, n, (count(*) FILTER (verdict = 'allow'))::DOUBLE AS yes, (count(*) FILTER (verdict = 'block'))::DOUBLE AS no FROM g WHERE verdict IS NOT NULL AND NOT held GROUP BY 1, 2),
kept AS MATERIALIZED (SELECT * FROM counted WHERE yes + no >= {LEAST}),
ctx AS MATERIALIZED (SELECT *, {back("yes")}, {back("no")} FROM (SELECT left(gram, n::INT - 1) AS context, sum(yes) AS yes_n, (count(*) FILTER (yes > 0))::DOUBLE AS yes_t, sum(no) AS no_n, (count(*) FILTER (no > 0))::DOUBLE AS no_t FROM kept GROUP BY 1)),
{", ".join(levels)},
model AS (SELECT x.gram, gain + coalesce(yes_b - no_b, 0) AS value FROM ({gains}) x LEFT JOIN ctx ON context = x.gram),
summed AS (SELECT page_id, sum(value) AS total FROM g JOIN model USING (gram) GROUP BY 1),
scored AS (SELECT p.*, coalesce(total, 0) / length(s) + (SELECT yes_b - no_b FROM ctx WHERE context = '') AS score FROM p LEFT JOIN summed USING (page_id)),
bins AS (SELECT floor(score * 1000) AS bin, count(*) AS n FROM scored WHERE held AND verdict = 'allow' GROUP BY 1),
cum AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS below, sum(n) OVER () AS total FROM bins),
cut AS (SELECT coalesce((max(bin) FILTER (below <= total * {ACCEPT_LOSS}) + 1) / 1000, least(0, min(bin) / 1000), 0) AS cut FROM cum)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN score >= cut THEN 'allow' ELSE 'block' END) AS verdict, round(score, 6) AS score, cut::DOUBLE AS threshold FROM scored, cut"""


ORACLES = {
    "op1_url_filters": _urls(),
    "op4_sharding": SHARDS,
    "op5_license_scans": LICENSES,
    "op8_minhash_near_dedup": NEAR_DUPLICATES,
    "op9_media_columns": MEDIA,
    "op10_chat_formatting": CHAT,
    "op11_conversation_prefix_trie": TRIE,
}
