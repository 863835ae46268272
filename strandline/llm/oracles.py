"""DuckDB SQL of the queries that SQL can express on whole tables, written apart from the operators."""

from __future__ import annotations

from .common import LOWER, UPPER

#: Equal payloads of 100 bytes or more: the smallest page is the response.
WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS lo FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id > lo THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > lo THEN lo END AS refers_to
FROM q
"""

# Fixed values: the control strings of the chat template and, for each, what stands in a text instead; 32 characters of marks are put around a turn.
_CONTROLS = (
    ("<|im_start|>", "<\\|im_start|>"),
    ("<|im_sep|>", "<\\|im_sep|>"),
    ("<|im_end|>", "<\\|im_end|>"),
    ("<|endoftext|>", "<\\|endoftext|>"),
    ("<s>", "<\\s>"),
    ("</s>", "<\\/s>"),
    ("[INST]", "[\\INST]"),
    ("[/INST]", "[\\/INST]"),
    ("<<SYS>>", "<\\<SYS>>"),
    ("<</SYS>>", "<\\</SYS>>"),
)
_ESCAPED = "replace(coalesce({0}, ''), '\\', '\\\\')"
for _text, _broken in _CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_text}', '{_broken}')"

CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, {_ESCAPED.format("text")} AS te, {_ESCAPED.format("role")} AS re FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', {_ESCAPED.format("'</s>[INST] ok [/INST]'")}, 'user'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', {_ESCAPED.format("'</s>[INST] ok [/INST]'")}, 'assistant')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(te) + length(re) + 32) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_LOW = "translate(coalesce(text, ''), '" + UPPER + "', '" + LOWER + "')"
_BLANK_WORD = r"[^\x20\x09-\x0D]+"

#: Shingles, shared counts of documents with a common shingle, and reachability over links.
COMPONENTS = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_BLANK_WORD}') AS w FROM documents),
st AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 3], ' ') AS g FROM st),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""

#: Word windows of every length that items have, joined as texts.
CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOW}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array({_LOW}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
ia AS (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g FROM ia),
ks AS (SELECT DISTINCT k FROM win),
da AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k),
h AS (SELECT DISTINCT doc_id, p, k, item_id FROM (SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS g FROM da) JOIN win USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items, sha256(coalesce(it.l, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AND 20 * coalesce(hit.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

#: Measures per document, then for each rule the beta prior by moments and the hosts' shrunk rates.
QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_BLANK_WORD}') AS w FROM documents),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_BLANK_WORD}') GROUP BY doc_id),
a AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) > 2), g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS c FROM a),
rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM g WHERE c > 1) GROUP BY doc_id),
m AS (SELECT d.doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 AS x_short, 100 * n_repeat_words > 50 * n_words AS x_repeats, 100 * n_symbols > 10 * n_words AS x_symbols, 100 * n_dup_lines > 30 * greatest(n_lines, 1) AS x_lines FROM m),
x AS (SELECT host, rule, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE bad) AS DOUBLE) AS f FROM (
  SELECT host, 'short' AS rule, x_short AS bad FROM f UNION ALL SELECT host, 'repeats', x_repeats FROM f UNION ALL SELECT host, 'symbols', x_symbols FROM f
  UNION ALL SELECT host, 'lines', x_lines FROM f UNION ALL SELECT host, 'any', x_short OR x_repeats OR x_symbols OR x_lines FROM f) GROUP BY host, rule),
t AS (SELECT rule, sum(f) AS f, sum(n) AS n, count(*) AS k, sum(f * f / n) AS f2, sum(n * n) AS n2, (sum(f) + 0.5) / (sum(n) + 1.0) AS m FROM x GROUP BY rule),
b AS (SELECT rule, m, CASE WHEN k > 1 AND n - n2 / n > 0 THEN (f2 - f * f / n - (k - 1) * m * (1 - m)) / (n - n2 / n) END AS b FROM t),
p AS (SELECT rule, m, CASE WHEN b > 0 THEN greatest(2, m * (1 - m) / b - 1) ELSE 1e18 END AS wt, greatest(0.3, 4 * m / (1 - m + 4 * m)) AS lim FROM b),
s AS (SELECT host, x.n, wt, lim, (x.f + m * wt) / (x.n + wt) AS r FROM x JOIN p USING (rule)),
h AS (SELECT host, bool_and(r - 3 * sqrt(r * (1 - r) / (n + wt + 1)) <= lim) AS ok FROM s GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, x_short OR x_repeats AS base_failed, NOT (x_short OR x_repeats) AND ok AS kept, f.host AS host FROM f JOIN h USING (host)
"""


def _rounds(n: int) -> str:
    """One part per round: every vector to its nearest centroid, then floored means; the last part only assigns."""
    out = ""
    for i in range(n + 1):
        out += f""",
a{i} AS MATERIALIZED (SELECT r, c, d FROM (SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS k FROM (
  SELECT v.r, c{i}.c, list_sum(list_transform(list_zip(v.e, c{i}.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v CROSS JOIN c{i})) WHERE k = 1)"""
        if i < n:
            out += f""",
m{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS e FROM (SELECT c, p, sum(x) AS s, count(*) AS n FROM (
  SELECT a.c, unnest(v.e) AS x, unnest(range(64)) AS p FROM a{i} a JOIN v USING (r)) GROUP BY c, p) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.e, o.e) AS e FROM c{i} o LEFT JOIN m{i} m USING (c))"""
    return out


#: Five rounds of assigning and averaging, then the last assignment.
CENTROIDS = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, e FROM (SELECT sha256('2:' || vec_id) AS h, e FROM v ORDER BY h LIMIT 40)){_rounds(5)},
i AS (SELECT c, sum(d) AS s FROM a5 GROUP BY c)
SELECT vec_id, CAST(a.c AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(i.s AS BIGINT) AS cluster_inertia, CAST((SELECT sum(d) FROM a5) AS BIGINT) AS inertia, sha256(array_to_string(c5.e, ',')) AS centroid_sha256
FROM a5 a JOIN v USING (r) JOIN c5 ON c5.c = a.c JOIN i ON i.c = a.c
"""

#: Keys of 20 characters in three documents lose their lines but in the last document.
LINES = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS p FROM s),
k AS (SELECT doc_id, line, p, trim(translate(line, '{UPPER}', '{LOWER}'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM x),
f AS (SELECT k, max(doc_id) AS last FROM k WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
g AS (SELECT k.*, f.k IS NOT NULL AND doc_id <> f.last AS gone FROM k LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM g GROUP BY doc_id
"""

_KEEPS = "CASE WHEN held THEN least(3 + more + {next}, {keep}) ELSE 1000000 END"
#: Damage by checksum, faults, cost to go from the last turn back, then one edit after another from the first.
REPAIR = rf"""
WITH RECURSIVE tb AS (SELECT list(c ORDER BY i) AS tb FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c FROM range(256) t(i))),
t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
z AS (SELECT t.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(place, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, b: xor(a // 256, tb[xor(a, b) % 256 + 1])), 4294967295) % 20 AS z FROM t, tb),
d AS (SELECT conv_id, turn, CASE z WHEN 4 THEN 'user' ELSE role END AS role, CASE z WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE z WHEN 3 THEN [0, 1] ELSE [0] END) AS k FROM z WHERE z <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, k) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, k) AS g FROM d),
f AS (SELECT *, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 1 WHEN g > 1 THEN 2 WHEN regexp_extract(text, '([^ 	-])[ 	-]*\z', 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM o),
e AS MATERIALIZED (SELECT conv_id, i, turn, role, text, r, fault, fault NOT IN (1, 2) AS held, CASE fault WHEN 3 THEN 3 ELSE 0 END AS more, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM f),
n AS (SELECT conv_id, count(*) AS n, CASE WHEN count(turn) > 0 THEN max(turn) - min(turn) + 1 - count(DISTINCT turn) ELSE 0 END AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
  count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE i > 1 AND prev || r NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY conv_id),
b AS (SELECT conv_id, n + 1 AS i, 0 AS c0, 6 AS c1, 3 AS c2, 0 AS c3 FROM n
  UNION ALL SELECT conv_id, i, least(h0, 3 + least(h2, 3 + h3)), least(h1, 3 + least(h2, 3 + h3)), least(h2, 3 + h3), least(h3, 3 + h2) FROM (
    SELECT e.conv_id, e.i,
      least(4 + c0, {_KEEPS.format(next="c2", keep="CASE r WHEN 's' THEN more + c1 WHEN 'u' THEN more + c2 ELSE 1000000 END")}) AS h0, least(4 + c1, {_KEEPS.format(next="c2", keep="CASE r WHEN 'u' THEN more + c2 ELSE 1000000 END")}) AS h1,
      least(4 + c2, {_KEEPS.format(next="c3", keep="CASE r WHEN 'a' THEN more + c3 ELSE 1000000 END")}) AS h2, least(4 + c3, {_KEEPS.format(next="c2", keep="CASE r WHEN 'u' THEN more + c2 ELSE 1000000 END")}) AS h3
    FROM e JOIN b ON b.conv_id = e.conv_id AND b.i = e.i + 1)),
q AS MATERIALIZED (SELECT conv_id, i, [c0, c1, c2, c3] AS c FROM b),
w AS (SELECT conv_id, CAST(1 AS BIGINT) AS i, 0 AS s, '' AS audit, CAST([] AS VARCHAR[]) AS kept, n, false AS done FROM n
  UNION ALL SELECT conv_id, CASE WHEN x IN ('I', '') THEN i ELSE i + 1 END, CASE WHEN x IN ('D', '') THEN s WHEN x = 'K' AND r = 's' THEN 1 WHEN s = 2 THEN 3 ELSE 2 END, audit || x,
    CASE x WHEN 'D' THEN kept WHEN '' THEN kept WHEN 'I' THEN list_append(kept, who || ':') WHEN 'K' THEN list_append(kept, role || ':' || text) ELSE list_append(kept, who || ':' || text) END, n, x = '' FROM (
      SELECT w.*, e.r, e.role, e.text, CASE w.s WHEN 2 THEN 'assistant' ELSE 'user' END AS who,
        CASE WHEN w.i > w.n THEN CASE WHEN w.s IN (0, 3) THEN '' ELSE 'I' END WHEN 4 + y.c[s + 1] = q.c[s + 1] THEN 'D' WHEN 3 + q.c[CASE s WHEN 2 THEN 4 ELSE 3 END] = q.c[s + 1] THEN 'I'
          WHEN held AND more + CASE WHEN s = 0 AND r = 's' THEN y.c[2] WHEN s <> 2 AND r = 'u' THEN y.c[3] WHEN s = 2 AND r = 'a' THEN y.c[4] ELSE 1000000 END = q.c[s + 1] THEN 'K' ELSE 'R' END AS x
      FROM w LEFT JOIN e ON e.conv_id = w.conv_id AND e.i = w.i LEFT JOIN q ON q.conv_id = w.conv_id AND q.i = w.i LEFT JOIN q y ON y.conv_id = w.conv_id AND y.i = w.i + 1 WHERE NOT w.done))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(q.c[1], 0) AS BIGINT) AS cost, coalesce(w.audit, '') AS audit, sha256(coalesce(array_to_string(w.kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n USING (conv_id) LEFT JOIN q ON q.conv_id = a.conv_id AND q.i = 1 LEFT JOIN w ON w.conv_id = a.conv_id AND w.done
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": WARC, "op5_ngram_join": COMPONENTS, "op6_quality": QUALITY, "op7_chat": CHAT, "op9_decontamination": CONTAMINATION, "op11_centroids": CENTROIDS, "op12_line_dedup": LINES, "op13_turn_repair": REPAIR}
