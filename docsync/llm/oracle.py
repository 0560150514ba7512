"""The same results in SQL, where SQL can express them."""

OP8 = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM d),
x AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
y AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i+1], ws[i+2]) AS c FROM x),
z AS (SELECT doc_id, least(3, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -3)) AS n
      FROM y WHERE c > 1),
r AS (SELECT doc_id, sum(n) AS n_repeat_words FROM z GROUP BY doc_id),
m AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f
      FROM b WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT avg(f / n) AS mean, coalesce(var_samp(f / n), 0) AS v, avg(n) AS size FROM h),
k AS (SELECT source, (f + mean * s) / (n + s) AS rate
      FROM h, (SELECT mean, CASE WHEN v > 1e-12 THEN greatest(1.0, mean * (1 - mean) / v - 1)
                                 ELSE size END AS s FROM p))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(rate, 0) <= 0.75 AS kept
FROM b LEFT JOIN k ON b.source = k.source
"""

OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 3),
             lambda i: array_to_string(ws[i:i + 4], ' ')))) END AS sh FROM w),
c AS (SELECT min(doc_id) AS id, len(sh) AS n, sh FROM s WHERE len(sh) > 0 GROUP BY sh),
t AS (SELECT id, n, unnest(sh) AS x FROM c),
common AS (SELECT x FROM t GROUP BY x HAVING count(*) > 1),
p AS (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS k
      FROM (SELECT * FROM t SEMI JOIN common USING (x)) a JOIN t b ON a.x = b.x AND a.id < b.id
      GROUP BY ALL HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r(id, other) AS (SELECT id, id FROM c UNION SELECT r.id, e.b FROM r JOIN e ON r.other = e.a),
m AS (SELECT id, min(other) AS root FROM r GROUP BY id)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(root, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.sh = c.sh LEFT JOIN m ON m.id = c.id
"""

OP7 = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS h,
        min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(((
      (strpos('0123456789abcdef', substr(h, 1 + (5 * i) // 4, 1)) - 1) * 16
      + strpos('0123456789abcdef', substr(h, 2 + (5 * i) // 4, 1)) - 1)
      >> CAST(3 - (5 * i) % 4 AS INTEGER)) % 32 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""

OP9 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 199)) AS i, h FROM d WHERE length(h) >= 400),
g AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM s),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY k) > 1),
o AS (SELECT doc_id, i, lag(i) OVER w AS before, lead(i) OVER w AS after
      FROM twice WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, CAST(sum(least(200, coalesce(after - i, 200))) AS BIGINT) AS n_removed,
        CAST(count(*) FILTER (before IS NULL OR i - before > 200) AS BIGINT) AS n_spans
      FROM o GROUP BY doc_id),
gaps AS (SELECT doc_id, i + 200 AS low, coalesce(after, 1000000000) AS high FROM o
         WHERE after IS NULL OR after > i + 200
         UNION ALL SELECT doc_id, 0, min(i) FROM o GROUP BY doc_id),
kept AS (SELECT g.doc_id, string_agg(substr(h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS t
         FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN f.doc_id IS NULL THEN h ELSE coalesce(t, '') END)) AS kept_sha256
FROM d LEFT JOIN f ON f.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

#: The table of crc32 by byte, as a list, and the unsigned crc32 of a text of ASCII digits or of
#: bytes given as a list, with that list at hand as ``crc.t``.
CRC_TABLE = """
crc AS MATERIALIZED (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i))"""


def crc32_of(numbers: str) -> str:
    """SQL for the crc32 of a list of byte values."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {numbers}), lambda c, b: "
            "xor(crc.t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)")


def op13() -> str:
    """Trees of up to LEVELS levels, so 16 ** LEVELS leaves in a source and as many sources."""
    levels = 8
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"

    def field(name):
        return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || {name}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def climb(node, fold):
        out = []
        for k in range(1, levels + 1):
            slot, kids = "f.i % 16", f"{node}{k}.kids"
            out.append(f"""
{node}{k} AS MATERIALIZED (SELECT s, i // 16 AS i, list(h ORDER BY i) AS kids, any_value(c) AS c0,
  CASE WHEN any_value(c) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
  (any_value(c) + 15) // 16 AS c FROM {node}{k - 1} GROUP BY s, i // 16)""")
            out.append(f"""
{fold}{k} AS MATERIALIZED (SELECT f.* REPLACE (f.i // 16 AS i,
  CASE WHEN c0 = 1 THEN now ELSE sha256(array_to_string({kids}[:{slot}], '') || now
    || array_to_string({kids}[{slot} + 2:], '')) END AS now,
  CASE WHEN c0 = 1 THEN sib ELSE sib || array_to_string({kids}[:{slot}], '')
    || array_to_string({kids}[{slot} + 2:], '') END AS sib)
  FROM {fold}{k - 1} f JOIN {node}{k} ON f.s = {node}{k}.s AND f.i // 16 = {node}{k}.i)""")
        return ",".join(out)
    return f"""
WITH {CRC_TABLE},
d AS MATERIALIZED (SELECT doc_id, coalesce('s' || source, 'n') AS s, {leaf("text")} AS leaf,
  CASE WHEN {crc32_of(digits)} % 5 = 0 THEN {leaf(
      "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
  FROM documents, crc),
f0 AS MATERIALIZED (SELECT doc_id, s, leaf, coalesce(other, leaf) AS now, '' AS sib,
  count(*) OVER (PARTITION BY s) AS c,
  row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
n0 AS (SELECT s, i, leaf AS h, c FROM f0),{climb("n", "f")},
m0 AS MATERIALIZED (SELECT '' AS s, s AS own, row_number() OVER (ORDER BY s) - 1 AS i, h,
  count(*) OVER () AS c FROM n{levels}),
g0 AS MATERIALIZED (SELECT f.doc_id, f.leaf, m0.h AS subroot, '' AS s, m0.i, f.now, f.sib
  FROM f{levels} f JOIN m0 ON f.s = m0.own),{climb("m", "g")}
SELECT doc_id, leaf, subroot, m{levels}.h AS root, sha256(sib) AS proof_sha256,
  now AS folded_root, now = m{levels}.h AS verified
FROM g{levels}, m{levels}
"""


OP12 = f"""
WITH RECURSIVE {CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
k AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run),
b AS (SELECT run, n, flatten(list_transform(
  string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x:
  CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)) AS bytes
  FROM k),
h AS (SELECT run, n, {crc32_of("bytes")} AS h FROM b, crc),
w AS MATERIALIZED (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run))
    || substr(run, 2 + h % length(run)) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM h GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
g AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS other FROM g a JOIN g b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, w.word FROM g JOIN w ON g.rest = w.word
  UNION SELECT w.word, g.word FROM g JOIN w ON g.rest = w.word),
f AS MATERIALIZED (SELECT p.word, w.n, count(*) OVER (PARTITION BY p.word) AS n_near, other, o.n AS other_n
  FROM p JOIN w ON w.word = p.word JOIN w o ON o.word = other
  QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, other) = 1),
c(word, root) AS (SELECT word, word FROM w UNION ALL
  SELECT c.word, f.other FROM c JOIN f ON f.word = c.root AND f.other_n >= 2 * f.n),
e AS (SELECT c.word, c.root FROM c LEFT JOIN f ON f.word = c.root AND f.other_n >= 2 * f.n WHERE f.word IS NULL)
SELECT w.word, CASE WHEN other_n >= 2 * w.n THEN other END AS form, e.root, w.n,
  coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
FROM w LEFT JOIN f ON f.word = w.word JOIN e ON e.word = w.word
"""

ORACLE = {"op2_ngram_jaccard": OP2, "op7_warc": OP7, "op8_quality_rules": OP8,
          "op9_suffix_dedup": OP9, "op12_spelling_variants": OP12,
          "op13_merkle_manifest": op13()}
