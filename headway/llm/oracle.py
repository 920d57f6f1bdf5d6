"""DuckDB twins of the queries that SQL expresses."""

from __future__ import annotations

from headway.llm import manifest, mixing, quality, secrets, vector_codes

_SPACES = r"[\x20\x09-\x0D]"
_NOT_SPACE = r"[^\x20\x09-\x0D]"


def _count(characters: str) -> str:
    return " + ".join(f"(length(t) - length(replace(t, {c}, '')))" for c in characters)


_SYMBOLS = _count([f"'{c}'" for c in quality.SYMBOLS])
_BLANKS = _count([f"chr({ord(c)})" for c in quality.SPACES])

OP5 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_NOT_SPACE}')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, key) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM again) GROUP BY doc_id),
counts AS (
  SELECT d.doc_id, len(w) AS n_words, length(t) - ({_BLANKS}) AS word_chars, {_SYMBOLS} AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(l) AS n_lines,
         coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words
            OR 100 * n_symbols > {quality.MAX_SYMBOLS} * n_words OR 100 * n_dup_lines > {quality.MAX_DUP_LINES} * n_lines
            OR word_chars < {quality.MEAN_WORD[0]} * n_words OR word_chars > {quality.MEAN_WORD[1]} * n_words
            OR longest > {quality.MAX_WORD}) AS kept
FROM counts
"""


def _found(kind: str, pattern: str, value: str) -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, source, t, {secrets.KINDS.index(kind)} AS rank, '{kind}' AS kind, i, {value.format(p=p)} AS value,
         list_sum(list_transform(g[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS s, length(f[i]) AS n
  FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i
        FROM (SELECT doc_id, source, t, regexp_extract_all(t, '{p}') AS f, string_split_regex(t, '{p}') AS g FROM d)
        WHERE len(f) > 0)"""


OP4 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
matches AS ({_found("assign", secrets.ASSIGN, "regexp_extract(f[i], '{p}', 1)")}
  UNION ALL {_found("access", "AKIA[A-Z0-9]+", "f[i]")}
  UNION ALL {_found("hex", "[0-9a-f]+", "f[i]")}
  UNION ALL {_found("opaque", "[A-Za-z0-9_-]{32,}", "f[i]")}),
fit AS (
  SELECT *, s + n AS e FROM matches
  WHERE (kind = 'assign' AND length(value) >= {secrets.MIN_ASSIGN}) OR (kind = 'access' AND n >= 20)
     OR (kind = 'hex' AND n >= 24)
     OR (kind = 'opaque' AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
         AND regexp_matches(value, '[0-9]'))),
spans AS (
  SELECT a.* FROM fit a WHERE kind <> 'opaque' OR NOT EXISTS (
    SELECT 1 FROM fit b WHERE b.doc_id = a.doc_id AND b.kind <> 'opaque' AND b.s < a.e AND a.s < b.e)),
owned AS (
  SELECT *, owners < {secrets.WIDESPREAD} OR texts < {secrets.WIDESPREAD} AS live
  FROM (SELECT value, count(DISTINCT coalesce('+' || source, '-')) AS owners, count(DISTINCT t) AS texts FROM spans GROUP BY value)),
judged AS (
  SELECT p.*, o.owners, o.texts, o.live FROM spans p JOIN owned o ON o.value = p.value WHERE p.kind <> 'opaque' OR o.live),
joined AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_wide,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'opaque') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
         string_agg(owners || '/' || texts, ',' ORDER BY s, rank) AS ownership
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_wide, 0)::BIGINT AS n_widespread, coalesce(ownership, '') AS ownership
FROM d LEFT JOIN joined j ON j.doc_id = d.doc_id
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of ASCII text by its table of 256 steps, which ``crc`` holds as ``steps``."""
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), "
            f"lambda c: ascii(c)::BIGINT)), lambda a, b: xor(a >> 8, crc.steps[(xor(a, b) & 255) + 1])), 4294967295)")


_CRC = """crc AS (
  SELECT list(c ORDER BY i) AS steps
  FROM (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
                              CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
        FROM range(256) r(i)))"""

_LEAF = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in manifest.FIELDS[:-1]) + " || "


def _climb(name: str, leaves: str) -> str:
    return f"""{name} AS (
  SELECT 0 AS level, tree, i, n, digest FROM {leaves}
  UNION ALL
  SELECT level + 1, tree, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY level, tree, i // 8, n)"""


def _steps(up: str, leaves: str, offset: int) -> str:
    """Per leaf (tree, place) and level: the digests beside its node, left and right."""
    return f"""
  SELECT l.tree, l.i AS place, u.level + {offset} AS level, {{'l': coalesce(string_agg(u.digest, '' ORDER BY u.i) FILTER (u.i < l.i // pow(8, u.level)::BIGINT), ''),
         'd': '', 'r': coalesce(string_agg(u.digest, '' ORDER BY u.i) FILTER (u.i > l.i // pow(8, u.level)::BIGINT), '')}} AS step
  FROM {leaves} l JOIN {up} u ON u.tree = l.tree AND u.n > 1 AND u.i // 8 = l.i // pow(8, u.level + 1)::BIGINT
  GROUP BY l.tree, l.i, u.level"""


OP11 = rf"""
WITH RECURSIVE {_CRC},
hashed AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, sha256({_LEAF} coalesce(strlen(text) || ':' || text, '-')) AS digest,
         CASE WHEN {_crc32("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 THEN
           sha256({_LEAF} coalesce(strlen(text) || ':' || translate(text, '{manifest.UPPER}', '{manifest.UPPER.lower()}'), '-')) END AS altered
  FROM documents, crc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed),
{_climb("up", "leaves")},
subroots AS (
  SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n
  FROM up WHERE n = 1),
{_climb("top", "subroots")},
steps AS ({_steps("up", "leaves", 0)}),
top_steps AS ({_steps("top", "subroots", 1000)}),
every AS (
  SELECT * FROM steps
  UNION ALL
  SELECT l.tree, l.i, t.level, t.step FROM leaves l JOIN subroots s ON s.name = l.tree JOIN top_steps t ON t.place = s.i),
paths AS (SELECT tree, place, list(step ORDER BY level) AS path FROM every GROUP BY tree, place),
folded AS (
  SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root,
         sha256(coalesce(list_aggregate(list_transform(p.path, lambda x: x.l || x.r), 'string_agg', ''), '')) AS proof_sha256,
         list_reduce(list_concat([{{'l': '', 'd': coalesce(l.altered, l.digest), 'r': ''}}], coalesce(p.path, [])),
                     lambda a, x: {{'l': '', 'd': sha256(x.l || a.d || x.r), 'r': ''}}).d AS folded_root
  FROM leaves l JOIN subroots s ON s.name = l.tree LEFT JOIN paths p ON p.tree = l.tree AND p.place = l.i)
SELECT *, folded_root = root AS verified FROM folded
"""


def _reduced(level: int) -> str:
    """One level of the reduction tree: runs of fractions folded in order, then what is left of each run."""
    run = mixing.RUN
    return f"""
fold{level} AS (
  SELECT source, i // {run} AS run, 0 AS k, i, doc_id, size, mass, NULL::BIGINT AS d_id, NULL::BIGINT AS d_size, NULL::INTEGER AS more
  FROM items{level} WHERE i % {run} = 0
  UNION ALL
  SELECT source, run, k + 1, CASE WHEN stays THEN i ELSE b_i END, CASE WHEN stays THEN doc_id ELSE b_id END,
         CASE WHEN stays THEN size ELSE b_size END,
         CASE WHEN to_a AND NOT stays THEN b_mass - up WHEN to_a THEN mass + up WHEN stays THEN mass - down ELSE b_mass + down END,
         CASE WHEN stays THEN b_id ELSE doc_id END, CASE WHEN stays THEN b_size ELSE size END,
         CASE WHEN to_a <> stays THEN 1 ELSE 0 END
  FROM (SELECT *, CASE WHEN to_a THEN size - mass > b_mass ELSE mass > b_size - b_mass END AS stays
        FROM (SELECT *, chance * (up + down) < down AS to_a
              FROM (SELECT f.*, b.i AS b_i, b.doc_id AS b_id, b.size AS b_size, b.mass AS b_mass,
                           least(f.size - f.mass, b.mass) AS up, least(f.mass, b.size - b.mass) AS down,
                           ('0x' || substr(md5('{mixing.SEED}:' || f.source || ':{level}:' || f.i || ':' || b.i), 1, 13))::BIGINT::DOUBLE
                             / 4503599627370496.0 AS chance
                    FROM fold{level} f JOIN items{level} b ON b.source = f.source AND b.i = f.run * {run} + f.k + 1 AND f.k + 1 < {run})))),
items{level + 1} AS (
  SELECT source, run AS i, doc_id, size, mass FROM fold{level} QUALIFY row_number() OVER (PARTITION BY source, run ORDER BY k DESC) = 1)"""


_LEVELS = 4     # enough for 64 ** 4 documents of a source

OP13 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce('0' || source, '1') AS source,
         len(list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         {list(mixing.WEIGHTS)}[((row_number() OVER (ORDER BY encode(source)) - 1) % 3 + 1)::INTEGER] AS weight
  FROM sized GROUP BY source),
waters AS (     -- the level is the highest that any set of smallest sources for their weight, at their bound, gives
  SELECT 3 * (SELECT sum(source_size) FROM sources) - 4 * coalesce(sum(source_size) OVER o, 0) AS rest,
         (SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER o, 0) AS share
  FROM sources WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT * FROM waters ORDER BY rest::DOUBLE / share DESC LIMIT 1),
wanted AS (
  SELECT source, source_size, CASE WHEN weight * rest > 4 * share * source_size THEN (2 * source_size)::DOUBLE
                                   ELSE weight::DOUBLE * rest::DOUBLE / (2 * share)::DOUBLE END AS target
  FROM sources, water),
copied AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::INTEGER END AS whole FROM wanted),
every AS (
  SELECT d.*, c.source_size, c.target, c.whole, row_number() OVER (PARTITION BY source ORDER BY size DESC, doc_id NULLS FIRST) - 1 AS i,
         CASE WHEN source_size = 0 THEN 0.0 ELSE (target - whole * source_size) / source_size END AS fraction
  FROM sized d JOIN copied c USING (source)),
items0 AS (SELECT source, i, doc_id, size, fraction * size AS mass FROM every WHERE fraction > 0 AND size > 0),
{",".join(_reduced(k) for k in range(_LEVELS))},
decided AS (
  {" UNION ALL ".join(f"SELECT source, d_id AS doc_id, d_size AS size, more FROM fold{k} WHERE k > 0" for k in range(_LEVELS))}
  UNION ALL SELECT source, doc_id, size, (2 * mass >= size)::INTEGER FROM items{_LEVELS}
  UNION ALL SELECT source, doc_id, size, 0 FROM every WHERE NOT (fraction > 0 AND size > 0))
SELECT d.doc_id, d.size, c.source_size, c.target, ((c.whole + d.more) * d.size)::BIGINT AS taken
FROM decided d JOIN copied c USING (source)
"""


def _assigned(books: str) -> str:
    """(vec_id, part, entry, dist) of every part's nearest entry in ``books``."""
    return f"""
  SELECT vec_id, part, min(dist * 64 + entry) % 64 AS entry, min(dist * 64 + entry) // 64 AS dist
  FROM (SELECT p.vec_id, p.part, b.entry, sum((p.v - b.v) * (p.v - b.v))::BIGINT AS dist
        FROM places p JOIN {books} b ON b.part = p.part AND b.place = p.place GROUP BY p.vec_id, p.part, b.entry)
  GROUP BY vec_id, part"""


def _trained(k: int) -> str:
    return f"""
near{k} AS ({_assigned(f"books{k}")}),
means{k} AS (
  SELECT n.part, n.entry, p.place, sum(p.v)::BIGINT AS s, count(*)::BIGINT AS c
  FROM near{k} n JOIN places p ON p.vec_id = n.vec_id AND p.part = n.part GROUP BY n.part, n.entry, p.place),
books{k + 1} AS (
  SELECT b.part, b.entry, b.place, coalesce((s - ((s % c) + c) % c) // c, b.v) AS v
  FROM books{k} b LEFT JOIN means{k} m ON m.part = b.part AND m.entry = b.entry AND m.place = b.place)"""


#: For unique ids, vectors of one length and components below 100,000 in size, as in the given tables.
OP12 = rf"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS x, len(embedding) // {vector_codes.PARTS} AS width,
         row_number() OVER (ORDER BY vec_id) - 1 AS rank
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbers AS (SELECT *, unnest(range(len(x))) AS k FROM kept),
places AS (SELECT vec_id, rank, k // width AS part, k % width AS place, x[k + 1] AS v FROM numbers),
books0 AS (SELECT part, rank AS entry, place, v FROM places WHERE rank < {vector_codes.ENTRIES}),
{",".join(_trained(k) for k in range(vector_codes.ROUNDS))},
final AS ({_assigned(f"books{vector_codes.ROUNDS}")}),
digest AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) AS h FROM books{vector_codes.ROUNDS}),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
  FROM final GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded c JOIN kept k USING (vec_id), digest
"""
