"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from . import license_scan as ls
from . import quality_rules as qr

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def op5() -> str:
    count = lambda pattern: f"(length(t) - length(regexp_replace(t, '{pattern}', '', 'g')))"
    ok = []
    for name, least, most in qr.THRESHOLDS:
        ok += [f"{name} >= {least!r}"] * (least is not None) + [f"{name} <= {most!r}"] * (most is not None)
    return rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
tri AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
dup AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (
  SELECT doc_id, sum(least(3, coalesce(nx - i, 3))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM dup) GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         {count('[#*$%&|<>]')} AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(cov.n, 0) AS n_repeat_words, {count('[!?]')} AS marks, {count(chr(92) + 'p{Lu}')} AS capitals,
         len(list_filter(w, lambda x: lower(x) IN ({_quoted(qr.STOP_WORDS)}))) AS stops,
         len(list_filter(w, lambda x: x = '|')) AS pipes
  FROM base LEFT JOIN cov USING (doc_id)),
measured AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_length,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
         CASE WHEN n_words > 0 THEN marks / n_words ELSE 0 END AS marks_per_word,
         CASE WHEN n_words > 0 THEN pipes / n_words ELSE 0 END AS pipe_word_ratio,
         CASE WHEN word_chars > 0 THEN capitals / word_chars ELSE 0 END AS capital_ratio,
         CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio
  FROM counted),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(ok)} AS kept
FROM judged"""


def op2() -> str:
    turn = lambda place: f"{place} % 3"
    at = lambda share: f"""CASE {turn('place')}
         WHEN 0 THEN CASE WHEN {share} * 5 < 3.125 THEN (sqrt(56.25 - 10 * ({share} * 5)) - 7.5) / -5
                     ELSE 0.5 + (sqrt(25 - 10 * ({share} * 5 - 3.125)) - 5) / -5 END
         WHEN 1 THEN CASE WHEN {share} * 2 < 1 THEN {share} * 2 / 2 ELSE 0.5 + ({share} * 2 - 1) / 2 END
         ELSE CASE WHEN {share} < 0.375 THEN (sqrt(0.25 + 2 * {share}) - 0.5) / 1
              ELSE 0.5 + (sqrt(1 + 2 * ({share} - 0.375)) - 1) / 1 END END"""  # noqa: E731
    return rf"""
WITH sizes AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
stats AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM sizes GROUP BY source),
weighed AS (
  SELECT *, (CASE {turn('place')} WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight,
         (2 * source_size)::DOUBLE AS cap FROM stats),
levels AS (
  SELECT *, ((1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, place
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT *, least(cap, coalesce(weight * max(CASE WHEN level <= cap / weight THEN level END) OVER (), cap)) AS target
  FROM levels),
streams AS (
  SELECT doc_id, size, source_size, target, place, floor(target)::BIGINT AS wanted,
         coalesce(sum(size) OVER (PARTITION BY place ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || size), 1, 15))::BIGINT,
           doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source),
taken AS (
  SELECT *, greatest(0, least(size, wanted - start)) AS one, greatest(0, least(size, wanted - source_size - start)) AS two
  FROM streams)
SELECT doc_id, size, source_size, target, (one + two)::BIGINT AS taken,
       CASE WHEN one > 0 THEN {at('(start / target)')} END AS position,
       CASE WHEN two > 0 THEN {at('((source_size + start) / target)')} END AS second_position
FROM taken"""


def op8() -> str:
    return r"""
WITH named AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) = 1 AS kept
  FROM named)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked"""


def op6() -> str:
    split = lambda text: (
        rf"list_filter(string_split_regex(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        rf" '{ls.SEPARATORS}'), lambda x: x <> '')"
    )
    phrases = ", ".join(f"([{_quoted(p.split(' '))}], '{label}')" for p, label in ls.PHRASES)
    every = ls.TEMPLATES + ls.LATER_PARTS
    longest = max(len(ls.split_words(text)) for _, text in every)
    sets = ls.template_sets(every)
    templates = ", ".join(
        f"({k}, '{label}', [{_quoted(ws)}], {ls.need(len(ws), ls.THRESHOLD)}, [{_quoted(apart)}]::VARCHAR[], {wider}::INT[])"
        for k, ((label, ws), (apart, wider)) in enumerate(zip(sets, ls.families(sets)))
    )
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT rid, doc_id, {split('t')} AS w FROM docs),
phrases(p, label) AS (VALUES {phrases}),
places AS (
  SELECT rid, label, i - 1 AS i FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM split), phrases
  WHERE w[i] = p[1] AND w[i:i + len(p) - 1] = p),
base AS (
  SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list_distinct(list(label))) AS b
  FROM places GROUP BY rid),
templates(id, label, words, least, apart, wider) AS (VALUES {templates}),
parts AS (
  SELECT rid, {split('line')} AS w FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs)
  UNION ALL
  SELECT rid, w[k + 1:k + {2 * longest}] FROM (SELECT rid, w, unnest(range(0, len(w), {longest})) AS k FROM split)),
blocks AS (SELECT row_number() OVER () AS bid, rid, w FROM parts),
hits AS (
  SELECT bid, rid, id, label, wider, len(list_intersect(words, w)) / len(words) AS c FROM blocks, templates
  WHERE len(list_intersect(words, w)) >= least AND len(list_intersect(apart, w)) = len(apart)),
there AS (SELECT bid, list(id) AS ids FROM hits GROUP BY bid),
matches AS (SELECT rid, label, c FROM hits JOIN there USING (bid) WHERE len(list_intersect(wider, ids)) = 0),
more AS (SELECT rid, list(DISTINCT label) AS m, max(c) AS best FROM matches GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(coalesce(b, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b, []), coalesce(m, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM split LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)"""


def op10() -> str:
    return """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100"""


def op13() -> str:
    gram = lambda k: f"SELECT lang, {k} AS k, list_slice(w, i, i + {k - 1}) AS g FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces)"
    return rf"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, g, count(*) AS f FROM ({' UNION ALL '.join(gram(k) for k in range(1, 6))})
  GROUP BY lang, k, g HAVING count(*) >= 100),
wider AS (
  SELECT lang, g, max(f) AS most FROM (
    SELECT lang, list_slice(g, 1, k - 1) AS g, f FROM grams WHERE k > 2
    UNION ALL SELECT lang, list_slice(g, 2, k) AS g, f FROM grams WHERE k > 2) GROUP BY lang, g),
cuts AS (
  SELECT p.lang AS lang, p.g AS g, f AS a, unnest(range(1, k)) AS cut
  FROM grams p LEFT JOIN wider ON p.lang = wider.lang AND p.g = wider.g WHERE k > 1 AND (most IS NULL OR 100 * most < 100 * f)),
scored AS (
  SELECT c.lang AS lang, c.g AS g, c.a AS a, c.cut AS cut, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN grams x ON c.lang = x.lang AND x.g = list_slice(c.g, 1, c.cut)
  JOIN grams y ON c.lang = y.lang AND y.g = list_slice(c.g, c.cut + 1, len(c.g)) JOIN totals t ON c.lang = t.lang),
best AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""


def _risen(name: str, start: str, levels: int) -> str:
    """Tables ``name``0 to ``name`` + levels of (tree, pos, h), a level of a tree of three in each; trees of one node stay."""
    out = [f"{name}0 AS ({start})"]
    for k in range(levels):
        out.append(
            f"""{name}{k + 1} AS (
  SELECT tree, 0::BIGINT AS pos, h FROM {name}{k} WHERE size = 1
  UNION ALL SELECT tree, pos // 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {name}{k} WHERE size > 1 GROUP BY tree, pos // 3)""".replace(
                f"FROM {name}{k} ", f"FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {name}{k}) "
            )
        )
    return ",\n".join(out)


def _path(name: str, levels: int, key: str, start: str) -> str:
    """Tables ``name``p0 to ``name``p + levels: each node's siblings so far (proof) and what its leaf folds to (f)."""
    out = [f"{name}p0 AS ({start})"]
    for k in range(levels):
        out.append(
            f"""{name}r{k} AS (SELECT tree, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM {name}{k} GROUP BY tree, pos // 3),
{name}p{k + 1} AS (
  SELECT {key}, p.tree AS tree, p.pos // 3 AS pos,
         CASE WHEN size = 1 THEN proof ELSE proof || array_to_string(hs[1:(p.pos % 3)], '') || array_to_string(hs[(p.pos % 3) + 2:], '') END AS proof,
         CASE WHEN size = 1 THEN f ELSE sha256(array_to_string(hs[1:(p.pos % 3)], '') || f || array_to_string(hs[(p.pos % 3) + 2:], '')) END AS f
  FROM {name}p{k} p JOIN {name}r{k} r ON p.tree = r.tree AND p.pos // 3 = r.run
  JOIN (SELECT tree, count(*) AS size FROM {name}{k} GROUP BY tree) s ON p.tree = s.tree)"""
        )
    return ",\n".join(out)


def op11(levels: int = 9) -> str:
    """Whole for sources of 3 ** levels rows at most."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    hashed = lambda text: "sha256(" + " || ".join(field(c) if c != "text" else field(text) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    return rf"""
WITH RECURSIVE crc(doc_id, s, i, c) AS (
  SELECT doc_id, doc_id::VARCHAR, 0, 4294967295::BIGINT FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, i + 1, CASE WHEN i % 9 = 0 THEN xor(c, ascii(substr(s, (i // 9 + 1)::INT, 1))::BIGINT)
         WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END
  FROM crc WHERE i < 9 * length(s)),
even AS (SELECT doc_id AS even_id FROM crc WHERE i = 9 * length(s) AND xor(c, 4294967295::BIGINT) % 2 = 0),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {hashed('text')} AS leaf,
         CASE WHEN even_id IS NOT NULL THEN {hashed("replace(text, chr(10), '')")} ELSE {hashed('text')} END AS begun
  FROM documents LEFT JOIN even ON doc_id = even_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
{_risen('t', 'SELECT tree, pos, leaf AS h FROM placed', levels)},
subroots AS (SELECT tree AS key, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM t{levels}),
{_risen('u', "SELECT '' AS tree, pos, h FROM subroots", levels)},
{_path('t', levels, 'doc_id, leaf', "SELECT doc_id, leaf, tree, pos, '' AS proof, begun AS f FROM placed")},
{_path('u', levels, 'doc_id, leaf, subroot', f"SELECT doc_id, leaf, s.h AS subroot, '' AS tree, s.pos AS pos, proof, f FROM tp{levels} p JOIN subroots s ON p.tree = s.key")}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM up{levels}, u{levels}"""
