"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

from strata.llm.quality_rules import COMMON_WORDS

ORACLES: dict[str, str] = {}

ORACLES["op6_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS t FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.t, c.t) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.t) = len(q.t) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

ORACLES["op9_source_mixing"] = """
WITH RECURSIVE ranked AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 12), doc_id NULLS FIRST) - 1 AS rank
  FROM documents),
weights AS (SELECT source, CAST(greatest(round(pow(COUNT(*), 0.5) * 1000), 1) AS BIGINT) AS weight FROM documents GROUP BY source),
sums AS (SELECT greatest(1024, 4 * COUNT(*)) AS period, COUNT(*) AS n, CAST(SUM(weight) AS BIGINT) AS total FROM weights),
parts AS (
  SELECT source, 1 + ((period - n) * weight) // total AS whole, ((period - n) * weight) % total AS rest, period FROM weights, sums),
shares AS (
  SELECT source, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, source NULLS FIRST) <= period - SUM(whole) OVER () THEN 1 ELSE 0 END AS share,
         row_number() OVER (ORDER BY source NULLS FIRST) AS place
  FROM parts),
all_shares AS (SELECT list(CAST(share AS BIGINT) ORDER BY place) AS a FROM shares),
edf AS (
  SELECT CAST(0 AS BIGINT) AS t, list_transform(a, lambda x: CAST(0 AS BIGINT)) AS done, CAST(NULL AS BIGINT) AS pick FROM all_shares
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(done) + 1), lambda i: done[i] + CASE WHEN i = p THEN 1 ELSE 0 END), p
  FROM (SELECT t, done, list_sort(list_filter(list_transform(range(1, len(done) + 1),
                 lambda i: {'deadline': ((done[i] + 1) * period + a[i] - 1) // a[i], 'i': i, 'release': (done[i] * period) // a[i]}),
                 lambda x: x.release <= t))[1].i AS p
        FROM edf, all_shares, sums WHERE t < period)),
slots AS (SELECT pick AS place, list(t - 1 ORDER BY t) AS slots FROM edf WHERE pick IS NOT NULL GROUP BY pick),
blocks AS (SELECT r.doc_id, r.source, rank // 64 AS block, CAST(rank % 64 AS INTEGER) AS in_block, CAST(share AS BIGINT) AS share, slots, period
           FROM ranked r JOIN shares s ON r.source IS NOT DISTINCT FROM s.source JOIN slots USING (place), sums)
SELECT doc_id, source, block, in_block, share, (block * period) // share AS release, ((block + 1) * period + share - 1) // share AS deadline,
       CAST((block // share) * period + slots[block % share + 1] AS BIGINT) AS slot
FROM blocks"""

#: a count for each class of quality_rules, in its order
_CLASSES = [r"[a-z]|[^\x00-\x7f]", r"[A-Z]", "", "[0-9]", " ", r"[\t\n\v\f\r]", r"[.,;:?!'\"()-]", r"[#*$%&|<>]", r"[+/=@\[\]\\^_`{}~]", r"[\x00-\x08\x0e-\x1f\x7f]"]
_NON_ASCII = [r"\p{Ll}", r"\p{Lu}", r"[\p{Lt}\p{Lm}\p{Lo}]", r"\p{Nd}", None, r"[\x{85}\p{Z}]", None, None, None, None]


def _count(pattern: str) -> str:
    return "len(regexp_extract_all(text, '" + pattern.replace("'", "''") + "'))"


def _class_counts() -> str:
    ascii_parts = [_count(p.split("|[^")[0]) if p else "0" for p in _CLASSES]
    other = [f"len(regexp_extract_all(foreign_text, '{p}'))" if p else "0" for p in _NON_ASCII]
    known = " + ".join(x for x in other if x != "0")
    other[-1] = f"len(foreign_text) - ({known})"
    return "[" + ", ".join(f"CAST({a} + {b} AS DOUBLE)" for a, b in zip(ascii_parts, other)) + "]"


_WORD_LISTS = " ".join(f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in COMMON_WORDS.items())
_MOST = max(map(len, COMMON_WORDS.values()))
_NORM = "list_transform({0}, lambda x: x / list_sum({0}))"


def _distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of shares."""
    part = f"(CASE WHEN {{0}}[i] > 0 THEN {{0}}[i] * log2({{0}}[i] / (({p}[i] + {q}[i]) / 2)) ELSE 0 END)"
    return f"round(sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i: {part.format(p)} + {part.format(q)})) / 2, 0)), 6)"


ORACLES["op4_quality_rules"] = rf"""
WITH docs AS (
  SELECT doc_id, lang, COALESCE(text, '') AS text, regexp_replace(COALESCE(text, ''), '[\x00-\x7f]', '', 'g') AS foreign_text,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         list_filter(regexp_split_to_array(lower(COALESCE(text, '')), '\s+'), lambda x: x <> '') AS lowered,
         CASE lang {_WORD_LISTS} ELSE [] END AS common
  FROM documents),
marked AS (SELECT *, list_transform(common, lambda w: len(list_filter(lowered, lambda x: x = w OR (len(x) = len(w) + 1 AND starts_with(x, w) AND right(x, 1) IN (',', '.', ';', ':'))))) AS hits FROM docs),
spread AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
windows AS (SELECT doc_id, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o] AS w, lead(word, 2) OVER o AS last FROM spread WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
counted AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, w) AS n FROM windows WHERE last IS NOT NULL),
repeats AS (SELECT doc_id, COUNT(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM counted WHERE n > 1) GROUP BY doc_id),
base AS (
  SELECT m.doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, CAST(COALESCE(list_sum(list_transform(words, lambda w: len(w))), 0) AS BIGINT) AS word_chars,
         CAST({_count('[#*$%&|<>]')} AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         COALESCE(r.n, 0) AS n_repeat_words, len(text) AS chars, {_class_counts()} AS classes,
         list_transform(range(1, {_MOST} + 1), lambda i: CAST(COALESCE(hits[i], 0) AS DOUBLE)) || [CASE WHEN len(common) = 0 THEN 0.0 ELSE CAST(len(lowered) - list_sum(hits) AS DOUBLE) END] AS common
  FROM marked m LEFT JOIN repeats r USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
sums AS (
  SELECT lang, kind, list(total ORDER BY i) AS reference FROM (
    SELECT lang, kind, i, SUM(x) AS total FROM (
      SELECT lang, 'classes' AS kind, unnest(classes) AS x, generate_subscripts(classes, 1) AS i FROM judged WHERE NOT base_failed
      UNION ALL SELECT lang, 'common', unnest(common), generate_subscripts(common, 1) FROM judged WHERE NOT base_failed) GROUP BY lang, kind, i)
  GROUP BY lang, kind),
shares AS (
  SELECT j.*, {_NORM.format('j.classes')} AS p1, {_NORM.format('a.reference')} AS q1, {_NORM.format('j.common')} AS p2, {_NORM.format('b.reference')} AS q2,
         list_sum(j.classes) > 0 AND list_sum(a.reference) > 0 AS has1, list_sum(j.common) > 0 AND list_sum(b.reference) > 0 AS has2
  FROM judged j LEFT JOIN sums a ON a.lang IS NOT DISTINCT FROM j.lang AND a.kind = 'classes' LEFT JOIN sums b ON b.lang IS NOT DISTINCT FROM j.lang AND b.kind = 'common'),
measured AS (SELECT *, CASE WHEN has1 THEN {_distance('p1', 'q1')} END AS char_distance, CASE WHEN has2 THEN {_distance('p2', 'q2')} END AS word_distance FROM shares)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT COALESCE(chars >= 200 AND char_distance > 0.18 + 2.0 / sqrt(greatest(chars, 1)), FALSE)
                       AND NOT COALESCE(n_words >= 50 AND word_distance > 0.25 + 1.2 / sqrt(greatest(n_words, 1)), FALSE) AS kept, char_distance, word_distance
FROM measured"""

#: letters of the keywords in either case
_KEYWORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_KEYWORDS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ALLOWED = [r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$", "(?i)example|sample|dummy|placeholder|changeme|your[-_]|xxxx|0123456789|abcdefgh",
            "^(sha(256|384|512)-)", "^/?([A-Za-z0-9_-]{1,15}/){3,}"]
#: a unit of 1 to 4 characters five times or more, and up to 3 characters
_REPEATED = ("len(list_filter(range(0, 16), lambda j: (len(hit) - j // 4) % (j % 4 + 1) = 0 AND (len(hit) - j // 4) // (j % 4 + 1) >= 5 "
             "AND left(hit, len(hit) - j // 4) = repeat(left(hit, j % 4 + 1), CAST((len(hit) - j // 4) // (j % 4 + 1) AS BIGINT)))) > 0")


def _found(kind: str, order: int, pattern: str, condition: str) -> str:
    """Matches of a pattern with their places: the pieces and the matches before each, added up."""
    return rf"""
  SELECT doc_id, '{kind}' AS kind, {order} AS ord, CAST(list_sum(list_transform(pieces[1:k], lambda x: len(x))) + COALESCE(list_sum(list_transform(hits[1:k - 1], lambda x: len(x))), 0) AS BIGINT) AS start, hit
  FROM (SELECT doc_id, pieces, hits, unnest(hits) AS hit, generate_subscripts(hits, 1) AS k
        FROM (SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS hits FROM docs))
  WHERE {condition}"""


def _random(window: int, bits: float, text: str) -> str:
    allowed = " OR ".join(f"regexp_matches(hit, '{p}')" for p in _ALLOWED)
    entropy = f"list_aggregate(string_split(substr({text}, CAST(i AS BIGINT), {window}), ''), 'entropy')"
    return f"NOT ({allowed} OR {_REPEATED}) AND list_max(list_transform(range(1, len(hit) - {window} + 2), lambda i: {entropy})) >= {bits}"


_SPANS = " UNION ALL ".join([
    _found("assign", 0, _ASSIGN, f"len(regexp_extract(hit, '{_ASSIGN}', 2)) >= 6"),
    _found("access", 1, "AKIA[A-Z0-9]+", "len(hit) >= 20"),
    _found("hex", 2, "[0-9a-f]+", "len(hit) >= 24"),
    _found("entropy_hex", 3, "[0-9A-Za-z]+", "regexp_full_match(hit, '[0-9A-Fa-f]{20,}') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Fa-f]') AND " + _random(20, 3.0, "lower(hit)")),
    _found("entropy_base64", 4, "[A-Za-z0-9+/_-]{24,}={0,2}", "regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') AND " + _random(24, 4.0, "hit")),
])

ORACLES["op3_secret_scans"] = rf"""
WITH docs AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
found AS ({_SPANS}),
named AS (SELECT *, kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(start + len(hit) AS VARCHAR) AS span FROM found)
SELECT d.doc_id, COUNT(*) FILTER (WHERE kind = 'assign') AS n_assign, COUNT(*) FILTER (WHERE kind = 'access') AS n_access, COUNT(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(COALESCE(string_agg(span, ',' ORDER BY start, ord) FILTER (WHERE ord < 3), '')) AS base_sha256, COALESCE(string_agg(span, ',' ORDER BY start, ord), '') AS spans
FROM docs d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id"""

ORACLES["op12_phrase_mining"] = r"""
WITH lowered AS (SELECT COALESCE(lang, 'und') AS lang, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
runs AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM worded, range(1, 6) AS sizes(m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, COUNT(*) AS c FROM runs GROUP BY lang, m, phrase HAVING COUNT(*) >= 100),
cuts AS (
  SELECT lang, m, phrase, c AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
  FROM f, range(1, 5) AS places(k) WHERE k < m),
inside AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[s:s + t - 1], ' ') AS phrase, MAX(c) AS longer
  FROM f, range(2, 5) AS lengths(t), range(1, 5) AS firsts(s) WHERE t < m AND s + t - 1 <= m GROUP BY ALL),
scored AS (
  SELECT c.lang, c.phrase, a, x.c AS l, y.c AS r, n, (1000 * CAST(a AS HUGEINT) * n) // (CAST(x.c AS HUGEINT) * y.c) AS score, k
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = tail JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT p.*, row_number() OVER (PARTITION BY p.lang ORDER BY score DESC, a DESC, p.phrase) AS rank
  FROM lowest p LEFT JOIN inside i ON i.lang = p.lang AND i.phrase = p.phrase WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""
