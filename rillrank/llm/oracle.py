"""SQL that gives the same rows as the queries, where SQL can express them."""

from __future__ import annotations

from rillrank.llm import licenses

_URLS = r"""
cut AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
),
canon AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '')
                      || regexp_replace(path, '(\.html)?/*$', '') END AS canonical
  FROM cut
)
"""

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TEMPLATES = ", ".join(f"({_text(name)}, {_text(notice)}, {size}, {licenses.step_of(size)}, {licenses.width_of(size)})"
                       for name, notice in licenses.TEMPLATES.items()
                       for size in [licenses.class_of(len(
                           "".join(c if c.isalnum() else " " for c in notice).split()))])

_LICENSE_SHINGLES = """
  SELECT {key}, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT {key}, regexp_extract_all(lower({text}), '[^\\x00-\\x08\\x0E-\\x1F\\x7F\\x09-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]+') AS w FROM {table}),
       unnest(range(1, greatest(len(w) - 3, 1))) AS t(i)
"""

#: name, pattern, score, context words; the first four in any text, the others by their score.
_PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0.9, "mail|contact|write"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0.7, "ip|address|host|server"),
    ("card", r"[0-9]([\x20-]?[0-9])+", 0.6, "card|visa|credit|payment|karte|tarjeta|carte"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|tel|call|mobile|fax"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b", 0.8, "iban|account|bank|konto|cuenta|compte"),
    ("us_ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 0.3, "ssn|social security"),
    ("local_phone", r"\b[0-9]{3}(?:[\x20.-]|\)\x20?)[0-9]{3}[\x20.-][0-9]{4}\b", 0.3, "phone|tel|call|mobile|fax|telefon"),
]
_PERSONAL_CUTS = " UNION ALL ".join(
    f"SELECT d, doc_id, {k} AS kind, regexp_extract_all(t, '{p}') AS found, string_split_regex(t, '{p}') AS gaps FROM texts"
    for k, (_, p, _, _) in enumerate(_PERSONAL))
_PERSONAL_KINDS = ", ".join(f"({k}, '{name}', {score}, '{context}')" for k, (name, _, score, context) in enumerate(_PERSONAL))

SQL: dict[str, str] = {
    "op1_license_scan": f"""
WITH templates(license, notice, size, step, width) AS (VALUES {_TEMPLATES}),
wanted AS MATERIALIZED (SELECT DISTINCT license, s FROM ({_LICENSE_SHINGLES.format(key='license', text='notice', table='templates')})),
held AS MATERIALIZED ({_LICENSE_SHINGLES.format(key='doc_id', text='coalesce(text, %s)' % "''", table='documents')}),
meets AS (SELECT h.doc_id, w.license, h.place, h.s FROM held h JOIN wanted w USING (s)),
windows AS (
  SELECT m.doc_id, m.license, k * t.step AS start, count(DISTINCT m.s) AS n
  FROM meets m JOIN templates t USING (license),
       unnest(range(greatest(0, CAST(ceil((m.place - t.width + 1) / t.step) AS BIGINT)), m.place // t.step + 1)) AS u(k)
  GROUP BY ALL
),
shares AS (
  SELECT doc_id, license, start, n / t.all_of AS share
  FROM windows JOIN (SELECT license, count(*) AS all_of FROM wanted GROUP BY license) t USING (license)
  WHERE n / t.all_of >= 0.8
)
SELECT doc_id, license, max(share) AS containment, CAST(arg_max(start, share * 1e9 - start) AS BIGINT) AS first_word
FROM shares GROUP BY doc_id, license
""",
    "op3_substring_dedup": f"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS key
  FROM docs, unnest(range(1, len(w) - 48)) AS t(i)
),
firsts AS (SELECT key, min(doc_id) AS first FROM windows GROUP BY key),
late AS (SELECT doc_id, i FROM windows JOIN firsts USING (key) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM late, unnest(range(0, 50)) AS t(j)),
kept AS (
  SELECT d.doc_id, d.i, d.word
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs) d
  ANTI JOIN gone g ON d.doc_id = g.doc_id AND d.i = g.i
),
joined AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS rest FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN joined USING (doc_id)
""",
    "op4_near_dup": f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
  FROM docs, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.seen = e.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM docs d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
""",
    "op10_url_filters": f"""
WITH {_URLS},
rules(rule_verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
fitting AS (
  SELECT page_id, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM (SELECT DISTINCT page_id, host, path FROM canon) c
  JOIN rules r ON (c.host = r.rule_host OR c.host LIKE '%.' || r.rule_host) AND starts_with(c.path, r.rule_path)
),
flagged AS (
  SELECT *, canonical IN (SELECT canonical FROM canon WHERE page_id % 50 = 0 AND canonical IS NOT NULL) AS found
  FROM canon
)
SELECT f.page_id, f.host, f.path, g.rule,
       CASE WHEN g.rule IS NOT NULL THEN g.rule_verdict WHEN f.found THEN 'block' ELSE 'allow' END AS verdict,
       coalesce(f.found, false) AS listed
FROM flagged f LEFT JOIN fitting g ON f.page_id = g.page_id AND g.place = 1
""",
    "op11_ranked_search": f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents),
sized AS MATERIALIZED (SELECT d, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
whole AS MATERIALIZED (SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized),
asked AS MATERIALIZED (
  SELECT q, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS q, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
),
held AS MATERIALIZED (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * all_docs + 2) / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole
),
scored AS (
  SELECT a.q, a.item_id, s.doc_id,
         CAST(sum(a.times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM asked a JOIN weighed USING (term) JOIN held h USING (term) JOIN sized s ON s.d = h.d, whole
  GROUP BY a.q, a.item_id, s.d, s.doc_id
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
WHERE place <= 10
""",
    "op12_personal_data": rf"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS t FROM documents),
kinds(kind, name, least, context) AS (VALUES {_PERSONAL_KINDS}),
cut AS ({_PERSONAL_CUTS}),
matches AS (
  SELECT d, kind, i, found[i] AS m, gaps[i] AS gap, gaps[i + 1] AS after FROM cut, unnest(range(1, len(found) + 1)) AS u(i)
),
placed AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY d, kind ORDER BY i) AS stop,
         regexp_replace(m, '[^0-9]', '', 'g') AS digits, replace(m, ' ', '') AS code,
         translate(right(gap, 40) || ' | ' || left(after, 40), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS near
  FROM matches
),
judged AS (
  SELECT d, kind, name, stop - length(m) AS start, stop,
         CASE kind
           WHEN 1 THEN list_bool_and(list_transform(string_split(m, '.'), lambda x: coalesce(TRY_CAST(x AS BIGINT) <= 255, false)))
           WHEN 2 THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda j:
                CASE WHEN j % 2 = 1 THEN CAST(digits[length(digits) - j + 1] AS INT)
                     ELSE (2 * CAST(digits[length(digits) - j + 1] AS INT)) // 10 + (2 * CAST(digits[length(digits) - j + 1] AS INT)) % 10
                END)) % 10 = 0
           WHEN 3 THEN length(digits) BETWEEN 9 AND 15
           WHEN 4 THEN length(code) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(
                string_split(code[5:] || code[1:4], ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)),
                lambda a, v: CASE WHEN v > 9 THEN (a * 100 + v) % 97 ELSE (a * 10 + v) % 97 END) = 1
           ELSE true END AS good,
         least + CASE WHEN regexp_matches(near, '(?:^|[^a-z])(?:' || context || ')') THEN 0.4 ELSE 0 END AS score
  FROM placed JOIN kinds USING (kind)
),
sides AS (
  SELECT *, max(CASE WHEN kind < 4 AND good THEN stop END) OVER (PARTITION BY d ORDER BY start, stop, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach,
         min(CASE WHEN kind < 4 AND good THEN start END) OVER (PARTITION BY d ORDER BY start, stop, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS entry
  FROM judged
),
kept AS (
  SELECT *, name || ':' || start || ':' || stop AS span FROM sides
  WHERE good AND (kind < 4 OR kind = 4 OR (score >= 0.6 AND coalesce(reach <= start, true) AND coalesce(entry >= stop, true)))
),
joined AS (
  SELECT d, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card,
         count(*) FILTER (kind = 3) AS n_phone, string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 4) AS base,
         string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM kept GROUP BY d
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (d)
""",
}
