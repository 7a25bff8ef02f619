"""DuckDB SQL for the registered queries that SQL can express, written from their definitions."""

from __future__ import annotations

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
), w AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS response,
    array_to_string(list_transform(string_split(digest, ''), lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', c) - 1) + 1, 4)), '') AS bits
  FROM p
)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(5), lambda j: CASE WHEN substr(bits, (i + j + 1)::INT, 1) = '1' THEN (16 >> j::INT) ELSE 0 END))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < response THEN response END AS refers_to
FROM w
"""


#: The rules of the secret scan, stated anew: kind, pattern, group, characters it needs.
RULES = (
    (
        "assign",
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("forge", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("webtoken", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+", 0, 1),
    ("private", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secrets_sql() -> str:
    scans = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS rank, {quoted(kind)} AS kind, {least} AS least, "
        f"regexp_extract_all(body, {quoted(pattern)}, 0) AS found, "
        f"regexp_extract_all(body, {quoted(pattern)}, {group}) AS counted, "
        f"string_split_regex(body, {quoted(pattern)}) AS gaps FROM d"
        for n, (kind, pattern, group, least) in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents), scans AS ({scans}),
numbered AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM scans),
spans AS (
  SELECT doc_id, rank, kind, begins, begins + length(found[i]) AS ends FROM (
    SELECT *, (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))::BIGINT AS begins
    FROM numbered WHERE length(counted[i]) >= least
  )
),
grouped AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || begins || ':' || ends, ',' ORDER BY begins, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || begins || ':' || ends, ',' ORDER BY begins, rank) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN grouped USING (doc_id)
"""


def licences_sql() -> str:
    from colloquy.llm.licences import COPYRIGHT, KNOWN, SIGNS, SPELLINGS

    plain = f"trim(regexp_replace(x, {quoted(SIGNS)}, ' ', 'g'))"
    for spelling, taken in SPELLINGS:
        plain = f"replace({plain}, {quoted(spelling)}, {quoted(taken)})"
    lines = f"list_transform(string_split(lower(coalesce(text, '')), chr(10)), lambda x: CASE WHEN regexp_matches(x, {quoted(COPYRIGHT)}) THEN '' ELSE {plain} END)"
    whole = "array_to_string(list_filter(lines, lambda x: x <> ''), ' ')"
    known = ", ".join(f"({quoted(licence)}, {quoted(text)})" for licence, text in KNOWN)
    return f"""
WITH known AS (
  SELECT digest, min(licence) AS licence FROM (
    SELECT licence, sha256({whole}) AS digest FROM (SELECT licence, {lines} AS lines FROM (VALUES {known}) v(licence, text))
  ) GROUP BY digest
),
d AS (SELECT doc_id, {lines} AS lines FROM documents),
units AS (
  SELECT doc_id, -1 AS line, {whole} AS plain FROM d
  UNION ALL SELECT doc_id, i - 1 AS line, lines[i] AS plain FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
),
found AS (SELECT doc_id, line, licence FROM units JOIN known ON sha256(plain) = digest WHERE plain <> '')
SELECT d.doc_id, min(licence) FILTER (line = -1) AS licence, count(line) FILTER (line >= 0) AS n_notices,
  coalesce(string_agg(line || ':' || licence, ',' ORDER BY line) FILTER (line >= 0), '') AS notices
FROM (SELECT DISTINCT doc_id FROM d) d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_secrets": secrets_sql(), "op5_warc": WARC, "op8_licences": licences_sql()}
