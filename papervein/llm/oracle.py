"""DuckDB counterparts of the queries that SQL can express on whole tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 by a table: a CTE ``crc(t)`` with the 256 entries, and the check sum of a list of bytes.
_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t
)"""
_CRC = "xor(list_reduce({}, lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295)"
# The UTF-8 bytes of a string of characters below U+0800.
_BYTES = """flatten(list_transform(string_split({}, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
    ELSE [192 + unicode(ch)::BIGINT // 64, 128 + unicode(ch)::BIGINT % 64] END))"""


def _offers(after: str, *offers: tuple[str, int, str, str, str]) -> str:
    """The best of the ways into a state; each offer: state before, cost, edits, lines added, condition."""
    ways = ", ".join(
        f"CASE WHEN {before}.cost IS NOT NULL AND ({when}) THEN "
        f"{{'cost': {before}.cost + {cost}, 'audit': {before}.audit || '{edits}', 'lines': {before}.lines || {lines}}} END"
        for before, cost, edits, lines, when in offers
    )
    return f"list_sort(list_filter([{ways}], lambda x: x IS NOT NULL))[1] AS {after}"


def _programme() -> str:
    """One row's step of the least-cost programme, over whole edit strings."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    own, as_user, as_assistant = "chr(10) || role || ':' || txt", f"{user} || txt", f"{assistant} || txt"

    def into(after, role_line, initial, kept, changed, insert_line):
        ways = [(after, 2, "D", "''", "TRUE")]
        for before in kept:
            ways.append((before, "extra", "K", own, f"stays AND initial = '{initial}'"))
        for before in changed:
            ways.append((before, "extra + 1", "R", role_line, "stays"))
        # An insertion first: from the states that the inserted turn may follow.
        inserted_before = {"u": ["s2"], "a": ["s0", "s1", "s3"]}[initial]
        for before in inserted_before:
            ways.append((before, "extra + 5", "IK", f"{insert_line} || {own}", f"stays AND initial = '{initial}'"))
            ways.append((before, "extra + 6", "IR", f"{insert_line} || {role_line}", "stays"))
        for before in {"u": ["s0", "s1", "s3"], "a": ["s2"]}[initial]:
            ways.append((before, 7, "ID", {"u": user, "a": assistant}[initial], "TRUE"))
        return _offers(after, *ways)

    return ", ".join((
        _offers("s0", ("s0", 2, "D", "''", "TRUE")),
        _offers("s1", ("s1", 2, "D", "''", "TRUE"), ("s0", "extra", "K", own, "stays AND initial = 's'")),
        into("s2", as_user, "u", ("s0", "s1", "s3"), ("s0", "s1", "s3"), assistant),
        into("s3", as_assistant, "a", ("s2",), ("s2",), user),
    ))


ORACLE: dict[str, str] = {
    "op6_decontamination": rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), lengths AS (SELECT DISTINCT least(10, len(w)) AS k FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS t
  FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS u(i) WHERE len(w) > 0
), places AS (
  SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS t
  FROM d, lengths, unnest(range(1, len(w) - k + 2)) AS u(i)
), found AS (SELECT r, i, k, item_id FROM places JOIN windows USING (k, t)
), hits AS (
  SELECT r, count(DISTINCT j) AS n_hit
  FROM (SELECT DISTINCT r, i, k FROM found), unnest(range(i, i + k)) AS u(j) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS t FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
""",
    "op7_warc": """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS h FROM pages
), m AS (SELECT h, max(page_id) AS holder FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> holder THEN holder END AS refers_to, TRUE AS valid
FROM p LEFT JOIN m USING (h)
""",
    "op8_lm_scoring": rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), t AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d
), q AS (SELECT r, i, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS v FROM t
), one AS (SELECT w, count(*) AS c FROM t GROUP BY w
), one_own AS (SELECT r, w, count(*) AS c FROM t GROUP BY r, w
), two AS (SELECT v, w, count(*) AS c FROM q WHERE v IS NOT NULL GROUP BY v, w
), two_own AS (SELECT r, v, w, count(*) AS c FROM q WHERE v IS NOT NULL GROUP BY r, v, w
), n AS (SELECT count(*) AS n FROM t
), s AS (
  SELECT q.r, q.i, one.c - one_own.c AS single, coalesce(two.c - two_own.c, 0) AS double, b.c - b_own.c AS before,
         greatest(n.n - len(d.ws), 1) AS others
  FROM q JOIN d USING (r) CROSS JOIN n
  JOIN one ON one.w = q.w JOIN one_own ON one_own.r = q.r AND one_own.w = q.w
  LEFT JOIN two ON two.v = q.v AND two.w = q.w LEFT JOIN two_own ON two_own.r = q.r AND two_own.v = q.v AND two_own.w = q.w
  LEFT JOIN one b ON b.w = q.v LEFT JOIN one_own b_own ON b_own.r = q.r AND b_own.w = q.v
), l AS (
  SELECT r, count(*) FILTER (WHERE double = 0 AND i > 1) AS n_backoff,
         sum(ln(CASE WHEN double > 0 THEN double / CAST(before AS DOUBLE)
                     ELSE CASE WHEN i = 1 THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END
                          * CASE WHEN single > 0 THEN CAST(single AS DOUBLE) ELSE 0.4::DOUBLE END / others END)) AS log_score
  FROM s GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_backoff, 0) AS BIGINT) AS n_backoff,
       round(coalesce(log_score, 0.0::DOUBLE), 3) AS log_score
FROM d LEFT JOIN l USING (r)
""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run
), coded AS (SELECT run, n, {_CRC.format(_BYTES.format("id || ':' || run"))} AS h FROM counted, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER))
                || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM coded)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(i)
), near AS (
  SELECT DISTINCT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN words b ON b.word = a.rest
  UNION SELECT b.word, a.word FROM cut a JOIN words b ON b.word = a.rest
), ranked AS (
  SELECT near.word, other, w.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, encode(other)) AS r
  FROM near JOIN words w ON w.word = near.other
), formed AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
         CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN ranked ON ranked.word = words.word AND r = 1
), chain AS (
  SELECT word, form AS later FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.later WHERE f.form IS NOT NULL
), ends AS (SELECT chain.word, chain.later FROM chain JOIN formed f ON f.word = chain.later WHERE f.form IS NULL)
SELECT formed.word, form, coalesce(later, formed.word) AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM formed LEFT JOIN ends ON ends.word = formed.word
""",
    "op12_conversation_repair": rf"""
WITH RECURSIVE {_CRC_TABLE}, filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format(_BYTES.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"))} % 20 AS kind
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS txt
  FROM filled, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)
), told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY turn NULLS FIRST) AS nth FROM damaged
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(txt), nth) AS i,
         rtrim(txt, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM told
), faulty AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN shown = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
           WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed
), ready AS (
  SELECT conv_id, i, role, txt, initial, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS stays,
         CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM faulty
), best AS (
  SELECT DISTINCT conv_id, 1::BIGINT AS i, {{'cost': 0, 'audit': '', 'lines': ''}} AS s0,
         NULL::STRUCT(cost INTEGER, audit VARCHAR, lines VARCHAR) AS s1, NULL::STRUCT(cost INTEGER, audit VARCHAR, lines VARCHAR) AS s2,
         NULL::STRUCT(cost INTEGER, audit VARCHAR, lines VARCHAR) AS s3 FROM ready
  UNION ALL
  SELECT best.conv_id, best.i + 1, {_programme()}
  FROM best JOIN ready ON ready.conv_id IS NOT DISTINCT FROM best.conv_id AND ready.i = best.i
), chosen AS (
  SELECT conv_id, list_sort(list_filter([s0, s3, CASE WHEN s2.cost IS NOT NULL THEN
           {{'cost': s2.cost + 5, 'audit': s2.audit || 'I', 'lines': s2.lines || chr(10) || 'assistant:'}} END],
           lambda x: x.cost IS NOT NULL))[1] AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS last FROM best) WHERE last = 1
), sums AS (
  SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(c.cost, 0)::BIGINT AS cost,
       coalesce(c.audit, '') AS audit, sha256(substr(coalesce(c.lines, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN chosen ON chosen.conv_id IS NOT DISTINCT FROM ids.conv_id
""",
}
