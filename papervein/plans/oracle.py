"""SQL for another engine that gives the same rows as each registered query.

The statements are put together from named common table expressions, written against the
given tables with their own means: window functions for offsets, joins on joined tokens
for phrases, a recursive query for connected points.
"""

from __future__ import annotations

from papervein import config
from papervein.config import GRADE_PATTERNS, MEASUREMENT_PATTERNS, Config, TokenPattern, TokenTest
from papervein.functions.prices import THICKNESS_PATTERNS
from papervein.plans import fixtures, views

CFG = Config()
SPACES = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
MAX_PHRASE = 6
# The token grammar, stated again for this engine.
TOKEN = (
    r"W[0-9]+(?:[.][0-9]+)?/[0-9]+k?|wt%|mass%|[0-9]{2}[A-Z]+[0-9][0-9A-Za-z]*|[0-9]{2}[A-SUVX-Z]\b"
    r"|[0-9]+(?:[.][0-9]+)?|\p{L}[\p{L}\p{N}_]*|[^\s]"
)
PIECE = f"(?:{TOKEN}) ?"
SELECTED = "(1, 4, 7)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows) -> str:
    def cell(v):
        return text(v) if isinstance(v, str) else str(v)

    return "VALUES " + ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)


def texts(items) -> str:
    return ", ".join(map(text, items))


def clean(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{SPACES}', ' ', 'g'))"


# ---- literature and relevance ------------------------------------------------


def _pick(sentences) -> str:
    return f"([{texts(sentences)}])[doc_id % {len(sentences)} + 1]"


_POOLS = (
    fixtures.GRADE_SENTENCES, fixtures.USE_SENTENCES, fixtures.STRENGTH_SENTENCES,
    fixtures.SUBJECT_SENTENCES,
)
_TABLE = (
    "'Sheet strength ' || 10 + doc_id % 85 || 'MPa' || chr(10) || 180 + doc_id % 700 || 'MPa |' || chr(9) || 200 + doc_id % 500 "
    "|| chr(10) || 'MPa loss ' || 1 + doc_id % 97 || 'W/kg ' || 2 + doc_id % 7 || '.' || doc_id % 10 || ' W/kg at 1.' "
    "|| doc_id % 10 || 'T and 15T code 50A' || 210 + doc_id % 790 || chr(10) || doc_id % 7 || '.' || doc_id % 10 || ' % Si'"
)
LITERATURE = f"""literature AS (
  SELECT doc_id, '/corpus/' || source || '/' || doc_id || ' - 50% a+b.txt' AS source_path,
         CASE WHEN lang <> 'es' THEN CAST(1985 + doc_id % 41 AS INTEGER) END AS year,
         {clean("concat_ws(' ', text, " + ", ".join(map(_pick, _POOLS)) + ", " + _TABLE + ")")} AS text
  FROM documents)"""
_HITS = " + ".join(
    f"CAST(contains(low, {text(term.lower())}) AS INTEGER)" for term in CFG.domain_terms
)
TAGGED = f"""tagged AS (
  SELECT *, hits >= {CFG.relevance_threshold} AS is_relevant
  FROM (SELECT *, {_HITS} AS hits FROM (SELECT *, lower(text) AS low FROM literature)))"""
RELEVANT = "relevant AS (SELECT doc_id, year, text, hits FROM tagged WHERE is_relevant)"
CLEAN = f"clean_documents AS (SELECT doc_id, {clean('text')} AS text FROM documents)"


_HEAD = "'^([^ ]+)'", "'^([^ ]+ [^ ]+)'"
LARGE_LIST = [
    f"""heads AS (
  SELECT DISTINCT unnest([{", ".join(f"regexp_extract(line, {h}, 1)" for h in _HEAD)}]) AS term
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))""",
    "large_terms AS (SELECT lower(term) AS term, count(*) AS times FROM heads WHERE trim(term) <> '' GROUP BY lower(term))",
    "large_hits AS (SELECT doc_id, sum(times) AS n FROM documents JOIN large_terms ON contains(lower(text), term) GROUP BY doc_id)",
]


# ---- learnt sentence bounds ----------------------------------------------------

ABBREVIATED = f"""abbreviated AS (
  SELECT doc_id, {clean("concat_ws(' ', " + _pick(fixtures.ABBREVIATED_SENTENCES) + ", text, "
                        + _pick(fixtures.ABBREVIATED_SENTENCES[1:]) + ")")} AS text FROM documents)"""
_WORD_PIECE = r"""'^[(\["'']*(\p{L}[\p{L}.''-]*?)(\.?)[,;:)\]"''!?]*$'"""


def _n_log(n: str, p: str) -> str:
    return f"(CASE WHEN {n} = 0 THEN 0.0::DOUBLE ELSE ({n}) * ln({p}) END)"


def _ratio(parts, bound) -> str:
    return f"-2.0::DOUBLE * (({' + '.join(_n_log(*x) for x in parts)}) - ({' + '.join(_n_log(*x) for x in bound)}))"


_BREAK_COUNTS = ("ab", "a - ab", "b - ab", "n - a - b + ab")
LEARNT = [
    ABBREVIATED,
    f"""word_rows AS (
  SELECT lower(regexp_extract(p, {_WORD_PIECE}, 1)) AS word, CASE WHEN regexp_extract(p, {_WORD_PIECE}, 2) = '.' THEN 1 ELSE 0 END AS kind
  FROM (SELECT unnest(string_split(text, ' ')) AS p FROM abbreviated)
  UNION ALL
  SELECT lower(unnest(regexp_extract_all(text, '[.!?] (\\p{{Lu}}[\\p{{L}}-]*)', 1))), 2 FROM abbreviated)""",
    """word_sums AS (
  SELECT word, count(*) FILTER (kind = 1) AS n_stop, count(*) FILTER (kind = 0) AS n_plain, count(*) FILTER (kind = 2) AS n_open
  FROM word_rows WHERE word <> '' GROUP BY word)""",
    """word_totals AS (
  SELECT sum(n_stop)::DOUBLE AS s, sum(n_stop + n_plain)::DOUBLE AS n, sum(n_open)::DOUBLE AS a FROM word_sums)""",
    f"""abbreviation_rows AS (
  SELECT word, n_stop, n_plain, round({_ratio((("ns", "share"), ("np", "(1 - share)")), (("ns", "0.99::DOUBLE"), ("np", "(1 - 0.99::DOUBLE)")))}
           * exp(-letters) * (length(word) - letters + 1) * pow(letters, -np), 6) AS score
  FROM (SELECT *, n_stop::DOUBLE AS ns, n_plain::DOUBLE AS np, length(replace(word, '.', ''))::DOUBLE AS letters,
               (SELECT s / n FROM word_totals) AS share FROM word_sums WHERE n_stop >= 5))""",
    "known_abbreviations AS (SELECT * FROM abbreviation_rows WHERE score >= 0.3)",
    f"""opener_rows AS (
  SELECT word, n_open, b::BIGINT AS n_all, round({_ratio(
      tuple(zip(_BREAK_COUNTS, ("b / n", "(1 - b / n)", "b / n", "(1 - b / n)"))),
      tuple(zip(_BREAK_COUNTS, ("ab / a", "(1 - ab / a)", "((b - ab) / (n - a))", "(1 - (b - ab) / (n - a))"))))}, 4) AS score
  FROM (SELECT word, n_open, n_open::DOUBLE AS ab, (n_stop + n_plain)::DOUBLE AS b, n, a FROM word_sums, word_totals)
  WHERE ab >= 5 AND ab <= b AND b < n AND n > a AND n / a > b / ab)""",
    "known_openers AS (SELECT * FROM opener_rows WHERE score >= 30)",
]


def learnt_sentence_ctes() -> list[str]:
    raw = sentence_ctes("abbreviated")[:2]
    return LEARNT + raw + [
        r"""ended AS (
  SELECT *, lower(regexp_extract(sentence, '(?:^|[ (\["''])(\p{L}[\p{L}.''-]*)\. $', 1)) AS last_word,
         lower(regexp_extract(lead(sentence) OVER (PARTITION BY doc_id ORDER BY sent_id), '^(\p{Lu}[\p{L}-]*)', 1)) AS next_word
  FROM cut)""",
        """held AS (
  SELECT *, last_word IN (SELECT word FROM known_abbreviations)
            AND coalesce(next_word, '') NOT IN (SELECT word FROM known_openers) AS goes_on FROM ended)""",
        """numbered_parts AS (
  SELECT doc_id, sent_id, sentence, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY sent_id)
           - CASE WHEN goes_on THEN 0 ELSE 1 END AS sentence_no FROM held)""",
        """learnt_parts AS (
  SELECT doc_id, sentence_no AS sent_id, string_agg(sentence, '' ORDER BY sent_id) AS sentence FROM numbered_parts GROUP BY doc_id, sentence_no)""",
        """sentence_rows AS (
  SELECT doc_id, sent_id, sentence,
         sum(length(sentence)) OVER (PARTITION BY doc_id ORDER BY sent_id) - length(sentence) AS sent_start
  FROM learnt_parts WHERE sentence <> '')""",
    ]


# ---- tokens and mentions -----------------------------------------------------


def sentence_ctes(source: str) -> list[str]:
    return [
        f"""parts AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?]) ([\\p{{Lu}}\\p{{Nd}}])',
    '\\1 ' || chr(1) || '\\2', 'g'), chr(1)) AS p FROM {source})""",
        """cut AS (SELECT doc_id, unnest(p) AS sentence, unnest(range(len(p))) AS sent_id FROM parts)""",
        """sentence_rows AS (
  SELECT doc_id, sent_id, sentence,
         sum(length(sentence)) OVER (PARTITION BY doc_id ORDER BY sent_id) - length(sentence) AS sent_start
  FROM cut WHERE sentence <> '')""",
    ]


def token_ctes(source: str, cut: list[str] | None = None) -> list[str]:
    """Tokens of the sentences of ``source``, or of those that ``cut`` gives."""
    return (cut or sentence_ctes(source)) + [
        f"""pieces AS (
  SELECT doc_id, sent_id, sentence, sent_start, unnest(p) AS piece, unnest(range(len(p))) AS token_id
  FROM (SELECT *, regexp_extract_all(sentence, '{PIECE}') AS p FROM sentence_rows))""",
        """token_rows AS (
  SELECT doc_id, sent_id, sentence, sent_start, token_id, rtrim(piece) AS token,
         sent_start + before AS start_char, sent_start + before + length(rtrim(piece)) AS end_char
  FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, sent_id ORDER BY token_id) - length(piece)
          AS before FROM pieces))""",
    ]


_WINDOW = "ahead AS (SELECT *, " + ", ".join(
    f"lead(token, {i}) OVER w AS t{i}, lead(end_char, {i}) OVER w AS e{i}" for i in range(MAX_PHRASE)
) + " FROM token_rows WINDOW w AS (PARTITION BY doc_id, sent_id ORDER BY token_id))"


def _test(column: str, test: TokenTest) -> str:
    if test.text is not None:
        return f"{column} = {text(test.text)}"
    if test.regex is not None:
        return f"regexp_matches({column}, {text(test.regex)})"
    if test.one_of is not None:
        return f"{column} IN ({texts(test.one_of)})"
    return f"lower({column}) IN ({texts(test.lower_in)})"


_SPAN = """SELECT doc_id, sent_id, sentence, {label} AS label, {n} AS n_tokens, start_char,
  e{last} AS end_char,
  substring(sentence, CAST(start_char - sent_start AS BIGINT) + 1, CAST(e{last} - start_char AS BIGINT))
    AS entity_text FROM ahead"""


def _pattern_select(pattern: TokenPattern) -> str:
    tests = " AND ".join(_test(f"t{i}", t) for i, t in enumerate(pattern.tests))
    n = pattern.n_tokens
    return _SPAN.format(label=text(pattern.label), n=n, last=n - 1) + f" WHERE {tests}"


def _phrase_select(n: int) -> str:
    key = " || chr(1) || ".join(f"t{i}" for i in range(n))
    return (
        _SPAN.format(label="phrases.label", n=n, last=n - 1)
        + f" JOIN phrases ON phrases.n = {n} AND phrases.key = {key}"
    )


PHRASES = f"""phrases AS (
  SELECT DISTINCT label, len(p) AS n, array_to_string(p, chr(1)) AS key
  FROM (SELECT label, regexp_extract_all(term, '{TOKEN}') AS p
        FROM ({values(fixtures.LEXICON)}) lexicon(label, term)))"""


def span_ctes(source: str, patterns, lexicon: bool, cut: list[str] | None = None) -> list[str]:
    selects = [_pattern_select(p) for p in patterns]
    if lexicon:
        selects += [_phrase_select(n) for n in range(1, MAX_PHRASE + 1)]
    return [
        *token_ctes(source, cut), _WINDOW, *([PHRASES] if lexicon else []),
        "spans AS (" + " UNION ALL ".join(selects) + ")",
    ]


_TRIGGER = r"(^|[^\p{L}\p{N}_])(non-oriented|non-grain-oriented|ngo)($|[^\p{L}\p{N}_])"


def entity_ctes(source: str, cut: list[str] | None = None) -> list[str]:
    kind = "STRUCT(r INTEGER, s BIGINT, l VARCHAR, e BIGINT, t VARCHAR)"
    return span_ctes(source, CFG.patterns, True, cut) + [
        f"""grouped AS (
  SELECT doc_id, sent_id, any_value(sentence) AS sentence,
         list_sort(list(DISTINCT CAST({{'r': -n_tokens, 's': start_char, 'l': label, 'e': end_char,
           't': entity_text}} AS {kind}))) AS c
  FROM spans GROUP BY doc_id, sent_id)""",
        f"""kept AS (
  SELECT doc_id, sentence, list_reduce(c, lambda acc, x:
    CASE WHEN len(list_filter(acc, lambda y: y.s < x.e AND x.s < y.e)) > 0 THEN acc
         ELSE list_append(acc, x) END, CAST([] AS {kind}[])) AS k
  FROM grouped)""",
        f"""flat AS (
  SELECT doc_id, trim(sentence) AS context,
         regexp_matches(lower(sentence), '{_TRIGGER}') AS ngo,
         len(list_filter(k, lambda y: y.l IN ({texts(CFG.competitor_labels)}))) > 0 AS rival,
         unnest(k) AS m FROM kept)""",
        f"""entities AS (
  SELECT doc_id, m.t AS entity_text, m.l AS label,
         CASE WHEN m.l NOT IN ({texts(CFG.target_labels)}) THEN NULL
              WHEN ngo AND rival THEN 'AMBIGUOUS' WHEN ngo THEN 'NGO'
              WHEN rival THEN 'COMPETITOR' ELSE 'UNSPECIFIED' END AS scope_tag,
         context, CAST(m.s AS INTEGER) AS start_char, CAST(m.e AS INTEGER) AS end_char
  FROM flat)""",
    ]


# ---- normalisation -----------------------------------------------------------


def _case(column: str, table: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in table.items())
    return f"CASE {column} {whens} END"


_UNITS = texts(CFG.units)
_ALIASES = [("COMPETING_MATERIAL", *pair) for pair in config.COMPETITOR_ALIASES.items()] + [
    ("APPLICATION", *pair) for pair in config.APPLICATION_ALIASES.items()
]
_BOUNDS = [(name, *bounds) for name, bounds in config.PROPERTY_BOUNDS.items()]
NORMALISED = [
    f"""valued AS (
  SELECT *, CASE WHEN label IN ({_UNITS}) AND NOT regexp_matches(entity_text, '^[WB][0-9]')
    THEN TRY_CAST(regexp_extract(entity_text, '^([0-9.]+)', 1) AS DOUBLE) END AS value_numeric,
    lower(context) AS low
  FROM entities WHERE label IN ({texts(CFG.domain_labels)}))""",
    f"""united AS (
  SELECT *, CASE WHEN label IN ({_UNITS}) THEN
      CASE WHEN regexp_matches(entity_text, '^[WB][0-9]') THEN 'notation'
           WHEN value_numeric IS NOT NULL THEN {_case("label", CFG.units)} END END AS unit,
    CASE WHEN label = 'MPA_VALUE' THEN
      CASE WHEN contains(low, 'yield') THEN 'yield_strength'
           WHEN contains(low, 'tensile') AND contains(low, 'strength') THEN 'tensile_strength'
           WHEN (contains(low, 'applied') OR contains(low, 'residual') OR contains(low, 'compressive')
                 OR contains(low, 'tensile')) AND contains(low, 'stress') THEN 'applied_stress'
           WHEN contains(low, 'tension') OR contains(low, 'compression') OR contains(low, 'compressive')
             THEN 'applied_stress'
           ELSE 'unspecified' END END AS resolved_property
  FROM valued)""",
    f"""normalised AS (
  SELECT u.doc_id, u.entity_text, u.label, u.scope_tag, u.context, u.start_char, u.end_char,
         u.value_numeric, u.unit,
         CASE WHEN value_numeric IS NOT NULL AND unit <> 'notation'
              THEN CAST(value_numeric AS VARCHAR) || ' ' || unit ELSE entity_text END AS canonical_form,
         u.resolved_property,
         CASE WHEN value_numeric < b.low OR value_numeric > b.high THEN 'out_of_range' END AS review_flag,
         coalesce(a.canonical, entity_text) AS canonical_entity,
         CASE WHEN u.label = 'APPLICATION' THEN
           CASE WHEN lower(trim(coalesce(a.canonical, entity_text))) IN ({texts(CFG.component_terms)})
                THEN 'component' ELSE 'application' END END AS subtype
  FROM united u
  LEFT JOIN ({values(_BOUNDS)}) b(property, low, high) ON b.property = u.resolved_property
  LEFT JOIN ({values(_ALIASES)}) a(label, surface, canonical)
    ON a.label = u.label AND a.surface = lower(trim(u.entity_text)))""",
]

BASE = [LITERATURE, TAGGED, RELEVANT]
ENTITIES = BASE + entity_ctes("relevant")
NORMAL = ENTITIES + NORMALISED


def with_(ctes: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


# ---- prices ------------------------------------------------------------------

_DIGITS = ", ".join(
    f"nullif(regexp_extract(upper(trim(entity_text)), {text(p)}, 1), '')" for p in THICKNESS_PATTERNS
)
BRIDGE = NORMAL + [
    f"""thick AS (
  SELECT n.*, r.cost_role,
         CASE WHEN n.label IN ({texts(CFG.priced_labels)})
              THEN TRY_CAST(coalesce({_DIGITS}) AS DOUBLE) / 100.0::DOUBLE END AS thickness_mm
  FROM normalised n JOIN ({values(config.COST_ROLES.items())}) r(label, cost_role) ON r.label = n.label)""",
    f"""bridge AS (
  SELECT doc_id, entity_text, label, value_numeric, unit, scope_tag, resolved_property, cost_role,
         thickness_mm, start_char,
         CASE WHEN thickness_mm > 0 THEN round({CFG.price_constant}::DOUBLE / thickness_mm, 3) END
           AS relative_price_eur_kg
  FROM thick)""",
    "parsed AS (SELECT * FROM bridge WHERE thickness_mm IS NOT NULL)",
]

# ---- trends ------------------------------------------------------------------


def bucket(year: str = "year") -> str:
    return (
        f"CAST({CFG.start_year} + floor(({year} - {CFG.start_year}) / {float(CFG.period_years)}) "
        f"* {CFG.period_years} AS INTEGER)"
    )


def label_of(start: str = "bucket") -> str:
    return f"{start} || '-' || ({start} + {CFG.period_years - 1})"


def dated(name: str, rows: str, years: str) -> str:
    return f"""{name} AS (
  SELECT *, {label_of()} AS bucket_label
  FROM (SELECT r.*, y.year, {bucket('y.year')} AS bucket
        FROM ({rows}) r JOIN {years} y ON y.doc_id = r.doc_id WHERE y.year IS NOT NULL))"""


def counts(rows: str, category: str, years: str, mode: str = "docs", name: str = "counts") -> list[str]:
    measure = "count(DISTINCT doc_id)" if mode == "docs" else "count(*)"
    return [
        dated(f"{name}_rows", rows, years),
        f"""{name} AS (
  SELECT bucket, bucket_label, {category}, {measure} AS n FROM {name}_rows GROUP BY ALL)""",
    ]


def matrix(category: str, source: str = "counts", suffix: str = "") -> str:
    columns = ", ".join(
        f"CAST(coalesce(sum(n) FILTER (bucket_label = '{label}'), 0) AS BIGINT) AS \"{label}{suffix}\""
        for label in CFG.period_labels
    )
    return f"SELECT {category}, {columns} FROM {source} GROUP BY {category}"


def top(category: str, n: int, source: str = "counts") -> str:
    on_spine = f"CASE WHEN bucket_label IN ({texts(CFG.period_labels)}) THEN n ELSE 0 END"
    return (
        matrix(category, source).replace(
            " FROM ", f", CAST(sum({on_spine}) AS BIGINT) AS total FROM ", 1
        )
        + f" ORDER BY total DESC, {category} LIMIT {n}"
    )


COMPETITORS = "SELECT * FROM normalised WHERE label = 'COMPETING_MATERIAL'"
FOCUS = "SELECT * FROM normalised WHERE label IN ('COMPETING_MATERIAL', 'APPLICATION')"
SUBTYPE = "SELECT * FROM normalised WHERE label = 'APPLICATION' AND subtype = '{}'"

# ---- units and topics --------------------------------------------------------


def chunk_cte(source: str) -> str:
    size = CFG.chunk_chars
    return f"""chunks AS (
  SELECT doc_id, chunk_start, doc_id || '_chunk_' || chunk_start AS unit_id, chunk AS text
  FROM (SELECT doc_id, chunk_start, substring(text, chunk_start + 1, {size}) AS chunk
        FROM (SELECT doc_id, text, unnest(range(0, length(text), {size})) AS chunk_start FROM {source}))
  WHERE length(chunk) >= {CFG.chunk_min_chars})"""


TOPICS = [
    CLEAN, chunk_cte("clean_documents"),
    f"""units AS (
  SELECT *, CAST((doc_id + chunk_start // {CFG.chunk_chars}) % 11 - 1 AS INTEGER) AS topic FROM chunks)""",
]
WEIGHTS = TOPICS + [
    r"""term_counts AS (
  SELECT topic, term, count(*) AS tf
  FROM (SELECT topic, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM units)
  GROUP BY topic, term)""",
    "mean_words AS (SELECT sum(tf)::DOUBLE / count(DISTINCT topic) AS a FROM term_counts)",
    """weights AS (
  SELECT topic, term, tf, round(tf * ln(1.0::DOUBLE + (SELECT a FROM mean_words) / total), 6) AS weight
  FROM (SELECT *, sum(tf) OVER (PARTITION BY term)::BIGINT AS total FROM term_counts))""",
]
_AXES = []
for d in range(CFG.reduced_dims):
    signs = [f"{'-' if i % 2 else '+'} v[{i + 1}]" for i in range(64) if (i // 2) % CFG.reduced_dims == d]
    _AXES.append(f"(0.0::DOUBLE {' '.join(signs)})")
_APART = " + ".join(f"(a.v[{i + 1}] - b.v[{i + 1}]) * (a.v[{i + 1}] - b.v[{i + 1}])" for i in range(CFG.reduced_dims))
# All pairs of points within the radius; nothing here knows of cells.
DENSITY = [
    """pushed AS (
  SELECT vec_id, label, list_transform(embedding, lambda x, i: x::DOUBLE
    + CASE WHEN vec_id % 10 <> 0 AND i = label + 1 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END) AS p
  FROM embeddings)""",
    """scaled AS (
  SELECT vec_id, label, list_transform(p, lambda x: x / len_p) AS v
  FROM (SELECT *, sqrt(list_reduce(p, lambda a, x: a + x * x, 0.0::DOUBLE)) AS len_p FROM pushed))""",
    f"points AS (SELECT vec_id, label, [{', '.join(_AXES)}] AS v FROM scaled)",
    f"""close AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM points a JOIN points b
  ON {_APART} <= {views.RADIUS}::DOUBLE * {views.RADIUS}::DOUBLE)""",
    f"core AS (SELECT a AS vec_id FROM close GROUP BY a HAVING count(*) >= {views.MIN_POINTS})",
    "links AS (SELECT a, b FROM close WHERE a IN (SELECT vec_id FROM core) AND b IN (SELECT vec_id FROM core))",
    """reach AS (
  SELECT vec_id AS start, vec_id FROM core
  UNION SELECT r.start, l.b FROM reach r JOIN links l ON l.a = r.vec_id)""",
    "component AS (SELECT start AS vec_id, min(vec_id) AS root FROM reach GROUP BY start)",
    f"""sized AS (
  SELECT root, count(*) AS size, min(v) AS first FROM component JOIN points USING (vec_id) GROUP BY root
  HAVING count(*) >= {CFG.min_topic_size})""",
    "numbered AS (SELECT root, row_number() OVER (ORDER BY size DESC, first) - 1 AS topic FROM sized)",
]

# All pairs of distinct vectors.
NEIGHBOURS = DENSITY[:2] + [
    "distinct_vectors AS (SELECT v, min(vec_id) AS id FROM scaled GROUP BY v)",
    f"""ranked_pairs AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, neighbour) AS rank FROM (
    SELECT a.id, b.id AS neighbour, {" + ".join(f"a.v[{i}] * b.v[{i}]" for i in range(1, 65))} AS similarity
    FROM distinct_vectors a JOIN distinct_vectors b ON a.id <> b.id))""",
    f"neighbour_rows AS (SELECT * FROM ranked_pairs WHERE rank <= {views.NEIGHBOURS})",
]
# Kruskal's way: the edges in order, with a list of the component of every point.
FOREST = NEIGHBOURS + [
    "apart AS (SELECT id, neighbour, round(sqrt(greatest(0.0::DOUBLE, 2.0::DOUBLE - 2.0::DOUBLE * similarity)), 9) AS d FROM neighbour_rows)",
    f"""core_of AS (
  SELECT id, max(d) AS core FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS r FROM apart)
  WHERE r <= {views.CORE_NEIGHBOURS} GROUP BY id)""",
    """mutual AS (
  SELECT least(apart.id, neighbour) AS u, greatest(apart.id, neighbour) AS v, min(greatest(d, a.core, coalesce(b.core, a.core))) AS w
  FROM apart JOIN core_of a ON a.id = apart.id LEFT JOIN core_of b ON b.id = neighbour GROUP BY ALL)""",
    "place_of AS (SELECT id, row_number() OVER (ORDER BY id) AS p FROM (SELECT u AS id FROM mutual UNION SELECT v FROM mutual))",
    """in_order AS (
  SELECT u, v, w, a.p AS a, b.p AS b, row_number() OVER (ORDER BY w, u, v) AS i
  FROM mutual JOIN place_of a ON a.id = u JOIN place_of b ON b.id = v)""",
    """grown AS (
  SELECT 0::BIGINT AS i, (SELECT list(p ORDER BY p) FROM place_of) AS comp, FALSE AS kept
  UNION ALL
  SELECT o.i, CASE WHEN comp[a] = comp[b] THEN comp
                   ELSE list_transform(comp, lambda x: CASE WHEN x = comp[b] THEN comp[a] ELSE x END) END, comp[a] <> comp[b]
  FROM grown JOIN in_order o ON o.i = grown.i + 1)""",
    "forest AS (SELECT u, v, w FROM grown JOIN in_order USING (i) WHERE kept)",
]
FOREST_TOPICS = FOREST + [
    "ends AS (SELECT u AS x, v AS y, w FROM forest UNION ALL SELECT v, u, w FROM forest)",
    # For each edge and side: the edges within two steps that do not lead over the edge itself.
    """one_side AS (
  SELECT e.x, e.y, avg(n.w) AS scale FROM ends e JOIN (
    SELECT x AS here, y AS first, w FROM ends
    UNION ALL SELECT a.x, a.y, b.w FROM ends a JOIN ends b ON b.x = a.y AND b.y <> a.x) n ON n.here = e.x AND n.first <> e.y
  GROUP BY e.x, e.y)""",
    f"""held_edges AS (
  SELECT f.u, f.v FROM forest f LEFT JOIN one_side a ON a.x = f.u AND a.y = f.v LEFT JOIN one_side b ON b.x = f.v AND b.y = f.u
  WHERE coalesce(greatest(a.scale, b.scale), a.scale, b.scale) IS NULL
     OR w <= {views.CUT_FACTOR}::DOUBLE * coalesce(greatest(a.scale, b.scale), a.scale, b.scale))""",
    """steps AS (SELECT u AS a, v AS b FROM held_edges UNION ALL SELECT v, u FROM held_edges)""",
    """wander AS (
  SELECT id AS start, id FROM distinct_vectors UNION SELECT w.start, s.b FROM wander w JOIN steps s ON s.a = w.id)""",
    "part AS (SELECT start AS id, min(id) AS root FROM wander GROUP BY start)",
    f"""numbered_parts AS (
  SELECT root, row_number() OVER (ORDER BY count(*) DESC, root) - 1 AS topic FROM part GROUP BY root
  HAVING count(*) >= {CFG.min_topic_size})""",
]

# ---- corpus ------------------------------------------------------------------

_PATH = "'/corpus/' || source || '/' || documents.doc_id || ' - 50% a+b.txt'"
_ATTACHMENT = "'/corpus/' || source || '/' || doc_id || ' - 50% a+b' || CASE WHEN doc_id % 2 = 0 THEN '.pdf' ELSE '.txt' END"
_STEM = "regexp_replace({}, '[.](pdf|txt)$', '', 'i')"
INGEST = [
    f"""raw_pages AS (
  SELECT {_PATH} AS source_path, text AS page_text FROM documents
  UNION ALL SELECT '/corpus/unread/u' || item_id || '.txt', NULL FROM benchmark)""",
    f"""ingested AS (
  SELECT md5(source_path) AS doc_id, source_path,
         {clean("array_to_string(string_split(page_text, chr(10)), ' ')")} AS text
  FROM raw_pages)""",
]
DECODED = """decoded AS (
  SELECT '/web/' || page_id || '.html' AS source_path, CASE WHEN html LIKE '%</html>' THEN regexp_extract_all(html, '<p>([^<]*)', 1) END AS pages,
         CASE WHEN html IS NULL THEN 'ValueError: no content' WHEN html NOT LIKE '%</html>' THEN 'ValueError: the page is cut off' END AS error
  FROM pages UNION ALL SELECT '/web/none/' || doc_id || '.html', NULL, 'ValueError: no content' FROM labels WHERE toxic = 1)"""
BIBLIOGRAPHY = f"""bibliography AS (
  SELECT doc_id AS ordinal, {_ATTACHMENT} AS attachment,
         (1985 + doc_id % 41) || '.0' AS year FROM documents JOIN labels USING (doc_id)
  UNION ALL
  SELECT doc_id + 1000000000, {_ATTACHMENT},
         CASE WHEN quality = 1 THEN (1986 + doc_id % 41)::VARCHAR END
  FROM documents JOIN labels USING (doc_id)
  UNION ALL
  SELECT item_id, '/corpus/bench/b' || item_id || '.txt', '2001' FROM benchmark)"""
YEARS = [
    BIBLIOGRAPHY,
    f"""all_years AS (
  SELECT {_STEM.format("regexp_extract(attachment, '[^/]*$')")} AS stem, 0 AS source, ordinal, year
  FROM bibliography WHERE attachment IS NOT NULL AND year IS NOT NULL
  UNION ALL
  SELECT doc_id || ' - 50% a+b', 1, doc_id, (1990 + doc_id % 30)::VARCHAR FROM labels WHERE toxic = 1)""",
    """years AS (
  SELECT stem, CAST(floor(TRY_CAST(year AS DOUBLE)) AS INTEGER) AS year FROM all_years
  QUALIFY row_number() OVER (PARTITION BY stem ORDER BY source DESC, ordinal DESC) = 1)""",
]
DATED_DOCS = INGEST + YEARS + [
    f"""dated_documents AS (
  SELECT i.*, regexp_extract(source_path, '[^/]*$') AS filename, y.year
  FROM ingested i LEFT JOIN years y ON y.stem = {_STEM.format("regexp_extract(source_path, '[^/]*$')")})"""
]
_WORDS = f"len(list_filter(string_split_regex(text, '{SPACES}'), lambda w: w <> ''))"
TOKEN_COUNTS = f"token_counts AS (SELECT doc_id, {_WORDS} AS token_count FROM documents)"
LINE_LABELS = [
    (f"src{i}", label) for i, label in enumerate(
        ("APPLICATION", "COMPETING_MATERIAL", "PRODUCER", "PROCESSING", "STANDARD")
    )
]

_RANK = f"md5('{CFG.seed}|' || doc_id || '|' || start_char), doc_id, start_char"
_SPAN_OUT = """SELECT DISTINCT doc_id, label, CAST(start_char AS INTEGER) AS start_char,
  CAST(end_char AS INTEGER) AS end_char, entity_text FROM spans"""
_PER_PERIOD = dated("doc_rows", "SELECT doc_id FROM {src}", "{src}") + """,
per_period AS (SELECT bucket, bucket_label, count(DISTINCT doc_id) AS n_docs FROM doc_rows GROUP BY ALL)"""
_ON_SPINE = texts(CFG.period_labels)
_SENSITIVITY = ", ".join(
    f"thickness_mm * {f}::DOUBLE AS thick_{n}, {CFG.price_constant}::DOUBLE / (thickness_mm * {f}::DOUBLE) AS price_{n}, "
    f"(({CFG.price_constant}::DOUBLE / (thickness_mm * {f}::DOUBLE)) / ({CFG.price_constant}::DOUBLE / thickness_mm) - 1) * 100 AS pct_change_{n}"
    for n, f in (("plus10", 1.1), ("minus10", 0.9))
)

_TOP_SHARES = f"""SELECT c.bucket_label, canonical_entity, n, total::BIGINT AS total, (running - n)::BIGINT AS "offset", n_docs,
  CASE WHEN n / total::DOUBLE * 100 >= 1 THEN round_even(n / total::DOUBLE * 100, 0)::INTEGER END AS pct
FROM (SELECT *, sum(n) OVER (PARTITION BY bucket) AS total,
        sum(n) OVER (PARTITION BY bucket ORDER BY canonical_entity ROWS UNBOUNDED PRECEDING) AS running
      FROM counts WHERE bucket_label IN ({_ON_SPINE}) AND canonical_entity IN (SELECT canonical_entity FROM best)) c
LEFT JOIN per_period p ON p.bucket = c.bucket"""
_TOPIC_NAMES = """SELECT topic, topic || '_' || string_agg(term, '_' ORDER BY weight DESC, term) AS name
  FROM (SELECT * FROM weights QUALIFY row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) <= 4)
  GROUP BY topic"""

ORACLE: dict[str, str] = {
    "ingest_documents": with_(INGEST, f"""SELECT doc_id, source_path, text, 'paper' AS source_type,
      'fulltext' AS text_source, 'local_pdf_zotero' AS origin, NULL::VARCHAR AS title,
      NULL::VARCHAR AS doi, '{views.INGEST_DATE}' AS ingest_date FROM ingested"""),
    "ingest_summary": with_(DATED_DOCS, """SELECT count(*) AS total, count(text) AS extracted,
      count(*) FILTER (text IS NULL) AS failed, count(*) FILTER (year IS NULL) AS missing_years
      FROM dated_documents"""),
    "year_lookup": with_(YEARS, "SELECT stem, year FROM years"),
    "documents_with_year": with_(DATED_DOCS, "SELECT doc_id, source_path, filename, year FROM dated_documents"),
    "missing_years": with_(DATED_DOCS, "SELECT filename FROM dated_documents WHERE year IS NULL"),
    "bibliography_gaps": with_(INGEST + [BIBLIOGRAPHY, f"""files AS (
      SELECT DISTINCT regexp_extract(source_path, '[^/]*$') AS filename, {_STEM.format("filename")} AS stem FROM ingested)""",
      f"""entries AS (
      SELECT DISTINCT regexp_extract(attachment, '[^/]*$') AS filename, {_STEM.format("filename")} AS stem FROM bibliography)"""],
      """SELECT filename, 'not_in_bibliography' AS gap FROM files WHERE stem NOT IN (SELECT stem FROM entries)
      UNION ALL SELECT filename, 'file_absent' FROM entries WHERE stem NOT IN (SELECT stem FROM files)"""),
    "corpus_tokens": with_([TOKEN_COUNTS], "SELECT * FROM token_counts ORDER BY token_count DESC, doc_id"),
    "corpus_token_summary": with_([TOKEN_COUNTS], """SELECT sum(token_count)::BIGINT AS total_tokens,
      round(avg(token_count), 6) AS mean_tokens, min(token_count) AS min_tokens, max(token_count) AS max_tokens
      FROM token_counts"""),
    "lexicon_counts": f"""SELECT label, count(*) AS n_terms
      FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) d
      JOIN ({values(LINE_LABELS)}) l(source, label) ON l.source = d.source
      WHERE {clean('line')} <> '' GROUP BY label""",
    "relevance_hits": with_(BASE, "SELECT doc_id, hits AS domain_term_hits FROM tagged"),
    "relevance_tag": with_(BASE, """SELECT CASE WHEN is_relevant THEN 'KEEP' ELSE 'DROP' END AS status,
      hits AS domain_term_hits, regexp_extract(source_path, '[^/]*$') AS document FROM tagged"""),
    "relevance_summary": with_(BASE, """SELECT count(*) AS total, count(*) FILTER (is_relevant) AS relevant,
      count(*) FILTER (NOT is_relevant) AS not_relevant FROM tagged"""),
    "relevant_documents": with_(BASE, "SELECT doc_id, year, hits AS domain_term_hits FROM relevant"),
    "tokens": with_([CLEAN, *token_ctes("clean_documents")], """SELECT doc_id, sent_id::INTEGER AS sent_id,
      token_id::INTEGER AS token_id, token, start_char::INTEGER AS start_char, end_char::INTEGER AS end_char
      FROM token_rows"""),
    "relevance_hits_large": with_(LARGE_LIST, """SELECT doc_id, coalesce(n, 0)::INTEGER AS domain_term_hits
      FROM documents LEFT JOIN large_hits USING (doc_id)"""),
    "abbreviation_words": with_(LEARNT, "SELECT * FROM known_abbreviations"),
    "sentence_openers": with_(LEARNT, "SELECT word, n_open, n_all AS n, score FROM known_openers"),
    "sentences_learnt": with_(learnt_sentence_ctes(), """SELECT doc_id, sent_id::INTEGER AS sent_id,
      sent_start::INTEGER AS sent_start, sentence FROM sentence_rows"""),
    "scope_tags_learnt": with_(entity_ctes("abbreviated", learnt_sentence_ctes()),
      "SELECT doc_id, start_char, label, scope_tag, context FROM entities WHERE scope_tag IS NOT NULL"),
    "lexicon_term_counts": with_([CLEAN, *token_ctes("clean_documents"), LARGE_LIST[0], f"""long_phrases AS (
      SELECT DISTINCT len(p) AS n, array_to_string(p, chr(1)) AS key FROM (
        SELECT regexp_extract_all({clean("term")}, '{TOKEN}') AS p FROM heads WHERE trim(term) <> '') WHERE len(p) > 0)""",
      """told AS (
      SELECT doc_id, sent_id, any_value(sentence) AS sentence, any_value(sent_start) AS sent_start, list(token ORDER BY token_id) AS t,
             list(start_char ORDER BY token_id) AS s, list(end_char ORDER BY token_id) AS e FROM token_rows GROUP BY doc_id, sent_id)""",
      """runs AS (
      SELECT doc_id, sentence, s[i] - sent_start AS a, e[i + n - 1] - s[i] AS size, array_to_string(t[i : i + n - 1], chr(1)) AS key, n
      FROM told, unnest(range(1, len(t) + 1)) AS u(i), (SELECT DISTINCT n FROM long_phrases) AS k(n) WHERE i + n - 1 <= len(t))""",
      """met AS (
      SELECT doc_id, substring(sentence, a::BIGINT + 1, size::BIGINT) AS entity_text FROM runs JOIN long_phrases USING (n, key))"""],
      "SELECT entity_text, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM met GROUP BY entity_text"),
    "sentences": with_([CLEAN, *sentence_ctes("clean_documents")], """SELECT doc_id, sent_id::INTEGER AS sent_id,
      sent_start::INTEGER AS sent_start, sentence FROM sentence_rows"""),
    "grade_mentions": with_([LITERATURE, *span_ctes("literature", GRADE_PATTERNS, False)], _SPAN_OUT),
    "measure_mentions": with_([LITERATURE, *span_ctes("literature", MEASUREMENT_PATTERNS, False)], _SPAN_OUT),
    "lexicon_mentions": with_([LITERATURE, *span_ctes("literature", (), True)], _SPAN_OUT),
    "resolved_mentions": with_([LITERATURE, *entity_ctes("literature")],
      "SELECT doc_id, start_char, end_char, label, entity_text FROM entities"),
    "entity_table": with_(ENTITIES, "SELECT * FROM entities"),
    "scope_tags": with_(ENTITIES, "SELECT doc_id, start_char, label, scope_tag FROM entities WHERE scope_tag IS NOT NULL"),
    "scoped_mentions": with_(ENTITIES, f"""SELECT doc_id, entity_text, label, scope_tag, context FROM entities
      WHERE label IN ({texts(CFG.target_labels)})"""),
    "entity_preview": with_(ENTITIES, """SELECT * FROM entities
      WHERE doc_id IN (SELECT doc_id FROM relevant ORDER BY doc_id LIMIT 2)"""),
    "label_counts": with_(ENTITIES, "SELECT label, count(*) AS n FROM entities GROUP BY label"),
    "scope_counts": with_(ENTITIES, """SELECT scope_tag, count(*) AS n FROM entities
      WHERE scope_tag IS NOT NULL GROUP BY scope_tag"""),
    "entities_per_document": with_(ENTITIES, """SELECT doc_id, count(*) AS entity_count FROM entities
      GROUP BY doc_id ORDER BY entity_count DESC, doc_id"""),
    "zero_mention_documents": with_([LITERATURE, CLEAN, """mixed AS (
      SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN c.text ELSE l.text END AS text
      FROM literature l JOIN clean_documents c USING (doc_id))""", *entity_ctes("mixed")],
      "SELECT doc_id FROM mixed WHERE doc_id NOT IN (SELECT doc_id FROM entities)"),
    "distinct_measures": with_(ENTITIES, f"""SELECT DISTINCT label, entity_text FROM entities
      WHERE label IN ({_UNITS}) ORDER BY label, entity_text"""),
    "domain_mentions": with_(ENTITIES, f"""SELECT doc_id, start_char, label, entity_text FROM entities
      WHERE label IN ({texts(CFG.domain_labels)})"""),
    "normalised_mentions": with_(NORMAL, "SELECT * FROM normalised"),
    "parsed_values": with_(NORMAL, "SELECT doc_id, start_char, label, entity_text, value_numeric, unit FROM normalised"),
    "canonical_forms": with_(NORMAL, "SELECT doc_id, start_char, label, entity_text, canonical_form FROM normalised"),
    "resolved_properties": with_(NORMAL, """SELECT doc_id, start_char, label, entity_text, resolved_property
      FROM normalised WHERE label = 'MPA_VALUE'"""),
    "review_flags": with_(NORMAL, """SELECT doc_id, start_char, label, entity_text, resolved_property,
      value_numeric, review_flag FROM normalised WHERE review_flag IS NOT NULL"""),
    "canonical_entities": with_(NORMAL, "SELECT doc_id, start_char, label, entity_text, canonical_entity FROM normalised"),
    "subtypes": with_(NORMAL, """SELECT doc_id, start_char, label, entity_text, canonical_entity, subtype
      FROM normalised WHERE subtype IS NOT NULL"""),
    "alias_pairs": with_(NORMAL, f"SELECT DISTINCT label, entity_text, canonical_entity FROM ({FOCUS})"),
    "subtype_members": with_(NORMAL, """SELECT DISTINCT subtype, canonical_entity FROM normalised
      WHERE label = 'APPLICATION'"""),
    "label_samples": with_(NORMAL, """SELECT doc_id, start_char, label, entity_text, canonical_form FROM normalised
      QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id, start_char) <= 2"""),
    "value_preview": with_(NORMAL, """SELECT doc_id, start_char, entity_text, label, value_numeric, unit
      FROM normalised WHERE value_numeric IS NOT NULL ORDER BY doc_id, start_char LIMIT 10"""),
    "document_units": with_(BASE, "SELECT doc_id, doc_id::VARCHAR AS unit_id, text FROM relevant"),
    "chunk_units": with_(BASE + [chunk_cte("relevant")], "SELECT doc_id, unit_id, text FROM chunks"),
    "neighbour_graph": with_(NEIGHBOURS, """SELECT s.vec_id AS id, d.id AS point, rank::INTEGER AS rank, neighbour, round(similarity, 6) AS similarity
      FROM scaled s JOIN distinct_vectors d ON d.v = s.v JOIN neighbour_rows n ON n.id = d.id"""),
    "spanning_forest": with_(FOREST, "SELECT * FROM forest"),
    "forest_topics": with_(FOREST_TOPICS, """SELECT s.vec_id, s.label, coalesce(topic, -1)::INTEGER AS topic
      FROM scaled s JOIN distinct_vectors d ON d.v = s.v JOIN part ON part.id = d.id LEFT JOIN numbered_parts USING (root)"""),
    "unit_preview": with_(BASE + [chunk_cte("relevant")], "SELECT unit_id, text FROM chunks ORDER BY doc_id, chunk_start LIMIT 2"),
    "decoded_documents": with_([DECODED], f"""SELECT source_path, len(pages)::INTEGER AS n_pages,
      {clean("array_to_string(pages, ' ')")} AS text, error FROM decoded"""),
    "decode_summary": with_([DECODED], "SELECT error, count(*) AS n FROM decoded GROUP BY error"),
    "unit_vectors": with_(BASE + [chunk_cte("relevant"), r"""indexed AS (
      SELECT unit_id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 262144 AS "index", count(*) AS tf
      FROM (SELECT unit_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM chunks) GROUP BY ALL)""",
      """raw_weights AS (
      SELECT unit_id, "index", tf * idf AS raw FROM indexed JOIN (
        SELECT "index", ln(((SELECT count(*) FROM chunks) + 1.0::DOUBLE) / (count(*) + 1)) AS idf FROM indexed GROUP BY "index")
      USING ("index"))"""],
      """SELECT unit_id, "index", round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY unit_id)), 6) AS weight
      FROM raw_weights WHERE raw <> 0"""),
    "chunk_summary": with_([CLEAN, chunk_cte("clean_documents")],
      "SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_units FROM chunks"),
    "topic_sizes": with_(TOPICS, "SELECT topic, count(*) AS n FROM units GROUP BY topic"),
    "topic_top_sizes": with_(TOPICS, f"""SELECT topic, count(*) AS n, topic IN {SELECTED} AS is_selected FROM units
      WHERE topic <> -1 GROUP BY topic ORDER BY n DESC, topic LIMIT 12"""),
    "ctfidf_terms": with_(WEIGHTS, "SELECT topic, term, tf, weight FROM weights"),
    "topic_labels": with_(WEIGHTS, """SELECT topic, n_units, topic || '_' || names AS name FROM
      (SELECT topic, string_agg(term, '_' ORDER BY weight DESC, term) AS names FROM
        (SELECT * FROM weights QUALIFY row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) <= 4)
       GROUP BY topic)
      JOIN (SELECT topic, count(*) AS n_units FROM units GROUP BY topic) USING (topic)"""),
    "density_topics": with_(DENSITY, """SELECT p.vec_id, p.label, coalesce(n.topic, -1)::INTEGER AS topic
      FROM points p LEFT JOIN component c ON c.vec_id = p.vec_id LEFT JOIN numbered n ON n.root = c.root"""),
    "period_spine": with_([LITERATURE, _PER_PERIOD.format(src="literature")], f"""SELECT s.bucket, {label_of('s.bucket')} AS bucket_label,
      s.bucket + {CFG.period_years - 1} > {CFG.end_year} AS is_partial, coalesce(n_docs, 0) AS n_docs
      FROM (SELECT unnest(range({CFG.start_year}, {CFG.end_year + 1}, {CFG.period_years}))::INTEGER AS bucket) s
      LEFT JOIN per_period p ON p.bucket = s.bucket ORDER BY s.bucket"""),
    "docs_per_bucket": with_(BASE + [_PER_PERIOD.format(src="relevant")], "SELECT * FROM per_period ORDER BY bucket"),
    "bucketed_mentions": with_(NORMAL + [dated("rows_", "SELECT doc_id, start_char, label FROM normalised", "relevant")],
      "SELECT * FROM rows_"),
    "prevalence_docs": with_(NORMAL + counts(FOCUS, "canonical_entity", "relevant"), "SELECT * FROM counts"),
    "prevalence_mentions": with_(NORMAL + counts(FOCUS, "canonical_entity", "relevant", "mentions"), "SELECT * FROM counts"),
    "competitor_trends": with_(NORMAL + counts(COMPETITORS, "canonical_entity", "relevant"), matrix("canonical_entity")),
    "application_trends": with_(NORMAL + counts(SUBTYPE.format("application"), "canonical_entity", "relevant"),
      matrix("canonical_entity")),
    "component_trends": with_(NORMAL + counts(SUBTYPE.format("component"), "canonical_entity", "relevant"),
      matrix("canonical_entity")),
    "application_top": with_(NORMAL + counts(SUBTYPE.format("application"), "canonical_entity", "relevant"),
      top("canonical_entity", 8)),
    "component_top": with_(NORMAL + counts(SUBTYPE.format("component"), "canonical_entity", "relevant"),
      top("canonical_entity", 8)),
    "entity_trends": with_(NORMAL + counts(FOCUS, "label", "relevant"), f"""SELECT {label_of('s.bucket')} AS bucket_label,
      coalesce(sum(n) FILTER (label = 'APPLICATION'), 0)::BIGINT AS "APPLICATION",
      coalesce(sum(n) FILTER (label = 'COMPETING_MATERIAL'), 0)::BIGINT AS "COMPETING_MATERIAL"
      FROM (SELECT unnest(range({CFG.start_year}, {CFG.end_year + 1}, {CFG.period_years}))::INTEGER AS bucket) s
      LEFT JOIN counts c ON c.bucket = s.bucket GROUP BY s.bucket"""),
    "period_shares": with_(NORMAL + counts(COMPETITORS, "canonical_entity", "relevant") + [_PER_PERIOD.format(src="relevant")],
      f"""SELECT c.bucket_label, canonical_entity, n, total::BIGINT AS total, (running - n)::BIGINT AS "offset", n_docs,
        CASE WHEN n / total::DOUBLE * 100 >= 1 THEN round_even(n / total::DOUBLE * 100, 0)::INTEGER END AS pct
      FROM (SELECT *, sum(n) OVER (PARTITION BY bucket) AS total,
              sum(n) OVER (PARTITION BY bucket ORDER BY canonical_entity ROWS UNBOUNDED PRECEDING) AS running
            FROM counts WHERE bucket_label IN ({_ON_SPINE})) c
      LEFT JOIN per_period p ON p.bucket = c.bucket"""),
    "application_shares": with_(NORMAL + counts(SUBTYPE.format("application"), "canonical_entity", "relevant")
      + [_PER_PERIOD.format(src="relevant"), f"best AS ({top('canonical_entity', 8)})"], _TOP_SHARES),
    "component_shares": with_(NORMAL + counts(SUBTYPE.format("component"), "canonical_entity", "relevant")
      + [_PER_PERIOD.format(src="relevant"), f"best AS ({top('canonical_entity', 8)})"], _TOP_SHARES),
    "topic_named_trends": with_([LITERATURE] + WEIGHTS + counts("SELECT * FROM units", "topic", "literature")
      + [f"trend AS ({matrix('topic')})", f"named AS ({_TOPIC_NAMES})"],
      "SELECT trend.*, named.name AS topic_name FROM trend LEFT JOIN named USING (topic)"),
    "unitisation_comparison": with_(NORMAL + counts(COMPETITORS, "label", "relevant", "docs", "d")
      + counts(COMPETITORS, "label", "relevant", "mentions", "m"),
      f"SELECT * FROM ({matrix('label', 'd', '_docs')}) JOIN ({matrix('label', 'm', '_mentions')}) USING (label)"),
    "topic_trends": with_([LITERATURE] + TOPICS + counts("SELECT * FROM units", "topic", "literature"), matrix("topic")),
    "topic_top_trends": with_([LITERATURE] + TOPICS + counts("SELECT * FROM units WHERE topic <> -1", "topic", "literature"),
      top("topic", 5)),
    "topic_selected_trends": with_([LITERATURE] + TOPICS
      + counts(f"SELECT * FROM units WHERE topic IN {SELECTED}", "topic", "literature"), matrix("topic")),
    "cost_bridge": with_(BRIDGE, "SELECT * EXCLUDE (start_char) FROM bridge"),
    "cost_role_counts": with_(BRIDGE, "SELECT cost_role, count(*) AS n FROM bridge GROUP BY cost_role"),
    "thickness_recall": with_(BRIDGE, f"""SELECT count(thickness_mm) AS parsed, count(*) AS total,
      round(count(thickness_mm) / count(*)::DOUBLE, 6) AS recall FROM bridge WHERE label IN ({texts(CFG.priced_labels)})"""),
    "unparsed_grades": with_(BRIDGE, f"""SELECT DISTINCT entity_text FROM bridge
      WHERE label IN ({texts(CFG.priced_labels)}) AND thickness_mm IS NULL"""),
    "grade_prices": with_(BRIDGE, """SELECT DISTINCT entity_text, thickness_mm, relative_price_eur_kg FROM parsed
      ORDER BY thickness_mm, entity_text"""),
    "thickness_groups": with_(BRIDGE, """SELECT thickness_mm, count(*) AS n_grades,
      arg_min(entity_text, (doc_id, start_char)) AS example, min(relative_price_eur_kg) AS price
      FROM parsed GROUP BY thickness_mm"""),
    "thickness_histogram": with_(BRIDGE, "SELECT thickness_mm, count(*) AS n FROM parsed GROUP BY 1 ORDER BY 1"),
    "price_stats": with_(BRIDGE, """SELECT count(*) AS n, count(DISTINCT thickness_mm) AS n_thickness,
      min(relative_price_eur_kg) AS min_price, max(relative_price_eur_kg) AS max_price,
      round(avg(relative_price_eur_kg), 6) AS mean_price, round(median(relative_price_eur_kg), 6) AS median_price,
      round(stddev_samp(relative_price_eur_kg), 6) AS std_price FROM parsed"""),
    "price_curve": with_(BRIDGE, f"""SELECT point, thickness_mm, {CFG.price_constant}::DOUBLE / thickness_mm AS price
      FROM (SELECT point::INTEGER AS point, low + point * ((high - low) / 199.0::DOUBLE) AS thickness_mm
            FROM (SELECT min(thickness_mm) * 0.9::DOUBLE AS low, max(thickness_mm) * 1.1::DOUBLE AS high,
                         unnest(range(200)) AS point FROM parsed))"""),
    "price_preview": with_(BRIDGE, """SELECT DISTINCT entity_text, thickness_mm, relative_price_eur_kg FROM parsed
      ORDER BY entity_text LIMIT 5"""),
    "sensitivity_preview": with_(BRIDGE, f"""SELECT entity_text, thickness_mm,
      {CFG.price_constant}::DOUBLE / thickness_mm AS price_baseline, {_SENSITIVITY}
      FROM (SELECT DISTINCT entity_text, thickness_mm FROM parsed) ORDER BY entity_text LIMIT 10"""),
    "price_sensitivity": with_(BRIDGE, f"""SELECT entity_text, thickness_mm,
      {CFG.price_constant}::DOUBLE / thickness_mm AS price_baseline, {_SENSITIVITY}
      FROM (SELECT DISTINCT entity_text, thickness_mm FROM parsed)"""),
    "stratified_sample": with_(ENTITIES, f"""SELECT doc_id, entity_text, label, context, start_char, end_char FROM entities
      WHERE label IN ({texts(CFG.domain_labels)})
      QUALIFY row_number() OVER (PARTITION BY label ORDER BY {_RANK}) <= 25"""),
    "scope_sample": with_(ENTITIES, f"""SELECT "group", entity_text, label, scope_tag, context, start_char, end_char,
      NULL::VARCHAR AS table_or_prose
      FROM (SELECT *, CASE WHEN scope_tag = 'UNSPECIFIED' THEN 'UNSPECIFIED' ELSE 'RESOLVED' END AS "group"
            FROM entities WHERE scope_tag IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY "group" ORDER BY {_RANK}) <= 30"""),
    "annotation_precision": with_(ENTITIES, """SELECT label, count(*) FILTER (mark = 'Y') AS correct,
      count(*) FILTER (mark = 'N') AS wrong, count(*) FILTER (mark NOT IN ('Y', 'N')) AS not_scored,
      round(count(*) FILTER (mark = 'Y') / nullif(count(*) FILTER (mark IN ('Y', 'N')), 0)::DOUBLE, 6) AS precision
      FROM (SELECT label, CASE WHEN d < 'b' THEN 'Y' WHEN d < 'e' THEN 'N' ELSE 'n/a' END AS mark
            FROM (SELECT label, substring(md5(doc_id || '|' || start_char), 1, 1) AS d FROM entities))
      GROUP BY label"""),
}
