"""The registered queries once more as SQL for an independent engine.

Written from the rules, not from the library: other string functions, window and list
functions instead of aggregates, subsequence patterns instead of a match table.
"""

from __future__ import annotations

from fettle.functions.labels import (
    ACRONYM,
    AMBIGUOUS,
    ASSESS_COLUMN,
    CLOSE_BUT_CHECK,
    CONFIRM_BY_HAND,
    DROP_CANDIDATE,
    FILL_AND_FLAG,
    FULL_NAME,
    NOTHING_TO_DO,
    OTHER_CONTEXT,
    SAME_COMPACT,
    SIMPLE_FILL,
    STRONG_BUT_CHECK,
    TOO_DIFFERENT,
    VALIDATED_PREFIX,
)
from fettle.functions.nulls import NA_TOKENS
from fettle.functions.tokens import NOT_LOOKUPS, STOP_WORDS
from fettle.operators.evidence import METRIC_PATTERNS
from fettle.plans.grants import COLUMNS, grants_sql
from fettle.operators.policies import DEFAULT_POLICY, POLICIES
from fettle.plans.registry import (
    PREVIEW_COLUMNS,
    QUESTION,
    REPORT_QUESTION,
    SAMPLE_COLUMNS,
    TARGET,
    TERM,
)
from fettle.plans.views import (
    COPY_EVERY,
    COPY_OFFSET,
    FIGURES_TEXT,
    QUESTION_TEXT,
    SECTIONED_TEXT,
)

COLS = list(COLUMNS)
NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?))$"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(texts) -> str:
    return "(" + ", ".join(lit(t) for t in texts) + ")"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def fold(x: str) -> str:
    return f"lower(replace(CAST({x} AS varchar), 'ß', 'ss'))"


def contains(cols, term: str) -> str:
    return "(" + " OR ".join(
        f"coalesce(contains({fold(c)}, {lit(term.lower())}), false)" for c in cols
    ) + ")"


def norm(x: str) -> str:
    """Normal form; full for everyday Latin text."""
    return (
        f"trim(regexp_replace(regexp_replace(upper(strip_accents(replace(coalesce({x}, ''), 'ß', 'ss'))),"
        " '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
    )


def compact(x: str) -> str:
    return f"replace({norm(x)}, ' ', '')"


def segments(x: str) -> str:
    return (
        f"list_filter(list_transform(regexp_split_to_array({strip(x)}, '[|/]'),"
        f" lambda p: {strip('p')}), lambda p: p <> '')"
    )


def as_null(c: str, blanks: bool) -> str:
    blank = rf" OR regexp_full_match({c}, '\s*')" if blanks else ""
    return f"CASE WHEN {c} IN {lits(NA_TOKENS)}{blank} THEN NULL ELSE {c} END"


def nulled(source: str, blanks: bool) -> str:
    cells = ", ".join(f"{as_null(c, blanks)} AS {c}" for c in COLS)
    return f"SELECT row_number, {cells} FROM {source}"


GRANTS = f"grants AS ({grants_sql()})"
READ = f"{GRANTS}, read AS ({nulled('grants', False)})"
CLEAN = f"{GRANTS}, clean AS ({nulled('grants', True)})"

# Missing values

_counted = " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS col, count(*) FILTER (WHERE {c} IS NULL) AS n, count(*) AS total FROM clean"
    for i, c in enumerate(["row_number", *COLS])
)
MISSING = f"""{CLEAN}, counted AS ({_counted}),
missing AS (SELECT ordinal, col, n, total, n / total * 100 AS pct FROM counted)"""
REPORT = f"""{MISSING}, report AS (SELECT col AS colonne, n AS valeurs_manquantes, total AS total_lignes,
  round(pct, 2) AS pourcentage_manquant,
  CASE WHEN pct = 0 THEN {lit(NOTHING_TO_DO)} WHEN pct < 5 THEN {lit(SIMPLE_FILL)}
    WHEN pct <= 40 THEN {lit(FILL_AND_FLAG)} WHEN pct > 70 THEN {lit(DROP_CANDIDATE)}
    ELSE {lit(ASSESS_COLUMN)} END AS recommandation FROM missing)"""
WORST = "ORDER BY pourcentage_manquant DESC, valeurs_manquantes DESC, colonne"


def _plan() -> str:
    rows = [
        f"({lit(c)}, {lit(p.decision)}, {lit(p.treatment)}, {lit(p.reason)})"
        for p in POLICIES
        for c in p.columns
        if c != "recipient_postal_code"
    ]
    d = DEFAULT_POLICY
    return f"""WITH {MISSING}, policy(pcol, decision, treatment, why) AS (VALUES {', '.join(rows)})
SELECT col AS "column", format('{{:,}} ({{:.2f}}%)', n, round(pct, 2)) AS missing,
  coalesce(decision, {lit(d.decision)}) AS "recommended decision",
  coalesce(treatment, {lit(d.treatment)}) AS "exact future treatment",
  coalesce(why, {lit(d.reason)}) AS "business rationale"
FROM missing LEFT JOIN policy ON col = pcol WHERE n > 0"""


# Roles and types

_sample_cells = " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS col, CAST({c} AS varchar) AS raw FROM head"
    for i, c in enumerate(["row_number", *COLS])
)
STATS = rf"""{GRANTS}, head AS (SELECT * FROM grants ORDER BY row_number HEAD_ROWS),
cells AS (SELECT ordinal, col, {as_null('raw', False)} AS v FROM ({_sample_cells})),
shaped AS (SELECT ordinal, col, v, nullif({strip('v')}, '') AS shown,
  regexp_matches(v, '^[+-]?[0-9]+$') AS is_int, regexp_matches(v, '{NUMBER}') AS is_num FROM cells),
stats AS (SELECT ordinal, col, count(*) AS n, count(v) AS present, count(shown) AS shown,
  count(*) FILTER (WHERE is_int) AS ints, count(*) FILTER (WHERE is_num) AS nums,
  avg(CASE WHEN regexp_matches(shown, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}})$') THEN 1.0 WHEN shown IS NOT NULL THEN 0.0 END) AS dates,
  avg(CASE WHEN regexp_matches(regexp_replace(shown, '[,$ ]', '', 'g'), '{NUMBER}') THEN 1.0 WHEN shown IS NOT NULL THEN 0.0 END) AS numbers,
  median(length(shown)) AS len FROM shaped GROUP BY ordinal, col),
typed AS (SELECT *, CASE WHEN present = 0 THEN 'float64' WHEN ints = n THEN 'int64'
  WHEN nums = present THEN 'float64' ELSE 'object' END AS dtype FROM stats)"""

def _roles(head: str, name: str) -> str:
    return f"""WITH {STATS.replace("HEAD_ROWS", head)}, shown AS (SELECT *, CASE WHEN dtype = 'float64' THEN len + 2 ELSE len END AS l FROM typed)
SELECT col AS "column", CASE WHEN shown = 0 THEN 'text'
  WHEN {name} LIKE '%date%' AND dates >= 0.5 THEN 'date'
  WHEN {name} NOT LIKE '%date%' AND ({name} LIKE '%start%' OR {name} LIKE '%end%') AND dates >= 0.9 AND l >= 8 THEN 'date'
  WHEN numbers >= 0.9 AND {name} NOT LIKE '%name%' AND {name} NOT LIKE '%title%'
    AND {name} NOT LIKE '%description%' AND l <= 20 THEN 'numeric' ELSE 'text' END AS role FROM shown"""


# Duplicates

_KEYS = {
    "ref_number": [("ref_number", "ref_number")],
    "org_date_value": [
        ("org", "recipient_legal_name"),
        ("date", "agreement_start_date"),
        ("value", "agreement_value"),
    ],
    "org_city_postal": [
        ("org", "recipient_legal_name"),
        ("city", "recipient_city"),
        ("postal", "recipient_postal_code"),
    ],
}
_SHOWN = [
    "ref_number",
    "recipient_legal_name",
    "recipient_city",
    "recipient_postal_code",
    "agreement_start_date",
    "agreement_value",
]


def _key_rows(rule: str, source: str = "clean") -> str:
    parts = _KEYS[rule]
    key = " || '|' || ".join(f"'{label}=' || {strip(c)}" for label, c in parts)
    full = " AND ".join(f"{strip(c)} <> ''" for _, c in parts)
    return f"SELECT '{rule}' AS t, {key} AS k, row_number AS r FROM {source} WHERE {full}"


def _digest(cols) -> str:
    pieces = " || ".join(
        f"strlen(coalesce({c}, '')) || ':' || coalesce({c}, '')" for c in cols
    )
    return f"sha256({pieces})"


def _groups(keys: str) -> str:
    return f"groups AS (SELECT t, k, count(*) AS n, min(r) AS r FROM ({keys}) GROUP BY t, k HAVING count(*) > 1)"


def _sampled(source: str) -> str:
    shown = ", ".join(f"coalesce(c.{c}, '') AS sample_{c}" for c in _SHOWN)
    return f"""SELECT t AS duplicate_type, k AS duplicate_key, n AS duplicate_count,
  r AS sample_row_number, {shown} FROM groups JOIN {source} c ON c.row_number = r"""


def _dup(*rules: str) -> str:
    keys = " UNION ALL ".join(_key_rows(r) for r in rules)
    if len(rules) == len(_KEYS):
        exact = f"SELECT 'exact_row' AS t, {_digest(COLS)} AS k, row_number AS r FROM clean"
        keys = f"{keys} UNION ALL {exact}"
    return f"WITH {CLEAN}, {_groups(keys)} {_sampled('clean')}"


SUMMARY = f"{CLEAN}, {_groups(' UNION ALL '.join(_key_rows(r) for r in _KEYS))}"

# Names

VALUES = f"""{READ}, vals AS (SELECT {TARGET} AS o, count(*) AS c, min(row_number) AS f
  FROM read WHERE {TARGET} IS NOT NULL GROUP BY 1)"""
FORMS = f"""{VALUES}, parts AS (SELECT o, c, f, {segments('o')} AS seg FROM vals),
collapsed AS (SELECT o, c, f, CASE WHEN len(seg) > 1
    AND len(list_distinct(list_transform(seg, lambda p: {norm('p')}))) = 1
    THEN seg[1] ELSE {strip('o')} END AS cv FROM parts),
allforms AS (SELECT o, c, f, cv, {norm('o')} AS whole, {norm('cv')} AS nv FROM collapsed),
forms AS (SELECT o, c, f, cv, whole, nv, replace(nv, ' ', '') AS k, replace(whole, ' ', '') AS w
  FROM allforms WHERE nv <> '')"""
_ACCEPT = "nv IN ('UQAM', 'U Q A M', 'UNIVERSITE DU QUEBEC A MONTREAL')"
_REVIEW = f"""(nv IN ('AQAM', 'QAM', 'COOP UQAM')
  OR (length(k) <= 12 AND k LIKE '%QAM%' AND NOT {_ACCEPT}))"""
GROUPS = f"""{FORMS}, flagged AS (SELECT *, {_ACCEPT} AS acc, {_REVIEW} AS rev FROM forms),
grouped AS (SELECT *, count(*) OVER (PARTITION BY k) AS members,
  first_value(o) OVER best AS canonical, first_value(length(w)) OVER best AS canonical_length,
  bool_or(acc) OVER (PARTITION BY k) AS has_alias FROM flagged
  WINDOW best AS (PARTITION BY k ORDER BY c DESC, length(whole), whole, f))"""
# A common subsequence with the label is the longest part of the label found in both texts.
_label = "UQAM"
_subs = sorted(
    {"".join(ch for i, ch in enumerate(_label) if m >> i & 1) for m in range(1, 2 ** len(_label))}
)
_sub_rows = ", ".join(f"({lit(s)}, {lit('%' + '%'.join(s) + '%')})" for s in _subs)
SCORED = f"""{GROUPS}, admitted AS (SELECT *,
    CASE WHEN acc THEN 'UQAM' WHEN members > 1 THEN CASE WHEN has_alias THEN 'UQAM' ELSE canonical END
      ELSE 'UQAM' END AS suggested,
    NOT acc AND (CASE WHEN members > 1 THEN has_alias ELSE true END) AND k <> 'UQAM' AS general
  FROM grouped WHERE acc OR members > 1 OR rev),
subs(s, p) AS (VALUES {_sub_rows}),
words AS (SELECT DISTINCT w FROM admitted WHERE general),
lcs AS (SELECT w, max(length(s)) AS m FROM words, subs WHERE w LIKE p GROUP BY w),
pairs AS (
  SELECT w, substr(w, greatest(i, 1), 4 - greatest(1 - i, 0)) AS a, 'UQAM' AS b
  FROM (SELECT w, unnest(range(-2, length(w) + 1)) AS i FROM words WHERE length(w) >= 4)
  UNION ALL
  SELECT w, w AS a, substr('UQAM', greatest(i, 1), length(w) - greatest(1 - i, 0)) AS b
  FROM (SELECT w, unnest(range(2 - length(w), 5)) AS i FROM words WHERE length(w) <= 4)),
window_ratio AS (SELECT w, a, b, 200.0 * coalesce(max(CASE WHEN a LIKE p AND b LIKE p THEN length(s) END), 0)
    / (length(a) + length(b)) AS r FROM pairs, subs GROUP BY w, a, b),
best_window AS (SELECT w, max(r) AS r FROM window_ratio GROUP BY w),
general_score AS (SELECT words.w, (200.0 * coalesce(m, 0) / (length(words.w) + 4) + best_window.r) / 2 AS mean
  FROM words LEFT JOIN lcs USING (w) JOIN best_window USING (w)),
means AS (SELECT a.*, CASE WHEN acc THEN 100.0
    WHEN general THEN g.mean
    WHEN members > 1 AND has_alias THEN (100 + 200.0 * 1 / (length(a.w) // length(k) + 1)) / 2
    WHEN members = 1 THEN (100 + 200.0 * 1 / (length(a.w) // length(k) + 1)) / 2
    ELSE (100 + 200.0 * least(length(a.w) // length(k), canonical_length // length(k))
      / (length(a.w) // length(k) + canonical_length // length(k))) / 2 END AS mean
  FROM admitted a LEFT JOIN general_score g ON a.w = g.w AND general),
scored AS (SELECT *, CAST(round_even(mean, 0) AS integer) AS score FROM means),
decided AS (SELECT *, CASE WHEN score >= 95 THEN 'accepted' WHEN score >= 80 THEN 'review'
  ELSE 'rejected' END AS decision FROM scored),
variants AS (SELECT o AS original_value, nv AS normalized_value, suggested AS suggested_group,
  score AS similarity_score, c AS "count", decision FROM decided)"""
MAPPING = f"""{SCORED}, mapping AS (SELECT o AS original_value, suggested AS clean_value, decision AS status,
  CASE decision WHEN 'accepted' THEN CASE
      WHEN acc AND whole = 'UNIVERSITE DU QUEBEC A MONTREAL' THEN {lit(FULL_NAME)}
      WHEN acc AND whole IN ('UQAM', 'U Q A M') THEN {lit(ACRONYM)}
      WHEN score >= 100 THEN {lit(SAME_COMPACT)}
      ELSE {lit(VALIDATED_PREFIX)} || suggested END
    WHEN 'review' THEN CASE
      WHEN rev AND score >= 90 THEN {lit(STRONG_BUT_CHECK)}
      WHEN rev THEN {lit(AMBIGUOUS)}
      WHEN contains(w, 'UQAM') THEN {lit(OTHER_CONTEXT + 'UQAM')}
      WHEN score >= 80 THEN {lit(CLOSE_BUT_CHECK)}
      ELSE {lit(CONFIRM_BY_HAND)} END
    ELSE {lit(TOO_DIFFERENT)} END AS reason FROM decided)"""
CLEANED = f"""{MAPPING}, cleaned AS (SELECT read.*, coalesce(m.clean_value, read.{TARGET}) AS {TARGET}_clean
  FROM read LEFT JOIN mapping m ON m.original_value = read.{TARGET} AND m.status = 'accepted')"""
_RANK = "CASE decision WHEN 'accepted' THEN 0 WHEN 'review' THEN 1 ELSE 2 END"

# Evidence

_ws = lit(" \t\n\r\x0b\x0c")
SECTIONS = rf"""docs AS (SELECT doc_id, {SECTIONED_TEXT} AS content FROM documents),
pieces AS (SELECT doc_id, string_split(regexp_replace(content, '(?m)^(#{{1,3}}\s)', chr(1) || '\1', 'g'), chr(1)) AS p FROM docs),
numbered AS (SELECT doc_id, unnest(p) AS body, generate_subscripts(p, 1) AS section FROM pieces),
bodies AS (SELECT doc_id, section, {strip('body')} AS body FROM numbered),
chunks AS (SELECT doc_id, section, CAST(i // 2800 + 1 AS integer) AS part,
    doc_id || ' section ' || section AS label, substr(body, CAST(i + 1 AS bigint), 2800) AS chunk
  FROM (SELECT *, unnest(range(0, length(body), 2800)) AS i FROM bodies WHERE body <> ''))"""


def tokens(x: str) -> str:
    return (
        f"list_distinct(list_filter(list_transform(regexp_extract_all({x}, '[A-Za-z0-9_]{{3,}}'),"
        f" lambda t: lower(t)), lambda t: t NOT IN {lits(STOP_WORDS)}))"
    )


# Words of the two questions, typed out: without stop words and repeats, in order.
_asked = ["duplicate", "blue", "gear", "notes"]
_report_words = ["why", "blue", "gear", "review", "accepted", "coop", "uqam", "forms", "remain"]
_list = "[" + ", ".join(lit(t) for t in _asked) + "]"
_near = " OR ".join(f"contains({fold('left(chunk, 250)')}, {lit(t)})" for t in _asked)
TOP = f"""{SECTIONS}, scores AS (SELECT *, CAST(len(list_intersect({tokens('chunk')}, {_list}))
    + CASE WHEN {_near} THEN 2 ELSE 0 END AS integer) AS score FROM chunks),
best AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, section, part) AS integer) AS rank
  FROM scores QUALIFY rank <= 2)"""


def _budget(source: str, order: str) -> str:
    return f"""spent AS (SELECT *, 26000 - coalesce(sum(length(text) + 2) OVER (ORDER BY {order}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining FROM {source}),
bounded AS (SELECT string_agg(substr(text, 1, CAST(remaining AS bigint)), chr(10) || chr(10) ORDER BY {order}) AS text,
  count(*) AS items FROM spent WHERE remaining > 0)"""


def _relevance() -> str:
    cols = ["original_value", "clean_value", "status", "reason"]
    score = " + ".join(
        f"CAST({contains(cols, t)} AS integer)" for t in _report_words
    )
    shown = ", ".join(f"left({c}, 240) AS {c}" for c in cols)
    return f"""WITH {MAPPING}, s AS (SELECT *, {score} AS score FROM mapping)
SELECT {shown}, CAST(score AS integer) AS score FROM s WHERE score > 0
ORDER BY score DESC, original_value LIMIT 6"""


def _reports() -> dict[str, tuple[str, list[str], list[str]]]:
    """Rows of each report, its columns and its order."""
    shown = [f"sample_{c}" for c in _SHOWN]
    variants = "original_value normalized_value suggested_group similarity_score count decision"
    return {
        "missing_values": (
            f"WITH {REPORT} SELECT * FROM report",
            "colonne valeurs_manquantes total_lignes pourcentage_manquant recommandation".split(),
            ["colonne"],
        ),
        "duplicates": (
            _dup(*_KEYS),
            ["duplicate_type", "duplicate_key", "duplicate_count", "sample_row_number", *shown],
            ["duplicate_type", "sample_row_number"],
        ),
        "organization_variants": (f"WITH {SCORED} SELECT * FROM variants", variants.split(), ["original_value"]),
        "entity_cleaning_mapping": (
            f"WITH {MAPPING} SELECT * FROM mapping",
            "original_value clean_value status reason".split(),
            ["original_value"],
        ),
    }


_COUNTED = ["decision", "status", "duplicate_type", "recommandation"]


def _summary(name: str) -> str:
    rows, cols, _ = _REPORTS[name]
    cells = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS v FROM r" for c in _COUNTED if c in cols)
    return f"""WITH r AS ({rows}), counted AS (SELECT col, coalesce(v, '<missing>') AS v, count(*) AS n FROM ({cells}) GROUP BY 1, 2)
SELECT '<rows>' AS "column", CAST(NULL AS varchar) AS value, count(*) AS "count", 1 AS rank FROM r
UNION ALL SELECT '<columns>', '{", ".join(cols)}', {len(cols)}, 1
UNION ALL SELECT * FROM (SELECT col, v, n, CAST(row_number() OVER (PARTITION BY col ORDER BY n DESC, v) AS integer) AS k
  FROM counted) WHERE k <= 12"""


def _bundle() -> str:
    """Items in order, then as much of them as fits."""
    ctes, items = [], []
    for n, (name, (rows, cols, order)) in enumerate(_REPORTS.items(), 1):
        score = " + ".join(f"CAST({contains([chr(34) + c + chr(34) for c in cols], t)} AS integer)" for t in _report_words)
        line = " || ',' || ".join(f"left(coalesce(CAST(\"{c}\" AS varchar), ''), 240)" for c in cols)
        ctes.append(f"r{n} AS ({rows}), s{n} AS ({_summary(name)})")
        ctes.append(f"m{n} AS (SELECT *, {score} AS hits FROM r{n} QUALIFY hits > 0 AND row_number() OVER (ORDER BY hits DESC, {', '.join(order)}) <= 6)")
        lines = " UNION ALL ".join(
            f"""SELECT {k} AS k, '{c} counts: ' || string_agg(value || '=' || format('{{:,}}', "count"), ', ' ORDER BY rank) AS line
  FROM s{n} WHERE "column" = '{c}' HAVING count(*) > 0"""
            for k, c in enumerate(_COUNTED)
            if c in cols
        )
        items.append(f"""SELECT {2 * n} AS part, 0 AS place, (SELECT '[{name}] Rows: ' || format('{{:,}}', "count") FROM s{n} WHERE "column" = '<rows>')
  || '; columns: {", ".join(cols)}' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY k) FROM ({lines})) AS text""")
        keys = ", ".join(order)
        items.append(f"""SELECT {2 * n + 1}, 0, '[{name} relevant rows]' || chr(10) || '{",".join(cols)}' || chr(10)
  || string_agg({line}, chr(10) ORDER BY hits DESC, {keys}) FROM m{n} HAVING count(*) > 0""")
    raw_lookup = [c for c in LOOKUP if not c.endswith("_clean")]
    near = " OR ".join(f"contains({fold('left(chunk, 250)')}, {lit(t)})" for t in _report_words)
    asked = "[" + ", ".join(lit(t) for t in _report_words) + "]"
    return f"""WITH {', '.join(ctes)}, {SECTIONS}, totals AS (WITH {READ} {_totals('read', raw_lookup)}),
scores AS (SELECT *, CAST(len(list_intersect({tokens('chunk')}, {asked})) + CASE WHEN {near} THEN 2 ELSE 0 END AS integer) AS score FROM chunks),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, section, part) AS rank FROM scores QUALIFY rank <= 2),
items AS (
  SELECT 0 AS part, 0 AS place, '[project metrics]' || chr(10) || 'rows: ' || (SELECT count(*) FROM orders) || chr(10) || 'columns: {len(COLS) + 1}' AS text
  UNION ALL SELECT 1, 0, '[dataset lookup]' || chr(10) || 'matched_rows: ' || matched_rows FROM totals
  UNION ALL {' UNION ALL '.join(items)}
  UNION ALL SELECT 10, doc_id * 100 + rank, '[' || label || ']' || chr(10) || chunk FROM best),
{_budget('items', 'part, place')}
SELECT text, '{",".join([*_REPORTS, "documents"])}' AS sources, (SELECT matched_rows FROM totals) AS dataset_rows FROM bounded"""


def _metrics() -> str:
    found = ", ".join(
        f"CAST(coalesce(nullif(replace(regexp_extract(content, {lit(p)}, 1), ',', ''), ''), '0') AS bigint) AS {n}"
        for n, p in METRIC_PATTERNS.items()
    )
    return f"SELECT doc_id, {found} FROM (SELECT doc_id, {FIGURES_TEXT} AS content FROM documents)"


LOOKUP = [
    "ref_number",
    "recipient_legal_name",
    "recipient_legal_name_clean",
    "recipient_country",
    "recipient_province",
    "recipient_city",
    "agreement_value",
    "agreement_start_date",
    "agreement_end_date",
]
_number = f"CASE WHEN regexp_matches({strip('agreement_value')}, '{NUMBER}') THEN CAST({strip('agreement_value')} AS double) END"


def _totals(source: str, cols) -> str:
    return f"""SELECT count(*) AS matched_rows,
  coalesce(sum({_number}), 0.0) AS value_sum
FROM {source} WHERE {contains(cols, TERM)}"""


_REPORTS = _reports()

# Remediation

_province = """CASE WHEN recipient_province IS NOT NULL THEN recipient_province
  WHEN recipient_country <> 'CA' THEN 'NOT_APPLICABLE' ELSE 'UNKNOWN' END"""
_held = "(amendment_date IS NULL AND amendment_number <> '0')"
TREATED = f"""{CLEAN}, treated AS (SELECT row_number AS key, ref_number, amendment_number, amendment_date,
  CASE WHEN amendment_date IS NULL AND amendment_number = '0' THEN 'NOT_APPLICABLE' END AS amendment_date_status,
  coalesce(agreement_type, 'UNKNOWN') AS agreement_type, agreement_type AS agreement_type_raw,
  coalesce(recipient_type, 'UNKNOWN') AS recipient_type, recipient_type AS recipient_type_raw,
  recipient_legal_name,
  coalesce(recipient_operating_name, 'NOT_PROVIDED') AS recipient_operating_name,
  recipient_operating_name IS NULL AS recipient_operating_name_was_missing,
  coalesce(recipient_country, 'UNKNOWN') AS recipient_country,
  recipient_country IS NULL AS recipient_country_was_missing,
  {_province} AS recipient_province, recipient_province IS NULL AS recipient_province_was_missing,
  coalesce(recipient_city, 'UNKNOWN') AS recipient_city, recipient_city IS NULL AS recipient_city_was_missing,
  coalesce(recipient_postal_code, 'UNKNOWN') AS recipient_postal_code,
  recipient_postal_code IS NULL AS recipient_postal_code_was_missing,
  agreement_value, agreement_start_date, agreement_end_date,
  CASE WHEN agreement_end_date IS NULL THEN 'NOT_PROVIDED' END AS agreement_end_date_status,
  coalesce(foreign_currency_type, 'NOT_APPLICABLE') AS foreign_currency_type,
  foreign_currency_value,
  CASE WHEN foreign_currency_value IS NULL THEN 'NOT_APPLICABLE' END AS foreign_currency_value_status,
  {_held} AS held FROM clean)"""
# What the rules say is logged: rows with an amendment without its date go to a person as they
# came, so nothing else is done to them; all others are filled, marked or lose a column.
_DONE = [
    ("amendment_date", "STATUS NOT_APPLICABLE", "amendment_date IS NULL"),
    ("agreement_type", "FILLED UNKNOWN", "agreement_type IS NULL"),
    ("recipient_type", "FILLED UNKNOWN", "recipient_type IS NULL"),
    ("recipient_operating_name", "FILLED NOT_PROVIDED", "recipient_operating_name IS NULL"),
    ("recipient_country", "FILLED UNKNOWN", "recipient_country IS NULL"),
    ("recipient_province", "FILLED NOT_APPLICABLE", "recipient_province IS NULL AND recipient_country <> 'CA'"),
    ("recipient_province", "FILLED UNKNOWN", "recipient_province IS NULL AND coalesce(recipient_country, 'CA') = 'CA'"),
    ("recipient_city", "FILLED UNKNOWN", "recipient_city IS NULL"),
    ("agreement_end_date", "STATUS NOT_PROVIDED", "agreement_end_date IS NULL"),
    ("foreign_currency_type", "FILLED NOT_APPLICABLE", "foreign_currency_type IS NULL"),
    ("foreign_currency_value", "STATUS NOT_APPLICABLE", "foreign_currency_value IS NULL"),
    ("coverage", "DROPPED VALUE", "coverage IS NOT NULL"),
]


def _log(postal: str) -> str:
    """A row for each cell; ``postal`` is the fill of a postal code that is missing."""
    done = [*_DONE, ("recipient_postal_code", f"FILLED {postal}", "recipient_postal_code IS NULL")]
    parts = [
        f"SELECT row_number AS key, '{c}' AS \"column\", '{a}' AS action FROM clean WHERE {t} AND NOT coalesce({_held}, false)"
        for c, a, t in done
    ]
    parts.append(f"SELECT row_number, 'amendment_date', 'SENT TO REVIEW' FROM clean WHERE {_held}")
    return " UNION ALL ".join(parts)


def _audit(postal: str) -> str:
    return f"""WITH {CLEAN}, log AS ({_log(postal)})
SELECT "column", action, count(*) AS cells FROM log WHERE action <> 'DROPPED VALUE' GROUP BY 1, 2
UNION ALL SELECT 'coverage', 'DROPPED COLUMN', count(*) FILTER (WHERE action = 'DROPPED VALUE') FROM log"""


_FILLED = [
    "agreement_type",
    "recipient_type",
    "recipient_operating_name",
    "recipient_country",
    "recipient_province",
    "recipient_city",
    "recipient_postal_code",
    "foreign_currency_type",
]


def _checks() -> str:
    day = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    tests = {f"populated:{c}": f"{c} IS NULL" for c in _FILLED}
    for c in ("amendment_date", "agreement_end_date", "foreign_currency_value"):
        tests[f"status:{c}"] = f"({c} IS NULL) <> ({c}_status IS NOT NULL)"
    tests["dependency:recipient_province"] = (
        "recipient_province = 'NOT_APPLICABLE' AND recipient_country = 'CA'"
    )
    for c in ("agreement_value", "foreign_currency_value", "amendment_number"):
        tests[f"type:{c}"] = f"NOT regexp_matches({c}, '{NUMBER}')"
    for c in ("amendment_date", "agreement_start_date", "agreement_end_date"):
        tests[f"type:{c}"] = f"NOT regexp_matches({c}, '{day}')"
    rows = [
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE NOT held AND {test}) AS failures FROM treated"
        for name, test in tests.items()
    ]
    rows.append(
        "SELECT 'row_conservation', abs((SELECT count(*) FROM grants) - count(*)) FROM treated"
    )
    rows.append("SELECT 'dropped:coverage', 0")
    rows += [f"SELECT 'profile:{c}', 0" for c in ["row_number", *COLS]]
    return f"WITH {TREATED} {' UNION ALL '.join(rows)}"


def _profile() -> str:
    """Filled and dropped columns lack nothing afterwards, the others what they lacked."""
    rows = []
    for c in ["row_number", *COLS]:
        n = f"count(*) FILTER (WHERE {c} IS NULL AND NOT coalesce({_held}, false))"
        left = "0" if c in [*_FILLED, "coverage"] else n
        rows.append(f"SELECT '{c}' AS \"column\", {n} AS before, {left} AS after, {left} AS expected FROM clean")
    return f"WITH {CLEAN} {' UNION ALL '.join(rows)}"


def _faults() -> str:
    """Of the actions only those on rows that were not lost count, once more where a row is repeated."""
    again = "(CASE WHEN key % 89 = 3 THEN 2 ELSE 1 END)"
    kept = "key % 101 <> 7"
    cells = {
        "recipient_city": "key % 83 = 1",
        "recipient_country": "recipient_country_was_missing",
        "agreement_value": "key % 79 = 0 AND agreement_value IS NOT NULL",
    }
    wrong = [
        f"SELECT '{c}' AS \"column\", 'UNEXPECTED VALUE' AS action, coalesce(sum({again}) FILTER (WHERE {kept} AND {t}), 0) AS cells FROM treated"
        for c, t in cells.items()
    ]
    done = f"""SELECT "column", action, sum({again}) AS cells FROM log WHERE {kept} AND action NOT IN ('DROPPED VALUE', 'STATUS NOT_APPLICABLE')
      AND "column" <> 'recipient_country' AND NOT ("column" = 'recipient_city' AND key % 83 = 1) GROUP BY 1, 2
    UNION ALL SELECT "column", action, sum({again}) FROM log WHERE {kept} AND "column" = 'amendment_date' AND action = 'STATUS NOT_APPLICABLE' GROUP BY 1, 2
    UNION ALL SELECT 'coverage', 'DROPPED COLUMN', coalesce(sum({again}) FILTER (WHERE {kept} AND action = 'DROPPED VALUE'), 0) FROM log"""
    added = "count(*) FILTER (WHERE key % 97 = 5)"
    return f"""WITH {TREATED}, log AS ({_log('UNKNOWN')}), left_over AS (SELECT * FROM treated WHERE {kept}), found AS ({done}
    UNION ALL {' UNION ALL '.join(wrong)}
    UNION ALL SELECT 'foreign_currency_value_status', 'MISSING COLUMN', sum({again}) FROM left_over
    UNION ALL SELECT 'remark', 'EXTRA COLUMN', coalesce(sum({again} + CASE WHEN key % 97 = 5 THEN 1 ELSE 0 END) FILTER (WHERE key % 71 = 0), 0) FROM left_over
    UNION ALL SELECT NULL, 'LOST ROW', (SELECT count(*) FROM treated) - count(*) FROM left_over
    UNION ALL SELECT NULL, 'ADDED ROW', {added} FROM left_over
    UNION ALL SELECT NULL, 'REPEATED ROW', count(*) FILTER (WHERE key % 89 = 3) FROM left_over)
SELECT "column", action, CAST(cells AS bigint) AS cells FROM found WHERE cells > 0 OR action = 'DROPPED COLUMN'"""


def _snapshot(cells: dict[str, str], source: str) -> str:
    shown = ", ".join(f"coalesce({sql}, '') AS {name}" for name, sql in cells.items())
    return f"SELECT {shown} FROM {source}"


def _stamp(c: str) -> str:
    return (
        f"CASE WHEN {c} = date_trunc('day', {c}) THEN strftime({c}, '%Y-%m-%d')"
        f" WHEN {c} = date_trunc('second', {c}) THEN strftime({c}, '%Y-%m-%d %H:%M:%S')"
        f" ELSE strftime({c}, '%Y-%m-%d %H:%M:%S.%f') END"
    )


def _text(c: str) -> str:
    return f"CAST({c} AS varchar)"


_ORDERS = {
    "o_orderkey": _text("o_orderkey"),
    "o_custkey": _text("o_custkey"),
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": _text("o_totalprice"),
    "o_orderdate": _stamp("o_orderdate"),
    "o_orderpriority": "o_orderpriority",
}
_EVENTS = {
    "event_id": _text("event_id"),
    "ts": _stamp("ts"),
    "user_id": _text("user_id"),
    "event_type": "event_type",
    "value": _text("value"),
    "props": "props",
}


def _preview_side(name: str, source: str, cols, shown) -> str:
    return f"""(SELECT '{name}' AS side, {shown} FROM {source}
  WHERE {contains(cols, TERM)} ORDER BY key LIMIT 40)"""


def _lookup_terms() -> str:
    return rf"""WITH q AS (SELECT conv_id, turn, {QUESTION_TEXT} AS question FROM conversations),
found AS (SELECT *, trim(regexp_extract(question, '["'']([^"'']{{3,80}})["'']', 1)) AS quoted,
  regexp_extract(question, '\b[A-Za-z0-9]+(?:[-/#][A-Za-z0-9]+){{2,}}\b') AS reference,
  list_filter(regexp_extract_all(question, '\b[A-Z][A-Z0-9&.-]{{3,}}\b'), lambda t: t NOT IN {lits(NOT_LOOKUPS)}) AS acr FROM q)
SELECT conv_id, turn, CASE WHEN quoted <> '' THEN quoted WHEN reference <> '' THEN reference
  ELSE coalesce(list_filter(acr, lambda t: length(t) = list_max(list_transform(acr, lambda u: length(u))))[1], '') END AS term FROM found"""


def oracle_sql() -> dict[str, str]:
    """SQL for each registered query that SQL can state."""
    cols = ", ".join(COLS)
    raw_cols = [c for c in PREVIEW_COLUMNS if c != f"{TARGET}_clean"]
    raw_shown = "row_number AS key, " + ", ".join(
        f"CAST(NULL AS varchar) AS {c}" if c == f"{TARGET}_clean" else c for c in PREVIEW_COLUMNS
    )
    clean_shown = "row_number AS key, " + ", ".join(PREVIEW_COLUMNS)
    exact = f"SELECT 'exact_row' AS t, {_digest(COLS)} AS k, row_number AS r FROM clean"
    shape = {
        c: c for c in ["ref_number", "amendment_number", "agreement_value", "agreement_start_date"]
    }
    shapes = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS v FROM grants" for c in shape)
    name = "lower(col)"
    words = f"SELECT doc_id, {tokens('text')} AS t FROM documents"
    numbered_key = "row_number"
    return {
        "row_numbers": f"WITH {GRANTS} SELECT row_number, {cols} FROM grants",
        "source_row_numbers": "SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS bigint) AS row_number, * FROM orders",
        "files_overview": 'SELECT 4 AS files, count(*) AS "rows", 6 AS "columns" FROM orders',
        "csv_line_breaks": """SELECT CAST(row_number() OVER (ORDER BY doc_id) AS bigint) AS row_number, CAST(doc_id AS varchar) AS doc_id,
  nullif(text, '') AS text, nullif(lang, '') AS lang, nullif(source, '') AS source, CAST(n_chars AS varchar) AS n_chars FROM documents""",
        "sample_rows": f"WITH {GRANTS} SELECT {cols} FROM grants ORDER BY row_number LIMIT 1000",
        "dataset_overview": f'WITH {GRANTS} SELECT count(*) AS "rows", {len(COLS) + 1} AS "columns" FROM grants',
        "text_scan": f"WITH {READ} SELECT "
        + ", ".join(f"nullif({c}, '') AS {c}" for c in COLS)
        + " FROM read",
        "csv_row_numbers": f"""SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS bigint) AS row_number,
  {', '.join(f"nullif({sql}, '') AS {name}" for name, sql in _ORDERS.items())} FROM orders""",
        "missing_input": f"WITH {REPORT} SELECT colonne, total_lignes FROM report",
        "target_fallback": f'WITH {READ} SELECT ref_number AS original_value, count(*) AS "count" FROM read WHERE ref_number IS NOT NULL GROUP BY 1',
        "search_blank": f"WITH {REPORT} SELECT * FROM report",
        "lookup_no_term": f"""SELECT count(*) AS questions, CAST(0 AS bigint) AS matched_rows, CAST(0 AS double) AS value_sum
FROM ({_lookup_terms()}) WHERE term = ''""",
        "snapshot_scan": _snapshot(_ORDERS, "orders"),
        "text_snapshot_orders": _snapshot(_ORDERS, "orders"),
        "text_snapshot_events": _snapshot(_EVENTS, "events"),
        "canonical_nulls": f"WITH {CLEAN} SELECT {numbered_key} AS key, {cols} FROM clean",
        "blank_preserving_nulls": f"WITH {READ} SELECT {numbered_key} AS key, "
        + ", ".join(f"coalesce({c}, '') AS {c}" for c in COLS)
        + " FROM read",
        "missing_report": f"WITH {REPORT} SELECT * FROM report",
        "missing_profile": f'WITH {MISSING} SELECT col AS "column", n AS missing_count, round(pct, 2) AS missing_percent FROM missing WHERE n > 0',
        "completeness": f"""WITH {MISSING} SELECT count(*) FILTER (WHERE n > 0) AS incomplete_columns,
  count(*) FILTER (WHERE n = 0) AS complete_columns, count(*) AS total_columns FROM missing""",
        "missing_range_filter": f"WITH {REPORT} SELECT * FROM report WHERE pourcentage_manquant BETWEEN 20 AND 100",
        "top_missing": f"WITH {REPORT} SELECT colonne, pourcentage_manquant, recommandation FROM report {WORST} LIMIT 10",
        "remediation_plan": _plan(),
        **{
            f"column_roles{suffix}": _roles(head, name)
            for suffix, head in (("", ""), ("_sample", "LIMIT 1000"))
        },
        **{
            f"column_dtypes{suffix}": f'WITH {STATS.replace("HEAD_ROWS", head)} SELECT col AS "column", dtype AS detected_dtype FROM typed'
            for suffix, head in (("", ""), ("_sample", "LIMIT 1000"))
        },
        "shape_counts": f"""WITH {GRANTS}, cells AS ({shapes})
SELECT col AS "column", count(*) FILTER (WHERE regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) AS dates,
  count(*) FILTER (WHERE regexp_matches(v, '{NUMBER}')) AS numbers,
  coalesce(sum(CASE WHEN regexp_matches(v, '{NUMBER}') THEN CAST(v AS double) END), 0.0) AS total
FROM cells GROUP BY col""",
        "dup_exact": f"""WITH {GRANTS}, doubled AS (SELECT {numbered_key} AS row_number, {cols} FROM grants UNION ALL
  SELECT {numbered_key} + {COPY_OFFSET}, {cols} FROM grants WHERE {numbered_key} % {COPY_EVERY} = {COPY_EVERY - 1}),
clean AS ({nulled('doubled', True)}), {_groups(exact)} {_sampled('clean')}""",
        "dup_ref": _dup("ref_number"),
        "dup_org_date_value": _dup("org_date_value"),
        "dup_org_city_postal": _dup("org_city_postal"),
        "dup_report": _dup(*_KEYS),
        "dup_by_rule": _dup("org_city_postal")
        + " ORDER BY duplicate_count DESC, sample_row_number LIMIT 200",
        "dup_lineitem": """SELECT 'part_supplier' AS duplicate_type, 'part=' || l_partkey || '|supplier=' || l_suppkey AS duplicate_key,
  count(*) AS duplicate_count, min(place) AS sample_row_number
FROM (SELECT *, row_number() OVER () AS place FROM lineitem) GROUP BY l_partkey, l_suppkey HAVING count(*) > 1""",
        "dup_documents": f"""SELECT 'exact_row' AS duplicate_type, sha256(strlen(t) || ':' || t) AS duplicate_key,
  count(*) AS duplicate_count, min(doc_id) AS sample_row_number
FROM (SELECT doc_id, coalesce({as_null('text', True)}, '') AS t FROM documents) GROUP BY t HAVING count(*) > 1""",
        "dup_summary": f"""WITH {SUMMARY} SELECT t AS duplicate_type, count(*) AS duplicate_groups,
  CAST(sum(n - 1) AS bigint) AS duplicate_rows_flagged FROM groups GROUP BY t""",
        "dup_summary_max": f"""WITH {SUMMARY} SELECT t AS duplicate_type, count(*) AS groups, max(n) AS max_group_size,
  CAST(sum(n - 1) AS bigint) AS rows_flagged FROM groups GROUP BY t""",
        "dup_total": f"WITH {SUMMARY} SELECT CAST(sum(n - 1) AS bigint) AS total_flagged FROM groups",
        "value_counts": f'WITH {VALUES} SELECT o AS original_value, c AS "count" FROM vals',
        "distinct_counts": f"""WITH {READ} SELECT count(DISTINCT {TARGET}) AS {TARGET},
  count(DISTINCT recipient_city) AS recipient_city, count(DISTINCT recipient_postal_code) AS recipient_postal_code FROM read""",
        "normalize_documents": f"SELECT doc_id, CAST(length(n) AS integer) AS length, md5(n) AS digest FROM (SELECT doc_id, {norm('text')} AS n FROM documents)",
        "compact_documents": f"SELECT doc_id, CAST(length(n) AS integer) AS length, md5(n) AS digest FROM (SELECT doc_id, {compact('text')} AS n FROM documents)",
        "collapse_segments_names": f"WITH {FORMS} SELECT o AS original_value, cv AS collapsed_value FROM collapsed",
        "name_forms": f"""WITH {FORMS} SELECT o AS original_value, cv AS collapsed_value, nv AS normalized_value,
  k AS compact_value, whole AS full_normalized FROM forms""",
        "compact_groups": f"""WITH {GROUPS} SELECT DISTINCT k AS compact_value, members, canonical,
  CASE WHEN has_alias THEN 'UQAM' END AS group_family FROM grouped""",
        "alias_flags": f"""WITH {FORMS}, every AS (SELECT o, nv, replace(nv, ' ', '') AS k FROM allforms)
SELECT o AS original_value, {_ACCEPT} AS accepted, nv <> '' AND {_REVIEW} AS review FROM every""",
        "fuzzy_scores": f"WITH {SCORED} SELECT original_value, suggested_group, similarity_score, decision FROM variants",
        "variants_report": f"WITH {SCORED} SELECT * FROM variants",
        "cleaning_mapping": f"WITH {MAPPING} SELECT * FROM mapping",
        "accepted_mapping": f"WITH {MAPPING} SELECT * FROM mapping WHERE status = 'accepted'",
        "cleaned_table": f"WITH {CLEANED} SELECT {numbered_key} AS key, {cols}, {TARGET}_clean FROM cleaned",
        "cleaned_from_saved": f"""WITH {MAPPING}, saved AS (SELECT original_value, min(CASE decision WHEN 'review' THEN NULL
    WHEN 'accepted' THEN suggested_group ELSE 'EDITED' END) AS label FROM variants GROUP BY 1)
SELECT {numbered_key} AS key, {cols}, coalesce(label, {TARGET}) AS {TARGET}_clean
FROM read LEFT JOIN saved ON original_value = {TARGET}""",
        "changed_cells": f"WITH {CLEANED} SELECT count(*) FILTER (WHERE {TARGET} <> {TARGET}_clean) AS changed_cells FROM cleaned",
        "cleaning_execution": f"""WITH {CLEANED}
SELECT 'rows_processed' AS metric, count(*) AS value FROM read
UNION ALL SELECT 'accepted_available', count(*) FROM mapping WHERE status = 'accepted'
UNION ALL SELECT 'mappings_skipped', count(*) FROM mapping WHERE status <> 'accepted'
UNION ALL SELECT 'corrections_applied', count(*) FROM cleaned WHERE {TARGET} <> {TARGET}_clean""",
        "mapping_status": f'WITH {MAPPING} SELECT status, count(*) AS "count" FROM mapping GROUP BY status',
        "mapping_review_count": f"WITH {MAPPING} SELECT count(*) AS review_rows FROM mapping WHERE status = 'review'",
        "search_any_column": f"""WITH {REPORT} SELECT * FROM report WHERE {contains(['colonne', 'valeurs_manquantes', 'total_lignes', 'pourcentage_manquant', 'recommandation'], 'recipient')}
{WORST} LIMIT 200""",
        "search_mapping": f"""WITH {MAPPING} SELECT * FROM mapping WHERE status = 'accepted'
  AND {contains(['original_value', 'clean_value', 'status', 'reason'], 'ring')} ORDER BY original_value LIMIT 500""",
        "search_variants": f"""WITH {SCORED} SELECT * FROM variants WHERE {contains(['original_value', 'normalized_value', 'suggested_group', 'similarity_score', '"count"', 'decision'], 'gear')}""",
        "decision_counts": f"""WITH {SCORED} SELECT decision, count(*) AS "count" FROM variants
WHERE {contains(['original_value', 'normalized_value', 'suggested_group', 'similarity_score', '"count"', 'decision'], 'uqam')} GROUP BY decision""",
        "search_table": f"""WITH {READ} SELECT ref_number, recipient_legal_name, recipient_city FROM read
WHERE {contains(['ref_number', 'recipient_legal_name', 'recipient_city'], 'nation_7')} ORDER BY row_number LIMIT 100""",
        "search_snapshot": f"""WITH numbered AS (SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS bigint) AS row_number,
  {', '.join(f"{sql} AS {name}" for name, sql in _ORDERS.items())} FROM orders)
SELECT * FROM numbered WHERE contains(o_orderpriority, 'URGENT') ORDER BY row_number LIMIT 100""",
        "top_rows": f"""WITH {READ} SELECT row_number AS key, {cols} FROM read
ORDER BY CASE WHEN regexp_matches(foreign_currency_value, '{NUMBER}') THEN CAST(foreign_currency_value AS double) END DESC NULLS LAST, row_number LIMIT 20""",
        "raw_clean_preview": f"""WITH {CLEANED}, shifted_raw AS (SELECT * REPLACE ({numbered_key} AS row_number) FROM read),
shifted AS (SELECT * REPLACE ({numbered_key} AS row_number) FROM cleaned)
{_preview_side('raw', 'shifted_raw', raw_cols, raw_shown)} UNION ALL {_preview_side('clean', 'shifted', PREVIEW_COLUMNS, clean_shown)}""",
        "cleaned_sample": f"WITH {CLEANED} SELECT {', '.join(SAMPLE_COLUMNS)} FROM cleaned ORDER BY row_number LIMIT 20",
        "lookup_terms": _lookup_terms(),
        "lookup_totals": f"WITH {CLEANED} {_totals('cleaned', LOOKUP)}",
        "lookup_extremes": f"""WITH {READ}, odd AS (SELECT * REPLACE (CASE row_number % 7 WHEN 0 THEN '1e33' WHEN 1 THEN '1e40'
  WHEN 2 THEN '0.1234567890123' ELSE agreement_value END AS agreement_value) FROM read)
{_totals('odd', [c for c in LOOKUP if not c.endswith('_clean')])}""",
        "lookup_rows": f"WITH {CLEANED} SELECT {', '.join(LOOKUP)} FROM cleaned WHERE {contains(LOOKUP, TERM)} ORDER BY row_number LIMIT 8",
        "token_sets": f"SELECT doc_id, CAST(len(t) AS integer) AS words, md5(array_to_string(list_sort(t), ' ')) AS digest FROM ({words})",
        "text_sections": f"WITH {SECTIONS} SELECT doc_id, CAST(section AS integer) AS section, part, label, md5(chunk) AS digest FROM chunks",
        "top_sections": f"WITH {TOP} SELECT doc_id, rank, score, label, md5(chunk) AS digest FROM best",
        "row_relevance": _relevance(),
        "report_summary": " UNION ALL ".join(
            f"SELECT \"column\", value, \"count\", rank, '{n}' AS report FROM ({_summary(n)})" for n in _REPORTS
        ),
        "value_profile": f"""WITH {SCORED}, cells AS (SELECT 'decision' AS col, decision AS v FROM variants
  UNION ALL SELECT 'suggested_group', suggested_group FROM variants),
counted AS (SELECT col, coalesce(v, '<missing>') AS v, count(*) AS n FROM cells GROUP BY 1, 2)
SELECT col AS "column", v AS value, n AS "count", CAST(row_number() OVER (PARTITION BY col ORDER BY n DESC, v) AS integer) AS rank
FROM counted QUALIFY rank <= 12""",
        "budget_concat": f"WITH {_budget('documents', 'doc_id')} SELECT text, items FROM bounded",
        "evidence_bundle": _bundle(),
        "report_metrics": _metrics(),
        "final_summary": f"""WITH {CLEANED}, nulls AS ({nulled('grants', True)}),
{_groups(' UNION ALL '.join(_key_rows(r, 'nulls') for r in _KEYS))}
SELECT 'rows' AS metric, count(*) AS value FROM read
UNION ALL SELECT 'columns', {len(COLS) + 1}
UNION ALL SELECT 'distinct_raw', count(DISTINCT {TARGET}) FROM read
UNION ALL SELECT 'distinct_clean', count(DISTINCT {TARGET}_clean) FROM cleaned
UNION ALL SELECT 'corrections_applied', count(*) FROM cleaned WHERE {TARGET} <> {TARGET}_clean
UNION ALL SELECT 'duplicate_rows_flagged', CAST(sum(n - 1) AS bigint) FROM groups
UNION ALL SELECT 'corrections_review', count(*) FROM mapping WHERE status = 'review'""",
        "remediated_table": f"WITH {TREATED} SELECT * EXCLUDE (held) FROM treated WHERE NOT held",
        "amendment_review": f"WITH {CLEAN} SELECT {numbered_key} AS key, {cols} FROM clean WHERE {_held}",
        "remediation_checks": _checks(),
        "remediated_detected": f"WITH {TREATED} SELECT * EXCLUDE (held) FROM treated WHERE NOT held",
        "remediation_profile": _profile(),
        "remediation_audit": _audit("UNKNOWN"),
        "remediation_planned": _audit("UNKNOWN"),
        "remediation_faults": _faults(),
        "remediation_shipped": _audit("NOT_PROVIDED"),
        "remediation_log": f"WITH {CLEAN}, log AS ({_log('UNKNOWN')}) SELECT * FROM log",
    }
