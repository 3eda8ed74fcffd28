"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

W = r"[^\x20\x09-\x0D]"
KEY = "concat_ws(' ', x, " + ", ".join(f"lead(x, {n}) OVER o" for n in range(1, 8)) + ")"

OP3 = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, COALESCE(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{W}+') AS ws FROM d),
u AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT rid, i, lag(x) OVER o = x AS again, {KEY} AS key, lead(x, 7) OVER o IS NOT NULL AS whole FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
g AS (SELECT rid, i, COUNT(*) OVER (PARTITION BY rid, key) AS n FROM k WHERE whole),
r AS (SELECT rid, COUNT(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM g WHERE n > 1) GROUP BY rid),
s AS (SELECT rid, COUNT(*) AS n_stutters FROM k WHERE again GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{W}')) AS ls FROM d),
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    COALESCE(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals, length(regexp_replace(t, '[^!]+', '', 'g')) AS n_exclamations, COALESCE(n_stutters, 0) AS n_stutters
  FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN r USING (rid) LEFT JOIN s USING (rid)),
b AS (SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 2 * n_words OR word_chars > 14 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 2 * n_capitals > word_chars THEN 16 ELSE 0 END + CASE WHEN 10 * n_exclamations > 3 * n_words THEN 32 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 5 * n_lines THEN 64 ELSE 0 END + CASE WHEN 10 * n_stutters > 3 * n_words THEN 128 ELSE 0 END AS bits FROM m)
"""
RULES = "(VALUES (1, 'few_words'), (2, 'repeated_words'), (4, 'symbols'), (8, 'word_length'), (16, 'capitals'), (32, 'exclamations'), (64, 'repeated_lines'), (128, 'stutter')) AS r(bit, rule)"
VERDICTS = OP3 + f"SELECT b.*, bits & 3 <> 0 AS base_failed, bits = 0 AS kept, rule AS sole_rule FROM b LEFT JOIN {RULES} ON bits = bit"
ABLATIONS = OP3 + f"SELECT rule, COUNT(*) FILTER (bits & bit <> 0) AS n_failed, COUNT(*) FILTER (bits = bit) AS n_only, COUNT(*) AS n_rows FROM b CROSS JOIN {RULES} GROUP BY rule"


def op5(rounds: int = 16, fills: int = 8, budget: float = 0.8, temper: float = 0.85, topics: int = 12, seed: int = 3) -> str:
    """The raking unrolled: three bounded scalings a round, towards targets that no value is too scarce for."""
    marginals = ("source", "lang", "topic")
    full, most = 1 - 1e-12, (3 + budget) / 4
    ctes = [
        r"""w AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, COALESCE(source, '') AS source, COALESCE(lang, '') AS lang, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)""",
        f"seeds AS MATERIALIZED (SELECT x AS word FROM (SELECT unnest(list_distinct(ws)) AS x FROM w) WHERE length(x) >= 5 GROUP BY x HAVING COUNT(*) <= 0.05 * (SELECT COUNT(*) FROM w) ORDER BY COUNT(*) DESC, x LIMIT {topics})",
        "told AS (SELECT rid, word, row_number() OVER (PARTITION BY rid ORDER BY COUNT(*) DESC, word) AS place FROM (SELECT rid, unnest(ws) AS word FROM w) JOIN seeds USING (word) GROUP BY rid, word)",
        "d AS MATERIALIZED (SELECT doc_id, source, lang, len(ws) AS tokens, COALESCE(word, 'other') AS topic FROM w LEFT JOIN (SELECT rid, word FROM told WHERE place = 1) USING (rid))",
        f"w0 AS MATERIALIZED (SELECT source, lang, topic, SUM(tokens) AS tokens, SUM(tokens) * {budget}::DOUBLE AS weight FROM d GROUP BY ALL)",
    ]
    for m in marginals:
        ctes.append(f"s_{m} AS MATERIALIZED (SELECT {m}, SUM(tokens)::DOUBLE AS t, pow(SUM(tokens)::DOUBLE, {temper}) AS raw FROM w0 GROUP BY {m} HAVING SUM(tokens) > 0)")
        ctes.append(f"c_{m}0 AS MATERIALIZED (SELECT SUM(t) * {budget}::DOUBLE / SUM(raw) AS rate FROM s_{m})")
        for k in range(fills):
            ctes.append(f"c_{m}{k + 1} AS MATERIALIZED (SELECT greatest(any_value(rate), (SUM(t) * {budget}::DOUBLE - SUM(CASE WHEN raw * rate >= t * {most}::DOUBLE THEN t * {most}::DOUBLE ELSE 0 END)) / NULLIF(SUM(CASE WHEN raw * rate >= t * {most}::DOUBLE THEN 0 ELSE raw END), 0)) AS rate FROM s_{m} CROSS JOIN c_{m}{k})")
        ctes.append(f"t_{m} AS MATERIALIZED (SELECT {m}, least(raw * rate, t * {most}::DOUBLE) AS target FROM s_{m} CROSS JOIN c_{m}{fills})")
    step = 0
    for _ in range(rounds):
        for m in marginals:
            ctes.append(
                f"w{step + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, CASE WHEN s > 0 AND target <= s THEN weight * (target / s) WHEN target > s AND s > f AND weight < tokens * {full!r}::DOUBLE THEN least(tokens::DOUBLE, weight * ((target - f) / (s - f))) ELSE weight END AS weight"
                f" FROM w{step} LEFT JOIN (SELECT {m}, SUM(weight) AS s, SUM(CASE WHEN weight >= tokens * {full!r}::DOUBLE THEN weight ELSE 0 END) AS f, any_value(target) AS target FROM w{step} JOIN t_{m} USING ({m}) GROUP BY {m}) USING ({m}))"
            )
            step += 1
    ctes.append(f"p AS MATERIALIZED (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS probability FROM w{step})")
    away = " UNION ALL ".join(f"SELECT ABS(SUM(weight) - any_value(target)) AS x FROM w{step} JOIN t_{m} USING ({m}) GROUP BY {m}" for m in marginals)
    ctes.append(f"r AS (SELECT ROUND(MAX(x) / (SELECT SUM(weight) FROM w{step}), 4) AS residual FROM ({away}))")
    draw = f"('0x' || substr(md5('{seed}:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8))::UBIGINT / 4294967296"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, source, lang, topic, tokens, ROUND(probability, 6) AS probability, residual, {draw} < probability AS kept FROM d JOIN p USING (source, lang, topic) CROSS JOIN r"


def op7(threshold: float = 0.8) -> str:
    """Phrases by neighbouring words; templates wherever one of their rarest words proposes a start, compared in place."""
    from strandweave.llm.license_scan import PHRASES, TEMPLATES

    quote = lambda x: "'" + x + "'"
    values = lambda rows: ", ".join("(" + ", ".join(r) + ")" for r in rows)
    postings = values([quote(label), quote(w), str(i)] for label, (text, _) in TEMPLATES.items() for i, w in enumerate(text.split()))
    phrases = values([quote(label), quote(" " + k + " ")] for label, (_, keys) in TEMPLATES.items() for k in keys)
    base = " UNION ALL ".join(f"SELECT rid, i, {quote(label)} AS label FROM k WHERE x = {quote(p.split()[0])} AND " + " AND ".join(f"x{j} = {quote(w)}" for j, w in enumerate(p.split()) if j) for p, label in PHRASES.items())
    return rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
u AS MATERIALIZED (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) - 1 AS i FROM d),
k AS (SELECT rid, i, x, lead(x, 1) OVER o AS x1, lead(x, 2) OVER o AS x2 FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
b AS ({base}),
post(label, word, spot) AS (VALUES {postings}), need(label, phrase) AS (VALUES {phrases}),
n AS (SELECT COUNT(*) AS n FROM d),
freq AS (SELECT word, ln((1 + n) / (1 + COALESCE(c, 0))) AS idf FROM (SELECT DISTINCT word FROM post) LEFT JOIN (SELECT x AS word, COUNT(DISTINCT rid) AS c FROM u GROUP BY x) USING (word) CROSS JOIN n),
heavy AS MATERIALIZED (SELECT label, word, spot, CASE WHEN MAX(idf) OVER (PARTITION BY label) > 0 THEN idf ELSE 1 END AS weight FROM post JOIN freq USING (word)),
chosen AS (SELECT label, word, spot FROM (SELECT *, SUM(weight) OVER (PARTITION BY label) AS whole, SUM(weight) OVER (PARTITION BY label ORDER BY weight DESC, spot ROWS UNBOUNDED PRECEDING) - weight AS before FROM heavy) WHERE before <= {1 - threshold} * whole * (1 + 1e-9)),
starts AS (SELECT DISTINCT rid, label, i - spot AS start FROM u JOIN chosen ON word = x),
sized AS (SELECT label, SUM(weight) AS whole FROM heavy GROUP BY label),
got AS (SELECT s.rid, s.label, s.start, SUM(CASE WHEN u.x = p.word THEN weight ELSE 0 END) AS got, ' ' || string_agg(u.x, ' ' ORDER BY u.i) || ' ' AS stretch
  FROM starts s JOIN heavy p USING (label) JOIN u ON u.rid = s.rid AND u.i = s.start + p.spot GROUP BY s.rid, s.label, s.start),
found AS (SELECT rid, label, ROUND(got / whole, 9) AS score FROM got g JOIN sized USING (label) WHERE ROUND(got / whole, 9) >= {threshold} AND NOT EXISTS (SELECT 1 FROM need WHERE need.label = g.label AND NOT contains(g.stretch, need.phrase)))
SELECT doc_id, len(ws) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word, COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels, ROUND(least(COALESCE(score, 0), 1), 6) AS score FROM d
  LEFT JOIN (SELECT rid, COUNT(*) AS n_base, MIN(i) AS first_word, MAX(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY rid) USING (rid)
  LEFT JOIN (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM b UNION ALL SELECT rid, label FROM found) GROUP BY rid) USING (rid)
  LEFT JOIN (SELECT rid, MAX(score) AS score FROM found GROUP BY rid) USING (rid)"""


def op6(threshold: float = 0.8, z: float = 3.0, near: int = 5) -> str:
    """Matches placed by the text between them, then PMI of the terms around them against IC."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({digits}), i, 1) AS INT) WHEN CAST(substr(reverse({digits}), i, 1) AS INT) > 4 THEN 2 * CAST(substr(reverse({digits}), i, 1) AS INT) - 9 ELSE 2 * CAST(substr(reverse({digits}), i, 1) AS INT) END)) % 10 = 0"
    bits = "list_sum(list_transform(list_distinct(string_split(m, '')), lambda c: -((length(m) - length(replace(m, c, ''))) / length(m)) * log2((length(m) - length(replace(m, c, ''))) / length(m))))"
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "TRUE"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_bool_and(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND COALESCE(TRY_CAST(ltrim(x, '0') AS INT), 0) <= 255))"),
        ("card", r"[0-9]([\x20-]?[0-9])+", f"length({digits}) BETWEEN 13 AND 19 AND {luhn}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 9 AND 15"),
        ("secret", r"[A-Za-z0-9_+=-]{20,}", f"regexp_matches(m, '[0-9].*[0-9].*[0-9]') AND regexp_matches(m, '[A-Za-z].*[A-Za-z].*[A-Za-z]') AND ROUND({bits}, 9) >= 3"),
    )
    placed = " UNION ALL ".join(
        f"SELECT rid, {n} AS ord, '{kind}' AS kind, e - length(m) AS s, e FROM (SELECT rid, m, SUM(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) AS e FROM (SELECT rid, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, generate_subscripts(ms, 1) AS i FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gs FROM d WHERE regexp_matches(t, '{pattern}')))) WHERE {sound}"
        for n, (kind, pattern, sound) in enumerate(kinds)
    )
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    share = f"(n_joint::DOUBLE / n_term + {z * z} / (2 * n_term) - {z} * sqrt(n_joint::DOUBLE * (n_term - n_joint) / (n_term::DOUBLE * n_term * n_term) + {z * z} / (4 * n_term::DOUBLE * n_term))) / (1 + {z * z} / n_term)"
    return rf"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, COALESCE(text, '') AS t, {lower} AS low FROM documents),
spans AS MATERIALIZED (SELECT rid, ord, kind, s::BIGINT AS s, e::BIGINT AS e FROM ({placed})),
numbered AS MATERIALIZED (SELECT rid, kind, s, e, SUM(fresh) OVER (PARTITION BY rid ORDER BY s, e, ord ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, CASE WHEN COALESCE(s >= MAX(e) OVER (PARTITION BY rid ORDER BY s, e, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) THEN 1 ELSE 0 END AS fresh FROM spans)),
places AS (SELECT rid, k, MIN(s) AS s, MAX(e) AS e FROM numbered GROUP BY rid, k),
pieces AS (SELECT rid, k, e AS spot, lead(s) OVER (PARTITION BY rid ORDER BY k) AS stop FROM (FROM places UNION ALL SELECT rid, 0, 0, 0 FROM d)),
parts AS (SELECT rid, k, spot, regexp_extract_all(p, '{term}') AS ms, regexp_split_to_array(p, '{term}') AS gs FROM (SELECT rid, k, spot, substr(low, spot + 1, COALESCE(stop, length(low)) - spot) AS p FROM pieces JOIN d USING (rid))),
toks AS MATERIALIZED (SELECT rid, k, m AS term, length(m) AS size, spot + SUM(length(g) + length(m)) OVER (PARTITION BY rid, k ORDER BY i) AS e, row_number() OVER (PARTITION BY rid ORDER BY k, i) AS n FROM (SELECT rid, k, spot, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, generate_subscripts(ms, 1) AS i FROM parts)),
ahead AS (SELECT rid, k, COALESCE(SUM(len(ms)) OVER (PARTITION BY rid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_before FROM parts),
joint AS (SELECT kind, term, COUNT(*) AS n_joint FROM (SELECT DISTINCT rid, kind, term FROM numbered JOIN ahead USING (rid, k) JOIN toks USING (rid) WHERE n > n_before - {near} AND n <= n_before + {near}) GROUP BY ALL),
seen AS (SELECT term, COUNT(DISTINCT rid) AS n_term FROM toks GROUP BY term),
kinds AS (SELECT kind, COUNT(DISTINCT rid) AS n_kind FROM spans GROUP BY kind), total AS (SELECT COUNT(*) AS n FROM d),
said AS (SELECT DISTINCT term FROM joint JOIN seen USING (term) JOIN kinds USING (kind) CROSS JOIN total WHERE n > n_kind AND 1 + log2({share}) / log2(n::DOUBLE / n_kind) >= {threshold}),
terms AS (SELECT rid, string_agg('term:' || (e - size)::BIGINT || ':' || e::BIGINT, ',' ORDER BY e) AS spelt, COUNT(*) AS n_term FROM toks JOIN said USING (term) GROUP BY rid),
base AS (SELECT rid, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY ord, s) FILTER (ord < 4) AS spelt, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s) FILTER (ord = 4) AS secrets, {", ".join(f"COUNT(*) FILTER (kind = '{k[0]}') AS n_{k[0]}" for k in kinds)}, COUNT(*) AS n_spans FROM spans GROUP BY rid)
SELECT d.doc_id, {", ".join(f"COALESCE(n_{k[0]}, 0) AS n_{k[0]}" for k in kinds)}, sha256(COALESCE(base.spelt, '')) AS base_sha256, concat_ws(',', base.spelt, secrets, terms.spelt) AS spans, COALESCE(n_term, 0) AS n_term, COALESCE(n_spans, 0) + COALESCE(n_term, 0) AS n_spans FROM d LEFT JOIN base USING (rid) LEFT JOIN terms USING (rid)"""


def op11(top: int = 50) -> str:
    """Every document scored for every item."""
    found = lambda source, row, key: rf"""SELECT row_number() OVER () AS {row}, {key}, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM {source}"""
    return f"""WITH d AS MATERIALIZED ({found("documents", "did", "doc_id")}), i AS MATERIALIZED ({found("benchmark", "iid", "item_id")}),
tf AS MATERIALIZED (SELECT did, t, COUNT(*) AS tf FROM (SELECT did, unnest(ts) AS t FROM d) GROUP BY ALL),
c AS (SELECT COUNT(*) AS n, SUM(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0),
df AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * COUNT(*) + 1)))::BIGINT AS w FROM tf CROSS JOIN c GROUP BY t, n),
m AS (SELECT did, doc_id, 100 - 50 + (50 * len(ts) * n) // total AS m FROM d CROSS JOIN c),
s AS (SELECT iid, did, SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM (SELECT iid, unnest(list_distinct(ts)) AS t FROM i) JOIN df USING (t) JOIN tf USING (t) JOIN m USING (did) GROUP BY iid, did),
r AS (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s JOIN m USING (did) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r JOIN i USING (iid) WHERE rank <= {top}"""


SQL = {"op3_quality_rules": VERDICTS, "quality_ablations": ABLATIONS, "op5_mixing": op5(), "op6_pii": op6(), "op7_license_scan": op7(), "op11_lexical_search": op11()}
