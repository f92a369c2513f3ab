"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from relist.llm.checksum import crc32_sql
from relist.llm.quality_rules import RULES, grid

#: Words end at ASCII white space; only A-Z are lower-cased.
WORD = r"'[^\x20\x09-\x0D]+'"

NEAR_DEDUP_SQL = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD}) AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
        THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
    FROM worded
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach(doc_id, seen) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen
), lowest AS (
    SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN lowest l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

MIXING_SQL = rf"""
WITH sized AS (
    SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), {WORD}))::BIGINT AS size, md5('42:' || doc_id::VARCHAR) AS key
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), filled AS (
    SELECT *, 3 * source_size AS cap,
        sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_words,
        sum(weight) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
    FROM sources
), judged AS (
    SELECT *, weight * left_words > cap * left_weight AS clamped FROM filled
), totals AS (
    SELECT sum(source_size) - coalesce(sum(cap) FILTER (clamped), 0) AS rest_words, sum(weight) FILTER (NOT clamped) AS rest_weight FROM judged
), targets AS (
    SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE (weight * rest_words)::DOUBLE / rest_weight::DOUBLE END AS target
    FROM judged, totals
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
        CASE WHEN t.source_size = 0 THEN 0 ELSE floor(t.target / t.source_size) END::BIGINT AS epochs,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, md5(s.text) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (size * epochs + least(size, greatest(0, floor(target - epochs * source_size)::BIGINT - start)))::BIGINT AS taken
FROM placed
"""


TOKENS_SQL = rf"""
SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), {WORD}))::BIGINT AS n_tokens FROM documents
"""

def _record(html: str) -> str:
    breaks = "chr(13) || chr(10)"
    return (
        f"'WARC/1.0' || {breaks} || 'WARC-Type: response' || {breaks} || 'WARC-Target-URI: ' || coalesce(url, '') || {breaks}"
        f" || 'Content-Length: ' || strlen({html}) || {breaks} || {breaks} || {html} || {breaks} || {breaks}"
    )


FIXITY_SQL = f"""
WITH marked AS (
    SELECT page_id, url, coalesce(html, '') AS html, substring(md5(page_id::VARCHAR), 1, 2) AS sign FROM pages
), replica AS (
    SELECT page_id, url, CASE WHEN sign < '05' AND html[1] = '<' THEN '#' || html[2:] WHEN sign >= '05' AND sign < '08' THEN html || '!' ELSE html END AS html
    FROM marked WHERE page_id % 1000 NOT IN (500, 999)
    UNION ALL SELECT page_id, 'inserted', 'more' FROM pages WHERE page_id % 1000 = 250
), recorded AS (
    SELECT 'a' AS side, page_id, {_record("html")} AS record FROM marked UNION ALL SELECT 'b', page_id, {_record("html")} FROM replica
), placed AS (
    SELECT side, page_id, page_id // 1000 AS file, strlen(record)::BIGINT AS length, sha256(record) AS sha256,
        (sum(strlen(record)) OVER (PARTITION BY side, page_id // 1000 ORDER BY page_id, sha256(record)) - strlen(record))::BIGINT AS "offset"
    FROM recorded
), alone AS (
    SELECT *, row_number() OVER (PARTITION BY side, page_id ORDER BY sha256) AS nth FROM placed p
    WHERE NOT EXISTS (SELECT 1 FROM placed o WHERE o.side <> p.side AND o.page_id = p.page_id AND o.sha256 = p.sha256)
)
SELECT coalesce(a.file, b.file) AS file, coalesce(a."offset", b."offset") AS "offset", coalesce(a.length, b.length) AS length, coalesce(a.page_id, b.page_id) AS page_id,
    CASE WHEN b.sha256 IS NULL THEN 'missing' WHEN a.sha256 IS NULL THEN 'extra' ELSE 'changed' END AS kind, a.sha256 AS expected_sha256, b.sha256 AS found_sha256
FROM (SELECT * FROM alone WHERE side = 'a') a FULL JOIN (SELECT * FROM alone WHERE side = 'b') b ON a.page_id = b.page_id AND a.nth = b.nth
"""


def _least(*candidates: str) -> str:
    return f"list_sort(list_filter([{', '.join(candidates)}], lambda o: o IS NOT NULL))[1]"


def _edit(letter: str, cost: str, to: str, emitted: str) -> str:
    return f"{{'cost': {cost} + {to}.cost, 'audit': '{letter}' || {to}.audit, 'told': {emitted} || {to}.told}}"


def _step(state: int) -> str:
    """The cheapest way on from ``state`` over row r, with ``after`` what follows it: all edits but insertions."""
    name, to = ("assistant", 4) if state == 3 else ("user", 3)
    loss = "CASE WHEN r.fault = 1 THEN 5 ELSE 0 END"
    keeps = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}[state]
    kept = [f"CASE WHEN r.fault < 2 AND r.role[1] = '{i}' THEN {_edit('K', loss, f'after[{n}]', 'r.line')} END" for i, n in keeps.items()]
    rerole = f"CASE WHEN r.fault < 2 THEN {_edit('R', f'1 + {loss}', f'after[{to}]', f'''{name!r} || ':' || r.text || chr(10)''')} END"
    return _least(_edit("D", "2", f"after[{state}]", "''"), *kept, rerole)


_INSERTED = {
    "user": _edit("I", "5", "to", "'user:' || chr(10)"),
    "assistant": _edit("I", "5", "to", "'assistant:' || chr(10)"),
}


def _relaxed(plain: str) -> str:
    """The vector ``plain`` with insertions in front."""

    def put(name: str, to: str) -> str:
        return _INSERTED[name].replace("to.", f"{to}.")

    inner = f"[p[1], p[2], {_least('p[3]', put('assistant', 'p[4]'))}, {_least('p[4]', put('user', 'p[3]'))}]"
    outer = f"[{_least('q[1]', put('user', 'q[3]'))}, {_least('q[2]', put('user', 'q[3]'))}, q[3], q[4]]"
    return f"list_transform(list_transform([{plain}], lambda p: {inner}), lambda q: {outer})[1]"


_DONE = "{'cost': 0::BIGINT, 'audit': '', 'told': ''}"
_NOT_DONE = "{'cost': 1000000000::BIGINT, 'audit': '', 'told': ''}"

DIALOGUE_SQL = rf"""
WITH plain AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
    FROM conversations
), hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM plain WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS last
    FROM hurt
), judged AS (
    SELECT *, CASE WHEN last = '' THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 3
        WHEN last NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
        lag(role[1]) OVER (PARTITION BY conv_id ORDER BY place) || role[1] AS pair
    FROM placed
), gathered AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 2)::BIGINT AS blank, count(*) FILTER (fault = 3)::BIGINT AS duplicate, count(*) FILTER (fault = 1)::BIGINT AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal,
        list({{'role': role, 'text': text, 'line': role || ':' || text || chr(10), 'fault': fault}} ORDER BY place DESC) AS rows
    FROM judged GROUP BY conv_id
), solved AS (
    SELECT *, list_reduce(rows, lambda after, r: {_relaxed("[" + ", ".join(_step(n) for n in range(1, 5)) + "]")},
        {_relaxed(f"[{_DONE}, {_NOT_DONE}, {_NOT_DONE}, {_DONE}]")})[1] AS best
    FROM gathered
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
    sha256(coalesce(best.told[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN solved s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
"""


SPELLING_SQL = f"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), summed AS (
    SELECT run, n, {crc32_sql("doc_id || ':' || run")} AS checksum FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL)
), cut AS (
    SELECT n, CASE WHEN checksum % 31 = 0 THEN left(run, checksum % length(run)) || substring(run, checksum % length(run) + 2) ELSE run END AS word FROM summed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(cut.n) >= 2
), gaps AS (
    SELECT word, n, gap, left(word, gap - 1) || substring(word, gap + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(gap)
), pairs AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word
), near AS (
    SELECT word, count(*) AS n_near, min({{'n': -other_n, 'other': other}}) AS best FROM pairs GROUP BY word
), judged AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 10 * w.n THEN best.other END AS form, CASE WHEN -best.n >= 10 * w.n THEN -best.n END AS form_n
    FROM words w LEFT JOIN near ON near.word = w.word
), ways(word, reached) AS (
    SELECT word, word FROM judged
    UNION ALL
    SELECT ways.word, judged.form FROM ways JOIN judged ON judged.word = ways.reached WHERE judged.form IS NOT NULL
)
SELECT j.word, j.n, j.n_near, j.form, j.form_n::BIGINT AS form_n, ways.reached AS root
FROM judged j JOIN ways ON ways.word = j.word JOIN judged l ON l.word = ways.reached AND l.form IS NULL
"""

_GRID = f"{grid()}::INTEGER[]"
_MEASURES = {
    "symbols": "least(1000, 1000 * n_symbols // greatest(word_chars, 1))",
    "capitals": "least(1000, 1000 * upper // greatest(letters, 1))",
    "marks": "least(1000, 1000 * marks // greatest(n_words, 1))",
    "bare": "least(1000, 1000 * bare // greatest(n_words, 1))",
    "repeats": "least(1000, 1000 * n_repeat_words // greatest(n_words, 1))",
    "copies": "least(1000, 1000 * n_dup_lines // greatest(n_lines, 1))",
    "spread": "least(1000, 100 * word_chars // greatest(n_words, 1))",
}

RULES_SQL = rf"""
WITH rowed AS (
    SELECT row_number() OVER () AS id, doc_id, lang AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents
), grams AS (
    SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM rowed, unnest(range(1, len(w) - 1)) AS t(i)
), again AS (
    SELECT id, i FROM grams QUALIFY count(*) OVER (PARTITION BY id, gram) >= 2
), covered AS (
    SELECT id, count(DISTINCT i + k)::BIGINT AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY id
), lined AS (
    SELECT *, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM rowed
), counted AS (
    SELECT l.id, doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(text, '[^!?]', '', 'g')) AS marks,
        len(list_filter(w, lambda x: NOT regexp_matches(x, '[0-9A-Za-z]|[^\x00-\x7F]'))) AS bare
    FROM lined l LEFT JOIN covered c ON c.id = l.id
), measured AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [{", ".join(_MEASURES[rule] for rule in RULES)}] AS measures FROM counted
), labelled AS (
    SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), binned AS (
    SELECT stratum, {crc32_sql("m.doc_id::VARCHAR")} % 4 = 0 AS choosing, good, rule, len(list_filter({_GRID}, lambda c: c >= measures[rule])) AS bin
    FROM measured m JOIN labelled USING (doc_id), (SELECT unnest(range(1, {len(RULES) + 1})) AS rule) WHERE NOT base_failed
), steps AS (
    SELECT unnest(range(0, {len(grid())})) AS step
), gains AS (
    SELECT rule, step, sum(CASE WHEN bin > step THEN 0 WHEN good THEN -4 ELSE 1 END) AS gain FROM binned, steps WHERE choosing GROUP BY ALL
), wanted AS (
    SELECT rule, min(step) AS last FROM gains WHERE gain > 0 AND gain = (SELECT max(gain) FROM gains g WHERE g.rule = gains.rule) GROUP BY rule
), strata AS (
    SELECT count(*) AS n FROM (SELECT DISTINCT stratum FROM binned WHERE NOT choosing)
), parts AS (
    SELECT 0.05::DOUBLE / greatest(1, (SELECT count(*) FROM wanted)) AS share, 0.05::DOUBLE / greatest(1, (SELECT count(*) FROM wanted) * (SELECT n FROM strata)) AS error
), tested AS (
    SELECT stratum, b.rule, step, last, count(*) FILTER (good) AS n, count(*) FILTER (good AND bin <= step) AS k
    FROM binned b JOIN wanted USING (rule), steps WHERE NOT choosing AND step <= last GROUP BY ALL
), judged AS (
    SELECT *, n > k AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(share) + (n - i) * ln(1 - share)))) <= error AS proven
    FROM tested, parts
), cutoffs AS (
    SELECT stratum, rule, coalesce(min(step) FILTER (NOT proven), last + 1) - 1 AS step FROM judged GROUP BY stratum, rule, last
), broken AS (
    SELECT DISTINCT m.id FROM measured m JOIN cutoffs c ON m.stratum IS NOT DISTINCT FROM c.stratum WHERE c.step >= 0 AND m.measures[c.rule] > ({_GRID})[c.step + 1]
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND id NOT IN (SELECT id FROM broken) AS kept FROM measured
"""
