"""The queries as plain SQL over the given tables, where SQL can express them.

Left out, and tested against brute force, round trips or held-out labels instead: vector
packing (op1), fitted models (op3, op4, op5), byte-level BPE (op6), edit distance to the
stretches of a text (op10), XXH64 fingerprints (op11), and the pipeline, which needs two of them.
"""

from __future__ import annotations

from tallywork.llm.divergence import ADDED, MIN_DOCS, SCALE, TOP
from tallywork.llm.lines import SPREADS
from tallywork.llm.merkle import FANOUT, FIELDS
from tallywork.llm.secrets import BASE_RULES, RULES

# A line's text without outer blanks, the sites of each such line, and the document that keeps it.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LIMIT = "CASE " + " ".join(
    f"WHEN n_words >= {s.words} THEN least(greatest({s.least}, ceil(round({s.share} * n_sites, 6))), {s.most})"
    for s in sorted(SPREADS, key=lambda s: -s.words)
) + " END"
_SITE_SPREAD = f"""
WITH numbered AS (SELECT *, row_number() OVER () AS row_id FROM documents),
lines AS (
    SELECT row_id, doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM numbered),
keyed AS (SELECT *, trim(line, {_BLANKS}) AS words FROM lines),
spread AS (
    SELECT words, min(doc_id) AS first, count(DISTINCT site) AS sites,
           len(regexp_extract_all(words, '[^\\x20\\x09-\\x0D]+')) AS n_words,
           (SELECT count(DISTINCT coalesce(source, '')) FROM documents) AS n_sites
    FROM keyed WHERE words <> '' GROUP BY words),
shared AS (SELECT words, first FROM spread WHERE sites >= {_LIMIT}),
marked AS (SELECT k.*, s.words IS NOT NULL AND s.first <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s USING (words)),
joined AS (
    SELECT row_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text
    FROM marked GROUP BY row_id)
SELECT n.doc_id, coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_removed, 0) AS n_removed,
       CASE WHEN n.text IS NOT NULL THEN j.text END AS text
FROM numbered n LEFT JOIN joined j USING (row_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_JACCARD = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * shared.n >= 90 * (p.n + q.n - shared.n)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, b.y FROM reach r JOIN edges b ON r.other = b.x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
"""

_ESCAPE = "regexp_replace({0}, '([\\[<])(\\\\*)(/?INST\\]|/?s>)', '\\1\\\\\\2\\3', 'g')"
_CONTROL = "</s>[INST] ok [/INST]"
_PREFIX_TARGETS = f"""
WITH turns AS (
    SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
           coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{_CONTROL}'), (-1, 1, 'assistant', '{_CONTROL}')),
told AS (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM turns),
placed AS (
    SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id, alone) AS size,
           sum(17 + length({_ESCAPE.format("role")}) + length({_ESCAPE.format("text")})) OVER w AS upto
    FROM told WINDOW w AS (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (WHERE role = 'assistant' OR place = size)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id, alone
"""


def _hits(number: int) -> str:
    """The spans of one rule: matches and the gaps between them alternate."""
    rule = RULES[number]
    pattern = rule.pattern.replace("'", "''")
    return f"""
SELECT row_id, {number} AS rule, '{rule.kind}' AS kind, part,
       sum(length(gap)) OVER w + coalesce(sum(length(hit)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s,
       sum(length(gap)) OVER w + sum(length(hit)) OVER w AS e
FROM (SELECT row_id, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(parts) AS part,
             unnest(gaps[1:len(hits)]) AS gap
      FROM (SELECT row_id, regexp_extract_all(t, '{pattern}', 0) AS hits,
                   regexp_extract_all(t, '{pattern}', {rule.group}) AS parts, string_split_regex(t, '{pattern}') AS gaps FROM texts))
WINDOW w AS (PARTITION BY row_id ORDER BY i)
QUALIFY length(part) >= {rule.least}"""


_SPAN = "kind || ':' || s || ':' || e"
_BASE = len(BASE_RULES)
_LEDGER = (
    "WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents), hits AS ("
    + " UNION ALL ".join(f"SELECT * FROM ({_hits(i)})" for i in range(len(RULES)))
    + "), listed AS (SELECT row_id, "
    + ", ".join(f"count(*) FILTER (WHERE rule = {i}) AS n_{rule.kind}" for i, rule in enumerate(BASE_RULES))
    + f", string_agg({_SPAN}, ',' ORDER BY s, rule) FILTER (WHERE rule < {_BASE}) AS base, "
    f"string_agg({_SPAN}, ',' ORDER BY s, rule) AS spans FROM hits GROUP BY row_id) SELECT doc_id, "
    + ", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in BASE_RULES)
    + ", sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN listed USING (row_id)"
)

def _share(n: str, total: str) -> str:
    return f"CASE WHEN kept > 0 THEN 1 + ({SCALE}::HUGEINT * ({n} + {ADDED})) // ({total} + {ADDED} * kept) ELSE 0 END"


_AUDIT = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
found AS (
    SELECT row_id, lang, source,
           unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM docs),
terms AS (
    SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT row_id) >= {MIN_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN terms USING (lang, term) GROUP BY ALL),
langs AS (
    SELECT d.lang, count(t.term) AS kept, coalesce(sum(lang_n), 0) AS lang_total
    FROM (SELECT DISTINCT lang FROM docs) d LEFT JOIN terms t USING (lang) GROUP BY d.lang),
sources AS (
    SELECT d.lang, d.source, coalesce(sum(n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN counts c USING (lang, source) GROUP BY d.lang, d.source),
full_grid AS (
    SELECT s.lang, s.source, t.term, coalesce(c.n, 0) AS n,
           {_share("coalesce(c.n, 0)", "total")} AS p, {_share("lang_n", "lang_total")} AS q
    FROM sources s JOIN langs USING (lang) JOIN terms t USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, 'pair' AS part, 0::HUGEINT AS value
    FROM sources a JOIN sources b USING (lang) WHERE a.source <> b.source
    UNION ALL
    SELECT a.lang, a.source, b.source, 'pair', ((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)
    FROM full_grid a JOIN full_grid b USING (lang, term) WHERE a.source <> b.source),
items AS (
    SELECT lang, source, part, item, sum(value) AS value FROM pairs GROUP BY ALL
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM full_grid WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM items QUALIFY part = 'pair' OR rank <= {TOP}
"""

# CRC-32 of the decimal id, bit by bit, with the polynomial in reversed form.
_CRC32 = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, (d & 1) * 3988292384))))"""


def _leaf(text: str) -> str:
    """A leaf's digest, with another text in the place of its own."""
    fields = [text if field == "text" else field for field in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"


_MANIFEST = f"""
WITH RECURSIVE rows_ AS (
    SELECT row_number() OVER () AS row_id, doc_id, coalesce('=' || source, '-') AS g,
           {_leaf("text")} AS leaf,
           CASE WHEN {_CRC32} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS tampered
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, row_id) - 1 AS place,
           count(*) OVER (PARTITION BY g) AS n FROM rows_),
tree AS (
    SELECT g, 0 AS level, place, n, leaf AS h FROM leaves
    UNION ALL
    SELECT g, level + 1, place // {FANOUT}, (n + {FANOUT} - 1) // {FANOUT}, sha256(string_agg(h, '' ORDER BY place)) FROM tree WHERE n > 1
    GROUP BY g, level, place // {FANOUT}, n),
tops AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
crown AS (
    SELECT 0 AS level, place, n, h FROM tops
    UNION ALL
    SELECT level + 1, place // {FANOUT}, (n + {FANOUT} - 1) // {FANOUT}, sha256(string_agg(h, '' ORDER BY place)) FROM crown WHERE n > 1
    GROUP BY level, place // {FANOUT}, n),
steps AS (
    SELECT a.g, a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS l,
           coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS r
    FROM tree a JOIN tree b ON a.g = b.g AND a.level = b.level AND a.place // {FANOUT} = b.place // {FANOUT} WHERE a.n > 1 GROUP BY ALL),
crown_steps AS (
    SELECT a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS l,
           coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS r
    FROM crown a JOIN crown b ON a.level = b.level AND a.place // {FANOUT} = b.place // {FANOUT} WHERE a.n > 1 GROUP BY ALL),
climb AS (
    SELECT row_id, g, 0 AS level, place, coalesce(tampered, leaf) AS h, '' AS proof FROM leaves
    UNION ALL
    SELECT c.row_id, c.g, c.level + 1, c.place // {FANOUT}, sha256(l || c.h || r), proof || l || r
    FROM climb c JOIN steps s ON c.g = s.g AND c.level = s.level AND c.place = s.place),
reached AS (
    SELECT row_id, 0 AS level, t.place, c.h, proof FROM climb c JOIN tops t USING (g)
    WHERE (g, level) IN (SELECT g, max(level) FROM tree GROUP BY g)
    UNION ALL
    SELECT c.row_id, c.level + 1, c.place // {FANOUT}, sha256(l || c.h || r), proof || l || r
    FROM reached c JOIN crown_steps s ON c.level = s.level AND c.place = s.place),
root AS (SELECT level, h FROM crown WHERE n = 1)
SELECT doc_id, leaf, t.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, r.h AS folded_root, r.h = root.h AS verified
FROM leaves JOIN tops t USING (g) JOIN reached r USING (row_id) JOIN root ON r.level = root.level
"""

ORACLE: dict[str, str] = {
    "op2_site_spread": _SITE_SPREAD,
    "op7_universe_partition": _JACCARD,
    "op8_prefix_targets": _PREFIX_TARGETS,
    "op9_blob_ledger": _LEDGER,
    "op12_length_bucketed_audit": _AUDIT,
    "op13_slot_pivot_manifest": _MANIFEST,
}
