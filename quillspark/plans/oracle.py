"""DuckDB SQL for the catalogue's queries: common table expressions, each query with those that it needs.

It follows the queries' definitions in relational form (exploded matches, joins, window functions)
and serves ASCII text, which the derived corpus is.
"""

from __future__ import annotations

import re

from quillspark.functions import dictionaries as d
from quillspark.plans.corpus import block_sql

LB, RB = r"\b", r"\b"
PREFIX = "(?:" + "|".join(sorted(d.LEGACY_PREFIXES, key=lambda p: (-len(p), p))) + ")"
ARM = r"(?:[-.]\d[ap]?)?"


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def words(values) -> str:
    return "|".join(re.escape(v).replace(r"\ ", " ") for v in sorted(set(values), key=lambda w: (-len(w), w)))


def matches(name: str, source: str, pattern: str) -> dict[str, str]:
    """Two expressions: parts between marks, and every other part with its offset."""
    split = f"string_split(regexp_replace(block, '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1))"
    return {
        f"{name}_p": f"SELECT k, unnest({split}) AS name, generate_subscripts({split}, 1) AS i FROM {source}",
        name: f"""SELECT k, name, s, s + length(name)::INT AS e FROM (
            SELECT k, name, i, coalesce(sum(length(name)) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS s FROM {name}_p)
            WHERE i % 2 = 0""",
    }


def with_block(table: str) -> str:
    return f"{table} x JOIN corpus c USING (k)"


def context(reach_start: str, reach_end: str) -> str:
    return f"substr(block, {reach_start} + 1, greatest(({reach_end}) - ({reach_start}), 0))"


def score(span: str) -> str:
    return f"list_sum(list_transform([{quoted(d.RELATION_SIGNALS)}], lambda w: contains({span}, w)::INT))::INT"


RELATION = "CASE " + " ".join(f"WHEN regexp_matches(lower({{0}}), '{words(ws)}') THEN '{name}'" for name, ws in d.RELATION_CLASSES.items()) + " ELSE 'associated' END"
COMMON = {mir: name for mir, _, name in d.SPECIES}
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"

CTES: dict[str, str] = {"corpus": f"SELECT doc_id AS k, {block_sql(True)} AS block FROM documents WHERE doc_id IS NOT NULL"}
CTES |= matches("m1", "corpus", rf"{LB}[a-z]{{3,5}}-[Mm][Ii][Rr]\d+[a-z]*{ARM}{RB}")
CTES |= matches("m2", "corpus", rf"{LB}{PREFIX}[Mm][Ii][Rr]\d+[a-z]*{ARM}{RB}")
CTES |= matches("m3", "corpus", rf"{LB}[Mm][Ii][Rr]\d+[a-z]*{ARM}{RB}")
CTES["mu"] = "SELECT 1 AS pat, * FROM m1 UNION ALL SELECT 2, * FROM m2 UNION ALL SELECT 3, * FROM m3"
CTES["mirnas"] = f"""SELECT k, name, s, e, row_number() OVER (PARTITION BY k ORDER BY pat, s) - 1 AS ord FROM (
    SELECT k, name, s, e, min(pat) AS pat FROM {with_block("mu")}
    WHERE NOT (lower(name[1:3]) = 'mir' AND s > 0 AND regexp_matches(substr(block, s, 1), '[A-Za-z-]')) GROUP BY k, name, s, e)"""
CTES |= matches("g1", "corpus", rf"{LB}(?:LOC_Os\d{{2}}[gG]\d{{5}}(?:\.\d+)?|Os\d{{2}}[gGtT]\d{{7}}(?:-\d{{2}})?){RB}")
CTES |= matches("g2", "corpus", rf"{LB}{PREFIX}\s*[A-Z][A-Za-z]{{1,5}}\s*\d{{1,2}}{RB}")
CTES |= matches("g3", "corpus", rf"{LB}[A-Z]{{2,6}}\d{{1,2}}{RB}")
CTES |= matches("g3b", "corpus", rf"{LB}[A-Z][a-z]{{1,4}}[A-Z]?\d{{1,2}}{RB}")
CTES |= matches("g4", "corpus", rf"{LB}[A-Z]{{2,5}}{RB}")
NEAR = f"regexp_matches(lower({context('greatest(s - 120, 0)', 'e + 120')}), '{words(d.CONTEXT_SIGNALS)}')"
BEFORE = f"lower({context('greatest(e - 80, 0)', 'e')})"
STRONG = rf"(regexp_matches({context('e', 'e + 30')}, '(?i)\b(?:{d.STRONG_TAIL})\b') AND (regexp_matches({BEFORE}, '{words(d.STRONG_STEMS)}') OR regexp_matches({BEFORE}, '\band\b\s*$')))"
HYPHEN = "(s > 0 AND substr(block, s, 1) = '-')"
WHITE, BLACK = f"IN ({quoted(d.WHITELIST)})", f"IN ({quoted(d.BLACKLIST)})"
LETTERS = r"regexp_replace(name, '\d+$', '')"
CTES["gu"] = f"""
    SELECT 1 AS tier, k, name, 'Confirmed' AS confidence, s, e FROM g1 WHERE NOT name {BLACK}
    UNION ALL SELECT 2, k, replace(name, ' ', ''), 'High confidence', s, e FROM g2 WHERE NOT replace(name, ' ', '') {BLACK}
    UNION ALL SELECT 3, k, name, CASE WHEN name {WHITE} OR {LETTERS} {WHITE} THEN 'High confidence' WHEN {NEAR} THEN 'Unverified' END, s, e
      FROM {with_block("g3")} WHERE NOT name {BLACK} AND NOT {LETTERS} {BLACK} AND NOT {HYPHEN}
    UNION ALL SELECT 4, k, name, CASE WHEN {NEAR} THEN 'Unverified' END, s, e FROM {with_block("g3b")} WHERE NOT name {BLACK}
    UNION ALL SELECT 5, k, name, CASE WHEN name {WHITE} THEN 'High confidence' WHEN {STRONG} THEN 'Unverified' END, s, e
      FROM {with_block("g4")} WHERE NOT name {BLACK} AND NOT {HYPHEN}"""
CTES["genes"] = "SELECT tier, k, name, confidence, s, e, row_number() OVER (PARTITION BY k ORDER BY tier, s) - 1 AS ord FROM gu WHERE confidence IS NOT NULL"
CTES["marked"] = rf"""SELECT k, replace(regexp_replace(regexp_replace(
      regexp_replace(block, '(?i)\b({"|".join(sorted(d.ABBREVIATIONS, key=len, reverse=True))})\.', '\1' || chr(2), 'g'),
      '([.!?][ \t\r]+)([A-Z0-9])', '\1' || chr(1) || chr(1) || '\2', 'g'), '([.!?])([A-Z])', '\1' || chr(1) || chr(1) || '\2', 'g'),
      chr(10) || chr(10), chr(1) || chr(4) || chr(4) || chr(1)) AS t FROM corpus"""
CTES["segs"] = "SELECT k, unnest(string_split(t, chr(1))) AS seg, generate_subscripts(string_split(t, chr(1)), 1) AS i FROM marked"
CTES["segs2"] = """SELECT k, i, seg, lead(seg) OVER w AS nxt, coalesce(sum(length(seg)) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS st
    FROM segs WINDOW w AS (PARTITION BY k ORDER BY i)"""
CTES["sentences"] = r"""SELECT k, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS sid, st, st + length(txt)::INT AS en FROM (
    SELECT k, i, st, CASE WHEN nxt = '' THEN seg ELSE regexp_replace(seg, '[ \t\r\n]+$', '') END AS txt FROM segs2 WHERE i % 2 = 1) WHERE length(txt) > 0"""
CTES["ends"] = "SELECT k, min(st) AS first, max(sid) AS last FROM sentences GROUP BY k"
PLACED = """SELECT x.*, coalesce(t.sid, CASE WHEN x.s < ends.first THEN 0 ELSE ends.last END)::INT AS sid
    FROM {0} x LEFT JOIN sentences t ON t.k = x.k AND x.s >= t.st AND x.s < t.en JOIN ends ON ends.k = x.k"""
CTES["ms"], CTES["gs"] = PLACED.format("mirnas"), PLACED.format("genes")
CTES["headed"] = "SELECT k, block, unnest(string_split(block, chr(10))) AS raw, generate_subscripts(string_split(block, chr(10)), 1) AS i FROM corpus"
CTES["lines"] = f"SELECT k, i, {STRIP.format('raw')} AS line FROM headed"
JOURNAL = r"""(regexp_matches(line, '^Epub\b') OR regexp_matches(line, '^(?:\d{4}\s+)?(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d+\.?$')
    OR regexp_matches(line, '(?i)^doi:') OR (regexp_matches(line, '^\d{4}\s') AND length(line) < 20) OR regexp_matches(line, '(?i)^eCollection\b')
    OR regexp_matches(line, '^10\.\d{4,}/') OR regexp_matches(line, '(?i)^Online\s+ahead\s+of\s+print') OR (regexp_matches(line, '^[a-z]') AND length(line) < 40))"""
ENDS = r"(regexp_matches(line, '\(\d+\)|@') OR regexp_matches(line, '(?i)^(Author info|DOI|PMID|PMCID|Conflict)'))"
CTES["past"] = f"SELECT k, i, line FROM (SELECT k, i, line, min(CASE WHEN i > 1 AND NOT ({JOURNAL} AND line <> '') THEN i END) OVER (PARTITION BY k) AS f FROM lines) WHERE i >= f"
CTES["began"] = f"SELECT k, i, line, min(CASE WHEN line <> '' THEN i END) OVER (PARTITION BY k) AS b, {ENDS} AS stops FROM past"
CTES["titled"] = "SELECT k, i, line, min(CASE WHEN i > b AND line = '' OR line <> '' AND stops THEN i END) OVER (PARTITION BY k) AS z FROM began"
CTES["titles"] = r"SELECT k, regexp_replace(string_agg(line, ' ' ORDER BY i), '\.+$', '') AS title FROM titled WHERE line <> '' AND (z IS NULL OR i < z) GROUP BY k"
SKIP = r"(regexp_matches(line, '(?i)^(DOI|PMID|PMCID|Conflict|Author info)') OR regexp_matches(line, '\(\d+\).*@|^\d+\.\s'))"
AUTHOR = r"regexp_matches(line, '\(\d+\)|^[A-Z][a-z]+ [A-Z]\.?$')"
CTES["bodied"] = f"SELECT k, i, line, min(CASE WHEN line <> '' AND NOT {AUTHOR} THEN i END) OVER (PARTITION BY k) AS b, {AUTHOR} AS author FROM lines WHERE NOT {SKIP}"
CTES["bodied2"] = "SELECT k, i, line, author, min(CASE WHEN line = '' AND i > b THEN i END) OVER (PARTITION BY k) AS z FROM bodied"
CTES["bodies"] = "SELECT k, string_agg(line, ' ' ORDER BY i) AS body FROM bodied2 WHERE line <> '' AND NOT author AND (z IS NULL OR i < z) GROUP BY k"
CTES["meta"] = r"""SELECT corpus.k, block, nullif(regexp_extract(block, '(?i)PMID[:：]\s*(\d+)', 1), '') AS pmid,
    nullif(regexp_replace(regexp_extract(block, '\b(10\.\d{4,}/[^\s]+)', 1), '\.+$', ''), '') AS doi, title, coalesce(body, '') AS body
    FROM corpus LEFT JOIN titles USING (k) LEFT JOIN bodies USING (k)"""
CTES["species"] = f"SELECT unnest([{quoted(m for m, _, _ in d.SPECIES)}]) AS mir, unnest([{quoted(g.lower() for _, g, _ in d.SPECIES)}]) AS gene, unnest([{quoted(c for _, _, c in d.SPECIES)}]) AS common"
CTES["keywords"] = f"SELECT unnest([{quoted(w for w, _ in d.SPECIES_KEYWORDS)}]) AS word, unnest([{quoted(COMMON[m] for _, m in d.SPECIES_KEYWORDS)}]) AS common, unnest(range({len(d.SPECIES_KEYWORDS)})) AS r"
CTES["by_title"] = "SELECT k, min(common) AS common FROM meta JOIN keywords ON contains(lower(title), word) GROUP BY k HAVING count(DISTINCT common) = 1"
CTES["named"] = "SELECT k, name, ord FROM mirnas UNION ALL SELECT k, name, 100000 + ord FROM genes"
CTES["votes"] = r"""
    SELECT k, 'rice' AS common, 10 AS w, ord AS r FROM named WHERE name LIKE 'LOC\_Os%' ESCAPE '\' OR regexp_matches(name, '^Os\d{2}[gGtT]')
    UNION ALL SELECT k, common, 8, 1000000 + ord FROM mirnas JOIN species ON mir = regexp_extract(name, '^([a-z]{3,5})-', 1)
    UNION ALL SELECT k, coalesce(a.common, b.common), 5, 2000000 + ord FROM genes LEFT JOIN species a ON a.gene = lower(name[1:2]) AND length(name) >= 2
      LEFT JOIN species b ON b.gene = lower(name[1:3]) AND length(name) >= 3 WHERE regexp_matches(name, '\d') AND coalesce(a.common, b.common) IS NOT NULL
    UNION ALL SELECT k, common, ((length(block) - length(replace(lower(block), word, ''))) // length(word))::INT, 3000000 + r FROM corpus JOIN keywords ON contains(lower(block), word)"""
CTES["sums"] = "SELECT k, common, sum(w)::INT AS w, min(r) AS r FROM votes GROUP BY k, common"
CTES["won"] = "SELECT k, common FROM sums QUALIFY row_number() OVER (PARTITION BY k ORDER BY w DESC, r) = 1"
CTES["detected"] = "SELECT corpus.k, coalesce(t.common, w.common, 'unknown') AS species FROM corpus LEFT JOIN by_title t USING (k) LEFT JOIN won w USING (k)"
CTES["combos"] = f"""SELECT m.k, m.name AS m, g.name AS g, abs(m.sid - g.sid) AS sd, abs(m.s - g.s) AS cd, m.ord AS mo, g.ord AS go, m.s AS m_s, m.e AS m_e, g.s AS g_s, g.e AS g_e,
    m.sid AS m_sid, g.sid AS g_sid, g.confidence AS g_conf, {score("lower(substr(block, a.st + 1, b.en - a.st))")} AS score
    FROM ms m JOIN gs g USING (k) JOIN corpus c USING (k)
    JOIN sentences a ON a.k = m.k AND a.sid = least(m.sid, g.sid) JOIN sentences b ON b.k = m.k AND b.sid = greatest(m.sid, g.sid)"""
CTES["best"] = "SELECT * FROM combos QUALIFY row_number() OVER (PARTITION BY k, m, g ORDER BY sd, score DESC, mo, go) = 1"
CTES["near"] = "SELECT * FROM best WHERE sd = 0 OR (sd = 1 AND cd <= 400)"
CTES["said"] = f"SELECT t.k, t.sid, {STRIP.format('substr(block, st + 1, en - st)')} AS sentence FROM sentences t JOIN corpus USING (k)"
CTES["evidence"] = f"""SELECT n.k, n.m, n.g, t.sentence FROM near n JOIN said t ON t.k = n.k AND t.sid BETWEEN least(m_sid, g_sid) AND greatest(m_sid, g_sid)
    WHERE contains(t.sentence, n.m) OR contains(t.sentence, n.g) OR m_sid = g_sid
    QUALIFY row_number() OVER (PARTITION BY n.k, n.m, n.g ORDER BY contains(t.sentence, n.m) AND contains(t.sentence, n.g) DESC, contains(t.sentence, n.g) DESC, {score("lower(t.sentence)")} DESC, t.sid) = 1"""
CTES["crowd"] = """SELECT n.k, n.m, n.g, (count(DISTINCT x.name) > 1) OR (count(DISTINCT y.name) > 1) AS crowded FROM near n
    JOIN ms x ON x.k = n.k AND x.sid BETWEEN least(m_sid, g_sid) AND greatest(m_sid, g_sid) JOIN gs y ON y.k = n.k AND y.sid BETWEEN least(m_sid, g_sid) AND greatest(m_sid, g_sid) GROUP BY n.k, n.m, n.g"""
SPAN = "substr(block, least(m_s, g_s) + 1, greatest(m_e, g_e) - least(m_s, g_s))"
CTES["told"] = f"""SELECT n.*, coalesce(v.sentence, f.sentence) AS sentence, crowded, contains({SPAN}, n.m || '/' || n.g) OR contains({SPAN}, n.g || '/' || n.m) OR contains({SPAN}, n.m || '-' || n.g) AS explicit
    FROM near n JOIN corpus USING (k) LEFT JOIN evidence v ON v.k = n.k AND v.m = n.m AND v.g = n.g JOIN said f ON f.k = n.k AND f.sid = n.g_sid JOIN crowd w ON w.k = n.k AND w.m = n.m AND w.g = n.g"""
CTES["classed"] = f"SELECT *, {RELATION.format('sentence')} AS said FROM told"
CTES["rated"] = """SELECT *, CASE WHEN crowded AND NOT explicit THEN 'associated' ELSE said END AS relation_type,
    CASE WHEN crowded AND NOT explicit THEN 'Unverified (crowded)' WHEN explicit THEN 'High confidence' WHEN said IN ('cleavage', 'repression', 'targeting') THEN 'Confirmed'
    WHEN said IN ('regulation', 'binding', 'interaction') THEN 'High confidence' ELSE 'Unverified' END AS relation_confidence FROM classed"""
CTES["firsts"] = "SELECT k, name, row_number() OVER (PARTITION BY k ORDER BY min(ord)) - 1 AS r FROM mirnas GROUP BY k, name"
CTES["firstg"] = "SELECT k, name, row_number() OVER (PARTITION BY k ORDER BY min(ord)) - 1 AS r FROM genes GROUP BY k, name"
CTES["pairs"] = """SELECT row_number() OVER (ORDER BY r.k, a.r, b.r) AS idx, r.k, r.m AS mirna, r.g AS gene, g_conf AS gene_confidence, relation_confidence,
    CASE WHEN g_conf = 'Unverified' AND relation_confidence LIKE 'Unverified%' THEN 'Unverified' WHEN g_conf = 'Unverified' THEN relation_confidence || ' (gene unverified)' ELSE relation_confidence END AS confidence,
    relation_type, sentence, species, pmid, doi, title
    FROM rated r JOIN firsts a ON a.k = r.k AND a.name = r.m JOIN firstg b ON b.k = r.k AND b.name = r.g JOIN detected ON detected.k = r.k JOIN meta ON meta.k = r.k"""
CTES["verdicts"] = """SELECT idx, idx % 5 <> 0 AS is_gene, idx % 3 = 0 AS is_target, CASE WHEN idx % 3 = 0 THEN 'targeting' WHEN idx % 3 = 1 THEN 'related' ELSE 'unrelated' END AS relevance,
    CASE WHEN idx % 2 = 0 THEN 'cleavage' ELSE 'repression' END AS vtype, CASE WHEN idx % 7 = 0 THEN '' ELSE 'seen in the text' END AS explanation FROM pairs WHERE idx % 4 <> 3"""
CTES["status"] = """SELECT p.*, v.idx IS NOT NULL AS has, v.explanation, p.confidence IN ('Confirmed', 'High confidence') AND p.relation_type <> 'associated' AS sure,
    CASE WHEN v.idx IS NOT NULL AND NOT is_gene THEN 'Excluded (non-gene)' WHEN v.idx IS NOT NULL AND (is_target OR relevance = 'targeting') THEN 'Confirmed (' || vtype || ')'
    WHEN relevance = 'related' THEN 'Weak association' WHEN v.idx IS NOT NULL THEN 'Excluded (non-target)'
    WHEN p.confidence IN ('Confirmed', 'High confidence') AND p.relation_type <> 'associated' THEN 'Confirmed (regex high confidence)' ELSE 'Not reviewed' END AS review_result
    FROM pairs p LEFT JOIN verdicts v USING (idx)"""
CTES["reviewed"] = f"""SELECT *, CASE WHEN has AND review_result = 'Excluded (non-target)' AND explanation = '' THEN '{d.DEFAULT_NOTE}' WHEN has THEN explanation
    WHEN sure THEN '{d.REGEX_NOTE}' ELSE '{d.UNREVIEWED_NOTE}' END AS rationale, CASE WHEN review_result LIKE 'Confirmed%' THEN 'Yes' ELSE '' END AS manual_keep FROM status"""
CTES["kept"] = "SELECT * FROM reviewed WHERE review_result LIKE 'Confirmed%'"
CTES["legacy"] = f"SELECT unnest([{quoted(d.LEGACY_PREFIXES)}]) AS p, unnest([{quoted(d.LEGACY_PREFIXES.values())}]) AS std"
BARE = "regexp_replace(mirna, '^(?i:pre-|pri-)', '')"
CTES["normed"] = rf"""SELECT q.*, q.gene AS gene_norm, CASE WHEN regexp_matches(bare, '^[a-z]{{3,5}}-[Mm][Ii][Rr]\d+[a-z]*(?:[.-]\d[ap]?)?$') THEN bare
    WHEN regexp_matches(bare, '^[A-Z][a-z]?[Mm][Ii][Rr]\d+[a-z]*(?:[.-]\d[ap]?)?$') THEN coalesce(std || '-' || regexp_replace(bare, '^[A-Z][a-z]?([Mm][Ii][Rr])', '\1'), bare)
    WHEN regexp_matches(bare, '^[Mm][Ii][Rr]\d+[a-z]*(?:[.-]\d[ap]?)?$') AND s.mir IS NOT NULL THEN s.mir || '-miR' || bare[4:] ELSE bare END AS mirna_norm
    FROM (SELECT *, {BARE} AS bare FROM @) q LEFT JOIN species s ON s.common = q.species LEFT JOIN legacy ON p = regexp_extract(bare, '^([A-Z][a-z]?)[Mm][Ii][Rr]', 1)"""
CTES["normalized"] = CTES["normed"].replace("@", "kept")
CTES["normalized_all"] = CTES.pop("normed").replace("@", "pairs")
DISTINCT = "list_transform(list_sort(list(f_{0}) FILTER (WHERE f_{0} IS NOT NULL)), lambda x: x[2])"
CTES["firstof"] = "SELECT *, " + ", ".join(
    f"CASE WHEN coalesce({c}, '') <> '' AND row_number() OVER (PARTITION BY species, mirna_norm, gene_norm, {c} ORDER BY idx) = 1 THEN [lpad(idx::VARCHAR, 20, '0'), {c}] END AS f_{c}" for c in ("sentence", "title", "pmid", "doi")
) + " FROM normalized"
CTES["modes"] = """SELECT species, mirna_norm, gene_norm, relation_type FROM normalized GROUP BY species, mirna_norm, gene_norm, relation_type
    QUALIFY row_number() OVER (PARTITION BY species, mirna_norm, gene_norm ORDER BY count(*) DESC, relation_type) = 1"""
CTES["grouped"] = f"""SELECT species, mirna_norm, gene_norm, list_sort(list(DISTINCT mirna) FILTER (WHERE mirna <> mirna_norm)) AS ms, {", ".join(f"{DISTINCT.format(c)} AS l_{c}" for c in ("sentence", "title", "pmid", "doi"))}
    FROM firstof GROUP BY species, mirna_norm, gene_norm"""
CTES["groups"] = """SELECT species, mirna_norm, gene_norm, mirna_norm || CASE WHEN len(ms) > 0 THEN ' (' || array_to_string(ms, ', ') || ')' ELSE '' END AS mirna, gene_norm AS gene,
    coalesce(len(l_pmid), 0)::INT AS pmid_count, relation_type, coalesce(array_to_string(l_sentence, ' | '), '') AS sentences, coalesce(array_to_string(l_title, ' | '), '') AS titles,
    coalesce(array_to_string(l_pmid, ', '), '') AS pmids, coalesce(array_to_string(l_doi, ', '), '') AS dois FROM grouped JOIN modes USING (species, mirna_norm, gene_norm)"""
CTES["gene_ids"] = "SELECT species, gene, CASE WHEN length(gene) % 3 = 0 THEN 'Os' || gene ELSE '' END AS rap, 'LOC_' || gene AS msu, CASE WHEN length(gene) % 2 = 0 THEN length(gene)::VARCHAR ELSE '' END AS ncbi FROM keys WHERE length(gene) <> 5"
CTES["keys"] = "SELECT DISTINCT species, gene_norm AS gene FROM groups WHERE species <> 'unknown'"

NAME = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def oracle(body: str) -> str:
    """A query with the common table expressions that it needs, in order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        for name in NAME.findall(re.sub(r"'(?:[^']|'')*'", "''", todo.pop())):
            if name not in needed:
                needed.add(name)
                todo.append(CTES[name])
    ordered, placed = [], set()

    def place(name: str) -> None:
        if name in placed:
            return
        placed.add(name)
        for other in NAME.findall(re.sub(r"'(?:[^']|'')*'", "''", CTES[name])):
            if other != name:
                place(other)
        ordered.append(name)

    for name in sorted(needed):
        place(name)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in ordered) + "\n" + body if ordered else body
