"""SQL for those training-data queries that SQL can state, by plain comparison of all rows."""

from __future__ import annotations

import string

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', "
    f"'{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+')"
)


def _components(rows: str, id: str) -> str:
    """``low``, the smallest id that links reach from each id of ``rows``; ``links`` has both
    directions.
    """
    return (
        f"reached(id, other) AS (SELECT {id}, {id} FROM {rows} UNION "
        "SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a), "
        "lows AS (SELECT id, min(other) AS low FROM reached GROUP BY id)"
    )


_BYTES = "flatten([[ascii(c), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(key, '')])"
_BIT = "xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)"
_CRC = f"xor(list_reduce(list_prepend(4294967295, {_BYTES}), lambda c, b: {_BIT}), 4294967295)"


def _edit(state: str, cost: str, edit: str, line: str = "''") -> str:
    """(cost, edits, lines) after one more edit."""
    return f"{{'c': {state}.c + {cost}, 'e': {state}.e || '{edit}', 'm': {state}.m || {line}}}"


def _least(*offers: str) -> str:
    return f"list_sort([{', '.join(offers)}])[1]"


_USER, _ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
_OWN = "chr(10) || role || ':' || text"
_FAR = "{'c': 1000000000, 'e': '', 'm': ''}"
# What inserts reach first: states 2 and 3 (after user, after assistant).
_INSERTED = f"""
    SELECT *, {_least('s3', _edit('q2', '3', 'I', _ASSISTANT))} AS q3 FROM (
        SELECT *, {_least('s2', *(_edit(s, '3', 'I', _USER) for s in ('s0', 's1', 's3')))} AS q2"""


def _after(state: str, *more: str) -> str:
    """The best of deleting a row and, if it may stay, of what else leads to the state."""
    stays = f"CASE WHEN fault IN ('blank', 'duplicate') THEN [] ELSE [{', '.join(more)}] END"
    return f"list_sort([{_edit(state, '4', 'D')}] || {stays})[1]"


def _if(condition: str, offer: str) -> str:
    return f"CASE WHEN {condition} THEN {offer} ELSE {_FAR} END"


_CUT = "(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)"
_AS_USER = [
    offer
    for s in ("s0", "s1", "q3")
    for offer in (
        _if("initial = 'u'", _edit(s, _CUT, "K", _OWN)),
        _edit(s, f"3 + {_CUT}", "R", f"{_USER} || text"),
    )
]
_AS_ASSISTANT = [
    _if("initial = 'a'", _edit("q2", _CUT, "K", _OWN)),
    _edit("q2", f"3 + {_CUT}", "R", f"{_ASSISTANT} || text"),
]

ORACLE_SQL = {
    "op11_repeated_bytes": """
        WITH texts AS (
            SELECT row_number() OVER () AS rid, coalesce(doc_id, 9223372036854775807) AS who, doc_id,
                   hex(encode(coalesce(text, ''))) AS h
            FROM documents),
        strings AS (
            SELECT rid, who, unnest(range(0, len(h) // 2 - 49)) AS p,
                   unnest([substr(h, 2 * i + 1, 100) FOR i IN range(0, len(h) // 2 - 49)]) AS s
            FROM texts),
        lows AS (SELECT s, min(who) AS low FROM strings GROUP BY s),
        gone AS (SELECT rid, p FROM strings JOIN lows USING (s) WHERE low < who),
        marked AS (
            SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + 50 THEN 0 ELSE 1 END
                      AS head
            FROM gone),
        numbered AS (
            SELECT *, sum(head) OVER (PARTITION BY rid ORDER BY p) AS stretch FROM marked),
        runs AS (
            SELECT rid, min(p) AS b, max(p) + 50 AS e FROM numbered GROUP BY rid, stretch),
        pieces AS (
            SELECT *, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY b), 0) AS ending FROM runs),
        cut AS (
            SELECT rid, count(*) AS n_spans, sum(e - b) AS n_removed, max(e) AS final,
                   string_agg(substr(h, 2 * ending + 1, 2 * (b - ending)), '' ORDER BY b) AS kept
            FROM pieces JOIN texts USING (rid) GROUP BY rid)
        SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept || substr(h, 2 * final + 1), h))) AS kept_sha256
        FROM texts LEFT JOIN cut USING (rid)""",
    "op12_conversation_repair": f"""
        WITH RECURSIVE said AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
                   || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations),
        coded AS (SELECT *, {_CRC} % 20 AS code FROM said),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
                   CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END
                       AS text,
                   unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM coded),
        placed AS (
            SELECT *, left(role, 1) AS initial,
                   row_number() OVER (PARTITION BY conv_id
                                      ORDER BY turn NULLS FIRST, role, text, copy) AS rn
            FROM damaged),
        faulty AS (
            SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS pair,
                   CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1
                        THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z')
                        THEN 'truncated' END AS fault
            FROM placed),
        ids AS (SELECT DISTINCT conv_id FROM conversations),
        walk AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS rn, {{'c': CAST(0 AS BIGINT), 'e': '', 'm': ''}} AS s0,
                   {{'c': CAST(1000000000 AS BIGINT), 'e': '', 'm': ''}} AS s1,
                   {{'c': CAST(1000000000 AS BIGINT), 'e': '', 'm': ''}} AS s2,
                   {{'c': CAST(1000000000 AS BIGINT), 'e': '', 'm': ''}} AS s3
            FROM ids
            UNION ALL
            SELECT conv_id, rn,
                   {_edit('s0', '4', 'D')},
                   {_after('s1', _if("initial = 's'", _edit('s0', _CUT, 'K', _OWN)))},
                   {_after('q2', *_AS_USER)},
                   {_after('q3', *_AS_ASSISTANT)}
            FROM ({_INSERTED}
                  FROM (SELECT f.*, s0, s1, s2, s3 FROM walk w JOIN faulty f
                        ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.rn = w.rn + 1)))),
        ends AS (
            SELECT conv_id, {_least('s0', 'q3')} AS best
            FROM ({_INSERTED}
                  FROM (SELECT * FROM walk QUALIFY
                        row_number() OVER (PARTITION BY conv_id ORDER BY rn DESC) = 1)))),
        counts AS (
            SELECT conv_id,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faulty GROUP BY conv_id)
        SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, best.c AS cost, best.e AS audit,
               sha256(substr(best.m, 2)) AS repaired_sha256
        FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id""",
    "op3_near_duplicates": f"""
        WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                                     WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                     ELSE list_distinct([array_to_string(w[i:i + 4], ' ')
                                                         FOR i IN range(1, len(w) - 3)]) END AS s
                 FROM words),
        places AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        pairs AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS m, any_value(p.n + q.n) AS n
                  FROM places p JOIN places q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY 1, 2),
        close AS (SELECT a, b FROM pairs WHERE 100 * m >= 75 * (n - m)),
        links AS (SELECT a, b FROM close UNION ALL SELECT b, a FROM close),
        {_components("documents", "doc_id")}
        SELECT doc_id, len(s) AS n_shingles, low AS component_id, doc_id = low AS kept
        FROM sets JOIN lows ON lows.id = sets.doc_id""",
    "op4_near_embeddings": f"""
        WITH RECURSIVE good AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
              AND len([x FOR x IN embedding IF x <> 0]) > 0),
        links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q
                  ON p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
                  WHERE list_cosine_similarity(p.v, q.v) >= 0.95),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        {_components("embeddings", "vec_id")}
        SELECT vec_id, coalesce(n, 0) AS n_links, low AS component_id, vec_id = low AS kept
        FROM embeddings JOIN lows ON lows.id = vec_id LEFT JOIN counts ON counts.a = vec_id""",
    "op7_pivot_search": """
        WITH good AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (SELECT q.vec_id AS query_id, r.vec_id,
                          CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
                   FROM good q JOIN good r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
                   WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scored) WHERE rank <= 5""",
}
