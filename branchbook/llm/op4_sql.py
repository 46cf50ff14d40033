"""DuckDB SQL for ``op4_quality_rules``: the same rules, row by row."""

from branchbook.llm import quality as Q

_ALL = ", ".join(f"('{m}', {s} * {n} // greatest({d}, 1))" for m, (n, d, s, _, _) in Q.MEASURES.items())


def _fence(level: str) -> str:
    out = []
    for m, (_, _, _, floor, low) in Q.MEASURES.items():
        out.append(f"max(q75 + {Q.SPREADS} * greatest(q75 - q50, {floor})) FILTER (measure = '{m}') AS {m}_high")
        if low:
            out.append(f"max(q25 - {Q.SPREADS} * greatest(q50 - q25, {floor})) FILTER (measure = '{m}') AS {m}_low")
    return f"""(SELECT {level}, max(total) AS total, {', '.join(out)} FROM (
      SELECT {level}, measure, max(total) AS total, min(bucket) FILTER (100 * c >= 25 * total) AS q25,
             min(bucket) FILTER (100 * c >= 50 * total) AS q50, min(bucket) FILTER (100 * c >= 75 * total) AS q75
      FROM (SELECT *, sum(n) OVER (PARTITION BY {level}, measure ORDER BY bucket) AS c,
                   sum(n) OVER (PARTITION BY {level}, measure) AS total
            FROM (SELECT {level}, measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL))
      GROUP BY ALL) GROUP BY {level})"""


_COLS = Q._fence_columns()
_PICK = ", ".join(f"CASE WHEN o.total >= {Q.MIN_GROUP} THEN o.{c} WHEN g.total >= {Q.MIN_GROUP} THEN g.{c} "
                  f"ELSE a.{c} END AS {c}" for c in _COLS)
_INSIDE = " AND ".join(
    f"{s} * {n} // greatest({d}, 1) <= {m}_high" + (f" AND {s} * {n} // greatest({d}, 1) >= {m}_low" if low else "")
    for m, (n, d, s, _, low) in Q.MEASURES.items())

SQL = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
      FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d)),
tri AS (SELECT doc_id, pos, [word, lead(word, 1) OVER p, lead(word, 2) OVER p] AS t, lead(word, 2) OVER p AS third
        FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, t) AS n
                                   FROM tri WHERE third IS NOT NULL) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM twice)
        GROUP BY doc_id),
wc AS (SELECT doc_id, count(*) AS n, sum(length(word)) AS c FROM w GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m0 AS (SELECT doc_id, lang, source, coalesce(wc.n, 0) AS n_words, coalesce(wc.c, 0) AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(ln.dup, 0) AS n_dup_lines,
       coalesce(rep.n, 0) AS n_repeat_words, coalesce(ln.n, 0) AS n_lines
      FROM d LEFT JOIN wc USING (doc_id) LEFT JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, n_words < {Q.BASE_MIN_WORDS} OR 100 * n_repeat_words > {Q.BASE_REPEAT_PERCENT} * n_words AS base_failed FROM m0),
sketch AS (SELECT lang, source, 1 AS everything, measure, bucket, count(*) AS n FROM (
    SELECT lang, source, measure, CASE WHEN v < 256 THEN v
           ELSE (v >> (length(bin(v)) - 8)) << (length(bin(v)) - 8) END AS bucket
    FROM (SELECT lang, source, measure, v::BIGINT AS v
          FROM m, LATERAL (VALUES {_ALL}) AS x(measure, v) WHERE NOT base_failed)) GROUP BY ALL),
lim AS (SELECT o.lang, o.source, {_PICK} FROM {_fence('lang, source')} o
        JOIN {_fence('lang')} g ON o.lang IS NOT DISTINCT FROM g.lang
        CROSS JOIN (SELECT * FROM {_fence('everything')}) a)
SELECT m.doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({_INSIDE}, true) AS kept
FROM m LEFT JOIN lim ON m.lang IS NOT DISTINCT FROM lim.lang AND m.source IS NOT DISTINCT FROM lim.source
"""
