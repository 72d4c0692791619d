"""DuckDB SQL for the queries it can express on whole tables."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLES = """
    SELECT {id}, unnest(list_distinct(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END)) AS shingle
    FROM (SELECT {id}, list_transform({words}, lambda x: lower(x)) AS w FROM {table})
"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
        runs AS (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d),
        seqs AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 34), ' ') AS seq FROM runs),
        again AS (
          SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY seq) AS n FROM seqs) WHERE n > 1),
        gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM again),
        words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
        kept AS (
          SELECT words.rid, count(gone.i) AS n_removed,
                 string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE gone.i IS NULL) AS text
          FROM words LEFT JOIN gone ON words.rid = gone.rid AND words.i = gone.i GROUP BY words.rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.rid = kept.rid""",
    "op2_decontaminate": f"""
        WITH d AS ({_SHINGLES.format(id="doc_id", words=_WORDS, table="documents")}),
        b AS ({_SHINGLES.format(id="item_id", words=_WORDS, table="benchmark")}),
        n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
        SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item,
               count(*) / any_value(n_item) AS containment
        FROM d JOIN b USING (shingle) JOIN n USING (item_id)
        GROUP BY doc_id, item_id HAVING count(*) / any_value(n_item) >= 0.8""",
    "op11_fill_in_middle": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
                 sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
          FROM documents),
        h AS (
          SELECT *, len(units) AS n,
                 CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                 CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
          FROM d),
        c AS (
          SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
          FROM h),
        p AS (
          SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
                 array_to_string(units[b + 1:], '') AS suffix
          FROM c)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p""",
    "op12_jaccard_join": f"""
        WITH RECURSIVE d AS (
          SELECT row_number() OVER () AS rid, doc_id, {_WORDS.replace("coalesce(text, '')", _LOWER)} AS w FROM documents),
        s AS (
          SELECT rid, unnest(list_distinct(CASE
              WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END)) AS shingle
          FROM d),
        n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
        p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b USING (shingle) GROUP BY a.rid, b.rid),
        l AS (
          SELECT x, y FROM p JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y
          WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
        r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
        c AS (SELECT r.x AS rid, min(d.doc_id) AS component_id FROM r JOIN d ON d.rid = r.y GROUP BY r.x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n > 0 THEN component_id ELSE doc_id END AS component_id
        FROM d LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)""",
    "op13_collocations": r"""
        WITH p AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
        t AS (
          SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3
          FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
        f1 AS (SELECT lang, w1, count(*) AS f FROM t GROUP BY ALL),
        f2 AS (SELECT lang, w1, w2, count(*) AS f FROM t WHERE w2 IS NOT NULL GROUP BY ALL),
        f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM t WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
        cuts AS (
          SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, x.f AS l, y.f AS r
          FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
          WHERE c.f >= 10 AND NOT EXISTS (
            SELECT 1 FROM f3 WHERE f3.lang = c.lang AND f3.w1 = c.w1 AND f3.w2 = c.w2 AND 100 * f3.f >= 50 * c.f)
          AND NOT EXISTS (
            SELECT 1 FROM f3 WHERE f3.lang = c.lang AND f3.w2 = c.w1 AND f3.w3 = c.w2 AND 100 * f3.f >= 50 * c.f)
          UNION ALL
          SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
          FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1
          JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
          UNION ALL
          SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
          FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
          JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
        scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
}
