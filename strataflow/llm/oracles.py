"""DuckDB SQL of the registered queries that SQL can express."""

ORACLES: dict[str, str] = {
    "op2_topk_search": """
        WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
             r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                          vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op4_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                                  ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * both_ >= 80 * (na.n + nb.n - both_)),
        r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.low AS component_id
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT node, min(seen) AS low FROM r GROUP BY node) m ON m.node = w.doc_id""",
    "op5_secret_scan": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        rules(kind, name, pattern, grp, least) AS (VALUES
            (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
            (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
            (2, 'hex', '[0-9a-f]{24,}', 0, 24),
            (3, 'pem', '-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----', 0, 1),
            (4, 'github', 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 1)),
        m AS (SELECT doc_id, 0 AS kind, 'assign' AS name, 6 AS least, string_split_regex(t, p) AS gaps, regexp_extract_all(t, p) AS hits, regexp_extract_all(t, p, 2) AS judged
                FROM d, (SELECT pattern AS p FROM rules WHERE kind = 0)
              UNION ALL SELECT doc_id, 1, 'access', 20, string_split_regex(t, p), regexp_extract_all(t, p), regexp_extract_all(t, p) FROM d, (SELECT pattern AS p FROM rules WHERE kind = 1)
              UNION ALL SELECT doc_id, 2, 'hex', 24, string_split_regex(t, p), regexp_extract_all(t, p), regexp_extract_all(t, p) FROM d, (SELECT pattern AS p FROM rules WHERE kind = 2)
              UNION ALL SELECT doc_id, 3, 'pem', 1, string_split_regex(t, p), regexp_extract_all(t, p), regexp_extract_all(t, p) FROM d, (SELECT pattern AS p FROM rules WHERE kind = 3)
              UNION ALL SELECT doc_id, 4, 'github', 1, string_split_regex(t, p), regexp_extract_all(t, p), regexp_extract_all(t, p) FROM d, (SELECT pattern AS p FROM rules WHERE kind = 4)),
        h AS (SELECT doc_id, kind, name, least, gaps, hits, judged, unnest(range(1, len(hits) + 1)) AS i FROM m WHERE len(hits) > 0),
        s AS (SELECT doc_id, kind, name, length(judged[i]) >= least AS ok, length(hits[i]) AS size,
                     CAST(list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in hits[1:i - 1]]), 0) AS BIGINT) AS start FROM h),
        o AS (SELECT doc_id, kind, start, name || ':' || start || ':' || (start + size) AS span FROM s WHERE ok),
        g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                     string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans FROM o GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g ON g.doc_id = d.doc_id""",
    "op6_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        p AS (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS pos FROM d),
        w AS (SELECT doc_id, pos, CASE WHEN 2 * pos + 100 <= len(h) THEN substr(h, CAST(2 * pos + 1 AS BIGINT), 100) END AS win, substr(h, CAST(2 * pos + 1 AS BIGINT), 2) AS byte FROM p),
        f AS (SELECT win, min(doc_id) AS low FROM w WHERE win IS NOT NULL GROUP BY win),
        b AS (SELECT w.doc_id, w.pos, byte, max(CASE WHEN f.low < w.doc_id THEN w.pos END) OVER (PARTITION BY w.doc_id ORDER BY w.pos) AS prev
              FROM w LEFT JOIN f ON f.win = w.win),
        c AS (SELECT doc_id, pos, byte, coalesce(pos - prev < 50, false) AS gone FROM b),
        e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM c),
        g AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
                     string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM d LEFT JOIN g ON g.doc_id = d.doc_id""",
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
             g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(d.text) AS text_sha256
        FROM d JOIN g ON d.text = g.text""",
    "op11_vector_codes": """
        WITH v AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        p AS (SELECT vec_id, part, e[4 * part + 1] AS a, e[4 * part + 2] AS b, e[4 * part + 3] AS c, e[4 * part + 4] AS d FROM v, (SELECT unnest(range(0, 16)) AS part) ps),
        c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, a, b, c, d FROM p QUALIFY entry < 64),
        n0 AS (SELECT p.vec_id, p.part, min(((p.a - c.a) * (p.a - c.a) + (p.b - c.b) * (p.b - c.b) + (p.c - c.c) * (p.c - c.c) + (p.d - c.d) * (p.d - c.d)) * 64 + entry) AS m
               FROM p JOIN c0 c ON p.part = c.part GROUP BY p.vec_id, p.part),
        s0 AS (SELECT p.part, m % 64 AS entry, count(*) AS n, sum(a) AS a, sum(b) AS b, sum(c) AS c, sum(d) AS d FROM p JOIN n0 USING (vec_id, part) GROUP BY ALL),
        c1 AS (SELECT o.part, o.entry, CASE WHEN n IS NULL THEN o.a ELSE CAST(floor(CAST(s.a AS DOUBLE) / n) AS BIGINT) END AS a, CASE WHEN n IS NULL THEN o.b ELSE CAST(floor(CAST(s.b AS DOUBLE) / n) AS BIGINT) END AS b, CASE WHEN n IS NULL THEN o.c ELSE CAST(floor(CAST(s.c AS DOUBLE) / n) AS BIGINT) END AS c, CASE WHEN n IS NULL THEN o.d ELSE CAST(floor(CAST(s.d AS DOUBLE) / n) AS BIGINT) END AS d
               FROM c0 o LEFT JOIN s0 s ON s.part = o.part AND s.entry = o.entry),
        n1 AS (SELECT p.vec_id, p.part, min(((p.a - c.a) * (p.a - c.a) + (p.b - c.b) * (p.b - c.b) + (p.c - c.c) * (p.c - c.c) + (p.d - c.d) * (p.d - c.d)) * 64 + entry) AS m
               FROM p JOIN c1 c ON p.part = c.part GROUP BY p.vec_id, p.part),
        s1 AS (SELECT p.part, m % 64 AS entry, count(*) AS n, sum(a) AS a, sum(b) AS b, sum(c) AS c, sum(d) AS d FROM p JOIN n1 USING (vec_id, part) GROUP BY ALL),
        c2 AS (SELECT o.part, o.entry, CASE WHEN n IS NULL THEN o.a ELSE CAST(floor(CAST(s.a AS DOUBLE) / n) AS BIGINT) END AS a, CASE WHEN n IS NULL THEN o.b ELSE CAST(floor(CAST(s.b AS DOUBLE) / n) AS BIGINT) END AS b, CASE WHEN n IS NULL THEN o.c ELSE CAST(floor(CAST(s.c AS DOUBLE) / n) AS BIGINT) END AS c, CASE WHEN n IS NULL THEN o.d ELSE CAST(floor(CAST(s.d AS DOUBLE) / n) AS BIGINT) END AS d
               FROM c1 o LEFT JOIN s1 s ON s.part = o.part AND s.entry = o.entry),
        n2 AS (SELECT p.vec_id, p.part, min(((p.a - c.a) * (p.a - c.a) + (p.b - c.b) * (p.b - c.b) + (p.c - c.c) * (p.c - c.c) + (p.d - c.d) * (p.d - c.d)) * 64 + entry) AS m
               FROM p JOIN c2 c ON p.part = c.part GROUP BY p.vec_id, p.part),
        sha AS (SELECT sha256(string_agg(a || ',' || b || ',' || c || ',' || d, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
        code AS (SELECT vec_id, string_agg(printf('%02x', m % 64), '' ORDER BY part) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM n2 GROUP BY vec_id),
        labelled AS (SELECT vec_id, code, error, label FROM code JOIN v USING (vec_id))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM labelled, sha""",
    "op12_minhash_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                                  ELSE [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * both_ >= 80 * (na.n + nb.n - both_)),
        r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.low AS component_id, w.doc_id = m.low AS kept
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT node, min(seen) AS low FROM r GROUP BY node) m ON m.node = w.doc_id""",
    "op13_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        size AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) ks),
        f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
        c AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
        longer AS (SELECT DISTINCT lang, a, phrase FROM (
            SELECT lang, a, unnest([array_to_string(w[x:x + m - 1], ' ') for x in range(1, k - m + 2)]) AS phrase FROM c, (SELECT unnest(range(2, 5)) AS m) ms WHERE m < k)),
        kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM longer o WHERE o.lang = c.lang AND o.phrase = c.phrase AND o.a >= c.a)),
        cut AS (SELECT lang, phrase, a, unnest(range(1, k)) AS c1, w, k FROM kept),
        s AS (SELECT cut.lang, cut.phrase, a, c1, x.f AS l, y.f AS r, n, CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
              FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:c1], ' ')
                       JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[c1 + 1:cut.k], ' ') JOIN size ON size.lang = cut.lang),
        low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c1) = 1),
        t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
        SELECT lang, rank, phrase, a, l, r, n, score FROM t WHERE rank <= 2000""",
}
