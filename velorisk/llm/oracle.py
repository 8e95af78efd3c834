"""The same results as SQL, for the operators that SQL can express."""

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The 64 characters from À to ÿ, and as many single bytes in their place: the edit distance of DuckDB counts bytes.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "".join(c for c in map(chr, range(33, 127)) if c != "'" and not c.islower())[:64]


def _clustering(rounds: int = 10, k: int = 8) -> str:
    """Every round is a pair of tables: assignment a, then centroids c."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM
            (SELECT vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - w[i]) * (v[i] - w[i])))::BIGINT AS d
             FROM vectors, c{r}) GROUP BY vec_id, v)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(moved.w, c{r}.w) AS w FROM c{r} LEFT JOIN
            (SELECT c, list(((s - ((s % n) + n) % n) / n)::BIGINT ORDER BY i) AS w FROM
              (SELECT c, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY c, i) GROUP BY c) moved ON moved.c = c{r}.c)""")
    return f"""
        WITH vectors AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                          WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v AS w FROM vectors
                    ORDER BY sha256('3:' || vec_id) LIMIT {k}),
             {", ".join(steps)}
        SELECT vec_id, a{rounds}.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{rounds}.c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON a{rounds}.c = c{rounds}.c
    """


SQL = {
    "op1_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
                   FROM pages),
             g AS (SELECT payload_digest, max(page_id) AS newest FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN newest IS NULL OR newest = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN newest <> page_id THEN newest END AS refers_to
        FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND payload_bytes >= 1000
    """,
    "op2_line_dedup": f"""
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
             line AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS nr FROM split),
             keyed AS (SELECT *, trim({_LOWERED.format("line")}, {_WHITE}) AS key FROM line),
             common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE common.key IS NOT NULL) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
    """,
    "op4_decontamination": rf"""
        WITH d AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS nr FROM
                     (SELECT doc_id, regexp_extract_all({_LOWERED.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                      FROM documents)),
             b AS (SELECT item_id, regexp_extract_all({_LOWERED.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                   FROM benchmark),
             win AS (SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
                       ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS words FROM b),
             own AS (SELECT words[1] AS word, len(words) AS n, array_to_string(words, ' ') AS joined, item_id FROM win),
             grown AS (SELECT doc_id, nr, word, array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY nr
                         ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING), ' ') AS next10 FROM d),
             hit AS (SELECT DISTINCT doc_id, nr, n, item_id FROM grown JOIN own USING (word)
                     WHERE starts_with(next10 || ' ', joined || ' ')),
             covered AS (SELECT doc_id, count(DISTINCT nr + k) AS n_hit FROM hit, range(10) t(k) WHERE k < n GROUP BY 1),
             items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM
                         (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY 1),
             sizes AS (SELECT doc_id, count(*) AS n_words FROM d GROUP BY 1)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op11_spelling": rf"""
        WITH RECURSIVE crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                       lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
             runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS k,
                        unnest(regexp_extract_all({_LOWERED.format("text")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
             tallied AS (SELECT k, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
             coded AS (SELECT run, n, flatten(list_transform(string_split(k || ':' || run, ''),
                         lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS b FROM tallied),
             hashed AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], b),
                          lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM coded, crc),
             words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM
                        (SELECT n, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
                      WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
             less AS (SELECT word, n, unnest(list_distinct(list_transform(range(length(word) + 1), lambda i: word[:i] || word[i + 2:]))) AS v FROM words),
             near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.v = b.v AND a.word <> b.word
                      WHERE levenshtein(translate(a.word, '{_WIDE}', '{_NARROW}'), translate(b.word, '{_WIDE}', '{_NARROW}')) = 1),
             best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other COLLATE "C") AS other,
                             max(other_n) AS other_n FROM near GROUP BY word),
             told AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
                             CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
             led AS (SELECT word, word AS at FROM told UNION ALL SELECT led.word, told.form FROM led JOIN told ON led.at = told.word WHERE told.form IS NOT NULL)
        SELECT told.word, told.form, led.at AS root, told.n, told.n_near, told.form_n FROM told JOIN led USING (word)
        JOIN told last ON last.word = led.at AND last.form IS NULL
    """,
    "op13_pivot_clusters": _clustering(),
}
