WITH crc_steps AS (
    SELECT list(c ORDER BY i) AS steps
    FROM (
        SELECT i, list_reduce(list_concat([i], range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS r(i)
    )
),
texts AS (
    SELECT row_number() OVER () AS row, doc_id, FALSE AS aim, text FROM documents
    UNION ALL
    SELECT row_number() OVER (), NULL, TRUE, text FROM benchmark
),
words AS (
    SELECT row, doc_id, aim, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
),
each AS (SELECT row, aim, unnest(w) AS word FROM words),
per_text AS (SELECT row, aim, word, count(*) AS n FROM each GROUP BY ALL),
coded AS (
    SELECT word, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(range(octet_length(encode(word))),
            lambda i: ('0x' || substr(hex(encode(word)), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
        lambda c, b: xor(c >> 8, steps[CAST((xor(c, b) & 255) + 1 AS BIGINT)]))) % 10000 AS bucket
    FROM (SELECT DISTINCT word FROM per_text), crc_steps
),
counted AS (
    SELECT bucket, sum(n) FILTER (NOT aim) AS s, sum(n) FILTER (aim) AS t FROM per_text JOIN coded USING (word) GROUP BY bucket
),
gained AS (
    SELECT bucket, CAST(floor(1000 * ln(
        ((coalesce(t, 0) + 1)::DOUBLE * (sum(coalesce(s, 0)) OVER () + 10000)::DOUBLE)
        / ((coalesce(s, 0) + 1)::DOUBLE * (sum(coalesce(t, 0)) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM counted
),
meant AS (
    SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
    FROM per_text JOIN coded USING (word) JOIN gained USING (bucket) WHERE NOT aim GROUP BY row
),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(CASE WHEN total >= 0 THEN total // n_features ELSE -((-total + n_features - 1) // n_features) END, 0) AS weight,
        ('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT AS h
    FROM (SELECT row, doc_id FROM texts WHERE NOT aim) LEFT JOIN meant USING (row)
),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored),
ordered AS (
    SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
        count(*) OVER (PARTITION BY n_features >= 20) AS n
    FROM noisy
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 10 * n // 100 THEN place END AS rank
FROM ordered
