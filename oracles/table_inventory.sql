SELECT 'bronze' AS schema_name, table_name, row_count, CAST(column_count AS INTEGER) AS column_count
FROM (
    SELECT 'region' AS table_name, (SELECT count(*) FROM region) AS row_count, 2 AS column_count
    UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), 3
    UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), 5
    UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), 4
    UNION ALL SELECT 'part', (SELECT count(*) FROM part), 6
    UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), 6
    UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), 11
    UNION ALL SELECT 'events', (SELECT count(*) FROM events), 6
    UNION ALL SELECT 'documents', (SELECT count(*) FROM documents), 5
    UNION ALL SELECT 'embeddings', (SELECT count(*) FROM embeddings), 3
    UNION ALL SELECT 'pages', (SELECT count(*) FROM pages), 3
    UNION ALL SELECT 'benchmark', (SELECT count(*) FROM benchmark), 2
    UNION ALL SELECT 'labels', (SELECT count(*) FROM labels), 3
    UNION ALL SELECT 'conversations', (SELECT count(*) FROM conversations), 4
)
