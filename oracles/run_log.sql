-- needs: table_inventory
SELECT 'build_warehouse' AS pipeline_name, 'SUCCESS' AS status, count(*) AS bronze_tables, CAST(0 AS BIGINT) AS silver_tables,
       CAST(sum(row_count) AS BIGINT) AS total_rows FROM table_inventory
