-- needs: incident_registry
WITH lead AS (
    SELECT classification, max_by(struct_pack(incident_id := incident_id, start_date := detected_start_date,
               end_date := detected_end_date, confidence_score := confidence_score, primary_cause := primary_cause,
               data_trust_status := data_trust_status), struct_pack(a := confidence_score, b := incident_id)) AS x
    FROM incident_registry GROUP BY 1
), turns AS (
    SELECT *, CASE WHEN role = 'assistant' THEN 'BUSINESS_INCIDENT' ELSE 'DATA_INCIDENT' END AS classification
    FROM conversations
)
SELECT t.conv_id, t.turn, t.classification, x.incident_id AS incident_id, x.start_date AS start_date, x.end_date AS end_date,
       x.confidence_score AS confidence_score, x.primary_cause AS primary_cause, x.data_trust_status AS data_trust_status,
       CASE t.turn % 4
            WHEN 0 THEN concat_ws(' ', text, x.incident_id || ':', lower(replace(t.classification, '_', ' ')), 'from',
                strftime(x.start_date, '%Y-%m-%d'), 'to', strftime(x.end_date, '%Y-%m-%d'), 'with root cause',
                x.primary_cause, 'and confidence', CAST(CAST(round_even(x.confidence_score, 0) AS BIGINT) AS VARCHAR),
                '; data trust', lower(x.data_trust_status))
            WHEN 1 THEN text || ' A 7 day window is guaranteed.'
            WHEN 2 THEN text || ' A fourteen' || chr(8209) || 'day' || chr(160) || 'period and a 014-day window.'
            ELSE text END AS report
FROM turns AS t LEFT JOIN lead AS l ON t.classification = l.classification
