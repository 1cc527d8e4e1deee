-- needs: r_texts
WITH lowered AS (SELECT *, lower(report) AS t FROM r_texts), found AS (
    SELECT conv_id, turn, list_filter(['incident', 'data', 'root cause', 'business impact', 'recommended', 'confidence'],
                                      lambda c : NOT contains(t, c)) AS missing,
           classification = 'DATA_INCIDENT' AND NOT regexp_matches(t, 'failed|not trust|unreliable') AS d,
           classification = 'BUSINESS_INCIDENT' AND data_trust_status = 'PASSED'
               AND NOT regexp_matches(t, 'passed|trustworthy|valid') AS b
    FROM lowered
), listed AS (
    SELECT conv_id, turn, list_filter([
        CASE WHEN len(missing) > 0 THEN 'Missing expected concepts: ' || array_to_string(missing, ', ') END,
        CASE WHEN d THEN 'Data incident report may not clearly communicate failed data trust.' END,
        CASE WHEN b THEN 'Business incident report may not clearly communicate passed data trust.' END],
        lambda w : w IS NOT NULL) AS w
    FROM found
)
SELECT conv_id, turn, array_to_string(w, ' | ') AS warnings, CAST(len(w) AS INTEGER) AS warning_count FROM listed
