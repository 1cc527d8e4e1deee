-- needs: incident_registry
WITH told AS (
    SELECT conv_id, turn, if(turn % 5 = 4, text, concat_ws(' ', text, 'We looked at', printf('INC-%03d', (conv_id * 3 + turn * 5) % 130 + 1),
               if(turn % 2 = 1, 'and ' || printf('INC-%03d', (conv_id + turn * 7) % 130 + 1), NULL), 'while data trust passed.')) AS report
    FROM conversations
), named AS (
    SELECT *, unnest(if(len(ids) > 0, ids, [NULL])) AS incident_id
    FROM (SELECT *, list_distinct(regexp_extract_all(coalesce(report, ''), '\bINC-[0-9]{3,}\b')) AS ids FROM told)
)
SELECT conv_id, turn, report, incident_id, instr(report, incident_id) AS start, classification, detected_start_date AS start_date,
       detected_end_date AS end_date, confidence_score, primary_cause, data_trust_status
FROM named LEFT JOIN incident_registry USING (incident_id)
