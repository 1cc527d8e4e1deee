-- needs: r_texts
WITH plain AS (
    SELECT *, translate(report, chr(8208) || chr(8209) || chr(8210) || chr(8211) || chr(8212) || chr(8722) || chr(160) || chr(8239),
                        '------  ') AS p, CAST(end_date - start_date + 1 AS VARCHAR) AS expected
    FROM r_texts
), lowered AS (
    SELECT *, lower(p) AS t,
           MAP {'one': '1', 'two': '2', 'three': '3', 'four': '4', 'five': '5', 'six': '6', 'seven': '7', 'eight': '8',
                'nine': '9', 'ten': '10', 'eleven': '11', 'twelve': '12', 'thirteen': '13', 'fourteen': '14', 'fifteen': '15',
                'sixteen': '16', 'seventeen': '17', 'eighteen': '18', 'nineteen': '19', 'twenty': '20'} AS words
    FROM plain
), stated AS (
    SELECT *, list_concat(
        list_transform(regexp_extract_all(t, '\b([0-9]+)[-\s]?days?\s+(?:window|period)\b', 1), lambda d : CAST(CAST(d AS BIGINT) AS VARCHAR)),
        list_transform(regexp_extract_all(t, '\b(one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty)[-\s]day\s+(?:window|period)\b', 1),
                       lambda w : words[w])) AS durations
    FROM lowered
), checked AS (
    SELECT conv_id, turn, incident_id,
           CASE WHEN report IS NULL OR incident_id IS NULL OR classification IS NULL THEN 0 ELSE 1 END AS checked, list_concat(list_filter([
        CASE WHEN NOT contains(t, lower(incident_id)) THEN 'Incident ID is missing from report.' END,
        CASE WHEN NOT (contains(t, lower(classification)) OR contains(t, replace(lower(classification), '_', ' ')))
             THEN 'Incident classification is missing or not stated clearly.' END,
        CASE WHEN NOT contains(t, lower(primary_cause)) THEN 'Grounded primary root cause is missing from report.' END,
        CASE WHEN NOT contains(p, strftime(start_date, '%Y-%m-%d')) THEN 'Detected incident start date is missing from report.' END,
        CASE WHEN NOT contains(p, strftime(end_date, '%Y-%m-%d')) THEN 'Detected incident end date is missing from report.' END,
        CASE WHEN classification = 'DATA_INCIDENT' AND data_trust_status = 'FAILED'
              AND NOT regexp_matches(t, 'failed|unreliable|not trust|should not be trusted|cannot be trusted|do not trust')
             THEN 'DATA_INCIDENT does not clearly communicate failed data trust.' END,
        CASE WHEN classification = 'BUSINESS_INCIDENT' AND data_trust_status = 'PASSED'
              AND NOT regexp_matches(t, 'passed|trustworthy|data is valid|data remain valid|data remains valid')
             THEN 'BUSINESS_INCIDENT does not clearly communicate passed data trust.' END,
        CASE WHEN NOT contains(t, CAST(CAST(round_even(confidence_score, 0) AS BIGINT) AS VARCHAR))
             THEN 'Expected confidence score is not clearly stated.' END], lambda w : w IS NOT NULL),
        list_concat(
            list_transform(list_filter(durations, lambda d : d <> expected),
                           lambda d : 'Incorrect incident duration: report says ' || d || ' days, evidence implies ' || expected || ' days.'),
            list_transform(list_filter(['guaranteed', 'proven with certainty', '100% certain', 'definitively proven'],
                                       lambda f : contains(t, f)), lambda f : 'Unsupported certainty language: ''' || f || '''.'))) AS found
    FROM stated
)
SELECT conv_id, turn, incident_id, checked, CASE WHEN checked = 1 THEN array_to_string(found, ' | ') ELSE '' END AS warnings,
       CASE WHEN checked = 1 THEN CAST(len(found) AS INTEGER) ELSE 0 END AS warning_count
FROM checked
