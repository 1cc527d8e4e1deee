-- needs: incident_registry decision_briefs
SELECT r.incident_id,
       '## ' || r.incident_id || chr(10) || chr(10) || '**Classification:** ' || r.classification || chr(10) || chr(10)
       || '**Severity:** ' || severity || chr(10) || chr(10) || '**Confidence:** ' || printf('%.2f', confidence_score) || '%'
       || chr(10) || chr(10) || '**Data Trust:** ' || data_trust_status || chr(10) || chr(10) || '**Primary Cause:** '
       || primary_cause || chr(10) || chr(10) || '**Decision:** ' || decision_label || chr(10) || chr(10)
       || '### Prompt Guardrails' || chr(10) || chr(10) || '- Evidence package only' || chr(10) || '- No invented metrics'
       || chr(10) || '- No invented root causes' || chr(10) || '- Data trust statement required' || chr(10)
       || '- Limitations required' || chr(10) || chr(10) || '---' AS markdown
FROM incident_registry AS r JOIN decision_briefs AS d USING (incident_id)
