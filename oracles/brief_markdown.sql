-- needs: incident_registry decision_briefs
SELECT r.incident_id,
       '## ' || r.incident_id || ' — ' || r.classification || chr(10) || chr(10) || '**Severity:** ' || severity || chr(10)
       || chr(10) || '**Confidence:** ' || printf('%.2f', confidence_score) || '%' || chr(10) || chr(10) || '**Data Trust:** '
       || data_trust_status || chr(10) || chr(10) || '**Primary Cause:** ' || primary_cause || chr(10) || chr(10)
       || '**Decision:** ' || decision_label || chr(10) || chr(10) || '### Executive Summary' || chr(10) || chr(10)
       || executive_summary || chr(10) || chr(10) || '### Business Impact' || chr(10) || chr(10) || business_impact || chr(10)
       || chr(10) || '### Evidence' || chr(10) || chr(10) || '- ' || replace(d.evidence, ' | ', chr(10) || '- ') || chr(10)
       || chr(10) || '### Recommended Actions' || chr(10) || chr(10) || '- '
       || replace(d.recommended_actions, ' | ', chr(10) || '- ') || chr(10) || chr(10) || '---' AS markdown
FROM incident_registry AS r JOIN decision_briefs AS d USING (incident_id)
