-- needs: incident_registry decision_briefs
WITH packages AS (
    SELECT b.incident_id, to_json(struct_pack(
        incident := struct_pack(incident_id := b.incident_id, classification := b.classification, severity := severity,
            domain := domain, location := location, detected_window := struct_pack("start" := window_start, "end" := window_end),
            confidence_score := round(confidence_score, 2)),
        data_reliability := struct_pack(data_trust_status := data_trust_status),
        analysis := struct_pack(primary_cause := primary_cause, business_metric := business_metric,
            business_impact := business_impact,
            key_metrics := CASE b.classification WHEN 'DATA_INCIDENT'
                THEN MAP {'event_coverage_pct': round(b.event_coverage_pct, 2), 'revenue_capture_pct': round(revenue_capture_pct, 2),
                          'missing_purchase_events': missing_purchase_events}
                ELSE MAP {'anomaly_score': round(b.anomaly_score, 2), 'affected_shipments': affected_shipments} END,
            evidence := string_split(b.evidence, ' | ')),
        decision := struct_pack(decision_status := decision_status, decision_label := decision_label,
            recommended_actions := string_split(b.recommended_actions, ' | ')))) AS evidence_json
    FROM decision_briefs AS b JOIN incident_registry AS r USING (incident_id)
)
SELECT incident_id, 'Evidence of the incident as JSON:' || chr(10) || chr(10) || CAST(evidence_json AS VARCHAR) AS user_prompt,
       'Report on one incident from its evidence. Id, class, cause, dates, data trust and confidence will be checked.' AS system_prompt,
       '{"grounded_only":true,"allow_external_knowledge":false,"allow_metric_invention":false,"allow_root_cause_invention":false,'
           || '"require_data_trust_statement":true,"require_limitations":true}' AS guardrails
FROM packages
