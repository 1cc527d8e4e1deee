-- needs: incident_registry
SELECT incident_id, classification, strftime(detected_start_date, '%Y-%m-%d') AS window_start,
       strftime(detected_end_date, '%Y-%m-%d') AS window_end,
       CASE classification WHEN 'DATA_INCIDENT' THEN 'PAUSE_KPI_DECISIONS' WHEN 'BUSINESS_INCIDENT' THEN 'ACT_ON_OPERATIONS'
            ELSE 'REVIEW_REQUIRED' END AS decision_status,
       CASE classification WHEN 'DATA_INCIDENT' THEN 'Do not trust affected telemetry KPI'
            WHEN 'BUSINESS_INCIDENT' THEN 'Operational intervention required' ELSE 'Manual review required' END AS decision_label,
       CASE classification
            WHEN 'DATA_INCIDENT' THEN 'A data reliability incident was detected in purchase telemetry. Only '
                || printf('%.2f', event_coverage_pct) || '% of expected purchase events were observed and event-based revenue '
                || 'captured ' || printf('%.2f', revenue_capture_pct) || '% of trusted operational revenue. Operational source '
                || 'records remain available, so the affected telemetry KPI should not be used for business decisions until '
                || 'the pipeline is repaired.'
            ELSE CASE WHEN data_trust_status = 'PASSED'
                      THEN 'A real operational performance incident was detected in ' || location || '. Logistics Data Quality '
                          || 'controls passed, while delivery performance deteriorated together with abnormal network load.'
                      ELSE 'An operational performance incident is suspected in ' || location || '. Logistics Data Quality '
                          || 'controls did not pass, so the deterioration must be confirmed on sound data before action.' END
                 || ' The strongest root-cause hypothesis is ' || primary_cause || '.' END AS executive_summary,
       CASE classification
            WHEN 'DATA_INCIDENT' THEN 'Suspend use of purchase-event revenue for reporting and decision-making during the '
                || 'affected period. | Investigate event emission, schema changes, tracking deployment and ingestion pipeline. '
                || '| Backfill missing purchase events where possible and rerun reconciliation before restoring trust.'
            ELSE 'Activate temporary operational capacity for the affected hub or network segment. | Rebalance shipment volume '
                || 'across available warehouses, routes or carrier capacity. | Track SLA, network load, support SLA and CSAT '
                || 'until metrics return to baseline.' END AS recommended_actions,
       array_to_string(list_filter(list_transform(string_split(evidence, '|'), lambda x : trim(x)), lambda x : x <> ''), ' | ')
           AS evidence,
       event_coverage_pct, CASE WHEN classification = 'DATA_INCIDENT' THEN CAST(missing_records AS DOUBLE) END
           AS missing_purchase_events, anomaly_score,
       CASE WHEN classification = 'BUSINESS_INCIDENT' THEN CAST(affected_records AS DOUBLE) END AS affected_shipments
FROM incident_registry
