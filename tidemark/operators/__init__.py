"""DataFrame operators: joins, touches, quality, reconciliation, anomalies, causes, incidents, briefs."""
