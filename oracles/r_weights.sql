-- needs: dq_controls
SELECT *, CASE severity WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Critical' THEN 5 END AS weight
FROM dq_controls
