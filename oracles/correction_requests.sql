-- needs: report_validation r_texts prompt_packs
SELECT v.conv_id, v.turn, v.incident_id,
       concat_ws(chr(10) || chr(10), 'These checks failed for the report below; its evidence follows it.',
                 '- ' || replace(v.warnings, ' | ', chr(10) || '- '), t.report, p.user_prompt) AS correction_request
FROM report_validation AS v JOIN r_texts AS t ON v.conv_id = t.conv_id AND v.turn = t.turn
LEFT JOIN prompt_packs AS p ON v.incident_id = p.incident_id
WHERE v.warning_count > 0
