-- needs: r_cases
SELECT * FROM r_cases
