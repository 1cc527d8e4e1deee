-- needs: r_tracking
SELECT * FROM r_tracking
