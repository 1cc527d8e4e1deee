-- needs: r_shipments
SELECT * FROM r_shipments
