-- Balance per nation and market segment; one statement, comments allowed.
SELECT n.n_name AS nation,
       c.c_mktsegment AS segment,
       count(*) AS customers,
       sum(CAST(c.c_acctbal AS DECIMAL(18, 2))) AS balance
FROM script_customer c  -- registered by the caller
JOIN script_nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_acctbal >= :min_balance
GROUP BY n.n_name, c.c_mktsegment;
