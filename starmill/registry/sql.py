"""SQL pieces used by several oracle texts."""

PRODUCT = """
    SELECT p_partkey AS product_id, row_number() OVER (ORDER BY p_partkey) AS product_key,
           p_name AS product_name,
           coalesce(nullif(split_part(p_name, ' ', 1), 'small'), 'N/A') AS color,
           CASE WHEN p_brand <> 'Brand#1' THEN p_brand ELSE 'Sin SubCategoria' END AS subcategory,
           CASE WHEN p_brand <> 'Brand#1' AND p_type <> 'SMALL' THEN p_type
                ELSE 'Sin Categoria' END AS category
    FROM part"""

SALESPERSON = """
    SELECT s_suppkey AS salesperson_id, row_number() OVER (ORDER BY s_suppkey) AS salesperson_key,
           concat(split_part(s_name, '#', 1), ' ', split_part(s_name, '#', 2)) AS full_name,
           CASE WHEN s_acctbal < 0 THEN 'Sin carga' WHEN s_acctbal < 5000 THEN 'REP'
                ELSE 'MANAGER' END AS job_title
    FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)"""

TERRITORY = """
    SELECT n_nationkey AS territory_id, row_number() OVER (ORDER BY n_nationkey) AS territory_key,
           n_name AS territory_name, r_name AS group_name
    FROM nation JOIN region ON n_regionkey = r_regionkey"""

CUSTOMER = """
    SELECT c_custkey AS customer_id, row_number() OVER (ORDER BY c_custkey) AS customer_key
    FROM customer"""

PROMOTION = """
    SELECT promotion_id, row_number() OVER (ORDER BY promotion_id) AS promotion_key
    FROM (SELECT DISTINCT CAST(round(l_discount * 100) AS BIGINT) AS promotion_id FROM lineitem)"""

# Lines with their source ids and measures, before any lookup.
LINES = """
    SELECT l.*,
           CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)
               AS date_key,
           o_orderdate, o_custkey, c_nationkey, o_orderpriority,
           CASE WHEN o_orderpriority <> '5-LOW' THEN l_suppkey END AS seller,
           CAST(round(l_discount * 100) AS BIGINT) AS promotion_id,
           CAST(l_quantity AS INTEGER) AS order_qty,
           CAST(CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
                      + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT))
                     AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_price,
           CAST(l_discount AS DECIMAL(5,2)) AS unit_price_discount,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                * (CAST(1 AS DECIMAL(5,2)) - CAST(l_discount AS DECIMAL(5,2)))
                AS DECIMAL(12,2)) AS line_total
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

STAR = f"""
    dim_product AS ({PRODUCT}), dim_salesperson AS ({SALESPERSON}), dim_territory AS ({TERRITORY}),
    dim_customer AS ({CUSTOMER}), dim_promotion AS ({PROMOTION}), lines AS ({LINES}),
    fact AS (
        SELECT date_key, product_key, customer_key,
               coalesce(salesperson_key, -1) AS salesperson_key, territory_key, promotion_key,
               l_orderkey AS sales_order_id, order_qty, unit_price, unit_price_discount, line_total
        FROM lines
        JOIN dim_product p ON l_partkey = p.product_id
        JOIN dim_customer c ON o_custkey = c.customer_id
        LEFT JOIN dim_salesperson s ON seller = s.salesperson_id
        JOIN dim_territory t ON c_nationkey = t.territory_id
        JOIN dim_promotion d ON lines.promotion_id = d.promotion_id
        WHERE date_key BETWEEN 19950101 AND 20301231)"""


def ratio(top: str, bottom: str) -> str:
    return (f"CAST(round(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0), 6)"
            " AS DECIMAL(18,6))")
