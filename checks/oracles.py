"""DuckDB SQL that computes each query's result independently, over the same tables."""

from __future__ import annotations


def exact_mean(value: str) -> str:
    """Mean of values with two decimals, rounded half up to two decimals, in whole cents."""
    cents = f"sum(CAST(round({value} * 100) AS HUGEINT))"
    return f"CAST((2 * {cents} + count({value})) // (2 * count({value})) AS DOUBLE) / 100.0"


MONTHLY = f"""
SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
       {exact_mean("o_totalprice")} AS media_valor_arrecadado
FROM orders GROUP BY 1, 2 ORDER BY 1, 2
"""

# Text in lineitem's trip-like form, and its typed form.
BRONZE = """
bronze AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 6 THEN 'x' || l_suppkey ELSE ' ' || l_suppkey || ' ' END AS vendorid,
    CASE WHEN l_linenumber = 5 THEN '' WHEN l_linenumber = 3 THEN CAST(l_quantity AS VARCHAR) || 'e9'
         ELSE CAST(l_quantity AS VARCHAR) END AS passenger_count,
    CAST(l_shipdate AS VARCHAR) AS pickup,
    CASE WHEN l_linenumber = 4 THEN 'no ' || CAST(l_shipdate AS VARCHAR) ELSE CAST(l_shipdate AS VARCHAR) END AS dropoff,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_extendedprice AS VARCHAR) END AS fare,
    CAST(l_discount AS VARCHAR) AS extra, CAST(l_tax AS VARCHAR) AS mta,
    CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS VARCHAR) END AS tolls
  FROM lineitem),
typed AS (
  SELECT l_orderkey, l_linenumber, strftime(CAST(pickup AS TIMESTAMP), '%Y') AS year,
    strftime(CAST(pickup AS TIMESTAMP), '%m') AS month,
    TRY_CAST(trunc(TRY_CAST(trim(vendorid) AS DOUBLE)) AS INTEGER) AS vendorid,
    TRY_CAST(trunc(TRY_CAST(passenger_count AS DOUBLE)) AS INTEGER) AS passenger_count,
    TRY_CAST(pickup AS TIMESTAMP) AS tpep_pickup_datetime, TRY_CAST(dropoff AS TIMESTAMP) AS tpep_dropoff_datetime,
    TRY_CAST(fare AS FLOAT) AS fare_amount, TRY_CAST(extra AS FLOAT) AS extra, TRY_CAST(mta AS FLOAT) AS mta_tax,
    TRY_CAST(tolls AS FLOAT) AS tolls_amount
  FROM bronze),
silver AS (
  SELECT *, coalesce(CAST(fare_amount AS DOUBLE), 0.0::DOUBLE) + coalesce(CAST(extra AS DOUBLE), 0.0::DOUBLE)
    + coalesce(CAST(mta_tax AS DOUBLE), 0.0::DOUBLE) + 0.0::DOUBLE + coalesce(CAST(tolls_amount AS DOUBLE), 0.0::DOUBLE) AS total_amount
  FROM typed)
"""


def check_row(source: str, kind: str, column: str, bad: str, mostly: float = 1.0) -> str:
    """One report row; ``bad`` counts non-null violations, or nulls for not_null."""
    evaluated = "count(*)" if kind == "not_null" else f"count({column})"
    return (
        f"SELECT '{kind}' AS expectation, '{column}' AS \"column\", {evaluated} AS evaluated, "
        f"count(*) FILTER (WHERE {bad}) AS violations, "
        f"count(*) FILTER (WHERE {bad}) <= {evaluated} * {1.0 - mostly} AS success FROM {source}"
    )


def exists_row(column: str, found: bool) -> str:
    return (
        f"SELECT 'exists' AS expectation, '{column}' AS \"column\", 0 AS evaluated, "
        f"{0 if found else 1} AS violations, {str(found).lower()} AS success"
    )


def report(*rows: str) -> str:
    return " UNION ALL ".join(rows)


def trip_report(source: str, start: str, end: str) -> str:
    return report(
        exists_row("vendorid", True),
        check_row(source, "not_null", "vendorid", "vendorid IS NULL"),
        exists_row("passenger_count", True),
        check_row(source, "not_null", "passenger_count", "passenger_count IS NULL"),
        check_row(source, "between", "passenger_count", "passenger_count NOT BETWEEN 1 AND 8"),
        check_row(source, "not_null", "total_amount", "total_amount IS NULL"),
        check_row(source, "between", "total_amount", "total_amount < 0.01"),
        check_row(source, "not_null", "tpep_pickup_datetime", "tpep_pickup_datetime IS NULL"),
        check_row(source, "not_null", "tpep_dropoff_datetime", "tpep_dropoff_datetime IS NULL"),
        check_row(
            source, "between", "tpep_pickup_datetime",
            f"tpep_pickup_datetime NOT BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'",
        ),
    )


GAPPY = "(SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN value END AS value) FROM events)"


def profile_row(column: str, kind: str, numeric: bool) -> str:
    def number(expression: str) -> str:
        return f"round({expression}, 6)" if numeric else "CAST(NULL AS DOUBLE)"

    return (
        f"SELECT '{column}' AS \"column\", '{kind}' AS type, count(*) AS n, count(*) - count({column}) AS nulls, "
        f"count(DISTINCT {column}) AS \"distinct\", CAST(min({column}) AS VARCHAR) AS min, "
        f"CAST(max({column}) AS VARCHAR) AS max, {number(f'avg(CAST({column} AS DOUBLE))' if numeric else '')} AS mean, "
        + ", ".join(
            f"{number(f'quantile_cont(CAST({column} AS DOUBLE), {q / 100})' if numeric else '')} AS q{q}" for q in (25, 50, 75)
        )
        + " FROM orders"
    )


ORDER_COLUMNS = (
    ("o_orderkey", "bigint", True),
    ("o_custkey", "bigint", True),
    ("o_orderstatus", "string", False),
    ("o_totalprice", "double", True),
    ("o_orderdate", "timestamp_ntz", False),
    ("o_orderpriority", "string", False),
)


def sketch_rows(source: str) -> str:
    """The exact columns of a profile of orders; the approximate ones are near."""
    rows = []
    for column, kind, numeric in ORDER_COLUMNS:
        mean = f"round(avg(CAST({column} AS DOUBLE)), 6)" if numeric else "CAST(NULL AS DOUBLE)"
        rows.append(
            f"SELECT '{column}' AS \"column\", '{kind}' AS type, count(*) AS n, count(*) - count({column}) AS nulls, "
            f"CAST(min({column}) AS VARCHAR) AS min, CAST(max({column}) AS VARCHAR) AS max, {mean} AS mean, "
            f"true AS distinct_near, true AS quantiles_near FROM {source}"
        )
    return " UNION ALL ".join(rows)


def suite_rows() -> str:
    rows = []
    for column, kind, numeric in ORDER_COLUMNS:
        blank = "CAST(NULL AS VARCHAR)"
        head = f"'{column}' AS \"column\""
        rows.append(f"SELECT 'exists' AS expectation, {head}, {blank} AS lo, {blank} AS hi, {blank} AS values")
        rows.append(f"SELECT 'not_null', {head}, {blank}, {blank}, {blank} FROM orders HAVING count(*) = count({column})")
        if numeric or kind == "timestamp_ntz":
            rows.append(
                f"SELECT 'between', {head}, CAST(min({column}) AS VARCHAR), CAST(max({column}) AS VARCHAR), {blank} FROM orders"
            )
        if kind == "string":
            rows.append(
                f"SELECT 'in_set', {head}, {blank}, {blank}, array_to_string(list_sort(list(DISTINCT {column})), '|') "
                f"FROM orders HAVING count(DISTINCT {column}) <= 20"
            )
    return " UNION ALL ".join(rows)


def norm(text: str) -> str:
    return f"coalesce(nullif(regexp_replace(lower({text}), '[^a-z0-9]', '', 'g'), ''), lower(trim({text})))"


LINKS = """
links AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
         generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS pos
  FROM pages)
"""
LINK_NAMES = f"""{LINKS},
seen AS (SELECT CAST(page_id AS VARCHAR) AS source, substr(trim(href), 2) AS name FROM links),
raws AS (SELECT DISTINCT name AS raw, {norm("name")} AS norm FROM seen)
"""


def similar(names: str) -> str:
    """CTEs ``ratios(head, candidate, ratio)``: the Ratcliff/Obershelp ratio by recursion.

    A block is a pair of ranges with its longest common run, the first one in the candidate and then
    in the head; the ranges left and right of the run are the next blocks.
    """
    run = """
      list_min(flatten(list_transform(range(v.alo, v.ahi), lambda i: list_transform(range(v.blo, v.bhi), lambda j: {
        'k': -coalesce(list_max(list_filter(range(1, least(v.ahi - i, v.bhi - j) + 1),
                 lambda k: substr(a, i + 1, k) = substr(b, j + 1, k))), 0), 'i': i, 'j': j}))))
    """
    return f"""
names AS (SELECT DISTINCT norm FROM ({names}) WHERE norm <> ''),
blocks AS (
  SELECT a, b, v.*, {run} AS m
  FROM (SELECT c.norm AS a, h.norm AS b,
               {{'alo': 0::BIGINT, 'ahi': length(c.norm), 'blo': 0::BIGINT, 'bhi': length(h.norm)}} AS v
        FROM names h JOIN names c ON h.norm <> c.norm
         AND 2.0 * least(length(h.norm), length(c.norm)) >= 0.8 * (length(h.norm) + length(c.norm)) - 1e-9)
  UNION ALL
  SELECT a, b, v.*, {run} AS m
  FROM (SELECT a, b, unnest([
          {{'alo': alo, 'ahi': m.i, 'blo': blo, 'bhi': m.j}},
          {{'alo': m.i - m.k, 'ahi': ahi, 'blo': m.j - m.k, 'bhi': bhi}}]) AS v
        FROM blocks WHERE m.k < 0)
  WHERE v.alo < v.ahi AND v.blo < v.bhi),
ratios AS (
  SELECT b AS head, a AS candidate, 2.0::DOUBLE * CAST(-sum(m.k) AS DOUBLE) / (length(a) + length(b)) AS ratio
  FROM blocks GROUP BY a, b
  HAVING 2.0::DOUBLE * CAST(-sum(m.k) AS DOUBLE) / (length(a) + length(b)) >= 0.8)
"""


VOCABULARY = f"SELECT norm FROM raws UNION SELECT {norm('p_name')} FROM part"
SIMILAR = f"WITH RECURSIVE {LINK_NAMES}, {similar(VOCABULARY)}"


def grouping(free: str, clash: str, split: str) -> str:
    """The greedy rule, one name after the other in sorted order."""
    return f"""
WITH RECURSIVE {LINK_NAMES}, {similar(f"SELECT norm FROM raws WHERE {free}")},
free AS (SELECT DISTINCT norm FROM raws WHERE {free}),
normseen AS (SELECT DISTINCT source, {norm("name")} AS norm FROM seen),
edges AS (
  SELECT head, candidate, ratio FROM ratios r WHERE head < candidate AND {clash}),
numbered AS (
  SELECT norm, row_number() OVER (ORDER BY norm) AS k,
         coalesce((SELECT list(candidate) FROM edges WHERE head = norm), []) AS nbrs
  FROM free),
walk AS (
  SELECT 0::BIGINT AS k, []::VARCHAR[] AS covered
  UNION ALL
  SELECT n.k, CASE WHEN list_contains(w.covered, n.norm) THEN w.covered ELSE list_concat(w.covered, n.nbrs) END
  FROM walk w JOIN numbered n ON n.k = w.k + 1),
covered AS (SELECT DISTINCT unnest(covered) AS norm FROM (SELECT covered FROM walk ORDER BY k DESC LIMIT 1)),
joined AS (
  SELECT candidate AS norm, min(head) AS head, arg_min(ratio, head) AS ratio
  FROM edges WHERE head NOT IN (SELECT norm FROM covered) AND candidate IN (SELECT norm FROM covered) GROUP BY 1),
members AS (
  SELECT raw, raws.norm, coalesce(head, raws.norm) AS head, coalesce(ratio, 1.0::DOUBLE) AS ratio, head IS NOT NULL AS late
  FROM raws LEFT JOIN joined USING (norm)),
placed AS (
  SELECT raw, row_number() OVER (PARTITION BY head, source ORDER BY late, ratio DESC, raw) AS place
  FROM (SELECT DISTINCT source, name AS raw FROM seen) JOIN members USING (raw)),
final AS (
  SELECT m.*, CASE WHEN {split} THEN m.raw END AS solo FROM members m)
SELECT CAST(dense_rank() OVER (ORDER BY head, coalesce(solo, '')) AS INTEGER) AS ordinal,
       CASE WHEN solo IS NULL THEN head ELSE {norm("solo")} END AS head, raw, ratio
FROM final
"""


SPELLING = f"""
WITH {LINK_NAMES},
groups AS (SELECT raw, norm, dense_rank() OVER (ORDER BY norm) AS ordinal FROM raws),
sets AS (SELECT ordinal, any_value(norm) AS norm, list_sort(list(raw)) AS variants FROM groups GROUP BY ordinal),
chosen AS (
  SELECT *, CASE WHEN len(variants) = 1 THEN variants[1] WHEN norm = 'the' THEN 'article'
                 WHEN norm = 'und' THEN 'conjunction' ELSE 'coluna_' || ordinal END AS wanted FROM sets),
mapping AS (
  SELECT CASE WHEN row_number() OVER (PARTITION BY lower(wanted) ORDER BY ordinal) = 1 THEN wanted
              ELSE 'coluna_' || ordinal END AS standard, variants, ordinal FROM chosen)
"""

# The three drifted datasets: source tag, file date and columns as text.
RAW = """
raw AS (
  SELECT year(l_shipdate) % 3 AS kind, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax,
         l_linenumber, l_orderkey, l_partkey,
         strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month,
         CASE WHEN year(l_shipdate) % 3 = 0 THEN 'yellow' WHEN year(l_shipdate) % 3 = 1 THEN 'green' ELSE 'fhvhv' END AS source_type,
         CASE WHEN year(l_shipdate) % 3 = 0 THEN TIMESTAMP '1996-01-01' WHEN year(l_shipdate) % 3 = 1 THEN TIMESTAMP '1997-02-01'
              ELSE TIMESTAMP '1900-01-01' END AS date_ref
  FROM lineitem),
yellow AS (
  SELECT year, month, CAST(l_suppkey AS INTEGER) AS vendorid, CAST(l_quantity AS INTEGER) AS passenger_count,
         l_shipdate AS tpep_pickup_datetime, l_shipdate + INTERVAL 1 DAY AS tpep_dropoff_datetime,
         CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) + CAST(CAST(l_discount AS FLOAT) AS DOUBLE)
         + CAST(CAST(l_tax AS FLOAT) AS DOUBLE) + 0.0::DOUBLE + CAST(CAST(l_linenumber AS FLOAT) AS DOUBLE) AS total_amount
  FROM raw WHERE kind = 0)
"""

FILE_PATH = """
(CASE o_orderstatus WHEN 'F' THEN 'yellow_tripdata_' WHEN 'O' THEN 'green_tripdata_' ELSE 'other_' END)
|| strftime(o_orderdate, '%Y') || (CASE WHEN o_orderpriority LIKE '1%' THEN '_' ELSE '-' END)
|| (CASE WHEN o_orderpriority LIKE '2%' THEN '13' ELSE strftime(o_orderdate, '%m') END) || '.parquet'
"""
SOURCE_TYPE = """
CASE WHEN contains(file, 'yellow') THEN 'yellow' WHEN contains(file, 'green') THEN 'green'
     WHEN contains(file, 'fhvhv') THEN 'fhvhv' ELSE 'desconhecido' END
"""
TABLE_LIST = (
    "'region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', "
    "'embeddings', 'pages', 'benchmark', 'labels', 'conversations'"
)
MONTHS_OF_ORDERS = "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders"



def both_means(source: str, amount: str = "total_amount", passengers: str = "passenger_count") -> str:
    return f"""
        SELECT 'monthly' AS mart, year || '-' || month AS key, {exact_mean(amount)} AS mean FROM {source} GROUP BY 1, 2
        UNION ALL
        SELECT 'hourly', CAST(CAST(tpep_pickup_datetime AS DATE) AS VARCHAR) || ' ' || hour(tpep_pickup_datetime),
               {exact_mean(passengers)} FROM {source} GROUP BY 1, 2"""


#: The row checks of the trip suite: label, and what breaks it.
ROW_CHECKS = {
    "not_null(vendorid)": "vendorid IS NULL",
    "not_null(passenger_count)": "passenger_count IS NULL",
    "between(passenger_count, 1, 8)": "passenger_count NOT BETWEEN 1 AND 8",
    "not_null(total_amount)": "total_amount IS NULL",
    "between(total_amount, 0.01, None)": "total_amount < 0.01",
    "not_null(tpep_pickup_datetime)": "tpep_pickup_datetime IS NULL",
    "not_null(tpep_dropoff_datetime)": "tpep_dropoff_datetime IS NULL",
    "between(tpep_pickup_datetime, 1996-01-01, 1999-01-01)":
        "tpep_pickup_datetime NOT BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-01-01'",
}
FAILED = "concat_ws('; ', " + ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in ROW_CHECKS.items()) + ")"

# A mean of doubles rounded as decimal text, half up.
ORACLES = {
    "q_hourly_mean": f"""
        SELECT CAST(ts AS DATE) AS dia, CAST(hour(ts) AS INTEGER) AS hora, {exact_mean("value")} AS media_passageiros
        FROM events GROUP BY 1, 2 ORDER BY 1, 2""",
    "q_monthly_mean": MONTHLY,
    "q_sql_view": MONTHLY,
    "q_year_month": "SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month FROM events",
    "q_cast": f"""
        WITH {BRONZE} SELECT l_orderkey, l_linenumber, vendorid, passenger_count, tpep_pickup_datetime,
        tpep_dropoff_datetime, fare_amount, tolls_amount FROM typed""",
    "q_total_amount": f"WITH {BRONZE} SELECT l_orderkey, l_linenumber, total_amount FROM silver",
    "q_total_missing_col": f"""
        WITH {BRONZE} SELECT l_orderkey, l_linenumber, coalesce(CAST(fare_amount AS DOUBLE), 0.0::DOUBLE)
        + coalesce(CAST(extra AS DOUBLE), 0.0::DOUBLE) + coalesce(CAST(mta_tax AS DOUBLE), 0.0::DOUBLE) AS total_amount FROM typed""",
    "q_silver": f"""
        WITH {BRONZE} SELECT year, month, vendorid, passenger_count, tpep_pickup_datetime, tpep_dropoff_datetime,
        total_amount FROM silver""",
    "q_quality": f"WITH {BRONZE} {trip_report('silver', '1996-01-01', '1999-01-01')}",
    "q_quality_not_null": report(
        check_row(GAPPY, "not_null", "value", "value IS NULL"),
        check_row(GAPPY, "not_null", "ts", "ts IS NULL"),
        exists_row("absent", False),
        check_row(GAPPY, "not_null", "value", "value IS NULL", 0.5),
    ),
    "q_quality_between": report(
        check_row("lineitem", "between", "l_quantity", "l_quantity NOT BETWEEN 1 AND 8"),
        check_row("lineitem", "between", "l_quantity", "l_quantity NOT BETWEEN 1 AND 50"),
        check_row("lineitem", "between", "l_tax", "l_tax NOT BETWEEN 0.0 AND 0.08::DOUBLE"),
    ),
    "q_quality_min": report(
        check_row(GAPPY, "between", "value", "value < 0.01::DOUBLE"),
        check_row(GAPPY, "between", "value", "value < 5.0"),
        check_row(GAPPY, "between", "value", "value > 100.0"),
    ),
    "q_quality_ts_range": report(
        check_row("events", "between", "ts", "ts NOT BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"),
        check_row("events", "between", "ts", "ts NOT BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2025-01-01'"),
        check_row("events", "between", "ts", "ts < TIMESTAMP '2024-01-02' OR ts >= TIMESTAMP '2024-01-03'"),
    ),
    "q_quality_gate": f"""
        WITH {BRONZE}, report AS ({trip_report('silver', '1996-01-01', '1999-01-01')})
        SELECT bool_and(success) AS success FROM report""",
    "q_quality_sample": """
        SELECT 'exists' AS expectation, 'o_orderkey' AS "column", 0 AS evaluated, 0 AS violations, true AS success
        UNION ALL SELECT 'not_null', 'o_custkey', least(count(*), 10000), count(*) - count(o_custkey), count(*) = count(o_custkey) FROM orders
        UNION ALL SELECT 'between', 'o_totalprice', least(count(*), 10000), 0, true FROM orders""",
    "q_profile": " UNION ALL ".join(profile_row(*c) for c in ORDER_COLUMNS),
    "q_suite_from_profile": suite_rows(),
    "q_norm_name": f"""
        SELECT p_partkey, {norm("p_name")} AS name_norm, {norm("p_brand")} AS brand_norm,
               {norm("p_type || '_' || p_brand")} AS type_norm,
               {norm("' ' || upper(other) || '_'")} AS other_norm, {norm("other || 'é ' || p_brand")} AS mixed_norm
        FROM (SELECT *, translate(lower(p_name), 'abcdefghijklmnopqrstuvwxyz', 'абвгдежзийклмнопрстуфхцчшщ') AS other FROM part)""",
    "q_similar_names": f"{SIMILAR} SELECT head, candidate, ratio FROM ratios",
    "q_similar_names_top3": f"""{SIMILAR}
        SELECT head, candidate, ratio, CAST(place AS INTEGER) AS place FROM (
          SELECT *, row_number() OVER (PARTITION BY head ORDER BY ratio DESC, candidate DESC) AS place FROM ratios)
        WHERE place <= 2""",
    "q_group_columns": grouping(
        "norm NOT IN ('the', 'and')",
        """NOT EXISTS (SELECT 1 FROM normseen x JOIN normseen y USING (source) WHERE x.norm = r.head AND y.norm = r.candidate)""",
        "m.raw IN (SELECT raw FROM placed WHERE place > 1)",
    ),
    "q_group_columns_no_veto": grouping("true", "true", "false"),
    "q_name_groups": f"{SPELLING} SELECT standard, array_to_string(variants, '|') AS variants FROM mapping",
    "q_split_exclusive": f"""{SPELLING},
        long AS (SELECT standard, ordinal, unnest(variants) AS variant, generate_subscripts(variants, 1) AS place FROM mapping),
        moved AS (SELECT CASE WHEN {norm("variant")} IN ('the', 'of') THEN {norm("variant")} ELSE standard END AS standard,
                         ordinal, place, variant FROM long)
        SELECT standard, array_to_string(list(variant ORDER BY ordinal, place), '|') AS variants FROM moved GROUP BY standard""",
    "q_require_columns": f"""{SPELLING}
        SELECT standard, array_to_string(variants, '|') AS variants FROM mapping UNION ALL SELECT 'vendorid', 'vendorid'""",
    "q_standard_of": f"""{SPELLING},
        long AS (SELECT lower(variant) AS variant, arg_min(standard, ordinal) AS standard
                 FROM (SELECT standard, ordinal, unnest(variants) AS variant FROM mapping) GROUP BY 1)
        SELECT source, name, standard FROM seen LEFT JOIN long ON lower(name) = variant""",
    "q_mapping_csv": f"""{SPELLING}
        SELECT standard AS nome_padrao, array_to_string(variants, ', ') AS colunas_equivalentes FROM mapping""",
    "q_build_mapping": """
        SELECT * FROM (VALUES
          ('vendorid', 'VendorID|vendor_id|vendorid'), ('tpep_pickup_datetime', 'tpep_pickup_datetime'),
          ('dropoff_datetime', 'Dropoff_Datetime|dropoff_datetime'), ('passenger_count', 'Passenger_Count|passenger_count'),
          ('fare_amount', 'fare_amount'), ('extra', 'extra'), ('mta_tax', 'mta_tax'), ('tip_amount', 'tip_amount'),
          ('tolls', 'tolls'), ('pulocationid', 'PULocationID|PUlocationID'), ('dolocationid', 'DOLocationID|DOlocationID')
        ) AS expected(standard, variants)""",
    "q_file_catalog": f"SELECT DISTINCT table_name AS name, true AS filled FROM duckdb_columns() WHERE table_name IN ({TABLE_LIST})",
    "q_schema_catalog": f"""
        SELECT table_name AS file, CAST(column_index - 1 AS INTEGER) AS pos, column_name AS name,
          CASE data_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'VARCHAR' THEN 'string'
            WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp[us]' WHEN 'FLOAT[]' THEN 'list<element: float>' END AS type
        FROM duckdb_columns() WHERE table_name IN ({TABLE_LIST})""",
    "q_quarantine": f"""
        SELECT DISTINCT 'good' AS state, table_name AS file FROM duckdb_columns() WHERE table_name IN ({TABLE_LIST})
        UNION ALL SELECT 'bad', 'notes'""",
    "q_rename_first": "SELECT o_orderkey AS order_key, o_totalprice AS price, o_orderstatus AS status FROM orders",
    "q_fill_missing": """
        SELECT o_orderkey AS order_key, o_totalprice AS price, o_orderstatus AS status,
               CAST(NULL AS VARCHAR) AS note, CAST(NULL AS INTEGER) AS rank FROM orders""",
    "q_final_columns": f"""
        WITH files AS (SELECT *, {FILE_PATH} AS file FROM orders)
        SELECT o_totalprice AS price, {SOURCE_TYPE} AS source_type, o_orderkey AS order_key, CAST(NULL AS VARCHAR) AS note FROM files""",
    "q_tag_source": f"""
        WITH files AS (SELECT *, {FILE_PATH} AS file FROM orders) SELECT o_orderkey, {SOURCE_TYPE} AS source_type FROM files""",
    "q_date_ref": """
        SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '2%' THEN TIMESTAMP '1900-01-01'
               ELSE date_trunc('month', o_orderdate)::TIMESTAMP END AS date_ref FROM orders""",
    "q_provenance": """
        SELECT o_orderkey, 'orders.parquet' AS source_file, TIMESTAMP '2024-01-02' AS ingestion_date FROM orders""",
    "q_conform_union": f"""
        WITH {RAW}
        SELECT l_suppkey AS vendorid, l_shipdate AS pickup, l_extendedprice AS fare, CAST(NULL AS DOUBLE) AS tip, source_type, date_ref
        FROM raw WHERE kind = 0
        UNION ALL SELECT l_suppkey, l_shipdate, l_extendedprice, l_discount, source_type, date_ref FROM raw WHERE kind = 1
        UNION ALL SELECT l_suppkey, l_shipdate, NULL, NULL, source_type, date_ref FROM raw WHERE kind = 2""",
    "q_write_roundtrip": f"""
        SELECT o_orderkey, CASE WHEN month = '01' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, year, month
        FROM ({MONTHS_OF_ORDERS})""",
    "q_partition_prune": f"SELECT * FROM ({MONTHS_OF_ORDERS}) WHERE year = '1998' AND month = '03'",
    "q_table_scan": f"SELECT * FROM ({MONTHS_OF_ORDERS}) WHERE month BETWEEN '03' AND '10'",
    "q_profile_sketch": sketch_rows("orders"),
    "q_profile_merged": sketch_rows(
        "(SELECT * REPLACE (CASE WHEN month(o_orderdate) = 1 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice) FROM orders)"
    ),
    "q_sample_repeated": """
        WITH t AS (SELECT count(*) AS n FROM orders)
        SELECT fact, CASE WHEN fact IN ('rows', 'of the table', 'distinct') THEN least(n, 1000) WHEN fact = 'not in the second' THEN 0
          WHEN fact = 'mean is near' THEN 1 ELSE CASE WHEN n > 1000 THEN 1 ELSE 0 END END AS n
        FROM t, (VALUES ('rows'), ('of the table'), ('distinct'), ('not in the second'), ('other seed is another choice'), ('mean is near')) AS f(fact)""",
    "q_sized_layout": """
        WITH m AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN '00' ELSE strftime(o_orderdate, '%m') END AS month FROM orders),
        t AS (SELECT count(*) AS total FROM orders)
        SELECT month, greatest(CAST(ceil(count(*) * 10 / any_value(total)) AS BIGINT), 1) AS n_files, count(*) AS n_rows, true AS none_far_over
        FROM m, t GROUP BY month""",
    "q_bounded_sample": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10000",
    "q_bronze": f"""
        WITH {RAW}
        SELECT source_type, year, month, CAST(l_suppkey AS VARCHAR) AS vendorid,
          CASE kind WHEN 0 THEN CAST(l_quantity AS VARCHAR) WHEN 1 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS passenger_count,
          CAST(l_shipdate AS VARCHAR) AS tpep_pickup_datetime,
          CASE kind WHEN 0 THEN CAST(l_shipdate + INTERVAL 1 DAY AS VARCHAR) WHEN 1 THEN CAST(l_shipdate AS VARCHAR) END AS dropoff_datetime,
          CASE WHEN kind < 2 THEN CAST(l_extendedprice AS VARCHAR) END AS fare_amount,
          CASE kind WHEN 1 THEN CAST(l_discount AS VARCHAR) END AS tip_amount,
          CASE kind WHEN 0 THEN CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) END AS tolls,
          CASE WHEN kind < 2 THEN CAST(l_orderkey AS VARCHAR) END AS pulocationid,
          CASE kind WHEN 0 THEN CAST(l_partkey AS VARCHAR) WHEN 2 THEN CAST(l_orderkey AS VARCHAR) END AS dolocationid,
          TIMESTAMP '2024-01-02' AS ingestion_date, date_ref
        FROM raw""",
    "q_silver_job": f"WITH {RAW} SELECT * FROM yellow",
    "q_silver_report": f"WITH {RAW} {trip_report('yellow', '1996-01-01', '1999-01-01')}",
    "q_marts": f"WITH {RAW} {both_means('yellow')}",
    "q_run_all": f"""
        WITH {RAW}, again AS (
          SELECT * REPLACE (passenger_count + CASE WHEN month = '01' THEN 1 ELSE 0 END AS passenger_count) FROM yellow)
        {both_means("again")}""",
    "q_publish_failed": f"""
        SELECT o_orderkey, CASE WHEN month = '01' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, year, month
        FROM ({MONTHS_OF_ORDERS})""",
    "q_maintained_means": f"""
        WITH {BRONZE}, again AS (
          SELECT * REPLACE (CASE WHEN month = '03' THEN 2 * total_amount ELSE total_amount END AS total_amount,
                            CAST(passenger_count AS BIGINT) + CASE WHEN month = '03' THEN 1 ELSE 0 END AS passenger_count) FROM silver)
        {both_means("again")}""",
    "q_violations": f"""
        WITH {BRONZE} SELECT * FROM (SELECT l_orderkey, l_linenumber, {FAILED} AS failed FROM silver) WHERE failed <> ''""",
    "q_violations_counted": f"WITH {BRONZE} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", count(*) AS violations, count(*) AS n_rows FROM silver WHERE {bad}"
        for name, bad in ROW_CHECKS.items()
    ),
    "q_catalog_refresh": """
        WITH kinds(data_type, type) AS (VALUES ('BIGINT', 'int64'), ('VARCHAR', 'string'), ('DOUBLE', 'double'), ('TIMESTAMP', 'timestamp[us]'))
        SELECT 'F' AS dataset, CAST(column_index - 1 AS INTEGER) AS pos, column_name AS name, type, false AS opened
        FROM duckdb_columns() JOIN kinds USING (data_type) WHERE table_name = 'orders'
        UNION ALL VALUES ('O', 0, 'o_orderkey', 'int64', true), ('O', 1, 'price', 'string', true), ('N', 0, 'o_orderdate', 'timestamp[us]', true)""",
    "q_links": f"WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, trim(href) AS href FROM links",
    "q_links_suffix": f"""
        WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, trim(href) AS href FROM links
        WHERE lower(trim(href)) LIKE '%on'""",
    "q_links_period": f"""
        WITH {LINKS}, dated AS (
          SELECT page_id, pos, url, lpad(CAST(page_id % 14 AS VARCHAR), 2, '0') AS month, substr(href, 2) AS word FROM links),
        named AS (SELECT *, '/data/trips_2023-' || month || '/' || word || '.parquet' AS href FROM dated)
        SELECT page_id, CAST(pos AS INTEGER) AS pos, href, regexp_extract(url, '^https?://[^/?#]*') || href AS abs_url,
               '2023-' || month AS period
        FROM named WHERE month BETWEEN '01' AND '05'""",
    "q_links_abs": f"""
        WITH {LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos,
          regexp_extract(url, '^https?://[^/?#]*') || trim(href) AS abs_url, CAST(NULL AS VARCHAR) AS period FROM links""",
    "q_links_forms": """
        WITH base AS (SELECT page_id, url, regexp_extract(url, '^(https?)://', 1) AS scheme,
          regexp_extract(url, '^https?://[^/?#]*') AS site FROM pages)
        SELECT page_id,
          CASE page_id % 9 WHEN 0 THEN 'x/y' WHEN 1 THEN '../up' WHEN 2 THEN './here' WHEN 3 THEN '?q=1' WHEN 4 THEN '#frag'
            WHEN 5 THEN '//other.example.org/z' WHEN 6 THEN 'https://z.example/a?b#c' WHEN 7 THEN '/a/../b'
            ELSE 'mailto:a@b.example' END AS href,
          CASE page_id % 9 WHEN 0 THEN site || '/d/e/x/y' WHEN 1 THEN site || '/d/up' WHEN 2 THEN site || '/d/e/here'
            WHEN 3 THEN site || '/d/e/f?q=1' WHEN 4 THEN site || '/d/e/f?old=1#frag' WHEN 5 THEN scheme || '://other.example.org/z'
            WHEN 6 THEN 'https://z.example/a?b#c' WHEN 7 THEN site || '/b' ELSE 'mailto:a@b.example' END AS abs_url
        FROM base""",
    "q_links_references": """
        SELECT page_id, '/i?a&b=' || chr(CAST(page_id % 1000 + 256 AS INTEGER)) || 'é&' || chr(128512) || chr(65533) || '&bogus;' AS href
        FROM pages""",
    "q_cast_whole": """
        SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS TINYINT) AS as_tinyint, CAST(l_linenumber AS SMALLINT) AS as_smallint,
          l_linenumber AS as_int, CAST(l_linenumber AS BIGINT) AS as_bigint, l_orderkey AS key_long,
          TRY_CAST(9223372036854775000::HUGEINT + l_linenumber + 803 AS BIGINT) AS near_end FROM lineitem""",
    "q_mean_odd_values": """
        SELECT user_id % 5 AS g, CASE WHEN user_id % 5 = 0 AND bool_or(event_id % 97 = 0) THEN 'nan'
          WHEN user_id % 5 = 1 AND bool_or(event_id % 89 = 0) THEN 'inf' ELSE 'number' END AS kind FROM events GROUP BY user_id % 5""",
    "q_float_suite_gate": """
        SELECT expectation, "column", 0 AS violations, true AS success
        FROM (VALUES ('exists'), ('not_null'), ('between')) AS e(expectation), (VALUES ('single'), ('exact'), ('whole')) AS c("column"),
             (SELECT 1 FROM orders HAVING count(*) > 0)""",
    "q_sample_checked": """
        WITH s AS (SELECT * FROM orders)
        SELECT 'between' AS expectation, 'o_totalprice' AS "column", count(o_totalprice) AS evaluated,
          count(*) FILTER (WHERE o_totalprice > 100000) AS violations, count(*) FILTER (WHERE o_totalprice > 100000) = 0 AS success FROM s
        UNION ALL SELECT 'not_null', 'o_custkey', count(*), count(*) - count(o_custkey), count(*) = count(o_custkey) FROM s""",
    "q_profile_sketch_bounds": """
        SELECT column_name AS "column", true AS counts_equal, true AS distinct_near, true AS quantiles_near
        FROM duckdb_columns() WHERE table_name = 'orders'""",
    "q_mapping_json": f"{SPELLING} SELECT standard, array_to_string(variants, '|') AS variants FROM mapping",
    "q_report_roundtrip": """
        SELECT 'exists' AS expectation, 'o_orderkey' AS "column", 0 AS evaluated, 0 AS violations, true AS success
        UNION ALL SELECT 'between', 'o_totalprice', count(o_totalprice), count(*) FILTER (WHERE o_totalprice > 100000),
          count(*) FILTER (WHERE o_totalprice > 100000) = 0 FROM orders""",
    "q_guards": """
        SELECT 'empty: all orders' AS guard, count(*) = 0 AS answer FROM orders
        UNION ALL SELECT 'empty: orders below zero', count(*) = 0 FROM orders WHERE o_totalprice < 0
        UNION ALL SELECT 'missing: orders', count(*) = 0 FROM duckdb_columns() WHERE table_name = 'orders'
        UNION ALL SELECT 'missing: other', count(*) = 0 FROM duckdb_columns() WHERE table_name = 'no_such_table'
        UNION ALL SELECT 'nothing mapped', true
        UNION ALL SELECT 'column not there', count(*) = 0 FROM duckdb_columns() WHERE table_name = 'orders' AND column_name = 'pickup'""",
    "q_skipped_groups": """
        SELECT 'o_orderkey' AS first_column, 'conformed' AS state, count(*) AS n FROM orders
        UNION ALL SELECT column_name, 'skipped', 0 FROM duckdb_columns() WHERE table_name IN ('nation', 'region') AND column_index = 1""",
    "q_preview": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
}
