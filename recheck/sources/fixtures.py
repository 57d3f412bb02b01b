"""Synthetic reconciliation inputs built from the driver tables.

One SQL text per fixture, portable between Spark SQL and DuckDB (integer-modulus perturbations only, no hashing or
randomness), so the Spark query and its DuckDB oracle see the same rows. Base tables appear as ``{name}``
placeholders: Spark fills in ``parquet.`<path>``` scans, DuckDB the pre-registered view names.

Deviation from a global ``row_number()`` for ``flatfile.row_id``: a window without PARTITION BY runs in one task, so the
id is built per order instead (``l_orderkey * 1024 + rank within the order``; lineitem has no unique key of its own).
"""

from __future__ import annotations

from recheck.session import Scratch

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")

FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {}


def _fx(name: str, deps: tuple[str, ...], sql: str) -> None:
    FIXTURES[name] = (deps, sql.strip())


# Baseline ("ground truth") price points: one row per order.
_fx("gt", (), """
SELECT o_orderkey AS row_id, concat('file_', CAST(o_orderkey % 4 AS STRING), '.xlsx') AS file_name,
 concat(c_name, ' (std)') AS sku_original, concat(c_mktsegment, '-', n_name) AS sku_normalized,
 o_orderpriority AS level5_category, o_orderstatus AS uom, o_totalprice AS unit_price,
 CAST(o_orderdate AS DATE) AS price_date,
 CASE o_orderkey % 7 WHEN 0 THEN 'NET 30' WHEN 1 THEN NULL WHEN 2 THEN 'net45'
   ELSE concat('NET', CAST(15 * (o_orderkey % 4 + 1) AS STRING)) END AS payment_term
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
""")

# Candidate ("pipeline") output: drops, case changes, price edits, null dates, unknown items, altered second copies.
_fx("pipeline", ("gt",), """
SELECT row_id, file_name, CASE WHEN row_id % 13 = 0 THEN upper(sku_original) ELSE sku_original END AS sku_original,
 sku_normalized, level5_category, CASE WHEN row_id % 29 = 0 THEN lower(uom) ELSE uom END AS uom,
 CASE WHEN row_id % 11 = 0 THEN unit_price + 1 WHEN row_id % 31 = 0 THEN -unit_price ELSE unit_price END AS unit_price,
 CASE WHEN row_id % 19 = 0 THEN NULL ELSE price_date END AS price_date, payment_term
FROM gt WHERE row_id % 17 <> 0
UNION ALL
SELECT row_id + 100000000, file_name, concat(sku_original, ' X'), sku_normalized, 'unknown', uom, unit_price,
 price_date, payment_term FROM gt WHERE row_id % 23 = 0
UNION ALL
SELECT row_id + 200000000, file_name, sku_original, sku_normalized, level5_category, uom, unit_price + 2, price_date,
 payment_term FROM gt WHERE row_id % 5 = 0
""")

# Rule and profile input (one row per line item).
_fx("flatfile", (), """
SELECT row_id, concat('file_', CAST(l_suppkey % 20 AS STRING), '.xlsx') AS file_name,
 concat(p_name, ' ', p_brand) AS sku_original,
 CASE WHEN row_id % 37 = 0 THEN NULL WHEN row_id % 41 = 0 THEN 'no such item' ELSE p_name END AS sku_normalized,
 CASE WHEN row_id % 43 = 0 THEN 'Unknown' ELSE p_type END AS level5_category, l_returnflag AS uom,
 l_suppkey AS supplier_id,
 CASE WHEN row_id % 47 = 0 THEN 'Other' WHEN row_id % 5 = 0 THEN upper(s_name) ELSE s_name END AS supplier_name_original,
 s_name AS supplier_name_normalized,
 o_custkey AS client_id, c_name AS client_name_original,
 CASE WHEN row_id % 53 = 0 THEN -l_quantity ELSE l_quantity END AS quantity,
 CASE WHEN row_id % 59 = 0 THEN NULL WHEN row_id % 61 = 0 THEN 0.0 ELSE l_extendedprice / l_quantity END AS unit_price,
 CASE WHEN row_id % 67 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS total_price,
 CASE WHEN row_id % 71 = 0 THEN NULL ELSE CAST(l_shipdate + INTERVAL '20' YEAR AS DATE) END AS price_date,
 CASE row_id % 7 WHEN 0 THEN 'NET 30' WHEN 1 THEN NULL WHEN 2 THEN 'net45' ELSE 'NET60' END AS payment_term,
 CASE row_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS price_type,
 CASE WHEN row_id % 79 = 0 THEN 'n/a' ELSE CAST(l_linenumber AS STRING) END AS store_no,
 CAST(NULL AS STRING) AS service_frequency
FROM (SELECT *, l_orderkey * 1024 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
        l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_id
      FROM {lineitem}) li
JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
""")

# Mapping sheet (data contract): column, expected dtype name, mandatory flag, allowed values.
_fx("contract", (), """
SELECT * FROM (VALUES
 ('file_name','object','Y',NULL), ('sku_original','object','Y',NULL), ('sku_normalized','object','Y',NULL),
 ('unit_price','float64','Y',NULL), ('price_date','datetime64[ns]','N',NULL), ('payment_term','object','N',NULL),
 ('price_type','object','N','A,B'), ('store_no','int64','N',NULL), ('service_frequency','object','N',NULL),
 ('currency_code','object','Y',NULL)
) AS t(flat_file_column, dtype, mandatory_column, possible_values)
""")

# Normalisation lookup: names, categories, units, removal list and reference prices.
_fx("norm_lookup", (), """
SELECT p_name AS normalized_name, p_type AS level_5, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'R' END AS normalized_uom,
 concat(p_name, ' ', p_brand) AS original_name, CASE WHEN p_partkey % 50 = 0 THEN ' Yes ' ELSE 'no' END AS remove_flag,
 p_retailprice * (1 + p_partkey % 4) AS price, CASE WHEN p_partkey % 10 = 0 THEN 'yes' ELSE 'No ' END AS price_outlier
FROM {part}
""")

_fx("supplier_category", (), """
SELECT CAST(s_suppkey % 3 AS INT) AS category_id, s_suppkey AS supplier_id, s_name AS supplier_normalized_names
FROM {supplier} WHERE s_suppkey % 10 <> 3
""")

_fx("supplier_alias", (), """
SELECT s_suppkey * 2 AS alias_id, s_suppkey AS supplier_id, s_name AS alternative_name FROM {supplier}
UNION ALL SELECT s_suppkey * 2 + 1, s_suppkey, lower(s_name) FROM {supplier} WHERE s_suppkey % 4 = 0
""")

_fx("client_alias", (), """
SELECT c_custkey AS alias_id, c_custkey AS client_id, c_name AS alternative_name FROM {customer} WHERE c_custkey % 9 <> 0
""")

_fx("taxonomy", (), """
SELECT DISTINCT concat('category ', CAST(p_size AS STRING)) AS category_name, p_size AS category_id FROM {part}
""")


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def table_refs(engine: str, sf_dir: str | None = None) -> dict[str, str]:
    if engine == "spark":
        return {t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in BASE_TABLES}
    return {t: t for t in BASE_TABLES}


def with_fixtures(names, body: str, engine: str = "duckdb", sf_dir: str | None = None, extra=(),
                  recursive: bool = False) -> str:
    """``WITH <fixtures and their deps>, <extra CTEs> <body>``; the same text runs on Spark and DuckDB."""
    refs = table_refs(engine, sf_dir)
    ctes = [f"{n} AS (\n{FIXTURES[n][1].format(**refs)}\n)" for n in _order(names)]
    ctes += [f"{n} AS (\n{q}\n)" for n, q in extra]
    if not ctes:
        return body
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + body


def load_fixture(spark, sf_dir: str, name: str):
    """The fixture as a Spark DataFrame (parquet scans of ``sf_dir``)."""
    return spark.sql(with_fixtures([name], f"SELECT * FROM {name}", "spark", sf_dir))


def load_sides(spark, sf_dir: str):
    """(pipeline, gt), with gt's rows built once: written, and read again wherever either side is read."""
    gt = Scratch(spark, "gt").written(load_fixture(spark, sf_dir, "gt"), "rows")
    body = FIXTURES["pipeline"][1]
    return spark.sql(f"WITH gt AS (SELECT * FROM {{gt}}) {body}", gt=gt), gt


def load_table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
