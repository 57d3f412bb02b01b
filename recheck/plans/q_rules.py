"""Business-rule queries over the flat-file fixture and its lookups."""

from __future__ import annotations


from recheck.operators import rules as RU
from recheck.plans.q_profile import CONTRACT, FLATFILE_COLS, FLATFILE_STRINGS, contract, flatfile
from recheck.plans.registry import query
from recheck.sources.fixtures import load_fixture, with_fixtures

LOOKUPS = ["flatfile", "norm_lookup", "supplier_category", "supplier_alias", "client_alias"]


def ruleset(spark, sf_dir):
    cat = load_fixture(spark, sf_dir, "supplier_category")
    cal = load_fixture(spark, sf_dir, "client_alias")
    return RU.build_rules(
        flatfile(spark, sf_dir), contract(spark, sf_dir), norm_lookup=load_fixture(spark, sf_dir, "norm_lookup"),
        supplier_category=cat, supplier_alias=load_fixture(spark, sf_dir, "supplier_alias"), client_alias=cal,
        conditional=[cat, cal])


def _sql(body, extra=()):
    return with_fixtures(LOOKUPS, body, "duckdb", extra=list(extra))


def _v(field, rule, where, msg_key=None):
    msg = RU.MESSAGES[msg_key or rule].replace("'", "''")
    return (f"SELECT row_id, '{field}' AS field, '{rule}' AS rule, '{msg}' AS message FROM flatfile f "
            f"WHERE {where}")


def _not_in(col, table, lcol, where=""):
    extra = f" AND {where}" if where else ""
    return f"NOT EXISTS (SELECT 1 FROM {table} l WHERE l.{lcol} IS NOT DISTINCT FROM f.{col}{extra})"


_MAND = [c for c, _, m, _ in CONTRACT if m == "Y" and c in FLATFILE_COLS]
_BAND = ("band", "SELECT normalized_name, min(price) AS mn, max(price) AS mx FROM norm_lookup "
                 "WHERE trim(lower(price_outlier)) = 'no' GROUP BY 1")
_ENUM = [(c, p) for c, _, _, p in CONTRACT if p is not None and c in FLATFILE_COLS
         and c not in ("sku_normalized", "level5_category", "uom", "supplier_name_normalized", "sku_original",
                       "unit_price")]

RULE_SQL = {
    "R1": [_v(c, "R1", f"{c} IS NULL") for c in _MAND],
    "R2": [_v(c, "R2", f"lower({c}) = 'unknown'") for c in FLATFILE_STRINGS],
    "R3": [_v("total_price", "R3", "total_price < 0")],
    "R4": [_v("price_date", "R4", "price_date < DATE '2017-01-01'")],
    "R5": [_v("payment_term", "R5", "NOT coalesce(regexp_full_match(payment_term, 'NET[0-9]+'), false)")],
    "R6": [_v("payment_term", "R6",
              "payment_term IS NOT NULL AND NOT regexp_full_match(lower(payment_term), 'net[0-9]+')")],
    "R7": [_v("sku_normalized", "R7", _not_in("sku_normalized", "norm_lookup", "normalized_name"))],
    "R8": [_v("level5_category", "R8", _not_in("level5_category", "norm_lookup", "level_5"))],
    "R9": [_v("uom", "R9", _not_in("uom", "norm_lookup", "normalized_uom"))],
    "R10": [_v("supplier_name_normalized", "R10",
               _not_in("supplier_name_normalized", "supplier_category", "supplier_normalized_names"))],
    "R11": [_v("sku_original", "R11", "NOT " + _not_in("sku_original", "norm_lookup", "original_name",
                                                       "trim(lower(l.remove_flag)) = 'yes'"))],
    "R12": [_v("unit_price", "R12", "EXISTS (SELECT 1 FROM band b WHERE b.normalized_name = f.sku_normalized "
                                    "AND (f.unit_price > b.mx OR f.unit_price < b.mn))")],
    "R13": [_v(c, "R13", "NOT coalesce(" + c + " IN (" + ", ".join(f"'{x}'" for x in p.split(",")) + "), false)")
            for c, p in _ENUM],
    "R16": [_v(c, "R16_null", f"{c} IS NULL", "R16_null") for c in ("supplier_id", "client_id")]
    + [_v("supplier_id", "R16_missing", "supplier_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier_category l "
                                        "WHERE CAST(l.supplier_id AS VARCHAR) = CAST(f.supplier_id AS VARCHAR))",
          "R16_missing"),
       _v("client_id", "R16_missing", "client_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM client_alias l "
                                      "WHERE CAST(l.client_id AS VARCHAR) = CAST(f.client_id AS VARCHAR))",
          "R16_missing")],
    "R18": [_v("quantity", "R18", "quantity < 0"), _v("total_price", "R18", "total_price < 0")],
    "R19": [_v("supplier_name_original", "R19",
               "NOT EXISTS (SELECT 1 FROM supplier_alias a WHERE a.supplier_id = f.supplier_id AND "
               "lower(a.alternative_name) = lower(f.supplier_name_original))")],
    "R20": [_v("client_name_original", "R20",
               "NOT EXISTS (SELECT 1 FROM client_alias a WHERE a.client_id = f.client_id AND "
               "lower(a.alternative_name) = lower(f.client_name_original))")],
}


def _rule_query(rid):
    def fn(spark, sf_dir):
        return ruleset(spark, sf_dir).violations(only=[rid])
    fn.__name__ = f"q_rule_{rid}"
    fn.__doc__ = f"Violations of rule {rid}."
    return fn


for _rid, _parts in RULE_SQL.items():
    query(f"rule_{_rid}", _sql(" UNION ALL ".join(_parts), [_BAND]))(_rule_query(_rid))


@query("violations_all", _sql(" UNION ALL ".join(p for parts in RULE_SQL.values() for p in parts), [_BAND]))
def q_violations_all(spark, sf_dir):
    """Every rule in one pass over the flat file (lookups joined first)."""
    return ruleset(spark, sf_dir).violations()


@query("violations_large_lookups", _sql(" UNION ALL ".join(p for parts in RULE_SQL.values() for p in parts), [_BAND]))
def q_violations_large_lookups(spark, sf_dir):
    """Every rule with no lookup small enough for a broadcast: memberships by distinct values, one join for all."""
    return ruleset(spark, sf_dir).violations(max_bytes=0)


_FLAGS_SQL = (
    "SELECT row_id, CASE WHEN nf THEN 'Not found' ELSE 'Found' END AS normalized_name_search_flag, "
    "CASE WHEN nf OR unit_price IS NULL OR coalesce(unit_price > mx OR unit_price < mn, false) THEN 'Out of Range' "
    "ELSE 'Within Range' END AS price_range_flag FROM (SELECT f.row_id, f.unit_price, b.mn, b.mx, "
    "(f.sku_normalized IS NULL OR " + _not_in("sku_normalized", "norm_lookup", "normalized_name") + ") AS nf "
    "FROM flatfile f LEFT JOIN band b ON b.normalized_name = f.sku_normalized)")


@query("rule_R14_R15_flags", _sql(_FLAGS_SQL, [_BAND]))
def q_flags(spark, sf_dir):
    """Name-search and price-range flags per row."""
    rs = ruleset(spark, sf_dir)
    return RU.search_flags(rs, contract(spark, sf_dir))


@query("rule_R17_comments", _sql(
    "SELECT row_id, string_agg(message || ' in ' || field, '; ' ORDER BY pos) AS comment FROM ("
    + " UNION ALL ".join(f"SELECT *, {FLATFILE_COLS.index(c) + 1} AS pos FROM ({p})"
                         for p, c in zip(RULE_SQL["R16"], ["supplier_id", "client_id", "supplier_id", "client_id"]))
    + ") GROUP BY row_id"))
def q_row_comments(spark, sf_dir):
    """Per row, the failing lookup checks in column order (R17; ``last_only`` reproduces the overwritten cell)."""
    rs = ruleset(spark, sf_dir)
    return RU.row_comments(rs.violations(only=["R16"]), FLATFILE_COLS)


@query("long_lookup", _sql(
    "SELECT DISTINCT field, value FROM (" + " UNION ALL ".join(
        f"SELECT '{c.replace('_', '')}' AS field, lower(CAST({c} AS VARCHAR)) AS value FROM {t}"
        for t, cols in [("norm_lookup", ["normalized_name", "level_5", "normalized_uom", "original_name", "remove_flag",
                                         "price", "price_outlier"]),
                        ("supplier_category", ["category_id", "supplier_id", "supplier_normalized_names"]),
                        ("client_alias", ["alias_id", "client_id", "alternative_name"])] for c in cols)
    + ") WHERE value IS NOT NULL"))
def q_long_lookup(spark, sf_dir):
    """Consolidated lookup as (field, value)."""
    return RU.long_lookup(load_fixture(spark, sf_dir, "norm_lookup"), load_fixture(spark, sf_dir, "supplier_category"),
                          load_fixture(spark, sf_dir, "client_alias"))


@query("price_band", _sql("SELECT normalized_name, mn AS min_price, mx AS max_price FROM band", [_BAND]))
def q_price_band(spark, sf_dir):
    """Reference price band per name over non-outlier rows."""
    return RU.price_band(load_fixture(spark, sf_dir, "norm_lookup"))


@query("alias_lists", _sql("SELECT supplier_id, string_agg(alternative_name, '|' ORDER BY alternative_name) AS names "
                           "FROM supplier_alias GROUP BY 1"))
def q_alias_lists(spark, sf_dir):
    """Supplier id -> its alternative names."""
    return RU.alias_lists(load_fixture(spark, sf_dir, "supplier_alias"), "supplier_id", "alternative_name", "|")


@query("suppliers_of", _sql("SELECT supplier_id, string_agg(supplier_normalized_names, '|' ORDER BY "
                            "supplier_normalized_names) AS names FROM supplier_category WHERE category_id = 1 "
                            "GROUP BY 1"))
def q_suppliers_of(spark, sf_dir):
    """Suppliers of category 1."""
    return RU.suppliers_of(load_fixture(spark, sf_dir, "supplier_category"), 1, sep="|")
