"""NULL outcome of each rule, lookups and row comments."""

import pytest

from recheck.operators import rules as RU

CONTRACT = [("name", "object", "Y", None), ("ptype", "object", "N", "A,B"), ("price", "float64", "Y", None)]


def _v(rs, rid):
    return {(r.row_id, r.field) for r in rs.violations(only=[rid]).collect()}


def test_rule_null_semantics(spark):
    df = spark.createDataFrame(
        [(1, "nut", "A", 5.0, "NET30", None, -1.0, "Unknown"),
         (2, None, None, None, None, "2016-05-01", 3.0, "x"),
         (3, "bolt", "C", 50.0, "net 30", "2018-01-01", 0.0, "y")],
        "row_id long, name string, ptype string, price double, payment_term string, price_date string, "
        "total_price double, level string").withColumn("price_date", RU.F.col("price_date").cast("date"))
    lk = spark.createDataFrame([("nut", "L1", "A", "nut x", " Yes ", 1.0, "no"),
                                ("nut", "L1", "A", "nut y", "no", 10.0, "No "),
                                ("nut", "L1", "A", "nut z", "no", 99.0, "yes")],
                               "normalized_name string, level_5 string, normalized_uom string, original_name string, "
                               "remove_flag string, price double, price_outlier string")
    rs = RU.build_rules(df, CONTRACT, norm_lookup=lk, roles={"sku_normalized": "name", "unit_price": "price",
                                                             "level5": "level", "sku_original": "name"})
    assert _v(rs, "R1") == {(2, "name"), (2, "price")}
    assert _v(rs, "R2") == {(1, "level")}
    assert _v(rs, "R3") == {(1, "total_price")}
    assert _v(rs, "R4") == {(2, "price_date")}                         # NULL date passes
    assert _v(rs, "R5") == {(2, "payment_term"), (3, "payment_term")}  # NULL term flagged
    assert _v(rs, "R6") == {(3, "payment_term")}                       # lenient: NULL passes
    assert _v(rs, "R7") == {(2, "name"), (3, "name")}                  # NULL not in lookup -> flagged
    assert _v(rs, "R12") == set()                                      # row 1 within [1, 10]; others have no band
    assert _v(rs, "R13") == {(2, "ptype"), (3, "ptype")}               # NULL and 'C' flagged
    flags = {r.row_id: (r.normalized_name_search_flag, r.price_range_flag)
             for r in RU.search_flags(rs, CONTRACT, {"sku_normalized": "name", "unit_price": "price"}).collect()}
    assert flags == {1: ("Found", "Within Range"), 2: ("Not found", "Out of Range"), 3: ("Not found", "Out of Range")}


def test_alias_pairs_and_comments(spark):
    df = spark.createDataFrame([(1, 7, "ACME", 3), (2, 7, None, 4), (3, 8, "acme", 3)],
                               "row_id long, supplier_id long, supplier_name_original string, client_id long")
    alias = spark.createDataFrame([(1, 7, "Acme")], "alias_id long, supplier_id long, alternative_name string")
    rs = RU.build_rules(df, supplier_alias=alias)
    assert _v(rs, "R19") == {(2, "supplier_name_original"), (3, "supplier_name_original")}
    rs2 = RU.build_rules(df, supplier_alias=alias, alias_case="as_is")
    assert _v(rs2, "R19") == {(1, "supplier_name_original"), (2, "supplier_name_original"),
                              (3, "supplier_name_original")}
    cond = RU.long_lookup(spark.createDataFrame([(7, 3)], "Supplier_ID long, client_id long"))
    rs3 = RU.build_rules(df, conditional=cond)
    v = rs3.violations(only=["R16"])
    order = df.columns
    allc = {r.row_id: r.comment for r in RU.row_comments(v, order).collect()}
    last = {r.row_id: r.comment for r in RU.row_comments(v, order, last_only=True).collect()}
    assert allc[2] == "Value not found in lookup in client_id"
    assert allc[3] == "Value not found in lookup in supplier_id"
    assert last[2] == "Value not found in lookup in client_id"


def test_lookup_tables(spark):
    sup = spark.createDataFrame([(1, 5, "B"), (1, 5, "a"), (2, 6, "c")], "category_id int, supplier_id long, "
                                "supplier_normalized_names string")
    got = {r.supplier_id: r.names for r in RU.suppliers_of(sup, 1, sep="|").collect()}
    assert got == {5: "B|a"}
    ll = {(r.field, r.value) for r in RU.long_lookup(sup).collect()}
    assert ("suppliernormalizednames", "b") in ll and ("categoryid", "1") in ll


def test_rules_run_under_other_headers_and_missing_ones_are_named(spark):
    df = spark.createDataFrame([(1, -1.0, "2016-01-01", "net 30", "nut")],
                               "row_id long, Total_Price double, `Price Date` string, PAYMENT_TERM string, Sku_Normalized string")
    df = df.withColumn("Price Date", RU.F.col("Price Date").cast("date"))
    rs = RU.build_rules(df, [("price type", "object", "Y", "A,B")])
    assert {r.rule for r in rs.violations().collect()} == {"R3", "R4", "R5", "R6", "R18"}
    gone = {(r.rule, r.reason) for r in rs.rules_not_run().collect()}
    assert ("R1", "no column price type") in gone and ("R13", "no column price type") in gone
    assert ("R7", "no lookup") in gone and ("R9", "no column uom, no lookup") in gone
    assert {r for r, _ in gone} == {"R1", "R7", "R8", "R9", "R10", "R11", "R12", "R13", "R16", "R19", "R20"}


def test_ambiguous_headers_raise(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "row_id long, Total_Price double, totalPrice double")
    with pytest.raises(ValueError, match="ambiguous"):
        RU.build_rules(df)


def test_only_the_lookups_of_a_rule_are_joined(spark):
    df = spark.createDataFrame([(1, "nut", -1.0)], "row_id long, sku_normalized string, total_price double")
    lk = spark.createDataFrame([("nut",) * 7], "normalized_name string, level_5 string, normalized_uom string, "
                               "original_name string, remove_flag string, price string, price_outlier string")
    rs = RU.build_rules(df, norm_lookup=lk)
    assert "Join" not in rs.violations(only=["R3"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" in rs.violations(only=["R7"])._jdf.queryExecution().executedPlan().toString()


def test_value_sets_share_one_broadcast_bound(spark):
    from recheck.operators.joins import hinted, set_bytes
    small, large = spark.range(10), spark.range(1000)
    a, b = set_bytes(small, large)
    plans = [d._jdf.queryExecution().logical().toString() for d in hinted([large, small], a + 1)]
    assert a < b and "hint" not in plans[0].lower() and "hint" in plans[1].lower()
