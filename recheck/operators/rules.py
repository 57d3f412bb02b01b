"""Declarative business rules evaluated in one pass (R1-R20, D4), plus the lookups they use.

A rule is a Boolean Column that is true when a cell violates it. Lookup-based rules first get flag columns from
broadcast joins with the (size-checked) lookup tables; then every rule is evaluated in a single projection that
builds ``array(when(rule, index))`` per row and explodes it into the long ``violations`` table
``(row_id, field, rule, message)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recheck.functions.cells import comparable, strip
from recheck.operators.joins import BROADCAST_MAX_BYTES, member_flag, member_set, sized
from recheck.operators.schema import canonical_name
from recheck.session import Scratch

# Patterns, cut-off date, marker words and messages of the checks.
UNKNOWN_TEXT = "unknown"
PAYMENT_TERM_STRICT = "^NET[0-9]+$"
PAYMENT_TERM_LENIENT = "^net[0-9]+$"
MIN_PRICE_DATE = "2017-01-01"
REMOVE_YES = "yes"
OUTLIER_NO = "no"
NON_NEGATIVE = ("quantity", "Total_Price", "totalprice")  # matched through canonical header names
MESSAGES = {
    "R1": "mandatory value missing",
    "R2": "value is 'unknown'",
    "R3": "negative price",
    "R4": "price date before 2017-01-01",
    "R5": "payment term is not NET<digits>",
    "R6": "Invalid payment term",
    "R7": "normalised name not in lookup",
    "R8": "level 5 category not in lookup",
    "R9": "unit of measure not in lookup",
    "R10": "supplier not in category supplier list",
    "R11": "item is on the removal list",
    "R12": "unit price outside lookup price band",
    "R13": "value not among possible values",
    "R16_null": "Null value found",
    "R16_missing": "Value not found in lookup",
    "R18": "negative_value",
    "R19": "supplier id and name are not an alias pair",
    "R20": "client id and name are not an alias pair",
}
SEARCH_FLAG = ("Found", "Not found")
RANGE_FLAG = ("Within Range", "Out of Range")

# Column roles of the price-point layout (data column names); pass another mapping for other layouts.
ROLES = {
    "sku_normalized": "sku_normalized", "level5": "level5_category", "uom": "uom",
    "supplier_normalized": "supplier_name_normalized", "sku_original": "sku_original", "unit_price": "unit_price",
    "price_date": "price_date", "payment_term": "payment_term", "supplier_id": "supplier_id",
    "supplier_name": "supplier_name_original", "client_id": "client_id", "client_name": "client_name_original",
}


@dataclass(frozen=True)
class Rule:
    rule: str
    field: str
    violated: Column
    message: str


def run_rules(df: DataFrame, rules: Sequence[Rule], row_id: str = "row_id") -> DataFrame:
    """Violations of all ``rules`` in one projection: (row_id, field, rule, message)."""
    if not rules:
        return df.sparkSession.createDataFrame([], "row_id long, field string, rule string, message string")
    # The array is built in a plain projection (whole-stage codegen) and only a column is exploded: with the rule
    # expressions inside the generator, Spark evaluates them outside codegen.
    return named_rules(df.select(F.col(row_id).alias("row_id"), violated(rules).alias("_is")), rules)


def violated(rules: Sequence[Rule]) -> Column:
    """Per row only an int array of the violated rules is built; names are looked up for violating rows only."""
    items = [F.when(F.coalesce(r.violated, F.lit(False)), F.lit(i + 1)) for i, r in enumerate(rules)]
    return F.array_compact(F.array(*items)) if items else F.array().cast("array<int>")


def named_rules(found: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(row_id, field, rule, message) of rows with the numbers ``_is`` of the rules that they violate."""
    fields = F.array(*[F.lit(r.field) for r in rules])
    ids = F.array(*[F.lit(r.rule) for r in rules])
    msgs = F.array(*[F.lit(r.message) for r in rules])
    v = found.where(F.size("_is") > 0).select("row_id", F.explode("_is").alias("_i"))
    return v.select("row_id", F.element_at(fields, F.col("_i")).alias("field"),
                    F.element_at(ids, F.col("_i")).alias("rule"), F.element_at(msgs, F.col("_i")).alias("message"))


# -- lookups -------------------------------------------------------------------------------------------------------

def long_lookup(*dfs: DataFrame) -> DataFrame:
    """Consolidated lookup as (field, value): canonical column names, lower-cased text values, NULLs dropped,
    distinct (J7). Each lookup column is only ever used as a value set, so a long table replaces zipping sheets."""
    parts = []
    for df in dfs:
        cols = [c for c in df.columns]
        st = F.explode(F.array(*[F.struct(F.lit(canonical_name(c)).alias("field"),
                                          F.lower(F.col(c).cast("string")).alias("value")) for c in cols]))
        parts.append(df.select(st.alias("s")).select("s.field", "s.value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("value").isNotNull()).distinct()


def price_band(lookup: DataFrame, name: str = "normalized_name", price: str = "price",
               outlier: str = "price_outlier") -> DataFrame:
    """Min/max reference price per name over non-outlier lookup rows."""
    ok = strip(F.lower(F.col(outlier))) == OUTLIER_NO
    return lookup.where(ok).groupBy(name).agg(F.min(price).alias("min_price"), F.max(price).alias("max_price"))


def alias_lists(df: DataFrame, id_col: str, name_col: str, sep: str | None = None) -> DataFrame:
    """id -> sorted list of alternative names (A8); ``sep`` joins the list into text."""
    names = F.array_sort(F.collect_list(name_col))
    if sep is not None:
        names = F.array_join(names, sep)
    return df.groupBy(id_col).agg(names.alias("names"))


def suppliers_of(cat_df: DataFrame, category_id, cat_col: str = "category_id", id_col: str = "supplier_id",
                 name_col: str = "supplier_normalized_names", sep: str | None = None) -> DataFrame:
    """Suppliers of one category with their names (F3 + A8)."""
    return alias_lists(cat_df.where(F.col(cat_col) == F.lit(category_id)), id_col, name_col, sep)


def pair_set(pairs: DataFrame, name: str) -> DataFrame:
    """Distinct rows of ``pairs`` with a marker column ``name``."""
    return pairs.toDF(*[f"{name}_{i}" for i in range(len(pairs.columns))]).distinct().withColumn(name, F.lit(True))


def pair_flag(df: DataFrame, left: Sequence[Column], pairs: DataFrame, name: str) -> DataFrame:
    """Add boolean ``name``: the tuple ``left`` is one of ``pairs``' rows (a ``pair_set``; plain equality: a NULL never
    matches)."""
    cond = F.lit(True)
    for i, c in enumerate(left):
        cond = cond & (c == F.col(f"{name}_{i}"))
    out = df.join(pairs, cond, "left").drop(*[f"{name}_{i}" for i in range(len(left))])
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def starts_then_digits(text: Column, start: str, pattern: str) -> Column:
    """``text.rlike(pattern)`` for the pattern ``^<start>[0-9]+$``, asked only where a line end follows (which ``$``
    allows): a regular expression a row costs more than all other rules."""
    plain = text.startswith(start) & (F.length(text) > len(start)) & (F.translate(text, "0123456789", "") == start)
    ended = F.right(text, F.lit(1)).isin("\n", "\r", "\u0085", "\u2028", "\u2029")
    return plain | (ended & text.rlike(pattern))


# -- the rule set --------------------------------------------------------------------------------------------------

@dataclass
class Lookup:
    """A value set and how its columns get to the data; joined only where a rule that asks for it is run.

    For membership: ``cell`` is the data's value as one text, ``members`` the set's as one column ``value`` of the same
    texts; a NULL ``cell`` is never looked up, and violates the rule where ``null_violates`` says so.
    """
    values: DataFrame
    attach: Callable[[DataFrame, DataFrame], DataFrame]
    cell: Column | None = None
    members: DataFrame | None = None
    null_violates: Column | None = None


def one_text(cells: Sequence[tuple[Column, T.DataType, T.DataType]], null_safe: bool) -> Column:
    """A tuple of cells as one text, equal on both sides where all cells are (each: column, own type, other type). NULL
    if any cell is, or, ``null_safe``, a text that says so."""
    parts = []
    for c, own, other in cells:
        text = F.concat(F.lit("="), F.replace(comparable(c, own, other), F.lit("\x01"), F.lit("\x01\x01")))
        parts.append(F.coalesce(text, F.lit("-")) if null_safe else text)
    return F.concat(*[x for p in parts for x in (p, F.lit(" \x01 "))][:-1])


@dataclass
class RuleSet:
    base: DataFrame                                  # the input, no lookup joined yet
    rules: list = field(default_factory=list)        # list[Rule]
    lookups: dict = field(default_factory=dict)      # rule id -> Lookup
    not_run: list = field(default_factory=list)      # (rule, what is missing)

    def with_lookups(self, names: Sequence[str]) -> DataFrame:
        """The input with the columns of the named lookups; their sizes are measured in one job."""
        return self._joined(names, None)[0]

    def _joined(self, names: Sequence[str], max_bytes: int | None, apart: bool = False) -> tuple[DataFrame, list[str]]:
        """The input joined with the named lookups, and the names of those left out: with ``apart``, memberships whose
        sets are too large for a broadcast."""
        used = [n for n in names if n in self.lookups]
        bound = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
        df, out = self.base, []
        for n, (values, small) in zip(used, sized([self.lookups[n].values for n in used], bound)):
            if apart and not small and self.lookups[n].cell is not None:
                out.append(n)
            else:
                df = self.lookups[n].attach(df, values)
        return df, out

    @property
    def data(self) -> DataFrame:
        return self.with_lookups(list(self.lookups))

    def violations(self, row_id: str = "row_id", only: Sequence[str] | None = None, max_bytes: int | None = None
                   ) -> DataFrame:
        """(row_id, field, rule, message) of the rules, or of those named. Sets up to ``max_bytes`` in sum (default:
        ``joins.BROADCAST_MAX_BYTES``) are broadcast; for larger ones see ``_by_values``."""
        rs = [r for r in self.rules if only is None or r.rule in only or r.rule.split("_")[0] in only]
        names = {r.rule for r in rs} | {f"{r.rule}:{r.field}" for r in rs}
        df, apart = self._joined([n for n in self.lookups if n in names], max_bytes, apart=True)

        def large(r: Rule) -> str | None:
            return next((n for n in (r.rule, f"{r.rule}:{r.field}") if n in apart), None)

        direct = [r if large(r) is None else Rule(r.rule, r.field, self.lookups[large(r)].null_violates, r.message)
                  for r in rs if large(r) is None or self.lookups[large(r)].null_violates is not None]
        if not apart:
            return run_rules(df, direct, row_id)
        # the input is derived once: what the rules found and the cells to be looked up are written, and read for each use
        by_value = [(r, self.lookups[large(r)]) for r in rs if large(r)]
        checked = Scratch(df.sparkSession, "rules").written(df.select(
            F.col(row_id).alias("row_id"), violated(direct).alias("_is"),
            *[x.cell.alias(f"_v{i}") for i, (_, x) in enumerate(by_value)]), "checked")
        out = self._by_values(checked, by_value)
        return named_rules(checked, direct).unionByName(out) if direct else out

    def _by_values(self, checked: DataFrame, rules: list[tuple[Rule, Lookup]]) -> DataFrame:
        """Violations of memberships in large sets; ``checked``: row_id and the cell of each rule. Only distinct (rule, value) pairs of the data meet the sets, in one
        join for all rules; the pairs that violate, few as a rule, go back to (row, rule, value) rows. Rows are never
        shuffled whole."""
        cells = F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_v{i}").alias("value"))
                                             for i in range(len(rules))]), lambda s: s["value"].isNotNull()))
        long = checked.select("row_id", cells.alias("_s")).select("row_id", "_s.*")
        members = None
        for i, (_, x) in enumerate(rules):
            part = x.members.select(F.lit(i).alias("_i"), F.col("value").alias("_v"))
            members = part if members is None else members.unionByName(part)
        member = members.where(F.col("_v").isNotNull()).distinct().withColumn("_member", F.lit(True))
        found = long.select("i", "value").distinct().join(
            member, (F.col("i") == F.col("_i")) & (F.col("value") == F.col("_v")), "left")
        # R11 asks for values that are in its set, all others for values that are not
        wants = F.element_at(F.array(*[F.lit(r.rule == "R11") for r, _ in rules]), F.col("i") + 1)
        bad = found.where(F.coalesce("_member", F.lit(False)) == wants).select(
            F.col("i").alias("_bi"), F.col("value").alias("_bv"))
        hits = long.join(bad, (F.col("i") == F.col("_bi")) & (F.col("value") == F.col("_bv")))

        def of(what: str) -> Column:
            return F.element_at(F.array(*[F.lit(getattr(r, what)) for r, _ in rules]), F.col("i") + 1).alias(what)

        return hits.select("row_id", of("field"), of("rule"), of("message"))

    def rules_not_run(self) -> DataFrame:
        """(rule, reason): each check that had nothing to look at; an empty table means that every rule ran."""
        return self.base.sparkSession.createDataFrame(self.not_run, "rule string, reason string")


def column_finder(df: DataFrame) -> Callable[[str], str | None]:
    """Finds a column by its canonical name (case, blanks and punctuation don't count); raises if two have it (C4)."""
    known: dict[str, list[str]] = {}
    for c in df.columns:
        known.setdefault(canonical_name(c), []).append(c)

    def find(name: str) -> str | None:
        found = [name] if name in df.columns else known.get(canonical_name(name), [])
        if len(found) > 1:
            raise ValueError(f"column {name!r} is ambiguous: {found}")
        return found[0] if found else None
    return find


def build_rules(df: DataFrame, contract_rows: Sequence[tuple] = (), norm_lookup: DataFrame | None = None,
                supplier_category: DataFrame | None = None, supplier_alias: DataFrame | None = None,
                client_alias: DataFrame | None = None, conditional: DataFrame | Sequence[DataFrame] | None = None,
                roles: dict | None = None, price_columns: Sequence[str] = ("total_price",),
                alias_case: str = "lower", level5_pool: Sequence[str] = ()) -> RuleSet:
    """Every check of the business-rule flows over one DataFrame. Building runs no job.

    ``contract_rows``: (column, dtype, mandatory 'Y', possible values) tuples; ``conditional``: the lookup tables of
    R16 (or one long lookup from ``long_lookup``, whose field names then cost a job). ``alias_case='as_is'`` keeps alias
    names as stored (the reference lower-cases only the data). ``level5_pool``: further lookup columns whose values
    count for R8 as well. Columns are found by their canonical names; a check whose column or lookup is missing is
    listed in ``not_run``.
    """
    find = column_finder(df)
    ro = {k: find(v) for k, v in {**ROLES, **(roles or {})}.items()}
    wanted = {**ROLES, **(roles or {})}
    rs = RuleSet(df)
    rules, m = rs.rules, MESSAGES
    contract = [(find(c), c, mand, possible) for c, _, mand, possible in contract_rows]

    def runs(rule: str, *needed: str, lookup=True) -> bool:
        gone = [f"no column {wanted[r]}" for r in needed if ro[r] is None] + ["no lookup"] * (lookup is None)
        if gone:
            rs.not_run.append((rule, ", ".join(gone)))
        return not gone

    def member(rule: str, col: str, values: DataFrame, text: Column | None = None, name: str | None = None) -> Column:
        flag = f"_in_{rule}" if name is None else f"_in_{rule}_{len(rs.lookups)}"
        own = df.schema[col].dataType if text is None else T.StringType()
        other = values.schema.fields[0]
        data, null_safe = F.col(col) if text is None else text, text is None
        rs.lookups[name or rule] = Lookup(
            member_set(values, flag), lambda d, v: member_flag(d, data, v, flag),
            one_text([(data, own, other.dataType)], null_safe),
            values.select(one_text([(F.col(other.name), other.dataType, own)], null_safe).alias("value")))
        return F.col(flag)

    for c, name, mand, _ in contract:                                                   # R1
        if mand == "Y" and c is None:
            rs.not_run.append(("R1", f"no column {name}"))
        elif mand == "Y":
            rules.append(Rule("R1", c, F.col(c).isNull(), m["R1"]))
    for f in df.schema.fields:                                                          # R2
        if isinstance(f.dataType, T.StringType):
            rules.append(Rule("R2", f.name, F.lower(F.col(f.name)) == UNKNOWN_TEXT, m["R2"]))
    for name in price_columns:                                                          # R3
        if find(name) is None:
            rs.not_run.append(("R3", f"no column {name}"))
        else:
            rules.append(Rule("R3", find(name), F.col(find(name)) < 0, m["R3"]))
    if runs("R4", "price_date"):                                                        # R4
        rules.append(Rule("R4", ro["price_date"], F.col(ro["price_date"]) < F.lit(MIN_PRICE_DATE).cast("date"), m["R4"]))
    if runs("R5", "payment_term"):
        pt = ro["payment_term"]
        rules.append(Rule("R5", pt, ~F.coalesce(starts_then_digits(F.col(pt), "NET", PAYMENT_TERM_STRICT), F.lit(False)), m["R5"]))
    if runs("R6", "payment_term"):
        rules.append(Rule("R6", pt, F.col(pt).isNotNull() & ~starts_then_digits(F.lower(F.col(pt)), "net", PAYMENT_TERM_LENIENT), m["R6"]))

    handled = set()
    for rid, role, lcols in (("R7", "sku_normalized", ["normalized_name"]), ("R8", "level5", ["level_5", *level5_pool]),
                             ("R9", "uom", ["normalized_uom"])):                        # R7, R8, R9
        if runs(rid, role, lookup=norm_lookup):
            values = norm_lookup.select(F.explode(F.array(*lcols)).alias("v")) if len(lcols) > 1 else norm_lookup.select(
                *lcols)
            rules.append(Rule(rid, ro[role], ~member(rid, ro[role], values), m[rid]))
            handled.add(ro[role])
    if runs("R11", "sku_original", lookup=norm_lookup):                                 # R11
        removal = norm_lookup.where(strip(F.lower(F.col("remove_flag"))) == REMOVE_YES).select("original_name")
        rules.append(Rule("R11", ro["sku_original"], member("R11", ro["sku_original"], removal), m["R11"]))
        handled.add(ro["sku_original"])
    if runs("R12", "unit_price", "sku_normalized", lookup=norm_lookup):                 # R12 (A7)
        price, name = ro["unit_price"], ro["sku_normalized"]
        rs.lookups["R12"] = Lookup(price_band(norm_lookup).toDF("_bn", "_bmin", "_bmax"), lambda d, v, own=name: d.join(
            v, F.col(own) == F.col("_bn"), "left").drop("_bn"))
        rules.append(Rule("R12", price, (F.col(price) > F.col("_bmax")) | (F.col(price) < F.col("_bmin")), m["R12"]))
        handled.add(price)
    if runs("R10", "supplier_normalized", lookup=supplier_category):                    # R10
        c = ro["supplier_normalized"]
        rules.append(Rule("R10", c, ~member("R10", c, supplier_category.select("supplier_normalized_names")), m["R10"]))
        handled.add(c)
    for c, name, _, possible in contract:                                               # R13
        if possible is not None and c is None:
            rs.not_run.append(("R13", f"no column {name}"))
        elif possible is not None and c not in handled:
            values = possible.split(",")
            rules.append(Rule("R13", c, ~F.coalesce(F.col(c).isin(*values), F.lit(False)), m["R13"]))

    if conditional is None:                                                             # R16
        rs.not_run.append(("R16", "no lookup"))
    else:
        if isinstance(conditional, DataFrame):
            long, fields = conditional, {r[0] for r in conditional.select("field").distinct().collect()}
        else:
            long = long_lookup(*conditional)
            fields = {canonical_name(c) for d in conditional for c in d.columns}
        for c in df.columns:
            if canonical_name(c) not in fields:
                continue
            values = long.where(F.col("field") == canonical_name(c)).select("value")
            known = member("R16", c, values, F.lower(F.col(c).cast("string")), f"R16_missing:{c}")
            rules.append(Rule("R16_null", c, F.col(c).isNull(), m["R16_null"]))
            rules.append(Rule("R16_missing", c, F.col(c).isNotNull() & ~known, m["R16_missing"]))

    for name in NON_NEGATIVE:                                                           # R18
        c = find(name)
        if c is not None and not any(r.rule == "R18" and r.field == c for r in rules):
            rules.append(Rule("R18", c, F.col(c) < 0, m["R18"]))
    if not any(r.rule == "R18" for r in rules):
        rs.not_run.append(("R18", "no column " + " or ".join(NON_NEGATIVE)))

    def alias_rule(rid, alias, id_role, name_role, id_col, name_col):                   # R19, R20
        if not runs(rid, id_role, name_role, lookup=alias):
            return
        i, n = ro[id_role], ro[name_role]
        an = F.lower(F.col(name_col)) if alias_case == "lower" else F.col(name_col)
        own, other, text = df.schema[i].dataType, alias.schema[id_col].dataType, T.StringType()
        rs.lookups[rid] = Lookup(
            pair_set(alias.select(id_col, an), f"_ok_{rid}"),
            lambda d, v: pair_flag(d, [F.col(i), F.lower(F.col(n))], v, f"_ok_{rid}"),
            one_text([(F.col(i), own, other), (F.lower(F.col(n)), text, text)], False),
            alias.select(one_text([(F.col(id_col), other, own), (an, text, text)], False).alias("value")),
            F.col(i).isNull() | F.col(n).isNull())
        rules.append(Rule(rid, n, ~F.col(f"_ok_{rid}"), m[rid]))

    alias_rule("R19", supplier_alias, "supplier_id", "supplier_name", "supplier_id", "alternative_name")
    alias_rule("R20", client_alias, "client_id", "client_name", "client_id", "alternative_name")
    return rs


def search_flags(rs: RuleSet, contract_rows: Sequence[tuple] = (), roles: dict | None = None,
                 row_id: str = "row_id") -> DataFrame:
    """Per row: ``normalized_name_search_flag`` (R14) and ``price_range_flag``."""
    find = column_finder(rs.base)
    ro = {k: find(v) for k, v in {**ROLES, **(roles or {})}.items()}
    name, price = ro["sku_normalized"], ro["unit_price"]
    if name is None or price is None:
        raise ValueError("search flags need the columns of the roles sku_normalized and unit_price")
    df = rs.with_lookups([n for n in ("R7", "R12") if n in rs.lookups])
    not_found = F.col(name).isNull()
    if "_in_R7" in df.columns:
        not_found = not_found | ~F.col("_in_R7")
    s_flag = F.when(not_found, F.lit(SEARCH_FLAG[1])).otherwise(F.lit(SEARCH_FLAG[0]))
    mandatory = {find(r[0]) for r in contract_rows if r[2] == "Y"}
    out_of = not_found
    if price in mandatory:
        out_of = out_of | F.col(price).isNull()
    if "_bmax" in df.columns:
        out_of = out_of | F.coalesce((F.col(price) > F.col("_bmax")) | (F.col(price) < F.col("_bmin")), F.lit(False))
    r_flag = F.when(out_of, F.lit(RANGE_FLAG[1])).otherwise(F.lit(RANGE_FLAG[0]))
    return df.select(F.col(row_id).alias("row_id"), s_flag.alias("normalized_name_search_flag"),
                     r_flag.alias("price_range_flag"))


def row_comments(violations: DataFrame, field_order: Sequence[str], rules: Sequence[str] = ("R16_null", "R16_missing"),
                 last_only: bool = False) -> DataFrame:
    """One comment per row from its failing lookup checks, in column order.

    ``last_only=True`` keeps only the last failing column's message, as the reference's overwritten comment cell.
    """
    pos = F.array_position(F.array(*[F.lit(c) for c in field_order]), F.col("field"))
    text = F.concat(F.col("message"), F.lit(" in "), F.col("field"))
    v = violations.where(F.col("rule").isin(*rules)).select("row_id", pos.alias("_p"), text.alias("_t"))
    if last_only:
        return v.groupBy("row_id").agg(F.max_by("_t", "_p").alias("comment"))
    return v.groupBy("row_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_t"))), lambda x: x["_t"]), "; ")
        .alias("comment"))
