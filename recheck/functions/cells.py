"""Scalar Column builders: cell text, key builders, normalisers, diff lists.

Everything here is a built-in expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's behaviour.
NULL_TEXT = "nan"  # how a missing cell renders as text
ASCII_ALNUM_STRIP = "[^A-Za-z0-9]"  # key variants A and B, and clean_key_text
UNICODE_ALNUM_STRIP = "[^\\p{L}\\p{N}]"  # key variant C (str.isalnum)
# White space that text cells are stripped of: every character of the Unicode white-space classes.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


# Of ASCII text both patterns take the same characters.
_ASCII_REST = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _without(text: Column, pattern: str) -> Column:
    """``text`` without the characters of ``pattern`` (one of the two above); a regular expression, some twenty times as
    dear, is asked only where there is more than ASCII."""
    plain = (F.octet_length(text) == F.length(text)) & F.is_valid_utf8(text)
    return F.when(plain, F.translate(text, _ASCII_REST, "")).otherwise(F.regexp_replace(text, pattern, ""))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is pandas' only null; make it Spark NULL right after a scan (Spark treats NaN = NaN as true)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def strip(c) -> Column:
    """Text without white space at its ends (``trim`` takes blanks only)."""
    return F.btrim(_c(c), F.lit(WHITE_SPACE))


def _expanded(text: Column) -> Column:
    """A number's text without its exponent: 5.0E-4 is 0.00050, 1E-7 is 0.0000001, 1.0E18 is 10 and 17 noughts."""
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(text, r"^-|\.|E.*$", "")  # one of them stands before the point
    e = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    more = e + 1 - F.length(digits)
    plain = (F.when(e < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits))
              .when(more >= 0, F.concat(digits, F.repeat(F.lit("0"), more)))
              .otherwise(F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."),
                                  F.substring(digits, e + 2, F.length(digits)))))
    return F.when(text.contains("E") & text.rlike(r"^-?[0-9](\.[0-9]+)?E-?[0-9]+$"), F.concat(sign, plain)).otherwise(text)


def number_text(c, dtype: T.DataType) -> Column:
    """One text per number, whatever its type: 10, 10.0 and 10.00 are '10', NULL and NaN are NULL.

    A double is the number that its shortest decimal text says. From 1e38 on, where no decimal and no whole number
    reaches, it keeps the text with an exponent.
    """
    col = _c(c)
    if isinstance(dtype, T.DecimalType):
        text = _expanded(col.cast("string"))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        v = F.nanvl(col.cast("string").cast("double") if isinstance(dtype, T.FloatType) else col,
                    F.lit(None).cast("double"))
        size = F.abs(v)
        # in this range the shortest decimal text of a double has at most 18 places after the point
        text = (F.when((v == F.floor(v)) & (size < 1e18), v.cast("decimal(38,0)").cast("string"))
                .when(size.between(1e-2, 1e15), v.cast("decimal(38,18)").cast("string"))
                .when(size < 1e38, _expanded(v.cast("string")))
                .otherwise(v.cast("string")))
    else:
        return col.cast("string")
    plain = text.contains(".") & ~text.contains("E")
    return F.when(plain, F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)


NUMBERS = (T.NumericType,)
TIMES = (T.TimestampType, T.TimestampNTZType)


def plain_text(c, dtype: T.DataType) -> Column:
    """A cell as text, NULL kept: numbers as ``number_text``, dates and midnight timestamps as yyyy-MM-dd."""
    col = _c(c)
    if isinstance(dtype, NUMBERS):
        return number_text(col, dtype)
    if isinstance(dtype, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(dtype, TIMES):
        day = col.cast("date")
        return F.when(col == day.cast(dtype), F.date_format(day, "yyyy-MM-dd")).otherwise(col.cast("string"))
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def cell_text(c, dtype: T.DataType | None = None) -> Column:
    """Render a cell as text, NULL -> 'nan' (N3). Without a type, by a plain cast."""
    col = _c(c)
    return F.coalesce(col.cast("string") if dtype is None else plain_text(col, dtype), F.lit(NULL_TEXT))


def comparable(c, own: T.DataType, other: T.DataType, mode: str = "exact") -> Column:
    """A cell as one text that is equal on both sides exactly where the cells are equal.

    Cells of one type compare by value: NaN is NULL, -0.0 is 0.0, timestamps are instants. Numbers of different types
    compare as numbers. Any other two types compare as ``plain_text``. NULL equals only NULL. ``ci`` compares the
    lower-cased text, with NULL as 'nan'.
    """
    col = _c(c)
    if mode == "ci":
        return F.lower(cell_text(col, own))
    if own == other and isinstance(own, (T.DoubleType, T.FloatType)):
        v = F.nanvl(col, F.lit(None).cast(own))
        return F.when(v == 0, F.lit("0.0")).otherwise(v.cast("string"))
    if own == other and isinstance(own, T.TimestampType):
        return F.unix_micros(col).cast("string")
    if own == other and isinstance(own, (T.DecimalType, T.TimestampNTZType)):
        return col.cast("string")
    return plain_text(col, own)


# Types whose values compare as they are, once NaN is NULL and -0.0 is 0.0.
_VALUES = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def cell_type(own: T.DataType, other: T.DataType, mode: str = "exact") -> T.DataType:
    """Type of ``cell``: the cells' own where both sides have it and its values compare as they are, else text."""
    return own if mode == "exact" and own == other and isinstance(own, _VALUES) else T.StringType()


def cell(c, own: T.DataType, other: T.DataType, mode: str = "exact") -> Column:
    """A cell in a form that is equal on both sides exactly where ``comparable`` is (D1): its value where it can be,
    else that text."""
    if cell_type(own, other, mode) != own or isinstance(own, T.StringType):
        return comparable(c, own, other, mode)
    col = _c(c)
    if isinstance(own, (T.DoubleType, T.FloatType)):
        v = F.nanvl(col, F.lit(None).cast(own))
        return F.when(v == 0, F.lit(0.0).cast(own)).otherwise(v)
    return col


def clean_key_text(c) -> Column:
    """Text reduced to ``[a-z0-9]``."""
    return F.lower(_without(_c(c).cast("string"), ASCII_ALNUM_STRIP))


def pseudo_key(df: DataFrame, cols: Sequence[str], variant: str = "ascii_lower", name: str = "pseudo_key",
               first: bool = True) -> DataFrame:
    """Derived row key (K1/K2/K3), placed first.

    ascii_lower   -- concat of cells as text (NULL -> 'nan'), lower-cased, stripped to [a-z0-9]   (variant A)
    ascii_case    -- cells joined by '-', stripped to [A-Za-z0-9], case kept                     (variant B)
    unicode_lower -- per cell: Unicode letters/digits kept, lower-cased; then concatenated        (variant C)
    """
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"key columns not in DataFrame: {missing}")
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in cols]
    if variant == "ascii_lower":
        key = _without(F.lower(F.concat(*texts)), ASCII_ALNUM_STRIP)
    elif variant == "ascii_case":
        key = _without(F.concat_ws("-", *texts), ASCII_ALNUM_STRIP)
    elif variant == "unicode_lower":
        key = F.concat(*[F.lower(_without(t, UNICODE_ALNUM_STRIP)) for t in texts])
    else:
        raise ValueError(f"unknown key variant {variant!r}")
    out = df.withColumn(name, key)
    if first:
        out = out.select(name, *[c for c in df.columns if c != name])
    return out


def diff_expr(left: dict, right: dict, cols: Sequence[str], mode: str = "exact") -> Column:
    """array<string> of the columns whose cells differ (D1), in ``cols`` order.

    ``left``/``right`` map column name -> Column. Modes: ``exact`` null-safe typed equality (the reference's
    text compare when both sides have one type), ``ci`` lower-cased text with NULL as 'nan'.
    """
    parts = []
    for c in cols:
        a, b = left[c], right[c]
        if mode == "ci":
            same = F.lower(cell_text(a)) == F.lower(cell_text(b))
        else:
            same = a.eqNullSafe(b)
        parts.append(F.when(~same, F.lit(c)))
    if not parts:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*parts))


def normalize_dates(df: DataFrame, cols: Sequence[str], on_error: str = "keep_column",
                    fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Dates to 'YYYY-MM-DD' text.

    ``keep_column``: all or nothing per column, as the reference (one bad value leaves that column untouched);
    ``null``: unparsable cells become NULL. The decision costs one aggregate pass over the named columns.
    """
    def parsed(c):
        return _as_date(df, c)

    if on_error == "null":
        return df.withColumns({c: F.date_format(parsed(c), fmt) for c in cols})
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & parsed(c).isNull()).alias(c) for c in cols]).first()
    ok = [c for c in cols if bad[c] == 0]
    return df.withColumns({c: F.date_format(parsed(c), fmt) for c in ok})


def _as_date(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(c)
    return F.try_to_timestamp(F.col(c).cast("string"))


def write_normalized(df: DataFrame, cols: Sequence[str], path: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """``normalize_dates`` (all or nothing a column) decided in the pass that writes: ``df`` is read once. Both forms of a
    column are written side by side and its bad cells observed on the way; the columns returned are those of the form
    that holds, and only they are read (N1)."""
    seen = Observation()
    new = {c: f"{c}__as_date" for c in cols}
    both = df.withColumns({new[c]: F.date_format(_as_date(df, c), fmt) for c in cols})
    both.observe(seen, *[F.count_if(F.col(c).isNotNull() & F.col(new[c]).isNull()).alias(f"bad{i}")
                         for i, c in enumerate(cols)]).write.parquet(path)
    bad = {c: seen.get[f"bad{i}"] for i, c in enumerate(cols)}
    written = df.sparkSession.read.schema(both.schema).parquet(path)
    return written.select(*[F.col(new[c]).alias(c) if c in new and not bad[c] else F.col(c) for c in df.columns])


def to_date_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Truncate named timestamp columns, or every timestamp column, to DATE."""
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.to_date(F.col(c)) for c in cols})


def clean_cells(df: DataFrame, trim: str = "both", cols: Sequence[str] | None = None) -> DataFrame:
    """Cells as text, NULL -> 'nan' (N4): numbers, dates and times as ``plain_text``, text stripped of white space at
    'both' ends, at its 'left' end, or not at all ('none'). The reference strips one side of a comparison or both:
    ``clean_sides``."""
    if trim not in ("both", "left", "none"):
        raise ValueError(f"unknown trim {trim!r}")
    cols = list(cols or df.columns)
    out = {}
    for c in cols:
        dt = df.schema[c].dataType
        v = plain_text(F.col(c), dt)
        if isinstance(dt, T.StringType) and trim != "none":
            v = strip(F.col(c)) if trim == "both" else F.ltrim(F.col(c), F.lit(WHITE_SPACE))
        out[c] = F.coalesce(v, F.lit(NULL_TEXT))
    return df.withColumns(out)


def clean_sides(left: DataFrame, right: DataFrame, trim: str = "both",
                cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a comparison as text cells (N4); ``trim``: 'left' strips the left side (the flat file) only,
    'both' strips both."""
    if trim not in ("left", "both"):
        raise ValueError(f"unknown trim {trim!r}")
    return clean_cells(left, "both", cols), clean_cells(right, "both" if trim == "both" else "none", cols)


def lower_strings(df: DataFrame) -> DataFrame:
    """Lower-case every string cell."""
    return df.withColumns({f.name: F.lower(F.col(f.name)) for f in df.schema.fields
                           if isinstance(f.dataType, T.StringType)})


def order_struct(cols: Sequence[str], row_id: str) -> Column:
    """Sort key with NULLs last per column and the unique row id as final tie-break (O1)."""
    parts = []
    for i, c in enumerate(cols):
        parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    parts.append(F.col(row_id).alias("rid"))
    return F.struct(*parts)
