"""Deterministic deduplication: one survivor per key under a total order.

``dropDuplicates`` keeps an arbitrary row per key.  Here the survivor is
the first row under an explicit order.  The default plan is an aggregate:
the smallest ``struct(order, other columns)`` grouped by the key (the largest where all
strings descend).  A partial
aggregate runs before the shuffle, so a hot key (even a third of all rows)
is cut to one row per map task and the final reduce stays small.  Every order
has such a struct: strings and bytes that go against it enter by their complement,
structs, arrays and maps by their JSON text.  The ``row_number`` window form
is there on request only; it shuffles every row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import epoch_micros

# An order item is a column name, or (name, "asc"|"desc"), or
# (name, "asc"|"desc", nulls_last: bool).  Defaults follow Spark: ascending
# puts nulls first, descending puts them last.
OrderItem = str | tuple


def _norm(item: OrderItem) -> tuple[str, bool, bool]:
    if isinstance(item, str):
        return item, True, False
    name, direction, *rest = item
    asc = str(direction).lower() == "asc"
    nulls_last = rest[0] if rest else (not asc)
    return name, asc, bool(nulls_last)


HEX, COMPLEMENT = "0123456789ABCDEF", "FEDCBA9876543210"


def _complex(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def _descending_bytes(col: Column) -> Column:
    """Text whose ascending order is the descending order of the bytes of ``col``: their complement
    as hex digits, and a sign above all digits, so that a longer value comes before its beginnings."""
    return F.concat(F.translate(F.hex(col), HEX, COMPLEMENT), F.lit("G"))


def _ascending_value(col: Column, dtype: T.DataType) -> Column:
    """A value in whose order rows can be told apart; structs, arrays and maps by their JSON text."""
    return F.to_json(col) if _complex(dtype) else col


def _descending_value(col: Column, dtype: T.DataType) -> Column:
    """A value whose ascending order is the descending order of ``col``."""
    if _complex(dtype):
        return _descending_bytes(F.to_json(col))
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return _descending_bytes(col)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.bitwise_not(col.cast("long"))
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return -col
    if isinstance(dtype, T.BooleanType):
        return ~col
    if isinstance(dtype, T.DateType):
        return -F.unix_date(col)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return -epoch_micros(col, ntz=isinstance(dtype, T.TimestampNTZType))
    raise TypeError(f"no descending order over {dtype.simpleString()}")


def _original(value: Column, dtype: T.DataType, utc: bool) -> Column | None:
    """The column that ``_descending_value`` made ``value`` of, or None if that can't be told from it."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.bitwise_not(value).cast(dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return (-value).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return ~value
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(-value)
    if isinstance(dtype, T.TimestampType) or (isinstance(dtype, T.TimestampNTZType) and utc):
        return F.timestamp_micros(-value).cast(dtype)
    return None


def _long_when_complemented(dtype: T.DataType) -> bool:
    return _complex(dtype) or isinstance(dtype, (T.StringType, T.BinaryType))


def _order_fields(df: DataFrame, order: Sequence[OrderItem]) -> tuple[list[Column], dict[str, Callable], bool]:
    """The fields of a struct that orders rows by ``order``, what gives columns back out of that struct, and
    whether the first row has the largest struct (else the smallest).

    Largest comes first where that spares the complements of long values: every string, byte and nested
    item descends.  Nulls are smallest in a struct; a flag goes before an item only where that puts
    them on the wrong side.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    items = [_norm(item) for item in order]
    long_ones = {asc for name, asc, _ in items if _long_when_complemented(types[name])}
    largest = long_ones == {False}
    parts: list[Column] = []
    back: dict[str, Callable] = {}
    utc = df.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC"
    for i, (name, asc, nulls_last) in enumerate(items):
        col, dtype = F.col(name), types[name]
        if nulls_last != largest:
            parts.append(col.isNull().alias(f"n{i}"))
        if largest and not asc and isinstance(dtype, (T.FloatType, T.DoubleType)):
            parts.append((~F.isnan(col)).alias(f"f{i}"))     # NaN comes last, as by its complement
        if asc == largest:
            value = _descending_value(col, dtype)
            if _original(col, dtype, utc) is not None:
                back.setdefault(name, lambda row, f=f"v{i}", dtype=dtype: _original(row.getField(f), dtype, utc))
        else:
            value = _ascending_value(col, dtype)
            if not _complex(dtype):
                back[name] = lambda row, f=f"v{i}": row.getField(f)
        parts.append(value.alias(f"v{i}"))
    return parts, back, largest


def _can_be_ordered(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_can_be_ordered(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _can_be_ordered(dtype.elementType)
    return isinstance(dtype, (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType,
                              T.TimestampType, T.TimestampNTZType))


def _first_row(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem],
               only: Column | None = None) -> tuple[Column, Callable[[Column], dict[str, Column]]]:
    """The aggregate that finds the first row of a group of ``keys`` (of the rows ``only``), and what
    gives the columns other than keys out of its value.

    A column that orders rows travels once, not as a part of the row and again as a part
    of its place; keys that grouping gives back unchanged don't travel beside themselves.
    """
    parts, back, largest = _order_fields(df, order)
    types = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in df.columns if c not in back and not (c in keys and _same_when_grouped(types[c]))]
    when = (lambda x: x) if only is None else (lambda x: F.when(only, x))
    if all(_can_be_ordered(types[c]) for c in rest):
        best = (F.max if largest else F.min)(when(F.struct(*parts, *[F.col(c).alias(f"r{i}") for i, c in enumerate(rest)])))
    else:           # a map has no order
        back, rest = {}, df.columns
        row = F.struct(*[F.col(c).alias(f"r{i}") for i, c in enumerate(rest)])
        best = (F.max_by if largest else F.min_by)(when(row), when(F.struct(*parts)))
    at = back | {c: (lambda row, f=f"r{i}": row.getField(f)) for i, c in enumerate(rest)}
    return best, lambda value: {c: f(value).alias(c) for c, f in at.items()}


def _same_when_grouped(dtype: T.DataType) -> bool:
    """Whether grouping gives the values of a key back as they are (it makes one of 0.0 and -0.0)."""
    return isinstance(dtype, (T.IntegralType, T.StringType, T.BinaryType, T.BooleanType, T.DateType,
                              T.TimestampType, T.TimestampNTZType, T.DecimalType)) \
        and getattr(dtype, "collation", "UTF8_BINARY") == "UTF8_BINARY"


def _sort_exprs(order: Sequence[OrderItem]) -> list[Column]:
    out = []
    for item in order:
        name, asc, nulls_last = _norm(item)
        c = F.col(name)
        if asc:
            out.append(c.asc_nulls_last() if nulls_last else c.asc_nulls_first())
        else:
            out.append(c.desc_nulls_last() if nulls_last else c.desc_nulls_first())
    return out


def default_order(df: DataFrame, keys: Sequence[str]) -> list[OrderItem]:
    """Total order over every non-key column (ascending): identical rows tie,
    and for them any survivor is the same row."""
    return [c for c in df.columns if c not in keys]


def dedup_first(df: DataFrame, keys: Sequence[str],
                order: Sequence[OrderItem] | None = None,
                method: str = "auto") -> DataFrame:
    """One row per ``keys`` -- the first under ``order``.

    All-null keys form one group (as ``dropDuplicates`` does).  ``method`` is
    ``"auto"`` or ``"aggregate"`` (min_by, skew-proof, any order), or ``"window"``
    (row_number: shuffles every row), which a caller must ask for.
    """
    keys = list(keys)
    order = list(order) if order is not None else default_order(df, keys)
    if method != "window":
        best, columns = _first_row(df, keys, order)
        at = columns(F.col("_survivor"))
        return (df.groupBy(*keys).agg(best.alias("_survivor"))
                .select(*[at.get(c, F.col(c)) for c in df.columns]))
    w = Window.partitionBy(*keys).orderBy(*_sort_exprs(order))
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def dedup_sides(new: DataFrame, old: DataFrame, keys: Sequence[str], order: Sequence[OrderItem]) -> DataFrame:
    """``dedup_first`` of both frames (of the same columns) by one aggregate, so that no row is shuffled twice and nothing is joined.

    ``_came`` tells whether ``new`` has the key, ``_changed`` whether the row is another than that of ``old`` (or may
    be), ``_old`` has the first row of ``old`` (without keys; null: none).
    """
    keys = list(keys)
    rows = new.withColumn("_is_new", F.lit(True)).unionByName(old.withColumn("_is_new", F.lit(False)))
    plain = rows.drop("_is_new")
    (of_new, columns), (of_old, _) = [_first_row(plain, keys, order, side) for side in (F.col("_is_new"), ~F.col("_is_new"))]
    aggregates = [of_new.alias("_new"), of_old.alias("_old")]
    if all(_can_be_ordered(f.dataType) for f in plain.schema.fields):
        first = (F.greatest if _order_fields(plain, order)[2] else F.least)("_new", "_old")
        changed = ~F.col("_first").eqNullSafe(F.col("_old"))
    else:
        aggregates.append(_first_row(plain, keys, order)[0].alias("_first"))
        first, changed = F.col("_first"), F.lit(True)
    found = rows.groupBy(*keys).agg(*aggregates).withColumn("_first", first)
    at, before = columns(F.col("_first")), columns(F.col("_old"))
    return found.select(*[at.get(c, F.col(c)) for c in plain.columns], F.col("_new").isNotNull().alias("_came"), changed.alias("_changed"),
                        F.when(F.col("_old").isNotNull(), F.struct(*[x for c, x in before.items() if c not in keys])).alias("_old"))
