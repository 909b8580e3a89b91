"""Choosing a join by the measured size of its small side."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_BYTES = 16


def _bytes(column, kind):
    """A value as bytes: texts and binaries by length, collections by what they hold."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + _FIXED_BYTES
    if isinstance(kind, T.StructType):
        sizes = [_bytes(column[f.name], f.dataType) for f in kind.fields]
        return sum(sizes, F.lit(_FIXED_BYTES).cast("bigint"))
    if isinstance(kind, T.MapType):
        both = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return _bytes(F.map_entries(column), T.ArrayType(both))
    if isinstance(kind, T.ArrayType):
        start = F.lit(_FIXED_BYTES).cast("bigint")
        if isinstance(kind.elementType, (T.NumericType, T.DateType, T.BooleanType, T.TimestampType)):
            return F.greatest(F.coalesce(F.size(column), F.lit(0)), F.lit(0)).cast("bigint") * 8 + start
        held = F.aggregate(column, F.lit(0).cast("bigint"), lambda n, x: n + _bytes(x, kind.elementType))
        return F.coalesce(held, F.lit(0).cast("bigint")) + start
    return F.lit(_FIXED_BYTES).cast("bigint")


def measured_bytes(df):
    """Rows of ``df`` as bytes, with all that their collections hold."""
    widths = [_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    total = sum(widths[1:], widths[0])
    return df.agg(F.sum(total)).first()[0] or 0


def broadcast_if_small(df, limit=BROADCAST_BYTES):
    """``df`` marked for broadcast when measured within ``limit``, else ``df`` as it is.

    Unmarked, the join shuffles both sides and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
