"""Checks of a categorical field before it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.guards import is_finite


def invalid_codes(field: DataFrame, column: str = "ptype") -> DataFrame:
    """Distinct whole values that aren't codes, in order."""
    v = F.col(column).cast("double")
    return field.where(is_finite(v) & (v == F.rint(v))).select(F.col(column).cast("int").alias("code")).distinct().where(~F.col("code").isin(*C.CODE_NAMES)).orderBy("code")


def check_codes(field: DataFrame, column: str = "ptype", *, expected: int | None = None) -> DataFrame:
    """The field with integer codes; raises ValueError on a wrong count, undefined, broken or unknown values."""
    v = F.col(column).cast("double")
    whole = is_finite(v) & (v == F.rint(v))
    n, undefined, broken, strange = field.agg(F.count("*"), F.count_if(~is_finite(v)), F.count_if(is_finite(v) & (v != F.rint(v))), F.count_if(whole & ~v.isin(*map(float, C.CODE_NAMES)))).first()
    if expected is not None and n != expected:
        raise ValueError(f"the field has {n} values, expected {expected}")
    if undefined:
        raise ValueError(f"{undefined} value(s) are not finite")
    if broken:
        raise ValueError(f"{broken} value(s) are not whole numbers")
    if strange:
        unknown = [str(r["code"]) for r in invalid_codes(field, column).limit(20).collect()]
        raise ValueError(f"unknown code(s) {', '.join(unknown)}; allowed are {', '.join(map(str, sorted(C.CODE_NAMES)))}")
    return field.withColumn(column, F.col(column).cast("int"))
