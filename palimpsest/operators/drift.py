"""Weight drift between two snapshots of a named-vector table (O-29)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def l2(v: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(v, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                              lambda a, b: a + b))


def l2_diff(a: Column, b: Column) -> Column:
    d = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(F.transform(d, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))


def vector_drift(base: DataFrame, tuned: DataFrame, name_contains: str = "lora", name: str = "name",
                 vec: str = "vec", digits: int = 6) -> DataFrame:
    """For tuned names containing ``name_contains`` (case-insensitive): L2 norm of the
    difference when the name exists in ``base``, else the L2 norm of the vector.

    A left equi-join on the name; vectors never leave their rows.
    """
    t = tuned.filter(F.lower(F.col(name)).contains(name_contains.lower())).select(F.col(name), F.col(vec).alias("_t"))
    b = base.select(F.col(name), F.col(vec).alias("_b"))
    j = t.join(b, name, "left")
    kind = F.when(F.col("_b").isNull(), F.lit("new")).otherwise(F.lit("diff"))
    value = F.when(F.col("_b").isNull(), l2(F.col("_t"))).otherwise(l2_diff(F.col("_t"), F.col("_b")))
    return j.select(name, kind.alias("kind"), F.round(value, digits).alias("l2"))
