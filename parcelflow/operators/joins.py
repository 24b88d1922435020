"""Key joins: changed-key restriction (J1), orphans.

Both are semi/anti joins on a key: Spark shuffles both sides on the key
(or broadcasts the key side when AQE measures it small at run time); no
side is broadcast by a static hint, since key lists grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def restrict_to_keys(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys``. A left-semi join
    returns the same rows as an inner join on DISTINCT keys, without
    materialising the distinct list."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on), on=on, how="left_semi")


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str | None = None) -> DataFrame:
    """Child rows with a non-NULL ``column`` that has no ``field`` in
    ``parent``."""
    field = field or column
    p = parent.select(F.col(field).alias("__pk")).filter(F.col("__pk").isNotNull())
    c = child.filter(F.col(column).isNotNull())
    return c.join(p, c[column] == p["__pk"], "left_anti")
