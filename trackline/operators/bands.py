"""Band join: ``left.value BETWEEN band.lo AND band.hi`` on equal keys.

Bands (tyre stints) are small integer ranges of laps.  Instead of an
equi-join on the keys with a range residual (all stint x lap pairs of a
driver), each band is exploded into one row per covered integer value and
joined on keys + value: an ordinary equi-join whose output multiplicity is
exactly that of the band join (one row per covering band).

``domain`` (optional: keys + value column, e.g. the laps table) clips each
band to the values that exist for its key.  The clip is exact because a
left row's value always lies in its key's domain, and it bounds the
explosion when a band's upper end is a large sentinel (ongoing stint).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def band_join(left: DataFrame, bands: DataFrame, keys: Sequence[str], value: str,
              lo: str, hi: str, how: str = "left",
              domain: DataFrame | None = None) -> DataFrame:
    keys = list(keys)
    b = bands.where(F.col(lo).isNotNull() & F.col(hi).isNotNull() & (F.col(lo) <= F.col(hi)))
    lo_c, hi_c = F.col(lo), F.col(hi)
    if domain is not None:
        rng = domain.groupBy(*keys).agg(F.min(value).alias("_dom_lo"), F.max(value).alias("_dom_hi"))
        b = b.join(rng, keys, "inner")
        lo_c = F.greatest(F.col(lo), F.col("_dom_lo"))
        hi_c = F.least(F.col(hi), F.col("_dom_hi"))
    band_cols = [c for c in bands.columns if c not in keys]
    exploded = (b.where(lo_c <= hi_c)
                .select(*keys, *band_cols, F.explode(F.sequence(lo_c, hi_c)).alias(value)))
    return left.join(exploded, keys + [value], how)
