"""Point geometry and map-ready output, as plain column expressions.

Coordinates are WGS 84 (SRID 4326) with x = longitude and y = latitude.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollstate.functions.timefn import display_time

# Fixed value: the coordinate reference system of every point.
SRID = 4326


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(lon: Column | str, lat: Column | str) -> Column:
    """``struct<x: lon, y: lat, srid: 4326>``."""
    return F.struct(_c(lon).cast("double").alias("x"), _c(lat).cast("double").alias("y"), F.lit(SRID).alias("srid"))


def wkt(lon: Column | str, lat: Column | str, decimals: int = 6) -> Column:
    """``POINT (lon lat)`` with a fixed number of decimals."""
    return F.format_string(f"POINT (%.{decimals}f %.{decimals}f)", _c(lon).cast("double"), _c(lat).cast("double"))


def geojson_feature(lon: Column | str, lat: Column | str, properties: list[str]) -> Column:
    """A GeoJSON Feature (text) with a Point geometry and the given columns as properties."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(_c(lon).cast("double"), _c(lat).cast("double")).alias("coordinates"))
    props = F.struct(*[F.col(p) for p in properties])
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), props.alias("properties")))


def map_ready(
    df: DataFrame, ts: str, lon: str = "lon", lat: str = "lat", category: str = "label"
) -> DataFrame:
    """Joined rows plus ``geometry`` (point), ``wkt``, the time as ``%Y-%m-%d %H:%M:%S`` text and a
    ``category`` column for colouring."""
    return df.select(
        *[F.col(c) for c in df.columns if c != ts],
        display_time(ts).alias(ts),
        point(lon, lat).alias("geometry"),
        wkt(lon, lat).alias("wkt"),
        F.col(category).alias("category"),
    )
