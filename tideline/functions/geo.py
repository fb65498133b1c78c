"""City bounding box and map grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The box and the cell size (degrees), and the number of cells per grid row.
LON_WEST, LON_EAST = -74.05, -73.7
LAT_SOUTH, LAT_NORTH = 40.5, 41.0
CELL_LON, CELL_LAT = 0.0014, 0.00125
CELLS_PER_ROW = 250


def in_city(lon: Column, lat: Column) -> Column:
    """Point inside the box, edges included. NaN and null are outside.

    The 32-bit coordinates are widened first, so the 32-bit -73.7 lies just outside.
    """
    x, y = lon.cast("double"), lat.cast("double")
    inside = x.between(LON_WEST, LON_EAST) & y.between(LAT_SOUTH, LAT_NORTH)
    return F.coalesce(inside & ~F.isnan(x) & ~F.isnan(y), F.lit(False))


def grid_cell(lon: Column, lat: Column) -> Column:
    """Number of the map cell that holds the point."""
    east = F.floor((F.lit(abs(LON_WEST)) - F.abs(lon.cast("double"))) / F.lit(CELL_LON))
    south = F.floor((F.lit(LAT_NORTH) - lat.cast("double")) / F.lit(CELL_LAT))
    return (east + south * CELLS_PER_ROW).cast("int")
