"""Distance on the globe from latitude and longitude."""

import math

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0088


def great_circle_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    half_lat = (F.radians(lat_b) - F.radians(lat_a)) / 2
    half_lon = (F.radians(lon_b) - F.radians(lon_a)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat_a)) * F.cos(
        F.radians(lat_b)
    ) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


class Cover:
    """Cells that cover the globe so that what lies within a radius of a point is in few of them.

    Bands of latitude are at least a radius high, and a band is cut by longitude into cells that
    are about a radius wide at its edge nearer to the pole; a band that touches a pole is one cell.
    Cells are whole numbers, so that a search by distance becomes a join by equality.
    """

    # Rounding must not put a point at the edge of a radius into a cell that is not asked.
    MARGIN = 1e-9

    def __init__(self, radius_km: float):
        self.degrees = math.degrees(radius_km / EARTH_RADIUS_KM) * (1 + self.MARGIN) + self.MARGIN
        self.bands = max(1, int(180 / self.degrees))
        self.height = 180 / self.bands

    def _band(self, latitude: Column) -> Column:
        band = F.floor((latitude + 90) / self.height)
        return F.greatest(F.lit(0), F.least(band, F.lit(self.bands - 1))).cast("long")

    def _cells(self, band: Column) -> Column:
        """Cells of a band."""
        edge = F.greatest(F.abs(band * self.height - 90), F.abs((band + 1) * self.height - 90))
        wide = F.greatest(F.cos(F.radians(edge)), F.lit(0.0)) * 360 / self.degrees
        return F.greatest(F.floor(wide), F.lit(1)).cast("long")

    @staticmethod
    def _east(longitude: Column) -> Column:
        return F.pmod(longitude + 180, F.lit(360.0))

    @staticmethod
    def _number(band: Column, cell: Column) -> Column:
        return F.struct(band.alias("band"), cell.alias("cell"))

    def cell(self, latitude: Column, longitude: Column) -> Column:
        """The cell of a point."""
        band = self._band(latitude)
        cells = self._cells(band)
        at = F.floor(self._east(longitude) / (F.lit(360.0) / cells)).cast("long")
        return self._number(band, F.least(at, cells - 1))

    def around(self, latitude: Column, longitude: Column) -> Column:
        """The cells, each once, of all points within the radius of a point."""
        to_pole = 90 - F.abs(latitude)
        reach = F.sin(F.radians(F.lit(min(self.degrees, 90.0)))) / F.cos(F.radians(latitude))
        span = F.when(
            to_pole > self.degrees, F.degrees(F.asin(F.least(reach, F.lit(1.0)))) + self.MARGIN
        ).otherwise(F.lit(180.0))
        east = self._east(longitude)

        def of_band(band: Column) -> Column:
            cells = self._cells(band)
            width = F.lit(360.0) / cells
            first = F.floor((east - span) / width - self.MARGIN).cast("long")
            last = F.floor((east + span) / width + self.MARGIN).cast("long")
            last = F.least(last, first + cells - 1)
            return F.transform(
                F.sequence(first, last), lambda c: self._number(band, F.pmod(c, cells))
            )

        low = self._band(latitude - self.degrees)
        high = self._band(latitude + self.degrees)
        return F.flatten(F.transform(F.sequence(low, high), of_band))
