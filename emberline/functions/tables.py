"""Codes, classes, layers and catalogues that results depend on."""

from __future__ import annotations

# Life-form classes.
LIFE_FORMS = {"Sparse": 0, "Tree": 1, "Shrub": 2, "Herb": 3, "Water": 4, "Barren": 5, "Developed": 6, "Snow-Ice": 7, "Agriculture": 8, "Nodata - Land": 9}

# The life form of each land-cover code; codes that are not listed are "Nodata - Land".
NLCD_LIFE_FORM = {
    0: "Nodata - Land", 11: "Water", 12: "Snow-Ice", 21: "Developed", 22: "Developed", 23: "Developed", 24: "Developed", 31: "Barren",
    41: "Tree", 42: "Tree", 43: "Tree", 52: "Shrub", 71: "Herb", 81: "Agriculture", 82: "Agriculture", 90: "Sparse", 95: "Sparse",
}
#: The listed codes in ascending order are the compact classes 0, 1, 2 and on; others share the number of "Nodata - Land".
NLCD_COMPACT = {code: k for k, code in enumerate(sorted(NLCD_LIFE_FORM))}
UNLISTED = LIFE_FORMS["Nodata - Land"]

# Codes on which a detection doesn't count as a wildfire's.
INVALID_COVER = (22, 23, 24, 81, 82, 0)
# How raster files mark missing cells.
MISSING = (-32768, -9999)
# What the ocean and unclassified land become in vegetation rasters.
OCEAN_CLASS, LAND_CLASS = 3292, 3000

# Land-cover datasets with category, abbreviation and version.
LAND_COVER = {
    "landfire_evt": ("vegetation", "EVT", "130"),
    "landfire_asp": ("topography", "ASP", "120"),
    "landfire_dem": ("topography", "DEM", "120"),
    "landfire_slp": ("topography", "SLP", "120"),
    "landfire_cbd": ("fuel", "CBD", "130"),
    "landfire_cbh": ("fuel", "CBH", "130"),
    "landfire_cc": ("fuel", "CC", "130"),
    "landfire_ch": ("fuel", "CH", "130"),
}

# Names of weather layers, instant and accumulated, and size of their grid.
WEATHER_INSTANT = (
    "Wind speed (gust)", "Temperature", "Lightning", "Precipitation rate", "Surface pressure", "Snow depth", "2 metre temperature",
    "2 metre relative humidity", "10 metre U wind component", "10 metre V wind component", "U component of wind", "V component of wind",
    "Low cloud cover", "Medium cloud cover", "High cloud cover", "Total Cloud Cover", "Moisture availability",
)
WEATHER_SAMPLE = (
    "Wind speed (gust)", "Temperature", "Precipitation rate", "Surface pressure", "2 metre temperature", "2 metre relative humidity",
    "10 metre U wind component", "10 metre V wind component", "U component of wind", "V component of wind",
)
WEATHER_ACCUMULATED = ("Total Precipitation", "Total snowfall", "Convective precipitation (water)", "Large scale precipitation (non-convective)")
WEATHER_GRID = (337, 451)

# Fixed values in hours before and after a point: layer, kind, from, to (half-open).
LAGS = (12, 24, 36, 48, 60)
AGGREGATES = ((60, 168), (168, 365 * 24))
FORECASTS = (24, 48, 72, 96, 120)
WEATHER_PAIRS = ((0, 24), (24, 48), (48, 72), (72, 96), (96, 120))
# Fixed values in metres: detection cell, window, weather cell.
CELL, WINDOW, WEATHER_CELL = 375, 22_500, 11_250
#: Small cells along the side of a cell, 15 metres each, of which shares are counted.
PARTS = 25
EARTH_KM = 6371.0
