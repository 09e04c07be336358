"""Map projections, grids and tiles as SQL expressions and Columns.

The texts are plain SQL arithmetic, so they run inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84, UTM and the MODIS sinusoidal tile grid.
A_WGS84 = 6378137.0
F_WGS84 = 1 / 298.257223563
K0 = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0
SPHERE_RADIUS = 6371007.181
SINU_X_MIN = -20015109.354
SINU_Y_MAX = 10007554.677
TILE_SIZE = 20015109.354 * 2.0 / 36.0
METRES_PER_DEGREE = 111320.0

_N = F_WGS84 / (2 - F_WGS84)
_E = math.sqrt(F_WGS84 * (2 - F_WGS84))
_RECT = A_WGS84 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Series of Krueger (1912) in the third flattening.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def num(x: float) -> str:
    """A double literal of SQL."""
    return f"{x!r}e0" if "e" not in repr(float(x)) else repr(float(x))


def utm_zone(lon: str) -> str:
    """Zone 1..60; longitudes wrap, no exceptions for Norway or Svalbard."""
    wrapped = f"(({lon} + 180e0) - 360e0 * floor(({lon} + 180e0) / 360e0))"
    return f"CAST(greatest(1, least(60, floor({wrapped} / 6e0) + 1)) AS INT)"


def utm_epsg(lon: str, lat: str) -> str:
    """326xx north of the equator and on it, 327xx south."""
    return f"(CASE WHEN {lat} >= 0 THEN 32600 ELSE 32700 END + {utm_zone(lon)})"


def _meridian(epsg: str) -> str:
    return f"(6e0 * ({epsg} % 100) - 183e0)"


def to_utm(lon: str, lat: str, epsg: str) -> tuple[str, str]:
    """Easting and northing of a point in the zone of an EPSG code."""
    sin = f"sin(radians({lat}))"
    t = f"sinh(atanh({sin}) - {num(_E)} * atanh({num(_E)} * {sin}))"
    dl = f"radians({lon} - {_meridian(epsg)})"
    xi, eta = f"atan2({t}, cos({dl}))", f"atanh(sin({dl}) / sqrt(1e0 + {t} * {t}))"
    x = " + ".join([eta, *(f"{num(a)} * cos({2 * j}e0 * {xi}) * sinh({2 * j}e0 * {eta})" for j, a in enumerate(_ALPHA, 1))])
    y = " + ".join([xi, *(f"{num(a)} * sin({2 * j}e0 * {xi}) * cosh({2 * j}e0 * {eta})" for j, a in enumerate(_ALPHA, 1))])
    south = f"(CASE WHEN {epsg} >= 32700 THEN {num(FALSE_NORTHING)} ELSE 0e0 END)"
    return f"({num(FALSE_EASTING)} + {num(K0 * _RECT)} * ({x}))", f"({south} + {num(K0 * _RECT)} * ({y}))"


def with_utm(df: DataFrame, lon: str, lat: str, epsg: str, x: str, y: str) -> DataFrame:
    """Adds ``to_utm`` step by step, so that no step is written out twice."""
    sin = f"sin(radians({lat}))"
    df = df.withColumn("u_t", F.expr(f"sinh(atanh({sin}) - {num(_E)} * atanh({num(_E)} * {sin}))")).withColumn("u_dl", F.expr(f"radians({lon} - {_meridian(epsg)})"))
    df = df.withColumns({"u_xi": F.expr("atan2(u_t, cos(u_dl))"), "u_eta": F.expr("atanh(sin(u_dl) / sqrt(1e0 + u_t * u_t))")})
    east = " + ".join(["u_eta", *(f"{num(a)} * cos({2 * j}e0 * u_xi) * sinh({2 * j}e0 * u_eta)" for j, a in enumerate(_ALPHA, 1))])
    north = " + ".join(["u_xi", *(f"{num(a)} * sin({2 * j}e0 * u_xi) * cosh({2 * j}e0 * u_eta)" for j, a in enumerate(_ALPHA, 1))])
    south = f"(CASE WHEN {epsg} >= 32700 THEN {num(FALSE_NORTHING)} ELSE 0e0 END)"
    place = F.struct(F.expr(f"{num(FALSE_EASTING)} + {num(K0 * _RECT)} * ({east})").alias(x), F.expr(f"{south} + {num(K0 * _RECT)} * ({north})").alias(y))
    # Expanding a list of one keeps the optimizer from writing the series out
    # again wherever x and y are used, which no generated method could hold.
    df = df.withColumn("u_place", F.explode(F.array(place)))
    return df.withColumns({x: F.col("u_place")[x], y: F.col("u_place")[y]}).drop("u_t", "u_dl", "u_xi", "u_eta", "u_place")


def from_utm(x: str, y: str, epsg: str) -> tuple[str, str]:
    """Longitude and latitude of an easting and northing."""
    south = f"(CASE WHEN {epsg} >= 32700 THEN {num(FALSE_NORTHING)} ELSE 0e0 END)"
    xi, eta = f"(({y} - {south}) / {num(K0 * _RECT)})", f"(({x} - {num(FALSE_EASTING)}) / {num(K0 * _RECT)})"
    xp = "(" + " - ".join([xi, *(f"{num(b)} * sin({2 * j}e0 * {xi}) * cosh({2 * j}e0 * {eta})" for j, b in enumerate(_BETA, 1))]) + ")"
    ep = "(" + " - ".join([eta, *(f"{num(b)} * cos({2 * j}e0 * {xi}) * sinh({2 * j}e0 * {eta})" for j, b in enumerate(_BETA, 1))]) + ")"
    chi = f"asin(sin({xp}) / cosh({ep}))"
    lat = " + ".join([chi, *(f"{num(d)} * sin({2 * j}e0 * {chi})" for j, d in enumerate(_DELTA, 1))])
    return f"({_meridian(epsg)} + degrees(atan2(sinh({ep}), cos({xp}))))", f"degrees({lat})"


def to_utm_steps(lon: str, lat: str, epsg: str, at: str) -> list[dict[str, str]]:
    """``to_utm`` in steps that each read the names of the one before, found
    as ``at`` and the name: u_t, u_dl; u_xi, u_eta; x, y."""
    sin = f"sin(radians({lat}))"
    xi, eta = f"{at}u_xi", f"{at}u_eta"
    east = " + ".join([eta, *(f"{num(a)} * cos({2 * j}e0 * {xi}) * sinh({2 * j}e0 * {eta})" for j, a in enumerate(_ALPHA, 1))])
    north = " + ".join([xi, *(f"{num(a)} * sin({2 * j}e0 * {xi}) * cosh({2 * j}e0 * {eta})" for j, a in enumerate(_ALPHA, 1))])
    south = f"(CASE WHEN {epsg} >= 32700 THEN {num(FALSE_NORTHING)} ELSE 0e0 END)"
    return [
        {"u_t": f"sinh(atanh({sin}) - {num(_E)} * atanh({num(_E)} * {sin}))", "u_dl": f"radians({lon} - {_meridian(epsg)})"},
        {"u_xi": f"atan2({at}u_t, cos({at}u_dl))", "u_eta": f"atanh(sin({at}u_dl) / sqrt(1e0 + {at}u_t * {at}u_t))"},
        {"x": f"{num(FALSE_EASTING)} + {num(K0 * _RECT)} * ({east})", "y": f"{south} + {num(K0 * _RECT)} * ({north})"},
    ]


def from_utm_steps(x: str, y: str, epsg: str, at: str) -> list[dict[str, str]]:
    """``from_utm`` in steps: u_xi, u_eta; u_xp, u_ep; u_chi, u_dl; lon, lat."""
    south = f"(CASE WHEN {epsg} >= 32700 THEN {num(FALSE_NORTHING)} ELSE 0e0 END)"
    xi, eta, chi = f"{at}u_xi", f"{at}u_eta", f"{at}u_chi"
    return [
        {"u_xi": f"(({y} - {south}) / {num(K0 * _RECT)})", "u_eta": f"(({x} - {num(FALSE_EASTING)}) / {num(K0 * _RECT)})"},
        {
            "u_xp": " - ".join([xi, *(f"{num(b)} * sin({2 * j}e0 * {xi}) * cosh({2 * j}e0 * {eta})" for j, b in enumerate(_BETA, 1))]),
            "u_ep": " - ".join([eta, *(f"{num(b)} * cos({2 * j}e0 * {xi}) * sinh({2 * j}e0 * {eta})" for j, b in enumerate(_BETA, 1))]),
        },
        {"u_chi": f"asin(sin({at}u_xp) / cosh({at}u_ep))", "u_dl": f"degrees(atan2(sinh({at}u_ep), cos({at}u_xp)))"},
        {"lon": f"{_meridian(epsg)} + {at}u_dl", "lat": "degrees(" + " + ".join([chi, *(f"{num(d)} * sin({2 * j}e0 * {chi})" for j, d in enumerate(_DELTA, 1))]) + ")"},
    ]


def to_sinusoidal(lon: str, lat: str) -> tuple[str, str]:
    return f"({num(SPHERE_RADIUS)} * radians({lon}) * cos(radians({lat})))", f"({num(SPHERE_RADIUS)} * radians({lat}))"


def from_sinusoidal(x: str, y: str) -> tuple[str, str]:
    lat = f"degrees({y} / {num(SPHERE_RADIUS)})"
    return f"degrees({x} / ({num(SPHERE_RADIUS)} * cos({y} / {num(SPHERE_RADIUS)})))", lat


def metres_per_degree_lon(lat: str) -> str:
    return f"greatest(1e0, {num(METRES_PER_DEGREE)} * cos(radians({lat})))"


def expand_bbox(metres: float, west="west", south="south", east="east", north="north") -> dict[str, str]:
    """A box grown by metres on all sides, clamped to the globe; unchanged for
    metres of 0 and less."""
    if metres <= 0:
        return {"west": west, "south": south, "east": east, "north": north}
    centre = f"greatest(-89.9999e0, least(89.9999e0, ({south} + {north}) / 2e0))"
    dlat, dlon = f"({num(metres)} / {num(METRES_PER_DEGREE)})", f"({num(metres)} / {metres_per_degree_lon(centre)})"
    return {"west": f"greatest(-180e0, {west} - {dlon})", "south": f"greatest(-90e0, {south} - {dlat})", "east": f"least(180e0, {east} + {dlon})", "north": f"least(90e0, {north} + {dlat})"}


def tile_origin(h: str, v: str) -> tuple[str, str]:
    """Upper left corner of a sinusoidal tile."""
    return f"({num(SINU_X_MIN)} + {h} * {num(TILE_SIZE)})", f"({num(SINU_Y_MAX)} - {v} * {num(TILE_SIZE)})"


def resolution_label(metres: Column) -> Column:
    return F.when(metres < 700, "500m").when(metres < 1500, "1km").otherwise(F.concat(F.round(metres).cast("int").cast("string"), F.lit("m")))


def pair(exprs: tuple[str, str], *names: str) -> dict[str, Column]:
    """Two expressions as named Columns."""
    return {n: F.expr(e) for n, e in zip(names, exprs)}
