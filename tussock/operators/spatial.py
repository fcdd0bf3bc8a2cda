"""Walking-distance join without a nested loop.

``centres LEFT JOIN points ON haversine(...) < r`` plans as a nested-loop join
(O(n*m)). Instead both sides get grid-cell keys and are equi-joined:

* latitude bands of height r/R (in degrees): a pair closer than r is at most
  one band apart;
* inside a band, longitude cells whose width is derived from the band's
  latitude range, so a pair closer than r is at most one cell apart (with
  wrap-around at the antimeridian).

Each point gets exactly one (band, cell) key, each centre the 3 x 3 (or fewer)
neighbouring keys, so the large side is never duplicated. The exact haversine
filter then removes false candidates; results equal the brute-force join.

The grid has several levels. Cells are counted first, on a grid eight times
finer; a cell with more than ``CELL_POINTS`` points is split into 4, 16 or 64
parts, and a part that is still crowded (a block of equal places) is dealt out
by a hash. A point's key has its own cell's level, and a centre expands over the
parts of a crowded cell that lie within reach.

Counting needs no pairs: ``count_within_distance`` collapses equal places, takes the parts of crowded cells that
lie wholly within the radius by their counts, and meets single places only in the parts that the circle cuts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tussock.functions.geo import EARTH_RADIUS_KM, band_height_deg, haversine_km, lon_cell_width_deg

# Points of a grid cell (or part of one) that meet in a task; a cell with more is split.
CELL_POINTS = 20_000
# Finest level: a cell is split into 2 ** LEVELS parts each way.
LEVELS = 3
# For counting: distinct places of a cell that are met one by one; one with more is cut into 8 x 8 parts, and those once more.
NODE_PLACES = 256
COUNT_BITS = 6
# Distinct places of a smallest part that meet in a task; more are dealt out by a hash.
LEAF_PLACES = 2_000


def _band(lat: Column, height: float) -> Column:
    return F.floor((lat + F.lit(90.0)) / F.lit(height))


def _cells(band: Column, height: float, radius_km: float) -> tuple[Column, Column]:
    """(number of cells, cell width) for a band."""
    width = lon_cell_width_deg(band, height, radius_km)
    n = F.greatest(F.floor(F.lit(360.0) / width), F.lit(1))
    return n, F.lit(360.0) / n


def _cell_index(lon: Column, n: Column, width: Column) -> Column:
    return F.pmod(F.floor((lon + F.lit(180.0)) / width), n)


# Key for points without coordinates: never produced by a centre.
_NO_CELL = -(2 ** 62)


def point_cells(points: DataFrame, lat: str, lon: str, radius_km: float, levels: int = LEVELS) -> DataFrame:
    """Add ``_band`` and ``_cell`` (one key per point), and the place in the cell on the finest of ``levels`` (``_y``, ``_x``).

    Points without coordinates can never be within range and are dropped first.
    The keys are declared non-nullable (``coalesce`` with an unreachable key),
    otherwise the optimizer infers ``isnotnull(<key expression>)`` join filters
    and evaluates the trigonometry twice per point.
    """
    h = band_height_deg(radius_km)
    valid = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    band = _band(F.col(lat), h)
    n, width = _cells(band, h, radius_km)
    fine = 1 << levels

    def part(at):
        return F.coalesce(F.least(F.floor((at - F.floor(at)) * fine), F.lit(fine - 1)), F.lit(0)).cast("int")

    return valid.select(
        "*",
        F.coalesce(band, F.lit(_NO_CELL)).alias("_band"),
        F.coalesce(_cell_index(F.col(lon), n, width), F.lit(_NO_CELL)).alias("_cell"),
        part((F.col(lat) + F.lit(90.0)) / F.lit(h)).alias("_y"),
        part((F.col(lon) + F.lit(180.0)) / width).alias("_x"),
    )


def _on_level(place: str) -> Column:
    """A finest place in its cell, on the cell's level (0 in cells that are not split)."""
    return F.expr(f"shiftright({place}, {LEVELS} - coalesce(_level, 0))").alias(place)


def crowded_parts(cells: DataFrame, cell_points: int = CELL_POINTS) -> DataFrame:
    """(_band, _cell, _level, _y, _x, _salts): the parts of the cells with more than ``cell_points`` points.

    ``cells`` is the result of ``point_cells``. It is counted once, by cell and finest part; levels and salts follow
    from those counts.
    """
    fine = cells.groupBy("_band", "_cell", "_y", "_x").agg(F.count(F.lit(1)).alias("_n"))
    full = fine.groupBy("_band", "_cell").agg(F.sum("_n").alias("_all")).filter(F.col("_all") > cell_points)
    level = F.least(F.ceil(F.log(4.0, F.col("_all") / F.lit(float(cell_points)))), F.lit(LEVELS)).cast("int")
    full = full.select("_band", "_cell", level.alias("_level"))
    parts = fine.join(full, ["_band", "_cell"]).select("_band", "_cell", "_level", _on_level("_y"), _on_level("_x"), "_n")
    return parts.groupBy("_band", "_cell", "_level", "_y", "_x").agg(F.ceil(F.sum("_n") / cell_points).alias("_salts"))


def centre_cells(centres: DataFrame, lat: str, lon: str, radius_km: float) -> DataFrame:
    """Explode each centre to the neighbouring (band, cell) keys that may hold
    a point within ``radius_km``; ``_at`` is the centre's place in cells of that band."""
    h = band_height_deg(radius_km)
    b0 = _band(F.col(lat), h)
    with_band = centres.withColumn("_band", F.explode(F.array(b0 - 1, b0, b0 + 1)))
    n, width = _cells(F.col("_band"), h, radius_km)
    idx = _cell_index(F.col(lon), n, width)
    neighbours = F.array_distinct(F.array(F.pmod(idx - 1, n), idx, F.pmod(idx + 1, n)))
    return with_band.withColumn("_cell", F.explode(neighbours)).withColumns(
        {"_at": (F.col(lon) + F.lit(180.0)) / width, "_of": n.cast("double")})


def _in_reach(lat: str, height: float) -> Column:
    """Whether a part of a crowded cell may hold a point within one band height and one cell width of the centre."""
    share = F.lit(1.0) / F.pow(F.lit(2.0), F.col("_level"))
    low = (F.col("_band") + F.col("_y") * share) * F.lit(height) - F.lit(90.0)
    up_down = F.greatest(low - F.col(lat), F.col(lat) - (low + share * F.lit(height)))
    left = F.col("_cell") + F.col("_x") * share - F.col("_at")
    left = F.pmod(left + F.col("_of") / 2, F.col("_of")) - F.col("_of") / 2
    # Cells that go round the globe have too few neighbours for a side to be out of reach.
    sideways = F.when(F.col("_of") < 4, F.lit(0.0)).otherwise(F.greatest(left, -(left + share)))
    return (up_down <= F.lit(height * 1.000001)) & (sideways <= F.lit(1.000001))


def within_distance(
    centres: DataFrame,
    points: DataFrame,
    radius_km: float,
    centre_lat: str = "centroid_lat",
    centre_lon: str = "centroid_lon",
    point_lat: str = "lat",
    point_lon: str = "lon",
    cell_points: int = CELL_POINTS,
) -> DataFrame:
    """Inner join of centres and points with haversine distance < radius_km (strict).

    Column names of the two inputs must not collide. One equi-join on the cell
    key at every size; the engine broadcasts the centre side when its own size
    estimate or the measured size allows. A crowded cell (say a third of all
    points in one city block) is split by place, then by hash, into keys of at most about ``cell_points``
    points each; the few centres near it are repeated for the parts in reach.
    """
    p = point_cells(points, point_lat, point_lon, radius_km)
    parts = crowded_parts(p.select("_band", "_cell", "_y", "_x"), cell_points)
    levels = parts.select("_band", "_cell", "_level").distinct()
    keys = ["_band", "_cell", "_y", "_x", "_salt"]
    split = p.join(levels, ["_band", "_cell"], "left").withColumns({a: _on_level(a) for a in ("_y", "_x")})
    split = split.join(parts.drop("_level"), ["_band", "_cell", "_y", "_x"], "left")
    # Deterministic salt (a hash of the point's own columns): a retried task
    # after an executor loss assigns every point to the same salt again.
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    split = split.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in points.columns]), salts)).drop("_level", "_salts")
    c = centre_cells(centres, centre_lat, centre_lon, radius_km).join(parts, ["_band", "_cell"], "left")
    c = c.filter(F.col("_level").isNull() | _in_reach(centre_lat, band_height_deg(radius_km)))
    c = c.withColumns({"_y": F.coalesce("_y", F.lit(0)), "_x": F.coalesce("_x", F.lit(0))})
    c = c.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_level", "_salts", "_at", "_of")
    pairs = split.join(c, on=keys, how="inner")
    dist = haversine_km(F.col(centre_lat), F.col(centre_lon), F.col(point_lat), F.col(point_lon))
    return pairs.filter(dist < F.lit(radius_km)).drop(*keys)


def _boxes(df: DataFrame, *keys) -> DataFrame:
    """Places, weight and bounds of the parts with the same ``keys``."""
    return df.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum("_w").alias("_w"), F.min("_s").alias("_s"), F.max("_t").alias("_t"),
                                 F.min("_l").alias("_l"), F.max("_r").alias("_r"))


def _box_reach(radius_km: float) -> tuple[Column, Column]:
    """(whether the box may hold a place within the radius of the centre, whether all of the box lies within it).

    The box spans ``_s`` to ``_t`` and ``_l`` to ``_r``. Compared is hav(d / R) = sin^2(dphi/2) + cos phi1 cos phi2
    sin^2(dlambda/2) at the nearest and farthest latitude, longitude and cosine of the box. The margins are wider than
    the rounding of the distance itself; what lies between the two is left to the exact distance.
    """
    angle = radius_km / EARTH_RADIUS_KM
    hav, margin = math.sin(min(angle, math.pi) / 2) ** 2, 1e-6 + 1e-14 / max(angle, 1e-300)
    lat, lon = F.col("_clat"), F.col("_clon")

    def half_sin2(degrees):
        return F.pow(F.sin(F.radians(degrees) / 2), 2)

    far = F.greatest(F.abs(lat - F.col("_s")), F.abs(lat - F.col("_t")))
    near = F.greatest(F.col("_s") - lat, lat - F.col("_t"), F.lit(0.0))
    cos, own = F.abs(F.cos(F.radians("_s"))), F.cos(F.radians(lat))
    spread = F.radians(F.col("_t") - F.col("_s"))
    left, right, narrow = F.col("_l") - lon, F.col("_r") - lon, F.col("_r") - F.col("_l") < 180
    ends = (half_sin2(left), half_sin2(right))
    most = half_sin2(far) + F.abs(own) * F.least(cos + spread, F.lit(1.0)) * F.greatest(*ends)
    whole = narrow & (ends[0] < 0.5) & (ends[1] < 0.5) & (far < 180) & (most < hav * (1 - margin))
    across = ~narrow | (F.floor(left / 360) < F.floor(right / 360))
    least = half_sin2(near) + own * F.greatest(cos - spread, F.lit(0.0)) * F.when(across, F.lit(0.0)).otherwise(F.least(*ends))
    on_globe = (F.abs(lat) <= 90) & (F.col("_s") >= -90) & (F.col("_t") <= 90)
    return ~(on_globe & (least > hav * (1 + margin))), whole


def _weights(spots: DataFrame, places: DataFrame, radius_km: float, node_places: int) -> DataFrame:
    """(_clat, _clon, _w): parts of the sum of ``_w`` over the ``places`` (_plat, _plon, _w) around each of the ``spots``."""
    def coarse(c):
        return F.shiftright(c, COUNT_BITS // 2).alias(c)

    where = ["_band", "_cell", "_y", "_x"]
    p = point_cells(places, "_plat", "_plon", radius_km, COUNT_BITS)
    fine = p.groupBy(*where).agg(F.count(F.lit(1)).alias("_n"), F.sum("_w").alias("_w"), F.min("_plat").alias("_s"),
                                 F.max("_plat").alias("_t"), F.min("_plon").alias("_l"), F.max("_plon").alias("_r"))
    cells, parts = _boxes(fine, "_band", "_cell"), _boxes(fine, "_band", "_cell", coarse("_y"), coarse("_x"))
    may, whole = _box_reach(radius_km)

    def met(open_nodes, nodes, keys):
        return open_nodes.join(nodes, keys).filter(may).withColumn("_whole", whole)

    def further(nodes, *keys):
        return nodes.filter(~F.col("_whole") & (F.col("_n") > node_places)).select("_clat", "_clon", "_band", "_cell", *keys)

    # The last step's parts are not cut again, whatever they hold.
    steps = [met(centre_cells(spots, "_clat", "_clon", radius_km).select("_clat", "_clon", "_band", "_cell"), cells, ["_band", "_cell"])
             .withColumns({"_y": F.lit(0), "_x": F.lit(0)})]
    steps.append(met(further(steps[0]), parts, ["_band", "_cell"]))
    inner = fine.withColumns({"_py": coarse("_y"), "_px": coarse("_x")})
    steps.append(met(further(steps[1], F.col("_y").alias("_py"), F.col("_x").alias("_px")), inner, ["_band", "_cell", "_py", "_px"]))
    steps = [n.select("_clat", "_clon", *where, F.lit(i).alias("_step"), "_n", "_w", "_whole") for i, n in enumerate(steps)]
    nodes = steps[0].unionByName(steps[1]).unionByName(steps[2])
    cut = nodes.filter(~F.col("_whole") & ((F.col("_n") <= node_places) | (F.col("_step") == 2)))
    salts = F.ceil(F.greatest(F.col("_n"), F.lit(1)) / LEAF_PLACES)
    cut = cut.select("_clat", "_clon", "_step", *where, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_salt"))

    cell, part = Window.partitionBy("_band", "_cell"), Window.partitionBy("_band", "_cell", F.shiftright("_y", COUNT_BITS // 2), F.shiftright("_x", COUNT_BITS // 2))
    step = (F.when(F.sum("_n").over(cell) <= node_places, 0).when(F.sum("_n").over(part) <= node_places, 1).otherwise(2))
    at = fine.select(*where, step.alias("_step"), F.when(step == 2, salts).otherwise(F.lit(1).cast("long")).alias("_salts"))

    def on_step(c):
        return F.when(F.col("_step") == 0, F.lit(0)).when(F.col("_step") == 1, coarse(c)).otherwise(F.col(c)).alias(c)

    keyed = p.join(at, where).select("_plat", "_plon", "_w", "_step", "_band", "_cell", on_step("_y"), on_step("_x"),
                                     F.pmod(F.xxhash64("_plat", "_plon"), "_salts").alias("_salt"))
    pairs = keyed.join(cut, ["_step", *where, "_salt"])
    pairs = pairs.filter(haversine_km(F.col("_clat"), F.col("_clon"), F.col("_plat"), F.col("_plon")) < F.lit(radius_km))
    return nodes.filter("_whole").select("_clat", "_clon", "_w").unionByName(pairs.select("_clat", "_clon", "_w"))


def count_within_distance(
    centres: DataFrame,
    points: DataFrame,
    radius_km: float,
    centre_key: str,
    point_id: str,
    out_col: str,
    centre_lat: str = "centroid_lat",
    centre_lon: str = "centroid_lon",
    point_lat: str = "lat",
    point_lon: str = "lon",
    cell_points: int = NODE_PLACES,
) -> DataFrame:
    """Per centre, COUNT(point_id) of points within the radius (strict); 0 when none.

    Equal places are counted once on either side (a NULL point id counts 0, as COUNT(col) skips NULLs), so that copies
    meet no copies. A cell with more than ``cell_points`` distinct places is cut into 8 x 8 parts, and those once more:
    parts wholly within the radius add their count, parts out of reach nothing, and only the places of parts that
    the circle cuts are compared by distance. Every centre row then takes the sum of its place, and one aggregation sums
    them by key; a NULL centre key is its own group, as in GROUP BY.
    """
    keys = centres.select(F.col(centre_key).alias("_key"), F.col(centre_lat).cast("double").alias("_clat"),
                          F.col(centre_lon).cast("double").alias("_clon"))
    spots = keys.select("_clat", "_clon").filter("_clat is not null and _clon is not null").distinct()
    places = points.select(F.col(point_lat).cast("double").alias("_plat"), F.col(point_lon).cast("double").alias("_plon"), F.col(point_id).alias("_id"))
    places = places.filter("_plat is not null and _plon is not null").groupBy("_plat", "_plon").agg(F.count("_id").alias("_w"))
    found = _weights(spots, places, radius_km, cell_points).groupBy("_clat", "_clon").agg(F.sum("_w").alias("_w"))
    return (keys.join(found, ["_clat", "_clon"], "left").groupBy("_key")
            .agg(F.sum(F.coalesce("_w", F.lit(0).cast("long"))).cast("long").alias(out_col)).withColumnRenamed("_key", centre_key))
