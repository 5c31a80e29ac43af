"""Station readings, gap-free runs and the nearest station with a complete history."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenolith.functions import columns as X
from phenolith.functions import geo
from phenolith.functions.sun import with_daylight
from phenolith.operators.grouping import geodesic_box, group_extent
from phenolith.schema import STATION_RADIUS_KM, WEATHER_COLUMNS, WEATHER_DAYS, WEATHER_LAG_DAYS
from phenolith.session import by_shuffle, cut_lineage, write_once

# What the readings carry where a measurement is missing.
MISSING_TEMPERATURE = 9999.9
MISSING_PRECIPITATION = 99.99

CELL_DEGREES = 1.0
SENT_STATIONS = 100_000  # rows of about 170 bytes in a broadcast
# Searched before the full radius, each request at the level that fits the density of stations around it: kilometres and cell size in degrees, each level half of
# the one before it, and the stations in reach that make a level dense enough.
LEVELS = tuple((25.0 / 2**k, 0.25 / 2**k) for k in range(9))
ENOUGH_STATIONS, COARSER = 16, 2  # the second: levels by which a request that finds none is searched again


def keyed_stations(stations: DataFrame) -> DataFrame:
    """Stations with the key of their position and their rank among the stations at it."""
    rank = F.row_number().over(Window.partitionBy("station_key").orderBy("usaf", "wban"))
    return stations.withColumn("station_key", X.station_key()).withColumn("station_rank", rank)


def join_weather_stations(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings with the position of their station. Catalyst picks the join by the size it sees, but never sends very many stations through the driver:
    their compressed files can be far below its threshold."""
    keyed = keyed_stations(stations)
    if stations.count() > SENT_STATIONS:
        keyed = by_shuffle(keyed)
    on = (readings["stn"] == keyed["usaf"]) & (readings["wban"] == keyed["wban"])
    return readings.join(keyed, on, "inner").drop(keyed["wban"], keyed["usaf"])


def filter_station_box(joined: DataFrame, south: float, north: float, west: float, east: float,
                       months: list[int] | None = None) -> DataFrame:
    """Readings of stations in a box, optionally of some months."""
    df = joined.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    if months:
        df = df.where(F.col("mo").isin([f"{m:02d}" for m in months]))
    return df


def year_month_plan(df: DataFrame, days_before: int = WEATHER_DAYS + WEATHER_LAG_DAYS) -> DataFrame:
    """Distinct years and months that the windows of the observations touch."""
    span = df.agg(F.date_sub(F.min("obs_date"), days_before).alias("first"), F.max("obs_date").alias("last"))
    months = F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), F.expr("interval 1 month"))
    return span.where(F.col("first").isNotNull()).select(F.explode(months).alias("m")).select(
        F.year("m").alias("year"), F.month("m").alias("month"))


def window_months(df: DataFrame, days_before: int = WEATHER_DAYS + WEATHER_LAG_DAYS) -> DataFrame:
    """Distinct years and months that some window touches: of each distinct date, not of the span from the first to the last."""
    dates = df.select("obs_date").where(F.col("obs_date").isNotNull()).distinct()
    months = F.sequence(F.trunc(F.date_sub("obs_date", days_before), "month"), F.trunc("obs_date", "month"), F.expr("interval 1 month"))
    return dates.select(F.explode(months).alias("m")).distinct().select(F.year("m").alias("year"), F.month("m").alias("month"))


def reachable_stations(stations: DataFrame, observations: DataFrame, radius_km: float = STATION_RADIUS_KM, cell: float = CELL_DEGREES) -> DataFrame:
    """Stations with an observation in a cell that their circle touches; the rest can't be the nearest of any. Only distinct cells of the observations are shuffled."""
    held = observations.select(geo.cell_y("latitude", cell).alias("cell_y"), geo.cell_x("longitude", cell).alias("cell_x")).distinct()
    placed = stations.where("lat is not null and lon is not null").select("*", F.inline(geo.reachable_cells("lat", "lon", radius_km, cell)))
    return placed.join(held, ["cell_y", "cell_x"], "left_semi").select(*stations.columns).distinct()


def station_days(joined: DataFrame, null_sentinels: bool = False, daylight: bool = True) -> DataFrame:
    """One row per station position and day.

    Stations at one position are one station; of several readings for a day the one with the largest
    station number wins. The winner is kept in a hash table of plain numbers, in each task before the shuffle.
    """
    df = joined.withColumn("day", X.reading_date()).where("station_key is not null and day is not null")
    if null_sentinels:
        df = df.where(
            f"temp < {MISSING_TEMPERATURE}D and max < {MISSING_TEMPERATURE}D "
            f"and min < {MISSING_TEMPERATURE}D and prcp < {MISSING_PRECIPITATION}D")
    # Rank first; the hash settles two readings of one station, the same way for every measure.
    df = df.withColumn("_order", F.expr("station_rank * 1099511627776L + shiftrightunsigned(xxhash64(temp, max, min, prcp), 24)"))
    pick = lambda c, name: F.max_by(c, "_order").alias(name)
    unique = df.groupBy("station_key", "day").agg(
        pick("temp", "avg_temp"), pick("max", "max_temp"), pick("min", "min_temp"), pick("prcp", "precipitation"))
    unique = unique.selectExpr(
        "station_key", "day", "cast(element_at(split(station_key, '[|]'), 1) as double) as lat",
        "cast(element_at(split(station_key, '[|]'), 2) as double) as lon",
        "avg_temp", "max_temp", "min_temp", "precipitation")
    return with_daylight(unique) if daylight else unique


def window_completeness(days: DataFrame, length: int = WEATHER_DAYS) -> DataFrame:
    """Days present in the trailing frame that ends at each station day.

    Two growing counts and a difference: each row is counted once, not once per frame it is in.
    """
    n = F.unix_date("day")
    frame = Window.partitionBy("station_key").orderBy(n)
    upto = F.count("*").over(frame.rangeBetween(Window.unboundedPreceding, 0))
    older = F.count("*").over(frame.rangeBetween(Window.unboundedPreceding, -length))
    return days.select("station_key", "day", (upto - older).alias("days_present"))


def gap_free_runs(days: DataFrame, length: int = WEATHER_DAYS) -> DataFrame:
    """Per station the ranges of days on which a complete window may end.

    A run without a gap keeps the difference between day number and rank constant. Runs shorter than
    the window vanish, so a station has at most one row per ``length`` days of its history.
    """
    n = F.unix_date("day")
    rank = F.row_number().over(Window.partitionBy("station_key").orderBy(n))
    runs = days.select("station_key", "day", (n - rank).alias("run")).groupBy("station_key", "run").agg(
        F.min("day").alias("first"), F.max("day").alias("last"))
    return runs.where(F.datediff("last", "first") >= length - 1).select(
        "station_key", F.date_add("first", length - 1).alias("first_end"), F.col("last").alias("last_end"))


def _position(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "*", "cast(element_at(split(station_key, '[|]'), 1) as double) as station_lat",
        "cast(element_at(split(station_key, '[|]'), 2) as double) as station_lon")


def stations_within_radius(points: DataFrame, stations: DataFrame, radius_km: float = STATION_RADIUS_KM,
                           cell: float = CELL_DEGREES, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Pairs of a distinct position and a station within the radius.

    An equi-join on grid cells: the station side is copied into every cell its circle touches, a point has
    one cell, so the large side is never multiplied. The exact distance decides.
    """
    keyed = stations.select(X.station_key().alias("station_key")).where(F.col("station_key").isNotNull()).distinct()
    reach = geo.reachable_cells("station_lat", "station_lon", radius_km, cell)
    cells = _position(keyed).select("station_key", "station_lat", "station_lon", F.inline(reach))
    positions = points.select(lat, lon).distinct().withColumns({
        "cell_y": geo.cell_y(lat, cell), "cell_x": geo.cell_x(lon, cell)})
    km = geo.haversine_km(lat, lon, "station_lat", "station_lon")
    return positions.join(cells, ["cell_y", "cell_x"]).select(
        lat, lon, "station_key", km.alias("km")).where(F.col("km") <= radius_km)


def with_end_day(df: DataFrame) -> DataFrame:
    """The last day of the window: the day before the lagged observation date."""
    return df.withColumn("end_day", F.date_sub("obs_date", WEATHER_LAG_DAYS + 1))


def group_boxes(observations: DataFrame, radius_km: float = STATION_RADIUS_KM) -> DataFrame:
    """Box of each season-region group, extended by the radius."""
    keyed = observations.withColumn("season_region_key", X.season_region_key())
    return geodesic_box(group_extent(keyed, "season_region_key"), radius_km)


def _search_ring(requests: DataFrame, runs: DataFrame, keys: list[str], edges: list[str], ring_km: float, cell: float) -> DataFrame:
    """The nearest complete station within a ring for each request, as struct ``best``."""
    reach = geo.reachable_cells("station_lat", "station_lon", ring_km, cell)
    near = runs.select("station_key", "station_lat", "station_lon", "first_end", "last_end", F.inline(reach)).withColumn(
        "end_month", F.explode(F.sequence(_month("first_end"), _month("last_end"))))
    placed = requests.withColumns({"cell_y": geo.cell_y("latitude", cell), "cell_x": geo.cell_x("longitude", cell)})
    cell_keys = ["cell_y", "cell_x", "end_month"]
    return _nearest(placed.join(by_shuffle(near), cell_keys), keys, edges, F.lit(ring_km))


def _nearest(pairs: DataFrame, keys: list[str], edges: list[str], ring) -> DataFrame:
    pairs = pairs.where("end_day between first_end and last_end")
    if edges:
        pairs = pairs.where("station_lat between box_south and box_north and station_lon between box_west and box_east")
    km = F.round(geo.haversine_km("latitude", "longitude", "station_lat", "station_lon"), 6)
    pairs = pairs.withColumn("km", km).where(F.col("km") <= ring)
    # Grouped by the request alone, so that a cell with very many pairs can be split by the join.
    return pairs.groupBy(*keys).agg(F.min(F.struct("km", "station_key")).alias("best")).select(*keys, "best.*")


def _cells_of(lat: str, lon: str) -> list:
    """Level and cell of a request, one struct per level."""
    return [F.struct(F.lit(k).alias("level"), geo.cell_y(lat, size).alias("cell_y"), geo.cell_x(lon, size).alias("cell_x")) for k, (_, size) in enumerate(LEVELS)]


def _reached_cells(lat: str, lon: str):
    """Level and cell of all that a station's circle of each level touches."""
    tagged = lambda k: lambda c: F.struct(F.lit(k).alias("level"), c["cell_y"].alias("cell_y"), c["cell_x"].alias("cell_x"))
    return F.inline(F.concat(*[F.transform(geo.reachable_cells(lat, lon, km, size), tagged(k)) for k, (km, size) in enumerate(LEVELS)]))


def _fitting_levels(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """For each position the finest level at which enough stations with a complete window are in reach of its cell, else the coarsest."""
    placed = runs.select("station_key", "station_lat", "station_lon").distinct()
    counts = placed.select(_reached_cells("station_lat", "station_lon")).groupBy("level", "cell_y", "cell_x").agg(F.count("*").alias("n"))
    positions = requests.select("latitude", "longitude").distinct().select("latitude", "longitude", F.inline(F.array(*_cells_of("latitude", "longitude"))))
    dense = F.when(F.coalesce(F.col("n") >= ENOUGH_STATIONS, F.lit(False)), F.col("level")).otherwise(F.lit(0))
    return positions.join(by_shuffle(counts), ["level", "cell_y", "cell_x"], "left").groupBy("latitude", "longitude").agg(F.max(dense).alias("level"))


def _search_levels(requests: DataFrame, runs: DataFrame, levels: DataFrame, keys: list[str], edges: list[str], radius_km: float) -> DataFrame:
    """The nearest complete station for requests that have one within the radius of their own level: a few stations each, however dense the place."""
    cell_keys = ["level", "cell_y", "cell_x"]
    cells = write_once(levels.select("latitude", "longitude", F.get(F.array(*_cells_of("latitude", "longitude")), F.col("level")).alias("c")).select("latitude", "longitude", "c.*"), "levels")
    near = runs.select("station_key", "station_lat", "station_lon", "first_end", "last_end", _reached_cells("station_lat", "station_lon"))
    near = near.join(by_shuffle(cells.select(*cell_keys).distinct()), cell_keys, "left_semi")
    near = near.withColumn("end_month", F.explode(F.sequence(_month("first_end"), _month("last_end"))))
    placed = requests.join(by_shuffle(cells), ["latitude", "longitude"])
    ring = F.least(F.lit(LEVELS[0][0]) / F.pow(F.lit(2.0), F.col("level")), F.lit(float(radius_km)))
    return write_once(_nearest(placed.join(by_shuffle(near), [*cell_keys, "end_month"]), keys, edges, ring), "ring")


def _month(day: str):
    return F.year(day) * 12 + F.month(day)


def nearest_complete_station(observations: DataFrame, days: DataFrame, radius_km: float = STATION_RADIUS_KM,
                             length: int = WEATHER_DAYS, cell: float = CELL_DEGREES, prefilter: str | None = None,
                             inner_rings: tuple | None = None) -> DataFrame:
    """For each distinct position and window end the nearest station whose window has no gap.

    The gap-free runs go into the join, keyed by cell and month of the window end: only stations that are
    complete around that time are ever paired. The minimum is taken in the partition that made the
    pairs. Distances count to the millimetre, ties go to the smaller station key.

    A smaller circle is tried first: a station found in it is nearer than any outside, so only requests without one go on to the full radius. How small
    depends on the place: the finest of nine levels, each of half the radius of the one before it, at which a few stations are in reach. In a place with very many
    stations and observations most of their pairs are never formed. ``inner_rings``, pairs of a radius and a cell size,
    are tried one after the other instead if they are given; the result does not depend on either.

    ``prefilter='group_box'`` also asks that the station lies in the box of the season-region group, which
    loses stations of wide groups.
    """
    keys = ["latitude", "longitude", "end_day"]
    requests = with_end_day(observations)
    if prefilter == "group_box":
        keys = keys + ["season_region_key"]
        requests = requests.withColumn("season_region_key", X.season_region_key())
    elif prefilter is not None:
        raise ValueError(f"unknown prefilter {prefilter}")
    requests = requests.select(*keys).distinct()
    edges = []
    if prefilter:
        edges = ["box_north", "box_south", "box_east", "box_west"]
        # One row per group, computed once for all rings.
        boxes = cut_lineage(group_boxes(observations, radius_km).select("season_region_key", *edges))
        requests = requests.join(boxes, "season_region_key")
    # Written once: every level and ring reads the requests, and observations can cost more to derive than to read.
    requests = write_once(requests.withColumn("end_month", _month("end_day")), "requests")
    # One row per run: small, and every ring reads it. Months keep the key of a place with very many stations from being one task's work.
    runs = write_once(_position(gap_free_runs(days, length)), "runs")

    found = None
    if inner_rings is None:
        levels = write_once(_fitting_levels(requests, runs), "levels")
        coarser = levels.where("level > 0").withColumn("level", F.greatest(F.col("level") - COARSER, F.lit(0)))
        for some in (levels, coarser):
            best = _search_levels(requests, runs, some, keys, edges, radius_km)
            requests = requests.join(by_shuffle(best.select(*keys)), keys, "left_anti")
            found = best if found is None else found.unionByName(best)
        inner_rings = ()
    for ring_km, ring_cell in [*((r, c) for r, c in inner_rings if r < radius_km), (radius_km, cell)]:
        best = write_once(_search_ring(requests, runs, keys, edges, ring_km, ring_cell), "ring")  # also the last: the matches and the wanted blocks both read it
        found = best if found is None else found.unionByName(best)
        if ring_km < radius_km:
            requests = requests.join(by_shuffle(best.select(*keys)), keys, "left_anti")
    return found.select(*keys, "station_key", "km")


def match_stations(observations: DataFrame, days: DataFrame, how: str = "inner", best: DataFrame | None = None, **options) -> DataFrame:
    """Observations with the chosen station, its distance and the last day of the window. ``best``: the chosen stations, if they were searched before."""
    if best is None:
        best = nearest_complete_station(observations, days, **options)
    left = with_end_day(observations)
    keys = ["latitude", "longitude", "end_day"]
    if options.get("prefilter"):
        keys = keys + ["season_region_key"]
        left = left.withColumn("season_region_key", X.season_region_key())
    return left.join(by_shuffle(best), keys, how)


def unmatched_observations(observations: DataFrame, days: DataFrame, **options) -> DataFrame:
    """Observations for which no station within the radius has a complete window."""
    return match_stations(observations, days, how="left_anti", **options)


def weather_blocks(days: DataFrame, length: int = WEATHER_DAYS, wanted: DataFrame | None = None) -> DataFrame:
    """Arrays of readings per station and block of ``length`` days, each with the block before it.

    Every window lies in the block of its last day, so one equi-join fetches it. A block holds at most
    ``2 * length`` days.
    """
    block = F.floor(F.unix_date("day") / length).cast("int")
    twice = days.select(
        "station_key", F.unix_date("day").alias("n"), *WEATHER_COLUMNS,
        F.explode(F.array(block, block + 1)).alias("block"))
    if wanted is not None:
        twice = twice.join(by_shuffle(wanted), ["station_key", "block"], "left_semi")  # by the keys that they are grouped by next
    rows = F.sort_array(F.collect_list(F.struct("n", *WEATHER_COLUMNS)))
    blocks = twice.groupBy("station_key", "block").agg(rows.alias("rows"))
    return blocks.select("station_key", "block", F.col("rows.n").alias("ns"),
                         *[F.col(f"rows.{c}").alias(f"_{c}") for c in WEATHER_COLUMNS])


def attach_windows(matched: DataFrame, days: DataFrame, length: int = WEATHER_DAYS, how: str = "inner", best: DataFrame | None = None) -> DataFrame:
    """Add the readings of the window, oldest first, as one array per measure. Only blocks that a window lies in are put together.

    With ``how='left'`` rows without a station stay and have null arrays. ``best``: the stations and window ends that ``matched`` was made
    with; else the matches are computed a second time for their blocks.
    """
    block = F.floor(F.unix_date("end_day") / length).cast("int").alias("block")
    wanted = (matched if best is None else best).select("station_key", block).distinct()
    joined = matched.select("*", block).join(by_shuffle(weather_blocks(days, length, wanted)), ["station_key", "block"], how)
    start = F.array_position("ns", F.unix_date("end_day") - (length - 1)).cast("int")
    joined = joined.withColumn("_start", start)
    return joined.select(
        *matched.columns,
        *[F.slice(f"_{c}", F.col("_start"), F.lit(length)).alias(c) for c in WEATHER_COLUMNS])


def nearest_complete_window(observations: DataFrame, days: DataFrame, **options) -> DataFrame:
    """Observations with the 120-day history of the nearest complete station; others are dropped."""
    best = nearest_complete_station(observations, days, **options)
    return attach_windows(match_stations(observations, days, best=best, **options), days, options.get("length", WEATHER_DAYS), best=best)


def usable_daylight(enriched: DataFrame) -> DataFrame:
    """Rows whose every day has a length above 0; the others belong to the rejects.

    Membership is null, hence no, when a day has no length.
    """
    return enriched.where("not coalesce(array_contains(daylight, 0L), true)")
