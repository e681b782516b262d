"""Joins by distance on the globe.

Points are put in cells of a cubic grid over the unit sphere (x, y, z), so there is no seam at the 180th meridian and no
crowding at the poles. Two points closer than the cell side always lie in the same or in adjacent cells, so a distance
join is an equi join on the cell with an exact haversine filter. Coordinates are made distinct before the join: a place
that holds a third of all samples is joined once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from meadow.operators.kernels import small
from meadow.sources.tables import cut_lineage, forget, written

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.sin(dlat / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon / 2) ** 2
    return 2 * radius * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def _axes(lat: Column, lon: Column) -> list[Column]:
    y, x = F.radians(lat), F.radians(lon)
    return [F.cos(y) * F.cos(x), F.cos(y) * F.sin(x), F.sin(y)]


def chord(km: float) -> float:
    """Straight distance through the unit sphere of an arc of km, a hair wider so that rounding never loses a pair."""
    return 2 * math.sin(min(math.pi, km / EARTH_KM) / 2) * 1.000001 + 1e-12


def cell_of(lat: Column, lon: Column, side: float) -> Column:
    return F.struct(*[F.floor(a / side).cast("int").alias(n) for n, a in zip("xyz", _axes(lat, lon))])


def near_cells(lat: Column, lon: Column, side: float, reach: int = 1) -> Column:
    """The cell of a point and its neighbours."""
    return around(cell_of(lat, lon, side), reach)


def around(c: Column, reach: int = 1) -> Column:
    """A cell and its neighbours. Given as a column of the table, the cell is worked out once and not for each neighbour."""
    steps = [F.lit(i) for i in range(-reach, reach + 1)]
    shift = lambda dx, dy, dz: F.struct((c["x"] + dx).alias("x"), (c["y"] + dy).alias("y"), (c["z"] + dz).alias("z"))
    return F.flatten(F.flatten(F.transform(F.array(*steps), lambda dx: F.transform(
        F.array(*steps), lambda dy: F.transform(F.array(*steps), lambda dz: shift(dx, dy, dz))))))


def _shuffled(df: DataFrame) -> DataFrame:
    """df as a side that is sorted and merged: the planner takes points spread to their cells for as few as the table they came
    from, and would send them all through the driver."""
    return df.hint("merge")


CROWDED = 4096  # points of the left side in a cell up to which the cell is one task's
TASK_PAIRS = 1_000_000  # pairs of points to compare, about, that one task meets
MOST_TASKS = 20_000


def close_points(left: DataFrame, right: DataFrame, km: float) -> DataFrame:
    """Distinct coordinate pairs within km: lat, lon, lat2, lon2, km. The right side is spread to neighbour cells.

    A cell with many points or many pairs is dealt by hash into parts, and the right side's points near it go to each of them, so
    that no task holds a dense place alone. The number of tasks follows the pairs to compare, not the few points read."""
    side = chord(km)
    a = left.select("lat", "lon").filter("lat is not null and lon is not null").distinct()
    b = right.select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2")).filter("lat2 is not null and lon2 is not null").distinct()
    a = cut_lineage(a.withColumn("_c", cell_of(F.col("lat"), F.col("lon"), side)))
    b = cut_lineage(b).withColumn("_c", F.explode(near_cells(F.col("lat2"), F.col("lon2"), side)))
    count = lambda df, n: df.groupBy("_c").agg(F.count(F.lit(1)).alias(n))
    cells = count(a, "_n").join(_shuffled(count(b, "_m")), "_c")
    parts = F.greatest(F.ceil(F.col("_n") / CROWDED), F.least(F.col("_n"), F.ceil(F.col("_n") * F.col("_m") / TASK_PAIRS)))
    cells = cut_lineage(cells.select("_c", parts.cast("int").alias("_parts"), (F.col("_n") * F.col("_m")).alias("_pairs")))
    pairs = cells.agg(F.coalesce(F.sum("_pairs"), F.lit(0))).first()[0]
    crowded = small(cells.filter("_parts > 1").select("_c", "_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    a = a.join(crowded, "_c", "left").withColumn("_p", F.pmod(F.xxhash64("lat", "lon"), parts).cast("int")).drop("_parts")
    b = b.join(crowded, "_c", "left").withColumn("_p", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    tasks = min(MOST_TASKS, -(-pairs // TASK_PAIRS))
    if tasks > 1:
        a, b = a.repartition(tasks, "_c", "_p"), b.repartition(tasks, "_c", "_p")
    d = haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return a.join(_shuffled(b), ["_c", "_p"]).withColumn("km", d).filter(F.col("km") <= km).drop("_c", "_p")


def samples_within_radius(samples: DataFrame, points: DataFrame, km: float, sample_id: str = "sample_id",
                          point_id: str = "point_id") -> DataFrame:
    """point_id, sample_id, km for every sample within km of each point."""
    near = close_points(samples, points, km)
    s = samples.select(sample_id, "lat", "lon")
    p = points.select(point_id, F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return near.join(p, ["lat2", "lon2"]).join(s, ["lat", "lon"]).select(point_id, sample_id, "km")


# Cell sides of the nearest-neighbour search; the last one covers the whole sphere.
_RINGS = [0.02, 0.08, 0.32, 1.28, 2.1]


def nearest(samples: DataFrame, places: DataFrame, place_id: str) -> DataFrame:
    """lat, lon, place (smallest id among the nearest), km for every distinct sample coordinate. Exact.

    Each round looks one grid wider, and only at the coordinates that are still open: a hit closer than the cell side
    cannot be beaten from outside the neighbour cells. Places are few per cell in early rounds, and late rounds have
    few open coordinates.
    """
    spot = places.filter("lat is not null and lon is not null").groupBy(
        F.col("lat").alias("lat2"), F.col("lon").alias("lon2")).agg(F.min(place_id).alias("place"))
    todo = samples.select("lat", "lon").filter("lat is not null and lon is not null").distinct()
    done = None
    for side in _RINGS:
        right = spot.withColumn("_c", F.explode(near_cells(F.col("lat2"), F.col("lon2"), side)))
        left = todo.withColumn("_c", cell_of(F.col("lat"), F.col("lon"), side))
        d = haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
        best = (left.join(_shuffled(right), "_c").withColumn("km", d).groupBy("lat", "lon")
                .agg(F.min_by("place", F.struct("km", "place")).alias("place"), F.min("km").alias("km")))
        if side < 2:
            best = best.filter(F.col("km") <= EARTH_KM * 2 * math.asin(side / 2))
            best = cut_lineage(best)
            todo = cut_lineage(todo.join(best, ["lat", "lon"], "left_anti"))
        done = best if done is None else done.unionByName(best)
        if side < 2 and todo.isEmpty():
            break
    return done


def nearest_facility(samples: DataFrame, facilities: DataFrame, max_km: float, sample_id: str = "sample_id") -> DataFrame:
    """Nearest facility of each sample with coordinates (latitude 0 counts as missing), and match flags."""
    ok = samples.filter("lat is not null and lon is not null and lat <> 0")
    near = nearest(ok, facilities, "facility_id")
    f = facilities.select(F.col("facility_id").alias("place"), "facility", "is_nuclear")
    j = ok.select(sample_id, "lat", "lon").join(near, ["lat", "lon"]).join(f, "place")
    hit = F.col("km") <= max_km
    return j.select(sample_id, F.col("km").alias("facility_distance_km"), hit.alias("industry_match"),
                    (hit & F.col("is_nuclear")).alias("facility_match"), (hit & ~F.col("is_nuclear")).alias("analog_match"),
                    F.when(hit, F.col("facility")).alias("facility_name"))


# Distance views and the facilities they cover.
VIEWS = {
    "dist_nuclear_km": None, "dist_analog_km": None, "dist_salts_km": "Salt|Potash", "dist_nitrates_km": "Fertilizer|Acid",
    "dist_metals_km": "Gold|Copper|Smelter|Rare", "dist_uranium_km": "Uranium",
    "dist_thermal_km": "Coal|Geothermal|Desalination|Smelter", "dist_desalination_km": "Desalination",
}


def nearest_by_view(samples: DataFrame, facilities: DataFrame, views: list[str] | None = None,
                    sample_id: str = "sample_id") -> DataFrame:
    """Distance to the nearest facility of each view: one search per view over distinct coordinates."""
    out = samples.select(sample_id, "lat", "lon").filter("lat is not null and lon is not null")
    for view in views or VIEWS:
        keep = (F.col("is_nuclear") if view == "dist_nuclear_km" else ~F.col("is_nuclear") if view == "dist_analog_km"
                else F.coalesce(F.col("facility_type_standard").rlike(f"(?i){VIEWS[view]}"), F.lit(False)))
        near = nearest(out, facilities.filter(keep), "facility_id").select("lat", "lon", F.col("km").alias(view))
        out = out.join(near, ["lat", "lon"], "left")
    return out.drop("lat", "lon")


# Prefixes of a usable accession.
USABLE = "^(SRR|ERR|DRR|SRS|SAMN|SAME|SAMD|SRX|ERX|DRX)"


def borrow_from_nearby(samples: DataFrame, archive: DataFrame, km: float, fields: list[str], accession: str = "accession") -> DataFrame:
    """Samples without an accession take the empty fields from the best archive sample within km.

    Best = 1000 x (3 with a date + 2 with a location) - km - 10 with a host; the smallest id breaks a tie.
    archive: archive_id, lat, lon, collection_date, location, host and the fields.
    """
    no_acc = ~F.coalesce(F.upper(F.trim(F.col(accession))).rlike(USABLE), F.lit(False))
    need = samples.filter(no_acc).select("sample_id", "lat", "lon")
    near = close_points(need, archive, km)
    known = lambda c: F.col(c).isNotNull().cast("int")
    score = (known("collection_date") * 3 + known("location") * 2) * 1000 - F.col("km") - known("host") * 10
    # All rows of a place are equally far, so the best of them is found before the place is joined.
    given = (known("collection_date") * 3 + known("location") * 2) * 1000 - known("host") * 10
    a = (archive.withColumn("g", given).groupBy(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
         .agg(F.min_by(F.struct("archive_id", "collection_date", "location", "host", F.struct(*fields).alias("f")), F.struct(-F.col("g"), F.col("archive_id"))).alias("a"))
         .select("lat2", "lon2", "a.*"))
    spot = (near.join(a, ["lat2", "lon2"]).withColumn("score", score).groupBy("lat", "lon")
            .agg(F.min_by(F.struct("archive_id", "f"), F.struct(-F.col("score"), F.col("archive_id"))).alias("best")))
    best = need.join(spot, ["lat", "lon"]).select("sample_id", "best")
    j = samples.join(best, "sample_id", "left")
    fill = [F.when(F.col(f).isNull(), F.col(f"best.f.{f}")).alias(f"{f}_nearby_inferred") for f in fields]
    return j.select(*samples.columns, F.col("best.archive_id").alias("donor"), *fill)


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node id) of undirected edges(src, dst).

    Each round gives a node, and the node that its label names, the smallest label among its neighbours, and then follows the
    label's own label: whole trees are hooked to smaller ones, so chains and wide grids close in a logarithmic number of rounds.
    State is written every round and the one before it is deleted; only a change count reaches the driver.
    """
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    both = written(both.filter("src <> dst"))
    lab = written(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("node")).alias("component")))
    while True:
        step = (both.join(_shuffled(lab.select(F.col("node").alias("dst"), "component")), "dst").groupBy(F.col("src").alias("node"))
                .agg(F.min("component").alias("c")))
        near = lab.join(_shuffled(step), "node")
        own = near.select("node", F.least("component", "c").alias("c"), F.col("component").alias("old"))
        hook = near.filter("c < component").select(F.col("component").alias("node"), "c", F.lit(None).cast(lab.schema["component"].dataType).alias("old"))
        near = written(own.unionByName(hook).groupBy("node").agg(F.min("c").alias("component"), F.max("old").alias("old")))
        jump = near.select(F.col("node").alias("component"), F.col("component").alias("far"))
        new = written(near.join(_shuffled(jump), "component", "left").select("node", F.coalesce("far", "component").alias("component"), "old"))
        settled = new.filter("component <> old").isEmpty()
        for done in (lab, near):
            forget(done)
        lab = new.drop("old")
        lab._written_at = new._written_at
        if settled:
            forget(both)
            break
    return lab


def near_groups(points: DataFrame, km: float) -> DataFrame:
    """lat, lon, group for distinct coordinates; coordinates are in one group when a chain of steps <= km joins them.

    Points in one fine cell (diagonal <= km) are linked without comparing them; only fine-cell pairs within reach are
    compared, and a cell pair needs one close point pair.
    """
    side = chord(km) / math.sqrt(3) * 0.999
    p = points.select("lat", "lon").filter("lat is not null and lon is not null").distinct()
    p = p.withColumn("c", cell_of(F.col("lat"), F.col("lon"), side))
    near = F.explode(around(F.col("c"), 2))
    q = p.select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.col("c").alias("c2"), near.alias("c"))
    d = haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    key = lambda c: F.concat_ws(",", f"{c}.x", f"{c}.y", f"{c}.z")
    edges = (p.join(_shuffled(q), "c").filter(key("c") < key("c2")).filter(d <= km)
             .select(key("c").alias("src"), key("c2").alias("dst")).distinct())
    comp = connected_components(edges)
    named = p.withColumn("node", key("c")).join(_shuffled(comp), "node", "left")
    return named.select("lat", "lon", F.coalesce("component", "node").alias("group"))


# Order of facility sources, best first.
SOURCE_ORDER = {"NFCIS": 1, "NRC": 2, "JRC": 3, "WNA": 4, "DNFSB": 5, "GEM": 6, "WIKIDATA": 7, "MINDAT": 8, "WIKIDATA_ANALOG": 9}


def dedup_facilities(facilities: DataFrame, km: float = 2.0, priority: Column | None = None) -> DataFrame:
    """One row per group of facilities within km: the best source first, its gaps filled from the rest, sources listed.

    Every filled column is a min_by over (priority, id), which merges before the shuffle.
    """
    rank = priority if priority is not None else F.coalesce(*[
        F.when(F.upper("data_source") == s, i) for s, i in SOURCE_ORDER.items()], F.lit(99))
    f = facilities.withColumn("_rank", F.struct(rank.alias("r"), F.col("facility_id").alias("i")))
    placed = f.join(_shuffled(near_groups(facilities, km)), ["lat", "lon"])
    rest = [c for c in facilities.columns if c not in ("lat", "lon")]
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c)
    out = placed.groupBy("group").agg(*[first(c) for c in rest], first("lat"), first("lon"),
                                      F.concat_ws(",", F.array_sort(F.collect_set("data_source"))).alias("merged_sources")).drop("group")
    loose = facilities.filter("lat is null or lon is null").withColumn("merged_sources", F.lit(None).cast("string"))
    return out.unionByName(loose)


def dedup_coordinates(points: DataFrame, tolerance_m: float = 100.0) -> DataFrame:
    """Adds cluster_lat, cluster_lon: the smallest (lat, lon) of the tolerance cell, independent of row order."""
    deg = tolerance_m / 111_320.0
    shrink = F.greatest(F.cos(F.radians("lat")), F.lit(1e-6))
    band = F.floor(F.col("lat") / deg)
    col_deg = deg / F.greatest(F.cos(F.radians((band + 0.5) * deg)), F.lit(1e-6))
    p = points.withColumns({"_a": band, "_b": F.floor(F.col("lon") / col_deg)})
    rep = p.filter("_a is not null and _b is not null").groupBy("_a", "_b").agg(F.min(F.struct("lat", "lon")).alias("_r"))
    return (p.join(rep, ["_a", "_b"], "left").withColumns({"cluster_lat": F.col("_r.lat"), "cluster_lon": F.col("_r.lon")})
            .drop("_a", "_b", "_r"))


def expand_results(clustered: DataFrame, results: DataFrame) -> DataFrame:
    """Results per cluster point back on every point."""
    return clustered.join(results, ["cluster_lat", "cluster_lon"], "left")


# Boxes (lat_min, lat_max, lon_min, lon_max) in order, and their metal contents in ppm.
METALS = ["ni", "mo", "v", "co", "zn", "cu", "pb", "as", "cd", "cr", "fe", "mn", "al"]
REGIONS = [
    ("north_america", (30, 50, -130, -60), [60, 1.5, 65, 18, 55, 45, 14, 8, 0.2, 120, 35000, 700, 82000]),
    ("europe", (35, 72, -10, 45), [70, 1.8, 70, 20, 60, 50, 16, 10, 0.3, 130, 38000, 750, 85000]),
    ("south_america", (-56, 12, -82, -35), [55, 1.2, 60, 16, 50, 40, 12, 6, 0.18, 110, 32000, 650, 80000]),
    ("africa", (-35, 37, -17, 52), [65, 1.4, 68, 19, 58, 48, 15, 9, 0.25, 125, 36000, 720, 83000]),
    ("asia", (5, 75, 45, 150), [75, 2.0, 75, 22, 65, 55, 18, 12, 0.35, 140, 40000, 800, 88000]),
    ("oceania", (-47, -10, 112, 180), [85, 2.2, 80, 25, 70, 60, 20, 14, 0.4, 150, 42000, 850, 90000]),
    ("ocean", (-90, 90, -180, 180), [50, 1.0, 50, 14, 40, 30, 10, 5, 0.15, 100, 30000, 600, 75000]),
]


def region_lookup(points: DataFrame, metals: list[str] = METALS) -> DataFrame:
    """region and <metal>_ppm: the last small box (latitude span under 90) that holds the point, else the first box that
    does; contents varied by the place's position inside its degree. The box table is seven fixed rows."""
    inside = lambda b: F.col("lat").between(b[0], b[1]) & F.col("lon").between(b[2], b[3])
    small = [r for r in REGIONS if r[1][1] - r[1][0] < 90]
    wide = [r for r in REGIONS if r[1][1] - r[1][0] >= 90]
    region = F.coalesce(*[F.when(inside(b), n) for n, b, _ in [*reversed(small), *wide]])
    frac = lambda c: F.pmod(F.col(c), F.lit(1.0))
    offset = (frac("lat") + frac("lon")) * 0.1
    factor = 1 + (offset - 0.05) + 0.15 * (offset * 2 - 1)
    base = lambda m: F.coalesce(*[F.when(F.col("region") == n, float(v[METALS.index(m)])) for n, _, v in REGIONS])
    return points.withColumn("region", region).withColumns({f"{m}_ppm": F.greatest(F.lit(0.1), base(m) * factor) for m in metals})


def uncovered_points(points: DataFrame, searches: DataFrame, share: float = 0.9) -> DataFrame:
    """Distinct query coordinates that no earlier search (lat, lon, radius_km) covers within share of its radius."""
    todo = points.select("lat", "lon").filter("lat is not null and lon is not null").distinct()
    top = searches.agg(F.max("radius_km")).first()[0]
    if top is None:
        return todo
    side = chord(top)
    s = searches.groupBy(F.col("lat").alias("lat2"), F.col("lon").alias("lon2")).agg(F.max("radius_km").alias("radius_km"))
    s = s.withColumn("_c", F.explode(near_cells(F.col("lat2"), F.col("lon2"), side)))
    p = todo.withColumn("_c", cell_of(F.col("lat"), F.col("lon"), side))
    d = haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return p.join(s, [p["_c"] == s["_c"], d < share * F.col("radius_km")], "left_anti").select("lat", "lon")
