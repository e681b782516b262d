"""Cleaning of wide metadata: column plans are made from names on the driver, values stay on the executors.

A rule that depends on a column's content (fill rate, share of numbers) is decided from one aggregated profile row.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from meadow.schema import NULL_TOKENS

# Standard columns and the names that mean the same.
TARGET_SCHEMA = {
    "ph": ["ph", "ph_level", "soil_ph", "water_ph", "ph_sensor"],
    "temperature": ["temp", "temperature_c", "temp_c", "water_temp", "soil_temp", "air_temp"],
    "env_type": ["environment", "sample_type", "water_body", "biome"],
    "salinity": ["sal", "salinity_ppt", "salinity_psu", "salt_concentration", "conductivity"],
    "depth": ["depth", "depth_m", "sampling_depth", "water_depth", "altitude_m"],
    "oxygen": ["do", "dissolved_oxygen", "o2_concentration", "oxygen_saturation"],
    "host_age": ["age", "host_age", "subject_age", "age_years"],
    "host_sex": ["sex", "gender", "host_sex"],
}


def name_ratio(a: str, b: str) -> float:
    """0..100 similarity of two names: twice the longest common subsequence over the summed lengths."""
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], (prev + 1 if x == y else max(row[j + 1], row[j]))
    return 200.0 * row[-1] / max(1, len(a) + len(b))


def fill_rates(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Share of non-null values per column: one aggregate, one row to the driver."""
    if not cols:
        return {}
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in cols]).first()
    return {c: (row[c] / row["_n"] if row["_n"] else 0.0) for c in cols}


def harmonize(df: DataFrame, core: list[str] = (), threshold: float = 85, min_fill: float = 0.01,
              schema: dict[str, list[str]] = TARGET_SCHEMA) -> DataFrame:
    """Fold alias or similarly named columns to one standard column, first non-null wins; keep other filled columns."""
    used, out = set(), []
    for std, aliases in schema.items():
        hits = [c for c in df.columns if c.lower().strip() in aliases or name_ratio(c.lower().strip(), std) >= threshold]
        if hits:
            used.update(hits)
            out.append((std, F.coalesce(*[F.col(f"`{c}`").cast("string") for c in hits])))
    rest = [c for c in df.columns if c not in used and c not in core]
    fill = fill_rates(df, rest)
    keep = [c for c in rest if fill[c] > min_fill]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in core], *[e.alias(n) for n, e in out],
                     *[F.col(f"`{c}`") for c in keep])


def drop_columns(df: DataFrame, unwanted: list[str]) -> DataFrame:
    """Without configured columns and without repeats of a name (case kept, first wins)."""
    names, keep = set(), []
    for i, c in enumerate(df.columns):
        if c not in unwanted and c not in names:
            keep.append(i)
            names.add(c)
    tmp = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return tmp.select(*[F.col(f"_{i}").alias(df.columns[i]) for i in keep])


# Columns that may hold the sample id, in order.
ID_COLUMNS = ["#sampleid", "sample_id", "sample id", "sample name", "run_accession"]


def clean_sample_ids(df: DataFrame, order: str, id_col: str = "#sampleid") -> DataFrame:
    """Lower-cased, trimmed, non-empty ids; of equal ids the first row in `order` stays.

    min_by is a partial aggregate, so a very common id is merged before the shuffle.
    """
    src = next(c for c in [id_col, *ID_COLUMNS] if c in df.columns)
    rest = [c for c in df.columns if c != src]
    t = df.withColumn("_id", F.lower(F.trim(F.col(f"`{src}`").cast("string")))).filter("_id <> ''")
    best = t.groupBy("_id").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(order)).alias("_r"))
    return best.select(F.col("_id").alias(id_col), "_r.*")


def number(col: Column) -> Column:
    return F.trim(col.cast("string")).try_cast("double")


def force_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: number(F.col(c)) for c in cols})


def numeric_losses(df: DataFrame, cols: list[str]) -> DataFrame:
    """column, lost: values that are not numbers."""
    lost = df.agg(*[F.count_if(F.col(c).isNotNull() & number(F.col(c)).isNull()).alias(c) for c in cols])
    return lost.unpivot([], cols, "column", "lost")


def map_values(df: DataFrame, maps: dict[str, dict[str, str]]) -> DataFrame:
    """Lower-case and trim, then replace by a value map; unmapped values stay."""
    out = {}
    for c, m in maps.items():
        v = F.lower(F.trim(F.col(c).cast("string")))
        lit = F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
        out[c] = F.coalesce(F.try_element_at(lit, v), v)
    return df.withColumns(out)


# Spellings of a target gene.
TARGET_GENES = {
    "16S": ["16S", "16S rRNA", "16S rRNA gene", "16s", "16s rrna"],
    "18S": ["18S", "18S rRNA", "18s"],
    "ITS": ["ITS", "ITS1", "ITS2", "its"],
}


def target_gene(col: Column) -> Column:
    """Canonical gene name; null spellings to null; other values trimmed."""
    v = F.trim(col)
    named = F.coalesce(*[F.when(v.isin(names), gene) for gene, names in TARGET_GENES.items()], v)
    return F.when(col.isNull() | col.isin("", "nan", "None", "NA"), F.lit(None)).otherwise(named)


# Habitats to leave out.
DROPPED_HABITATS = ["animal distal gut", "animal corpus", "animal secretion"]


def drop_habitats(df: DataFrame, col: str = "empo_3") -> DataFrame:
    return df.filter(~F.coalesce(F.lower(F.col(col)).isin(DROPPED_HABITATS), F.lit(False)))


# Unit suffixes of column names, unit conversions, standard units.
UNIT_SUFFIXES = {
    "celsius": r"_(celsius|cel|c)$", "fahrenheit": r"_(fahrenheit|far|f)$", "kelvin": r"_(kelvin|k)$",
    "meters": r"_(meters|meter|m)$", "feet": r"_(feet|ft)$",
}
STANDARD_UNITS = {"temp": "celsius", "depth": "meters", "altitude": "meters"}
CONVERSIONS = {
    ("fahrenheit", "celsius"): lambda x: (x - 32) * 5 / 9,
    ("kelvin", "celsius"): lambda x: x - 273.15,
    ("feet", "meters"): lambda x: x * 0.3048,
}


def standardize_units(df: DataFrame) -> DataFrame:
    """Two or more columns of one measurement become <measurement>_<unit>; the last listed value wins."""
    groups: dict[str, list] = {}
    for c in df.columns:
        for unit, pat in UNIT_SUFFIXES.items():
            m = re.search(pat, c, re.IGNORECASE)
            if m and m.start():
                base = c[: m.start()]
                groups.setdefault(next((k for k in STANDARD_UNITS if k in base), base), []).append((c, unit))
                break
    for base, cols in groups.items():
        goal = STANDARD_UNITS.get(base)
        if len(cols) < 2 or not goal:
            continue
        values = []
        for c, unit in cols:
            x = number(F.col(c))
            if unit == goal:
                values.append(x)
            elif (unit, goal) in CONVERSIONS:
                values.append(CONVERSIONS[unit, goal](x))
        merged = F.coalesce(*reversed(values))
        df = df.withColumn("_merged", merged).drop(*[c for c, _ in cols]).withColumnRenamed("_merged", f"{base}_{goal}")
    return df


def collapse_suffixes(df: DataFrame, suffix: str) -> DataFrame:
    """x<suffix> fills x, or becomes x where there is none."""
    for c in [c for c in df.columns if c.endswith(suffix) and len(c) > len(suffix)]:
        base = c[: -len(suffix)]
        if base in df.columns:
            df = df.withColumn(base, F.coalesce(base, c)).drop(c)
        else:
            df = df.withColumnRenamed(c, base)
    return df


def merge_ph(df: DataFrame) -> DataFrame:
    """First numeric value of the pH-like columns, in column order with `ph` first."""
    cols = [c for c in df.columns if re.match(r"^ph[^a-zA-Z]|^ph$", c) and "std" not in c]
    if len(cols) < 2:
        return df
    cols = sorted(cols, key=lambda c: c != "ph")
    return df.withColumn("_ph", F.coalesce(*[number(F.col(f"`{c}`")) for c in cols])).drop(*cols).withColumnRenamed("_ph", "ph")


# Accepted date layouts and the precision each gives.
DATE_LAYOUTS = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd", "day"), (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd", "day"),
    (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy", "day"), (r"^\d{2}-\d{2}-\d{4}$", "MM-dd-yyyy", "day"),
    (r"^\d{4}-\d{2}$", "yyyy-MM", "month"), (r"^\d{4}/\d{2}$", "yyyy/MM", "month"), (r"^\d{4}$", "yyyy", "year"),
]
_PRECISION_FORMAT = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


# Month names.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def _named_month(s: Column) -> Column:
    """Timestamp of day, month name, year in either order, or of month name and year; full or three-letter names."""
    def month(name: Column) -> Column:
        n = F.lower(name)
        return F.coalesce(*[F.when(n.isin(m, m[:3]), F.lit(i)) for i, m in enumerate(MONTHS, 1)])

    def made(pattern: str, day: int | None, name: int, year: int) -> Column:
        part = lambda i: F.regexp_extract(s, pattern, i)
        text = F.concat_ws("-", part(year), month(part(name)), part(day) if day else F.lit("1"))
        return F.when(s.rlike(pattern) & month(part(name)).isNotNull(), F.try_to_timestamp(text, F.lit("yyyy-M-d")))

    return F.coalesce(made(r"^(\d{1,2})[- /]([A-Za-z]{3,9})[- /,]+(\d{4})$", 1, 2, 3),
                      made(r"^([A-Za-z]{3,9})[- ](\d{1,2}),? (\d{4})$", 2, 1, 3), made(r"^([A-Za-z]{3,9})[- /](\d{4})$", None, 1, 2))


def date_of(col: Column) -> Column:
    """Timestamp of a date text in one of the accepted layouts, of an ISO date-time (with or without seconds, fractions and
    zone; the date and time as written), or with a month name; null when not a date."""
    s = F.trim(col)
    tries = [F.when(s.rlike(p), F.try_to_timestamp(s, F.lit(f))) for p, f, _ in DATE_LAYOUTS]
    clock = F.replace(s, F.lit("T"), F.lit(" "))
    zone = r"(\.\d+)?\s*(Z|[+-]\d{2}:?\d{2})?$"
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}" + zone), F.try_to_timestamp(F.substring(clock, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")))
    short = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}\s*(Z|[+-]\d{2}:?\d{2})?$"), F.try_to_timestamp(F.substring(clock, 1, 16), F.lit("yyyy-MM-dd HH:mm")))
    return F.coalesce(*tries, iso, short, _named_month(s))


def standardize_dates(df: DataFrame, cols: list[str] | None = None, min_parsed: float = 0.1) -> DataFrame:
    """Date-like text columns to yyyy-MM-dd when at least min_parsed of their values are dates; other values stay as they are."""
    marks = ("date", "time", "temporal", "year", "month", "day")
    types = dict(df.dtypes)
    cols = cols or [c for c in df.columns if any(m in c.lower() for m in marks)]
    stamped = [c for c in cols if types[c] in ("timestamp", "date", "timestamp_ntz")]
    text = [c for c in cols if types[c] == "string"]
    out = {c: F.date_format(c, "yyyy-MM-dd") for c in stamped}
    if text:
        row = df.agg(*[F.count(c).alias(f"n_{c}") for c in text],
                     *[F.count(date_of(F.col(c))).alias(f"p_{c}") for c in text]).first()
        for c in text:
            if row[f"p_{c}"] > 0 and row[f"p_{c}"] >= row[f"n_{c}"] * min_parsed:
                out[c] = F.coalesce(F.date_format(date_of(F.col(c)), "yyyy-MM-dd"), F.col(c))
    return df.withColumns(out) if out else df


def parse_date_precision(col: Column) -> tuple[Column, Column]:
    """(ISO text at its own precision, day / month / year / unknown)."""
    s = F.trim(col)
    parsed = [(F.when(s.rlike(p), F.try_to_timestamp(s, F.lit(f))), prec) for p, f, prec in DATE_LAYOUTS]
    value = F.coalesce(*[F.date_format(ts, _PRECISION_FORMAT[prec]) for ts, prec in parsed])
    kind = F.coalesce(*[F.when(ts.isNotNull(), prec) for ts, prec in parsed], F.lit("unknown"))
    return value, kind


# Columns that may hold coordinates, in order.
LAT_COLUMNS = ["lat_study", "lat_ena", "lat.1", "lat", "biosample_geographic_location_(latitude)", "biosample_latitude",
               "experiment_lat", "run_lat", "latitude"]
LON_COLUMNS = ["lon_study", "lon.1", "lon", "biosample_geographic_location_(longitude)", "biosample_longitude",
               "experiment_lon", "run_lon", "longitude"]
PAIR_COLUMNS = ["location_ena", "location_start", "location_end", "location_start_study", "location_end_study", "lat_lon",
                "location", "biosample_lat_lon", "biosample_latitude_and_longitude", "run_location", "run_location_start",
                "run_location_end", "experiment_location", "experiment_location_start", "experiment_location_end"]
# Shapes of a coordinate pair.
DIRECTED = r"(?i)([\d.-]+(?:[eE][-+]?\d+)?)\s*([NS])\s*([\d.-]+(?:[eE][-+]?\d+)?)\s*([EW])"
PLAIN_PAIR = (r"([-+]?[1-8]?\d(?:\.\d+)?|[-+]?90(?:\.0+)?),\s*"
              r"([-+]?180(?:\.0+)?|[-+]?(?:1[0-7]\d|[1-9]?\d)(?:\.\d+)?)")
DMS = r"(?i)(\d{1,3})\s*°\s*(?:([\d.]+)\s*['′]\s*)?(?:([\d.]+)\s*[\"″]\s*)?([NSEW])"


def coordinate_pair(s: Column) -> Column:
    """struct(lat, lon) of a text: `12.3 N 45.6 W`, then `lat, lon`, then degrees-minutes-seconds; null when none fits."""
    ex = lambda p, g: F.regexp_extract(s, p, g)
    sign = lambda letter, neg: F.when(F.upper(letter) == neg, -1.0).otherwise(1.0)
    pair = lambda y, x: F.struct(y.alias("lat"), x.alias("lon"))
    directed = pair(ex(DIRECTED, 1).try_cast("double") * sign(ex(DIRECTED, 2), "S"),
                    ex(DIRECTED, 3).try_cast("double") * sign(ex(DIRECTED, 4), "W"))
    plain = pair(ex(PLAIN_PAIR, 1).try_cast("double"), ex(PLAIN_PAIR, 2).try_cast("double"))
    found = F.regexp_extract_all(s, F.lit(DMS), F.lit(0))

    def angle(text):
        at = lambda k: F.coalesce(F.regexp_extract(text, DMS, k).try_cast("double"), F.lit(0.0))
        v = at(1) + at(2) / 60 + at(3) / 3600
        return F.when(F.upper(text).rlike("[SW]"), -v).otherwise(v)

    angles = F.transform(F.when(s.contains("°"), found), angle)
    dms = F.transform(F.filter(F.array(angles), lambda a: F.size(a) >= 2), lambda a: pair(F.get(a, F.lit(0)), F.get(a, F.lit(1))))
    good = F.filter(F.array(directed, plain), lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())
    return F.get(F.concat(good, dms), F.lit(0))


def extract_coordinates(df: DataFrame) -> DataFrame:
    """lat / lon from the first numeric columns, else from the first pair column that parses; invalid rows dropped."""
    col = lambda c: F.col(f"`{c}`")
    first = lambda names: F.coalesce(*[number(col(c)) for c in names if c in df.columns], F.lit(None).cast("double"))
    numeric = F.struct(first(LAT_COLUMNS).alias("lat"), first(LON_COLUMNS).alias("lon"))
    whole = F.filter(F.array(numeric), lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())
    pairs = [coordinate_pair(col(c).cast("string")) for c in PAIR_COLUMNS if c in df.columns]
    out = df.withColumn("_at", F.coalesce(F.get(whole, F.lit(0)), *pairs))
    return (out.withColumns({"lat": F.col("_at.lat"), "lon": F.col("_at.lon")}).drop("_at")
            .filter("lat between -90 and 90 and lon between -180 and 180"))


def clamp_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon") -> tuple[DataFrame, DataFrame]:
    """(all rows with clipped coordinates, the rows that were clipped with both values)."""
    y, x = number(F.col(lat)), number(F.col(lon))
    clip = lambda v, m: F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(-m)), F.lit(m)))
    cy, cx = clip(y, 90.0), clip(x, 180.0)
    bad = df.filter((y != cy) | (x != cx)).withColumns(
        {"original_lat": y, "original_lon": x, "clamped_lat": cy, "clamped_lon": cx})
    return df.withColumns({lat: cy, lon: cx}), bad


# Environment terms and the words that mean them, in order.
ONTOLOGY = {
    "empo_1": {
        "Host-associated": ["host", "symbiont", "microbiome", "human", "animal"],
        "Free-living": ["free living", "environmental", "soil", "water", "sediment", "air"],
    },
    "empo_2": {
        "Animal": ["animal", "human", "insect", "mammal", "gut", "feces", "skin"],
        "Plant": ["plant", "rhizosphere", "root", "leaf", "flower"],
        "Fungus": ["fungus", "fungal"],
        "Aquatic": ["aquatic", "water", "marine", "freshwater", "sediment", "ocean"],
        "Terrestrial": ["terrestrial", "soil", "land", "desert", "forest"],
    },
    "empo_3": {
        "Gut": ["gut", "feces", "fecal", "intestinal"],
        "Soil": ["soil", "rhizosphere", "terrestrial"],
        "Water": ["water", "aquatic", "marine", "freshwater"],
        "Sediment": ["sediment"],
        "Skin": ["skin"],
    },
    "env_biome": {
        "Urban": ["urban", "city"],
        "Agricultural": ["agricultural", "farm", "crop"],
        "Forest": ["forest"],
        "Grassland": ["grassland", "savanna"],
        "Aquatic": ["aquatic", "marine", "freshwater", "lake", "river", "ocean"],
    },
    "env_feature": {"Anthropogenic": ["anthropogenic", "human-made", "built environment"], "Natural": ["natural", "wild"]},
    "env_material": {
        "Soil": ["soil", "loam", "clay", "silt"], "Water": ["water"], "Sediment": ["sediment", "mud"], "Air": ["air"],
    },
}


def infer_terms(df: DataFrame, text: Column, ontology: dict[str, dict[str, list[str]]] = ONTOLOGY) -> DataFrame:
    """One column per category: the first term with a word inside the text, else Unknown.

    The lower-cased text is made once per row in its own projection; each word is one `contains` in generated code.
    """
    low = df.withColumn("_low", F.lower(text))
    hit = lambda words: reduce(lambda x, y: x | y, [F.col("_low").contains(w) for w in words])
    cols = {c: F.coalesce(*[F.when(hit(words), term) for term, words in terms.items()], F.lit("Unknown")) for c, terms in ontology.items()}
    return low.withColumns(cols).drop("_low")


# Parts of names whose columns stay text.
PROTECTED = [
    "accession", "alias", "id", "name", "sra", "project", "study", "experiment", "run", "sample", "submission", "ftp", "url",
    "link", "md5", "date", "created", "updated", "time", "tax_lineage", "refs", "publication", "citation", "description",
    "first_public", "location", "target_gene", "pcr_primer", "primer", "mapping_file", "lcms_position", "store_cond",
    "earthquake", "ena",
]


def clean_numeric_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """A text column becomes numeric when > 90 % of its values are numbers, or > 85 % are after dropping commas and
    trailing units; protected names stay."""
    cols = [c for c in cols if not any(t in c.lower() for t in PROTECTED)]
    if not cols:
        return df
    v = {c: F.trim(F.col(c)) for c in cols}
    known = {c: F.col(c).isNotNull() & ~v[c].isin(NULL_TOKENS) & (F.lower(v[c]) != "nan") for c in cols}
    plain = {c: F.when(known[c], v[c].try_cast("double")) for c in cols}
    lead = {c: F.regexp_extract(F.replace(v[c], F.lit(","), F.lit("")), r"^(-?\d+\.?\d*)", 1).try_cast("double") for c in cols}
    row = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count_if(known[c]).alias(f"n{i}"), F.count(plain[c]).alias(f"p{i}"), F.count(lead[c]).alias(f"l{i}"))]).first()
    out = {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        if n and row[f"p{i}"] / n > 0.90:
            out[c] = plain[c]
        elif n and row[f"l{i}"] / n > 0.85:
            out[c] = lead[c]
    return df.withColumns(out) if out else df


# Suffixes and prefixes that mark copies of one column, in order.
VARIANT_SUFFIXES = ["_sample", "_study", "_ena", "_facility"]
VARIANT_PREFIXES = ["run_", "experiment_", "biosample_", "study_"]


def coalesce_variants(df: DataFrame, bases: list[str], min_fill: float = 0.001) -> DataFrame:
    """x, x_sample, x_study, x_ena, x_facility become x; nearly empty columns go."""
    for b in bases:
        found = [c for c in [b, *[b + s for s in VARIANT_SUFFIXES]] if c in df.columns]
        if found:
            df = df.withColumn("_v", F.coalesce(*found)).drop(*found).withColumnRenamed("_v", b)
    fill = fill_rates(df, df.columns)
    return df.select(*[c for c in df.columns if fill[c] >= min_fill])


def coalesce_prefixes(df: DataFrame) -> DataFrame:
    """run_x, experiment_x, biosample_x, study_x become x where two or more exist (accessions stay)."""
    bases = sorted({c[len(p):] for c in df.columns for p in VARIANT_PREFIXES if c.startswith(p)} - {"accession"})
    for b in bases:
        found = [p + b for p in VARIANT_PREFIXES if p + b in df.columns]
        if len(found) > 1:
            df = df.withColumn("_v", F.coalesce(*found)).drop(*found, b).withColumnRenamed("_v", b)
    return df


def unpack_nested(col: Column) -> Column:
    """Text of a list or dictionary -> value: [] to null, one item to the item, {'value': v} to v, else unchanged."""
    def one(s):
        s = F.trim(s)
        arr = F.from_json(F.when(s.rlike(r"^\[.*\]$"), s), "array<string>")
        obj = F.from_json(F.when(s.rlike(r"^\{.*\}$"), s), "map<string,string>")
        return (F.when(arr.isNotNull(), F.when(F.size(arr) == 0, F.lit(None)).when(F.size(arr) == 1, F.get(arr, F.lit(0)))
                       .otherwise(s))
                .when(obj.isNotNull() & F.map_contains_key(obj, "value"), F.try_element_at(obj, F.lit("value")))
                .otherwise(s))
    return one(one(col))


def aggregate_runs(df: DataFrame, key: str, order: str, list_cols: list[str], mean_cols: list[str]) -> DataFrame:
    """One row per run: sorted distinct list for list columns, mean for environment numbers, first non-null in order
    otherwise. All three are partial aggregates."""
    rest = [c for c in df.columns if c not in (key, order, *list_cols, *mean_cols)]
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest]
    return df.groupBy(key).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in list_cols],
                               *[F.avg(c).alias(c) for c in mean_cols], *first)


def suggest_value_merges(df: DataFrame, cols: list[str], threshold: float = 0.9) -> DataFrame:
    """column, value, target: similar lower-cased values map to the most frequent one.

    Two values within e edits share, if the shorter is cut into e + 1 even pieces, one piece at a place that is at most e off.
    So values meet by (column, length, piece, its text); any number of values per column is compared without a cap.
    """
    long = df.select([F.lower(F.trim(F.col(c).cast("string"))).alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = long.filter("value is not null and value <> ''").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("len", F.length("value"))
    slack = 1 - threshold
    most = lambda n: F.floor(n / threshold * slack + 1e-9).cast("int")  # edits from a value of length n to a longer one
    cut = lambda n, i: F.floor(n * i / (most(n) + 1)).cast("int")
    piece = F.explode(F.sequence(F.lit(0), most(F.col("len")))).alias("i")
    short = counts.select("*", piece).withColumn("lo", cut(F.col("len"), F.col("i")))
    short = short.select("column", F.col("len").alias("m"), "i", F.expr("substring(value, lo + 1)").alias("_rest"), "value", "n",
                         (cut(F.col("len"), F.col("i") + 1) - F.col("lo")).alias("_w"))
    short = short.select("column", "m", "i", F.expr("left(_rest, _w)").alias("piece"), F.col("value").alias("s"), F.col("n").alias("ns"))
    reach = F.explode(F.sequence(F.greatest(F.lit(1), F.ceil(F.col("len") * threshold - 1e-9).cast("int")), F.col("len"))).alias("m")
    wide = counts.select("*", reach).select("*", F.explode(F.sequence(F.lit(0), most(F.col("m")))).alias("i"))
    wide = wide.select("*", F.explode(F.sequence(-most(F.col("m")), most(F.col("m")))).alias("off")).withColumn("lo", cut(F.col("m"), F.col("i")) + F.col("off"))
    wide = wide.withColumn("_w", cut(F.col("m"), F.col("i") + 1) - cut(F.col("m"), F.col("i"))).filter("lo >= 0 and lo + _w <= len")
    wide = wide.select("column", "m", "i", F.expr("substring(value, lo + 1, _w)").alias("piece"), F.col("value").alias("t"), F.col("n").alias("nt"))
    met = short.join(wide, ["column", "m", "i", "piece"]).filter("s <> t").select("column", "s", "ns", "t", "nt").distinct()
    longer = F.greatest(F.length("s"), F.length("t"))
    near = met.filter(1 - F.levenshtein("s", "t") / longer >= threshold)
    up = (F.col("nt") > F.col("ns")) | ((F.col("nt") == F.col("ns")) & (F.col("t") < F.col("s")))
    moves = near.select("column", F.when(up, F.col("s")).otherwise(F.col("t")).alias("value"), F.when(up, F.col("t")).otherwise(F.col("s")).alias("target"),
                        F.greatest("ns", "nt").alias("m"))
    return moves.groupBy("column", "value").agg(F.min_by("target", F.struct(-F.col("m"), F.col("target"))).alias("target"))


# Accession shapes in the order they are tried.
ACCESSIONS = [
    ("SAMEA", r"^SAMEA\d{7,}$"), ("SAMN", r"^SAMN\d{7,}$"), ("SRP", r"^SRP\d{6,}$"), ("SRX", r"^SRX\d{6,}$"),
    ("SRR", r"^SRR\d{6,}$"), ("SRS", r"^SRS\d{6,}$"), ("PRJNA", r"^PRJNA\d+$"), ("PRJEB", r"^PRJEB\d+$"),
    ("ERS", r"^ERS\d{6,}$"), ("DRR", r"^DRR\d{6,}$"), ("DRS", r"^DRS\d{6,}$"), ("ERR", r"^ERR\d{6,}$"),
    ("COMPOUND", r"^(SRR|ERR|DRR|SRX)\d{6,}\.(SRS|ERS|DRS|SAMEA|SAMN)\d{6,}$"),
]
# Prefixes that give a type with less confidence.
ACCESSION_PREFIXES = ["SAMEA", "SAMN", "SRP", "SRX", "SRR", "SRS", "ERS", "ERR", "DRS", "DRR"]


def classify_accession(col: Column) -> tuple[Column, Column]:
    """(type, confidence): 1.0 for a full match, 0.7 for the prefix, else 0."""
    s = F.upper(F.trim(col))
    full = F.coalesce(*[F.when(s.rlike(p), t) for t, p in ACCESSIONS])
    part = F.coalesce(*[F.when(s.startswith(t), t) for t in ACCESSION_PREFIXES])
    return F.coalesce(full, part), F.when(full.isNotNull(), 1.0).when(part.isNotNull(), 0.7).otherwise(0.0)


def record_type(run: Column, experiment: Column) -> Column:
    """run / experiment / biosample from the accession prefixes."""
    return (F.when(F.upper(run).rlike("^(SRR|ERR|DRR)"), "run")
            .when(F.upper(experiment).rlike("^(SRX|ERX|DRX)"), "experiment").otherwise("biosample"))


# Truthy spellings.
TRUTHY = ["true", "yes", "1", "contaminated"]


def flags_and_defaults(df: DataFrame, flag: str, accessions: list[str], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Truthy text to boolean, missing accession to N/A, rows at (0, 0) dropped."""
    f = F.coalesce(F.lower(F.col(flag).cast("string")).isin(TRUTHY), F.lit(False)) if flag in df.columns else F.lit(False)
    cols = {flag: f}
    for a in accessions:
        cols[a] = F.coalesce(F.col(a), F.lit("N/A")) if a in df.columns else F.lit("N/A")
    return df.withColumns(cols).filter(~((F.col(lat) == 0) & (F.col(lon) == 0)))


# Facility types and the patterns that name them, in order; then defaults by source.
FACILITY_TYPES = [
    ("Nuclear Power Plant", "pressuri[sz]ed|PWR|boiling|BWR|candu|heavy|PHWR|reactor|npp|power plant|generating station"),
    ("Uranium Mine", "uranium.*mine|open.*pit|in-situ|isr|deposit|prospect|project"),
    ("Uranium Mill", "mill"), ("Salt Mine", "salt"), ("Potash Mine", "potash"),
    ("Fertilizer Plant", "fertilizer|nitrate|ammonia"), ("Acid Plant", "acid|sulfuric"), ("Coal Power Plant", "coal"),
    ("Gold Mine", "gold"), ("Copper Mine", "copper"), ("Smelter", "aluminium|smelter"),
    ("Desalination Plant", "desalination"), ("Geothermal Plant", "geothermal"),
    ("Waste Storage", "storage|repository|disposal"), ("Superfund Site", "superfund"),
]
SOURCE_TYPES = {"MINDAT": "Uranium Mine", "WNA": "Nuclear Power Plant", "PRIS": "Nuclear Power Plant"}


def standard_facility_type(kind: Column, name: Column, source: Column) -> Column:
    """Patterns on the type, then on the name, then the source's default, then the type itself or Unknown."""
    scan = lambda c: [F.when(c.rlike(f"(?i){p}"), t) for t, p in FACILITY_TYPES]
    by_source = [F.when(F.upper(source) == s, t) for s, t in SOURCE_TYPES.items()]
    own = F.when((kind != "") & (F.lower(kind) != "nan"), kind)
    return F.coalesce(*scan(kind), *scan(name), *by_source, own, F.lit("Unknown"))


def day_length(lat: Column, day: Column) -> Column:
    """Hours of daylight at a latitude on a date."""
    tilt = F.radians(F.lit(23.44) * F.cos((F.dayofyear(day) - 172) * F.lit(2 * 3.141592653589793) / 365))
    m = F.least(F.greatest(1 - F.tan(F.radians(lat)) * F.tan(tilt), F.lit(0.0)), F.lit(2.0))
    return F.lit(24.0) * (1 - F.acos(1 - m) / F.lit(3.141592653589793))


def season(lat: Column, day: Column) -> Column:
    """Season by day of year, the southern half shifted by half a year."""
    doy = F.dayofyear(day).cast("double")
    d = F.when(lat < 0, (doy + 182.5) % 365).otherwise(doy)
    return (F.when(day.isNull(), "Unknown").when(d.between(80, 171.999), "Spring").when((d >= 172) & (d < 264), "Summer")
            .when((d >= 264) & (d < 355), "Autumn").otherwise("Winter"))


def _clip(c: Column) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def _row_mean(cols: list[Column]) -> Column:
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    return F.try_divide(total, sum((c.isNotNull().cast("int") for c in cols), F.lit(0)))


def proxy_columns(df: DataFrame) -> DataFrame:
    """Weighted, clipped combinations of environment columns; each needs its inputs to exist.

    Global maxima and the one standard deviation come from one aggregated row, joined as a one-row broadcast.
    """
    have = set(df.columns)
    maxed = [c for c in ["vegetation_ndvi_seasonal", "carbon_npp_gC_m2_year", "gbif_species_richness_100km",
                         "human_settlement_density_per_km2", "soil_carbon_stock_total"] if c in have]
    human = [c for c in df.columns if c.startswith("human_")]
    stats = [F.max(c).alias(f"_max_{c}") for c in dict.fromkeys(maxed + human)]
    if "bioclim_annual_mean_temp" in have:
        stats.append(F.stddev("bioclim_annual_mean_temp").alias("_sd_temp"))
    if stats:
        df = df.crossJoin(F.broadcast(df.agg(*stats)))
    c, mx = F.col, lambda n: F.col(f"_max_{n}")
    moist = lambda: (c("soil_moisture_anomaly_pct") + 100) / 200
    new: dict[str, Column] = {}

    def add(name, needs, make):
        if all(n in have for n in needs):
            new[name] = make()

    temp, ndvi, npp = "weather_temp_c", "vegetation_ndvi_seasonal", "carbon_npp_gC_m2_year"
    rain, agb, soc_stock = "bioclim_annual_precip", "carbon_agb_mg_ha", "soil_carbon_stock_total"
    tseas, pseas, soc, anom = "bioclim_temp_seasonality", "bioclim_precip_seasonality", "soil_grids_soc_pct", "soil_moisture_anomaly_pct"
    farm, clay = "human_agricultural_fraction", "soil_grids_clay_pct"
    inside = lambda n, lo, hi: ((c(n) > lo) & (c(n) < hi)).cast("double")
    add("proxy_drought_stress_index", ["drought_severity_index", "olm_aridity_index"],
        lambda: c("drought_severity_index") * 0.6 + c("olm_aridity_index") * 0.4)
    add("proxy_water_stress_composite", ["water_stress_proxy", anom],
        lambda: _clip(c("water_stress_proxy") * 0.5 + (1 - moist()) * 0.5))
    add("proxy_temperature_stress", [temp, "bioclim_annual_mean_temp"],
        lambda: F.abs(c(temp) - c("bioclim_annual_mean_temp")) / (c("_sd_temp") + 0.1))
    stress = list(new.values()) + [c(n) for n in df.columns if "proxy_" in n and "stress" in n]
    if stress:
        new["proxy_overall_climate_stress"] = _row_mean(stress)
    add("proxy_vegetation_productivity_index", [ndvi, npp], lambda: (c(ndvi) / mx(ndvi) + c(npp) / (mx(npp) + 1)) / 2)
    add("proxy_growing_season_suitability", [temp, rain, ndvi],
        lambda: inside(temp, 5, 30) * 0.3 + inside(rain, 100, 5000) * 0.3 + c(ndvi) * 0.4)
    add("proxy_climate_variability", [tseas, pseas], lambda: c(tseas) / 650 * 0.5 + c(pseas) / 100 * 0.5)
    add("proxy_total_carbon_pool", [agb, soc_stock], lambda: c(agb) + c(soc_stock))
    add("proxy_carbon_cycling_intensity", [npp, soc_stock, agb], lambda: c(npp) / (c(soc_stock) + c(agb) + 1))
    add("proxy_decomposition_potential", [temp, anom, soc],
        lambda: _clip(c(temp) / 25) * 0.4 + _clip(moist()) * 0.3 + _clip(c(soc) / 10) * 0.3)
    rich = "gbif_species_richness_100km"
    add("proxy_biodiversity_potential", [rich, ndvi, rain],
        lambda: c(rich) / mx(rich) * 0.4 + c(ndvi) * 0.3 + _clip(1 - F.abs(c(rain) - 1500) / 1500) * 0.3)
    add("proxy_endemism_conservation_priority", ["gbif_endemism_index", "human_urban_area_fraction"],
        lambda: c("gbif_endemism_index") * (1 - c("human_urban_area_fraction")))
    dens, night = "human_settlement_density_per_km2", "human_nightlights_intensity"
    add("proxy_habitat_fragmentation_risk", [dens, farm, night],
        lambda: _clip(c(dens) / (mx(dens) + 1) * 0.4 + c(farm) * 0.4 + c(night) / 100 * 0.2))
    if len(human) > 2:
        new["proxy_human_impact_intensity"] = _row_mean([c(h) / F.when(mx(h) > 0, mx(h)).otherwise(1) for h in human])
    add("proxy_air_pollution_risk", ["atm_pm25_ugm3", "atm_no2_ppb"],
        lambda: _clip((c("atm_pm25_ugm3") / 50 + c("atm_no2_ppb") / 40) / 2))
    add("proxy_agricultural_intensity_risk", [farm, soc], lambda: c(farm) * _clip(1 - c(soc) / 10))
    add("proxy_climate_stability", [tseas, pseas], lambda: 1 - (_clip(c(tseas) / 650) * 0.5 + _clip(c(pseas) / 100) * 0.5))
    add("proxy_disturbance_recovery_potential", [npp, soc_stock],
        lambda: c(npp) / (mx(npp) + 1) * 0.6 + c(soc_stock) / (mx(soc_stock) + 1) * 0.4)
    if stress:
        overall = new["proxy_overall_climate_stress"]
        new["proxy_ecosystem_resilience_score"] = _clip(1 - _row_mean([*stress, overall]))
    add("proxy_soil_fertility_index", ["soil_grids_ph", "soil_grids_cec", soc],
        lambda: _clip(1 - F.abs(c("soil_grids_ph") - 6.5) / 7) * 0.3 + _clip(c("soil_grids_cec") / 30) * 0.35 + _clip(c(soc) / 5) * 0.35)
    add("proxy_soil_structure_quality", [clay, soc, "chemical_weathering_index"],
        lambda: _clip(1 - F.abs(c(clay) - 25) / 25) * 0.4 + _clip(c(soc) / 5) * 0.3 + c("chemical_weathering_index") * 0.3)
    add("proxy_soil_water_retention", [clay, soc, anom],
        lambda: _clip(c(clay) / 100) * 0.4 + _clip(c(soc) / 10) * 0.3 + _clip(moist()) * 0.3)
    return df.withColumns(new).drop(*[n for n in df.columns if n.startswith(("_max_", "_sd_"))])


# Metals, their soil indicators and weights.
METAL_INDICATORS = {
    "uranium": {"clay_content": 0.40, "acidic_ph": 0.25, "low_organic_carbon": 0.20, "high_cec": 0.15},
    "arsenic": {"clay_content": 0.30, "acidic_ph": 0.20, "moderate_organic_carbon": 0.30, "high_cec": 0.20},
    "copper": {"clay_content": 0.35, "neutral_to_alkaline_ph": 0.25, "high_organic_carbon": 0.25, "high_cec": 0.15},
    "lead": {"clay_content": 0.35, "neutral_to_alkaline_ph": 0.20, "high_organic_carbon": 0.30, "high_cec": 0.15},
    "zinc": {"clay_content": 0.30, "neutral_to_alkaline_ph": 0.25, "high_organic_carbon": 0.30, "high_cec": 0.15},
    "cadmium": {"acidic_ph": 0.35, "high_organic_carbon": 0.30, "low_cec": 0.20, "sandy_loam": 0.15},
    "nickel": {"clay_content": 0.30, "moderate_ph": 0.25, "low_organic_carbon": 0.25, "neutral_ph": 0.20},
    "rare_earth": {"clay_content": 0.40, "acidic_ph": 0.30, "high_organic_carbon": 0.20, "high_cec": 0.10},
}
# Value used for a missing soil property.
SOIL_DEFAULTS = {"clay": 30.0, "phh2o": 6.5, "soc": 50.0, "cec": 150.0, "sand": 40.0}
# Score steps (upper limit, score) of an indicator over a soil property, then the score above the last limit.
INDICATOR_STEPS = {
    "clay_content": ("clay", [(10, 0.3), (25, 0.6), (40, 0.9)], 0.8),
    "acidic_ph": ("phh2o", [(4.5, 0.8), (6.5, 0.9), (7.5, 0.6)], 0.3),
    "neutral_to_alkaline_ph": ("phh2o", [(6.5, 0.4), (7.5, 0.95), (8.5, 0.8)], 0.5),
    "moderate_ph": ("phh2o", [(6, 0.6), (7.5, 0.95), (8, 0.7)], 0.4),
    "high_organic_carbon": ("soc", [(30, 0.3), (60, 0.6), (100, 0.9)], 0.95),
    "moderate_organic_carbon": ("soc", [(40, 0.5), (100, 0.95)], 0.7),
    "low_organic_carbon": ("soc", [(30, 0.95), (60, 0.7)], 0.3),
    "high_cec": ("cec", [(80, 0.3), (150, 0.6), (250, 0.9)], 0.95),
    "low_cec": ("cec", [(80, 0.95), (150, 0.6)], 0.2),
}


def _indicator(name: str, soil: dict[str, Column]) -> Column:
    if name == "neutral_ph":
        return F.greatest(F.lit(0.0), 1 - F.abs(soil["phh2o"] - 7.0) / 3)
    if name == "sandy_loam":
        sand = soil["sand"]
        return F.when(sand.between(50, 70), 0.9).when(sand.between(40, 80), 0.7).otherwise(0.4)
    prop, steps, top = INDICATOR_STEPS[name]
    out = None
    for limit, score in steps:
        hit = soil[prop] < limit
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out.otherwise(top)


def element_proxy(df: DataFrame, metals: list[str] | None = None) -> DataFrame:
    """<metal>_elem: weighted mean of the metal's soil indicator scores, 0..1."""
    soil = {k: F.coalesce(F.col(k).cast("double"), F.lit(v)) if k in df.columns else F.lit(v) for k, v in SOIL_DEFAULTS.items()}
    cols = {}
    for metal in metals or METAL_INDICATORS:
        parts = METAL_INDICATORS[metal]
        score = sum((_indicator(i, soil) * w for i, w in parts.items()), F.lit(0.0)) / sum(parts.values())
        cols[f"{metal}_elem"] = _clip(score)
    return df.withColumns(cols)


def combine_proxies(geo: DataFrame, elem: DataFrame, metals: list[str], key: str = "sample_id", geo_weight: float = 0.4,
                    elem_weight: float = 0.6) -> DataFrame:
    """<metal>_proxy = 0.4 geology + 0.6 element, a missing score counts as 0.5."""
    j = geo.join(elem, key, "full")
    pick = lambda c: F.coalesce(F.col(c), F.lit(0.5)) if c in j.columns else F.lit(0.5)
    return j.select(key, *[(pick(f"{m}_geo") * geo_weight + pick(f"{m}_elem") * elem_weight).alias(f"{m}_proxy") for m in metals])


# Metals of broad rock types and of named formations, with their scores.
ROCK_METALS = {
    "ultramafic": {"nickel": 0.85, "chromium": 0.80, "cobalt": 0.70, "iron": 0.95},
    "mafic": {"iron": 0.90, "chromium": 0.60, "cobalt": 0.65, "nickel": 0.60},
    "granitic": {"uranium": 0.65, "thorium": 0.70, "rare_earth_elements": 0.50, "tungsten": 0.55},
    "sulfide_rich": {"copper": 0.80, "zinc": 0.80, "iron": 0.95, "arsenic": 0.75, "lead": 0.70},
    "hydrothermal": {"copper": 0.75, "uranium": 0.70, "gold": 0.65, "arsenic": 0.60, "zinc": 0.70},
}
FORMATION_METALS = {
    "uraninite": {"uranium": 0.95, "thorium": 0.85, "vanadium": 0.70},
    "carnotite": {"uranium": 0.90, "vanadium": 0.80},
    "pitchblende": {"uranium": 0.92, "radium": 0.75, "bismuth": 0.60},
    "arsenofeldspars": {"arsenic": 0.88, "gold": 0.65, "copper": 0.70},
    "marcasite_pyrite": {"arsenic": 0.75, "copper": 0.80, "zinc": 0.70, "iron": 0.95},
    "chalcopyrite": {"copper": 0.92, "iron": 0.85, "molybdenum": 0.70, "gold": 0.55},
    "bornite_chalcocite": {"copper": 0.85, "iron": 0.70, "manganese": 0.60},
    "sphalerite_galena": {"zinc": 0.92, "lead": 0.90, "cadmium": 0.70, "silver": 0.65},
    "magnetite_hematite": {"iron": 1.0, "chromium": 0.65, "vanadium": 0.60},
    "pentlandite": {"nickel": 0.95, "cobalt": 0.85, "iron": 0.90, "copper": 0.60},
    "laterite": {"nickel": 0.92, "cobalt": 0.70, "iron": 0.95, "manganese": 0.75},
    "bastnasite": {"rare_earth_elements": 0.90, "thorium": 0.70, "uranium": 0.50},
}
UNKNOWN_METAL = 0.3


def _metal_table(spark, table: dict[str, dict[str, float]], key: str, score: str) -> DataFrame:
    return spark.createDataFrame([(k, m, v) for k, row in table.items() for m, v in row.items()], f"{key} string, metal string, {score} double")


def geology_metals(df: DataFrame, rock: str = "rock_type", formation: str = "formation", key: str = "sample_id") -> DataFrame:
    """key, metal, score: metals of a sample's rock type and formation, names in any case; where both name a metal the formation
    decides. A sample whose names are in neither table has the metal `unknown` at 0.3. Two joins with fixed tables."""
    spark = df.sparkSession
    named = df.select(key, F.lower(rock).alias("_rock"), F.lower(formation).alias("_formation"))
    rocks = named.join(F.broadcast(_metal_table(spark, ROCK_METALS, "_rock", "r")), "_rock").select(key, "metal", "r", F.lit(None).cast("double").alias("f"))
    forms = named.join(F.broadcast(_metal_table(spark, FORMATION_METALS, "_formation", "f")), "_formation").select(key, "metal", F.lit(None).cast("double").alias("r"), "f")
    none = named.filter(~F.coalesce(F.col("_rock").isin(*ROCK_METALS), F.lit(False)) & ~F.coalesce(F.col("_formation").isin(*FORMATION_METALS), F.lit(False)))
    found = rocks.unionByName(forms).groupBy(key, "metal").agg(F.coalesce(F.max("f"), F.max("r")).alias("score")).filter("score > 0")
    return found.unionByName(none.select(key, F.lit("unknown").alias("metal"), F.lit(UNKNOWN_METAL).alias("score")))


# Metals that take the mineral index where nothing else scores them, and the scores where no measure is there.
INDEX_METALS = ["zinc", "nickel", "cadmium"]
NEUTRAL_METALS = {"uranium": 0.5, "arsenic": 0.5, "copper": 0.5, "lead": 0.5, "zinc": 0.5, "nickel": 0.5, "cadmium": 0.5}


def surface_metals(df: DataFrame, key: str = "sample_id") -> DataFrame:
    """key and <metal>_geo, 0..1, from rock_type, slope_percent, clay_percent, iron_oxide_percent, aluminum_oxide_percent,
    organic_carbon_percent and metal_mineral_index; a null or zero measure gives no score, an absent column counts as null.
    A row that has no score at all takes the neutral ones."""
    have = lambda c: F.nullif(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(None).cast("double")
    clay, iron, alum, carbon = (have(f"{c}_percent") for c in ("clay", "iron_oxide", "aluminum_oxide", "organic_carbon"))
    rock = F.col("rock_type") if "rock_type" in df.columns else F.lit(None).cast("string")
    steep = F.when(have("slope_percent") > 10, 0.1).otherwise(0.0)
    one = lambda c: F.when(c.isNotNull(), F.least(c, F.lit(1.0)))
    scores = {
        "uranium": one(F.when(rock == "igneous", 0.5 + clay / 100 * 0.3 + steep)),
        "arsenic": one(0.3 + iron * 0.5),
        "copper": one(0.4 + clay / 100 * 0.3 + F.coalesce(alum * 0.2, F.lit(0.0))),
        "lead": one(0.5 + carbon / 20 * 0.3),
        **{m: have("metal_mineral_index") for m in INDEX_METALS},
    }
    nothing = F.coalesce(*scores.values()).isNull()
    return df.select(key, *[F.when(nothing, NEUTRAL_METALS[m]).otherwise(c).alias(f"{m}_geo") for m, c in scores.items()])


# Host names and sample kinds that are left out, and the columns searched.
HOST_NAMES = ["homo sapiens", "mus musculus", "rattus norvegicus", "metazoa", "neotoma"]
EXCLUDED_KINDS = ["gut metagenome", "plant metagenome", "pig metagenome", "fecal metagenome", "bat metagenome",
                  "algae metagenome", "insect"]
TITLE_COLUMNS = ["experiment_title", "study_study_title", "study_study_abstract", "sample_description",
                 "experiment_design_description"]
HOST_COLUMNS = ["biosample_scientific_name", "sample_scientific_name", "sample_host"]
KIND_COLUMNS = ["sample_scientific_name", "biosample_scientific_name", "sample_description", "study_study_title"]


def filter_amplicon_runs(df: DataFrame, amplicon: bool = True) -> DataFrame:
    """AMPLICON strategy, 16S in any title-like column, no host name, no excluded kind."""
    has = lambda cols, pat: F.coalesce(*[F.when(F.col(c).rlike(f"(?i){pat}"), True) for c in cols], F.lit(False))
    present = lambda cols: [c for c in cols if c in df.columns]
    keep = F.lit(True)
    if amplicon and "experiment_library_strategy" in df.columns:
        keep &= F.coalesce(F.upper("experiment_library_strategy") == "AMPLICON", F.lit(False))
    if present(TITLE_COLUMNS):
        keep &= has(present(TITLE_COLUMNS), "16S")
    if present(HOST_COLUMNS):
        keep &= ~has(present(HOST_COLUMNS)[:1], "|".join(HOST_NAMES))
    if present(KIND_COLUMNS):
        keep &= ~has(present(KIND_COLUMNS), "|".join(EXCLUDED_KINDS))
    return df.filter(keep)
