"""Readers: typed CSV, schedule feeds, GeoJSON lines, road inventories, OSM elements, base maps, station counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T


def typed(raw: DataFrame, schema: T.StructType, *others: Column) -> DataFrame:
    """Text columns as the schema's: trimmed, by lower-case name; '' and what cannot be cast, or is not finite, is null."""
    have = {c.strip().lower(): c for c in raw.columns}

    def value(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType)
        cell = F.nullif(F.trim(F.col(f"`{have[field.name]}`")), F.lit(""))
        cast = cell.try_cast(field.dataType)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            cast = F.when(F.isnan(cast) | (F.abs(cast) == float("inf")), None).otherwise(cast)
        return cast

    return raw.select(*others, *[value(f).alias(f.name) for f in schema])


def _csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.csv(paths, header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-1. CSV (gzip too) with a header: trimmed values, lower-case names, the schema's columns; '' and what
    cannot be cast, or is not finite, is null. Quoted line breaks stay in their field."""
    return typed(_csv(spark, path), schema)


#: Columns of the schedule tables that the operators use; others are read as they are.
GTFS = {
    "agency": "agency_id string, agency_name string, agency_url string, agency_timezone string",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type int",
    "fare_attributes": "fare_id string, price double, currency_type string, payment_method int, transfers int",
    "fare_rules": "fare_id string, route_id string, origin_id string, destination_id string, contains_id string",
    "feed_info": "feed_publisher_name string, feed_publisher_url string, feed_lang string, feed_start_date string, feed_end_date string, feed_version string",
    "frequencies": "trip_id string, start_time string, end_time string, headway_secs int, exact_times int",
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int",
    "shapes": "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, shape_dist_traveled double",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int",
    "stops": "stop_id string, stop_code string, stop_name string, stop_lat double, stop_lon double",
    "transfers": "from_stop_id string, to_stop_id string, transfer_type int, min_transfer_time int",
    "trips": "route_id string, service_id string, trip_id string, trip_headsign string, direction_id int, shape_id string",
}


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def read_gtfs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """SRC-2. The feed's known tables; unknown files are skipped, absent columns are null."""
    return {name: read_csv_typed(spark, f"{folder}/{name}.txt", T.StructType.fromDDL(ddl)) for name, ddl in GTFS.items() if _exists(spark, f"{folder}/{name}.txt")}


def _by_header(spark: SparkSession, pattern: str) -> dict[str, list[str]]:
    """The files that match, or the parts below them, by their first line: a line of each file is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = top.getFileSystem(conf)
    files: list = []
    for found in fs.globStatus(top):
        files += [s.getPath() for s in fs.listStatus(found.getPath()) if not s.getPath().getName().startswith(("_", "."))] if found.isDirectory() else [found.getPath()]
    out: dict[str, list[str]] = {}
    for path in files:
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
        out.setdefault((lines.readLine() or "").lstrip("\ufeff").strip(), []).append(path.toString())
        lines.close()
    return out


def read_gtfs_feeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """SRC-3. All feeds below ``root``, with the agency's folder name. Files of one table may differ in their columns:
    those with one header are one read, and headers are few however many feeds there are."""
    out = {}
    for name, ddl in GTFS.items():
        if not _exists(spark, f"{root}/*/{name}.txt"):
            continue
        agency = F.regexp_extract("_metadata.file_path", rf"/([^/]+)/{name}\.txt(/[^/]*)?$", 1).alias("agency")
        for paths in _by_header(spark, f"{root}/*/{name}.txt").values():
            part = typed(_csv(spark, paths), T.StructType.fromDDL(ddl), agency)
            out[name] = out[name].unionByName(part) if name in out else part
    return out


POINT = "array<double>"
FEATURE = "type string, id string, properties map<string,string>, geometry struct<type:string,coordinates:string>"


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4. NDJSON line features: id, properties, parts (array of lines of [lon, lat]); a LineString is one part."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    f = F.from_json("value", FEATURE)
    rows = raw.select(f.alias("f"))
    one, many = F.from_json("f.geometry.coordinates", f"array<{POINT}>"), F.from_json("f.geometry.coordinates", f"array<array<{POINT}>>")
    return rows.select(F.coalesce("f.id", F.element_at("f.properties", "tmc")).alias("id"), F.col("f.properties").alias("properties"), F.when(F.col("f.geometry.type") == "LineString", F.array(one)).otherwise(many).alias("parts"))


def normalize_inventory(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """SRC-5. Drifting column names unified; empty positions dropped; a single part as a line; no geometry as null."""
    parts = F.filter(F.transform("parts", lambda p: F.filter(p, lambda x: F.size(x) > 0)), lambda p: F.size(p) > 0)
    named = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    cleaned = named.withColumn("parts", parts)
    return cleaned.withColumn("coords", F.when(F.size("parts") == 1, F.element_at("parts", 1))).withColumn("parts", F.when(F.size("parts") > 0, F.col("parts")))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in a stated order."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def load_osm(nodes: DataFrame, ways: DataFrame) -> dict[str, DataFrame]:
    """SRC-6. Nodes and ways, the first row of each id."""
    return {"nodes": first_of(nodes, ["node_id"], ["lon", "lat"]), "ways": first_of(ways, ["way_id"], ["node_ids"])}


def load_base_map(tables: dict[str, DataFrame], order: str = "tile") -> dict[str, DataFrame]:
    """SRC-7. Base-map tables keyed ``id``, the first row of each id by tile."""
    return {name: first_of(df, ["id"], [order]) for name, df in tables.items()}


def read_station_directions(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8. (rc_station, year, federal_direction), codes 0 and 9 dropped."""
    schema = T.StructType.fromDDL("rc_station string, year int, federal_direction int")
    return read_csv_typed(spark, path, schema).where(~F.col("federal_direction").isin(0, 9))


def extract_station_directions(layouts: list[tuple[DataFrame, tuple[str, str, str]]]) -> DataFrame:
    """SRC-9. Distinct (station, year, direction) of count tables with their own column names; quotes and spaces stripped."""
    out = None
    for df, (station, year, direction) in layouts:
        clean = lambda c: F.regexp_replace(F.col(c).cast("string"), r"[\s\"']", "")
        part = df.select(clean(station).alias("rc_station"), clean(year).try_cast("int").alias("year"), clean(direction).try_cast("int").alias("federal_direction"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def clean_count_csv(lines: DataFrame) -> DataFrame:
    """SRC-10. Text lines (line_no, value): spaces around commas and slashes trimmed, blank and separator rows dropped,
    and of repeated lines the first kept."""
    v = F.regexp_replace(F.trim("value"), r"\s*([,/])\s*", "$1")
    return lines.select("line_no", v.alias("value")).where(F.col("value").rlike("[A-Za-z0-9]")).groupBy("value").agg(F.min("line_no").alias("line_no"))
