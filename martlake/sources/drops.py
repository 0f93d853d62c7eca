"""Drop-file sources.

A drop is a JSON object ``{"<day>": [record, ...], ...}``.  The reference
reads one object per file; ``read_drops`` also accepts files holding one such
object per line, so a producer can write large drops as splittable text.
Parsing is ``from_json`` into ``map<string, array<struct>>`` followed by two
``posexplode``s, so the day position and the record position inside the day
list are kept as the source order (needed by the ranked dedup, W7b).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, MapType, StringType,
                               StructField, StructType)

# Record contracts of the two drop kinds (field names as they arrive).
SESSION_REQUIRED = ("session_id", "client_id", "visit_date", "visit_time", "visit_number",
                    "utm_source", "utm_medium", "utm_campaign", "utm_adcontent", "utm_keyword",
                    "device_category", "device_os", "device_brand", "device_screen_resolution",
                    "device_browser", "geo_country", "geo_city")
HIT_REQUIRED = ("session_id", "hit_date", "hit_time", "hit_number", "hit_type", "hit_referer",
                "hit_page_path", "event_category", "event_action", "event_label", "event_value")

SESSION_RECORD = StructType(
    [StructField(c, LongType() if c == "visit_number" else StringType()) for c in SESSION_REQUIRED]
    + [StructField("device_model", StringType())])
HIT_RECORD = StructType(
    [StructField(c, LongType() if c == "hit_number" else DoubleType() if c == "event_value"
                 else StringType()) for c in HIT_REQUIRED])

# Vehicle record of the scoring directory (one JSON object per file).
VEHICLE_RECORD = StructType([
    StructField("id", LongType()), StructField("url", StringType()), StructField("region", StringType()),
    StructField("region_url", StringType()), StructField("price", DoubleType()),
    StructField("year", DoubleType()), StructField("manufacturer", StringType()),
    StructField("model", StringType()), StructField("fuel", StringType()),
    StructField("odometer", DoubleType()), StructField("title_status", StringType()),
    StructField("transmission", StringType()), StructField("image_url", StringType()),
    StructField("description", StringType()), StructField("state", StringType()),
    StructField("lat", DoubleType()), StructField("long", DoubleType()),
    StructField("posting_date", StringType()),
])


def drop_file_column():
    """Drop file name of a scanned line: the ``file_name=<name>`` folder when
    the drop was written by ``write_drops`` (one folder per drop), else the
    file's own name."""
    from_folder = F.regexp_extract(F.col("_metadata.file_path"), r"file_name=([^/]+)/[^/]*$", 1)
    return F.when(from_folder != "", F.url_decode(from_folder)).otherwise(F.col("_metadata.file_name"))


def drop_documents(spark: SparkSession, path: str, whole_file: bool = True,
                   layout: str = "files") -> DataFrame:
    """Raw drop text with its file name: (file_name, line_no, value).

    ``layout='files'``: ``*.json`` files in a folder, one object per file
    (``whole_file=True``, the reference format) or per line.
    ``layout='folders'``: the ``write_drops`` layout, a ``file_name=<name>``
    folder per drop holding text parts with one object per line."""
    if layout == "folders":
        df = spark.read.option("recursiveFileLookup", "true").text(path)
    else:
        reader = spark.read.option("pathGlobFilter", "*.json")
        df = reader.option("wholetext", "true").text(path) if whole_file else reader.text(path)
    return df.select(drop_file_column().alias("file_name"),
                     F.monotonically_increasing_id().alias("line_no"), "value")


def flatten_drops(docs: DataFrame, record_schema: StructType, text: str = "value",
                  file_col: str = "file_name", line_col: str | None = "line_no") -> DataFrame:
    """One row per record: file, line, day, day_pos, rec_pos and
    the record fields.  A file with no records yields no rows, nor does a broken
    one (see ``corrupt_documents``).  Fields are parsed as text and then cast, so
    that a quoted number is a number; a text that is none becomes NULL."""
    as_text = StructType([StructField(f.name, StringType()) for f in record_schema.fields])
    keep = [file_col, *([line_col] if line_col else [])]
    parsed = docs.select(*keep, F.from_json(F.col(text), MapType(StringType(), ArrayType(as_text))).alias("_m"))
    days = parsed.select(*keep, F.posexplode(F.map_entries("_m")).alias("day_pos", "_e"))
    recs = days.select(*keep, "day_pos", F.col("_e.key").alias("day"),
                       F.posexplode(F.col("_e.value")).alias("rec_pos", "_r"))
    fields = [F.col(f"_r.{f.name}").try_cast(f.dataType).alias(f.name) for f in record_schema.fields]
    return recs.select(*keep, "day", "day_pos", "rec_pos", *fields)


def corrupt_documents(docs: DataFrame, text: str = "value", file_col: str = "file_name") -> DataFrame:
    """Files with a document that is not a JSON object of lists of records."""
    shape = MapType(StringType(), ArrayType(MapType(StringType(), StringType())))
    broken = (F.trim(F.col(text)) != "") & F.from_json(F.col(text), shape, {"mode": "PERMISSIVE"}).isNull()
    return docs.where(broken).select(file_col).distinct()


def read_drops(spark: SparkSession, path: str, record_schema: StructType,
               whole_file: bool = True) -> DataFrame:
    """S3: scan a directory of drops into flat records."""
    return flatten_drops(drop_documents(spark, path, whole_file), record_schema)


def record_keys(docs: DataFrame, required, text: str = "value", file_col: str = "file_name") -> DataFrame:
    """S5 helper: per file, which ``required`` keys occur in any record (with a
    NULL too, when the producer wrote it) and the record count.  Other keys that
    a producer sends are not gathered."""
    generic = MapType(StringType(), ArrayType(MapType(StringType(), StringType())))
    recs = (docs.select(file_col, F.explode(F.map_values(F.from_json(F.col(text), generic))).alias("_l"))
            .select(file_col, F.explode("_l").alias("_r")))
    has = [F.max(F.map_contains_key("_r", F.lit(c))).alias(f"_h{i}") for i, c in enumerate(required)]
    per = recs.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_records"), *has)
    keys = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"_h{i}"), F.lit(c)) for i, c in enumerate(required)])))
    files = docs.select(file_col).distinct()
    return files.join(per, file_col, "left").select(
        file_col, F.coalesce("n_records", F.lit(0)).alias("n_records"), keys.alias("keys"))


def missing_columns(docs: DataFrame, required, text: str = "value",
                    file_col: str = "file_name") -> DataFrame:
    """Per file (file, n_records, missing, corrupt, ok).  An empty file
    reports no contract failure; it is skipped as empty (``n_records = 0``).  A
    file with a broken document is ``corrupt`` and never ok: a transform failure,
    not an empty file."""
    req = F.array(*[F.lit(c) for c in required])
    k = record_keys(docs, required, text, file_col)
    bad = corrupt_documents(docs, text, file_col).withColumn("_bad", F.lit(True))
    missing = F.array_sort(F.array_except(req, F.col("keys")))
    corrupt = F.coalesce("_bad", F.lit(False))
    return k.join(bad, file_col, "left").select(
        file_col, "n_records",
        F.when(F.col("n_records") == 0, F.array().cast("array<string>")).otherwise(missing).alias("missing"),
        corrupt.alias("corrupt"),
        ((F.col("n_records") > 0) & (F.size(missing) == 0) & ~corrupt).alias("ok"))


def read_records_per_file(spark: SparkSession, path: str, schema: StructType = VEHICLE_RECORD,
                          one_record_per_file: bool = True) -> DataFrame:
    """Every ``*.json`` file of a directory is one record, keyed by file
    name (the reference layout).  ``one_record_per_file=False`` reads JSON
    lines instead (many records per file, the layout to use at scale; the
    key is then file name + record id).  An empty directory raises."""
    r = spark.read.schema(schema).option("pathGlobFilter", "*.json")
    if one_record_per_file:
        return r.option("multiLine", "true").json(path).withColumn("file_name", F.col("_metadata.file_name"))
    return r.json(path).withColumn(
        "file_name", F.concat_ws("#", F.col("_metadata.file_name"), F.col("id").cast("string")))
