"""Queries that write data of the given tables out and read it back, image queries, and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.ids import strip
from .operators import attempts as log
from .operators.evidence import clean_ids
from .operators.images import flattened, resized
from .operators.labels import label_join_2022
from .plans.training_set import training_set
from .queries import MILESTONE_EVERY, _joined, query
from .schemas import BUNDLE_2022
from .sinks.checkpoint import append_ids
from .sinks.files import with_row_index, write_csv, write_jsonl
from .sinks.images import as_png, write_files
from .sinks.store import read_store, write_store
from .sources import bundle
from .sources.idlist import read_lines
from .sources.images import read_images, scan_report
from .sources.listing import list_flat
from .sources.tsv import read_catalogue
from .staging import stage_path
from .standins import view
from .streaming import checkpoint, guard, milestones, totals


@query
def q_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set(_joined(spark, sf_dir)).select(
        "id", "image_id", "filename", "caption", "scientific_name", "family", "genus", "species", "code", "split"
    )


@query
def q_scan_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "catalogue")
    file_names = {"gbif_id": "gbifID", "country_code": "countryCode"}
    rows = view(spark, sf_dir, "multimedia").withColumnsRenamed(file_names)
    rows.write.option("sep", "\t").option("header", True).csv(path)
    return read_catalogue(spark, path)


@query
def q_bundle_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "bundles")
    text = F.col("image_id").cast("string").alias("image_id")
    parts = {
        "annotations": view(spark, sf_dir, "annotations").select(text, "category_id", "institution_id"),
        "images": view(spark, sf_dir, "images").select(text, "file_name"),
        "categories": view(spark, sf_dir, "categories").select("category_id", "species", "genus", "family"),
        "institutions": view(spark, sf_dir, "institutions").withColumnRenamed("collection_code", "collectionCode"),
    }
    for part, rows in parts.items():
        fields = F.array(F.struct(*rows.columns))
        rows.select(fields.alias(part)).write.mode("append").json(path)
    star = bundle.star_2022(bundle.read_bundles(spark, path, BUNDLE_2022, multi_line=False))
    joined = label_join_2022(star["annotations"], star["images"], star["categories"], star["institutions"])
    return joined.select("image_id", "filename", "species", "genus", "family", "institution")


@query
def q_sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "metadata_csv")
    write_csv(with_row_index(_joined(spark, sf_dir), ["id"]), path, index="row_index")
    schema = (
        "row_index bigint, id bigint, image_id bigint, filename string, species string, genus string, family string, institution string"
    )
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


@query
def q_sink_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "catalogue_json")
    rows = view(spark, sf_dir, "multimedia")
    write_jsonl(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query
def q_checkpoint_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "id_list")
    done = clean_ids(view(spark, sf_dir, "processed_ids"))
    failed = clean_ids(view(spark, sf_dir, "failed_ids"))
    append_ids(done, path)
    append_ids(done.unionAll(failed), path)
    return read_lines(spark, path).groupBy(F.col("line").alias("id")).agg(F.count("*").alias("n_lines"))


def _bytes(px: Column) -> Column:
    """Binary value of an array of byte values."""
    return F.unhex(F.array_join(F.transform(px, lambda v: F.lpad(F.hex(v), 2, "0")), ""))


@query
def q_store_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "store")
    gbif_id = (F.col("vec_id") * 3 + 1_000_000).alias("gbif_id")
    rows = view(spark, sf_dir, "pixels").select(gbif_id, _bytes(F.col("px")).alias("content"))
    write_store(rows, path)
    stored = read_store(spark, path, "gbif_id bigint, content binary, prefix1 string, prefix2 string")
    return stored.select("gbif_id", "prefix1", "prefix2", F.hex("content").alias("content_hex"))


# Images


def _image_structs(spark: SparkSession, sf_dir: str, edge: int, bands: int, mode: int) -> DataFrame:
    return view(spark, sf_dir, "pixels").select(
        "vec_id",
        F.lit("").alias("origin"),
        F.lit(edge).alias("height"),
        F.lit(edge).alias("width"),
        F.lit(bands).alias("nChannels"),
        F.lit(mode).alias("mode"),
        _bytes(F.col("px")).alias("data"),
    )


def _image_rows(images: DataFrame) -> DataFrame:
    return images.select("vec_id", "height", "width", F.col("nChannels").alias("bands"), F.hex("data").alias("data_hex"))


@query
def q_image_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _image_rows(flattened(_image_structs(spark, sf_dir, 4, 4, 24)))


@query
def q_image_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _image_rows(resized(_image_structs(spark, sf_dir, 8, 1, 0), box=5))


@query
def q_image_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image files of every pixel row; some are empty and some are cut short."""
    folder = stage_path(spark, "images")
    images = _image_structs(spark, sf_dir, 8, 1, 0).withColumn(
        "name", F.concat(F.col("vec_id").cast("string"), F.lit(".png"))
    )
    number = F.regexp_extract("name", "^([0-9]+)", 1).cast("bigint")
    damaged = (
        F.when(number % 50 == 0, F.unhex(F.lit("")))
        .when(number % 50 == 1, F.substring("content", 1, 20))
        .otherwise(F.col("content"))
    )
    written = write_files(as_png(images).withColumn("content", damaged), folder)
    written.write.parquet(stage_path(spark, "written"))
    report = scan_report(list_flat(spark, folder), read_images(spark, folder))
    name = F.element_at(F.split("path", "/"), -1)
    valid = F.col("readable")
    return report.select(
        name.alias("name"),
        (F.col("length") == 0).alias("empty"),
        F.when(valid, F.col("height")).alias("height"),
        F.when(valid, F.col("width")).alias("width"),
        "readable",
    )


# Streams

# Triggers that take in a stream of id lines, whatever number of files Spark wrote them to.
ID_TRIGGERS = 4


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order of time, a third of the span to a trigger."""
    stored = stage_path(spark, "events")
    events = log.host_events(view(spark, sf_dir, "attempts"))
    span = events.agg(F.min("ts_us").alias("first"), F.max("ts_us").alias("last")).first()
    third = F.least(F.floor((F.col("ts_us") - span["first"]) * 3 / (span["last"] - span["first"] + 1)), F.lit(2))
    for part in range(3):
        events.filter(F.coalesce(third, F.lit(0)) == part).coalesce(1).write.mode("append").parquet(stored)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(stored)


def _run(writer, spark: SparkSession) -> None:
    with guard.rocksdb_state(spark):
        query = writer.option("checkpointLocation", stage_path(spark, "progress")).trigger(availableNow=True).start()
    query.awaitTermination()


@query
def st_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "decisions")
    _run(guard.guard_writer(_event_stream(spark, sf_dir), path), spark)
    return guard.decisions(spark, path)


@query
def st_host_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "totals")
    _run(totals.totals_writer(totals.rolling_errors(_event_stream(spark, sf_dir)), path), spark)
    return totals.latest_totals(spark, path)


def _line_stream(spark: SparkSession, source: str) -> DataFrame:
    """Lines stored in ``source`` in order of time, an equal share of its files to a trigger.

    The files are as many as tasks wrote them, and a trigger costs the same jobs for few ids as for many. With a
    file to a trigger, triggers would grow with the input, and every one of them reads the ids of those before it.
    """
    files = len(spark.read.schema("line string").parquet(source).inputFiles())
    share = max(1, -(-files // ID_TRIGGERS))
    return spark.readStream.schema("line string").option("maxFilesPerTrigger", share).parquet(source)


@query
def st_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = stage_path(spark, "id_lines"), stage_path(spark, "id_list")
    for name in ("processed_ids", "failed_ids"):
        view(spark, sf_dir, name).select("line").write.mode("append").parquet(source)
    ids = _line_stream(spark, source).select(strip(F.col("line")).alias("id")).filter(F.length("id") > 0)
    _run(checkpoint.id_list_writer(ids, path), spark)
    return checkpoint.read_list(spark, path).groupBy("id").agg(F.count("*").alias("n_lines"))


@query
def st_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "milestones")
    hits = log.first_success(view(spark, sf_dir, "attempts")).select("gbif_id", "attempt_id", "ts_us")
    stored = stage_path(spark, "hits")
    hits.write.parquet(stored)
    stream = spark.readStream.schema(hits.schema).parquet(stored)
    _run(milestones.milestones_writer(stream, path, MILESTONE_EVERY), spark)
    return milestones.reached(spark, path)
