"""File provenance: manifest rows, the latest per dataset, and lineage traces."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions import fixed
from cartorio.sources.manifest import MANIFEST_SCHEMA, file_sha256
from cartorio.sources.paths import readable

#: The curated table that no landing file is behind.
GENERATED = "dim_date"
LAYERS = ["SOURCE", "BRONZE_RAW", "SILVER_CLEAN", "GOLD_ANALYTICAL"]


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def record_counts(records: DataFrame, file: str = "_seq.file") -> DataFrame:
    """Records per landing file (a quoted line break does not make a record)."""
    return records.groupBy(F.col(file).alias("file_path")).agg(F.count("*").alias("row_count")).withColumn(
        "file_path", readable("file_path"))


def path_key(column: str) -> Column:
    """Readers spell the scheme of local paths with one slash or three."""
    return F.regexp_replace(F.col(column), r"^file:/+", "/")


def manifest_rows(
    hashes: DataFrame, counts: DataFrame, dataset: str | Column, source_url: str, version: str = "v1.0",
    extra: dict[str, str] | None = None, timestamp: str | None = None,
) -> DataFrame:
    """One manifest row per file: hash, bytes and records. A file without records counts 0."""
    name = F.lit(dataset) if isinstance(dataset, str) else dataset
    pairs = [F.lit(x) for kv in (extra or {}).items() for x in kv]
    details = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")
    keyed = counts.select(path_key("file_path").alias("_path"), "row_count")
    joined = hashes.withColumn("_path", path_key("file_path")).join(keyed, "_path", "left")
    return joined.select(
        name.alias("dataset_name"),
        F.lit(source_url).alias("source_url"),
        F.element_at(F.split("_path", "/"), -1).alias("original_filename"),
        "file_path", "file_hash_sha256", "file_size_bytes",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        F.lit(version).alias("dataset_version"),
        F.lit(timestamp or _now()).alias("download_timestamp"),
        F.lit("SUCCESS").alias("status"),
        details.alias("extra"),
    ).select(*MANIFEST_SCHEMA.names)


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("ignoreNullFields", False).json(path)


def record_ingestion(
    spark: SparkSession, records: DataFrame, raw: str, manifest_path: str, dataset: str,
    source_url: str, version: str = "v1.0", extra: dict[str, str] | None = None,
) -> None:
    """Hash the landing files below ``raw``, count their records and append the manifest rows."""
    append_manifest(
        manifest_rows(file_sha256(spark, raw), record_counts(records), dataset, source_url, version, extra),
        manifest_path)


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """The last row of each dataset by time, path and hash breaking ties."""
    rest = [c for c in manifest.columns if c not in ("dataset_name", "extra")]
    order = F.struct("download_timestamp", "file_path", "file_hash_sha256")
    last = manifest.groupBy("dataset_name").agg(F.max_by(F.struct(*rest, "extra"), order).alias("last"))
    return last.select("dataset_name", "last.*").select(*manifest.columns)


def latest_ingestion(manifest: DataFrame) -> DataFrame:
    """All file rows of each dataset's last ingestion; its files share one time."""
    last = manifest.groupBy("dataset_name").agg(F.max("download_timestamp").alias("download_timestamp"))
    return manifest.join(last, ["dataset_name", "download_timestamp"], "left_semi")


# ---------------------------------------------------------------- lineage


def entity_datasets(spark: SparkSession, entities: DataFrame | None = None) -> DataFrame:
    """(entity, dataset) of the known entities, or of the given ones, unknown ones without dataset."""
    known = spark.createDataFrame(sorted(fixed.ENTITY_DATASETS.items()), "known string, dataset string")
    if entities is None:
        return known.withColumnRenamed("known", "entity")
    return entities.join(F.broadcast(known), F.lower("entity") == F.col("known"), "left").drop("known")


_LINEAGE_COLUMNS = ["entity", "layer_rank", "layer", "name", "version", "hash_or_checksum", "row_count", "validation_status"]


def lineage_trace(
    entities: DataFrame, manifest: DataFrame, silver_counts: DataFrame, gold_counts: DataFrame,
    validation_status: str | None,
) -> DataFrame:
    """Nodes from the source to the curated table behind each (entity, dataset), in layer order.

    The raw node appears only with manifest rows. It sums the records of all files of the last
    ingestion; a single file gives its name and hash too. The Gold node has the curated table's own
    row count. The calendar is generated, so it has no file behind it. An unknown entity yields a
    single ERROR node.
    """
    one = F.col("n_files") == 1
    last = latest_ingestion(manifest).groupBy(F.col("dataset_name").alias("dataset")).agg(
        F.count("*").alias("n_files"), F.sum("row_count").alias("raw_rows"), F.max("dataset_version").alias("dataset_version"),
        F.max("original_filename").alias("file"), F.max("file_hash_sha256").alias("hash"))
    last = last.withColumns({"file": F.when(one, F.col("file")).otherwise(F.concat(F.col("n_files"), F.lit(" files"))),
                             "hash": F.when(one, F.col("hash"))})
    silver = silver_counts.select(F.col("table_name").alias("dataset"), F.col("n_rows").alias("silver_rows"))
    gold = gold_counts.select(F.col("table_name").alias("gold_name"), F.col("n_rows").alias("gold_rows"))
    own = F.col("entity").rlike("^(fact|dim)_")
    made = F.col("entity") == GENERATED
    known = entities.where(F.col("dataset").isNotNull() | made).join(last, "dataset", "left").join(silver, "dataset", "left")
    known = known.withColumn(
        "gold_name", F.when(own, F.col("entity")).otherwise(F.coalesce(
            F.try_element_at(_gold_of_dataset(), F.col("dataset")), F.concat(F.lit("fact_"), "dataset"))),
    ).join(gold, "gold_name", "left")
    none_s, none_n = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def node(rank: int, name: Column, version: Column, digest: Column, rows: Column) -> Column:
        return F.struct(
            F.lit(rank).alias("layer_rank"), F.lit(LAYERS[rank - 1]).alias("layer"), name.alias("name"),
            version.alias("version"), digest.alias("hash_or_checksum"), rows.alias("row_count"))

    nodes = F.array(
        node(1, F.when(made, "Generated calendar").otherwise("Court open data portal"),
             F.when(made, "Generated").otherwise("Official Portal"), none_s, none_n),
        node(2, F.concat_ws("/", F.lit("raw"), "dataset", "file"), F.col("dataset_version"), F.col("hash"), F.col("raw_rows")),
        node(3, F.concat(F.lit("silver/"), "dataset"), F.lit("v0.1.0-clean"), none_s, F.col("silver_rows")),
        node(4, F.col("gold_name"), F.lit("v0.1.0-star"), none_s, F.col("gold_rows")),
    )
    rank = F.col("node.layer_rank")
    traced = known.select("entity", "n_files", made.alias("made"), F.explode(nodes).alias("node")).where(
        ((rank != 2) | F.col("n_files").isNotNull()) & (~rank.isin(2, 3) | ~F.col("made"))).select("entity", "node.*")
    unknown = entities.where(F.col("dataset").isNull() & ~made).select(
        "entity", F.lit(0).alias("layer_rank"), F.lit("ERROR").alias("layer"),
        F.lit("unknown entity").alias("name"), none_s.alias("version"), none_s.alias("hash_or_checksum"),
        none_n.alias("row_count"))
    status = F.lit(validation_status or "UNKNOWN").alias("validation_status")
    return traced.unionByName(unknown).withColumn("validation_status", status).select(
        *_LINEAGE_COLUMNS).orderBy("entity", "layer_rank")


def _gold_of_dataset() -> Column:
    """Curated table of each Silver dataset: its fact, or the dimension of people."""
    pairs = {d: e for e, d in fixed.ENTITY_DATASETS.items() if e.startswith("fact_") or e == "dim_personnel"}
    return F.create_map(*[F.lit(x) for kv in sorted(pairs.items()) for x in kv])

