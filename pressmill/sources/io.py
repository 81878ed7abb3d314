"""Readers and writers: thin, declarative, with explicit schemas where a format has none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import page_id
from ..operators.ordering import numbered

SCAN_SUFFIXES = (".jp2", ".tif", ".tiff", ".png", ".jpg", ".jpeg")
RESPONSE = "id string, custom_id string, response struct<body struct<usage struct<prompt_tokens int, completion_tokens int, total_tokens int>, choices array<struct<finish_reason string, message struct<content string>>>>>"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def file_name(suffix: bool = True) -> Column:
    name = F.col("_metadata.file_name")
    return name if suffix else F.regexp_replace(name, r"\.[^.]*$", "")


def discover_scans(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SCAN_SUFFIXES) -> DataFrame:
    """path, relpath, page_id (with _ext<n> for repeats) and seq of every scan below the folder; hidden files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    root = folder.rstrip("/")
    rel = F.regexp_replace(F.expr(f"substring(path, locate('{root}', path) + {len(root)})"), r"^/+", "")
    known = files.select("path", rel.alias("relpath")).where(F.lower("relpath").rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$") & ~F.col("relpath").rlike(r"(^|/)\."))
    ids = known.withColumn("base", page_id(F.col("relpath")))
    unique = numbered(with_unique_ids(ids, "base", ["relpath"], "page_id"), ["relpath"], name="seq")
    return unique.select("path", "relpath", "page_id", "seq")


def with_unique_ids(df: DataFrame, base: str, order: list[str], name: str) -> DataFrame:
    """name: the base id, with _ext<n> behind it where it was there n times before."""
    again = numbered(df, order, [base], "_again")
    return again.withColumn(name, F.when(F.col("_again") == 0, F.col(base)).otherwise(F.concat(F.col(base), F.lit("_ext"), F.col("_again")))).drop("_again")


def read_parquet_folder(spark: SparkSession, folder: str, name_column: str, columns: list[str] | None = None) -> DataFrame:
    """All files of a folder as one table with the file's name."""
    df = spark.read.parquet(folder).withColumn(name_column, file_name())
    return df.select(*columns, name_column) if columns else df


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_texts(spark: SparkSession, folder: str, column: str = "content") -> DataFrame:
    """file_name (no suffix) and whole text of each .txt file."""
    return spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True).select(file_name(False).alias("file_name"), F.col("value").alias(column))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Batch responses, one JSON object a line; lines that don't parse are dropped."""
    return flatten_responses(spark.read.schema(RESPONSE).json(path, mode="DROPMALFORMED"))


def read_response_array(spark: SparkSession, path: str) -> DataFrame:
    """Batch responses in files that hold one JSON array."""
    return flatten_responses(spark.read.schema(RESPONSE).option("multiLine", True).json(path))


def flatten_responses(df: DataFrame) -> DataFrame:
    body, first = "response.body", F.col("response.body.choices")[0]
    return df.select("id", "custom_id", *[F.col(f"{body}.usage.{c}") for c in ("prompt_tokens", "completion_tokens", "total_tokens")], first["finish_reason"].alias("finish_reason"), first["message"]["content"].alias("content"))


def single_response(df: DataFrame, id: str, custom_id: str) -> DataFrame:
    """The row of one answer that came at once (column `body`, as JSON text), under the ids that the caller gives."""
    body = F.from_json("body", RESPONSE.split("response struct<body ", 1)[1][:-1])
    return flatten_responses(df.select(F.lit(id).alias("id"), F.lit(custom_id).alias("custom_id"), F.struct(body.alias("body")).alias("response")))


def read_label_export(spark: SparkSession, path: str) -> DataFrame:
    """Boxes of an annotation export (NDJSON; the project key varies, so projects are read as a map)."""
    box = "struct<name string, bounding_box struct<left double, top double, width double, height double>>"
    schema = f"data_row struct<external_id string>, media_attributes struct<height int, width int>, projects map<string, struct<labels array<struct<annotations struct<objects array<{box}>>>>>>"
    rows = spark.read.schema(schema).json(path).select(F.col("data_row.external_id").alias("filename"), F.col("media_attributes.height").alias("page_height"), F.col("media_attributes.width").alias("page_width"), F.explode(F.map_values("projects")[0]["labels"][0]["annotations"]["objects"]).alias("o"))
    b = "o.bounding_box"
    return rows.select("filename", F.regexp_replace("filename", r"\.png$", "").alias("page_id"), F.col("o.name").alias("class"), F.lit(1.0).alias("confidence"), F.col(f"{b}.left").alias("x1"), F.col(f"{b}.top").alias("y1"), F.expr(f"{b}.left + {b}.width").alias("x2"), F.expr(f"{b}.top + {b}.height").alias("y2"), "page_height", "page_width")


def read_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """id and label (JSON) of every readable manifest below the folder."""
    docs = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").text(folder, wholetext=True)
    parsed = docs.select(F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.label").alias("label"), F.get_json_object("value", "$.type").alias("type"))
    return parsed.where("type = 'Manifest' and id is not null").select("id", "label")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """page (id of the annotation page), id, text and target of each annotation in annotation pages."""
    docs = spark.read.text(path, wholetext=True)
    items = F.from_json(F.get_json_object("value", "$.items"), "array<struct<id string, body string, target string>>")
    rows = docs.select(F.get_json_object("value", "$.id").alias("page"), F.posexplode(items).alias("at", "a"))
    one, many = F.get_json_object("a.body", "$.value"), F.get_json_object("a.body", "$[0].value")
    return rows.select("page", "at", "a.id", F.coalesce(one, many).alias("text"), "a.target")


# ---- sinks


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite") -> None:
    (df.write.partitionBy(*by) if by else df.write).mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_text(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)


def write_exports(regions: DataFrame, folder: str) -> None:
    """regions, lines and words tables, partitioned by page, and each page's text with headers; suspect and empty regions give no text."""
    box = [F.col(f"box.{c}").alias(c) for c in "xywh"]
    write_parquet(regions.drop("lines", "words").select("*", *box).drop("box"), f"{folder}/regions", ["page_id"])
    for name, item in (("lines", "line"), ("words", "word")):
        rows = regions.select("page_id", "box_page_id", F.posexplode(name).alias(item, "e"))
        write_parquet(rows.select("page_id", "box_page_id", item, "e.text", *[F.col(f"e.box.{c}").alias(c) for c in "xywh"]), f"{folder}/{name}", ["page_id"])
    write_parquet(page_texts(regions), f"{folder}/texts", ["page_id"])


def write_documents(df: DataFrame, folder: str, key: str = "page_id", body: str = "document", mode: str = "overwrite") -> None:
    """Each row's JSON text in a folder of its key, by Spark's committer: a document is there whole or not at all."""
    df.select(key, F.col(body).alias("value")).write.partitionBy(key).mode(mode).text(folder)


def remove_partial(spark: SparkSession, folder: str, suffix: str = ".tmp") -> list[str]:
    """Delete what broken runs left in a folder (files that end in the suffix, folders of unfinished commits); gives their paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone, todo = [], [path] if files.exists(path) else []
    while todo:
        for entry in files.listStatus(todo.pop()):
            name = entry.getPath().getName()
            if name.endswith(suffix) or name == "_temporary":
                files.delete(entry.getPath(), True)
                gone.append(entry.getPath().toString())
            elif entry.isDirectory():
                todo.append(entry.getPath())
    return sorted(gone)


def page_texts(regions: DataFrame) -> DataFrame:
    """page_id and its published text: a header '[order id class]' above each region."""
    shown = regions.where((F.coalesce("suspect", F.lit("")) == "") & (F.coalesce("text", F.lit("")) != ""))
    part = F.concat(F.lit("["), F.col("reading_order").cast("string"), F.lit(" "), "box_page_id", F.lit(" "), "class", F.lit("]\n"), "text")
    ordered = F.array_sort(F.collect_list(F.struct("reading_order", "box_page_id", part.alias("part"))))
    return shown.groupBy("page_id").agg(F.array_join(F.transform(ordered, lambda s: s["part"]), "\n\n").alias("value"))


def decode_images(df: DataFrame, column: str = "content") -> DataFrame:
    """Base64 images as bytes, for a binary sink."""
    return df.withColumn(column, F.unbase64(column))
