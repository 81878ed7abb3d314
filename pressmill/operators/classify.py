"""Classification: label maps, silver sets, renamed class columns, request lines for a labelling model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .corpus import sample_by_hash, split_by_hash

# Class codes and their names.
TEXT_TYPES = ["news report", "editorial", "letter", "advert", "review", "poem/song/story", "other"]
MERGED_TYPES = ["article", "article", "article", "advert", "article", "poem/song/story", "other"]
MERGED_CODES = {"article": 0, "advert": 1, "poem/song/story": 2, "other": 3}
TOPICS = [
    "arts_culture_entertainment_media", "crime_law_justice", "disaster_accident_emergency", "economy_business_finance", "education", "environment", "health", "human_interest", "labour", "lifestyle_leisure",
    "politics", "religion", "science_technology", "society", "sport", "conflict_war_peace", "weather", "NA",
]


def named(code: Column, names: list[str]) -> Column:
    """The name of a code; null for a code without one."""
    return F.get(F.array(*[F.lit(n) for n in names]), code)


def text_types(labels: DataFrame) -> DataFrame:
    """text_class, text_class2 and class_code2 from custom_id and content (a model's answer)."""
    code = T.parse_label(F.col("content"))[0]
    merged = F.create_map(*[F.lit(x) for kv in MERGED_CODES.items() for x in kv])
    df = labels.select("custom_id", code.alias("class_code")).withColumns({"text_class": named(F.col("class_code"), TEXT_TYPES), "text_class2": named(F.col("class_code"), MERGED_TYPES)})
    return df.withColumn("class_code2", merged[F.col("text_class2")])


def topics(labels: DataFrame) -> DataFrame:
    """custom_id, class_code (all codes) and one 0/1 column for each topic."""
    df = labels.select("custom_id", T.parse_label(F.col("content")).alias("class_code"))
    return df.select("custom_id", "class_code", *[F.array_contains("class_code", k).cast("int").alias(n) for k, n in enumerate(TOPICS)])


def training_rows(content: DataFrame, least_tokens: int = 30) -> DataFrame:
    """Titles and texts of more than least_tokens output tokens."""
    return content.where(F.col("class").isin("title", "text") & (F.col("completion_tokens") > least_tokens))


def silver_set(labels: DataFrame, content: DataFrame, code: str, seed: int = 1852, share: float = 0.8) -> DataFrame:
    """bbox_uid, content, class_code and is_train; issues are on one side as a whole. Labels join on custom_id = bbox_uid."""
    rows = labels.join(content, labels.custom_id == content.bbox_uid).where(F.col(code).isNotNull())
    return split_by_hash(rows, "issue_id", share, seed).select("bbox_uid", "content", F.col(code).alias("class_code"), "is_train")


def sampled_rows(content: DataFrame, n: int = 2000, seed: int = 1850) -> DataFrame:
    return sample_by_hash(training_rows(content), "bbox_uid", n, seed)


def rename_classes(df: DataFrame, names: list[str]) -> DataFrame:
    """class_<i> and class_<i>_probability to the classes' names."""
    return df.withColumnsRenamed({f"class_{k}{end}": f"{n}{end}" for k, n in enumerate(names) for end in ("", "_probability")})


def request_lines(content: DataFrame, instructions: str, most: int = 100) -> DataFrame:
    """One JSON request a line for a labelling model: custom_id is the bbox_uid, the prompt is the instructions and the text."""
    message = F.array(F.struct(F.lit("user").alias("role"), T.genre_prompt(F.col("content"), instructions).alias("content")))
    return content.select(F.to_json(F.struct(F.col("bbox_uid").alias("custom_id"), F.struct(F.lit(most).alias("max_tokens"), message.alias("messages")).alias("body"))).alias("value"))


def experiment(file: Column) -> dict[str, Column]:
    """dataset, deskew and max_ratio from names such as NCSE_deskew_True_max_ratio_1.5.csv."""
    part = lambda k: F.split_part(F.replace(file, F.lit(".csv"), F.lit("")), F.lit("_"), F.lit(k))
    return {"dataset": part(1), "deskew": part(3), "max_ratio": part(6).try_cast("double")}


def experiment_page(dataset: Column, file: Column) -> Column:
    bare = F.replace(F.replace(file, F.lit("_box_page_id"), F.lit("")), F.lit(".txt"), F.lit(""))
    return F.when(dataset == "BLN600", F.replace(bare, F.lit("_page_1_B0C1R0"), F.lit(""))).otherwise(bare)
