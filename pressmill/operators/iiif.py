"""IIIF Presentation documents as JSON strings, built from structs by to_json; one aggregate per page."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import image_identifier

CONTEXT = "http://iiif.io/api/presentation/3/context.json"


def xywh(canvas: Column, box: Column) -> Column:
    return F.concat(canvas, F.lit("#xywh="), F.concat_ws(",", *[box[k].cast("string") for k in "xywh"]))


def parts_target(canvas: Column, boxes: Column) -> Column:
    """JSON of a target in parts: an SVG path with one rectangle each, and the first as a fragment."""
    rect = lambda b: F.format_string("M%d,%d h%d v%d h%d Z", b["x"], b["y"], b["w"], b["h"], -b["w"])
    path = F.array_join(F.transform(boxes, rect), " ")
    svg = F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg"><path d="'), path, F.lit('" fill="none" stroke="#00BFFF"/></svg>'))
    fragment = F.concat(F.lit("xywh="), F.concat_ws(",", *[boxes[0][k].cast("string") for k in "xywh"]))
    source = F.to_json(F.struct(canvas.alias("id"), F.lit("Canvas").alias("type")))
    first = F.to_json(F.struct(F.lit("FragmentSelector").alias("type"), F.lit("http://www.w3.org/TR/media-frags/").alias("conformsTo"), fragment.alias("value")))
    second = F.to_json(F.struct(F.lit("SvgSelector").alias("type"), svg.alias("value")))
    return F.concat(F.lit('{"type":"SpecificResource","source":'), source, F.lit(',"selector":['), first, F.lit(","), second, F.lit("]}"))


def annotation(ident: Column, target_json: Column, text: Column, granularity: str, language: str, tag: Column | None = None) -> Column:
    """JSON of a text annotation; `body` is an object, or a list where a tag (null for none) is added."""
    body = F.to_json(F.struct(F.lit("TextualBody").alias("type"), text.alias("value"), F.lit("text/plain").alias("format"), F.lit(language).alias("language")))
    if tag is not None:
        extra = F.to_json(F.struct(F.lit("TextualBody").alias("type"), tag.alias("value"), F.lit("tagging").alias("purpose")))
        body = F.when(tag.isNull(), body).otherwise(F.concat(F.lit("["), body, F.lit(","), extra, F.lit("]")))
    head = F.to_json(F.struct(ident.alias("id"), F.lit("Annotation").alias("type"), F.lit("supplementing").alias("motivation"), F.lit(granularity).alias("textGranularity")))
    return F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"body":'), body, F.lit(',"target":'), target_json, F.lit("}"))


def _quoted(text: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")


def _page(base: Column, name: str, items: Column) -> Column:
    url = F.concat(base, F.lit(f"/annotations/{name}.json"))
    label = F.concat(F.lit(f'{{"en":["{name.capitalize()} ('), F.size(items).cast("string"), F.lit(')"]}'))
    return F.concat(F.lit(f'{{"@context":"{CONTEXT}","id":'), _quoted(url), F.lit(',"type":"AnnotationPage","label":'), label, F.lit(',"items":['), F.array_join(items, ","), F.lit("]}"))


def page_documents(regions: DataFrame, manifest_base: str, image_base: str, language: str = "en", slash: str | None = None) -> DataFrame:
    """page_id, blocks, lines, words and manifest (JSON each) from region rows.

    Needs page_id, source_relpath, page_width, page_height, box_page_id, class, reading_order, text, suspect, box and the
    arrays lines and words of STRUCT<text, box[, match]>. Suspect regions are left out, blocks need text.
    """
    base = F.concat(F.lit(f"{manifest_base.rstrip('/')}/"), image_identifier(F.col("page_id")))
    # regions are collected as they are; what JSON is made of a page is made behind the grouping, so it is never sorted or spilled
    region = F.struct("reading_order", "box_page_id", "class", "text", "suspect", "box", "lines", "words")
    pages = regions.groupBy("page_id", "source_relpath", "page_width", "page_height").agg(F.collect_list(region).alias("_regions")).withColumn("_base", base).withColumn("_canvas", F.concat("_base", F.lit("/canvas/p1")))
    shown = lambda r: F.coalesce(r["suspect"], F.lit("")) == ""
    ident = lambda r, kind, *more: F.concat(F.col("_base"), F.lit(f"/annotation/{kind}/"), r["box_page_id"], *more)
    target = lambda box: _quoted(xywh(F.col("_canvas"), box))

    def block(r: Column) -> Column:
        return F.when(shown(r) & (F.coalesce(r["text"], F.lit("")) != ""), annotation(ident(r, "block"), target(r["box"]), r["text"], "block", language, r["class"]))

    def each(column: str, kind: str) -> Callable[[Column], Column]:
        tagged = "match" in regions.schema[column].dataType.elementType.names
        one = lambda r: lambda e, n: annotation(ident(r, kind, F.lit("-"), n.cast("string")), target(e["box"]), e["text"], kind, language, F.when(e["match"] == "estimated", "estimated position") if tagged else None)
        return lambda r: F.when(shown(r), F.transform(r[column], one(r))).otherwise(F.array().cast("array<string>"))

    def ordered(made: Callable[[Column], Column]) -> Column:
        named = F.transform("_regions", lambda r: F.struct(r["reading_order"].alias("reading_order"), r["box_page_id"].alias("box_page_id"), made(r).alias("made")))
        return F.transform(F.array_sort(named), lambda s: s["made"])

    blocks, lines, words = F.filter(ordered(block), lambda x: x.isNotNull()), F.flatten(ordered(each("lines", "line"))), F.flatten(ordered(each("words", "word")))
    pages = pages.select("page_id", "_base", "_canvas", "source_relpath", "page_width", "page_height", blocks.alias("b"), lines.alias("l"), words.alias("w"), F.size("_regions").alias("n"))
    refs = F.concat_ws(",", *[F.concat(F.lit('{"id":'), _quoted(F.concat("_base", F.lit(f"/annotations/{k}.json"))), F.lit(f',"type":"AnnotationPage","label":{{"en":["{k.capitalize()}"]}}}}')) for k in ("blocks", "lines", "words")])
    service = F.concat(F.lit(f"{image_base.rstrip('/')}/"), image_identifier(F.col("source_relpath"), slash))
    size = F.concat(F.lit(',"width":'), F.col("page_width").cast("string"), F.lit(',"height":'), F.col("page_height").cast("string"))
    image = F.concat(F.lit('{"id":'), _quoted(F.concat(service, F.lit("/full/max/0/default.jpg"))), F.lit(',"type":"Image","format":"image/jpeg"'), size, F.lit(',"service":[{"id":'), _quoted(service), F.lit(',"type":"ImageService3","profile":"level2"}]}'))
    painting = F.concat(F.lit('{"id":'), _quoted(F.concat("_canvas", F.lit("/annotation/painting"))), F.lit(',"type":"Annotation","motivation":"painting","body":'), image, F.lit(',"target":'), _quoted(F.col("_canvas")), F.lit("}"))
    label = F.concat(F.lit('{"none":['), _quoted(F.col("page_id").cast("string")), F.lit("]}"))
    meta = F.concat(F.lit('[{"label":{"en":["Source file"]},"value":{"none":['), _quoted(F.col("source_relpath")), F.lit(']}},{"label":{"en":["Regions"]},"value":{"none":["'), F.col("n").cast("string"), F.lit('"]}}]'))
    canvas = F.concat(F.lit('{"id":'), _quoted(F.col("_canvas")), F.lit(',"type":"Canvas","label":'), label, size, F.lit(',"items":[{"id":'), _quoted(F.concat("_canvas", F.lit("/page/painting"))), F.lit(',"type":"AnnotationPage","items":['), painting, F.lit(']}],"annotations":['), refs, F.lit("]}"))
    manifest = F.concat(F.lit(f'{{"@context":"{CONTEXT}","id":'), _quoted(F.concat("_base", F.lit("/manifest.json"))), F.lit(',"type":"Manifest","label":'), label, F.lit(',"metadata":'), meta, F.lit(',"items":['), canvas, F.lit("]}"))
    return pages.select("page_id", _page(F.col("_base"), "blocks", F.col("b")).alias("blocks"), _page(F.col("_base"), "lines", F.col("l")).alias("lines"), _page(F.col("_base"), "words", F.col("w")).alias("words"), manifest.alias("manifest"))


def collection(manifests: DataFrame, base: str, label: str = "Newspaper pages") -> DataFrame:
    """One row: the JSON of a collection that lists every manifest (columns id, label as JSON), ordered by id."""
    item = F.concat(F.lit('{"id":'), _quoted(F.col("id")), F.lit(',"type":"Manifest","label":'), F.col("label"), F.lit("}"))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", item.alias("item")))), lambda s: s["item"]), ",")
    head = f'{{"@context":"{CONTEXT}","id":"{base.rstrip("/")}/collection.json","type":"Collection","label":{{"en":["{label}"]}},"items":['
    return manifests.agg(F.concat(F.lit(head), items, F.lit("]}")).alias("collection"))


def structure_errors(document: Column) -> Column:
    """Names of the parts that every document needs and this one lacks, sorted; empty if it parses and has them."""
    parsed = F.from_json(document, "map<string,string>")
    need = ["@context", "id", "items", "label", "type"]
    missing = F.filter(F.array(*[F.lit(k) for k in need]), lambda k: ~F.map_contains_key(parsed, k))
    return F.when(parsed.isNull() | (F.size(parsed) == 0), F.array(F.lit("<root>"))).otherwise(missing)


def keep_layers(annotations: Column, name: str) -> Column:
    """Of an array of references only those to the chosen annotation page."""
    return F.filter(annotations, lambda a: a["id"].endswith(f"/annotations/{name}.json"))
