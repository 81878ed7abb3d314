"""Text expressions: plain Column functions that stay in whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases of a model that talks about the image instead of transcribing it.
COMMENTARY = (
    r"(?i)\b(?:the|this) (?:image|picture|photograph|scan)\b|\bheavily cropped\b"
    r"|\bno (?:legible|readable|visible) text\b"
    r"|\bI (?:cannot|can't|am unable to) (?:read|transcribe|make out|decipher|see|identify)\b"
    r"|\b(?:text|image|writing) is (?:not |too )?(?:visible|legible|readable|blurry|faded|unclear)\b"
)
COMMENTARY_WINDOW = 300
TITLE_LETTERS, TITLE_VOWELS = 5, 2

_PARAGRAPH = "\x00"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def clean_line_breaks(text: Column) -> Column:
    """Joins words hyphenated at a line's end, turns single line feeds into spaces and runs of them into paragraph breaks."""
    text = F.regexp_replace(text, r"-\n", "")
    text = F.regexp_replace(text, r"\n\n+", _PARAGRAPH)
    text = F.regexp_replace(text, r"\n", " ")
    text = F.regexp_replace(text, _PARAGRAPH, "\n\n")
    return strip(F.regexp_replace(text, r" +", " "))


def is_title(text: Column) -> Column:
    """Upper case throughout, at least five letters A-Z and two vowels (counted over the whole string)."""
    letters, vowels = F.regexp_count(text, F.lit("[A-Z]")), F.regexp_count(text, F.lit("[AEIOU]"))
    return (text == F.upper(text)) & (letters >= TITLE_LETTERS) & (vowels >= TITLE_VOWELS)


def strip_fences(text: Column) -> Column:
    """Without back quotes at the ends, and without the first 'tsv' anywhere in the text."""
    bare = F.btrim(text, F.lit("`"))
    at = F.instr(bare, "tsv")
    return F.when(at > 0, F.concat(F.substring(bare, F.lit(1), at - 1), F.substring(bare, at + 3, F.length(bare)))).otherwise(bare)


def words(text: Column) -> Column:
    """White-space separated tokens, none empty."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def line_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("\n")) + 1


def paragraph_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("\n\n")) + 1


def filled_parts(text: Column, separator: str) -> Column:
    """How many parts between separators hold more than white space."""
    return F.size(F.filter(F.split(text, separator), lambda p: F.regexp_replace(p, r"\s+", "") != ""))


def fragment_share(text: Column) -> Column:
    """Share of the tokens with letters that have at most three of them; 0 below three such tokens."""
    letters = F.regexp_replace(text, r"[^\p{L}\s]", "")
    tokens = F.split(letters, r"\s+")
    add = lambda so_far, w: F.struct(
        (so_far["all"] + (w != "").cast("int")).alias("all"), (so_far["short"] + F.length(w).between(1, 3).cast("int")).alias("short")
    )
    share = lambda n: F.when(n["all"] < 3, F.lit(0.0)).otherwise(n["short"] / n["all"])
    return F.aggregate(tokens, F.struct(F.lit(0).alias("all"), F.lit(0).alias("short")), add, share)


def is_layout_json(raw: Column) -> Column:
    """A JSON list of objects that all have a 'bbox'."""
    parsed = F.from_json(raw, "array<map<string,string>>", {"mode": "PERMISSIVE"})
    good = (F.size(parsed) > 0) & F.forall(parsed, lambda m: m.isNotNull() & F.map_contains_key(m, "bbox"))
    return F.coalesce(strip(raw).startswith("[") & good, F.lit(False))


def transcription_problem(region_class: Column, text: Column, raw: Column, finish_reasons: Column) -> Column:
    """Why the output of a model is no transcription, or null."""
    return (
        F.when(is_layout_json(raw), "layout JSON instead of text")
        .when(F.array_contains(finish_reasons, "length"), "output hit its token limit (repetition loop)")
        .when((region_class != "figure") & (strip(text) != "") & F.substring(text, 1, COMMENTARY_WINDOW).rlike(COMMENTARY), "model commentary instead of a transcription")
    )


def character_error_rate(reference: Column, text: Column) -> Column:
    """Edit distance in characters over the reference's length."""
    return F.levenshtein(reference, text) / F.length(reference)


def image_identifier(path: Column, slash: str | None = None) -> Column:
    """Percent-encoded path; '/' is encoded too, or replaced first."""
    path = F.replace(path, F.lit("\\"), F.lit("/"))
    if slash:
        path = F.replace(path, F.lit("/"), F.lit(slash))
    encoded = F.replace(F.url_encode(path), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def page_id(path: Column) -> Column:
    """Id from a relative path: no suffix, '/' as '__', other odd characters as '_', trimmed; 'page' if nothing is left."""
    bare = F.regexp_replace(path, r"\.[^./]*$", "")
    flat = F.regexp_replace(F.replace(bare, F.lit("/"), F.lit("__")), r"[^A-Za-z0-9._-]+", "_")
    trimmed = F.btrim(flat, F.lit("._"))
    return F.when(trimmed == "", "page").otherwise(trimmed)


def display_name(name: Column) -> Column:
    return F.initcap(F.replace(F.replace(F.replace(name, F.lit("_PDF_files.parquet"), F.lit("")), F.lit("_issue"), F.lit("")), F.lit("_"), F.lit(" ")))


def excerpt(text: Column, size: int = 200) -> Column:
    """The beginning on one line, hyphenation joined."""
    return F.replace(F.replace(F.substring(text, 1, size), F.lit("\n"), F.lit(" ")), F.lit("- "), F.lit(""))


def genre_prompt(text: Column, instructions: str) -> Column:
    return F.concat(F.lit(instructions.rstrip() + "\n\n"), text)


def parse_label(raw: Column) -> Column:
    """Class codes from a model's answer such as {'class': 6} or {'class': [15, 4]}; 99 when it can't be read."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^```[a-zA-Z]*\s*|\s*```$", ""), "'", '"')
    one = F.from_json(bare, "struct<class int>")["class"]
    many = F.from_json(bare, "struct<class array<int>>")["class"]
    loose = F.regexp_extract(bare, r"class\D*(\d+)", 1).try_cast("int")
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.when(loose.isNotNull(), F.array(loose)), F.array(F.lit(99)))


def cache_key(model: Column, max_tokens: Column, temperature: Column, prompt: Column, content: Column) -> Column:
    """SHA-256 of the request's settings joined by bars, followed by the image's bytes."""
    settings = F.concat_ws("|", model, max_tokens.cast("string"), temperature.cast("string"), prompt)
    return F.sha2(F.concat(F.encode(settings, "UTF-8"), content), 256)


def first_tokens(text: Column, n: int) -> Column:
    """The first n white-space tokens."""
    return F.array_join(F.slice(words(text), 1, n), " ")
