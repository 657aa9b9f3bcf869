"""Column functions over file paths, names and ids."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, functions as F

# Limits, extension sets and file-type labels.
LARGE_FILE_BYTES = 104857600
LARGE_EXTENSIONS = ("pdf", "docx", "pptx")
PARSE_EXTENSIONS = ("pdf", "docx", "pptx", "jpeg", "jpg", "png", "tiff", "tif", "html", "txt")
SPREADSHEET_EXTENSIONS = ("xlsx", "xlsm")
CSV_EXTENSIONS = ("csv",)
FILE_TYPES = {
    "pdf": "pdf",
    "docx": "docx",
    "pptx": "pptx",
    "jpg": "jpeg",
    "jpeg": "jpeg",
    "png": "png",
    "tiff": "tiff",
    "tif": "tiff",
    "html": "html",
    "txt": "txt",
}
CONVERTED_FOLDER = "converted_excel/"
SPLIT_FOLDER = "split_documents/"


def base_name(path: Column) -> Column:
    """Text after the last slash, null if there is none."""
    return F.regexp_substr(path, F.lit(r"[^/]+$"))


def extension(path: Column) -> Column:
    """Last dot and what follows, null if there is no dot."""
    return F.regexp_substr(path, F.lit(r"\.[^.]+$"))


def strip_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def has_extension(path: Column, extensions: tuple[str, ...]) -> Column:
    upper = F.upper(path)
    return reduce(lambda a, b: a | b, [upper.endswith("." + e.upper()) for e in extensions])


def is_large_type(path: Column) -> Column:
    return has_extension(path, LARGE_EXTENSIONS)


def is_parse_type(path: Column) -> Column:
    return has_extension(path, PARSE_EXTENSIONS)


def is_spreadsheet(path: Column) -> Column:
    return has_extension(path, SPREADSHEET_EXTENSIONS) & ~path.startswith(CONVERTED_FOLDER)


def is_csv(path: Column) -> Column:
    return has_extension(path, CSV_EXTENSIONS)


def file_type(path: Column) -> Column:
    """File-type label by extension, ``unknown`` for any other."""
    labels = F.create_map(*[F.lit(v) for suffix, label in FILE_TYPES.items() for v in ("." + suffix, label)])
    return F.coalesce(F.try_element_at(labels, F.lower(extension(path))), F.lit("unknown"))


def is_split_part(path: Column, strict: bool = True) -> Column:
    """Name of a part written by the splitter.

    ``strict`` is the plain LIKE test, in which every underscore stands for any
    one character; otherwise the digits and underscores must really be there.
    """
    if strict:
        return path.like("%_part_%_of_%.pdf")
    return path.rlike(r"_part_\d+_of_\d+\.pdf$")


def stamp(as_of: datetime) -> str:
    """The caller's clock as it appears inside ids."""
    return as_of.strftime("%Y-%m-%d_%H%M%S")


def path_hash(path: Column) -> Column:
    """All 128 bits: a 64-bit part would collide at billions of files."""
    return F.md5(path)


def registry_id(prefix: str, path: Column, as_of: datetime) -> Column:
    return F.concat(F.lit(prefix + "_"), path_hash(path), F.lit("_" + stamp(as_of)))


def document_id(path: Column, as_of: datetime) -> Column:
    return F.concat(F.lit("DOC_" + stamp(as_of) + "_"), path_hash(path))


def part_file_name(name: Column, number: Column, total: Column) -> Column:
    return F.concat(
        strip_extension(name), F.lit("_part_"), number.cast("string"), F.lit("_of_"), total.cast("string"), F.lit(".pdf")
    )


def member_id(parent: Column, kind: str, number: Column) -> Column:
    """Ids of parts, sheets, rows, columns and chunks: parent, kind, number."""
    return F.concat(parent, F.lit(f"_{kind}_"), number.cast("string"))


def table_name(file_name: Column) -> Column:
    """Target table of a CSV file, built from its base name."""
    clean = F.upper(F.regexp_replace(strip_extension(file_name), r"[^\p{L}\p{N}_]", "_"))
    return F.concat(F.lit("CSV_"), F.when(clean.rlike("^[0-9]"), F.lit("T_")).otherwise(F.lit("")), clean)


def display_path(path: Column) -> Column:
    """Long paths keep their last 27 characters behind an ellipsis."""
    return F.when(F.length(path) > 30, F.concat(F.lit("..."), F.right(path, F.lit(27)))).otherwise(path)


def strip_bucket(path: Column) -> Column:
    return F.regexp_replace(path, "^s3://[^/]+/", "")
