"""Raw sales files (CSV with a header row) as eight text columns."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.cells import missing_to_null
from basketry.schema import RAW_COLUMNS


_ODD_LINE = "_line_of_another_width"


def files_with_quoted_newlines(spark: SparkSession, path: str) -> list[str]:
    """The files in which some quoted field may span lines.

    A field that does leaves an odd number of quotes on the line it opens on, so a
    file without an odd line has none.  One row per such file comes back.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = spark.read.text(path).where(quotes % 2 == 1)
    return sorted(r[0] for r in odd.select(F.input_file_name()).distinct().collect())


# What is known of a line besides its cells.
PLACES = ["line_reason", "source_file", "source_block"]


def _scan(spark: SparkSession, paths: str | list[str], multi_line: bool, places: bool = False) -> DataFrame:
    """One scan.  A line with more cells than the header is an error; missing cells are NULL.

    With `places` such a line has a `line_reason` instead, and every line its file and the
    first byte of the block it was read in.
    """
    options = {"header": True, "enforceSchema": False, "quote": '"', "escape": '"', "multiLine": multi_line}
    names = spark.read.csv(paths, inferSchema=False, **options).columns
    cells = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    # Lines of another width come with their text in the last column.
    reader = spark.read.schema(f"{cells}, `{_ODD_LINE}` string").option("columnPruning", False)
    rows = reader.csv(paths, columnNameOfCorruptRecord=_ODD_LINE, **options)
    wider = ", ".join(f"c{k} string" for k in range(len(names) + 1))
    beyond = F.from_csv(F.col(_ODD_LINE), wider, {"quote": '"', "escape": '"'})[f"c{len(names)}"]
    wider_line = F.concat(F.lit("a line has cells beyond the header: "), F.col(_ODD_LINE))
    if places:
        return rows.select(
            *[F.col(f"`{name}`") for name in names],
            F.when(beyond.isNotNull(), wider_line).alias("line_reason"),
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("source_block"),
        )
    error = F.raise_error(wider_line)
    first = F.when(beyond.isNotNull(), error.cast("string")).otherwise(F.col(f"`{names[0]}`"))
    return rows.select(first.alias(names[0]), *[F.col(f"`{name}`") for name in names[1:]])


def read_raw(
    spark: SparkSession, path: str, multi_line: bool | None = None, places: bool = False
) -> DataFrame:
    """Scan raw files; every cell is text, missing-value tokens are NULL.

    Columns are found by header name and every file must have the same header.
    `multi_line=True` reads fields that contain line breaks, at the price of one
    task per file; `False` lets Spark split large files.  `None` looks first and
    decides per file: those that may hold such fields are read whole, the others split.
    `places` adds `line_reason`, `source_file` and `source_block`, for `silver.examined`.
    """
    if multi_line is None:
        odd = files_with_quoted_newlines(spark, path)
        every = sorted(map(unquote, spark.read.text(path).inputFiles()))
        whole = [f for f in every if _plain(f) in {_plain(o) for o in odd}]
        split = [f for f in every if f not in whole]
        scans = [_scan(spark, files, flag, places) for files, flag in ((whole, True), (split, False)) if files]
        raw = scans[0] if len(scans) == 1 else scans[0].unionByName(scans[1])
    else:
        raw = _scan(spark, path, multi_line, places)
    absent = [name for name in RAW_COLUMNS if name not in raw.columns]
    if absent:
        raise ValueError(f"raw file lacks columns {absent}; it has {raw.columns}")
    return normalise(raw, PLACES if places else [])


def _plain(path: str) -> str:
    """A file's path without escapes and with one slash after its scheme."""
    return re.sub("^([a-z]+):/+", r"\1:/", unquote(path))


def normalise(raw: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """The eight raw columns with every missing-value token turned into NULL."""
    return raw.selectExpr([f"{missing_to_null(name)} AS `{name}`" for name in RAW_COLUMNS] + (carried or []))
