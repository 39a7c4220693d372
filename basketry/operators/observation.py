"""What a question's queries returned, as one text.

The results of a question are joined without a separator, in order, so digits at
the end of one result fuse with digits at the start of the next.  A question may
hold any share of all results, and a result may have any length; the text is
therefore kept in parts of exactly `width` characters, but for a question's last,
and questions are asked of the parts so that the answer is that of the whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.text import NUMBER, marks_failure

PART_WIDTH = 1 << 20

_BY_PART = "PARTITION BY id ORDER BY part"


def observation_parts(queries: DataFrame, width: int = PART_WIDTH) -> DataFrame:
    """id, part, observation, is_whole, retries.

    `is_whole` marks the only part of a question; `retries` counts the refused or failed
    queries whose result starts in the part.  A question without any text has no part.
    """
    width = int(width)
    return (
        queries.where("length(result) > 0")
        .withColumn("failed", marks_failure(F.col("result")))
        .withColumn("text_start", F.expr("text_end - length(result)"))
        .selectExpr(
            "*",
            f"explode(sequence(text_start div {width}, (text_end - 1) div {width})) AS part",
        )
        .selectExpr(
            "id",
            "part",
            "texts",
            f"failed AND part = text_start div {width} AS counted",
            f"struct(text_end, substr(result, int(greatest(part * {width} - text_start, 0)) + 1,"
            f" int(least(text_end, (part + 1) * {width}) - greatest(text_start, part * {width})))"
            " AS piece) AS piece",
        )
        .groupBy("id", "part")
        .agg(
            F.sort_array(F.collect_list("piece")).alias("pieces"),
            (F.max("texts") <= width).alias("is_whole"),
            F.count_if("counted").alias("retries"),
        )
        .selectExpr(
            "id", "part", "array_join(pieces.piece, '') AS observation", "is_whole", "retries"
        )
    )


def _entry_state(parts: DataFrame) -> DataFrame:
    """Per part: `skip` leading dots that belong to no number, and whether the part
    starts `in_fraction`, that is, inside a number whose point came before.

    In a run of digits and points every second point ends a number, so it takes
    the count of points since the last break (anything else, or two points in a
    row) to tell.  Only these counts pass through the window, not the texts.
    """
    counted = parts.selectExpr(
        "id",
        "part",
        "right(observation, 1) AS last",
        r"length(regexp_extract(observation, r'^\.+', 0)) AS leading",
        r"observation RLIKE r'[^0-9.]|\.\.' AS broken",
        r"regexp_count(regexp_replace(observation, r'(?s)^.*(?:[^0-9.]\.*|\.\.+)', ''), r'\.')"
        " AS dots_left",
    )
    return (
        counted.selectExpr(
            "*", f"IF(lag(last) OVER ({_BY_PART}) RLIKE '[0-9]', 0, leading) AS skip"
        )
        # Leading dots that are skipped count as a break before the part.
        .selectExpr(
            "*",
            "IF(broken, dots_left, dots_left - skip) AS open_dots",
            "broken OR skip > 0 AS reset",
        )
        .selectExpr("*", f"sum(open_dots) OVER ({_BY_PART}) AS dots")
        .selectExpr(
            "*", f"dots - max(IF(reset, dots - open_dots, 0)) OVER ({_BY_PART}) AS dots_after"
        )
        .selectExpr("*", f"lag(dots_after, 1, 0L) OVER ({_BY_PART}) AS dots_before")
        .selectExpr("id", "part", "skip", "skip = 0 AND dots_before % 2 = 1 AS in_fraction")
    )


def asked_of_parts(parts: DataFrame, asked: DataFrame) -> DataFrame:
    """Parts with what their question expects.

    Joining on the question would gather all its texts; only its part numbers
    meet there, and the texts are joined part by part.
    """
    expected = parts.select("id", "part").join(asked, "id")
    return parts.join(expected, ["id", "part"])


# A piece of a number without what cannot matter: 400 digits make it exceed any double,
# zeros among them keep it so, and decimals beyond the 400th are below any tolerance.
_CLIPPED = r"""regexp_replace(regexp_replace(regexp_replace(piece,
    r'^(-?0{400})0+', '$1'), r'^(-?0*[1-9][0-9]{400})[0-9]+', '$1'), r'([.][0-9]{400})[0-9]+', '$1')"""


def numbers_across(parts: DataFrame) -> DataFrame:
    """id, expected_num, values: all numbers of each question's whole text, in several rows.

    A number that crosses from part to part is put together from its pieces: the
    `tail` one part ends with and the `head` the next begins with, at most some 1,200
    characters of each.
    """
    cut = (
        parts.select("id", "part", "expected_num", "observation")
        .join(_entry_state(parts), ["id", "part"])
        .selectExpr(
            "id",
            "part",
            "expected_num",
            "skip",
            "substr(observation, skip + 1) AS text",
            "IF(in_fraction, regexp_extract(text, r'^[0-9]*', 0),"
            r" regexp_extract(text, r'^(?:[0-9]*\.)?[0-9]*', 0)) AS head",
            "substr(text, length(head) + 1) AS rest",
            # A lone minus may still become a number's sign in the next part.
            rf"regexp_extract_all(rest, r'{NUMBER}|-', 0) AS pieces",
            "coalesce(try_element_at(pieces, -1), '') AS final",
            "IF(endswith(rest, final), final, '') AS tail",
            "filter(IF(tail = '', pieces, slice(pieces, 1, size(pieces) - 1)), p -> p <> '-')"
            " AS inner",
        )
    )
    inside = cut.selectExpr("id", "expected_num", "CAST(inner AS ARRAY<DOUBLE>) AS values")
    crossing = (
        cut.selectExpr(
            "id", "part", "expected_num", "head", "tail",
            "int(skip > 0) AS ends_before", "int(rest <> '') AS ends_in",
        )
        .selectExpr(
            "*",
            f"coalesce(sum(ends_before + ends_in) OVER ({_BY_PART}"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + ends_before AS run",
        )
        .selectExpr(
            "id",
            "expected_num",
            "inline(array(struct(run, part * 2 AS at, head AS piece),"
            " struct(run + ends_in AS run, part * 2 + 1 AS at, tail AS piece)))",
        )
        .where("piece <> ''")
        .withColumn("piece", F.expr(_CLIPPED))
        .groupBy("id", "expected_num", "run")
        .agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("ordered"))
        .selectExpr(
            "id",
            "expected_num",
            f"CAST(regexp_extract_all(array_join(ordered.piece, ''), r'{NUMBER}', 0)"
            " AS ARRAY<DOUBLE>) AS values",
        )
    )
    return inside.unionByName(crossing)


def mentions_across(parts: DataFrame, width: int = PART_WIDTH) -> DataFrame:
    """id, mentioned: whether a question's whole text contains `expected_str`, ignoring case.

    Hits inside a part and hits across seams are looked for separately.  For a seam only
    edges travel, as long as the text looked for fits a part; a longer one is looked for in
    as many parts, put together, as it spans.
    """
    asked = parts.selectExpr(
        "id",
        "part",
        "lower(expected_str) AS wanted",
        "lower(observation) AS text",
        "length(wanted) - 1 AS reach",
        f"int(ceil(reach / {int(width)})) AS spanned",
    )
    inside = asked.selectExpr("id", "contains(text, wanted) AS mentioned")
    edges = asked.where("reach > 0").selectExpr(
        "id",
        "wanted",
        "inline(transform(sequence(0, spanned), back -> struct(part + back AS seam, -back AS at,"
        " CASE WHEN back = 0 THEN left(text, reach) WHEN spanned = 1 THEN right(text, reach)"
        " ELSE text END AS edge)))",
    )
    across = (
        edges.groupBy("id", "seam")
        .agg(F.sort_array(F.collect_list(F.struct("at", "edge"))).alias("edges"), F.first("wanted").alias("wanted"))
        .selectExpr("id", "contains(array_join(edges.edge, ''), wanted) AS mentioned")
    )
    return inside.unionByName(across)
