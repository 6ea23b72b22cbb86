"""Line dedup by spread over sites: lines found on many distinct sites are boilerplate, and only their first occurrence stays."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.common import SPACE, table, tagged
from playtide.session import written

#: Distinct sites from which a line counts as boilerplate.
MIN_SITES = 10
#: A line of this many words hardly comes twice by chance and counts from fewer sites.
LONG_WORDS, LONG_SITES = 16, 5
#: Lines of fewer words than this come by chance in a large corpus and count from a share of all sites.
SHORT_WORDS, SHORT_SHARE = 4, 0.6
#: Sketch size (2^12 registers: 1.6 % standard error) and the share around the threshold within which sites are counted exactly.
LOG_REGISTERS, BAND = 12, 0.15
BLANKS = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def line_rows(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """_row, doc_id, pos, site, number of words and the 128-bit hash of each line that is not blank, without the blanks around it."""
    rows = docs.select(
        "_row", F.col(doc_id).alias("doc_id"), F.col(site).cast("string").alias("site"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(BLANKS))).filter("line != ''")
    return rows.select(
        "_row", "doc_id", "site", "pos", F.size(F.split("line", f"{SPACE}+")).alias("words"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of the lines on enough distinct sites (a null site does not count).

    That is ``min_sites``; LONG_SITES at most for lines of LONG_WORDS words or more, and at least SHORT_SHARE of all sites for lines under
    SHORT_WORDS. One aggregation merges a sketch of sites per line. Estimates clear of the threshold decide; lines within BAND of it
    get an exact count, over distinct (line, site) pairs, so neither a common line nor a large site meets in one task.
    """
    all_sites = lines.select("site").filter("site is not null").distinct().count()
    least = F.when(F.col("words") >= LONG_WORDS, min(min_sites, LONG_SITES)).when(
        F.col("words") < SHORT_WORDS, max(min_sites, math.ceil(SHORT_SHARE * all_sites))).otherwise(min_sites)
    sketched = lines.groupBy(*KEY).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites"), F.max("words").alias("words"))
    spread = written(sketched.withColumn("least", least).filter(F.col("sites") >= F.col("least") * (1 - BAND)), "line-sites")
    clear = F.col("sites") > F.col("least") * (1 + BAND)
    near = spread.filter(~clear).select(*KEY, "least")
    counted = lines.filter("site is not null").join(near, KEY).select(*KEY, "least", "site").distinct().groupBy(*KEY, "least").count()
    return spread.filter(clear).select(*KEY).union(counted.filter(F.col("count") >= F.col("least")).select(*KEY))


def dedup_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, doc_id: str = "doc_id", text: str = "text", site: str = "source",
) -> DataFrame:
    """``docs`` with boilerplate lines (see :func:`boilerplate`) taken out of the text, and the columns n_lines and n_removed.

    The first occurrence of such a line, by (doc_id, row, place), stays, so no passage is lost as a whole. Blank lines stay. A null
    text stays null with 0 lines; a document left without lines has an empty text. Rows with a null doc_id sort first; each row
    loses lines of its own only, also where rows share a doc_id or have none. Columns named n_lines or n_removed are replaced, all
    others stay. An empty table gives an empty table.
    """
    docs = tagged(docs.drop("n_lines", "n_removed"), "line-docs")
    lines = written(line_rows(docs, doc_id, text, site), "lines", compression="zstd")
    spread = written(boilerplate(lines, min_sites), "boilerplate")
    found = lines.join(spread, KEY).select("_row", "doc_id", "pos", *KEY)
    at = F.struct("doc_id", "_row", "pos")
    first = found.groupBy(*KEY).agg(F.min(at).alias("first"))
    removed = found.join(first, KEY).filter(~at.eqNullSafe(F.col("first"))).groupBy("_row").agg(F.collect_set("pos").alias("_gone"))
    split = F.split(text, "\n")
    gone = F.coalesce(F.col("_gone"), F.array().cast("array<int>"))
    kept = F.filter(split, lambda _, i: ~F.array_contains(gone, i))
    return docs.join(removed, "_row", "left").withColumns({
        text: F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")),
        "n_lines": F.coalesce(F.size(split), F.lit(0)),
        "n_removed": F.coalesce(F.size(split) - F.size(kept), F.lit(0)),
    }).drop("_row", "_gone")


def op7_line_dedup(spark, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP7_SQL = f"""
WITH split AS (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
    SELECT * FROM (
        SELECT doc_id, source, i - 1 AS pos, trim(parts[i], {_BLANKS_SQL}) AS line
        FROM (SELECT doc_id, source, parts, unnest(generate_series(1, len(parts))) AS i FROM split)
    ) WHERE line != ''
),
spread AS (
    SELECT line FROM lines GROUP BY line
    HAVING count(DISTINCT source) >= CASE
        WHEN len(string_split_regex(line, '[ \\t-\\r]+')) >= {LONG_WORDS} THEN {LONG_SITES}
        WHEN len(string_split_regex(line, '[ \\t-\\r]+')) < {SHORT_WORDS}
        THEN greatest({MIN_SITES}, (SELECT ceil({SHORT_SHARE} * count(DISTINCT source)) FROM lines))
        ELSE {MIN_SITES} END
),
gone AS (
    SELECT doc_id, pos FROM (
        SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS k
        FROM lines JOIN spread USING (line)
    ) WHERE k > 1
),
by_doc AS (SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, len(parts) AS n_lines, coalesce(len(gone), 0) AS n_removed,
    array_to_string([parts[i] FOR i IN generate_series(1, len(parts)) IF gone IS NULL OR NOT list_contains(gone, i - 1)], chr(10)) AS text
FROM split LEFT JOIN by_doc USING (doc_id)
"""
