"""The game's stage catalogue as a small dimension table (50 rows, safe to broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.functions import rounded

# Id, rows, cols, windiness, distractor level, hints, blockers. Ten stages make a chapter.
STAGES = (
    (1, 3, 3, 0.0, 1, 3, 0), (2, 3, 3, 0.0, 1, 2, 0), (3, 3, 3, 0.1, 1, 2, 0), (4, 3, 3, 0.1, 1, 1, 0),
    (5, 3, 3, 0.15, 1, 1, 0), (6, 3, 3, 0.2, 1, 1, 0), (7, 3, 3, 0.2, 2, 1, 0), (8, 3, 3, 0.25, 2, 0, 0),
    (9, 3, 3, 0.3, 2, 0, 0), (10, 3, 3, 0.35, 2, 0, 0),
    (11, 3, 4, 0.2, 1, 2, 0), (12, 3, 4, 0.25, 2, 1, 0), (13, 4, 3, 0.25, 2, 1, 0), (14, 4, 3, 0.3, 2, 1, 0),
    (15, 4, 4, 0.3, 2, 1, 0), (16, 4, 4, 0.35, 2, 0, 0), (17, 4, 4, 0.35, 2, 0, 0), (18, 4, 4, 0.4, 2, 0, 0),
    (19, 4, 4, 0.4, 2, 0, 1), (20, 4, 4, 0.45, 2, 0, 1),
    (21, 4, 4, 0.4, 2, 0, 1), (22, 4, 4, 0.45, 2, 0, 1), (23, 4, 4, 0.45, 2, 0, 1), (24, 4, 4, 0.5, 2, 0, 1),
    (25, 4, 4, 0.5, 3, 0, 1), (26, 4, 4, 0.55, 3, 0, 2), (27, 4, 4, 0.55, 3, 0, 2), (28, 4, 4, 0.6, 3, 0, 2),
    (29, 4, 4, 0.6, 3, 0, 2), (30, 4, 4, 0.65, 3, 0, 3),
    (31, 4, 5, 0.5, 2, 0, 2), (32, 5, 4, 0.5, 2, 0, 2), (33, 5, 5, 0.55, 3, 0, 2), (34, 5, 5, 0.55, 3, 0, 2),
    (35, 5, 5, 0.6, 3, 0, 3), (36, 5, 5, 0.6, 3, 0, 3), (37, 5, 5, 0.65, 3, 0, 3), (38, 5, 5, 0.7, 3, 0, 3),
    (39, 5, 5, 0.7, 3, 0, 4), (40, 5, 5, 0.75, 3, 0, 4),
    (41, 5, 5, 0.7, 3, 0, 3), (42, 5, 5, 0.7, 3, 0, 4), (43, 5, 5, 0.75, 3, 0, 4), (44, 5, 5, 0.75, 3, 0, 4),
    (45, 5, 5, 0.8, 3, 0, 5), (46, 5, 5, 0.8, 3, 0, 5), (47, 5, 5, 0.85, 3, 0, 5), (48, 5, 5, 0.9, 3, 0, 5),
    (49, 5, 5, 0.95, 3, 0, 6), (50, 5, 5, 1.0, 3, 0, 6),
)
CHAPTERS = 5
STAGES_PER_CHAPTER = 10

_FIELDS = "id int, rows int, cols int, windiness double, distractor int, hints int, blockers int"


def dim_stage(spark: SparkSession) -> DataFrame:
    """The catalogue with chapter, number within the chapter, both id forms and the shown difficulty (1 to 5)."""
    weight = F.col("windiness") * 2.5 + F.col("distractor") * 0.7 + F.col("blockers") * 0.3
    chapter = F.ceil(F.col("id") / STAGES_PER_CHAPTER).cast("int")
    number = F.pmod(F.col("id") - 1, F.lit(STAGES_PER_CHAPTER)) + 1
    return spark.createDataFrame(STAGES, _FIELDS).withColumns({
        "chapter": chapter,
        "stage_no": number,
        "stage_id": F.concat_ws("-", chapter, number),
        "grid_size": F.concat_ws("x", "rows", "cols"),
        "difficulty": F.least(F.lit(5), rounded(weight, 0, "half_up").cast("int")),
    })
