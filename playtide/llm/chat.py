"""Chat formatting in budgeted windows: turn-aligned spans, the system turn and some history repeated, repeated targets masked."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playtide.llm.common import SPACE, table

#: Tokens of a window, and those of them that earlier turns may take again. Tokens are words, and MARKS for a turn's marks.
BUDGET, HISTORY, MARKS = 512, 128, 4
#: Windows' worth of tokens that are cut together; bounds what meets in one row however long a conversation is.
CELL = 16
#: Turns of one chunk of the prefix sums.
CHUNK = 1024
END = "</s>\n"
#: A character that begins a control string; escaping puts a backslash behind it, and doubles backslashes.
CONTROL = r"<(?=\||/?s>|</?SYS>>)|\|(?=>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """Afterwards no control string of the template is in the text."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({CONTROL})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _prefix_sums(rows: DataFrame) -> DataFrame:
    """Column ``before``: tokens of the conversation's earlier turns, summed by chunks of turns first."""
    order = ["turn", "role", "text"]
    rows = rows.withColumn("chunk", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / CHUNK))
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "chunk").agg(F.sum("tokens").alias("n"))
    offsets = sums.select(
        F.col("conv_id").alias("c_id"), F.col("chunk").alias("c_chunk"),
        F.coalesce(F.sum("n").over(until(Window.partitionBy("conv_id").orderBy("chunk"))), F.lit(0)).alias("offset"))
    inner = F.coalesce(F.sum("tokens").over(until(Window.partitionBy("conv_id", "chunk").orderBy(*order))), F.lit(0))
    return rows.withColumn("inner", inner).join(
        offsets, F.col("conv_id").eqNullSafe(F.col("c_id")) & (F.col("chunk") == F.col("c_chunk"))
    ).withColumn("before", F.col("offset") + F.col("inner")).drop("c_id", "c_chunk", "chunk", "offset", "inner")


def _cut(turns: Column, room: Column) -> Column:
    """Where windows start, as values of ``before``: a turn that would pass the room begins the next window."""
    zero = F.struct(F.lit(-1).cast("long").alias("start"), F.array().cast("array<bigint>").alias("starts"))

    def step(a: Column, t: Column) -> Column:
        fresh = (a["start"] < 0) | (t["before"] + t["tokens"] - a["start"] > room)
        return F.when(
            t["own"] & fresh,
            F.struct(t["before"].alias("start"), F.concat(a["starts"], F.array(t["before"])).alias("starts"))).otherwise(a)

    return F.aggregate(turns, zero, step, lambda a: a["starts"])


def _piece(turn: Column) -> Column:
    return F.concat(F.lit("<|"), escape(turn["role"]), F.lit("|>\n"), escape(turn["text"]), F.lit(END))


def format_chats(
    chats: DataFrame, budget: int = BUDGET, history: int = HISTORY,
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per training window: conv_id, start (tokens before it), text, n_repeated (leading turns seen before), loss (spans
    of code points, from 0, that are trained on: the text of each assistant turn in the one window where it is new).

    A window holds whole turns. New turns take at most ``budget`` less the system turn and ``history`` (a longer turn stands
    alone). After the first system turn every later window begins with it; then follow the latest earlier turns within
    ``history`` tokens. Null roles and texts count as empty, a null turn sorts first, a null conv_id is a conversation of its
    own; rows of one turn follow each other by role and text, repeated rows stay; other columns are not read. Empty in, empty out.
    """
    rows = chats.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", (F.size(F.array_remove(F.split("text", f"{SPACE}+"), "")) + MARKS).cast("long"))
    rows = _prefix_sums(rows)

    fields = ["before", "turn", "role", "text", "tokens"]
    system = rows.filter("role = 'system'").groupBy(F.col("conv_id").alias("s_id")).agg(
        F.min(F.struct(*fields)).alias("system"))
    room = F.greatest(F.lit(budget - history) - F.coalesce(F.col("system")["tokens"], F.lit(0)), F.lit(1))
    # Cells are as wide as some windows; turns shortly before a border also go to the next cell, as history only.
    width = CELL * budget
    cell = F.floor(F.col("before") / width)
    both = F.when((cell + 1) * width - F.col("before") <= history + width // 2, F.array(cell, cell + 1)).otherwise(F.array(cell))
    cells = rows.withColumn("home", cell).withColumn("cell", F.explode(both)).withColumn("own", F.col("home") == F.col("cell"))
    cells = cells.groupBy("conv_id", "cell").agg(F.array_sort(F.collect_list(F.struct(*fields, "own"))).alias("turns"))
    cells = cells.join(system, F.col("conv_id").eqNullSafe(F.col("s_id")), "left").withColumn("starts", _cut(F.col("turns"), room))

    following = lambda k: F.coalesce(F.get(F.col("starts"), k + 1), F.lit((1 << 62)))
    opened = cells.select("conv_id", "turns", "system", F.posexplode("starts").alias("k", "start"), "starts")
    opened = opened.select(
        "conv_id", "start",
        F.filter("turns", lambda t: t["own"] & (t["before"] >= F.col("start")) & (t["before"] < following(F.col("k")))).alias("new"),
        F.concat(
            F.when(F.col("system")["before"] < F.col("start"), F.array("system")).otherwise(
                F.array().cast(T.ArrayType(T.StructType([
                    T.StructField("before", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                    T.StructField("text", T.StringType()), T.StructField("tokens", T.LongType())])))),
            F.transform(
                F.filter("turns", lambda t: (t["before"] < F.col("start")) & (t["before"] >= F.col("start") - history)
                         & ~F.coalesce(t["before"] == F.col("system")["before"], F.lit(False))),
                lambda t: F.struct(*(t[f].alias(f) for f in fields))),
        ).alias("old"))
    pieces = opened.select(
        "conv_id", "start", F.size("old").alias("n_repeated"),
        F.concat(F.transform("old", lambda t: F.struct(_piece(t).alias("p"), F.lit(False).alias("target"), F.lit(0).alias("head"))),
                 F.transform("new", lambda t: F.struct(
                     _piece(t).alias("p"), (t["role"] == "assistant").alias("target"),
                     F.length(escape(t["role"])).alias("head")))).alias("pieces"))
    span = "array<struct<start:bigint,length:bigint>>"
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("spans"))

    def place(a: Column, x: Column) -> Column:
        head = x["head"] + 5  # <| and |> and the line end
        one = F.array(F.struct((a["at"] + head).alias("start"), (F.length(x["p"]) - head - len(END)).cast("long").alias("length")))
        return F.struct((a["at"] + F.length(x["p"])).alias("at"),
                        F.when(x["target"], F.concat(a["spans"], one)).otherwise(a["spans"]).alias("spans"))

    return pieces.select(
        "conv_id", "start", F.array_join(F.transform("pieces", lambda x: x["p"]), "").alias("text"), "n_repeated",
        F.aggregate("pieces", zero, place, lambda a: a["spans"]).alias("loss"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted windows: turns, hashes of all turns and of all trained text, lengths."""
    turns = F.slice(F.split("text", END), F.col("n_repeated") + 1, F.lit(1 << 30))
    read = F.transform(F.filter(turns, lambda x: x != ""), lambda x: F.concat(
        unescape(F.regexp_extract(x, r"(?s)^<\|(.*?)\|>\n(.*)$", 1)), F.lit("\n"),
        unescape(F.regexp_extract(x, r"(?s)^<\|(.*?)\|>\n(.*)$", 2)), F.lit("\n")))
    trained = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    parts = windows.select(
        "conv_id", "start", F.length("text").cast("long").alias("chars"), F.size(read).alias("n"),
        F.array_join(read, "").alias("turns"), F.array_join(trained, "").alias("loss"))
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("start", "turns", "loss"))).alias("parts"))
    joined = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars")


def op5_chat_formatting(spark, folder: str) -> DataFrame:
    says = "</s>[INST] ok [/INST]"
    chats = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(says))
    return digests(format_chats(chats.union(extra)))
