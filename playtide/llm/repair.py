"""Cheapest repair of conversations, worked out once per distinct ending of their role/fault signatures.

A turn is one symbol: s, u, a or o by its role's initial (o: any other), in capitals if it is truncated, x if it must go (blank or
duplicate). A conversation's signature is cut into chunks of a bounded number of turns. Equal endings cost the same, so distinct
signatures share their endings in one automaton that is minimised from the end: in the order of the reversed signatures, range-partitioned
over the tasks, each node follows its ending directly, and a task holds just the path of nodes it is at. Cost-to-go, best edits and the
grammar state reached are found once per node and grammar state, for all conversations.

A chunk that others follow ends with what these will cost from each grammar state. Those vectors come from the chunks' tables of costs
between grammar states, carried from the last chunk to the first: one short row per chunk, so one conversation may have any number of turns.
"""

from __future__ import annotations

import math
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playtide.llm.common import numbered, release_memory, table
from playtide.session import written

#: Turns of a chunk, and chunks whose texts are handled at once.
CHUNK, STEP = 64, 128
BLANKS = " \t\n\x0b\x0c\r"
#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn. Each has the role that must or may follow.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT_ROLE = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ROLE_NAMES = {"u": "user", "a": "assistant"}
# What the edits cost.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: What follows the last turn from each state: insertions that complete the grammar.
FINAL = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
#: The end of a signature whose conversation ends there; else four costs, joined by commas (- for one that cannot be).
END = "E"
#: A node: for each grammar state the cost-to-go, the edits from here on, and the state reached by them.
Node = list[tuple[float, str, int]]
TURN = pa.schema([("tree", pa.int64()), ("chunk", pa.int64()), ("place", pa.int32()), ("role", pa.string()), ("text", pa.string())])


def ending(end: str) -> Node:
    """The node behind a signature's last symbol."""
    if end == END:
        return [(cost, edits, ASSISTANT if edits else state) for state, (cost, edits) in enumerate(FINAL)]
    return [(math.inf if c == "-" else float(c), "", state) for state, c in enumerate(end.split(","))]


def before(symbol: str, node: Node) -> Node:
    """The node of an ending that has one more turn in front. Of equally cheap edits the ASCII-least stand first: D, I, K, R."""
    spoilt, role = TRUNCATED * symbol.isupper(), symbol.lower()
    found: Node = []
    for state in range(4):
        cost, edits, end = node[state]
        best = (cost + DELETE, "D" + edits, end)
        if symbol != "x":
            wanted, after = NEXT_ROLE[state]
            if role == "s" and state == START:
                after, keep = SYSTEM, True
            else:
                keep = role == wanted
            if keep:
                cost, edits, end = node[after]
                best = min(best, (cost + spoilt, "K" + edits, end))
            cost, edits, end = node[NEXT_ROLE[state][1]]
            best = min(best, (cost + spoilt + REROLE, "R" + edits, end))
        found.append(best)
    # Insertions stay before the turn; three in a row are never cheaper than deleting it, but may come before a later one.
    for _ in range(4):
        for state in range(4):
            cost, edits, end = found[NEXT_ROLE[state][1]]
            found[state] = min(found[state], (cost + INSERT, "I" + edits, end))
    return found


def _automaton(batches):
    """Costs, edits and states reached for (end, signature) rows in the order of (end, reversed signature)."""
    last, path = None, []
    for batch in batches:
        nodes = []
        for end, signature in zip(batch["end"].to_pylist(), batch["signature"].to_pylist()):
            turned = signature[::-1]
            if last is None or last[0] != end:
                shared, path = 0, [ending(end)]
            else:
                shared = next((i for i, (a, b) in enumerate(zip(last[1], turned)) if a != b), min(len(last[1]), len(turned)))
                del path[shared + 1:]
            for symbol in turned[shared:]:
                path.append(before(symbol, path[-1]))
            last = end, turned
            nodes.append(path[-1])
        yield pa.record_batch([
            batch["end"], batch["signature"], pa.array([[n[0] for n in x] for x in nodes], pa.list_(pa.float64())),
            pa.array([[n[1] for n in x] for x in nodes], pa.list_(pa.string())),
            pa.array([[n[2] for n in x] for x in nodes], pa.list_(pa.int32()))], ["end", "signature", "costs", "edits", "ends"])


def solved(signatures: DataFrame) -> DataFrame:
    """(end, signature, costs, edits, ends) for the distinct (end, signature): one entry for each grammar state before the first turn."""
    items = signatures.select("end", "signature", F.reverse("signature").alias("turned")).distinct()
    ordered = items.repartitionByRange("end", "turned").sortWithinPartitions("end", "turned").select("end", "signature")
    return ordered.mapInArrow(_automaton, "end string, signature string, costs array<double>, edits array<string>, ends array<int>")


def _best(costs: list[float], then: list[float]) -> float:
    return min(a + b for a, b in zip(costs, then))


def _text(costs: list[float]) -> tuple[str, float]:
    least = min(costs)
    return ",".join("-" if math.isinf(c) else str(int(c - least)) for c in costs), least


def _backward(rows: pa.Table) -> pa.Table:
    """What follows each chunk of one conversation, from its table of costs (start state x end state)."""
    rows = rows.sort_by("chunk")
    then, out = None, []
    for table_ in reversed(rows["matrix"].to_pylist()):
        if then is None:
            out.append(END)
            costs = [_best(table_[4 * s:4 * s + 4], [f[0] for f in FINAL]) for s in range(4)]
        else:
            out.append(_text(then)[0])
            costs = [_best(table_[4 * s:4 * s + 4], then) for s in range(4)]
        then = costs
    return pa.table({"tree": rows["tree"], "chunk": rows["chunk"], "end": pa.array(out[::-1], pa.string())})


def _forward(rows: pa.Table) -> pa.Table:
    """The grammar state before each chunk of one conversation, from the states that each chunk leads to."""
    rows = rows.sort_by("chunk")
    state, out = START, []
    for ends in rows["ends"].to_pylist():
        out.append(state)
        state = ends[state]
    return pa.table({"tree": rows["tree"], "chunk": rows["chunk"], "state": pa.array(out, pa.int32())})


def endings(chunks: DataFrame) -> DataFrame:
    """(tree, chunk, end) of ``chunks`` (tree, chunk, chunks, signature)."""
    single = chunks.filter("chunks = 1").select("tree", "chunk", F.lit(END).alias("end"))
    long = chunks.filter("chunks > 1").select("tree", "chunk", "signature")
    units = [",".join("0" if i == k else "-" for i in range(4)) for k in range(4)]
    tables = solved(long.select("signature", F.explode(F.array(*map(F.lit, units))).alias("end")))
    parts = [F.max(F.when(F.col("end") == u, F.col("costs"))) for u in units]
    rows = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: F.array(*[F.get(p, s) for p in (F.col(f"c{k}") for k in range(4))]))
    matrices = written(tables.groupBy("signature").agg(*[p.alias(f"c{k}") for k, p in enumerate(parts)]).select(
        "signature", F.flatten(rows).alias("matrix")), "repair-tables")
    chained = long.join(matrices, "signature").select("tree", "chunk", "matrix").groupBy("tree").applyInArrow(
        _backward, "tree long, chunk long, end string")
    return single.union(chained)


def best_edits(chunks: DataFrame) -> DataFrame:
    """(tree, chunk, state, edits) of ``chunks`` (tree, chunk, chunks, signature): the state before a chunk and its cheapest edits."""
    ended = written(chunks.join(endings(chunks), ["tree", "chunk"]).select("tree", "chunk", "chunks", "end", "signature"), "repair-ends")
    nodes = written(solved(ended), "repair-nodes").select("end", "signature", "edits", "ends")
    found = ended.join(nodes, ["end", "signature"])
    single = found.filter("chunks = 1").select("tree", "chunk", F.lit(START).alias("state"), F.get("edits", F.lit(START)).alias("edits"))
    long = written(found.filter("chunks > 1").select("tree", "chunk", "edits", "ends"), "repair-long", compression="zstd")
    states = long.select("tree", "chunk", "ends").groupBy("tree").applyInArrow(_forward, "tree long, chunk long, state int")
    return single.union(long.join(states, ["tree", "chunk"]).select("tree", "chunk", "state", F.get("edits", "state").alias("edits")))


def apply_edits(state: int, edits: str, turns: list[dict]) -> list[tuple[str, str]]:
    """The repaired (role, text) of a chunk's turns."""
    out, rest = [], iter(turns)
    for edit in edits:
        if edit == "D":
            next(rest)
            continue
        wanted, after = NEXT_ROLE[state]
        role, text = ROLE_NAMES[wanted], ""
        if edit != "I":
            turn = next(rest)
            text = turn["text"]
            if edit == "K":
                role = turn["role"]
                after = SYSTEM if role[:1] == "s" else after
        out.append((role, text))
        state = after
    return out


def _applied(batches):
    """(tree, chunk, repaired turns) of each chunk, some at a time."""
    for batch in batches:
        for i in range(0, len(batch), STEP):
            part = batch.slice(i, STEP)
            yield [(r["tree"], r["chunk"], apply_edits(r["state"], r["edits"], r["turns"])) for r in part.to_pylist()]
    release_memory()


def _pieces(batches):
    """The repaired text of each chunk: its turns as role:text, a line break before each."""
    for rows in _applied(batches):
        pieces = ["".join(f"\n{role}:{text}" for role, text in turns) for _, _, turns in rows]
        yield pa.record_batch([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(pieces, pa.string())],
            ["tree", "chunk", "piece"])


def _turns(batches):
    for rows in _applied(batches):
        flat = [(tree, chunk, i, role, text) for tree, chunk, turns in rows for i, (role, text) in enumerate(turns)]
        yield pa.RecordBatch.from_pylist([dict(zip(TURN.names, r)) for r in flat], TURN)


def _digests(batches):
    """sha256 of the pieces of each tree, which arrive in order; only the hash's state is held."""
    at, digest = None, None
    for batch in batches:
        done = []
        for i in range(len(batch)):
            tree, piece = batch["tree"][i].as_py(), batch["piece"][i].as_py().encode()
            if tree != at:
                if digest is not None:
                    done.append((at, digest[0].hexdigest()))
                at, digest = tree, [sha256(), True]
            if piece:
                digest[0].update(piece[1:] if digest[1] else piece)
                digest[1] = False
        yield pa.record_batch([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["tree", "digest"])
    if digest is not None:
        yield pa.record_batch([pa.array([at], pa.int64()), pa.array([digest[0].hexdigest()], pa.string())], ["tree", "digest"])


def trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def with_faults(rows: DataFrame) -> DataFrame:
    """Numbered turns (tree, pos, role, text, …) with ``fault``: blank, duplicate, truncated or null, the first that holds."""
    key = [F.col("role"), F.sha2(F.col("text").cast("binary"), 256).alias("_text")]
    again = written(rows.select("tree", "pos", *key).groupBy("tree", "role", "_text").agg(
        F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_times")).filter("_times > 1").drop("_times"), "repair-repeated")
    told = rows.withColumn("_text", key[1]).join(again, ["tree", "role", "_text"], "left").drop("_text")
    last = F.right(trimmed(F.col("text")), F.lit(1))
    return told.withColumn("fault", F.when(trimmed(F.col("text")) == "", "blank").when(
        F.col("pos") > F.col("_first"), "duplicate").when(~last.isin(".", "!", "?"), "truncated")).drop("_first")


def symbol(role: Column, fault: Column) -> Column:
    initial = F.left(role, F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper(known)).otherwise(known)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every conversation of ``rows`` with its faults, cheapest edits and repaired turns.

    Returns conv_id; gaps (turn numbers missing between the least and the greatest), blank, duplicate, truncated, illegal (neighbouring
    turns whose roles' initials are not su, ua or au), cost, all long; audit, a letter per edit: Keep, Delete, Rerole, Insert; and digest, the
    sha256 of the repaired turns as role:text lines. The repaired roles match (s?(ua)+)?; of equally cheap edits the ASCII-least are
    taken. Turns are in the order of their number, nulls first, equal ones by role and text. Null roles and texts count as one blank.
    Rows without a conv_id are one conversation. Repeated rows are duplicates. Other columns are not read; an empty table
    gives an empty table. A conversation may have any number of turns; only its audit must fit into a row.
    """
    told, chunks = _chunked(rows, conv_id, turn, role, text)
    edits = written(best_edits(chunks.select("tree", "chunk", "chunks", "signature")), "repair-edits", compression="zstd")
    digests = _repaired_pieces(told, edits).repartition("tree").sortWithinPartitions("tree", "chunk").mapInArrow(_digests, "tree long, digest string")
    return _summary(chunks, edits).join(digests, "tree").select("conv_id", *COUNTS, "cost", "audit", "digest")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def repaired_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations themselves: (conv_id, chunk, place, role, text), in order of (chunk, place) within conv_id."""
    told, chunks = _chunked(rows, conv_id, turn, role, text)
    edits = written(best_edits(chunks.select("tree", "chunk", "chunks", "signature")), "repair-edits", compression="zstd")
    turns = _with_turns(told, edits).mapInArrow(_turns, "tree long, chunk long, place int, role string, text string")
    ids = chunks.filter("chunk = 0").select("tree", "conv_id")
    return turns.join(ids, "tree").select("conv_id", "chunk", "place", "role", "text")


def _chunked(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The numbered turns with faults, and a row per chunk with its signature and sums."""
    told = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    told = numbered(told, ["conv_id"], ["turn", "role", "text", "_row"], "repair-turns").withColumn("chunk", F.floor(F.col("pos") / CHUNK))
    told = written(with_faults(told.drop("_row")), "repair-faults", compression="zstd")
    initial = F.left("role", F.lit(1))
    one = F.struct("pos", symbol(F.col("role"), F.col("fault")).alias("symbol"), initial.alias("initial"), "turn")
    chunks = told.groupBy("tree", "conv_id", "n", "chunk").agg(
        F.sort_array(F.collect_list(one)).alias("rows"), *(F.count_if(F.col("fault") == f).alias(f) for f in COUNTS[1:4]))
    pairs = F.zip_with(F.col("rows.initial"), F.slice("rows.initial", F.lit(2), F.size("rows")), lambda a, b: F.concat(a, b))
    legal = ("su", "ua", "au")
    numbers = F.array_distinct(F.filter("rows.turn", lambda t: t.isNotNull()))
    return told, written(chunks.select(
        "tree", "conv_id", "chunk", F.ceil(F.col("n") / CHUNK).alias("chunks"), *COUNTS[1:4], F.array_join("rows.symbol", "").alias("signature"),
        F.size(F.filter(pairs, lambda p: p.isNotNull() & ~p.isin(*legal))).cast("long").alias("illegal"),
        F.size(numbers).cast("long").alias("turns"), F.array_min(numbers).alias("least"), F.array_max(numbers).alias("most"),
        F.element_at("rows.initial", 1).alias("first_role"), F.element_at("rows.initial", -1).alias("last_role")), "repair-chunks")


def _with_turns(told: DataFrame, edits: DataFrame) -> DataFrame:
    turns = told.groupBy("tree", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
    return turns.join(edits, ["tree", "chunk"])


def _repaired_pieces(told: DataFrame, edits: DataFrame) -> DataFrame:
    return _with_turns(told, edits).mapInArrow(_pieces, "tree long, chunk long, piece string")


def _summary(chunks: DataFrame, edits: DataFrame) -> DataFrame:
    """Sums over the chunks of each conversation; what crosses two chunks is taken from their first and last turns."""
    order = Window.partitionBy("tree").orderBy("chunk")
    sums = chunks.withColumns({"_role": F.lag("last_role").over(order), "_turn": F.lag("most").over(order)})
    crossing = F.col("_role").isNotNull() & ~F.concat("_role", "first_role").isin("su", "ua", "au")
    sums = sums.join(edits, ["tree", "chunk"]).withColumns({
        "illegal": F.col("illegal") + crossing.cast("long"),
        "turns": F.col("turns") - F.coalesce((F.col("_turn") == F.col("least")).cast("long"), F.lit(0)),
        "cost": _cost(F.col("edits"), F.col("signature"))})
    gaps = F.coalesce(F.max("most") - F.min("least") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps")
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "edits"))), lambda x: x["edits"]), "").alias("audit")
    return sums.groupBy("tree", "conv_id").agg(gaps, *(F.sum(c).alias(c) for c in (*COUNTS[1:], "cost")), audit)


def _cost(edits: Column, signature: Column) -> Column:
    """Cost of a chunk's edits: those that are no insertion stand for its turns, one by one."""
    own = F.split(F.replace(edits, F.lit("I"), F.lit("")), "")
    spoilt = F.zip_with(own, F.split(signature, ""), lambda e, s: F.when(e.isin("K", "R") & s.isin("S", "U", "A", "O"), TRUNCATED).otherwise(0))
    edit = lambda e: F.when(e == "D", DELETE).when(e == "I", INSERT).when(e == "R", REROLE).otherwise(0)
    total = lambda items: F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + x)
    return total(spoilt) + total(F.transform(F.split(edits, ""), edit))


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the contract: by crc32 of conv_id:turn, modulo 20, rows are dropped, emptied, cut, repeated or given to the user.

    Nulls, also those of conv_id and turn in the hashed text, stand for one blank.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def op12_conversation_repair(spark, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    found = repair(damaged(rows)).withColumnRenamed("conv_id", "id")
    whole = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    return whole.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*COUNTS, "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.lit(sha256().hexdigest())).alias("repaired_sha256"))
