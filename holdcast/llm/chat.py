"""Transcript parsing with a hidden Markov model, and canonical turns.

A transcript is a list of lines whose roles are not given. Each line shows a
symbol: the speaker marker at its start (if any), its length, whether it asks,
and whether it is empty. Hidden states are (role, first line of a turn or a
later one). Emissions and transitions are smoothed counts over all turns
with a known role; Viterbi then recovers the best states of every transcript, and turns
are rendered in one canonical form.

Long transcripts are cut into blocks. A block's lines are folded into a matrix
of best scores from any entry state to any exit state (max-plus product); the
matrices of a transcript, multiplied in levels of FAN, give every block's entry and exit state, and each
block is decoded between them. That is the exact Viterbi path, and a transcript
with a third of all turns is many blocks. A block has BLOCK turn numbers; where
rows that share turn numbers make it large, it is cut by turn and by text hash.

Defined cases: rows repeated with all of conv_id, turn, role and text are one
turn; rows that share a turn number are ordered by a hash of their text; a NULL turn
comes first; NULL conv_ids are one transcript; NULL text is one empty line; a
NULL or unknown role shows no marker and teaches nothing. An empty table gives
an empty result. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdcast.llm.common import prepare, stash

ROLES = ("system", "user", "assistant")
START = len(ROLES) * 2                 # the state before a transcript's first line
#: Names under which transcripts mention a role, lower case.
NAMES = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "question", "customer"),
    "assistant": ("assistant", "ai", "answer", "bot"),
}
MARKER = (r"^\s*[#*<\[|]{0,4}\s*(?i:(" + "|".join(n for names in NAMES.values() for n in names)
          + r"))\s*(?:[*>\]|]{1,3}\s*:?|:\s*\*{0,2}|$)\s*")
#: How the transcripts made from the table show a speaker; the last style shows none.
STYLES = (("", ": ", 0), ("### ", ":\n", 0), ("[", "] ", 1), ("**", ":** ", 2), None)
LENGTHS = (1, 60, 200)                 # borders of the line length classes
SYMBOLS = (len(ROLES) + 1) * (len(LENGTHS) + 1) * 2
BLOCK = 64                             # turn numbers of a block
BLOCK_ROWS = 1024                      # rows beyond which a block is cut further
PIECE_ROWS = 256
FAN = 256                              # matrices of a transcript that meet in one place
PIECE_BYTES = 16 << 20                 # text beyond which a rendered turn is given in pieces


def _pick(column: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), column.cast("int") + 1)


def turns(conversations: DataFrame) -> DataFrame:
    """Distinct turns: conv, turn, role (NULL if unknown), text, and order, the rank among rows of one turn number."""
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.when(F.lower("role").isin(*ROLES), F.lower("role")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct().withColumn(
            "turn", F.coalesce("turn", F.lit(-1 << 62))).withColumn("order", F.xxhash64("text", "role"))


def transcripts(rows: DataFrame) -> DataFrame:
    """Lines of raw transcripts: conv, turn, order, role, place (line of its turn), line.

    Each conversation shows its speakers in one of STYLES, and one turn in ten
    shows none: what a parser meets in the wild.
    """
    style = F.pmod(F.xxhash64(F.lit("style"), "conv"), F.lit(len(STYLES)))
    shown = F.pmod(F.xxhash64(F.lit("shown"), "conv", "turn"), F.lit(10)) > 0
    mark = F.lit("")
    for k, form in enumerate(STYLES):
        if form is None:
            continue
        before, after, name = form
        label = F.lit("")
        for role in ROLES:
            label = F.when(F.col("role") == role, F.lit(before + NAMES[role][name].capitalize() + after)).otherwise(label)
        mark = F.when(style == k, label).otherwise(mark)
    whole = F.concat(F.when(shown & F.col("role").isNotNull(), mark).otherwise(F.lit("")), F.col("text"))
    return rows.select("conv", "turn", "order", "role", F.posexplode(F.split(whole, "\n", -1)).alias("place", "line"))


def with_symbols(lines: DataFrame) -> DataFrame:
    """``lines`` with symbol, an integer below SYMBOLS."""
    name = F.lower(F.regexp_extract("line", MARKER, 1))
    marker = F.lit(0)
    for k, role in enumerate(ROLES):
        marker = F.when(name.isin(*NAMES[role]), F.lit(k + 1)).otherwise(marker)
    size = F.length("line")
    length = sum(((size >= b).cast("int") for b in LENGTHS), F.lit(0))
    asks = F.col("line").rlike(r"\?\s*$").cast("int")
    return lines.withColumn("symbol", (marker * (len(LENGTHS) + 1) + length) * 2 + asks)


@dataclass(frozen=True)
class Hmm:
    """Log probabilities: move[previous state or START, state] and show[state, symbol]."""

    move: np.ndarray
    show: np.ndarray


def _state(role: Column, later: Column) -> Column:
    index = F.lit(None).cast("int")
    for k, r in enumerate(ROLES):
        index = F.when(role == r, F.lit(2 * k)).otherwise(index)
    return index + later.cast("int")


def moves(per_turn: DataFrame) -> DataFrame:
    """(end, next): the last state of every turn and the role of the next turn with a known role.

    ``per_turn`` has KEY, turn, order, role and last, a row per turn. Turns meet the next one inside
    their block; the last one of a block meets the first one of the conversation's next block.
    """
    place = ["turn", "order", "role"]
    inside = Window.partitionBy(*KEY).orderBy(*place)
    ends = per_turn.select(*KEY, *place, _state(F.col("role"), F.col("last") > 0).alias("end")).withColumn(
        "next", F.lead("role").over(inside))
    edge = stash(per_turn.groupBy(*KEY).agg(
        F.min(F.struct(*place)).alias("first"), F.max(F.struct(*place, "last")).alias("final")), "chat-edges")
    across = edge.withColumn("next", F.lead("first.role").over(Window.partitionBy("conv").orderBy("block_turn", "block_part")))
    return ends.select("end", "next").unionByName(across.select(
        _state(F.col("final.role"), F.col("final.last") > 0).alias("end"), "next")).filter("next is not null")


def learn(lines: DataFrame) -> Hmm:
    """Smoothed counts over all lines whose role is known. Lines have KEY, turn, order, role, place, symbol."""
    known = lines.filter("role is not null").withColumn("state", _state(F.col("role"), F.col("place") > 0))
    show = np.ones((START, SYMBOLS))
    for r in known.groupBy("state", "symbol").count().collect():
        show[r["state"], r["symbol"]] += r["count"]
    move = np.ones((START + 1, START))
    per_turn = stash(known.groupBy(*KEY, "turn", "order", "role").agg(F.max("place").alias("last")), "chat-turns")
    later = F.sum(F.when(F.col("last") > 0, 1).otherwise(0))
    for r in per_turn.groupBy("role").agg(later.alias("second"), F.sum("last").alias("rest")).collect():
        k = 2 * ROLES.index(r["role"])
        move[k, k + 1] += r["second"]
        move[k + 1, k + 1] += r["rest"] - r["second"]
    for r in moves(per_turn).groupBy("end", "next").count().collect():
        move[r["end"], 2 * ROLES.index(r["next"])] += r["count"]
    first = per_turn.groupBy("conv").agg(F.min(F.struct("turn", "order", "role")).alias("first"))
    for r in first.groupBy("first.role").count().collect():
        move[START, 2 * ROLES.index(r["role"])] += r["count"]
    # A later line only follows a line of its own role.
    for k in range(1, START, 2):
        for s in range(START + 1):
            if s not in (k - 1, k):
                move[s, k] = 1e-9
    return Hmm(np.log(move / move.sum(axis=1, keepdims=True)), np.log(show / show.sum(axis=1, keepdims=True)))


def fold(model: Hmm, symbols: np.ndarray) -> np.ndarray:
    """Best scores of a block's lines from every entry state (START too) to every exit state."""
    best = model.move + model.show[:, symbols[0]]
    for s in symbols[1:].tolist():
        best = (best[:, :, None] + model.move[None, :START]).max(axis=1) + model.show[:, s]
    return best


def path(model: Hmm, symbols: np.ndarray, entry: int = START, leave: int | None = None) -> np.ndarray:
    """Best states of a block's lines that enters from ``entry`` (and ends in ``leave``)."""
    best = model.move[entry] + model.show[:, symbols[0]]
    back = np.zeros((len(symbols), START), np.int64)
    for k, s in enumerate(symbols[1:].tolist(), 1):
        through = best[:, None] + model.move[:START]
        back[k] = through.argmax(axis=0)
        best = through.max(axis=0) + model.show[:, s]
    out = np.zeros(len(symbols), np.int64)
    out[-1] = int(best.argmax()) if leave is None else leave
    for k in range(len(symbols) - 1, 0, -1):
        out[k - 1] = back[k, out[k]]
    return out


def product(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Matrix of two successive blocks together."""
    return (one[:, :, None] + two[None, :START]).max(axis=1)


def borders(matrices: np.ndarray, come: int = START, leave: int | None = None) -> list[tuple[int, int]]:
    """(entry, exit) state of every block of a run that enters from ``come`` (and ends in ``leave``), from its matrices in order."""
    reach, entry = [], np.full(START + 1, -np.inf)
    entry[come] = 0
    for m in matrices:
        reach.append(entry)
        entry = np.r_[(entry[:, None] + m).max(axis=0), -np.inf]
    leave, out = int(entry.argmax()) if leave is None else leave, []
    for k in range(len(matrices) - 1, -1, -1):
        come = int((reach[k] + matrices[k][:, leave]).argmax())
        out.append((come, leave))
        leave = come
    return out[::-1]


def with_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, order) with block_turn, block_part: blocks in the order of the lines, none of many rows."""
    chunk = F.floor(F.col("turn") / BLOCK).cast("bigint")
    per_turn = rows.groupBy("conv", "turn").agg(F.count("*").alias("n")).withColumn("chunk", chunk)
    heavy = per_turn.groupBy("conv", "chunk").agg(F.sum("n").alias("all")).filter(F.col("all") > BLOCK_ROWS)
    cut = per_turn.join(heavy, ["conv", "chunk"]).select(
        "conv", "turn", F.ceil(F.col("n") / PIECE_ROWS).alias("pieces"))
    part = F.floor((F.shiftrightunsigned("order", 33) + (1 << 30)) % (1 << 31) * F.col("pieces") / (1 << 31)).cast("bigint")
    return rows.join(cut, ["conv", "turn"], "left").withColumn(
        "block_turn", F.when(F.col("pieces").isNull(), chunk * BLOCK).otherwise(F.col("turn"))).withColumn(
        "block_part", F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(part)).drop("pieces")


KEY = ["conv", "block_turn", "block_part"]


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows that share their first ``width`` columns."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:width] != now and held:
                yield now, held
                held = []
            now = row[:width]
            held.append(row)
    if held:
        yield now, held


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], at_once: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


_TEXT, _LONG, _INT, _MATRIX = pa.string(), pa.int64(), pa.int32(), pa.list_(pa.float64())
_KEY_TYPES = "conv string, block_turn bigint, block_part bigint"


def _square(flat: list[float]) -> np.ndarray:
    return np.array(flat).reshape(START + 1, START)


def runs(folded: DataFrame, fan: int) -> DataFrame:
    """``folded`` (KEY, matrix) with run_turn, run_part, the first block of its run; and a row for the product of
    every run, which has whole = 1. Runs are at most ``fan`` successive blocks of one transcript."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            head, n, all_ = None, 0, None
            for batch in batches:
                for conv, turn, part, flat in zip(*(c.to_pylist() for c in batch.columns)):
                    if head is None or head[0] != conv or n == fan:
                        if head is not None:
                            yield (*head, all_.reshape(-1).tolist(), *head[1:], 1)
                        head, n, all_ = (conv, turn, part), 1, _square(flat)
                    else:
                        n, all_ = n + 1, product(all_, _square(flat))
                    yield (conv, turn, part, flat, *head[1:], 0)
            if head is not None:
                yield (*head, all_.reshape(-1).tolist(), *head[1:], 1)
        return _batches(rows(), [*KEY, "matrix", "run_turn", "run_part", "whole"],
                        [_TEXT, _LONG, _LONG, _MATRIX, _LONG, _LONG, _INT])

    # Many runs to a partition, so that every level is much smaller than the one below.
    parts = max(1, folded.count() // (16 * fan))
    return stash(folded.select(*KEY, "matrix").repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY).mapInArrow(
        run, f"{_KEY_TYPES}, matrix array<double>, run_turn bigint, run_part bigint, whole int"), "chat-runs")


def all_borders(folded: DataFrame, fan: int = FAN) -> DataFrame:
    """(KEY, entry, leave) of all blocks, from ``folded`` (KEY, matrix).

    Matrices of long transcripts are multiplied in levels until at most ``fan`` are left of each;
    then the borders go down the levels, at most ``fan`` matrices at a time.
    """
    levels, top = [], folded
    while (top.groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > fan:
        found = runs(top, fan)
        levels.append(found.filter("whole = 0").drop("whole"))
        top = found.filter("whole = 1").select(*KEY, "matrix")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((*r[:3], *b) for _, held in _groups(batches, 1)
                for r, b in zip(held, borders(np.array([r[3] for r in held]).reshape(len(held), START + 1, START))))
        return _batches(rows, [*KEY, "entry", "leave"], [_TEXT, _LONG, _LONG, _INT, _INT])

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r[0], *r[3:5], *b) for _, held in _groups(batches, 3) for r, b in zip(held, borders(
            np.array([r[5] for r in held]).reshape(len(held), START + 1, START), *held[0][6:8])))
        return _batches(rows, [*KEY, "entry", "leave"], [_TEXT, _LONG, _LONG, _INT, _INT])

    kinds = f"{_KEY_TYPES}, entry int, leave int"
    border = top.select(*KEY, "matrix").repartition("conv").sortWithinPartitions(*KEY).mapInArrow(ends, kinds)
    for level in reversed(levels):
        of_run = stash(border, "chat-borders").select(
            "conv", F.col("block_turn").alias("run_turn"), F.col("block_part").alias("run_part"), "entry", "leave")
        run = ["conv", "run_turn", "run_part"]
        border = level.join(of_run, run).select(*run, *KEY[1:], "matrix", "entry", "leave").repartition(
            *run).sortWithinPartitions(*run, *KEY[1:]).mapInArrow(down, kinds)
    return border


def recover(lines: DataFrame, model: Hmm) -> DataFrame:
    """``lines`` (KEY, turn, order, place, line, symbol) with state and turn_no, counted from 1 in each transcript.

    Lines before a transcript's first turn start have turn_no 0.
    """
    long, text, int_ = pa.int64(), pa.string(), pa.int32()

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((*key, fold(model, np.array([r[-1] for r in held])).reshape(-1).tolist())
                for key, held in _groups(batches, 3))
        return _batches(rows, [*KEY, "matrix"], [text, long, long, pa.list_(pa.float64())])

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for _, held in _groups(batches, 3):
                found = path(model, np.array([r[7] for r in held]), held[0][8], held[0][9])
                for r, s, n in zip(held, found.tolist(), np.cumsum(found % 2 == 0).tolist()):
                    yield (*r[:7], s, n)
        return _batches(rows(), [*KEY, "turn", "order", "place", "line", "state", "starts"],
                        [text, long, long, long, long, int_, text, int_, long])

    order = [*KEY, "turn", "order", "place"]
    key = "conv string, block_turn bigint, block_part bigint"
    folded = stash(lines.select(*order, "symbol").repartition(*KEY).sortWithinPartitions(*order).mapInArrow(
        matrices, f"{key}, matrix array<double>"), "chat-folded")
    border = all_borders(folded)
    decoded = stash(lines.join(border, KEY).select(*order, "line", "symbol", "entry", "leave").repartition(*KEY)
                    .sortWithinPartitions(*order).mapInArrow(
                        states, f"{key}, turn bigint, order bigint, place int, line string, state int, starts bigint"),
                    "chat-states")
    before = Window.partitionBy("conv").orderBy("block_turn", "block_part").rowsBetween(Window.unboundedPreceding, -1)
    base = decoded.groupBy(*KEY).agg(F.max("starts").alias("n")).select(
        *KEY, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return decoded.join(base, KEY).withColumn("turn_no", F.col("base") + F.col("starts")).drop("base", "starts")


def _with_piece(found: DataFrame, large: DataFrame, facts: DataFrame, piece_bytes: int) -> DataFrame:
    """Lines of the ``large`` turns with piece, and the turn's first line and last piece."""
    turn, place = ["conv", "turn_no"], ["turn", "order", "place"]
    whole = Window.partitionBy(*turn)
    blocks = facts.join(large, turn, "left_semi").select(
        *turn, *KEY[1:], F.coalesce(F.sum("bytes").over(whole.orderBy(*KEY[1:]).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    last = facts.join(large, turn, "left_semi").groupBy(*turn).agg(
        F.min("first").alias("first"), (F.sum("bytes") - F.max("last")["size"]).alias("at"))
    inside = Window.partitionBy(*turn, *KEY[1:]).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    piece = lambda at: F.floor(at / piece_bytes).cast("int")
    return found.join(large, turn, "left_semi").join(stash(blocks, "chat-bases"), [*turn, *KEY[1:]]).join(
        last, turn).withColumn("piece", piece(F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))).withColumn(
        "last_piece", piece(F.col("at")))


def render(found: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Recovered turns: conv_id, turn_no, piece, role, at_turn, n_lines, rendered.

    One row per turn; a turn of more than ``piece_bytes`` is given in pieces, numbered from 0, that
    joined in order are the rendered turn. n_lines counts the lines of the piece.
    """
    body = F.when(F.col("state") % 2 == 0, F.regexp_replace("line", MARKER, "")).otherwise(F.col("line"))
    found = found.withColumn("body", body).withColumn("size", (F.octet_length("body") + 1).cast("bigint"))
    turn, place = ["conv", "turn_no"], ["turn", "order", "place"]
    facts = stash(found.groupBy(*turn, *KEY[1:]).agg(
        F.sum("size").alias("bytes"), F.min(F.struct(*place, "state")).alias("first"),
        F.max(F.struct(*place, "size")).alias("last")), "chat-facts")
    large = stash(facts.groupBy(*turn).agg(F.sum("bytes").alias("bytes")).filter(
        F.col("bytes") > piece_bytes).select(*turn), "chat-large")
    lines = F.array_sort(F.collect_list(F.struct(*place, "body"))).alias("lines")
    n_lines = F.count("*").alias("n_lines")
    per_turn = found.join(F.broadcast(large), turn, "left_anti").groupBy(*turn).agg(
        F.lit(0).alias("piece"), F.lit(0).alias("last_piece"), F.min(F.struct(*place, "state")).alias("first"), n_lines, lines)
    if not large.isEmpty():
        per_turn = per_turn.unionByName(_with_piece(found, large, facts, piece_bytes).groupBy(*turn, "piece").agg(
            F.first("last_piece").alias("last_piece"), F.first("first").alias("first"), n_lines, lines))
    role = _pick(F.floor(F.col("first.state") / 2), list(ROLES))
    starts, stops = F.col("piece") == 0, F.col("piece") == F.col("last_piece")
    text = F.array_join(F.transform("lines", lambda x: x["body"]), "\n")
    text = F.when(starts & stops, F.trim(text)).when(starts, F.ltrim(text)).when(stops, F.rtrim(text)).otherwise(text)
    return per_turn.select(
        F.when(F.col("conv") != "", F.col("conv").cast("bigint")).alias("conv_id"), "turn_no", "piece", role.alias("role"),
        F.when(F.col("first.turn") > (-1 << 62), F.col("first.turn")).alias("at_turn"), "n_lines",
        F.concat(F.when(starts, F.concat(F.lit("<|"), role, F.lit("|>\n"))).otherwise(F.lit("\n")), text,
                 F.when(stops, F.lit("\n<|end|>")).otherwise(F.lit(""))).alias("rendered"))


def parse(conversations: DataFrame) -> DataFrame:
    """Transcripts of a table of conversations, their roles recovered: the lines with state and turn_no."""
    prepare(conversations.sparkSession)
    rows = stash(with_blocks(turns(conversations)), "chat-rows")
    blocks = rows.select("conv", "turn", "order", "block_turn", "block_part")
    lines = stash(with_symbols(transcripts(rows).join(blocks.distinct(), ["conv", "turn", "order"])), "chat-lines")
    return recover(lines.drop("role"), learn(lines))


def op8_chat(conversations: DataFrame) -> DataFrame:
    """conv_id, turn_no, piece, role, at_turn, n_lines, rendered."""
    return render(parse(conversations))
