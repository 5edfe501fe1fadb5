"""Lines to server events: the one order-dependent step of the pipeline.

Everything that looks back over a log (game number, recording state, pending
deck, header above a payload line) is a running value. A window over the whole
log would put it into one task, so each running value is made of two parts:

* inside a block: window functions over (source_file, block);
* before a block: one summary row per block, combined over the blocks of a log.

Lines are shuffled once. The summaries come from the same exchange, and there
is one row of them per file split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelspark.functions import lines as L
from duelspark.functions import payloads as P
from duelspark.schemas import GAME

BLOCK = ["source_file", "block"]

#: The kind of the rows of ``events`` that carry a log's state, see ``state_of``.
STATE = "state"

# Blocks before and behind all others, for the state that comes in and goes out.
_BEFORE, _BEHIND = -(1 << 62), 1 << 62


def classify(lines: DataFrame) -> DataFrame:
    """Adds ``kind`` and drops the text that no later step can need."""
    return lines.withColumn("kind", L.kind(F.col("line"))).withColumn(
        "line", F.when(~F.col("kind").isin(L.START, L.END, L.SKIP), F.col("line"))
    )


def markers(lines: DataFrame) -> DataFrame:
    """Start and end markers."""
    return lines.select("source_file", "pos", L.kind(F.col("line")).alias("kind")).filter(
        F.col("kind").isin(L.START, L.END)
    )


def wanted(lines: DataFrame) -> DataFrame:
    """Lines with the prefix and without unwanted text."""
    line = F.col("line")
    return lines.filter(L.has_prefix(line) & ~L.is_unwanted(line))


def headers(lines: DataFrame) -> DataFrame:
    """Event headers with their fields and the payload of a one-line record."""
    line, kind = F.col("line"), L.kind(F.col("line"))
    return (
        lines.withColumn("kind", kind)
        .filter(F.col("kind").isin(L.INLINE, L.HEAD))
        .select("source_file", "pos", L.header_fields(L.metadata(line)).alias("h"),
                L.inline_payload(line).alias("payload"))
        .select("source_file", "pos", "h.*", "payload")
    )


def _frame(lines: DataFrame) -> DataFrame:
    """Running values inside each block."""
    order = Window.partitionBy(*BLOCK).orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kind, line, pos = F.col("kind"), F.col("line"), F.col("pos")
    # The explicit repartition keeps the window inputs from being computed below
    # the exchange, so the events and the summaries read one and the same shuffle.
    # Keys are made non-nullable for the same reason: a join would otherwise add
    # a NULL filter below only one of the two uses.
    placed = (
        classify(lines)
        .select(
            F.coalesce("source_file", F.lit("")).alias("source_file"),
            F.struct(
                F.coalesce("block.part", F.lit(0)).cast("bigint").alias("part"),
                F.coalesce("block.file", F.lit("")).alias("file"),
                F.coalesce("block.start", F.lit(0)).cast("bigint").alias("start"),
            ).alias("block"),
            "pos", "kind", "line",
        )
        .repartition(*BLOCK)
    )
    return placed.select(
        "*",
        F.row_number().over(order).alias("line_no"),
        F.sum((kind == L.START).cast("int")).over(upto).alias("starts"),
        F.last(F.when(kind.isin(L.START, L.END), kind), True).over(upto).alias("mark"),
        F.last(F.when(kind == L.DECK, pos), True).over(upto).alias("deck_pos"),
        F.lag(F.when(kind == L.HEAD, line)).over(order).alias("prev_head"),
        F.lead(kind).over(order).alias("next_kind"),
    )


def _is_header():
    return F.col("kind").isin(L.INLINE, L.HEAD)


def _edge(part: int):
    return F.struct(F.lit(part).alias("part"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("start"))


def block_carry(frame: DataFrame, before: DataFrame | None = None, ends: bool = False) -> DataFrame:
    """What each block inherits from the blocks before it (and the kind after it).

    ``before`` (rows of ``state_of``) stands for all lines of a log that were read
    earlier. With ``ends`` one more block per log, behind all others, inherits what
    lines that are yet to come need.
    """
    kind, pos, line = F.col("kind"), F.col("pos"), F.col("line")
    marker = kind.isin(L.START, L.END)
    summary = frame.groupBy(*BLOCK).agg(
        F.sum((kind == L.START).cast("int")).alias("n_starts"),
        F.max("line_no").alias("n_lines"),
        F.max_by(kind, F.when(marker, pos)).alias("end_mark"),
        F.max_by(F.when(kind == L.HEAD, line), pos).alias("tail_head"),
        F.min_by(kind, pos).alias("first_kind"),
        F.max(F.when(kind == L.DECK, pos)).alias("last_deck"),
        F.max_by(line, F.when(kind == L.DECK, pos)).alias("deck"),
        # Headers inside a game for sure, and headers above the first marker,
        # which are inside one only if the block before ends inside a game.
        F.max(F.when(_is_header() & (F.col("mark") == L.START), pos)).alias("sure"),
        F.max(F.when(_is_header() & F.col("mark").isNull(), pos)).alias("open"),
        F.max_by(F.xxhash64(kind, line), pos).alias("tail"),
    )
    by_source = Window.partitionBy("source_file")
    order = by_source.orderBy("block")
    # Windows, not a join with the logs of the summary: that would read the lines once more.
    if before is not None:
        known = before.select(
            "source_file", _edge(_BEFORE).alias("block"), F.col("games").cast("bigint").alias("n_starts"),
            F.col("lines").cast("bigint").alias("n_lines"), F.col("mark").alias("end_mark"), F.col("head").alias("tail_head"),
            F.when(F.col("deck").isNotNull(), F.lit(0).cast("bigint")).alias("last_deck"), "deck", "tail",
        )
        summary = summary.unionByName(known, allowMissingColumns=True)
        summary = summary.withColumn("_newest", F.max("block.part").over(by_source)).filter(F.col("_newest") > _BEFORE).drop("_newest")
    if ends:
        rest = [c for c in summary.columns if c not in BLOCK]
        copies = F.when(F.lead("block").over(order).isNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        summary = summary.withColumn("_copies", copies).select("*", F.explode("_copies").alias("_end")).select(
            "source_file",
            F.when(F.col("_end"), _edge(_BEHIND)).otherwise(F.col("block")).alias("block"),
            *[F.when(~F.col("_end"), F.col(c)).alias(c) for c in rest],
        )
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(-1).cast("bigint")
    after_deck = lambda p: F.coalesce(F.col(p) > F.coalesce(F.col("last_deck"), none), F.lit(False))
    return (
        summary.withColumn("mark_in", F.last("end_mark", True).over(earlier))
        .withColumn(
            "used",
            after_deck("sure") | (F.coalesce(F.col("mark_in") == L.START, F.lit(False)) & after_deck("open")),
        )
        .select(
            *BLOCK,
            "mark_in",
            F.coalesce(F.sum("n_starts").over(earlier), F.lit(0)).alias("games_in"),
            F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)).alias("lines_in"),
            F.lag("tail_head").over(order).alias("head_in"),
            F.lead("first_kind").over(order).alias("kind_out"),
            F.last(F.when(F.col("last_deck").isNotNull(), F.col("block")), True).over(earlier).alias("deck_block"),
            F.last(F.when(F.col("used"), F.col("block")), True).over(earlier).alias("used_block"),
            F.last("deck", True).over(earlier).alias("deck_in"),
            F.last("tail", True).over(earlier).alias("tail_in"),
        )
        .withColumn(
            "deck_in",
            F.when(F.col("used_block").isNull() | (F.col("used_block") < F.col("deck_block")), F.col("deck_in")),
        )
        .drop("deck_block", "used_block")
    )


def in_game(lines: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Every line inside a game that is a header or may be a payload, with full context."""
    frame = _frame(lines)
    return _in_game(frame, block_carry(frame, before))


def _in_game(frame: DataFrame, carry: DataFrame) -> DataFrame:
    order = Window.partitionBy(*BLOCK).orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    pos, mark, kind, line = F.col("pos"), F.col("mark"), F.col("kind"), F.col("line")
    # Text that follows no header, and lines no rule wants, end here.
    useful = (kind.isin(L.INLINE, L.HEAD, L.BAD, L.START, L.DECK)) | (
        (kind == L.TEXT) & (F.col("prev_head").isNotNull() | (F.col("line_no") == 1))
    )
    local = frame.filter(useful).select(
        "*",
        F.last(F.when(kind == L.DECK, line), True).over(upto).alias("deck_line"),
        F.last(F.when(_is_header() & (mark == L.START), pos), True).over(earlier).alias("sure"),
        F.last(F.when(_is_header() & mark.isNull(), pos), True).over(earlier).alias("open"),
    )
    in_game = F.coalesce(F.col("mark_in") == L.START, F.lit(False))
    floor = F.coalesce(F.col("deck_pos"), F.lit(-1).cast("bigint"))
    used = F.coalesce(F.col("sure") > floor, F.lit(False)) | (
        in_game & F.coalesce(F.col("open") > floor, F.lit(False))
    )
    return (
        local.join(carry, BLOCK, "left")
        .filter((F.coalesce(mark, F.col("mark_in")) == L.START) & (kind != L.DECK))
        .select(
            "source_file",
            (F.col("games_in") + F.col("starts")).cast("int").alias("game_num"),
            "pos",
            (F.col("lines_in") + F.col("line_no")).alias("line_ord"),
            "kind",
            "line",
            F.when(F.col("line_no") == 1, F.col("head_in")).otherwise(F.col("prev_head")).alias("head"),
            F.coalesce(F.col("next_kind"), F.col("kind_out")).alias("next_kind"),
            F.when(_is_header() & ~used, F.coalesce(F.col("deck_line"), F.col("deck_in"))).alias("deck"),
        )
    )


def events(lines: DataFrame, before: DataFrame | None = None, ends: bool = False) -> DataFrame:
    """Lines inside games with header fields and payload.

    ``raw`` is the payload text of an event and NULL on other lines; ``payload``
    is also NULL where the JSON lacks the branch its event type must have.

    ``before`` (rows of ``state_of``): what was read of these logs earlier; numbers
    of games and lines go on from there. ``ends`` adds one row per log of kind STATE.
    """
    kind, line = F.col("kind"), F.col("line")
    is_payload = (kind == L.TEXT) & F.col("head").isNotNull()
    frame = _frame(lines)
    carry = block_carry(frame, before, ends)
    found = _found(_in_game(frame, carry), kind, line, is_payload)
    if not ends:
        return found
    state = carry.filter(F.col("block.part") == _BEHIND).select(
        "source_file", F.col("games_in").cast("int").alias("game_num"), F.col("lines_in").alias("line_ord"),
        F.lit(STATE).alias("kind"), F.col("mark_in").alias("next_kind"), F.col("head_in").alias("line"),
        F.col("deck_in").alias("deck"), F.col("tail_in").cast("string").alias("raw"),
    )
    return found.unionByName(state, allowMissingColumns=True)


def state_of(found: DataFrame) -> DataFrame:
    """source_file, lines, games, mark, head, deck, tail after the lines of ``events(ends=True)``: one row per log.

    ``mark`` is the last start or end marker, ``head`` a header that is the last
    line, ``deck`` a deck that no header has taken, ``tail`` a hash of the last line.
    """
    return found.filter(F.col("kind") == STATE).select(
        "source_file", F.col("line_ord").alias("lines"), F.col("game_num").alias("games"), F.col("next_kind").alias("mark"),
        F.col("line").alias("head"), "deck", F.col("raw").cast("bigint").alias("tail"),
    )


def latest_state(states: DataFrame) -> DataFrame:
    """The newest row of every log."""
    rest = [c for c in states.columns if c not in ("source_file", "lines")]
    newest = states.groupBy("source_file").agg(F.max_by(F.struct("lines", *rest), "lines").alias("s"))
    return newest.select("source_file", "s.*")


def _found(inside: DataFrame, kind, line, is_payload) -> DataFrame:
    return (
        inside
        .filter(is_payload | kind.isin(L.INLINE, L.HEAD, L.BAD, L.START))
        .select(
            *GAME,
            "line_ord",
            "kind",
            "next_kind",
            "line",
            "deck",
            L.header_fields(L.metadata(F.when(is_payload, F.col("head")).otherwise(line))).alias("h"),
            F.when(is_payload, line).when(kind == L.INLINE, L.inline_payload(line)).alias("raw"),
        )
        .withColumn("payload", P.project(F.col("h.event"), F.col("raw")))
    )


def bronze(lines: DataFrame) -> DataFrame:
    """One row per server event inside a game, plus one deck row per pending deck."""
    return bronze_of(events(lines))


def bronze_of(found: DataFrame) -> DataFrame:
    """As ``bronze``, from ``events``."""
    row = lambda sub, event, payload: F.struct(
        F.lit(sub).alias("sub"), event.alias("event"), payload.alias("payload")
    )
    deck = F.when(
        F.col("deck").isNotNull(),
        row(0, F.lit(P.DECK_EVENT), P.wrap_list(L.inline_payload(F.col("deck")))),
    )
    event = F.when(F.col("payload").isNotNull(), row(1, F.col("h.event"), F.col("payload")))
    return (
        found.filter(F.col("kind") != STATE)
        .withColumn("row", F.explode(F.array_compact(F.array(deck, event))))
        .select(
            *GAME,
            (F.col("line_ord") * 2 + F.col("row.sub")).alias("row_ord"),
            F.col("h.player_id").alias("player_id"),
            F.col("h.timestamp").alias("timestamp"),
            "row.event",
            "row.payload",
        )
    )


def quarantine(lines: DataFrame) -> DataFrame:
    """Lines inside a game that look like events but cannot be read, with the reason."""
    return quarantine_of(events(lines))


def quarantine_of(found: DataFrame) -> DataFrame:
    """As ``quarantine``, from ``events``."""
    kind = F.col("kind")
    followed = F.coalesce(F.col("next_kind") == L.TEXT, F.lit(False))
    return (
        found.filter(kind != STATE)
        .withColumn(
            "reason",
            F.when(kind == L.BAD, "header")
            .when((kind == L.HEAD) & ~followed, "no_payload")
            .when(F.col("raw").isNotNull() & F.col("payload").isNull(), "no_branch"),
        )
        .filter(F.col("reason").isNotNull())
        .select(
            *GAME, (F.col("line_ord") * 2 + 1).alias("row_ord"), "reason", F.coalesce("raw", "line").alias("line")
        )
    )


def file_manifest(files: DataFrame, lines: DataFrame) -> DataFrame:
    """Games and event rows per source; sources without events are kept and marked."""
    return manifest_of(files, events(lines))


def manifest_of(files: DataFrame, found: DataFrame) -> DataFrame:
    """As ``file_manifest``, from ``events``."""
    count_if = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("bigint")
    seen = found.groupBy("source_file").agg(
        count_if(F.col("kind") == L.START).alias("games"), F.count("payload").alias("rows")
    )
    zero = F.lit(0).cast("bigint")
    return (
        files.select("source_file")
        .join(seen, "source_file", "left")
        .select(
            "source_file",
            F.coalesce("games", zero).alias("games"),
            F.coalesce("rows", zero).alias("rows"),
            F.when(F.coalesce("rows", zero) > 0, "parsed").otherwise("no_games").alias("status"),
        )
    )
