"""Records of delimited text files: whole rows, quoted line breaks included, read by many tasks per file.

A file is read in byte ranges, line by line. Whether a line begins inside quotes depends on all text before
it, but what a line does to that is a map of two states (outside, inside) to two states, and so is what a
range does: the maps of its lines composed. So one pass gives each range its map, the maps of a file's ranges
give each range the state it begins in, and a second pass knows the state at every line without having read
what comes before. Lines of ranges without open quotes are records as they are and move nowhere; only
the lines of other ranges are gathered into records.

The first pass also decides, per file, the encoding its bytes are valid in, and finds its first line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowmill.plans.storage import materialise

QUOTE = '"'

# What is blank in a line without text.
BLANKS = " \t\r\x0b\x0c"

FILE, BLOCK, POS, SUB = "__file", "__block", "__pos", "__sub"
PLACE = [BLOCK, POS, SUB]

# States within a line: at the start of a field, within a bare field, within quotes, after a closing quote.
START, BARE, QUOTED, CLOSED = range(4)


class UnclosedQuote(ValueError):
    """A quote that is open at the end of its file."""


def physical_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines cut at line feeds only, as raw bytes in `value`, with their file, byte range and order."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(POS),
    )


def ended_lines(lines: DataFrame, inner: bool) -> DataFrame:
    """Lines without their end, `__end`; with `inner` also cut at carriage returns that stand alone."""
    value = F.col("value")
    crlf = F.endswith(value, F.lit("\r"))
    # By bytes: what is a character is not known yet.
    shorter = F.substring(value.cast("binary"), F.lit(1), F.octet_length(value) - 1).cast("string")
    body = F.when(crlf, shorter).otherwise(value)
    end = F.when(crlf, F.lit("\r\n")).otherwise(F.lit("\n"))
    if not inner:
        return lines.select(body.alias("value"), FILE, BLOCK, POS, F.lit(0).alias(SUB), end.alias("__end"))
    parts = F.split(F.decode(body.cast("binary"), "ISO-8859-1"), "\r", -1)
    cut = lines.select(end.alias("__last"), FILE, BLOCK, POS, F.posexplode(parts).alias(SUB, "part"))
    cut = cut.withColumn("value", F.encode("part", "ISO-8859-1").cast("string")).drop("part")
    last = F.row_number().over(Window.partitionBy(FILE, BLOCK, POS).orderBy(F.col(SUB).desc())) == 1
    return cut.select("value", FILE, BLOCK, POS, SUB, F.when(last, F.col("__last")).otherwise(F.lit("\r")).alias("__end"))


def _walk(text: Column, separator: str, begin: int) -> Column:
    """The state after the text and the number of fields begun in it, from the state before it.

    A quote opens only at the start of a field; within quotes two of them are one.
    """

    def after(state: Column, segment: Column) -> Column:
        settled = F.when(F.endswith(segment, F.lit(separator)), F.lit(START)).otherwise(F.lit(BARE))
        return F.when((state == QUOTED) | (segment == ""), state).otherwise(settled)

    def fields(state: Column, segment: Column) -> Column:
        bare = F.replace(segment, F.lit(separator), F.lit(""))
        cuts = (F.char_length(segment) - F.char_length(bare)) / F.lit(len(separator))
        return F.when(state == QUOTED, F.lit(0)).otherwise(cuts.cast("int"))

    def step(at: Column, segment: Column) -> Column:
        # The quote before the segment, then the segment.
        turned = F.element_at(F.array(*map(F.lit, (QUOTED, BARE, CLOSED, QUOTED))), at["state"] + 1)
        return F.struct(after(turned, segment).alias("state"), (at["fields"] + fields(turned, segment)).alias("fields"))

    segments = F.split(text, QUOTE, -1)
    first = segments[0]
    state = after(F.lit(begin), first)
    start = F.struct(state.alias("state"), fields(F.lit(begin), first).alias("fields"))
    return F.aggregate(F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0))), start, step)


def ends_inside(text: Column, separator: str, inside: bool) -> Column:
    """1 if quotes are open after a line that begins inside or outside them, else 0."""
    walked = _walk(text, separator, QUOTED if inside else START)["state"] == QUOTED
    return F.when(F.contains(text, F.lit(QUOTE)), walked.cast("int")).otherwise(F.lit(int(inside)))


def field_count(text: Column, separator: str) -> Column:
    """Number of fields of a record."""
    bare = F.char_length(text) - F.char_length(F.replace(text, F.lit(separator), F.lit("")))
    plain = (bare / F.lit(len(separator))).cast("int")
    return 1 + F.when(F.contains(text, F.lit(QUOTE)), _walk(text, separator, START)["fields"]).otherwise(plain)


def survey(lines: DataFrame) -> DataFrame:
    """One row per byte range: valid bytes, quotes, lone carriage returns, first line with text."""
    value = F.col("value")
    text = F.when(F.btrim(value, F.lit(BLANKS)) != "", F.struct(POS, SUB, "value"))
    return lines.groupBy(FILE, BLOCK).agg(
        F.bool_and(F.is_valid_utf8(value)).alias("utf8"),
        F.bool_and(F.octet_length(value) == F.char_length(value)).alias("ascii"),
        F.bool_or(F.contains(value, F.lit(QUOTE))).alias("quotes"),
        F.bool_or(F.contains(value, F.lit("\r"))).alias("inner"),
        F.min(text).alias("first"),
    )


def decoded(value: Column, charset: Column) -> Column:
    """Text of raw bytes; UTF-8 and ASCII need no change."""
    return F.when(charset == "ISO-8859-1", F.decode(value.cast("binary"), "ISO-8859-1")).otherwise(value)


def running_state(swaps: Column, last: Column, begin: Column) -> Column:
    """The state after some maps, from their number of swaps and the last constant one among them."""
    fixed = (last["value"] + swaps - last["swaps"]) % 2
    return F.coalesce(fixed, (begin + swaps) % 2).cast("int")


def _with_runs(rows: DataFrame, window, before: bool) -> DataFrame:
    """Add __swaps and __fixed of the maps (to_out, to_in) up to a row, or before it."""
    swap = ((F.col("to_out") == 1) & (F.col("to_in") == 0)).cast("int")
    constant = F.col("to_out") == F.col("to_in")
    upto = window.rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    own = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__own", F.sum(swap).over(own))
    mark = F.when(constant, F.struct(F.col("to_out").alias("value"), F.col("__own").alias("swaps")))
    return rows.select(
        "*", F.coalesce(F.sum(swap).over(upto), F.lit(0)).alias("__swaps"), F.last(mark, ignorenulls=True).over(upto).alias("__fixed")
    ).drop("__own")


def with_maps(lines: DataFrame, separator: str) -> DataFrame:
    text = F.col("value")
    return lines.withColumns({"to_out": ends_inside(text, separator, False), "to_in": ends_inside(text, separator, True)})


def opened(lines: DataFrame, blocks: DataFrame, separator: str) -> DataFrame:
    """blocks with begin and end (states), touched (some line may begin inside quotes) and home.

    `home` is the range in which a record that is open at the begin has begun.
    """
    within = Window.partitionBy(FILE, BLOCK).orderBy(POS, SUB)
    maps = with_maps(lines.where(F.contains("value", F.lit(QUOTE))), separator)
    marks = maps.where("NOT (to_out = 0 AND to_in = 1)").select(FILE, *PLACE, "to_out", "to_in")
    marks = materialise(_with_runs(marks, within, before=False))
    last = F.max_by(F.struct("__swaps", "__fixed"), F.struct(POS, SUB))
    ends = marks.groupBy(FILE, BLOCK).agg(last.alias("run"))
    state = lambda begin: running_state(F.col("run.__swaps"), F.col("run.__fixed"), F.lit(begin))
    ends = ends.select(FILE, BLOCK, state(0).alias("to_out"), state(1).alias("to_in"))
    blocks = blocks.join(ends, [FILE, BLOCK], "left").fillna({"to_out": 0, "to_in": 1})
    in_file = Window.partitionBy(FILE).orderBy(BLOCK)
    blocks = _with_runs(blocks, in_file, before=True)
    blocks = blocks.withColumn("begin", running_state(F.col("__swaps"), F.col("__fixed"), F.lit(0)))
    blocks = blocks.withColumn("end", F.when(F.col("begin") == 1, F.col("to_in")).otherwise(F.col("to_out")))
    blocks = materialise(blocks.drop("__swaps", "__fixed", "to_out", "to_in"))
    after = running_state(F.col("__swaps"), F.col("__fixed"), F.col("begin"))
    closes = marks.join(blocks.select(FILE, BLOCK, "begin"), [FILE, BLOCK]).groupBy(FILE, BLOCK)
    closes = closes.agg(F.bool_or(after == 0).alias("closes"), F.bool_or(after == 1).alias("opens"))
    blocks = blocks.join(closes, [FILE, BLOCK], "left").withColumn(
        "opener", (F.col("end") == 1) & ((F.col("begin") == 0) | F.coalesce("closes", F.lit(False)))
    )
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    home = F.last(F.when(F.col("opener"), F.col(BLOCK)), ignorenulls=True).over(earlier)
    blocks = blocks.withColumn("home", home)
    blocks = blocks.withColumn("touched", F.coalesce("opens", F.lit(False)) | (F.col("begin") == 1))
    return materialise(blocks.drop("closes", "opens", "opener"))


def gathered(lines: DataFrame, separator: str) -> DataFrame:
    """Records of the lines of touched ranges. lines: with begin, end and home of their range."""
    within = Window.partitionBy(FILE, BLOCK).orderBy(POS, SUB)
    rows = _with_runs(with_maps(lines, separator), within, before=True)
    begins = running_state(F.col("__swaps"), F.col("__fixed"), F.col("begin")) == 0
    rows = rows.withColumn("n", F.sum(begins.cast("int")).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("most", F.max("n").over(Window.partitionBy(FILE, BLOCK)))
    crosses = (F.col("n") == 0) | ((F.col("n") == F.col("most")) & (F.col("end") == 1))
    home = F.when(F.col("n") == 0, F.col("home")).otherwise(F.col(BLOCK))
    # Ranges are whole already, so this moves nothing; only what crosses them is gathered again.
    parts = F.array_sort(F.collect_list(F.struct(*PLACE, "value", "__end")))
    first = [F.first(c).alias(n) for n, c in (("crosses", crosses), ("home", home), ("reader", F.col("reader")))]
    fragments = materialise(rows.groupBy(FILE, BLOCK, "n").agg(parts.alias("parts"), *first).drop(BLOCK))
    joined = fragments.where("crosses").groupBy(FILE, "home").agg(
        F.array_sort(F.flatten(F.collect_list("parts"))).alias("parts"), F.first("reader").alias("reader")
    )
    found = fragments.where("NOT crosses").select(FILE, "parts", "reader").unionByName(joined.drop("home"))
    earlier = F.slice("parts", F.lit(1), F.size("parts") - 1)
    whole = F.array_join(F.transform(earlier, lambda p: F.concat(p["value"], p["__end"])), "")
    return found.select(
        FILE, *[F.col("parts")[0][c].alias(c) for c in PLACE],
        F.concat(whole, F.element_at("parts", -1)["value"]).alias("value"), "reader",
    ).orderBy(FILE, *PLACE)


class Records:
    """The records of one or more files: `rows` (file, place, value, reader) and `files` (charset, first line).

    `reader` is what rows need to know of their file: charset and place of its first record.
    """

    def __init__(self, spark: SparkSession, path: str | Sequence[str], separator: str | None, encodings: dict[str, str]):
        """encodings: names and charsets to try in order; the last takes any bytes. No separator: no quotes."""
        lines = physical_lines(spark, path)
        whole = ended_lines(lines, inner=False)
        blocks = materialise(survey(whole))
        flags = blocks.agg(F.bool_or("inner"), F.bool_or("quotes")).first()
        if flags[0]:
            whole = ended_lines(lines, inner=True)
            blocks = materialise(survey(whole))
        self.files = materialise(self._files(blocks, encodings))
        blocks = blocks.select(FILE, BLOCK).join(self.files.select(FILE, "reader"), FILE)
        # One row per byte range, of which the driver keeps a task as it is.
        rows = whole.join(F.broadcast(materialise(blocks)), [FILE, BLOCK])
        rows = rows.withColumn("value", decoded(F.col("value"), F.col("reader.charset")))
        self.multiline = False
        if separator is not None and flags[1]:
            blocks = opened(rows, blocks, separator)
            self._refuse_open(blocks)
            self.multiline = bool(blocks.where("touched").limit(1).count())
        out = [FILE, *PLACE, "value", "reader"]
        if self.multiline:
            states = F.broadcast(blocks.select(FILE, BLOCK, "begin", "end", "home", "touched"))
            rows = rows.join(states, [FILE, BLOCK])
            joined = materialise(gathered(rows.where("touched"), separator))
            rows = rows.where("NOT touched").select(*out).unionByName(joined)
        self.rows = rows.select(*out).where(F.btrim("value", F.lit(BLANKS + "\n")) != "")

    @staticmethod
    def _files(blocks: DataFrame, encodings: dict[str, str]) -> DataFrame:
        valid = {"UTF-8": F.col("utf8"), "US-ASCII": F.col("ascii")}
        fits = [F.when(valid.get(c, F.lit(True)), F.struct(F.lit(n).alias("encoding"), F.lit(c).alias("charset"))) for n, c in encodings.items()]
        files = blocks.groupBy(FILE).agg(
            F.bool_and("utf8").alias("utf8"), F.bool_and("ascii").alias("ascii"),
            F.min(F.when(F.col("first").isNotNull(), F.struct(F.col(BLOCK).alias("block"), "first"))).alias("head"),
        )
        chosen = files.withColumn("chosen", F.coalesce(*fits))
        place = F.struct(F.col("head.block").alias(BLOCK), F.col(f"head.first.{POS}").alias(POS), F.col(f"head.first.{SUB}").alias(SUB))
        return chosen.select(
            FILE, "chosen.encoding", decoded(F.col("head.first.value"), F.col("chosen.charset")).alias("line"),
            F.struct(F.col("chosen.charset").alias("charset"), place.alias("first")).alias("reader"),
        )

    @staticmethod
    def _refuse_open(blocks: DataFrame) -> None:
        last = blocks.groupBy(FILE).agg(F.max_by("end", BLOCK).alias("end")).where("end = 1")
        names = [r[FILE] for r in last.orderBy(FILE).limit(3).collect()]
        if names:
            raise UnclosedQuote(f"a quote is not closed before the end of {', '.join(names)}")

    def encodings(self) -> list[str]:
        """The encodings in use, that of most files first."""
        used = self.files.groupBy("encoding").count().orderBy(F.col("count").desc(), "encoding").collect()
        return [r.encoding for r in used]

    def is_first(self) -> Column:
        return F.struct(*PLACE) == F.col("reader.first")

    def heads(self, separator: str | None, limit: int) -> list[tuple[str, str]]:
        """Distinct first records and the first file of each, by file."""
        heads = self.files.where("line IS NOT NULL").select(FILE, F.col("line").alias("value"))
        if self.multiline and heads.where(ends_inside(F.col("value"), separator, False) == 1).limit(1).count():
            heads = self.rows.where(self.is_first()).select(FILE, "value")
        found = heads.groupBy("value").agg(F.min(FILE).alias("file")).orderBy("file").limit(limit).collect()
        return [(r.value, r.file) for r in found]
