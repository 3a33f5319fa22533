"""Column expressions for rendered log lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Level width and level ranks of the log layouts (fixed values).
LEVEL_WIDTH = 5
LEVELS = {
    "ALL": 0, "TRACE": 1, "DEBUG": 2, "INFO": 3, "WARN": 4, "ERROR": 5, "FATAL": 6, "OFF": 7,
}

# One pattern for both layouts: time, level, logger, optional line number, message.
LINE = (
    r"(?s)^\[?(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3})\]? +([A-Z]+) +"
    r"\[([^\]:]+)(?::(\d+))?\] - (.*)$"
)
# Starts and separates the fields while a line is taken apart.
MARK = "\u0001"


def rendered_time(ts: Column) -> Column:
    """Time as yyyy-MM-dd HH:mm:ss.SSS, years above 9999 with all their digits.

    Cut from the text form, which needs no time zone; date_format would move
    zone-free times that the session zone skips.
    """
    text = ts.cast("string")
    millis = F.rpad(F.substring(F.regexp_extract(text, r"\.(\d+)$", 1), 1, 3), 3, "0")
    return F.concat(F.substring_index(text, ".", 1), F.lit("."), millis)


def rendered_line(ts: Column, level: Column, logger: Column, message: Column,
                  line: Column | None = None, layout: str = "stdout") -> Column:
    """A log line; the ``file`` layout puts the time in brackets, ``line`` may be left out.

    A level is padded, never cut. Missing parts read ``null``, so that no line is lost.
    """
    or_null = lambda part: F.coalesce(part.cast("string"), F.lit("null"))
    time, level, logger, message = (or_null(p) for p in (rendered_time(ts), level, logger, message))
    if layout == "file":
        time = F.concat(F.lit("["), time, F.lit("]"))
    elif layout != "stdout":
        raise ValueError(f"unknown log layout {layout!r}")
    place = logger if line is None else F.concat(logger, F.lit(":"), or_null(line))
    padded = F.when(F.char_length(level) < LEVEL_WIDTH, F.rpad(level, LEVEL_WIDTH, " ")).otherwise(level)
    return F.concat(time, F.lit(" "), padded, F.lit(" ["), place, F.lit("] - "), message)


def line_fields(text: Column) -> Column:
    """An empty text and the five fields of a line; other texts do not start like that.

    The pattern runs once per line: its groups are spread out and then split.
    """
    spread = F.regexp_replace(text, LINE, MARK + MARK.join(["$1", "$2", "$3", "$4", "$5"]))
    return F.split(spread, MARK, 6)


def named_fields(text: Column, fields: Column) -> dict[str, Column]:
    """The fields by name, all null when the text does not match or its time is no time."""
    none, ts, level, logger, line, message = (F.get(fields, F.lit(i)) for i in range(6))
    ts = ts.try_cast("timestamp_ntz")
    split = (F.size(fields) == 6) & (none == "") & ~text.startswith(MARK)
    matched = split & ts.isNotNull()
    return {
        "ts": F.when(split, ts),
        "level": F.when(matched, level),
        "logger": F.when(matched, logger),
        "line": F.when(matched, F.nullif(line, F.lit("")).try_cast("int")),
        "message": F.when(matched, message),
    }


def level_rank(level: Column) -> Column:
    """The rank of a level name, null for an unknown one."""
    ranks = F.create_map(*[F.lit(item) for pair in LEVELS.items() for item in pair])
    return F.try_element_at(ranks, level)


def threshold_rank(logger: Column, root: str, loggers: dict[str, str]) -> Column:
    """The rank a logger must reach: that of the longest configured prefix, or the root's."""
    rank = F.lit(LEVELS[root])
    for prefix in sorted(loggers, key=len):
        below = (logger == prefix) | logger.startswith(prefix + ".")
        rank = F.when(below, LEVELS[loggers[prefix]]).otherwise(rank)
    return rank
