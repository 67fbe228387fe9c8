"""Run-log text to typed rows. Input: a DataFrame with a ``line`` column, as from ``spark.read.text``.

A line is a time stamp, then fields between "|". Within a field stand words, counts after their name ("units 3/7", "ok 3"), pairs ("rows=1,234"), or a tag in square brackets in front of
what is said about it. The parsers below read these parts; which of them a line has decides its kind.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The stamp, and the words that the logs use.
STAMP = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d),\d{3}"
PROGRESS, DQ_PROGRESS, DQ_UNIT, DQ_RUN, COMMAND = "PROGRESS ", "DQ-PROGRESS ", "DQ-UNIT ", "DQ run ", "# command"
LOADED, LOAD_FAILED, NO_ROWS, SKIPPED = "loaded:", "load failed:", "no rows;", "skipped:"
SOURCE_ROWS, LAKE_ROWS = "ora", "ice"
#: longest issue text, and longest text of another kind
ISSUE, DETAIL = 240, 160
#: what a command holds, and the kind of log that it writes; the first that fits counts
COMMANDS = (("dq", "dq"), ("snapshot", "snapshot"), ("iceberg", "pipeline"), ("pipeline", "pipeline"))


def _found(text: Column, pattern: str, part: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, part), F.lit(""))


def _number(c: Column) -> Column:
    return F.regexp_replace(c, ",", "").try_cast("bigint")


def pair(name: str, text: Column | None = None) -> Column:
    """The value of name=value."""
    return _found(F.col("line") if text is None else text, rf"\b{name}=([^\s)]+)")


def count_of(name: str, part: int = 1) -> Column:
    """The number behind a name; of "name 3/7" the first or second."""
    return _number(_found(F.col("line"), rf"\b{name}\s+([\d,]+)(?:/([\d,]+))?", part))


def _after(word: str) -> Column:
    """The fields behind a word."""
    return F.split(F.when(F.contains("line", F.lit(word)), F.substring_index("line", word, -1)), r"\s*\|\s*")


def _kind(tests: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(test, F.lit(kind)) for kind, test in tests.items()])


def _by_kind(values: dict[str, Column]) -> Column:
    return reduce(lambda c, kv: c.when(F.col("kind") == kv[0], kv[1]), values.items(), F.when(F.lit(False), F.lit(None)))


def level() -> Column:
    """error, warning or null; the levels stand in a field of their own, or in brackets."""
    own = F.transform(F.split("line", r"\|"), lambda x: F.btrim(x, F.lit(" []")))
    failed = F.array_contains(own, "ERROR") | F.contains("line", F.lit("Traceback"))
    return F.when(failed, "error").when(F.array_contains(own, "WARNING") | F.contains("line", F.lit("UserWarning")), "warning")


def issue_text() -> Column:
    return F.substring(F.trim(F.regexp_replace("line", STAMP + r"\s*\|?\s*", "")), 1, ISSUE)


def _stamped(lines: DataFrame) -> DataFrame:
    return lines.select("line", _found(F.col("line"), STAMP).try_cast("timestamp_ntz").alias("ts"), level().alias("level"))


def parse_pipeline_log(lines: DataFrame) -> DataFrame:
    """(ts, kind, table, branch, rows, ok, fail, detail, elapsed, attempt, tables_done, tables_total, units_total, memory, memory_peak, buffers, level) of every line that says something.

    ``ok`` of a progress line counts the units extracted. A line that fits several kinds takes the first of: progress, unit, unit_error, loaded, load_failed, no_rows, skipped, summary, issue.
    """
    df = _stamped(lines).withColumns({
        "step": _after(PROGRESS), "tag": F.split(_found(F.col("line"), r"\[([^\[\]|]+)\] "), "/"), "said": F.ltrim(F.regexp_extract("line", r"\[[^\[\]|]+\] (.*)$", 1)),
        # a summary is indented: table, outcome, pairs
        "words": F.when(F.col("line").startswith("  "), F.split(F.trim("line"), r"\s+")),
    })
    unit, table = F.size("tag") == 2, F.size("tag") == 1
    says = lambda text: table & F.col("said").startswith(text)
    outcome = F.get("words", F.lit(1))
    df = df.withColumn("kind", _kind({
        "progress": F.col("step")[0].rlike(r"^\s*\d+:\d\d:\d\d$"), "unit": unit & F.col("said").rlike(r"^[\d,]+ rows\b"), "unit_error": unit & F.split("said", ":")[0].contains("connection error"), "loaded": says(LOADED),
        "load_failed": says(LOAD_FAILED), "no_rows": says(NO_ROWS), "skipped": says(SKIPPED), "summary": outcome.isin("SUCCESS", "FAILED") & pair("disp").isNotNull(), "issue": F.col("level").isNotNull(),
    })).where("kind IS NOT NULL")
    rest = F.substring(F.trim(F.regexp_replace("said", "^[^:]*:", "")), 1, DETAIL)
    own, paired = F.element_at("tag", -1), ("loaded", "no_rows", "summary")
    return df.select(
        "ts", "kind", _by_kind({k: own for k in ("unit", "unit_error", "loaded", "load_failed", "no_rows", "skipped")} | {"summary": F.get("words", F.lit(0))}).alias("table"),
        F.when(F.col("kind").isin("unit", "unit_error"), F.col("tag")[0]).alias("branch"), F.when(F.col("kind") == "unit", _number(F.split("said", " ")[0])).otherwise(_number(pair("rows"))).alias("rows"),
        _by_kind({"progress": count_of("extract")} | {k: _number(pair("ok")) for k in paired}).alias("ok"),
        _by_kind({"progress": F.coalesce(_number(_found(F.col("line"), r"(\d+) failed")), F.lit(0))} | {k: _number(pair("fail")) for k in paired}).alias("fail"),
        _by_kind({"progress": F.trim(F.get("step", F.lit(1))), "summary": outcome, "issue": issue_text()} | {k: pair("disp") for k in ("loaded", "no_rows")} | {k: rest for k in ("unit_error", "load_failed", "skipped")}).alias("detail"),
        F.when(F.col("kind") == "progress", F.trim(F.col("step")[0])).alias("elapsed"), F.when(F.col("kind") == "unit", count_of("attempt")).alias("attempt"),
        count_of("tables").alias("tables_done"), count_of("tables", 2).alias("tables_total"), count_of("extract", 2).alias("units_total"),
        F.trim(_found(F.col("line"), r"\brss=([^(|]+)")).alias("memory"), _found(F.col("line"), r"\(peak ([^)]+)\)").alias("memory_peak"), pair("arrow").alias("buffers"), F.when(F.col("kind") == "issue", F.col("level")).alias("level"),
    )


def parse_dq_log(lines: DataFrame) -> DataFrame:
    """(ts, kind, table, branch, source_rows, lake_rows, count_delta, matched, delta, pct, status, detail, elapsed, done, total, ok, tolerated, mismatched, failed, run, branches, tables, hashed, level).

    "-" is null. Kinds: scope, progress, unit, issue. ``branches`` of a scope line is an array of names.
    """
    df = _stamped(lines).withColumns({"step": _after(DQ_PROGRESS), "own": _after(DQ_UNIT)})
    df = df.withColumn("kind", _kind({"scope": F.contains("line", F.lit(DQ_RUN)), "progress": F.col("step").isNotNull(), "unit": F.col("own").isNotNull(), "issue": F.col("level").isNotNull()})).where("kind IS NOT NULL")
    of = lambda kind, c: F.when(F.col("kind") == kind, c)
    unit = F.split(F.trim(F.col("own")[0]), "/")
    listed = F.split(F.regexp_replace(F.regexp_extract("line", r"branches=\[([^\]]*)\]", 1), r"['\" ]", ""), ",")
    window = F.trim(F.regexp_extract("line", r"window=([^|]*)", 1))
    return df.select(
        "ts", "kind", of("unit", unit[0]).alias("table"), of("unit", unit[1]).alias("branch"),
        *[_number(pair(name)).alias(alias) for name, alias in ((SOURCE_ROWS, "source_rows"), (LAKE_ROWS, "lake_rows"), ("cnt", "count_delta"), ("match", "matched"), ("delta", "delta"))],
        pair("pct").try_cast("double").alias("pct"), of("unit", F.trim(F.element_at("own", -1))).alias("status"),
        _by_kind({"scope": window, "progress": F.concat_ws("/", count_of("units").cast("string"), count_of("units", 2).cast("string")), "issue": issue_text()}).alias("detail"), of("progress", F.trim(F.col("step")[0])).alias("elapsed"),
        of("progress", count_of("units")).alias("done"), of("progress", count_of("units", 2)).alias("total"),
        *[of("progress", count_of(name)).alias(alias) for name, alias in (("ok", "ok"), ("tol", "tolerated"), ("mismatch", "mismatched"), ("err", "failed"))],
        of("scope", _found(F.col("line"), DQ_RUN + r"\s*(\S+)")).alias("run"), of("scope", F.filter(listed, lambda x: x != "")).alias("branches"), of("scope", _number(pair("tables"))).alias("tables"), of("scope", pair("hash")).alias("hashed"), of("issue", F.col("level")).alias("level"),
    )


def parse_generic_log(lines: DataFrame) -> DataFrame:
    """(kind, name, detail, updated, inserted, deleted, level) of snapshot-diff and other logs: wrote, snapshot (name and value), counts, no_changes, issue."""
    label, value = F.trim(F.substring_index("line", ":", 1)), F.trim(F.regexp_replace("line", "^[^:]*:", ""))
    arrow = F.split("line", r"(?:->|→)\s*wrote\s+")
    counted = lambda name: _number(_found(F.col("line"), rf"\b{name}\s*:\s*([\d,]+)"))
    named = label.isin("Table", "Latest", "Identity") | label.startswith("Baseline (as-of ")
    warned = F.coalesce(level(), F.when(F.contains("line", F.lit("WARNING:")), "warning"), F.when(F.contains("line", F.lit("Error")), "error"))
    df = lines.select("line", warned.alias("level")).withColumn("kind", _kind({
        "wrote": F.size(arrow) > 1, "snapshot": named & (value != ""), "counts": (label == "Updated") & counted("Deleted").isNotNull(), "no_changes": F.col("line").startswith("No updated records"), "issue": F.col("level").isNotNull(),
    })).where("kind IS NOT NULL")
    count = lambda name: _by_kind({"counts": counted(name), "no_changes": F.lit(0).cast("bigint")})
    return df.select(
        "kind", F.when(F.col("kind") == "snapshot", label).alias("name"), _by_kind({"wrote": F.trim(arrow[1]), "snapshot": value, "issue": issue_text()}).alias("detail"), count("Updated").alias("updated"), count("Inserted").alias("inserted"),
        count("Deleted").alias("deleted"), F.when(F.col("kind") == "issue", F.col("level")).alias("level"),
    )


def classify_log(lines: DataFrame, by: str | None = None) -> DataFrame:
    """(log_kind) of a log, or of each log in column ``by``. The command in its header decides; a log without one is what most of its telling lines are, else generic."""
    command = F.lower(F.when(F.col("line").startswith(COMMAND), F.substring_index("line", ":", -1)))
    named = F.coalesce(*[F.when(command.contains(word), F.lit(kind)) for word, kind in COMMANDS], F.when(command.isNotNull(), F.lit("generic")))
    has = lambda *words: reduce(Column.__or__, [F.contains("line", F.lit(w)) for w in words])
    votes = {"dq": has(DQ_PROGRESS, DQ_UNIT, DQ_RUN), "pipeline": F.col("line").rlike(r"(^|[^-\w])PROGRESS\s+\d"), "snapshot": F.col("line").startswith("Baseline (as-of") | F.col("line").startswith("Updated")}
    counted = lines.groupBy(*([by] if by else [])).agg(F.max(named).alias("named"), *[F.count_if(test).alias(kind) for kind, test in votes.items()])
    most = F.greatest(*votes)
    told = F.coalesce(*[F.when((F.col(kind) == most) & (most > 0), F.lit(kind)) for kind in votes], F.lit("generic"))
    return counted.select(*([by] if by else []), F.coalesce("named", told).alias("log_kind"))
