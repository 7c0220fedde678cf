"""Text, HTML, JSON and CSV bodies that arrive as bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedframes.functions.bodies import body_shape, utf8_text

KINDS = ("text", "html", "json")


def decode_bodies(bodies: DataFrame, content: str = "content", kind: str = "kind") -> DataFrame:
    """Replace the bytes by ``text``; a ``json`` body that does not parse, or an unknown kind, fails."""
    text = utf8_text(F.col(content))
    problem = F.when(~F.col(kind).isin(*KINDS), F.concat(F.lit("unknown body kind "), F.col(kind))).when(
        (F.col(kind) == "json") & body_shape(text).isNull(), F.lit("body is not JSON")
    )
    keep = [F.col(f"`{c}`") for c in bodies.columns if c != content]
    return bodies.select(*keep, F.when(problem.isNull(), text).otherwise(F.raise_error(problem)).alias("text"))


_ESC = "\x01"  # stands before a, b and c: itself, a line end within quotes, a quote behind a backslash


def _split_lines(text: Column) -> Column:
    """Lines end where a line end has an even number of quotes before it.

    Cut at its quotes, a body is by turns outside and inside of them. The line
    ends inside are set aside until the body is cut at the others. A quote
    behind a backslash does not open or close anything.
    """
    safe = F.replace(F.replace(text, F.lit(_ESC), F.lit(f"{_ESC}a")), F.lit('\\"'), F.lit(f"{_ESC}c"))
    pieces = F.transform(
        F.split(safe, '"'), lambda piece, k: F.when(k % 2 == 1, F.replace(piece, F.lit("\n"), F.lit(f"{_ESC}b"))).otherwise(piece)
    )
    lines = F.split(F.array_join(pieces, '"'), "\r?\n")
    marks = {"b": "\n", "c": '\\"', "a": _ESC}

    def restored(line: Column) -> Column:
        for mark, held in marks.items():
            line = F.replace(line, F.lit(_ESC + mark), F.lit(held))
        return line

    return F.transform(lines, lambda line: F.when(F.contains(line, F.lit(_ESC)), restored(line)).otherwise(line))


def csv_lines(bodies: DataFrame, content: str = "content") -> DataFrame:
    """One row per line, header line included (``pos`` 0), surrounding blanks of the body removed.

    A line end within quotes belongs to its value. Quotes that are never closed
    hold all that follows, which then is no line as declared.
    """
    keep = [F.col(f"`{c}`") for c in bodies.columns if c != content]
    text = F.trim(utf8_text(F.col(content)), F.lit(" \t\r\n"))
    return bodies.select(*keep, F.posexplode(_split_lines(text)).alias("pos", "line"))


_BAD = "__bad"


def _csv_parsed(bodies: DataFrame, schema: T.StructType, content: str) -> tuple[DataFrame, list[Column]]:
    """The lines below the header with ``__row``, whose field ``__bad`` is the line if it is not as declared."""
    lines = csv_lines(bodies, content)
    keep = [F.col(f"`{c}`") for c in lines.columns if c not in ("pos", "line")]
    names = ",".join(schema.fieldNames())
    wrong = F.raise_error(F.concat(F.lit(f"CSV header should be {names}, is "), F.col("line")))
    is_row = F.when(F.col("pos") > 0, F.lit(True)).when(F.col("line") == names, F.lit(False)).otherwise(wrong)
    row = F.from_csv("line", f"{schema.toDDL()}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD})
    return lines.filter(is_row).select(*keep, "pos", "line", row.alias("__row")), keep


def csv_rows(bodies: DataFrame, schema: T.StructType, content: str = "content") -> DataFrame:
    """CSV bodies as typed rows; a body whose header is not the declared one fails.

    The header differs from endpoint to endpoint, so reading by position
    without this check could shift columns unseen. A line with more or fewer
    values, or with one that its column cannot hold, fails too; blank lines
    are no rows. :func:`csv_rejects` lists them all.
    """
    parsed, keep = _csv_parsed(bodies, schema, content)
    bad = F.col(f"__row.{_BAD}")
    told = F.raise_error(F.concat(F.lit("CSV line "), F.col("pos").cast("string"), F.lit(" is not as declared: "), bad))
    rows = parsed.filter(F.trim("line") != "").filter(F.when(bad.isNull(), F.lit(True)).otherwise(told))
    return rows.select(*keep, "pos", *[F.col(f"__row.`{c}`") for c in schema.fieldNames()])


def csv_rejects(bodies: DataFrame, schema: T.StructType, content: str = "content") -> DataFrame:
    """The lines ``pos, line`` that are no rows, each with a ``reason``: ``blank`` or ``not as declared``."""
    parsed, keep = _csv_parsed(bodies, schema, content)
    reason = F.when(F.trim("line") == "", "blank").when(F.col(f"__row.{_BAD}").isNotNull(), "not as declared")
    return parsed.select(*keep, "pos", "line", reason.alias("reason")).filter("reason is not null")
