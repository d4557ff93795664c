"""Delimited text: comma and tab separated files, plain or compressed."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.functions.text import present

_RECORD = "_unfit_record"
#: Columns that a file may have unless the caller says otherwise.
MAX_COLUMNS = 65536


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or glob is there, on any Hadoop file system."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    multiline: bool = False,
    strict: bool = True,
    max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """All columns of a headed file, as text, named by its header line.

    A short line is padded with NULLs. A line whose fields beyond the header's
    hold anything raises when ``strict``; otherwise the surplus is ignored and
    the line is kept. Either way the outcome does not depend on which columns a
    query selects: strict mode parses all columns of a line, keeps the text of
    lines that do not fit, and looks at every surplus field of those.

    A header of more than ``max_columns`` names raises.

    ``multiline`` admits line breaks inside quotes and makes each file one
    split, so it is off unless the file has free text.
    """
    options = {
        "sep": sep,
        "header": True,
        "quote": '"',
        "escape": '"',
        "multiLine": multiline,
        "mode": "PERMISSIVE",
        "maxCharsPerColumn": -1,
        "maxColumns": max_columns,
    }
    names = spark.read.options(**options).csv(path).columns
    fields = [T.StructField(n, T.StringType()) for n in names]
    if not strict:
        return spark.read.schema(T.StructType(fields)).options(**options).csv(path)
    declared = T.StructType([*fields, T.StructField(_RECORD, T.StringType())])
    rows = (
        spark.read.schema(declared)
        .options(**options, columnPruning=False, columnNameOfCorruptRecord=_RECORD)
        .csv(path)
    )
    message = F.concat(
        F.lit(f"a line of {path} has too many fields; it begins with "),
        F.coalesce(F.col(f"`{names[0]}`"), F.lit("nothing")),
    )
    intact = F.assert_true(~_has_surplus(F.col(_RECORD), sep, len(names)), message)
    return rows.where(intact.isNull()).drop(_RECORD)


def _has_surplus(record: Column, sep: str, width: int) -> Column:
    """Whether a field after the first ``width`` is not empty."""
    unquoted = F.regexp_replace(record, '"(?:[^"]|"")*"', "q")
    parts = F.split(unquoted, re.escape(sep))
    surplus = F.slice(parts, width + 1, F.greatest(F.size(parts) - width, F.lit(0)))
    return F.coalesce(F.exists(surplus, lambda x: F.trim(x) != ""), F.lit(False))


def _cast(text: Column, kind: T.DataType, strict: bool) -> Column:
    if isinstance(kind, T.StringType):
        return text
    # narrow integers may be written with a decimal point when the file's
    # producer had missing values in the column
    if isinstance(kind, (T.ByteType, T.ShortType)):
        text = text.cast("double") if strict else text.try_cast("double")
    return text.cast(kind) if strict else text.try_cast(kind)


def typed(
    rows: DataFrame, schema: T.StructType, strict: bool = True, extras: bool = False
) -> DataFrame:
    """Replace missing-value tokens by NULL and cast text to ``schema``.

    Fields are matched by name. ``extras`` also passes on columns that the
    schema does not list, as text. A value that does not fit its type raises
    when ``strict`` and becomes NULL otherwise.
    """
    missing = [n for n in schema.names if n not in rows.columns]
    if missing:
        raise ValueError(f"columns not found in the file: {', '.join(missing)}")
    kinds = {f.name: f.dataType for f in schema}
    wanted = rows.columns if extras else schema.names
    return rows.select(
        *[
            _cast(present(rows[f"`{n}`"]), kinds.get(n, T.StringType()), strict).alias(n)
            for n in wanted
        ]
    )
