"""Read the extracts' CSV files the way the loaders do.

* Positional fields: the loader's column list maps file fields by position;
  fields past the list are dropped, missing trailing fields are NULL.
* Quoting: fields optionally enclosed in ``"`` with ``""`` inside; a bare
  ``NULL`` is NULL; the charset is a parameter. The loaders' ``latin1`` is
  windows-1252, the default here and in ``sinks.export_csv``.
* Preamble: the extract tool writes a "database context" line, a header and
  a dash rule before the data. Spark has no row skip, and counting lines
  is meaningless when a file is split across tasks, so preamble rows are
  recognised by content: the header names (blanks and underscores alike), a
  rule of dashes in every field of the header, or the context message alone on
  its line. This also drops repeated headers of multi-part output. Every other
  line is a row or a reject, blank and all-NULL lines too.
* Dates: MySQL ``STR_TO_DATE`` formats; like MySQL, trailing text after a
  complete value is ignored and numbers need not be zero-padded. A date or typed
  value that is present but does not parse sends its row to the reject frame,
  with the columns that failed, instead of being loaded as NULL silently.

The name split of F10 needs no code: an unquoted "LAST, FIRST" field is two
fields to any CSV reader, and the loader's column list names both.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import charset, csvrecords

CORRUPT = "_corrupt_record"
REASON = "_failed"
# Fixed value: the first words of the extract tool's database-context line.
CONTEXT_PREFIX = "changed database context"

# MySQL STR_TO_DATE token -> (lenient regex, Spark datetime pattern letter).
_TOKENS = {
    "%Y": (r"\d{4}", "yyyy"),
    "%m": (r"\d{1,2}", "M"),
    "%d": (r"\d{1,2}", "d"),
    "%H": (r"\d{1,2}", "H"),
    "%i": (r"\d{1,2}", "m"),
    "%s": (r"\d{1,2}", "s"),
}


@dataclass(frozen=True)
class LoadSpec:
    """A loader: file fields by position, date fields, and target columns.

    ``fields``: names for the file's fields in order.
    ``dates``: target column -> (source field, MySQL format).
    ``target``: output columns in order (plain fields or date targets).
    ``header``: the extract's header names, to recognise preamble rows.
    """

    fields: tuple
    target: tuple
    dates: dict = field(default_factory=dict)
    header: tuple = ()
    types: dict = field(default_factory=dict)   # target column -> Spark type
    charset: str = charset.DEFAULT
    null_value: str = "NULL"
    # Quoted fields may hold line breaks (the loader accepts them inside
    # enclosed fields). A batch load then reads the splits twice (``csvrecords``),
    # a stream each file in one task, so it is off unless the extract can contain them.
    multiline: bool = False


@dataclass
class Loaded:
    rows: DataFrame
    rejects: DataFrame
    parsed: DataFrame
    spec: LoadSpec

    def once(self) -> Loaded:
        """The same rows and rejects over one written copy of the parsed file, so
        that a sink that writes both reads and parses the file once."""
        return split_rows(materialize(self.parsed), self.spec)


def _compact_format(fmt: str) -> bool:
    """True when fields of the format touch each other (``%Y%m%d``)."""
    return re.search(r"%[a-zA-Z]%[a-zA-Z]", fmt) is not None


def mysql_format(fmt: str) -> tuple[str, str, bool]:
    """Translate a ``STR_TO_DATE`` format: (leading regex, Spark pattern, has_time)."""
    regex, pattern, i = "^", "", 0
    compact = _compact_format(fmt)
    while i < len(fmt):
        tok = fmt[i:i + 2]
        if tok in _TOKENS:
            rx, letter = _TOKENS[tok]
            if compact and rx.startswith(r"\d{1,2}"):
                rx, letter = r"\d{2}", letter * 2
            regex += rx
            pattern += letter
            i += 2
        else:
            ch = fmt[i]
            regex += re.escape(ch)
            pattern += f"'{ch}'" if ch.isalpha() else ch
            i += 1
    has_time = any(t in fmt for t in ("%H", "%i", "%s"))
    return regex, pattern, has_time


def parse_mysql_date(x: Column | str, fmt: str) -> Column:
    """Lenient ``STR_TO_DATE(x, fmt)``: NULL when the value does not parse."""
    c = F.col(x) if isinstance(x, str) else x
    regex, pattern, has_time = mysql_format(fmt)
    head = F.regexp_extract(F.trim(c), regex, 0)
    ts = F.try_to_timestamp(F.nullif(head, F.lit("")), F.lit(pattern))
    return ts.cast("timestamp_ntz") if has_time else F.to_date(ts)


def read_fields(spark: SparkSession, path: str, spec: LoadSpec) -> DataFrame:
    """All fields as text, plus the raw line of malformed rows."""
    if not spec.multiline:
        return decoded(with_options(spark.read, spec).csv(path), spec)
    # One record a row, whatever split it started in.
    text = F.decode("record", charset.spark_name(spec.charset))
    fields = F.from_csv(text, F.lit(file_schema(spec).simpleString()), {
        "quote": '"', "escape": '"', "nullValue": spec.null_value, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
        "multiLine": "true", "maxCharsPerColumn": "-1"})
    return decoded(csvrecords.records(spark, path).select(fields.alias("f")).select("f.*"), spec)


def file_schema(spec: LoadSpec) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in (*spec.fields, CORRUPT)])


def with_options(reader, spec: LoadSpec):
    """A batch or stream reader set to the loader's file format."""
    return (reader.schema(file_schema(spec))
            .option("header", "false")
            .option("quote", '"')
            .option("escape", '"')
            .option("nullValue", spec.null_value)
            .option("encoding", charset.spark_name(spec.charset))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", str(spec.multiline).lower()))


def decoded(raw: DataFrame, spec: LoadSpec) -> DataFrame:
    return raw.select(*[charset.after_read(F.col(c), spec.charset).alias(c) for c in raw.columns])


def preamble_row(spec: LoadSpec) -> Column:
    """True for lines that are not data: header, dash rule, context line."""
    def blank_after(n: int) -> Column:
        cond = F.lit(True)
        for f in spec.fields[n:]:
            cond = cond & F.col(f).isNull()
        return cond

    first = F.lower(F.trim(F.coalesce(F.col(spec.fields[0]), F.lit(""))))
    cond = first.startswith(CONTEXT_PREFIX) & blank_after(1)
    width = min(len(spec.header) or len(spec.fields), len(spec.fields))
    rule = blank_after(width)
    for f in spec.fields[:width]:
        rule = rule & F.coalesce(F.trim(F.col(f)).rlike("^-+$"), F.lit(False))
    cond = cond | rule
    if spec.header:
        hdr = F.lit(True)
        for f, h in zip(spec.fields, spec.header):
            name = F.regexp_replace(F.lower(F.trim(F.coalesce(F.col(f), F.lit("")))), "[ _]+", "_")
            hdr = hdr & (name == F.lit(re.sub("[ _]+", "_", h.strip().lower())))
        cond = cond | hdr
    return cond


def parse_rows(raw: DataFrame, spec: LoadSpec) -> DataFrame:
    """Drop preamble lines, parse dates and cast. ``_failed`` names the targets
    whose value is present but does not parse; it is empty for good rows. The
    file's fields stay as they were read, as ``_raw``."""
    parsed = raw.filter(~preamble_row(spec)).withColumn("_raw", F.struct(*spec.fields))
    failed = []
    for target, (src, fmt) in spec.dates.items():
        value = F.col(f"_raw.{src}")
        parsed = parsed.withColumn(target, parse_mysql_date(value, fmt))
        failed.append((target, value))
    for target, dtype in spec.types.items():
        value = F.col(f"_raw.{target}")
        parsed = parsed.withColumn(target, F.nullif(F.trim(value), F.lit("")).try_cast(dtype))
        failed.append((target, value))
    names = [F.when(v.isNotNull() & (F.trim(v) != "") & F.col(t).isNull(), F.lit(t)) for t, v in failed]
    return parsed.withColumn(REASON, F.concat_ws(",", *names) if names else F.lit(""))


def split_rows(parsed: DataFrame, spec: LoadSpec) -> Loaded:
    """Loadable rows with the target's columns; rejects with the file's fields,
    the malformed line if any, and the targets that failed."""
    rows = parsed.filter(F.col(REASON) == "").select(*spec.target)
    rejects = parsed.filter(F.col(REASON) != "").select("_raw.*", CORRUPT, REASON)
    return Loaded(rows, rejects, parsed, spec)


def load_csv(spark: SparkSession, path: str, spec: LoadSpec) -> Loaded:
    return split_rows(parse_rows(read_fields(spark, path, spec), spec), spec)
