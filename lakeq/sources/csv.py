"""CSV scans that keep every value as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.names import quoted

# Encodings tried in order by the profiling reader.
DEFAULT_ENCODINGS = ("utf-8", "cp1252", "latin1")

# Windows-1252 differs from Latin-1 in bytes 80-9F only; five of them stand for nothing.
_C1 = [bytes([b]) for b in range(0x80, 0xA0)]
_CP1252_UNDEFINED = "".join(b.decode("latin-1") for b in _C1 if not b.decode("cp1252", "ignore"))
_CP1252_FROM = "".join(b.decode("latin-1") for b in _C1 if b.decode("cp1252", "ignore"))
_CP1252_TO = "".join(b.decode("cp1252") for b in _C1 if b.decode("cp1252", "ignore"))


def read_csv_strings(spark: SparkSession, path, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Header row, no type inference — every column is a string.

    Quoting follows RFC 4180 (a quote inside quotes is doubled); ``multi_line``
    allows line breaks inside quotes, at the price of one task per file. Files
    read together must have the same header: one with other or reordered columns
    fails when it is read, instead of being taken by position."""
    reader = (spark.read.option("header", True).option("inferSchema", False).option("encoding", encoding)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line))
    df = reader.csv(path)
    if len(df.inputFiles()) < 2:
        return df
    schema = T.StructType([T.StructField(c, T.StringType()) for c in df.columns])
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def _as_utf8(c: Column) -> Column:
    """Text read byte by byte as Latin-1, as the UTF-8 its bytes are."""
    return F.encode(c, "ISO-8859-1").cast("string")


def read_csv_with_fallback(spark: SparkSession, path, encodings=DEFAULT_ENCODINGS,
                           multi_line: bool = False) -> tuple[DataFrame, str]:
    """The first of ``encodings`` that every byte of the data fits (trap T9).

    Spark does not raise on bad bytes, so the file is read as Latin-1, which keeps
    every byte, and one aggregate tests the values: valid UTF-8, or free of the
    bytes that Windows-1252 leaves undefined. Latin-1 always fits. A path that
    cannot be read raises Spark's own error. Returns (frame, encoding)."""
    raw = read_csv_strings(spark, path, "ISO-8859-1", multi_line)
    cols = [F.col(quoted(c)) for c in raw.columns]
    headers = [c.encode("latin-1", "ignore") for c in raw.columns]
    tests = {"utf-8": [~F.is_valid_utf8(_as_utf8(c)) for c in cols],
             "cp1252": [c.rlike(f"[{_CP1252_UNDEFINED}]") for c in cols]}
    wanted = [e.lower() for e in encodings]
    bad = raw.agg(*[F.coalesce(F.bool_or(_any(v)), F.lit(False)).alias(k) for k, v in tests.items()]).first() if cols else {
        k: False for k in tests}

    def header_fits(encoding: str) -> bool:
        try:
            b"".join(headers).decode(encoding)
        except UnicodeDecodeError:
            return False
        return True

    for encoding in wanted:
        if encoding not in (*tests, "latin1"):
            raise ValueError(f"encoding {encoding!r} is not one of {', '.join(DEFAULT_ENCODINGS)}")
        if not header_fits(encoding) or encoding in tests and bad[encoding]:
            continue
        decode = {"utf-8": _as_utf8, "cp1252": lambda c: F.translate(c, _CP1252_FROM, _CP1252_TO),
                  "latin1": lambda c: c}[encoding]
        names = [h.decode(encoding) for h in headers]
        names = [n.removeprefix("﻿") if i == 0 else n for i, n in enumerate(names)]
        return raw.select([decode(c).alias(n) for c, n in zip(cols, names)]), encoding
    raise ValueError(f"{path}: its bytes fit none of {', '.join(wanted)}")


def read_csv_by_file(spark: SparkSession, path, encodings=DEFAULT_ENCODINGS, multi_line: bool = False,
                     file_col: str = "source_file", encoding_col: str = "source_encoding") -> DataFrame:
    """S2 over a folder whose files differ in encoding: the first of ``encodings`` that
    every byte of a file fits is chosen for that file, and its rows are decoded by it.

    One aggregate by file tests the bytes; its rows (one a file) are joined back to the
    text by file, so the text is read twice and never shuffled while files are few.
    Adds the file and its encoding as columns. A file that fits none has a NULL encoding
    and NULL values, so that the others can still be used; names of columns are taken
    as UTF-8 where they are, else as the last encoding."""
    wanted = [e.lower() for e in encodings]
    unknown = [e for e in wanted if e not in ("utf-8", "cp1252", "latin1")]
    if unknown:
        raise ValueError(f"encoding {unknown[0]!r} is not one of {', '.join(DEFAULT_ENCODINGS)}")
    raw = read_csv_strings(spark, path, "ISO-8859-1", multi_line)
    cols = {c: F.col(quoted(c)) for c in raw.columns}
    rows = raw.select(*cols.values(), F.col("_metadata.file_path").alias(file_col))
    fails = {"utf-8": _any([~F.is_valid_utf8(_as_utf8(c)) for c in cols.values()]),
             "cp1252": _any([c.rlike(f"[{_CP1252_UNDEFINED}]") for c in cols.values()]), "latin1": F.lit(False)}
    chosen = F.coalesce(*[F.when(~F.bool_or(fails[e]), F.lit(e)) for e in wanted], F.lit(None).cast("string"))
    verdicts = rows.groupBy(file_col).agg(chosen.alias(encoding_col))
    decoded = {"utf-8": _as_utf8, "cp1252": lambda c: F.translate(c, _CP1252_FROM, _CP1252_TO), "latin1": lambda c: c}

    def name(c: str) -> str:
        data = c.encode("latin-1", "ignore")
        try:
            return data.decode("utf-8").removeprefix("\ufeff")
        except UnicodeDecodeError:
            return data.decode(wanted[-1])

    def value(c: Column) -> Column:
        out = F.lit(None).cast("string")
        for e in wanted:
            out = F.when(F.col(encoding_col) == e, decoded[e](c)).otherwise(out)
        return out

    # A side of one row a file: AQE broadcasts it while it is small, else the join shuffles.
    return rows.join(verdicts, file_col).select(*[value(v).alias(name(c)) for c, v in cols.items()], file_col, encoding_col)
