"""Archive manifests, integrity checks and unpacking."""

from __future__ import annotations

import io
import zipfile
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expected_hash(line: str | Column) -> Column:
    """First whitespace-separated token of ``"<sha256 hex>  <file name>"``."""
    c = F.col(line) if isinstance(line, str) else line
    return F.lower(F.split(F.trim(c), r"\s+")[0])


def verify_checksums(content: DataFrame, manifest: DataFrame, key: str = "file_name") -> DataFrame:
    """SHA-256 of each file's bytes against its manifest line.

    ``content`` has ``(file_name, content binary)`` — e.g. the ``binaryFile`` source
    with a derived file name; ``manifest`` has ``(file_name, line)``.  Files without
    a manifest line (or the reverse) are reported with ``status`` instead of failing."""
    c = content.select(key, F.sha2(F.col("content"), 256).alias("actual"))
    m = manifest.select(key, expected_hash("line").alias("expected"))
    j = c.join(m, key, "full_outer")
    status = (F.when(F.col("actual").isNull(), F.lit("missing_file"))
               .when(F.col("expected").isNull(), F.lit("missing_checksum"))
               .when(F.col("actual") == F.col("expected"), F.lit("ok"))
               .otherwise(F.lit("mismatch")))
    return j.select(key, "expected", "actual", status.alias("status"))


def binary_files(spark, path_glob: str, name_pattern: str = r"([^/]+)$", recursive: bool = False) -> DataFrame:
    """S10 input: the ``binaryFile`` source, with the file name taken from the path (one row per file, so a task holds
    one file's bytes at a time).  ``recursive`` takes ``path_glob`` for a folder and reads everything below it."""
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path_glob).select(F.regexp_extract("path", name_pattern, 1).alias("file_name"), "content")


def manifest_lines(spark, path: str) -> DataFrame:
    """S10 X15 input: manifest files of ``"<sha256 hex>  <file name>"`` lines as ``(file_name, line)``; the mark of binary
    mode (``*``) before a name is not part of it, blank lines are no entries."""
    d = spark.read.text(path).where(F.trim("value") != "")
    return d.select(F.regexp_extract(F.trim("value"), r"^\S+\s+\*?(.*)$", 1).alias("file_name"), F.col("value").alias("line"))


def _unzip_batches(batches):
    """One frame per member, so a task holds one member's text; what cannot be read gives a null text."""
    def frame(name, member, text):
        return pd.DataFrame({"file_name": [name], "member": [member], "text": [text]}, dtype="object")

    unreadable = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, ValueError, TypeError)
    for pdf in batches:
        for name, blob in zip(pdf["file_name"], pdf["content"]):
            try:
                zf = zipfile.ZipFile(io.BytesIO(bytes(blob)))
            except unreadable:
                yield frame(name, None, None)
                continue
            with zf:
                for member in zf.namelist():
                    try:
                        yield frame(name, member, zf.read(member).decode("utf-8", errors="replace"))
                    except unreadable:
                        yield frame(name, member, None)


def unpack_zip(archives: DataFrame) -> DataFrame:
    """Zip archives ``(file_name, content)`` -> their CSV lines ``(file_name, member, line)``.

    Each task opens its own archives with the standard library (Arrow batches in,
    Arrow batches out); lines are split and parsed by Spark afterwards.  A broken
    archive yields one row with a null member, a broken member one with a null line."""
    members = archives.select("file_name", "content").mapInPandas(
        _unzip_batches, "file_name string, member string, text string")
    lines = members.select("file_name", "member", F.explode_outer(F.split(F.col("text"), "\r?\n")).alias("line"))
    return lines.filter(F.col("line").isNull() | (F.length("line") > 0))


def zip_text(name: str, text: str) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        zf.writestr(name, text)
    return buf.getvalue()


def pack_zip(lines: DataFrame, group: list[str], name_col: str = "file_name", line_col: str = "line",
             order_col: str | None = None) -> DataFrame:
    """Build one zip per ``group`` holding its lines as ``<file_name>.csv`` (archive fixture
    builder; one group = one archive file, e.g. a symbol-day)."""
    cols = [*group, name_col, line_col] + ([order_col] if order_col else [])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        if order_col:
            pdf = pdf.sort_values(order_col)
        name = pdf[name_col].iloc[0]
        blob = zip_text(f"{name}.csv", "\n".join(pdf[line_col].astype(str)) + "\n")
        return pd.DataFrame({name_col: [f"{name}.zip"], "content": [blob]})

    return lines.select(*cols).groupBy(*group).applyInPandas(pack, f"{name_col} string, content binary")


def work_manifest(symbols: DataFrame, first_day: Column, last_day: Column, unit: str = "day",
                  interval_label: str = "1h", symbol: str = "symbol") -> DataFrame:
    """Every (symbol, period) archive file that should exist, with its name
    and relative path.  Periods come from ``sequence`` per symbol row (the bounds are
    scalar Columns), so the product is generated row-wise, never by a cross join."""
    step = F.expr("INTERVAL 1 DAY") if unit == "day" else F.expr("INTERVAL 1 MONTH")
    fmt = "yyyy-MM-dd" if unit == "day" else "yyyy-MM"
    d = symbols.select(symbol, F.explode(F.sequence(first_day, last_day, step)).alias("period"))
    name = F.format_string("%s-%s-%s", F.col(symbol), F.lit(interval_label), F.date_format("period", fmt))
    return d.select(symbol, "period", name.alias("file_name"),
                    F.concat_ws("/", F.col(symbol), F.lit(interval_label), F.concat(name, F.lit(".zip")))
                    .alias("path"))


def missing_files(manifest: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted minus present (left anti join) — re-runs only fetch what is missing."""
    return manifest.join(present.select(*keys).distinct(), keys, "left_anti")
