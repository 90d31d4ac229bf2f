"""Zipped monthly bar files."""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.operators.klines import VALUE_COLUMNS, kline_outcomes, parse_kline_rows
from barflow.schemas import BAR_COLUMNS
from barflow.session import drop_path, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Symbol, bar width, and the month or day that an archive holds.
FILE_NAME = r"([^/]+)-([0-9]+[smhdwM]o?)-([0-9]{4}-[0-9]{2}(?:-[0-9]{2})?)\.zip$"
LINES_PER_BATCH = 20_000
_FIELDS = "open_time STRING, " + ", ".join(f"{name} STRING" for name in VALUE_COLUMNS)


def _fault(content) -> str | None:
    """Why an archive's first member cannot be unpacked to its end, checksum included; None if it can."""
    import io
    import zipfile
    import zlib

    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = archive.namelist()
            if not names:
                return "empty_archive"
            with archive.open(names[0]) as member:
                while member.read(1 << 20):
                    pass
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, OSError, ValueError):
        return "bad_archive"
    return None


def _unzip(batches):
    """Lines of each archive's first member; an archive that cannot be unpacked whole gives none.

    Bytes that are no UTF-8 become replacement characters, so that only their line is unreadable.
    """
    import io
    import zipfile

    import pandas as pd

    def lines_of(content):
        if _fault(content):
            return
        with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open(archive.namelist()[0]) as member:
            yield from io.TextIOWrapper(member, "utf-8", errors="replace", newline="")

    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            buffer = []
            for line in lines_of(content):
                buffer.append(line.rstrip("\r\n"))
                if len(buffer) == LINES_PER_BATCH:
                    yield pd.DataFrame({"path": path, "line": buffer})
                    buffer = []
            if buffer:
                yield pd.DataFrame({"path": path, "line": buffer})


def _faults(batches):
    import pandas as pd

    for batch in batches:
        found = [(path, _fault(content)) for path, content in zip(batch["path"], batch["content"])]
        yield pd.DataFrame([f for f in found if f[1]], columns=["path", "reason"])


def archive_lines(files: DataFrame) -> DataFrame:
    """``path, line`` of ``path, content`` rows; unpacked in bounded batches on the workers."""
    return files.select("path", "content").mapInPandas(_unzip, "path string, line string")


def archive_rows(files: DataFrame) -> DataFrame:
    """Text fields of every archived line; symbol and interval come from the file name.

    Files whose name says neither or that cannot be unpacked are left out whole; ``archive_rejects`` and
    ``archive_faults`` list them.
    """
    fields = F.from_csv("line", _FIELDS)
    return archive_lines(files.where(F.rlike("path", F.lit(FILE_NAME)))).select(
        F.regexp_extract("path", FILE_NAME, 1).alias("symbol"),
        F.regexp_extract("path", FILE_NAME, 2).alias("interval"),
        fields.alias("f"),
    ).select("symbol", "interval", "f.*")


def archive_rejects(files: DataFrame) -> DataFrame:
    """``path, reason`` of the files that ``archive_rows`` leaves out for their name."""
    return files.where(~F.rlike("path", F.lit(FILE_NAME))).select("path", F.lit("bad_name").alias("reason"))


def archive_faults(files: DataFrame) -> DataFrame:
    """``path, reason`` of the well-named files that cannot be unpacked to their end."""
    named = files.where(F.rlike("path", F.lit(FILE_NAME))).select("path", "content")
    return named.mapInPandas(_faults, "path string, reason string")


def archive_klines(files: DataFrame) -> DataFrame:
    """Typed bars of every readable archived line."""
    return parse_kline_rows(archive_rows(files))


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """All zip files below ``path``; files are the unit of parallelism."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def archive_kline_scan(spark: SparkSession, path: str) -> DataFrame:
    """Bars of all archives below ``path``. Lazy, so every archive is inflated twice; see ``load_archives``."""
    return archive_klines(archive_files(spark, path))


# --- one pass with side outputs ---------------------------------------------


def _outcomes(batches):
    """One row a line, and one with a reason for an archive that breaks off; every archive is inflated once.

    Lines reach Spark before the end of their archive is known. What came of a broken one is taken out later, by
    its row.
    """
    import io
    import re
    import zipfile
    import zlib

    import pandas as pd

    broken = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, OSError, ValueError)
    named = re.compile(FILE_NAME)

    def frame(path, start, lines, fault=None):
        at = range(start, start + len(lines))
        return pd.DataFrame({"path": path, "line_no": at, "line": lines, "fault": [fault] * len(lines)})

    def pieces(path, content):
        buffer, start = [], 0
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = archive.namelist()
            if not names:
                raise KeyError(path)
            with archive.open(names[0]) as member:
                for line in io.TextIOWrapper(member, "utf-8", errors="replace", newline=""):
                    buffer.append(line.rstrip("\r\n"))
                    if len(buffer) == LINES_PER_BATCH:
                        yield frame(path, start, buffer)
                        start, buffer = start + len(buffer), []
        if buffer:
            yield frame(path, start, buffer)

    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            if not named.search(path):
                yield frame(path, 0, [None], "bad_name")
                continue
            try:
                yield from pieces(path, content)
            except KeyError:
                yield frame(path, 0, [None], "empty_archive")
            except broken:
                yield frame(path, 0, [None], "bad_archive")


@dataclass(frozen=True)
class ArchiveLoad:
    """What one pass over a set of archives gave. All three frames read one stored table.

    ``bars``: the bars of whole archives. ``rejects``: ``path, line_no, reason`` of their unreadable
    lines, numbered from 0; a heading in line 0 is no reject. ``faults``: ``path, reason`` of archives
    of which nothing is taken: ``bad_name``, ``empty_archive``, ``bad_archive``.
    """

    bars: DataFrame
    rejects: DataFrame
    faults: DataFrame
    path: str

    def drop(self) -> None:
        """Delete the stored table; the frames cannot be read afterwards."""
        drop_path(self.bars.sparkSession, self.path)


def load_archives(files: DataFrame) -> ArchiveLoad:
    """Read and parse every archive of ``path, content`` rows once, with bars, rejects and faults as side outputs.

    The pass is written below the shared folder: typed values for bars, the reason for what is none. Empty
    input gives three empty frames; files given twice give their rows twice; a null content is a ``bad_archive``.
    """
    spark = files.sparkSession
    known = files.where("path IS NOT NULL").select("path", F.coalesce("content", F.lit(b"")).alias("content"))
    lines = known.mapInPandas(_outcomes, "path string, line_no bigint, line string, fault string")
    fields = F.from_csv("line", _FIELDS)
    named = lines.select(
        "path",
        "line_no",
        "fault",
        F.regexp_extract("path", FILE_NAME, 1).alias("symbol"),
        F.regexp_extract("path", FILE_NAME, 2).alias("interval"),
        fields.alias("f"),
    ).select("path", "line_no", "fault", "symbol", "interval", "f.*")
    heading = (F.col("line_no") == 0) & F.col("fault").isNull() & F.rlike("open_time", F.lit("^\\s*[A-Za-z]"))
    parsed = kline_outcomes(named.where(~F.coalesce(heading, F.lit(False))), ("path", "line_no", "fault"))
    target = scratch_path(spark, "archives")
    parsed.write.parquet(target)
    whole = spark.read.schema(parsed.schema).parquet(target)
    faults = whole.where("fault IS NOT NULL").select("path", F.col("fault").alias("reason"))
    # lines of an archive that broke off later; the few broken ones are a side that Spark sizes by itself
    kept = whole.where("fault IS NULL").join(faults.select("path").distinct(), "path", "left_anti")
    return ArchiveLoad(
        kept.where("reason IS NULL").select(*BAR_COLUMNS),
        kept.where("reason IS NOT NULL").select("path", "line_no", "reason"),
        faults,
        target,
    )
