"""Raw observation CSV files, as downloaded."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.schema import RAW_COLUMNS, RAW_SCHEMA


def read_raw_observations(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    encoding: str = "ISO-8859-1",
    path: str | None = None,
    root: str | None = None,
    stream: bool = False,
    **options,
) -> DataFrame:
    """All lines of the files as eight text columns ``c0`` .. ``c7`` and
    ``file_name``, and the whole path in a column named ``path``, if given. Lines with
    fewer fields are filled up with NULL.

    ``file_name`` is the file's own name, or with ``root`` its path below that folder,
    which keeps files of one name in several folders apart. A stream takes one path, a
    folder or a pattern, and each file once; ``options`` may bound its micro-batches.

    The files are Shift-JIS with CRLF, but only their header lines hold more than
    ASCII, and no byte of a Shift-JIS character looks like a comma or a line end.
    So the default reads bytes as they are: data rows come out right, files stay
    splittable, and no session setting is needed. ``encoding="Shift_JIS"``
    decodes the header texts too; Spark 4 allows it only with
    ``spark.sql.legacy.javaCharsets=true``.
    """
    reader = spark.readStream if stream else spark.read
    lines = (
        reader.schema(RAW_SCHEMA)
        .option("encoding", encoding)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .options(**options)
        .csv(paths)
    )
    whole = [F.col("_metadata.file_path").alias(path)] if path else []
    name = F.col("_metadata.file_name")
    if root is not None:
        name = _below(root, F.col("_metadata.file_path"))
    return lines.select(*RAW_COLUMNS, name.alias("file_name"), *whole)


def _below(root: str, file_path: Column) -> Column:
    """The path below a folder; a file that is not below it fails the job."""
    folder = urlsplit(root).path.rstrip("/") + "/"
    whole = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    place = F.instr(whole, folder)
    outside = F.raise_error(F.concat(F.lit(f"not below {folder}: "), whole)).cast("string")
    return F.when(place == 0, outside).otherwise(F.substring(whole, place + len(folder), F.length(whole)))


def common_root(paths: Sequence[str]) -> str:
    """The deepest folder that all files of the given files, folders and patterns lie below."""
    folders = []
    for path in paths:
        parts = path.rstrip("/").split("/")
        pattern = next((i for i, x in enumerate(parts) if re.search(r"[\[\]{}*?]", x)), len(parts))
        last = parts[pattern - 1] if pattern == len(parts) else ""
        folders.append(parts[: pattern - 1] if re.search(r"\.(csv|gz)$", last) else parts[:pattern])
    shared = [x[0] for x in zip(*folders) if len(set(x)) == 1]
    unlike = next((i for i, x in enumerate(zip(*folders)) if len(set(x)) > 1), len(shared))
    return "/".join(shared[:unlike])
