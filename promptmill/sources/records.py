"""Record files: JSON lines or one JSON array per file, strict.

``read_records`` gives one row per record with its provenance
``(src_idx, src_file, block_start, seq)``, which sorts back into input order, the record itself as
VARIANT ``rec`` and its JSON text ``raw``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variants import is_object, with_strict_json
from ..operators.sizes import parts_for
from .json_array import read_array_elements

PROVENANCE = ["src_idx", "src_file", "block_start", "seq"]
# What a line is called wherever its files lie and however they are split.
IDENTITY = ["src_idx", "src_path", "line_no"]
_SNIFF_THREADS = 32
#: Rows numbered together.
_BLOCK_ROWS = 1024


def read_lines(spark: SparkSession, paths: str | Sequence[str], src_idx: int = 0) -> DataFrame:
    """Text lines with provenance.  Files are split freely; no shuffle."""
    return (
        spark.read.text([paths] if isinstance(paths, str) else list(paths))
        .select(
            F.lit(src_idx).alias("src_idx"),
            F.col("_metadata.file_path").alias("src_file"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("seq"),
            F.col("value"),
        )
    )


def lines_with_provenance(df: DataFrame, text: str, src_idx: int = 0, src_file: str = "") -> DataFrame:
    """Give any DataFrame of lines the columns ``read_lines`` gives."""
    return df.select(
        F.lit(src_idx).alias("src_idx"),
        F.lit(src_file).alias("src_file"),
        F.lit(0).cast("long").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
        F.col(text).alias("value"),
    )


def in_input_order(df: DataFrame) -> DataFrame:
    """Sort by provenance: a range-partitioned sort, so part files follow input order too."""
    return df.orderBy(*PROVENANCE)


def line_numbers(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add the 1-based line number within the file to ``wanted``, a subset of ``lines``.

    Blank lines count.  No file is gathered in one task: lines are counted per input split
    (partial aggregation), only those counts are summed up along each file, and a row's own
    position in its split is a subtraction.
    """
    split_key = ["src_idx", "src_file", "block_start"]
    per_split = lines.groupBy(*split_key).agg(
        F.min("seq").alias("first_seq"), F.count("*").alias("n_lines")
    )
    along_file = (
        "sum(n_lines) over (partition by src_idx, src_file order by block_start "
        "rows between unbounded preceding and 1 preceding)"
    )
    starts = per_split.select(
        *split_key, "first_seq", F.coalesce(F.expr(along_file), F.lit(0)).alias("lines_before")
    )
    return wanted.join(starts, split_key).select(
        *[wanted[c] for c in wanted.columns],
        (F.col("lines_before") + F.col("seq") - F.col("first_seq") + 1).alias("line_no"),
    )


def relative_path(roots: Sequence[str]) -> Column:
    """The path of ``src_file`` below the root of its source; the file's name if it is the root.

    A root that is a pattern leaves the whole path, which is at least unique.
    """
    file = F.col("src_file")
    path = file
    for i, root in enumerate(roots):
        below = quote(re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/"), safe="/%:=@&+$,;~!'()-_.")
        inside = F.locate(f"{below}/", file)
        rest = F.substring(file, inside + len(below) + 1, F.length(file))
        name = F.when(F.endswith(file, F.lit(below)), F.element_at(F.split(file, "/"), -1)).otherwise(file)
        path = F.when(F.col("src_idx") == i, F.when(inside > 0, rest).otherwise(name)).otherwise(path)
    return path


def with_identity(lines: DataFrame, rows: DataFrame, roots: Sequence[str]) -> DataFrame:
    """``rows``, a subset of ``lines``, with the columns of ``IDENTITY`` added."""
    return line_numbers(lines, rows).withColumn("src_path", relative_path(roots))


def with_record_identity(rows: DataFrame, roots: Sequence[str]) -> DataFrame:
    """``rows`` (one per record, with provenance) with ``src_path`` and ``record_no`` added.

    The number counts the records of a file from 1, blank lines and layout aside, so it does not
    depend on how files are split or where they lie.  Rows are numbered by blocks of an input split, and
    the counts of the blocks are summed up along each file, so no task holds a whole split.  Rows go to
    as many partitions as their size needs.  Hand in a written table: it is read three times.
    """
    block = ["src_idx", "src_file", "block_start", "_block"]
    placed = rows.withColumn("_block", F.floor(F.col("seq") / _BLOCK_ROWS))
    in_block = f"row_number() over (partition by {', '.join(block)} order by seq)"
    along = "sum(n) over (partition by src_idx, src_file order by block_start, _block rows between unbounded preceding and 1 preceding)"
    counts = placed.groupBy(*block).agg(F.count("*").alias("n"))
    starts = counts.select(*block, F.coalesce(F.expr(along), F.lit(0)).alias("_before"))
    dealt = placed.repartition(parts_for(rows), *block)
    numbered = dealt.withColumn("_place", F.expr(in_block)).join(starts, block)
    columns = [*rows.columns, relative_path(roots).alias("src_path"), (F.col("_before") + F.col("_place")).alias("record_no")]
    return numbered.select(*columns)


def parse_records(lines: DataFrame) -> DataFrame:
    """Strict parse of lines: blank lines are skipped, a malformed one ends the job."""
    problem = F.concat(
        F.lit("not a JSON object, in "), F.col("src_file"), F.lit(": "), F.col("value")
    )

    parsed = with_strict_json(lines, F.col("value"), "_rec")
    checked = F.when(is_object(F.col("_rec")), F.col("_rec")).otherwise(
        F.raise_error(problem).cast("variant")
    )
    # A generator is never pruned: every line is checked, whatever is read of it.
    return parsed.select(*PROVENANCE, F.explode(F.array(checked)).alias("rec"), F.col("value").alias("raw"))


def _first_char_of_files(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """The first character of each file, one byte read per file."""
    jvm = spark.sparkContext._jvm
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()

    def first(file: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(file)
        stream = path.getFileSystem(hadoop_conf).open(path)
        try:
            byte = stream.read()
        finally:
            stream.close()
        return chr(byte) if byte >= 0 else ""

    with ThreadPoolExecutor(_SNIFF_THREADS) as pool:
        return list(pool.map(first, files))


def sniff_layout(spark: SparkSession, paths: str | Sequence[str]) -> tuple[list[str], list[str]]:
    """Sort the files below ``paths`` into (array files, line files) by first character.

    Only ``[`` in the very first place makes an array; leading white space does not count as
    that.  The work on the driver is one byte per file, like a file listing; name the layout to
    ``read_records`` to leave it out.
    """
    listing = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    files = sorted(unquote(f) for f in listing.inputFiles())
    chars = _first_char_of_files(spark, files)
    arrays = [f for f, c in zip(files, chars) if c == "["]
    lines = [f for f, c in zip(files, chars) if c != "["]
    return arrays, lines


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: str = "auto",
    src_idx: int = 0,
) -> DataFrame:
    """Read records from JSON arrays and/or JSON lines, in any mix of files.

    ``layout`` is ``auto`` (look at each file's first character), ``array`` or ``lines``.
    """
    if layout == "auto":
        arrays, lines = sniff_layout(spark, paths)
    elif layout in ("array", "lines"):
        all_paths = [paths] if isinstance(paths, str) else list(paths)
        arrays, lines = (all_paths, []) if layout == "array" else ([], all_paths)
    else:
        raise ValueError(f"layout must be auto, array or lines, not {layout!r}")
    parts = []
    if lines:
        parts.append(parse_records(read_lines(spark, lines, src_idx)))
    if arrays:
        parts.append(parse_records(read_array_elements(spark, arrays, src_idx)))
    if not parts:
        empty = spark.createDataFrame([], "value string")
        parts.append(parse_records(lines_with_provenance(empty, "value", src_idx)))
    return reduce(DataFrame.unionByName, parts)


def concat_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate sources in list order; ``src_idx`` becomes the position in the list."""
    if not frames:
        raise IndexError("no source to concatenate")
    placed = [df.withColumn("src_idx", F.lit(i)) for i, df in enumerate(frames)]
    return reduce(DataFrame.unionByName, placed)
