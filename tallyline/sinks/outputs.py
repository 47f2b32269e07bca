"""Text files by group (a day, a run): header first, rows in order, each group replaced as a whole.

Spark stages the files of all groups and moves them at the end of the job, and then writes a success marker; until then, and
after a job that failed, readers find the files of the job before, without the marker. Groups that a job does not have
stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.session import materialize, shuffles_removed
from tallyline.sinks.files import delete, exists, names, replace_text


def csv_field(value: Column, always: bool = False) -> Column:
    """Text of a CSV field, in quotes where it needs them, or always."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return quoted if always else F.when(text.rlike('[",\\n\\r]'), quoted).otherwise(text)


def csv_lines(rows: DataFrame, groups: list[str], order: list[str], columns: list[str], always: bool = False) -> DataFrame:
    """(groups, n, order..., value): a line for each row and a header line for each group, which comes first."""
    line = F.concat_ws(",", *[csv_field(F.col(f"`{c}`"), always) for c in columns]).alias("value")
    body = rows.select(*groups, F.lit(1).alias("n"), *[F.col(o).alias(f"o{k}") for k, o in enumerate(order)], line)
    head = F.lit(",".join(f'"{c}"' if always else c for c in columns)).alias("value")
    # One row of each group leaves a task.
    headers = rows.select(*groups).distinct().select(*groups, F.lit(0).alias("n"), *[
        F.lit(None).cast(body.schema[f"o{k}"].dataType).alias(f"o{k}") for k in range(len(order))], head)
    return body.unionByName(headers)


def write_lines(lines: DataFrame, path: str, groups: list[str], dealt: bool = False, compression: str = "none",
                tasks: int | None = None) -> None:
    """Write ``value`` into ``path/<group>=.../``, sorted by all other columns. Ranges of the order go to tasks, so a heavy
    group becomes several files whose names are in order. Rows that are ``dealt`` in such ranges already are not moved again. With
    ``tasks`` the ranges stay as many: where each group is a small file, files take the time and not bytes, and ranges put together by
    their bytes would leave all files to one task."""
    place = [c for c in lines.columns if c not in (*groups, "value")]
    ranges = lines if dealt else lines.repartitionByRange(*([tasks] if tasks else []), *groups, *place)
    _replace(ranges.sortWithinPartitions(*groups, *place).select(*groups, "value"), path, groups, compression)


def _replace(rows: DataFrame, path: str, groups: list[str], compression: str = "none") -> None:
    spark, marker = rows.sparkSession, f"{path}/_SUCCESS"
    delete(spark, marker)
    with shuffles_removed(spark):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression).partitionBy(
            *groups).text(path)
    replace_text(spark, marker, "")


def write_csv(rows: DataFrame, path: str, groups: list[str], order: list[str], columns: list[str], always: bool = False) -> None:
    write_lines(csv_lines(rows, groups, order, columns, always), path, groups)


def write_json(rows: DataFrame, path: str, groups: list[str], columns: list[str], order: list[str] = (), **how) -> None:
    """An object for each row, a line each; null values are written."""
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
    write_lines(rows.select(*groups, *[F.col(o).alias(f"o{k}") for k, o in enumerate(order)], line.alias("value")), path, groups, **how)


def write_chunks(payloads: DataFrame, path: str, group: str, chunk: str, value: str = "payload") -> None:
    """One text as a file of its own in ``path/<group>=.../<chunk>=.../``, chunks counted from 0. Chunks that a group had in
    an earlier job and has no more are removed once the new ones are there."""
    spark, again = payloads.sparkSession, exists(payloads.sparkSession, path)
    if again:
        payloads = materialize(payloads, "chunks")
    _replace(payloads.select(group, chunk, F.col(value).alias("value")), path, [group, chunk])
    if again:  # one row for each group of this job
        for name, last in payloads.groupBy(F.col(group).cast("string")).agg(F.max(chunk)).collect():
            folder = f"{path}/{group}={name}"
            for old in names(spark, folder, f"{chunk}="):
                if int(old) > last:
                    delete(spark, f"{folder}/{chunk}={old}")


def read_lines(spark: SparkSession, path: str, groups: list[str]) -> DataFrame:
    """(groups as text, line_no, line) as they stand in the files; line 0 is the first. Values hold no line feeds."""
    whole = spark.read.option("wholetext", True).text(path).select(
        *[F.col(g).cast("string").alias(g) for g in groups], F.col("_metadata.file_name").alias("file"), "value")
    lines = whole.select(*groups, "file", F.posexplode(F.split(F.rtrim("value", F.lit("\n")), "\n")).alias("pos", "line"))
    number = F.row_number().over(Window.partitionBy(*groups).orderBy("file", "pos")) - 1
    return lines.select(*groups, number.alias("line_no"), "line")
