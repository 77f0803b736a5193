"""Tables that cut lineage, kept in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tellerbook.session import working_folder


#: A stage of Python or of files is cut into so many tasks a core, or into more where a task would take more partitions.
TASKS_A_CORE, PARTITIONS_A_TASK = 8, 4


def few_tasks(rows: DataFrame) -> DataFrame:
    """The same rows in no more tasks than keep all cores evenly busy.

    Each task that starts a Python function or a file costs some ten milliseconds, however
    few its rows. Shuffles keep their partitions; a task takes several, one after another, so it
    holds no more at once. Rows of a partition stay together and in order. The number grows with that of
    the shuffle partitions, which is sized to the data.
    """
    spark = rows.sparkSession
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_A_TASK
    return rows.coalesce(max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, dealt))


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write ``rows`` once, in ``few_tasks``, and return the written table.

    What follows reads the files, so a lost executor costs no recomputation of
    what came before. Tasks put their files in place themselves, as nothing reads a table
    before its job has ended: so the driver need not move them one by one.
    """
    spark = rows.sparkSession
    path = working_folder(spark, purpose)
    few_tasks(rows).write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def need_columns(rows: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: others, whatever they are called, play no part."""
    missing = [n for n in names if n not in rows.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return rows.select(*[rows[n] for n in names])
