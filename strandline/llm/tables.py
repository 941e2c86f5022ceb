"""Written tables of an operator's rounds, freed when nothing reads them any more."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..session import release, scratch_path


@dataclass
class Table:
    """Rows that lie in the scratch folder."""

    rows: DataFrame
    path: str

    def free(self) -> None:
        """Give back the space; to be called once no later job reads the rows."""
        release(self.rows.sparkSession, self.path)


def written(df: DataFrame, name: str) -> Table:
    """``df`` written to the scratch folder, as ``session.write_through`` does, with its place."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return Table(spark.read.schema(df.schema).parquet(path), path)
