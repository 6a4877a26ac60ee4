"""Training-CSV scan: header row, quoted fields, explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tokens pandas' read_csv treats as missing by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

SCHEMA = "row_id BIGINT, prompt STRING, sentence STRING, label STRING"


def write(df: DataFrame, path: str) -> None:
    """Header + quoted fields; values keep their leading/trailing blanks."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def read(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
          .schema(schema).csv(path))
    text_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select(*[F.when(F.col(c).isin(NA_TOKENS), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if c in text_cols else F.col(c) for c in df.columns])
