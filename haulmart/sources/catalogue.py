"""The delay-cause catalogue that every installation starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Code, name, category.
DELAY_CAUSES = (
    ("TRAFICO", "Tráfico", "EXTERNA"),
    ("CLIMA", "Clima", "EXTERNA"),
    ("FALLA_MECANICA", "Falla mecánica", "MECANICA"),
    ("DOCUMENTACION", "Documentación", "INTERNA"),
    ("CARGA_DESCARGA", "Carga y descarga", "INTERNA"),
    ("ACCIDENTE", "Accidente", "EXTERNA"),
    ("OTRO", "Otro", "EXTERNA"),
    ("NO_ESPECIFICADA", "No especificada", "EXTERNA"),
)


def delay_causes(spark: SparkSession) -> DataFrame:
    rows = [(i, *row, True) for i, row in enumerate(DELAY_CAUSES, start=1)]
    return spark.createDataFrame(
        rows, "id bigint, code string, name string, category string, is_active boolean"
    )


def read_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A fixture file: a JSON array of {model, pk, fields{...}} records."""
    fields = (
        "code string, name string, category string, is_active boolean, "
        "created_at timestamp, updated_at timestamp"
    )
    records = (
        spark.read.schema(f"model string, pk bigint, fields struct<{_typed(fields)}>")
        .option("multiLine", True)
        .json(path)
    )
    return records.select(F.col("pk").alias("id"), "fields.*")


def _typed(fields: str) -> str:
    return ", ".join(":".join(f.split()) for f in fields.split(","))
