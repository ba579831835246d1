"""Photos that may be used under a license with a given property."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import flag
from marlstone.sources.schemas import MISSING_COORDINATE


def located_and_licensed(pictures: DataFrame) -> DataFrame:
    """Pictures with a license and both coordinates; a null coordinate drops the picture too."""
    return pictures.select("photo_id", "longitude", "latitude", "license").where(
        F.col("license").isNotNull()
        & (F.col("longitude") != MISSING_COORDINATE)
        & (F.col("latitude") != MISSING_COORDINATE)
    )


def with_license_flag(pictures: DataFrame, licences: DataFrame, property_name: str) -> DataFrame:
    """Pictures whose license has the property; pictures of unlisted licenses drop out."""
    chosen = licences.where(flag(F.col(property_name))).select("Name")
    return pictures.alias("p").join(chosen.alias("l"), F.col("l.Name") == F.col("p.license")).select("p.*")
