"""One row of an export, and wide tables of sensor vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, sorted_json, wide
from ..functions.profiles import value_names
from ..operators.lookups import row_slice
from ..operators.statistics import vector_summary
from ..sources.schemas import EXPORT_META, RAW_META, SIDES


def locate(rows: DataFrame, episodes: DataFrame, index: int | None = None, episode: int | None = None, frame: int | None = None) -> DataFrame:
    """The row of a global index, or of a frame of an episode; an error if there is none."""
    if index is None:
        span = episodes.where(F.col("episode_index") == (episode or 0)).select("dataset_from_index", "dataset_to_index").first()
        if span is None:
            raise ValueError(f"no episode {episode}")
        index = span["dataset_from_index"] + (frame or 0)
        if not span["dataset_from_index"] <= index < span["dataset_to_index"]:
            raise ValueError(f"no frame {frame} in episode {episode}")
    found = rows.where(F.col("index") == index)
    if not found.limit(1).count():
        raise ValueError(f"no row {index}")
    return found


def summary(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Size, least, greatest, mean and first values of each vector of each row."""
    parts = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), vector_summary(c(n)).alias("s")) for n in columns]))
    return rows.select("index", parts.alias("p")).select("index", "p.column", "p.s.*")


def sides(which: str) -> tuple[str, ...]:
    if which == "both":
        return SIDES
    if which not in SIDES:
        raise ValueError(f"side {which!r} is not left, right or both")
    return (which,)


def raw_wide(store: DataFrame, metadata: DataFrame, side: str, dim: int, package: str | None = None, layout: dict | None = None, start: int = 0, limit: int | None = None) -> DataFrame:
    """Store rows with their log entry: 19 columns and a column for each value."""
    part = row_slice(store, "store_index", start, limit, store.count())
    log = metadata.withColumn("layout_json", sorted_json(F.col("layout"))) if "layout" in metadata.columns else metadata
    joined = part.join(log.withColumnRenamed("zarr_index", "key__"), F.col("store_index") == F.col("key__"), "left")
    known = {"side": F.lit(side), "zarr_index": F.col("store_index")}
    if "layout_json" in joined.columns:
        known["layout_json"] = F.coalesce("layout_json", F.lit("{}"))
    columns = [known.get(n, c(n) if n in joined.columns else F.lit(None).cast("string")).alias(n) for n in RAW_META]
    return joined.select(*columns, *wide(F.col("data"), value_names(dim, package, None, layout)))


def export_wide(rows: DataFrame, side: str, dim: int, dtype: str = "float32", package: str | None = None, layout: dict | None = None, start: int = 0, limit: int | None = None) -> DataFrame:
    """Exported rows of a side: 7 columns and a column for each value."""
    part = row_slice(rows, "index", start, limit, rows.count())
    known = {"side": F.lit(side), "global_index": F.col("index"), "dtype": F.lit(dtype)}
    columns = [known.get(n, F.col(n) if n in part.columns else F.lit(None).cast("string")).alias(n) for n in EXPORT_META]
    return part.select(*columns, *wide(c(f"observation.tactile_{side}"), value_names(dim, package, None, layout)))
