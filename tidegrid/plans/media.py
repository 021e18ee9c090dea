"""Videos of an export: probed where a decoder is installed, and reported as skipped where not."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Greatest mean difference of a decoded frame from its image.
MOST_MAE = 12.0


def decoder():
    """The video decoder's module, or None."""
    try:
        import cv2
    except ImportError:
        return None
    return cv2


def probe(videos: DataFrame, fps: float) -> DataFrame:
    """Per video path: status (ok, skipped or error), frames and what is wrong; ``frames`` is expected."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cv2 = decoder()
        for batch in batches:
            rows = []
            for path, expected in zip(batch["path"], batch["frames"], strict=True):
                if cv2 is None:
                    rows.append((path, "skipped", None, "no decoder"))
                    continue
                video = cv2.VideoCapture(path)
                found, rate = int(video.get(cv2.CAP_PROP_FRAME_COUNT)), video.get(cv2.CAP_PROP_FPS)
                wrong = "not readable" if not video.isOpened() else "frames" if found != expected else "rate" if abs(rate - fps) > 1e-3 else None
                video.release()
                rows.append((path, "error" if wrong else "ok", found, wrong))
            yield pd.DataFrame(rows, columns=["path", "status", "found", "problem"]).astype({"found": "Int64"})

    return videos.select("path", "frames").mapInPandas(run, "path string, status string, found long, problem string")


def findings(differences: DataFrame, most: float = MOST_MAE) -> DataFrame:
    """Sampled frames, with ``d`` from ``image_difference``, that differ too much or have swapped channels."""
    bad = (F.col("d.mae") > most) | F.col("d.swapped") | F.col("d.mae").isNull()
    return differences.where(F.coalesce(bad, F.lit(True)))
