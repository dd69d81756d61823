"""What a viewer shows of volumes: slices, tiles and thinned surfaces."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import mrc


def slice_at(path: str, z: int | None = None, most: int = 1024) -> np.ndarray:
    """One plane (the middle one by default), thinned to `most` a side; only it is read."""
    h = mrc.read_header(path)
    z = h.nz // 2 if z is None else min(max(z, 0), h.nz - 1)
    plane = mrc.read_volume(path, z, 1)[0]
    step = max(1, max(plane.shape) // most)
    return plane[::step, ::step]


def slices(paths: DataFrame, most: int = 1024) -> DataFrame:
    """path, height, width, data of the middle plane of each file."""

    def cut(batches):
        for rows in batches:
            planes = [slice_at(p, None, most) for p in rows["path"]]
            yield pd.DataFrame({"path": rows["path"], "height": [p.shape[0] for p in planes], "width": [p.shape[1] for p in planes], "data": [p.astype("<f4").tobytes() for p in planes]})

    return paths.select("path").mapInPandas(cut, "path string, height int, width int, data binary")


def tile(x: Column, y: Column, size: float) -> Column:
    """The square of a map that a particle lies in."""
    return F.struct(F.floor(x / size).cast("int").alias("column"), F.floor(y / size).cast("int").alias("row"))


def thinned(volume: np.ndarray, most: int = 128) -> np.ndarray:
    step = max(1, max(volume.shape) // most)
    return volume[::step, ::step, ::step]
