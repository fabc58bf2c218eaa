"""Pixel layout of decoded images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Mode codes of Spark's image source.
UNDECODABLE_MODE = -1
RGB_MODE = 16  # three 8-bit channels


@F.pandas_udf(T.BinaryType())
def _rgb_bytes(data: pd.Series, channels: pd.Series) -> pd.Series:
    """Gray, BGR or BGRA bytes as RGB bytes, image by image."""

    def convert(raw: bytes | None, n: int) -> bytes | None:
        if raw is None:
            return None
        pixels = np.frombuffer(raw, np.uint8).reshape(-1, int(n))
        if n == 1:
            return np.repeat(pixels, 3, axis=1).tobytes()
        return np.ascontiguousarray(pixels[:, 2::-1]).tobytes()

    return pd.Series([convert(raw, n) for raw, n in zip(data, channels)])


def to_rgb(image: Column) -> Column:
    """Image struct with three channels in red, green, blue order.

    The alpha channel is dropped without blending, gray is repeated. Pixels
    stay row by row from the top left.
    """
    return F.struct(
        image["origin"].alias("origin"),
        image["height"].alias("height"),
        image["width"].alias("width"),
        F.lit(3).alias("nChannels"),
        F.lit(RGB_MODE).alias("mode"),
        _rgb_bytes(image["data"], image["nChannels"]).alias("data"),
    )
