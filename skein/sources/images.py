"""Image files to pixel grids (X3): Spark's image source decodes in the JVM;
a small numpy step turns each decoded image into a grey grid by block means."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.separable import resample_pixels
from skein.sources.files import IMAGE_EXTS


def grey_levels(a: np.ndarray) -> np.ndarray:
    """Whole grey levels of decoded pixels (rows x columns x channels, stored as BGR(A)) by the 299/587/114
    weights in 16-bit fixed point, rounded."""
    if a.shape[2] < 3:
        return a[:, :, 0].astype(np.int64)
    b, g, r = (a[:, :, i].astype(np.int64) for i in range(3))
    return (r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16


def image_grids(spark: SparkSession, root: str, size: int = 8, exts: list[str] = IMAGE_EXTS, method: str = "block") -> DataFrame:
    """``(path, grid array<int>)``: images under ``root`` (recursive, any-case
    extension), undecodable files dropped, grey by the 299/587/114 weights,
    resized to ``size x size``. One image is one row: no shuffle.

    ``method="lanczos"`` resamples whole grey levels by a Lanczos-3 window, whatever the image's size;
    ``"block"`` takes block means, and images below ``size`` pixels each way are skipped, as undecodable ones are."""
    if method not in ("block", "lanczos"):
        raise ValueError(f"unknown method {method!r}")
    rx = r"\.(" + "|".join(exts) + r")$"
    img = (spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(root)
           .select(F.col("image.origin").alias("path"), "image.height", "image.width", "image.nChannels",
                   "image.data").filter(F.lower("path").rlike(rx)))

    def run(batches):
        for pdf in batches:
            out = []
            for path, h, w, c, data in zip(pdf["path"], pdf["height"], pdf["width"], pdf["nChannels"], pdf["data"]):
                a = np.frombuffer(bytes(data), dtype=np.uint8).reshape(h, w, c)
                if method == "lanczos":
                    out.append((path, resample_pixels(grey_levels(a), size, size).ravel().tolist()))
                    continue
                if h < size or w < size:
                    continue
                a = a.astype(np.float64)
                if c >= 3:  # stored as BGR(A)
                    grey = 0.114 * a[:, :, 0] + 0.587 * a[:, :, 1] + 0.299 * a[:, :, 2]
                else:
                    grey = a[:, :, 0]
                ys = np.linspace(0, h, size + 1).astype(int)
                xs = np.linspace(0, w, size + 1).astype(int)
                g = [int(np.floor(grey[ys[r]:ys[r + 1], xs[q]:xs[q + 1]].mean())) for r in range(size) for q in range(size)]
                out.append((path, g))
            yield pd.DataFrame(out, columns=["path", "grid"])

    return img.mapInPandas(run, "path string, grid array<int>")
