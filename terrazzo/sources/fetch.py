"""Downloads: a table of addresses becomes a table of validated files.

Every address is read by the task that holds its row, tried again after a growing wait, and checked to be a GeoTIFF that
opens and has its last block. Files are rows; nothing is left on an executor's disk, and what a lost executor had read is
read again. Writing the result as a table makes it durable at once or not at all.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from terrazzo.sources import raster

#: Seconds that an address may stay silent, and answers after which another attempt makes sense.
SILENT, AGAIN = 180, frozenset({408, 429, 500, 502, 503, 504})


def pause(attempt: int) -> int:
    """Seconds before the next attempt: five more each time, a minute at most."""
    return min(60, 5 * attempt)


def sound(content: bytes) -> bool:
    """Whether a GeoTIFF opens and its last pixel can be read."""
    try:
        _, tags = raster.directory(content)
        return raster.decode(content, (tags[raster.WIDTH][0] - 1, tags[raster.HEIGHT][0] - 1, 1, 1)).data.size > 0
    except (ValueError, KeyError, ArithmeticError, IndexError):
        return False


def read(url: str, chunk: int) -> bytes:
    held = []
    with urllib.request.urlopen(url, timeout=SILENT) as answer:  # noqa: S310
        while part := answer.read(chunk):
            held.append(part)
    return b"".join(held)


def fetched(url: str, attempts: int, chunk: int, unit: float) -> tuple[bytes | None, int, str | None]:
    """Content, attempts made, and why there is no content."""
    why = "no attempt"
    for attempt in range(1, attempts + 1):
        try:
            content = read(url, chunk)
            if sound(content):
                return content, attempt, None
            why = "not a whole GeoTIFF"
        except urllib.error.HTTPError as e:
            why = f"status {e.code}"
            if e.code not in AGAIN:
                return None, attempt, why
        except (OSError, ValueError) as e:
            why = f"{type(e).__name__}: {e}"[:200]
        if attempt < attempts:
            time.sleep(pause(attempt) * unit)
    return None, attempts, why


def download(assets: DataFrame, attempts: int = 3, chunk: int = 8 << 20, email: str | None = None, unit: float = 1.0) -> DataFrame:
    """The columns of assets (one of them url), content, attempts and error: a row for each address, whether it came or not.
    email is sent along where the archive asks for it; unit is how long a second of waiting takes."""
    keys = assets.columns
    if "url" not in keys:
        raise ValueError("assets need a column url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, url in enumerate(batch.column("url").to_pylist()):
                if email and url:
                    url += ("&" if "?" in url else "?") + urllib.parse.urlencode({"email": email})
                content, tried, why = fetched(url, attempts, chunk, unit) if url else (None, 0, "no address")
                own = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array([content], pa.binary()), pa.array([tried], pa.int32()), pa.array([why], pa.string())], [*keys, "content", "attempts", "error"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in assets.schema.fields)
    return assets.mapInArrow(run, f"{kinds}, content binary, attempts int, error string")
