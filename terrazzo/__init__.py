"""A Spark-native engine for satellite-scene catalogues and raster mosaics."""

from importlib.metadata import version

__version__ = "0.2"


def versions() -> dict[str, str]:
    """This engine's version and those of what it runs on."""
    return {"terrazzo": __version__} | {name: version(name) for name in ("pyspark", "pyarrow", "numpy", "pandas")}
