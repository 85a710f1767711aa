"""Inputs: rasters as pixel tables, scene catalogues, polygons as edge tables, GeoJSON and GeoTIFF."""
