"""Borough polygons from GeoJSON, as one row per polygon edge.

Each feature is a Polygon or a MultiPolygon. Every polygon (each part of a
MultiPolygon) gets its own ``polygon_id``; all its rings (outer and holes)
contribute edges, so an even-odd test per polygon handles holes. Ids are unique
across documents (a repeated document counts once), codes may be any text. Rings
need not repeat their first vertex; zero-length edges are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.schemas import GEOJSON_SCHEMA, MULTIPOLYGON_COORDS, POLYGON_COORDS

EDGE_COLUMNS = ["borough_code", "borough", "polygon_id", "x1", "y1", "x2", "y2"]


def read_borough_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Edges of the polygons in a GeoJSON file (the file is a dimension, MBs)."""
    doc = spark.read.text(path, wholetext=True)
    return geojson_edges(doc.select(F.col("value").alias("geojson")))


def geojson_text_frame(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([(text,)], "geojson string")


def borough_code(text: Column) -> Column:
    """The code as an integer; any other text as a number above all real codes, by its hash."""
    return F.coalesce(text.try_cast("int"),
                      (F.pmod(F.xxhash64(text), F.lit(1_000_000_000)) + 1_000_000_000).cast("int"))


def geojson_edges(docs: DataFrame) -> DataFrame:
    """``docs(geojson STRING)`` -> edges ``(borough_code, borough, polygon_id, x1, y1, x2, y2)``."""
    feats = (docs.distinct().select(F.xxhash64("geojson").alias("doc"), F.from_json("geojson", GEOJSON_SCHEMA).alias("g"))
             .select("doc", F.posexplode("g.features").alias("feature_idx", "f")))
    geom_type = F.col("f.geometry.type")
    coords = F.col("f.geometry.coordinates")
    polys = (F.when(geom_type == "Polygon", F.array(F.from_json(coords, POLYGON_COORDS)))
             .when(geom_type == "MultiPolygon", F.from_json(coords, MULTIPOLYGON_COORDS)))
    code_text = F.trim(F.col("f.properties.boroughCode"))
    feats = feats.select(
        F.struct("doc", "feature_idx").alias("feature_idx"),
        borough_code(code_text).alias("borough_code"),
        F.col("f.properties.borough").alias("borough"),
        polys.alias("polys"))
    # One name per code: the first feature's, as a dictionary keyed by code keeps it.
    names = (feats.groupBy("borough_code")
             .agg(F.min_by("borough", "feature_idx").alias("borough_name")))
    rings = (feats.select("borough_code", "feature_idx",
                          F.posexplode("polys").alias("part_idx", "rings"))
             .select("borough_code", "feature_idx", "part_idx",
                     F.explode("rings").alias("ring")))
    n = F.size("ring")
    edges = rings.select(
        "borough_code",
        F.xxhash64("feature_idx", "part_idx").alias("polygon_id"),
        F.explode(F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                F.get(F.get("ring", i), 0).alias("x1"),
                F.get(F.get("ring", i), 1).alias("y1"),
                F.get(F.get("ring", (i + 1) % n), 0).alias("x2"),
                F.get(F.get("ring", (i + 1) % n), 1).alias("y2")))).alias("e"))
    edges = edges.select("borough_code", "polygon_id", "e.*").where(
        (F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    return (edges.join(names, "borough_code")
            .select("borough_code", F.col("borough_name").alias("borough"), "polygon_id",
                    "x1", "y1", "x2", "y2"))


def edges_per_borough(edges: DataFrame) -> DataFrame:
    """Edge and polygon counts per borough code."""
    return edges.groupBy("borough_code").agg(
        F.count("*").alias("n_edges"),
        F.countDistinct("polygon_id").alias("n_polygons"))
