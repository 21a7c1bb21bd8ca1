"""Feature scans, the shared folder, seasons and the feed."""

import json
import os
from datetime import date, datetime

from pyspark.sql import functions as F

from perilframe import io
from perilframe.operators import rings
from perilframe.plans import storm
from perilframe.sources import tables
from perilframe.streaming import feed

SQUARE, HOLE, FAR = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]], [[10, 10], [12, 10], [12, 12.5], [10, 10]]


def test_features_of_all_kinds(spark, tmp_path):
    shapes = [("Point", [1.5, 2]), ("MultiPoint", [[1, 2], [3, 4]]), ("LineString", [[0, 0], [1, 1], [2, 0]]), ("MultiLineString", [[[0, 0], [1, 1]], [[5, 5], [6, 6], [7, 7]]]), ("Polygon", [SQUARE, HOLE]), ("MultiPolygon", [[SQUARE, HOLE], [FAR]])]
    features = [{"type": "Feature", "properties": {"name": k, "n": i, "none": None}, "geometry": {"type": k, "coordinates": c}} for i, (k, c) in enumerate(shapes)]
    features += [{"type": "Feature", "properties": None, "geometry": None}, {"type": "Feature", "properties": {}, "geometry": {"type": "GeometryCollection", "geometries": []}}]
    (tmp_path / "all.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, features)) + "\nbroken {\n")
    got = tables.scan_features(spark, str(tmp_path / "all.json")).cache()
    want = []
    for i, (k, c) in enumerate(shapes):
        parts = {"Point": [[[c]]], "MultiPoint": [[[p]] for p in c], "LineString": [[c]], "MultiLineString": [[x] for x in c], "Polygon": [c], "MultiPolygon": c}[k]
        want += [(i, k, k, p, r, s, float(xy[0]), float(xy[1])) for p, rs in enumerate(parts) for r, vs in enumerate(rs) for s, xy in enumerate(vs)]
    assert sorted((r.feature, r.kind, r.properties["name"], r.part, r.ring, r.seq, r.x, r.y) for r in got.collect()) == sorted(want)
    by_line = tables.scan_features(spark, str(tmp_path / "lines.json"), lines=True)
    assert sorted((r.kind, r.part, r.ring, r.seq, r.x, r.y) for r in by_line.collect()) == sorted((w[1], *w[3:]) for w in want)
    covered = rings.ring_cover(tables.rings_of(got, ["feature"]), 1.0, ["feature"]).groupBy("feature").count()
    assert dict(covered.collect()) == {4: 15, 5: 18}


def test_cleanup_deletes_what_was_written(spark):
    path = io.written(spark.range(3), "to-be-deleted").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and io.cleanup(spark) >= 1 and not os.path.exists(os.path.dirname(path)) and io.cleanup(spark) == 0


def test_seasons_by_their_column(spark):
    rows = spark.createDataFrame([(1, "1998", date(1997, 12, 1)), (2, "1997", date(1997, 12, 1)), (3, " ", date(1999, 1, 1)), (4, None, date(1999, 1, 1))], "sid long, SEASON string, iso_time date")
    assert [r.sid for r in storm.in_seasons(rows, 1998).collect()] == [1]
    assert [r.sid for r in storm.in_seasons(rows.drop("SEASON"), 1998).collect()] == [3, 4]


def test_feed(spark, tmp_path):
    kinds = "l_id long, l_start date, l_end date, l_lat double, l_lon double"
    spark.createDataFrame([(1, date(2000, 1, 1), None, 0.0, 0.0), (2, date(2000, 5, 1), None, 0.0, 0.0)], kinds).write.parquet(str(tmp_path / "in"))
    losses = spark.createDataFrame([(7, date(2000, 1, 3), None, 1.0, 0.5)], "r_id long, r_start date, r_end date, r_lat double, r_lon double")
    stream = spark.readStream.schema(kinds).parquet(str(tmp_path / "in"))
    feed.match_feed(stream, losses, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [(r.l_id, r.r_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(1, 7)]
    events = spark.createDataFrame([(datetime(2024, 1, 1, 5), "a"), (datetime(2024, 1, 1, 7), "a"), (datetime(2024, 1, 2), "b")], "ts timestamp, event_type string")
    assert sorted((r.event_type, r["count"]) for r in feed.windowed_counts(events).collect()) == [("a", 2), ("b", 1)]
