"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

from tracklake.plans import registry

DATA = "/root/testdata/sf0.001"
NAMES = ["source_audit", "class_counts", "match_detections", "nms", "image_level", "gap_filled", "track_decisions", "track_events", "auroc", "event_peaks", "sequence_features", "window_frames", "clip_decisions", "curation_manifest", "curation_names", "kept_negatives", "average_precision", "group_fold", "event_overlaps", "event_evaluation", "frame_features", "box_forms", "row_folds"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    got = registry.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.sql(registry.ORACLE_SQL[name])
    assert columns == sorted(want.columns)
    rows = lambda found: sorted(repr(tuple(r)) for r in found)
    assert rows(map(list, got.select(columns).collect())) == rows(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())
