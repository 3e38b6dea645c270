"""A sample of the registered queries against their SQL at the smallest scale (tests/oracle.py runs all)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect

SAMPLE = ["evaluate", "confusion_matrix", "seg_metrics", "raster_arithmetic", "overlay_preview", "lut_join", "zoom_raster_linear", "find_mask_level",
          "tile_fill", "construct_labels", "read_region", "write_tiles", "save_data_config", "write_annotations", "write_detections", "match_left_right",
          "purpose_counts", "rename_plan", "rasterize", "annotation_join_group", "patch_boxes", "filter_regions", "region_comparison_map", "disc_density",
          "top_hotspots", "tile_grid", "skip_tiles_semi", "crop_and_mask", "blend_tiles", "tta_gmean", "adapt_patches", "lovasz_loss", "early_stopping",
          "ordered_stitch_stream", "kfold"]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, sf, con, name):
    status, n, _, _, msg = compare(spark, con, sf, name, queries()[name], oracle_sql()[name])
    assert status == "ok" and n > 0, msg


def test_entry_and_registry(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())


def test_map_state_stitching_gives_the_same_rows(spark, sf):
    """The state-store variant that keeps one entry per waiting tile."""
    from tessella.queries.tiles import stream_source
    from tessella.session import scratch_path
    from tessella.streaming import stitch as ST
    key, old = "spark.sql.streaming.stateStore.providerClass", None
    old = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = scratch_path(spark)
        ST.run_to_parquet(ST.ordered_stitch_stream_mapstate(stream_source(spark, sf, 3)), out, scratch_path(spark))
        got = {(r.slide_id, r.seq, r.value) for r in spark.read.schema(ST.OUTPUT).parquet(out).collect()}
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
    from tessella.fixtures import view
    assert got == {(r.slide_id, r.seq, r.value) for r in view(spark, sf, "stream").collect()}
