"""Plan shape: pruning, pushdown, bounded top-k, shared scan work."""

import contextlib
import io

import __spark_entry__ as E
from pyspark.sql import functions as F

from playlens.operators.metrics import per_user_ranking
from playlens.operators.recommend import top_k_per_group


def _explain(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_scans_are_pruned_and_filtered(spark, sf_small):
    plan = _explain(E.q_minmax_x100(spark, sf_small))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<p_partkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_per_group_top_k_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    plan = _explain(top_k_per_group(df, "g", [F.col("v").desc()], 5))
    assert "WindowGroupLimit" in plan


def test_pair_aggregation_runs_once(spark, sf_small):
    df = E.q_minmax_x100(spark, sf_small)
    df.collect()
    assert "ReusedExchange" in _explain(df)


def test_no_python_udf_in_preparation(spark, sf_small):
    plan = _explain(E.q_split_ordered_80(spark, sf_small))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


PRODUCTS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow")

# MLlib's exact top-k scores every user block against every item block: that
# product is the workload's own feature, and the only one allowed.
MLLIB_TOP_K = {n for n in E._QUERIES if n.startswith(("als_list_shape_", "als_topk_", "als_lists_exact_")) or n in ("als_recommended_ids", "als_metrics", "als_metrics_rank250")}
# Blocks of factors are multiplied in Arrow tasks.
FACTOR_TOP_K = {n for n in E._QUERIES if n.startswith("topk_") and n != "topk_scores"}
# Whole grids of fits; their rows come from a local table.
GRID = {"grid_results", "grid_best", "grid_results_x1", "grid_best_x1"}


def test_no_cross_products_or_python_udfs(spark, sf_small):
    """Every query of the library plans without all-pairs joins or Python, but for the two kinds of top-k."""
    for name in sorted(set(E._QUERIES) - GRID):
        plan = _explain(E.queries()[name](spark, sf_small))
        products, python = ({op for op in ops if op in plan} for ops in (PRODUCTS, PYTHON))
        if name in MLLIB_TOP_K:
            assert products <= {"CartesianProduct"}, (name, products)
        elif name in FACTOR_TOP_K:
            assert not products and python <= {"FlatMapCoGroupsInArrow", "ArrowEvalPython"}, (name, products, python)
        else:
            assert not products and not python, (name, products, python)


def test_metrics_rank_only_hits(spark):
    lists = spark.range(100).selectExpr("id % 5 AS user_id", "id AS track_new_id", "CAST(id / 5 + 1 AS INT) AS pos")
    labels = spark.range(0, 100, 7).selectExpr("id % 5 AS user_id", "id AS track_new_id")
    plan = _explain(per_user_ranking(lists, labels, 10))
    window, join = plan.index("Window"), plan.index("Inner")
    assert "row_number" in plan and window < plan.rindex("Inner") and join > 0


def test_scores_are_prepared_once(spark, sf_small):
    """The list metrics read one score table, once as lists and once as labels."""
    spark.catalog.clearCache()
    E._KEPT.clear()
    plan = _explain(E.q_map_all(spark, sf_small))
    assert "InMemoryTableScan" in plan
    outside = plan.split("InMemoryRelation")[0]
    assert "lineitem" not in outside


def test_kept_tables_are_bounded(spark, sf_small):
    E._KEPT.clear()
    made = [E._kept(spark, "test", i, build=lambda: spark.range(3)) for i in range(E.MAX_KEPT + 2)]
    assert len(E._KEPT) == E.MAX_KEPT and not made[0].is_cached and made[-1].is_cached
    again = E._kept(spark, "test", E.MAX_KEPT + 1, build=lambda: None)
    assert again is made[-1]
    for df in made:
        df.unpersist()
    E._KEPT.clear()
