"""Driver contract, sources / sinks round trips, and oracle checks at sf0.001."""

import os
import tempfile

import pytest

import __spark_entry__ as E
from playlens.sources import read_csv, read_split_side, register_tables, register_view, write_csv, write_split, write_table
from tests.oracle import compare, duck

ORACLE_NAMES = sorted(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["users", "map", "map_at_k", "ndcg_at_k", "pairs", "rmse"]
    row = df.first()
    assert row.users > 0 and 0.0 <= row.map <= 1.0 and 0.0 <= row.ndcg_at_k <= 1.0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_oracle(spark, con, sf_small, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], sf_small)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_run_preparation_writes_scores_and_split(spark, sf_small):
    from playlens.plans.prepare import run_preparation
    from playlens.sources import fixtures as FX

    out = tempfile.mkdtemp(prefix="playlens-test-")
    paths = run_preparation(FX.catalog(spark, sf_small), FX.plays_f2(spark, sf_small), out, "x100", 52)
    scores = spark.read.parquet(paths["scores"])
    split = spark.read.parquet(paths["split"])
    assert scores.count() == split.count()
    assert split.select("user_id", "track_new_id").subtract(scores.select("user_id", "track_new_id")).count() == 0


def test_split_round_trip(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="playlens-test-"), "split")
    df = spark.createDataFrame(
        [(1, 1, 1.0, "train"), (1, 2, 2.0, "validation"), (2, 1, 3.0, "train")],
        "user_id int, track_new_id int, normalized_ranking double, dataset string",
    )
    write_split(df, out)
    assert read_split_side(spark, out, "train").count() == 2
    assert read_split_side(spark, out, "validation").columns == ["user_id", "track_new_id", "normalized_ranking"]
    with pytest.raises(Exception):
        write_split(df, out)  # default mode refuses to overwrite
    write_table(df, out, mode="overwrite")


def test_csv_with_ddl_and_view(spark):
    d = tempfile.mkdtemp(prefix="playlens-test-")
    p = os.path.join(d, "plays.csv")
    with open(p, "w") as f:
        f.write("1,msid-1\n2,msid-2\n")
    df = read_csv(spark, p, "user_id INT, recording_msid STRING")
    assert dict(df.dtypes) == {"user_id": "int", "recording_msid": "string"}
    register_view(df, "plays_csv")
    assert spark.sql("select count(*) c from plays_csv").first().c == 2


def test_csv_round_trip_keeps_null_and_empty_apart(spark, tmp_path):
    rows = [(1, None), (None, ""), (3, 'quote " and, comma'), (4, "NULL"), (5, "two\\backslashes"), (6, " spaced ")]
    df = spark.createDataFrame(rows, "user_id bigint, recording_msid string")
    for header in (False, True):
        path = write_csv(df, str(tmp_path / f"h{header}"), header=header)
        back = read_csv(spark, path, "user_id BIGINT, recording_msid STRING", header=header)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_malformed_csv_rows(spark, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text("1,msid-1\nx,msid-2\n3\n4,msid-4,more\n5,msid-5\n")
    schema = "user_id INT, recording_msid STRING"
    good = [(1, "msid-1"), (5, "msid-5")]
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, str(path), schema).collect()
    assert sorted(map(tuple, read_csv(spark, str(path), schema, malformed="drop").collect())) == good
    kept = read_csv(spark, str(path), schema, malformed="keep", corrupt_col="_bad").cache()
    assert kept.count() == 5
    assert sorted(map(tuple, kept.where("_bad IS NULL").drop("_bad").collect())) == good
    assert {r["_bad"] for r in kept.where("_bad IS NOT NULL").collect()} == {"x,msid-2", "3", "4,msid-4,more"}
    with pytest.raises(ValueError):
        read_csv(spark, str(path), schema, malformed="ignore")


def test_tables_are_registered_from_any_path(spark, sf_small):
    """A path that only Spark's readers understand; a missing table is Spark's own error."""
    assert E.q_plays_f2_sql(spark, f"file:{sf_small}").count() == E.q_plays_f2(spark, sf_small).count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        register_tables(spark, f"file:{sf_small}", ["no_such_table"])
