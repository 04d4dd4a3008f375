"""Driver contract: entry smoke, registry and oracle keys."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["Risk_Label", "Action_ID"] and len(df.columns) == 20
    assert df.count() > 0


def test_every_oracle_key_is_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    no_sql = set(E.QUERIES) - set(E.ORACLE)
    assert no_sql == {"gbt_predictions", "gbt_early_stop", "gbt_continued", "score_new_events",
                      "feature_importance", "explain_events", "gbt_model_comparison", "gbt_tuned_threshold",
                      "gbt_validation_threshold", "explain_events_wide", "feature_importance_comparison"}


def test_small_queries_match_oracle(spark, fixture_dir):
    """Every oracle-backed query at sf0.001 against DuckDB (same compare as the driver)."""
    import duckdb

    from tools.check_oracle import _rows

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{fixture_dir}/events.parquet')")
    q, o = E.queries(), E.oracle_sql()
    for name, sql in E.ORACLE.items():
        df = q[name](spark, fixture_dir)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(cols), name
        assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), cols), name


def test_scale_conf_sizes_partitions():
    from leakwatch.session import scale_conf

    conf = scale_conf(100 * 2**40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (128 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 24
