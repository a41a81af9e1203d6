"""Bucketed facts: the join on sale id and four more keys moves neither of them."""

from tillback.plans.intermediate import MATCH_KEYS
from tillback.sources.tables import write_overwrite


def test_five_key_join_stays_in_its_buckets(spark, raw):
    names = {"sales": "bucketed_sales", "returns": "bucketed_returns"}
    try:
        for table, name in names.items():
            rows = raw(table, *[{"sale_id": f"SL{k}" if k % 3 else None} for k in range(60)]).select(*MATCH_KEYS)
            write_overwrite(rows, name, bucket_by="sale_id", buckets=4)
        settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
        before = {key: spark.conf.get(key) for key in settings}
        try:
            for key, value in settings.items():
                spark.conf.set(key, value)
            joined = spark.table(names["sales"]).join(spark.table(names["returns"]), MATCH_KEYS)
            assert joined.count() == 40
            assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().toString()
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)
        assert spark.table(names["sales"]).filter("sale_id is null").count() == 20
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
