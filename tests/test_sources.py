import datetime as dt
import gzip
from decimal import Decimal

import pytest

from tillback.domains import DIMENSIONS, TABLES, columns
from tillback.operators.quality import row_counts
from tillback.session import MAX_SHUFFLE_BLOCKS, shuffle_partitions, split_bytes
from tillback.sources.landing import copy_into, list_stage, write_csv
from tillback.sources.scratch import shared_folder
from tillback.sources.tables import (
    checked_identifier, copy_to_bronze, create_namespace, layer_schema, publish_views, qualified, read_mart,
    write_overwrite,
)
from tillback.streaming.incremental import copy_new_files

HEADER = ",".join(columns("stores"))


def landing(tmp_path, *lines, name="stores.csv", header=HEADER):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


def test_fields_are_typed_and_trimmed(spark, tmp_path):
    path = landing(tmp_path, 'S1, "North, Main" ,Ottawa,ON,East,mall,2020-01-31', "S2,NULL,null,,East,mall,01/31/2020")
    rows = {row.store_id: row for row in copy_into(spark, "stores", path).collect()}
    assert rows["S1"].store_name == "North, Main" and rows["S1"].open_date == dt.date(2020, 1, 31)
    assert (rows["S2"].store_name, rows["S2"].city, rows["S2"].province) == (None, None, None)
    assert rows["S2"].open_date == dt.date(2020, 1, 31)
    assert rows["S1"].source_file == "stores.csv" and rows["S1"].loaded_at is not None


@pytest.mark.parametrize("line", ["S1,North,Ottawa,ON,East,mall", "S1,North,Ottawa,ON,East,mall,2020-01-31,more"])
def test_wrong_field_count_fails_even_a_count(spark, tmp_path, line):
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        copy_into(spark, "stores", landing(tmp_path, line)).count()


def test_bad_value_fails_the_load(spark, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        copy_into(spark, "stores", landing(tmp_path, "S1,North,Ottawa,ON,East,mall,2020-02-30")).collect()


def test_fields_go_by_position_unless_the_header_is_checked(spark, tmp_path):
    swapped = ",".join(reversed(columns("stores")))
    path = landing(tmp_path, "S1,North,Ottawa,ON,East,mall,2020-01-31", header=swapped)
    assert copy_into(spark, "stores", path).first().store_id == "S1"
    with pytest.raises(Exception, match="(?i)header"):
        copy_into(spark, "stores", path, check_header=True).collect()


def test_compressed_numbers_and_switch_words(spark, tmp_path):
    path = tmp_path / "products.csv.gz"
    line = "P1,Lamp,home,decor,B,10.005,5,ON"
    path.write_bytes(gzip.compress((",".join(columns("products")) + "\n" + line + "\n").encode()))
    row = copy_into(spark, "products", str(path)).first()
    assert (row.unit_price, row.active_flag) == (Decimal("10.01"), True)


def test_write_and_list(spark, tmp_path, raw):
    path = str(tmp_path / "out")
    written = raw("customers", {"city": 'A "quoted", place'}, {"customer_id": "C2", "city": None}).select(*columns("customers"))
    write_csv(written, path)
    read = copy_into(spark, "customers", path).select(*columns("customers"))
    assert sorted(read.collect(), key=str) == sorted(written.collect(), key=str)
    listed = [row for row in list_stage(spark, path).collect() if row.path.endswith(".csv")]
    assert listed and all(row.length > 0 for row in listed)


def test_new_files_are_taken_once(spark, tmp_path):
    folder = landing(tmp_path, "S1,North,Ottawa,ON,East,mall,2020-01-31")
    target, checkpoint = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    copy_new_files(spark, "stores", folder, target, checkpoint)
    copy_new_files(spark, "stores", folder, target, checkpoint)
    assert spark.read.parquet(target).count() == 1
    landing(tmp_path, "S2,South,Ottawa,ON,East,mall,2020-01-31", name="more.csv")
    copy_new_files(spark, "stores", folder, target, checkpoint, files_per_batch=1)
    rows = {row.store_id: row.source_file for row in spark.read.parquet(target).collect()}
    assert rows == {"S1": "stores.csv", "S2": "more.csv"}


def test_partitions_follow_the_input_size():
    assert shuffle_partitions(0) == 200
    for size in (10**12, 10**14, 10**15):
        tasks = size // split_bytes(size)
        assert shuffle_partitions(size, size) * tasks <= MAX_SHUFFLE_BLOCKS
        assert shuffle_partitions(size) <= shuffle_partitions(size, size)


def test_names():
    assert layer_schema(None, "raw") == "raw" and layer_schema(" MARTS ", "raw") == "MARTS"
    assert qualified(" db ", "marts", "t_1$") == "DB.MARTS.T_1$"
    for bad in ("a.b", "a b", "", "x;drop"):
        with pytest.raises(ValueError):
            checked_identifier(bad)


def test_shared_folder_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_bronze_views_and_reading_back(spark, raw):
    create_namespace(spark, "source_layer", "bronze_layer")
    sources = {}
    for table in TABLES:
        sources[table] = f"source_layer.{table}"
        write_overwrite(raw(table, {}), sources[table])
    targets = copy_to_bronze(spark, sources, "bronze_layer")
    copy_to_bronze(spark, sources, "bronze_layer")
    assert [row.row_count for row in row_counts({n: spark.table(t) for n, t in targets.items()}).collect()] == [1] * 6
    assert read_mart(spark, "bronze_layer", "bronze_stores").columns == spark.table("source_layer.stores").columns
    publish_views({"stores_now": spark.table(targets["stores"])})
    assert spark.sql("select count(*) from stores_now").first()[0] == 1
    assert set(DIMENSIONS) < set(TABLES)
