"""Spec normalisation (type rules, key / not-null flags) and the catalogue."""

from __future__ import annotations

import pytest

from histlake.plans import TableSpec, catalog_rows, normalize_spec, spark_type, table_rows
from histlake.plans.spec import table_name

KEY, NN = "主键", "非空"

SPEC_ROWS = [
    (1, "ID", "number(11)", KEY),
    (2, "qty", "number", None),
    (3, "small", "number(10)", NN),
    (4, "name", "varchar2(50)", f"{KEY},{NN}"),
    (5, "code", "varchar2(4)", None),
    (6, "label", "nvarchar2(20)", None),
    (7, "created", "DATE", NN),
    (8, "body", "clob", None),
    (9, "score", "integer", None),
    (10, "rid", "rowid", None),
    (11, "flag", "char(1)", None),
    (12, "stamp", "timestamp(6)", None),
    (13, "price", "number(10,2)", None),
    (14, None, "number", None),
]
EXPECTED = {
    "id": "bigint", "qty": "int", "small": "int", "name": "varchar(50)", "code": "varchar(10)",
    "label": "varchar(20)", "created": "timestamp", "body": "varchar(5000)", "score": "double",
    "rid": "varchar(10)", "flag": "varchar(10)", "stamp": "varchar(10)", "price": None,
}


@pytest.fixture()
def spec_df(spark):
    return spark.createDataFrame(SPEC_ROWS, "col_pos long, col_name string, col_type string, "
                                            "col_constraint string")


def test_type_rules_and_flags(spec_df):
    out = {r.col_name: r for r in normalize_spec(spec_df, table="ERP.Some-Table").collect()}
    assert set(out) == set(EXPECTED)                      # the row without a name is skipped
    assert {k: r.col_type for k, r in out.items()} == EXPECTED
    assert out["price"].type_error.startswith("unparsable type")
    assert {k for k, r in out.items() if r.is_key} == {"id", "name"}
    assert {k for k, r in out.items() if r.is_required} == {"id", "name", "small", "created"}
    assert {r.tbl_name for r in out.values()} == {"erp_some_table"}


def test_from_normalized_raises_on_bad_type_and_builds_spec(spark, spec_df):
    norm = normalize_spec(spec_df, table="t1")
    with pytest.raises(ValueError):
        TableSpec.from_normalized(norm, "t1")
    good = normalize_spec(spec_df.filter("col_type <> 'number(10,2)'"), table="t1")
    spec = TableSpec.from_normalized(good, "t1", database="db")
    assert spec.keys == ("id", "name")
    assert spec.required == ("small", "created")
    assert spec.column_names[:3] == ["id", "qty", "small"]
    assert spec.m_table == "db.m_t1"
    assert spark_type("varchar(50)").simpleString() == "string"
    assert spark_type("timestamp").simpleString() == "timestamp_ntz"
    assert spec.schema["id"].dataType.simpleString() == "bigint"


def test_table_without_key_is_refused(spark):
    df = spark.createDataFrame([(1, "a", "int", None)], "col_pos long, col_name string, "
                                                       "col_type string, col_constraint string")
    with pytest.raises(ValueError):
        TableSpec.from_normalized(normalize_spec(df, table="nokey"), "nokey")


def test_table_name_rule():
    assert table_name("Sales.Order-Lines") == "sales_order_lines"


def test_catalog_rows(spark):
    sheet = spark.createDataFrame(
        [(" ID ", "number", KEY, " the id ", None, "1", " 2"),
         ("Name", "varchar2(5)", "['x']", "", "c", None, None),
         (None, "int", None, None, None, None, None)],
        "col_name string, col_type string, col_constraint string, col_desc string, "
        "comments string, sample_data string, sec_lvl_id string")
    out = catalog_rows(sheet, schema_name="lake", table="items").collect()
    assert len(out) == 6
    assert {r.tbl_name for r in out} == {"f_items", "ff_items", "m_items"}
    first = [r for r in out if r.col_name == "id" and r.tbl_name == "m_items"][0]
    assert (first.data_source, first.schema_name, first.col_desc, first.comments,
            first.sample_data, first.sec_lvl_id, first.col_constraint) == \
        ("Hive", "lake", "the id", "", "1", "2", f"['{KEY}']")
    second = [r for r in out if r.col_name == "name"][0]
    assert second.col_constraint == "['x']"
    assert "col_type" not in sheet.drop("col_type").columns
    tables = spark.createDataFrame([("cat", "theme", "sys", "me", "desc", "daily", "1", "c", "src", "L1")],
                                   "data_category string, themes string, owner_sys string, owner string, "
                                   "tbl_desc string, data_frequency string, sec_lvl_id string, "
                                   "comments string, data_source string, tbl_std_lvl string")
    trows = table_rows(tables, "lake", table="items").collect()
    assert sorted(r.tbl_name for r in trows) == ["f_items", "ff_items", "m_items"]


@pytest.mark.parametrize("table", ["region", "orders", "lineitem", "events", "documents", "embeddings", "pages",
                                   "benchmark", "labels", "conversations"])
def test_from_schema_of_every_given_table(spark, table):
    """Types without a rule of their own pass through unchanged."""
    from conftest import SF001

    from histlake.plans.spec import spark_type
    schema = spark.read.parquet(f"{SF001}/{table}.parquet").schema
    spec = TableSpec.from_schema(table, schema, (schema.fieldNames()[0],))
    assert [n for n, _ in spec.columns] == schema.fieldNames()
    for (_, text), field in zip(spec.columns, schema.fields, strict=True):
        assert spark_type(text).typeName().split("_")[0] == field.dataType.typeName().split("_")[0]
    for t in ("float", "smallint", "tinyint", "boolean", "binary", "decimal", "array<float>", "map<string,int>"):
        assert spark_type(t) is not None
    with pytest.raises(ValueError):
        spark_type("no such type")
