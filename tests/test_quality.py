"""Data-quality checks and schema conformance on hand-made dirty rows."""

from pyspark.sql import types as T

from depot.operators import quality as Q


def test_conform_to_schema_dirty_values(spark):
    df = spark.createDataFrame([("1", "12.345678", "2024-01-02"), ("x", "abc", "not a date")],
                               "id string, amount string, d string")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(12, 4)),
                           T.StructField("d", T.DateType()), T.StructField("extra", T.StringType())])
    rows = Q.conform_to_schema(df, schema).collect()
    assert [r.id for r in rows] == [1, None]
    assert str(rows[0].amount) == "12.3457" and rows[1].amount is None
    assert rows[1].d is None and rows[0].extra is None


def test_checks_find_violations(spark):
    parent = spark.createDataFrame([(1,), (2,)], "pid long")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None), (12, 2)], "cid long, pid long")
    dup = {r.key_value: r.n for r in Q.check_unique({"child": (child, [["cid"]])}).collect()}
    assert dup == {"12": 2}
    fk = {r.foreign_key: r.orphans for r in Q.check_foreign_keys([("child.pid", child, "pid", parent, "pid")]).collect()}
    assert fk == {"child.pid": 1}
    nn = {r.column_name: r.null_count for r in Q.check_not_null({"child": (child, ["cid", "pid"])}).collect()}
    assert nn == {"cid": 0, "pid": 1}
    ne = {r.table_name: (r.failed, r.reason) for r in
          Q.check_non_empty({"child": child, "none": child.filter("cid < 0"), "missing": None}).collect()}
    assert ne == {"child": (False, "ok"), "none": (True, "empty"), "missing": (True, "missing")}
    seq = Q.check_sequential_ids({"child": (child, "cid")}, start=10).first()
    assert not seq.ok and seq.n == 4 and seq.n_distinct == 3


def test_sequential_ids_shuffle_blocks_not_ids(spark):
    ids = {"all": spark.range(1, 20_001).toDF("i"), "twice": spark.range(100).selectExpr("id div 2 + 1 AS i"),
           "odd": spark.createDataFrame([(-65,), (None,), (-64,), (0,), (2**63 - 1,), (-2**63,), (0,)], "i long"),
           "none": spark.range(0).toDF("i"), "text": spark.createDataFrame([("1",), ("2",)], "i string")}
    got = {r.table_name: tuple(r)[1:] for r in Q.check_sequential_ids({n: (df, "i") for n, df in ids.items()}).collect()}
    assert got == {"all": (20_000, 20_000, 1, 20_000, True), "twice": (100, 50, 1, 50, False),
                   "odd": (7, 5, -2**63, 2**63 - 1, False), "none": (0, 0, None, None, True), "text": (2, 2, 1, 2, True)}
    seen = Q.check_sequential_ids({"all": (spark.range(1, 20_001, 1, 2).toDF("i"), "i")})
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright(id" in plan and "count(distinct" not in plan.lower()        # a row per 64 ids is shuffled


def test_cast_losses_are_counted(spark):
    from pyspark.sql import types as T
    from depot.operators.quality import conform_losses, conform_to_schema
    df = spark.createDataFrame([("1", "12.345"), ("x", "99999999"), (None, "7")], "a string, b string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DecimalType(6, 2)), T.StructField("c", T.StringType())])
    assert {r.column_name: r.lost for r in conform_losses(df, schema).collect()} == {"a": 1, "b": 1}
    assert conform_to_schema(df, schema).count() == 3


def test_all_declared_tables_have_a_spec():
    from depot.sources.schemas import SPECS
    assert len(SPECS) == 32
    for spec in SPECS.values():
        names = [c for c, _ in spec.columns]
        assert len(set(names)) == len(names) and set(spec.not_null) <= set(names) and set(spec.keys[0]) <= set(spec.not_null)
        for key in spec.keys:
            assert set(key) <= set(names)
        for column, parent, key in spec.foreign:
            assert column in names and [key] in SPECS[parent].keys


def test_declared_checks_on_dirty_tables(spark):
    """Every declared table, empty but for the dirty rows of three of them."""
    from depot.sources.schemas import SPECS
    tables = {n: spark.createDataFrame([], s.struct) for n, s in SPECS.items()}
    tables["vendors"] = spark.createDataFrame([("1", "a"), ("1", "b"), ("x", None), (None, "d")], "vendor_id string, vendor_name string")
    tables["items"] = spark.createDataFrame([(1, "s1", 1, "2.5"), (2, "s1", 7, "much"), (3, None, None, "99999999")], "item_id int, item_sku string, vendor_id int, weight_lb string")
    tables["vendor_item_details"] = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 7, 5), (4, None, 1)], "vendor_item_id long, vendor_id long, item_id long")
    got = {(r.table_name, r.check_name, r.subject): r.failures for r in Q.check_declared(tables, SPECS).collect()}
    assert len(got) == sum(1 + len(s.not_null) + len(s.keys) + len(s.foreign) + len(set(tables[n].columns) & {c for c, _ in s.columns}) for n, s in SPECS.items())
    broken = {k: v for k, v in got.items() if v and k[1] != "non_empty"}
    assert broken == {
        ("vendors", "not_null", "vendor_id"): 2, ("vendors", "not_null", "vendor_name"): 1, ("vendors", "lost_in_cast", "vendor_id"): 1, ("vendors", "unique", "vendor_id"): 1,
        ("items", "not_null", "item_sku"): 1, ("items", "not_null", "vendor_id"): 1, ("items", "lost_in_cast", "weight_lb"): 2, ("items", "unique", "item_sku"): 1,
        ("items", "foreign_key", "vendor_id"): 1,
        ("vendor_item_details", "not_null", "vendor_id"): 1, ("vendor_item_details", "unique", "vendor_id,item_id"): 1,
        ("vendor_item_details", "foreign_key", "vendor_id"): 1, ("vendor_item_details", "foreign_key", "item_id"): 1}
    assert {k[0] for k, v in got.items() if k[1] == "non_empty" and not v} == {"vendors", "items", "vendor_item_details"}


def test_a_key_and_its_references_share_one_shuffle(spark):
    from depot.sources.schemas import SPECS
    tables = {n: spark.createDataFrame([], SPECS[n].struct) for n in ("vendors", "items", "inventory")}
    parts = Q._key_checks("vendors", ["vendor_id"], tables["vendors"], [("items", "vendor_id", tables["items"]), ("inventory", "vendor_id", tables["inventory"])])
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate [k0") == 1


def test_view_columns_are_those_of_the_views(tables):
    from depot.registry.quality import DECLARED_VIEWS
    for view, columns in DECLARED_VIEWS.values():
        assert getattr(tables, view).columns == columns.split(), view
