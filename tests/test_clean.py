from pyspark.sql import Observation

from conftest import rows
from lodestar.functions import register_functions
from lodestar.operators import expect_all_or_drop, expectation_report
from lodestar.plans import clean
from test_scd import BATCH1, CUSTOMER

RULES = {"rule1": "product_id IS NOT NULL", "rule2": "product_name IS NOT NULL"}


def test_customers(spark):
    silver = clean.clean_customers(spark.createDataFrame(BATCH1, CUSTOMER).selectExpr("*", "'x' _rescued_data"))
    assert silver.columns == ["customer_id", "email", "seen", "Domain", "Full_name"]
    assert rows(silver.distinct(), "customer_id", "Domain", "Full_name") == [
        ("C1", "gmail.com", "Ann Lee"), ("C2", "x.org", None), ("C3", None, "Cy Poe"), ("C4", None, "Di Ray")
    ]
    counts = [tuple(r) for r in clean.domain_counts(silver).collect()]
    assert counts == [(None, 2), ("gmail.com", 2), ("x.org", 1)]
    assert rows(clean.in_domain(silver, "gmail.com", "domain"), "customer_id") == [("C1",), ("C1",)]


def test_products_use_no_udf(spark, capsys):
    products = spark.createDataFrame([("P1", "Pen", 10.0)], "product_id string, product_name string, price double")
    silver = clean.clean_products(products)
    silver.explain()
    assert "UDF" not in capsys.readouterr().out.upper().replace("PYTHONUDF", "UDF")
    assert rows(silver, "discounted_price") == [(9.0,)]
    products.createOrReplaceTempView("products")
    assert rows(spark.sql("SELECT discount_func(price) FROM products")) == [(9.0,)]
    stored = register_functions(spark, "default")
    assert rows(spark.sql(f"SELECT {stored}(20)")) == [(18.0,)]


def test_rules(spark):
    data = [("P1", "Pen"), (None, "Cap"), ("P2", None), ("P1", "Pen"), ("P1", "Pen")]
    df = spark.createDataFrame(data, "product_id string, product_name string")
    seen = Observation("rules")
    assert expect_all_or_drop(df, RULES, seen).count() == 3
    assert seen.get == {"rows": 5, "rule1": 1, "rule2": 1}
    assert rows(expectation_report(df, RULES)) == [("rule1", 5, 1), ("rule2", 5, 1)]
    assert expect_all_or_drop(df, {"null": "product_name = 'Pen'"}).count() == 3


def test_preview_is_ordered(spark):
    assert [r.id for r in clean.preview(spark.range(100).repartition(5), 3, "id").collect()] == [0, 1, 2]
