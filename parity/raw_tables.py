"""The three untidy source tables, derived from ``part`` and ``lineitem``.

Every part and every sold part gives rows; the remainders of the key only decide
*which* flaw a row carries and which extra rows stand beside it.  One scan of
``part`` feeds all rows of a table: a row becomes an array of its copies, and the
array becomes rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.config import EXPECTED_ROW, Expected

# The columns that the queries read; with them no job has to look for a schema.
SCHEMAS = {
    "part": "p_partkey BIGINT, p_size INT, p_retailprice DOUBLE",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, value DOUBLE",
    "documents": "doc_id BIGINT, n_chars BIGINT",
}

_KEY = "CAST(p_partkey AS STRING)"
_PADDED_KEY = f"""CASE p_partkey % 3 WHEN 0 THEN {_KEY}
    WHEN 1 THEN concat('  ', {_KEY}, ' ') ELSE concat({_KEY}, '.0') END"""
_PRICE = """CAST(CAST(CASE WHEN p_partkey % 25 = 0 THEN p_retailprice * 6
    ELSE p_retailprice END AS DECIMAL(18,2)) AS STRING)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# What a right run must find, from the rules by which the raw tables are made: which
# parts have a readable price, which web key each part is linked with, and who of two
# parts with one web key is first.  No table of the pipeline is read.
_EXPECTED = """
WITH item AS (
  SELECT p_partkey AS p,
    CAST(IF(p_partkey % 25 = 0, p_retailprice * 6, p_retailprice) AS DECIMAL(18,2)) AS price,
    (p_partkey % 41 <> 0 AND p_partkey % 43 <> 0) OR p_partkey % 7 = 0 AS priced,
    CASE WHEN p_partkey % 19 = 0 THEN NULL
         WHEN p_partkey % 23 = 0 AND p_partkey > 0 THEN p_partkey - 1
         ELSE p_partkey END AS web
  FROM {part}),
sold AS (
  SELECT l_partkey AS web, CAST(sum(l_quantity) AS BIGINT) AS units
  FROM {lineitem} GROUP BY l_partkey HAVING l_partkey % 47 <> 0),
linked AS (
  SELECT i.* FROM item i
  LEFT ANTI JOIN item f ON f.p = i.web AND f.web = i.web AND f.p < i.p),
keys AS (SELECT web FROM sold UNION SELECT p FROM item),
merged AS (
  SELECT l.p, l.price, coalesce(s.units, 0) AS units
  FROM linked l JOIN keys k ON k.web = l.web LEFT JOIN sold s ON s.web = l.web
  WHERE l.priced),
spread AS (
  SELECT avg(CAST(price AS DOUBLE)) + 2 * stddev_pop(CAST(price AS DOUBLE)) AS limit
  FROM merged)
SELECT (SELECT count(*) FROM item WHERE priced) AS erp_rows,
  (SELECT count(*) FROM linked) AS liaison_rows,
  (SELECT count(*) FROM sold) + (SELECT count(*) FROM item) AS web_cleaned_rows,
  (SELECT count(*) FROM keys) AS web_rows,
  (SELECT count(*) FROM merged) AS merged_rows,
  (SELECT CAST(sum(price * units) AS DECIMAL(38,2)) FROM merged) AS total_revenue,
  (SELECT count(*) FROM merged WHERE price > (SELECT limit FROM spread)) AS premium_rows"""


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        _EXPECTED,
        part=table(spark, sf_dir, "part"),
        lineitem=table(spark, sf_dir, "lineitem"),
    )


def expected_for(spark: SparkSession, sf_dir: str) -> Expected:
    """Expected values of any data set, from ``part`` and ``lineitem`` directly.

    They are a scalar subquery of the plan that compares with them: no job runs here.
    """
    one = _expected(spark, sf_dir)
    row = one.select(F.struct("*").alias("row")).scalar()
    # Fields of one column: each value as a subquery of its own would be planned again.
    return Expected(**{name: F.col(EXPECTED_ROW)[name] for name in one.columns}, row=row)


def expected_values(spark: SparkSession, sf_dir: str) -> Expected:
    """The same as values, for a run that compares with them after every stage."""
    return Expected(**_expected(spark, sf_dir).first().asDict())


def _copies(df: DataFrame, key: str, *rows: tuple[str, dict[str, str]]) -> DataFrame:
    """A row for every listed copy whose condition holds; ``key`` is never null."""

    def struct(cells: dict[str, str]) -> str:
        return "struct(" + ", ".join(f"{v} AS {k}" for k, v in cells.items()) + ")"

    copies = ", ".join(
        struct(cells) if when == "always" else f"if({when}, {struct(cells)}, NULL)"
        for when, cells in rows
    )
    return df.selectExpr(f"inline(array({copies}))").where(f"{key} IS NOT NULL")


def raw_erp(spark: SparkSession, sf_dir: str) -> DataFrame:
    older = {
        "product_id": _KEY,
        "onsale_web": "'0'",
        "price": _PRICE,
        "stock_quantity": "CAST(p_size AS STRING)",
        "stock_status": "'outofstock'",
    }
    foreign = {
        "product_id": f"concat('X-', {_KEY})",
        "onsale_web": "'1'",
        "price": "'1.00'",
        "stock_quantity": "'1'",
        "stock_status": "'instock'",
    }
    current = {
        "product_id": _PADDED_KEY,
        "onsale_web": """CASE WHEN p_partkey % 11 = 0 THEN NULL
            WHEN p_partkey % 2 = 0 THEN '1.0' ELSE '0' END""",
        "price": f"""CASE WHEN p_partkey % 41 = 0 THEN NULL
            WHEN p_partkey % 43 = 0 THEN 'n/a'
            WHEN p_partkey % 5 = 0 THEN replace({_PRICE}, '.', ',')
            ELSE {_PRICE} END""",
        "stock_quantity": "CAST(p_size * 10 AS STRING)",
        "stock_status": "CASE WHEN p_size < 10 THEN '  ' ELSE ' instock ' END",
    }
    return _copies(
        table(spark, sf_dir, "part"),
        "product_id",
        ("always", current),
        ("p_partkey % 7 = 0", older),
        ("p_partkey % 49 = 0", older),
        ("p_partkey % 97 = 0", foreign),
        ("p_partkey % 97 = 0", foreign),
    )


def raw_liaison(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_web = f"""CASE WHEN p_partkey % 19 = 0 THEN '  '
        WHEN p_partkey % 23 = 0 AND p_partkey > 0
            THEN concat('sku-', CAST(p_partkey - 1 AS STRING))
        ELSE concat(' sku-', {_KEY}, ' ') END"""
    return _copies(
        table(spark, sf_dir, "part"),
        "product_id",
        ("always", {"product_id": _PADDED_KEY, "id_web": id_web}),
        (
            "p_partkey % 13 = 0",
            {"product_id": _KEY, "id_web": "CAST(NULL AS STRING)"},
        ),
    )


def raw_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "CAST(l_partkey AS STRING)"
    sold = table(spark, sf_dir, "lineitem").groupBy("l_partkey").sum("l_quantity")
    units = "CAST(CAST(`sum(l_quantity)` AS BIGINT) AS STRING)"
    day = "lpad(CAST(1 + l_partkey % 28 AS STRING), 2, '0')"
    products = sold.selectExpr(
        f"concat('sku-', {key}, CASE WHEN l_partkey % 4 = 0 THEN ' ' ELSE '' END) sku",
        f"""CASE WHEN l_partkey % 3 = 0 THEN concat({units}, '.0')
            ELSE {units} END AS total_sales""",
        f"""CASE WHEN l_partkey % 47 = 0 THEN ' '
            ELSE concat('Item ', {key}) END AS post_title""",
        """CASE WHEN l_partkey % 2 = 0 THEN ' Product '
            ELSE 'product' END AS post_type""",
        f"""CASE WHEN l_partkey % 10 = 0 THEN 'bad-date'
            ELSE concat('2024-01-', {day}, ' 10:00:00') END AS post_modified""",
        f"concat(' http://shop.example/?p=', {key}) AS guid",
    )
    photo = {
        "sku": f"concat('sku-', {_KEY})",
        "total_sales": "'0'",
        "post_title": f"concat('Photo ', {_KEY})",
        "post_type": "'attachment'",
        "post_modified": "'2024-06-01 00:00:00'",
        "guid": "'http://shop.example/img'",
    }
    blog = {
        "sku": f"concat('sku-', {_KEY})",
        "total_sales": "'5'",
        "post_title": "'Blog'",
        "post_type": "'page'",
        "post_modified": "'2024-06-01 00:00:00'",
        "guid": "''",
    }
    others = _copies(
        table(spark, sf_dir, "part"),
        "sku",
        ("always", photo),
        ("p_partkey % 9 = 0", blog),
    )
    return products.unionByName(others)
