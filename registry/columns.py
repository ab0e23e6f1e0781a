"""Column standardisers."""

from pyspark.sql import functions as F

from masterloom.functions import (
    code_field,
    concat_phone_parts,
    phone_part,
    fill_blank,
    full_address,
    hhmm_time,
    initial_flag,
    last_digits,
    reference_fallback,
    standardize_property_codes,
    strip_special,
)
from masterloom.operators import normalize_phones, standardize_phones
from registry import query, table


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 10 <> 0 THEN concat('SF', CAST(o_custkey AS STRING)) END AS code,
           CASE WHEN o_orderkey % 10 <> 0 THEN concat('SF-', CAST(o_custkey AS STRING)) END AS dashed
    FROM orders
    """
)
def code_of_id(spark, folder):
    raw = F.when(F.col("o_orderkey") % 10 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" "))
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", code_field(raw, "SF").alias("code"), code_field(raw, "SF", "-").alias("dashed")
    )


@query(
    """
    SELECT o_orderkey,
           coalesce(nullif(trim(CASE WHEN o_orderkey % 3 = 0 THEN '  '
                                     WHEN o_orderkey % 3 = 1 THEN concat(' ', o_orderstatus, ' ') END), ''),
                    nullif(o_orderpriority, '5-LOW')) AS country_standardized
    FROM orders
    """
)
def fallback_of_reference(spark, folder):
    third = F.col("o_orderkey") % 3
    name = F.when(third == 0, F.lit("  ")).when(
        third == 1, F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(" "))
    )
    fallback = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return table(spark, folder, "orders").select(
        "o_orderkey", reference_fallback(name, fallback).alias("country_standardized")
    )


@query(
    """
    SELECT o_orderkey, concat('+4930', lpad(CAST(o_orderkey % 1000000 AS STRING), 6, '1')) AS composed,
           CASE o_orderkey % 3 WHEN 0 THEN concat('617.', CAST(o_orderkey AS STRING), '5')
             WHEN 1 THEN CAST(o_orderkey AS STRING) ELSE concat(CAST(o_orderkey AS STRING), '000') END AS dotted
    FROM orders
    """
)
def phone_composed(spark, folder):
    """A region with a wide range of lengths takes off a composed code once; dots do not cut a number."""
    orders = table(spark, folder, "orders").withColumn("key", F.col("o_orderkey").cast("string"))
    raw = orders.select(
        "o_orderkey",
        concat_phone_parts(
            F.lit("30.0"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "1"), country=F.lit("49.0")
        ).alias("phone"),
        F.lit("49").alias("country_code"),
        F.lit("0").alias("trunk_prefix"),
        F.lit(6).alias("min_len"),
        F.lit(11).alias("max_len"),
        phone_part(
            F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("617."), "key", F.lit("5")))
            .when(F.col("o_orderkey") % 3 == 1, F.concat("key", F.lit(".00")))
            .otherwise(F.concat("key", F.lit("E3")))
        ).alias("dotted"),
    )
    return normalize_phones(raw, {"composed": "phone"}).select("o_orderkey", "composed", "dotted")


@query(
    """
    SELECT o_orderkey,
           concat(CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey % 90 AS STRING) ELSE '' END,
                  lpad(CAST(o_custkey % 1000 AS STRING), 4, '0'),
                  CASE o_orderkey % 3
                    WHEN 0 THEN concat(CAST(o_orderkey % 90 + 10 AS STRING), '00000000')
                    WHEN 1 THEN '555-CALL' ELSE '' END) AS phone
    FROM orders
    """
)
def phone_parts(spark, folder):
    """Float texts become whole, leading zeros stay, other text stays, null is skipped."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    country = F.when(key % 5 != 0, F.concat((cust % 90).cast("string"), F.lit(".0")))
    area = F.concat(F.lit(" "), F.lpad((cust % 1000).cast("string"), 4, "0"))
    number = F.when(
        key % 3 == 0,
        F.concat(
            ((key % 90 + 10) / 10).cast("decimal(3,1)").cast("string"), F.lit("E9")
        ),
    ).when(key % 3 == 1, F.lit("555-CALL"))
    return table(spark, folder, "orders").select(
        "o_orderkey", concat_phone_parts(country, area, number).alias("phone")
    )


@query(
    """
    WITH t AS (SELECT o_orderkey, concat(CASE WHEN o_orderkey % 2 = 0 THEN ' +' ELSE '' END,
                      o_orderpriority, ' (', CAST(o_custkey AS STRING), ') +', CAST(o_orderkey AS STRING)) AS p
               FROM orders)
    SELECT o_orderkey, regexp_replace(p, '[^0-9]', '', 'g') AS digits,
           concat(CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '' END,
                  regexp_replace(p, '[^0-9]', '', 'g')) AS dialled
    FROM t
    """
)
def special_characters(spark, folder):
    key = F.col("o_orderkey")
    text = F.concat(
        F.when(key % 2 == 0, F.lit(" +")).otherwise(F.lit("")),
        F.col("o_orderpriority"),
        F.lit(" ("),
        F.col("o_custkey").cast("string"),
        F.lit(") +"),
        key.cast("string"),
    )
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", text.alias("p"))
        .select(
            "o_orderkey",
            strip_special("p").alias("digits"),
            strip_special("p", keep_plus=True).alias("dialled"),
        )
    )


@query(
    """
    WITH raw AS (
      SELECT c_custkey, 10 + c_nationkey AS cc,
             regexp_replace(concat(CASE c_custkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '0' ELSE '' END,
               CASE WHEN c_custkey % 3 = 0 THEN CAST(10 + c_nationkey AS STRING) ELSE '' END,
               '(', lpad(CAST(c_custkey % 1000 AS STRING), 3, '1'), ') ',
               lpad(CAST(c_custkey AS STRING), 6, '2')), '[^0-9+]', '', 'g') AS p
      FROM customer),
    n AS (
      SELECT c_custkey, CAST(cc AS STRING) AS cc,
             CASE WHEN p LIKE '+%' THEN substring(p, 2 + length(CAST(cc AS STRING)))
                  WHEN p LIKE '0%' THEN substring(p, 2) ELSE p END AS nsn
      FROM raw)
    SELECT c_custkey,
           CASE WHEN length(nsn) BETWEEN 7 AND 12 THEN concat('+', cc, nsn) END AS formattedphone
    FROM n
    """
)
def phone_normalize(spark, folder):
    key, code = F.col("c_custkey"), (F.col("c_nationkey") + 10).cast("string")
    third = key % 3
    phone = F.concat(
        F.when(third == 0, F.lit("+")).when(third == 1, F.lit("0")).otherwise(F.lit("")),
        F.when(third == 0, code).otherwise(F.lit("")),
        F.lit("("),
        F.lpad((key % 1000).cast("string"), 3, "1"),
        F.lit(") "),
        F.lpad(key.cast("string"), 6, "2"),
    )
    raw = table(spark, folder, "customer").select(
        "c_custkey",
        phone.alias("phone"),
        code.alias("country_code"),
        F.lit("0").alias("trunk_prefix"),
        F.lit(7).alias("min_len"),
        F.lit(12).alias("max_len"),
    )
    return normalize_phones(raw, {"formattedphone": "phone"}).select("c_custkey", "formattedphone")


# Forms of one number: own code with +, with 00, with nothing; trunk prefix; bare;
# foreign; too short; with code and trunk.  Two regions of 27 have no plan.
PHONE_FORMS = """
    CASE o_orderkey % 8
      WHEN 0 THEN concat('+', cc, ' (', nsn, ')') WHEN 1 THEN concat('00', cc, '/', nsn)
      WHEN 2 THEN concat(cc, nsn) WHEN 3 THEN concat('0', nsn) WHEN 4 THEN nsn
      WHEN 5 THEN concat('+99 ', nsn) WHEN 6 THEN '12 34' ELSE concat('+', cc, ' (0) ', nsn) END
"""


@query(
    f"""
    WITH t AS (SELECT o_orderkey, o_custkey % 27 AS region, CAST(10 + o_custkey % 27 AS STRING) AS cc,
                      concat('5', lpad(CAST(o_orderkey AS STRING), 7, '1')) AS nsn FROM orders),
    p AS (SELECT *, {PHONE_FORMS} AS phone FROM t)
    SELECT o_orderkey,
           CASE WHEN region >= 25 OR o_orderkey % 8 = 6 THEN NULL
                WHEN o_orderkey % 8 = 5 THEN concat('+99', nsn)
                ELSE concat('+', cc, nsn) END AS formatted,
           CASE WHEN region >= 25 THEN NULL ELSE concat('+', cc, nsn) END AS formatted_desk
    FROM p
    """
)
def phone_forms(spark, folder):
    nsn = "concat('5', lpad(CAST(o_orderkey AS STRING), 7, '1'))"
    orders = (
        table(spark, folder, "orders")
        .selectExpr(
            "o_orderkey",
            "concat(' nation_', CAST(o_custkey % 27 AS STRING)) AS region_name",
            "CAST(10 + o_custkey % 27 AS STRING) AS cc",
            f"{nsn} AS nsn",
        )
        .selectExpr("*", f"{PHONE_FORMS} AS phone", "nsn AS desk")
    )
    plan = table(spark, folder, "nation").selectExpr(
        "n_name AS region",
        "CAST(10 + n_nationkey AS STRING) AS country_code",
        "'0' AS trunk_prefix",
        "8 AS min_len",
        "8 AS max_len",
    )
    phones = {"formatted": "phone", "formatted_desk": "desk"}
    done = standardize_phones(orders, phones, "region_name", plan, drop_raw=True)
    return done.drop("region_name", "cc", "nsn")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN length(d) >= 6 THEN right(d, 6) END AS sixdigit
    FROM (SELECT *, regexp_replace(concat('+', CAST(l_partkey * 7919 AS STRING)), '[^0-9]', '', 'g') AS d
          FROM lineitem) t
    """
)
def last_six_digits(spark, folder):
    phone = F.concat(F.lit("+"), (F.col("l_partkey") * 7919).cast("string"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", last_digits(phone).alias("sixdigit")
    )


@query(
    """
    SELECT o_orderkey,
           concat_ws(', ', nullif(trim(CASE WHEN o_orderkey % 4 = 0 THEN '  ' ELSE concat(' ', o_orderstatus) END), ''),
                     nullif(o_orderpriority, '5-LOW'),
                     CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey AS STRING) END) AS full_address
    FROM orders
    """
)
def address_line(spark, folder):
    blank = F.col("o_orderkey") % 4 == 0
    return table(spark, folder, "orders").select(
        "o_orderkey",
        full_address(
            [
                F.when(blank, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("o_orderstatus"))),
                F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
                F.when(~blank, F.col("o_custkey")),
            ]
        ).alias("full_address"),
    )


# Codes with, without and equal to the brand, blank, and with a city after the brand.
PROPERTY_CODE = """
    CASE p_partkey % 5 WHEN 0 THEN lower(concat(p_brand, '-', CAST(p_partkey AS STRING)))
      WHEN 1 THEN p_brand WHEN 2 THEN ' - '
      WHEN 3 THEN concat(p_brand, substring(p_type, 1, 2), CAST(p_partkey AS STRING))
      ELSE concat('x/', CAST(p_partkey AS STRING)) END AS propertycode
"""
BRAND = "CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand"
CITY = "CASE WHEN p_partkey % 2 = 0 THEN substring(p_type, 1, 2) ELSE '' END AS city"
CLEAN = f"""
    WITH t AS (SELECT p_partkey, {PROPERTY_CODE}, {BRAND}, {CITY} FROM part),
    c AS (SELECT p_partkey,
                 nullif(upper(regexp_replace(propertycode, '[^0-9A-Za-z]', '', 'g')), '') AS code,
                 upper(regexp_replace(brand, '[^0-9A-Za-z]', '', 'g')) AS brand,
                 nullif(upper(city), '') AS city FROM t)
"""


@query(
    f"""
    {CLEAN},
    b AS (SELECT *, CASE WHEN starts_with(code, brand) AND length(code) > length(brand)
                         THEN substring(code, length(brand) + 1) ELSE code END AS left1 FROM c)
    SELECT p_partkey,
           CASE WHEN starts_with(left1, city) AND length(left1) > length(city)
                THEN substring(left1, length(city) + 1) ELSE left1 END AS propertycode_standardized
    FROM b
    """
)
def property_code_strip(spark, folder):
    return _property_codes(spark, folder, "strip")


@query(
    f"""
    {CLEAN},
    b AS (SELECT *, CASE WHEN city IS NOT NULL AND NOT starts_with(code, city)
                         THEN concat(city, code) ELSE code END AS with_city FROM c)
    SELECT p_partkey,
           CASE WHEN code IS NULL THEN NULL
                WHEN brand IS NOT NULL AND NOT starts_with(with_city, brand)
                THEN concat(brand, with_city) ELSE with_city END AS propertycode_standardized
    FROM b
    """
)
def property_code_prefix(spark, folder):
    return _property_codes(spark, folder, "prefix")


def _property_codes(spark, folder, mode):
    parts = table(spark, folder, "part").selectExpr("p_partkey", PROPERTY_CODE, BRAND, CITY)
    columns = {"propertycode": {"brand_col": "brand", "city_col": "city"}}
    done = standardize_property_codes(parts, columns, mode=mode)
    return done.select("p_partkey", "propertycode_standardized")


@query(
    """
    SELECT event_id,
           concat_ws('', lpad(CAST(hour(t) AS STRING), 2, '0'), lpad(CAST(minute(t) AS STRING), 2, '0')) AS hhmm,
           CASE WHEN event_type = 'view' THEN '' ELSE strftime(ts, '%H%M') END AS hhmm_of_text
    FROM (SELECT *, CASE WHEN event_type <> 'error' THEN ts END AS t FROM events) x
    """
)
def time_of_day(spark, folder):
    """From timestamps, some null, and from text, some of it unreadable."""
    text = F.when(F.col("event_type") == "view", F.lit("noon")).otherwise(F.col("ts").cast("string"))
    return table(spark, folder, "events").select(
        "event_id",
        hhmm_time(F.when(F.col("event_type") != "error", F.col("ts"))).alias("hhmm"),
        hhmm_time(text).alias("hhmm_of_text"),
    )


@query(
    """
    SELECT c_custkey,
           CASE WHEN c_mktsegment LIKE 'B%' THEN 'Y' ELSE '' END AS b_flag,
           CASE WHEN c_mktsegment LIKE 'F%' AND c_custkey % 2 = 0 THEN 'Y' ELSE '' END AS f_flag
    FROM customer
    """
)
def first_letter_flags(spark, folder):
    text = F.concat(F.lit(" "), F.lower("c_mktsegment"))
    some = F.when(F.col("c_custkey") % 2 == 0, text)
    return table(spark, folder, "customer").select(
        "c_custkey", initial_flag(text, "B").alias("b_flag"), initial_flag(some, "f").alias("f_flag")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, coalesce(nullif(l_returnflag, 'N'), '') AS flag,
           nullif(l_suppkey, 3) AS suppkey
    FROM lineitem
    """
)
def blanks_filled(spark, folder):
    return fill_blank(
        table(spark, folder, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
            F.nullif(F.col("l_suppkey"), F.lit(3)).alias("suppkey"),
        )
    )
