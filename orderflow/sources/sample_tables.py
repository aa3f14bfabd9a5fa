"""Orders, messages and listings derived from the star-schema sample tables.

A line item stands for one order at one supplier: every derived row comes from
one line item, by expressions and dimension lookups. Nothing is grouped, so no
order key can grow into an oversized group, and the derived input grows with
the line items. Faults are set by formula on the order key. An event stands
for one order in the timed order stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dish i of an order is the part's name with the i-th course.
COURSES = ("curry", "naan", "rice", "tea", "kebab", "paratha", "juice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part, supplier, nation and region."""
    lineitem = table(spark, sf_dir, "lineitem")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return (
        lineitem.join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(places, F.expr("s_nationkey = n_nationkey"))
    )


def _order_columns(lines: DataFrame, price: str) -> DataFrame:
    """Order fields, with prices computed exactly and given as type ``price``.

    A line item orders as many dishes as its line number, starting again after the last.
    """
    count = f"(1 + (l_linenumber - 1) % {len(COURSES)})"
    courses = ", ".join(f"'{course}'" for course in COURSES)
    quantity = [f"(1 + (cast(l_quantity as int) + {i}) % 4)" for i in range(1, len(COURSES) + 1)]
    units = " + ".join(f"if({i} <= {count}, {quantity[i - 1]}, 0)" for i in range(1, len(COURSES) + 1))
    # A dish is written once, not once per course: larger generated methods are never compiled to machine code.
    items = f"""transform(slice(array({courses}), 1, {count}), (course, i) ->
        named_struct('food_item', concat(p_name, ' ', course), 'category', p_type,
            'unit_price', cast(unit_price as {price}), 'quantity', 1 + (cast(l_quantity as int) + i + 1) % 4))"""
    return (
        lines.withColumn("unit_price", F.expr("cast(p_retailprice as decimal(10,2))"))
        .withColumn("total", F.expr(f"cast(unit_price * ({units}) as decimal(18,2))"))
        .selectExpr(
            "l_orderkey",
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey) as order_id",
            "concat('user-', l_orderkey) as user_id",
            "cast(l_suppkey as int) as restaurant_id",
            "s_name as restaurant_name",
            "n_name as restaurant_city",
            "array(p_type, p_brand) as cuisines",
            """concat(case when l_orderkey % 100 = 3 then '091'
                           when l_orderkey % 2 = 0 then '+91'
                           else '080' end, 20000000 + l_suppkey) as phone_number""",
            "l_returnflag <> 'R' or l_orderkey % 100 = 4 as request_online",
            "l_returnflag = 'R' or l_orderkey % 100 = 4 as request_table",
            "concat(replace(cast(l_shipdate as string), ' ', 'T'), 'Z') as order_time",
            f"{items} as items",
            f"""cast(cast(case when l_orderkey % 33 <> 0 then total
                              when l_linenumber % 3 = 0 then total * 1.25
                              when l_linenumber % 3 = 1 then -total
                              else total * 50 end as decimal(18,2)) as {price}) as order_price""",
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order history in the shape of the order schema."""
    return _order_columns(_lines(spark, sf_dir), "double").drop("l_orderkey")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON order messages, some cut short, some no object, some with a text flag.

    The messages carry a field the order schema does not know.
    """
    exact = _order_columns(_lines(spark, sf_dir), "decimal(18,2)")
    fields = [name for name in exact.columns if name != "l_orderkey"]
    text = exact.select(
        "l_orderkey",
        F.col("order_id").alias("key"),
        F.to_json(F.struct(*fields, F.lit("web").alias("device"))).alias("text"),
    )
    return text.selectExpr(
        "key",
        """case when l_orderkey % 211 = 7 then left(text, length(text) - 1)
                when l_orderkey % 223 = 7 then concat('[', text, ']')
                when l_orderkey % 227 = 7
                then replace(text, '"request_online":true', '"request_online":"true"')
                else text end as value""",
    )


def event_orders(events: DataFrame) -> DataFrame:
    """Timed orders from a batch or stream of events."""
    return events.selectExpr(
        "cast(event_id as string) as order_id",
        "cast(user_id as string) as user_id",
        "event_type as restaurant_city",
        "concat(replace(cast(ts as string), ' ', 'T'), 'Z') as order_time",
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Timed orders as JSON messages; some name no user, have no readable time or are cut short."""
    orders = event_orders(events).withColumn("number", F.col("order_id").cast("long"))
    faulty = orders.selectExpr(
        "number",
        "order_id",
        "if(number % 7 = 3, null, user_id) as user_id",
        "restaurant_city",
        "if(number % 11 = 5, 'soon', order_time) as order_time",
    )
    text = F.to_json(F.struct("order_id", "user_id", "restaurant_city", "order_time"))
    cut = F.expr("if(number % 13 = 1, left(text, length(text) - 1), text)")
    return faulty.select("number", text.alias("text")).select(cut.alias("value"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat restaurant listing: 14 text columns, one row per line item."""
    return _lines(spark, sf_dir).selectExpr(
        """case when s_suppkey % 50 <> 9
                then concat('Plot ', s_suppkey, ', ', n_name) end as address""",
        "case when s_suppkey % 40 = 1 then '  ' else s_name end as name",
        "case l_returnflag when 'A' then 'Yes' when 'N' then 'No' else ' yes' end as online_order",
        "case when l_linestatus = 'O' then 'Yes' else 'No' end as book_table",
        """case l_orderkey % 7 when 0 then 'NEW' when 1 then '-' when 3 then ' 3.9 /5'
                               when 4 then 'abc'
                when 5 then concat(3 + l_partkey % 20 div 10, '.', l_partkey % 10, '/5')
                when 6 then concat(3 + l_partkey % 20 div 10, '.', l_partkey % 10, '5/5')
           end as rate""",
        """case when l_orderkey % 11 = 0 then 'n/a'
                else cast(cast(l_quantity as int) * 10 as string) end as votes""",
        """case when s_suppkey % 10 = 0 and l_linenumber % 2 = 0
                then concat('080 ', 30000000 + s_suppkey)
                else concat('+91 98', 10000000 + s_suppkey, '\\n', '080 ', 20000000 + s_suppkey)
           end as phone""",
        "case when l_orderkey % 97 <> 0 then n_name end as location",
        "p_type as rest_type",
        "concat(p_type, ', ', p_brand) as cuisines",
        """case when l_orderkey % 13 = 0 then null
                when l_partkey % 1500 < 800 then cast(200 + l_partkey % 1500 as string)
                else concat('1,', lpad(l_partkey % 1500 - 800, 3, '0'))
           end as `approx_cost(for two people)`""",
        """case l_linenumber when 1 then '[]' when 2 then 'on request'
                when 3 then concat("['", p_name, "', \\"chef's tea\\"]")
                else concat("['", p_name, "', 'a', 'b', 'c', 'd', 'e']") end as menu_item""",
        """case l_returnflag when 'R' then 'Delivery' when 'A' then 'Buffet' else 'Dine-out' end
           as `listed_in(type)`""",
        "r_name as `listed_in(city)`",
    )
