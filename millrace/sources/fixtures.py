"""Record-linkage inputs made from the star-schema tables: noisy renderings of the same customers in three sources.

The statement runs in Spark and DuckDB alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCES_SQL = """
with b as (
  select c_custkey k, p_name,
    case c_nationkey % 3 when 0 then 'US' when 1 then 'India' else 'France' end country,
    split_part('Société,Northern,Royal,Sri Ganesh,Delta,Maison,Pacific,Étoile,Global,Lakshmi,Granite,Orchid,Summit,Bharat,Riviera,Cedar,Apex', ',', cast(c_custkey % 17 as int) + 1) w1,
    split_part('Oak,Mahatma Gandhi,Victor Hugo,Lincoln,Nehru,Voltaire,Maple,Station,Castle,River,Temple,Market,Garden', ',', cast((c_custkey * 7 + 3) % 13 as int) + 1) st,
    cast((c_custkey * 37) % 900 + 1 as string) num,
    case c_nationkey % 3 when 1 then cast(110000 + (c_custkey * 13) % 5000 as string)
                         else cast(10000 + (c_custkey * 13) % 5000 as string) end pc,
    case when c_nationkey % 3 = 1 and c_custkey % 13 < 3 then '०१२३४५६७८९' else '0123456789' end digits
  from {customer} join {part} on p_partkey = c_custkey % 200
), src as (
  select 'S1' src, k, concat('S1-', cast(k as string)) entity_id,
    concat(w1, ' ', p_name, case country when 'US' then ' Inc.' when 'India' then ' Pvt. Ltd.' else ' SARL' end) business_name,
    translate(concat(num, ' ', st, case country when 'France' then ' Boulevard, ' else ' Road, ' end, pc), '0123456789', digits) business_address, country
  from b
  union all
  select 'S2', k, concat('S2-', cast(k as string)),
    case k % 4 when 0 then upper(concat(w1, ' ', p_name))
               when 1 then concat('www.', lower(replace(concat(w1, p_name), ' ', '')), '.com')
               when 2 then concat(w1, ' & ', p_name, ' Corp')
               else concat(w1, ' ', p_name, ' LLC') end,
    case when k % 37 = 0 then null else translate(concat(num, ' ', st, case country when 'France' then ' Bd ' else ' Rd ' end, pc), '0123456789', digits) end, country
  from b where k % 18 <> 0
  union all
  select 'S3', k, concat('S3-', cast(k as string)),
    case k % 3 when 1 then concat(p_name, ' ', w1, ' Company')
               else concat(w1, ' ', substring(p_name, 1, length(p_name) - 1), ' Ltd') end,
    case when k % 37 = 0 then null else concat(num, '-', st, case country when 'France' then ' blvd' else ' rd.' end) end, country
  from b where k % 18 <> 0 and k % 3 <> 0
)"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src, k, entity_id, business_name, business_address, country`` of all three sources."""
    customer, part = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "part"))
    return spark.sql(SOURCES_SQL + " select * from src", customer=customer, part=part)


def truth(src: DataFrame) -> DataFrame:
    """``s1_id, t_id``: records of the same customer."""
    s = src.filter("src = 'S1'").select("k", F.col("entity_id").alias("s1_id"))
    t = src.filter("src <> 'S1'").select("k", F.col("entity_id").alias("t_id"))
    return s.join(t, "k").select("s1_id", "t_id")


#: Result rows with an offender for each rule of the validator; needs ``src`` before it.
LISTS_SQL = """
lists as (
  select k, concat(case when k % 43 = 0 then 'S1-X' else 'S1-' end, cast(k as string)) s1_id,
    case when k % 19 = 0 then concat('S2-', cast(k as string), ',S2-', cast(k as string))
         when k % 23 = 0 then concat('S1-', cast(k + 1 as string))
         when k % 29 = 0 then concat('S4-', cast(k as string), ',')
         when k % 31 = 0 then ' '
         when k % 37 = 0 then concat('S2-', cast(k + 900000000 as string))
         else concat('S2-', cast(k as string), ',S3-', cast(k as string)) end id_list,
    case when k % 11 = 0 then concat('S2-', cast(k as string)) else concat('S3-', cast(k as string), ',S2-', cast(k as string)) end candidate_list
  from src where src.src = 'S1' and k % 41 <> 0
  union all
  select k, concat('S1-', cast(k as string)), '', '' from src where src.src = 'S1' and k % 47 = 0 and k % 41 <> 0
)"""


def result_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, s1_id, id_list, candidate_list``."""
    customer, part = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "part"))
    return spark.sql(SOURCES_SQL + "," + LISTS_SQL + " select * from lists", customer=customer, part=part)
