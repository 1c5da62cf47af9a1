"""A housing-shaped view derived from ``orders``: one row per order, identical in Spark and DuckDB.

All defects of the real table are planted: heavy tails, null bedrooms, a target pinned at both
ends, a five-row category level. The uniforms come from md5, so no engine's generator matters.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


KEY = "id"
#: Rows of a partition at most, on average: learners read a whole partition's features in one task.
PARTITION_ROWS = 1 << 18


def _u(tag: str, engine: str) -> str:
    text = f"substr(md5(concat('{tag}|', cast(o_orderkey as {'string' if engine == 'spark' else 'varchar'}))), 1, 8)"
    if engine == "spark":
        return f"(cast(conv({text}, 16, 10) as double) / 4294967296.0D)"
    return f"(cast(cast('0x' || {text} as ubigint) as double) / 4294967296.0::double)"


def _g(tag: str, engine: str) -> str:
    d = "D" if engine == "spark" else "::double"
    a, b = _u(tag + "a", engine), _u(tag + "b", engine)
    return f"(sqrt(-2.0{d} * ln(({a} * 4294967296.0{d} + 1.0{d}) / 4294967297.0{d})) * cos(2.0{d} * pi() * {b}))"


def housing_sql(engine: str, source: str = "orders") -> str:
    d = "D" if engine == "spark" else "::double"

    def u(tag):
        return _u(tag, engine)

    def num(x):
        return f"{x}{d}"

    stages = [
        f"""select o_orderkey as id,
            round(least(greatest(exp({num('5.6')} + {num('0.85')} * {_g('hh', engine)}), {num('5.0')}), {num('6000.0')}), 3) as households,
            {u('r')} as ur, {u('b')} as ub, {u('p')} as up, {u('lvl')} as ul,
            round({num('-124.0')} + {num('9.0')} * {u('lon')}, 4) as longitude,
            {num('32.6')} + {num('9.3')} * {u('lat')} as lat,
            cast(1 + floor({num('51.0')} * {u('age')}) as double) as housing_median_age,
            round({num('0.5')} + {num('14.5')} * {u('inc')}, 4) as median_income,
            {_g('n', engine)} as noise
            from {source}""",
        f"""select *,
            round(households * ({num('3.0')} + {num('6.0')} * ur)) as total_rooms,
            round(households * ({num('1.5')} + {num('2.5')} * up), 3) as population
            from (STAGE) s1""",
        f"""select id, longitude, round(lat, 4) as latitude, housing_median_age, total_rooms,
            case when id % 97 = 3 then cast(null as double)
                 else round(total_rooms * ({num('0.15')} + {num('0.15')} * ub)) end as total_bedrooms,
            population, households, median_income,
            case when id % 31 = 7 then {num('500001.0')} when id = 5 then {num('14999.0')}
                 else round(least(greatest({num('30000.0')} + {num('28000.0')} * median_income
                      + {num('1200.0')} * ({num('42.0')} - lat) - {num('2500.0')} * (population / households)
                      + {num('35000.0')} * noise, {num('20000.0')}), {num('480000.0')})) end as median_house_value,
            case when id < 5 then 'ISLAND' when ul < {num('0.44')} then '<1H OCEAN' when ul < {num('0.76')} then 'INLAND'
                 when ul < {num('0.89')} then 'NEAR OCEAN' else 'NEAR BAY' end as ocean_proximity
            from (STAGE) s2""",
    ]
    text = stages[0]
    for stage in stages[1:]:
        text = stage.replace("STAGE", text)
    return text


def housing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The given file is one split; everything below is computed from the key, so it is dealt out by it.
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    parts = max(spark.sparkContext.defaultParallelism, -(-orders.count() // PARTITION_ROWS))
    orders = orders.repartition(parts, "o_orderkey")
    return spark.sql(housing_sql("spark", "{orders}"), orders=orders)


def held_housing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view for queries that read it in many passes: a row's twelve hashes are worked out once. Later queries of the session
    over the same folder find it held."""
    return housing(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)


#: DuckDB preamble: ``with h as (...)``.
HOUSING_CTE = f"h as ({housing_sql('duckdb')})"
