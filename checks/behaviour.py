"""Refusals and invariants as queries: what is refused, and what holds for every row of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.housing import housing
from checks.oracle import HOUSE_SPLIT, ORACLE, h, r
from checks.queries import KEY, Y, fitted, query, rounded, scratch, sided_housing, table
from holdfast import config
from holdfast.errors import DataNotFoundError, SchemaError
from holdfast.operators import steps
from holdfast.operators.branches import FeatureBranches
from holdfast.operators.contract import HOUSING
from holdfast.operators.metrics import headline, segment_table
from holdfast.operators.stats import fit_one, keep_all
from holdfast.plans import models
from holdfast.sources import csv, record

COLUMNS = config.SCHEMA.fieldNames()


def refusal(job: Callable) -> str:
    """The class that ``job`` refuses with, or an empty text."""
    try:
        job()
    except (ValueError, OSError) as refused:
        return type(refused).__name__
    return ""


def rows(spark: SparkSession, found: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(found), schema)


# --- the contract ---------------------------------------------------------------------------


@query("expected_columns")
def expected_columns(spark, d):
    """The contract's columns in order, which of them a table of features needs, and the values the table has."""
    df, features = housing(spark, d), HOUSING.expected_columns(require_target=False)
    counted = df.agg(*[F.count(c).alias(c) for c in HOUSING.expected_columns()])
    each = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(c in features).alias("feature"), F.col(c).alias("n"))
        for i, c in enumerate(HOUSING.expected_columns())
    ]
    return counted.select(F.inline(F.array(*each)))


ORACLE["expected_columns"] = h(" union all ".join(
    f"""select {i} as position, '{c}' as "column", {str(c != Y).lower()} as feature, count({c}) as n from h""" for i, c in enumerate(COLUMNS)
))


@query("check_missing")
def check_missing(spark, d):
    """Each column left out in turn; the whole table passes."""
    df = housing(spark, d)
    found = [(c, refusal(lambda c=c: HOUSING.validate(df.drop(c)))) for c in COLUMNS]
    return rows(spark, [*found, ("", refusal(lambda: HOUSING.validate(df)))], "left_out string, refusal string")


ORACLE["check_missing"] = "select * from (values " + ", ".join(f"('{c}', 'MissingColumnsError')" for c in COLUMNS) + ", ('', '')) v(left_out, refusal)"


def _faulty(df: DataFrame, faults: str) -> DataFrame:
    low, high = config.VALUE_RANGES["latitude"]
    if "range" in faults:
        df = df.withColumn("latitude", F.when(F.col("id") % 2 == 0, F.lit(high + 1.0)).otherwise(F.col("latitude")))
    if "type" in faults:
        df = df.withColumn("population", F.col("population").cast("string"))
    return df.drop("households") if "missing" in faults else df


FAULTS = ("missing type range", "missing type", "missing range", "type range", "missing", "type", "range", "")


@query("check_order")
def check_order(spark, d):
    """Of several faults the most specific is told: names before types before values."""
    df = housing(spark, d)
    return rows(spark, [(f, refusal(lambda f=f: HOUSING.validate(_faulty(df, f)))) for f in FAULTS], "faults string, refusal string")


_TOLD = {f: "MissingColumnsError" if "missing" in f else "ColumnTypeError" if "type" in f else "ValueRangeError" if f else "" for f in FAULTS}
ORACLE["check_order"] = "select * from (values " + ", ".join(f"('{f}', '{told}')" for f, told in _TOLD.items()) + ") v(faults, refusal)"


@query("schema_error_family")
def schema_error_family(spark, d):
    """Every refusal of the contract is caught as one family, and tells the rows at fault."""
    df, found = housing(spark, d), []
    for fault in ("missing", "type", "range"):
        try:
            HOUSING.validate(_faulty(df, fault))
        except SchemaError as refused:
            found.append((fault, isinstance(refused, ValueError), f"{df.where('id % 2 = 0').count()} row(s)" in str(refused)))
    return rows(spark, found, "fault string, caught boolean, tells_rows boolean")


ORACLE["schema_error_family"] = "select * from (values ('missing', true, false), ('type', true, false), ('range', true, true)) v(fault, caught, tells_rows)"


@query("check_routed_columns")
def check_routed_columns(spark, d):
    """A table without a column that a branch reads is refused before anything is fitted."""
    df = housing(spark, d)
    found = [(c, refusal(lambda c=c: FeatureBranches().fit(df.drop(c)))) for c in COLUMNS if c != Y]
    return rows(spark, found, "left_out string, refusal string")


ORACLE["check_routed_columns"] = "select * from (values " + ", ".join(f"('{c}', 'ValueError')" for c in COLUMNS if c != Y) + ") v(left_out, refusal)"


# --- options ----------------------------------------------------------------------------------

ENCODERS = [(unknown, drop) for unknown in ("infrequent_if_exist", "ignore", "error") for drop in (None, "first")]


@query("check_encoder_safety")
def check_encoder_safety(spark, d):
    """Settings under which two levels would look alike are refused; the others give rows of at most one mark."""
    docs, parts = table(spark, d, "documents"), []
    for unknown, drop in ENCODERS:
        made = []
        told = refusal(lambda: made.append(steps.OneHot(handle_unknown=unknown, drop=drop, min_frequency=0.0)))
        marks = F.lit(None).cast("double")
        frame = docs.limit(0).select("doc_id") if told else fitted(docs, ["lang"], made, keep=["doc_id"])
        if not told:
            marks = F.sum(sum((F.col(f"`{c}`") for c in frame.columns[1:]), F.lit(0.0)))
        parts.append(frame.agg(marks.alias("marks")).select(F.lit(unknown).alias("unknown"), F.lit(drop or "").alias("drop"), F.lit(told).alias("refusal"), "marks"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


ORACLE["check_encoder_safety"] = """with c as (select cast(count(*) as double) as n, cast(count(*) filter (where lang > (select min(lang) from documents)) as double) as later from documents)
select 'infrequent_if_exist' as unknown, '' as "drop", '' as refusal, n as marks from c
 union all select 'infrequent_if_exist', 'first', 'UnsafeEncoderError', null union all select 'ignore', '', '', n from c
 union all select 'ignore', 'first', 'UnsafeEncoderError', null union all select 'error', '', '', n from c union all select 'error', 'first', '', later from c"""

IMPUTERS = ("median", "mean", "middle", "")


@query("check_option_names")
def check_option_names(spark, d):
    """Unknown names are refused before any data is read; known ones leave no null."""
    events = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    found = []
    for kind in IMPUTERS:
        made = []
        told = refusal(lambda: made.append(steps.Impute(kind=kind)))
        found.append((kind, told, None if told else fitted(events, ["value"], made, keep=["event_id"]).where("value is not null").count()))
    return rows(spark, found, "name string, refusal string, n bigint")


ORACLE["check_option_names"] = """select 'median' as name, '' as refusal, count(*) as n from events union all select 'mean', '', count(*) from events
 union all select 'middle', 'ValueError', null union all select '', 'ValueError', null"""

BOUNDS = ((0.0, 1.0), (0.1, 0.9), (0.5, 0.5), (0.9, 0.1), (-0.1, 0.5), (0.5, 1.1))


@query("check_quantile_bounds")
def check_quantile_bounds(spark, d):
    """Bounds that are no quantiles or out of order are refused; the others clip at exact quantiles."""
    events, found = table(spark, d, "events"), []
    for low, high in BOUNDS:
        made = []
        told = refusal(lambda: made.append(steps.Clip(lower=low, upper=high)))
        ends = (None, None) if told else fit_one(events, made[0].fit({"value": F.col("value")}, keep_all))["bounds"]["value"]
        found.append((low, high, told, *ends))
    return rounded(rows(spark, found, "lower double, upper double, refusal string, low double, high double"))


ORACLE["check_quantile_bounds"] = " union all ".join(
    f"select {a}::double as lower, {b}::double as upper, '' as refusal, {r(f'quantile_cont(value, {a})')} as low, {r(f'quantile_cont(value, {b})')} as high from events"
    if 0 <= a < b <= 1 else f"select {a}::double, {b}::double, 'ValueError', null, null"
    for a, b in BOUNDS
)


@query("onehot_error_mode")
def onehot_error_mode(spark, d):
    """Levels of training pass; a level that only the other rows have ends the job, and so does null."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    known = docs.where("lang <> 'de'")
    step = steps.OneHot(handle_unknown="error", min_frequency=0)
    state = fit_one(known, step.fit({"lang": F.col("lang")}, keep_all))
    made = step.apply(state, {"lang": F.col("lang")})

    def outcome(df: DataFrame) -> str:
        try:
            df.select(*[F.sum(c).alias(n) for n, c in made.items()]).collect()
        except Exception as ended:  # what Spark raises for raise_error depends on its version
            return "refused" if "unknown category in lang" in str(ended) else type(ended).__name__
        return "passed"

    nulls = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit("en")))
    return rows(spark, [("known", outcome(known)), ("all", outcome(docs)), ("nulls", outcome(nulls))], "given string, outcome string")


ORACLE["onehot_error_mode"] = "select * from (values ('known', 'passed'), ('all', 'refused'), ('nulls', 'refused')) v(given, outcome)"


# --- what holds for every row -------------------------------------------------------------------


def _model(spark, d):
    sided = sided_housing(spark, d)
    return sided, FeatureBranches(nClusters=3, deskew="log").fit(sided.where("side = 'train'").drop("side"))


@query("row_independence")
def row_independence(spark, d):
    """Features of a row don't depend on the rows beside it: every seventh row alone, and among all."""
    sided, model = _model(spark, d)
    some = sided.where("id % 7 = 0")
    alone, among = model.feature_frame(some, KEY), model.feature_frame(sided, KEY)
    names = [c for c in alone.columns if c not in KEY]
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in names])
    both = alone.select("id", values.alias("a")).join(among.select("id", values.alias("b")), "id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different"))


ORACLE["row_independence"] = h("select count(*) as n, 0 as n_different from h where id % 7 = 0")


@query("train_only_stats")
def train_only_stats(spark, d):
    """What was learned is a function of the training rows: wild test rows don't move it, wild training rows do."""
    sided = sided_housing(spark, d)
    chain = [steps.Impute(kind="median"), steps.Scale(kind="standard")]

    def learned(df: DataFrame) -> list:
        return fit_one(df.where("side = 'train'"), st_fit(chain))

    def st_fit(made):
        return steps.fit_chain(made, {"population": F.col("population")}, keep_all)

    def wild(side: str) -> DataFrame:
        return sided.withColumn("population", F.when(F.col("side") == side, F.col("population") * 1000).otherwise(F.col("population")))

    base = learned(sided)
    found = [("test", learned(wild("test")) != base), ("train", learned(wild("train")) != base)]
    return rows(spark, found, "wild_side string, moved boolean")


ORACLE["train_only_stats"] = "select * from (values ('test', false), ('train', true)) v(wild_side, moved)"


@query("geo_invariants")
def geo_invariants(spark, d):
    """Similarities lie in [0, 1] for every row, and that to the nearest centre is the greatest."""
    df = housing(spark, d)
    step = steps.Geo(n_clusters=4)
    state = fit_one(df, step.fit({c: F.col(c) for c in config.GEO_COLUMNS}, keep_all))
    near = list(step.apply(state, {c: F.col(c) for c in config.GEO_COLUMNS}).values())
    outside = sum((F.when((x < 0) | (x > 1) | x.isNull(), 1).otherwise(0) for x in near), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(outside).alias("n_outside"), F.lit(len(state["centers"])).alias("n_centers"))


ORACLE["geo_invariants"] = h("select count(*) as n, 0 as n_outside, 4 as n_centers from h")


# --- inputs and outputs -----------------------------------------------------------------------


@query("src_missing_error")
def src_missing_error(spark, d):
    """No candidate holds the file: an error of its own; the given tables beside it are not taken for it."""
    told = refusal(lambda: csv.resolve_csv(spark, search=[d, f"{d}/absent"], default=f"{d}/absent.csv"))
    return table(spark, d, "region").agg(F.count(F.lit(1)).alias("n_regions")).withColumn("refusal", F.lit(told))


ORACLE["src_missing_error"] = f"select count(*) as n_regions, '{DataNotFoundError.__name__}' as refusal from region"


@query("sink_write_once")
def sink_write_once(spark, d):
    """The second run is refused and changes nothing; a rerun on request replaces record and headline."""
    sided, folder = sided_housing(spark, d), scratch(spark)
    test = sided.where("side = 'test'").withColumn("prediction", F.lit(200000.0))
    arms = segment_table(test).withColumn("arm", F.lit("flat"))
    found = []
    for attempt, (seed, rerun) in enumerate([(1, False), (2, False), (3, True)]):
        told = refusal(lambda: record.write_once(spark, {"seed": seed, "n": test.count()}, headline(arms), folder, rerun=rerun))
        kept = record.read_record(spark, f"{folder}/{record.RECORD}")
        n_arms = spark.read.csv(f"{folder}/{record.HEADLINE}", header=True).count()
        found.append((attempt, told, kept["seed"], kept["n"], n_arms))
    return rows(spark, found, "attempt int, refusal string, seed int, n bigint, arms bigint")


ORACLE["sink_write_once"] = h(
    """select a.attempt, a.refusal, a.seed, n, 1 as arms from (values (0, '', 1), (1, 'RecordExistsError', 1), (2, '', 3)) a(attempt, refusal, seed),
 (select count(*) as n from sd where side = 'test') t""", *HOUSE_SPLIT
)


@query("sink_model")
def sink_model(spark, d):
    """A fitted chain, saved and loaded, predicts the same for every row of the test side."""
    sided, folder = sided_housing(spark, d), scratch(spark)
    train, test = (sided.where(f"side = '{s}'").drop("side") for s in ("train", "test"))
    chain = models.model_chain(models.chosen("ridge"), nClusters=3, deskew="log").fit(train)
    record.save_model(chain, folder)
    again = PipelineModel.load(folder).transform(test).select("id", F.col("prediction").alias("b"))
    both = chain.transform(test).select("id", F.col("prediction").alias("a")).join(again, "id")
    return both.agg(F.count("a").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("n_different"))


ORACLE["sink_model"] = h("select count(*) as n, 0 as n_different from sd where side = 'test'", *HOUSE_SPLIT)
