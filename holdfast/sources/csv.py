"""Finding and reading the headered CSV, and holding it to the contract."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import config
from holdfast.errors import DataNotFoundError
from holdfast.functions.expressions import nan_to_null
from holdfast.operators.contract import HOUSING, Contract


def _files(spark: SparkSession, path: str, name: str | None = None) -> list[str]:
    """Files behind a path on any file system Spark reads; with ``name``, searched recursively."""
    reader = spark.read.format("binaryFile")
    if name is not None:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name)
    try:
        return sorted(reader.load(path).inputFiles())
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def resolve_csv(
    spark: SparkSession,
    explicit: str | None = None,
    *,
    search: list[str] | None = None,
    name: str = config.CSV_NAME,
    default: str = config.CSV_DEFAULT,
) -> str:
    """The input's path: explicit, else the environment's, else found by name, else the default.

    A miss lists everything that was tried; nothing is guessed.
    """
    if explicit is not None:
        if not _files(spark, explicit):
            raise DataNotFoundError(f"No such file: {explicit}")
        return explicit
    tried = []
    named = os.environ.get(config.CSV_ENV_VAR)
    if named:
        if _files(spark, named):
            return named
        tried.append(named)
    for folder in search or []:
        found = _files(spark, folder, name)
        if found:
            return found[0]
        tried.append(f"{folder} (searched for {name})")
    if _files(spark, default):
        return default
    tried.append(default)
    raise DataNotFoundError(
        f"Input not found. Tried, in order: {'; '.join(tried)}. Pass a path or set {config.CSV_ENV_VAR}."
    )


#: The spellings of a missing value.
NULL_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def read_csv(spark: SparkSession, path: str, contract: Contract = HOUSING, *, checked: bool = True) -> DataFrame:
    """Read a headered CSV by column name.

    The header decides which columns are there, so a missing one is reported as missing. A file of
    the same read whose header differs, and a row with more or fewer fields than the header, is refused
    when it is read. Values are taken as text first: checked reading then names a column of the wrong
    kind, unchecked reading fails on the first such value.
    """
    header = spark.read.csv(path, header=True, inferSchema=False).schema.fieldNames()
    known = {f.name: f.dataType for f in contract.schema}
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    # Without column pruning every row is cut into all its fields, so a wrong number of them shows.
    reader = spark.read.schema(text).option("columnPruning", False)
    raw = reader.csv(path, header=True, mode="FAILFAST", enforceSchema=False)
    raw = raw.select([F.when(~F.trim(F.col(f"`{c}`")).isin(*NULL_SPELLINGS), F.col(f"`{c}`")).alias(c) for c in header])
    if checked:
        contract.check_missing(raw, require_target=False)
        return nan_to_null(contract.cast_text(raw))
    return nan_to_null(raw.select([F.col(f"`{c}`").cast(known.get(c, T.StringType())).alias(c) for c in header]))


def load_raw(
    spark: SparkSession,
    path: str | None = None,
    *,
    contract: Contract = HOUSING,
    validate_schema: bool = True,
    verbose: bool = True,
    search: list[str] | None = None,
) -> DataFrame:
    """Resolve, read, validate; says which file it opened and what it holds."""
    resolved = resolve_csv(spark, path, search=search)
    df = read_csv(spark, resolved, contract, checked=validate_schema)
    if verbose:
        print(f"[holdfast] read {resolved}  ->  {df.count():,} rows x {len(df.columns)} columns")
    return contract.validate(df) if validate_schema else df
