"""A questionnaire stage and its lookups, derived from the supplied tables.

Every order carries one respondent. The derivation is plain SQL that Spark and DuckDB both understand, so the
oracle starts from the same rows; what is compared is everything that happens after it.
"""

from __future__ import annotations

from functools import cache
from uuid import NAMESPACE_OID, uuid5

from pyspark.sql import DataFrame, SparkSession

from tallyloom.plans import specs
from tallyloom.plans.schema import ANSWER_COLUMNS
from tallyloom.sources.workspace import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mix(seed: int, modulus: int) -> str:
    """An integer below `modulus` that varies over the orders, differently for each seed."""
    return f"((o_orderkey * {2 * seed + 3} + o_custkey * {seed % 13 + 1} + {seed}) % {modulus})"


def _pick(seed: int, modulus: int, values: list[str]) -> str:
    """One of the SQL expressions `values`; null for the rest of the modulus."""
    whens = " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values))
    return f"CASE {_mix(seed, modulus)} {whens} END"


_FLAG = ["'Y'"] * 6 + ["'y'", "' Yes '", "'no'", "''", "'0'", "'N'", "' none' || chr(9)", "'FALSE'", "'x'", "'No'", "'NO'"]
_DEFINITION = ["o_orderpriority", "'  '", "' ' || o_orderpriority || chr(10)", "''", "chr(160) || o_orderpriority"]
_YES_NO = ["'Y'", "'yes '", "' t'", "'1'", "'no'", "'F'", "'0'", "'maybe'", "'2'", "''", "'TRUE'", "'n'"]
_AMOUNT = [
    "'12.5'",
    "'$12'",
    "'1,200'",
    "''",
    "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || '.25'",
    "' 7 '",
    "'1e3'",
    "'nan'",
    "'-3'",
]
_SEMESTERS = ["'1'", "' 2 '", "'2.0'", "'x'", "''", "'3'"]
_COUNT = ["'0'", "'1'", "'2'", "'3'", "'3'", "'2'", "'2.9'", "' 2 '", "'x'", "''", "' '", "'-1'", "'nan'", "'5'", "'2.0'"]
_ADJECTIVES = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
_NOUNS = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
_METHODS = ["'0'", "'1'", "'2'", "'3'", "'4'", "'9'", "rpad('Survey by ', 60, 'telephone ')", "''"]
_COUNTRIES = ["'USA'", "'NATION_3'", "'NATION_7'", "'XX'", "'USA'"]
_EMPLOYMENT_COUNTRIES = ["' USA'", "'Can'", "'  '", "''", "' DE '", "'F'"]


def _company(seed: int) -> str:
    """A third of the answers name one company; some name a company no lookup knows; some are missing."""
    adjective = _pick(seed, 8, [f"'{word}'" for word in _ADJECTIVES])
    noun = _pick(seed + 1, 8, [f"'{word}'" for word in _NOUNS])
    return (
        f"CASE WHEN {_mix(seed + 2, 9)} < 3 THEN 'blue anvil' WHEN {_mix(seed + 2, 9)} < 5 THEN {adjective} || ' ' || {noun} "
        f"WHEN {_mix(seed + 2, 9)} = 5 THEN 'Acme ' || o_orderstatus END"
    )


def _answer(name: str, seed: int) -> str:
    lower = name.lower()
    if name == "intern_count":
        return _pick(seed, 17, _COUNT)
    if name == "collection_method":
        return _pick(seed, 9, _METHODS)
    if name.startswith("intern_organization"):
        return _company(seed)
    if name.startswith(("intern_paid_amt",)):
        return _pick(seed, 11, _AMOUNT)
    if name.startswith(("intern_paid", "intern_college_credit")):
        return _pick(seed, 17, _YES_NO)
    if name.startswith("intern_semesters"):
        return _pick(seed, 9, _SEMESTERS)
    if name.startswith("intern_"):
        return _pick(seed, 7, ["o_orderstatus || '-' || o_orderpriority", "''", "' '"])
    if name == "connect_email":
        return _pick(seed, 6, ["'a' || CAST(o_custkey AS STRING) || '@b.example'", "'N'", "'NO'", "''"])
    if lower.endswith(("_fill", "_other_fill")) or name in ("PS_committment_other", "plans_other"):
        return _pick(seed, 5, ["'note ' || o_orderstatus", "' ' || o_orderpriority || ' '", "'  '"])
    if name == "ps_committment_definition":
        return _pick(seed, 5, ["'Other'", "o_orderpriority", "'other'"])
    if lower.endswith(("_definition", "_defin", "_def")):
        return _pick(seed, 9, _DEFINITION)
    if name.startswith(("int_exp_", "intern1_", "intern2_", "intern3_", "EMP_how_obtain", "connect_", "indicator_", "SFT_assist")):
        return _pick(seed, 31, _FLAG)
    if name == "Have_PostGrad_Info":
        return _pick(seed, 4, ["'Y'", "'N'", "''"])
    if name == "FS_country":
        return _pick(seed, 8, _COUNTRIES)
    if name == "FS_state":
        return f"CASE WHEN {_mix(seed, 3)} < 2 THEN 'S' || CAST({_mix(seed + 1, 30)} AS STRING) END"
    if name == "FE_college_code":
        return f"CASE WHEN {_mix(seed, 4)} < 2 THEN lpad(CAST(o_custkey % 45 AS STRING), 6, '0') END"
    if name == "EMP_company":
        return _company(seed)
    if name == "EMP_country":
        return _pick(seed, 8, _EMPLOYMENT_COUNTRIES)
    return _pick(seed, 6, ["o_orderstatus", "o_orderpriority", "CAST(o_custkey AS STRING)"])


def _term() -> str:
    code = (
        "CAST((year(o_orderdate) + 18 - 1800) * 10 + CASE WHEN month(o_orderdate) <= 4 THEN 1 "
        "WHEN month(o_orderdate) <= 7 THEN 5 ELSE 8 END AS STRING)"
    )
    return (
        f"CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 'ABCD' "
        f"WHEN o_orderkey % 83 = 0 THEN '  ' WHEN o_orderkey % 79 = 0 THEN ' ' || {code} || ' ' "
        f"WHEN o_orderkey % 73 = 0 THEN '215' WHEN o_orderkey % 71 = 0 THEN '' ELSE {code} END"
    )


_STUDENT = (
    "CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN '  ' "
    "WHEN o_orderkey % 53 = 0 THEN '9123456' || CAST(o_orderkey AS STRING) "
    "WHEN o_orderkey % 47 = 0 THEN chr(9) || CAST(o_custkey AS STRING) || ' ' "
    "ELSE CAST(o_custkey AS STRING) END"
)


@cache
def stage_columns() -> dict[str, str]:
    """Stage column -> SQL expression over `orders`."""
    columns = {"id": "o_orderkey", "student_id": _STUDENT, "term": _term()}
    gated = {*specs.RESPONSE_EVIDENCE}
    for seed, name in enumerate(ANSWER_COLUMNS):
        expression = _answer(name, seed)
        # a fifth of the respondents fills none of the response columns
        columns[name] = f"CASE WHEN o_orderkey % 5 > 0 THEN {expression} END" if name in gated else expression
    columns["LOAD_UTC_DT"] = "o_orderdate"
    return columns


LOOKUP_SQL = {
    "country": "SELECT CASE WHEN n_nationkey = 1 THEN 'USA' ELSE n_name END AS country, n_name || ' land' AS descr FROM nation",
    "state": (
        "SELECT 'S' || CAST(n_nationkey AS STRING) AS STATE, CASE WHEN n_regionkey < 3 THEN 'USA' ELSE 'CAN' END AS country, "
        "n_name || ' state' AS descr FROM nation"
    ),
    "school": (
        "SELECT lpad(CAST(s_suppkey - s_suppkey % 3 AS STRING), 6, '0') || '-' || CAST(s_suppkey % 3 AS STRING) "
        "AS NSC_COLLEGE_AND_BRANCH_CODE, s_name AS NSC_COLLEGE_NAME FROM supplier"
    ),
    "organization": (
        "SELECT lpad(CAST(s_suppkey AS STRING), 6, '0') AS external_system_id, "
        "CASE s_suppkey % 4 WHEN 0 THEN 'COL' WHEN 1 THEN 'HS' WHEN 2 THEN 'COL' END AS ls_school_type, "
        "s_name || ' org' AS descr50 FROM supplier"
    ),
    "company": (
        "SELECT p_name AS company_name_variant, min(p_brand) AS standardized_company_name FROM part GROUP BY p_name"
    ),
    "company_repeated": (
        "SELECT p_name AS company_name_variant, min(p_brand) AS standardized_company_name FROM part GROUP BY p_name "
        "UNION ALL SELECT p_name, max(p_brand) FROM part GROUP BY p_name"
    ),
}
_LOOKUP_SOURCES = {
    "country": "nation",
    "state": "nation",
    "school": "supplier",
    "organization": "supplier",
    "company": "part",
    "company_repeated": "part",
}


#: Rows of a file of the dealt orders.
ROWS_PER_FILE = 200_000


def dealt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as a stored table in files of equal size, which grow in number, whatever the layout of the given file."""

    def dealt() -> DataFrame:
        orders = table(spark, sf_dir, "orders")
        return orders.repartition(_shares(orders))

    return _stored(spark, sf_dir, "orders", dealt)


def _shares(orders: DataFrame) -> int:
    """The number of shares of about ROWS_PER_FILE rows; the count is in the footers."""
    return max(orders.sparkSession.sparkContext.defaultParallelism, -(-orders.count() // ROWS_PER_FILE))


def derived_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide stage over all orders, as a view: each query derives the columns it reads, and no others."""
    return _derive(dealt_orders(spark, sf_dir))


def _derive(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*[f"{sql} AS {name}" for name, sql in stage_columns().items()])


_folders: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, frame) -> DataFrame:
    """A derived frame as a stored table, written to the shared folder the first time a session asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _folders:
        folder = new_folder(spark, name)
        frame().write.parquet(folder)
        _folders[key] = folder
    return spark.read.parquet(_folders[key])


def stage(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The stage over all orders as a stored table, which is what the library works on.

    A query that reads a few columns may name them: only they are derived and stored then. Each task derives and stores
    one share of the dealt orders: left to itself, the reader hands all of their small files to as many tasks as there are cores.
    """

    def derived() -> DataFrame:
        orders = dealt_orders(spark, sf_dir)
        return _derive(orders.repartition(_shares(orders))).select(*columns or "*")

    name = "-".join(["stage", *columns]) if len(columns) < 4 else f"stage-{uuid5(NAMESPACE_OID, ' '.join(columns)).hex}"
    return _stored(spark, sf_dir, name, derived)


def lookup(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lookup as a stored table."""
    source = _LOOKUP_SOURCES[name]
    sql = LOOKUP_SQL[name].replace(f"FROM {source}", "FROM {source}")
    return _stored(spark, sf_dir, name, lambda: spark.sql(sql, source=table(spark, sf_dir, source)))


def lookups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: lookup(spark, sf_dir, name) for name in ("country", "state", "school", "organization", "company")}


def stage_sql(*extra: str) -> str:
    """WITH clause defining `stage` and the named lookups for DuckDB."""
    columns = ",\n    ".join(f"{sql} AS {name}" for name, sql in stage_columns().items())
    parts = [f"stage AS (\n  SELECT\n    {columns}\n  FROM orders\n)"]
    parts += [f"lk_{name} AS ({LOOKUP_SQL[name]})" for name in extra]
    return "WITH " + ",\n".join(parts) + "\n"
