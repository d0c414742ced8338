"""The measurement rules as SQL functions, and the feeds as views, for users who write SQL.

Spark expands such functions like views, so a query that uses them is planned as if the
expressions stood in it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from calipers.functions.text import NUMBER_PATTERN
from calipers.sources import adapters

_SIDE = """coalesce(try_cast(regexp_extract(part, '([0-9]+) ft', 1) AS double), 0D) * 12
    + coalesce(try_cast(regexp_extract(part, '([0-9]+) in', 1) AS double), 0D)"""

_HUNDREDFOLD = f"try_cast(regexp_substr(value, r'{NUMBER_PATTERN}') AS double) * 10D * 10D"
_INCHES = "try_cast(value AS bigint)"

#: name -> (parameters, result type, expression)
FUNCTIONS = {
    "dimension_value": ("value STRING", "DOUBLE", f"""CASE WHEN {_HUNDREDFOLD} < 9007199254740992D
        THEN CAST(ceil({_HUNDREDFOLD}) AS double) ELSE {_HUNDREDFOLD} END / 10D / 10D"""),
    "leading_number": ("value STRING", "DOUBLE", r"try_cast(split(trim(value), r'\s+')[0] AS double)"),
    "feet_inches": ("value DOUBLE", "STRING", f"""concat(({_INCHES} - pmod({_INCHES}, 12)) div 12, "'",
        pmod({_INCHES}, 12), '"')"""),
    "inches": ("value DOUBLE", "STRING", """CASE WHEN value IS NOT NULL THEN
        concat(rtrim('.', rtrim('0', format_string('%.2f', value))), '"') END"""),
    "rug_side": ("part STRING", "DOUBLE", _SIDE),
    "rug_width": ("name STRING", "DOUBLE", """CASE WHEN size(split(name, 'x')) = 2
        THEN least(rug_side(split(name, 'x')[0]), rug_side(get(split(name, 'x'), 1))) END"""),
    "rug_height": ("name STRING", "DOUBLE", """CASE WHEN size(split(name, 'x')) = 2
        THEN greatest(rug_side(split(name, 'x')[0]), rug_side(get(split(name, 'x'), 1))) END"""),
}


def register_functions(spark: SparkSession) -> None:
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Functions and views of one session."""
    register_functions(spark)
    adapters.register_views(spark, sf_dir)
