"""Table access and pieces of DuckDB SQL that several oracles share."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WS = r"[ \t\n\r\f\v]"
TRIM = "trim({x}, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
SENTENCES = (
    "list_filter(list_transform(string_split(regexp_replace({t}, '([.!?])" + WS + r"+', '\1' || chr(1), 'g'), chr(1)), lambda x: "
    + TRIM.format(x="x") + "), lambda x: length(x) > 0 AND NOT regexp_matches(x, '^[.!?]$'))"
)
TOKENS = "list_filter(string_split_regex({t}, '" + WS + "+'), lambda x: x <> '')"
TOKEN_SET = "list_distinct(" + TOKENS.format(t="trim(regexp_replace(regexp_replace(lower({t}), '[^\\p{{L}}\\p{{N}}_ \\t\\n\\r\\f\\v]', '', 'g'), '" + WS + "+', ' ', 'g'))") + ")"


def token_set(expr: str) -> str:
    return TOKEN_SET.format(t=expr)


def quoted(items: list[str]) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def contains_any(expr: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({expr}, '" + p.replace("'", "''") + "')" for p in phrases) + ")"
