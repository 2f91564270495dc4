"""Reading and writing pages, records, robots rules and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill import schemas
from voxmill.functions import text as tx


def read_records(
    spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_REVIEW, fmt: str = "parquet"
) -> DataFrame:
    """Records from parquet, JSON Lines (``jsonl``) or one JSON array per file (``json``).

    A JSON array cannot be split, so each such file is read by one task; use it for interchange.
    JSON input gets ``seq`` from its place (files by path, then position in the file), unless
    ``schema`` has it. Parquet has no such order: there ``seq`` must be a column.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    records = spark.read.schema(schema).json(path, multiLine=(fmt == "json"))
    if "seq" in schema.fieldNames():
        return records
    split = records.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at")
    )
    # One row for each split that a task reads.
    number = F.row_number().over(W.orderBy("_file", "_at")) - 1
    splits = split.distinct().withColumn("_split", number.cast("long"))
    placed = records.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"), *schema.fieldNames(),
    )
    seq = F.shiftleft("_split", 33).bitwiseOR(F.col("_row")).alias("seq")
    return placed.join(splits, ["_file", "_at"]).select(seq, *schema.fieldNames())


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGE).parquet(path)


def read_robots(spark: SparkSession, path: str) -> DataFrame:
    """Rules of robots.txt files: one row per (file, agent, rule), in line order."""
    files = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("origin"), F.col("value").alias("body")
    )
    return parse_robots(files)


def read_host_rules(spark: SparkSession, path: str) -> DataFrame:
    """(host, agent, allow, path_pattern) of files named ``<host>/robots.txt`` or ``<host>.txt``."""
    rules = read_robots(spark, path)
    host = F.regexp_extract("origin", r"([^/]+)(?:/robots\.txt|\.txt)$", 1)
    return rules.select(F.lower(host).alias("host"), "agent", "allow", "path_pattern")


def parse_robots(files: DataFrame) -> DataFrame:
    """(origin, body) -> (origin, line_no, agent, allow, path_pattern).

    A group starts at the agent lines that follow a rule line; all its agents share its rules. The
    whole walk stays inside one row, as a robots file is read as one value.
    """
    lines = F.transform(
        F.split(F.col("body"), tx.LINE_BREAK),
        lambda raw, i: F.struct(
            (i + 1).alias("no"),
            F.lower(F.regexp_extract(raw, r"^\s*([A-Za-z-]+)\s*:", 1)).alias("field"),
            F.regexp_extract(raw, r"^[^:#]*:\s*([^#]*?)\s*(#.*)?$", 1).alias("value"),
        ),
    )
    used = F.filter(lines, lambda x: x["field"].isin("user-agent", "allow", "disallow"))
    fields = F.transform(F.col("used"), lambda x: x["field"])
    placed = F.transform(
        F.col("used"),
        # Number of the rule lines before this line, to tell groups apart.
        lambda x, i: F.struct(
            x["no"].alias("no"),
            x["field"].alias("field"),
            x["value"].alias("value"),
            ((x["field"] == "user-agent") & (i > 0)
             & (F.get(F.col("fields"), i - 1) != "user-agent")).cast("int").alias("opens"),
        ),
    )
    row = (
        files.withColumn("used", used)
        .withColumn("fields", fields)
        .select("origin", F.posexplode(placed).alias("i", "x"))
        .select("origin", "i", "x.*")
    )
    per_file = W.partitionBy("origin").orderBy("i")
    grouped = row.withColumn("grp", F.sum("opens").over(per_file))
    agents = grouped.where("field = 'user-agent'").select(
        "origin", "grp", F.lower("value").alias("agent")
    )
    rules = grouped.where("field <> 'user-agent' and value <> ''").select(
        "origin", "grp", F.col("no").alias("line_no"),
        (F.col("field") == "allow").alias("allow"), F.col("value").alias("path_pattern"),
    )
    return rules.join(agents, ["origin", "grp"]).select(
        "origin", "line_no", "agent", "allow", "path_pattern"
    )


def agent_rules(rules: DataFrame, agent: str, origin: str | None = None) -> list[tuple[bool, str]]:
    """One site's rules for an agent (else those for ``*``), brought to the driver.

    ``origin`` names the file of the site; it is needed if ``rules`` holds several. The rules
    become part of the filter expression; ``links.robots_filter_by_host`` joins them instead.
    """
    token = agent.lower().split("/")[0].strip()
    own_site = rules if origin is None else rules.where(F.col("origin") == origin)
    if origin is None and own_site.select("origin").distinct().limit(2).count() > 1:
        raise ValueError("the rules of several sites; name one by its origin")
    rows = own_site.where(F.col("agent").isin(token, "*")).orderBy("line_no").collect()
    own = [r for r in rows if r.agent == token] or [r for r in rows if r.agent == "*"]
    return [(r.allow, r.path_pattern) for r in own]


def write_records(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write to a new stage path; overwriting the path that is being read is not possible."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)
    return path


def write_summary(summary: DataFrame, path: str) -> str:
    """A summary as JSON lines, one for each of its rows."""
    summary.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
