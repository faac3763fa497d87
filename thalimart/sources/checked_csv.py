"""CSV files that do not keep to their layout.

Columns are found by the names in the header line, whatever their order and case;
a column that the files lack is NULL, further ones are dropped. All files of a
table must have one header: a file with another one stops the read with an error
instead of shifting its cells. Cells may hold line breaks if they are quoted
(``multi_line``; such files are read by one task each).

A line with too few or too many cells is kept as the import keeps it - missing cells
are NULL, surplus ones are left out - but no longer unseen: its text stays in the
column ``bad_line``, beside the number of cells it has. Blank lines are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import (LOCATION_COLS, LOCATION_CSV, ORDERS_COLS, ORDERS_CSV, RENAMES, RESTAURANT_COLS, RESTAURANT_CSV, USERS_COLS, USERS_CSV,
                      Staging, _text_schema)

BAD_LINE = "bad_line"


def cells_of(line: Column) -> Column:
    """How many cells a line has: separators outside quotes, plus one."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_checked_csv(spark: SparkSession, path: str, cols: list[str], multi_line: bool = False) -> DataFrame:
    """The staging columns by their header names, ``bad_line`` (NULL for a sound
    line) and ``ingest_seq``."""
    # a quote inside a quoted cell is doubled; whole lines are parsed, whatever columns are asked for
    reader = spark.read.option("header", "true").option("multiLine", str(multi_line).lower()).option("escape", '"').option("columnPruning", "false")
    header = reader.csv(path).columns  # from the first file's first line
    schema = _text_schema(header).add(BAD_LINE, "string")
    rows = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).option("enforceSchema", "false")
            .schema(schema).csv(path))
    at = {h.strip().lower(): i for i, h in reversed(list(enumerate(header)))}
    plain = rows.toDF(*(f"c{i}" for i in range(len(header))), BAD_LINE)
    md = rows.select("*", "_metadata").toDF(*plain.columns, "md")
    seq = F.struct(F.col("md.file_path").alias("file"), F.col("md.file_block_start").alias("block"),
                   F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    named = [(F.col(f"c{at[c.lower()]}") if c.lower() in at else F.lit(None).cast("string")).alias(RENAMES.get(c, c)) for c in cols]
    return md.select(*named, BAD_LINE, seq.alias("ingest_seq"))


def read_checked_staging(spark: SparkSession, users: str, restaurants: str, orders: str, locations: str,
                         multi_line: bool = False) -> tuple[Staging, DataFrame]:
    """The staging tables, and (source, cells, kept, bad_line) of the lines that do
    not keep to the layout: how many cells they have, which were kept, their text."""
    tables = {"users": (users, USERS_CSV, USERS_COLS), "restaurants": (restaurants, RESTAURANT_CSV, RESTAURANT_COLS),
              "orders": (orders, ORDERS_CSV, ORDERS_COLS), "locations": (locations, LOCATION_CSV, LOCATION_COLS)}
    read = {name: read_checked_csv(spark, path, cols, multi_line) for name, (path, cols, _) in tables.items()}
    bad = None
    for name, df in read.items():
        own = df.where(F.col(BAD_LINE).isNotNull()).select(F.lit(name).alias("source"), cells_of(F.col(BAD_LINE)).alias("cells"),
                                                            F.array(*tables[name][2][:-1]).alias("kept"), BAD_LINE)
        bad = own if bad is None else bad.unionByName(own)
    return Staging(**{name: read[name].select(*cols) for name, (_, _, cols) in tables.items()}), bad
