"""Delimited files with ``;`` between fields and a comma in numbers."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.functions.columns import comma_double, comma_long, comma_text, known_text

PARSERS = {
    "string": known_text,
    "double": comma_double,
    "bigint": comma_long,
    "int": lambda column: comma_long(column).try_cast("int"),
}


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, named by the header."""
    return spark.read.option("sep", fixed.FIELD_SEPARATOR).option("header", True).csv(path)


def preview(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """The first rows; Spark stops reading when it has them."""
    return read_raw(spark, path).limit(n)


def parsed(column: str, dtype: str) -> Column:
    return PARSERS[dtype](F.col(column))


def read_typed(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """Columns with declared types; columns without one stay text."""
    raw = read_raw(spark, path)
    return raw.select(*[parsed(c, types.get(c, "string")).alias(c) for c in raw.columns])


def parse_failures(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column, how many texts are neither missing nor readable as the declared type."""
    failed = [
        F.count_if(known_text(F.col(c)).isNotNull() & parsed(c, dtype).isNull()).alias(c)
        for c, dtype in types.items()
    ]
    return raw.agg(*failed).unpivot([], list(types), "METRIC", "N_FAILED")


def read_train_test(
    spark: SparkSession, train_path: str, test_path: str, types: Mapping[str, str]
) -> DataFrame:
    """Both files as one table, columns matched by name, with the file each row came from."""
    train, test = (
        read_typed(spark, path, types).withColumn("SPLIT", F.lit(split))
        for path, split in ((train_path, "train"), (test_path, "test"))
    )
    return train.unionByName(test, allowMissingColumns=True)


def with_position(raw: DataFrame, position: str = "POSITION") -> DataFrame:
    """Adds a column that sorts like the lines of the file just read.

    It is made of folder, part number, file, block and place within the block, so that blocks are read apart. Parts go
    by their number, as their names sort otherwise from 100,000 on; a file that has none stands before those that do.
    """
    path = F.col("_metadata.file_path")
    return raw.select(
        "*",
        F.struct(
            F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("folder"),
            F.regexp_extract(path, "part-([0-9]+)[^/]*$", 1).try_cast("bigint").alias("part"),
            path.alias("file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("place"),
        ).alias(position),
    )


def write_delimited(df: DataFrame, path: str, header: bool = True) -> None:
    """Writes the rows in their order, as part files, numbers with a decimal comma."""
    columns = [
        comma_text(F.col(name)).alias(name) if dtype.startswith(("double", "float", "decimal")) else F.col(name)
        for name, dtype in df.dtypes
    ]
    df.select(*columns).write.option("sep", fixed.FIELD_SEPARATOR).option("header", header).csv(path)


def write_scores(scores: DataFrame, score: str, path: str) -> None:
    """One score a line without a header, in the order of the rows; a missing score is an empty line."""
    scores.select(F.coalesce(F.col(score).cast("string"), F.lit(""))).write.text(path)


def line_damage(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Per folder of part files, what is wrong with their lines: ``(FOLDER, N_LINES, N_DAMAGED, N_FEW, N_MANY, N_QUOTES,
    N_BLANK, N_OTHER_HEADERS)``.

    Lines are read with the given columns as texts. The reader marks a line whose number of fields differs; it counts as
    one of open quotes if it has an odd number of them, else as one of too few or too many fields. Blank ones have no
    value in any field. Every part file's header is compared, in the same order; those that differ are counted. Damaged lines stay in the counts, and
    ``read_raw`` goes on reading them as far as they go.
    """
    schema = ", ".join(f"`{name}` string" for name in columns) + ", _damaged string"
    reader = spark.read.schema(schema).option("sep", fixed.FIELD_SEPARATOR).option("header", True).option("recursiveFileLookup", True)
    lines = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_damaged").csv(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "([^/]*)/[^/]*$", 1).alias("FOLDER")
    lines = lines.select(folder, F.coalesce(*columns).isNull().alias("blank"), "_damaged")
    quotes = F.length("_damaged") - F.length(F.translate("_damaged", '"', ""))
    bare = F.regexp_replace("_damaged", '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.translate(bare, fixed.FIELD_SEPARATOR, "")) + 1
    kind = F.when(F.col("_damaged").isNull(), None).when(quotes % 2 == 1, "quotes").when(fields < len(columns), "few").otherwise("many")
    counted = lines.select("FOLDER", "blank", kind.alias("kind")).groupBy("FOLDER").agg(
        F.count("*").alias("N_LINES"),
        F.count("kind").alias("N_DAMAGED"),
        *[F.count_if(F.coalesce(F.col("kind") == name, F.lit(False))).alias(f"N_{name.upper()}") for name in ("few", "many", "quotes")],
        F.count_if("blank").alias("N_BLANK"),
    )
    headers = header_lines(spark, path)
    other = F.count_if(F.col("header") != fixed.FIELD_SEPARATOR.join(columns)).alias("N_OTHER_HEADERS")
    headers = headers.groupBy(F.regexp_extract("file", "([^/]*)/[^/]*$", 1).alias("FOLDER")).agg(other)
    return headers.join(counted, "FOLDER", "left").select(
        "FOLDER",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in ("N_LINES", "N_DAMAGED", "N_FEW", "N_MANY", "N_QUOTES", "N_BLANK")],
        "N_OTHER_HEADERS",
    )


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, header)``: the first line of every part file that has any.

    Only the first block of a file is looked at, and of it the first line is found by a partial aggregate.
    """
    texts = spark.read.option("recursiveFileLookup", True).text(path)
    texts = texts.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    return texts.where("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
