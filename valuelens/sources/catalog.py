"""Product catalog documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.operators.quality import InvalidData, catalog_rules, require, violations
from valuelens.schemas import PRODUCT_CATALOG


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The catalog of a JSON file, checked: any other number of documents than one, or another shape, fails."""
    catalog = (
        spark.read.schema(PRODUCT_CATALOG)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )
    if catalog.limit(2).count() != 1:
        raise InvalidData(f"{path} does not hold exactly one catalog")
    return require(catalog, catalog_rules())


def parse_catalogs(documents: DataFrame, column: str, *keep: str) -> DataFrame:
    """Catalogs from a column of JSON text, one per row, not yet checked."""
    parsed = F.from_json(F.col(column), PRODUCT_CATALOG, {"mode": "FAILFAST"})
    return documents.select(*keep, parsed.alias("catalog")).select(*keep, "catalog.*")


MALFORMED = "document is malformed"


def read_catalog_files(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Catalogs of any number of JSON files, not yet checked: (file, the catalog's columns, malformed).

    A document is a line, or with ``lines`` off a whole file. What is no JSON, or has a value of another type, is
    malformed.
    """
    texts = spark.read.text(path, wholetext=not lines).select("value", F.col("_metadata.file_path").alias("file"))
    parsed = F.from_json("value", f"{PRODUCT_CATALOG}, _malformed string", {"columnNameOfCorruptRecord": "_malformed"})
    documents = texts.where("trim(value) <> ''").select("file", parsed.alias("catalog")).select("file", "catalog.*")
    return documents.withColumn("malformed", F.expr("_malformed is not null")).drop("_malformed")


def rejected_files(documents: DataFrame, *by: str) -> DataFrame:
    """(file, rule, violations) of all rules that a document of the file breaks, counted in one pass."""
    rules = {MALFORMED: "malformed"}
    # A malformed document has no content that could break another rule.
    rules |= {name: f"not malformed and ({broken})" for name, broken in catalog_rules().items()}
    return violations(documents, rules, *(by or ("file",))).where("violations > 0")


def accepted_catalogs(documents: DataFrame) -> DataFrame:
    """The catalogs of files of which no document breaks a rule. Rejected files are few, or else shuffled like the rest."""
    return documents.join(rejected_files(documents).select("file").distinct(), "file", "left_anti").drop("malformed")
