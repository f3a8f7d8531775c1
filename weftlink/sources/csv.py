"""Flat CSV shards to nested person records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.functions import norm as N
from weftlink.model import MAIDEN_URL, person_struct, ssn_identifier
from weftlink.operators.neighbours import number_rows
from weftlink.session import ship

#: The columns of a shard, all text, and the gender codes.
COLUMNS = ("EnterpriseID", "LAST", "FIRST", "MIDDLE", "SUFFIX", "DOB", "GENDER", "SSN", "ADDRESS1", "ADDRESS2", "ZIP", "MOTHERS_MAIDEN_NAME", "MRN", "CITY", "STATE", "PHONE", "PHONE2", "EMAIL", "ALIAS")
GENDERS = {"M": "male", "F": "female", "U": "unknown", "O": "other"}


def _clean(c: str) -> Column:
    return F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))


def to_person(df: DataFrame) -> DataFrame:
    """The column ``person`` from the flat text columns; what is absent stays null, never empty."""
    text = lambda c: F.lit(None).cast("string") if c not in df.columns else _clean(c)
    null, none = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    listed = lambda *cs: F.nullif(F.array_compact(F.array(*cs)), F.array().cast("array<string>"))
    given = listed(text("FIRST"), text("MIDDLE"))
    official = F.when(given.isNotNull() | text("LAST").isNotNull() | text("SUFFIX").isNotNull(), F.struct(F.lit("official").alias("use"), text("LAST").alias("family"), given.alias("given"), listed(text("SUFFIX")).alias("suffix"), null.alias("text")))
    alias = F.when(text("ALIAS").isNotNull(), F.struct(F.lit("nickname").alias("use"), null.alias("family"), none.alias("given"), none.alias("suffix"), text("ALIAS").alias("text")))
    cells = F.flatten(F.array(*[F.split(F.coalesce(text(c), F.lit("")), r"\^+") for c in ("PHONE", "PHONE2")]))
    numbers = F.filter(F.transform(cells, lambda x: F.trim(x)), lambda x: x != "")
    phones = F.transform(numbers, lambda x, i: F.struct(F.lit("phone").alias("system"), x.alias("value"), (i + 1).alias("rank")))
    email = F.array_compact(F.array(F.when(text("EMAIL").isNotNull(), F.struct(F.lit("email").alias("system"), text("EMAIL").alias("value"), F.lit(1).alias("rank")))))
    telecom = F.concat(phones, email)
    line = listed(text("ADDRESS1"), text("ADDRESS2"))
    address = F.when(line.isNotNull() | text("CITY").isNotNull() | text("STATE").isNotNull() | text("ZIP").isNotNull(), F.array(F.struct(F.lit("home").alias("use"), line.alias("line"), text("CITY").alias("city"), text("STATE").alias("state"), text("ZIP").alias("postalCode"))))
    names = F.array_compact(F.array(official, alias))
    gender = F.try_element_at(F.create_map(*[F.lit(x) for kv in GENDERS.items() for x in kv]), F.upper(F.substring(F.coalesce(text("GENDER"), F.lit("")), 1, 1)))
    person = person_struct(
        id=text("EnterpriseID"),
        gender=gender,
        birthDate=N.from_day_offset(F.coalesce(text("DOB"), F.lit(""))),
        name=F.when(F.size(names) > 0, names),
        telecom=F.when(F.size(telecom) > 0, telecom),
        address=address,
        identifier=F.when(text("SSN").isNotNull(), F.array(ssn_identifier(text("SSN")))),
        extension=F.when(text("MOTHERS_MAIDEN_NAME").isNotNull(), F.array(F.struct(F.lit(MAIDEN_URL).alias("url"), text("MOTHERS_MAIDEN_NAME").alias("valueString")))),
    )
    return df.withColumn("person", person)


def shards(spark: SparkSession, folder: str, pattern: str = "*.csv", limit: int | None = None) -> list[str]:
    """The shard files of a folder, on any file system that Spark reads, by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{pattern}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in (found or []))[:limit]


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The columns of a file, from its first line alone."""
    jvm, where = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(c.strip().strip('"').lstrip("\ufeff") for c in (line or "").split(","))


def read_people(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(shard, person) of CSV shards with a header; everything is text, nothing is inferred. Paths with ``..`` and files without the
    columns FIRST and LAST are refused before anything is read. Files with one header are one scan, however many there are; no
    paths give no people."""
    ship(spark)
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        if ".." in path.split("/"):
            raise ValueError(f"path with ..: {path}")
        columns = _header(spark, path)
        if not {"FIRST", "LAST"} <= set(columns):
            raise ValueError(f"no columns FIRST and LAST in {path}")
        groups.setdefault(columns, []).append(path)
    name = lambda c: F.regexp_extract(c, r"([^/]+/[^/]+)$", 1)
    tail = lambda p: "/".join(p.rstrip("/").split("/")[-2:])
    numbers = spark.createDataFrame([(tail(p), i) for i, p in enumerate(paths)], "_file string, shard int")
    together = spark.createDataFrame([], FLAT).withColumn("_file", F.lit(""))
    for columns, files in groups.items():
        kind = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        read = spark.read.csv(files, header=True, schema=kind, enforceSchema=False)
        together = together.unionByName(read.withColumn("_file", name(F.input_file_name())), allowMissingColumns=True)
    return to_person(together).join(numbers, "_file").select("shard", "person")


def sample_and_donors(people: DataFrame, sample: int, donors: int) -> tuple[DataFrame, DataFrame]:
    """The first people of a shard in the order of their ids, and the next ones."""
    placed = number_rows(people.withColumn("_id", F.col("person.id")), [F.col("_id")], "ord").drop("_id")
    return placed.where(F.col("ord") < sample), placed.where((F.col("ord") >= sample) & (F.col("ord") < sample + donors))


FLAT = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
