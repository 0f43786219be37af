"""ARFF export and import of labelled vectors.

The export is a directory of part files that, read in name order, are one ARFF
document: the header first, then per vector a comment ``%n a b`` and the data line.
No task sees the whole of it. ``parts.join_parts`` makes the single file where the file
system can join files, ``parts.part_list`` says where each part starts.

Data lines are dense, ``0,3,0,True``, or sparse, ``{1 3, 3 True}``: place and value of what
isn't zero, in any place order when read, the class at the place after the last path.
A sparse line holds as much text as its pair has paths, however many there are in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import dense_array, vector_text
from ..operators.numbering import dense_ids


def number_vectors(sparse: DataFrame) -> DataFrame:
    """Sparse vectors with the running example number ``num``, 1, 2, ... in (a, b) order."""
    return dense_ids(sparse, ["a", "b"], "num", start=1)


def arff_header(vocabulary: DataFrame) -> DataFrame:
    """Header lines with their place, ``section, num, value``: one row per path."""
    spark = vocabulary.sparkSession
    fixed = [
        (0, 0, "@RELATION vectors"),
        (2, 0, "@ATTRIBUTE class {True, False}"),
        (3, 0, "@DATA"),
    ]
    name = F.concat(F.lit("@ATTRIBUTE col"), F.col("id").cast("string"), F.lit(" NUMERIC"))
    attributes = vocabulary.select(
        F.lit(1).alias("section"), F.col("id").alias("num"), name.alias("value")
    )
    return spark.createDataFrame(fixed, "section int, num bigint, value string").unionByName(attributes)


def arff_body(numbered: DataFrame, size: DataFrame) -> DataFrame:
    """Two lines per vector in one value: the pair comment and the data.

    The dense text is made here, in the projection of the task that writes it; nothing
    before holds zeros.
    """
    comment = F.concat(F.lit("%"), F.col("num").cast("string"), F.lit("\t"), "a", F.lit("\t"), "b")
    features = dense_array(F.col("cells"), F.col("_size"))
    data = vector_text(features, F.col("label"))
    return numbered.withColumn("_size", size.scalar()).select(
        F.lit(4).alias("section"), "num", F.concat_ws("\n", comment, data).alias("value")
    )


def sparse_arff_body(numbered: DataFrame, size: DataFrame) -> DataFrame:
    """``arff_body`` with sparse data: nothing of the length of the vocabulary is made."""
    comment = F.concat(F.lit("%"), F.col("num").cast("string"), F.lit("\t"), "a", F.lit("\t"), "b")
    entry = lambda c: F.concat(c["id"].cast("string"), F.lit(" "), c["n"].cast("string"))
    label = F.concat(F.col("_size").cast("string"), F.lit(" "), F.when(F.col("label"), "True").otherwise("False"))
    entries = F.concat_ws(", ", F.transform("cells", entry), label)
    return numbered.withColumn("_size", size.scalar()).select(
        F.lit(4).alias("section"),
        "num",
        F.concat(comment, F.lit("\n{"), entries, F.lit("}")).alias("value"),
    )


BODIES = {"dense": arff_body, "sparse": sparse_arff_body}


def arff_lines(
    sparse: DataFrame, vocabulary: DataFrame, size: DataFrame, form: str = "dense"
) -> DataFrame:
    """All lines of the document as ``section, num, part, value``."""
    body = BODIES[form](number_vectors(sparse), size).select(
        "section", "num", F.posexplode(F.split("value", "\n")).alias("part", "value")
    )
    header = arff_header(vocabulary).select("section", "num", F.lit(0).alias("part"), "value")
    return header.unionByName(body)


def write_arff(
    sparse: DataFrame,
    vocabulary: DataFrame,
    size: DataFrame,
    path: str,
    mode: str = "errorifexists",
    form: str = "dense",
) -> None:
    """Write the document as ordered part files in two folders, ``0-header`` and ``1-data``,
    with ``dense`` or ``sparse`` data lines.

    Both are sorted as narrow rows: the paths, and the sparse vectors.
    """
    header = arff_header(vocabulary).orderBy("section", "num")
    header.select("value").write.mode(mode).text(f"{path}/0-header")
    body = BODIES[form](number_vectors(sparse).orderBy("num"), size)
    body.select("value").write.mode(mode).text(f"{path}/1-data")


def _texts(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The text of a document, whether in one file, part files or the folders above."""
    return spark.read.option("recursiveFileLookup", "true").options(**options).text(path)


def parse_arff(lines: DataFrame, value: str = "value") -> DataFrame:
    """Data lines as ``features, label``: the class is the last attribute."""
    parts = (
        lines.select(F.trim(F.col(value)).alias("_v"))
        .where((F.col("_v") != "") & ~F.col("_v").rlike("^[%@]"))
        .select(F.split("_v", ",").alias("_p"))
    )
    return parts.select(
        F.slice("_p", F.lit(1), F.size("_p") - 1).cast("array<bigint>").alias("features"),
        (F.lower(F.trim(F.get("_p", F.size("_p") - 1))) == "true").alias("label"),
    )


def read_arff(spark: SparkSession, path: str) -> DataFrame:
    return parse_arff(_texts(spark, path))


def read_arff_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Vectors of an exported document with the pairs of their comments.

    The text is cut at the ``%`` that starts each comment, so a comment and its data
    line are one record. No word of a vector can hold that character.
    """
    records = _texts(spark, path, lineSep="%")
    split = records.select(F.split("value", "[\t\n]").alias("_r")).where(F.size("_r") >= 4)
    data = split.where(F.get("_r", F.lit(0)).rlike("^[0-9]+$")).select(
        F.get("_r", F.lit(0)).cast("bigint").alias("num"),
        F.get("_r", F.lit(1)).alias("a"),
        F.get("_r", F.lit(2)).alias("b"),
        F.split(F.get("_r", F.lit(3)), ",").alias("_p"),
    )
    return data.select(
        "num",
        "a",
        "b",
        F.slice("_p", F.lit(1), F.size("_p") - 1).cast("array<bigint>").alias("features"),
        (F.lower(F.get("_p", F.size("_p") - 1)) == "true").alias("label"),
    )


def _sparse_cells(data: Column) -> list[Column]:
    """``cells, label`` of a sparse data line: cells in id order, zeros left out."""
    inner = F.regexp_extract(data, r"^\s*\{(.*)\}\s*$", 1)
    entries = F.transform(F.split(inner, ","), lambda e: F.split(F.trim(e), r"\s+"))
    pairs = F.filter(entries, lambda e: F.size(e) == 2)
    number = lambda e: F.get(e, F.lit(1)).try_cast("bigint")
    counted = F.filter(pairs, lambda e: number(e) != 0)
    cell = lambda e: F.struct(F.get(e, F.lit(0)).cast("bigint").alias("id"), number(e).alias("n"))
    said = F.filter(pairs, lambda e: number(e).isNull())
    # A nominal value that is left out is the first one declared, which is True.
    label = F.coalesce(F.lower(F.get(F.get(said, F.lit(0)), F.lit(1))) == "true", F.lit(True))
    return [F.array_sort(F.transform(counted, cell)).alias("cells"), label.alias("label")]


def parse_sparse_arff(lines: DataFrame, value: str = "value") -> DataFrame:
    """Sparse data lines as ``cells, label``."""
    data = F.col(value)
    return lines.where(data.rlike(r"^\s*\{")).select(*_sparse_cells(data))


def read_sparse_arff(spark: SparkSession, path: str) -> DataFrame:
    return parse_sparse_arff(_texts(spark, path))


def read_sparse_arff_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Sparse vectors ``num, a, b, label, cells`` with the pairs of their comments."""
    records = _texts(spark, path, lineSep="%").select(F.split("value", "[\t\n]").alias("_r"))
    data = records.where((F.size("_r") >= 4) & F.get("_r", F.lit(0)).rlike("^[0-9]+$"))
    cells, label = _sparse_cells(F.get("_r", F.lit(3)))
    return data.select(
        F.get("_r", F.lit(0)).cast("bigint").alias("num"),
        F.get("_r", F.lit(1)).alias("a"),
        F.get("_r", F.lit(2)).alias("b"),
        label,
        cells,
    )
