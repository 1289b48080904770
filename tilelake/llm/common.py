"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it was."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text as UTF-8; bytes.split() cuts at exactly the white space of WORD."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def column(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``df`` has, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
